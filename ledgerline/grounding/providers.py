"""Extraction providers: what a stage calls, and what it asks."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


EXTRACT, FALLBACK, REVIEW_ROLE, ADJUDICATE = "extract", "fallback_extract", "review", "adjudicate"


class Provider(Protocol):
    """One model behind a stage. Called on the executors with a batch of prompts; one answer (JSON text, or None for a failure) for each.

    roles, if it has any, names what it may be asked for: extract, fallback_extract, review, adjudicate.
    """

    name: str
    model: str

    def answer(self, prompts: list[str]) -> list[str | None]: ...


def need(provider: Provider, *roles: str) -> None:
    """NotImplementedError for a role that a provider doesn't have; one that names no roles has all."""
    for role in roles:
        if role not in getattr(provider, "roles", (role,)):
            raise NotImplementedError(f"{provider.name} does not support {role}")


def in_role(provider: Provider, role: str) -> Provider:
    """A provider made ready for a role; NotImplementedError if it doesn't have it."""
    need(provider, role)
    return provider.as_role(role) if hasattr(provider, "as_role") else provider


def ask(provider: Provider) -> Callable[[Column], Column]:
    """A provider as a column function, called in Arrow batches: struct<text, error>, NULL for a NULL prompt. An exception fails one prompt at a time.

    A provider with a method ask_one is asked prompt by prompt, and its exceptions tell why; of others an exception for a whole batch
    is followed by asking one by one.
    """

    def single(prompt: str) -> tuple[str | None, str | None]:
        try:
            text = provider.ask_one(prompt) if hasattr(provider, "ask_one") else provider.answer([prompt])[0]
        except Exception as e:
            return None, str(e) or type(e).__name__
        return text, "no answer" if text is None else None

    @F.pandas_udf("struct<text: string, error: string>")
    def answers(prompts: pd.Series) -> pd.DataFrame:
        asked = [k for k, p in enumerate(prompts) if p is not None]
        out: list[tuple[str | None, str | None]] = [(None, None)] * len(prompts)
        try:
            if hasattr(provider, "ask_one"):
                raise NotImplementedError
            for k, a in zip(asked, provider.answer([prompts.iloc[k] for k in asked]), strict=True):
                out[k] = a, "no answer" if a is None else None
        except Exception:
            for k in asked:
                out[k] = single(prompts.iloc[k])
        return pd.DataFrame(out, columns=["text", "error"], dtype=object)

    return answers


def response_text(body: Column, provider: str) -> Column:
    """The answer inside a provider's HTTP body: model output steps, message content (text or parts), or choices."""
    if provider == "gemini":
        steps = F.from_json(F.get_json_object(body, "$.steps"), "array<struct<type: string, content: array<struct<type: string, text: string>>>>")
        texts = F.flatten(F.transform(F.filter(steps, lambda s: s["type"] == "model_output"), lambda s: F.filter(s["content"], lambda c: c["type"] == "text")))
        return F.get(texts, F.lit(0))["text"]
    if provider == "cohere":
        parts = F.get(F.filter(F.from_json(F.get_json_object(body, "$.message.content"), "array<struct<type: string, text: string>>"), lambda c: c["text"].isNotNull()), F.lit(0))["text"]
        return F.coalesce(parts, F.get_json_object(body, "$.message.content"))
    return F.get_json_object(body, "$.choices[0].message.content")


def _indented(c: Column) -> Column:
    """JSON text with an indent of two, letters as they are; other text stays."""

    def one(t):
        try:
            return None if t is None else json.dumps(json.loads(t), indent=2, ensure_ascii=False)
        except ValueError:
            return t

    @F.pandas_udf("string")
    def indented(text: pd.Series) -> pd.Series:
        return text.map(one)

    return indented(c)


_SHAPE = (
    "Answer with one JSON object and nothing around it: company, role_family, summary (text or null), is_remote (true, false or null), evidence_quotes (a list of texts) "
    "and claims (a list of objects of field, value, evidence_quote, supported)."
)
_RULES = (
    "Use nothing but the evidence; what you know besides doesn't count. Copy every quote letter by letter, with its case and spacing. Give each field that isn't null exactly one supported claim, "
    "named after the field, with the same value and a quote that shows it. Leave a field null when no single quote shows it, and make no supported claim for it. A posting that says nothing of where the work is done has is_remote null."
)
_REVIEW_SHAPE = (
    "Answer with one JSON object and nothing around it: corrected_extraction (an extraction in the structure of the draft), corrections, added_information, removed_information (lists of texts) "
    "and review_status (ACCEPTED if the draft stands, CORRECTED if you changed it, CONFLICT if the evidence contradicts itself, INSUFFICIENT_EVIDENCE if it doesn't carry the draft)."
)


def _prompt(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def extract_prompt(evidence: Column, fallback: bool = False) -> Column:
    """What the first stage is asked; fallback: what a provider is asked that stands in for it, whose draft nobody will review."""
    head = "Another model failed to read the posting below; you read it in its place, and no one reviews your draft before the last stage, so be strict." if fallback else "Read the posting below."
    return _prompt(f"{head} Name company, role family, whether the work is remote, and a summary of one sentence. {_RULES} {_SHAPE}\n\nEvidence:\n", evidence)


def review_prompt(evidence: Column, draft: Column, fallback: bool = False) -> Column:
    head = "The first model failed, so this draft is another's own work: check it as if a stranger had written it." if fallback else "Check this draft against the evidence."
    return _prompt(f"{head} Correct what is wrong and list what you changed, added and removed. {_RULES} {_REVIEW_SHAPE}\n\nEvidence:\n", evidence, "\n\nDraft:\n", _indented(draft))


def adjudicate_prompt(evidence: Column, draft: Column, review: Column, fallback: bool = False) -> Column:
    head = "There is one draft and no review of it: be strict." if fallback else "A draft and its review may differ: decide by the evidence alone, not by who said it."
    return _prompt(f"{head} {_RULES} {_SHAPE}\n\nEvidence:\n", evidence, "\n\nDraft:\n", _indented(draft), "\n\nReview:\n", _indented(review))
