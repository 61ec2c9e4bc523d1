"""Extraction providers over HTTP: the requests of three interfaces, their retries, and the answer inside a response."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from ledgerline.grounding.checks import REVIEW_STATUS
from ledgerline.grounding.providers import ADJUDICATE, EXTRACT, FALLBACK, REVIEW_ROLE
from ledgerline.sources.live import Transport, send

# Each interface's address, the seconds it is given, the header that carries the key and what stands before it.
INTERFACES = {
    "gemini": ("https://generativelanguage.googleapis.com/v1beta/interactions", 60.0, "x-goog-api-key", ""),
    "cohere": ("https://api.cohere.com/v2/chat", 60.0, "Authorization", "Bearer "),
    "groq": ("https://api.groq.com/openai/v1/chat/completions", 90.0, "Authorization", "Bearer "),
}
# The models asked unless another is named.
MODELS = {"gemini": "gemini-3.7-flash", "cohere": "command-a-plus-05-2026", "groq": "openai/gpt-oss-120b"}
ROLES = {"gemini": (EXTRACT,), "cohere": (EXTRACT, FALLBACK, REVIEW_ROLE), "groq": (EXTRACT, FALLBACK, ADJUDICATE)}
#: Statuses after which a request is sent again; 429 waits as the server asks.
AGAIN = (500, 502, 503, 504)


class ProviderError(RuntimeError):
    """Why a provider gave no answer."""


def _object(closed: bool, **properties: dict) -> dict:
    return {"type": "object", "properties": properties, "required": list(properties), **({"additionalProperties": False} if closed else {})}


def _one_of(*kinds: str) -> dict:
    return {"type": list(kinds) if len(kinds) > 1 else kinds[0]}


def extraction_schema(closed: bool = True) -> dict:
    """The JSON schema of an extraction; closed: no other keys."""
    claim = _object(closed, field=_one_of("string"), value=_one_of("string", "boolean", "null"), evidence_quote=_one_of("string", "null"), supported=_one_of("boolean"))
    text = _one_of("string", "null")
    return _object(closed, company=text, role_family=text, is_remote=_one_of("boolean", "null"), summary=text, evidence_quotes={"type": "array", "items": _one_of("string")}, claims={"type": "array", "items": claim})


def review_schema() -> dict:
    """The JSON schema of a review."""
    texts = {"type": "array", "items": _one_of("string")}
    return _object(True, corrected_extraction=extraction_schema(), corrections=texts, added_information=texts, removed_information=texts, review_status={"type": "string", "enum": list(REVIEW_STATUS)})


def request_body(kind: str, model: str, prompt: str, schema: dict) -> dict:
    """What is sent to an interface for one prompt, with the structure that the answer must have."""
    if kind == "gemini":
        return {"model": model, "input": prompt, "response_format": {"type": "text", "mime_type": "application/json", "schema": schema}}
    user = {"role": "user", "content": prompt}
    if kind == "cohere":
        return {"model": model, "messages": [user], "temperature": 0, "response_format": {"type": "json_object", "schema": schema}}
    system = {"role": "system", "content": "You decide the last stage of an extraction. Answer with valid JSON only. Nothing but the evidence counts; never guess."}
    return {"model": model, "messages": [system, user], "response_format": {"type": "json_schema", "json_schema": {"name": "extraction_result", "schema": schema}}, "temperature": 0}


def answer_text(kind: str, data: object) -> str:
    """The answer inside a response; ProviderError if there is none."""
    as_list = lambda x: x if isinstance(x, list) else []
    texts: list = []
    if isinstance(data, dict):
        if kind == "gemini":
            texts = [c.get("text") for s in as_list(data.get("steps")) if isinstance(s, dict) and s.get("type") == "model_output" for c in as_list(s.get("content")) if isinstance(c, dict) and c.get("type") == "text"]
        elif kind == "cohere":
            content = data["message"].get("content") if isinstance(data.get("message"), dict) else None
            texts = [content] if isinstance(content, str) else [c.get("text") for c in as_list(content) if isinstance(c, dict) and c.get("type") == "text"]
        else:
            choice = next(iter(as_list(data.get("choices"))), None)
            message = choice.get("message") if isinstance(choice, dict) else None
            texts = [message.get("content")] if isinstance(message, dict) else []
    for t in texts:
        if isinstance(t, str) and t:
            return t
    raise ProviderError(f"{kind} returned no text")


def wait_after(status: int | None, attempt: int, retry_after: str | None) -> float | None:
    """Seconds before the next attempt, without jitter; None if there is no other. attempt counts from 0."""
    if status == 429:
        try:
            return min(float(retry_after) if retry_after else 2.0**attempt, 30.0)
        except ValueError:
            return 2.0
    return min(2.0**attempt, 10.0) if status is None or status in AGAIN else None


def post(transport: Transport, url: str, headers: dict[str, str], body: dict, seconds: float, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> object:
    """The JSON of a response, with retries on 429, 500, 502-504 and where no answer comes; ProviderError for all else, 413 and unreadable JSON too."""
    for attempt in range(attempts):
        status, raw, back = transport("POST", url, {"Content-Type": "application/json", **headers}, json.dumps(body).encode(), seconds)
        wait = wait_after(status, attempt, {k.lower(): v for k, v in back.items()}.get("retry-after"))
        if wait is None:
            break
        if attempt == attempts - 1:
            raise ProviderError(f"HTTP {status} after {attempts} attempts" if status else f"No answer after {attempts} attempts: {back.get('error', '')}")
        sleep(min(wait + random.uniform(0, 0.5), 30.0) if status == 429 else wait + random.uniform(0, 0.5))
    if status == 413:
        raise ProviderError("HTTP 413: the request is too large")
    if status >= 400:
        raise ProviderError(f"HTTP {status}: {raw[:500].decode('utf-8', 'replace')}")
    try:
        return json.loads(raw)
    except ValueError as e:
        raise ProviderError("The response isn't JSON") from e


@dataclass(frozen=True)
class HttpProvider:
    """A provider behind one of the INTERFACES, in one of its roles. `answer` has None for a prompt whose request fails; `ask_one` raises why."""

    name: str
    api_key: str
    model: str = ""
    role: str = EXTRACT
    url: str = ""
    attempts: int = 3
    transport: Transport = send
    sleep: Callable[[float], None] = time.sleep

    @property
    def roles(self) -> tuple[str, ...]:
        return ROLES[self.name]

    def as_role(self, role: str) -> HttpProvider:
        return replace(self, role=role)

    def ask_one(self, prompt: str) -> str:
        url, seconds, header, before = INTERFACES[self.name]
        schema = review_schema() if self.role == REVIEW_ROLE else extraction_schema(self.name != "gemini")
        body = request_body(self.name, self.model or MODELS[self.name], prompt, schema)
        return answer_text(self.name, post(self.transport, self.url or url, {header: before + self.api_key}, body, seconds, self.attempts, self.sleep))

    def answer(self, prompts: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for p in prompts:
            try:
                out.append(self.ask_one(p))
            except ProviderError:
                out.append(None)
        return out
