"""Sizes of texts in tokens of a public byte-pair tokenizer."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vocabulary file (tiktoken ranks) read on the driver; any other file of that form may be named instead.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer splits text before merging bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def canonical_source(c: Column) -> Column:
    """Source names as mix_targets has them: lower case, bare ends, words joined by "_"; NULL and blank names are NULL."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(c), r"^[\s_-]+|[\s_-]+$", ""), r"[\s_-]+", "_"), F.lit(""))


# Runs of white space (as the pattern has it) that its look-ahead would need too deep a stack for.
_LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def encoder(ranks: bytes):
    """text -> token ids, from the bytes of a vocabulary file; texts may be of any length and make."""
    import tiktoken

    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    made = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        out, at = [], 0
        for m in _LONG_SPACE.finditer(text):
            # The pattern makes one piece of such a run, but for the last character before more text.
            end = m.end() - (m.end() < len(text))
            out += made.encode_ordinary(text[at : m.start()])
            out += made._encode_single_piece(text[m.start() : end])
            at = end
        return out + made.encode_ordinary(text[at:]) if at else made.encode_ordinary(text)

    return encode


def token_counts(documents: DataFrame, doc_id: str, text: str, *keep: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, kept columns, tokens, head_tokens) of each row: whole texts are encoded, NULL and empty ones have 0 tokens.

    head_tokens are the tokens of the first line, with its line end, of a text of several lines (a title or question), else 0. The
    vocabulary is broadcast as bytes: its size is that of the file, whatever the number of documents.
    """
    with open(vocabulary, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())
    spare = documents.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).alias("__text"))
    kept = spare.select("doc_id", *keep)
    names = kept.columns

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(ranks.value)
        for pdf in batches:
            total, head = [], []
            for t in pdf["__text"]:
                first, end, rest = t.partition("\n") if t else ("", "", "")
                total.append(len(encode(t)) if t else 0)
                head.append(min(total[-1], len(encode(first + end))) if rest and first.strip() else 0)
            yield pdf[names].assign(tokens=total, head_tokens=head)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return spare.mapInPandas(counted, f"{fields}, tokens bigint, head_tokens bigint")
