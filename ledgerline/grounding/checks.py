"""Extractions held against their evidence: every quote and every field must be grounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Structured output of a provider; claim values are kept as text with a note of whether they are null.
EXTRACTION = "struct<company: string, role_family: string, is_remote: boolean, summary: string, evidence_quotes: array<string>, claims: array<struct<field: string, value: string, evidence_quote: string, supported: boolean>>>"
REVIEW = f"struct<corrected_extraction: {EXTRACTION}, corrections: array<string>, added_information: array<string>, removed_information: array<string>, review_status: string>"
REVIEW_STATUS = ("ACCEPTED", "CORRECTED", "CONFLICT", "INSUFFICIENT_EVIDENCE")
# The errors' texts, each followed by the quote or field at fault.
BAD_QUOTE = "Evidence quote not found in source: "
NO_QUOTE = "Supported claim has no evidence quote: "
BAD_CLAIM_QUOTE = "Claim evidence quote not found in source: "
NO_VALUE = "Supported claim has no value: "
NO_CLAIM = "Non-null field has no supported claim: "

#: Fields that need a supported claim, in the order in which they are reported.
FIELDS = ("company", "role_family", "is_remote", "summary")


def decode(text: Column, shape: str = EXTRACTION) -> Column:
    """A provider's JSON as a struct; NULL if it can't be read. Values of claims may be text, boolean or null."""
    return F.from_json(text, shape, {"mode": "PERMISSIVE"})


def decode_strict(text: Column, shape: str = EXTRACTION) -> Column:
    """A provider's JSON as a struct; NULL if it isn't an object of this shape: a part of another kind, a claim without a field, a review without its extraction or status.

    Parts that are absent are NULL, keys besides those of the shape don't matter.
    """
    read = F.from_json(text, shape.removesuffix(">") + ", _corrupt_record: string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    extraction = read["corrected_extraction"] if "corrected_extraction" in shape else read
    nameless = F.coalesce(F.exists(extraction["claims"], lambda c: c.isNull() | c["field"].isNull()), F.lit(False))
    good = text.isNotNull() & F.ltrim(text).startswith("{") & read["_corrupt_record"].isNull() & ~nameless
    if extraction is not read:
        good = good & extraction.isNotNull() & F.coalesce(read["review_status"].isin(*REVIEW_STATUS), F.lit(False))
    return F.when(good, F.from_json(text, shape, {"mode": "PERMISSIVE"}))


def _holds(evidence: Column, quote: Column) -> Column:
    return F.coalesce(F.contains(evidence, quote), F.lit(False))


def grounding_errors(evidence: Column, x: Column) -> Column:
    """Errors of an extraction struct in a fixed order: quotes, claims one by one, fields. An empty array means grounded.

    Matching is exact in case and space. An empty quote is held by any evidence; NULL evidence holds none. NULL arrays count as empty,
    NULL elements are skipped.
    """
    quotes = F.filter(F.coalesce(x["evidence_quotes"], F.array().cast("array<string>")), lambda q: q.isNotNull())
    bad_quotes = F.transform(F.filter(quotes, lambda q: ~_holds(evidence, q)), lambda q: F.concat(F.lit(BAD_QUOTE), q))
    claims = F.filter(F.coalesce(x["claims"], F.from_json(F.lit("[]"), "array<struct<field: string, value: string, evidence_quote: string, supported: boolean>>")), lambda c: c.isNotNull())
    supported = lambda c: F.coalesce(c["supported"], F.lit(False))
    name = lambda c: F.coalesce(c["field"], F.lit(""))
    none = F.lit(None).cast("string")
    of_claim = lambda c: F.array_compact(F.array(
        F.when(c["evidence_quote"].isNull() & supported(c), F.concat(F.lit(NO_QUOTE), name(c))).otherwise(none),
        F.when(c["evidence_quote"].isNotNull() & ~_holds(evidence, c["evidence_quote"]), F.concat(F.lit(BAD_CLAIM_QUOTE), name(c))).otherwise(none),
        F.when(c["evidence_quote"].isNotNull() & supported(c) & c["value"].isNull(), F.concat(F.lit(NO_VALUE), name(c))).otherwise(none),
    ))
    backed = F.transform(F.filter(claims, supported), name)
    missing = [F.when(x[f].isNotNull() & ~F.array_contains(backed, f), NO_CLAIM + f).otherwise(none) for f in FIELDS]
    return F.concat(bad_quotes, F.flatten(F.transform(claims, of_claim)), F.array_compact(F.array(*missing)))


def ground(df: DataFrame, evidence: str, extraction: str) -> DataFrame:
    """df with validation_errors and validation_status (VALIDATED without errors, else QUARANTINE); a NULL extraction is quarantined."""
    errors = F.when(F.col(extraction).isNull(), F.array(F.lit("Extraction can't be read"))).otherwise(grounding_errors(F.col(evidence), F.col(extraction)))
    return df.withColumn("validation_errors", errors).withColumn("validation_status", F.when(F.size("validation_errors") == 0, "VALIDATED").otherwise("QUARANTINE"))
