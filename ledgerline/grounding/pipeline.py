"""Three stages - extract, review, adjudicate - with a fallback, as columns: each stage runs only where the one before calls for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.grounding.checks import EXTRACTION, REVIEW, decode, decode_strict, ground
from ledgerline.grounding.providers import ADJUDICATE, EXTRACT, FALLBACK, REVIEW_ROLE, Provider, adjudicate_prompt, ask, extract_prompt, in_role, review_prompt
from ledgerline.session import cut

# What a record is told of its stages, each before or after a provider's name and, with a colon, the error.
UNAVAILABLE, FALLBACK_USED = "unavailable", "fallback extraction used"
EXTRACTION_FAILED, FALLBACK_FAILED, FALLBACK_DONE = "extraction failed", "fallback extraction failed", "fallback extraction succeeded"
REVIEW_FAILED, ADJUDICATION_FAILED = "review failed", "adjudication failed"
SUFFIX = "-fallback-extract"
ODD = "the answer doesn't have the structure"


def route(extracted: Column, fallback: Column, reviewed: Column, adjudicated: Column) -> Column:
    """How a record leaves the pipeline, from the success of each stage (NULL counts as failure)."""
    ok = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(~ok(extracted) & ~ok(fallback), "no_extraction")
        .when(~ok(extracted) & ~ok(adjudicated), "fallback_adjudication_failed")
        .when(~ok(extracted), "fallback")
        .when(~ok(reviewed), "review_failed")
        .when(~ok(adjudicated), "adjudication_failed")
        .otherwise("complete")
    )


def run_pipeline(df: DataFrame, evidence: str, first: Provider, second: Provider, third: Provider) -> DataFrame:
    """df with draft, review, final (JSON text), first_attempt, second_attempt, third_attempt, exit, validation_status and validation_errors.

    first extracts; where it fails second extracts instead, and its draft counts as unreviewed (INSUFFICIENT_EVIDENCE); else second reviews; third
    adjudicates. Providers that name their roles must have these (NotImplementedError). Answers that don't have the structure count as
    failures. An attempt is struct<provider, model, success, result, error>, NULL where the stage wasn't reached. validation_errors tell
    which stage failed and why, or what grounding found, after two notes if the fallback was used. Each stage's answers are stored before the
    next stage asks, so a task that runs again never asks a provider of an earlier stage again. A NULL evidence fails its first stage.
    """
    one_, fall_back, review_, three_ = in_role(first, EXTRACT), in_role(second, FALLBACK), in_role(second, REVIEW_ROLE), in_role(third, ADJUDICATE)
    shaped = lambda c, shape: F.when(decode_strict(c, shape).isNotNull(), c)
    why = lambda answer, good: F.when(good.isNull(), F.coalesce(answer["error"], F.lit(ODD)))
    attempt = lambda provider, good, error, name=None: F.struct(F.lit(name or provider.name).alias("provider"), F.lit(provider.model).alias("model"), good.isNotNull().alias("success"), good.alias("result"), error.alias("error"))
    e = F.col(evidence)
    one = cut(df.withColumn("__a1", ask(one_)(extract_prompt(e))))
    one = one.withColumn("__first", shaped(F.col("__a1.text"), EXTRACTION))
    direct = F.col("__first").isNotNull()
    two = cut(one.withColumns({"__af": ask(fall_back)(F.when(~direct, extract_prompt(e, fallback=True))), "__ar": ask(review_)(F.when(direct, review_prompt(e, F.col("__first"))))}))
    two = two.withColumn("__fallback", F.when(~direct, shaped(F.col("__af.text"), EXTRACTION))).withColumn("draft", F.coalesce("__first", "__fallback"))
    reviewed = F.when(direct, shaped(F.col("__ar.text"), REVIEW))
    synthetic = F.concat(F.lit('{"corrected_extraction": '), F.col("draft"), F.lit(', "corrections": [], "added_information": [], "removed_information": [], "review_status": "INSUFFICIENT_EVIDENCE"}'))
    two = two.withColumn("review", F.when(direct, reviewed).when(F.col("draft").isNotNull(), synthetic))
    prompt = F.when(direct & F.col("review").isNotNull(), adjudicate_prompt(e, F.col("draft"), F.col("review"))).when(~direct & F.col("draft").isNotNull(), adjudicate_prompt(e, F.col("draft"), F.col("review"), fallback=True))
    three = cut(two.withColumn("__a3", ask(three_)(prompt)))
    three = three.withColumn("final", shaped(F.col("__a3.text"), EXTRACTION))
    done = three.withColumn("exit", route(direct, F.col("__fallback").isNotNull(), direct & F.col("review").isNotNull(), F.col("final").isNotNull()))
    errors = {
        "__e1": why(F.col("__a1"), F.col("__first")), "__e2": F.when(direct, why(F.col("__ar"), F.col("review"))).otherwise(why(F.col("__af"), F.col("__fallback"))), "__e3": why(F.col("__a3"), F.col("final")),
    }
    judged = ground(done.withColumns(errors).withColumn("__x", decode(F.col("final"))), evidence, "__x")
    says = lambda provider, what, error=None: F.concat(F.lit(f"{provider.name.capitalize()} {what}: "), F.col(error)) if error else F.lit(f"{provider.name.capitalize()} {what}")
    adjudication = says(third, ADJUDICATION_FAILED, "__e3")
    told = (
        F.when(F.col("exit") == "no_extraction", F.array(says(first, EXTRACTION_FAILED, "__e1"), says(second, FALLBACK_FAILED, "__e2")))
        .when(F.col("exit") == "fallback_adjudication_failed", F.array(says(first, EXTRACTION_FAILED, "__e1"), says(second, FALLBACK_DONE), adjudication))
        .when(F.col("exit") == "fallback", F.concat(F.array(says(first, UNAVAILABLE, "__e1"), says(second, FALLBACK_USED)), "validation_errors"))
        .when(F.col("exit") == "review_failed", F.array(says(second, REVIEW_FAILED, "__e2")))
        .when(F.col("exit") == "adjudication_failed", F.array(adjudication))
        .otherwise(F.col("validation_errors"))
    )
    stopped = ~F.col("exit").isin("complete", "fallback")
    reached = F.col("draft").isNotNull() & F.col("review").isNotNull()
    return judged.withColumns(
        {
            "validation_status": F.when(stopped, "QUARANTINE").otherwise(F.col("validation_status")),
            "validation_errors": told,
            "first_attempt": attempt(first, F.col("__first"), F.col("__e1")),
            "second_attempt": F.when(direct, attempt(second, F.col("review"), F.col("__e2"))).otherwise(attempt(second, F.col("__fallback"), F.col("__e2"), second.name + SUFFIX)),
            "third_attempt": F.when(reached, attempt(third, F.col("final"), F.col("__e3"))),
        }
    ).drop("__a1", "__af", "__ar", "__a3", "__first", "__fallback", "__x", "__e1", "__e2", "__e3")
