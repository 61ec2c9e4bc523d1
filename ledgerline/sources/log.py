"""Structured events of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import record_id
from ledgerline.schemas import schema


def events(df: DataFrame, stage: str, status: Column, run_at: str, detail: list[str] = (), **fields: Column) -> DataFrame:
    """df's rows as rows of pipeline_log; detail columns become JSON with NULLs kept, NULL without any."""
    values = {
        "ts": F.lit(run_at).cast("timestamp"), "stage": F.lit(stage), "status": status, "detail": F.to_json(F.struct(*detail), {"ignoreNullFields": "false"}) if detail else F.lit(None).cast("string"), **fields,
    }
    values["id"] = record_id(*(values.get(k, F.lit(None)) for k in ("ts", "stage", "source", "record_id", "status", "detail")))
    return df.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema("pipeline_log")))
