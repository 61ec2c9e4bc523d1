"""Sessions and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

from ledgerline.schemas import INPUTS


def build_session(app: str = "ledgerline", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; on a cluster, submit-time settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only where none is set and all runs in one process (tests) one is made, which ends with the session's process.

    Files in it are removed when what they hold is no longer referred to, if spark.cleaner.referenceTracking.cleanCheckpoints is set, as build_session does.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = "file://" + os.path.join(own, "checkpoints")
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder, its lineage cut; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder. Those whose schema is declared are read by it, without a job that looks into files for it."""
    reader = spark.read.schema(INPUTS[name]) if name in INPUTS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")
