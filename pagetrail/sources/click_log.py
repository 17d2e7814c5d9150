"""The test table as a raw log: JSON lines with the faults a real log has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.schema import RAW_COLUMNS
from pagetrail.sources.events_table import click_columns
from pagetrail.sources.scratch import scratch_path

# Length a broken line is cut to; no line is that short, so each one is malformed.
BROKEN_LENGTH = 40


def click_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per event: events of type error lack ``user_id``, and lines of
    events with a value below 1 are broken off."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = table.select(F.col("value"), *click_columns())
    known = F.when(F.col("current_page") != "payment_failed", F.col("user_id"))
    whole = F.to_json(F.struct(*RAW_COLUMNS))
    anonymous = F.to_json(F.struct(known.alias("user_id"), *RAW_COLUMNS[1:]))
    broken = F.substring(whole, 1, BROKEN_LENGTH)
    return rows.select(F.when(F.col("value") < 1, broken).otherwise(anonymous).alias("line"))


def write_click_log(spark: SparkSession, sf_dir: str) -> str:
    """Write the lines to a new scratch folder and return its path."""
    path = scratch_path(spark, "click-log")
    click_log_lines(spark, sf_dir).write.text(path)
    return path
