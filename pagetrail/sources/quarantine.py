"""Rejected events: why each was rejected, and putting corrected ones back.

    <root>/quarantine/log=<log>/      rejected rows of a delivery
    <root>/corrections/log=<log>/     corrected ones, which readers of Bronze add to it

Every rejected row keeps its text, all reasons that apply, and the key it was given when
it was read. A corrected row is kept under that key, so replaying it once more changes
nothing, and a second correction replaces the first, on whatever day it puts the event.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions.columns import event_time, quoted
from pagetrail.schema import CORRUPT_COLUMN, RAW_COLUMNS, REQUIRED_COLUMNS
from pagetrail.sources.layers import write_layer
from pagetrail.sources.scratch import scratch_table

RAW = ", ".join(f"{c} string" for c in RAW_COLUMNS)
CORRECTED = f"{RAW}, event_key string, day date"
MALFORMED = "malformed"
BAD_TIME = "unparsable event_time"


def missing(column: str) -> str:
    return f"missing {column}"


def reasons(raw: DataFrame) -> Column:
    """All reasons to reject a row, in a fixed order; empty for a valid one.

    A line that does not parse is malformed, and of its fields nothing more is said.
    Otherwise each required field that is null is missing, and a time is unparsable if it
    is given and is none.
    """
    broken = F.col(CORRUPT_COLUMN).isNotNull()
    time = event_time(raw, "event_time")
    each = [F.when(quoted(c).isNull(), F.lit(missing(c))) for c in REQUIRED_COLUMNS]
    each.append(F.when(F.col("event_time").isNotNull() & time.isNull(), F.lit(BAD_TIME)))
    return F.when(broken, F.array(F.lit(MALFORMED))).otherwise(F.array_compact(F.array(*each)))


def with_reasons(raw: DataFrame) -> DataFrame:
    """The rows with ``reasons``, in the projection that reads them."""
    return raw.withColumn("reasons", reasons(raw))


def reason_counts(rejected: DataFrame) -> DataFrame:
    """``reason`` and ``events``; an event counts under each of its reasons."""
    each = rejected.select(F.explode("reasons").alias("reason"))
    return each.groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


def _folder(root: str, name: str, log: str | None) -> str:
    folder = f"{root.rstrip('/')}/{name}"
    if log is None:
        return folder
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", log):
        raise ValueError(f"{log!r} cannot be the name of a delivery")
    return f"{folder}/log={log}"


def write_quarantine(rejected: DataFrame, root: str, log: str) -> None:
    """Replace what delivery ``log`` has rejected, and drop the corrections of its rows."""
    write_layer(rejected, _folder(root, "quarantine", log))
    none = rejected.sparkSession.createDataFrame([], CORRECTED)
    write_layer(none, _folder(root, "corrections", log))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The rejected rows of all deliveries, with their ``log``."""
    schema = f"{RAW}, {CORRUPT_COLUMN} string, event_key string, reasons array<string>, log string"
    return spark.read.schema(schema).parquet(_folder(root, "quarantine", None))


def read_corrections(spark: SparkSession, root: str) -> DataFrame:
    """The corrected rows of all deliveries, as they stand in Bronze."""
    rows = spark.read.schema(f"{CORRECTED}, log string")
    return rows.parquet(_folder(root, "corrections", None))


def still_rejected(spark: SparkSession, root: str) -> DataFrame:
    """The rejected rows that no correction has been given for."""
    done = read_corrections(spark, root).select("event_key")
    return read_quarantine(spark, root).join(done, "event_key", "left_anti")


def replay(corrected: DataFrame, root: str) -> DataFrame:
    """Take corrected events in; returns those that would be rejected again, with ``reasons``.

    ``corrected`` has the raw columns and the ``event_key`` of the row each corrects; of rows
    with one key the last in the order of their columns counts. Only keys that are in the
    quarantine are taken. Merged by key: run again with the same rows it changes nothing, and
    Bronze itself is never rewritten. Of the deliveries concerned the corrections are read
    and replaced, of no others.
    """
    spark = corrected.sparkSession
    raw = corrected.select(*RAW_COLUMNS, "event_key").withColumn(
        CORRUPT_COLUMN, F.lit(None).cast("string")
    )
    known = read_quarantine(spark, root).select("event_key", "log")
    row = F.max(F.struct(*RAW_COLUMNS, "day", "reasons")).alias("row")
    judged = with_reasons(raw).withColumn("day", F.to_date(event_time(raw, "event_time")))
    judged = judged.join(known, "event_key").groupBy("event_key", "log").agg(row)
    judged = scratch_table(judged.select("event_key", "log", "row.*"), "corrected")
    good = judged.filter(F.size("reasons") == 0).drop("reasons")
    old = read_corrections(spark, root)
    logs = good.select("log").distinct()
    kept = old.join(logs, "log", "left_semi").join(good.select("event_key"), "event_key", "left_anti")
    merged = scratch_table(kept.select(*good.columns).union(good), "corrections")
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("log").parquet(_folder(root, "corrections", None))
    return judged.filter(F.size("reasons") > 0).drop("day")
