"""Sessions from a folder to which log files are added.

Each batch of files is reduced to a row per user and second, which is written once,
under the number of the batch. Sessions are built from all rows written so far, so no
event is too late, open sessions are there too, and a batch that is run again after a
failure replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagetrail.functions.columns import quoted, seconds_between
from pagetrail.operators.gold import check_stages, second_rows, sessions_from_seconds
from pagetrail.operators.sessions import with_event_timestamp
from pagetrail.schema import CORRUPT_COLUMN, FUNNEL_STAGES, GAP_SECONDS, VALUE_COUNTERS
from pagetrail.sources.raw import READ_SCHEMA
from pagetrail.sources.scratch import scratch_path

COUNTED = "counted_stages"


def read_raw_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """``read_raw_json`` for files that keep arriving in folder ``path``."""
    reader = (
        spark.readStream.schema(READ_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def append_seconds(
    events: DataFrame,
    path: str,
    stages: Sequence[str] = FUNNEL_STAGES,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
    checkpoint: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Append a stream of valid events, per user and second, to the folder ``path``.

    Progress is kept in ``checkpoint``; give the same folder to go on after a stop.
    With ``once`` the query ends when it has read what is there now. Events whose time
    does not parse are left out, as in ``gold_from_events``. Each row tells the stages it has
    hits of, so batches may be appended with others.
    """
    columns = {stage: stage for stage in check_stages(stages, counters)}

    def write(batch: DataFrame, number: int) -> None:
        timed = with_event_timestamp(batch).filter(F.col("event_timestamp").isNotNull())
        rows = second_rows(timed, columns, counters)
        rows = rows.withColumn(COUNTED, F.array(*[F.lit(s) for s in columns]).cast("array<string>"))
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = events.writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint or scratch_path(events.sparkSession, "stream"))
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def sessions_so_far(
    spark: SparkSession,
    path: str,
    stages: Sequence[str] = FUNNEL_STAGES,
    gap_seconds: int = GAP_SECONDS,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
) -> DataFrame:
    """Gold's fields of every session of the events appended up to now.

    Refused if some of them were appended without one of the ``stages``, as their hits are
    not known.
    """
    columns = {stage: stage for stage in check_stages(stages, counters)}
    seconds = spark.read.option("mergeSchema", "true").parquet(path).drop("batch")
    wanted = F.array(*[F.lit(s) for s in columns]).cast("array<string>")
    without = seconds.select(F.array_except(wanted, COUNTED).alias("missing"))
    unknown = without.filter(F.size("missing") > 0).first()
    if unknown:
        raise ValueError(f"events were appended without the stages {unknown.missing}")
    seconds = seconds.drop(COUNTED)
    return sessions_from_seconds(seconds, columns, gap_seconds, counters).select(
        "user_id",
        "start_time",
        "end_time",
        "page_views",
        *counters,
        seconds_between(F.col("end_time"), F.col("start_time")).alias("duration_seconds"),
        *[quoted(s) for s in stages],
    )
