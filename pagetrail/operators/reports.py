"""Funnel and conversion reports: a few rows each, computed from whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.columns import percent, quoted
from pagetrail.schema import REPORT_STAGES, TARGET_STAGE

HOUR = "hour"


def total_sessions(gold: DataFrame) -> DataFrame:
    """Number of sessions, as one row."""
    return gold.agg(F.count(F.lit(1)).alias("total_sessions"))


def present_stages(gold: DataFrame, stages: Sequence[str]) -> list[str]:
    """The stages Gold has a column for, in the given order."""
    have = {c.lower() for c in gold.columns}
    return [s for s in stages if s.lower() in have]


def funnel_report(
    gold: DataFrame, stages: Sequence[str] = REPORT_STAGES, missing: str = "zero"
) -> DataFrame:
    """Sessions that reached each stage, and their share of all sessions in percent.

    One pass for all stages. A stage Gold has no column for counts 0 with
    ``missing="zero"`` and is left out with ``"skip"``.
    """
    if missing not in ("zero", "skip"):
        raise ValueError("missing must be 'zero' or 'skip'")
    present = present_stages(gold, stages)
    shown = present if missing == "skip" else list(stages)
    row = "stage_no int, stage string, sessions bigint, pct double"
    if not shown:
        return gold.sparkSession.createDataFrame([], row)
    counts = gold.agg(
        F.count(F.lit(1)).alias("total"),
        F.array(*[_stage_row(no, s, s in present) for no, s in enumerate(shown, 1)]).alias("rows"),
    )
    share = percent(F.col("sessions"), F.col("total")).alias("pct")
    return (
        counts.select("total", F.inline("rows"))
        .select("stage_no", "stage", "sessions", share)
        .orderBy("stage_no")
    )


def _stage_row(no: int, stage: str, present: bool) -> Column:
    reached = F.count_if(quoted(stage) > 0) if present else F.lit(0).cast("bigint")
    return F.struct(
        F.lit(no).alias("stage_no"), F.lit(stage).alias("stage"), reached.alias("sessions")
    )


def funnel_lines(report: DataFrame) -> DataFrame:
    """The report as text, ``home: 1774 (31.0%)``; rounded for display only."""
    pct = F.coalesce("pct", F.lit(0.0))
    line = F.format_string("%s: %d (%.1f%%)", "stage", "sessions", pct)
    return report.select("stage_no", line.alias("line"))


def conversion_by(sessionised: DataFrame, dim: str, target: str = TARGET_STAGE) -> DataFrame:
    """Sessions, sessions that reached ``target`` and their percentage, per value of ``dim``.

    ``dim`` belongs to the event, so a session counts once under each value seen in
    it, and counts as converted under all of them.
    """
    return dimension(conversions(sessionised, [dim], target), dim)


def conversions(
    sessionised: DataFrame, dims: Sequence[str], target: str = TARGET_STAGE
) -> DataFrame:
    """``conversion_by`` for several dimensions (text) in one pass: dim, value, sessions,
    converted and rate. One row per session is shuffled, with the values seen in it."""
    seen = [
        F.collect_set(F.struct(F.lit(d).alias("dim"), quoted(d).cast("string").alias("value")))
        for d in dims
    ]
    seen = [values.alias(f"seen_{i}") for i, values in enumerate(seen)]
    session = sessionised.groupBy("user_id", "session_id").agg(
        (F.count_if(F.col("current_page") == F.lit(target)) > 0).alias("reached"), *seen
    )
    values = F.concat(*[F.col(f"seen_{i}") for i in range(len(dims))])
    return _rates(session.select("reached", F.inline(values)), "dim", "value")


def conversion_sets(
    sessionised: DataFrame, sets: Sequence[Sequence[str]], target: str = TARGET_STAGE
) -> DataFrame:
    """Conversion per value of each set of dimensions, in one pass: a row per set and values.

    Columns: ``dims`` (the set, comma-joined), each dimension as text (null where the set is
    without it), ``sessions``, ``converted``, ``rate``. Dimensions are columns of events or
    ``hour``, of day in the session time zone, in which the session starts. A session
    counts once under each combination of values that one of its events has.

    Events are combined by session on the partitioning that the windows leave; what is
    shuffled are counts per set and values.
    """
    dims = list(dict.fromkeys(d for one in sets for d in one))
    of_events = [d for d in dims if d != HOUR]
    seen = F.collect_set(F.struct(F.lit(1), *[quoted(d).cast("string").alias(d) for d in of_events]))
    session = sessionised.groupBy("user_id", "session_id").agg(
        (F.count_if(F.col("current_page") == F.lit(target)) > 0).alias("reached"),
        F.hour(F.min("event_timestamp")).cast("string").alias(HOUR),
        seen.alias("seen"),
    )

    def values(one: Sequence[str]) -> Column:
        def of(x: Column) -> Column:
            parts = [
                (F.lit(None).cast("string") if d not in one else F.col(d) if d == HOUR else x[d])
                for d in dims
            ]
            named = [part.alias(d) for part, d in zip(parts, dims, strict=True)]
            return F.struct(F.lit(",".join(one)).alias("dims"), *named)

        return F.array_distinct(F.transform("seen", of))

    rows = session.select("reached", F.inline(F.concat(*[values(one) for one in sets])))
    return _rates(rows, "dims", *dims)


def dimension(rates: DataFrame, dim: str) -> DataFrame:
    """The rows of one dimension, with its name for the values."""
    return rates.filter(F.col("dim") == dim).drop("dim").withColumnRenamed("value", dim)


def conversion_by_hour(gold: DataFrame, target: str = TARGET_STAGE) -> DataFrame:
    """The same per hour of day (session time zone) in which the session starts."""
    reached = gold.select(
        F.hour("start_time").alias("hour"), (quoted(target) > 0).alias("reached")
    )
    return _rates(reached, "hour")


def _rates(reached: DataFrame, *by: str) -> DataFrame:
    return (
        reached.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("sessions"), F.count_if("reached").alias("converted"))
        .withColumn("rate", percent(F.col("converted"), F.col("sessions")))
    )
