"""Sessions that go on from one run to the next.

A run leaves one row per user: the last instant, the number of the last session and,
while that session may still go on, its statistics so far. The next run numbers its own
events as if there were no others, then shifts each user's numbers by the carried one and
joins its first session with the carried session where the gap allows. So a run reads its
own events and a row per user, and no event or session that an earlier run has closed.

    user_id, session_id      the user's last session
    last_time                the user's last instant
    open                     whether the session may still go on; if not, no more is kept:
    start_time, end_time, page_views, the counters, hits
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagetrail.functions.columns import epoch_seconds, opens_session, seconds_between, session_key
from pagetrail.operators.busy_users import MAX_USER_ROWS
from pagetrail.operators.sessions import EVENT_ID, sessionise, with_event_timestamp
from pagetrail.operators.sparse import HITS, merged_part, session_parts
from pagetrail.schema import GAP_SECONDS, VALUE_COUNTERS

USER = "user_id"


def no_carry(
    spark: SparkSession, counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS
) -> DataFrame:
    """What the first run carries over: nothing."""
    counts = ", ".join(f"`{c}` bigint" for c in ("page_views", *counters))
    return spark.createDataFrame(
        [],
        f"{USER} string, session_id bigint, last_time timestamp, open boolean,"
        f" start_time timestamp, end_time timestamp, {counts}, hits {HITS}",
    )


def late_events(timed: DataFrame, carry: DataFrame) -> DataFrame:
    """Events before the last instant of their user in an earlier run, unchanged."""
    last = carry.select(F.col(USER).alias("_user"), F.col("last_time").alias("_last"))
    joined = timed.join(last, timed[USER] == F.col("_user"))
    return joined.filter(F.col("event_timestamp") < F.col("_last")).select(*timed.columns)


def continued(
    events: DataFrame,
    carry: DataFrame,
    gap_seconds: int = GAP_SECONDS,
    tie: str | None = EVENT_ID,
    tie_is_unique: bool = False,
    max_user_rows: int | None = MAX_USER_ROWS,
) -> DataFrame:
    """``sessionise`` for the events of one run, as if all earlier runs were there.

    Adds ``session_start``, the time of the session's first event in any run. No event may be
    before its user's carried instant (``late_events``). Users are compared by equality, so
    events without a user, which ingest rejects, start anew in each run.

    The carried rows are joined by user, by whom the windows have partitioned the events
    already. The join asks for no grouping afterwards, so adaptive execution may split a
    busy user's events.
    """
    own = sessionise(
        events, gap_seconds, tie=tie, tie_is_unique=tie_is_unique, max_user_rows=max_user_rows
    )
    columns = own.columns
    in_session = Window.partitionBy(USER, "session_id")
    own = own.withColumn("_start", F.min("event_timestamp").over(in_session))
    firsts = with_event_timestamp(events).groupBy(F.col(USER).alias("_user"))
    firsts = firsts.agg(F.min("event_timestamp").alias("_first"))
    last = carry.select(
        F.col(USER).alias("_of"), "session_id", F.col("last_time").alias("_last"),
        F.col("start_time").alias("_begun"),
    )
    goes_on = seconds_between(F.col("_first"), F.col("_last")) <= gap_seconds
    shifts = firsts.join(last, F.col("_user") == F.col("_of")).select(
        "_user",
        "_last",
        F.when(goes_on, F.col("_begun")).alias("_begun"),
        (F.col("session_id") - F.when(goes_on, 1).otherwise(0)).alias("_shift"),
    )
    is_first = F.col("prev_time").isNull()
    previous = F.coalesce("prev_time", F.col("_last"))
    gap = seconds_between(F.col("event_timestamp"), previous)
    number = F.col("session_id") + F.coalesce("_shift", F.lit(0))
    start = F.when(F.col("session_id") == 1, F.coalesce("_begun", "_start"))
    shifted = {
        "prev_time": previous,
        "time_diff_seconds": gap,
        "is_new_session": F.when(is_first, opens_session(gap, gap_seconds)).otherwise(
            F.col("is_new_session")
        ),
        "session_id": number,
        "unique_session_id": session_key(F.col(USER), number),
        "session_start": start.otherwise(F.col("_start")),
    }
    joined = own.join(shifts, own[USER] == F.col("_user"), "left")
    return joined.withColumns(shifted).select(*columns, "session_start")


def sessions_with_carry(
    sessionised: DataFrame,
    carry: DataFrame,
    horizon: Column,
    gap_seconds: int = GAP_SECONDS,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
) -> DataFrame:
    """The sessions that this run's events touch and those left open before it.

    A row of ``session_parts`` each, with ``is_last`` of its user and ``closed``: whether
    no event at ``horizon`` or later, before which all events are known, can still join it.
    """
    today, before = session_parts(sessionised, counters), carry.filter("open")
    same = (F.col("p.user_id") == F.col("c.user_id")) & (
        F.col("p.session_id") == F.col("c.session_id")
    )
    merged = (
        today.alias("p")
        .join(before.alias("c"), same, "full")
        .select(
            *[F.coalesce(f"p.{c}", f"c.{c}").alias(c) for c in (USER, "session_id")],
            *merged_part("p", "c", counters),
        )
    )
    numbers = F.max("session_id").over(Window.partitionBy(USER))
    over = epoch_seconds(horizon) - epoch_seconds(F.col("end_time")) > gap_seconds
    return merged.withColumn("is_last", F.col("session_id") == numbers).withColumn(
        "closed", ~F.col("is_last") | over
    )


def carried_on(
    sessions: DataFrame,
    carry: DataFrame,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
) -> DataFrame:
    """What this run carries over, from ``sessions_with_carry`` (written, as it is read twice)
    and what was carried before. Closed sessions leave their number and last instant only."""
    last = sessions.filter("is_last")
    kept = ["start_time", "end_time", "page_views", *counters, "hits"]
    now = last.select(
        USER,
        "session_id",
        F.col("end_time").alias("last_time"),
        (~F.col("closed")).alias("open"),
        *[F.when(~F.col("closed"), F.col(c)).alias(c) for c in kept],
    )
    quiet = carry.filter("not open").join(last.select(USER), USER, "left_anti")
    return now.unionByName(quiet.select(*now.columns))
