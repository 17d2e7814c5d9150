"""Group each user's events into sessions separated by an inactivity timeout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.functions.columns import (
    epoch_seconds,
    event_time,
    opens_session,
    quoted,
    seconds_between,
    session_key,
)
from pagetrail.operators.busy_users import MAX_USER_ROWS, busy_users, split_users
from pagetrail.schema import GAP_SECONDS, METRIC_COLUMNS
from pagetrail.sources.scratch import scratch_table

EVENT_ID = "event_id"
# Width of the time slices a busy user's instants are spread over.
SLICE_SECONDS = 900
# Slice of the instants without a time; sorts before every real slice.
NO_TIME_SLICE = -(2**63)


def with_event_timestamp(events: DataFrame, time: str = "event_time") -> DataFrame:
    """Add ``event_timestamp``, null where the time does not parse."""
    return events.withColumn("event_timestamp", event_time(events, time))


def unparsed_times(events: DataFrame, time: str = "event_time") -> DataFrame:
    """The events whose time is missing or does not parse, unchanged."""
    return events.filter(event_time(events, time).isNull())


def sessionise(
    events: DataFrame,
    gap_seconds: int = GAP_SECONDS,
    *,
    user: str = "user_id",
    time: str = "event_time",
    tie: str | None = EVENT_ID,
    tie_is_unique: bool = False,
    keep_null_times: bool = False,
    max_user_rows: int | None = MAX_USER_ROWS,
) -> DataFrame:
    """Every event with its gap to the user's previous event and its session.

    ``tie`` orders a user's events of the same instant, by default by ``event_id``
    where there is one; None leaves their order open. Events without a usable time are
    left out (``unparsed_times`` returns them) unless ``keep_null_times`` is set; then
    they sort first, each opens a session, and all of them carry the last of those
    numbers.

    Users with more than ``max_user_rows`` events take a plan that spreads one user
    over many tasks. Finding them runs a job that counts the user column, so give it a
    written table rather than raw text; None turns both off. With ``tie_is_unique`` no
    two events of one user and instant share a ``tie`` value, and even the events of a
    single instant need not meet in one task.
    """
    if gap_seconds < 0:
        raise ValueError("gap_seconds must not be negative")
    if tie == EVENT_ID and EVENT_ID not in events.columns:
        tie = None
    busy = busy_users(events, user, max_user_rows) if max_user_rows is not None else None
    quiet, crowded = (events, None) if busy is None else split_users(events, user, busy)
    numbered = _number_in_order(
        with_event_timestamp(quiet, time), gap_seconds, user, tie, keep_null_times
    )
    if crowded is not None:
        by_instant = _number_by_instant(
            with_event_timestamp(crowded, time),
            gap_seconds,
            user,
            tie,
            tie_is_unique,
            keep_null_times,
        )
        numbered = numbered.unionByName(by_instant)
    key = session_key(quoted(user), F.col("session_id"))
    return numbered.withColumn("unique_session_id", key)


def session_metrics(sessionised: DataFrame) -> DataFrame:
    """The session columns of each event, for inspection."""
    return sessionised.select(*METRIC_COLUMNS)


def _gap_columns(gap_seconds: int) -> dict[str, Column]:
    diff = seconds_between(F.col("event_timestamp"), F.col("prev_time"))
    return {"time_diff_seconds": diff, "is_new_session": opens_session(diff, gap_seconds)}


def _number_in_order(
    timed: DataFrame, gap_seconds: int, user: str, tie: str | None, keep_null_times: bool
) -> DataFrame:
    """One exchange and one sort by user; both windows run on it."""
    by_user = Window.partitionBy(user)
    rows = by_user.orderBy("event_timestamp", *([quoted(tie)] if tie else []))
    flagged = timed.withColumn("prev_time", F.lag("event_timestamp").over(rows)).withColumns(
        _gap_columns(gap_seconds)
    )
    if keep_null_times:
        # Events without a time are peers: each opens a session, all get the last number.
        peers = by_user.orderBy("event_timestamp")
        return flagged.withColumn("session_id", F.sum("is_new_session").over(peers))
    # With a time, only the first event of an instant can open a session, so counting
    # row by row gives peers one number too. Events without a time count nothing and
    # leave after the windows; filtered before, Spark would parse each time twice.
    has_time = F.col("event_timestamp").isNotNull()
    opened = F.when(has_time, F.col("is_new_session")).otherwise(0)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.withColumn("session_id", F.sum(opened).over(so_far)).filter(has_time)


def _tie_order(*ties: str) -> Column:
    """Sorts like the tie columns in a window, nulls first, and is never null itself."""
    parts = []
    for n, tie in enumerate(ties):
        parts += [quoted(tie).isNotNull().alias(f"known_{n}"), quoted(tie).alias(f"tie_{n}")]
    return F.struct(*parts)


def _number_by_instant(
    timed: DataFrame,
    gap_seconds: int,
    user: str,
    tie: str | None,
    tie_is_unique: bool,
    keep_null_times: bool,
) -> DataFrame:
    """The same columns without ever sorting all of one user's events in one task.

    Only the first event of an instant can open a session, so sessions are found
    on the distinct instants and joined back to the events by (user, instant). The first
    event of an instant is the least of its events, found by partial minima, and is known
    again after the join by its tie or, where ties are not unique, by its row number.
    """
    columns, ties = timed.columns, [tie] if tie else []
    if not keep_null_times:
        timed = timed.filter(F.col("event_timestamp").isNotNull())
    if not (tie and tie_is_unique):
        # Written, as the numbers must be the same wherever the rows are read again.
        numbered = timed.withColumn("at_row", F.monotonically_increasing_id())
        timed, ties = scratch_table(numbered, "busy-events"), [*ties, "at_row"]
    order = _tie_order(*ties)
    instants = _numbered_instants(timed, gap_seconds, user, order, keep_null_times)
    joined = timed.join(
        instants,
        quoted(user).eqNullSafe(F.col("at_user"))
        & F.col("event_timestamp").eqNullSafe(F.col("at_instant")),
    )
    is_first = order.eqNullSafe(F.col("at_first"))
    previous = F.when(is_first, F.col("at_previous")).otherwise(F.col("event_timestamp"))
    return (
        joined.filter("at_session > 0")  # 0 for events without a time unless they are kept
        .withColumn("prev_time", previous)
        .withColumns(_gap_columns(gap_seconds))
        .select(
            *[quoted(c) for c in columns],
            "prev_time",
            "time_diff_seconds",
            "is_new_session",
            F.col("at_session").alias("session_id"),
        )
    )


def _numbered_instants(
    timed: DataFrame, gap_seconds: int, user: str, order: Column, keep_null_times: bool
) -> DataFrame:
    """Previous instant and session number of each distinct (user, instant).

    Copies of an instant collapse before the shuffle. Instants are windowed per
    (user, slice); one row per slice carries the last instant and the number of
    sessions over to the user's later slices.
    """
    seconds = epoch_seconds(F.col("at_instant"))
    slice_no = F.coalesce(
        F.floor(seconds / F.lit(SLICE_SECONDS)).cast("long"), F.lit(NO_TIME_SLICE)
    )
    instants = (
        timed.groupBy(
            quoted(user).alias("at_user"), F.col("event_timestamp").alias("at_instant")
        )
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(order).alias("at_first"),
        )
        .withColumn("slice", slice_no)
    )
    # Instants are distinct, so ``at_first`` orders nothing; with it both uses of
    # ``marked`` need the same columns and Spark runs their common shuffle once.
    in_slice = Window.partitionBy("at_user", "slice").orderBy("at_instant", "at_first")
    before = F.lag("at_instant").over(in_slice)
    # Events without a time open one session each, or none if they are left out; the
    # first instant of a slice is judged below, once the slice before it is known.
    opened = (
        F.when(F.col("at_instant").isNull(), F.col("copies") if keep_null_times else F.lit(0))
        .when(F.col("at_previous").isNull(), F.lit(0))
        .otherwise(
            opens_session(
                seconds_between(F.col("at_instant"), F.col("at_previous")), gap_seconds
            )
        )
        .cast("long")
    )
    marked = instants.withColumn("at_previous", before).withColumn("opened", opened)

    by_user = Window.partitionBy("at_user").orderBy("slice")
    slices = (
        marked.groupBy("at_user", "slice")
        .agg(
            F.min("at_instant").alias("first_instant"),
            F.max("at_instant").alias("last_instant"),
            F.sum("opened").alias("opened_inside"),
        )
        .withColumn("instant_before", F.lag("last_instant").over(by_user))
        .withColumn(
            "opened_first",
            F.when(F.col("first_instant").isNull(), F.lit(0)).otherwise(
                opens_session(
                    seconds_between(F.col("first_instant"), F.col("instant_before")), gap_seconds
                )
            ),
        )
        .select(
            F.col("at_user").alias("slice_user"),
            F.col("slice").alias("slice_no"),
            "instant_before",
            (
                F.sum(F.col("opened_inside") + F.col("opened_first")).over(by_user)
                - F.col("opened_inside")
            ).alias("sessions_before"),
        )
    )
    return (
        marked.withColumn("opened", F.sum("opened").over(in_slice))
        .join(
            slices,
            F.col("at_user").eqNullSafe(F.col("slice_user"))
            & (F.col("slice") == F.col("slice_no")),
        )
        .select(
            "at_user",
            "at_instant",
            "at_first",
            F.coalesce("at_previous", "instant_before").alias("at_previous"),
            (F.col("sessions_before") + F.col("opened")).alias("at_session"),
        )
    )
