"""One row per session: times, counters and hits per stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.functions.columns import (
    epoch_seconds,
    opens_session,
    quoted,
    seconds_between,
    session_key,
)
from pagetrail.operators.sessions import with_event_timestamp
from pagetrail.schema import EXTRA_STAGES, GAP_SECONDS, VALUE_COUNTERS

SESSION = ["user_id", "session_id"]
# Above this many stages, one counter per stage and row costs more than a pivot.
MAX_COUNTED_STAGES = 64
# Prefix of the column of a discovered page whose name is taken.
PAGE_PREFIX = "page_"
# Least width of the time slices a user's sessions are first found in.
SLICE_SECONDS = 900


def distinct_pages(events: DataFrame, page: str = "current_page") -> DataFrame:
    """``page``: every value once."""
    return events.select(quoted(page).alias("page")).dropna().distinct()


def discover_stages(events: DataFrame, page: str = "current_page") -> list[str]:
    """The distinct pages in sorted order. Runs a job; each will be a column."""
    return sorted(r.page for r in distinct_pages(events, page).toLocalIterator())


def stage_columns(
    pages: Sequence[str], counters: Mapping[str, tuple[str, str]]
) -> dict[str, str]:
    """A column name for each discovered page: its own, prefixed while that is taken.

    Names that differ in case only are one name to Spark, so the later one is prefixed.
    """
    used, names = _taken(counters), {}
    wanted = used | {p.lower() for p in pages}
    for page in pages:
        name = page
        if name.lower() in used:
            while name.lower() in wanted:
                name = PAGE_PREFIX + name
            wanted.add(name.lower())
        used.add(name.lower())
        names[page] = name
    return names


def _taken(counters: Mapping[str, tuple[str, str]]) -> set[str]:
    names = {"unique_session_id", "end_time", "start_time", "page_views", "duration_seconds"}
    names |= {"user_id", "session_id", "hits_user", "hits_session"}
    return names | {name.lower() for name in counters}


def check_stages(stages: Sequence[str], counters: Mapping[str, tuple[str, str]]) -> list[str]:
    """The stages as a list; raises if one would share a name with another Gold column."""
    taken = _taken(counters)
    for stage in stages:
        if stage.lower() in taken:
            raise ValueError(f"stage {stage!r} has the name of another Gold column")
        taken.add(stage.lower())
    return list(stages)


def _resolve(
    events: DataFrame,
    stages: Sequence[str] | None,
    extras: Sequence[str],
    counters: Mapping[str, tuple[str, str]],
) -> dict[str, str]:
    """Pages and their columns: given or discovered ones, then the extras not among them."""
    if stages is None:
        found = stage_columns(discover_stages(events), counters)
    else:
        found = {stage: stage for stage in check_stages(stages, counters)}
    for extra in extras:
        if extra.lower() not in {name.lower() for name in found.values()}:
            found[extra] = extra
    check_stages(list(found.values()), counters)
    return found


def _stat_columns(counters: Mapping[str, tuple[str, str]]) -> list[Column]:
    return [
        F.max("event_timestamp").alias("end_time"),
        F.min("event_timestamp").alias("start_time"),
        F.count("current_page").alias("page_views"),
        *[
            F.count_if(quoted(column) == F.lit(value)).alias(name)
            for name, (column, value) in counters.items()
        ],
    ]


def _stage_columns(stages: Mapping[str, str]) -> list[Column]:
    return [F.count_if(F.col("current_page") == F.lit(p)).alias(c) for p, c in stages.items()]


def _session_rows(
    grouped: DataFrame, counters: Mapping[str, tuple[str, str]], stages: Mapping[str, str]
) -> DataFrame:
    """The text key, made only now, and the final column order."""
    return grouped.select(
        _key().alias("unique_session_id"),
        "end_time",
        "start_time",
        "page_views",
        *counters,
        seconds_between(F.col("end_time"), F.col("start_time")).alias("duration_seconds"),
        *[quoted(s) for s in stages.values()],
    )


def _key() -> Column:
    return session_key(F.col("user_id"), F.col("session_id"))


def session_stats(
    sessionised: DataFrame, counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS
) -> DataFrame:
    """Start, end, duration, page views and value counters of each session."""
    grouped = sessionised.groupBy(*SESSION).agg(*_stat_columns(counters))
    return _session_rows(grouped, counters, {})


def funnel_matrix(
    sessionised: DataFrame,
    stages: Sequence[str] | None = None,
    extras: Sequence[str] = EXTRA_STAGES,
) -> DataFrame:
    """Hits of each session on each stage; 0 where it has none.

    Without ``stages``, one column per distinct page. ``extras`` are columns even
    when no event has them.
    """
    stages = _resolve(sessionised, stages, extras, {})
    if len(stages) > MAX_COUNTED_STAGES or not stages:
        hits = _pivot(sessionised, stages)
    else:
        hits = sessionised.groupBy(*SESSION).agg(*_stage_columns(stages))
    return hits.select(_key().alias("unique_session_id"), *[quoted(s) for s in stages.values()])


def _pivot(sessionised: DataFrame, stages: Mapping[str, str]) -> DataFrame:
    """As counters, but grouped by (session, page) first. Values are given, so no job runs."""
    if not stages:
        return sessionised.select(*SESSION).distinct()
    # Pivot columns are numbered: pages that differ in case only would share a name.
    pages = F.create_map(*[F.lit(x) for n, p in enumerate(stages) for x in (p, n)])
    number = F.try_element_at(pages, F.col("current_page"))
    numbered = sessionised.select(*SESSION, number.alias("stage_no"))
    hits = numbered.groupBy(*SESSION).pivot("stage_no", list(range(len(stages)))).count()
    zero = F.lit(0).cast("bigint")
    return hits.select(
        *SESSION,
        *[F.coalesce(quoted(str(n)), zero).alias(c) for n, c in enumerate(stages.values())],
    )


def gold(
    sessionised: DataFrame,
    stages: Sequence[str] | None = None,
    extras: Sequence[str] = EXTRA_STAGES,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
) -> DataFrame:
    """``session_stats`` and ``funnel_matrix`` in one aggregation.

    Grouped by (user, session number), not by the text key, so it runs on the
    partitioning the session windows leave behind.
    """
    stages = _resolve(sessionised, stages, extras, counters)
    if len(stages) > MAX_COUNTED_STAGES:
        return _gold_by_pivot(sessionised, stages, counters)
    grouped = sessionised.groupBy(*SESSION).agg(
        *_stat_columns(counters), *_stage_columns(stages)
    )
    return _session_rows(grouped, counters, stages)


def gold_pivot_join(
    sessionised: DataFrame,
    stages: Sequence[str] | None = None,
    extras: Sequence[str] = EXTRA_STAGES,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
) -> DataFrame:
    """The same table as an inner join of the statistics with the pivoted pages."""
    stages = _resolve(sessionised, stages, extras, counters)
    return _gold_by_pivot(sessionised, stages, counters)


def _gold_by_pivot(
    sessionised: DataFrame, stages: Mapping[str, str], counters: Mapping[str, tuple[str, str]]
) -> DataFrame:
    stats = sessionised.groupBy(*SESSION).agg(*_stat_columns(counters))
    hits = _pivot(sessionised, stages).withColumnsRenamed(
        {"user_id": "hits_user", "session_id": "hits_session"}
    )
    same = F.col("user_id").eqNullSafe(F.col("hits_user")) & (
        F.col("session_id") == F.col("hits_session")
    )
    return _session_rows(stats.join(hits, same), counters, stages)


def gold_from_events(
    events: DataFrame,
    stages: Sequence[str] | None = None,
    gap_seconds: int = GAP_SECONDS,
    extras: Sequence[str] = EXTRA_STAGES,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
    time: str = "event_time",
) -> DataFrame:
    """Gold straight from raw events, when the per-event session columns are not wanted.

    Events are combined by (user, second) before the first shuffle; sessions are found
    within (user, time slice) and only their parts, at most one per slice and timeout
    in it, meet in one task per user. So no user needs a plan of its own. Events
    without a usable time are left out.
    """
    if gap_seconds < 1:
        raise ValueError("the timeout must be at least one second")
    stages = _resolve(events, stages, extras, counters)
    timed = with_event_timestamp(events, time).filter(F.col("event_timestamp").isNotNull())
    per_second = second_rows(timed, stages, counters)
    sessions = sessions_from_seconds(per_second, stages, gap_seconds, counters)
    return _session_rows(sessions, counters, stages)


def second_rows(
    timed: DataFrame, stages: Mapping[str, str], counters: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Statistics per ``user_id`` and whole ``second``, in which gaps are measured."""
    second = epoch_seconds(F.col("event_timestamp")).alias("second")
    return timed.groupBy("user_id", second).agg(*_stat_columns(counters), *_stage_columns(stages))


def sessions_from_seconds(
    seconds: DataFrame,
    stages: Mapping[str, str],
    gap_seconds: int,
    counters: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Numbered sessions of rows per (user, second), of which several may be of one second."""
    merged = _merged(counters, stages)
    width = max(gap_seconds, SLICE_SECONDS)
    sliced = seconds.withColumn("slice", F.floor(F.col("second") / F.lit(width)).cast("long"))
    sliced = sliced.groupBy("user_id", "slice", "second").agg(*merged)
    in_slice = Window.partitionBy("user_id", "slice").orderBy("second")
    gap = F.col("second") - F.lag("second").over(in_slice)
    opened = F.when(gap > gap_seconds, 1).otherwise(0)
    parts = (
        sliced.withColumn("opened", opened)
        .withColumn("part", F.sum("opened").over(in_slice))
        .groupBy("user_id", "slice", "part")
        .agg(F.min("second").alias("first"), F.max("second").alias("last"), *merged)
    )
    by_user = Window.partitionBy("user_id").orderBy("first")
    before = opens_session(F.col("first") - F.lag("last").over(by_user), gap_seconds)
    return (
        parts.withColumn("opened", before)
        .withColumn("session_id", F.sum("opened").over(by_user))
        .groupBy("user_id", "session_id")
        .agg(*merged)
    )


def _merged(counters: Mapping[str, tuple[str, str]], stages: Mapping[str, str]) -> list[Column]:
    """The same statistics from statistics of parts."""
    sums = ["page_views", *counters, *stages.values()]
    return [
        F.max("end_time").alias("end_time"),
        F.min("start_time").alias("start_time"),
        *[F.sum(quoted(c)).alias(c) for c in sums],
    ]
