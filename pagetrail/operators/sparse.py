"""Gold with any number of pages: hits per session as a map instead of a column per page.

Pages are data here, never column names: none is collected, none clashes, and a log with
a hundred thousand pages costs no more than its distinct (session, page) pairs. Both
groupings run on the partitioning by user that the session windows leave.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.columns import percent, quoted, seconds_between, session_key
from pagetrail.operators.gold import check_stages
from pagetrail.schema import EXTRA_STAGES, VALUE_COUNTERS

SESSION = ["user_id", "session_id"]
HITS = "map<string,bigint>"


def page_hits(sessionised: DataFrame) -> DataFrame:
    """``user_id``, ``session_id``, ``page`` and ``hits``: a row per session and page in it.

    Events without a page count for no page.
    """
    page = F.col("current_page").alias("page")
    found = sessionised.filter(F.col("current_page").isNotNull())
    return found.groupBy(*SESSION, page).agg(F.count(F.lit(1)).alias("hits"))


def sparse_funnel(sessionised: DataFrame) -> DataFrame:
    """``unique_session_id``, ``page``, ``hits``: the funnel matrix without its zeros."""
    key = session_key(F.col("user_id"), F.col("session_id"))
    return page_hits(sessionised).select(key.alias("unique_session_id"), "page", "hits")


def session_parts(
    sessionised: DataFrame, counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS
) -> DataFrame:
    """``user_id``, ``session_id``, times, views, counters and ``hits`` of each session.

    Rows of parts of one session are put together by ``merged_part``.
    """
    per_page = sessionised.groupBy(*SESSION, "current_page").agg(
        F.min("event_timestamp").alias("start_time"),
        F.max("event_timestamp").alias("end_time"),
        F.count("current_page").alias("page_views"),
        *[
            F.count_if(quoted(column) == F.lit(value)).alias(name)
            for name, (column, value) in counters.items()
        ],
    )
    pair = F.when(
        F.col("current_page").isNotNull(), F.struct(F.col("current_page"), F.col("page_views"))
    )
    return per_page.groupBy(*SESSION).agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("page_views").alias("page_views"),
        *[F.sum(name).alias(name) for name in counters],
        # A row per distinct page of one session; null entries are left out.
        F.map_from_entries(F.collect_list(pair)).alias("hits"),
    )


def merged_part(
    one: str, other: str, counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS
) -> list[Column]:
    """The statistics of a session from two parts of it, either of which may be missing."""

    def field(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def total(name: str) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.coalesce(field(one, name), zero) + F.coalesce(field(other, name), zero)

    none = F.create_map().cast(HITS)
    hits = F.map_zip_with(
        F.coalesce(field(one, "hits"), none),
        F.coalesce(field(other, "hits"), none),
        lambda page, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    )
    return [
        F.least(field(one, "start_time"), field(other, "start_time")).alias("start_time"),
        F.greatest(field(one, "end_time"), field(other, "end_time")).alias("end_time"),
        *[total(name).alias(name) for name in ("page_views", *counters)],
        hits.alias("hits"),
    ]


def sparse_gold(
    sessionised: DataFrame, counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS
) -> DataFrame:
    """Gold with a ``hits`` map in place of the stage columns."""
    return finished(session_parts(sessionised, counters), counters)


def finished(parts: DataFrame, counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS):
    """The columns of Gold from rows of whole sessions."""
    return parts.select(
        session_key(F.col("user_id"), F.col("session_id")).alias("unique_session_id"),
        "end_time",
        "start_time",
        "page_views",
        *counters,
        seconds_between(F.col("end_time"), F.col("start_time")).alias("duration_seconds"),
        "hits",
    )


def widened(
    gold: DataFrame, stages: Sequence[str], extras: Sequence[str] = EXTRA_STAGES
) -> DataFrame:
    """The wide Gold table with the given stages, then the extras not among them."""
    stages = list(dict.fromkeys([*stages, *extras]))
    check_stages(stages, {c: () for c in gold.columns if c != "hits"})
    zero = F.lit(0).cast("bigint")
    kept = [c for c in gold.columns if c != "hits"]
    hits = [F.coalesce(F.try_element_at("hits", F.lit(s)), zero).alias(s) for s in stages]
    return gold.select(*[quoted(c) for c in kept], *hits)


def page_reach(gold: DataFrame) -> DataFrame:
    """``page``, ``sessions`` that reached it, ``pct`` of all sessions, ``hits``: every page.

    Sessions are counted per page before the shuffle; the number of all sessions is a scalar
    subquery.
    """
    total = gold.agg(F.count(F.lit(1)).alias("total")).scalar()
    reached = gold.select(F.explode("hits").alias("page", "hits")).groupBy("page").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("hits").alias("hits")
    )
    return reached.select(
        "page", "sessions", percent(F.col("sessions"), total).alias("pct"), "hits"
    )
