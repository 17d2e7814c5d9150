"""Tell the few users with very many events from all others.

A window over one user's events runs in one task. That is the cheapest plan
for ordinary users and the wrong one for a user that owns a large share of the
table, so the two kinds take different plans (see ``sessions``).

Where all events together are no more than one user may have, nothing is counted by user.
Else the busy users are found once, by exact counts. If there are any, they are written to
a table: both plans agree on it even if a lost executor makes Spark run one again. It is
joined like any other table, so its size is bounded by nothing but the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.columns import quoted
from pagetrail.sources.scratch import scratch_table

MAX_USER_ROWS = 5_000_000


def busy_users(events: DataFrame, user: str, max_rows: int = MAX_USER_ROWS) -> DataFrame | None:
    """``busy_user``: users with more than ``max_rows`` events; null is a user too.

    None if there are no such users. Counts the events, of a Parquet table by its footers;
    if they are more than ``max_rows``, a second job reads the user column and counts by
    user before its shuffle. Only busy users, if any, are written.
    """
    if events.count() <= max_rows:
        return None
    counts = events.groupBy(quoted(user).alias("busy_user")).agg(F.count(F.lit(1)).alias("rows"))
    busy = counts.filter(F.col("rows") > max_rows).select("busy_user")
    return None if busy.isEmpty() else scratch_table(busy, "busy-users")


def split_users(events: DataFrame, user: str, busy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The events of all other users, and those of the busy ones."""
    same = quoted(user).eqNullSafe(F.col("busy_user"))
    return events.join(busy, same, "left_anti"), events.join(busy, same, "left_semi")
