"""A growing log in layers by day: each run reads the days it adds, and nothing closed before.

    <root>/bronze/day=<event's day>/            valid events; a delivery replaces its days
    <root>/quarantine/, <root>/corrections/     rejected rows, and corrected ones
    <root>/silver/upto=<n>/day=<start day>/     the events of a run by their session's day
    <root>/gold/upto=<n>/day=<start day>/       the sessions that the run has closed
    <root>/durations/upto=<n>/day=<start day>/  sessions per duration, of those it has closed
    <root>/carry/upto=<n>/                      a row per user, for the next run

A run goes up to a day, whose date it is named after. It takes the days of Bronze after
the run before, and that run's carry. Run again, it replaces its own folders only. Sessions
stay on the day they start, also where a later run closes them, so a filter on ``day``
prunes folders in every layer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions.columns import event_time
from pagetrail.operators.busy_users import MAX_USER_ROWS
from pagetrail.operators.carry_over import carried_on, continued, no_carry, sessions_with_carry
from pagetrail.operators.durations import daily_duration_counts, merged_counts
from pagetrail.operators.sparse import finished
from pagetrail.schema import CORRUPT_COLUMN, GAP_SECONDS, RAW_COLUMNS, VALUE_COUNTERS
from pagetrail.sources.layers import read_layer, read_layer_if_present, write_days, write_layer
from pagetrail.sources.quarantine import read_corrections, with_reasons, write_quarantine
from pagetrail.sources.raw import read_raw_json
from pagetrail.sources.scratch import scratch_table

EVENT_KEY = "event_key"
BRONZE_COLUMNS = [*RAW_COLUMNS, EVENT_KEY]
SILVER_SCHEMA = (
    ", ".join(f"{c} string" for c in BRONZE_COLUMNS)
    + ", event_timestamp timestamp, prev_time timestamp, time_diff_seconds bigint,"
    " is_new_session int, session_id bigint, unique_session_id string, session_start timestamp"
)

DURATIONS = "duration_seconds bigint, sessions bigint, upto date, day date"


@dataclass(frozen=True)
class Increment:
    """What a run has done: the day it went up to, and whether its carry is another than the
    one it had left before. If it is, the runs after it are to be repeated in turn."""

    upto: dt.date
    carry_changed: bool


def bronze_path(root: str) -> str:
    return f"{root.rstrip('/')}/bronze"


def _path(root: str, layer: str, upto: dt.date | None = None) -> str:
    folder = f"{root.rstrip('/')}/{layer}"
    return folder if upto is None else f"{folder}/upto={upto.isoformat()}"


def event_key(log: str) -> Column:
    """Unique and, within a delivery, in the order of its rows."""
    number = F.lpad(F.monotonically_increasing_id().cast("string"), 19, "0")
    return F.concat(F.lit(log + "/"), number)


def ingest_days(spark: SparkSession, source: str, root: str, log: str) -> None:
    """Sort a delivery of raw lines, called ``log``, into the days of Bronze and the quarantine.

    The days that it has events of are replaced, all others stay: deliver whole days. What
    it rejects replaces what an earlier delivery of that name had rejected. The text is
    parsed once and written once; both are made from that table, so the keys agree.
    """
    raw = read_raw_json(spark, source).withColumn(EVENT_KEY, event_key(log))
    parsed = event_time(raw, "event_time")
    rows = scratch_table(
        with_reasons(raw.withColumn("day", F.to_date(parsed))), f"delivery-{log.replace('/', '-')}"
    )
    valid = rows.filter(F.size("reasons") == 0).select(*BRONZE_COLUMNS, "day")
    write_days(valid, bronze_path(root))
    rejected = rows.filter(F.size("reasons") > 0).select(
        *RAW_COLUMNS, CORRUPT_COLUMN, EVENT_KEY, "reasons"
    )
    write_quarantine(rejected, root, log)


def read_bronze_days(
    spark: SparkSession, root: str, after: dt.date | None, upto: dt.date
) -> DataFrame:
    """The events of the days after ``after`` up to ``upto``, corrected ones too.

    Folders of other days are not listed; of the corrections all are read.
    """
    days = F.col("day") <= F.lit(upto)
    if after is not None:
        days &= F.col("day") > F.lit(after)
    events = read_bronze(spark, root).filter(days)
    corrected = read_corrections(spark, root).filter(days)
    return events.unionByName(corrected.select(*events.columns)).drop("day")


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """The valid events of all deliveries by ``day``, without the corrected ones."""
    columns = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)
    return spark.read.schema(f"{columns}, day date").parquet(bronze_path(root))


def increments(spark: SparkSession, root: str) -> list[dt.date]:
    """The days that complete runs went up to, in order: a date per run."""
    marks = read_layer_if_present(spark, f"{root.rstrip('/')}/_increments")
    if marks is None:
        return []
    return sorted(r.upto for r in marks.select(F.col("upto").cast("date")).distinct().collect())


def _digest(carry: DataFrame) -> tuple[int, int]:
    """Tells two carry tables apart, whatever the order of their rows and map entries."""
    plain = [F.array_sort(F.map_entries("hits")) if c == "hits" else F.col(c) for c in carry.columns]
    row = carry.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*plain).cast("decimal(38,0)")).alias("sum")
    ).first()
    return row["rows"], int(row["sum"] or 0)


def run_increment(
    spark: SparkSession,
    root: str,
    upto: dt.date,
    gap_seconds: int = GAP_SECONDS,
    counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS,
    max_user_rows: int | None = MAX_USER_ROWS,
) -> Increment:
    """Add the days of Bronze after the run before, up to ``upto``, to Silver, Gold and carry.

    The days up to ``upto`` must be complete: sessions that the next day's first instant
    could not join any more are closed. Running it again for the same day, for instance after
    a corrected delivery, replaces what that run had written and leaves all others. Its mark
    is taken away first and written last, so readers never see half a run.
    """
    before = [d for d in increments(spark, root) if d < upto]
    last = before[-1] if before else None
    carry = no_carry(spark, counters) if last is None else read_layer(spark, _path(root, "carry", last))
    old = read_layer_if_present(spark, _path(root, "carry", upto))
    old_digest = None if old is None else _digest(old)
    _mark(spark, root, upto, done=False)

    events = read_bronze_days(spark, root, last, upto)
    silver = continued(
        events,
        carry,
        gap_seconds,
        tie=EVENT_KEY,
        tie_is_unique=True,
        max_user_rows=max_user_rows,
    )
    silver = silver.withColumn("day", F.to_date("session_start"))
    write_layer(silver, _path(root, "silver", upto), by=["day"])

    horizon = F.lit(upto + dt.timedelta(days=1)).cast("timestamp")
    written = spark.read.schema(SILVER_SCHEMA).parquet(_path(root, "silver", upto))
    sessions = scratch_table(
        sessions_with_carry(written, carry, horizon, gap_seconds, counters), "sessions"
    )
    closed = finished(sessions.filter("closed"), counters)
    write_layer(
        closed.withColumn("day", F.to_date("start_time")), _path(root, "gold", upto), by=["day"]
    )
    write_layer(daily_duration_counts(closed), _path(root, "durations", upto), by=["day"])
    write_layer(carried_on(sessions, carry, counters), _path(root, "carry", upto))
    changed = old_digest != _digest(read_layer(spark, _path(root, "carry", upto)))
    _mark(spark, root, upto, done=True)
    return Increment(upto, changed)


def _mark(spark: SparkSession, root: str, upto: dt.date, done: bool) -> None:
    row = spark.range(0, int(done), 1, 1).select(F.current_timestamp().alias("completed_at"))
    write_layer(row, _path(root, "_increments", upto))


def refresh(spark: SparkSession, root: str, day: dt.date, **options) -> list[Increment]:
    """Repeat the run that holds ``day``, whose events have changed, and those after it
    for as long as a run leaves another carry than before. Returns the runs repeated."""
    repeated = []
    for upto in [d for d in increments(spark, root) if d >= day]:
        repeated.append(run_increment(spark, root, upto, **options))
        if not repeated[-1].carry_changed:
            break
    return repeated


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """The events of all complete runs with their sessions; ``day`` is where a session starts."""
    return _of_runs(spark, root, "silver", f"{SILVER_SCHEMA}, upto date, day date").drop("upto")


def read_gold(
    spark: SparkSession, root: str, counters: Mapping[str, tuple[str, str]] = VALUE_COUNTERS
) -> DataFrame:
    """The sessions of all complete runs, with ``hits`` and ``day``: closed ones from the runs
    that closed them, and those still open from what the last run carries over."""
    done = increments(spark, root)
    if not done:
        raise LookupError(f"no complete run in {root}")
    carry = read_layer(spark, _path(root, "carry", done[-1]))
    still = finished(carry.filter("open"), counters).withColumn("day", F.to_date("start_time"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in still.schema.fields[:-1])
    closed = _of_runs(spark, root, "gold", f"{fields}, upto date, day date").drop("upto")
    return closed.unionByName(still)


def read_duration_counts(
    spark: SparkSession, root: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Sessions per duration of those that start on the days from ``first`` to ``last``.

    Merged from the counts that the runs keep, by day, and the sessions still open; Gold is not read.
    """
    kept = _of_runs(spark, root, "durations", DURATIONS).drop("upto")
    carry = read_layer(spark, _path(root, "carry", increments(spark, root)[-1]))
    still = daily_duration_counts(finished(carry.filter("open"), {}))
    return merged_counts(kept.unionByName(still), first, last)


def _of_runs(spark: SparkSession, root: str, layer: str, schema: str) -> DataFrame:
    done = increments(spark, root)
    rows = spark.read.schema(schema).parquet(_path(root, layer))
    return rows.filter(F.col("upto").isin(done))
