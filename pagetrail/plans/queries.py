"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.operators.durations import (
    daily_duration_counts,
    duration_density,
    duration_histogram,
    merged_counts,
)
from pagetrail.operators.gold import (
    funnel_matrix,
    gold,
    gold_from_events,
    gold_pivot_join,
    session_stats,
)
from pagetrail.operators.model import (
    conversion_quality,
    held_out_scores,
    rank_auc,
    reliability,
)
from pagetrail.operators.reports import (
    conversion_by,
    conversion_by_hour,
    conversion_sets,
    funnel_lines,
    funnel_report,
    total_sessions,
)
from pagetrail.operators.sessions import session_metrics, sessionise, unparsed_times
from pagetrail.operators.sparse import page_reach, sparse_funnel, sparse_gold, widened
from pagetrail.plans.increments import (
    ingest_days,
    read_bronze_days,
    read_duration_counts,
    read_gold,
    read_silver,
    run_increment,
)
from pagetrail.plans.layered_run import ingest, read_bronze, run_layers
from pagetrail.schema import CORRUPT_COLUMN, FUNNEL_STAGES, GAP_SECONDS, LEGACY_GAP_SECONDS
from pagetrail.sources.click_log import write_click_log
from pagetrail.sources.events_table import click_events
from pagetrail.sources.layers import (
    export_csv,
    export_parquet,
    preview,
    read_csv,
    read_layer,
    write_days,
    write_layer,
)
from pagetrail.sources.quarantine import read_quarantine, reason_counts, replay
from pagetrail.sources.raw import read_raw_json, rejected_count, rejected_events, valid_events
from pagetrail.sources.runs import claim_run, layer_path, mark_complete, read_as_of, run_diff
from pagetrail.sources.scratch import scratch_path, scratch_table
from pagetrail.streaming.sessions import append_seconds, read_raw_stream, sessions_so_far

Query = Callable[[SparkSession, str], DataFrame]

# The test events lie hours apart; at this timeout sessions have several of them.
WIDE_GAP = 21_600
CONVERSION_SETS = [("device",), ("browser",), ("hour",), ("device", "hour")]


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL engine under comparison has them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _sessionised(spark: SparkSession, sf_dir: str, gap: int = WIDE_GAP, **options) -> DataFrame:
    return sessionise(click_events(spark, sf_dir), gap, tie_is_unique=True, **options)


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(_sessionised(spark, sf_dir), FUNNEL_STAGES)


def _sessionise(gap: int, **options) -> Query:
    return lambda spark, sf_dir: _sessionised(spark, sf_dir, gap, **options)


def _rows_of_half_the_users(spark: SparkSession, sf_dir: str) -> int:
    """A limit that about half of the users exceed: the mean number of events."""
    users = click_events(spark, sf_dir).groupBy("user_id").count()
    return int(users.agg(F.avg("count")).first()[0])


def _busy(spark: SparkSession, sf_dir: str, unique: bool) -> DataFrame:
    limit = _rows_of_half_the_users(spark, sf_dir)
    events = click_events(spark, sf_dir)
    return sessionise(events, WIDE_GAP, tie_is_unique=unique, max_user_rows=limit)


def _some_bad_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of which searches have no usable time."""
    time = F.when(F.col("current_page") == "search", "unknown").otherwise(F.col("event_time"))
    return click_events(spark, sf_dir).withColumn("event_time", time)


def _tied(spark: SparkSession, sf_dir: str, limit: int | None, unique: bool) -> DataFrame:
    """Clicks of which all of an hour have the same time."""
    clicks = click_events(spark, sf_dir)
    hour = F.date_trunc("hour", F.to_timestamp("event_time"))
    clicks = clicks.withColumn("event_time", F.date_format(hour, "yyyy-MM-dd HH:mm:ss"))
    return sessionise(clicks, WIDE_GAP, tie_is_unique=unique, max_user_rows=limit)


def gold_dirty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered pages of which two differ in case only and one is called like a counter."""
    page = (
        F.when(F.col("current_page") == "search", "page_views")
        .when((F.col("current_page") == "home") & (F.col("event_id") % 2 == 0), "Home")
        .otherwise(F.col("current_page"))
    )
    clicks = click_events(spark, sf_dir).withColumn("current_page", page)
    return gold(sessionise(clicks, WIDE_GAP, tie_is_unique=True))


def event_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessionised(spark, sf_dir).select(
        "event_id", "user_id", "event_timestamp", "prev_time", "time_diff_seconds"
    )


def session_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessionised(spark, sf_dir).select(
        "event_id", "is_new_session", "session_id", "unique_session_id"
    )


def sub_second_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' own times, which have fractions of seconds, and a numeric user."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    return sessionise(events, WIDE_GAP, time="ts", tie_is_unique=True).drop("ts")


def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(read_raw_json(spark, write_click_log(spark, sf_dir)))


def ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_events(read_raw_json(spark, write_click_log(spark, sf_dir)))


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_count(read_raw_json(spark, write_click_log(spark, sf_dir)))


def bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "layers")
    ingest(spark, write_click_log(spark, sf_dir), root, 1)
    return read_bronze(spark, root, 1).drop("event_id")


def bad_records_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "layers")
    ingest(spark, write_click_log(spark, sf_dir), root, 1)
    return read_layer(spark, layer_path(root, 1, "bad_records")).drop("event_id")


def _layered(layer: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "layers")
        run_layers(spark, write_click_log(spark, sf_dir), root, gap_seconds=WIDE_GAP)
        return read_as_of(spark, root, layer)

    return query


def layer_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with different timeouts; the Gold table as of a run between them."""
    root = scratch_path(spark, "layers")
    for run_id, gap in ((1, GAP_SECONDS), (3, WIDE_GAP)):
        sessions = session_stats(_sessionised(spark, sf_dir, gap))
        write_layer(sessions, layer_path(root, run_id, "gold"))
        mark_complete(spark, root, run_id)
    return read_as_of(spark, root, "gold", 2)


def layer_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sessions change if the timeout does, from two runs' tables."""
    root, runs = scratch_path(spark, "layers"), []
    for gap in (GAP_SECONDS, WIDE_GAP):
        runs.append(claim_run(spark, root))
        sessions = session_stats(_sessionised(spark, sf_dir, gap))
        write_layer(sessions, layer_path(root, runs[-1], "gold"))
        mark_complete(spark, root, runs[-1])
    return run_diff(spark, root, "gold", *runs, ["unique_session_id"])


def gold_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions, path = _gold(spark, sf_dir), scratch_path(spark, "gold-csv")
    export_csv(sessions, path)
    return read_csv(spark, path, sessions.schema)


def gold_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold-parquet")
    export_parquet(_gold(spark, sf_dir), path)
    return read_layer(spark, path)


def density_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded, as sums of exponentials differ in the last digits between engines."""
    curve = duration_density(_gold(spark, sf_dir))
    return curve.select(F.round("x", 4).alias("x"), F.round("density", 4).alias("density"))


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log read as a stream: all its sessions, the open ones too."""
    raw = read_raw_stream(spark, write_click_log(spark, sf_dir))
    path = scratch_path(spark, "stream-seconds")
    append_seconds(valid_events(raw), path).awaitTermination()
    return sessions_so_far(spark, path, gap_seconds=WIDE_GAP)


def model_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the model is measured on; whether it is right is tested, not compared."""
    sessions = scratch_table(_gold(spark, sf_dir), "gold")
    return conversion_quality(sessions).drop("right")


def preview_is_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a preview has, and how many of them Gold has."""
    sessions = scratch_table(_gold(spark, sf_dir), "gold")
    shown = preview(sessions).select("unique_session_id").withColumn("shown", F.lit(1))
    both = shown.join(sessions.select("unique_session_id", "start_time"), "unique_session_id", "left")
    return both.agg(F.count("shown").alias("shown"), F.count("start_time").alias("in_gold"))


def layered_bad_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in which some times do not parse."""
    root, log = scratch_path(spark, "layers"), scratch_path(spark, "log")
    _some_bad_times(spark, sf_dir).drop("event_id").write.json(log)
    run_layers(spark, log, root, gap_seconds=WIDE_GAP, export_events=False)
    return read_as_of(spark, root, "bad_times").drop("event_id")


def _two_increments(spark: SparkSession, sf_dir: str) -> str:
    """The raw log in layers by day, taken in by two runs; the folder."""
    root = scratch_path(spark, "days")
    ingest_days(spark, write_click_log(spark, sf_dir), root, "log")
    ends = read_bronze_days(spark, root, None, dt.date.max).agg(
        F.min(F.to_date("event_time")).alias("lo"), F.max(F.to_date("event_time")).alias("hi")
    )
    lo, hi = ends.first()
    for upto in (lo + (hi - lo) / 2, hi):
        run_increment(spark, root, upto, WIDE_GAP)
    return root


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two runs over halves of the log; ``day`` is where their session starts."""
    silver = read_silver(spark, _two_increments(spark, sf_dir))
    return silver.drop("event_key")


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of two runs over halves of the log, those still open too."""
    return widened(read_gold(spark, _two_increments(spark, sf_dir)), FUNNEL_STAGES)


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "days")
    ingest_days(spark, write_click_log(spark, sf_dir), root, "log")
    return reason_counts(read_quarantine(spark, root))


def replayed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after the rejected ones without a user were given one, twice."""
    root = scratch_path(spark, "days")
    ingest_days(spark, write_click_log(spark, sf_dir), root, "log")
    rejected = read_quarantine(spark, root).filter(F.col(CORRUPT_COLUMN).isNull())
    for _ in range(2):
        replay(rejected.withColumn("user_id", F.lit("nobody")), root)
    return read_bronze_days(spark, root, None, dt.date.max).drop("event_key")


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions that the model was not trained on, with their scores."""
    return held_out_scores(scratch_table(_gold(spark, sf_dir), "gold"))


def model_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability(model_scores(spark, sf_dir))


def _views_as_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every session that needs no training: its page views, a tenth each."""
    views = F.least(F.col("page_views"), F.lit(10)) / 10
    return _gold(spark, sf_dir).select(
        views.alias("score"), (F.col("confirmation") > 0).alias("converted")
    )


def rank_auc_of_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    auc = rank_auc(_views_as_score(spark, sf_dir))
    return auc.select(F.round("auc", 9).alias("auc"))


def reliability_of_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reliability(_views_as_score(spark, sf_dir))
    return rows.withColumns({c: F.round(c, 9) for c in ("mean_score", "rate")})


def duration_histogram_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From counts kept by day, merged over all days."""
    path = scratch_path(spark, "durations")
    write_days(daily_duration_counts(_gold(spark, sf_dir)), path)
    return duration_histogram(None, counts=merged_counts(read_layer(spark, path)))


def incremental_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the counts that two runs over halves of the log have kept."""
    root = _two_increments(spark, sf_dir)
    return duration_histogram(None, counts=read_duration_counts(spark, root))


QUERIES: dict[str, Query] = {
    # Silver: events with their sessions.
    "sessionise_900": _sessionise(GAP_SECONDS),
    "sessionise_1800": _sessionise(LEGACY_GAP_SECONDS),
    "sessionise_21600": _sessionise(WIDE_GAP),
    "sessionise_busy_users": lambda s, d: _busy(s, d, unique=True),
    "sessionise_busy_users_any_tie": lambda s, d: _busy(s, d, unique=False),
    "sessionise_ties": lambda s, d: _tied(s, d, None, unique=True),
    "sessionise_ties_busy_users": lambda s, d: _tied(s, d, 0, unique=True),
    "sessionise_ties_busy_users_any_tie": lambda s, d: _tied(s, d, 0, unique=False),
    "sessionise_sub_second": sub_second_gaps,
    "sessionise_without_bad_times": lambda s, d: sessionise(_some_bad_times(s, d), WIDE_GAP),
    "sessionise_keep_null_times": lambda s, d: sessionise(
        _some_bad_times(s, d), WIDE_GAP, keep_null_times=True
    ),
    "unparsed_times": lambda s, d: unparsed_times(_some_bad_times(s, d)),
    "event_gaps": event_gaps,
    "session_flags": session_flags,
    "session_metrics": lambda s, d: session_metrics(_sessionised(s, d)),
    # Gold: one row per session.
    "session_stats": lambda s, d: session_stats(_sessionised(s, d)),
    "session_stats_900": lambda s, d: session_stats(_sessionised(s, d, GAP_SECONDS)),
    "session_stats_plain_1800": lambda s, d: session_stats(
        _sessionised(s, d, LEGACY_GAP_SECONDS), counters={}
    ),
    "funnel_matrix": lambda s, d: funnel_matrix(_sessionised(s, d), FUNNEL_STAGES),
    "gold": _gold,
    "gold_discovered_stages": lambda s, d: gold(_sessionised(s, d)),
    "gold_dirty_pages": gold_dirty_pages,
    "gold_pivot_join": lambda s, d: gold_pivot_join(_sessionised(s, d), FUNNEL_STAGES),
    "gold_from_events": lambda s, d: gold_from_events(
        click_events(s, d), FUNNEL_STAGES, WIDE_GAP
    ),
    "gold_busy_users": lambda s, d: gold(_busy(s, d, unique=True), FUNNEL_STAGES),
    "sparse_funnel": lambda s, d: sparse_funnel(_sessionised(s, d)),
    "sparse_gold_widened": lambda s, d: widened(sparse_gold(_sessionised(s, d)), FUNNEL_STAGES),
    # Runs over a growing log.
    "incremental_silver": incremental_silver,
    "incremental_gold": incremental_gold,
    "quarantine_reasons": quarantine_reasons,
    "replayed_events": replayed_events,
    # Reports.
    "page_reach": lambda s, d: page_reach(sparse_gold(_sessionised(s, d))),
    "total_sessions": lambda s, d: total_sessions(_gold(s, d)),
    "funnel_counts": lambda s, d: funnel_report(_gold(s, d)).drop("pct"),
    "funnel_counts_present": lambda s, d: funnel_report(
        gold(_sessionised(s, d)), missing="skip"
    ).drop("pct"),
    "funnel_conversion": lambda s, d: funnel_report(_gold(s, d), FUNNEL_STAGES),
    "funnel_lines": lambda s, d: funnel_lines(funnel_report(_gold(s, d), FUNNEL_STAGES)),
    "conversion_by_device": lambda s, d: conversion_by(_sessionised(s, d), "device"),
    "conversion_by_browser": lambda s, d: conversion_by(_sessionised(s, d), "browser"),
    "conversion_by_hour": lambda s, d: conversion_by_hour(_gold(s, d)),
    "duration_histogram": lambda s, d: duration_histogram(_gold(s, d)),
    "duration_histogram_minutes": lambda s, d: duration_histogram(_gold(s, d), unit="minutes"),
    "duration_histogram_merged": duration_histogram_merged,
    "incremental_histogram": incremental_histogram,
    "duration_density": density_rounded,
    "conversion_sets": lambda s, d: conversion_sets(_sessionised(s, d), CONVERSION_SETS),
    "rank_auc_of_views": rank_auc_of_views,
    "reliability_of_views": reliability_of_views,
    # Sources, layers and exports.
    "ingest_valid": ingest_valid,
    "ingest_rejected": ingest_rejected,
    "ingest_counts": ingest_counts,
    "bronze_layer": bronze_layer,
    "bad_records_layer": bad_records_layer,
    "layered_gold": _layered("gold"),
    "layered_funnel": _layered("funnel"),
    "layer_as_of": layer_as_of,
    "layer_diff": layer_diff,
    "gold_csv_roundtrip": gold_csv_roundtrip,
    "gold_parquet_roundtrip": gold_parquet_roundtrip,
    "stream_sessions": stream_sessions,
    "layered_session_metrics": _layered("session_metrics"),
    "layered_conversion_by_device": _layered("conversion_by_device"),
    "layered_conversion_by_browser": _layered("conversion_by_browser"),
    "layered_bad_times": layered_bad_times,
    "preview_is_part": preview_is_part,
    "model_held_out": model_held_out,
    "model_scores": model_scores,
    "model_reliability": model_reliability,
    "preview_gold": lambda s, d: preview(_gold(s, d)),
}


def registered() -> dict[str, Query]:
    """All queries, with their timestamps ready for comparison."""
    return {name: _ready(query) for name, query in QUERIES.items()}


def _ready(query: Query) -> Query:
    return lambda spark, sf_dir: plain_times(query(spark, sf_dir))
