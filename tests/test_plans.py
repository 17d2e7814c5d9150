"""Physical plans: shuffles, columns read, and no hidden jobs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pagetrail.operators.gold import gold, gold_from_events, gold_pivot_join
from pagetrail.operators.reports import conversion_by, funnel_report
from pagetrail.operators.sessions import sessionise
from pagetrail.schema import FUNNEL_STAGES
from pagetrail.sources.events_table import click_events
from pagetrail.sources.raw import read_raw_json, valid_events

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|Range)", plan(df))


@pytest.fixture(scope="module")
def clicks(spark):
    return click_events(spark, SF_DIR)


@pytest.fixture
def silver(clicks):
    return sessionise(clicks, max_user_rows=None)


def jobs_of(spark, make):
    spark.sparkContext.setJobGroup("plan-test", "")
    try:
        make()
        return spark.sparkContext.statusTracker().getJobIdsForGroup("plan-test")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_gold_needs_one_exchange(clicks, silver):
    assert len(exchanges(gold(silver, FUNNEL_STAGES))) == 1
    # Seconds, slices and users: see test_a_hot_user_leaves_the_map_side_as_few_rows.
    assert len(exchanges(gold_from_events(clicks, FUNNEL_STAGES))) == 3


def test_no_user_over_the_limit_means_the_plain_plan(clicks):
    assert len(exchanges(gold(sessionise(clicks), FUNNEL_STAGES))) == 1


def test_reports_add_only_the_exchange_of_their_few_rows(silver):
    assert len(exchanges(conversion_by(silver, "device"))) == 2
    funnel = exchanges(funnel_report(gold(silver, FUNNEL_STAGES)))
    assert [e.split("(")[0] for e in funnel].count("hashpartitioning") == 1


def test_one_sort_for_both_windows(silver):
    assert len(re.findall(r"\bSort \[", plan(silver))) == 1


def test_only_needed_columns_are_read(clicks):
    rows = gold(sessionise(clicks, max_user_rows=None), FUNNEL_STAGES)
    text = plan(rows.select("unique_session_id"))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "props" not in read and "event_type" not in read


def test_a_user_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.sql(
        "SELECT 'u' AS user_id, 1L AS event_id, '2024-01-01' AS event_time, 'home' AS current_page"
    ).write.parquet(path)
    one = sessionise(spark.read.parquet(path), max_user_rows=None).filter("user_id = 'u'")
    assert "EqualTo(user_id,u)" in plan(one)


def test_required_field_filters_reach_the_json_scan(spark, tmp_path):
    (tmp_path / "log.json").write_text("{}")
    text = plan(valid_events(read_raw_json(spark, str(tmp_path))))
    assert "IsNotNull(user_id)" in text and "IsNotNull(current_page)" in text


def test_defining_gold_runs_no_job(spark, clicks):
    silver = sessionise(clicks, max_user_rows=None)
    for make in (
        lambda: gold(silver, FUNNEL_STAGES),
        lambda: gold_pivot_join(silver, FUNNEL_STAGES),
        lambda: gold_from_events(clicks, FUNNEL_STAGES),
        lambda: funnel_report(gold(silver, FUNNEL_STAGES)),
        lambda: conversion_by(silver, "device"),
    ):
        assert len(jobs_of(spark, make)) == 0


def test_busy_users_are_spread_by_instant(clicks):
    """No exchange by user alone but the one of the quiet users and of slice totals."""
    rows = sessionise(clicks, max_user_rows=60, tie_is_unique=True)
    found = exchanges(rows)
    assert any("event_timestamp" in e for e in found) and any("slice" in e for e in found)
    assert "CartesianProduct" not in plan(rows) and "NestedLoop" not in plan(rows)


@pytest.fixture
def no_small_data_shortcuts(spark):
    """Plans as for large tables: no broadcast joins by size, no joining of partitions."""
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("limit, spread", [(None, False), (1000, True)])
def test_no_task_gets_all_events_of_a_busy_user(spark, no_small_data_shortcuts, limit, spread):
    i = F.col("id")
    user = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), i % 300))
    events = spark.range(9000).select(
        i.alias("event_id"), user.alias("user_id"), F.timestamp_seconds(i * 70).alias("at")
    )
    rows = sessionise(events, time="at", tie_is_unique=True, max_user_rows=limit)
    per_task = (
        rows.withColumn("task", F.spark_partition_id())
        .groupBy("task")
        # The session column is used, or its windows would not run at all.
        .agg(F.count_if((F.col("user_id") == "hot") & (F.col("session_id") > 0)).alias("hot"))
    )
    counts = [r.hot for r in per_task.collect()]
    assert sum(counts) == 3000
    assert (max(counts) < 1000) == spread


def test_a_hot_user_leaves_the_map_side_as_few_rows(spark, tmp_path):
    """Partial sessions are merged before the shuffle, whatever the order of events."""
    path = str(tmp_path / "hot")
    events = spark.range(200_000, numPartitions=4).select(
        F.col("id").alias("event_id"),
        F.lit("hot").alias("user_id"),
        F.date_format(F.timestamp_seconds(F.col("id") % 50_000), "yyyy-MM-dd HH:mm:ss").alias(
            "event_time"
        ),
        F.lit("home").alias("current_page"),
        F.lit("Chrome").alias("browser"),
        F.lit("Mobile").alias("device"),
    )
    events.write.parquet(path)
    rows = gold_from_events(spark.read.parquet(path), ["home"])
    got = rows.collect()
    assert [(r.unique_session_id, r.page_views, r.home) for r in got] == [
        ("hot_1", 200_000, 200_000)
    ]
    ran = plan(rows).split("== Initial Plan ==")[0]
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", ran)
    names = [set(re.findall(r"[a-z_]+(?=#)", k)) for k in keys]
    assert names == [{"user_id"}, {"user_id", "slice"}, {"user_id", "_groupingexpression"}]
    assert "MergingSessions" not in ran
    # What is shuffled by user alone are parts of slices, not events or seconds.
    by_user = ran.index("Exchange hashpartitioning(user_id#")
    below = ran[by_user : ran.index("Exchange hashpartitioning(user_id#", by_user + 1)]
    assert re.search(r"HashAggregate\(keys=\[user_id#\d+, slice#\d+L, part#\d+L\]", below)
    # Before the first shuffle the events of a second are combined.
    assert "partial_" in ran.split("Exchange hashpartitioning")[-1]
