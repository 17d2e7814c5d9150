"""Durations by day, the density's reach, conversion by sets, ranks, and hot instants."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from pagetrail.operators.durations import (
    REACH,
    daily_duration_counts,
    duration_counts,
    duration_density,
    duration_histogram,
    kernel_rows,
    merged_counts,
)
from pagetrail.operators.gold import gold
from pagetrail.operators.model import rank_auc, reliability
from pagetrail.operators.reports import conversion_by, conversion_by_hour, conversion_sets
from pagetrail.operators.sessions import sessionise
from pagetrail.schema import FUNNEL_STAGES
from pagetrail.sources.events_table import click_events
from pagetrail.sources.layers import write_days

DAY = dt.date(2024, 1, 10)


@pytest.fixture(scope="module")
def silver(spark):
    return sessionise(click_events(spark, "/root/testdata/sf0.01"), 21_600)


@pytest.fixture(scope="module")
def sessions(spark, silver, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    gold(silver, FUNNEL_STAGES).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(str, df.collect()))


def test_two_days_from_the_layer_equal_the_direct_histogram(spark, sessions, tmp_path):
    write_days(daily_duration_counts(sessions), str(tmp_path / "durations"))
    layer = spark.read.parquet(str(tmp_path / "durations"))
    after = DAY + dt.timedelta(days=1)
    merged = merged_counts(layer, DAY, after)
    direct = sessions.filter(F.to_date("start_time").between(F.lit(DAY), F.lit(after)))
    assert rows(duration_histogram(None, counts=merged)) == rows(duration_histogram(direct))
    curves = [duration_density(None, counts=merged), duration_density(direct)]
    curves = [[(r.x, r.density) for r in c.collect()] for c in curves]
    assert all(pytest.approx(a) == b for a, b in zip(*curves, strict=True))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("make", [duration_histogram, duration_density])
def test_gold_is_counted_once(sessions, make):
    """Ends and moments are subqueries over the exchange that the bins are made from."""
    df = make(sessions)
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in ran and "CartesianProduct" not in ran and "NestedLoop" not in ran


def test_kernel_rows_fall_with_the_bandwidth(spark):
    few = spark.createDataFrame([(i, 1) for i in range(0, 1000, 100)], "duration_seconds long, sessions long")
    # Many equal durations and one far away: a narrow kernel over a wide range.
    narrow = spark.createDataFrame(
        [(i % 50, 1000) for i in range(50)] + [(100_000, 1)], "duration_seconds long, sessions long"
    )
    assert kernel_rows(few, 200, 1.0).count() == 10 * 200
    assert kernel_rows(narrow, 200, 1.0).count() < 51 * 200 / 10


def test_density_equals_the_whole_kernel(spark):
    rnd = random.Random(3)
    durations = [rnd.randrange(1000) for _ in range(300)] + [50_000, 60_000]
    gold_like = spark.createDataFrame([(d,) for d in durations], "duration_seconds long")
    n, mean = len(durations), sum(durations) / len(durations)
    h = math.sqrt(sum((d - mean) ** 2 for d in durations) / (n - 1)) * n**-0.2
    low, high = min(durations), max(durations)
    scale = (high - low) / 30 / (h * math.sqrt(2 * math.pi))
    found = duration_density(gold_like).collect()
    assert len(found) == 200
    cut = n * scale * math.exp(-REACH * REACH / 2)
    for i, r in enumerate(found):
        x = low + i * (high - low) / 199
        whole = scale * sum(math.exp(-0.5 * ((x - d) / h) ** 2) for d in durations)
        assert r.x == pytest.approx(x)
        assert abs(r.density - whole) <= cut + 1e-9 * whole


def test_histogram_of_nothing_and_of_one_duration(spark):
    empty = spark.createDataFrame([], "duration_seconds long")
    found = duration_histogram(empty).collect()
    assert [r.sessions for r in found] == [0] * 30 and found[0].lo == 0 and found[29].hi == 1
    assert duration_density(empty).collect() == []
    equal = spark.createDataFrame([(60,), (60,), (None,)], "duration_seconds long")
    found = duration_histogram(equal, unit="minutes").collect()
    assert [r.bin for r in found if r.sessions] == [15] and found[15].sessions == 2
    assert (found[0].lo, found[29].hi) == (0.5, 1.5)
    assert duration_density(equal).collect() == []


def test_sets_equal_the_single_reports(silver, sessions):
    sets = conversion_sets(silver, [("device",), ("browser",), ("hour",)])
    for dim, report in (
        ("device", conversion_by(silver, "device")),
        ("browser", conversion_by(silver, "browser")),
        ("hour", conversion_by_hour(sessions)),
    ):
        got = sets.filter(F.col("dims") == dim).select(*report.columns)
        assert rows(got) == rows(report.withColumn(dim, F.col(dim).cast("string")))


def test_sets_are_one_pass_over_the_events(silver):
    plan = conversion_sets(silver, [("device", "browser"), ("hour",)])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2


def test_combined_values_are_those_of_one_event(spark):
    events = [("u", "2024-01-01 10:00:00", "home", "Mobile", "Chrome"),
              ("u", "2024-01-01 10:01:00", "confirmation", "Tablet", None)]
    df = spark.createDataFrame(
        events, "user_id string, event_time string, current_page string, device string, browser string"
    )
    found = conversion_sets(sessionise(df), [("device", "browser")]).collect()
    assert {(r.device, r.browser, r.sessions, r.converted) for r in found} == {
        ("Mobile", "Chrome", 1, 1), ("Tablet", None, 1, 1),
    }


@pytest.mark.parametrize("kinds", [2, 10, 10_000])
def test_auc_counts_every_pair(spark, kinds):
    rnd = random.Random(kinds)
    given = [(rnd.randrange(kinds) / kinds, rnd.random() < 0.3) for _ in range(400)]
    scores = spark.createDataFrame(given + [(None, True), (0.5, None)], "score double, converted boolean")
    pos, neg = [s for s, c in given if c], [s for s, c in given if not c]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert rank_auc(scores.repartition(7)).first().auc == pytest.approx(won / (len(pos) * len(neg)))


def test_auc_of_one_kind_is_null(spark):
    scores = spark.createDataFrame([(0.5, True)], "score double, converted boolean")
    assert rank_auc(scores).first().auc is None
    assert rank_auc(scores.limit(0)).first().auc is None


def test_reliability(spark):
    given = [(0.05, False), (0.05, True), (0.95, True), (1.0, True), (None, True)]
    scores = spark.createDataFrame(given, "score double, converted boolean")
    found = {r.bin: (r.sessions, r.rate) for r in reliability(scores).collect()}
    assert found == {0: (2, 0.5), 9: (2, 1.0)}


def test_a_hot_instant_without_unique_ties_is_spread(spark):
    """200,000 equal instants of one user: exactly one is first, and tasks share the rest."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.files.maxPartitionBytes": "512k",  # what a join splits are map tasks' rows
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    events = spark.range(200_000, numPartitions=20).select(
        F.lit("hot").alias("user_id"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("at"),
        F.lit(7).alias("event_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("url"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = sessionise(events, time="at", max_user_rows=1000)
        tasks = found.withColumn("task", F.spark_partition_id()).groupBy("task").agg(
            F.count("*").alias("n"),
            F.sum("is_new_session").alias("opened"),
            F.max("session_id").alias("session"),
            F.count("prev_time").alias("later"),
        )
        parts = tasks.collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert sum(p.n for p in parts) == 200_000 and max(p.n for p in parts) < 20_000
    assert sum(p.opened for p in parts) == 1 and sum(p.later for p in parts) == 199_999
    assert {p.session for p in parts} == {1}
