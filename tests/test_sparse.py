"""Gold with hits as a map."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagetrail.operators.gold import gold
from pagetrail.operators.sessions import sessionise
from pagetrail.operators.sparse import page_reach, sparse_funnel, sparse_gold, widened
from pagetrail.schema import FUNNEL_STAGES
from pagetrail.sources.events_table import click_events


@pytest.fixture(scope="module")
def silver(spark):
    clicks = click_events(spark, "/root/testdata/sf0.001")
    page = F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("current_page"))
    return sessionise(clicks.withColumn("current_page", page), 21_600)


def rows(df):
    return sorted(map(str, df.collect()))


def test_widened_equals_the_wide_form(silver):
    assert rows(widened(sparse_gold(silver), FUNNEL_STAGES)) == rows(gold(silver, FUNNEL_STAGES))


def test_funnel_has_no_zeros(silver):
    found = sparse_funnel(silver)
    assert found.filter("hits < 1 or page is null").isEmpty()
    total = found.agg(F.sum("hits")).first()[0]
    assert total == silver.filter("current_page is not null").count()


def test_no_exchange_but_the_windows(silver):
    plan = sparse_gold(silver)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_taken_names_are_refused(silver):
    with pytest.raises(ValueError):
        widened(sparse_gold(silver), ["page_views"])


def test_hundred_thousand_pages(spark):
    """No page is a column, and none is in the driver."""
    events = spark.range(200_000).select(
        F.concat(F.lit("u"), F.col("id") % 50).alias("user_id"),
        F.timestamp_seconds(F.floor(F.col("id") / 50) * 60).alias("event_time"),
        F.concat(F.lit("/page/"), F.col("id") % 100_000).alias("current_page"),
        F.lit("Mobile").alias("device"),
        F.lit("Chrome").alias("browser"),
    )
    reach = page_reach(sparse_gold(sessionise(events, 900)))
    row = reach.agg(F.count("*").alias("n"), F.min("hits").alias("a"), F.max("sessions").alias("b"))
    assert tuple(row.first()) == (100_000, 2, 1)


def test_no_sessions(silver):
    assert page_reach(sparse_gold(silver.limit(0))).collect() == []
