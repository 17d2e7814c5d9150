"""Gold, reports and durations on hand-written events."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest

from pagetrail.operators.durations import duration_density, duration_histogram
from pagetrail.operators.gold import (
    MAX_COUNTED_STAGES,
    discover_stages,
    funnel_matrix,
    gold,
    gold_from_events,
    gold_pivot_join,
    session_stats,
    stage_columns,
)
from pagetrail.operators.reports import (
    conversion_by,
    conversion_by_hour,
    funnel_report,
    total_sessions,
)
from pagetrail.operators.sessions import sessionise
from pagetrail.schema import FUNNEL_STAGES

SCHEMA = (
    "event_id bigint, user_id string, event_time string, current_page string, "
    "browser string, device string"
)
EVENTS = [
    (1, "a", "2024-01-01 10:00:00", "home", "Chrome", "Mobile"),
    (2, "a", "2024-01-01 10:01:00", "home", "Chrome", "Desktop"),
    (3, "a", "2024-01-01 10:02:05", "confirmation", "Edge", None),
    (4, "a", "2024-01-01 11:00:00", "search", "Edge", "Tablet"),
    (5, "b", "2024-01-01 11:30:00", "payment_failed", None, "Mobile"),
]
STAGES = ["home", "search", "confirmation"]


@pytest.fixture(scope="module")
def clicks(spark):
    return spark.createDataFrame(EVENTS, SCHEMA)


@pytest.fixture(scope="module")
def silver(clicks):
    return sessionise(clicks)


def table(df):
    return {r[0]: r.asDict() for r in df.collect()}


def test_session_stats(silver):
    rows = table(session_stats(silver))
    assert set(rows) == {"a_1", "a_2", "b_1"}
    first = rows["a_1"]
    assert first["start_time"] == dt.datetime(2024, 1, 1, 10)
    assert first["end_time"] == dt.datetime(2024, 1, 1, 10, 2, 5)
    assert (first["page_views"], first["duration_seconds"]) == (3, 125)
    assert (first["mobile_sessions"], first["chrome_sessions"]) == (1, 2)
    assert rows["a_2"]["duration_seconds"] == 0


def test_statistics_without_counters(silver):
    assert session_stats(silver, counters={}).columns == [
        "unique_session_id",
        "end_time",
        "start_time",
        "page_views",
        "duration_seconds",
    ]


def test_gold_columns_order_and_types(silver):
    df = gold(silver)
    assert df.columns == [
        "unique_session_id",
        "end_time",
        "start_time",
        "page_views",
        "mobile_sessions",
        "chrome_sessions",
        "duration_seconds",
        "confirmation",
        "home",
        "payment_failed",
        "search",
        "order_placed",
    ]
    assert {t for _, t in df.dtypes[3:]} == {"bigint"}


@pytest.mark.parametrize("stages", [STAGES, None, [], ["home", "never reached"]])
def test_gold_variants_are_equal(clicks, silver, stages):
    want = gold(silver, stages)
    for other in (gold_pivot_join(silver, stages), gold_from_events(clicks, stages)):
        assert other.columns == want.columns
        assert table(other) == table(want)


def test_gold_variants_keep_events_without_a_user(spark):
    rows = [(1, None, "2024-01-01", "home", None, None), (2, "u", "2024-01-01", "home", None, None)]
    clicks = spark.createDataFrame(rows, SCHEMA)
    silver = sessionise(clicks)
    for df in (gold(silver), gold_pivot_join(silver), gold_from_events(clicks)):
        assert set(table(df)) == {"1", "u_1"}


def test_session_windows_need_a_positive_timeout(clicks):
    with pytest.raises(ValueError):
        gold_from_events(clicks, STAGES, gap_seconds=0)


def test_an_extra_stage_is_counted_when_events_have_it(silver):
    rows = table(gold(silver, STAGES))
    assert rows["b_1"]["payment_failed"] == 1 and rows["b_1"]["order_placed"] == 0


def test_many_stages_take_the_pivot(silver):
    many = STAGES + [f"page {i}" for i in range(MAX_COUNTED_STAGES)]
    rows = table(gold(silver, many))
    assert rows["a_1"]["home"] == 2 and rows["a_1"]["page 7"] == 0
    assert table(funnel_matrix(silver, many))["a_1"]["home"] == 2


def test_funnel_matrix(silver):
    df = funnel_matrix(silver, STAGES)
    assert df.columns == ["unique_session_id", *STAGES, "payment_failed", "order_placed"]
    assert list(table(df)["a_1"].values())[1:] == [2, 0, 1, 0, 0]


def test_stage_names_with_dots_and_quotes(spark):
    pages = ["a.b", "c`d", "e f", "ä"]
    rows = [(i, "u", "2024-01-01", p, None, None) for i, p in enumerate(pages)]
    silver = sessionise(spark.createDataFrame(rows, SCHEMA))
    for df in (gold(silver), gold_pivot_join(silver)):
        assert df.columns[7:11] == sorted(pages)
        assert df.first()[7:11] == (1, 1, 1, 1)
    report = funnel_report(gold(silver), pages).collect()
    assert [(r.stage, r.sessions) for r in report] == [(p, 1) for p in pages]


def test_discovered_stages_are_sorted(silver):
    assert discover_stages(silver) == ["confirmation", "home", "payment_failed", "search"]


@pytest.mark.parametrize("stage", ["page_views", "Duration_Seconds", "session_id", "home"])
def test_colliding_stage_names_are_refused(silver, stage):
    for variant in (gold, gold_pivot_join, gold_from_events):
        with pytest.raises(ValueError):
            variant(silver, ["home", stage])


def test_missing_values_count_nowhere(spark):
    rows = [(1, "u", "2024-01-01", None, None, None), (2, "u", "2024-01-01", "home", None, None)]
    row = gold(sessionise(spark.createDataFrame(rows, SCHEMA)), ["home"]).first()
    assert (row.page_views, row.mobile_sessions, row.chrome_sessions, row.home) == (1, 0, 0, 1)


def test_funnel_report(silver):
    df = gold(silver, STAGES)
    zero = funnel_report(df, ["home", "checkout", "confirmation"]).collect()
    assert [tuple(r) for r in zero] == [
        (1, "home", 1, 100.0 / 3),
        (2, "checkout", 0, 0.0),
        (3, "confirmation", 1, 100.0 / 3),
    ]
    skip = funnel_report(df, ["home", "checkout", "confirmation"], missing="skip").collect()
    assert [(r.stage_no, r.stage) for r in skip] == [(1, "home"), (2, "confirmation")]
    assert funnel_report(df, ["checkout"], missing="skip").collect() == []
    assert total_sessions(df).first()[0] == 3
    with pytest.raises(ValueError):
        funnel_report(df, missing="none")


def test_reports_without_sessions(silver):
    df = gold(silver.limit(0), STAGES)
    assert [(r.sessions, r.pct) for r in funnel_report(df, ["home"]).collect()] == [(0, None)]
    assert total_sessions(df).first()[0] == 0
    assert duration_density(df).count() == 0
    bins = duration_histogram(df).collect()
    assert len(bins) == 30 and sum(r.sessions for r in bins) == 0
    assert (bins[0].lo, bins[29].hi) == (0.0, 1.0)
    assert conversion_by(silver.limit(0), "device").count() == 0


def test_a_session_counts_under_every_value_it_has(silver):
    found = conversion_by(silver, "device").collect()
    rows = {r.device: (r.sessions, r.converted, r.rate) for r in found}
    assert rows == {
        "Mobile": (2, 1, 50.0),
        "Desktop": (1, 1, 100.0),
        None: (1, 1, 100.0),
        "Tablet": (1, 0, 0.0),
    }
    other = conversion_by(silver, "browser", "search").collect()
    assert {(r.browser, r.sessions, r.converted) for r in other} == {
        ("Chrome", 1, 0),
        ("Edge", 2, 1),
        (None, 1, 0),
    }


def test_conversion_by_hour(silver):
    rows = conversion_by_hour(gold(silver, STAGES)).collect()
    assert {(r.hour, r.sessions, r.converted, r.rate) for r in rows} == {
        (10, 1, 1, 100.0),
        (11, 2, 0, 0.0),
    }


def durations(spark, values):
    return spark.createDataFrame([(v,) for v in values], "duration_seconds bigint")


@pytest.mark.parametrize("unit, per", [("seconds", 1), ("minutes", 60)])
@pytest.mark.parametrize(
    "values", [[5, 5, 5], [0], list(range(0, 900, 7)) + [900] * 4, [0, 30, 60, 61, 3000]]
)
def test_histogram_equals_numpy(spark, values, unit, per):
    counts, edges = np.histogram(np.array(values) / per, 30)
    rows = duration_histogram(durations(spark, values), unit=unit).collect()
    assert [r.bin for r in rows] == list(range(30))
    assert [r.sessions for r in rows] == counts.tolist()
    assert np.allclose([r.lo for r in rows] + [rows[-1].hi], edges)


def test_equal_durations_fall_in_the_middle_and_the_maximum_in_the_last_bin(spark):
    equal = duration_histogram(durations(spark, [9, 9])).collect()
    assert [r.bin for r in equal if r.sessions] == [15]
    wide = duration_histogram(durations(spark, [0, 300])).collect()
    assert [r.bin for r in wide if r.sessions] == [0, 29]


def test_density_equals_the_formula(spark):
    values = [0, 0, 10, 40, 41, 300]
    d, n = np.array(values, float), len(values)
    h = d.std(ddof=1) * n ** (-1 / 5)
    rows = duration_density(durations(spark, values)).collect()
    xs = np.linspace(0, 300, 200)
    kernel = np.exp(-0.5 * ((xs[:, None] - d[None, :]) / h) ** 2).sum(axis=1)
    want = kernel / (h * math.sqrt(2 * math.pi)) * (300 / 30)
    assert np.allclose([r.x for r in rows], xs)
    assert np.allclose([r.density for r in rows], want)


def test_page_views_add_up_to_the_events(clicks, silver):
    assert sum(r.page_views for r in gold(silver).collect()) == clicks.count()


def test_discovered_pages_get_columns_of_their_own():
    pages = ["A", "a", "page_a", "page_views", "User_ID"]
    assert stage_columns(sorted(pages), {}) == {
        "A": "A",
        "User_ID": "page_User_ID",
        "a": "page_page_a",
        "page_a": "page_a",
        "page_views": "page_page_views",
    }


@pytest.mark.parametrize("n", [MAX_COUNTED_STAGES, MAX_COUNTED_STAGES + 1])
def test_both_plans_for_many_stages_give_the_same_rows(spark, clicks, n):
    stages = [s for s in FUNNEL_STAGES] + [f"p{i}" for i in range(n - len(FUNNEL_STAGES))]
    silver = sessionise(clicks, 21_600)
    rows = gold(silver, stages, extras=[])
    other = gold_pivot_join(silver, stages, extras=[])
    assert rows.columns == other.columns and len(rows.columns) == 7 + n
    assert rows.exceptAll(other).count() == 0 and other.exceptAll(rows).count() == 0
    again = gold_from_events(clicks, stages, 21_600, extras=[])
    assert rows.exceptAll(again).count() == 0 and again.count() == rows.count()
