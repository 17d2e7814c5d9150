"""Runs over a growing log: equal to one run, reading nothing that is closed."""

from __future__ import annotations

import datetime as dt
import json
import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagetrail.__main__ import main
from pagetrail.operators.carry_over import carried_on, late_events, no_carry, sessions_with_carry
from pagetrail.operators.sessions import sessionise
from pagetrail.operators.sparse import sparse_gold
from pagetrail.plans import increments as inc
from pagetrail.sources.layers import write_days
from pagetrail.sources.quarantine import read_quarantine, reason_counts, replay, still_rejected

START = dt.datetime(2024, 3, 1)
DAYS = [dt.date(2024, 3, d) for d in range(1, 6)]
PAGES = ["home", "search", "confirmation", "page_views", "a`b"]
SILVER = [
    "user_id", "event_time", "current_page", "prev_time", "time_diff_seconds", "is_new_session",
    "session_id", "unique_session_id",
]


def random_events(seed, users=6, n=400, days=5):
    """Events in bursts, many of them around midnight, some of one instant."""
    rnd, rows = random.Random(seed), []
    for _ in range(n):
        user = f"u{min(rnd.randrange(users), rnd.randrange(users))}"
        second = rnd.randrange(days) * 86_400 + rnd.choice(
            [rnd.randrange(0, 3000), rnd.randrange(86_400 - 3000, 86_400), rnd.randrange(86_400)]
        )
        time = START + dt.timedelta(seconds=min(second, days * 86_400 - 1))
        for _ in range(rnd.choice([1, 1, 1, 2])):
            rows.append((user, str(time), rnd.choice(PAGES), rnd.choice(["Mobile", None])))
    return rows


def write_log(path, rows):
    path.mkdir(parents=True, exist_ok=True)
    with open(path / "part.json", "w") as file:
        for user, time, page, device in rows:
            line = {"user_id": user, "event_time": time, "current_page": page, "device": device}
            file.write(json.dumps(line) + "\n")
    return str(path)


def delivered(spark, tmp_path, rows, name="log"):
    root = str(tmp_path / f"root-{name}")
    inc.ingest_days(spark, write_log(tmp_path / name, rows), root, name)
    return root


def rows_of(df, columns=None):
    return sorted((tuple(map(str, r)) for r in df.select(*(columns or df.columns)).collect()))


def gold_rows(df):
    entries = F.array_sort(F.map_entries("hits")).cast("string").alias("hits")
    return rows_of(df.select(*[c for c in df.columns if c not in ("hits", "day")], entries))


def one_run(spark, root, gap):
    events = inc.read_bronze_days(spark, root, None, DAYS[-1])
    return sessionise(events, gap, tie=inc.EVENT_KEY, tie_is_unique=True)


@pytest.mark.parametrize(
    ("seed", "gap", "ends"),
    [
        (1, 900, [DAYS[1], DAYS[4]]),
        (2, 900, DAYS),
        (3, 30_000, [DAYS[0], DAYS[3], DAYS[4]]),
        (4, 200_000, DAYS),  # a session may be open for days
    ],
)
def test_runs_over_parts_equal_one_run(spark, tmp_path, seed, gap, ends):
    root = delivered(spark, tmp_path, random_events(seed))
    for upto in ends:
        inc.run_increment(spark, root, upto, gap)
    whole = one_run(spark, root, gap)
    silver = inc.read_silver(spark, root)
    assert rows_of(silver, SILVER) == rows_of(whole, SILVER)
    assert gold_rows(inc.read_gold(spark, root)) == gold_rows(sparse_gold(whole))
    days = silver.groupBy("unique_session_id").agg(
        F.countDistinct("day").alias("n"), F.min(F.to_date("event_timestamp")).alias("first"),
        F.min("day").alias("day"),
    )
    assert days.filter("n <> 1 or first <> day").isEmpty()


def test_busy_users_in_a_run(spark, tmp_path):
    root = delivered(spark, tmp_path, random_events(5, users=2))
    for upto in DAYS:
        inc.run_increment(spark, root, upto, 900, max_user_rows=20)
    assert rows_of(inc.read_silver(spark, root), SILVER) == rows_of(one_run(spark, root, 900), SILVER)


def test_second_run_reads_nothing_closed(spark, tmp_path):
    root = delivered(spark, tmp_path, random_events(6))
    inc.run_increment(spark, root, DAYS[2], 900)
    bare = tmp_path / "bare"
    for part in ("carry", "_increments", "corrections"):
        shutil.copytree(Path(root) / part, bare / part)
    for day in DAYS[3:]:
        shutil.copytree(Path(root) / f"bronze/day={day}", bare / f"bronze/day={day}")
    for folder in (root, str(bare)):
        inc.run_increment(spark, folder, DAYS[4], 900)
    for layer in ("silver", "gold", "carry"):
        found = [spark.read.parquet(f"{f}/{layer}/upto={DAYS[4]}") for f in (root, bare)]
        assert rows_of(found[0].withColumn("x", F.lit(1)).drop("hits")) == rows_of(
            found[1].withColumn("x", F.lit(1)).drop("hits")
        )


def test_carry_is_a_row_per_user(spark, tmp_path):
    root = delivered(spark, tmp_path, random_events(7))
    for upto in DAYS:
        inc.run_increment(spark, root, upto, 900)
        carry = spark.read.parquet(f"{root}/carry/upto={upto}")
        seen = inc.read_bronze_days(spark, root, None, upto).select("user_id").distinct()
        assert rows_of(carry.select("user_id")) == rows_of(seen)
        assert carry.filter("open and hits is null or not open and hits is not null").isEmpty()


def test_a_run_again_replaces_itself_only(spark, tmp_path):
    rows = random_events(8)
    root = delivered(spark, tmp_path, rows)
    for upto in DAYS:
        inc.run_increment(spark, root, upto, 900)
    before = rows_of(inc.read_silver(spark, root), SILVER)
    again = inc.run_increment(spark, root, DAYS[2], 900)
    assert not again.carry_changed
    assert rows_of(inc.read_silver(spark, root), SILVER) == before

    # A corrected delivery of the third day, with which a user has one session more.
    day = [r for r in rows if r[1].startswith(str(DAYS[2]))]
    day.append(("u0", f"{DAYS[2]} 12:34:56", "home", None))
    untouched = {f: f.stat().st_mtime_ns for f in Path(root).glob("bronze/day=2024-03-0[1245]/*")}
    inc.ingest_days(spark, write_log(tmp_path / "again", day), root, "again")
    assert untouched == {f: f.stat().st_mtime_ns for f in untouched}
    repeated = inc.refresh(spark, root, DAYS[2], gap_seconds=900)
    assert [r.upto for r in repeated][0] == DAYS[2]
    whole = one_run(spark, root, 900)
    assert rows_of(inc.read_silver(spark, root), SILVER) == rows_of(whole, SILVER)
    assert gold_rows(inc.read_gold(spark, root)) == gold_rows(sparse_gold(whole))
    # The last run of an unchanged day leaves the same carry, and nothing after it is repeated.
    assert [r.upto for r in inc.refresh(spark, root, DAYS[1], gap_seconds=900)] == [DAYS[1]]


def test_a_stopped_run_is_hidden(spark, tmp_path, monkeypatch):
    root = delivered(spark, tmp_path, random_events(9))
    inc.run_increment(spark, root, DAYS[1], 900)
    before = rows_of(inc.read_silver(spark, root), SILVER)

    def fails(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(inc, "carried_on", fails)
    with pytest.raises(RuntimeError):
        inc.run_increment(spark, root, DAYS[3], 900)
    assert inc.increments(spark, root) == [DAYS[1]]
    assert rows_of(inc.read_silver(spark, root), SILVER) == before


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold"])
def test_a_day_filter_prunes_folders(spark, tmp_path, layer):
    root = delivered(spark, tmp_path, random_events(10))
    inc.run_increment(spark, root, DAYS[4], 900)
    read = {"bronze": inc.read_bronze, "silver": inc.read_silver, "gold": inc.read_gold}[layer]
    day = read(spark, root).filter(F.col("day") == F.lit(DAYS[3]))
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("PartitionFilters: [")[1:]]
    assert filters and "day#" in filters[0].split("]")[0]
    files = {r.f for r in day.select(F.input_file_name().alias("f")).distinct().collect() if r.f}
    assert files and all(f"day={DAYS[3]}" in f or "/carry/" in f for f in files)


def test_nothing_yet(spark, tmp_path):
    root = delivered(spark, tmp_path, [])
    with pytest.raises(LookupError):
        inc.read_gold(spark, root)
    assert inc.run_increment(spark, root, DAYS[0]).upto == DAYS[0]
    assert inc.read_gold(spark, root).count() == inc.read_silver(spark, root).count() == 0


def test_late_events(spark):
    carry = no_carry(spark)
    row = ("u", 3, dt.datetime(2024, 3, 1, 12), False, None, None, None, None, None, None)
    carry = carry.union(spark.createDataFrame([row], carry.schema))
    times = [dt.datetime(2024, 3, 1, h) for h in (11, 12, 13)]
    events = spark.createDataFrame(
        [("u", t) for t in times] + [("v", times[0])], "user_id string, event_timestamp timestamp"
    )
    assert [tuple(r) for r in late_events(events, carry).collect()] == [("u", times[0])]


def test_an_open_session_without_new_events_closes(spark):
    sessions = sessionise(
        spark.createDataFrame(
            [("u", "2024-03-01 23:50:00", "home", None, None)],
            "user_id string, event_time string, current_page string, device string, browser string",
        )
    )
    midnight = F.lit("2024-03-02").cast("timestamp")
    first = sessions_with_carry(sessions, no_carry(spark), midnight)
    assert [r.closed for r in first.collect()] == [False]
    carry = carried_on(first, no_carry(spark))
    later = sessions_with_carry(sessions.limit(0), carry, F.lit("2024-03-03").cast("timestamp"))
    assert [(r.closed, r.page_views, r.hits) for r in later.collect()] == [(True, 1, {"home": 1})]
    after = carried_on(later, carry).collect()
    assert [(r.user_id, r.session_id, r.open, r.hits) for r in after] == [("u", 1, False, None)]


LINES = [
    '{"user_id":"a","event_time":"2024-03-01 10:00:00","current_page":"home"}',
    '{"event_time":"2024-03-01 10:00:00","current_page":"home"}',
    '{"event_time":"2024-03-01 10:00:00"}',
    '{"user_id":"b","event_time":"soon","current_page":"home"}',
    '{"event_time":"soon"}',
    "{broken",
    "{}",
]


@pytest.fixture
def dirty(spark, tmp_path):
    (tmp_path / "dirty").mkdir()
    (tmp_path / "dirty" / "a.json").write_text("\n".join(LINES) + "\n")
    root = str(tmp_path / "root")
    inc.ingest_days(spark, str(tmp_path / "dirty"), root, "dirty")
    return root


def test_every_reason_is_kept(spark, dirty):
    counts = {r.reason: r.events for r in reason_counts(read_quarantine(spark, dirty)).collect()}
    assert counts == {
        "malformed": 1,
        "missing user_id": 4,
        "missing event_time": 1,
        "missing current_page": 3,
        "unparsable event_time": 2,
    }
    assert inc.read_bronze(spark, dirty).count() == 1
    broken = read_quarantine(spark, dirty).filter("_corrupt_record is not null").first()
    assert broken._corrupt_record == "{broken" and broken.log == "dirty"


def test_replay_is_idempotent(spark, dirty):
    rejected = read_quarantine(spark, dirty)
    fixed = rejected.filter("_corrupt_record is null and event_time is not null").withColumns(
        {
            "user_id": F.coalesce("user_id", F.lit("x")),
            "current_page": F.coalesce("current_page", F.lit("search")),
        }
    )
    whole = lambda: rows_of(inc.read_bronze_days(spark, dirty, None, DAYS[4]))
    bad = replay(fixed, dirty)
    assert [r.reasons for r in bad.collect()] == [["unparsable event_time"]] * 2
    once = whole()
    assert len(once) == 3 and still_rejected(spark, dirty).count() == 4
    replay(fixed, dirty)
    replay(fixed.limit(0), dirty)
    assert whole() == once
    # Another correction of the same rows puts them on another day, and on no other.
    moved = fixed.withColumn("event_time", F.lit("2024-03-04 08:00:00"))
    assert replay(moved, dirty).isEmpty()
    assert [r[1][:10] for r in whole()] == ["2024-03-01"] + ["2024-03-04"] * 4
    # Keys that nothing was rejected under are not taken.
    replay(moved.withColumn("event_key", F.lit("other/1")), dirty)
    assert len(whole()) == 5
    inc.run_increment(spark, dirty, DAYS[4])
    assert inc.read_silver(spark, dirty).count() == 5


def test_a_new_delivery_drops_its_corrections(spark, tmp_path, dirty):
    rejected = read_quarantine(spark, dirty).filter("size(reasons) = 1 and user_id is null")
    replay(rejected.filter("current_page is not null").withColumn("user_id", F.lit("x")), dirty)
    assert inc.read_bronze_days(spark, dirty, None, DAYS[4]).count() == 2
    inc.ingest_days(spark, str(tmp_path / "dirty"), dirty, "dirty")
    assert inc.read_bronze_days(spark, dirty, None, DAYS[4]).count() == 1
    with pytest.raises(ValueError):
        inc.ingest_days(spark, str(tmp_path / "dirty"), dirty, "../up")


def test_command_line(spark, tmp_path, capsys):
    root, log = str(tmp_path / "root"), write_log(tmp_path / "log", random_events(11, n=40))
    assert main(["deliver", log, root, "first"]) == 0
    for day in (DAYS[0], DAYS[4], DAYS[4]):
        assert main(["advance", root, str(day)]) == 0
    assert inc.increments(spark, root) == [DAYS[0], DAYS[4]]
    assert "unique_session_id" in capsys.readouterr().out
    late = [("new", f"{DAYS[0]} 23:59:59", "home", None)]
    inc.ingest_days(spark, write_log(tmp_path / "late", late), root, "late")
    assert main(["advance", root, str(DAYS[0])]) == 0
    assert f"repeat the run up to {DAYS[4]}" in capsys.readouterr().out


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(400_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
        F.when(F.col("id") % 100 == 0, F.lit("2024-03-02")).otherwise("2024-03-01").cast("date").alias("day"),
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        write_days(rows, str(tmp_path / "days"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "days").glob("day=*")}
    assert files["day=2024-03-01"] > 4 and files["day=2024-03-02"] <= 2
    assert spark.read.parquet(str(tmp_path / "days")).count() == 400_000
