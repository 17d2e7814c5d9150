"""Reading raw lines, layers, versions, exports and the layered run."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from types import SimpleNamespace

import pytest

from pagetrail.__main__ import main
from pagetrail.plans.layered_run import ingest, read_bronze, run_layers, show_reports
from pagetrail.schema import RAW_COLUMNS
from pagetrail.sources.layers import (
    export_csv,
    export_parquet,
    preview,
    read_csv,
    read_layer,
    read_layer_if_present,
    write_layer,
)
from pagetrail.sources.raw import read_raw_json, rejected_count, rejected_events, valid_events
from pagetrail.sources.runs import (
    claim_run,
    completed_runs,
    layer_path,
    mark_complete,
    next_run_id,
    read_as_of,
    remove_retired,
    retire_runs,
    run_as_of,
    run_path,
    table_diff,
)
from pagetrail.sources.scratch import BYTES_PER_FILE, scratch_path, scratch_table, text_files


GOLD_COUNTERS = {"page_views", "mobile_sessions", "chrome_sessions", "duration_seconds"}


def click(user="u", time="2024-01-01 10:00:00", page="home", **more):
    return json.dumps({"user_id": user, "event_time": time, "current_page": page, **more})


LINES = [
    click(url="https://myshop.com/home", browser="Chrome", device="Mobile"),
    click("v"),
    click(None),
    '{"user_id": "u", "current_page": "home"}',
    '{"user_id": "u", "event_time": "2024-01-01 10:00:00"}',
    "{not json",
    "",
    "[" + click("w") + "," + click("x") + "]",
    '{"user_id": 7, "event_time": "2024-01-01", "current_page": {"a":1}, "unknown": true}',
    click(""),
    click("y", "garbage"),
    click()[:-20],
]


@pytest.fixture
def log(tmp_path):
    path = tmp_path / "log.json"
    path.write_text("\n".join(LINES) + "\n")
    return str(path)


def test_raw_lines_are_split_exactly(spark, log):
    raw = read_raw_json(spark, log)
    assert raw.columns == RAW_COLUMNS + ["_corrupt_record"]
    good = {(r.user_id, r.event_time, r.current_page) for r in valid_events(raw).collect()}
    assert good == {
        ("u", "2024-01-01 10:00:00", "home"),
        ("v", "2024-01-01 10:00:00", "home"),
        ("w", "2024-01-01 10:00:00", "home"),
        ("x", "2024-01-01 10:00:00", "home"),
        ("7", "2024-01-01", '{"a":1}'),
        ("", "2024-01-01 10:00:00", "home"),
        ("y", "garbage", "home"),
    }
    bad = rejected_events(raw).collect()
    assert sorted(r._corrupt_record for r in bad if r._corrupt_record) == sorted(
        ["{not json", click()[:-20]]
    )
    assert len(bad) == 5
    assert tuple(rejected_count(raw).first()) == (12, 5)
    assert valid_events(raw).columns == RAW_COLUMNS


def test_ingest_writes_both_layers_in_one_pass(spark, log, tmp_path):
    root = str(tmp_path / "out")
    counts = ingest(spark, log, root, 1)
    assert (counts.events, counts.rejected) == (12, 5)
    bronze = read_bronze(spark, root, 1)
    assert bronze.columns == RAW_COLUMNS + ["event_id"]
    assert bronze.count() == bronze.select("event_id").distinct().count() == 7
    assert read_layer(spark, layer_path(root, 1, "bad_records")).count() == 5


def test_ingest_without_rejects_writes_no_quarantine(spark, tmp_path):
    (tmp_path / "log.json").write_text(click())
    root = str(tmp_path / "out")
    assert ingest(spark, str(tmp_path / "log.json"), root, 1).rejected == 0
    assert read_layer_if_present(spark, layer_path(root, 1, "bad_records")) is None


def test_run_without_valid_events(spark, tmp_path):
    (tmp_path / "log.json").write_text("{broken\n")
    root = str(tmp_path / "out")
    counts = run_layers(spark, str(tmp_path / "log.json"), root)
    assert (counts.events, counts.rejected) == (1, 1)
    assert read_as_of(spark, root, "gold").count() == 0
    assert {r.sessions for r in read_as_of(spark, root, "funnel").collect()} == {0}


def test_layered_run(spark, tmp_path, log):
    root = str(tmp_path / "out")
    run_layers(spark, log, root)
    gold = read_as_of(spark, root, "gold")
    assert gold.columns[7:] == ["home", '{"a":1}', "payment_failed", "order_placed"]
    silver = read_as_of(spark, root, "silver")
    assert silver.count() == 6 and gold.count() == 6
    assert [r.user_id for r in read_as_of(spark, root, "bad_times").collect()] == ["y"]
    assert read_as_of(spark, root, "session_metrics").count() == 6
    assert read_as_of(spark, root, "total_sessions").first()[0] == 6
    for report in ("conversion_by_device", "conversion_by_browser", "conversion_by_hour"):
        assert read_as_of(spark, root, report).count() > 0
    exports = {"bronze_csv": 7, "silver_csv": 6, "gold_csv": 6, "funnel_csv": 8}
    for name, rows in exports.items():
        path = f"{run_path(root, 1)}/export={name}"
        assert spark.read.option("header", True).csv(path).count() == rows
    assert read_layer(spark, f"{run_path(root, 1)}/export=gold_parquet").count() == 6


def test_a_run_with_given_stages_counts_what_the_reports_need(spark, tmp_path):
    lines = [click(page=p) for p in ("home", "confirmation", "payment_failed")]
    (tmp_path / "log.json").write_text("\n".join(lines))
    root = str(tmp_path / "out")
    run_layers(spark, str(tmp_path / "log.json"), root, stages=["home"])
    funnel = {r.stage: r.sessions for r in read_as_of(spark, root, "funnel").collect()}
    assert (funnel["home"], funnel["confirmation"], funnel["payment_failed"]) == (1, 1, 1)
    assert read_as_of(spark, root, "conversion_by_hour").first().converted == 1


def test_a_second_run_is_a_new_version(spark, tmp_path, log):
    root = str(tmp_path / "out")
    assert run_layers(spark, log, root, keep_null_times=False).run_id == 1
    (tmp_path / "other.json").write_text(click())
    assert run_layers(spark, str(tmp_path / "other.json"), root).run_id == 2
    assert read_as_of(spark, root, "silver").count() == 1
    assert read_layer_if_present(spark, layer_path(root, 2, "bad_times")) is None
    assert read_as_of(spark, root, "silver", 1).count() == 6
    with pytest.raises(ValueError):
        run_layers(spark, log, root, run_id=2)


def test_a_run_that_breaks_off_is_not_visible(spark, tmp_path, log, monkeypatch):
    root = str(tmp_path / "out")
    run_layers(spark, log, root)
    assert run_as_of(spark, root) == 1
    with monkeypatch.context() as patch:
        patch.setattr("pagetrail.plans.layered_run.gold", None)
        with pytest.raises(TypeError):
            run_layers(spark, log, root)
    assert run_as_of(spark, root) == 1
    assert read_as_of(spark, root, "gold").count() == 6
    assert run_layers(spark, log, root).run_id == 3


def test_dirty_pages_lose_no_event(spark, tmp_path):
    pages = ["home", "Home", "user_id", "page_views", "page_home", "a b", "x.y"]
    (tmp_path / "log.json").write_text("\n".join(click(page=p) for p in pages))
    root = str(tmp_path / "out")
    run_layers(spark, str(tmp_path / "log.json"), root)
    row = read_as_of(spark, root, "gold").first().asDict()
    stages = {c: n for c, n in row.items() if isinstance(n, int) and c not in GOLD_COUNTERS}
    assert sum(stages.values()) == row["page_views"] == len(pages)
    assert stages["Home"] == 1 and stages["page_page_home"] == 1


def test_command_line_on_a_log_without_valid_events(spark, tmp_path, capsys):
    (tmp_path / "log.json").write_text("{broken\n")
    assert main(["run", str(tmp_path / "log.json"), str(tmp_path / "out")]) == 0
    assert "1 events read, 1 rejected" in capsys.readouterr().out


def test_busy_users_change_no_layer(spark, tmp_path, log):
    plain, busy = str(tmp_path / "plain"), str(tmp_path / "busy")
    run_layers(spark, log, plain, max_user_rows=None, export_events=False)
    run_layers(spark, log, busy, max_user_rows=0, export_events=False)
    for layer in ("silver", "gold", "funnel"):
        a, b = read_as_of(spark, plain, layer), read_as_of(spark, busy, layer)
        a, b = (d.drop("event_id") for d in (a, b))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_null_times_can_be_kept(spark, tmp_path, log):
    root = str(tmp_path / "out")
    run_layers(spark, log, root, keep_null_times=True)
    assert read_as_of(spark, root, "silver").count() == 7
    assert read_layer_if_present(spark, layer_path(root, 1, "bad_times")) is None


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        run_as_of(spark, root)
    for run_id in (1, 4, 6):
        write_layer(spark.range(run_id), layer_path(root, run_id, "gold"))
        if run_id != 6:  # run 6 never finishes
            mark_complete(spark, root, run_id)
    found = [read_as_of(spark, root, "gold", n).count() for n in (1, 3, 4, 9, None)]
    assert found == [1, 1, 4, 4, 4]
    assert sorted(r.run_id for r in completed_runs(spark, root).collect()) == [1, 4]
    with pytest.raises(LookupError):
        run_as_of(spark, root, 0)


def test_starts_at_one_time_get_their_own_numbers(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: claim_run(spark, root), range(16)))
    assert sorted(numbers) == list(range(1, 17))
    assert next_run_id(spark, root) == 17 and completed_runs(spark, root).isEmpty()
    assert claim_run(spark, root, 3) == 3  # again after a failure
    mark_complete(spark, root, 3)
    with pytest.raises(ValueError):
        claim_run(spark, root, 3)


def test_retention_keeps_what_readers_see(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(5):
        n = claim_run(spark, root)
        write_layer(spark.range(n), layer_path(root, n, "gold"))
        if n != 4:  # still running
            mark_complete(spark, root, n)
    reader = read_as_of(spark, root, "gold", 2)
    assert retire_runs(spark, root, 2) == [1, 2]
    with pytest.raises(LookupError):
        run_as_of(spark, root, 2)
    assert remove_retired(spark, root, 3600) == [] and reader.count() == 2
    assert remove_retired(spark, root, 0) == [1, 2] and remove_retired(spark, root, 0) == []
    assert sorted(p.name for p in tmp_path.glob("run_id=*")) == ["run_id=3", "run_id=4", "run_id=5"]
    assert read_as_of(spark, root, "gold").count() == 5 and retire_runs(spark, root, 2) == []
    assert claim_run(spark, root) == 6
    with pytest.raises(ValueError):
        retire_runs(spark, root, 0)


def test_diff_of_tables(spark):
    schema = "k string, `a.b` long, m map<string,long>, x string"
    before = [("same", 1, {"p": 1, "q": 2}, "l"), ("gone", 1, {}, "l"), (None, 1, None, "l")]
    after = [("same", 1, {"q": 2, "p": 1}, "other"), ("new", 1, {}, ""), (None, None, None, "")]
    before += [("bag", 1, {}, ""), ("bag", 2, {}, ""), ("fewer", 1, {}, ""), ("fewer", 1, {}, "")]
    after += [("bag", 2, {}, ""), ("bag", 1, {}, ""), ("fewer", 1, {}, "")]
    before += [("null", None, {}, ""), ("map", 1, {"p": 1}, "")]
    after += [("null", 0, {}, ""), ("map", 1, {"p": 2}, "")]
    a = spark.createDataFrame(before, schema).drop("x")
    b = spark.createDataFrame(after, schema)
    found = {tuple(r) for r in table_diff(a, b, ["k"]).collect()}
    assert found == {
        ("gone", "removed"), ("new", "added"), (None, "changed"), ("fewer", "changed"),
        ("null", "changed"), ("map", "changed"),
    }
    assert table_diff(a, a, ["k", "a.b"]).isEmpty()
    with pytest.raises(ValueError):
        table_diff(a, b, ["x"])


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(spark.range(3), path)
    write_layer(spark.range(2).selectExpr("id AS other"), path, replace_schema=True)
    assert read_layer(spark, path).columns == ["other"] and read_layer(spark, path).count() == 2
    write_layer(spark.range(2), str(tmp_path / "orc"), "orc")
    assert read_layer(spark, str(tmp_path / "orc"), "orc").count() == 2


def test_exports(spark, tmp_path):
    df = spark.sql("SELECT 'a,\"b' AS s, 1L AS n, timestamp'2024-01-01 00:00:00.123456' AS t")
    export_csv(df, str(tmp_path / "csv"), parts=1)
    assert read_csv(spark, str(tmp_path / "csv"), df.schema).collect() == df.collect()
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    export_parquet(df, str(tmp_path / "parquet"))
    assert read_layer(spark, str(tmp_path / "parquet")).collect() == df.collect()
    assert preview(spark.range(100)).count() == 5


def test_csv_gives_back_every_text(spark, tmp_path):
    texts = [" home ", "\thome\t", "a\nb", "a\r\nb", "", None, "\\N", "\\E", "\\n", "a\\", '"', '""', ",", "'"]
    texts += ['a"b,c', "\\\\n", "null", "é\u3000", "# x", "\\\n"]
    rows = [(i, t, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "n long, `a\nb, \"c\\` string, s string")
    export_csv(df, str(tmp_path / "csv"))
    got = read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_a_missing_layer_is_none_and_other_errors_are_raised(spark, tmp_path):
    assert read_layer_if_present(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(Exception):
        read_layer_if_present(spark, str(tmp_path), "no-such-format")


class Context:
    """Just enough of a Spark context for a session without the setting."""

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, setting=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting or default),
        sparkContext=Context(master),
    )


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(session("spark://host", "/shared/"), "x").startswith("/shared/x-")
    assert scratch_table(spark.range(4), "x").count() == 4


def test_scratch_without_the_setting():
    local = session("local[2]")
    first, second = scratch_path(local, "x"), scratch_path(local, "x")
    assert first != second and Path(first).parent == Path(second).parent
    with pytest.raises(RuntimeError):
        scratch_path(session("spark://host"), "x")


def test_command_line(spark, log, tmp_path, capsys):
    root = str(tmp_path / "out")
    assert main(["report", root]) == 1
    assert main(["run", log, root, "--run-id", "2", "--stages", "home"]) == 0
    assert "12 events read, 5 rejected" in capsys.readouterr().out
    assert main(["report", root]) == 0
    assert "confirmation" in capsys.readouterr().out
    assert show_reports(spark, root, 1) is False


def test_scratch_tables_have_checksums_inside_and_no_side_files(spark):
    table = scratch_table(spark.range(1000, numPartitions=2), "x")
    folder = Path(table.inputFiles()[0].removeprefix("file:")).parent
    names = sorted(f.name for f in folder.iterdir())
    assert len(names) == 3 and names[0] == "_SUCCESS", names
    assert table.selectExpr("sum(id)").first()[0] == 499_500
    broken = folder / names[1]
    content = bytearray(broken.read_bytes())
    content[100] ^= 1  # within the values
    broken.write_bytes(content)
    with pytest.raises(Exception, match="(?i)checksum|crc"):
        table.selectExpr("sum(id)").collect()


def test_text_files_follow_the_bytes_and_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    texts = spark.range(1000).selectExpr("if(id % 2 = 0, 'abc', null) AS text")
    assert text_files(texts) == text_files(texts.limit(0)) == cores
    long = spark.range(20 * cores, numPartitions=cores).selectExpr(
        f"repeat('ü', {BYTES_PER_FILE // 20}) AS body"
    )
    assert text_files(long, "body") == 2 * cores
