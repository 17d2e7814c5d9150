from __future__ import annotations

import hashlib
import random
import subprocess
import sys
from pathlib import Path

import pytest

from pagetrail.llm import warc
from pagetrail.sources.scratch import scratch_path

PAGES = "page_id long, url string, html string"


def pages(n=700):
    rnd = random.Random(8)
    shared = ["s" * 99, "s" * 100, "é" * 50, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 9, None, ""]
    rows = []
    for i in range(n):
        html = rnd.choice(shared) if rnd.random() < 0.5 else "x" * rnd.randrange(300) + str(i)
        url = rnd.choice(["http://a.example.com/p", "http://b.example.com/p?q=1", None, "no url"])
        rows.append((i, url if i % 3 else f"http://h{i % 11}.example.org/{i}", html))
    return rows


def archive(spark, rows):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, PAGES)
    folder, index = scratch_path(spark, "archives"), scratch_path(spark, "captures")
    warc.write_archives(df, folder)
    warc.write_index(warc.captures(spark, folder), index)
    return folder, index


@pytest.fixture(scope="module")
def archived(spark):
    patch = pytest.MonkeyPatch()
    patch.setattr(warc, "RECORDS_PER_FILE", 40)
    patch.setattr(warc, "CAPTURES_PER_BLOCK", 16)
    patch.setattr(warc, "DIRECTORY_ROWS", 5)
    yield pages(), *archive(spark, pages())
    patch.undo()


def expected(rows):
    first = {}
    for i, _, html in sorted(rows):
        first.setdefault(html or "", i)
    out = {}
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and first[html or ""] != i
        kind = "revisit" if again else "response"
        refers = first[html or ""] if again else None
        out[i] = (len(data), hashlib.sha256(data).hexdigest(), kind, refers)
    return out


def test_read_back_equals_the_pages(spark, archived):
    rows, _, index = archived
    got = warc.read_back(spark.createDataFrame(rows, PAGES), index).collect()
    assert {r["page_id"]: tuple(r)[1:] for r in got} == expected(rows) and len(got) == len(rows)


def test_payloads_come_back_whole(spark, archived):
    rows, _, index = archived
    html = {i: (h or "") for i, _, h in rows}
    read = warc.read_records(warc.indexed_captures(spark, index)).collect()
    assert len(read) == len(rows)
    for row in read:
        want = html[row["page_id"]] if row["kind"] == "response" else ""
        assert bytes(row["payload"]).decode() == want


def test_look_up_finds_all_captures_of_a_url(spark, archived):
    rows, _, index = archived
    wanted = ["http://a.example.com/p", "HTTP://A.example.com/p", "http://h3.example.org/3", "http://none/"]
    urls = spark.createDataFrame([(u,) for u in wanted], "url string")
    got = warc.look_up(urls, index).collect()
    want = {i for i, u, _ in rows if u in wanted}
    assert {r["page_id"] for r in got} == want and len(got) == len(want)
    assert all(r["length"] > 0 and r["file"] for r in got)


def test_blocks_are_sorted_and_the_directory_is_sparse(spark, archived):
    rows, _, index = archived
    directory = spark.read.parquet(f"{index}/directory").collect()
    ordered = sorted((r["first_key"], r["last_key"]) for r in directory)
    assert sum(r["n"] for r in directory) == len(rows) and len(directory) < len(rows) / 5
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:], strict=False))


def test_edges_and_empty(spark):
    rows = [
        (1, "http://x/\r\nWARC-Type: fake", "a" * 200),
        (1, "http://x/", "a" * 200),
        (2, "http://x/", "a" * 200),
        (None, None, "a" * 200),
        (None, None, None),
        (3, "", "é" * 200_000),
    ]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS payload", "2 AS digest", "3 AS block")
    _, index = archive(spark, df)
    got = warc.read_back(df, index).collect()
    kinds = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in got)
    assert kinds == sorted(
        [
            ("1", "response", "None"),
            ("1", "response", "None"),
            ("2", "revisit", "1"),
            ("None", "revisit", "1"),
            ("None", "response", "None"),
            ("3", "response", "None"),
        ]
    )
    assert {r["payload_bytes"] for r in got} == {200, 0, 400_000}
    nothing = spark.createDataFrame([], PAGES)
    _, none = archive(spark, nothing)
    assert warc.read_back(nothing, none).count() == 0
    assert warc.look_up(df, none).count() == 0 and warc.look_up(nothing, index).count() == 0
    assert warc.look_up(df.select("url").filter("url is null"), index).count() == 3
    with pytest.raises(LookupError):
        warc.read_back(spark.createDataFrame([(9, "http://elsewhere/", "")], PAGES), index)


class Held:
    """An archive in memory that notes what is read of it."""

    def __init__(self, data):
        self.data, self.most = data, 0

    def read_at(self, n, at):
        self.most = max(self.most, n)
        return self.data[at : at + n]


def record(i, size, url="http://x/"):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * size
    head = f"WARC/1.1\r\nWARC-Target-URI: {url}\r\nX-Page-ID: {i}\r\nContent-Length: {len(block)}"
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_listing_skips_what_does_not_fit_the_window(monkeypatch):
    monkeypatch.setattr(warc, "WINDOW_BYTES", 200)
    parts = [record(0, 10), record(1, 100_000), record(2, 0, "http://x/" + "y" * 900), record(3, 5)]
    file = Held(b"".join(parts))
    found = list(warc.listed(file, len(file.data)))
    assert [int(h["X-Page-ID"]) for _, _, h in found] == [0, 1, 2, 3]
    assert [file.data[at : at + n] for at, n, _ in found] == parts and file.most < 4000
    for broken in (file.data[:-9], file.data + b"more", b"no record\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.listed(Held(broken), len(broken)))
    with pytest.raises(ValueError):
        warc.parse(parts[0][:-1])


LARGE = """
import sys
from pyspark.sql import SparkSession, functions as F
from pagetrail.llm import warc
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "1800m").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
pages = spark.range(600, numPartitions=4).select(F.col("id").alias("page_id"),
    F.concat(F.lit("http://x.org/"), F.col("id") % 50).alias("url"),
    F.concat(F.repeat(F.lit("0123456789"), 100_000), F.col("id")).alias("html"))
warc.write_archives(pages, sys.argv[1] + "/archives")
warc.write_index(warc.captures(spark, sys.argv[1] + "/archives"), sys.argv[1] + "/index")
got = warc.read_back(pages, sys.argv[1] + "/index")
row = got.agg(F.count("*"), F.min("payload_bytes"), F.countDistinct("payload_digest")).first()
print("found", *row)
"""


def test_large_pages_on_a_small_heap(tmp_path):
    """600 pages of a megabyte, 150 of them in each archive, on a heap of 1,800 MB."""
    done = subprocess.run(
        [sys.executable, "-c", LARGE, str(tmp_path)],
        capture_output=True, text=True, timeout=300, cwd=Path(warc.__file__).parents[2],
    )
    assert "found 600 1000001 600" in done.stdout, done.stderr[-2000:]


def test_url_key(spark):
    df = spark.createDataFrame(
        [("https://WWW.a.com/X?y=1#z",), ("http://a.com",), ("nothing",), (None,)], "u string"
    )
    got = [r[0] for r in df.select(warc.url_key(df["u"])).collect()]
    assert got == ["com,a,www)/X?y=1#z", "com,a)", ")", ")"]
