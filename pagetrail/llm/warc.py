"""WARC archives, and a two-level index of their captures.

Archives are plain WARC 1.1 files written by Spark's text writer: a record is one row,
and what WARC puts after each record is the line separator. Captures are sorted by URL
key (reversed host, then the rest) and stored in compressed blocks; a sparse directory
has the first and last key of each block. A lookup binary-searches the directory, opens
the blocks found and then reads only the byte ranges of the records.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.sources.scratch import scratch_table

RECORDS_PER_FILE = 2000
WINDOW_BYTES = 1 << 20  # of an archive read at a time while its records are listed
BATCH_BYTES = 8 << 20  # of payloads held before they are passed on
CAPTURES_PER_BLOCK = 256
DIRECTORY_ROWS = 200_000  # rows of the directory that are searched, and broadcast, at a time
LEAST_SHARED_BYTES = 100  # payloads below are never stored as revisits
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"

CAPTURE = """page_id long, url string, kind string, digest string, refers_to long,
file string, offset long, length long"""


def _one_line(url: Column) -> Column:
    """As it stands in a header."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(page_id: Column, digest: Column) -> Column:
    hashed = F.md5(F.concat_ws("|", page_id.cast("string"), digest).cast("binary"))
    parts = [F.substring(hashed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One row ``record`` per page: a response with its payload, or a revisit without.

    Of pages with equal payloads of at least ``LEAST_SHARED_BYTES`` bytes the one with
    the smallest id is the response (pages without an id come last); repeated rows of
    that id are responses too. A null html is an empty payload.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    digest = F.sha2(payload.cast("binary"), 256)
    page = pages.select(
        F.col(key).cast("long").alias("page_id"),
        _one_line(F.col(url)).alias("url"),
        payload.alias("payload"),
        digest.alias("digest"),
    )
    firsts = (
        pages.filter(F.octet_length(payload) >= LEAST_SHARED_BYTES)
        .groupBy(digest.alias("_digest"))
        .agg(F.min(F.col(key).cast("long")).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1 and _first is not null")
        .drop("_n")
    )
    # Written, so that its size is known: where few payloads repeat, it is broadcast and
    # no payload is shuffled.
    firsts = scratch_table(firsts, "shared-payloads")
    found = page.join(firsts, page["digest"] == firsts["_digest"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        header("WARC-Refers-To", F.when(revisit, _record_id(F.col("_first"), F.col("digest")))),
        header("X-Page-ID", F.col("page_id").cast("string")),
        header("X-Refers-To-Page", F.when(revisit, F.col("_first").cast("string"))),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
        F.col("block"),
    )
    return found.withColumn("block", block).select(record.alias("record"))


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """Archives of at most ``RECORDS_PER_FILE`` records each, in a new folder."""
    rows = records(pages, key, url, html)
    writer = rows.write.option("lineSep", END).option("compression", "none")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def _headers(data: bytes, at: int) -> dict[str, str]:
    lines = data.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at byte {at}")
    return dict(line.split(": ", 1) for line in lines[1:])


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one whole record."""
    stop = data.index(b"\r\n\r\n") + 4
    headers = _headers(data[: stop - 4], 0)
    end = stop + int(headers["Content-Length"])
    if data[end:] != b"\r\n\r\n":
        raise ValueError("the record does not end where it says")
    return headers, data[stop:end]


def listed(file, size: int) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(offset, length, headers) of each record of an archive, read in windows.

    Blocks that do not fit the window are skipped, not read, so memory does not depend on
    the size of records or archives.
    """
    at, start, window = 0, 0, b""
    while at < size:
        stop, more = -1, WINDOW_BYTES
        while stop < 0:
            if start <= at < start + len(window):
                stop = window.find(b"\r\n\r\n", at - start)
            if stop < 0:
                if start == at and len(window) == size - at:
                    raise ValueError(f"no record at byte {at}")
                if start == at and window:
                    more *= 2  # a header longer than the window
                window, start = file.read_at(min(more, size - at), at), at
        headers = _headers(window[at - start : stop], at)
        length = start + stop + 4 + int(headers["Content-Length"]) + 4 - at
        if at + length > size:
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, length, headers
        at += length


def body(block: bytes) -> bytes:
    """The body of the HTTP message in a record's block."""
    return block[block.index(b"\r\n\r\n") + 4 :]


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives in a folder, of which the headers are read.

    Spark lists the archives and deals them out by their sizes; tasks open them by byte
    ranges, so no archive and no payload is ever a row. The folder is one that the executors
    can open.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    schema = T._parse_datatype_string(CAPTURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_pylist()
            for path, size in zip(batch.column("path").to_pylist(), sizes, strict=True):
                rows = []
                for offset, length, headers in listed(_opened(path), size):
                    page, first = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page")
                    rows.append(
                        {
                            "page_id": None if page is None else int(page),
                            "url": headers.get("WARC-Target-URI"),
                            "kind": headers["WARC-Type"],
                            "digest": headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                            "refers_to": None if first is None else int(first),
                            "file": path,
                            "offset": offset,
                            "length": length,
                        }
                    )
                    if len(rows) == RECORDS_PER_FILE:
                        yield pa.RecordBatch.from_pylist(rows, arrow_schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow_schema)

    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    arrow_schema = pa.schema([(f.name, kinds[f.dataType]) for f in schema.fields])
    return files.select("path", "length").mapInArrow(run, schema)


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query``: pages of a host, and hosts of a domain, lie together."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    names = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.coalesce(F.concat(names, F.lit(")"), rest), F.lit(")"))


def write_index(found: DataFrame, folder: str) -> None:
    """The sorted captures in compressed blocks, and the sparse directory of these."""
    keyed = found.withColumn("key", url_key(F.col("url")))
    # The offset as well, so that captures of one URL may lie in several partitions.
    order = ("key", "file", "offset")
    keyed = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["key", *found.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def block(rows: list[dict]) -> pa.RecordBatch:
            lines = [json.dumps([r[n] for n in names]) for r in rows]
            data = zlib.compress("\n".join(lines).encode())
            columns = {
                "first_key": [rows[0]["key"]],
                "last_key": [rows[-1]["key"]],
                "n": [len(rows)],
                "block": [hashlib.md5(data).hexdigest()],
                "data": [data],
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= CAPTURES_PER_BLOCK:
                yield block(held[:CAPTURES_PER_BLOCK])
                held = held[CAPTURES_PER_BLOCK:]
        if held:
            yield block(held)

    schema = "first_key string, last_key string, n long, block string, data binary"
    spark = found.sparkSession
    keyed.mapInArrow(run, schema).write.parquet(f"{folder}/blocks")
    directory = spark.read.parquet(f"{folder}/blocks").drop("data")
    directory.repartitionByRange("first_key", "block").sortWithinPartitions(
        "first_key", "last_key"
    ).write.parquet(f"{folder}/directory")


def _unpacked(blocks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The captures in blocks, with their keys."""
    entry = T._parse_datatype_string("key string, " + CAPTURE)
    schema = T.StructType([*blocks.select(*keep).schema.fields, *entry.fields])
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    arrow = [kinds[f.dataType] for f in entry.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lines = zlib.decompress(batch.column("data")[i].as_py()).decode().split("\n")
                rows = list(zip(*map(json.loads, lines), strict=True))
                arrays = [batch.column(c).take(pa.array([i] * len(lines))) for c in keep]
                arrays += [pa.array(list(v), kind) for v, kind in zip(rows, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return blocks.select(*keep, "data").mapInArrow(run, schema)


def indexed_captures(spark: SparkSession, folder: str) -> DataFrame:
    """All captures of an index, in the order of their keys within each block."""
    return _unpacked(spark.read.parquet(f"{folder}/blocks")).drop("key")


def look_up(urls: DataFrame, folder: str, url: str = "url") -> DataFrame:
    """The captures of each of the given URLs, each URL once.

    The directory is searched in sorted parts of ``DIRECTORY_ROWS`` blocks, so it may be
    of any size; only blocks whose range holds a wanted key are read. URLs count by their
    keys: null ones and those without a host find the captures without one. A URL with no
    capture gives no row, nor does an empty index or an empty table; repeated rows are one.
    """
    spark = urls.sparkSession
    wanted = urls.select(url_key(F.col(url)).alias("wanted")).distinct()
    rows = spark.read.parquet(f"{folder}/directory").orderBy("first_key", "last_key", "block")
    parts, part = [], []
    for row in rows.select("first_key", "last_key", "block").toLocalIterator():
        part.append(tuple(row))
        if len(part) == DIRECTORY_ROWS:
            parts.append(_blocks_of(wanted, part))
            part = []
    parts.append(_blocks_of(wanted, part))
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.union(more)
    blocks = spark.read.parquet(f"{folder}/blocks").select("block", "data")
    needed = blocks.join(hits.select("block").distinct(), "block")
    found = _unpacked(needed, ("block",))
    exact = (found["block"] == hits["block"]) & (found["key"] == hits["wanted"])
    kept = [found[c] for c in found.columns if c not in ("block", "key")]
    return found.join(hits, exact).select(*kept)


def _blocks_of(wanted: DataFrame, directory: list[tuple[str, str, str]]) -> DataFrame:
    """(wanted, block) for the blocks whose keys reach from below to above a wanted key."""
    shared = wanted.sparkSession.sparkContext.broadcast(directory)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.array([d[0] for d in shared.value], object)
        last = np.array([d[1] for d in shared.value], object)
        for batch in batches:
            keys, blocks = [], []
            for key in batch.column("wanted").to_pylist():
                # Blocks are sorted and do not overlap but in single keys.
                low = np.searchsorted(last, key, side="left")
                high = np.searchsorted(first, key, side="right")
                keys += [key] * max(0, high - low)
                blocks += [shared.value[i][2] for i in range(low, high)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(blocks, pa.string())], ["wanted", "block"]
            )

    return wanted.mapInArrow(run, "wanted string, block string")


def _opened(path: str):
    """A file of the shared folder, by the URI that Spark gives for it."""
    uri = re.sub("^file:/(?!/)", "file:///", path)
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner)


def read_records(found: DataFrame) -> DataFrame:
    """The captures with ``payload`` (binary), read as byte ranges of the archives.

    Captures are sorted by place in the archive, and an archive's are read by one task,
    which holds payloads of some megabytes at a time, one at least. The folder is one that
    the executors can open.
    """
    source = found.repartition("file").sortWithinPartitions("file", "offset")
    schema = T.StructType([*found.schema.fields, T.StructField("payload", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            start, held, bodies = 0, 0, []
            for i, (path, offset, length) in enumerate(zip(*columns, strict=True)):
                if path != name:
                    name, file = path, _opened(path)
                _, block = parse(file.read_at(length, offset))
                bodies.append(body(block))
                held += length
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(start, len(bodies))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(bodies, pa.binary())], schema.names
                    )
                    start, held, bodies = i + 1, 0, []

    return source.mapInArrow(run, schema)


def read_back(
    pages: DataFrame, index: str, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """The pages as the archives have them: page_id, payload_bytes, payload_digest,
    record_type and refers_to. A revisit has the size of the response it stands for.

    Captures are found by looking the pages' URLs up in the index; a page without one is an
    error. Null URLs are found like others; repeated rows are a record each; an empty table
    gives no rows.
    """
    found = scratch_table(look_up(pages.select(_one_line(F.col(url)).alias("url")), index), "found")
    ids = pages.select(F.col(key).cast("long").alias("_id"))
    missed = ids.join(found, F.col("_id").eqNullSafe(F.col("page_id")), "left_anti")
    if not missed.isEmpty():
        raise LookupError(f"the index has no capture of page {missed.first()[0]} and maybe others")
    read = read_records(found).select(
        "page_id",
        F.col("kind").alias("record_type"),
        "refers_to",
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha2("payload", 256).alias("read_digest"),
        "digest",
    )
    read = scratch_table(read, "records")
    revisits = read.filter("record_type = 'revisit'")
    sizes = read.filter("record_type = 'response'").join(
        revisits.select(F.col("digest").alias("read_digest")).distinct(), "read_digest"
    )
    sizes = sizes.groupBy(F.col("read_digest").alias("digest")).agg(F.max("bytes").alias("size"))
    whole = revisits.join(sizes, "digest").select(
        "page_id",
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    plain = read.filter("record_type = 'response'").select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("read_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    return plain.union(whole)
