"""Runs of lines that occur earlier in the corpus are deleted, found by winnowing.

A window is the shortest run of lines from a line onwards, or back from a line, that has
``min_words`` words. Its fingerprint is the smallest of its lines' hashes, so equal
windows have equal fingerprints, and of the many windows few distinct fingerprints
remain. Only windows whose fingerprint occurs at two places are compared by content.
Every repeated run of ``min_words`` words or more is made of windows from its first line
on and back from its last, so together they extend over all of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import slices
from pagetrail.llm.hashing import mix
from pagetrail.llm.text import as_bytes
from pagetrail.sources.scratch import scratch_table

MIN_WORDS = 50

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)

WINDOW_FIELDS = "fingerprint long, at int, content_1 long, content_2 long, start int, stop int"


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


def windows(text: bytes, min_words: int = MIN_WORDS) -> list[tuple[int, ...]]:
    """(fingerprint, its line, 128 bits of content, first line, last line) of each window.

    Lines without a word belong to no window but may lie inside one.
    """
    numbers, hashes, words = [], [], []
    for number, line in enumerate(text.split(b"\n")):
        if n := len(line.split()):
            numbers.append(number)
            words.append(n)
            hashes.append(hashlib.blake2b(line, digest_size=16).digest())
    upto = np.cumsum([0, *words])
    n = len(words)
    if not n or upto[-1] < min_words:
        return []
    lines = np.arange(n)
    last = np.searchsorted(upto, upto[:-1] + min_words) - 1
    first = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
    forward, back = lines[last < n], lines[first >= 0]
    runs = np.concatenate(
        [np.stack([forward, last[forward]], 1), np.stack([first[back], back], 1)]
    )
    runs = np.unique(runs, axis=0)
    starts, stops = runs[:, 0], runs[:, 1]
    parts = np.frombuffer(b"".join(hashes), np.uint64).reshape(n, 2)
    contents = []
    for part, base, inverse in zip(parts.T, _BASES, _INVERSES, strict=True):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * _powers(base, n))])
        run = (sums[stops + 1] - sums[starts]) * _powers(inverse, n)[starts]
        contents.append(mix(run + (stops - starts).astype(np.uint64)).view(np.int64).tolist())
    order = mix(parts[:, 0]).view(np.int64)
    found = []
    for a, b, c, d in zip(starts.tolist(), stops.tolist(), *contents, strict=True):
        at = a + int(order[a : b + 1].argmin())
        found.append((int(order[at]), numbers[at], c, d, numbers[a], numbers[b]))
    return found


def _identity(key: Column, text: Column) -> Column:
    """Sorts rows by key, those without one last; equal for equal rows."""
    return F.struct(
        key.isNull().alias("no_id"), key.alias("id"), F.xxhash64(text).alias("text_hash")
    )


def _windows(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    source = docs.select(
        _identity(F.col(key), F.col(text)).alias("row"), as_bytes(F.col(text)).alias("_text")
    )
    fields = T._parse_datatype_string(WINDOW_FIELDS).fields
    schema = T.StructType([source.schema["row"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = [windows(t, min_words) for t in batch.column("_text").to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
            columns = list(zip(*(w for one in found for w in one), strict=True))
            if columns:
                kinds = [pa.int64() if f.dataType == T.LongType() else pa.int32() for f in fields]
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                rows = batch.column("row").take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([rows, *arrays], schema.names)

    return source.mapInArrow(run, schema)


def repeated_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``row`` and the ``runs`` [first, last] of its lines that occur earlier.

    Earlier is a smaller key, or the same document further up without overlap. Only
    rows with such runs are returned.
    """
    found = scratch_table(_windows(docs, key, text, min_words), "windows")
    most = found.count()
    places = found.groupBy("fingerprint").agg(
        F.min(F.struct("row", "at")).alias("low"), F.max(F.struct("row", "at")).alias("high")
    )
    # Written, so that adaptive execution can split a hot key of the join below.
    shared = scratch_table(places.filter("low <> high").select("fingerprint"), "shared", most)
    candidates = scratch_table(
        found.join(shared, "fingerprint").drop("fingerprint", "at"), "shared-windows", most
    )
    content = ["content_1", "content_2"]
    span = F.struct("row", "start", "stop")
    firsts = candidates.groupBy(content).agg(F.min(span).alias("first"), F.max(span).alias("last"))
    firsts = scratch_table(firsts.filter("first <> last").select(*content, "first"), "firsts", most)
    later = candidates.join(firsts, content).filter(
        (F.col("row") != F.col("first.row")) | (F.col("start") > F.col("first.stop"))
    )
    return later.groupBy("row").agg(
        F.collect_set(F.array("start", "stop")).alias("runs")  # at most two for each line
    )


def _without_runs(text: bytes, runs: list[list[int]]) -> tuple[bytes, int, int]:
    lines = text.split(b"\n")
    change = np.zeros(len(lines) + 1, np.int64)
    for start, stop in runs:
        change[start] += 1
        change[stop + 1] -= 1
    gone = np.cumsum(change[:-1]) > 0
    left = [line for line, g in zip(lines, gone.tolist(), strict=True) if not g]
    return b"\n".join(left), len(lines), int(gone.sum())


def remove_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """All rows with ``text`` without its repeated runs, and ``n_lines``, ``n_removed``.

    A run of whole lines with at least ``min_words`` words that occurs in a document
    with a smaller key, or further up in the same one, is deleted; the first occurrence
    stays. Rows that are equal in key and text count as one document and are all treated
    alike; rows without a key come after all others. A null text stays null, with no
    lines; a text that consists of repeated runs becomes empty. Input columns called
    ``n_lines`` or ``n_removed`` are replaced, all others stay as they are.
    """
    runs = repeated_runs(docs, key, text, min_words)
    runs = runs.select(
        F.col("row.id").alias("_id"),
        F.col("row.text_hash").alias("_hash"),
        F.col("runs").alias("_runs"),
    )
    rows = docs.drop("n_lines", "n_removed")
    same = F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_hash"))
    joined = rows.join(runs, same, "left").drop("_id", "_hash")
    counts = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed")]
    schema, columns = T.StructType([*rows.schema.fields, *counts]), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts, sizes, removed = [], [], []
            column = batch.column(text)
            pairs = zip(column.to_pylist(), batch.column("_runs").to_pylist(), strict=True)
            for whole, gone in pairs:
                left, n, cut = whole, 0, 0
                if whole is not None:
                    left, n, cut = _without_runs(whole.encode(), gone or [])
                    left = left.decode() if cut else whole
                texts.append(left)
                sizes.append(n)
                removed.append(cut)
            arrays = [
                pa.array(texts, column.type) if c == text else batch.column(c) for c in columns
            ]
            arrays += [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return joined.mapInArrow(run, schema)
