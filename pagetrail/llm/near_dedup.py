"""Near-duplicate documents: banded MinHash, odd sketches, and a check on the full sets.

Every distinct shingle set gets MinHash samples. Runs of some of them (bands) put similar
sets into common buckets; many more, one of each part of the hash range, are folded into
a parity bitmap (an odd sketch). The number of bits in which two bitmaps differ tells
whether a pair can be similar enough to be worth reading both texts. Copies are collapsed first and a bucket's sets are compared with one
of them; only pairs that may still join two components are then looked at, so a group
of copies costs a number of comparisons in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import lists, slices
from pagetrail.llm.components import components
from pagetrail.llm.hashing import mix, run_hashes, set_id, word_hashes
from pagetrail.llm.text import LOWER, as_bytes
from pagetrail.sources.scratch import scratch_table, text_files

SHINGLE = 5
ROWS, BANDS = 5, 40  # at a similarity of 0.8 a pair shares no band once in 8 million cases
SAMPLES = ROWS * BANDS
PARTS = 12  # the odd sketch has a sample of each of 2 ** PARTS parts of the hash range
BITS = 4096
ROUNDS = 1  # of looking for links to other components before all pairs left are checked
SKETCHES_PER_FILE = 20_000  # about half a kilobyte each, some tens of MB for a task that joins two
PAIRS_PER_TASK = 2_000
DEVIATIONS = 5.0  # by which a pair may differ more than expected and still be checked

_RANDOM = np.random.Generator(np.random.PCG64(85))
_FACTORS = (_RANDOM.integers(0, 2**31, SAMPLES, np.uint32) * 2 + 1).astype(np.uint32)[:, None]
_SHIFTS = _RANDOM.integers(0, 2**32, SAMPLES, np.uint32)[:, None]
_BAND_STEPS = _RANDOM.integers(0, 2**63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words; of the whole text if it has fewer."""
    return np.unique(run_hashes(word_hashes(text.translate(LOWER)), SHINGLE))


def samples(members: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set: the smallest value under each of the functions."""
    values = (members >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(values), 1024):
        part = _FACTORS * values[start : start + 1024] + _SHIFTS
        np.minimum(lowest, part.min(axis=1), out=lowest)
    return lowest


def bands(lowest: np.ndarray) -> np.ndarray:
    numbered = (lowest.reshape(BANDS, ROWS) * _BAND_STEPS).sum(axis=1, dtype=np.uint64)
    return mix(numbered + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def part_samples(members: np.ndarray) -> np.ndarray:
    """The smallest member in each part of the hash range that has one; members are sorted."""
    part = members >> np.uint64(64 - PARTS)
    return members[np.flatnonzero(np.diff(part, prepend=np.uint64(1 << PARTS)))]


def odd_sketch(drawn: np.ndarray) -> np.ndarray:
    """The samples hashed to bits; a bit is set if it is hit an odd number of times, so
    the samples that two sets have in common cancel out in the XOR."""
    at = (mix(drawn) % np.uint64(BITS)).astype(np.int64)
    parity = (np.bincount(at, minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def _limit(percent: int) -> Column:
    """The most bits in which the sketches of a pair of ``percent`` hundredths may differ.

    At similarity s the union has ``(n_a + n_b) / (1 + s)`` members, which fill about m
    parts, and about ``s * m`` samples are common. The parts that each set fills vary
    together with m, so they are expected numbers too, and those of two sets of equal
    size, which fill most. The samples that are not common set an expected number of
    bits; a pair may have more by five standard deviations. These come from drawing m of
    the union's members without replacement, and from samples that fall on one bit.
    """
    s, all_parts = percent / 100, 1 << PARTS
    members = F.col("n_a") + F.col("n_b")
    union = members / (1 + s)
    filled = all_parts * (1 - F.exp(-union / all_parts))
    apart = 2 * all_parts * (1 - F.exp(-members / (2 * all_parts))) - 2 * s * filled
    decay = F.exp(-4 * apart / BITS)
    odd = BITS / 2 * (1 - F.sqrt(decay))
    from_samples = decay * 4 * filled * s * (1 - s) * (1 - filled / union)
    from_bits = BITS / 4 * (1 - decay - 4 * apart / BITS * decay)
    return odd + 2 + DEVIATIONS * F.sqrt(F.greatest(F.lit(0.0), from_samples + from_bits))


def _promising(percent: int) -> Column:
    """Whether the pair's sizes and sketches allow a similarity of ``percent`` hundredths."""
    differ = [
        F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i]))
        for i in range(BITS // 64)
    ]
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & (reduce(lambda a, b: a + b, differ) <= _limit(percent))


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text_hash``, ``n_shingles``, ``set_id``, ``bands``, half of each
    band's bits (``codes``) and ``sketch``."""
    source = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        as_bytes(F.col(text)).alias("_text"),
    )
    schema = T.StructType(
        [
            source.schema["key"],
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_id", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
            T.StructField("sketch", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            sets = [shingles(t) for t in batch.column("_text").to_pylist()]
            lowest, drawn = [samples(s) for s in sets], [part_samples(s) for s in sets]
            n, keys = len(sets), np.concatenate([bands(x) for x in lowest])
            arrays = [
                batch.column("key"),
                batch.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_id(s) for s in sets], pa.binary()),
                lists(keys, np.full(n, BANDS), pa.int64()),
                lists(keys.astype(np.int32), np.full(n, BANDS), pa.int32()),
                lists(
                    np.concatenate([odd_sketch(x) for x in drawn]),
                    np.full(n, BITS // 64),
                    pa.int64(),
                ),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)


def _side(sketches: DataFrame, side: str) -> DataFrame:
    names = {"set_id": side, "n_shingles": f"n_{side}"}
    names |= {c: f"{c}_{side}" for c in sketches.columns if c not in names}
    return sketches.withColumnsRenamed(names)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose full sets are similar enough."""
    sides = [
        texts.select(F.col("set_id").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"
    ]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b")
    schema = T.StructType([T.StructField(c, T.BinaryType()) for c in "ab"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "text_a"), "text_b"):
            similar, last, last_set = [], None, None
            rows = zip(
                *(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b")), strict=True
            )
            for b, text_a, text_b in rows:
                if b != last:  # one set is often compared with many
                    last, last_set = b, shingles(text_b)
                one = shingles(text_a)
                shared = len(np.intersect1d(one, last_set, assume_unique=True))
                union = len(one) + len(last_set) - shared
                similar.append(100 * shared >= percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(similar))

    return both.mapInArrow(run, schema)


def _with_component(node: DataFrame, labels: DataFrame) -> DataFrame:
    """Set ids and their components; a set that is linked with nothing is its own."""
    return node.join(labels, node["key"] == labels["node"], "left").select(
        "set_id", F.coalesce("component", "key").alias("component")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` for each row.

    Rows are linked if their sets of five-word shingles have a Jaccard similarity of at
    least ``percent`` (80 or more) hundredths; rows of one key are one document.
    ``component_id`` is the smallest key reachable. Without words (null or empty text) a
    row is linked with nothing. A row without a key takes no part: its component is null
    and it is kept. Repeated rows get one answer each; an empty table gives none.
    """
    if percent < 80:
        raise ValueError("the bands are made for similarities of 0.8 and more")
    rows = scratch_table(signatures(docs, key, text), "signatures")
    linked = rows.filter((F.col("n_shingles") > 0) & F.col("key").isNotNull())
    columns = ("key", "text_hash", "n_shingles", "bands", "codes", "sketch")
    first = F.min(F.struct(*columns)).alias("x")
    classes = scratch_table(
        linked.groupBy("set_id").agg(first).select("set_id", "x.*"),
        "classes",
        rows.count(),
        SKETCHES_PER_FILE,
    )
    n_classes = classes.count()
    most = BANDS * n_classes  # places of sets in buckets

    buckets = classes.select(
        "set_id", F.col("key").alias("class_key"), F.posexplode("bands").alias("number", "band")
    )
    shared = buckets.groupBy("band").agg(
        F.min(F.struct("class_key", "set_id")).alias("first"), F.count("*").alias("n")
    )
    shared = scratch_table(
        shared.filter("n > 1").select("band", F.col("first.set_id").alias("b")), "buckets", most // 2
    )
    members = scratch_table(
        buckets.join(shared, "band").select("number", "band", "b", F.col("set_id").alias("a")),
        "members",
        most,
    )
    sketches = classes.select("set_id", "n_shingles", "sketch")

    def closest(candidates: DataFrame) -> DataFrame:
        """Of each set's candidates the one it shares most bands with, if it may be similar."""
        counted = candidates.groupBy("a", "b").agg(F.count("*").alias("n"))
        best = counted.groupBy("a").agg(F.max(F.struct("n", "b")).alias("x")).select("a", "x.b")
        best = best.join(_side(sketches, "a"), "a").join(_side(sketches, "b"), "b")
        return best.filter(_promising(percent)).select("a", "b")

    wanted = members.select(F.col("a").alias("set_id")).distinct()
    wanted = wanted.join(classes.select("set_id", "key", "text_hash"), "set_id")
    bodies = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        as_bytes(F.col(text)).alias("text"),
    )
    found = bodies.join(wanted, ["key", "text_hash"]).select("set_id", "text")
    if not rows.groupBy("key", "text_hash").count().filter("count > 1").isEmpty():
        found = found.dropDuplicates(["set_id"])  # repeated rows
    texts = scratch_table(found.coalesce(text_files(docs, text)), "candidate-texts")

    node = classes.select("set_id", "key")
    ends = [
        node.select(F.col("set_id").alias(side), F.col("key").alias(end))
        for side, end in (("a", "src"), ("b", "dst"))
    ]

    def links(pairs: DataFrame, at_most: int | None = None) -> DataFrame:
        """The edges that the pairs give which are similar, written by a task for some pairs."""
        pairs = scratch_table(pairs, "pairs", at_most, SKETCHES_PER_FILE)
        found = _verified(pairs, texts, percent).join(ends[0], "a").join(ends[1], "b")
        return scratch_table(found.select("src", "dst"), "links", pairs.count(), PAIRS_PER_TASK)

    # Rows of one key with different texts are one document.
    firsts = linked.select("key", "set_id").join(
        node.withColumnRenamed("key", "first"), "set_id"
    )
    torn = firsts.groupBy("key").agg(F.min("first").alias("src"), F.max("first").alias("last"))
    torn = firsts.join(torn.filter("src <> last").select("key", "src"), "key")
    same = torn.select("src", F.col("first").alias("dst")).filter("src <> dst").distinct()

    def in_mixed_buckets(labels: DataFrame) -> DataFrame:
        """Members, with components, of the buckets that hold more than one component."""
        labelled = _with_component(node, labels).withColumnRenamed("set_id", "a")
        placed = members.join(labelled, "a").select("number", "band", "a", "component")
        ends = placed.groupBy("band").agg(
            F.min(F.struct("component", "a")).alias("low"),
            F.max(F.struct("component", "a")).alias("high"),
        )
        return placed.join(ends.filter("low.component < high.component"), "band")

    # Each set against one of the first in its buckets, then of another component.
    first = closest(members.filter("a <> b").select("a", "b"))
    edges = links(first, n_classes).union(same)
    edges = scratch_table(edges, "links", n_classes + rows.count())
    labels = components(edges)
    for _ in range(ROUNDS):
        other = F.when(F.col("component") == F.col("low.component"), F.col("high.a"))
        found = closest(
            in_mixed_buckets(labels).select("a", other.otherwise(F.col("low.a")).alias("b"))
        )
        found = links(found, n_classes)
        if found.isEmpty():
            break
        edges = edges.union(found)
        labels = components(edges)

    # All pairs of a bucket whose sets are still in different components.
    mixed = in_mixed_buckets(labels).select("number", "band", "a", "component")
    full = classes.select(*sketches.columns, "codes")
    undecided = mixed.withColumnRenamed("a", "set_id").join(full, "set_id")
    undecided = scratch_table(undecided, "undecided", members.count(), SKETCHES_PER_FILE)
    left, right = _side(undecided, "a"), _side(undecided, "b")
    on = (F.col("band_a") == F.col("band_b")) & (F.col("component_a") < F.col("component_b"))
    on &= _promising(percent)
    # Each pair once, in the first bucket it shares.
    equal = F.zip_with("codes_a", "codes_b", lambda x, y: x == y)
    on &= F.array_position(equal, True) == F.col("number_a") + 1
    more = links(left.join(right, on).select("a", "b"))
    if not more.isEmpty():
        labels = components(edges.union(more))

    nodes = _with_component(node, labels)
    answered = rows.select("key", "n_shingles", "set_id").join(nodes, "set_id", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("key").isNotNull(), F.col("component"))
    return answered.select(
        F.col("key").alias(key),
        "n_shingles",
        F.coalesce(component, F.col("key")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
