"""Fingerprints of documents by a randomised edit embedding.

A walk over the characters of a text stays on a character or moves on, by a random bit
for the step and the character that all texts share. Two texts that differ by few edits
fall back into the same steps soon after each edit, so the characters seen at equal steps
agree nearly everywhere: edit distance becomes Hamming distance. A fingerprint has one
bit of the character seen at each of some steps, 128 in every doubling of the length, and
the share of differing bits, weighted by the steps they stand for, estimates the
distance of the whole walks. Near texts are found by bands of sampled bits and verified
by whole fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import lists, slices
from pagetrail.llm.components import components
from pagetrail.llm.hashing import mix
from pagetrail.sources.scratch import scratch_table

PHASES = 256  # steps after which the shared random bits start again
PER_OCTAVE = 128  # steps sampled in each doubling of the length
OCTAVES = 40
CHUNK = 1 << 16  # characters walked over at a time
BANDS, BAND_BITS = 64, 40  # at a likeness of 0.9 a pair shares no band once in 6,000 cases
LEAST_LIKENESS = 0.9

_RANDOM = np.random.Generator(np.random.PCG64(13))
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _moves() -> list[bytes]:
    """For each class of characters and phase, the phase after the step that moves on."""
    bits = _RANDOM.integers(0, 2, (256, PHASES), np.uint8)
    tables = []
    for row in bits:
        row[_RANDOM.integers(0, PHASES)] = 1  # so that every walk moves on some time
        ones = np.flatnonzero(row)
        at = np.searchsorted(ones, np.arange(PHASES))
        tables.append(bytes(((np.append(ones, ones[0] + PHASES)[at] + 1) % PHASES).tolist()))
    return tables


_MOVES = _moves()


def _sampled_steps() -> tuple[np.ndarray, np.ndarray]:
    """The sampled steps in order, one of each equal part of an octave, and the parts' sizes."""
    steps, weights = [np.arange(PER_OCTAVE)], [np.ones(PER_OCTAVE, np.int64)]
    for octave in range(OCTAVES):
        part = 1 << octave
        first = (PER_OCTAVE << octave) + part * np.arange(PER_OCTAVE)
        steps.append(first + _RANDOM.integers(0, part, PER_OCTAVE))
        weights.append(np.full(PER_OCTAVE, part))
    return np.concatenate(steps), np.concatenate(weights)


STEPS, WEIGHTS = _sampled_steps()
_REACH = np.concatenate([[0], np.cumsum(WEIGHTS)])
_BAND_PLACES = np.stack(
    [_RANDOM.choice(2 * PER_OCTAVE, BAND_BITS, replace=False) for _ in range(BANDS)]
)
_BAND_FACTORS = _RANDOM.integers(0, 2**63, BAND_BITS, np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Walk:
    """The code points of a text, and the phase after each of them."""

    codes: np.ndarray
    classes: bytes
    phases: bytes


def _walk(classes: bytes, phase: int = 0) -> bytes:
    parts = []
    for start in range(0, len(classes), CHUNK):
        part = bytes([phase := _MOVES[c][phase] for c in classes[start : start + CHUNK]])
        parts.append(part)
    return b"".join(parts)


def walk(text: str) -> Walk:
    """One pass over the whole text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = codes.astype(np.uint8)
    far = np.flatnonzero(codes >= 128)
    classes[far] = mix(codes[far].astype(np.uint64)) >> np.uint64(56)
    return Walk(codes, classes.tobytes(), _walk(classes.tobytes()))


def edited(one: Walk, other: Walk) -> Walk:
    """The walk over ``one`` with its last half replaced by the beginning of ``other``.

    The half is rounded down; of a shorter ``other`` all is taken. What is before it is
    walked over as it was.
    """
    half = len(one.codes) // 2
    left = len(one.codes) - half
    classes, codes = other.classes[:half], other.codes[:half]
    more = _walk(classes, one.phases[left - 1] if left else 0)
    return Walk(
        np.concatenate([one.codes[:left], codes]),
        one.classes[:left] + classes,
        one.phases[:left] + more,
    )


def text_of(walked: Walk) -> str:
    return walked.codes.tobytes().decode("utf-32-le", "surrogatepass")


def sampled_bits(walked: Walk) -> np.ndarray:
    """A bit of the character seen at each sampled step that the walk reaches."""
    phases = np.frombuffer(walked.phases, np.uint8)
    seen, begun, before = [], 0, np.uint8(0)
    for start in range(0, len(phases), CHUNK):
        part = phases[start : start + CHUNK]
        taken = np.diff(part, prepend=before).astype(np.int64)  # modulo 256, as the phases
        taken[taken == 0] = PHASES
        upto = begun + np.cumsum(taken)
        low, high = np.searchsorted(STEPS, [begun, upto[-1]])
        seen.append(walked.codes[start + np.searchsorted(upto, STEPS[low:high], side="right")])
        begun, before = upto[-1], part[-1]
    if not seen:
        return np.empty(0, np.uint8)
    codes = np.concatenate(seen).astype(np.uint64)
    mixed = mix(codes * _SALT + STEPS[: len(codes)].astype(np.uint64))
    return (mixed & np.uint64(1)).astype(np.uint8)


def fingerprint(bits: np.ndarray) -> str:
    """The number of bits and the bits themselves, in hexadecimal."""
    return f"{len(bits):x}:{np.packbits(bits).tobytes().hex()}"


def bits_of(text: str) -> np.ndarray:
    """The bits of a fingerprint."""
    count, digits = text.split(":")
    return np.unpackbits(np.frombuffer(bytes.fromhex(digits), np.uint8))[: int(count, 16)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 minus the estimated share of steps at which the walks see different characters.

    Different characters have equal bits half of the time, so a differing bit counts
    twice. Steps that only one walk reaches are different; two empty texts are alike.
    """
    common, most = sorted((len(a), len(b)))
    if not most:
        return 1.0
    apart = 2 * int(WEIGHTS[:common][a[:common] != b[:common]].sum())
    return max(0.0, 1.0 - (apart + int(_REACH[most] - _REACH[common])) / int(_REACH[most]))


def band_keys(bits: np.ndarray) -> np.ndarray:
    """Bands of sampled bits of the last two whole octaves, and of those one lower.

    So two texts whose lengths lie on both sides of a doubling have bands in common.
    Texts of less than two octaves have one band, of all their bits.
    """
    whole = len(bits) // PER_OCTAVE
    if whole < 2:
        padded = np.append(bits, [1]).astype(np.uint64)
        factors = mix(np.arange(1, len(padded) + 1, dtype=np.uint64))
        return mix((padded * factors).sum(dtype=np.uint64)[None]).view(np.int64)
    keys = []
    for top in {whole, max(2, whole - 1)}:
        part = bits[(top - 2) * PER_OCTAVE : top * PER_OCTAVE].astype(np.uint64)
        numbered = np.uint64(top * BANDS) + np.arange(BANDS, dtype=np.uint64)
        sums = (part[_BAND_PLACES] * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
        keys.append(mix(sums + mix(numbered)))
    return np.concatenate(keys).view(np.int64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_chars`` (code points) and ``fingerprint`` of every whole text.

    A null text counts as empty and has no bits. Repeated rows get one answer each; other
    columns are left out. No shuffle.
    """
    source = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("_text"))
    schema = T.StructType(
        [
            T.StructField(key, source.schema["key"].dataType),
            T.StructField("n_chars", T.LongType()),
            T.StructField("fingerprint", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            walks = [walk(t) for t in batch.column("_text").to_pylist()]
            arrays = [
                batch.column("key"),
                pa.array([len(w.codes) for w in walks], pa.int64()),
                pa.array([fingerprint(sampled_bits(w)) for w in walks], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)


_EDITED = [
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
]


def _answer(key, one: Walk, bits: np.ndarray, other: Walk, other_bits: np.ndarray) -> tuple:
    changed = edited(one, other)
    changed_bits = sampled_bits(changed)
    digest = hashlib.sha256(text_of(changed).encode("utf-8", "surrogatepass")).hexdigest()
    return (
        key,
        len(one.codes),
        digest,
        fingerprint(bits),
        fingerprint(changed_bits),
        likeness(bits, changed_bits),
        likeness(bits, other_bits),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def edited_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document.

    Documents follow one another by falling ``key``, those without one last, equal keys by
    a hash of their texts; after the last comes the first. In the edited text the last half
    of the code points, rounded down, is replaced by the first as many of the next document,
    or by all of it where it is shorter. Null texts count as empty; a table of one row
    is its own next; repeated rows get one answer each. Other columns are left out.

    Texts are shuffled once, into ranges of keys. Within a range neighbours meet as
    rows go by; of each range only the first and the last text are written, and these,
    two for a partition, are brought together afterwards.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    source = docs.select(
        F.col(key).alias("key"),
        F.coalesce(text, F.lit("")).alias("_text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("_hash"),
    )
    order = [F.col("key").desc_nulls_last(), F.col("_hash")]
    ranges = source.repartitionByRange(*order, F.monotonically_increasing_id())
    ranges = ranges.sortWithinPartitions(*order).select(
        "key", "_text", F.spark_partition_id().alias("_part")
    )
    schema = T.StructType(
        [
            source.schema["key"],
            *_EDITED,
            T.StructField("part", T.IntegerType()),
            T.StructField("place", T.StringType()),  # first and last rows have their texts
            T.StructField("text", T.StringType()),
        ]
    )
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = part = None
        nothing = (None,) * len(_EDITED)
        for batch in slices(batches, "_text"):
            rows = []
            for key_, whole in zip(
                batch.column("key").to_pylist(), batch.column("_text").to_pylist(), strict=True
            ):
                walked = walk(whole)
                bits = sampled_bits(walked)
                if last is None:
                    part = batch.column("_part")[0].as_py()
                    rows.append((key_, *nothing, part, "first", whole))
                else:
                    rows.append((*_answer(*last, walked, bits), None, None, None))
                last = (key_, walked, bits)
            yield _batch(rows, shape)
        if last is not None:
            yield _batch([(last[0], *nothing, part, "last", text_of(last[1]))], shape)

    found = scratch_table(ranges.mapInArrow(run, schema), "fingerprints")
    inner = found.filter("place is null").select("key", *[f.name for f in _EDITED])

    ends = found.filter("place is not null").select("key", "part", "place", "text")
    parts = sorted(r.part for r in ends.filter("place = 'last'").select("part").collect())
    following = list(zip(parts, parts[1:] + parts[:1], strict=True))  # a pair per partition
    after = docs.sparkSession.createDataFrame(following, "part int, next_part int")
    firsts = ends.filter("place = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text")
    )
    borders = ends.filter("place = 'last'").join(after, "part").join(firsts, "next_part")
    borders = borders.select("key", "text", "next_text")
    answers = T.StructType([source.schema["key"], *_EDITED])
    answers_shape = to_arrow_schema(answers)

    def at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "text"), "next_text"):
            for row in batch.to_pylist():
                one, other = walk(row["text"]), walk(row["next_text"])
                answer = _answer(
                    row["key"], one, sampled_bits(one), other, sampled_bits(other)
                )
                yield _batch([answer], answers_shape)

    whole = inner.unionByName(borders.mapInArrow(at_borders, answers))
    return whole.withColumnRenamed("key", key)


def _verified(pairs: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of fingerprints that are alike enough."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "ab"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "a"), "b"):
            sides = [[bits_of(x) for x in batch.column(c).to_pylist()] for c in "ab"]
            alike = [likeness(a, b) >= least for a, b in zip(*sides, strict=True)]
            yield batch.filter(pa.array(alike, pa.bool_()))

    return pairs.select("a", "b").mapInArrow(run, schema)


def near_documents(
    docs: DataFrame, least: float = LEAST_LIKENESS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``fingerprint`` and ``class_id``, the smallest key that links lead to.

    Two documents are linked if their fingerprints share a band and are at least ``least``
    alike (0.9 or more). Equal fingerprints are one class from the start. Each class is
    compared with the first in its bands; then, of what is left in a band, all pairs whose
    classes are still apart. A row without a key takes no part, and its class is null; a
    text without bits, null or empty, is linked with nothing.
    """
    if least < LEAST_LIKENESS:
        raise ValueError(f"the bands are made for a likeness of {LEAST_LIKENESS} and more")
    rows = scratch_table(fingerprints(docs, key, text), "fingerprints")
    rows = rows.select(F.col(key).alias("key"), "fingerprint")
    linked = rows.filter(F.col("key").isNotNull() & (F.col("fingerprint") != "0:"))
    classes = scratch_table(
        linked.groupBy("fingerprint").agg(F.min("key").alias("first")), "print-classes"
    )
    schema = "fingerprint string, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "fingerprint"):
            keys = [band_keys(bits_of(x)) for x in batch.column("fingerprint").to_pylist()]
            sizes = np.array([len(k) for k in keys])
            bands = lists(np.concatenate(keys), sizes, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("fingerprint"), bands], ["fingerprint", "bands"]
            )

    prints = classes.select("fingerprint").mapInArrow(run, schema)
    members = prints.select("fingerprint", F.explode("bands").alias("band"))
    members = scratch_table(members.join(classes, "fingerprint"), "bands")
    heads = members.groupBy("band").agg(
        F.min(F.struct("first", "fingerprint")).alias("head"), F.count("*").alias("n")
    )
    heads = heads.filter("n > 1").select("band", F.col("head.fingerprint").alias("b"))

    # Rows of one key are one document: their classes are linked by it.
    again = linked.join(classes, "fingerprint").filter(F.col("key") != F.col("first"))
    torn = again.select(F.col("key").alias("src"), F.col("first").alias("dst"))

    def edges_of(pairs: DataFrame) -> DataFrame:
        src = classes.select(F.col("fingerprint").alias("a"), F.col("first").alias("src"))
        dst = classes.select(F.col("fingerprint").alias("b"), F.col("first").alias("dst"))
        return pairs.join(src, "a").join(dst, "b").select("src", "dst")

    stars = members.join(heads, "band").select(F.col("fingerprint").alias("a"), "b")
    stars = stars.filter("a <> b").distinct()
    edges = scratch_table(edges_of(_verified(stars, classes, least)).union(torn), "links")
    labels = components(edges)

    placed = members.join(labels, F.col("first") == F.col("node"), "left").select(
        "band", "fingerprint", F.coalesce("component", "first").alias("component")
    )
    mixed = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_rows = placed.join(mixed.filter("low < high"), "band").select(
        "band", "fingerprint", "component"
    )
    open_rows = scratch_table(open_rows, "open-bands")
    left = open_rows.toDF("band", "a", "of_a")
    right = open_rows.toDF("band", "b", "of_b")
    rest = left.join(right, "band").filter("of_a < of_b").select("a", "b").distinct()
    more = scratch_table(edges_of(_verified(rest, classes, least)), "links")
    if not more.isEmpty():
        labels = components(edges.union(more))
    named = linked.select("key").distinct().join(labels, F.col("key") == F.col("node"), "left")
    named = named.select(
        F.col("key").alias("named"), F.coalesce("component", "key").alias("class_id")
    )
    return rows.join(named, F.col("key") == F.col("named"), "left").select(
        F.col("key").alias(key),
        "fingerprint",
        F.coalesce("class_id", "key").alias("class_id"),
    )
