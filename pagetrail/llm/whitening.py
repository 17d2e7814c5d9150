"""Whitening of embedding vectors by shifted CholeskyQR.

The centred rows A are never gathered. Each pass sends a factor of the size of one vector
by itself to the tasks, which add up the Gram matrix of their rows after the triangular
solves so far; the driver sees these small matrices only. The first Cholesky factor is
taken of the Gram matrix plus a shift, so it exists however nearly dependent the
dimensions are; later passes repeat until the rows are orthonormal. With A = Q R and the
SVD of the composed R = U S W', the components are the columns of W, their eigenvalues
S^2 / n, and the whitened rows Q U sqrt(n).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import lists, offsets

SCALE = 64.0
OFFSET = 1_000_000
COMPONENTS = 32
# A Gram matrix and a factor are held by every task and the driver: 32 MB at this many.
MAX_DIMENSIONS = 2048
MAX_PASSES = 12
ROUNDING = np.finfo(np.float64).eps / 2
# Rows count as orthonormal when no entry of their Gram matrix is further from the identity.
ORTHONORMAL = 1e-12
# A direction whose squared length stays below this after a solve has no variance.
NO_VARIANCE = 1e-9
# Without a shift, the shortest direction must be longer than this share of the longest.
SAFE = 1e-6
# Entries beyond this do not fit a long after scaling.
LARGEST = 2.0**52 / SCALE
SLICE_ENTRIES = 1 << 19

RESULTS = {
    "component": T.IntegerType(),
    "n": T.LongType(),
    "deviation": T.LongType(),
    "whitened": T.DoubleType(),
    "explained": T.DoubleType(),
    "identity_error": T.DoubleType(),
}


@dataclass(frozen=True)
class Whitening:
    """What the rows are centred and multiplied by, and what came out."""

    n: int
    sums: list[int]
    steps: list[tuple[str, np.ndarray]]
    turn: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    components: np.ndarray = field(repr=False)

    @property
    def count(self) -> int:
        return self.turn.shape[1]


def valid(vector: str) -> Column:
    """Whether the vector has entries, all of them finite and, scaled, within a long."""
    c = F.col(vector)
    sound = F.forall(c, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= LARGEST))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & sound, F.lit(False))


def whole_numbers(vector: str) -> Column:
    """The entries as longs: floor(64 * c) + 1000000, in doubles up to the floor."""
    return F.transform(
        F.col(vector), lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET
    )


def fit_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key`` and ``x`` of the rows that count.

    Left out are null and empty vectors, such with null or non-finite entries or entries
    beyond 2^46, and such with another number of entries than most of the others
    have (of equally frequent numbers the larger one is kept).
    """
    sound = vectors.filter(valid(vector))
    sizes = sound.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    most = sizes.agg(F.max(F.struct("n", "size")).alias("most")).first().most
    size = most.size if most else 0
    if size > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {size} entries; at most {MAX_DIMENSIONS} can be whitened")
    return sound.filter(F.size(vector) == size).select(
        F.col(key).alias("key"), whole_numbers(vector).alias("x")
    )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows as matrices of longs, in slices of a bounded number of entries."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = offsets(batch.column("x"))
        d = int(at[1] - at[0])
        values = batch.column("x").values.to_numpy(zero_copy_only=False)
        matrix = values[at[0] : at[-1]].reshape(-1, d)
        step = max(1, SLICE_ENTRIES // d)
        for start in range(0, len(matrix), step):
            yield batch.slice(start, step), matrix[start : start + step]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off exactly, before any rounding."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole) - part


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)^2 of each row, exact; null where it does not fit a long."""
    whole = np.array([s // n for s in sums], np.int64)
    left = np.array([s % n for s in sums], np.int64)
    apart = x - whole
    widest = int(np.abs(apart).max(initial=0)) * n + n
    if widest * widest * x.shape[1] < 2**63:
        away = apart * n - left
        return (away * away).sum(axis=1).tolist()
    totals = [
        sum((n * a - r) ** 2 for a, r in zip(row, left.tolist(), strict=True))
        for row in apart.tolist()
    ]
    return [t if t < 2**63 else None for t in totals]


def solve_upper(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows R^-1 by forward substitution, column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _apply(rows: np.ndarray, steps: list[tuple[str, np.ndarray]]) -> np.ndarray:
    for kind, matrix in steps:
        rows = solve_upper(rows, matrix) if kind == "solve" else rows @ matrix
    return rows


def _total(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of the tasks' matrices, given as (row, values); Spark adds them up."""
    cells = parts.select("row", F.posexplode("values").alias("column", "value"))
    summed = cells.groupBy("row", "column").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros((width, width))
    total[summed["row"].to_numpy(), summed["column"].to_numpy()] = summed["value"].to_numpy()
    return total


_PART = T.StructType(
    [T.StructField("row", T.IntegerType()), T.StructField("values", T.ArrayType(T.DoubleType()))]
)


def _gram(
    rows: DataFrame,
    n: int,
    sums: list[int],
    steps: list[tuple[str, np.ndarray]],
    width: int,
) -> np.ndarray:
    """Q'Q of the centred rows after the steps: one pass, one small matrix a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for _, x in _matrices(batches):
            q = _apply(_centred(x, n, sums), steps)
            gram += q.T @ q
        if gram.any():
            values = lists(gram.ravel(), np.full(width, width), pa.float64())
            numbers = pa.array(np.arange(width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([numbers, values], _PART.names)

    return _total(rows.select("x").mapInArrow(run, _PART), width)


def _shifted_cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper R with R'R = gram + shift."""
    return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T


def _places(rows: DataFrame) -> list:
    """Of each dimension the number of entries, their exact sum, the least and the most.

    Entries are added in pieces of 18 bits, whose sums fit longs for 2^45 rows.
    """
    fields = "place int, n long, high_bits long, mid_bits long, low_bits long, low long, high long"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches):
            low = np.int64((1 << 18) - 1)
            columns = [
                np.arange(x.shape[1], dtype=np.int32),
                np.full(x.shape[1], len(x)),
                (x >> 36).sum(axis=0),
                ((x >> 18) & low).sum(axis=0),
                (x & low).sum(axis=0),
                x.min(axis=0),
                x.max(axis=0),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    parts = rows.select("x").mapInArrow(run, fields)
    sums = [F.sum(c).alias(c) for c in ("n", "high_bits", "mid_bits", "low_bits")]
    total = parts.groupBy("place").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"))
    return total.orderBy("place").collect()  # a row per dimension


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``fit_rows``; None if there are none, or all are equal.

    Every pass is one job over all rows. Dimensions without variance, known exactly from
    whole-number sums, are left out first. Where dimensions depend on one another, a pass
    shows directions without variance: those with less than about a 10^-17th of the
    largest one; they are left out then.
    """
    places = _places(rows)
    if not places:
        return None
    n = places[0].n
    sums = [(p.high_bits << 36) + (p.mid_bits << 18) + p.low_bits for p in places]
    varied = [p.place for p in places if p.low < p.high]
    if not varied:
        return None
    d = len(sums)
    steps = []
    composed = np.eye(d)[varied]  # A = Q composed
    if len(varied) < d:
        steps.append(("times", np.eye(d)[:, varied]))
    solved = False
    for _ in range(MAX_PASSES):
        width = len(composed)
        gram = _gram(rows, n, sums, steps, width)
        if np.abs(gram - np.eye(width)).max() <= ORTHONORMAL * max(1, np.sqrt(width)):
            break
        lengths, turn = np.linalg.eigh(gram)
        if solved and lengths[0] < NO_VARIANCE:
            kept = turn[:, lengths >= NO_VARIANCE]
            steps.append(("times", kept))
            composed = kept.T @ composed
            continue
        shift = 0.0
        if not solved or lengths[0] < SAFE * lengths[-1]:
            # What rounding may take off, in proportion to the rows' number and width.
            size = 11 * (n * width + width * (width + 1)) * ROUNDING
            shift = min(size, 1e-3) * lengths[-1]
        r = _shifted_cholesky(gram, shift)
        steps.append(("solve", r))
        composed = r @ composed
        solved = True
    u, s, w = np.linalg.svd(composed, full_matrices=False)
    count = min(components, len(s))
    return Whitening(
        n=n,
        sums=sums,
        steps=steps,
        turn=u[:, :count] * np.sqrt(n),
        eigenvalues=s[:count] ** 2 / n,
        trace=float((s**2).sum() / n),
        components=w[:count].T,
    )


def transform(rows: DataFrame, found: Whitening) -> DataFrame:
    """``key``, ``deviation`` and ``whitened``, an array with a number per component."""
    schema = T.StructType(
        [
            rows.schema["key"],
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches):
            q = _apply(_centred(x, found.n, found.sums), found.steps) @ found.turn
            arrays = [
                batch.column("key"),
                pa.array(deviations(x, found.n, found.sums), pa.int64()),
                lists(q.ravel(), np.full(len(q), found.count), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(run, schema)


def identity_error(rows: DataFrame, found: Whitening) -> float:
    """How far the covariance of the whitened rows is from the identity, at most."""
    width = found.count + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, x in _matrices(batches):
            q = _apply(_centred(x, found.n, found.sums), found.steps) @ found.turn
            q = np.hstack([q, np.ones((len(q), 1))])
            total += q.T @ q
        if total.any():
            values = lists(total.ravel(), np.full(width, width), pa.float64())
            numbers = pa.array(np.arange(width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([numbers, values], _PART.names)

    total = _total(rows.select("x").mapInArrow(run, _PART), width) / found.n
    mean = total[-1, :-1]
    covariance = total[:-1, :-1] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(found.count)).max())


def whiten(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per valid vector and component, of at most ``components`` numbered from 1.

    Columns: ``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``. ``fit_rows`` tells which vectors count; a null key is kept, a
    repeated row counts as often as it occurs. Components without variance have no rows,
    so there are none at all if no vector counts or all are equal. ``deviation`` is null
    where it does not fit a long.
    """
    rows = fit_rows(vectors, key, vector)
    found = fit(rows, components)
    if found is None:
        fields = [T.StructField(key, vectors.schema[key].dataType)]
        fields += [T.StructField(name, kind) for name, kind in RESULTS.items()]
        return vectors.sparkSession.createDataFrame([], T.StructType(fields))
    error = identity_error(rows, found)
    share = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues])
    each = transform(rows, found).select(
        F.col("key").alias(key), "deviation", F.posexplode("whitened").alias("place", "whitened")
    )
    return each.select(
        key,
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
