"""Toxicity by a sparse linear classifier that is regularised by counterfactuals.

Features are a text's distinct words and word beginnings, hashed. Besides the labels,
training sees pairs of sentences that differ in an identity term only: sentences of the
sample in which a term is swapped for another, and sentences to which a neutral mention
of one is added. The squared difference of the scores of a pair is penalised, so a
mention of a group does not count against a text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import slices
from pagetrail.llm.hashing import mix, word_hashes
from pagetrail.llm.text import LOWER, LOWER_ALNUM, as_bytes

FEATURES = 1 << 20
PREFIXES = (4, 6)  # bytes of a word's beginning, besides the whole word
SAMPLED_ROWS = 2500  # of each label, at most, that the classifier is fitted on
SENTENCES = 8  # of each text of the sample that counterfactuals may be made from
ROUNDS = 150
SPARSITY = 0.0012  # weight, for each text, of the absolute values of the weights
FAIRNESS = 1.0  # weight of the squared score changes of counterfactual pairs
PAIRS = 600  # counterfactual pairs of each of two kinds that training sees, at most
SLICE = 2 << 20

# Terms for groups of people, in sets whose members replace each other.
IDENTITY_TERMS = [
    "women men girls boys nonbinary transgender".split(),
    "woman man girl boy".split(),
    "gay lesbian bisexual straight heterosexual queer".split(),
    "christian muslim jewish hindu buddhist atheist catholic protestant".split(),
    "christians muslims jews hindus buddhists atheists catholics".split(),
    "black white asian african european latino arab american".split(),
    "german french spanish turkish polish chinese indian mexican".split(),
    "deaf blind disabled autistic elderly young old".split(),
    "frauen männer juden muslime christen ausländer deutsche".split(),
    "femmes hommes juifs musulmans chrétiens étrangers français".split(),
    "mujeres hombres judíos musulmanes cristianos extranjeros españoles".split(),
]
MENTIONS = ("i am {}", "my neighbour is {}", "we met some {} people there")


def features(text: bytes) -> np.ndarray:
    """Sorted distinct feature numbers of a text; none of an empty one."""
    words = text.translate(LOWER_ALNUM)
    kinds = [word_hashes(words), *(word_hashes(words, n) for n in PREFIXES)]
    numbered = [mix(h + np.uint64(k)) % np.uint64(FEATURES) for k, h in enumerate(kinds)]
    return np.unique(np.concatenate(numbered)).astype(np.int64)


# Fixed values end here. A term as a word of its own, in lower case.
_GROUPS = {t.encode(): terms for terms in IDENTITY_TERMS for t in terms}
_EDGE = rb"[\w\x80-\xff]"
_TERM = re.compile(rb"(?<!%b)(%b)(?!%b)" % (_EDGE, b"|".join(sorted(_GROUPS)), _EDGE))


def sentences(text: bytes, most: int = SENTENCES) -> list[bytes]:
    """Of the sentences of a whole text some, those with an identity term first, by hash."""
    found = {s for s in re.split(rb"[.!?\n]+", text.translate(LOWER)) if s.strip()}
    return sorted(found, key=lambda s: (not _TERM.search(s), zlib.crc32(s), s))[:most]


@dataclass
class Classifier:
    weights: np.ndarray
    intercept: float = 0.0

    def logit(self, text: bytes) -> float:
        return float(self.weights[features(text)].sum()) + self.intercept

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -30, 30))))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return np.concatenate(rows) if rows else np.empty(0, np.int64), owner


def counterfactuals(
    given: list[bytes], pairs: int = PAIRS, seed: int = 11
) -> list[tuple[bytes, bytes]]:
    """Pairs of sentences that differ in an identity term, at most ``pairs`` of each of two kinds."""
    rng = np.random.Generator(np.random.PCG64(seed))
    swapped, added = [], []
    for i in rng.permutation(len(given)):
        lower = given[i].translate(LOWER)
        if (found := _TERM.search(lower)) and len(swapped) < pairs:
            others = [t for t in _GROUPS[found[1]] if t.encode() != found[1]]
            other = others[rng.integers(len(others))].encode()
            swapped.append((lower, lower[: found.start()] + other + lower[found.end() :]))
        if len(added) < pairs:
            terms = IDENTITY_TERMS[rng.integers(len(IDENTITY_TERMS))]
            mention = MENTIONS[rng.integers(len(MENTIONS))].format(terms[rng.integers(len(terms))])
            added.append((lower, lower + b" " + mention.encode()))
    return swapped + added


def fit(
    texts: list[bytes], labels: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS
) -> Classifier:
    """``fit_features`` for texts at hand."""
    given = [s for t in texts for s in sentences(t)]
    return fit_features([features(t) for t in texts], given, labels, rounds, pairs)


def fit_features(
    rows: list[np.ndarray],
    given: list[bytes],
    labels: np.ndarray,
    rounds: int = ROUNDS,
    pairs_of_a_kind: int = PAIRS,
) -> Classifier:
    """Logistic loss, absolute weights and squared counterfactual differences, by
    proximal steps whose size adapts to each weight. ``rows`` are features of whole texts,
    ``given`` sentences to make counterfactuals from."""
    flat, owner = _flat(rows)
    pairs = [(features(a), features(b)) for a, b in counterfactuals(given, pairs_of_a_kind)]
    changed, pair = _flat([np.setxor1d(a, b, assume_unique=True) for a, b in pairs])
    gained, gainer = _flat([np.setdiff1d(b, a, assume_unique=True) for a, b in pairs])
    used, flat = np.unique(np.concatenate([flat, changed, gained]), return_inverse=True)
    flat, changed, gained = np.split(flat, np.cumsum([len(owner), len(pair)]))
    # Both labels weigh the same, however often they occur in the sample.
    share = np.where(labels > 0, labels.mean(), 1 - labels.mean())
    importance, sparsity = 0.5 / np.maximum(share, 1e-9), SPARSITY * len(rows)
    weights, squares = np.zeros(len(used)), np.full(len(used), 1e-8)
    intercept, intercept_square = 0.0, 1e-8
    for _ in range(rounds):
        logits = np.bincount(owner, weights[flat], len(rows)) + intercept
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) * importance
        gradient = np.bincount(flat, error[owner], len(used))
        if len(pairs):
            # Features of the second sentence count +1, those only in the first -1.
            gain = 2 * np.bincount(gainer, weights[gained], len(pairs))
            difference = gain - np.bincount(pair, weights[changed], len(pairs))
            step = 2 * FAIRNESS * difference
            gradient += 2 * np.bincount(gained, step[gainer], len(used))
            gradient -= np.bincount(changed, step[pair], len(used))
        squares += gradient * gradient
        rate = 0.3 / np.sqrt(squares)
        weights -= rate * gradient
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * sparsity, 0)
        intercept_square += error.sum() ** 2
        intercept -= 0.3 * error.sum() / np.sqrt(intercept_square)
    out = np.zeros(FEATURES, np.float32)
    out[used] = weights
    return Classifier(out, float(intercept))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learns: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLED_ROWS,
    pairs: int = PAIRS,
) -> Classifier:
    """Fitted on at most ``rows`` labelled rows of each label where ``learns(key)`` holds.

    These are the ones with the smallest hashes of their keys; of each the whole text
    counts, however long. Of several labels for a key the highest counts, of several texts
    the one with the smallest hash; null labels do not. Texts are turned into features by
    tasks: the driver gets the sample's features and some of its sentences, of which at most
    ``pairs`` of each kind become counterfactuals. Without labelled rows every score is a half.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & learns)
    known = known.groupBy(key).agg(F.max(label).alias("_label"))
    order = (F.xxhash64(key), F.col(key))
    sides = [known.filter(side) for side in (F.col("_label") > 0, F.col("_label") <= 0)]
    first, second = (side.orderBy(*order).limit(rows) for side in sides)
    chosen = first.union(second)
    found = (
        docs.select(key, as_bytes(F.col(text)).alias("_text"))
        .join(F.broadcast(chosen), key)  # two times ``rows`` at most
        .groupBy(key)
        .agg(F.min(F.struct(F.xxhash64("_text").alias("h"), "_text", "_label")).alias("x"))
        .select(F.xxhash64(key).alias("at"), "x._text", (F.col("x._label") > 0).alias("toxic"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE):
            texts = batch.column("_text").to_pylist()
            arrays = [
                batch.column("at"),
                batch.column("toxic"),
                pa.array([features(t).astype("<u4").tobytes() for t in texts], pa.binary()),
                pa.array([sentences(t) for t in texts], pa.list_(pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["at", "toxic", "features", "sentences"])

    fields = "at long, toxic boolean, features binary, sentences array<binary>"
    examples = found.mapInArrow(run, fields).orderBy("at", "features").collect()
    if not examples:
        return Classifier(np.zeros(FEATURES, np.float32))
    return fit_features(
        [np.frombuffer(bytes(r["features"]), "<u4").astype(np.int64) for r in examples],
        [bytes(s) for r in examples for s in r["sentences"]],
        np.array([float(r["toxic"]) for r in examples]),
        pairs_of_a_kind=pairs,
    )


def score(
    docs: DataFrame,
    classifier: Classifier,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The ``keep`` columns, ``score`` (0 to 1) and ``predicted`` (1 from a half on).

    Whole texts are read; a null text is scored like an empty one, by the intercept.
    Rows are scored one by one, so repeated ones get equal scores.
    """
    source = docs.select(*keep, as_bytes(F.col(text)).alias("_text"))
    schema = T.StructType(
        [
            *source.select(*keep).schema.fields,
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "_text", SLICE):
            scores = np.array([model.score(t) for t in batch.column("_text").to_pylist()])
            arrays = [batch.column(c) for c in keep]
            arrays += [pa.array(scores), pa.array(scores >= 0.5).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)
