"""Hashed maximum-entropy language model with a class-factored softmax.

``p(word | history) = p(class | history) * p(word | class)``. The first factor is a
softmax over classes. Its features are the hashed previous word, the pair of previous words
and the word two back (a skip), and the endings of the last four words, which also speak for
words that training has not seen. Frequent words are classes of their own. The others are
classed by their endings, and endings that occur in the same texts are one class: they are
clustered by what else the training texts with them hold. Within a class the features
are the words themselves, for which the optimum is known: smoothed relative frequency.

Texts are first cut into blocks of numbered tokens, which all later steps read. Word
counts are summed over all blocks and joined back to each block's own words, so no task
holds the vocabulary. The weights are trained in rounds: each task makes gradient
updates on its blocks, starting from the common weights; the changes are averaged over
the tasks in a tree, for each feature by how often a task has seen it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import lists, slices
from pagetrail.llm.hashing import mix, word_endings, word_hashes
from pagetrail.llm.text import LOWER, as_bytes
from pagetrail.sources.scratch import scratch_path, scratch_table

CLASSES = 24
FREQUENT = 3  # words that are classes of their own, besides the end of the text
END_CLASS = FREQUENT
CLUSTERS = CLASSES - FREQUENT - 1  # classes for all other words, by their endings
ENDING_BYTES = 3
ENDINGS = 4096  # numbers that endings are hashed to
ANCHORS = 128  # groups of endings whose share in a text describes it
TEXTS = 256  # described at a time
BUCKET_BITS = 15
HASHED = 1 << BUCKET_BITS  # rows of hashed features of words
BACK = 3  # words whose endings are features
BUCKETS = HASHED + BACK * (ENDINGS + 1)  # all rows; an ending may be missing
ROUNDS = 1  # passes over the training texts
EXCHANGES = 2  # parts of a pass after which the tasks' weights are averaged
BLOCKS_A_TASK = 16  # at least, so that a task sees enough to learn from
BLOCKS_A_FILE = 32  # whose word counts are written by one task
BATCH = 65536  # tokens of an update, and of what is scored at a time
FIRST_BATCH = 4096  # of a task's first updates; it doubles after every eight
RATE = 0.15
AT_ONCE = 2048  # tokens or feature rows whose numbers are worked on at a time
BLOCK_BYTES = 4 << 20
JOINED_BYTES = 1 << 16  # of texts that are cut into words together
END = np.uint64(0x5EED0FE4D0F7E875)
COUNT_BITS = 40  # of a packed (position, count)

_CODEC = pa.Codec("zstd", 1)
_KIND_STEPS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64
)


def tokenise(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) and of each text's end, their numbered endings,
    and how many each text has.

    The end has the number after the last. White space between texts lets many short ones
    be cut at once.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    group = np.cumsum(sizes) // JOINED_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    parts = []
    for start, stop in zip(cuts, cuts[1:], strict=False):
        joined = b"\n".join(texts[start:stop]).translate(LOWER)
        places, endings = word_endings(joined, ENDING_BYTES)
        endings = (mix(endings) % np.uint64(ENDINGS)).astype(np.int32)
        ends = np.searchsorted(places, np.cumsum(sizes[start:stop]))
        hashes = np.insert(word_hashes(joined), ends, END)
        parts.append((hashes, np.insert(endings, ends, ENDINGS), np.diff(ends, prepend=0) + 1))
    hashes, endings, lengths = (np.concatenate(p) for p in zip(*parts, strict=True))
    return hashes, endings, lengths


def blocks(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of some megabytes of text: keys, whether they train, lengths, and their tokens
    as numbers into the block's own distinct ``words``, with endings and training counts.

    ``block`` numbers the rows of one run of this plan, so write it before using it twice.
    """
    source = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(learns, F.lit(False)).alias("_learns"),
        as_bytes(F.col(text)).alias("_text"),
    )
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(source.schema["_key"].dataType)),
            T.StructField("learns", T.ArrayType(T.BooleanType())),
            T.StructField("lengths", T.ArrayType(T.IntegerType())),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.LongType())),
            T.StructField("endings", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_block = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(slices(batches, "_text", BLOCK_BYTES)):
            hashes, token_endings, lengths = tokenise(batch.column("_text").to_pylist())
            numbered = pa.array(hashes).dictionary_encode()
            words, tokens = numbered.dictionary.to_numpy(), numbered.indices.to_numpy()
            endings = np.empty(len(words), np.int32)
            endings[tokens] = token_endings
            # Frequent words get small numbers, which take less room when compressed.
            order = np.argsort(-np.bincount(tokens, minlength=len(words)), kind="stable")
            words, endings = words[order], endings[order]
            ranks = np.empty(len(order), np.int32)
            ranks[order] = np.arange(len(order))
            tokens = ranks[tokens]
            learns = batch.column("_learns").to_numpy(zero_copy_only=False)
            counts = np.bincount(tokens[np.repeat(learns, lengths)], minlength=len(words))
            one = lambda values, kind: lists(values, np.array([len(values)]), kind)
            whole = pa.array([0, len(learns)], pa.int32())
            arrays = [
                pa.array([first_block + number], pa.int64()),
                pa.ListArray.from_arrays(whole, batch.column("_key")),
                pa.ListArray.from_arrays(whole, batch.column("_learns")),
                one(lengths, pa.int32()),
                pa.array([packed(tokens)], pa.binary()),
                one(words.view(np.int64), pa.int64()),
                one(endings, pa.int32()),
                one(counts, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, compressed byte plane by byte plane, after how many they are."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    size = len(numbers).to_bytes(8, "little")
    return size + _CODEC.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = _CODEC.decompress(data[8:], decompressed_size=4 * size, asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int32)


def word_counts(coded: DataFrame) -> DataFrame:
    """``word``, ``n`` and ``ending`` of every word of the training texts."""
    each = coded.select(F.explode(F.arrays_zip("words", "endings", "counts")).alias("x"))
    return (
        each.filter("x.counts > 0")
        .groupBy(F.col("x.words").alias("word"))
        .agg(F.sum("x.counts").alias("n"), F.min("x.endings").alias("ending"))
    )


def company(coded: DataFrame) -> np.ndarray:
    """For each ending the mean description of the training texts around it (ENDINGS x ANCHORS).

    A text is described by the shares of groups of endings in it; each of its words adds
    that to its own ending's row. One matrix a task, added up in a tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ENDINGS, ANCHORS))
        for batch in batches:
            for row in _rows(batch):
                endings = row["endings"][row["tokens"]]
                text = np.repeat(np.arange(len(row["lengths"])), row["lengths"])
                used = np.repeat(row["learns"], row["lengths"]) & (endings < ENDINGS)
                endings, text = endings[used], text[used].astype(np.int64)
                cuts = np.searchsorted(text, np.arange(0, len(row["lengths"]) + TEXTS, TEXTS))
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at = (text[a:b] - k * TEXTS) * ENDINGS + endings[a:b]
                    held = np.bincount(at, minlength=TEXTS * ENDINGS).astype(np.float32)
                    held = held.reshape(TEXTS, ENDINGS)
                    shares = held.reshape(TEXTS, -1, ANCHORS).sum(axis=1)
                    shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1)
                    total += held.T @ shares
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    used = coded.select("learns", "lengths", "tokens", "words", "endings")
    sums = used.mapInArrow(run, "sums binary").rdd.map(lambda r: np.frombuffer(r["sums"]))
    if used.isEmpty():
        return np.zeros((ENDINGS, ANCHORS))
    return sums.treeReduce(np.add, depth=3).reshape(ENDINGS, ANCHORS)


def clustered(company: np.ndarray) -> np.ndarray:
    """The class of each ending: weighted k-means of their descriptions, by the distance
    that compares each share with its overall value. Rare endings follow the nearest centre,
    those never seen the largest class."""
    weight = company.sum(axis=1)
    out = np.zeros(ENDINGS, np.int32)
    seen = np.flatnonzero(weight > 0)
    if not len(seen):
        return out + END_CLASS + 1
    overall = np.maximum(company.sum(axis=0) / weight.sum(), 1e-12)
    weight = weight[seen]
    points = (company[seen] / weight[:, None] - overall) / np.sqrt(overall)
    # Few directions tell texts apart; the others are noise of rare endings.
    _, _, axes = np.linalg.svd(points * np.sqrt(weight)[:, None], full_matrices=False)
    points = points @ axes[:CLUSTERS].T

    def distances(centres: np.ndarray) -> np.ndarray:
        return ((points[:, None, :] - centres) ** 2).sum(axis=2)

    # Centres one by one where weight and distance from those before are the greatest.
    centres = points[[weight.argmax()]]
    while len(centres) < min(CLUSTERS, len(seen)):
        far = weight * distances(centres).min(axis=1)
        if far.max() <= 1e-9 * (weight * (points**2).sum(axis=1)).max():
            break
        centres = np.vstack([centres, points[far.argmax()]])
    for _ in range(50):
        nearest = distances(centres).argmin(axis=1)
        moved = np.stack(
            [
                np.average(points[nearest == k], axis=0, weights=weight[nearest == k])
                if (nearest == k).any()
                else centre
                for k, centre in enumerate(centres)
            ]
        )
        if np.allclose(moved, centres):
            break
        centres = moved
    out += int(np.bincount(nearest, weight).argmax())
    out[seen] = nearest
    return out + END_CLASS + 1


@dataclass
class Vocabulary:
    """What the model knows of all words together; its size does not grow with the data."""

    tokens: int
    distinct: int
    frequent: dict[int, int]  # the classes of the most frequent words
    of_ending: np.ndarray  # the classes of all others, and of the end
    class_tokens: np.ndarray
    class_words: np.ndarray

    def classes(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = self.of_ending[endings]
        for word, number in self.frequent.items():
            out[words == word] = number
        return out


def vocabulary(counts: DataFrame, of_ending: np.ndarray) -> Vocabulary:
    """At most ``FREQUENT`` words and a sum for each ending are fetched."""
    of_ending = np.append(of_ending, END_CLASS).astype(np.int32)
    end = F.lit(int(END.astype(np.int64)))
    top = counts.filter(F.col("word") != end).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = {r["word"]: i for i, r in enumerate(top)}
    sums = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in sums.collect():
        tokens[of_ending[row["ending"]]] += row["n"]
        words[of_ending[row["ending"]]] += row["v"]
    for i, row in enumerate(top):
        tokens[of_ending[row["ending"]]] -= row["n"]
        words[of_ending[row["ending"]]] -= 1
        tokens[i], words[i] = row["n"], 1
    return Vocabulary(int(tokens.sum()), int(words.sum()), frequent, of_ending, tokens, words)


def histories(words: np.ndarray, endings: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The feature rows of each token (six kinds x tokens), from up to four words before it."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)

    def before(values: np.ndarray, back: int, none) -> np.ndarray:
        shifted = np.concatenate([values[: min(back, len(values))], values[:-back]])
        return np.where(place >= back, shifted, values.dtype.type(none))

    one, two = before(words, 1, 0), before(words, 2, 0)
    first, second, third = _KIND_STEPS
    hashed = np.stack([one * first, (one * first + two * second) * second, two * third])
    rows = [(hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)]
    for back in range(1, BACK + 1):
        ending = before(endings, back, ENDINGS)
        rows.append((ending + (HASHED + (back - 1) * (ENDINGS + 1)))[None].astype(np.int32))
    return np.concatenate(rows)


class Weights:
    def __init__(self, table: np.ndarray, bias: np.ndarray):
        self.table, self.bias = table, bias

    @classmethod
    def zero(cls, vocab: Vocabulary) -> Weights:
        share = (vocab.class_tokens + 0.5) / (vocab.tokens + 0.5 * CLASSES)
        return cls(np.zeros((BUCKETS, CLASSES), np.float32), np.log(share).astype(np.float32))

    def log_probabilities(self, features: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probability of each class (tokens x CLASSES).

        Laid out class by class; a few tokens at a time, whose arrays stay in the cache.
        """
        out = np.empty((CLASSES, features.shape[1]), np.float32)
        for start in range(0, out.shape[1], AT_ONCE):
            columns = features[:, start : start + AT_ONCE].astype(np.intp)
            sums = self.table.take(columns[0], axis=0)
            for rows in columns[1:]:
                sums += self.table.take(rows, axis=0)
            sums += self.bias
            sums -= sums.max(axis=1, keepdims=True)
            sums -= np.log(np.exp(sums).sum(axis=1, keepdims=True))
            out[:, start : start + AT_ONCE] = sums.T
        return out.T

    def update(self, features: np.ndarray, classes: np.ndarray, squares: np.ndarray, rate: float):
        """One step on a batch of tokens, its size adapted to each weight."""
        error = np.exp(self.log_probabilities(features).T)
        error[classes, np.arange(len(classes))] -= 1
        firsts = features.min(axis=1)  # of each kind, whose rows lie together
        kinds = (features - firsts[:, None]).astype(np.intp)
        gradient, column = np.zeros((CLASSES, BUCKETS)), np.empty(len(classes))
        for values, sums in zip(error, gradient, strict=True):
            column[:] = values
            for first, rows in zip(firsts, kinds, strict=True):
                found = np.bincount(rows, column)
                sums[first : first + len(found)] += found
        for start in range(0, BUCKETS, AT_ONCE):
            part = slice(start, start + AT_ONCE)
            step = gradient[:, part].T.astype(np.float32, order="C")
            squares[part] += step * step
            step /= np.sqrt(squares[part])
            step *= rate
            self.table[part] -= step


def _rows(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    for i in range(batch.num_rows):
        names = [n for n in batch.schema.names if n not in ("block", "keys", "tokens")]
        row = {n: batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in names}
        row["words"] = row["words"].view(np.uint64)
        row["tokens"] = unpacked(batch.column("tokens")[i].as_py())
        yield row


def train(coded: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Passes of updates over all training tokens; only sums of weights reach the driver.

    A pass is made in parts, each over other blocks, after which the tasks' weights are
    averaged and all go on from there. A task has several blocks, so the weights depend
    little on how the texts were partitioned.
    """
    context = coded.sparkSession.sparkContext
    weights = Weights.zero(vocab)
    used = coded.select("block", "learns", "lengths", "tokens", "words", "endings")
    tasks = max(1, used.count() // EXCHANGES // BLOCKS_A_TASK)
    for number in range(rounds * EXCHANGES):
        shared = context.broadcast((weights.table, weights.bias, vocab))
        rate = RATE / (1 + number // EXCHANGES)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate):
            table, bias, known = shared.value
            own = Weights(table.copy(), bias)
            squares = np.full(table.shape, 1e-4, np.float32)
            seen, updates = np.zeros(BUCKETS, np.int64), 0
            for batch in batches:
                for row in _rows(batch):
                    learns = np.repeat(row["learns"], row["lengths"])
                    numbers = known.classes(row["words"].view(np.int64), row["endings"])
                    words, endings = (row[c][row["tokens"]] for c in ("words", "endings"))
                    features = histories(words, endings, row["lengths"])[:, learns]
                    classes = numbers[row["tokens"]][learns]
                    start = 0
                    while start < len(classes):
                        part = slice(start, start + min(BATCH, FIRST_BATCH << updates // 8))
                        own.update(features[:, part], classes[part], squares, rate)
                        start, updates = part.stop, updates + 1
                    seen += np.bincount(features.ravel(), minlength=BUCKETS)
            change = (own.table - table) * seen[:, None]
            sums = np.concatenate([change.ravel(), seen.astype(np.float64)]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

        part = F.pmod(F.xxhash64("block"), F.lit(EXCHANGES)) == number % EXCHANGES
        sums = used.filter(part).coalesce(tasks).mapInArrow(run, "sums binary").rdd.map(
            lambda r: np.frombuffer(r["sums"], np.float32)
        )
        total = sums.treeReduce(np.add, depth=3)
        shared.unpersist()
        seen = np.maximum(total[-BUCKETS:], 1)[:, None]
        weights.table += total[:-BUCKETS].reshape(BUCKETS, CLASSES) / seen
    return weights


def score(
    docs: DataFrame,
    learns: Column,
    key: str = "doc_id",
    text: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """A row per row: key, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``learns`` holds and scores all, whole. Tokens are the
    words and one end; a null or empty text is the end alone. ``base_score`` is the
    smoothed unigram log10 probability, ``score`` the model's. Words are told apart by
    64-bit hashes. Without training rows every count is 0 and the classes are equally
    likely; an empty table gives no rows; repeated rows count as often as they occur.
    """
    path, spark = scratch_path(docs.sparkSession, "blocks"), docs.sparkSession
    cut = blocks(docs, learns, key, text)
    cut.write.option("compression", "zstd").parquet(path)
    coded = spark.read.schema(cut.schema).parquet(path)
    files = max(1, -(-coded.count() // BLOCKS_A_FILE))
    counts = scratch_table(word_counts(coded).coalesce(files), "word-counts")
    vocab = vocabulary(counts, clustered(company(coded)))
    weights = train(coded, vocab, rounds) if vocab.tokens else Weights.zero(vocab)

    asked = coded.select("block", F.posexplode("words").alias("at", "word"))
    scale = 1 << COUNT_BITS
    placed = F.col("at") * F.lit(scale) + F.coalesce("n", F.lit(0))
    found = asked.join(counts.select("word", "n"), "word", "left").select(
        "block", placed.alias("packed")
    )
    found = found.groupBy("block").agg(F.sort_array(F.collect_list("packed")).alias("packed"))
    ready = coded.select("block", "keys", "learns", "lengths", "tokens", "words", "endings")
    ready = ready.join(found, "block")

    shared = docs.sparkSession.sparkContext.broadcast((weights.table, weights.bias, vocab))
    key_type = coded.schema["keys"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias, known = shared.value
        model = Weights(table, bias)
        for batch in batches:
            for i, row in enumerate(_rows(batch)):
                n = (row["packed"] & (scale - 1)).astype(np.float64)
                base = np.log10((n + 0.5) / (known.tokens + 0.5 * (known.distinct + 1)))
                classes = known.classes(row["words"].view(np.int64), row["endings"])
                inside = np.log10(
                    (n + 0.5) / (known.class_tokens + 0.5 * (known.class_words + 1))[classes]
                )
                tokens, lengths = row["tokens"], row["lengths"]
                features = histories(row["words"][tokens], row["endings"][tokens], lengths)
                by_class = np.empty(len(tokens))
                for start in range(0, len(tokens), BATCH):
                    part = slice(start, start + BATCH)
                    logs = model.log_probabilities(features[:, part])
                    by_class[part] = logs[np.arange(len(logs)), classes[tokens[part]]]
                starts = np.cumsum(lengths) - lengths
                add = lambda values: np.add.reduceat(values, starts)
                arrays = [
                    batch.column("keys")[i].values,
                    pa.array(lengths, pa.int64()),
                    pa.array(add((n > 0)[tokens].astype(np.int64)), pa.int64()),
                    pa.array(np.full(len(lengths), known.tokens), pa.int64()),
                    pa.array(add(base[tokens]), pa.float64()),
                    pa.array(add(inside[tokens] + by_class / np.log(10)), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return ready.mapInArrow(run, schema)
