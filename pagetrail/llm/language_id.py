"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network is trained here, in numpy, by backpropagation through time on a bounded
sample of labelled rows. It labels every byte; a document's probabilities are the mean
of those of its letters. Texts are cut into segments, which are labelled side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import content, slices
from pagetrail.llm.text import LOWER_ALNUM, as_bytes

HIDDEN = 8  # units of each direction
SEGMENT = 64  # bytes that are read together
SAMPLED_TEXTS = 500  # of each language, at most, that the network is trained on
SPARE = 8  # times as many rows are ranked, in case texts without letters are among them
SAMPLED_CHARACTERS = 320  # of each of these
EPOCHS = 14
BATCH = 256
WIDE = 2048  # segments labelled together
SLICE = 2 << 20
UNDETERMINED = "und"

# Letters as they are but for the case of A-Z; all else is one symbol.
_SYMBOL = np.frombuffer(LOWER_ALNUM, np.uint8).copy()
_SYMBOL[ord("0") : ord("9") + 1] = 32


@dataclass
class Direction:
    """Weights of one gated recurrent unit; rows are update, reset and candidate.

    The gates are sigmoids, written as tanh of half the sum. ``symbols`` has the input
    weights of each byte, with the biases.
    """

    symbols: np.ndarray  # 3H x 256
    recurrent: np.ndarray  # 3H x H

    @classmethod
    def random(cls, rng: np.random.Generator, hidden: int) -> Direction:
        scale = 1 / np.sqrt(hidden)
        return cls(
            rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32),
            rng.normal(0, scale, (3 * hidden, hidden)).astype(np.float32),
        )

    def states(self, data: np.ndarray) -> np.ndarray:
        """The states after each of the rows of ``data`` (steps x segments)."""
        steps, n = data.shape
        h = self.recurrent.shape[1]
        out = np.empty((steps, h, n), np.float32)
        inputs, sums = np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
        state = np.zeros((h, n), np.float32)
        for t in range(steps):
            np.take(self.symbols, data[t], axis=1, out=inputs, mode="clip")
            np.matmul(self.recurrent, state, out=sums)
            gates = inputs[: 2 * h]
            gates += sums[: 2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            candidate = sums[2 * h :]
            candidate *= gates[h:]
            candidate += inputs[2 * h :]
            np.tanh(candidate, out=candidate)
            state = np.subtract(state, candidate, out=out[t])
            state *= gates[:h]
            state += candidate
        return out

    def gradients(self, data: np.ndarray, states: np.ndarray, outer: np.ndarray):
        """Backpropagation through time; ``outer`` is the loss's gradient by each state."""
        steps, n = data.shape
        h = self.recurrent.shape[1]
        by_symbol, by_recurrent = np.zeros_like(self.symbols), np.zeros_like(self.recurrent)
        later = np.zeros((h, n), np.float32)
        zero = np.zeros((h, n), np.float32)
        for t in range(steps - 1, -1, -1):
            before = states[t - 1] if t else zero
            inputs = self.symbols[:, data[t]]
            sums = self.recurrent @ before
            gates = 0.5 + 0.5 * np.tanh(inputs[: 2 * h] + sums[: 2 * h])
            z, r = gates[:h], gates[h:]
            own = sums[2 * h :]
            candidate = np.tanh(inputs[2 * h :] + r * own)
            d_state = later + outer[t]
            d_candidate = d_state * (1 - z) * (1 - candidate * candidate)
            d_z = d_state * (before - candidate) * 2 * z * (1 - z)
            d_r = d_candidate * own * 2 * r * (1 - r)
            d_sums = np.concatenate([d_z, d_r, d_candidate * r])
            d_inputs = np.concatenate([d_z, d_r, d_candidate])
            by_recurrent += d_sums @ before.T
            order = np.argsort(data[t], kind="stable")
            present, first = np.unique(data[t][order], return_index=True)
            by_symbol[:, present] += np.add.reduceat(d_inputs[:, order], first, axis=1)
            later = d_state * z + self.recurrent.T @ d_sums
        return by_symbol, by_recurrent


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # languages x 2H
    bias: np.ndarray  # languages x 1

    @classmethod
    def random(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 3) -> Network:
        rng = np.random.Generator(np.random.PCG64(seed))
        one, two = Direction.random(rng, hidden), Direction.random(rng, hidden)
        output = rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32)
        return cls(languages, one, two, output, np.zeros((len(languages), 1), np.float32))

    def probabilities(self, data: np.ndarray):
        """Of each language at each place (steps x languages x segments), and the states."""
        ahead = self.forward.states(data)
        back = self.backward.states(data[::-1])[::-1]
        h = ahead.shape[1]
        scores = np.matmul(self.output[:, :h], ahead)
        scores += np.matmul(self.output[:, h:], back)
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores, ahead, back

    def parameters(self) -> list[np.ndarray]:
        one, two = self.forward, self.backward
        return [one.symbols, one.recurrent, two.symbols, two.recurrent, self.output, self.bias]

    def gradients(self, data: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean loss over the letters of the segments, by each parameter."""
        found, ahead, back = self.probabilities(data)
        letters = (data != 32).astype(np.float32)[:, None, :]
        error = found * letters
        error[:, label, np.arange(len(label))] -= letters[:, 0, :]
        error /= max(1.0, float(letters.sum()))
        h = ahead.shape[1]
        both = np.concatenate([ahead, back], axis=1)
        by_output = np.einsum("tkn,thn->kh", error, both, optimize=True)
        by_state = np.matmul(self.output.T, error)
        one = self.forward.gradients(data, ahead, by_state[:, :h])
        two = self.backward.gradients(data[::-1], back[::-1], by_state[::-1, h:])
        return [*one, *two, by_output, error.sum(axis=(0, 2))[:, None]]

    def train(self, data: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = 5):
        """Adam over shuffled batches, each language weighing the same by its sample."""
        rng = np.random.Generator(np.random.PCG64(seed))
        slow = [np.zeros_like(p) for p in self.parameters()]
        square = [np.zeros_like(p) for p in self.parameters()]
        step, total = 0, max(1, epochs * -(-data.shape[1] // BATCH))
        for _ in range(epochs):
            order = rng.permutation(data.shape[1])
            for start in range(0, len(order), BATCH):
                part = order[start : start + BATCH]
                step += 1
                rate = 0.02 * (1 - 0.9 * step / total)
                grads = self.gradients(data[:, part], label[part])
                for p, g, m, v in zip(self.parameters(), grads, slow, square, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    fixed = np.sqrt(v / (1 - 0.99**step)) + 1e-8
                    p -= rate * (m / (1 - 0.9**step)) / fixed
        return self


def segments(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts (one buffer with offsets) as columns of symbols, padded, and their owners."""
    lengths = np.diff(at)
    counts = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(lengths)), counts)
    first = np.cumsum(counts) - counts
    start = at[owner] + (np.arange(len(owner)) - first[owner]) * SEGMENT
    places = start + np.arange(SEGMENT)[:, None]
    inside = places < at[owner + 1]
    symbols = _SYMBOL[data[np.where(inside, places, 0)]] if len(data) else places
    return np.where(inside, symbols, np.uint8(32)).astype(np.uint8), owner


def pooled(network: Network, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The mean probabilities of each text's letters (texts x languages)."""
    columns, owner = segments(data, at)
    total = np.zeros((len(at) - 1, len(network.languages)))
    letters = np.zeros(len(at) - 1)
    for start in range(0, columns.shape[1], WIDE):
        part = np.ascontiguousarray(columns[:, start : start + WIDE])
        found, _, _ = network.probabilities(part)
        letter = (part != 32).astype(np.float32)
        who = owner[start : start + WIDE]
        np.add.at(total, who, np.einsum("tkn,tn->nk", found, letter))
        np.add.at(letters, who, letter.sum(axis=0))
    return total / np.maximum(letters, 1)[:, None]


def train(
    docs: DataFrame,
    learns: Column,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    texts: int = SAMPLED_TEXTS,
    characters: int = SAMPLED_CHARACTERS,
) -> Network | None:
    """A network for the languages of the rows where ``learns`` holds; None without any.

    It is fitted on a bounded sample: of each language the ``texts`` rows with the smallest
    hashes of key and text among those with letters, all if they are fewer, and of each
    a stretch of ``characters``, from a hashed place on. Languages are a row each in the driver.
    """
    labelled = docs.filter(learns & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    order = F.xxhash64(F.col(key), F.col(text))
    # Only a share of the hashes' range is ranked, one that yields some times as many rows.
    counted = labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()
    near = F.lit(False)
    for row in counted:
        share = min(1.0, SPARE * texts / row["n"])
        low = F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)
        near = near | ((F.col(lang) == row["lang"]) & (order <= low))
    usable = labelled.filter(near)
    room = F.greatest(F.lit(1), F.length(text) - characters)
    first = F.pmod(order, room.cast("long")).cast("int") + 1
    part = F.substr(F.col(text), first, F.lit(characters))
    ranked = usable.select(F.col(lang).alias("lang"), order.alias("o"), part.alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("o", "part"))
    rows = ranked.withColumn("rank", rank).filter(F.col("rank") <= texts).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["rank"]))
    languages = sorted({r["lang"] for r in rows})
    encoded = [r["part"].encode() for r in rows]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(e) for e in encoded])])
    columns, owner = segments(data, at)
    label = np.array([languages.index(r["lang"]) for r in rows])[owner]
    return Network.random(languages).train(columns, label)


def identify(
    docs: DataFrame,
    network: Network | None,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score`` (the mean probability of that language).

    A null text or one without a letter is ``und`` with score 0, as is every text if
    there is no network. Equal probabilities give the language that sorts first. Every
    row is labelled on its own, over its whole text.
    """
    source = docs.select(
        *keep,
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
        as_bytes(F.col(text)).alias("_text"),
    )
    schema = T.StructType(
        [
            *source.select(*keep).schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*(model.languages if model else []), UNDETERMINED], object)
        for batch in slices(batches, "_text", SLICE):
            known = batch.column("_letters").to_numpy(zero_copy_only=False) & (model is not None)
            best, score = np.full(len(known), len(names) - 1), np.zeros(len(known))
            if known.any():
                found = pooled(model, *content(batch.column("_text")))
                best = np.where(known, found.argmax(axis=1), best)
                score = np.where(known, np.clip(found.max(axis=1), 0, 1), 0.0)
            arrays = [batch.column(c) for c in keep]
            arrays += [pa.array(names[best], pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)
