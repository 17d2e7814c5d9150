from __future__ import annotations

import collections
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrail.llm import lm
from pagetrail.llm.queries import QUERIES
from tests.llm.brute import LOWER, WORD

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def base_scores(rows, learns):
    counts = collections.Counter()
    for row in rows:
        if learns(row):
            counts.update(tokens(row["text"]))
    n, v = sum(counts.values()), len(counts)
    out = []
    for row in rows:
        found = [counts[t] for t in tokens(row["text"])]
        score = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in found)
        out.append((len(found), sum(c > 0 for c in found), n, score))
    return out


def test_query_equals_brute_force_in_its_counts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    held_out = lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1
    want = base_scores(rows, lambda r: not held_out(r))
    got = {r["doc_id"]: r for r in QUERIES["op10_lm_scoring"](spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for row, (n_tokens, n_known, total, base) in zip(rows, want, strict=True):
        have = got[row["doc_id"]]
        assert have["held_out"] == held_out(row)
        assert (have["n_tokens"], have["n_known"], have["train_tokens"]) == (n_tokens, n_known, total)
        assert have["base_score"] == pytest.approx(base, rel=1e-9)
        assert have["score"] < 0 and math.isfinite(have["score"])


def test_history_lowers_perplexity_of_held_out_texts(spark):
    """Words follow each other by a rule that only a model with a history can use."""
    rnd = random.Random(6)
    follow = {f"w{i}a": f"w{(7 * i) % 40}b" for i in range(40)}
    rows = []
    for i in range(1500):
        words = []
        for _ in range(20):
            first = f"w{rnd.randrange(40)}a"
            words += [first, follow[first]]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = lm.score(docs, learns=F.col("doc_id") < 1200, rounds=12)
    sums = scored.filter("doc_id >= 1200").agg(F.sum("base_score"), F.sum("score")).first()
    assert sums[1] > 0.93 * sums[0]  # both negative


def test_probabilities_of_all_classes_sum_to_one():
    rng = np.random.Generator(np.random.PCG64(2))
    weights = lm.Weights(
        rng.normal(0, 1, (lm.BUCKETS, lm.CLASSES)).astype(np.float32),
        rng.normal(0, 1, lm.CLASSES).astype(np.float32),
    )
    features = rng.integers(0, lm.BUCKETS, (4, 50)).astype(np.uint16)
    total = np.exp(weights.log_probabilities(features)).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-5)


def test_histories_do_not_cross_texts():
    words, endings = np.arange(1, 9, dtype=np.uint64), np.arange(11, 19, dtype=np.int32)
    both = lm.histories(words, endings, np.array([5, 3]))
    assert (both[:, 5:] == lm.histories(words[5:], endings[5:], np.array([3]))).all()
    assert (both[:, :5] == lm.histories(words[:5], endings[:5], np.array([5]))).all()
    assert both.max() < lm.BUCKETS and both.min() >= 0


def bigram_score(train, texts):
    """log10 of an interpolated bigram model: relative frequencies, by how often the
    word before was seen, mixed with the smoothed unigram."""
    words, pairs, before = (collections.Counter() for _ in range(3))
    for text in train:
        last = ""
        for t in tokens(text):
            words[t] += 1
            pairs[last, t] += 1
            before[last] += 1
            last = t
    n, v, total = sum(words.values()), len(words), 0.0
    for text in texts:
        last = ""
        for t in tokens(text):
            unigram = (words[t] + 0.5) / (n + 0.5 * (v + 1))
            trust = before[last] / (before[last] + 5)
            seen = pairs[last, t] / before[last] if before[last] else 0.0
            total += math.log10((1 - trust) * unigram + trust * seen)
            last = t
    return total


def test_gain_on_held_out_texts_is_over_that_of_bigrams(spark):
    """With the defaults, and nearly the same whatever the partitions."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held_out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    rows = docs.collect()
    train = [r.text for r in rows if not held_out(r.doc_id)]
    bigram = bigram_score(train, [r.text for r in rows if held_out(r.doc_id)])
    learns = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    found = []
    for parts in (1, 16):
        scored = lm.score(docs.repartition(parts), learns=learns).filter(~learns)
        found.append(scored.agg(F.sum("base_score"), F.sum("score")).first())
    for base, score in found:
        assert score - base >= bigram - base > 0
    assert abs(found[0][1] / found[1][1] - 1) < 0.001


def test_score_equals_a_plain_version(spark, monkeypatch):
    """Sums over words and features, with weights and classes at random."""
    rnd, rng = random.Random(4), np.random.Generator(np.random.PCG64(4))
    vocabulary = ["".join(rnd.choices("abcdé", k=rnd.randint(1, 6))) for _ in range(30)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(9)))) for i in range(12)]
    of_ending = rng.integers(lm.END_CLASS + 1, lm.CLASSES, lm.ENDINGS).astype(np.int32)
    weights = lm.Weights(
        rng.normal(0, 1, (lm.BUCKETS, lm.CLASSES)).astype(np.float32),
        rng.normal(0, 1, lm.CLASSES).astype(np.float32),
    )
    monkeypatch.setattr(lm, "train", lambda *_: weights)
    monkeypatch.setattr(lm, "clustered", lambda _: of_ending)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in lm.score(docs, learns=F.col("doc_id") < 9).collect()}

    counts = collections.Counter(t for i, text in rows if i < 9 for t in tokens(text))
    hashed = lambda w: int(lm.word_hashes(w.encode())[0])
    by_rank = sorted((w for w in counts if w), key=lambda w: (-counts[w], np.uint64(hashed(w)).view(np.int64)))
    own = {w: k for k, w in enumerate(by_rank[: lm.FREQUENT])}

    def ending(w):
        if w is None:
            return lm.ENDINGS
        last = w.encode()[-lm.ENDING_BYTES :].rjust(lm.ENDING_BYTES, b" ")
        number = np.array([int.from_bytes(last, "big")], np.uint64)
        return int(lm.mix(number)[0] % np.uint64(lm.ENDINGS))

    def number_of(w):
        return lm.END_CLASS if w is None else own.get(w, int(of_ending[ending(w)]))

    inside, kinds = collections.Counter(), collections.Counter()
    for w, n in counts.items():
        inside[number_of(w)] += n
        kinds[number_of(w)] += 1
    full, steps = 1 << 64, [int(k) for k in lm._KIND_STEPS]
    for i, text in rows:
        total, past = 0.0, []
        for w in tokens(text):
            one, two = (hashed(past[-k]) if len(past) >= k else 0 for k in (1, 2))
            keys = [one * steps[0], (one * steps[0] + two * steps[1]) * steps[1], two * steps[2]]
            features = [k % full >> (64 - lm.BUCKET_BITS) for k in keys]
            for back in range(1, lm.BACK + 1):
                last = ending(past[-back]) if len(past) >= back else lm.ENDINGS
                features.append(lm.HASHED + (back - 1) * (lm.ENDINGS + 1) + last)
            sums = weights.bias + weights.table[features].sum(axis=0)
            c = number_of(w)
            total += (sums[c] - np.log(np.exp(sums.astype(float)).sum())) / math.log(10)
            total += math.log10((counts[w] + 0.5) / (inside[c] + 0.5 * (kinds[c] + 1)))
            past.append(w)
        assert got[i] == pytest.approx(total, abs=1e-4)


def test_updates_follow_the_gradient():
    rng = np.random.Generator(np.random.PCG64(5))
    table = rng.normal(0, 0.1, (lm.BUCKETS, lm.CLASSES)).astype(np.float32)
    bias = rng.normal(0, 1, lm.CLASSES).astype(np.float32)
    features = rng.integers(0, 40, (6, 30)).astype(np.int32)
    classes = rng.integers(0, lm.CLASSES, 30)

    def loss(weights):
        return -float(weights.log_probabilities(features)[np.arange(30), classes].sum(dtype=float))

    model = lm.Weights(table.copy(), bias)
    model.update(features, classes, np.full(table.shape, 1e12, np.float32), 1e6)
    gradient = table - model.table
    for row, column in [(3, 0), (17, 5), (39, lm.CLASSES - 1)]:
        ends = []
        for step in (0.05, -0.05):
            moved = table.copy()
            moved[row, column] += step
            ends.append(loss(lm.Weights(moved, bias)))
        assert gradient[row, column] == pytest.approx((ends[0] - ends[1]) / 0.1, abs=0.02)


def test_updates_equal_a_plain_version():
    """Two steps of adapted size, with more tokens than are worked on at a time."""
    rng = np.random.Generator(np.random.PCG64(7))
    table = rng.normal(0, 0.1, (lm.BUCKETS, lm.CLASSES)).astype(np.float32)
    bias = rng.normal(0, 1, lm.CLASSES).astype(np.float32)
    words, endings = rng.integers(0, 2**63, 5000, np.uint64), rng.integers(0, lm.ENDINGS, 5000)
    features = lm.histories(words, endings, np.array([3000, 0, 2000]))
    classes = rng.integers(0, lm.CLASSES, 5000)
    model, squares = lm.Weights(table.copy(), bias), np.full(table.shape, 1e-4, np.float32)
    plain, plain_squares = table.astype(float), np.full(table.shape, 1e-4)
    for _ in range(2):
        model.update(features, classes, squares, 0.15)
        sums = np.exp(bias + plain[features].sum(axis=0))
        error = sums / sums.sum(axis=1, keepdims=True) - np.eye(lm.CLASSES)[classes]
        gradient = np.zeros(table.shape)
        for rows in features:
            np.add.at(gradient, rows, error)
        plain_squares += gradient**2
        plain -= 0.15 * gradient / np.sqrt(plain_squares)
    assert np.allclose(model.table, plain, atol=1e-3)
    assert np.allclose(squares, plain_squares, atol=1e-3)


def test_probabilities_take_little_room_besides_the_result():
    rng = np.random.Generator(np.random.PCG64(8))
    weights = lm.Weights(
        rng.normal(0, 1, (lm.BUCKETS, lm.CLASSES)).astype(np.float32),
        np.zeros(lm.CLASSES, np.float32),
    )
    features = rng.integers(0, lm.BUCKETS, (6, lm.BATCH)).astype(np.int32)
    tracemalloc.start()
    try:
        found = weights.log_probabilities(features)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.5 * found.nbytes


def test_short_texts_are_cut_together_as_they_are_alone(monkeypatch):
    rnd = random.Random(9)
    alphabet = ["a", "B", "é", "語", " ", "\n", "\t", "\x0b"]
    some = ["".join(rnd.choices(alphabet, k=rnd.randrange(40))) for _ in range(2000)]
    texts = [t.encode() for t in ["", " ", "\n", "x" * (lm.JOINED_BYTES + 1), *some, ""]]
    calls = []
    cut = lm.word_hashes
    monkeypatch.setattr(lm, "word_hashes", lambda text: calls.append(1) or cut(text))
    hashes, endings, lengths = lm.tokenise(texts)
    assert len(calls) < 10
    alone = [lm.tokenise([t]) for t in texts]
    assert lengths.tolist() == [len(a[0]) for a in alone] == [len(tokens(t.decode())) for t in texts]
    assert (hashes == np.concatenate([a[0] for a in alone])).all()
    assert (endings == np.concatenate([a[1] for a in alone])).all()
    stops = np.cumsum(lengths) - 1
    assert (np.flatnonzero(hashes == lm.END) == stops).all()
    assert (np.flatnonzero(endings == lm.ENDINGS) == stops).all()


def test_endings_of_the_same_texts_are_one_class():
    rng = np.random.Generator(np.random.PCG64(6))
    company = np.zeros((lm.ENDINGS, lm.ANCHORS))
    kinds = rng.dirichlet(np.ones(lm.ANCHORS) * 0.3, 3)
    for ending in range(300):
        company[ending] = kinds[ending % 3] * rng.integers(50, 5000)
    found = lm.clustered(company)
    assert len({*found[:300]}) == 3 and all(len({*found[k:300:3]}) == 1 for k in range(3))
    assert found.min() > lm.END_CLASS and found.max() < lm.CLASSES
    assert (lm.clustered(np.zeros((lm.ENDINGS, lm.ANCHORS))) > lm.END_CLASS).all()


def test_packed_numbers_come_back():
    for numbers in ([], [0], [1, 255, 256, 70_000, 2**31 - 1]):
        assert lm.unpacked(lm.packed(np.array(numbers, np.int64))).tolist() == numbers


def test_edges_and_empty(spark, edges):
    got = lm.score(edges, learns=F.col("doc_id") > 0)
    rows = got.collect()
    want = base_scores(edges.collect(), lambda r: (r["doc_id"] or 0) > 0)
    key = lambda x: (x[0], round(x[3], 6))
    have = [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows]
    assert sorted(map(key, have)) == sorted(map(key, want))
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    untaught = lm.score(edges, learns=F.lit(False)).collect()
    assert len(untaught) == 10 and all(math.isfinite(r["score"]) for r in untaught)
    assert lm.score(edges.limit(0), learns=F.lit(True)).count() == 0
