from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrail.llm import near_dedup
from pagetrail.llm.components import components
from tests.llm.brute import near_duplicates, shingles


def copies(vocabulary, seed=3):
    """Groups of copies with a few to many words changed, chains, exact copies and others."""
    rnd = random.Random(seed)
    docs = []
    for group in range(12):
        base = rnd.choices(vocabulary, k=rnd.choice([6, 20, 60, 200]))
        for _ in range(rnd.randrange(1, 9)):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4, 8])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            if group % 3 == 0:
                base = words  # a chain: neighbours are similar, ends need not be
            docs.append(" ".join(words))
    docs += ["", " \n", None, "a b c", "a b c", "A  B\tc", "a b"]
    rnd.shuffle(docs)
    return list(enumerate(docs, start=5))


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_equals_brute_force(spark, vocabulary, percent):
    docs = copies(vocabulary)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = near_duplicates(docs, percent)
    got = near_dedup.near_duplicates(df, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_text_ids(spark, vocabulary):
    docs = [(f"doc-{i}", text) for i, text in copies(vocabulary, 5)]
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id string, text string"))
    want = near_duplicates(docs, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) < len(docs)


def test_one_id_with_several_texts_is_one_document(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "u v w x y z"), (3, "u v w x y z")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["component_id"] for r in got.collect()} == {1}


def test_edges_and_empty(spark, edges):
    got = near_dedup.near_duplicates(edges)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    assert len(rows) == 10
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in rows)
    assert sorted(r["n_shingles"] for r in rows if r["doc_id"] in (2, 3, 4, 1)) == [0, 0, 0, 1, 1]
    assert near_dedup.near_duplicates(edges.limit(0)).count() == 0


def test_sketch_limit_keeps_similar_pairs(spark, vocabulary):
    """No pair at or above the threshold is dropped, and far ones are."""
    rnd = random.Random(9)
    rows, kept = [], 0
    for _ in range(300):
        a = rnd.choices(vocabulary, k=rnd.choice([8, 40, 300, 3000]))
        b = list(a)
        for _ in range(rnd.randrange(0, 1 + len(a) // 12)):
            b[rnd.randrange(len(b))] = rnd.choice(vocabulary)
        texts = [" ".join(a), " ".join(b)]
        x, y = (shingles(t) for t in texts)
        similar = 100 * len(x & y) >= 85 * len(x | y)
        row = [similar, len(x & y) / len(x | y)]
        for t in texts:
            members = near_dedup.shingles(t.encode())
            drawn = near_dedup.part_samples(members)
            row += [len(members), len(drawn), near_dedup.odd_sketch(drawn).tolist()]
        rows.append(row)
        kept += similar
    schema = "similar boolean, j double, n_a int, parts_a int, sketch_a array<long>, "
    df = spark.createDataFrame(rows, schema + "n_b int, parts_b int, sketch_b array<long>")
    got = df.withColumn("ok", near_dedup._promising(85)).collect()
    assert kept > 40 and all(r["ok"] for r in got if r["similar"])
    assert not any(r["ok"] for r in got if r["j"] < 0.6 and r["n_a"] > 30)


@pytest.mark.parametrize("percent", [80, 85])
def test_sketch_limit_keeps_pairs_at_the_threshold(spark, percent):
    """Pairs exactly at the threshold, of small to large unions, with balanced differences."""
    rng = np.random.Generator(np.random.PCG64(percent))
    rows = []
    for union, pairs in ((20, 3000), (40, 3000), (100, 2000), (400, 2000), (1000, 2000), (4000, 500)):
        common = percent * union // 100
        half = (union - common) // 2
        for _ in range(pairs):
            members = rng.integers(0, 2**64, union, np.uint64)
            row = []
            for own in (members[: common + half], np.r_[members[:common], members[common + half :]]):
                drawn = near_dedup.part_samples(np.sort(own))
                row += [len(own), near_dedup.odd_sketch(drawn)]
            differ = int(np.bitwise_count((row[1] ^ row[3]).view(np.uint64)).sum())
            rows.append((union, row[0], row[2], differ))
    schema = "union int, n_a int, n_b int, differ int"
    lost = spark.createDataFrame(rows, schema).filter(F.col("differ") > near_dedup._limit(percent))
    assert lost.groupBy("union").count().collect() == []


def test_minhash_estimates_similarity():
    rng = np.random.Generator(np.random.PCG64(1))
    x = np.sort(rng.integers(0, 2**64, 1000, np.uint64))
    y = np.sort(np.concatenate([x[:900], rng.integers(0, 2**64, 100, np.uint64)]))
    equal = (near_dedup.samples(x) == near_dedup.samples(y)).mean()
    assert abs(equal - 900 / 1100) < 0.1


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    rnd = random.Random(1)
    rnd.shuffle(pairs)
    df = spark.createDataFrame([p if rnd.random() < 0.5 else p[::-1] for p in pairs], "src long, dst long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(df.limit(0)).count() == 0
