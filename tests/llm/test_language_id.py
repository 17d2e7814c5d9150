from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pagetrail.llm import language_id
from pagetrail.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def loss(network, data, label):
    found, _, _ = network.probabilities(data)
    letters = data != 32
    picked = found[:, label, np.arange(len(label))]
    return float(-(np.log(picked) * letters).sum() / letters.sum())


def test_backpropagation_equals_differences():
    """Every parameter's gradient against a central difference of the loss."""
    rng = np.random.Generator(np.random.PCG64(1))
    network = language_id.Network.random(["a", "b", "c"], hidden=3)
    for side in (network.forward, network.backward):
        side.symbols, side.recurrent = side.symbols.astype(float), side.recurrent.astype(float)
    network.output, network.bias = network.output.astype(float), network.bias.astype(float)
    data = rng.choice([32, 97, 98, 99, 195], (7, 5)).astype(np.uint8)
    label = np.array([0, 1, 2, 1, 0])
    analytic = network.gradients(data, label)
    for parameter, gradient in zip(network.parameters(), analytic, strict=True):
        places = np.argwhere(np.abs(gradient) > 1e-4)
        for at in map(tuple, rng.permutation(places)[:6]):
            kept, step = parameter[at], 1e-2
            parameter[at] = kept + step
            high = loss(network, data, label)
            parameter[at] = kept - step
            low = loss(network, data, label)
            parameter[at] = kept
            assert abs((high - low) / (2 * step) - gradient[at]) < 2e-3 + 0.05 * abs(gradient[at])


def test_segments_cover_every_byte_once():
    texts = [b"", b"abc", b"x" * 64, b"y" * 129]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum([0, *map(len, texts)])
    columns, owner = language_id.segments(data, at)
    assert np.bincount(owner, minlength=4).tolist() == [0, 1, 1, 3]
    letters = (columns != 32).sum(axis=0)
    assert np.bincount(owner, letters, minlength=4).tolist() == [0, 3, 64, 129]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = QUERIES["op3_language_id"](spark, SF_DIR).join(docs, "doc_id").cache()
    assert got.count() == docs.count()
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0
    rest = got.filter("held_out and lang is not null and length(text) > 40")
    right = rest.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    checked = got.filter(
        F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    )
    assert checked.count() == 0


def test_edges_and_empty(spark, edges):
    labelled = edges.withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("xx"))
    network = language_id.train(labelled, F.lit(True))
    got = language_id.identify(labelled, network)
    assert got.columns == ["doc_id", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == 10
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] == 1}) == 1
    assert language_id.train(labelled, F.lit(False)) is None
    none = language_id.identify(labelled, None).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert language_id.identify(labelled.limit(0), network).count() == 0
