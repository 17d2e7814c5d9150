from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pagetrail.llm import merkle
from pagetrail.llm.queries import QUERIES
from tests.llm.brute import LOWER

FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h("".join(values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def proof_of(levels, index):
    steps = []
    for nodes in levels[:-1]:
        first = index - index % 16
        steps.append((nodes[first:index], nodes[index + 1 : first + 16]))
        index //= 16
    return steps


def brute(rows):
    """Sorted answers, a tuple per row (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for source in order:
        leaves = sorted(
            ((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in trees[source]),
            key=lambda x: x[:3],
        )
        built[source] = (leaves, levels_of([x[2] for x in leaves]))
    top = levels_of([built[s][1][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        leaves, levels = built[source]
        upper = proof_of(top, place)
        for i, (_, _, leaf, row) in enumerate(leaves):
            steps = proof_of(levels, i) + upper
            proof = h("".join("".join(a + b) for a, b in steps))
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = None if row[4] is None else row[4].translate(LOWER)
                node = leaf_of((*row[:4], text))
            for a, b in steps:
                node = h("".join(a) + node + "".join(b))
            out.append((row[0], leaf, levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def answers(df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = answers(QUERIES["op12_merkle"](spark, "/root/testdata/sf0.01"))
    assert found == brute(rows)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (16, 17, 1), (300, 2), (4096,), (4097, 5, 257)])
def test_sizes_around_the_powers(spark, sizes):
    rows = [
        (1000 * k + i, f"s{k}", "en", i, f"Text {i} of {k}")
        for k, n in enumerate(sizes)
        for i in range(n)
    ]
    docs = spark.createDataFrame(rows, FIELDS).repartition(6)
    assert answers(merkle.proofs(docs)) == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"host{i % 4200}", None, 1, "a") for i in range(4300)]
    docs = spark.createDataFrame(rows, FIELDS)
    assert answers(merkle.proofs(docs)) == brute(rows)


def test_edges(spark):
    rows = [
        (1, None, None, None, None),
        (1, None, None, None, None),
        (None, None, "de", 3, "ABC"),
        (None, "", "de", 3, ""),
        (5, "", "de", 3, "Äß ABC \U0001f600"),
        (-7, "a\x00b", "-", 3, "x" * 300_000),
        (5, "é", "de", 3, "long Text here " * 20_000),
        (5, "z", "de", 3, "upper"),
        (5, "z", "de", 3, "Upper"),
        (5, "z", "de", 4, "Upper"),
    ]
    docs = spark.createDataFrame(rows, FIELDS).selectExpr(
        "*", "1 AS tree", "2 AS leaf", "3 AS `index`", "4 AS key", "5 AS n", "6 AS root"
    )
    assert answers(merkle.proofs(docs)) == brute(rows)
    assert answers(merkle.proofs(docs.limit(0))) == []


def test_text_ids(spark):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, FIELDS).withColumn("doc_id", F.col("doc_id").cast("string"))
    found = answers(merkle.proofs(docs))
    by_text = sorted(str(i) for i in range(40))
    leaves = levels_of([leaf_of((i, "s", "en", 1, f"T{i}")) for i in by_text])
    assert {r[3] for r in found} == {leaves[-1][0]}


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 1000, 4096])
def test_positions_are_the_order_of_completion(n):
    levels = levels_of([f"{i}" for i in range(n)])
    log = merkle.append_nodes(levels[0], len(levels) - 1)
    assert len(log) == sum(map(len, levels)) == len({*log} | {str(i) for i in range(n)})
    for level, nodes in enumerate(levels):
        for i, node in enumerate(nodes):
            assert log[merkle.position(level, i, n)] == node


def test_log_is_dense_in_postorder(spark):
    rows = [(i, f"s{int(i % 2 == 1 and i > 8000)}", "en", 1, f"T{i}") for i in range(9000)]
    members = merkle.manifest(spark.createDataFrame(rows, FIELDS))
    found = merkle.log_rows(merkle.append_log(members)).collect()
    trees = defaultdict(list)
    for r in found:
        trees[r.tree].append(r)
    assert len(trees) == 2
    for nodes in trees.values():
        nodes.sort(key=lambda r: r.position)
        assert [r.position for r in nodes] == list(range(len(nodes)))
        leaves = [r.node for r in nodes if r.level == 0]
        levels = levels_of(leaves)
        assert merkle.append_nodes(leaves, len(levels) - 1) == [r.node for r in nodes]
