from __future__ import annotations

import random

from pagetrail.llm import line_dedup
from tests.llm.brute import without_repeats


def random_docs(vocabulary, seed):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 10, 30, 60]))) for _ in range(25)]
    docs = []
    for i in range(50):
        lines = []
        for _ in range(rnd.randrange(0, 8)):
            if rnd.random() < 0.6:
                at = rnd.randrange(len(pool))
                lines += pool[at : at + rnd.randrange(1, 6)]
            lines.append(rnd.choice(["", "  ", " ".join(rnd.choices(vocabulary, k=12))]))
        docs.append((i, "\n".join(lines)))
    return docs


def test_equals_brute_force(spark, vocabulary):
    for seed in (1, 2, 3):
        docs = random_docs(vocabulary, seed) + [(90, None), (91, ""), (92, "x y\n" * 60)]
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
        got = line_dedup.remove_repeated_lines(df).collect()
        assert {r["doc_id"]: r["text"] for r in got} == without_repeats(docs)


def test_passage_stays_in_the_first_document_only(spark):
    passage = " ".join(f"p{i}" for i in range(51))
    docs = [(3, f"own three\n{passage}\nend"), (1, f"own one\n{passage}"), (2, f"{passage}\nown two")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated_lines(df).collect()}
    assert got == {1: f"own one\n{passage}", 2: "own two", 3: "own three\nend"}


def test_short_repeats_stay(spark):
    line = " ".join(["word"] * 49)
    df = spark.createDataFrame([(1, line), (2, line)], "doc_id long, text string")
    assert {r["text"] for r in line_dedup.remove_repeated_lines(df).collect()} == {line}


def test_equal_windows_have_equal_fingerprints(vocabulary):
    rnd = random.Random(4)
    run = [" ".join(rnd.choices(vocabulary, k=9)) for _ in range(20)]
    one = line_dedup.windows("\n".join(["a b", *run, "c"]).encode())
    two = line_dedup.windows("\n".join(["x", "", "y z", *run]).encode())
    assert len({w[2:4] for w in one} & {w[2:4] for w in two}) >= 15
    by_content = {w[2:4]: w[0] for w in one}
    assert all(by_content.get(w[2:4], w[0]) == w[0] for w in two)
    assert len({w[0] for w in one}) < len(one) / 2  # few fingerprints for many windows


def test_edges_and_empty(spark, edges):
    got = line_dedup.remove_repeated_lines(edges)
    assert got.columns == [c for c in edges.columns if c != "n_removed"] + ["n_lines", "n_removed"]
    rows = got.collect()
    assert len(rows) == 10 and sum(r["n_removed"] for r in rows) == 0
    assert [r["text"] for r in rows if r["doc_id"] == 2] == [None]
    assert line_dedup.remove_repeated_lines(edges.limit(0)).count() == 0


def test_rows_without_id_come_last(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(None, passage + "\nz"), (5, passage)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated_lines(df).collect()}
    assert got == {None: "z", 5: passage}
