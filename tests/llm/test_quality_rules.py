from __future__ import annotations

import re

import pytest

from pagetrail.llm import quality_rules
from pagetrail.llm.queries import QUERIES
from tests.llm.brute import WORD

SF_DIR = "/root/testdata/sf0.001"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {
        i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)
    }
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        "a b c d",
        "a b c d e a b c d e",
        "a b c d e x a b c d e y a b c d e",
        "a a a a a a a a",
        "l1 x\nl1 x\n\n \nl1 x\nl2",
        "# * $ % & | < > ## \U0001f600",
    ],
)
def test_counts(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = quality_rules.judge(df).first()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert tuple(row[n] for n in names) == counts(text)


def test_verdicts(spark):
    clean = "the cat sat on the mat and looked at a bird in the tall green tree there"
    rows = [
        (1, clean),
        (2, "too short to be kept"),
        (3, "same words all the time " * 10),
        (4, " ".join(f"{w}|" for w in clean.split())),
        (5, clean.upper() + " " + " ".join(f"W{i}X" for i in range(20)).upper()),
    ]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in got.collect()}
    assert [got[i]["kept"] for i in range(1, 6)] == [True, False, False, False, False]
    assert got[4]["failed_rules"] == ["symbols"] and not got[4]["base_failed"]
    assert got[5]["failed_rules"] == ["upper_case"]


def test_edges_and_empty(spark, edges):
    got = quality_rules.judge(edges)
    assert got.count() == 10 and got.filter("kept is null or base_failed is null").count() == 0
    assert quality_rules.judge(edges.limit(0)).count() == 0


def test_no_user_functions_and_no_shuffle(spark):
    plan = QUERIES["op6_quality_rules"](spark, SF_DIR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
