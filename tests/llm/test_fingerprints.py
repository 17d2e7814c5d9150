from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from pagetrail.llm import fingerprints as fp
from pagetrail.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def walked_plainly(text):
    """Step by step: the character seen at each step, by the same shared moves."""
    seen, phase = [], 0
    for c in text:
        group = ord(c)
        if group >= 128:
            group = int(fp.mix(fp.np.array([group], fp.np.uint64))[0] >> fp.np.uint64(56))
        after = fp._MOVES[group][phase]
        stays = (after - phase) % fp.PHASES or fp.PHASES
        seen += [c] * stays
        phase = after
    return seen


def share_of_equal_steps(a, b):
    pairs = list(itertools.zip_longest(walked_plainly(a), walked_plainly(b)))
    return sum(x == y for x, y in pairs) / len(pairs)


def prose(seed, n):
    rnd = random.Random(seed)
    return "".join(rnd.choices("etaoin shrdlu cmfwyp", k=n))


def half_replaced(one, other):
    half = len(one) // 2
    return one[: len(one) - half] + other[:half]


def neighbours(rows):
    """(key, text, text of the next) in the order of the operator; distinct keys."""
    known = sorted((r for r in rows if r[0] is not None), reverse=True)
    chain = known + [r for r in rows if r[0] is None]
    return [(k, t or "", chain[(i + 1) % len(chain)][1] or "") for i, (k, t) in enumerate(chain)]


def answer(one, other):
    changed = half_replaced(one, other)
    bits = [fp.sampled_bits(fp.walk(t)) for t in (one, changed, other)]
    return (
        len(one),
        hashlib.sha256(changed.encode()).hexdigest(),
        fp.fingerprint(bits[0]),
        fp.fingerprint(bits[1]),
        fp.likeness(bits[0], bits[1]),
        fp.likeness(bits[0], bits[2]),
    )


COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def answers(df):
    return sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = sorted(((k, *answer(a, b)) for k, a, b in neighbours(rows)), key=str)
    found = answers(QUERIES["op13_fingerprints"](spark, SF))
    assert found == wanted
    apart = [r for r in found if r[1] > 200 and r[6] < 0.5]
    assert len(apart) > 400
    assert sum(r[5] > r[6] for r in apart) > 0.99 * len(apart)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8])
def test_few_rows_in_many_partitions(spark, n):
    rows = [(i if i else None, prose(i, 5 * i) or None) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = sorted(((k, *answer(a, b)) for k, a, b in neighbours(rows)), key=str)
    assert answers(fp.edited_neighbours(docs)) == wanted


def test_edges(spark, edges):
    found = fp.edited_neighbours(edges).collect()
    assert len(found) == edges.count()
    by_key = {}
    for r in found:
        by_key.setdefault(r.doc_id, []).append(r)
    assert by_key[6][0].n_chars == len("long text here " * 20_000)
    assert by_key[3][0].fingerprint == "0:" and by_key[3][0].near_edited == 1.0
    assert by_key[1][0].fingerprint == by_key[1][1].fingerprint
    # the second copy's next document is the first of the next key
    assert {r.near_next == 1.0 for r in by_key[1]} == {True, False}
    plain = fp.fingerprints(edges).filter("doc_id = -7").first()
    assert plain.n_chars == len("ÄÖ ß é　日本 \U0001f600")


def test_walk_equals_plain_steps():
    for text in ("", "a", "abcabc", prose(1, 3000), "ÄÖß" * 50, "日本\U0001f600 x" * 300):
        seen = walked_plainly(text)
        bits = fp.sampled_bits(fp.walk(text))
        count = int((fp.STEPS < len(seen)).sum())
        assert len(bits) == count
        steps = fp.STEPS[:count]
        codes = fp.np.array([ord(seen[s]) for s in steps], fp.np.uint64)
        mixed = fp.mix(codes * fp._SALT + steps.astype(fp.np.uint64))
        assert bits.tolist() == (mixed & fp.np.uint64(1)).tolist()
        assert fp.bits_of(fp.fingerprint(bits)).tolist() == bits.tolist()


def test_long_texts_are_walked_in_pieces_alike(monkeypatch):
    text = prose(3, 5000)
    whole = fp.fingerprint(fp.sampled_bits(fp.walk(text)))
    monkeypatch.setattr(fp, "CHUNK", 64)
    assert fp.fingerprint(fp.sampled_bits(fp.walk(text))) == whole


def test_edited_walk_is_the_walk_over_the_edited_text():
    for a, b in itertools.product(("", "a", "ab", "abc", prose(4, 999)), repeat=2):
        changed = fp.edited(fp.walk(a), fp.walk(b))
        assert fp.text_of(changed) == half_replaced(a, b)
        assert changed.phases == fp.walk(half_replaced(a, b)).phases


def test_likeness_estimates_the_share_of_equal_steps():
    text, errors = prose(5, 4000), []
    for seed in range(12):
        rnd = random.Random(seed)
        other = list(text)
        for _ in range(4 * seed):
            at = rnd.randrange(len(other))
            other[at : at + rnd.choice([0, 1, 2])] = rnd.choice(["", "x", "yz"])
        other = "".join(other)
        bits = [fp.sampled_bits(fp.walk(t)) for t in (text, other)]
        errors.append(fp.likeness(*bits) - share_of_equal_steps(text, other))
    assert max(map(abs, errors)) < 0.2 and abs(sum(errors) / len(errors)) < 0.08
    assert fp.likeness(*[fp.sampled_bits(fp.walk(prose(s, 4000))) for s in (6, 7)]) < 0.35
    bits = fp.sampled_bits(fp.walk(text))
    assert fp.likeness(bits, bits) == 1.0 and fp.likeness(bits, bits[:0]) == 0.0


def test_near_documents_equal_brute_force(spark):
    rnd, rows = random.Random(9), []
    for k in range(40):
        text = prose(100 + k, rnd.randint(300, 3000))
        for _ in range(rnd.randint(1, 4)):
            at = rnd.randrange(len(text))
            rows.append((len(rows), text[:at] + "qq" + text[at + rnd.randint(0, 2) :]))
            rows.append((len(rows), text))
    rows += [(900, None), (901, ""), (None, rows[0][1]), (902, "short"), (903, "short")]
    rows += [(3, rows[40][1])]  # one key, two texts
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a", F.lit(1))
    bits = [fp.sampled_bits(fp.walk(t or "")) for _, t in rows]
    parent = {k: k for k, _ in rows if k is not None}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (i, (k, _)), (j, (m, _)) in itertools.combinations(enumerate(rows), 2):
        if k is None or m is None or not len(bits[i]) or not len(bits[j]):
            continue
        if k == m or fp.likeness(bits[i], bits[j]) >= fp.LEAST_LIKENESS:
            low, high = sorted((root(k), root(m)))
            parent[high] = low
    found = {(r.doc_id, r.class_id) for r in fp.near_documents(docs).collect()}
    assert found == {(k, None if k is None else root(k)) for k, _ in rows}
    assert len({root(k) for k in parent}) < len(parent) - 30
    assert fp.near_documents(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        fp.near_documents(docs, 0.5)
