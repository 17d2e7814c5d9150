from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from pagetrail.llm import bpe
from pagetrail.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ours():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Tokenizer(file.read())


@pytest.fixture(scope="module")
def library():
    tokenizer = Library.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def equal(ours, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = ours.encode(text)
    assert got.tolist() == want, text[:80]
    assert ours.decode(got) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "",
        " \t\n",
        "It's WE'LL i'D 'sss''t",
        "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|> <|endoftext|>́",
        "ΣΑΣ Σ İ ǅ É Ᲊ Ƛ",
        "\x1c a\x1db\x85c　d e​f\x00",
        "日本語 ١٢٣ 12.5 --- a_b 😀👍🏽",
    ],
)
def test_hand_written(ours, library, text):
    equal(ours, library, text)


def test_random_words(ours, library):
    rnd = random.Random(7)
    for letters, longest in (("abcdeth inger's", 200), ("aaabhtnghe", 900), ("ééüñaß", 300)):
        for _ in range(100):
            equal(ours, library, "".join(rnd.choices(letters, k=rnd.randrange(1, longest))))


def test_every_character(ours, library):
    for start in range(0, 0x110000, 64):
        chars = [chr(i) for i in range(max(start, 1), start + 64) if not 0xD800 <= i < 0xE000]
        equal(ours, library, " ".join(f"a{c}b" for c in chars))


def test_long_word_in_bounded_memory(ours):
    """Only the symbols whose tokens may still change are held."""
    rnd = random.Random(3)
    word = "".join(rnd.choices("etaoinshr", k=20_000))
    transducer, most, tokens = bpe.Transducer(ours.merges), 0, []
    for symbol in word[:-1]:
        tokens += transducer.feed(symbol)
        most = max(most, len(transducer.text))
    tokens += transducer.finish(word[-1])
    assert "".join(tokens) == word + "</w>"
    assert most < 4 * ours.merges.lookahead
    for left, right in zip(tokens, tokens[1:], strict=False):
        assert ours.merges.adjacent(left, right)


def words_of(letters, rnd, longest=12, n=3000):
    return ["".join(rnd.choices(letters, k=rnd.randrange(1, longest))) for _ in range(n)]


def test_new_words_take_their_steps_together(ours, library, monkeypatch):
    """Many new words cost no Python step for each of their symbols."""
    steps, ending = [], bpe.Merges.ending
    counted = lambda self, *args: steps.append(1) or ending(self, *args)
    monkeypatch.setattr(bpe.Merges, "ending", counted)
    text = " ".join(words_of("bcdfghklmnopuvwyz", random.Random(21)))
    equal(ours, library, text)
    assert not steps


def test_many_words_equal_library(ours, library):
    rnd = random.Random(11)
    far = "aeéüñßжλ日本語한국어क्षि\u0301\U0001f600ÉΣİ"
    texts = [" ".join(words_of(letters, rnd)) for letters in ("ethaoinsr'", "aab", "x1.,-!é", far)]
    texts += [" ".join("é" * n + "a" * m for n in range(28, 36) for m in range(20))]
    texts += ["".join(f"{w}<|endoftext|>" for w in words_of("hijklo", rnd)), "", " \n", "a" * 5000]
    texts += [" ".join(words_of("eta", rnd, longest=150))]
    got = ours.encode_all(texts)
    for text, ids in zip(texts, got, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text[:80]
    assert [ids.tolist() for ids in ours.encode_all(texts[::-1])] == [i.tolist() for i in got[::-1]]


def test_words_in_groups_and_full_caches(library, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP", 500)
    monkeypatch.setattr(bpe, "CHUNK", 200)
    monkeypatch.setattr(bpe, "FEW_WORDS", 5)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 60)
    monkeypatch.setattr(bpe, "PAIR_SLOTS", 16)
    with open(PATH, encoding="utf-8") as file:
        small = bpe.Tokenizer(file.read())
    rnd, most = random.Random(13), 0
    for _ in range(5):
        texts = [" ".join(words_of("ethaoin", rnd, n=60, longest=6)) for _ in range(9)]
        for text, ids in zip(texts, small.encode_all(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        most = max(most, len(small._words.newer), len(small._words.older))
    assert 0 < most <= 30


def test_neighbours_of_many_pairs(ours):
    names, rnd = sorted(ours.merges.tokens), random.Random(17)
    merges, many = ours.merges, ours.transducers
    number = {many.ids[i]: i for i in range(many.n)}
    pairs = [(rnd.choice(names), rnd.choice(names)) for _ in range(3000)]
    pairs += [merges.parts[rnd.randrange(len(merges.parts))] for _ in range(300)]
    pairs = [(a, b) for a, b in pairs if not a.endswith("</w>") and {a, b} <= merges.tokens]
    sides = [np.array([number[merges.ids[p[side]]] for p in pairs]) for side in (0, 1)]
    want = [merges.adjacent(a, b) for a, b in pairs]
    assert 0 < sum(want) < len(want)
    for _ in range(2):  # once worked out, once remembered
        assert many.adjacent(*sides).tolist() == want


def test_vocabulary_without_end_mark():
    parts = [("a", "b"), ("b", "a"), ("ab", "ab"), ("a", "a"), ("aa", "ba"), ("c", "ab")]
    ids = {t: i for i, t in enumerate(["a", "b", "c", *(x + y for x, y in parts)])}
    merges, rnd = bpe.Merges(parts, ids, ""), random.Random(19)
    many = bpe.Transducers(merges, dict(enumerate(bpe.byte_alphabet())))
    words = words_of("aabbc", rnd, longest=40, n=400)
    got = many.encode([w.encode() for w in words])
    for word, found in zip(words, got, strict=True):
        assert np.frombuffer(found, np.int32).tolist() == [ids[t] for t in merges.merge(list(word))]
    assert many.encode([]) == []
    with pytest.raises(ValueError, match="no token"):
        many.encode([b"abd"])


def test_readable_text(ours):
    assert ours.text(ours.encode("Größe 日本 naïve<|endoftext|>x")) == (
        "größe 日本 naïve <|endoftext|>x "
    )


def test_readable_text_of_rows(spark):
    texts = ["Größe 日本 naïve<|endoftext|>x", "a \U0001f600", "", None, "word " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.decode(bpe.encode(docs, PATH), PATH, keep=("doc_id",), readable=True)
    assert got.columns == ["doc_id", "decoded"]
    assert {r["doc_id"]: r["decoded"] for r in got.collect()} == dict(
        enumerate(["größe 日本 naïve <|endoftext|>x ", "a \U0001f600 ", "", "", "word " * 5000])
    )


def test_edge_rows(spark):
    rows = [(1, "a b"), (None, "a b"), (2, None), (3, ""), (4, "x" * 100_000), (1, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids")
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(got) == 6
    both = bpe.encode(docs, PATH, decoded=True).select("doc_id", "ids", "decoded").collect()
    assert sorted(map(str, both)) == sorted(map(str, got))
    assert sorted(len(r["ids"]) for r in got if r["doc_id"] in (2, 3)) == [0, 0]
    assert {r["decoded"] for r in got if r["doc_id"] == 1} == {"a</w> b</w>"}
    empty = bpe.encode(docs.limit(0), PATH)
    assert empty.columns == ["doc_id", "ids"] and empty.count() == 0


def test_query_equals_library(spark, library):
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op9_bpe"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for row in docs:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        have = got[row["doc_id"]]
        assert have["n_tokens"] == len(ids)
        assert have["ids_sha256"] == digest(" ".join(map(str, ids)))
        assert have["decoded_sha256"] == digest(library.decode(ids, skip_special_tokens=False))


def test_names_cover_all_ids(ours):
    assert len(ours.names) == 49_408 and np.count_nonzero(ours.names == "") == 0
