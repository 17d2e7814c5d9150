"""BPE encoding as a streaming transducer with bounded lookahead, and decoding.

Reads the JSON file of a tokenizer whose model is byte-level BPE with an end-of-word
suffix, lower-casing and a splitting pattern. The vocabulary is a parameter.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import islice
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import lists, offsets, slices

# White space as the pattern engine of the tokenizer has it.
SPACE = "\t-\r \x85\xa0  -     　"
# Texts within the first characters are split by the faster pattern module.
NEAR = 0x250
FAR = re.compile(f"[{chr(NEAR)}-\U0010ffff]")

CHUNK = 1 << 16  # characters split into words at a time, cut at white space
CUT = re.compile("[ \t\n\r]")

# Letters and numbers of the pattern module's character data that the
# tokenizer's own, older data does not have, and capitals (with the distance to their
# small letters) that it has and Python's data does not.
NEWER_LETTERS = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1
ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11df1 16ea0-16eb8
16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2
1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2
1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479
3d000-3fc3f"""
NEWER_NUMBERS = "11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6"
NEWER_CAPITALS = {
    "1c89": 1, "a7cb": -42343, "a7cc": 1, "a7ce": 1, "a7d2": 1, "a7d4": 1, "a7da": 1,
    "a7dc": -42561, "10d50-10d65": 32, "16ea0-16eb8": 27,
}

SLICE = 1 << 20  # bytes of text in a result batch
CACHED_WORDS = 150_000  # entries of each worker's cache
LONG_WORD = 64  # bytes beyond which a word has its own transducer; characters, is not cached
FEW_WORDS = 100  # new words up to which each has a transducer of its own
GROUP = 1 << 19  # characters whose words are looked up together
PAIR_SLOTS = 1 << 19  # pairs of tokens of which is kept whether they may be neighbours


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def code_points(ranges: str) -> list[range]:
    ends = (part.split("-") for part in ranges.split())
    return [range(int(e[0], 16), int(e[-1], 16) + 1) for e in ends]


def category(name: str, newer: str) -> str:
    """A character class: the category without those that the tokenizer does not know."""
    out = "".join(f"\\U{r.start:08x}-\\U{r.stop - 1:08x}" for r in code_points(newer))
    return rf"[\p{{{name}}}--[{out}]]"


def known_characters(pattern: str) -> str:
    pattern = pattern.replace(r"\s", SPACE).replace(r"\p{L}", category("L", NEWER_LETTERS))
    return pattern.replace(r"\p{N}", category("N", NEWER_NUMBERS))


SMALL = {i: i + d for span, d in NEWER_CAPITALS.items() for r in code_points(span) for i in r}
SMALL[ord("Σ")] = ord("σ")
assert min(SMALL) >= NEAR
CAPITALS = re.compile(f"[{''.join(map(chr, sorted(SMALL)))}]")


def near_characters(pattern: str) -> str:
    """The same for texts in the first characters only, with every letter spelt out."""
    pattern = pattern.replace(r"\s", "\t-\r \x85\xa0")
    for name in "LN":
        members = "".join(c for c in map(chr, range(NEAR)) if regex.match(rf"\p{{{name}}}", c))
        pattern = pattern.replace(rf"\p{{{name}}}", members)
    return pattern


def chunks(text: str) -> Iterator[str]:
    """The text in parts that end before white space, which no word or mark crosses."""
    start = 0
    while len(text) - start > CHUNK:
        cut = CUT.search(text, start + CHUNK)
        stop = cut.start() if cut else len(text)
        yield text[start:stop]
        start = stop
    yield text[start:]


class Merges:
    """The merge list: BPE of a symbol sequence, and which tokens may be neighbours."""

    def __init__(self, merges: Iterable[tuple[str, str]], ids: dict[str, int], end: str):
        self.ids = ids
        self.end = end
        self.parts = list(merges)
        self.ranks = {pair: rank for rank, pair in enumerate(self.parts)}
        self.made = {a + b: rank for rank, (a, b) in enumerate(self.parts)}
        self._pairs: dict[tuple[str, str], bool] = {}
        self.tokens = {t for t in ids if self.merge(self.symbols(t)) == [t]}
        lengths = {t: len(self.symbols(t)) for t in self.tokens}
        #: A later token starts at most so many symbols back: the sufficient lookahead.
        self.lookahead = max(lengths.values())
        sizes: dict[str, set[int]] = {}
        for token, n in lengths.items():
            if n > 2:
                sizes.setdefault(self._tail(token), set()).add(n)
        #: By the last three symbols, how long tokens are that end with them.
        self.sizes = {t: (*sorted(found, reverse=True), 2, 1) for t, found in sizes.items()}

    def _tail(self, token: str) -> str:
        return token[-3 - len(self.end) if token.endswith(self.end) else -3 :]

    def symbols(self, token: str) -> list[str]:
        """A token's single symbols, of which the last may carry the end mark."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            head = token[: -len(self.end)]
            return [*head[:-1], head[-1] + self.end]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE: apply the merge of lowest rank until none applies."""
        while len(symbols) > 1:
            ranked = [
                (self.ranks[pair], i)
                for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))
                if pair in self.ranks
            ]
            if not ranked:
                break
            _, i = min(ranked)
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]
        return symbols

    def adjacent(self, left: str, right: str) -> bool:
        """Whether BPE of the two joined gives just these two.

        Undoes the merges that made them, latest first, and looks whether the pieces that
        then meet could have been merged before; of equal merges the left one is first.
        """
        a, b, limit = left, right, len(self.ranks)
        while True:
            rank = self.ranks.get((a, b))
            if rank is not None and rank < limit:
                known = False
                break
            rank_a, rank_b = self.made.get(a, -1), self.made.get(b, -1)
            if rank_a > rank_b:
                a, limit = self.parts[rank_a][1], rank_a
            elif rank_b >= 0:
                b, limit = self.parts[rank_b][0], rank_b + 1
            else:
                known = True
                break
        if len(self._pairs) >= 2_000_000:
            self._pairs.clear()
        self._pairs[left, right] = known
        return known

    def ending(self, text: str, ends: list[str | None], final: str = "") -> str:
        """The token that ends the encoding of all of ``text``, whose prefixes end in ``ends``."""
        n, tokens, pairs = len(text), self.tokens, self._pairs
        for size in self.sizes.get(text[-3:] + final, (2, 1)):
            if size <= n:
                token = text[-size:] + final
                if token in tokens:
                    before = ends[n - size]
                    if before is None or pairs.get((before, token)):
                        return token
                    if (before, token) not in pairs and self.adjacent(before, token):
                        return token
        raise ValueError(f"no token of the vocabulary ends {text[-1:]!r}")


class Transducer:
    """Encodes one word symbol by symbol and emits tokens as soon as they are stable.

    For each prefix of the word there is one token that its encoding ends with: the one
    that may stand after the token the shorter prefix ends with. Tokens that lie on the
    chains of all prefixes at most ``lookahead`` symbols back cannot change any more.
    They are emitted and forgotten, so memory depends on the merge list and not on the
    word.
    """

    def __init__(self, merges: Merges, text: str = "", ends: tuple[str | None, ...] = (None,)):
        self.merges = merges
        self.text = text  # symbols after the last stable token
        self.ends = list(ends)  # the last token of each prefix

    def feed(self, symbols: str) -> list[str]:
        """Take more symbols of the word, none of them its last; the tokens now stable."""
        ending, lookahead, done = self.merges.ending, self.merges.lookahead, []
        text, ends = self.text, self.ends
        for symbol in symbols:
            text += symbol
            ends.append(ending(text, ends))
            if len(text) % lookahead == 0:
                self.text, self.ends = text, ends
                done += self._stable()
                text, ends = self.text, self.ends
        self.text = text
        return done

    def finish(self, symbol: str) -> list[str]:
        """Take the last symbol of the word; the rest of its tokens."""
        last = self.merges.ending(self.text + symbol, self.ends, self.merges.end)
        at = len(self.text) + 1 - (len(last) - len(self.merges.end))
        return [*self._chain(at), last]

    def _chain(self, at: int) -> list[str]:
        tokens = []
        while at > 0:
            tokens.append(self.ends[at])
            at -= len(tokens[-1])
        return tokens[::-1]

    def _stable(self) -> list[str]:
        newest = len(self.text)
        open_ends = set(range(max(0, newest - self.merges.lookahead + 1), newest + 1))
        while len(open_ends) > 1:
            at = max(open_ends)
            open_ends.remove(at)
            open_ends.add(at - len(self.ends[at]))
        at = open_ends.pop()
        tokens = self._chain(at)
        self.text, self.ends = self.text[at:], self.ends[at:]
        return tokens


class Table:
    """Whole numbers by whole numbers of 0 or more, looked up for many keys at once."""

    def __init__(self, values: dict[int, int]):
        self.bits = max(4, (4 * len(values)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        keys = np.fromiter(values.keys(), np.int64, len(values))
        numbers = np.fromiter(values.values(), np.int32, len(values))
        at = slots(keys, self.bits)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several for one slot the last
            self.values[at[free]] = numbers[free]
            left = self.keys[at] != keys
            keys, numbers, at = keys[left], numbers[left], self._next(at[left])

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = slots(keys, self.bits)
        found = self.keys[at]
        hit = found == keys
        out = np.where(hit, self.values[at], -1)
        left = np.flatnonzero(~hit & (found >= 0))
        while len(left):
            at[left] = self._next(at[left])
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each key belongs in a table of 2 ** bits."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


class Transducers:
    """The transducer for many words at once, all of them taken a symbol further together.

    What ``Merges`` holds by names is held here by numbers: the tokens as a tree of their
    bytes from the last to the first, the merges as tables. Words of at most ``LONG_WORD``
    bytes, so that the tokens of all their prefixes can be kept.
    """

    def __init__(self, merges: Merges, alphabet: dict[int, str]):
        end, bytes_of = merges.end, {c: b for b, c in alphabet.items()}
        names = {*merges.ids, *merges.made, *(t for pair in merges.parts for t in pair)}
        numbers = {t: i for i, t in enumerate(names)}
        self.n = len(numbers)
        #: By token: its id, how many bytes it has, the rank of the merge that makes it, its parts.
        self.ids, self.sizes, self.made, self.left, self.right = np.full(
            (5, self.n), -1, np.int32
        )
        ranks: dict[int, int] = {}
        for (a, b), rank in merges.ranks.items():
            ranks[numbers[a] * self.n + numbers[b]] = rank
        for token, rank in merges.made.items():
            i, (a, b) = numbers[token], merges.parts[rank]
            self.made[i], self.left[i], self.right[i] = rank, numbers[a], numbers[b]
        self.ranks, self.n_ranks = Table(ranks), len(merges.ranks)
        #: Nodes 0 and 1 are the roots for tokens within a word and at its end.
        self.last_root = 1 if end else 0
        children: dict[int, int] = {}
        tokens: dict[int, int] = {}
        for token in merges.tokens:
            symbols = merges.symbols(token)
            final = bool(end) and len(symbols[-1]) > 1
            body = token[: -len(end)] if final else token
            if not all(c in bytes_of for c in body):
                continue
            i, node = numbers[token], int(final)
            self.ids[i], self.sizes[i] = merges.ids[token], len(symbols)
            for c in reversed(body):
                node = children.setdefault(node << 8 | bytes_of[c], len(children) + 2)
            tokens[node] = i
        self.children = Table(children)
        self.token_at = np.full(len(children) + 2, -1, np.int32)
        self.token_at[list(tokens.keys())] = list(tokens.values())
        self._pairs = np.full(PAIR_SLOTS, -1, np.int64)  # 2 * pair + whether neighbours

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as the bytes of whole numbers."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        lengths = np.fromiter((len(words[i]) for i in order), np.int64, len(words))
        data = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
        starts = np.cumsum(lengths) - lengths
        ends = np.full(len(data), -1, np.int32)
        for i in range(int(lengths[0]) if len(words) else 0):
            longer, active = np.searchsorted(-lengths, (-i - 1, -i))
            node = np.zeros(active, np.int64)
            node[longer:] = self.last_root
            self._step(data, ends, starts[:active] + i, node, i + 1)
        if (ends < 0).any():
            raise ValueError("a word has a symbol that no token of the vocabulary ends with")
        chosen = np.zeros(len(data), bool)
        at, first = starts + lengths - 1, starts
        while len(at):
            chosen[at] = True
            at = at - self.sizes[ends[at]]
            at, first = at[at >= first], first[at >= first]
        raw = self.ids[ends[chosen]].tobytes()
        stops = (4 * np.cumsum(chosen))[starts + lengths - 1].tolist()
        out: list[bytes] = [b""] * len(words)
        for i, a, b in zip(order, [0, *stops], stops, strict=False):
            out[i] = raw[a:b]
        return out

    def _step(
        self, data: np.ndarray, ends: np.ndarray, at: np.ndarray, node: np.ndarray, length: int
    ) -> None:
        """Sets the tokens that the prefixes of ``length`` end with, whose last bytes are ``at``."""
        for size in range(1, length + 1):
            node = self.children.get(node << 8 | data[at - (size - 1)])
            going = node >= 0
            at, node = at[going], node[going]
            if not len(at):
                return
            token = self.token_at[node]
            known = np.flatnonzero(token >= 0)
            if size < length:
                known = known[self.adjacent(ends[at[known] - size], token[known])]
            ends[at[known]] = token[known]
            going = np.ones(len(at), bool)
            going[known] = False
            at, node = at[going], node[going]

    def adjacent(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``Merges.adjacent`` of many pairs of tokens."""
        pairs = left.astype(np.int64) * self.n + right
        at = slots(pairs, PAIR_SLOTS.bit_length() - 1)
        known = self._pairs[at]
        out = (known & 1).astype(bool)
        new = np.flatnonzero(known >> 1 != pairs)
        if len(new):
            out[new] = self._adjacent(left[new], right[new])
            self._pairs[at[new]] = 2 * pairs[new] + out[new]
        return out

    def _adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        rows, limit = np.arange(len(a)), np.full(len(a), self.n_ranks)
        while len(rows):
            rank = self.ranks.get(a.astype(np.int64) * self.n + b)
            joined = (rank >= 0) & (rank < limit)
            out[rows[joined]] = False
            rank_a, rank_b = self.made[a], self.made[b]
            going = np.flatnonzero(~joined & (np.maximum(rank_a, rank_b) >= 0))
            rows, a, b, rank_a, rank_b = (x[going] for x in (rows, a, b, rank_a, rank_b))
            undo = rank_a > rank_b
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
            limit = np.where(undo, rank_a, rank_b + 1)
        return out


class Tokenizer:
    """The tokenizer of a JSON file: normalise, split, transduce; and back to text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, vocabulary = spec["model"], dict(spec["model"]["vocab"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end = model.get("end_of_word_suffix") or ""
        self._merge_list, self._vocabulary = merges, vocabulary
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")"
        )
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(known_characters(pattern), regex.V1).findall
        self.near_words = re.compile(near_characters(pattern)).findall
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.names = np.empty(max([*vocabulary.values(), *self.added.values()]) + 1, object)
        self.names[:] = ""
        for token, i in {**vocabulary, **self.added}.items():
            self.names[i] = token
        self.special = np.isin(np.arange(len(self.names)), list(self.added.values()))
        self._words = _Bounded(CACHED_WORDS, self._ids_of)

    @cached_property
    def merges(self) -> Merges:
        return Merges(self._merge_list, self._vocabulary, self.end)

    @cached_property
    def transducers(self) -> Transducers:
        return Transducers(self.merges, self.alphabet)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each whole text; words are looked up ``GROUP`` characters at a time."""
        ids: list[list[bytes]] = [[] for _ in texts]
        found: list[bytes | None] = []  # what the words of the group give, as far as known
        unknown: list[str] = []  # the others of its words
        parts: list[tuple[int, int, bytes]] = []  # text, where its words end, added token after
        characters = 0

        def flush() -> None:
            values, start = iter(self._words.computed(unknown)), 0
            whole = [next(values) if x is None else x for x in found]
            for i, stop, added in parts:
                ids[i].append(b"".join(whole[start:stop]) + added)
                start = stop
            for done in (found, unknown, parts):
                done.clear()

        for i, text in enumerate(texts):
            for chunk in chunks(text):
                for part, added in self._parts(chunk):
                    plain = self.normalise(part)
                    near = plain.isascii() or not FAR.search(plain)
                    words = (self.near_words if near else self.words)(plain)
                    known = self._words.known(words)
                    unknown += [w for w, x in zip(words, known, strict=True) if x is None]
                    found += known
                    parts.append((i, len(found), added))
                characters += len(chunk)
                if characters >= GROUP:
                    flush()
                    characters = 0
        flush()
        return [np.frombuffer(b"".join(pieces), np.int32) for pieces in ids]

    def _parts(self, chunk: str) -> Iterator[tuple[str, bytes]]:
        """What stands between added tokens, each time with the id of the token after it."""
        if not any(token in chunk for token in self.added):
            yield chunk, b""
            return
        plain = [*self.added_pattern.split(chunk), ""]
        for part, token in zip(plain[::2], plain[1::2], strict=True):
            yield part, np.int32(self.added[token]).tobytes() if token else b""

    @staticmethod
    def normalise(text: str) -> str:
        """NFC, then lower case character by character: a sigma has no final form."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        if FAR.search(text) and CAPITALS.search(text):
            text = text.translate(SMALL)
        return text.lower()

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of each word, those of short words together where there are many."""
        coded = [word.encode("utf-8", "replace") for word in words]
        if len(words) <= FEW_WORDS:
            return [self._word(word) for word in coded]
        short = iter(self.transducers.encode([w for w in coded if len(w) <= LONG_WORD]))
        return [next(short) if len(w) <= LONG_WORD else self._word(w) for w in coded]

    def _word(self, word: bytes) -> bytes:
        symbols, ids = word.decode("latin-1").translate(self.alphabet), self.merges.ids
        transducer = Transducer(self.merges)
        tokens = transducer.feed(symbols[:-1]) + transducer.finish(symbols[-1])
        return np.array([ids[t] for t in tokens], np.int32).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """What the file's decoder gives; it names none, so the tokens joined by spaces."""
        return " ".join(self.names[ids])

    def text(self, ids: Iterable[int]) -> str:
        """Readable text: bytes decoded as they come, a space after each word."""
        return "".join(TextDecoder(self).feed(ids))


class TextDecoder:
    """Ids to text, piece by piece: holds back the bytes of an unfinished character."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.bytes_of = {c: b for b, c in tokenizer.alphabet.items()}
        self.decoder = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> Iterator[str]:
        end = self.tokenizer.end
        for i in ids:
            token = self.tokenizer.names[i]
            if self.tokenizer.special[i]:
                yield self.decoder.decode(b"", True) + token
                self.decoder.reset()
                continue
            ends_word = bool(end) and token.endswith(end) and len(token) > len(end)
            body = token[: -len(end)] if ends_word else token
            yield self.decoder.decode(bytes(self.bytes_of[c] for c in body), ends_word)
            if ends_word:
                self.decoder.reset()
                yield " "


class _Bounded:
    """Results by short text, for each Python worker; when full, the older half goes."""

    def __init__(self, most: int, compute: Callable[[list[str]], list[Any]]):
        self.most, self.compute = most, compute
        self.newer: dict[str, Any] = {}
        self.older: dict[str, Any] = {}

    def known(self, texts: list[str]) -> list[Any]:
        """The result of each text, None where it is not at hand."""
        return list(map(self.newer.get, texts))

    def computed(self, texts: list[str]) -> list[Any]:
        """The result of each text that was not at hand, all new ones computed together."""
        values = dict.fromkeys(texts)
        for text in values.keys() & self.older.keys():
            values[text] = self.older[text]
        new = [text for text, value in values.items() if value is None]
        values.update(zip(new, self.compute(new), strict=True))
        short = (text for text in values if len(text) <= LONG_WORD)
        kept = {text: values[text] for text in islice(short, self.most // 2)}
        if 2 * (len(self.newer) + len(kept)) > self.most:
            self.older, self.newer = self.newer, kept
        else:
            self.newer.update(kept)
        return [values[text] for text in texts]


@lru_cache(maxsize=2)
def tokenizer_of(source: str) -> Tokenizer:
    return Tokenizer(source)


def _shared(df: DataFrame, path: str):
    """The tokenizer's file, whose size does not depend on the data, for all executors."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(
    df: DataFrame,
    path: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    decoded: bool = False,
) -> DataFrame:
    """The ``keep`` columns and ``ids`` (array of int) of every whole text.

    With ``decoded`` also the text the tokenizer makes of the ids again, as ``decode``
    has it, in the same Python workers. Null and empty texts have no ids; repeated rows
    are encoded like any other. Other columns are left out, so none clashes. No shuffle,
    and no state between rows but a bounded cache.
    """
    shared = _shared(df, path)
    source = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [*source.select(*keep).schema.fields]
    fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(shared.value)
        for batch in slices(batches, "_text", SLICE):
            ids = tokenizer.encode_all(batch.column("_text").to_pylist())
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            arrays = [batch.column(c) for c in keep]
            arrays.append(lists(np.concatenate(ids), lengths, pa.int32()))
            if decoded:
                arrays.append(pa.array([tokenizer.decode(i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)


def decode(
    df: DataFrame,
    path: str,
    ids: str = "ids",
    keep: tuple[str, ...] = ("doc_id", "ids"),
    readable: bool = False,
) -> DataFrame:
    """The ``keep`` columns and ``decoded``: the text the tokenizer's decoder makes of the ids,
    or if ``readable`` what ``TextDecoder`` makes of their bytes."""
    shared = _shared(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(shared.value)
        text_of = tokenizer.text if readable else tokenizer.decode
        for batch in slices(batches, "_ids", 1 << 20):
            column = batch.column("_ids")
            at, flat = offsets(column), column.values.to_numpy(zero_copy_only=False)
            texts = [text_of(flat[a:b]) for a, b in zip(at, at[1:], strict=False)]
            arrays = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(texts, pa.string())], [*keep, "decoded"]
            )

    empty = F.array().cast("array<int>")
    source = df.select(*keep, F.coalesce(F.col(ids), empty).alias("_ids"))
    schema = T.StructType(
        [*source.select(*keep).schema.fields, T.StructField("decoded", T.StringType())]
    )
    return source.mapInArrow(run, schema)
