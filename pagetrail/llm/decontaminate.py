"""Benchmark decontamination by a distributed positional inverted index.

The documents become segments: rows of a table that hold, for some megabytes of text,
the positions of every word of the test items. A phrase is searched in each segment by
taking the positions of the word that is rarest in the whole corpus, shifted by its place in
the phrase, and intersecting them with the shifted positions of its other words, the
rarer ones first. All phrases of a block are intersected together, as arrays. A segment
holds whole documents, so a search needs no shuffle, and no word's list is ever gathered
in one task. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.batches import SLICE_BYTES, lists, slices
from pagetrail.llm.hashing import word_hashes
from pagetrail.llm.text import LOWER_ALNUM, as_bytes
from pagetrail.sources.scratch import scratch_table

WINDOW = 13
BLOCK_WORDS = 1_000_000  # words of items that are searched for, and broadcast, at a time
MAX_TERMS = 8_000_000  # distinct words of items that are broadcast; beyond, all words are indexed
CANDIDATES = 1 << 18  # places that are intersected at a time
GAP = 1 << 20  # between the documents of a segment; no phrase or width is larger

SEARCH_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("found", T.ArrayType(T.StringType())),
]


def words_of(text: bytes) -> np.ndarray:
    """A hash for each run of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    return word_hashes(text.translate(LOWER_ALNUM)).view(np.int64)


@dataclass
class Phrases:
    """Sequences of words, of which every run of ``size`` words is searched for its owner."""

    names: dict[str, int] = field(default_factory=dict)
    words: list[np.ndarray] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    owners: list[int] = field(default_factory=list)

    def add(self, words: np.ndarray, owner: str, size: int | None = None) -> None:
        """Every run of ``size`` words; all words, where they are fewer or no size is given."""
        if len(words):
            self.words.append(words)
            self.sizes.append(min(size or len(words), len(words)))
            self.owners.append(self.names.setdefault(owner, len(self.names)))

    @property
    def n_words(self) -> int:
        return sum(map(len, self.words))

    @property
    def vocabulary(self) -> np.ndarray:
        """The distinct words, sorted."""
        return np.unique(np.concatenate([np.empty(0, np.int64), *self.words]))


@dataclass
class Searched:
    """Runs of words as places in one array, each with its rarest word; eight bytes a word."""

    words: np.ndarray
    seen: np.ndarray  # how often each of the words occurs in the corpus
    starts: np.ndarray
    sizes: np.ndarray
    rarest: np.ndarray  # the offset of the run's rarest word
    owners: np.ndarray

    @classmethod
    def of(cls, phrases: Phrases, seen_of) -> Searched:
        """The runs of which every word occurs; ``seen_of`` tells how often words do."""
        words = np.concatenate([np.empty(0, np.int64), *phrases.words])
        seen = seen_of(words)
        begins = np.cumsum([0, *map(len, phrases.words)])
        runs = []
        for begin, part, size, owner in zip(
            begins, phrases.words, phrases.sizes, phrases.owners, strict=False
        ):
            counts = np.lib.stride_tricks.sliding_window_view(seen[begin : begin + len(part)], size)
            at = np.flatnonzero(counts.min(axis=1) > 0)
            if len(at):
                rarest = counts[at].argmin(axis=1)
                runs.append((begin + at, np.full(len(at), size), rarest, np.full(len(at), owner)))
        columns = zip(*runs, strict=True) if runs else [[np.empty(0)]] * 4
        return cls(words, seen, *(np.concatenate(c).astype(np.int32) for c in columns))


def build_index(
    docs: DataFrame, vocabulary: np.ndarray | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per segment: its documents, and the positions of each word of ``vocabulary``,
    or of all words, if that is None.

    ``key`` may be any column and null; a null text has no words. ``terms`` is sorted;
    the positions of ``terms[i]`` end at ``ends[i]`` and are sorted by document.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        keys, n_words, terms, places = [], [], [], []
        held = 0

        def segment() -> pa.RecordBatch:
            found = np.concatenate(terms)
            order = np.argsort(found, kind="stable")
            distinct, counts = np.unique(found, return_counts=True)
            owner = np.repeat(np.arange(len(n_words), dtype=np.int32), [len(t) for t in terms])
            columns = [
                (n_words, pa.int32()),
                (distinct, pa.int64()),
                (np.cumsum(counts), pa.int64()),
                (owner[order], pa.int32()),
                (np.concatenate(places)[order], pa.int32()),
            ]
            all_keys = pa.concat_arrays(keys)
            one = pa.array([0, len(all_keys)], pa.int32())
            arrays = [pa.ListArray.from_arrays(one, all_keys)]
            arrays += [lists(np.asarray(c), np.array([len(c)]), kind) for c, kind in columns]
            return pa.RecordBatch.from_arrays(arrays, index_schema.names)

        for batch in slices(batches, "_text"):
            keys.append(batch.column("_key"))
            for data in batch.column("_text").to_pylist():
                words = words_of(data)
                at = np.flatnonzero(_among(words, wanted))
                terms.append(words[at])
                places.append(at.astype(np.int32))
                n_words.append(len(words))
                held += len(data)
            if held >= 2 * SLICE_BYTES:
                yield segment()
                keys, n_words, terms, places = [], [], [], []
                held = 0
        if n_words:
            yield segment()

    source = docs.select(F.col(key).alias("_key"), as_bytes(F.col(text)).alias("_text"))
    index_schema = T.StructType(
        [
            T.StructField("keys", T.ArrayType(source.schema["_key"].dataType)),
            T.StructField("n_words", T.ArrayType(T.IntegerType())),
            T.StructField("terms", T.ArrayType(T.LongType())),
            T.StructField("ends", T.ArrayType(T.LongType())),
            T.StructField("owners", T.ArrayType(T.IntegerType())),
            T.StructField("positions", T.ArrayType(T.IntegerType())),
        ]
    )
    return source.mapInArrow(run, index_schema)


def _among(words: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    """Which of the words are in a sorted array; all, if that is None."""
    if wanted is None:
        return np.ones(len(words), bool)
    if not len(wanted):
        return np.zeros(len(words), bool)
    at = np.searchsorted(wanted, words)
    at[at == len(wanted)] = 0
    return wanted[at] == words


def term_counts(index: DataFrame) -> DataFrame:
    """``term`` and ``n``: occurrences of each word in the whole corpus."""
    each = index.select(
        F.explode(
            F.transform(
                F.col("terms"),
                lambda t, i: F.struct(
                    t.alias("term"),
                    (F.get("ends", i) - F.coalesce(F.get("ends", i - 1), F.lit(0))).alias("n"),
                ),
            )
        ).alias("x")
    )
    return each.groupBy(F.col("x.term").alias("term")).agg(F.sum("x.n").alias("n"))


def _seen(counts: DataFrame, phrases: Phrases):
    """How often words occur, as a function; a row for each distinct word of a block is fetched."""
    terms = phrases.vocabulary
    wanted = counts.sparkSession.createDataFrame(pa.table({"term": terms}))
    found = counts.join(wanted, "term", "left_semi").toArrow()
    known, numbers = found["term"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(known)
    known, numbers = known[order], numbers[order]

    def seen_of(words: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(words), np.int64)
        at = np.searchsorted(known, words)
        at[at == len(known)] = 0
        return np.where(known[at] == words, numbers[at], 0)

    return seen_of


class Segment:
    """One row of the index, with each word's places counted through all its documents."""

    def __init__(self, n_words, terms, ends, owners, positions):
        self.n_words = n_words.astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.n_words + GAP)]) + GAP
        self.terms, self.ends = terms, np.concatenate([[0], ends])
        self.places = self.base[owners] + positions
        order = np.argsort(self.places)
        # The word at each place, to tell whether a shifted place is in that word's list.
        self.by_place = self.places[order]
        self.word_at = np.repeat(terms, np.diff(self.ends))[order]

    def _lists(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the position lists of the words begin and end."""
        if not len(self.terms):
            return np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at = np.searchsorted(self.terms, words)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == words
        return np.where(known, self.ends[at], 0), np.where(known, self.ends[at + 1], 0)

    def occurrences(self, word: int) -> np.ndarray:
        (start,), (stop,) = self._lists(np.array([word]))
        return self.places[start:stop]

    def _has(self, words: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each word's list holds the place beside it."""
        at = np.searchsorted(self.by_place, places)
        at[at == len(self.by_place)] = 0
        return (self.by_place[at] == places) & (self.word_at[at] == words)

    def phrases(self, searched: Searched) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts, numbers of runs) of all occurrences: shifted lists intersected from the
        rarest word on, for a bounded number of places at a time."""
        rarest = searched.words[searched.starts + searched.rarest]
        begins, ends = self._lists(rarest)
        runs = np.flatnonzero(ends > begins)
        for size in np.unique(searched.sizes[runs]):
            of_size = runs[searched.sizes[runs] == size]
            lengths = (ends - begins)[of_size]
            group = np.cumsum(lengths) // CANDIDATES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(of_size)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield from self._together(searched, of_size[a:b], int(size), begins, lengths[a:b])

    def _together(self, searched, runs, size, begins, lengths):
        """The occurrences of runs of one size."""
        which = np.repeat(np.arange(len(runs)), lengths)
        skipped = np.arange(len(which)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        words_at = searched.starts[runs][:, None] + np.arange(size)
        order = np.argsort(searched.seen[words_at], axis=1, kind="stable")
        words = np.take_along_axis(searched.words[words_at], order, axis=1)
        starts = self.places[begins[runs][which] + skipped] - searched.rarest[runs][which]
        for rank in range(size):
            if not len(starts):
                return
            held = self._has(words[which, rank], starts + order[which, rank])
            starts, which = starts[held], which[held]
        if len(starts):
            yield starts, runs[which]

    def near(self, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of at most ``width`` words that hold all the words and
        begin with one of them."""
        found = [self.occurrences(t) for t in np.unique(terms)]
        starts, ends = [], []
        if all(len(x) for x in found):
            for left in found:
                last = left
                for places in found:
                    at = np.searchsorted(places, left)
                    inside = at < len(places)
                    reach = np.where(inside, places[np.where(inside, at, 0)], left + GAP)
                    last = np.maximum(last, reach)
                fits = last - left < width
                starts.append(left[fits])
                ends.append(last[fits] + 1)
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(starts), np.concatenate(ends)

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, places, side="right") - 1


def _by_document(segment: Segment, hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Merged spans and distinct owners of each document, from (starts, ends, owner numbers)."""
    n = len(segment.n_words)
    spans: list[list[list[int]]] = [[] for _ in range(n)]
    found: list[list[int]] = [[] for _ in range(n)]
    if hits:
        starts, ends, owners = (np.concatenate(x) for x in zip(*hits, strict=True))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
        first = np.concatenate([[True], starts[1:] > ends[:-1]])
        last = np.concatenate([first[1:], [True]])
        for a, b in zip(starts[first], ends[last], strict=True):
            doc = int(segment.documents(a))
            spans[doc].append([int(a - segment.base[doc]), int(b - segment.base[doc])])
        pairs = np.unique(
            np.stack([segment.documents(starts), owners[order]], axis=1), axis=0
        )
        for doc, owner in pairs.tolist():
            found[doc].append(owner)
    return spans, found


def _search(index: DataFrame, phrases: Phrases, hits_of) -> DataFrame:
    """A row per document: key, n_words, merged spans [start, end) and the names found.

    ``hits_of(segment)`` gives (starts, ends, numbers of names) arrays.
    """
    names = index.sparkSession.sparkContext.broadcast(list(phrases.names))
    key_type = index.schema["keys"].dataType.elementType
    schema = T.StructType([T.StructField("key", key_type), *SEARCH_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {
                    name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)
                    for name in ("n_words", "terms", "ends", "owners", "positions")
                }
                segment = Segment(**row)
                spans, found = _by_document(segment, hits_of(segment))
                arrays = [
                    batch.column("keys")[i].values,
                    pa.array(row["n_words"], pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array([[names.value[o] for o in f] for f in found], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return index.mapInArrow(run, schema)


def find_phrases(
    index: DataFrame, phrases: Phrases, counts: DataFrame | None = None
) -> DataFrame:
    """Exact matches of all phrases, as rows of ``_search``. ``counts`` are ``term_counts``,
    where they are written already."""
    counts = term_counts(index) if counts is None else counts
    searched = Searched.of(phrases, _seen(counts, phrases))
    shared = index.sparkSession.sparkContext.broadcast(searched)

    def hits_of(segment: Segment):
        wanted = shared.value
        return [
            (starts, starts + wanted.sizes[runs], wanted.owners[runs])
            for starts, runs in segment.phrases(wanted)
        ]

    return _search(index, phrases, hits_of)


def find_near(index: DataFrame, phrases: Phrases, width: int) -> DataFrame:
    """Runs of at most ``width`` words that hold all words of a phrase, in any order.

    A word that a phrase has twice is needed once. Null, empty and long texts, repeated rows
    and empty tables are as in ``build_index``: a row for every document, with what it has.
    """
    if width > GAP:
        raise ValueError(f"width is at most {GAP}")
    shared = index.sparkSession.sparkContext.broadcast((phrases.words, phrases.owners))

    def hits_of(segment: Segment):
        hits = []
        for words, owner in zip(*shared.value, strict=True):
            starts, ends = segment.near(words, width)
            if len(starts):
                hits.append((starts, ends, np.full(len(starts), owner)))
        return hits

    return _search(index, phrases, hits_of)


def item_blocks(
    items: DataFrame, key: str, text: str, block_words: int, size: int
) -> Iterator[Phrases]:
    """The items with words, in blocks of about ``block_words`` words; one block is held."""
    rows = items.select(
        F.coalesce(F.col(key).cast("string"), F.lit("null")), as_bytes(F.col(text))
    )
    block, held = Phrases(), 0
    for name, data in rows.toLocalIterator():
        words = words_of(bytes(data))
        if held and held + len(words) > block_words:
            yield block
            block, held = Phrases(), 0
        block.add(words, name, size)
        held += len(words)
    if held:
        yield block


def _merged(spans: Column) -> Column:
    """Sorted spans with those that meet or overlap made one."""

    def step(done, x):
        last = F.element_at(done, -1)
        grown = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.array(last[0], F.greatest(last[1], x[1]))),
        )
        return F.when((F.size(done) > 0) & (F.get(last, F.lit(1)) >= x[0]), grown).otherwise(
            F.concat(done, F.array(x))
        )

    start = F.array().cast("array<array<bigint>>")
    return F.aggregate(F.sort_array(spans), start, step)


def contaminated_documents(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row per row of ``docs``: key, n_words, n_hit, n_items, items, spans, contaminated.

    A window is ``size`` consecutive words of an item, or all words of a shorter item. A
    document's word is hit if it lies in an occurrence of a window. ``items`` are the ids
    as sorted strings; a null id counts as ``null``, items with one id count as one.
    ``contaminated``: at least a twentieth of the words are hit. Null and empty texts,
    and empty tables, give no hits; repeated rows are judged each. The corpus is indexed
    once, by the distinct words of all items, or by all words if these are more than
    ``MAX_TERMS``. Items are read twice, for their words and then in blocks of
    ``block_words`` words, which are searched for one after the other.
    """
    if size >= GAP:
        raise ValueError(f"a window is shorter than {GAP} words")
    identity = F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("hash"))
    rows = docs.select(identity.alias("_row"), F.col(text).alias("_text"))
    read = (items, item_key, item_text, block_words, size)
    vocabulary: np.ndarray | None = np.empty(0, np.int64)
    for block in item_blocks(*read):
        vocabulary = np.union1d(vocabulary, block.vocabulary)
        if len(vocabulary) > MAX_TERMS:
            vocabulary = None
            break
    index = scratch_table(build_index(rows, vocabulary, "_row", "_text"), "postings")
    most = index.agg(F.sum(F.size("terms"))).first()[0] or 0
    counts = scratch_table(term_counts(index), "counts", most)
    parts = [find_phrases(index, block, counts) for block in item_blocks(*read)]
    parts = parts or [find_phrases(index, Phrases(), counts)]
    parts = [part.withColumnRenamed("found", "items") for part in parts]
    result = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            result = result.unionByName(part)
        result = (
            result.groupBy("key", "n_words")
            .agg(
                F.flatten(F.collect_set("spans")).alias("spans"),
                F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
                (F.count("*") / len(parts)).cast("int").alias("_copies"),
            )
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select("key", "n_words", _merged(F.col("spans")).alias("spans"), "items")
        )
    hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0]
    )
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return result.select(
        F.col("key.id").alias(key),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sort_array("items").alias("items"),
        "spans",
    ).withColumn("contaminated", contaminated)
