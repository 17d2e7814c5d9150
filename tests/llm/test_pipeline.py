from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pagetrail.llm import batches, bpe, quality_rules
from tests.llm.brute import contaminated, near_duplicates, without_repeats
from tests.llm.test_quality_rules import counts

SF_DIR = "/root/testdata/sf0.001"


def passes(text):
    n_words, _, _, _, n_repeat = counts(text)
    return n_words >= 10 and 100 * n_repeat <= 20 * n_words


@pytest.fixture(scope="module")
def staged(spark):
    docs = corpus_pipeline.table(spark, SF_DIR, "documents")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        step = stage(spark, tables[-1], SF_DIR)
        tables.append(corpus_pipeline.scratch_table(step, name.replace(" ", "-")))
    return tables


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_by_brute_force(spark, staged):
    docs, good, lines, distinct, clean, coded = staged
    for df in staged[1:-1]:
        assert df.columns == docs.columns
    kept = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    assert {i for i, _ in texts(good)} == kept <= {i for i, t in texts(docs) if passes(t)}
    want = without_repeats(texts(good))
    before = dict(texts(good))
    assert dict(texts(lines)) == {
        i: t for i, t in want.items() if t == before[i] or t.strip(" \t\n\x0b\f\r")
    }
    assert lines.filter(F.length("text") != F.col("n_chars")).count() == 0
    groups = near_duplicates(texts(lines), 80)
    assert {i for i, _ in texts(distinct)} == {i for i, (_, c) in groups.items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = contaminated(texts(distinct), items)
    assert {i for i, _ in texts(clean)} == {
        i for i, (n, hit, _) in found.items() if not (hit and 20 * hit >= n)
    }
    library = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r for r in coded.collect()}
    assert got.keys() == dict(texts(clean)).keys()
    for i, text in texts(clean):
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_run_equals_the_stages(spark, staged):
    ran = corpus_pipeline.run(spark, SF_DIR)
    assert ran.columns == staged[-1].columns
    assert sorted(map(str, ran.collect())) == sorted(map(str, staged[-1].collect()))


def test_edges_pass_every_stage(spark, edges):
    docs = edges.withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF_DIR)
        assert name == "bpe" or got.columns == docs.columns
        assert got.count() <= 10
        empty = stage(spark, docs.limit(0), SF_DIR)
        assert empty.count() == 0
    assert corpus_pipeline.lines(spark, docs, SF_DIR).count() == 10
    # One row of each id, and both rows without one.
    assert corpus_pipeline.distinct(spark, docs, SF_DIR).count() == 9


def test_one_row_of_each_id_stays_and_always_the_same(spark):
    words = "one two three four five six seven"
    rows = [(1, words, "b"), (1, words, "a"), (1, words + " eight", "c"), (2, words, "d")]
    rows += [(3, "u v w x y z", "e"), (None, words, "f"), (None, words, "f"), (4, None, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = None
    for parts in (1, 5):
        got = corpus_pipeline.distinct(spark, docs.repartition(parts), SF_DIR).collect()
        ids = sorted((r.doc_id for r in got), key=str)
        assert ids == [1, 3, 4, None, None]
        one = [tuple(r) for r in got if r.doc_id == 1]
        assert want is None or one == want
        want = one
    assert want[0] in (rows[1], rows[2])  # of one text the first in the order of the columns


def test_documents_without_an_id_are_judged_too(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    rows = [(None, item), (None, "nothing of it"), (7, item), (7, "other text"), ("8", None)]
    docs = spark.createDataFrame([(None if i is None else int(i), t) for i, t in rows], "doc_id long, text string")
    got = corpus_pipeline.uncontaminated(spark, docs, SF_DIR).collect()
    assert sorted(map(str, got)) == sorted(map(str, (docs.filter(
        "text is null or text in ('nothing of it', 'other text')").collect())))


def test_encoded_edges(spark, edges):
    got = corpus_pipeline.encoded(spark, edges, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = got.collect()
    assert len(rows) == 10 and all(r.n_tokens == len(r.ids) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {0}


def test_vocabulary_is_not_in_the_repository():
    assert bpe.__file__ and not corpus_pipeline.public_tokenizers.path("word_bpe_49k.json").startswith(
        "/root/repo"
    )


def test_stages_give_as_few_parts_as_the_texts_need(spark):
    """Not one, and so one file, for every part of the input or of a shuffle."""
    docs = [(i, f"{i} " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(80)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    adaptive = "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive)
    try:
        spark.conf.set(adaptive, "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        for name, stage in corpus_pipeline.STAGES:
            parts = stage(spark, docs, SF_DIR).rdd.getNumPartitions()
            assert parts <= spark.sparkContext.defaultParallelism, name
    finally:
        spark.conf.set(adaptive, before)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_python_workers_get_batches_of_bounded_bytes(spark):
    """However long the texts are: of these 10,000 rows would be one batch of 30 MB."""
    long = F.repeat(F.lit("word "), 600)
    docs = spark.range(0, 10_000, 1, 1).select(F.col("id").alias("doc_id"), long.alias("text"))

    def sizes(given):
        for batch in given:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    setting, small = corpus_pipeline.BATCH_SETTING, spark.createDataFrame([], docs.schema)
    before = spark.conf.get(setting, None)
    try:
        for name, stage in corpus_pipeline.STAGES[1:]:
            spark.conf.unset(setting)
            stage(spark, small, SF_DIR)
            got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
            assert sum(got) >= 30_000_000 and max(got) <= 10 << 20, name
        spark.conf.set(setting, "1m")
        corpus_pipeline.encoded(spark, small, SF_DIR)
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.unset(setting)
        if before is not None:
            spark.conf.set(setting, before)


def test_workers_give_back_memory_after_each_batch(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            self.released += 1

    pool, trimmed = Pool(), []
    monkeypatch.setattr(batches.pa, "default_memory_pool", lambda: pool)
    monkeypatch.setattr(batches, "TRIM", trimmed.append)
    given = [pa.RecordBatch.from_pydict({"t": ["ab", "cde", None]}) for _ in range(3)]
    parts = list(batches.slices(iter(given), "t", 2))
    assert [x for p in parts for x in p.column("t").to_pylist()] == ["ab", "cde", None] * 3
    assert pool.released == len(trimmed) == 3
