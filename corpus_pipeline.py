"""Documents to clean, distinct, uncontaminated and encoded ones, stage by stage.

Each stage gives its rows in as many partitions as their texts need (``text_files``), for it
is written before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from pagetrail.llm.text import SPACES, table
from pagetrail.sources.scratch import scratch_table, text_files

SIMILARITY_PERCENT = 80
FEW_IDS = 500_000  # some tens of MB where they are broadcast
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get batches of some MB of rows at a time, unless the session has a limit.

    By default Spark gathers 10,000 rows or 64 MB for each task: outside the heap, in buffers
    that double as they grow, and once more in the worker. The rows stay the same.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; null, empty and short texts do not."""
    good = quality_rules.judge(docs).filter("kept").select(*docs.columns)
    return good.coalesce(text_files(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that occur earlier, and their new lengths.

    A document that consists of such runs has nothing left and goes.
    """
    bounded_batches(spark)
    left = line_dedup.remove_repeated_lines(docs)
    left = left.filter((F.col("n_removed") == 0) | (F.trim("text", F.lit(SPACES)) != ""))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        n_chars = F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", n_chars)
    return left.select(*docs.columns).coalesce(text_files(docs))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; one row of each id.

    Of rows with one id the text with the smallest hash stays, of several with that text
    the first in the order of all columns. Rows without an id take no part and stay.
    """
    bounded_batches(spark)
    judged = near_dedup.near_duplicates(docs.select("doc_id", "text"), SIMILARITY_PERCENT)
    judged = judged.filter("doc_id is not null").groupBy("doc_id")
    judged = judged.agg(F.first("kept").alias("kept"), F.count("*").alias("_rows"))
    judged = scratch_table(judged, "judged-ids", docs.count())
    left = _without(docs, judged.filter("not kept").select("doc_id"), ["doc_id"])
    again = judged.filter("kept and _rows > 1").select("doc_id")
    if again.isEmpty():
        return left.select(*docs.columns).coalesce(text_files(docs))
    columns = F.struct(F.xxhash64("text").alias("_hash"), *docs.columns)
    least = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(columns).alias("_x"))
    single = _without(left, again, ["doc_id"])
    least = least.select(*[f"_x.`{c}`" for c in docs.columns])
    return single.select(*docs.columns).union(least).coalesce(text_files(docs))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of benchmark items.

    Rows are told apart by id and a hash of the text, so rows without an id are judged too,
    and equal rows alike.
    """
    bounded_batches(spark)
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    benchmark = table(spark, sf_dir, "benchmark")
    named = docs.select("text", row.alias("_row"))
    judged = decontaminate.contaminated_documents(named, benchmark, key="_row")
    bad = judged.filter("contaminated").select("_row").distinct()
    bad = scratch_table(bad, "contaminated", docs.count())
    clean = _without(docs.withColumn("_row", row), bad, ["_row"]).select(*docs.columns)
    return clean.coalesce(text_files(docs))


def _without(docs: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    """The documents that are not among ``gone``, a written table of ids.

    Where these are few, by their count, each executor gets them all and no text is
    shuffled; otherwise both sides are.
    """
    few = gone.count() <= FEW_IDS
    return docs.join(F.broadcast(gone) if few else gone, on, "left_anti")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and what they decode to."""
    bounded_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded"
    ).coalesce(text_files(docs))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", distinct),
    ("decontamination", uncontaminated),
    ("bpe", encoded),
]

# The last stage is outside SQL; tests/llm compares all stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    limited = spark.conf.get(BATCH_SETTING, None) is not None
    try:
        for name, stage in STAGES:
            docs = scratch_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        if not limited:  # the limit of the stages is not left to the session's other jobs
            spark.conf.unset(BATCH_SETTING)
    return docs
