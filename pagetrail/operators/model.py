"""A model on Gold: will a session reach the target stage, given its other columns?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.functions.columns import quoted
from pagetrail.schema import REPORT_STAGES, TARGET_STAGE
from pagetrail.sources.scratch import scratch_path, scratch_table

# Besides the names: the number of views is the sum of all stages, the target's too, and
# the end and the duration tell what came after it.
NOT_FEATURES = {"unique_session_id", "start_time", "end_time", "page_views", "duration_seconds"}
HELD_OUT_FOLDS = 5
WHOLE = "decimal(38,0)"


def feature_columns(gold: DataFrame, target: str = TARGET_STAGE) -> list[str]:
    """The counters of Gold, without the target, the stages that follow it, and sums."""
    later = REPORT_STAGES[REPORT_STAGES.index(target) :] if target in REPORT_STAGES else [target]
    return [c for c in gold.columns if c not in NOT_FEATURES and c not in later]


def split_sessions(gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Four fifths to train on and a fifth to measure on, by a hash of the key."""
    fold = F.pmod(F.crc32(F.col("unique_session_id").cast("binary")), F.lit(HELD_OUT_FOLDS))
    return gold.filter(fold != 0), gold.filter(fold == 0)


def held_out_scores(gold: DataFrame, target: str = TARGET_STAGE) -> DataFrame:
    """``unique_session_id``, ``score`` and ``converted`` of the held-out sessions, written.

    The model is trained on the others. A score is the probability that it gives.
    """
    train, test = split_sessions(gold)
    scored = train_conversion_model(train, target).transform(test)
    return scratch_table(
        scored.select(
            "unique_session_id",
            vector_to_array("probability")[1].alias("score"),
            (quoted(target) > 0).alias("converted"),
        ),
        "held-out",
    )


def conversion_quality(gold: DataFrame, target: str = TARGET_STAGE) -> DataFrame:
    """One row on the held-out sessions: how many, how many convert, how many are told
    rightly at a score of one half, and the area under the ROC curve."""
    scores = held_out_scores(gold, target)
    return scores.agg(
        F.count(F.lit(1)).alias("held_out"),
        F.count_if("converted").alias("converted"),
        F.count_if(F.col("converted") == (F.col("score") > 0.5)).alias("right"),
    ).withColumn("auc", rank_auc(scores).scalar())


def rank_auc(scores: DataFrame, score: str = "score", label: str = "converted") -> DataFrame:
    """``auc``: the share of (converted, other) pairs of rows in which the converted one
    scores higher; equal scores count half. One row, null without rows of both kinds.

    No pair is made. Rows are counted per distinct score, and these are sorted over all
    partitions and written; below each score lie the partitions before its own, known by their
    totals, and those before it in its own. Null scores and labels are left out.
    """
    known = scores.filter(quoted(score).isNotNull() & quoted(label).isNotNull())
    counted = known.groupBy(quoted(score).alias("score")).agg(
        F.count_if(quoted(label)).cast(WHOLE).alias("pos"),
        F.count_if(~quoted(label)).cast(WHOLE).alias("neg"),
    )
    placed = counted.repartitionByRange("score").withColumn("part", F.spark_partition_id())
    placed = scratch_table(placed, "scores")
    totals = placed.groupBy("part").agg(F.sum("neg").alias("all_neg"))
    # A row per partition.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("all_neg").over(earlier), F.lit(0)))
    inside = Window.partitionBy("part").orderBy("score")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    ranked = placed.withColumn("below", below).join(totals, "part")
    # In doubles: each term is a product of whole numbers, and the sum one of shares.
    negatives = (F.col("below") + F.col("before")).cast("double") + F.col("neg").cast("double") / 2
    won = F.sum(F.col("pos").cast("double") * negatives)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))


def reliability(
    scores: DataFrame, bins: int = 10, score: str = "score", label: str = "converted"
) -> DataFrame:
    """``bin`` of equal width over [0, 1], ``sessions``, ``mean_score`` and ``rate`` converted.

    A model is reliable where the last two agree. Empty bins have no row.
    """
    place = F.least(F.floor(quoted(score) * bins), F.lit(bins - 1)).cast("int").alias("bin")
    known = scores.filter(quoted(score).isNotNull() & quoted(label).isNotNull())
    return known.groupBy(place).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.avg(quoted(score)).alias("mean_score"),
        F.avg(quoted(label).cast("double")).alias("rate"),
    )


def train_conversion_model(
    gold: DataFrame,
    target: str = TARGET_STAGE,
    features: Sequence[str] | None = None,
    path: str | None = None,
) -> PipelineModel:
    """Logistic regression of ``target > 0`` on ``features``, saved at ``path``.

    Give it a written table, as training passes over the rows many times. The model
    returned is the saved one: a freshly trained one holds its session, which cannot be
    sent to executors once the session has observed counts.
    """
    names = list(features or feature_columns(gold, target))
    rows = gold.select(
        *[quoted(n).cast("double").alias(n) for n in names],
        (quoted(target) > 0).cast("double").alias("label"),
    )
    steps = [VectorAssembler(inputCols=names, outputCol="features"), LogisticRegression()]
    path = path or scratch_path(gold.sparkSession, "model")
    Pipeline(stages=steps).fit(rows).write().overwrite().save(path)
    return PipelineModel.load(path)


def conversion_scores(model: PipelineModel, gold: DataFrame) -> DataFrame:
    """Each session and whether the model expects it to convert, 1 or 0."""
    scored = model.transform(gold)
    return scored.select("unique_session_id", F.col("prediction").cast("int").alias("converts"))
