"""Versioned layers: every run has its own directory, and a list tells which are complete.

    <root>/run_id=<n>/layer=<name>/     the tables of run n
    <root>/_claims/<n>                  taken by the one job that could create it
    <root>/_runs/run_id=<n>/            one row while run n is complete, else none
    <root>/_retired/run_id=<n>/         one row once run n is no longer offered to readers

A run becomes visible with its row in the list, so one that was lost half way is
never read. Going back means reading as of an earlier run. Old runs leave in two steps:
first they are retired, so that no new reader finds them, and only when those who found
them before have had time to finish are their tables removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.functions.columns import quoted
from pagetrail.sources.files import child_names, create_exclusively, delete_tree
from pagetrail.sources.layers import DEFAULT_FORMAT, read_layer


def run_path(root: str, run_id: int) -> str:
    return f"{root.rstrip('/')}/run_id={int(run_id)}"


def layer_path(root: str, run_id: int, layer: str) -> str:
    return f"{run_path(root, run_id)}/layer={layer}"


def _list_path(root: str) -> str:
    return f"{root.rstrip('/')}/_runs"


def mark_complete(spark: SparkSession, root: str, run_id: int) -> None:
    """Make run ``run_id`` visible to readers."""
    _mark(spark, root, run_id, 1)


def claim_run(spark: SparkSession, root: str, run_id: int | None = None) -> int:
    """Take a number for a run, the next free one unless it is given; the run stays hidden.

    The number is taken by creating a file that must not exist yet, so of jobs that start
    together each gets its own. A number that is given may have been taken before, by a run
    that failed. A complete run is never replaced: its tables are what readers may go back to.
    """
    if run_id is None:
        run_id = next_run_id(spark, root)
        while not create_exclusively(spark, _claim_path(root, run_id)):
            run_id += 1
    else:
        if not _finished(spark, root).filter(F.col("run_id") == run_id).isEmpty():
            raise ValueError(f"run {run_id} in {root} is complete; take a new number")
        create_exclusively(spark, _claim_path(root, run_id))
    _mark(spark, root, run_id, 0)
    return run_id


def next_run_id(spark: SparkSession, root: str) -> int:
    """One more than the greatest number taken, by a complete run or another."""
    taken = child_names(spark, f"{root.rstrip('/')}/_claims") + child_names(spark, _list_path(root))
    numbers = [int(n) for name in taken if (n := name.removeprefix("run_id=")).isdigit()]
    return max(numbers, default=0) + 1


def _claim_path(root: str, run_id: int) -> str:
    return f"{root.rstrip('/')}/_claims/{int(run_id)}"


def _mark(spark: SparkSession, root: str, run_id: int, rows: int) -> None:
    done = spark.range(0, rows, 1, 1).select(F.current_timestamp().alias("completed_at"))
    done.write.mode("overwrite").parquet(f"{_list_path(root)}/run_id={int(run_id)}")


def _listed(spark: SparkSession, path: str, time: str) -> DataFrame:
    rows = f"{time} timestamp, run_id bigint"
    try:
        return spark.read.schema(rows).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], rows)


def _finished(spark: SparkSession, root: str) -> DataFrame:
    return _listed(spark, _list_path(root), "completed_at")


def retired_runs(spark: SparkSession, root: str) -> DataFrame:
    """``run_id`` and ``retired_at`` of the runs that are no longer offered."""
    return _listed(spark, f"{root.rstrip('/')}/_retired", "retired_at")


def completed_runs(spark: SparkSession, root: str) -> DataFrame:
    """``run_id`` and completion time of every complete run that is not retired."""
    gone = retired_runs(spark, root).select("run_id")
    return _finished(spark, root).join(gone, "run_id", "left_anti")


def retire_runs(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Offer only the last ``keep`` complete runs, one at least; the numbers retired now.

    Their tables stay for those who are reading them.
    """
    if keep < 1:
        raise ValueError("the last complete run cannot be retired")
    done = sorted(r.run_id for r in completed_runs(spark, root).select("run_id").collect())
    for run_id in done[:-keep]:
        row = spark.range(1, numPartitions=1).select(F.current_timestamp().alias("retired_at"))
        row.write.mode("overwrite").parquet(f"{root.rstrip('/')}/_retired/run_id={run_id}")
    return done[:-keep]


def remove_retired(spark: SparkSession, root: str, grace_seconds: int) -> list[int]:
    """Delete the tables of runs retired at least ``grace_seconds`` ago; their numbers.

    No reader that starts now can find them, and one that found them before has had that
    long. The numbers are not given out again.
    """
    since = F.current_timestamp() - F.make_dt_interval(secs=F.lit(grace_seconds))
    old = retired_runs(spark, root).filter(F.col("retired_at") <= since).select("run_id")
    removed = []
    for run_id in sorted(r.run_id for r in old.collect()):
        if delete_tree(spark, run_path(root, run_id)):
            removed.append(run_id)
    return removed


def run_as_of(spark: SparkSession, root: str, run_id: int | None = None) -> int:
    """The greatest complete run, or the greatest up to ``run_id``."""
    runs = completed_runs(spark, root)
    if run_id is not None:
        runs = runs.filter(F.col("run_id") <= run_id)
    found = runs.agg(F.max("run_id").alias("run_id")).first().run_id
    if found is None:
        raise LookupError(f"no complete run in {root} up to {run_id}")
    return found


def read_as_of(
    spark: SparkSession,
    root: str,
    layer: str,
    run_id: int | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """A layer as the given run, or the last one before it, left it."""
    return read_layer(spark, layer_path(root, run_as_of(spark, root, run_id), layer), fmt)


def run_diff(
    spark: SparkSession,
    root: str,
    layer: str,
    before: int,
    after: int,
    key: Sequence[str],
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """``key`` and ``change`` (added, removed or changed) of what two runs' tables differ in."""
    tables = [read_layer(spark, layer_path(root, run_id, layer), fmt) for run_id in (before, after)]
    return table_diff(*tables, key)


def table_diff(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys whose rows differ, and how: ``key`` and ``change``.

    Compared are the columns that both have; the others are told by the schemas. Of each row
    only the key and 128 bits of a hash of the rest are shuffled. Rows of one key are
    compared as a bag: their number and the sums of their hashes. Null is a value like any
    other, in keys too.
    """
    missing = [c for c in key if c not in before.columns or c not in after.columns]
    if missing:
        raise ValueError(f"no column {missing} in both tables")
    rest = sorted(set(before.columns) & set(after.columns) - set(key))
    sides = []
    for side, df in (("a", before), ("b", after)):
        values = [_comparable(df.schema[c]) for c in rest]
        hashes = [F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)") for seed in (0, 1)]
        names = [quoted(c).alias(f"{side}_{i}") for i, c in enumerate(key)]
        sides.append(
            df.groupBy(*names).agg(
                F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(h) for h in hashes]).alias(side)
            )
        )
    same = F.lit(True)
    for i in range(len(key)):
        same &= F.col(f"a_{i}").eqNullSafe(F.col(f"b_{i}"))
    joined = sides[0].join(sides[1], same, "full").filter(~F.col("a").eqNullSafe(F.col("b")))
    change = (
        F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    )
    keys = [
        F.when(F.col("a").isNull(), F.col(f"b_{i}")).otherwise(F.col(f"a_{i}")).alias(c)
        for i, c in enumerate(key)
    ]
    return joined.select(*keys, change.alias("change"))


def _comparable(field: T.StructField) -> Column:
    """The column as something that hashes alike if it is equal: maps as sorted entries."""
    if isinstance(field.dataType, T.MapType):
        entries = F.array_sort(F.map_entries(quoted(field.name)))
        return F.struct(quoted(field.name).isNull(), entries)
    # A null adds nothing to a hash; where it stands must count.
    return F.struct(quoted(field.name).isNull(), quoted(field.name))
