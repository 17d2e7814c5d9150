"""Layer tables and exports at a path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.functions.columns import quoted

DEFAULT_FORMAT = "parquet"
NULL = "\\N"
EMPTY = "\\E"
# CSV options: a header, times with all their digits, and text exactly as it is.
CSV_OPTIONS = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# What a line break would do to a file of lines is avoided by a backslash and a letter.
ESCAPES = {"\n": "\\n", "\r": "\\r"}


def write_layer(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    replace_schema: bool = False,
    by: Sequence[str] = (),
) -> None:
    """Overwrite the table at ``path``, with a folder per value of the columns ``by``.

    Parquet takes the new schema as it is; a Delta table needs ``replace_schema``.
    """
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)


def write_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Replace the days that ``df`` has rows of, and leave all others as they are.

    Rows are shuffled by day, so that not every task writes a file for every day; adaptive
    execution splits a large day among tasks by its size and joins small ones.
    """
    dealt = df.hint("rebalance", quoted(day))
    writer = dealt.write.format(DEFAULT_FORMAT).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(day).save(path)


def read_layer(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_layer_if_present(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT
) -> DataFrame | None:
    """The table, or None if nothing has been written at ``path``."""
    try:
        return read_layer(spark, path, fmt)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def export_csv(df: DataFrame, path: str, parts: int | None = None) -> None:
    """A directory of CSV files with a header line each; ``read_csv`` gives the same rows.

    In text, a backslash is doubled, a line break becomes a backslash and a letter, and an
    empty value ``\\E``; null is ``\\N``. So every row is one line and files can be split.

    Written by as many tasks as ``df`` has partitions. Give ``parts`` only for a
    report of fixed size: one part is one task, and ``coalesce`` would also pull the
    stage before it into that task, so the rows are repartitioned.
    """
    if parts is not None:
        df = df.repartition(parts)
    columns = [_escaped(f).alias(_escaped_name(f.name)) for f in df.schema.fields]
    df.select(*columns).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def _escaped_name(name: str) -> str:
    for plain, escape in {"\\": "\\\\", **ESCAPES}.items():
        name = name.replace(plain, escape)
    return name


def _escaped(field: T.StructField) -> Column:
    column = quoted(field.name)
    if not isinstance(field.dataType, T.StringType):
        return column
    text = column
    for plain, escape in {"\\": "\\\\", **ESCAPES}.items():
        text = F.replace(text, F.lit(plain), F.lit(escape))
    return F.when(column == "", F.lit(EMPTY)).otherwise(text)


def _unescaped(field: T.StructField) -> Column:
    column = quoted(field.name)
    if not isinstance(field.dataType, T.StringType):
        return column

    def plain(part: Column) -> Column:
        for text, escape in ESCAPES.items():
            part = F.replace(part, F.lit(escape), F.lit(text))
        return part

    # Between doubled backslashes, a single one can only start an escape.
    parts = F.transform(F.split(column, r"\\\\", -1), plain)
    return F.when(column == EMPTY, F.lit("")).otherwise(F.array_join(parts, "\\"))


def export_parquet(df: DataFrame, path: str) -> None:
    """A directory of Parquet files."""
    df.write.mode("overwrite").parquet(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """An export read back with its own schema."""
    named = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])
    rows = spark.read.schema(named).options(**CSV_OPTIONS).csv(path)
    columns = zip(named.fields, schema.fields, strict=True)
    return rows.select(*[_unescaped(n).alias(f.name) for n, f in columns])


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """Some rows of the table, in no particular order."""
    return df.limit(rows)
