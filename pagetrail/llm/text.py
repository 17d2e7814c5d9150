"""Words, tables and small expressions shared by the operators on text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\f\r"

# bytes.translate tables: ASCII letters to lower case, and the same with every other
# ASCII character than a letter or digit made a space.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOWER_ALNUM = bytes(
    LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Only A-Z change, whatever the locale."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_bytes(text: Column) -> Column:
    """UTF-8, empty for null: what the Arrow functions take."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def fold(doc_id: Column, folds: int) -> Column:
    """The row's fold: crc32 of the id as text, modulo ``folds``; 0 without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))
