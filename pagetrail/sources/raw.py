"""Raw click events: JSON lines read against the fixed schema, split by required fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.functions.columns import is_missing
from pagetrail.schema import CORRUPT_COLUMN, RAW_COLUMNS, RAW_SCHEMA, REQUIRED_COLUMNS

# The raw columns and the text of lines that do not parse.
READ_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])


def read_raw_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as raw columns plus ``_corrupt_record``; a bad line is a row of nulls.

    The schema is given, so no job runs. Blank lines give no row, a top-level array
    gives one row per element, other types than text become their JSON text.
    """
    return (
        spark.read.schema(READ_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )


def valid_events(raw: DataFrame) -> DataFrame:
    """Rows with every required field, in the raw schema."""
    return raw.filter(~is_missing(REQUIRED_COLUMNS)).select(*RAW_COLUMNS)


def rejected_events(raw: DataFrame) -> DataFrame:
    """All other rows, with the text of the line where it did not parse."""
    return raw.filter(is_missing(REQUIRED_COLUMNS)).select(*raw.columns)


def rejected_count(raw: DataFrame) -> DataFrame:
    """Rows read and rows rejected, as one row."""
    return raw.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(is_missing(REQUIRED_COLUMNS)).alias("rejected"),
    )
