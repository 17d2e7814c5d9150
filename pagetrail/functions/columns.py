"""Column expressions: time parsing, session keys, percentages, quoted names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """The column called exactly ``name``, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def event_time(df: DataFrame, name: str) -> Column:
    """Column ``name`` as TIMESTAMP: text is parsed (bad text gives null), other types are cast."""
    if isinstance(df.schema[name].dataType, T.StringType):
        text = quoted(name)
        # A time of day alone would be read as one of the day of the run.
        dated = F.when(~text.rlike(r"^\s*T?\d{1,2}:"), text)
        return F.try_to_timestamp(dated).cast("timestamp")
    return quoted(name).cast("timestamp")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return ts.cast("long")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference of the two whole-second values, null if either is null."""
    return epoch_seconds(later) - epoch_seconds(earlier)


def opens_session(diff: Column, gap_seconds: int) -> Column:
    """1 for a user's first event or after a gap longer than the timeout, else 0."""
    return F.when(diff.isNull() | (diff > F.lit(gap_seconds)), 1).otherwise(0)


def session_key(user: Column, number: Column) -> Column:
    """``<user>_<number>``; the last underscore splits it again."""
    return F.concat_ws("_", user, number)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as double, null when whole is 0."""
    return F.try_divide(F.lit(100.0) * part, whole)


def is_missing(names: list[str]) -> Column:
    """True where any of the columns is null; never null itself."""
    missing = F.lit(False)
    for name in names:
        missing = missing | quoted(name).isNull()
    return missing
