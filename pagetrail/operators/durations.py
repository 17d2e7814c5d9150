"""Distribution of session durations: histogram and density curve.

Both need the range of the durations before they can place any of them. They work on the
number of sessions per distinct duration: that aggregate is combined before its shuffle,
and its size depends on the longest session and not on the number of sessions. The range
and the moments are scalar subqueries over the same aggregate, whose exchange Spark runs
once. Counts of parts of the sessions, such as of days, add up to counts of the whole, so
they can be kept and merged for any range of days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.schema import DENSITY_POINTS, HISTOGRAM_BINS

# Seconds per unit.
UNITS = {"seconds": 1.0, "minutes": 60.0}
# Bandwidths that a duration reaches. What is cut off is under 3e-18 of the kernel's height,
# and over all sessions under that share of the height they would have at one place.
REACH = 9.0


def duration_counts(gold: DataFrame) -> DataFrame:
    """Sessions per distinct duration in seconds."""
    return (
        gold.filter(F.col("duration_seconds").isNotNull())
        .groupBy("duration_seconds")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )


def daily_duration_counts(gold: DataFrame) -> DataFrame:
    """``day`` on which sessions start, ``duration_seconds`` and ``sessions``."""
    timed = gold.filter(F.col("duration_seconds").isNotNull())
    day = F.to_date("start_time").alias("day")
    return timed.groupBy(day, "duration_seconds").agg(F.count(F.lit(1)).alias("sessions"))


def merged_counts(
    daily: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """The counts of the days from ``first`` to ``last``, both included, as one."""
    if first is not None:
        daily = daily.filter(F.col("day") >= F.lit(first))
    if last is not None:
        daily = daily.filter(F.col("day") <= F.lit(last))
    return daily.groupBy("duration_seconds").agg(F.sum("sessions").alias("sessions"))


def _ends(counts: DataFrame) -> Column:
    """Shortest and longest duration, null if there are no sessions.

    The sum makes the subquery use the columns that the query around it uses, so that both
    have the same exchange.
    """
    d = F.col("duration_seconds")
    ends = F.struct(F.min(d).alias("lo"), F.max(d).alias("hi"), F.sum("sessions").alias("n"))
    return counts.agg(ends.alias("ends")).scalar()


def duration_histogram(
    gold: DataFrame | None,
    bins: int = HISTOGRAM_BINS,
    unit: str = "seconds",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Sessions per equal-width bin over [min, max]; the last bin includes its upper edge.

    Bins are found in whole seconds, so no rounding moves a session. When all
    durations are equal the range is half a unit to either side; with no sessions it
    is [0, 1]. Empty bins are rows too. ``counts`` are ``duration_counts`` or merged ones,
    where there are some; Gold is not read then.
    """
    per = F.lit(UNITS[unit])
    counts = duration_counts(gold) if counts is None else counts
    ended = counts.withColumn("ends", _ends(counts))
    lo, hi = F.col("ends.lo"), F.col("ends.hi")
    exact = F.expr(f"(duration_seconds - ends.lo) * {bins} div nullif(ends.hi - ends.lo, 0)")
    bin_no = F.least(F.coalesce(exact, F.lit(bins // 2)), F.lit(bins - 1)).cast("bigint")
    filled = ended.groupBy(bin_no.alias("bin")).agg(F.sum("sessions").alias("sessions"))
    rows = counts.sparkSession.range(bins, numPartitions=1).select(
        F.col("id").alias("bin"), _ends(counts).alias("ends")
    )
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    low = F.coalesce(lo / per - half, F.lit(0.0))
    high = F.coalesce(hi / per + half, F.lit(1.0))
    width = (high - low) / bins
    return (
        rows.join(F.broadcast(filled), "bin", "left")  # at most one row per bin
        .select(
            "bin",
            (low + F.col("bin") * width).alias("lo"),
            (low + (F.col("bin") + 1) * width).alias("hi"),
            F.coalesce("sessions", F.lit(0).cast("bigint")).alias("sessions"),
        )
        .orderBy("bin")
    )


def duration_density(
    gold: DataFrame | None,
    points: int = DENSITY_POINTS,
    bins: int = HISTOGRAM_BINS,
    unit: str = "seconds",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Gaussian density of the durations, scaled to the histogram's counts.

    Bandwidth by Scott's rule, ``points`` places over [min, max]. No rows when fewer
    than two distinct durations exist, as the bandwidth is then 0. A duration adds to the
    places within nine bandwidths of it and to no others.
    """
    per = F.lit(UNITS[unit])
    counts = duration_counts(gold) if counts is None else counts
    reached = kernel_rows(counts, points, UNITS[unit])
    summed = reached.groupBy("point").agg(F.sum("part").alias("density"))
    rows = counts.sparkSession.range(points, numPartitions=1).select(
        F.col("id").alias("point"), _ends(counts).alias("ends")
    )
    rows = rows.filter(F.col("ends.lo") < F.col("ends.hi"))
    low, high = F.col("ends.lo") / per, F.col("ends.hi") / per
    scale = (high - low) / bins
    return (
        rows.join(F.broadcast(summed), "point", "left")  # at most one row per point
        .orderBy("point")
        .select(
            (low + F.col("point") * ((high - low) / (points - 1))).alias("x"),
            (F.coalesce("density", F.lit(0.0)) * scale).alias("density"),
        )
    )


def kernel_rows(counts: DataFrame, points: int, per: float) -> DataFrame:
    """``point`` and the ``part`` a duration adds there, for the points within its reach."""
    ended = counts.select("duration_seconds", "sessions", _ends(counts).alias("ends"))
    lo, hi = F.col("ends.lo"), F.col("ends.hi")
    # Shifted by the shortest duration, so that large values lose no digits.
    at = ((F.col("duration_seconds") - lo) / F.lit(per)).alias("at")
    span = ((hi - lo) / F.lit(per)).alias("span")
    shifted = ended.filter(lo < hi).select(at, span, F.col("sessions").cast("double").alias("n"))
    moments = shifted.agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n") * F.col("at")).alias("first"),
        F.sum(F.col("n") * F.col("at") * F.col("at")).alias("second"),
    )
    squares = F.col("second") - F.col("first") * F.col("first") / F.col("total")
    bandwidth = moments.select(
        F.sqrt(squares / (F.col("total") - 1)) * F.pow("total", F.lit(-0.2))
    ).scalar()
    with_h = shifted.withColumn("h", bandwidth)
    step = F.col("span") / (points - 1)
    reach = F.lit(REACH) * F.col("h")
    first = F.greatest(F.ceil((F.col("at") - reach) / step), F.lit(0))
    last = F.least(F.floor((F.col("at") + reach) / step), F.lit(points - 1))
    near = with_h.withColumn("point", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    z = (F.col("point") * step - F.col("at")) / F.col("h")
    height = F.col("n") / (F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return near.select("point", (height * F.exp(F.lit(-0.5) * z * z)).alias("part"))
