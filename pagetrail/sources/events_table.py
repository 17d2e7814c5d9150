"""Click events from the ``events`` table of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Page for each event type, browser by k % 4, device by k % 3.
PAGE_OF_TYPE = {
    "signup": "home",
    "click": "search",
    "view": "product_view",
    "purchase": "confirmation",
    "error": "payment_failed",
}
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge"]
DEVICES = ["Mobile", "Desktop", "Tablet"]
SITE = "https://myshop.com/"


def click_columns() -> list[Column]:
    """The raw click columns as expressions over ``events``, with ``event_id`` in front."""
    pages = F.create_map(*[F.lit(v) for pair in PAGE_OF_TYPE.items() for v in pair])
    k = F.get_json_object("props", "$.k").cast("int")
    page = pages[F.col("event_type")]
    return [
        F.col("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        page.alias("current_page"),
        F.concat(F.lit(SITE), page).alias("url"),
        _nth(BROWSERS, k).alias("browser"),
        _nth(DEVICES, k).alias("device"),
    ]


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the raw click schema."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*click_columns())


def _nth(values: list[str], k: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[k % len(values)]
