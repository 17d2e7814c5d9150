"""Column names, types and fixed values of the click-event data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw columns and their types.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("event_time", T.StringType(), False),
        T.StructField("current_page", T.StringType(), False),
        T.StructField("url", T.StringType(), True),
        T.StructField("browser", T.StringType(), True),
        T.StructField("device", T.StringType(), True),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
REQUIRED_COLUMNS = [f.name for f in RAW_SCHEMA.fields if not f.nullable]
CORRUPT_COLUMN = "_corrupt_record"

# The columns that sessions add, and those of the metrics.
SESSION_COLUMNS = [
    "event_timestamp",
    "prev_time",
    "time_diff_seconds",
    "is_new_session",
    "session_id",
    "unique_session_id",
]
METRIC_COLUMNS = [
    "unique_session_id",
    "user_id",
    "session_id",
    "event_timestamp",
    "time_diff_seconds",
    "is_new_session",
]

# The funnel pages, in funnel order.
FUNNEL_STAGES = ["home", "search", "product_view", "add_to_cart", "checkout", "confirmation"]
# Stages every Gold table carries even when no event has them.
EXTRA_STAGES = ["payment_failed", "order_placed"]
# The stages of the full funnel report, in report order.
REPORT_STAGES = FUNNEL_STAGES + ["order_placed", "payment_failed"]

# Gold counters of events with one value of one column.
VALUE_COUNTERS = {
    "mobile_sessions": ("device", "Mobile"),
    "chrome_sessions": ("browser", "Chrome"),
}

# Session timeouts in seconds.
GAP_SECONDS = 900
LEGACY_GAP_SECONDS = 1800

TARGET_STAGE = "confirmation"
HISTOGRAM_BINS = 30
DENSITY_POINTS = 200
