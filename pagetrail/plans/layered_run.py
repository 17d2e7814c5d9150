"""From raw JSON lines to all layers, exports and reports of one run.

Every table is written once and read back for what follows, so no sink repeats the
work of another, and a lost executor costs its own tasks only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions.columns import is_missing
from pagetrail.operators.busy_users import MAX_USER_ROWS
from pagetrail.operators.durations import duration_counts, duration_density, duration_histogram
from pagetrail.operators.gold import gold
from pagetrail.operators.reports import (
    conversion_by_hour,
    conversions,
    dimension,
    funnel_lines,
    funnel_report,
    present_stages,
    total_sessions,
)
from pagetrail.operators.sessions import session_metrics, sessionise, unparsed_times
from pagetrail.schema import (
    EXTRA_STAGES,
    FUNNEL_STAGES,
    GAP_SECONDS,
    RAW_COLUMNS,
    REPORT_STAGES,
    REQUIRED_COLUMNS,
    TARGET_STAGE,
)
from pagetrail.sources.layers import (
    DEFAULT_FORMAT,
    export_csv,
    export_parquet,
    read_layer,
    read_layer_if_present,
    write_layer,
)
from pagetrail.sources.raw import read_raw_json
from pagetrail.sources.runs import claim_run, layer_path, mark_complete, run_as_of, run_path
from pagetrail.sources.scratch import scratch_table

BRONZE_COLUMNS = RAW_COLUMNS + ["event_id"]


@dataclass(frozen=True)
class IngestCounts:
    events: int
    rejected: int
    run_id: int


def ingest(
    spark: SparkSession, source: str, root: str, run_id: int
) -> IngestCounts:
    """Write valid events to layer ``bronze`` and, if any, the others to ``bad_records``.

    One pass: the text is parsed once, each row goes to the Parquet directory of its
    layer, and the counts are observed on the way. ``event_id`` numbers the rows; once
    written it is a fixed, unique tie-break for events of the same instant. What an
    earlier attempt at this run left is replaced.
    """
    counts = Observation("ingest")
    bad = is_missing(REQUIRED_COLUMNS)
    rows = (
        read_raw_json(spark, source)
        .withColumns(
            {
                "event_id": F.monotonically_increasing_id(),
                "layer": F.when(bad, "bad_records").otherwise("bronze"),
            }
        )
        .observe(
            counts,
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("layer") == "bad_records").alias("rejected"),
        )
    )
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("layer")
        .parquet(run_path(root, run_id))
    )
    seen = counts.get
    return IngestCounts(seen["events"], seen["rejected"], run_id)


def read_bronze(spark: SparkSession, root: str, run_id: int) -> DataFrame:
    """The valid events of a run; empty if it had none."""
    table = read_layer_if_present(spark, layer_path(root, run_id, "bronze"))
    if table is None:
        fields = ", ".join(f"{c} string" for c in RAW_COLUMNS)
        return spark.createDataFrame([], f"{fields}, event_id bigint")
    return table.select(*BRONZE_COLUMNS)


def run_layers(
    spark: SparkSession,
    source: str,
    root: str,
    *,
    run_id: int | None = None,
    gap_seconds: int = GAP_SECONDS,
    stages: Sequence[str] | None = None,
    report_stages: Sequence[str] = REPORT_STAGES,
    target: str = TARGET_STAGE,
    keep_null_times: bool = False,
    export_events: bool = True,
    max_user_rows: int | None = MAX_USER_ROWS,
    fmt: str = DEFAULT_FORMAT,
) -> IngestCounts:
    """Run everything once, beside all earlier runs, and mark the run complete.

    ``run_id`` is the next free number unless given; the number of a complete run is
    refused. A run that fails stays hidden, so readers go on with the one before it.

    Layers: bronze, bad_records, bad_times, silver, session_metrics, gold and one per
    report. Exports: ``<run>/export=<name>`` as CSV for bronze, silver, gold and the
    reports, as Parquet for gold; those of bronze and silver, as large as the log, can be
    left out with ``export_events=False``. ``bad_records`` and ``bad_times`` exist only if they
    have rows. Gold has a column for each page found, or for the given ``stages`` and
    those the reports need. ``fmt`` is the format of the layers after Bronze.
    """

    def path(layer: str) -> str:
        return layer_path(root, run_id, layer)

    def export(name: str) -> str:
        return f"{run_path(root, run_id)}/export={name}"

    run_id = claim_run(spark, root, run_id)
    counts = ingest(spark, source, root, run_id)
    bronze = read_bronze(spark, root, run_id)
    if export_events:
        export_csv(bronze, export("bronze_csv"))

    if not keep_null_times:
        bad_times = unparsed_times(bronze)
        if not bad_times.isEmpty():
            write_layer(bad_times, path("bad_times"), fmt)
    write_layer(
        sessionise(
            bronze,
            gap_seconds,
            tie_is_unique=True,
            keep_null_times=keep_null_times,
            max_user_rows=max_user_rows,
        ),
        path("silver"),
        fmt,
    )
    silver = read_layer(spark, path("silver"), fmt)
    write_layer(session_metrics(silver), path("session_metrics"), fmt)
    if export_events:
        export_csv(silver, export("silver_csv"))

    extras = EXTRA_STAGES if stages is None else [*EXTRA_STAGES, *report_stages, target]
    write_layer(gold(silver, stages, extras), path("gold"), fmt, replace_schema=True)
    sessions = read_layer(spark, path("gold"), fmt)
    export_csv(sessions, export("gold_csv"))
    export_parquet(sessions, export("gold_parquet"))

    for name, report in _reports(silver, sessions, report_stages, target).items():
        write_layer(report, path(name), fmt)
        export_csv(read_layer(spark, path(name), fmt), export(f"{name}_csv"), parts=1)
    mark_complete(spark, root, run_id)
    return counts


def _reports(
    silver: DataFrame, sessions: DataFrame, stages: Sequence[str], target: str
) -> dict[str, DataFrame]:
    if not present_stages(sessions, [target]):
        sessions = sessions.withColumn(target, F.lit(0).cast("bigint"))
    counts = duration_counts(sessions)
    rates = scratch_table(conversions(silver, ["device", "browser"], target), "conversions")
    return {
        "total_sessions": total_sessions(sessions),
        "funnel": funnel_report(sessions, stages),
        "conversion_by_device": dimension(rates, "device"),
        "conversion_by_browser": dimension(rates, "browser"),
        "conversion_by_hour": conversion_by_hour(sessions, target),
        "duration_histogram": duration_histogram(sessions, counts=counts),
        "duration_density": duration_density(sessions, counts=counts),
    }


def show_reports(
    spark: SparkSession, root: str, run_id: int | None = None, fmt: str = DEFAULT_FORMAT
) -> bool:
    """Print the funnel and the durations of a run; False if there is no Gold table yet."""
    try:
        found = run_as_of(spark, root, run_id)
    except LookupError:
        print(f"no complete run in {root}; run the layers first")
        return False
    sessions = read_layer_if_present(spark, layer_path(root, found, "gold"), fmt)
    if sessions is None:
        print(f"run {found} in {root} has no Gold table")
        return False
    print(f"Total sessions: {total_sessions(sessions).first().total_sessions}")
    for row in funnel_lines(funnel_report(sessions, FUNNEL_STAGES)).orderBy("stage_no").collect():
        print(row.line)
    duration_histogram(sessions, unit="minutes").show(100)
    return True
