"""The registered queries as SQL over the same tables, written independently of the operators."""

from __future__ import annotations

from pagetrail.plans.queries import CONVERSION_SETS, WIDE_GAP
from pagetrail.schema import EXTRA_STAGES, FUNNEL_STAGES, REPORT_STAGES

CLICKS = """clicks AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
    CASE event_type WHEN 'signup' THEN 'home' WHEN 'click' THEN 'search'
      WHEN 'view' THEN 'product_view' WHEN 'purchase' THEN 'confirmation'
      WHEN 'error' THEN 'payment_failed' END AS current_page,
    'https://myshop.com/' || CASE event_type WHEN 'signup' THEN 'home' WHEN 'click' THEN 'search'
      WHEN 'view' THEN 'product_view' WHEN 'purchase' THEN 'confirmation'
      WHEN 'error' THEN 'payment_failed' END AS url,
    CASE k % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Edge' END
      AS browser,
    CASE k % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Desktop' ELSE 'Tablet' END AS device,
    value
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
)"""

# Clicks of which searches have no usable time.
BAD_TIMES = f"""{CLICKS}, shaky AS (
  SELECT * REPLACE (CASE WHEN current_page = 'search' THEN 'unknown' ELSE event_time END
    AS event_time) FROM clicks
)"""

# What a reader finds in the raw log: broken lines have no fields, errors no user.
LOG = f"""{CLICKS}, log AS (
  SELECT event_id, CASE WHEN value < 1 OR current_page = 'payment_failed' THEN NULL
      ELSE user_id END AS user_id,
    CASE WHEN value >= 1 THEN event_time END AS event_time,
    CASE WHEN value >= 1 THEN current_page END AS current_page,
    CASE WHEN value >= 1 THEN url END AS url,
    CASE WHEN value >= 1 THEN browser END AS browser,
    CASE WHEN value >= 1 THEN device END AS device,
    CASE WHEN value < 1 THEN substr('{{"user_id":"' || user_id || '","event_time":"' || event_time
      || '","current_page":"' || current_page || '"', 1, 40) END AS _corrupt_record
  FROM clicks
)"""

RAW = "user_id, event_time, current_page, url, browser, device"
VALID = "user_id IS NOT NULL AND event_time IS NOT NULL AND current_page IS NOT NULL"


def _silver(gap: int, source: str = "clicks", time: str | None = None) -> str:
    """CTEs ending in ``silver``: ``source`` with the session columns."""
    time = time or "TRY_CAST(event_time AS TIMESTAMP)"
    return f"""timed AS (
  SELECT *, {time} AS event_timestamp FROM {source}
), lagged AS (
  SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id
      ORDER BY event_timestamp NULLS FIRST, event_id) AS prev_time FROM timed
), gaps AS (
  SELECT *, CAST(floor(epoch(event_timestamp)) AS BIGINT)
    - CAST(floor(epoch(prev_time)) AS BIGINT) AS time_diff_seconds FROM lagged
), flagged AS (
  SELECT *, CASE WHEN time_diff_seconds IS NULL OR time_diff_seconds > {gap} THEN 1 ELSE 0 END
    AS is_new_session FROM gaps
), numbered AS (
  SELECT *, CAST(sum(is_new_session) OVER (PARTITION BY user_id
    ORDER BY event_timestamp NULLS FIRST) AS BIGINT) AS session_id FROM flagged
), silver AS (
  SELECT *, concat_ws('_', user_id, session_id) AS unique_session_id FROM numbered
)"""


def _stats(counters: bool = True) -> str:
    more = """count(*) FILTER (device = 'Mobile') AS mobile_sessions,
    count(*) FILTER (browser = 'Chrome') AS chrome_sessions,""" if counters else ""
    return f"""unique_session_id, max(event_timestamp) AS end_time,
    min(event_timestamp) AS start_time, count(current_page) AS page_views, {more}
    CAST(floor(epoch(max(event_timestamp))) AS BIGINT)
      - CAST(floor(epoch(min(event_timestamp))) AS BIGINT) AS duration_seconds"""


def _hits(stages: list[str]) -> str:
    return ", ".join(f"count(*) FILTER (current_page = '{s}') AS {s}" for s in stages)


GOLD_STAGES = FUNNEL_STAGES + EXTRA_STAGES
FOUND_STAGES = ["confirmation", "home", "payment_failed", "product_view", "search", "order_placed"]
EVENT = "event_id, " + RAW
SESSION = (
    "event_timestamp, prev_time, time_diff_seconds, is_new_session, session_id, unique_session_id"
)


def _gold_ctes(gap: int = WIDE_GAP, source: str = "clicks", first: str = CLICKS) -> str:
    return f"""WITH {first}, {_silver(gap, source)}, gold AS (
  SELECT {_stats()}, {_hits(GOLD_STAGES)} FROM silver GROUP BY unique_session_id
)"""


def _events(gap: int) -> str:
    return f"WITH {CLICKS}, {_silver(gap)} SELECT {EVENT}, {SESSION} FROM silver"


def _sessions(gap: int, counters: bool = True) -> str:
    return f"""WITH {CLICKS}, {_silver(gap)}
SELECT {_stats(counters)} FROM silver GROUP BY unique_session_id"""


def _gold(stages: list[str] = GOLD_STAGES) -> str:
    return f"""WITH {CLICKS}, {_silver(WIDE_GAP)}
SELECT {_stats()}, {_hits(stages)} FROM silver GROUP BY unique_session_id"""


def _funnel(stages: list[str], pct: bool, ctes: str | None = None) -> str:
    """One row per stage, counted over sessions that have at least one hit."""
    rows = " UNION ALL ".join(
        f"""SELECT CAST({no} AS INTEGER) AS stage_no, '{s}' AS stage,
      (SELECT count(*) FROM gold WHERE {s} > 0) AS sessions"""
        for no, s in enumerate(stages, 1)
    )
    share = ", 100.0::DOUBLE * sessions / (SELECT count(*) FROM gold) AS pct" if pct else ""
    return f"{ctes or _gold_ctes()} SELECT stage_no, stage, sessions{share} FROM ({rows})"


def _logged() -> str:
    return f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE {VALID}),
{_silver(WIDE_GAP, "kept")}, gold AS (
  SELECT {_stats()}, {_hits(GOLD_STAGES)} FROM silver GROUP BY unique_session_id
)"""


def _conversion(dim: str, ctes: str | None = None) -> str:
    return f"""{ctes or _gold_ctes()}
SELECT {dim}, count(DISTINCT unique_session_id) AS sessions,
  count(DISTINCT CASE WHEN confirmation > 0 THEN unique_session_id END) AS converted,
  100.0::DOUBLE * count(DISTINCT CASE WHEN confirmation > 0 THEN unique_session_id END)
    / count(DISTINCT unique_session_id) AS rate
FROM silver JOIN gold USING (unique_session_id) GROUP BY {dim}"""


def _histogram(per: float, ctes: str | None = None) -> str:
    return f"""{ctes or _gold_ctes()}, ends AS (
  SELECT min(duration_seconds) AS a, max(duration_seconds) AS b FROM gold
), binned AS (
  SELECT least((duration_seconds - a) * 30 // (b - a), 29) AS bin, count(*) AS n
  FROM gold, ends GROUP BY 1
), edges AS (
  SELECT i AS bin, a / {per}::DOUBLE AS low,
    (b / {per}::DOUBLE - a / {per}::DOUBLE) / 30.0::DOUBLE AS width
  FROM range(30) r(i), ends
)
SELECT CAST(bin AS BIGINT) AS bin, low + bin * width AS lo, low + (bin + 1) * width AS hi,
  coalesce(n, 0) AS sessions
FROM edges LEFT JOIN binned USING (bin)"""


DENSITY = f"""{_gold_ctes()}, d AS (
  SELECT CAST(duration_seconds AS DOUBLE) AS v, count(*) AS n FROM gold GROUP BY 1
), m AS (
  SELECT min(duration_seconds)::DOUBLE AS a, max(duration_seconds)::DOUBLE AS b,
    stddev_samp(duration_seconds) * pow(count(*), -0.2) AS h FROM gold
), grid AS (
  SELECT a + i * ((b - a) / 199.0::DOUBLE) AS x FROM range(200) r(i), m
)
SELECT round(x, 4) AS x,
  round(sum(n * exp(-0.5 * ((x - v) / h) * ((x - v) / h)) * (b - a) / 30 / (h * sqrt(2 * pi()))), 4)
    AS density
FROM grid, d, m GROUP BY grid.x"""


TIES = f"""WITH {CLICKS}, tied AS (
  SELECT * REPLACE (strftime(date_trunc('hour', CAST(event_time AS TIMESTAMP)),
    '%Y-%m-%d %H:%M:%S') AS event_time) FROM clicks
), {_silver(WIDE_GAP, "tied")} SELECT {EVENT}, {SESSION} FROM silver"""

DIRTY_PAGES = f"""WITH {CLICKS}, dirty AS (
  SELECT * REPLACE (CASE WHEN current_page = 'search' THEN 'page_views'
    WHEN current_page = 'home' AND event_id % 2 = 0 THEN 'Home' ELSE current_page END
    AS current_page) FROM clicks
), {_silver(WIDE_GAP, "dirty")}
SELECT {_stats()}, count(*) FILTER (current_page = 'Home') AS Home,
  count(*) FILTER (current_page = 'home') AS page_home,
  count(*) FILTER (current_page = 'page_views') AS page_page_views,
  {_hits(["confirmation", "payment_failed", "product_view", "order_placed"])}
FROM silver GROUP BY unique_session_id"""


def _conversion_set(dims: tuple[str, ...]) -> str:
    values = ", ".join(
        f"CAST({d} AS VARCHAR) AS {d}" if d in dims else f"NULL AS {d}"
        for d in ("device", "browser", "hour")
    )
    return f"""SELECT '{",".join(dims)}' AS dims, {values}, count(DISTINCT unique_session_id) AS sessions,
  count(DISTINCT CASE WHEN confirmation > 0 THEN unique_session_id END) AS converted,
  100.0::DOUBLE * count(DISTINCT CASE WHEN confirmation > 0 THEN unique_session_id END)
    / count(DISTINCT unique_session_id) AS rate
FROM silver JOIN hours USING (unique_session_id) GROUP BY {", ".join(dims)}"""


VIEWS = f"""{_gold_ctes()}, scored AS (
  SELECT least(page_views, 10) / 10.0::DOUBLE AS score, confirmation > 0 AS converted FROM gold
)"""


ORACLES: dict[str, str] = {
    "sessionise_ties": TIES,
    "sessionise_ties_busy_users": TIES,
    "sessionise_ties_busy_users_any_tie": TIES,
    "gold_dirty_pages": DIRTY_PAGES,
    "sessionise_900": _events(900),
    "sessionise_1800": _events(1800),
    "sessionise_21600": _events(WIDE_GAP),
    "sessionise_busy_users": _events(WIDE_GAP),
    "sessionise_busy_users_any_tie": _events(WIDE_GAP),
    "sessionise_sub_second": f"""WITH {_silver(WIDE_GAP, "events", "ts")}
SELECT event_id, user_id, {SESSION} FROM silver""",
    "sessionise_without_bad_times": f"""WITH {BAD_TIMES}, usable AS (
  SELECT * FROM shaky WHERE TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL
), {_silver(WIDE_GAP, "usable")} SELECT {EVENT}, {SESSION} FROM silver""",
    "sessionise_keep_null_times": f"""WITH {BAD_TIMES}, {_silver(WIDE_GAP, "shaky")}
SELECT {EVENT}, {SESSION} FROM silver""",
    "unparsed_times": f"""WITH {BAD_TIMES}
SELECT {EVENT} FROM shaky WHERE TRY_CAST(event_time AS TIMESTAMP) IS NULL""",
    "event_gaps": f"""WITH {CLICKS}, {_silver(WIDE_GAP)}
SELECT event_id, user_id, event_timestamp, prev_time, time_diff_seconds FROM silver""",
    "session_flags": f"""WITH {CLICKS}, {_silver(WIDE_GAP)}
SELECT event_id, is_new_session, session_id, unique_session_id FROM silver""",
    "session_metrics": f"""WITH {CLICKS}, {_silver(WIDE_GAP)}
SELECT unique_session_id, user_id, session_id, event_timestamp, time_diff_seconds,
  is_new_session FROM silver""",
    "session_stats": _sessions(WIDE_GAP),
    "session_stats_900": _sessions(900),
    "session_stats_plain_1800": _sessions(1800, counters=False),
    "funnel_matrix": f"""WITH {CLICKS}, {_silver(WIDE_GAP)}
SELECT unique_session_id, {_hits(GOLD_STAGES)} FROM silver GROUP BY unique_session_id""",
    "gold": _gold(),
    "gold_discovered_stages": _gold(FOUND_STAGES),
    "gold_pivot_join": _gold(),
    "gold_from_events": _gold(),
    "gold_busy_users": _gold(),
    "sparse_funnel": f"""WITH {CLICKS}, {_silver(WIDE_GAP)}
SELECT unique_session_id, current_page AS page, count(*) AS hits FROM silver
WHERE current_page IS NOT NULL GROUP BY ALL""",
    "sparse_gold_widened": _gold(),
    "page_reach": f"""WITH {CLICKS}, {_silver(WIDE_GAP)}
SELECT current_page AS page, count(DISTINCT unique_session_id) AS sessions,
  100.0::DOUBLE * count(DISTINCT unique_session_id)
    / (SELECT count(DISTINCT unique_session_id) FROM silver) AS pct,
  count(*) AS hits FROM silver WHERE current_page IS NOT NULL GROUP BY 1""",
    "incremental_silver": f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE {VALID}),
{_silver(WIDE_GAP, "kept")}, starts AS (
  SELECT *, min(event_timestamp) OVER (PARTITION BY unique_session_id) AS session_start FROM silver
)
SELECT {RAW}, {SESSION}, session_start, CAST(session_start AS DATE) AS day FROM starts""",
    "incremental_gold": f"""{_logged()}
SELECT *, CAST(start_time AS DATE) AS day FROM gold""",
    "quarantine_reasons": f"""WITH {LOG}
SELECT CASE WHEN _corrupt_record IS NOT NULL THEN 'malformed' ELSE 'missing user_id' END AS reason,
  count(*) AS events FROM log WHERE NOT ({VALID}) GROUP BY 1""",
    "replayed_events": f"""WITH {LOG}
SELECT coalesce(user_id, 'nobody') AS user_id, event_time, current_page, url, browser, device
FROM log WHERE _corrupt_record IS NULL""",
    "total_sessions": f"{_gold_ctes()} SELECT count(*) AS total_sessions FROM gold",
    "funnel_counts": _funnel(REPORT_STAGES, pct=False),
    "funnel_counts_present": _funnel(
        [s for s in REPORT_STAGES if s in FOUND_STAGES], pct=False
    ),
    "funnel_conversion": _funnel(FUNNEL_STAGES, pct=True),
    "funnel_lines": f"""SELECT stage_no,
  stage || ': ' || sessions || ' (' || printf('%.1f', pct) || '%)' AS line
FROM ({_funnel(FUNNEL_STAGES, pct=True)})""",
    "conversion_by_device": _conversion("device"),
    "conversion_by_browser": _conversion("browser"),
    "conversion_by_hour": f"""{_gold_ctes()}
SELECT CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS sessions,
  count(*) FILTER (confirmation > 0) AS converted,
  100.0::DOUBLE * count(*) FILTER (confirmation > 0) / count(*) AS rate
FROM gold GROUP BY 1""",
    "duration_histogram": _histogram(1.0),
    "duration_histogram_minutes": _histogram(60.0),
    "duration_density": DENSITY,
    "duration_histogram_merged": _histogram(1.0),
    "incremental_histogram": _histogram(1.0, _logged()),
    "conversion_sets": f"""{_gold_ctes()}, hours AS (
  SELECT unique_session_id, confirmation, CAST(hour(start_time) AS INTEGER) AS hour FROM gold
) {" UNION ALL ".join(_conversion_set(dims) for dims in CONVERSION_SETS)}""",
    "rank_auc_of_views": f"""{VIEWS}, ranked AS (
  SELECT converted, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0
    AS mid FROM scored
)
SELECT round((sum(mid) FILTER (converted) - p * (p + 1) / 2.0) / (p * n), 9)::DOUBLE AS auc
FROM ranked, (SELECT (count(*) FILTER (converted))::DOUBLE AS p,
  (count(*) FILTER (NOT converted))::DOUBLE AS n FROM scored) GROUP BY p, n""",
    "reliability_of_views": f"""{VIEWS}
SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS sessions,
  round(avg(score), 9) AS mean_score, round(avg(CAST(converted AS INTEGER)), 9) AS rate
FROM scored GROUP BY 1""",
    "ingest_valid": f"WITH {LOG} SELECT {RAW} FROM log WHERE {VALID}",
    "ingest_rejected": f"WITH {LOG} SELECT {RAW}, _corrupt_record FROM log WHERE NOT ({VALID})",
    "ingest_counts": f"""WITH {LOG} SELECT count(*) AS events,
  count(*) FILTER (NOT ({VALID})) AS rejected FROM log""",
    "bronze_layer": f"WITH {LOG} SELECT {RAW} FROM log WHERE {VALID}",
    "bad_records_layer": f"WITH {LOG} SELECT {RAW}, _corrupt_record FROM log WHERE NOT ({VALID})",
    "layered_gold": f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE {VALID}),
{_silver(WIDE_GAP, "kept")}
SELECT {_stats()}, {_hits(["confirmation", "home", "product_view", "search"])},
  0::BIGINT AS payment_failed, 0::BIGINT AS order_placed FROM silver GROUP BY unique_session_id""",
    "layered_funnel": _funnel(
        REPORT_STAGES,
        pct=True,
        ctes=f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE {VALID}),
{_silver(WIDE_GAP, "kept")}, gold AS (
  SELECT {_stats()}, {_hits(GOLD_STAGES)} FROM silver GROUP BY unique_session_id
)""",
    ),
    "stream_sessions": f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE {VALID}),
{_silver(WIDE_GAP, "kept")}, gold AS (
  SELECT user_id, {_stats()}, {_hits(FUNNEL_STAGES)} FROM silver
  GROUP BY user_id, unique_session_id
)
SELECT * EXCLUDE (unique_session_id) FROM gold""",
    "layered_session_metrics": f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE {VALID}),
{_silver(WIDE_GAP, "kept")}
SELECT unique_session_id, user_id, session_id, event_timestamp, time_diff_seconds,
  is_new_session FROM silver""",
    "layered_conversion_by_device": _conversion("device", _logged()),
    "layered_conversion_by_browser": _conversion("browser", _logged()),
    "layered_bad_times": f"""WITH {BAD_TIMES}
SELECT {RAW} FROM shaky WHERE TRY_CAST(event_time AS TIMESTAMP) IS NULL""",
    "preview_is_part": f"""{_gold_ctes()}
SELECT least(count(*), 5) AS shown, least(count(*), 5) AS in_gold FROM gold""",
    "layer_as_of": _sessions(900),
    "layer_diff": f"""SELECT coalesce(a.unique_session_id, b.unique_session_id) AS unique_session_id,
  CASE WHEN a.unique_session_id IS NULL THEN 'added' WHEN b.unique_session_id IS NULL THEN 'removed'
    ELSE 'changed' END AS change
FROM ({_sessions(900)}) a FULL JOIN ({_sessions(WIDE_GAP)}) b
  ON a.unique_session_id = b.unique_session_id WHERE a IS DISTINCT FROM b""",
    "gold_csv_roundtrip": _gold(),
    "gold_parquet_roundtrip": _gold(),
}
