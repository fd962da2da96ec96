"""SQL counterparts of the registered queries, in ANSI form as run by DuckDB."""

from __future__ import annotations

from barlake.catalog.views import CLEAN_SQL, DIRTY_SQL, ORDERED_SQL, SHIPPED_SQL

ISSUE_ORDER = [
    "missing_values",
    "duplicate_timestamps",
    "price_inconsistency",
    "volume_anomaly",
    "outlier_detection",
    "time_gaps",
]
BAR = "ticker, timeframe, ts, open, high, low, close, volume, seq"


def _with(query: str, *parts: tuple[str, str]) -> str:
    tables = [("bars", DIRTY_SQL), *parts]
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in tables) + "\n" + query


def _returns(order: str, bars: str = "bars", fill: bool = True) -> list[tuple[str, str]]:
    """Filled close, then the change against the filled close of the row before."""
    filled = (
        f"last_value(close IGNORE NULLS) OVER (PARTITION BY ticker, timeframe ORDER BY {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        if fill
        else "close"
    )
    return [
        ("filled", f"SELECT ticker, timeframe, ts, seq, {filled} AS fc FROM {bars}"),
        (
            "pairs",
            "SELECT ticker, timeframe, seq, fc, "
            f"lag(fc) OVER (PARTITION BY ticker, timeframe ORDER BY {order}) AS pc FROM filled",
        ),
        (
            "rets",
            "SELECT ticker, timeframe, seq, (fc - pc) / pc AS ret FROM pairs "
            "WHERE fc IS NOT NULL AND pc IS NOT NULL AND pc <> 0",
        ),
        (
            "stats",
            "SELECT ticker, timeframe, count(*) AS n_returns, avg(ret) AS mean_ret, stddev_samp(ret) AS std_ret "
            "FROM rets GROUP BY ticker, timeframe",
        ),
        (
            "scored",
            "SELECT r.ticker, r.timeframe, r.seq, "
            "CASE WHEN std_ret > 0 THEN abs((ret - mean_ret) / std_ret) END AS z "
            "FROM rets r JOIN stats s ON r.ticker = s.ticker AND r.timeframe = s.timeframe",
        ),
        (
            "outliers",
            "SELECT ticker, timeframe, count(*) FILTER (WHERE z > 3) AS n_outliers FROM scored "
            "GROUP BY ticker, timeframe",
        ),
    ]


def _steps(bars: str = "bars") -> list[tuple[str, str]]:
    return [
        (
            "steps",
            "SELECT ticker, timeframe, ts, seq, epoch_us(ts) - epoch_us(lag(ts) OVER "
            f"(PARTITION BY ticker, timeframe ORDER BY ts NULLS LAST, seq)) AS step_us FROM {bars}",
        ),
        (
            "medians",
            "SELECT ticker, timeframe, median(step_us) AS median_step_us FROM steps GROUP BY ticker, timeframe",
        ),
        (
            "gaps",
            "SELECT s.ticker, s.timeframe, max(median_step_us) AS median_step_us, count(*) FILTER (WHERE CASE "
            "WHEN s.timeframe = '1d' THEN step_us > 3 * CAST(86400000000 AS BIGINT) "
            "ELSE step_us > 10 * median_step_us END) AS n_gaps "
            "FROM steps s JOIN medians m ON s.ticker = m.ticker AND s.timeframe = m.timeframe "
            "GROUP BY s.ticker, s.timeframe",
        ),
    ]


def _rows(bars: str = "bars") -> tuple[str, str]:
    missing = ", ".join(
        f"count(*) - count({c}) AS n_missing_{c}" for c in ("open", "high", "low", "close", "volume")
    )
    return (
        "row_counts",
        f"SELECT ticker, timeframe, count(*) AS records, {missing}, "
        "count(*) - count(DISTINCT ts) - CASE WHEN count(*) > count(ts) THEN 1 ELSE 0 END AS n_duplicates, "
        "count(*) FILTER (WHERE high < low) AS n_high_low, "
        "count(*) FILTER (WHERE close > high OR close < low) AS n_close_out, "
        "count(*) FILTER (WHERE open > high OR open < low) AS n_open_out, "
        f"count(*) FILTER (WHERE volume <= 0) AS n_no_volume FROM {bars} GROUP BY ticker, timeframe",
    )


def _counters(order: str = "seq", bars: str = "bars") -> list[tuple[str, str]]:
    return [
        _rows(bars),
        *_returns(order, bars),
        *_steps(bars),
        (
            "counters",
            "SELECT r.ticker, r.timeframe, records, n_missing_open, n_missing_high, n_missing_low, n_missing_close, "
            "n_missing_volume, n_duplicates, n_high_low, n_close_out, n_open_out, n_no_volume, "
            "coalesce(n_outliers, 0) AS n_outliers, coalesce(n_gaps, 0) AS n_gaps, median_step_us FROM row_counts r "
            "LEFT JOIN outliers o ON r.ticker = o.ticker AND r.timeframe = o.timeframe "
            "LEFT JOIN gaps g ON r.ticker = g.ticker AND r.timeframe = g.timeframe",
        ),
    ]


def _issues() -> list[tuple[str, str]]:
    text = lambda n: f"CAST({n} AS VARCHAR)"
    part = lambda label, n: f"CASE WHEN {n} > 0 THEN '{label}' || {text(n)} || ' rows' END"
    missing = " || ', ".join(
        f"'{c.capitalize()}'': ' || {text(f'n_missing_{c}')}" for c in ("open", "high", "low", "close", "volume")
    ).replace("'Open'': '", "'''Open'': '", 1)
    missing = missing.replace(", '", ", ''")
    price = ", ".join(
        [
            part("High < Low: ", "n_high_low"),
            part("Close outside High/Low range: ", "n_close_out"),
            part("Open outside High/Low range: ", "n_open_out"),
        ]
    )
    pieces = [
        (
            "n_missing_open + n_missing_high + n_missing_low + n_missing_close + n_missing_volume",
            f"'Missing values: {{' || {missing} || '}}'",
        ),
        ("n_duplicates", f"'Found ' || {text('n_duplicates')} || ' duplicate timestamps'"),
        ("n_high_low + n_close_out + n_open_out", f"concat_ws('; ', {price})"),
        ("n_no_volume", f"'Zero or negative volume: ' || {text('n_no_volume')} || ' rows'"),
        ("n_outliers", f"'Price outliers (|z| > 3): ' || {text('n_outliers')} || ' occurrences'"),
        (
            "n_gaps",
            f"'Large time gaps detected: ' || {text('n_gaps')} || "
            "CASE WHEN timeframe = '1d' THEN ' gaps > 3 days' ELSE ' gaps' END",
        ),
    ]
    union = " UNION ALL ".join(
        f"SELECT ticker, timeframe, {rank} AS rank, '{kind}' AS type, {message} AS message, {n} AS n "
        f"FROM counters WHERE {n} > 0"
        for rank, (kind, (n, message)) in enumerate(zip(ISSUE_ORDER, pieces))
    )
    results = (
        "SELECT c.ticker, c.timeframe, records, count(rank) AS issues, "
        "CASE WHEN count(rank) > 0 THEN 'ISSUES' ELSE 'OK' END AS status, "
        "coalesce(string_agg(type || ': ' || message, ' | ' ORDER BY rank), '') AS issue_text FROM counters c "
        "LEFT JOIN issues i ON c.ticker = i.ticker AND c.timeframe = i.timeframe "
        "GROUP BY c.ticker, c.timeframe, records"
    )
    return [*_counters(), ("issues", union), ("results", results)]


def _landing() -> list[tuple[str, str]]:
    """The bars that the landing lines of all events stand for."""
    return [
        (
            "parsed",
            "SELECT event_type AS ticker, CASE WHEN user_id % 2 = 0 THEN '1d' ELSE '5m' END AS timeframe, "
            "CASE WHEN user_id % 2 = 0 THEN date_trunc('day', ts) "
            "ELSE date_trunc('second', ts) + INTERVAL '4' HOUR END AS ts, value AS open, value * 2 AS high, "
            "value * 0.5 AS low, CASE WHEN event_id % 53 = 0 THEN NULL ELSE value END AS close, "
            "CAST(event_id AS DOUBLE) AS volume, event_id FROM events",
        )
    ]


MASTER = ("master", f"SELECT {BAR} FROM bars WHERE delivery = 1 AND ts IS NOT NULL")
BATCH = ("batch", f"SELECT {BAR} FROM bars WHERE delivery = 2 AND ts IS NOT NULL")
SAME_KEY = "m.ticker = b.ticker AND m.timeframe = b.timeframe AND m.ts = b.ts"


def _first(source: str, order: str = "seq") -> str:
    return (
        f"SELECT {BAR} FROM (SELECT *, row_number() OVER (PARTITION BY ticker, timeframe, ts ORDER BY {order}) AS rn "
        f"FROM {source}) AS ranked WHERE rn = 1"
    )


NEW = ("nw", f"SELECT {BAR} FROM batch b WHERE NOT EXISTS (SELECT 1 FROM master m WHERE {SAME_KEY})")
FRESH = (
    "fresh",
    "SELECT b.* FROM bars b LEFT JOIN (SELECT ticker AS mt, timeframe AS mf, max(ts) AS mark FROM master "
    "WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ticker, timeframe) AS m ON ticker = mt AND timeframe = mf "
    "WHERE ts IS NOT NULL AND (mark IS NULL OR ts > mark)",
)
FRESH_STATE = (
    "SELECT ticker, timeframe, latest, "
    "CAST(floor((epoch_us({as_of}) - epoch_us(latest)) / 1000000.0) AS BIGINT) AS age_seconds, state, "
    "state <> 'fresh' AS stale FROM (SELECT ticker, timeframe, latest, CASE WHEN n IS NULL THEN 'missing' "
    "WHEN latest IS NULL THEN 'no_time' WHEN {old} THEN 'old' ELSE 'fresh' END AS state FROM known) AS k"
)


def _fresh_daily(as_of: str, nations: bool = True) -> list[tuple[str, str]]:
    wanted = "SELECT DISTINCT ticker FROM bars"
    if nations:
        wanted += " UNION SELECT n_name FROM nation"
    return [
        ("wanted", wanted),
        (
            "known",
            "SELECT w.ticker, '1d' AS timeframe, max(ts) AS latest, count(b.seq) AS found, "
            "CASE WHEN count(b.seq) = 0 THEN NULL ELSE count(b.seq) END AS n FROM wanted w "
            "LEFT JOIN bars b ON w.ticker = b.ticker AND b.timeframe = '1d' GROUP BY w.ticker",
        ),
        (
            "fresh",
            FRESH_STATE.format(
                as_of=f"TIMESTAMP '{as_of}'",
                old=f"date_diff('day', CAST(latest AS DATE), DATE '{as_of[:10]}') > 7",
            ),
        ),
    ]


def _fresh_intraday(as_of: str) -> str:
    stamp = f"TIMESTAMP '{as_of}'"
    return FRESH_STATE.format(as_of=stamp, old=f"epoch_us({stamp}) - epoch_us(latest) > 12 * 3600 * CAST(1000000 AS BIGINT)")


SIZES = [("1m", "7d"), ("5m", "60d"), ("15m", "60d"), ("30m", "60d"), ("90m", "60d"), ("1h", "730d")]
PERIOD = "CASE timeframe " + " ".join(f"WHEN '{s}' THEN '{p}'" for s, p in SIZES) + " WHEN '1d' THEN 'max' ELSE '60d' END"


def _sizes(*more: str) -> str:
    return "(VALUES " + ", ".join(f"('{s}')" for s in [*(s for s, _ in SIZES), *more]) + ") AS sizes(timeframe)"


def oracle_sql() -> dict[str, str]:
    by_time = "ts NULLS LAST, seq"
    missing = "n_missing_open, n_missing_high, n_missing_low, n_missing_close, n_missing_volume"
    latest_ordered = ("ordered", ORDERED_SQL), ("shipped", SHIPPED_SQL)
    shipped_columns = "s.ticker, s.timeframe, s.ts, s.close, s.seq"
    time_text = (
        "CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN NULL ELSE date_trunc('second', ts) END"
    )
    vendor = (
        "SELECT c_name AS ticker, '5m' AS timeframe, CASE WHEN c_custkey % 11 <> 0 "
        "THEN TIMESTAMP '2024-01-02 14:30:00' END AS ts, p AS open, p AS high, p AS low, p AS close, p AS volume, "
        "CASE WHEN c_custkey % 11 <> 0 THEN CAST(0 AS BIGINT) END AS seq, "
        "CASE WHEN c_custkey % 11 = 0 THEN 'ConnectionError: no answer' END AS error "
        "FROM (SELECT *, CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey AS DOUBLE) + 0.5 END AS p "
        "FROM customer) AS c WHERE c_custkey % 11 = 0 OR c_custkey % 7 <> 0"
    )
    # The form of each event's time: whether it has a clock, an offset, a day, a year.
    form = "event_id % 11"
    wall = f"CASE WHEN {form} <= 6 THEN date_trunc('minute', ts) WHEN {form} <= 8 THEN date_trunc('day', ts) WHEN {form} = 9 THEN date_trunc('year', ts) END"
    return {
        "ticker_universe": (
            "SELECT c_mktsegment AS \"group\", upper(c_name) AS ticker FROM customer UNION ALL "
            "SELECT c_mktsegment, upper(c_name) || '=X' FROM customer"
        ),
        "fetch_plan": (
            f"SELECT upper(c_name) AS ticker, timeframe, {PERIOD} AS period FROM customer, {_sizes('2h', '1d')}"
        ),
        "refresh_stale_only": _with(
            f"SELECT ticker, timeframe, {PERIOD} AS period FROM fresh WHERE stale",
            *_fresh_daily("2024-02-07 00:00:00", nations=False),
        ),
        "bars_clean": f"SELECT {BAR} FROM ({CLEAN_SQL}) AS c",
        "bars_dirty": _with(f"SELECT {BAR} FROM bars"),
        "series_rows": _with(
            "SELECT ticker, timeframe, count(*) AS records, min(ts) AS first_ts, max(ts) AS latest_ts "
            "FROM bars GROUP BY ticker, timeframe"
        ),
        "series_state": _with(
            "SELECT ticker, timeframe, count(*) AS records, min(ts) AS first_ts, max(ts) AS latest_ts "
            "FROM bars GROUP BY ticker, timeframe"
        ),
        "target_watermark": f"SELECT max(ts) AS latest FROM ({ORDERED_SQL}) AS o",
        "series_exist": f"SELECT DISTINCT ticker, timeframe FROM ({ORDERED_SQL}) AS o",
        "dq_missing": _with(f"SELECT ticker, timeframe, {missing} FROM row_counts", _rows()),
        "dq_duplicates": _with("SELECT ticker, timeframe, n_duplicates FROM row_counts", _rows()),
        "dq_price": _with("SELECT ticker, timeframe, n_high_low, n_close_out, n_open_out FROM row_counts", _rows()),
        "dq_volume": _with("SELECT ticker, timeframe, records, n_no_volume FROM row_counts", _rows()),
        "simple_returns": _with("SELECT ticker, timeframe, seq, ret FROM rets", *_returns("seq")),
        "simple_returns_by_time": _with("SELECT ticker, timeframe, seq, ret FROM rets", *_returns(by_time)),
        "simple_returns_unfilled": _with(
            "SELECT ticker, timeframe, seq, ret FROM rets", *_returns("seq", fill=False)
        ),
        "return_stats": _with(
            "SELECT ticker, timeframe, n_returns, round(mean_ret, 6) AS mean_ret, round(std_ret, 6) AS std_ret "
            "FROM stats",
            *_returns("seq"),
        ),
        "z_scores": _with("SELECT ticker, timeframe, seq, round(z, 6) AS z FROM scored", *_returns("seq")),
        "dq_outliers": _with("SELECT ticker, timeframe, n_outliers FROM outliers", *_returns("seq")),
        "dq_outliers_by_time": _with("SELECT ticker, timeframe, n_outliers FROM outliers", *_returns(by_time)),
        "time_steps": _with(
            "SELECT ticker, timeframe, ts, n_rows, step_us FROM (SELECT *, "
            "count(*) OVER (PARTITION BY ticker, timeframe, ts) AS n_rows, "
            "row_number() OVER (PARTITION BY ticker, timeframe, ts ORDER BY seq) AS rn FROM steps) AS s "
            "WHERE rn = 1 AND ts IS NOT NULL",
            *_steps(),
        ),
        "step_medians": _with("SELECT ticker, timeframe, median_step_us FROM medians", *_steps()),
        "dq_gaps": _with("SELECT ticker, timeframe, n_gaps FROM gaps", *_steps()),
        "dq_counters": _with("SELECT * FROM counters", *_counters()),
        "dq_counters_by_time": _with("SELECT * FROM counters", *_counters(by_time)),
        "dq_counters_incremental": _with("SELECT * FROM counters", *_counters(by_time)),
        "dq_counters_hourly": _with(
            "SELECT * FROM counters", ("hourly", CLEAN_SQL), *_counters(by_time, "hourly")
        ),
        "dq_issues": _with("SELECT ticker, timeframe, type, message, n FROM issues", *_issues()),
        "dq_results": _with(
            "SELECT ticker, timeframe, records, issues, status, issue_text FROM results", *_issues()
        ),
        "dq_stats": _with(
            "SELECT count(*) AS total_files, CAST(sum(records) AS BIGINT) AS total_records, "
            "count(*) FILTER (WHERE issues > 0) AS files_with_issues, "
            "CAST(sum(issues) AS BIGINT) AS anomalies_detected FROM results",
            *_issues(),
        ),
        "dq_empty_series": _with(
            "SELECT n_name AS ticker, timeframe, 'empty_data' AS type, 'DataFrame is empty' AS message "
            "FROM nation, (VALUES ('1d'), ('5m')) AS sizes(timeframe) WHERE NOT EXISTS "
            "(SELECT 1 FROM bars b WHERE b.ticker = n_name AND b.timeframe = sizes.timeframe)"
        ),
        "dq_processing_errors": (
            "SELECT c_name || '_1d' AS ticker, 'processing_error' AS type, "
            "CASE WHEN c_custkey % 5 = 0 THEN 'no_header' ELSE 'missing_column' END AS message, CAST(1 AS BIGINT) AS n "
            "FROM customer WHERE c_custkey % 2 = 0 AND (c_custkey % 5 = 0 OR c_custkey % 7 = 0)"
        ),
        "rows_with_missing": _with(
            f"SELECT {BAR} FROM bars WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL "
            "OR volume IS NULL"
        ),
        "chart_data": _with(
            f"SELECT {BAR}, (SELECT string_agg('⚠️ ' || type || ': ' || message, '<br>' ORDER BY rank) FROM issues "
            "WHERE ticker = 'click' AND timeframe = '5m') AS issue_text "
            "FROM bars WHERE ticker = 'click' AND timeframe = '5m'",
            *_issues(),
        ),
        "clean_cast": (
            "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN t + INTERVAL '4' HOUR ELSE t END AS utc_ts, "
            "CAST(t AS DATE) AS bar_date, CASE WHEN event_id % 71 = 0 OR event_id % 73 = 0 OR event_id % 79 = 0 "
            "THEN NULL ELSE CAST(event_id % 1000 AS DOUBLE) / 4 END AS number "
            f"FROM (SELECT event_id, {time_text} AS t FROM events) AS e WHERE t IS NOT NULL"
        ),
        "clean_time_forms": (
            f"SELECT event_id, CASE WHEN {form} = 6 THEN t + INTERVAL '4' HOUR ELSE t END AS utc_ts, CAST(t AS DATE) AS bar_date "
            f"FROM (SELECT event_id, CAST({wall} AS TIMESTAMP) AS t FROM events) AS e"
        ),
        "banner_filter": (
            "SELECT doc_id, lang AS ticker FROM documents "
            "WHERE NOT (coalesce(contains(text, lang), FALSE) OR coalesce(contains(source, lang), FALSE))"
        ),
        "landing_clean": _with(
            "SELECT ticker, timeframe, ts, open, high, low, close, volume FROM parsed "
            "WHERE event_id % 97 <> 0 AND event_id % 89 <> 0",
            *_landing(),
        ),
        "landing_rejects": _with(
            "SELECT ticker || '_' || timeframe || '.csv' AS source_file, 'bad_time' AS reason, count(*) AS n "
            "FROM parsed WHERE event_id % 97 <> 0 AND event_id % 89 = 0 GROUP BY ticker, timeframe",
            *_landing(),
        ),
        "new_rows": _with(f"SELECT {BAR} FROM nw", MASTER, BATCH, NEW),
        "keep_first": _with(_first("timed"), ("timed", "SELECT * FROM bars WHERE ts IS NOT NULL")),
        "keep_last": _with(_first("timed", "seq DESC"), ("timed", "SELECT * FROM bars WHERE ts IS NOT NULL")),
        "merge_delta": _with(_first("nw"), MASTER, BATCH, NEW),
        "merge_append": _with(f"{_first('master')} UNION ALL {_first('nw')}", MASTER, BATCH, NEW),
        "merge_exact": _with(
            f"SELECT {BAR} FROM flagged WHERE NOT has_m OR NOT has_n OR rn = 1",
            MASTER,
            BATCH,
            NEW,
            ("both_sides", "SELECT *, 0 AS src FROM master UNION ALL SELECT *, 1 AS src FROM nw"),
            (
                "flagged",
                "SELECT *, min(src) OVER (PARTITION BY ticker, timeframe) = 0 AS has_m, "
                "max(src) OVER (PARTITION BY ticker, timeframe) = 1 AS has_n, "
                "row_number() OVER (PARTITION BY ticker, timeframe, ts ORDER BY src, seq) AS rn FROM both_sides",
            ),
        ),
        "merge_replace": _with(
            f"{_first('batch', 'seq DESC')} UNION ALL SELECT {BAR} FROM ({_first('master')}) AS m "
            "WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE m.ticker = b.ticker AND m.timeframe = b.timeframe "
            "AND m.ts = b.ts)",
            MASTER,
            BATCH,
        ),
        "freshness_daily": _with("SELECT * FROM fresh", *_fresh_daily("2024-02-05 06:00:00")),
        "freshness_from_state": _with("SELECT * FROM fresh", *_fresh_daily("2024-02-05 06:00:00")),
        "freshness_intraday": _with(
            _fresh_intraday("2024-01-31 11:30:00"),
            (
                "known",
                "SELECT ticker, timeframe, max(ts) AS latest, count(*) AS n FROM bars WHERE timeframe = '5m' "
                "GROUP BY ticker, timeframe",
            ),
        ),
        "freshness_intraday_all": _with(
            _fresh_intraday("2024-02-05 06:00:00"),
            ("wanted", f"SELECT * FROM (SELECT DISTINCT ticker FROM bars) AS t, {_sizes()}"),
            (
                "known",
                "SELECT w.ticker, w.timeframe, max(ts) AS latest, "
                "CASE WHEN count(b.seq) = 0 THEN NULL ELSE count(b.seq) END AS n FROM wanted w "
                "LEFT JOIN bars b ON w.ticker = b.ticker AND w.timeframe = b.timeframe GROUP BY w.ticker, w.timeframe",
            ),
        ),
        "refresh_needed": _with(
            "SELECT bool_or(stale) AS needs_refresh FROM fresh", *_fresh_daily("2024-02-05 06:00:00")
        ),
        "publish_global": _with(
            f"SELECT {shipped_columns} FROM shipped s WHERE ts > (SELECT max(ts) FROM ordered)", *latest_ordered
        ),
        "publish_series": _with(
            f"SELECT {shipped_columns} FROM shipped s LEFT JOIN (SELECT ticker, timeframe, max(ts) AS w "
            "FROM ordered GROUP BY ticker, timeframe) AS o ON s.ticker = o.ticker AND s.timeframe = o.timeframe "
            "WHERE w IS NULL OR s.ts > w",
            *latest_ordered,
        ),
        "publish_conflict_skip": _with(_first("nw"), MASTER, BATCH, NEW),
        "publish_split_daily": _with(_split_form("= '1d'")),
        "publish_split_intraday": _with(_split_form("<> '1d'")),
        "publish_combined": _with(
            "SELECT ticker, timeframe, ts AS \"timestamp\", open, high, low, close, volume FROM bars"
        ),
        "publish_split_increment": _with(
            _split_form("= '1d' AND ts > (SELECT max(ts) FROM master WHERE timeframe = '1d' AND ts < TIMESTAMP '2024-01-16')"),
            MASTER,
        ),
        "publish_combined_increment": _with(
            'SELECT ticker, timeframe, ts AS "timestamp", open, high, low, close, volume FROM (' + _first("fresh") + ") AS f",
            MASTER,
            FRESH,
        ),
        "stored_master": _with(f"{_first('master')} UNION ALL {_first('nw')}", MASTER, BATCH, NEW),
        "stored_delta": _with(_first("nw"), MASTER, BATCH, NEW),
        "stored_series_state": _with(
            "SELECT ticker, timeframe, count(*) AS records, min(ts) AS first_ts, max(ts) AS latest_ts "
            f"FROM ({_first('master')} UNION ALL {_first('nw')}) AS m GROUP BY ticker, timeframe",
            MASTER,
            BATCH,
            NEW,
        ),
        "stored_quality": _with(
            "SELECT * FROM counters",
            MASTER,
            BATCH,
            NEW,
            ("merged", f"{_first('master')} UNION ALL {_first('nw')}"),
            *_counters(by_time, "merged"),
        ),
        "compacted_master": _with(f"SELECT {BAR} FROM bars WHERE ts IS NOT NULL"),
        "stored_raw": _with(
            "SELECT ticker, timeframe, ts, open, high, low, close, volume FROM parsed "
            "WHERE event_id % 97 <> 0 AND event_id % 89 <> 0",
            *_landing(),
        ),
        "landing_files": _with("SELECT ticker, timeframe, ts, open, high, low, close, volume FROM bars WHERE ts IS NOT NULL"),
        "daily_copy": _with(f"SELECT {BAR} FROM bars WHERE timeframe = '1d' AND ts IS NOT NULL"),
        "stored_report": _with(
            "SELECT ticker, timeframe, records, issues, status, issue_text FROM results", *_issues()
        ),
        "published_table": _with(
            'SELECT ticker, timeframe, ts AS "timestamp", open, high, low, close, volume FROM (SELECT * FROM master '
            f"WHERE ts < TIMESTAMP '2024-01-16' UNION ALL {_first('fresh')}) AS f",
            MASTER,
            FRESH,
        ),
        "published_buckets": _with(
            f"SELECT {BAR} FROM master UNION ALL {_first('late')}",
            MASTER,
            BATCH,
            (
                "late",
                "SELECT b.* FROM batch b LEFT JOIN (SELECT ticker AS mt, timeframe AS mf, max(ts) AS mark FROM master "
                "GROUP BY ticker, timeframe) AS m ON ticker = mt AND timeframe = mf WHERE mark IS NULL OR ts > mark",
            ),
        ),
        "full_run": _with(
            "SELECT step, TRUE AS ok, detail, n AS rows FROM ("
            "SELECT 'data_collection' AS step, 'done' AS detail, (SELECT count(*) FROM keys) AS n UNION ALL "
            "SELECT 'quality_checks', 'done', (SELECT count(*) FROM (SELECT DISTINCT ticker, timeframe FROM keys) AS s) UNION ALL "
            "SELECT 'split_publish', 'disabled', CAST(NULL AS BIGINT) UNION ALL "
            "SELECT 'combined_publish', 'done', (SELECT count(*) FROM keys)) AS steps",
            *_landing(),
            ("keys", "SELECT DISTINCT ticker, timeframe, ts FROM parsed WHERE event_id % 97 <> 0 AND event_id % 89 <> 0"),
        ),
        "daily_subset": _with(f"SELECT {BAR} FROM bars WHERE timeframe = '1d'"),
        "pluggable_fetch": vendor,
        "fetch_as_source": vendor,
        "age_of_bars": _with(
            "SELECT ticker, timeframe, ts, seq, date_diff('day', CAST(ts AS DATE), DATE '2024-02-05') AS age_days, "
            "(epoch_us(TIMESTAMP '2024-02-05 06:00:00') - epoch_us(ts)) / 1000000.0 AS age_seconds FROM bars "
            "WHERE ts IS NOT NULL"
        ),
    }


def _split_form(test: str) -> str:
    return (
        'SELECT ts AS "Date", ticker AS "Ticker", timeframe AS "Timeframe", open AS "Open", high AS "High", '
        'low AS "Low", close AS "Close", CAST(trunc(volume) AS BIGINT) AS "Volume" '
        f"FROM bars WHERE timeframe {test}"
    )
