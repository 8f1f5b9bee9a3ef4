"""The SQL each registered query is checked against."""

TICKS = """
ticks AS (
  SELECT event_id, ts AS event_time, event_type AS symbol,
         open, greatest(open, close) AS high, least(open, close) AS low, close, volume,
         'events' AS source
  FROM (
    SELECT event_id, ts, event_type, value AS close,
           coalesce(lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), value) AS open,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
    FROM events
  )
)"""

TICK_COLUMNS = "event_time, symbol, open, high, low, close, volume, source"

LABELLED = f"""{TICKS},
labelled AS (
  SELECT * FROM (
    SELECT *, high - low AS hl_spread,
           lead(close) OVER (PARTITION BY symbol ORDER BY event_time, event_id) AS next_close
    FROM ticks
  ) WHERE next_close IS NOT NULL AND volume IS NOT NULL
)"""

PARTS = f"""{LABELLED},
parts AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY symbol, event_time, event_id)
                      <= CAST(floor((SELECT count(*) FROM labelled) * 0.8) AS BIGINT)
                 THEN 'train' ELSE 'test' END AS part
  FROM labelled
)"""

PREDICTIONS = f"""{LABELLED},
line AS (
  SELECT regr_slope(next_close, close) AS slope, regr_intercept(next_close, close) AS intercept,
         count(*) AS n
  FROM labelled
),
predictions AS (
  SELECT *, (SELECT slope FROM line) * close + (SELECT intercept FROM line) AS pred_next_close,
         CAST(floor(epoch(event_time) / 43200) AS INTEGER) AS batch_id
  FROM ticks
)"""

ERRORS = f"""{PREDICTIONS},
errors AS (
  SELECT *, abs(pred_next_close - actual_next_close) AS abs_error FROM (
    SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY event_time, event_id)
              AS actual_next_close
    FROM predictions
  ) WHERE actual_next_close IS NOT NULL AND pred_next_close IS NOT NULL
)"""

DAILY = """
daily AS (
  SELECT o_orderdate AS event_time, o_orderpriority AS symbol,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume, 'alphavantage_daily' AS source
  FROM orders GROUP BY o_orderdate, o_orderpriority
)"""

SILVER_COLUMNS = """
  CASE WHEN close < 80 THEN 'low' WHEN close < 120 THEN 'mid' ELSE 'high' END AS range_bucket,
  round(high - low, 6) AS hl_spread, round(close - open, 6) AS oc_change"""

# averages are rounded as decimals, see ``rounded``
STATS_COLUMNS = """
  round(min(close), 6) AS min_close, round(max(close), 6) AS max_close,
  round(avg(close)::DECIMAL(30, 9), 6)::DOUBLE AS avg_close,
  round(var_samp(close)::DECIMAL(30, 9), 6)::DOUBLE AS var_close,
  round(avg(volume)::DECIMAL(30, 9), 6)::DOUBLE AS avg_volume, count(*) AS n_obs"""


def stats(width: str, slide: str | None = None, source: str = "ticks") -> str:
    """Window statistics as a query over the CTE ``source``."""
    if slide is None:
        starts = f"SELECT *, time_bucket(INTERVAL '{width}', event_time) AS ws FROM {source}"
    else:  # a tick lies in two windows, as the slide is half the width
        starts = f"""
          SELECT *, time_bucket(INTERVAL '{slide}', event_time) AS ws FROM {source}
          UNION ALL
          SELECT *, time_bucket(INTERVAL '{slide}', event_time) - INTERVAL '{slide}' AS ws
          FROM {source}"""
    return f"""SELECT ws AS window_start, ws + INTERVAL '{width}' AS window_end, symbol,
      {STATS_COLUMNS} FROM ({starts}) GROUP BY ws, symbol"""


def least_squares(rows: str) -> str:
    """CTE ``fit`` with the least-squares solution over the CTE ``rows``.

    Four columns span the features: low is open + close - high, the spread is high - low.
    The normal equations of the centred columns are solved by elimination.
    """
    names = ["open", "close", "high", "volume"]
    size = range(len(names))
    means = ", ".join(f"avg({n}) AS m{i}" for i, n in enumerate(names))
    dev = [f"({n} - m{i})" for i, n in enumerate(names)]
    entries = [f"sum({dev[i]} * {dev[j]}) AS a{i}{j}" for i in size for j in size]
    entries += [f"sum({dev[i]} * (next_close - my)) AS b{i}" for i in size]
    ctes = [
        f"means AS (SELECT {means}, avg(next_close) AS my FROM {rows})",
        f"step0 AS (SELECT {', '.join(entries)} FROM {rows}, means)",
    ]
    for p in size:
        cells = []
        for i in size:
            keep = i <= p
            cells += [
                f"a{i}{j}" if keep else f"a{i}{j} - a{i}{p} / a{p}{p} * a{p}{j} AS a{i}{j}"
                for j in size
            ]
            cells.append(f"b{i}" if keep else f"b{i} - a{i}{p} / a{p}{p} * b{p} AS b{i}")
        ctes.append(f"step{p + 1} AS (SELECT {', '.join(cells)} FROM step{p})")
    last = "step4"
    for i in reversed(size):
        known = "".join(f" - a{i}{j} * w{j}" for j in size if j > i)
        ctes.append(f"solve{i} AS (SELECT *, (b{i}{known}) / a{i}{i} AS w{i} FROM {last})")
        last = f"solve{i}"
    weights = ", ".join(f"w{i}" for i in size)
    bias = "my" + "".join(f" - w{i} * m{i}" for i in size)
    ctes.append(f"fit AS (SELECT {weights}, {bias} AS w FROM {last}, means)")
    return ",\n".join(ctes)


FITTED = "(SELECT w FROM fit)" + "".join(
    f" + (SELECT w{i} FROM fit) * {name}"
    for i, name in enumerate(["open", "close", "high", "volume"])
)

HEAD_FIT = f"""{PARTS},
head AS (SELECT * FROM parts WHERE part = 'train'),
{least_squares("head")},
tail AS (SELECT *, {FITTED} AS prediction FROM parts WHERE part = 'test')"""

FULL_FIT = f"""{LABELLED},
{least_squares("labelled")}"""

SILVER = f"""SELECT event_time, symbol, open, high, low, close, volume, source,
  {SILVER_COLUMNS} FROM ticks"""

HISTORY = """SELECT event_time, symbol, round(open, 4) AS open, round(high, 4) AS high,
  round(low, 4) AS low, round(close, 4) AS close, volume, source,
  round(high - low, 4) AS hl_spread FROM daily"""

LABEL = f"""WITH {TICKS}
SELECT event_id, event_time, symbol, close,
       lead(close) OVER (PARTITION BY symbol ORDER BY event_time, event_id) AS next_close
FROM ticks"""

HUMAN_BYTES = """
SELECT event_id, CASE
  WHEN size = 0 THEN '0 B'
  WHEN size < 1024 THEN printf('%.1f B', size)
  WHEN size < 1024.0 ** 2 THEN printf('%.1f KB', size / 1024.0)
  WHEN size < 1024.0 ** 3 THEN printf('%.1f MB', size / 1024.0 ** 2)
  WHEN size < 1024.0 ** 4 THEN printf('%.1f GB', size / 1024.0 ** 3)
  ELSE printf('%.1f TB', size / 1024.0 ** 4) END AS size
FROM (SELECT event_id, floor(value * 1024.0 ** (length(event_type) - 4)) AS size FROM events)"""

LATEST_ERRORS = "SELECT * FROM errors ORDER BY event_time DESC, event_id DESC LIMIT 500"

ORACLES = {
    "window_stats_tumbling": f"WITH {TICKS} {stats('10 seconds')}",
    "window_stats_hourly": f"WITH {TICKS} {stats('1 hour')}",
    "window_stats_sliding": f"WITH {TICKS} {stats('1 hour', '30 minutes')}",
    "tick_parse_json": f"""WITH {TICKS},
kinds AS (SELECT *, volume < 10 OR (volume >= 30 AND volume < 40) AS broken,
                 volume >= 10 AND volume < 20 AS partial,
                 volume >= 20 AND volume < 30 AS mistyped FROM ticks)
SELECT event_id,
  CASE WHEN NOT broken THEN event_time END AS event_time,
  CASE WHEN NOT broken THEN symbol END AS symbol,
  CASE WHEN NOT broken THEN open END AS open,
  CASE WHEN NOT broken AND NOT partial THEN high END AS high,
  CASE WHEN NOT broken AND NOT partial THEN low END AS low,
  CASE WHEN NOT broken AND NOT partial AND NOT mistyped THEN close END AS close,
  CASE WHEN NOT broken AND NOT partial THEN volume END AS volume,
  CASE WHEN NOT broken AND NOT partial THEN source END AS source
FROM kinds""",
    "tick_encode_json": f"""WITH {TICKS}
SELECT strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
       symbol, open, high, low, close, volume, source FROM ticks""",
    "silver_features": f"""WITH {TICKS}
SELECT event_id, event_time, symbol, open, high, low, close, volume, source,
  {SILVER_COLUMNS} FROM ticks""",
    "next_close_label": LABEL,
    "next_close_label_sliced": LABEL,
    "training_set": f"""WITH {LABELLED}
SELECT open, high, low, close, volume, round(hl_spread, 6) AS hl_spread, next_close
FROM labelled""",
    "history_clean": f"WITH {DAILY} {HISTORY} WHERE volume > 1",
    "training_topup": f"""WITH {TICKS}, {DAILY}
SELECT event_time, symbol, open, high, low, close, volume, source, range_bucket,
       round(hl_spread, 4) AS hl_spread, round(oc_change, 4) AS oc_change
FROM ({SILVER})
UNION ALL
SELECT event_time, symbol, round(open, 4), round(high, 4), round(low, 4), round(close, 4),
       volume, source, NULL, round(high - low, 4), NULL FROM daily""",
    "history_cache": f"WITH {DAILY} {HISTORY}",
    "chrono_split": f"WITH {PARTS} SELECT event_id, symbol, part FROM parts",
    "chrono_split_narrowed": f"WITH {PARTS} SELECT event_id, symbol, part FROM parts",
    "linreg_single": f"""WITH {PREDICTIONS}
SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept, n FROM line""",
    "linreg_train": f"""WITH {HEAD_FIT}
SELECT event_id, symbol, next_close, round(prediction, 3) AS prediction FROM tail""",
    "regression_metrics": f"""WITH {HEAD_FIT}
SELECT round(avg(abs(next_close - prediction)), 4) AS mae,
       round(sqrt(avg((next_close - prediction) ** 2)), 4) AS rmse,
       (SELECT count(*) FROM head) AS n_train, count(*) AS n_test FROM tail""",
    "score_fill_missing": f"""WITH {TICKS}
SELECT event_id, open, CASE WHEN volume >= 60 THEN high ELSE 0.0 END AS high, low,
       CASE WHEN volume < 20 THEN 0.0 ELSE close END AS close,
       CAST(0.0 AS DOUBLE) AS volume, CAST(0.0 AS DOUBLE) AS hl_spread FROM ticks""",
    "legacy_prediction_alias": f"""WITH {PREDICTIONS}
SELECT event_id, round(pred_next_close, 4) AS pred_close,
       round(pred_next_close, 4) AS pred_next_close FROM predictions""",
    "latest_batches": f"""WITH {PREDICTIONS}
SELECT event_id, batch_id, close, round(pred_next_close, 4) AS pred_next_close FROM predictions
WHERE batch_id IN (SELECT DISTINCT batch_id FROM predictions ORDER BY batch_id DESC LIMIT 30)""",
    "latest_batch_folders": f"""WITH {PREDICTIONS}
SELECT event_time, symbol, batch_id, close, round(pred_next_close, 4) AS pred_next_close
FROM predictions
WHERE batch_id IN (SELECT DISTINCT batch_id FROM predictions ORDER BY batch_id DESC LIMIT 30)""",
    "online_error": f"""WITH {ERRORS}
SELECT event_id, symbol, close, round(pred_next_close, 4) AS pred_next_close,
       actual_next_close, round(abs_error, 4) AS abs_error FROM errors""",
    "online_mae": f"""WITH {ERRORS}
SELECT round(coalesce(avg(abs_error), 0.0), 6) AS mae FROM errors""",
    "pipeline_counts": f"""WITH {ERRORS}
SELECT (SELECT count(*) FROM ({stats('10 seconds')})) AS n_windows,
       (SELECT count(*) FROM errors) AS n_predictions""",
    "error_histogram": f"""WITH {ERRORS},
bounds AS (SELECT min(abs_error) AS low, max(abs_error) AS high FROM errors)
SELECT bin, count(*) AS n FROM (
  SELECT CAST(least(floor((abs_error - (SELECT low FROM bounds))
      / ((SELECT high FROM bounds) - (SELECT low FROM bounds)) * 30), 29) AS INTEGER) AS bin
  FROM errors
) GROUP BY bin""",
    "latest_windows": f"""WITH {TICKS}
SELECT window_end, symbol, var_close, n_obs FROM (
  SELECT * FROM ({stats('10 seconds')}) ORDER BY window_start DESC, symbol DESC LIMIT 40)""",
    "latest_predictions": f"""WITH {ERRORS}
SELECT event_id, event_time, symbol, actual_next_close,
       round(pred_next_close, 4) AS pred_next_close FROM ({LATEST_ERRORS})""",
    "series_avg_close": f"""WITH {TICKS}
SELECT window_start, symbol, avg_close FROM ({stats('1 hour')})""",
    "pred_vs_actual_long": f"""WITH {ERRORS}, newest AS ({LATEST_ERRORS})
SELECT event_time, symbol, event_id, 'actual_next_close' AS series,
       round(actual_next_close, 4) AS price FROM newest
UNION ALL
SELECT event_time, symbol, event_id, 'pred_next_close', round(pred_next_close, 4) FROM newest""",
    "demo_score_from_silver": f"""WITH {FULL_FIT},
newest AS (SELECT * FROM ticks ORDER BY event_time DESC, event_id DESC LIMIT 500),
scored AS (
  SELECT *, {FITTED} AS pred_next_close,
         lead(close) OVER (PARTITION BY symbol ORDER BY event_time, event_id) AS actual_next_close
  FROM newest)
SELECT event_id, symbol, round(actual_next_close, 3) AS actual_next_close,
       round(pred_next_close, 3) AS pred_next_close,
       round(abs(pred_next_close - actual_next_close), 3) AS abs_error,
       'demo_from_silver' AS source_mode
FROM scored WHERE actual_next_close IS NOT NULL""",
    "daily_payload_flatten": f"WITH {DAILY} SELECT * FROM daily",
    "tolerant_parquet_read": f"""WITH {TICKS}
SELECT event_time, symbol, open, high, low, close, volume, source,
       round(high - low, 6) AS hl_spread FROM ticks""",
    "stats_snapshot": f"WITH {TICKS} {stats('1 hour')}",
    "stats_read_latest": f"WITH {TICKS} {stats('1 hour')}",
    "stats_read_newest_files": f"WITH {TICKS} {stats('1 hour')}",
    "run_log_latest": """
SELECT ts AS timestamp_utc, event_type AS command,
       round(value / 7, 3) AS elapsed_seconds,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS return_code
FROM events ORDER BY ts DESC, event_type DESC LIMIT 6""",
    "human_bytes": HUMAN_BYTES,
    "stream_source_json": f"WITH {TICKS} SELECT {TICK_COLUMNS} FROM ticks",
    "stream_bronze_append": f"WITH {TICKS} SELECT {TICK_COLUMNS} FROM ticks",
    "stream_silver_append": f"WITH {TICKS} {SILVER}",
    "stream_window_stats_complete": f"WITH {TICKS} {stats('1 hour')}",
    "stream_window_stats_update": f"WITH {TICKS} {stats('1 hour')}",
    "stream_window_stats_append": f"""WITH {TICKS}
SELECT * FROM ({stats('1 hour')})
WHERE window_end <= (SELECT max(ts) - INTERVAL '2 minutes' FROM events)""",
    "stream_window_stats_sliding": f"WITH {TICKS} {stats('1 hour', '30 minutes')}",
    "stream_score": f"""WITH {FULL_FIT}
SELECT event_time, symbol, close, round({FITTED}, 3) AS pred_next_close,
       'next_close' AS prediction_target FROM ticks""",
    "stream_progress_metrics": f"""WITH {TICKS}
SELECT 'stats_snapshot' AS name, (SELECT CAST(count(*) AS BIGINT) FROM ticks) AS input_rows,
       (SELECT count(*) FROM ({stats('1 hour')})) AS state_rows,
       CAST(0 AS BIGINT) AS dropped_rows""",
}
