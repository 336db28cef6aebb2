"""DuckDB SQL twins of the registered queries, over the same parquet views.

Written independently of the Spark code, straight from the SQL semantics of
each result (the reference's own checks are SQL).  Traps: DuckDB's ``/`` of
x by 0 gives inf, so ratios use ``NULLIF``; sums are cast back to BIGINT.
Series keys join null-safe (``IS NOT DISTINCT FROM``), like the Spark side:
a NULL series is a group of its own.
"""

from __future__ import annotations

import calendar
import datetime as dt

from flowtally.fixed import (DAY_TYPE_HOLIDAY, DAY_TYPE_ORDINARY, HIGH_ALERT, HIGH_RATIO, LOW_ALERT,
                             LOW_RATIO, NORMAL)

YEARS = (*range(1990, 2003), 2024)      # of the given tables


def _holidays(year: int) -> list[dt.date]:
    """The US federal holidays of a year, by counting through its calendar
    (the engine tests a date against rules instead)."""
    def weekday(month: int, day: int, nth: int) -> dt.date:
        found = [w[day] for w in calendar.monthcalendar(year, month) if w[day]]
        return dt.date(year, month, found[nth])

    monday, thursday = calendar.MONDAY, calendar.THURSDAY
    return [dt.date(year, 1, 1), weekday(1, monday, 2), weekday(2, monday, 2), weekday(5, monday, -1),
            dt.date(year, 7, 4), weekday(9, monday, 0), weekday(10, monday, 1), dt.date(year, 11, 11),
            weekday(11, thursday, 3), dt.date(year, 12, 25)]


HOLIDAYS = ", ".join(f"DATE '{d}'" for year in YEARS for d in _holidays(year))


def is_holiday_sql(day: str) -> str:
    return f"CASE WHEN {day} IN ({HOLIDAYS}) THEN 1 ELSE 0 END"


DT_FMT = "%Y-%m-%d %H:%M:%S"

REC = f"""
hourly AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS traffic,
         COUNT(*) AS n_records
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL
  GROUP BY 1, 2, 3),
rec AS (
  SELECT series,
         strftime(CAST(day AS TIMESTAMP) + to_hours(hour), '{DT_FMT}') AS date_time,
         strftime(day, '%Y-%m-%d') AS date, hour,
         CAST({is_holiday_sql('day')} AS INTEGER) AS is_holiday,
         traffic, n_records, CAST(day AS TIMESTAMP) + to_hours(hour) AS hour_ts
  FROM hourly)"""

BASE = """
base AS (
  SELECT series, is_holiday, hour,
         CAST(SUM(traffic) AS DOUBLE) / COUNT(traffic) AS avg_traffic
  FROM rec GROUP BY 1, 2, 3)"""

ALERTS = f"""
alerts AS (
  SELECT r.series, r.date_time, r.traffic, b.avg_traffic AS baseline, r.is_holiday, r.hour,
         CASE WHEN r.traffic / NULLIF(b.avg_traffic, 0) >= {HIGH_RATIO} THEN '{HIGH_ALERT}'
              WHEN r.traffic / NULLIF(b.avg_traffic, 0) <= {LOW_RATIO} THEN '{LOW_ALERT}'
              ELSE '{NORMAL}' END AS alert_status
  FROM rec r JOIN base b
    ON r.series IS NOT DISTINCT FROM b.series AND r.is_holiday = b.is_holiday AND r.hour = b.hour)"""

CURVE = """
curve AS (
  SELECT series, date, hour,
         CAST(SUM(traffic) OVER (PARTITION BY series, date ORDER BY hour
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_traffic,
         is_holiday
  FROM rec)"""

ROLL = f"""
roll AS (
  SELECT series, date_time AS "current_time",
         strftime(hour_ts - INTERVAL 23 HOUR, '{DT_FMT}') AS window_start,
         CAST(SUM(traffic) OVER w AS DOUBLE) / COUNT(*) OVER w AS avg_traffic,
         CAST(COUNT(*) OVER w AS INTEGER) AS data_count
  FROM rec
  WINDOW w AS (PARTITION BY series ORDER BY hour_ts
               RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW))"""

DAY_MEAN = """
day_mean AS (
  SELECT series, date_time AS "current_time", date || ' 00:00:00' AS window_start,
         CAST(SUM(traffic) OVER w AS DOUBLE) / COUNT(*) OVER w AS avg_traffic,
         CAST(COUNT(*) OVER w AS INTEGER) AS data_count
  FROM rec
  WINDOW w AS (PARTITION BY series, date ORDER BY hour
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

DAVG = """
davg AS (
  SELECT series, date, is_holiday,
         CAST(SUM(traffic) AS DOUBLE) / COUNT(traffic) AS avg_daily_traffic
  FROM rec GROUP BY 1, 2, 3)"""

TOTAL = """
total AS (
  SELECT series, date, is_holiday, CAST(SUM(traffic) AS BIGINT) AS total_daily_traffic
  FROM rec GROUP BY 1, 2, 3)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _day_records(tbl: str, series: str, time_col: str, value: str) -> str:
    return f"""
drec AS (
  SELECT {series} AS series, strftime(CAST({time_col} AS DATE), '%Y-%m-%d') AS date,
         CAST({is_holiday_sql(f'CAST({time_col} AS DATE)')} AS INTEGER) AS is_holiday,
         CAST(ROUND({value} * 100) AS BIGINT) AS traffic
  FROM {tbl} WHERE {time_col} IS NOT NULL AND {value} IS NOT NULL)"""


def _daily_total_sql(drec: str) -> str:
    return _with(drec) + """
SELECT series, date, is_holiday, CAST(SUM(traffic) AS BIGINT) AS total_daily_traffic
FROM drec GROUP BY 1, 2, 3"""


def _daily_average_sql(drec: str) -> str:
    return _with(drec) + """
SELECT series, date, is_holiday, CAST(SUM(traffic) AS DOUBLE) / COUNT(traffic) AS avg_daily_traffic
FROM drec GROUP BY 1, 2, 3"""


ORDERS = _day_records("orders", "o_orderstatus", "o_orderdate", "o_totalprice")
LINEITEM = _day_records("lineitem", "l_returnflag", "l_shipdate", "l_extendedprice")

HOURLY_RECORDS = _with(REC) + """
SELECT series, date_time, date, hour, is_holiday, traffic, n_records FROM rec"""

ALERTS_SQL = _with(REC, BASE, ALERTS) + "SELECT * FROM alerts"

CURVE_SQL = _with(REC, CURVE) + "SELECT * FROM curve"

ROLL_SQL = _with(REC, ROLL) + "SELECT * FROM roll"

DAY_MEAN_SQL = _with(REC, DAY_MEAN) + "SELECT * FROM day_mean"


# The ratio that each stored class rests on: alerts carry their baseline.
RATIOS = """
ratios AS (SELECT alert_status, traffic / NULLIF(baseline, 0) AS ratio FROM alerts)"""


def _misplaced(status: str, wrong: str) -> str:
    return _with(REC, BASE, ALERTS, RATIOS) + f"""
SELECT count(*) FILTER (alert_status = '{status}' AND {wrong}) AS invalid_count FROM ratios"""


# A day's total is the sum of its hours; the curve's value at an hour is the
# sum up to it.  V6 follows from one grouping of the hourly records.
DAY_ENDS = f"""
day_ends AS (
  SELECT series, date,
         CASE max(is_holiday) WHEN 1 THEN '{DAY_TYPE_HOLIDAY}' ELSE '{DAY_TYPE_ORDINARY}' END AS day_type,
         CAST(sum(traffic) AS BIGINT) AS batch_total, max(hour) AS last_hour,
         CAST(sum(traffic) FILTER (hour <= 23) AS BIGINT) AS stream_final
  FROM rec GROUP BY series, date)"""


# Raw traffic rows with unreadable values (every 97th event), repeated rows
# (every 89th) and holidays marked at midnight only; an hour's traffic is the
# largest of its readings.
DIRTY = f"""
WITH raw AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(round(value * 100) AS BIGINT) AS traffic, event_id % 97 = 0 AS bad,
         CASE WHEN hour(ts) = 0 THEN {is_holiday_sql('CAST(ts AS DATE)')} ELSE 0 END AS mark
  FROM events, (VALUES (0), (1)) AS twice(again)
  WHERE ts IS NOT NULL AND value IS NOT NULL AND (again = 0 OR event_id % 89 = 0)),
days AS (SELECT day, max(mark) AS is_holiday FROM raw WHERE NOT bad GROUP BY day),
hours AS (SELECT series, day, hour, max(traffic) AS traffic, count(*) AS n_records
          FROM raw WHERE NOT bad GROUP BY series, day, hour)"""
DIRTY_HOURS_SQL = DIRTY + f"""
SELECT series, strftime(CAST(day AS TIMESTAMP) + to_hours(hour), '{DT_FMT}') AS date_time,
       strftime(day, '%Y-%m-%d') AS date, hour, is_holiday, traffic, n_records
FROM hours JOIN days USING (day)"""
DIRTY_CURVE_SQL = DIRTY + """
SELECT series, strftime(day, '%Y-%m-%d') AS date, hour,
       CAST(sum(traffic) OVER (PARTITION BY series, day ORDER BY hour) AS BIGINT) AS cumulative_traffic,
       is_holiday
FROM hours JOIN days USING (day)"""


# Files by remainder of event_id come in turn.  A row is late when its day had
# ended 5 days before the last time of the files before the previous one.
ARRIVED = """
arrived AS (
  SELECT event_id, event_type, value, ts, event_id % 4 AS file, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS closed_at
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL),
marks AS (
  SELECT a.file, date_trunc('second', max(b.ts)) - INTERVAL 5 DAY AS watermark
  FROM (SELECT DISTINCT file FROM arrived) a JOIN arrived b ON b.file <= a.file - 2 GROUP BY a.file),
judged AS (
  SELECT arrived.*, watermark, coalesce(closed_at <= watermark, false) AS late
  FROM arrived LEFT JOIN marks USING (file))"""
LATE_CURVE = f"""
late_hours AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         sum(CAST(round(value * 100) AS BIGINT)) AS traffic
  FROM judged WHERE NOT late GROUP BY 1, 2, 3)
SELECT series, strftime(day, '%Y-%m-%d') AS date, hour,
       CAST(sum(traffic) OVER (PARTITION BY series, day ORDER BY hour) AS BIGINT) AS cumulative_traffic,
       CAST({is_holiday_sql('day')} AS INTEGER) AS is_holiday
FROM late_hours"""


# A baseline version holds from its time on and is the mean of the hours before.
ASOF = f"""
renewed AS (SELECT unnest([TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-22']) AS valid_from),
versions AS (
  SELECT series, is_holiday, hour, valid_from, CAST(sum(traffic) AS DOUBLE) / count(*) AS baseline
  FROM rec JOIN renewed ON hour_ts < valid_from GROUP BY 1, 2, 3, 4)
SELECT r.series, r.date_time, r.traffic, v.baseline, r.is_holiday, r.hour,
       CASE WHEN r.traffic / NULLIF(v.baseline, 0) >= {HIGH_RATIO} THEN '{HIGH_ALERT}'
            WHEN r.traffic / NULLIF(v.baseline, 0) <= {LOW_RATIO} THEN '{LOW_ALERT}'
            ELSE '{NORMAL}' END AS alert_status,
       strftime(v.valid_from, '{DT_FMT}') AS baseline_version
FROM rec r ASOF JOIN versions v
  ON r.series = v.series AND r.is_holiday = v.is_holiday AND r.hour = v.hour AND r.hour_ts >= v.valid_from"""
LIVE = """
day_sums AS (SELECT series, date, day(CAST(date AS DATE)) AS d, CAST(sum(traffic) AS BIGINT) AS total
             FROM rec GROUP BY series, date)
SELECT series, date, CASE WHEN d % 7 <> 3 THEN total ELSE 0 END AS batch_total,
       CASE WHEN d % 5 <> 2 THEN total ELSE 0 END AS stream_final, CAST(0 AS BIGINT) AS diff,
       CASE WHEN d % 5 = 2 THEN 'total only' WHEN d % 7 = 3 THEN 'curve only' ELSE 'both' END AS sides
FROM day_sums WHERE d % 7 <> 3 OR d % 5 <> 2"""


RECORD_MEANS = """
WITH records AS (
  SELECT event_type AS series, ts, CAST(round(value * 100) AS BIGINT) AS traffic
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL)
SELECT series, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "current_time",
       strftime(ts - INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_start, traffic,
       CAST(sum(traffic) OVER lately AS DOUBLE) / count(*) OVER lately AS avg_traffic,
       CAST(count(*) OVER lately AS INTEGER) AS data_count
FROM records
WINDOW lately AS (PARTITION BY series ORDER BY ts
                  RANGE BETWEEN INTERVAL '23:59:59.999999' PRECEDING AND CURRENT ROW)"""


ORACLE: dict[str, str] = {
    "hourly_records": HOURLY_RECORDS,
    "hourly_baseline": _with(REC, BASE) + "SELECT * FROM base",
    "hourly_baseline_rounded": _with(REC, BASE) + """
SELECT series, is_holiday, hour, ROUND(avg_traffic) AS avg_traffic FROM base""",
    "daily_average": _with(REC, DAVG) + "SELECT * FROM davg",
    "daily_total": _with(REC, TOTAL) + "SELECT * FROM total",
    "daily_total_orders": _daily_total_sql(ORDERS),
    "daily_average_orders": _daily_average_sql(ORDERS),
    "daily_total_lineitem": _daily_total_sql(LINEITEM),
    "daily_average_lineitem": _daily_average_sql(LINEITEM),
    "holiday_diff": _with(REC, BASE) + """,
sides AS (
  SELECT series, hour, max(avg_traffic) FILTER (is_holiday = 0) AS ordinary,
         max(avg_traffic) FILTER (is_holiday = 1) AS off
  FROM base GROUP BY series, hour)
SELECT series, hour, ordinary AS non_holiday_baseline, off AS holiday_baseline,
       -- + 0.0: Spark's decimal rounding never yields -0.0, std::round can
       round((off - ordinary) / nullif(ordinary, 0) * 100, 2) + 0.0 AS diff_percent
FROM sides WHERE ordinary IS NOT NULL AND off IS NOT NULL""",
    "alerts_batch": ALERTS_SQL,
    "alerts_stream": ALERTS_SQL,
    "alerts_stream_clean": ALERTS_SQL,
    "alert_distribution": _with(REC, BASE, ALERTS) + """
SELECT alert_status, COUNT(*) AS record_count FROM alerts GROUP BY alert_status""",
    "check_high": _misplaced(HIGH_ALERT, f"ratio < {HIGH_RATIO}"),
    "check_low": _misplaced(LOW_ALERT, f"ratio > {LOW_RATIO}"),
    "check_normal": _with(REC, BASE, ALERTS, RATIOS) + f"""
SELECT count(*) AS total_normal,
       count(*) FILTER (ratio < {LOW_RATIO}) AS below_low_threshold,
       count(*) FILTER (ratio > {HIGH_RATIO}) AS above_high_threshold,
       count(*) FILTER (ratio >= {LOW_RATIO} AND ratio <= {HIGH_RATIO}) AS within_range
FROM ratios WHERE alert_status = '{NORMAL}'""",
    "cumulative_batch": CURVE_SQL,
    "cumulative_stream": CURVE_SQL,
    "rolling24_batch": ROLL_SQL,
    "rolling24_stream": ROLL_SQL,
    "running_day_mean_batch": DAY_MEAN_SQL,
    "running_day_mean_stream": DAY_MEAN_SQL,
    "check_endpoint": _with(REC, DAY_ENDS) + """
SELECT series, date, day_type, batch_total, stream_final, batch_total - stream_final AS diff
FROM day_ends WHERE last_hour = 23""",
    "check_endpoint_last": _with(REC, DAY_ENDS) + """
SELECT series, date, day_type, batch_total, stream_final, batch_total - stream_final AS diff
FROM day_ends""",
    "endpoint_coverage": _with(REC, DAY_ENDS) + """
SELECT count(*) FILTER (last_hour = 23) AS both_sides,
       count(*) FILTER (last_hour < 23) AS totals_without_end,
       CAST(0 AS BIGINT) AS ends_without_total
FROM day_ends""",
    "endpoint_coverage_lossy": _with(REC, DAY_ENDS) + """,
kept AS (SELECT day(CAST(date AS DATE)) % 7 <> 3 AS total, day(CAST(date AS DATE)) % 5 <> 2 AND last_hour = 23 AS curve_end
         FROM day_ends)
SELECT count(*) FILTER (total AND curve_end) AS both_sides, count(*) FILTER (total AND NOT curve_end) AS totals_without_end,
       count(*) FILTER (curve_end AND NOT total) AS ends_without_total
FROM kept""",
    "import_check_damaged": _with(REC, BASE, DAVG, TOTAL) + """,
counted AS (
  SELECT 'batch_hourly_baseline' AS table_name, count(*) AS n, count(*) FILTER (hour = 5) AS lost, 0 AS changed FROM base
  UNION ALL SELECT 'batch_daily_average', count(*), 0, 0 FROM davg
  UNION ALL SELECT 'batch_daily_total', count(*), 0, count(*) FILTER (day(CAST(date AS DATE)) = 9) FROM total)
SELECT table_name, n AS rows_before, n - lost AS rows_after, CAST(lost + 2 * changed AS BIGINT) AS rows_different
FROM counted""",
    "check_convergence": _with(REC) + """,
means AS (
  SELECT series, date_time,
         CAST(sum(traffic) OVER day_back AS DOUBLE) / count(*) OVER day_back AS lately,
         CAST(sum(traffic) OVER whole_day AS DOUBLE) / count(*) OVER whole_day AS daily
  FROM rec
  WINDOW day_back AS (PARTITION BY series ORDER BY hour_ts
                      RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW),
         whole_day AS (PARTITION BY series, date))
SELECT series, date_time AS "current_time", lately AS stream_rolling_avg, daily AS batch_daily_avg,
       round(abs(lately - daily), 2) AS error,
       round(abs(lately - daily) / nullif(daily, 0) * 100, 2) AS error_pct
FROM means""",
    "import_counts": _with(REC, BASE, DAVG, TOTAL) + """
SELECT * FROM (VALUES ('batch_hourly_baseline', (SELECT count(*) FROM base)),
                      ('batch_daily_average', (SELECT count(*) FROM davg)),
                      ('batch_daily_total', (SELECT count(*) FROM total))) AS t(table_name, row_count)""",
    "import_check": _with(REC, BASE, DAVG, TOTAL) + """
SELECT table_name, n AS rows_before, n AS rows_after, CAST(0 AS BIGINT) AS rows_different
FROM (VALUES ('batch_hourly_baseline', (SELECT count(*) FROM base)),
             ('batch_daily_average', (SELECT count(*) FROM davg)),
             ('batch_daily_total', (SELECT count(*) FROM total))) AS t(table_name, n)""",
    "daily_total_dates": _with(REC, TOTAL) + """
SELECT * FROM total WHERE date IN ('2024-01-02', '2024-01-15')""",
    "export_round_trip": _with(REC, TOTAL) + "SELECT * FROM total",
    "conformed_total": _with(REC, TOTAL) + "SELECT * FROM total",
    "view_select": _with(REC, TOTAL) + "SELECT * FROM total",
    "catalog_round_trip": _with(REC, BASE) + "SELECT * FROM base",
    "total_preview": _with(REC, TOTAL) + "SELECT * FROM total ORDER BY series, date LIMIT 10",
    "cumulative_stream_append": CURVE_SQL,
    "alerts_stream_append": ALERTS_SQL,
    "rolling24_stream_unordered": ROLL_SQL,
    "dirty_csv": DIRTY_HOURS_SQL,
    "dirty_csv_stream": DIRTY_CURVE_SQL,
    "dirty_csv_rejected": DIRTY + """
SELECT 'value' AS reject_reason, count(*) AS record_count FROM raw WHERE bad""",
    "csv_round_trip": f"""
WITH marked AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(ROUND(value * 100) AS BIGINT) AS traffic,
         CASE WHEN hour(ts) = 0 AND {is_holiday_sql('CAST(ts AS DATE)')} = 1
              THEN 1 ELSE 0 END AS mark
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL),
days AS (SELECT day, MAX(mark) AS is_holiday FROM marked GROUP BY day),
hourly AS (SELECT series, day, hour, CAST(SUM(traffic) AS BIGINT) AS traffic, COUNT(*) AS n_records
           FROM marked GROUP BY 1, 2, 3)
SELECT h.series, strftime(CAST(h.day AS TIMESTAMP) + to_hours(h.hour), '{DT_FMT}') AS date_time,
       strftime(h.day, '%Y-%m-%d') AS date, h.hour, CAST(d.is_holiday AS INTEGER) AS is_holiday,
       h.traffic, h.n_records
FROM hourly h JOIN days d ON h.day = d.day""",
    "late_rows": _with(ARRIVED) + f"""
SELECT event_id, event_type AS series, value, CAST(file AS BIGINT) AS batch_id,
       strftime(closed_at, '{DT_FMT}') AS closed_at, strftime(watermark, '{DT_FMT}') AS watermark
FROM judged WHERE late""",
    "late_curve": _with(ARRIVED, LATE_CURVE),
    "replay_in_order": _with(LINEITEM) + """
SELECT series, date, 0 AS hour, CAST(sum(traffic) AS BIGINT) AS cumulative_traffic, is_holiday
FROM drec GROUP BY series, date, is_holiday""",
    "cumulative_stream_keyed": CURVE_SQL,
    "incremental_baseline": _with(REC, BASE) + "SELECT * FROM base",
    "incremental_average": _with(REC, DAVG) + "SELECT * FROM davg",
    "incremental_total": _with(REC, TOTAL) + "SELECT * FROM total",
    "alerts_asof": _with(REC, ASOF),
    "alerts_asof_stream": _with(REC, ASOF),
    "endpoint_live": _with(REC, LIVE),
    "intake_metrics": DIRTY + """
SELECT run, metric, CAST(value AS BIGINT) AS value
FROM (SELECT count(*) AS n, count(*) FILTER (bad) AS n_bad FROM raw),
     (VALUES ('batch'), ('stream')) AS runs(run),
     LATERAL (VALUES ('rows_read', n), ('malformed', 0), ('rejected_time', 0), ('rejected_value', n_bad),
                     ('kept', n - n_bad)) AS m(metric, value)""",
    "dirty_csv_stream_marked": DIRTY_CURVE_SQL,
    "rolling_records": RECORD_MEANS,
    "rolling_records_stream": RECORD_MEANS,
    "rolling_topk": _with(REC, ROLL) + """
SELECT * FROM roll ORDER BY "current_time", series LIMIT 20""",
    "curve_ordered": _with(REC, CURVE) + "SELECT * FROM curve ORDER BY series, date, hour",
}
