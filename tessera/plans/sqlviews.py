"""DuckDB twins of ``tessera.sources.testviews`` for the oracle SQL.

``with_views(sql, ...)`` prefixes a statement with the CTEs it names, plus
their dependencies, so each oracle string is self-contained ANSI SQL over the
driver's pre-registered tables.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "v_measurements": ("""
        SELECT event_id, event_type AS formula, value,
               printf('NL%05d', user_id) AS station_number,
               CAST(ts AS TIMESTAMP) AS timestamp_measured,
               CAST(ts AS DATE) AS date
        FROM events""", ()),
    "v_stations": ("""
        SELECT number, 'Location ' || number AS location
        FROM (SELECT DISTINCT station_number AS number FROM v_measurements) s""", ("v_measurements",)),
    "v_station_details": ("""
        SELECT station_number AS number, 'Location ' || station_number AS location,
               list_sort(list(DISTINCT formula)) AS components, min(date) AS first_seen
        FROM v_measurements GROUP BY station_number""", ("v_measurements",)),
    "v_parts": ("""
        SELECT date, station_number, max(timestamp_measured) AS last_ts,
               min(event_id) AS first_id, count(*) AS n,
               max(CASE WHEN formula = 'error' THEN 1 ELSE 0 END) AS has_error
        FROM v_measurements GROUP BY date, station_number""", ("v_measurements",)),
    "v_meas_ledger": ("""
        SELECT 'air_quality_data' AS asset_key,
               CAST(date AS VARCHAR) || '|' || station_number AS partition_key,
               date, station_number, 'MATERIALIZED' AS status,
               last_ts AS event_time, first_id * 2 AS event_id, n AS row_count
        FROM v_parts""", ("v_parts",)),
    "v_meas_ledger_rr": ("""
        SELECT * FROM v_meas_ledger
        UNION ALL
        SELECT 'air_quality_data', CAST(date AS VARCHAR) || '|' || station_number,
               date, station_number, 'FAILED', last_ts + INTERVAL 1 HOUR,
               first_id * 2 + 1, 0
        FROM v_parts WHERE has_error = 1""", ("v_meas_ledger",)),
    "v_meas_ledger_many": ("""
        SELECT * FROM v_meas_ledger WHERE event_id % 3 <> 0
        UNION ALL
        SELECT 'station_names', partition_key, date, station_number, 'MATERIALIZED',
               event_time + INTERVAL 10 DAY, event_id, row_count FROM v_meas_ledger""", ("v_meas_ledger",)),
    "v_meas_ledger_rr_many": ("""
        SELECT * FROM v_meas_ledger_rr WHERE event_id % 3 <> 0
        UNION ALL
        SELECT 'station_names', partition_key, date, station_number, 'MATERIALIZED',
               event_time + INTERVAL 10 DAY, event_id, row_count FROM v_meas_ledger_rr""", ("v_meas_ledger_rr",)),
    # Backfill requests with their errors, in the order of the rules.
    "v_backfill_errors": ("""
        SELECT *, concat_ws(';',
            CASE WHEN start_date IS NULL OR end_date IS NULL THEN 'start_date or end_date missing' END,
            CASE WHEN start_date > end_date THEN 'start_date after end_date' END,
            CASE WHEN policy IS NULL THEN 'policy missing'
                 WHEN policy NOT IN ('missing', 'all') THEN 'unknown policy ' || policy END,
            CASE WHEN policy = 'missing' AND asset_key IS NULL THEN 'policy missing needs asset_key' END,
            CASE WHEN file_type <> 'parquet' THEN 'unsupported type ' || file_type END,
            CASE WHEN location LIKE 'minio://%' THEN 'unsupported scheme minio' END) AS errors
        FROM v_backfills""", ("v_backfills",)),
    "v_backfill_checked": ("""
        SELECT * REPLACE (concat_ws(';', nullif(errors, ''),
            CASE WHEN asset_key IS NOT NULL AND NOT skip_checks
                      AND asset_key NOT IN (SELECT asset_key FROM v_meas_ledger) THEN 'unknown asset ' || asset_key END) AS errors)
        FROM v_backfill_errors""", ("v_backfill_errors", "v_meas_ledger")),
    "v_ledger": ("""
        SELECT CASE WHEN o_custkey % 10 < 7 THEN 'air_quality_data' ELSE 'station_names' END AS asset_key,
               CAST(o_custkey AS VARCHAR) AS partition_key,
               CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'MATERIALIZED'
                                  WHEN 'P' THEN 'IN_PROGRESS' END AS status,
               CAST(o_orderdate AS TIMESTAMP) AS event_time,
               o_orderkey AS event_id
        FROM orders""", ()),
    # Runs flattened: one column per tag instead of a map.
    "v_runs": ("""
        SELECT run_id, job_name, status, asset_name, location,
               CASE WHEN partitioned THEN CAST(day AS VARCHAR) || '|' || station END AS partition_key,
               CASE WHEN partitioned THEN CAST(day AS VARCHAR) END AS tag_daily,
               CASE WHEN partitioned THEN station END AS tag_station,
               backfill, schedule, auto_mat,
               CASE WHEN partitioned THEN asset || ':' || CAST(day AS VARCHAR) || '|' || station END AS run_key,
               CASE WHEN status <> 'STARTED' THEN end_us END AS end_us,
               end_us + o_orderkey % 600 * 1000000 AS update_us, o_orderkey
        FROM (
          SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderkey,
                 asset || '_job' AS job_name,
                 CASE o_orderstatus WHEN 'F' THEN 'FAILURE' WHEN 'O' THEN 'SUCCESS'
                                    WHEN 'P' THEN 'STARTED' END AS status,
                 CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE asset END AS asset_name,
                 asset,
                 CASE WHEN o_custkey % 2 = 0 THEN 'ingestion-a' ELSE 'ingestion-b' END AS location,
                 o_orderkey % 20 <> 0 AS partitioned,
                 CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) // 90 AS INTEGER) AS DATE) AS day,
                 printf('NL%05d', o_custkey // 10) AS station,
                 CASE WHEN o_orderpriority LIKE '1%' THEN 'backfill-' || CAST(o_custkey % 10 AS VARCHAR) END AS backfill,
                 CASE WHEN o_orderpriority LIKE '2%' OR (o_orderpriority LIKE '1%' AND o_orderkey % 7 = 0)
                      THEN 'schedule-' || CAST(o_custkey % 4 AS VARCHAR) END AS schedule,
                 CASE WHEN o_orderpriority LIKE '3%' THEN 'true'
                      WHEN o_orderpriority LIKE '4%' AND o_orderkey % 9 = 0 THEN '' END AS auto_mat,
                 epoch_us(CAST(o_orderdate AS TIMESTAMP)) + (o_orderkey % 86400) * 1000000
                   + (o_orderkey * 37) % 1000000 AS end_us
          FROM (SELECT *, CASE WHEN o_custkey % 3 = 0 THEN 'air_quality_data'
                               WHEN o_custkey % 3 = 1 THEN 'daily_air_quality_data'
                               ELSE 'station_names' END AS asset FROM orders) o
        ) r""", ()),
    "v_backfills": ("""
        SELECT c_custkey AS request_id, 'backfill-' || CAST(c_custkey AS VARCHAR) AS name,
               'air_quality_job' AS job_name, 'ingestion' AS repository_name,
               CASE WHEN c_custkey % 17 = 5 THEN NULL WHEN c_custkey % 11 = 10 THEN 'sometimes'
                    WHEN c_custkey % 2 = 0 THEN 'missing' ELSE 'all' END AS policy,
               CASE WHEN c_custkey % 7 = 3 THEN NULL WHEN c_custkey % 23 = 6 THEN 'no_such_asset'
                    ELSE 'air_quality_data' END AS asset_key,
               CASE WHEN c_custkey % 19 <> 4 THEN CAST(DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS DATE) END AS start_date,
               CAST(CASE WHEN c_custkey % 9 = 8 THEN DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) - 1
                    ELSE DATE '2024-01-01' + CAST(c_custkey % 30 + c_custkey % 4 AS INTEGER) END AS DATE) AS end_date,
               [printf('NL%05d', c_custkey // 10), printf('NL%05d', c_custkey // 10 + 1),
                printf('NL%05d', c_custkey // 10 + 2)] AS stations,
               CASE WHEN c_custkey % 13 = 12 THEN 'csv' ELSE 'parquet' END AS file_type,
               c_custkey % 2 = 1 AS skip_checks,
               CASE WHEN c_custkey % 29 = 7 THEN 'minio://bucket/x' WHEN c_custkey % 2 = 0 THEN 'gs://bucket/x'
                    ELSE '/data/x' END AS location
        FROM customer""", ()),
    "v_calls": ("""
        SELECT event_type AS bucket, event_id AS call_id, CAST(ts AS TIMESTAMP) AS ts FROM events""", ()),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <views in dependency order>, <extra CTEs> <sql>``."""
    ctes = [f"{n} AS ({VIEWS[n][0]}\n)" for n in _closure(names)]
    ctes += [f"{k} AS ({v}\n)" for k, v in (extra or {}).items()]
    if not ctes:
        return sql
    return "WITH " + ",\n".join(ctes) + "\n" + sql
