"""SQL of the queries that pass through files."""

from __future__ import annotations

from .oracle import _ASSIGNED, _DAMAGED, _DURATION_BAD, _FIRST, _LINES, _MEASURES, _NORM, ORACLE

# The first reports as they are stored: no re-issues.
_STORED = _FIRST
_ISSUE_PARTS = f"""
q AS (SELECT quantile_cont(duration_minutes, 0.25) AS q1, quantile_cont(duration_minutes, 0.75) AS q3 FROM counted),
keyed AS (SELECT *, count(*) OVER (PARTITION BY flight_id, start_time_utc, region_code) AS copies FROM counted),
issues AS (
  SELECT flight_id, 'duration_range' AS check_name, 'FAIL' AS severity FROM counted WHERE {_DURATION_BAD}
  UNION ALL
  SELECT flight_id, 'duration_outliers', 'WARN' FROM counted, q
  WHERE duration_minutes < q1 - 1.5 * (q3 - q1) OR duration_minutes > q3 + 1.5 * (q3 - q1)
  UNION ALL
  SELECT flight_id, 'uniqueness', 'FAIL' FROM keyed WHERE copies > 1
)"""
_CSV_VEHICLE = """CASE WHEN k % 2 = 1 AND k % 7 = 0 THEN vehicle_category || chr(10) || '"x", y' ELSE vehicle_category END"""

ORACLE |= {
    "csv_scan": f"""WITH {_STORED}
        SELECT flight_id, start_time_utc, end_time_utc, duration_minutes, region_code, {_CSV_VEHICLE} AS vehicle_category, latitude
        FROM norm""",
    "repeated_headers": """SELECT CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'B' || o_orderkey END AS flight_id,
        o_orderstatus AS notes, o_orderpriority AS notes_1 FROM orders""",
    "workbook_scan": """SELECT 'F-' || o_orderkey AS flight_id,
        o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS start_time_utc,
        o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) + to_hours(6) AS end_time_utc,
        'R' || (o_custkey % 25) AS region_code FROM orders""",
    "mixed_sources": "SELECT 'F-' || o_orderkey AS flight_id, o_orderdate AS start_time_utc, o_orderkey % 3 = 1 AS degraded FROM orders",
    "noise_dropped": f"""WITH {_DAMAGED} SELECT source, trim(c[1]) AS first_cell FROM kept
        WHERE len(list_filter(c, lambda x: regexp_matches(trim(x), '^ ?F-[0-9]*7$'))) = 0""",
    "text_table_rejects": f"""WITH {_DAMAGED} SELECT 'report-' || n AS source, len(c) || ' fields, header has 4' AS reason, count(*) AS lines
        FROM cut WHERE len(c) NOT IN (1, 4) GROUP BY ALL""",
    "source_checksums": "SELECT sha256(s_name || chr(10)) AS checksum FROM supplier UNION ALL SELECT ''",
    "own_format": "SELECT 'F-' || o_orderkey AS flight_id, o_orderdate AS start_time_utc FROM orders",
    "sanitized_rows": """SELECT CASE WHEN k % 17 = 0 THEN '' ELSE 'F-' || k END AS flight_id,
        CAST(CAST(k * 7919 % 1900 - 950 AS DOUBLE) / 10 AS DECIMAL(9, 1))::VARCHAR AS latitude,
        CAST(CAST(k * 104729 % 3700 - 1850 AS DOUBLE) / 10 AS DECIMAL(9, 1))::VARCHAR AS longitude,
        CASE WHEN k % 4 <> 0 THEN 'P' || (k % 7) ELSE '' END AS payload_type
        FROM (SELECT o_orderkey AS k FROM orders CROSS JOIN (VALUES (0), (1)) AS s(seq) WHERE seq = 0 OR o_orderkey % 50 = 0)""",
    "decimal_cells": """SELECT CASE WHEN k % 17 = 0 THEN '' ELSE 'F-' || k END AS flight_id,
        CAST(CAST(k * 7919 % 1900 - 950 AS DOUBLE) / 10 AS DECIMAL(9, 1))::VARCHAR AS latitude
        FROM (SELECT o_orderkey AS k FROM orders CROSS JOIN (VALUES (0), (1)) AS s(seq) WHERE seq = 0 OR o_orderkey % 50 = 0)""",
    "pages_concatenated": """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS a,
        CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS b FROM orders""",
    "metric_exclusions_log": f"""WITH {_NORM} SELECT flight_id, start_time_utc, region_code, duration_minutes,
        CASE WHEN duration_minutes <= 0 THEN 'duration not above the lower bound' ELSE 'duration above the upper bound' END AS reason
        FROM counted WHERE duration_minutes <= 0 OR duration_minutes > 1440""",
    "canonical_scan": f"WITH {_STORED} SELECT flight_id, start_time_utc, duration_minutes, region_code, superseded FROM norm",
    "raw_csv_roundtrip": f"""WITH {_STORED} SELECT CASE WHEN k % 17 <> 0 THEN 'F-' || k END AS flight_id, region_name,
        CAST(latitude AS DECIMAL(9, 1))::VARCHAR AS latitude, CASE WHEN k % 2 = 1 THEN 'n/a' END AS notes FROM typed""",
    "lineage_doc": f"""WITH {_STORED} SELECT (SELECT count(*) FROM typed) AS raw, (SELECT count(*) FROM norm) AS normalized,
        (SELECT count(*) FROM counted) AS valid, (SELECT count(*) FROM typed WHERE NOT ok) AS invalid,
        (SELECT count(*) FROM norm WHERE superseded) AS duplicates, true AS whole_checksum""",
    "quality_json": f"""WITH {_STORED}, {_ISSUE_PARTS}, checks AS (
          SELECT unnest(['schema', 'duration_range', 'coordinate_range', 'uniqueness', 'monthly_completeness', 'duration_outliers', 'sources'])
            AS check_name), n AS (SELECT check_name, any_value(severity) AS status, count(DISTINCT flight_id) AS n FROM issues GROUP BY 1),
        gaps AS (SELECT sum(g) AS g FROM (SELECT max(m) - min(m) + 1 - count(*) AS g FROM (
            SELECT DISTINCT year(start_time_utc) AS y, month(start_time_utc) AS m FROM counted) GROUP BY y))
        SELECT 'v1' AS dataset_version, check_name,
          CASE WHEN check_name = 'monthly_completeness' AND g > 0 THEN 'WARN' ELSE coalesce(n.status, 'OK') END AS status,
          coalesce(n.n, 0) AS impacted_records
        FROM checks LEFT JOIN n USING (check_name), gaps""",
    "issues_replaced": f"WITH {_STORED}, {_ISSUE_PARTS} SELECT DISTINCT flight_id AS flight_uid, check_name, severity FROM issues",
    "version_status": f"""WITH {_STORED}, {_ISSUE_PARTS}, n AS (
          SELECT count(DISTINCT check_name) FILTER (severity = 'WARN') + (SELECT CAST(sum(g) > 0 AS INTEGER) FROM (
              SELECT max(m) - min(m) + 1 - count(*) AS g FROM (
                SELECT DISTINCT year(start_time_utc) AS y, month(start_time_utc) AS m FROM counted) GROUP BY y)) AS warn_count,
            count(DISTINCT check_name) FILTER (severity = 'FAIL') AS fail_count FROM issues)
        SELECT 'v1' AS dataset_version, CASE WHEN fail_count > 0 THEN 'quality_fail' WHEN warn_count > 0 THEN 'quality_warn' ELSE 'validated' END
          AS status, 1995 AS year, warn_count, fail_count FROM n""",
    "stage_log": """SELECT 'v1' AS version, unnest(['dataset.ingested', 'dataset.validated', 'aggregates.built', 'insights.ready']) AS event,
        unnest([1, 2, 1, 1]) AS times""",
    "geo_job": f"""WITH {_ASSIGNED.replace("src AS (", "src_all AS (", 1).replace("), raw AS (", "), src AS (SELECT * FROM src_all WHERE seq = 0), raw AS (", 1)}
        SELECT geo_region AS region_code, count(*) AS flights FROM assigned WHERE NOT (longitude = 0 AND latitude = 0) GROUP BY 1""",
    "region_refresh": "SELECT code, name, edge_count FROM (" + ORACLE["region_directory"] + ")",
    "export_csv": f"""WITH {_NORM}, years AS (SELECT region_code, year, {_MEASURES} FROM metric GROUP BY region_code, year) SELECT * FROM years""",
    "reconcile_stored": f"""WITH {_STORED}, n AS (
          SELECT region_code, year(start_time_utc) AS year, count(*) AS c FROM counted GROUP BY ALL)
        SELECT y.region_code, y.year, flights_count, coalesce(c, 0) AS normalized_flights
        FROM years y LEFT JOIN n ON n.region_code = y.region_code AND n.year = y.year""",
    "operational_metrics": f"""WITH {_ASSIGNED}, r AS (SELECT round(count(geo_region) / count(*), 6) AS geocoded_ratio FROM assigned)
        SELECT geocoded_ratio, f AS quality_fail_count, f > 0 AS quality_alert, geocoded_ratio < 0.99 AS geocoding_alert
        FROM r, (SELECT CAST(count(*) FILTER (status = 'quality_fail') AS BIGINT) AS f FROM (STATUS))""",
    "own_check": f"""WITH {_NORM} SELECT DISTINCT flight_id AS flight_uid, 'priority' AS check_name, 'FAIL' AS severity
        FROM counted WHERE vehicle_category = '1-URGENT'""",
    "sample_rows": f"""WITH {_LINES}, keyed AS (SELECT *, count(*) OVER (PARTITION BY flight_id, start_time_utc, region_code) AS copies FROM lines)
        SELECT * FROM (SELECT 'uniqueness' AS check_name, least(5, count(*) FILTER (copies > 1)) AS shown FROM keyed
          UNION ALL SELECT 'duration_range', least(5, count(*)) FROM lines WHERE duration_minutes < 2 OR duration_minutes > 40) WHERE shown > 0""",
    "month_gaps": f"""WITH {_NORM}, seen AS (SELECT DISTINCT year(start_time_utc) AS y, month(start_time_utc) AS m FROM counted
          WHERE month(start_time_utc) <> 6)
        SELECT 'monthly_completeness' AS check_name, CASE WHEN sum(g) > 0 THEN 'WARN' ELSE 'OK' END AS status,
          CAST(sum(g) AS BIGINT) AS violation_count FROM (SELECT max(m) - min(m) + 1 - count(*) AS g FROM seen GROUP BY y)""",
    "incremental_files": f"WITH {_NORM} SELECT flight_id, start_time_utc, end_time_utc, superseded FROM norm",
    "quality_gate": f"""WITH {_NORM} SELECT flight_id, start_time_utc, CASE seq WHEN 0 THEN 'passed' ELSE 'held' END AS gate FROM norm""",
    "stage_events": f"""WITH {_NORM}, n AS (SELECT seq, count(*) AS records FROM norm GROUP BY seq)
        SELECT seq AS batch_id, e.event, records, e.status AS quality_status FROM n JOIN (VALUES
          (0, 'dataset.ingested', 'OK'), (0, 'dataset.validated', 'OK'), (0, 'aggregates.built', 'OK'), (0, 'insights.ready', 'OK'),
          (1, 'dataset.ingested', 'OK'), (1, 'dataset.validated', 'FAIL')) AS e(s, event, status) ON e.s = n.seq""",
}
ORACLE["operational_metrics"] = ORACLE["operational_metrics"].replace("STATUS", ORACLE["version_status"])

# The stored report says what its JSON form says.
ORACLE["report_stored"] = ORACLE["quality_json"]
ORACLE["redelivered_files"] = f"""WITH {_STORED}
    SELECT flight_id, start_time_utc, CASE WHEN k % 4 = 0 THEN 'again' ELSE vehicle_category END AS vehicle_category, superseded
    FROM norm WHERE k % 4 <> 1"""
