"""The registered queries as SQL over the driver tables, written independently of the library."""

from __future__ import annotations

# Reports as the adapter defines them, with times and numbers taken as meant.
_TYPED = """
src AS (
  SELECT o_orderkey AS k, seq, o_custkey AS cust, c_nationkey AS nation,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER))
           - to_hours(CASE WHEN o_orderkey % 3 = 1 THEN 3 ELSE 0 END) AS start_time_utc,
         o_custkey % 1600 - 20 + seq * 30 AS gap,
         o_orderpriority, o_orderstatus, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey
  CROSS JOIN (VALUES (0), (1)) AS s(seq)
  WHERE seq = 0 OR o_orderkey % 50 = 0
), raw AS (
  SELECT *, start_time_utc + to_minutes(CAST(gap AS INTEGER)) AS end_time_utc,
         CASE WHEN k % 17 <> 0 THEN 'F-' || k END AS given_id,
         CASE WHEN k % 5 IN (0, 1) THEN NULL WHEN k % 5 = 2 THEN 45.5 ELSE CAST(k * 37 % 1500 AS DOUBLE) END AS given,
         CASE WHEN k % 23 <> 0 THEN 'R' || nation END AS region_code,
         'NATION_' || nation AS region_name,
         CAST(k * 7919 % 1900 - 950 AS DOUBLE) / 10 AS latitude,
         CAST(k * 104729 % 3700 - 1850 AS DOUBLE) / 10 AS longitude,
         CASE WHEN k % 4 <> 0 THEN 'P' || (k % 7) ELSE '' END AS payload_type
  FROM src
), hashed AS (
  SELECT *, CASE WHEN given_id IS NULL THEN
      sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(
        strftime(start_time_utc, '%Y-%m-%d %H:%M:%S') || '+00:00|' ||
        strftime(end_time_utc, '%Y-%m-%d %H:%M:%S') || '+00:00|' || coalesce(region_code, region_name))) END AS h
  FROM raw
), named AS (
  SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
      translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12)
      AS surrogate_id
  FROM hashed
), typed AS (
  SELECT k, seq, coalesce(given_id, surrogate_id) AS flight_id, surrogate_id, start_time_utc, end_time_utc,
         coalesce(given, CAST(gap AS DOUBLE)) AS duration_minutes, given, gap, region_code, region_name,
         latitude, longitude, o_orderpriority AS vehicle_category, o_orderstatus AS operator_type,
         c_mktsegment AS flight_purpose, payload_type,
         end_time_utc >= start_time_utc AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AS ok
  FROM named
)"""

_NORM = _TYPED + """, norm AS (
  SELECT *, row_number() OVER (
      PARTITION BY flight_id, date_trunc('second', start_time_utc), coalesce(region_code, '')
      ORDER BY seq DESC, k DESC) > 1 AS superseded
  FROM typed WHERE ok
), counted AS (
  SELECT * FROM norm WHERE NOT superseded
), metric AS (
  SELECT *, CAST(round(duration_minutes * 100) AS BIGINT) AS hundredths,
         year(start_time_utc) AS year, month(start_time_utc) AS month
  FROM counted WHERE duration_minutes > 0 AND duration_minutes <= 1440
)"""

# Sum and average of hundredths of minutes, rounded half up.
_MEASURES = """count(DISTINCT flight_id) AS flights_count,
  CAST(sum(hundredths) AS BIGINT) / 100.0 AS duration_sum_min,
  CAST((2 * sum(hundredths) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0 AS duration_avg_min"""

_YEARS = _NORM + f""", years AS (
  SELECT region_code, year, {_MEASURES} FROM metric GROUP BY region_code, year
)"""

_MONTHS = _NORM + f""", months AS (
  SELECT region_code, year, month, {_MEASURES} FROM metric GROUP BY region_code, year, month
)"""

_LINES = """
lines AS (
  SELECT 'L-' || l_orderkey || '-' || l_linenumber AS flight_id, l_shipdate AS start_time_utc,
         CASE WHEN l_returnflag <> 'N' THEN 'R' || l_linenumber END AS region_code,
         l_quantity AS duration_minutes, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem
)"""

_REGIONS = """
grid AS (
  SELECT n_nationkey AS k, 'R' || n_nationkey AS code, n_name AS name,
         CAST(n_nationkey % 5 * 72 - 180 AS DOUBLE) AS w, CAST(n_nationkey // 5 * 36 - 90 AS DOUBLE) AS s
  FROM nation
), shapes AS (
  SELECT *, CASE WHEN k = 6 THEN w + 30 ELSE w + 36 END AS cx, CASE WHEN k = 6 THEN s + 15 ELSE s + 18 END AS cy
  FROM grid
)"""

_ASSIGNED = _NORM + "," + _REGIONS + """, hits AS (
  SELECT f.k, f.seq, code, CAST((cx - longitude) * (cx - longitude) + (cy - latitude) * (cy - latitude) AS FLOAT) AS d
  FROM counted f JOIN shapes
    ON longitude BETWEEN w AND w + 72 AND latitude BETWEEN s AND s + 36
   AND NOT (shapes.k = 6 AND longitude > w + 36 AND latitude > s + 18)
   AND NOT (shapes.k = 12 AND longitude > w + 26 AND longitude < w + 46 AND latitude > s + 13 AND latitude < s + 23)
  WHERE NOT (longitude = 0 AND latitude = 0)
), best AS (
  SELECT k, seq, count(*) AS geo_matches, arg_min(code, struct_pack(d := d, code := code)) AS geo_region
  FROM hits GROUP BY k, seq
), assigned AS (
  SELECT f.*, best.geo_region, coalesce(best.geo_matches, 0) AS geo_matches
  FROM counted f LEFT JOIN best ON best.k = f.k AND best.seq = f.seq
)"""

_DAMAGED = r"""
lines AS (
  SELECT r_regionkey AS n, CAST(-1 AS BIGINT) AS a, CAST(0 AS BIGINT) AS b, NULL AS value FROM region
  UNION ALL
  SELECT o_orderkey % 5, o_orderkey, 0,
         concat_ws(CASE o_orderkey % 5 WHEN 0 THEN ';' WHEN 1 THEN chr(9) ELSE ',' END, ' F-' || o_orderkey,
                   strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
                   CAST(o_orderkey % 90 AS VARCHAR)) FROM orders
  UNION ALL
  SELECT doc_id % 5, doc_id, pos, part
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS part,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
), cut AS (
  SELECT n, string_split(value, CASE n WHEN 0 THEN ';' WHEN 1 THEN chr(9) ELSE ',' END) AS c
  FROM lines WHERE value IS NOT NULL
), kept AS (SELECT 'report-' || n AS source, c FROM cut WHERE len(c) = 4)"""

_FIRST = _YEARS.replace("src AS (", "src_all AS (", 1).replace(
    "), raw AS (", "), src AS (SELECT * FROM src_all WHERE seq = 0), raw AS (", 1
)


def _two_versions(tail: str) -> str:
    """The same chain twice, as old_... (before re-issues) and new_... tables."""
    names = ("src_all", "src", "raw", "hashed", "named", "typed", "norm", "counted", "metric", "years")

    def prefixed(chain: str, tag: str) -> str:
        for name in names:
            for before, after in ((f"{name} AS (", f"{tag}_{name} AS ("), (f"FROM {name}", f"FROM {tag}_{name}")):
                chain = chain.replace(before, after)
        return chain.replace(f"FROM {tag}_src_all", f"FROM {tag}_src_all").replace(f"{tag}_{tag}_", f"{tag}_")

    return prefixed(_FIRST, "old") + "," + prefixed(_YEARS, "new") + tail


_CANONICAL = """flight_id, surrogate_id, start_time_utc, end_time_utc, duration_minutes, region_code, region_name,
  latitude, longitude, vehicle_category, operator_type, flight_purpose, payload_type, superseded"""

_DURATION_BAD = "duration_minutes < 1 OR duration_minutes > 1440"

# All checks of the suite that can hit a normalised report: the other rules hold by construction.
_ISSUES = _NORM + f""", fence AS (
  SELECT quantile_cont(duration_minutes, 0.25) AS q1, quantile_cont(duration_minutes, 0.75) AS q3 FROM counted
), issues AS (
  SELECT DISTINCT flight_id AS flight_uid, 'duration_range' AS check_name, 'FAIL' AS severity
  FROM counted WHERE {_DURATION_BAD}
  UNION ALL
  SELECT DISTINCT flight_id, 'duration_outliers', 'WARN' FROM counted, fence
  WHERE duration_minutes < q1 - 1.5 * (q3 - q1) OR duration_minutes > q3 + 1.5 * (q3 - q1)
)"""


def _outcome(name: str, ok: str, bad: str, status: str = "FAIL") -> str:
    return f"""SELECT '{name}' AS check_name, CASE WHEN n > 0 THEN '{status}' ELSE 'OK' END AS status,
      CASE WHEN n > 0 THEN {bad} ELSE '{ok}' END AS summary, n AS violation_count"""


def _pct(now: str, before: str) -> str:
    return f"round(100.0 * CAST({now} - {before} AS DOUBLE) / nullif(CAST({before} AS DOUBLE), 0), 2)"


ORACLE: dict[str, str] = {
    "flights_by_region_year": f"WITH {_YEARS} SELECT * FROM years",
    "normalize_flights": f"WITH {_NORM} SELECT {_CANONICAL} FROM norm",
    "ingest_counts": f"""WITH {_NORM}
        SELECT (SELECT count(*) FROM typed) AS raw, (SELECT count(*) FROM norm) AS normalized,
               (SELECT count(*) FROM counted) AS valid, (SELECT count(*) FROM typed WHERE NOT ok) AS invalid,
               (SELECT count(*) FROM norm WHERE superseded) AS duplicates""",
    "rejected_rows": f"""WITH {_TYPED}
        SELECT flight_id, start_time_utc, end_time_utc, latitude, longitude,
               concat_ws(',', CASE WHEN end_time_utc < start_time_utc THEN 'end_before_start' END,
                         CASE WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude_range' END,
                         CASE WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude_range' END) AS reasons
        FROM typed WHERE NOT ok""",
    "surrogate_ids": f"""WITH {_TYPED}
        SELECT surrogate_id, flight_id, start_time_utc, end_time_utc, region_code, region_name
        FROM typed WHERE surrogate_id IS NOT NULL""",
    "duration_differences": f"""WITH {_TYPED}
        SELECT flight_id, start_time_utc, end_time_utc, CAST(given AS DOUBLE) AS given_minutes,
               CAST(gap AS DOUBLE) AS derived_minutes
        FROM typed WHERE ok AND given IS NOT NULL AND abs(given - gap) > 1""",
    "flight_years": f"WITH {_NORM} SELECT DISTINCT year(start_time_utc) AS year FROM counted",
    "header_canonical": r"""
        WITH texts AS (
          SELECT 'c' AS kind, c_custkey AS id, '  ' || c_name || ' (' || c_mktsegment || ')' || chr(9) AS text FROM customer
          UNION ALL
          SELECT 'o', o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Flight No' WHEN 1 THEN ' DURATION (min) '
            WHEN 2 THEN 'Номер полета' WHEN 3 THEN 'Region-Code' WHEN 4 THEN 'Широта'
            ELSE 'Column ' || o_orderpriority END FROM orders
          UNION ALL SELECT 'd', doc_id, text FROM documents
        )
        SELECT kind, id,
               regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g') AS header,
               CASE WHEN kind = 'o' THEN CASE id % 6 WHEN 0 THEN 'flight_id' WHEN 1 THEN 'duration_minutes'
                 WHEN 2 THEN 'flight_id' WHEN 3 THEN 'region_code' WHEN 4 THEN 'latitude' END END AS target
        FROM texts""",
    "service_rows_dropped": """
        WITH ranked AS (
          SELECT CAST(o_custkey AS VARCHAR) AS source, o_orderkey AS row_no, o_orderkey % 4 <> 3 AS service,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
          FROM orders
        ), led AS (
          SELECT *, bool_and(service) OVER (PARTITION BY source ORDER BY rn) AS lead_in FROM ranked
        )
        SELECT source, row_no FROM led WHERE NOT (lead_in AND rn <= 10)""",
    "text_table_salvage": f"""WITH {_DAMAGED}
        SELECT source, trim(c[1]) AS flight_id, trim(c[2]) AS start_time, trim(c[3]) AS end_time,
               trim(c[4]) AS duration_minutes, true AS degraded
        FROM kept""",
    "html_first_table": """
        SELECT 'F-' || o_orderkey AS flight_id, o_orderdate - to_hours(3) AS start_time_utc,
               o_orderdate - to_hours(3) AS end_time_utc, o_orderstatus || ' & ' || o_orderpriority AS region_code
        FROM orders
        UNION ALL SELECT 'G-' || o_orderkey, NULL, NULL, NULL FROM orders""",
    "html_links": """
        SELECT CAST(o_orderkey AS VARCHAR) AS source, 'Start Time' AS column_name, '/o/' || o_orderkey AS href
        FROM orders""",
    "page_meta": """
        SELECT page_id AS key, CASE WHEN page_id % 2 = 0 THEN 'Zone/' || page_id END AS content FROM pages""",
    "classify_sources": """
        SELECT 's3://bucket.x/reports/' || o_orderstatus || '/' || o_orderkey ||
                 ['.csv', '.XLSX', '.htm', '.pdf', '.xls', '.txt', '', '.Html'][o_orderkey % 8 + 1] AS path,
               ['csv', 'xlsx', 'html', 'pdf', 'xlsx', NULL, NULL, 'html'][o_orderkey % 8 + 1] AS format
        FROM orders""",
    "flights_raw_payload": f"""WITH {_NORM}, parts AS (
          SELECT *, strftime(start_time_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS st,
                 strftime(end_time_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS et FROM counted)
        SELECT flight_id AS flight_external_id, CAST(start_time_utc AS DATE) AS event_date,
               '{{"flight_id":"' || flight_id || '","surrogate_id":' || coalesce('"' || surrogate_id || '"', 'null') ||
               ',"start_time_utc":"' || st || '","end_time_utc":"' || et || '","duration_minutes":' || duration_minutes ||
               ',"region_code":' || coalesce('"' || region_code || '"', 'null') || ',"region_name":"' || region_name ||
               '","latitude":' || latitude || ',"longitude":' || longitude || ',"vehicle_category":"' || vehicle_category ||
               '","operator_type":"' || operator_type || '","flight_purpose":"' || flight_purpose ||
               '","payload_type":"' || payload_type || '","superseded":false}}' AS payload,
               year(start_time_utc) AS year, month(start_time_utc) AS month
        FROM parts""",
    "flights_norm": f"""WITH {_NORM}
        SELECT flight_id AS flight_uid, start_time_utc AS departure_time, end_time_utc AS arrival_time,
               round(duration_minutes, 2) AS duration_minutes, year(start_time_utc) AS year, month(start_time_utc) AS month
        FROM counted""",
    "check_schema": f"""WITH {_NORM}
        SELECT 'schema' AS check_name, CASE WHEN n > 0 THEN 'FAIL' ELSE 'OK' END AS status,
               CASE WHEN n > 0 THEN 'required columns hold nulls'
                    ELSE 'the columns are those of the record' END AS summary,
               n AS violation_count, CASE WHEN n > 0 THEN '{{"null_counts":{{"region_code":' || n || '}}}}' END AS details
        FROM (SELECT count(*) FILTER (region_code IS NULL) AS n FROM counted)""",
    "check_duration_range": f"""WITH {_NORM}
        SELECT 'duration_range' AS check_name, flight_id, start_time_utc, duration_minutes
        FROM counted WHERE {_DURATION_BAD}""",
    "check_coordinate_range": f"""WITH {_TYPED}
        SELECT 'coordinate_range' AS check_name, flight_id, start_time_utc, latitude, longitude
        FROM typed WHERE latitude < -90 OR latitude > 90 OR longitude < -180 OR longitude > 180""",
    "check_uniqueness": f"""WITH {_LINES}, n AS (
          SELECT *, count(*) OVER (PARTITION BY flight_id, start_time_utc, region_code) AS copies FROM lines)
        SELECT 'uniqueness' AS check_name, flight_id, start_time_utc, region_code, duration_minutes
        FROM n WHERE copies > 1""",
    "check_monthly": f"""WITH {_NORM}, seen AS (
          SELECT DISTINCT year(start_time_utc) AS y, month(start_time_utc) AS m FROM counted
        ), per_year AS (
          SELECT y, string_agg(m, ',' ORDER BY m) AS ms, max(m) - min(m) + 1 - count(*) AS gaps FROM seen GROUP BY y)
        SELECT 'monthly_completeness' AS check_name, CASE WHEN sum(gaps) > 0 THEN 'WARN' ELSE 'OK' END AS status,
               CASE WHEN sum(gaps) > 0 THEN 'months without flights lie between others'
                    ELSE 'no year has a gap between its months' END AS summary,
               CAST(sum(gaps) AS BIGINT) AS violation_count,
               '{{"observed":{{' || string_agg('"' || y || '":[' || ms || ']', ',' ORDER BY y) || '}}}}' AS details
        FROM per_year""",
    "check_outliers": f"""WITH {_NORM}, q AS (
          SELECT quantile_cont(duration_minutes, 0.25) AS q1, quantile_cont(duration_minutes, 0.75) AS q3 FROM counted)
        SELECT 'duration_outliers' AS check_name, flight_id, start_time_utc, duration_minutes
        FROM counted, q WHERE duration_minutes < q1 - 0.25 * (q3 - q1) OR duration_minutes > q3 + 0.25 * (q3 - q1)""",
    "quality_report": f"""WITH {_LINES}, keyed AS (
          SELECT *, count(*) OVER (PARTITION BY flight_id, start_time_utc, region_code) AS copies FROM lines
        ), all_dups AS (
          SELECT * FROM keyed WHERE copies > 1
        ), q AS (
          SELECT quantile_cont(duration_minutes, 0.25) AS q1, quantile_cont(duration_minutes, 0.75) AS q3 FROM lines
        ), seen AS (
          SELECT DISTINCT year(start_time_utc) AS y, month(start_time_utc) AS m FROM lines
        ), n AS (
          SELECT (SELECT count(*) FROM keyed WHERE copies > 1) AS dups,
                 (SELECT count(*) FROM lines WHERE {_DURATION_BAD}) AS durations,
                 (SELECT count(*) FROM lines, q WHERE duration_minutes < q1 - 1.5 * (q3 - q1)
                                                  OR duration_minutes > q3 + 1.5 * (q3 - q1)) AS outliers,
                 (SELECT CAST(sum(g) AS BIGINT) FROM
                    (SELECT max(m) - min(m) + 1 - count(*) AS g FROM seen GROUP BY y)) AS gaps)
        SELECT *, '' AS impacted_regions, CAST(0 AS BIGINT) AS impacted_records FROM (
          SELECT 'schema' AS check_name, 'OK' AS status, 'the columns are those of the record' AS summary,
                 CAST(0 AS BIGINT) AS violation_count
          UNION ALL {_outcome('duration_range', 'every duration is in range',
                              "n || ' durations are out of range'")} FROM (SELECT durations AS n FROM n)
          UNION ALL SELECT 'coordinate_range', 'OK', 'every coordinate is on the globe', 0
          UNION ALL {_outcome('monthly_completeness', 'no year has a gap between its months',
                              "'months without flights lie between others'", 'WARN')} FROM (SELECT gaps AS n FROM n)
          UNION ALL {_outcome('duration_outliers', 'every duration is inside the fence',
                              "n || ' durations are outside the fence'", 'WARN')}
                    FROM (SELECT outliers AS n FROM n))
        UNION ALL
        SELECT *, coalesce((SELECT string_agg(DISTINCT region_code, ',' ORDER BY region_code) FROM all_dups), ''),
               (SELECT count(DISTINCT flight_id) FROM all_dups)
        FROM ({_outcome('uniqueness', 'no two rows share a key',
                        "n || ' rows share their key'")} FROM (SELECT dups AS n FROM n))""",
    "quality_status": f"""WITH {_ISSUES}, n AS (
          SELECT count(DISTINCT check_name) FILTER (severity = 'WARN') AS warn_count,
                 count(DISTINCT check_name) FILTER (severity = 'FAIL') AS fail_count FROM issues)
        SELECT CASE WHEN fail_count > 0 THEN 'FAIL' WHEN warn_count > 0 THEN 'WARN' ELSE 'OK' END AS status,
               CASE WHEN fail_count > 0 THEN 'quality_fail' WHEN warn_count > 0 THEN 'quality_warn'
                    ELSE 'validated' END AS quality_status,
               warn_count, fail_count, warn_count + fail_count AS total
        FROM n""",
    "flight_issues": f"WITH {_ISSUES} SELECT flight_uid, check_name, severity FROM issues",
    "storage_key_audit": f"""WITH {_LINES}
        SELECT flight_id, count(*) AS rows, min(start_time_utc) AS first_start, max(start_time_utc) AS last_start
        FROM lines GROUP BY flight_id HAVING count(*) > 1""",
    "check_mixed_types": f"""WITH {_TYPED}, n AS (
          SELECT count(*) FILTER (k % 5 >= 2) AS durations, count(*) AS rows,
                 count(*) FILTER (k % 4 <> 0) AS payloads, count(*) FILTER (k % 17 <> 0) AS ids FROM typed)
        SELECT unnest(['duration_minutes', 'latitude', 'payload_type', 'flight_id']) AS column_name,
               unnest([durations, rows, payloads, ids]) AS filled, unnest([0, 0, payloads, ids]) AS not_numeric,
               'OK' AS status
        FROM n""",
    "source_review": f"""WITH {_DAMAGED}
        SELECT source AS path, count(*) AS rows, CAST(4 AS BIGINT) AS width, true AS degraded, 'FAIL' AS status
        FROM kept GROUP BY source""",
    "check_region_geometry": "SELECT 'R' || n_nationkey AS code, '' AS problems, 'OK' AS status FROM nation",
    "anomalies": f"""WITH {_TYPED}, n AS (
          SELECT count(*) AS rows, count(*) FILTER (duration_minutes = 0) AS zero,
                 count(*) FILTER (duration_minutes < 0 OR end_time_utc < start_time_utc) AS negative,
                 count(*) FILTER (latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180) AS coords,
                 count(*) FILTER (year(start_time_utc) <> 1996) AS years FROM typed)
        SELECT rows, unnest(['zero_duration', 'negative_duration', 'coordinates_out_of_range', 'outside_batch_year']) AS anomaly,
               unnest([zero, negative, coords, years]) AS n FROM n""",
    "flights_with_issues": f"""WITH {_ISSUES}
        SELECT region_code, count(*) AS flights FROM counted
        WHERE flight_id IN (SELECT flight_uid FROM issues) GROUP BY region_code""",
    "flights_without_issues": f"""WITH {_ISSUES}
        SELECT region_code, count(*) AS flights FROM counted
        WHERE flight_id NOT IN (SELECT flight_uid FROM issues) GROUP BY region_code""",
    "region_directory": f"""WITH {_REGIONS}
        SELECT code, name, w AS min_x, s AS min_y, w + 72 AS max_x, s + 36 AS max_y, cx AS centroid_x, cy AS centroid_y,
               CAST(CASE k WHEN 6 THEN 6 WHEN 12 THEN 8 WHEN 18 THEN 8 ELSE 4 END AS BIGINT) AS edge_count
        FROM shapes""",
    "geo_assign": f"WITH {_ASSIGNED} SELECT flight_id, start_time_utc, region_code, geo_region FROM assigned",
    "geo_tiebreak": f"""WITH {_ASSIGNED}
        SELECT flight_id, longitude, latitude, geo_region, geo_matches FROM assigned WHERE geo_matches > 1""",
    "flights_geo": f"""WITH {_ASSIGNED}
        SELECT 'v1' AS dataset_version, flight_id AS flight_uid, geo_region AS region_code, longitude AS location_x,
               latitude AS location_y, start_time_utc AS observed_at, year(start_time_utc) AS year
        FROM assigned WHERE NOT (longitude = 0 AND latitude = 0)""",
    "geocoded_ratio": f"""WITH {_ASSIGNED}, n AS (SELECT count(*) AS flights, count(geo_region) AS geocoded FROM assigned)
        SELECT *, round(CAST(geocoded AS DOUBLE) / flights, 6) AS geocoded_ratio,
               CAST(geocoded AS DOUBLE) / flights < 0.99 AS alert FROM n""",
    "location_audit": f"""WITH {_ASSIGNED}
        SELECT geo_region AS region_code, count(*) AS stored, count(*) AS intersected
        FROM assigned WHERE geo_region IS NOT NULL GROUP BY geo_region""",
    "region_lookup": f"""WITH {_NORM}
        SELECT region_code, n_name AS directory_name, count(*) AS flights
        FROM norm LEFT JOIN nation ON region_code = 'R' || n_nationkey GROUP BY region_code, n_name""",
    "aggregates_month": f"""WITH {_NORM}
        SELECT region_code, year, month, vehicle_category, {_MEASURES}
        FROM metric GROUP BY region_code, year, month, vehicle_category""",
    "median_duration": f"""WITH {_NORM}
        SELECT region_code, year, round(quantile_cont(duration_minutes, 0.5), 4) AS duration_median_min
        FROM metric GROUP BY region_code, year""",
    "breakdowns": f"""WITH {_NORM}, stacked AS (
          SELECT *, unnest(['operator_type', 'payload_type', 'flight_purpose']) AS dimension,
                 unnest([operator_type, payload_type, flight_purpose]) AS value FROM metric)
        SELECT dimension, value, year, {_MEASURES} FROM stacked WHERE value <> '' GROUP BY dimension, value, year""",
    "reporting_hours": f"WITH {_YEARS} SELECT region_code, year, round(duration_sum_min / 60, 4) AS duration_sum_h FROM years",
    "mom_dynamics": f"""WITH {_MONTHS}
        SELECT a.*, {_pct('a.flights_count', 'b.flights_count')} AS flights_count_mom_pct,
               {_pct('a.duration_sum_min', 'b.duration_sum_min')} AS duration_sum_min_mom_pct
        FROM months a LEFT JOIN months b ON a.region_code IS NOT DISTINCT FROM b.region_code
         AND a.year = b.year AND a.month = b.month + 1""",
    "yoy_dynamics": f"""WITH {_YEARS}
        SELECT a.*, {_pct('a.flights_count', 'b.flights_count')} AS flights_count_yoy_pct,
               {_pct('a.duration_sum_min', 'b.duration_sum_min')} AS duration_sum_min_yoy_pct,
               {_pct('a.duration_avg_min', 'b.duration_avg_min')} AS duration_avg_min_yoy_pct
        FROM years a LEFT JOIN years b ON a.region_code IS NOT DISTINCT FROM b.region_code AND a.year = b.year + 1""",
    "trailing_trend": f"""WITH {_MONTHS}
        SELECT region_code, year, month, flights_count,
               round(avg(flights_count) OVER (PARTITION BY region_code ORDER BY year, month
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS flights_trailing_avg,
               CAST(sum(flights_count) OVER (PARTITION BY region_code, year ORDER BY month
                     ROWS UNBOUNDED PRECEDING) AS BIGINT) AS flights_running
        FROM months""",
    "top_regions": f"""WITH {_YEARS}, ranked AS (
          SELECT region_code, year, flights_count, duration_sum_min,
                 row_number() OVER (PARTITION BY year ORDER BY flights_count DESC, duration_sum_min DESC,
                                    region_code NULLS FIRST) AS by_flights,
                 row_number() OVER (PARTITION BY year ORDER BY duration_sum_min DESC, flights_count DESC,
                                    region_code NULLS FIRST) AS by_minutes FROM years)
        SELECT region_code, year, flights_count, duration_sum_min, by_flights AS rank, 'flights_count' AS measure
        FROM ranked WHERE by_flights <= 5
        UNION ALL SELECT region_code, year, flights_count, duration_sum_min, by_minutes, 'duration_sum_min'
        FROM ranked WHERE by_minutes <= 5""",
    "top_share": f"""WITH {_YEARS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY year ORDER BY flights_count DESC, duration_sum_min DESC,
                                       region_code NULLS FIRST) AS rn FROM years)
        SELECT year, CAST(sum(flights_count) FILTER (rn <= 5) AS BIGINT) AS top_flights,
               CAST(sum(flights_count) AS BIGINT) AS all_flights,
               round(CAST(sum(flights_count) FILTER (rn <= 5) AS DOUBLE) / sum(flights_count), 6) AS top_share
        FROM ranked GROUP BY year""",
    "peak_month": f"""WITH {_MONTHS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY region_code, year ORDER BY flights_count DESC, month) AS rn FROM months)
        SELECT region_code, year, month AS peak_month, flights_count AS peak_month_flights FROM ranked WHERE rn = 1""",
    "seasonality": f"""WITH {_MONTHS}, m AS (
          SELECT year, month, CAST(sum(flights_count) AS BIGINT) AS flights_count FROM months GROUP BY year, month)
        SELECT year, month, flights_count,
               round(CAST(flights_count AS DOUBLE) / sum(flights_count) OVER (PARTITION BY year), 6) AS share,
               round(CAST(flights_count AS DOUBLE) / sum(flights_count) OVER (PARTITION BY year) * 12, 6) AS index
        FROM m""",
    "reconcile_aggregates": f"""WITH {_YEARS}, n AS (
          SELECT region_code, year(start_time_utc) AS year, count(*) AS c FROM counted GROUP BY ALL)
        SELECT y.region_code, y.year, flights_count, coalesce(c, 0) AS normalized_flights
        FROM years y LEFT JOIN n ON n.region_code = y.region_code AND n.year = y.year""",
    "stats_page": f"""WITH {_YEARS}
        SELECT * FROM years WHERE region_code IS NOT NULL OR year > 1995
        ORDER BY region_code NULLS FIRST, year LIMIT 20""",
    "region_facts": f"""WITH {_MONTHS}, years AS (
          SELECT region_code, year, {_MEASURES} FROM metric GROUP BY region_code, year
        ), peaks AS (
          SELECT *, row_number() OVER (PARTITION BY region_code, year ORDER BY flights_count DESC, month) AS rn FROM months)
        SELECT a.region_code, a.year, a.flights_count, CAST((CAST(round(a.duration_sum_min * 100) AS BIGINT) + 30) // 60 AS DOUBLE) / 100 AS duration_total_h,
               a.duration_avg_min, {_pct('a.flights_count', 'b.flights_count')} AS flights_count_yoy_pct,
               {_pct('a.duration_avg_min', 'b.duration_avg_min')} AS duration_avg_min_yoy_pct,
               p.month AS peak_month, p.flights_count AS peak_month_flights
        FROM years a LEFT JOIN years b ON a.region_code IS NOT DISTINCT FROM b.region_code AND a.year = b.year + 1
        JOIN peaks p ON p.rn = 1 AND p.region_code IS NOT DISTINCT FROM a.region_code AND p.year = a.year""",
    "drilldown": f"""WITH {_YEARS}, top AS (
          SELECT *, row_number() OVER (PARTITION BY year ORDER BY flights_count DESC, duration_sum_min DESC,
                                       region_code NULLS FIRST) AS rn FROM years)
        SELECT m.flight_id, m.region_code, m.start_time_utc, m.duration_minutes
        FROM metric m JOIN top ON rn = 1 AND top.year = m.year AND top.region_code IS NOT DISTINCT FROM m.region_code""",
    "version_diff": "WITH " + _two_versions("""
        SELECT coalesce(o.flight_id, n.flight_id) AS flight_id,
               strftime(coalesce(o.start_time_utc, n.start_time_utc), '%Y-%m-%d %H:%M:%S') AS start_second,
               coalesce(o.region_code, n.region_code, '') AS region,
               CASE WHEN o.flight_id IS NULL THEN 'added' WHEN n.flight_id IS NULL THEN 'removed'
                    WHEN o.end_time_utc = n.end_time_utc AND o.duration_minutes = n.duration_minutes THEN 'unchanged'
                    ELSE 'changed' END AS change
        FROM old_counted o FULL JOIN new_counted n
          ON o.flight_id = n.flight_id AND o.start_time_utc = n.start_time_utc
         AND o.region_code IS NOT DISTINCT FROM n.region_code"""),
    "row_difference": "WITH " + _two_versions(f""", o AS (SELECT {_CANONICAL} FROM old_norm),
          n AS (SELECT {_CANONICAL} FROM new_norm)
        SELECT 'old' AS side, flight_id, start_time_utc, end_time_utc, superseded FROM (FROM o EXCEPT ALL FROM n)
        UNION ALL
        SELECT 'new', flight_id, start_time_utc, end_time_utc, superseded FROM (FROM n EXCEPT ALL FROM o)"""),
    "aggregate_diff": "WITH " + _two_versions("""
        SELECT coalesce(o.region_code, n.region_code) AS region_code, coalesce(o.year, n.year) AS year,
               o.flights_count AS old_flights_count, o.duration_sum_min AS old_duration_sum_min,
               n.flights_count AS new_flights_count, n.duration_sum_min AS new_duration_sum_min,
               coalesce(n.flights_count, 0) - coalesce(o.flights_count, 0) AS flights_count_delta,
               round(coalesce(n.duration_sum_min, 0) - coalesce(o.duration_sum_min, 0), 2) AS duration_sum_min_delta
        FROM old_years o FULL JOIN new_years n
          ON o.region_code IS NOT DISTINCT FROM n.region_code AND o.year = n.year"""),
    "incremental_flights": f"""WITH {_NORM}
        SELECT flight_id, start_time_utc, end_time_utc, region_code, superseded FROM norm""",
    "incremental_recompute": f"WITH {_YEARS} SELECT * FROM years",
    "stream_daily_counts": """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, 'R' || (user_id % 25) AS region_code,
               count(*) AS flights_count, round(sum(CAST(value AS DECIMAL(18, 2))), 2)::DOUBLE AS duration_sum_min
        FROM events GROUP BY 1, 2""",
}

_MONTH_NAMES = (
    "['January','February','March','April','May','June','July','August','September','October','November','December']"
)


def _trend(column: str, label: str) -> str:
    shown = f"CAST(round(abs({column}), 1) AS DECIMAL(18,1))"
    return f"""CASE WHEN {column} IS NULL THEN '{label}: no previous year'
        WHEN {column} > 0 THEN '{label} up ' || {shown} || '% y/y'
        WHEN {column} < 0 THEN '{label} down ' || {shown} || '% y/y' ELSE '{label} unchanged y/y' END"""


ORACLE["region_insights"] = f"""
    SELECT region_code, year, {_trend('flights_count_yoy_pct', 'Flights')} || ', ' ||
           {_trend('duration_avg_min_yoy_pct', 'average duration')} || '. Peak in ' || {_MONTH_NAMES}[peak_month] ||
           ' (' || peak_month_flights || ' flights).' AS insight,
           '100*(flights_count[year]-flights_count[year-1])/flights_count[year-1]; ' ||
           '100*(duration_avg_min[year]-duration_avg_min[year-1])/duration_avg_min[year-1]; ' ||
           'max_by(month, flights_count)' AS formula,
           'aggregates_year/' || coalesce(region_code, '-') || '/' || year AS source_keys
    FROM ({ORACLE['region_facts']})"""
