"""Final SELECTs of the oracle statements (see ``orelake.oracle``)."""

from __future__ import annotations

from orelake.oracle import RUN_TS, q

_RKEY = "coalesce(replace(replace(replace(replace(upper(trim({x})), '-', ''), '_', ''), '''', ''), ' ', ''), '')"

ORACLE: dict[str, str] = {
    "dim_date": q("SELECT date_key, date_value, year, month, day, day_of_week, week_of_year FROM dim_date"),
    "dim_city": q("SELECT city_key, city_name, region_name, city_normalized, created_at FROM dim_city"),
    "dim_course": q("SELECT course_key, course_id, course_name, created_at FROM dim_course"),
    "dim_student": q(f"""
SELECT md5(entity_id) AS student_key, entity_id AS student_id, account_id, full_name,
       CAST(NULL AS VARCHAR) AS email, phone_number, md5(place) AS city_key, place_city AS city_name, place_region AS region_name,
       education_level, account_status, is_contacted, is_paid_student, enrolled_courses_count,
       created_at, updated_at, {RUN_TS} AS processed_at, bronze_batch_id AS source_batch_id,
       _partition_key AS last_partition_key, coalesce(lower(account_status), '') = 'active' AS is_active,
       {RUN_TS} AS load_ts
FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY _partition_key DESC, updated_at DESC NULLS LAST,
                                   bronze_batch_id DESC) AS rn2 FROM clean) WHERE rn2 = 1
"""),
    "fact_student_daily": q("SELECT date_key, city_key, student_total_count, student_paid_count, paid_rate, load_ts "
                            "FROM fact_student_daily"),
    "mv_paid_students_daily": q("SELECT date_key, city_key, student_total_count, student_paid_count, paid_rate, "
                                f"{RUN_TS} AS refreshed_at FROM fact_student_daily"),
    "fact_course_enrollment_event": q("SELECT event_id, date_key, event_time, student_key, student_id, city_key, "
                                      "course_key, course_id, access_type, end_at, load_ts, is_active FROM enrol"),
    "mv_course_enrollment_region_daily": q("SELECT * FROM mv_course"),
    "kpi_region_daily_paid": q("SELECT * FROM region_daily ORDER BY date_value, region_name"),
    "kpi_daily_paid": q("SELECT * FROM daily ORDER BY date_value"),
    "kpi_unpaid_region_daily": q("""
SELECT date_value, region_name, total_students, paid_students, total_students - paid_students AS unpaid_students,
       paid_rate_pct, (total_students - paid_students) * 1e2 / total_students AS unpaid_rate_pct
FROM region_daily"""),
    "kpi_latest_tiles": q("""
SELECT * EXCLUDE (h), CAST(h // 100 AS VARCHAR) || '.' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') || '%' AS paid_rate_text
FROM (SELECT *, CASE WHEN total_students = 0 THEN 0
                     ELSE (CAST(paid_students AS HUGEINT) * 20000 + total_students) // (2 * total_students) END AS h
      FROM daily WHERE date_value = (SELECT max(date_value) FROM daily))"""),
    "kpi_region_rank_latest": q("SELECT * FROM region_daily WHERE date_value = (SELECT max(date_value) FROM region_daily) "
                                "ORDER BY paid_rate_pct DESC, region_name"),
    "kpi_region_table": q("SELECT * FROM region_daily ORDER BY date_value DESC, paid_rate_pct DESC, region_name"),
    "kpi_course_enrollment": q("""
SELECT d.date_value, m.region_name, m.course_name, m.enrolled_students_count
FROM mv_course m JOIN dim_date d ON d.date_key = m.date_key
ORDER BY d.date_value, m.enrolled_students_count DESC"""),
    "kpi_course_reach_quarter": q("""
SELECT CAST(d.year AS INTEGER) AS year, CAST(ceil(d.month / 3.0) AS INTEGER) AS quarter,
       coalesce(c.region_name, 'UNKNOWN') AS region_name, e.course_key, CAST(count(DISTINCT e.student_id) AS BIGINT) AS students_count
FROM enrol e JOIN dim_date d ON d.date_key = e.date_key LEFT JOIN dim_city c ON c.city_key = e.city_key
GROUP BY 1, 2, 3, 4"""),
    "kpi_course_reach_year": q("""
SELECT CAST(d.year AS INTEGER) AS year, e.course_key, coalesce(c.course_name, 'UNKNOWN') AS course_name,
       CAST(count(DISTINCT e.student_id) AS BIGINT) AS students_count
FROM enrol e JOIN dim_date d ON d.date_key = e.date_key LEFT JOIN dim_course c ON c.course_key = e.course_key
GROUP BY 1, 2, 3"""),
    "kpi_top_courses_latest": q("""
SELECT d.date_value, m.region_name, m.course_key, m.course_name, m.enrolled_students_count
FROM mv_course m JOIN dim_date d ON d.date_key = m.date_key
WHERE d.date_value = (SELECT max(d2.date_value) FROM mv_course m2 JOIN dim_date d2 ON d2.date_key = m2.date_key)
ORDER BY m.enrolled_students_count DESC, m.course_name, m.region_name, m.course_key
LIMIT 12"""),
    "kpi_access_mix": q("""
SELECT coalesce(access_type, 'UNKNOWN') AS access_type, CAST(count(*) AS BIGINT) AS events_count,
       CAST(count(DISTINCT student_id) AS BIGINT) AS students_count
FROM enrol GROUP BY coalesce(access_type, 'UNKNOWN') ORDER BY events_count DESC"""),
    "kpi_region_map": q(f"""
, feats AS (
  SELECT {_RKEY.format(x="shape_name")} AS region_key, min(shape_name) AS shape_name
  FROM (SELECT upper(left(n, 1)) || substr(n, 2) AS shape_name
        FROM (SELECT replace(lower(r_name), ' ', '-') AS n FROM region))
  GROUP BY 1
), latest AS (
  SELECT *, {_RKEY.format(x="region_name")} AS region_key
  FROM region_daily WHERE date_value = (SELECT max(date_value) FROM region_daily)
)
SELECT l.date_value, l.region_name, l.region_key, f.shape_name, l.total_students, l.paid_students, l.paid_rate_pct,
       f.shape_name IS NOT NULL AS has_boundary
FROM latest l LEFT JOIN feats f ON f.region_key = l.region_key"""),
    "gold_run_metrics": q("""
, f AS (SELECT date_key, CAST(sum(student_total_count) AS BIGINT) AS student_total_count,
               CAST(sum(student_paid_count) AS BIGINT) AS student_paid_count,
               round(avg(paid_rate), 9) AS avg_paid_rate
        FROM fact_student_daily GROUP BY date_key),
  e AS (SELECT date_key, CAST(count(*) AS BIGINT) AS n FROM enrol GROUP BY date_key)
SELECT coalesce(f.date_key, e.date_key) AS date_key, coalesce(f.student_total_count, 0) AS student_total_count,
       coalesce(f.student_paid_count, 0) AS student_paid_count, coalesce(f.avg_paid_rate, 0.0) AS avg_paid_rate,
       coalesce(e.n, 0) AS student_course_enrollments
FROM f FULL JOIN e ON f.date_key = e.date_key"""),
}

_ISO3 = "strftime({x}, '%Y-%m-%dT%H:%M:%S.%gZ')"
_ISO0 = "strftime({x}, '%Y-%m-%dT%H:%M:%SZ')"
_ISO6 = "strftime({x}, '%Y-%m-%dT%H:%M:%S.%fZ')"
_UPD_TS = ("CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN date_trunc('second', upd_raw) "
           "ELSE upd_raw END")
_ENTITY = ("CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN '  ' "
           "ELSE CAST(o_custkey AS VARCHAR) END")
_CURSOR_DOCS = f"""
, cursor_docs AS (
  SELECT o_orderkey AS doc_seq, {_ENTITY} AS entity_id, {_UPD_TS} AS updated_ts FROM doc
), inc_batch AS (
  SELECT * FROM cursor_docs WHERE updated_ts > TIMESTAMP '1998-01-01 00:00:00'
  ORDER BY updated_ts, doc_seq LIMIT 1000
)
"""
_USERS = """
, users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS oid,
         CASE WHEN c_custkey % 3 = 0 THEN 'acct-' || c_custkey END AS uid,
         CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 5 = 0 THEN NULL
              ELSE replace(lower(c_name), '#', '.') || '@example.com' END AS email,
         CASE WHEN c_custkey % 5 = 0 THEN 'alt.' || c_custkey || '@example.org' END AS mail
  FROM customer
), ue AS (
  SELECT oid, uid, trim(CASE WHEN email IS NULL OR email = '' THEN mail ELSE email END) AS e FROM users
), emap AS (
  SELECT k, min(e) AS email
  FROM (SELECT uid AS k, e FROM ue UNION ALL SELECT oid AS k, e FROM ue)
  WHERE k IS NOT NULL AND k <> '' AND e IS NOT NULL AND e <> ''
  GROUP BY k
)
"""

ORACLE.update({
    "silver_students_clean": q(f"""
SELECT entity_id, account_id, full_name, phone_number, city, education_level, account_status, technique,
       is_contacted, enrolled_courses_count, is_paid_student, created_at, updated_at, bronze_batch_id,
       'silver-0001' AS silver_batch_id, {RUN_TS} AS processed_at, 'UPSERT' AS _operation, 'watermark' AS _source,
       'students' AS _table_name, _partition_key, CAST(NULL AS VARCHAR) AS _checksum
FROM clean"""),
    "silver_students_quarantine": q(f"""
SELECT entity_id, bronze_batch_id, quarantine_reason, 'students' AS source_table,
       'bronze/students/' || _partition_key AS bronze_file_path, {RUN_TS} AS quarantined_at, _partition_key
FROM quarantine"""),
    "silver_courses": q("SELECT course_id, course_name, created_at, updated_at, ingest_ds FROM silver_courses"),
    "silver_metrics": q("""
SELECT ds, CAST(sum(sc) AS BIGINT) AS students_clean_count, CAST(sum(sq) AS BIGINT) AS students_quarantine_count,
       CAST(sum(cc) AS BIGINT) AS courses_clean_count, CAST(sum(sc) + sum(cc) AS BIGINT) AS total_clean_count,
       CAST(sum(sq) AS BIGINT) AS total_quarantine_count
FROM (SELECT _partition_key AS ds, 1 AS sc, 0 AS sq, 0 AS cc FROM clean
      UNION ALL SELECT _partition_key, 0, 1, 0 FROM quarantine
      UNION ALL SELECT ingest_ds, 0, 0, 1 FROM silver_courses)
GROUP BY ds"""),
    "bronze_incremental": q(_CURSOR_DOCS + "SELECT * FROM inc_batch"),
    "bronze_bootstrap": q(_CURSOR_DOCS + "SELECT * FROM cursor_docs ORDER BY updated_ts NULLS FIRST, doc_seq LIMIT 1000"),
    "bronze_next_watermark": q(_CURSOR_DOCS + """
SELECT coalesce(max(updated_ts), TIMESTAMP '1998-01-01 00:00:00') AS watermark,
       (SELECT doc_seq FROM inc_batch WHERE updated_ts IS NOT NULL ORDER BY updated_ts DESC, doc_seq DESC LIMIT 1)
         AS watermark_tie,
       CAST(count(*) AS BIGINT) AS batch_rows
FROM inc_batch WHERE updated_ts IS NOT NULL"""),
    "bronze_cursor_drain": q(f"""
SELECT md5(lpad(lower(hex(p_partkey)), 24, '0') || '|' || '2024-02-01 00:00:00') AS event_id,
       {RUN_TS} AS event_time, lpad(lower(hex(p_partkey)), 24, '0') AS course_id, p_name AS course_name,
       'upsert' AS event_type, '2023-12-31 00:00:00' AS created_at, '' AS updated_at
FROM part WHERE lpad(lower(hex(p_partkey)), 24, '0') > lpad(lower(hex(100)), 24, '0')"""),
    "bronze_email_lookup": q(_USERS + """
SELECT s.o_orderkey AS doc_seq, s.account_id AS userId, m.email
FROM std0 s LEFT JOIN emap m ON m.k = trim(s.account_id)"""),
    "bronze_stamped": q(f"""
SELECT o_orderkey AS doc_seq,
       {_ENTITY} AS _id,
       CASE WHEN o_custkey % 19 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN 'acct-' || o_custkey
            ELSE CAST(o_custkey AS VARCHAR) END AS userId,
       CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN ' INACTIVE ' END AS status,
       CASE WHEN o_custkey % 7 = 0 THEN 'n/a'
            ELSE '+216 ' || c_nationkey || '-' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') END AS phone,
       replace(lower(c_name), '#', '''s ') AS name,
       CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 11 = 0 THEN '  ' || lower(n_name)
            WHEN o_custkey % 17 = 0 THEN r_name || ', ' || n_name || ', Old'
            WHEN o_custkey % 23 = 0 THEN '' ELSE r_name || ', ' || n_name END AS city,
       c_mktsegment AS educationLevel,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'true' WHEN '2-HIGH' THEN 'Yes' WHEN '3-MEDIUM' THEN ' y '
            WHEN '4-NOT SPECIFIED' THEN '0' END AS isContacted,
       '[]' AS enrolledChapters, CAST(NULL AS VARCHAR) AS boughtBooks,
       CASE WHEN o_orderkey % 31 = 0 THEN 'bad' ELSE {_ISO3.format(x="o_orderdate - INTERVAL 30 DAY")} END AS createdAt,
       CASE WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN {_ISO0.format(x="date_trunc('second', upd_raw)")}
            ELSE {_ISO3.format(x="upd_raw")} END AS updatedAt,
       0 AS __v, 'UPSERT' AS _operation, 'watermark' AS _source,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE {_ISO6.format(x="o_orderdate + INTERVAL 26 HOUR")} END AS _ingested_at,
       'batch-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS _batch_id, 'students' AS _table_name,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS _partition_key,
       '{{"has_null_pk":' || CASE WHEN o_orderkey % 101 = 0 THEN 'true' ELSE 'false' END
         || ',"has_missing_updated_at":' || CASE WHEN o_orderkey % 29 = 0 THEN 'true' ELSE 'false' END || '}}'
         AS _quality_flags
FROM doc"""),
    "bronze_batch_metadata": q("""
SELECT 'students' AS collection, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS partition,
       CAST(count(*) AS BIGINT) AS record_count, 'PASSED_7_POINT_GATE' AS quality_status,
       'watermark' AS source
FROM doc GROUP BY 2"""),
})

# One file per day or slice: 64 bytes a line, 1,024 for the course bootstrap and every 30th slice.
_SIZED = """
, sized AS (
  SELECT 'courses' AS collection, strftime(ts, '%Y-%m-%d') AS ds, CAST(64 * count(*) AS BIGINT) AS file_size FROM events GROUP BY 2
  UNION ALL SELECT 'courses', '2023-12-31', CAST(1024 * count(*) AS BIGINT) FROM part
  UNION ALL
  SELECT 'students', strftime(date_trunc('month', o_orderdate), '%Y-%m-%d'),
         CAST(count(*) * CASE WHEN ((any_value(year(o_orderdate)) - 1992) * 12 + any_value(month(o_orderdate)) - 1) % 30 = 0 THEN 1024 ELSE 64 END AS BIGINT)
  FROM doc GROUP BY 2)"""
_EVENTS = f"""
, ev_all AS (
  SELECT 'boot-' || p_partkey AS event_id, CAST(p_partkey AS VARCHAR) AS course_id, p_name AS course_name,
         CAST(NULL AS VARCHAR) AS title, CAST(p_partkey AS BIGINT) AS _offset,
         '2023-12-31T00:00:00.000000Z' AS _ingested_at, '2023-12-31' AS ingest_date, '' AS updated_at
  FROM part
  UNION ALL
  SELECT 'ev-' || e.event_id,
         CASE WHEN e.event_type = 'error' THEN ' ' ELSE json_extract_string(e.props, '$.k') END,
         CASE WHEN e.event_type <> 'click' THEN coalesce(p.p_name, 'course') || ' (' || e.event_type || ')' END,
         CASE WHEN e.event_type = 'click' THEN coalesce(p.p_name, 'course') || ' (' || e.event_type || ')' END,
         CAST(e.event_id AS BIGINT), {_ISO6.format(x="e.ts")}, strftime(e.ts, '%Y-%m-%d'),
         {_ISO6.format(x="(CASE WHEN e.event_id % 7 = 0 THEN e.ts - INTERVAL 10 DAY ELSE e.ts END)")}
  FROM events e LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
)
"""

ORACLE.update({
    "stream_course_events": q(_EVENTS + "SELECT event_id, course_id, course_name, title, _offset, _ingested_at, "
                                        "ingest_date FROM ev_all"),
    "stream_dedup": q(_EVENTS + "SELECT course_id, course_name, title, updated_at, _offset FROM ev_all"),
    "stream_upsert_courses": q("SELECT course_key, course_id, course_name, created_at FROM dim_course"),
})

ORACLE.update({
    "dedupe_checksum": q("""
, d AS (SELECT o_orderkey AS doc_seq, 'slice-' || strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS _batch_id,
               CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN ' INACTIVE ' END AS status FROM doc)
SELECT * FROM d UNION ALL SELECT doc_seq, _batch_id, 'Changed' FROM d WHERE doc_seq % 15 = 0"""),
    "missing_partitions": q("""
, present AS (SELECT DISTINCT CAST(ingested_ts AS DATE) AS ds FROM doc WHERE ingested_ts IS NOT NULL)
SELECT CAST(g.ds AS DATE) AS ds
FROM (SELECT unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS ds FROM present) g
WHERE CAST(g.ds AS DATE) NOT IN (SELECT ds FROM present)"""),
    "missing_partitions_listed": q("""
, present AS (SELECT DISTINCT ds FROM (SELECT CAST(ts AS DATE) AS ds FROM events UNION SELECT DATE '2023-12-31')
                 WHERE day(ds) % 5 > 0)
SELECT CAST(g.ds AS DATE) AS ds
FROM (SELECT unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS ds FROM present) g
WHERE CAST(g.ds AS DATE) NOT IN (SELECT ds FROM present)"""),
    "retention_tier": q("""
, parts AS (
  SELECT DISTINCT 'students' AS collection, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ds FROM doc
  UNION
  SELECT DISTINCT 'courses', ingest_date FROM (SELECT '2023-12-31' AS ingest_date UNION ALL
                                              SELECT strftime(ts, '%Y-%m-%d') FROM events)
)
SELECT collection, ds, CAST(DATE '2024-02-01' - CAST(ds AS DATE) AS INTEGER) AS age_days,
       CASE WHEN DATE '2024-02-01' - CAST(ds AS DATE) <= 30 THEN 'hot'
            WHEN DATE '2024-02-01' - CAST(ds AS DATE) <= 90 THEN 'warm'
            WHEN DATE '2024-02-01' - CAST(ds AS DATE) <= 365 THEN 'cold' ELSE 'delete' END AS tier,
       DATE '2024-02-01' - CAST(ds AS DATE) > 40 AS stale_in_hot
FROM parts"""),
    "upsert_dim": ORACLE["dim_student"],
    "replace_partition": ORACLE["fact_student_daily"] + " WHERE date_key <> 19980301",
    "table_roundtrip": ORACLE["bronze_batch_metadata"],
    "jsonl_tolerant_scan": q(_EVENTS + "SELECT event_id, course_id, course_name, title, _offset FROM ev_all"),
    "extended_json_scan": q(f"""
SELECT o_orderkey AS doc_seq, {_ENTITY} AS _id,
       CASE WHEN o_orderkey % 31 = 0 THEN 'bad' ELSE {_ISO3.format(x="o_orderdate - INTERVAL 30 DAY")} END AS createdAt,
       CASE WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN {_ISO0.format(x="date_trunc('second', upd_raw)")}
            ELSE {_ISO3.format(x="upd_raw")} END AS updatedAt
FROM doc"""),
})

ORACLE["bronze_cursor_poll"] = ORACLE["bronze_cursor_drain"] + " ORDER BY course_id LIMIT 50"

ORACLE["silver_title_case"] = q(f"""
SELECT o_orderkey AS doc_seq, full_name,
       CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE city END AS city,
       account_status
FROM std0""")

# CRC-32 in bit arithmetic: the table of one-byte remainders from its rule, then one step per byte.
_CRC_STEP = ("CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END")
_JSON = " || ',' || ".join(f"'\"{name}\":' || coalesce('\"' || {name} || '\"', 'null')" for name in
                           ("_id", "userId", "status", "phone", "city", "createdAt", "updatedAt"))
ORACLE.update({
    "row_checksum": f"""
WITH RECURSIVE steps AS (
  SELECT b, b AS a, 0 AS k FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, {_CRC_STEP}, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(a ORDER BY b) AS t FROM steps WHERE k = 8),
rows AS (SELECT doc_seq, '{{' || {_JSON} || '}}' AS j FROM ({ORACLE["bronze_stamped"]}))
SELECT doc_seq, lpad(lower(to_hex(xor(list_reduce(
         [x::BIGINT FOR x IN list_prepend(4294967295, [ascii(c)::BIGINT FOR c IN regexp_extract_all(j, '(?s).')])],
         lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295))), 8, '0') AS _checksum
FROM rows, crc""",
    "bronze_file_sizes": q("""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS _partition_key, CAST(count(*) AS BIGINT) AS record_count,
       true AS files_match, true AS has_files, true AS has_bytes
FROM doc GROUP BY 1"""),
    "file_counts": q("""
SELECT 'students' AS collection, CAST(count(*) AS BIGINT) AS record_count, true AS files_match, true AS bytes_match FROM doc
UNION ALL SELECT 'courses', CAST((SELECT count(*) FROM part) + (SELECT count(*) FROM events) AS BIGINT), true, true"""),
    "file_size_anomaly": q(_SIZED + """
SELECT collection, ds, file_size, round(avg_file_size, 6) AS avg_file_size,
       file_size > 1073741824 OR file_size > 10 * avg_file_size AS is_anomaly
FROM (SELECT *, avg(file_size) OVER (PARTITION BY collection) AS avg_file_size FROM sized)"""),
    "file_sizes_known": q(_SIZED + """
SELECT collection, CAST(count(*) AS BIGINT) AS file_count, CAST(sum(file_size) AS BIGINT) AS total_size_bytes
FROM sized GROUP BY collection"""),
    "bronze_drain": q(f"""
SELECT o_orderkey AS doc_seq, {_ENTITY} AS _id,
       CASE WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN {_ISO0.format(x="date_trunc('second', upd_raw)")}
            ELSE {_ISO3.format(x="upd_raw")} END AS updatedAt,
       CASE WHEN o_orderkey % 29 = 0 AND o_orderkey % 2 = 1 THEN DATE '2024-03-02' ELSE DATE '2024-03-01' END AS _partition_key
FROM doc"""),
    "course_publish": q("""
SELECT md5(lpad(lower(hex(p_partkey)), 24, '0') || '|' || '2024-02-01 00:00:00') AS event_id,
       lpad(lower(hex(p_partkey)), 24, '0') AS course_id, p_name AS course_name, 'upsert' AS event_type
FROM part"""),
    "stream_upsert_courses_other_cut": ORACLE["stream_upsert_courses"],
    "day_run": q("""
, good AS (SELECT DISTINCT entity_id, place FROM std WHERE NOT missing_pk)
SELECT unnest(['bronze/students', 'bronze/students with checksum', 'sidecar']) AS layer, count(*) AS row_count FROM doc
UNION ALL SELECT 'sidecar equal to the listing', 1
UNION ALL SELECT 'silver/quarantine', count(*) FROM std WHERE missing_pk
UNION ALL SELECT unnest(['silver/students', 'silver/students with checksum', 'gold/dim_student', 'gold metrics']), count(*) FROM good
UNION ALL SELECT 'silver metrics', (SELECT count(*) FROM good) + (SELECT count(*) FROM silver_courses WHERE ingest_ds = '2024-01-05')
UNION ALL SELECT unnest(['silver/courses', 'gold/dim_course']), count(*) FROM silver_courses WHERE ingest_ds = '2024-01-05'
UNION ALL SELECT unnest(['gold/dim_city', 'gold/fact_student_daily', 'gold/mv_paid_students_daily']), count(DISTINCT place) FROM good
UNION ALL SELECT 'gold/dim_date', 1"""),
})
