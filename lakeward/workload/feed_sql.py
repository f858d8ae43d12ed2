"""The hospital feeds as projections of the given tables.

The text is shared by Spark and by the SQL engine the results are compared with. The few
places where their dialects differ are named tokens: ``PLUS_DAYS(d, n)``, ``MINUTE_ID(ts)``
and ``PLUS_SECONDS(ts, n)``; ``render`` writes them out for one engine.
"""

from __future__ import annotations

import re

_FILE_OF = """
 concat('part_', {k} % 4, CASE WHEN {k} % 2 = 0 THEN '.csv' ELSE '.json' END) AS file_name,
 concat('/landing/part_', {k} % 4) AS file_path,
 CAST(1000 + {k} % 4 AS BIGINT) AS file_size,
 CASE {k} % 4 WHEN 0 THEN TIMESTAMP '2026-01-01 00:00:00' WHEN 1 THEN TIMESTAMP '2026-01-02 00:00:00'
  WHEN 2 THEN TIMESTAMP '2026-01-03 00:00:00' ELSE TIMESTAMP '2026-01-04 00:00:00' END AS file_modification_time,
 CASE WHEN {k} % 2 = 0 THEN 'csv' ELSE 'json' END AS source_format,
 concat('2026010', 1 + ({b} % 5) % 2, '000000') AS batch_id,
 CASE WHEN ({b} % 5) % 2 = 0 THEN TIMESTAMP '2026-01-05 00:00:00'
  ELSE TIMESTAMP '2026-01-06 00:00:00' END AS processed_timestamp
"""

_SERVICE_OF = """CASE WHEN {k} % 61 = 0 THEN '  ' WHEN {k} % 67 = 0 THEN NULL
 WHEN {k} % 3 = 0 THEN concat(' SVC', {s} % 6, ' ') ELSE concat('svc', {s} % 6) END AS service"""

_ROLE_OF = """CASE {k} % 8 WHEN 0 THEN 'Doctor ' WHEN 1 THEN ' NURSE' WHEN 2 THEN 'technician'
 WHEN 3 THEN 'Administrator' WHEN 4 THEN 'porter' WHEN 5 THEN ' ' WHEN 6 THEN NULL ELSE 'nurse' END AS role"""

PATIENTS = f"""
SELECT CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE concat('P', l_orderkey % 20000) END AS patient_id,
 CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE concat('name', l_partkey) END AS name,
 CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST((l_partkey * 7 + l_linenumber) % 120 - 4 AS INT) END AS age,
 CASE WHEN l_suppkey % 47 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS arrival_date,
 CASE WHEN l_suppkey % 43 = 0 THEN NULL
  ELSE PLUS_DAYS(CAST(o_orderdate AS DATE), (l_suppkey * 7 + l_partkey) % 220 - 10) END AS departure_date,
 {_SERVICE_OF.format(k="l_partkey", s="l_suppkey")},
 CAST((l_orderkey * 31 + l_linenumber * 17) % 108 AS INT) AS satisfaction,
 {_FILE_OF.format(k="l_suppkey", b="l_partkey")},
 concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS row_key
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

STAFF = f"""
SELECT CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE concat('S', c_custkey % 400) END AS staff_id,
 CASE WHEN c_custkey % 37 = 0 THEN ' ' ELSE c_name END AS staff_name,
 {_ROLE_OF.format(k="c_custkey")},
 {_SERVICE_OF.format(k="c_custkey", s="c_custkey")},
 {_FILE_OF.format(k="c_custkey", b="c_nationkey")},
 CAST(c_custkey AS STRING) AS row_key
FROM customer
"""

STAFF_SCHEDULE = f"""
SELECT CAST(event_id % 54 AS INT) AS week,
 CASE WHEN event_id % 41 = 0 THEN NULL ELSE concat('S', user_id) END AS staff_id,
 concat('staff', user_id) AS staff_name,
 {_ROLE_OF.format(k="user_id")},
 {_SERVICE_OF.format(k="event_id", s="user_id")},
 CAST(CASE WHEN event_id % 29 = 0 THEN 2 WHEN event_id % 31 = 0 THEN NULL WHEN user_id % 6 = 1 THEN event_id % 2
  WHEN event_id % 10 = 0 THEN 0 ELSE 1 END AS INT) AS present,
 {_FILE_OF.format(k="user_id", b="event_id")},
 CAST(event_id AS STRING) AS row_key
FROM events
"""

SERVICES_WEEKLY = f"""
SELECT CAST(o_orderkey % 55 AS INT) AS week, CAST(o_custkey % 13 AS INT) AS month,
 {_SERVICE_OF.format(k="o_custkey", s="k")},
 CAST(CASE WHEN o_orderkey % 71 = 0 THEN 0 ELSE beds END AS INT) AS available_beds,
 CAST(CASE WHEN o_orderkey % 73 = 0 THEN 0 WHEN o_orderkey % 97 = 0 THEN -2 WHEN o_orderkey % 23 = 0 THEN adm + ref + 1
  WHEN o_orderkey % 59 = 0 THEN adm - 1 ELSE adm + ref END AS INT) AS patients_request,
 CAST(CASE WHEN o_orderkey % 79 = 0 THEN -1 ELSE adm END AS INT) AS patients_admitted,
 CAST(CASE WHEN o_orderkey % 83 = 0 THEN -1 WHEN o_orderkey % 53 = 0 THEN adm + ref + 5 ELSE ref END AS INT)
  AS patients_refused,
 CAST(o_orderkey % 104 AS INT) AS patient_satisfaction,
 CAST(CASE WHEN k = 2 THEN 20 + o_orderkey % 50 WHEN o_orderkey % 101 = 0 THEN 120 ELSE 50 + o_orderkey % 50 END AS INT)
  AS staff_morale,
 CASE o_orderkey % 19 WHEN 0 THEN ' ' WHEN 1 THEN NULL WHEN 2 THEN ' FLU ' ELSE 'none' END AS event,
 {_FILE_OF.format(k="o_custkey", b="o_orderkey")},
 CAST(o_orderkey AS STRING) AS row_key
FROM (SELECT *, CAST(floor(adm * (CASE WHEN k = 3 THEN 70 ELSE 10 END) / 100) AS INT) AS ref FROM
 (SELECT *, CAST(floor(beds * (45 + 9 * k + o_orderkey % 12) / 100) AS INT) AS adm FROM
  (SELECT o_orderkey, o_custkey, CAST((o_custkey + o_orderkey) % 6 AS INT) AS k,
    CAST(20 + o_orderkey % 31 AS INT) AS beds FROM orders) a) b) c
"""

# A control table: each minute of the event stream is a batch, closed by purchases and errors;
# the two batches of the feeds above follow, the first closed and the second running.
CONTROL = """
SELECT batch_id, 'hospital_feeds' AS pipeline_name, event_time, status, source_files, processed_records FROM (
 SELECT MINUTE_ID(ts) AS batch_id, date_trunc('minute', ts) AS event_time, 'RUNNING' AS status, 0 AS source_files,
  CAST(0 AS BIGINT) AS processed_records FROM events
 UNION ALL
 SELECT MINUTE_ID(ts), date_trunc('second', ts), CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'COMPLETED' END,
  CAST(user_id % 9 AS INT), event_id FROM events WHERE event_type IN ('error', 'purchase')
 UNION ALL
 SELECT batch_id, min(processed_timestamp), 'RUNNING', 0, CAST(0 AS BIGINT) FROM bronze_staff GROUP BY batch_id
 UNION ALL
 SELECT batch_id, PLUS_SECONDS(max(processed_timestamp), 3600), 'COMPLETED', CAST(count(DISTINCT file_path) AS INT),
  count(*) FROM bronze_staff WHERE batch_id = '20260101000000' GROUP BY batch_id
) e
"""

# Landed files: every order is a file of its customer's nation.
LANDED_FILES = """
SELECT concat('feed', c_nationkey) AS dataset, concat('file_', o_orderkey, '.csv') AS file_name,
 PLUS_SECONDS(o_orderdate, o_orderkey % 86400) AS modified_time, CAST(floor(o_totalprice) AS BIGINT) AS size
FROM orders JOIN customer ON o_custkey = c_custkey
"""

EXPECTED_FILES = """
SELECT concat('feed', n_nationkey) AS dataset, 1 + n_nationkey % 3 AS expected_count,
 CASE WHEN n_nationkey = 7 THEN 'listing failed' END AS error_message
FROM nation
"""

# Raw text as a careless source might send it: unreadable numbers and dates, and a field that
# the feed does not declare.
RAW_PATIENTS = """
SELECT row_key AS patient_id, name,
 CASE WHEN age % 10 = 3 THEN concat('x', age) ELSE CAST(age AS STRING) END AS age,
 CASE WHEN satisfaction % 9 = 4 THEN 'unknown' ELSE CAST(arrival_date AS STRING) END AS arrival_date,
 CAST(departure_date AS STRING) AS departure_date, service, CAST(satisfaction AS STRING) AS satisfaction,
 CASE WHEN satisfaction % 5 = 0 THEN concat('w', satisfaction) END AS ward,
 source_format, row_key
FROM bronze_patients
"""

RAW_STAFF = """
SELECT row_key AS staff_id, staff_name, role, service,
 CASE WHEN staff_name = ' ' THEN 'unnamed' END AS note, source_format, row_key
FROM bronze_staff
"""

RAW_STAFF_SCHEDULE = """
SELECT CASE WHEN present = 2 THEN concat('w', week) ELSE CAST(week AS STRING) END AS week, row_key AS staff_id,
 staff_name, role, service, CAST(present AS STRING) AS present, source_format, row_key
FROM bronze_staff_schedule
"""

RAW_SERVICES_WEEKLY = """
SELECT CAST(week AS STRING) AS week, CASE WHEN month = 0 THEN 'none' ELSE CAST(month AS STRING) END AS month,
 row_key AS service, CAST(available_beds AS STRING) AS available_beds,
 CASE WHEN patients_request < 0 THEN 'n/a' ELSE CAST(patients_request AS STRING) END AS patients_request,
 CAST(patients_admitted AS STRING) AS patients_admitted, CAST(patients_refused AS STRING) AS patients_refused,
 CAST(patient_satisfaction AS STRING) AS patient_satisfaction, CAST(staff_morale AS STRING) AS staff_morale, event,
 source_format, row_key
FROM bronze_services_weekly
"""

_DIALECTS = {
    "spark": {
        "PLUS_DAYS": r"date_add(\1, CAST(\2 AS INT))",
        "MINUTE_ID": r"date_format(date_trunc('minute', \1), 'yyyyMMddHHmmss')",
        "PLUS_SECONDS": r"timestampadd(SECOND, \2, CAST(\1 AS TIMESTAMP))",
    },
    "duckdb": {
        "PLUS_DAYS": r"CAST(\1 + CAST(\2 AS INT) AS DATE)",
        "MINUTE_ID": r"strftime(date_trunc('minute', \1), '%Y%m%d%H%M%S')",
        "PLUS_SECONDS": r"(\1 + to_seconds(\2))",
    },
}


def render(text: str, engine: str) -> str:
    """Replace the dialect tokens of a feed text. A first argument may hold one pair of brackets."""
    for token, replacement in _DIALECTS[engine].items():
        arguments = r"\(((?:[^(),]|\([^()]*\))+)" + ("" if token == "MINUTE_ID" else r", ((?:[^()]|\([^()]*\))+)") + r"\)"
        text = re.sub(token + arguments, replacement, text)
    return text
