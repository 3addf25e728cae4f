"""The same results in plain SQL over the same tables, for DuckDB.

Written from the definitions, not from the Spark code: other functions, other
join forms, no shared expressions.
"""

from siltstone.registry.queries import AS_OF

_ISO = "'%Y-%m-%dT%H:%M:%S.000Z'"
_DAY = "'%Y-%m-%dT%H:%M:%S.000'"
_BIG = "1000000000000"

RAW = f"""
raw AS (
  SELECT
    'row-' || o_orderkey AS ":id",
    '1' AS ":version",
    strftime(o_orderdate, {_ISO}) AS ":created_at",
    strftime(o_orderdate + INTERVAL 12 HOUR, {_ISO}) AS ":updated_at",
    CAST(o_orderkey AS VARCHAR) AS incident_report_number,
    CASE WHEN o_custkey % 13 <> 0
      THEN o_orderpriority || '/' || (o_custkey % 4) END AS crime_type,
    o_orderpriority AS category_description,
    o_orderstatus AS ucr_category,
    CAST(o_custkey % 30 AS VARCHAR) AS ucr_code,
    CASE WHEN o_orderkey % 89 = 5 THEN 'n/a'
      ELSE strftime(o_orderdate, {_DAY}) END AS occ_date,
    CASE WHEN o_orderkey % 97 = 0 THEN 'bad'
      ELSE ' ' || strftime(o_orderdate, '%m/%d/%Y') || '  05:07 ' END AS occ_date_time,
    strftime(reported, {_DAY}) AS rep_date,
    CASE WHEN o_orderkey % 7 = 0 THEN '8/1/2026 5:07'
      ELSE strftime(reported, '%m/%d/%Y %H:%M') END AS rep_date_time,
    CASE WHEN o_orderstatus = 'F'
      THEN strftime(reported + to_days(CAST(o_orderkey % 40 - 2 AS INTEGER)), {_DAY})
      END AS clearance_date,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN 'o'
      WHEN o_orderstatus = 'F' THEN ' c '
      WHEN o_orderstatus = 'O' THEN 'N' END AS clearance_status,
    CASE o_custkey % 7 WHEN 0 THEN ' y ' WHEN 2 THEN '?' WHEN 1 THEN NULL
      ELSE 'N' END AS family_violence,
    CASE WHEN o_custkey % 11 = 0 THEN NULL
      WHEN o_orderkey % 97 = 0 THEN 'x'
      WHEN o_orderkey % 3 = 0 THEN (o_custkey % 10 + 1) || '.0'
      ELSE CAST(o_custkey % 10 + 1 AS VARCHAR) END AS council_district,
    'D' || (o_custkey % 5) AS district,
    'S' || (o_custkey % 8) AS sector,
    CAST(o_custkey AS VARCHAR) AS census_block_group,
    CASE WHEN o_custkey % 17 <> 0 THEN 'STREET' END AS location_type
  FROM (SELECT *, o_orderdate + to_days(CAST(o_orderkey % 9 - 1 AS INTEGER))
          AS reported FROM orders)
)"""

BASE = (
    RAW
    + """,
base AS (
  SELECT
    ":id" AS source_row_id, ":version" AS source_version,
    ":created_at" AS source_created_at, ":updated_at" AS source_updated_at,
    * EXCLUDE (":id", ":version", ":created_at", ":updated_at"),
    'incidents' AS dataset_id, 'run-1' AS ingestion_run_id,
    TIMESTAMP '2002-01-01 00:00:00' AS ingested_at,
    'landing/run-1/' AS source_file
  FROM raw
)"""
)


def _local(column: str) -> str:
    text = f"regexp_replace(trim({column}), '\\s+', ' ', 'g')"
    return (
        f"CASE WHEN regexp_full_match({text}, '\\d\\d/\\d\\d/\\d{{4}} \\d\\d:\\d\\d') "
        f"THEN try_strptime({text}, '%m/%d/%Y %H:%M') END"
    )


def _date(column: str) -> str:
    return f"CAST(try_strptime({column}, '%Y-%m-%dT%H:%M:%S.%g') AS DATE)"


def _instant(column: str) -> str:
    return f"try_strptime({column}, '%Y-%m-%dT%H:%M:%S.%gZ')"


CLEAN = (
    BASE
    + f""",
clean AS (
  SELECT * EXCLUDE (family_violence) REPLACE (
      {_date("occ_date")} AS occ_date,
      {_local("occ_date_time")} AS occ_date_time,
      {_date("rep_date")} AS rep_date,
      {_local("rep_date_time")} AS rep_date_time,
      {_date("clearance_date")} AS clearance_date,
      {_instant("source_created_at")} AS source_created_at,
      {_instant("source_updated_at")} AS source_updated_at,
      upper(trim(clearance_status)) AS clearance_status,
      TRY_CAST(council_district AS INTEGER) AS council_district
    ),
    CASE upper(trim(family_violence)) WHEN 'Y' THEN true WHEN 'N' THEN false END
      AS is_family_violence,
    CASE upper(trim(clearance_status)) WHEN 'C' THEN true WHEN 'O' THEN true
      WHEN 'N' THEN false END AS is_cleared
  FROM base
)"""
)

ENRICHED = (
    CLEAN
    + """,
enriched AS (
  SELECT *,
    if(reported_after < 0, NULL, reported_after) AS reporting_delay_days,
    if(cleared_after < 0, NULL, cleared_after) AS clearance_delay_days,
    -- The smallest of the known gaps tells whether any step came too early.
    coalesce(least(reported_after, cleared_after, clearance_date - occ_date) < 0, false)
      AS has_date_sequence_issue
  FROM (SELECT *, rep_date - occ_date AS reported_after,
      clearance_date - rep_date AS cleared_after FROM clean)
)"""
)

FACT = (
    ENRICHED
    + """,
fact AS (
  SELECT incident_report_number, source_row_id, crime_type, category_description,
    ucr_category, ucr_code, occ_date, occ_date_time, rep_date, rep_date_time,
    clearance_date, clearance_status, is_cleared, is_family_violence,
    council_district, district, sector, census_block_group, location_type,
    reporting_delay_days, clearance_delay_days, has_date_sequence_issue,
    1 AS incident_count, dataset_id, ingestion_run_id, ingested_at,
    source_created_at, source_updated_at
  FROM enriched
)"""
)

MART = (
    FACT
    + """,
mart AS (
  SELECT CAST(date_trunc('month', occ_date) AS DATE) AS occ_month,
    crime_type, council_district,
    CAST(sum(incident_count) AS BIGINT) AS incident_count,
    count(*) FILTER (WHERE is_cleared IS NOT NULL) AS known_clearance_count,
    count(*) FILTER (WHERE is_cleared) AS cleared_count,
    count(*) FILTER (WHERE is_family_violence) AS family_violence_count
  FROM fact GROUP BY 1, 2, 3
)"""
)

RATES = (
    FACT
    + """,
counts AS (
  SELECT CAST(date_trunc('month', occ_date) AS DATE) AS occ_month,
    council_district,
    CAST(sum(incident_count) AS BIGINT) AS incident_count,
    count(*) FILTER (WHERE is_cleared IS NOT NULL) AS known_clearance_count,
    count(*) FILTER (WHERE is_cleared) AS cleared_count,
    count(*) FILTER (WHERE NOT is_cleared) AS not_cleared_count,
    count(*) FILTER (WHERE is_cleared IS NULL) AS unknown_clearance_count
  FROM fact GROUP BY 1, 2
),
rates AS (
  SELECT *, CAST(cleared_count AS DOUBLE) / nullif(known_clearance_count, 0)
    AS clearance_rate FROM counts
)"""
)

# The base table after both batches of moved incidents, each as a whole of its rows.
_NOON = "strftime(CAST(substr(source_created_at, 1, 10) AS TIMESTAMP) + "
MOVED_BASE = (
    BASE.replace("\nbase AS (", "\nplain AS (")
    + f""",
one AS (
  SELECT * REPLACE (
      {_NOON} INTERVAL 36 HOUR, {_ISO}) AS source_updated_at, 'run-2' AS ingestion_run_id,
      CASE WHEN k % 35 = 1 THEN 'n/a'
        ELSE {_NOON} INTERVAL 40 DAY, {_DAY}) END AS occ_date,
      CASE WHEN k % 2 = 1 THEN '3' ELSE council_district END AS council_district,
      CASE WHEN k % 3 = 1 THEN 'N' ELSE clearance_status END AS clearance_status,
      'Y' AS family_violence)
  FROM (SELECT *, CAST(incident_report_number AS BIGINT) AS k FROM plain)
  WHERE k % 5 = 1
),
two AS (
  SELECT * REPLACE (
      {_NOON} INTERVAL 60 HOUR, {_ISO}) AS source_updated_at, 'run-3' AS ingestion_run_id,
      {_NOON} INTERVAL (-400) DAY, {_DAY}) AS occ_date,
      CASE WHEN k % 2 = 0 THEN 'C' END AS clearance_status)
  FROM (SELECT *, CAST(incident_report_number AS BIGINT) AS k FROM plain)
  WHERE k % 7 = 2
),
copies AS (
  SELECT * REPLACE (
      {_NOON} INTERVAL 60 HOUR, {_ISO}) AS source_updated_at, 'run-3' AS ingestion_run_id,
      CAST(k + {_BIG} AS VARCHAR) AS incident_report_number)
  FROM (SELECT *, CAST(incident_report_number AS BIGINT) AS k FROM plain)
  WHERE k % 50 = 4
),
base AS (
  SELECT * FROM plain WHERE CAST(incident_report_number AS BIGINT) % 5 <> 1
    AND CAST(incident_report_number AS BIGINT) % 7 <> 2
  UNION ALL SELECT * EXCLUDE (k) FROM one WHERE k % 7 <> 2
  UNION ALL SELECT * EXCLUDE (k) FROM two
  UNION ALL SELECT * EXCLUDE (k) FROM copies
)"""
)


def _moved(ctes: str) -> str:
    """The same definitions over the base table after the two batches."""
    return MOVED_BASE + ctes.removeprefix(BASE)


MONTHS = f"occ_month < date_trunc('month', DATE '{AS_OF.isoformat()}')"

REPEATED = f"""
repeated AS (
  SELECT
    CASE WHEN l_orderkey % 103 = 1 THEN '  '
      WHEN l_orderkey % 101 <> 1 THEN CAST(l_orderkey AS VARCHAR) END
      AS incident_report_number,
    CASE WHEN l_suppkey % 10 <> 0 THEN strftime(l_shipdate, {_ISO}) END
      AS source_updated_at,
    CAST(l_partkey % 12 AS VARCHAR) AS source_version,
    CASE WHEN l_quantity <> 13
      THEN l_partkey || '-' || l_suppkey || '-' || l_linenumber END AS source_row_id
  FROM lineitem
)"""

MERGE = (
    BASE
    + f""",
target AS (
  SELECT incident_report_number,
    CASE WHEN CAST(census_block_group AS BIGINT) % 19 <> 0
      THEN source_updated_at END AS source_updated_at,
    source_version, crime_type, ingestion_run_id
  FROM base
),
updates AS (
  SELECT
    CAST(CASE WHEN o_custkey % 11 = 3 THEN o_orderkey + {_BIG} ELSE o_orderkey END
      AS VARCHAR) AS incident_report_number,
    strftime(o_orderdate + INTERVAL 12 HOUR + to_days(CAST(
      CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS INTEGER)),
      {_ISO}) AS source_updated_at,
    CASE WHEN o_orderkey % 8 = 1 THEN NULL WHEN o_orderkey % 4 = 1 THEN '2'
      ELSE '1' END AS source_version,
    'UPDATED ' || o_orderpriority AS crime_type,
    'run-2' AS ingestion_run_id
  FROM orders
),
candidates AS (
  SELECT u.*, t.incident_report_number AS target_incident_report_number,
    t.source_updated_at AS target_source_updated_at,
    t.source_version AS target_source_version
  FROM updates u LEFT JOIN target t USING (incident_report_number)
  WHERE t.incident_report_number IS NULL
    OR t.source_updated_at IS NULL
    OR u.source_updated_at > t.source_updated_at
    OR (u.source_updated_at = t.source_updated_at
        AND u.source_version IS DISTINCT FROM t.source_version)
),
merged AS (
  SELECT incident_report_number, source_updated_at, source_version, crime_type,
    ingestion_run_id FROM candidates
  UNION ALL
  SELECT * FROM target WHERE incident_report_number NOT IN
    (SELECT incident_report_number FROM candidates)
)"""
)

_UNAPPLIED = """
  SELECT u.* FROM updates u WHERE NOT EXISTS (
    SELECT 1 FROM {stored} t
    WHERE t.incident_report_number = u.incident_report_number
      AND (t.source_updated_at > u.source_updated_at
        OR (t.source_updated_at = u.source_updated_at
          AND t.source_version IS NOT DISTINCT FROM u.source_version)))"""

LATER = (
    BASE
    + f""",
later AS (
  SELECT * REPLACE (
    CAST(CASE WHEN k % 23 = 4 THEN k + {_BIG} ELSE k END AS VARCHAR)
      AS incident_report_number,
    CASE WHEN k % 5 = 2 THEN NULL ELSE crime_type END AS crime_type,
    CASE WHEN k % 29 = 0 THEN 'moved' ELSE sector END AS sector,
    CASE WHEN k % 2 = 0 THEN '2' ELSE source_version END AS source_version)
  FROM (SELECT *, CAST(incident_report_number AS BIGINT) AS k FROM base)
)"""
)

KEYS = f"""
source AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderdate AS t FROM orders
),
stored AS (
  SELECT CAST(CASE WHEN o_custkey % 31 = 1 THEN o_orderkey + {_BIG}
      ELSE o_orderkey END AS VARCHAR) AS k,
    CASE WHEN o_custkey % 37 = 2 THEN NULL
      WHEN o_custkey % 7 = 3 THEN o_orderdate + INTERVAL 1 DAY
      ELSE o_orderdate END AS t
  FROM orders
),
lacking AS (SELECT k FROM source WHERE k NOT IN (SELECT k FROM stored)),
extra AS (SELECT k FROM stored WHERE k NOT IN (SELECT k FROM source)),
differing AS (
  SELECT k, source.t AS source_t, stored.t AS stored_t
  FROM source JOIN stored USING (k) WHERE source.t IS DISTINCT FROM stored.t
)"""

CONTROL = f"""
runs AS (
  SELECT 'run-' || o_orderkey AS pipeline_run_id,
    'incident_load' AS pipeline_name,
    CASE WHEN o_custkey % 9 = 0 THEN 'FULL_SNAPSHOT' ELSE 'INCREMENTAL' END
      AS run_type,
    CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS'
      ELSE 'RUNNING' END AS status,
    started AS started_at,
    CASE WHEN o_orderstatus <> 'P'
      THEN started + to_microseconds(o_custkey * 1500000) END AS finished_at,
    CASE WHEN o_orderstatus = 'F' THEN 'UNKNOWN_ERROR' END AS failure_category,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS error_message,
    o_orderdate AS created_at
  FROM (SELECT *, CASE WHEN o_custkey % 29 <> 0 THEN o_orderdate END AS started
        FROM orders)
),
batches AS (
  SELECT identity AS extract_batch_id, 'run-' || l_orderkey AS pipeline_run_id,
    'ds-' || l_suppkey AS dataset_id,
    CASE WHEN l_linestatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CAST(10000 AS INTEGER) AS page_size, l_linenumber AS pages_downloaded,
    l_partkey AS record_count, identity AS raw_prefix,
    CASE WHEN l_linestatus = 'O' THEN identity END AS manifest_path,
    l_shipdate AS started_at, l_shipdate AS finished_at
  FROM (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-'
          || l_suppkey AS identity FROM lineitem)
),
marks AS (
  SELECT 'ds-' || s_suppkey AS dataset_id, 'updated_at' AS watermark_column,
    CASE WHEN s_suppkey % 9 = 0 THEN NULL
      WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '1997-01-01 00:00:00'
      ELSE TIMESTAMP '2000-06-01 00:00:00' END AS watermark_value,
    'run-' || (s_suppkey * 3) AS last_successful_pipeline_run_id,
    TIMESTAMP '2002-01-01 00:00:00' AS updated_at
  FROM supplier
),
requests AS (
  SELECT
    'run-' || CASE WHEN l_orderkey % 41 = 1 THEN l_orderkey + {_BIG}
      WHEN l_partkey % 3 = 0 THEN l_suppkey * 3 ELSE l_orderkey END
      AS pipeline_run_id,
    'ds-' || CASE WHEN l_orderkey % 43 = 1 THEN -1 ELSE l_suppkey END AS dataset_id,
    l_shipdate AS window_end
  FROM lineitem
),
judged AS (
  SELECT q.pipeline_run_id, q.dataset_id, q.window_end, r.status AS run_status,
    m.watermark_value AS current_watermark,
    CASE
      WHEN r.pipeline_run_id IS NULL THEN 'RUN_NOT_FOUND'
      WHEN m.dataset_id IS NULL THEN 'WATERMARK_NOT_FOUND'
      WHEN r.status = 'SUCCESS'
        AND m.last_successful_pipeline_run_id = q.pipeline_run_id
        AND m.watermark_value >= q.window_end THEN 'ALREADY_FINALIZED'
      WHEN r.status <> 'RUNNING' THEN 'RUN_NOT_RUNNING'
      WHEN q.window_end < m.watermark_value THEN 'WATERMARK_WOULD_GO_BACK'
      ELSE 'ADVANCE' END AS decision
  FROM requests q
  LEFT JOIN runs r ON r.pipeline_run_id = q.pipeline_run_id
  LEFT JOIN marks m ON m.dataset_id = q.dataset_id
),
failures AS (
  SELECT q.pipeline_run_id, 'UNKNOWN_ERROR' AS failure_category,
    'requested' AS error_message, r.status AS run_status,
    CASE WHEN r.status IS NULL THEN 'RUN_NOT_FOUND'
      WHEN r.status = 'RUNNING' THEN 'MARK_FAILED'
      WHEN r.status = 'FAILED' THEN 'ALREADY_FAILED'
      ELSE 'NOT_FAILABLE' END AS decision
  FROM (SELECT DISTINCT pipeline_run_id FROM requests) q
  LEFT JOIN runs r USING (pipeline_run_id)
),
overview AS (
  SELECT r.pipeline_run_id, r.pipeline_name, r.run_type,
    r.status AS pipeline_status, r.started_at AS pipeline_started_at,
    r.finished_at AS pipeline_finished_at,
    CAST(round((epoch_us(coalesce(r.finished_at, TIMESTAMP '2002-06-01 00:00:00'))
      - epoch_us(r.started_at)) / 1000000.0) AS BIGINT) AS pipeline_duration_seconds,
    r.failure_category, r.error_message, r.created_at,
    b.extract_batch_id, b.dataset_id, b.status AS batch_status, b.page_size,
    b.pages_downloaded, b.record_count, b.raw_prefix, b.manifest_path,
    b.started_at AS batch_started_at, b.finished_at AS batch_finished_at,
    m.watermark_column, m.watermark_value, m.last_successful_pipeline_run_id,
    coalesce(m.last_successful_pipeline_run_id = r.pipeline_run_id, false)
      AS is_last_successful_run
  FROM runs r
  LEFT JOIN batches b ON b.pipeline_run_id = r.pipeline_run_id
  LEFT JOIN marks m ON m.dataset_id = b.dataset_id
)"""

MODES = """
marked AS (
  SELECT event_type AS dataset_id, ts,
    CASE event_type WHEN 'signup' THEN TIMESTAMP '2023-12-31'
      WHEN 'purchase' THEN TIMESTAMP '2024-02-01'
      WHEN 'view' THEN TIMESTAMP '2024-01-04'
      WHEN 'error' THEN TIMESTAMP '2024-01-20' END AS wm
  FROM events
),
windows AS (
  SELECT dataset_id, count(*) AS source_record_count,
    CASE WHEN max(wm) IS NOT NULL THEN count(*) FILTER (WHERE ts > wm) END
      AS changed_record_count,
    max(ts) FILTER (WHERE ts > wm) AS window_end
  FROM marked GROUP BY 1
),
modes AS (
  SELECT *, CASE
    WHEN changed_record_count IS NULL THEN 'REJECTED'
    WHEN changed_record_count = 0 THEN 'NO_CHANGES'
    WHEN changed_record_count = source_record_count THEN 'FULL_SNAPSHOT'
    WHEN changed_record_count * 1.0 / source_record_count >= 0.8
      THEN 'REVIEW_REQUIRED'
    ELSE 'INCREMENTAL' END AS load_mode
  FROM windows
)"""

EVENT_RUNS = """
counts AS (
  SELECT event_type AS run_id, count(*) AS n FROM events GROUP BY 1
)"""

ORACLES: dict[str, str] = {
    "raw_scan": f"WITH {RAW} SELECT * FROM raw",
    "landing_manifest": """
        SELECT 'run-1' AS run_id, 'events' AS dataset_id,
          CAST(10000 AS BIGINT) AS page_size, count(*) AS expected_record_count,
          count(*) AS extracted_record_count, 'SUCCESS' AS status,
          true AS pages_within_size, true AS pages_listed
        FROM events""",
    "manifest_gate": f"""WITH {EVENT_RUNS}
        SELECT run_id, n AS actual_record_count,
          CASE run_id WHEN 'view' THEN NULL WHEN 'purchase' THEN 'PARTIAL'
            ELSE 'SUCCESS' END AS status,
          CASE run_id WHEN 'view' THEN NULL WHEN 'click' THEN n + 1 ELSE n END
            AS expected_record_count,
          CASE WHEN run_id <> 'view' THEN n END AS extracted_record_count,
          CASE run_id WHEN 'view' THEN 'MANIFEST_MISSING'
            WHEN 'purchase' THEN 'NOT_SUCCESSFUL'
            WHEN 'click' THEN 'COUNT_MISMATCH' ELSE 'ACCEPTED' END AS verdict
        FROM counts""",
    "manifest_files": f"""WITH {EVENT_RUNS}
        SELECT run_id, run_id <> 'click' AS names_unique,
          run_id <> 'click' AS pages_match, run_id <> 'click' AS records_match,
          run_id IN ('click', 'error') AS has_file_problems,
          run_id = 'signup' AS accepted
        FROM counts WHERE run_id <> 'view'""",
    "manifest_total": f"""WITH {EVENT_RUNS}
        SELECT run_id, CASE run_id WHEN 'click' THEN 2 * n ELSE n END
          AS listed_records FROM counts WHERE run_id <> 'view'""",
    "extraction_status": """
        WITH c AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS pages,
            l_orderkey % 7 + 1 AS want, CASE WHEN l_orderkey % 3 = 0 THEN 5 END AS cap
          FROM lineitem GROUP BY l_orderkey)
        SELECT l_orderkey,
          CASE WHEN n = want THEN 'SUCCESS' WHEN pages >= cap THEN 'PARTIAL'
            ELSE 'COUNT_MISMATCH' END AS status,
          CASE WHEN cap IS NOT NULL AND n < want THEN 'PARTIAL'
            WHEN n = want THEN 'SUCCESS' ELSE 'COUNT_MISMATCH' END AS bootstrap_status
        FROM c""",
    "file_ledger_upsert": f"""
        WITH n AS (SELECT *, CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey + {_BIG}
            ELSE o_orderkey END AS obj FROM orders),
        merged AS (
          SELECT o.o_custkey AS cust, o.o_orderkey AS obj, 'part_0001.json' AS file_name,
            coalesce(n.o_custkey % 500, 10000) AS record_count,
            coalesce(n.o_custkey * 100, o.o_orderkey % 1000) AS file_size_bytes,
            o.o_orderdate AS created_at
          FROM orders o LEFT JOIN n
            ON n.o_custkey = o.o_custkey AND n.obj = o.o_orderkey
          UNION ALL
          SELECT o_custkey, obj, 'part_0002.json', o_custkey % 500, o_custkey * 100,
            TIMESTAMP '2002-01-01 00:00:00'
          FROM n WHERE obj >= {_BIG})
        SELECT 'batch-' || cust AS extract_batch_id, file_name,
          'landing/' || obj AS object_path, record_count, file_size_bytes,
          CAST(NULL AS VARCHAR) AS checksum_sha256, created_at
        FROM merged""",
    "page_checksums": """
        SELECT 'c_nationkey=' || c_nationkey AS folder,
          CAST(sum(strlen(line) + 1) AS BIGINT) AS file_size_bytes,
          sha256(string_agg(line || chr(10), '' ORDER BY c_custkey)) AS checksum_sha256
        FROM (SELECT *, c_custkey || ' ' || c_name AS line FROM customer) GROUP BY ALL
        """,
    "source_summary": """SELECT count(*) AS record_count, max(ts) AS max_updated_at
        FROM events""",
    "change_window": """SELECT count(*) AS record_count, max(ts) AS max_updated_at
        FROM events WHERE ts > TIMESTAMP '2024-01-10'""",
    "change_window_pages": """
        SELECT event_id, ts,
          (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 + 1 AS page_number
        FROM events
        WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-28'""",
    "keyset_page": """SELECT * FROM orders WHERE o_orderkey > 999
        ORDER BY o_orderkey LIMIT 10000""",
    "key_snapshot": """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
        WHERE o_orderdate <= TIMESTAMP '2001-01-01'""",
    "iso_text": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts_text
        FROM events""",
    "load_mode": f"WITH {MODES} SELECT * FROM modes",
    "run_outcomes": f"""WITH {MODES}
        SELECT *, load_mode AS run_type,
          CASE load_mode WHEN 'NO_CHANGES' THEN 'SUCCESS' ELSE 'FAILED' END
            AS pipeline_status,
          CASE load_mode WHEN 'NO_CHANGES' THEN 'SUCCESS' ELSE 'BLOCKED' END
            AS batch_status,
          CASE WHEN load_mode = 'REVIEW_REQUIRED' THEN 'BULK_CHANGE_REVIEW' END
            AS failure_category,
          CASE WHEN load_mode = 'REVIEW_REQUIRED' THEN printf(
            'Bulk change at or above the review threshold, not a complete snapshot: '
            || 'changed=%d, source=%d, percentage=%.2f%%', changed_record_count,
            source_record_count, changed_record_count * 100.0 / source_record_count)
            END AS error_message,
          CAST(0 AS INTEGER) AS pages_downloaded, CAST(0 AS BIGINT) AS record_count
        FROM modes WHERE load_mode IN ('NO_CHANGES', 'REVIEW_REQUIRED')""",
    "bronze_stage": f"WITH {BASE} SELECT * FROM base",
    "batch_profile": f"""WITH {REPEATED},
        kept AS (SELECT DISTINCT incident_report_number FROM repeated),
        c AS (SELECT count(*) AS incoming_count,
            (SELECT count(*) FROM kept) AS deduplicated_count,
            count(*) FILTER (WHERE coalesce(trim(incident_report_number), '') = '')
              AS missing_key_count,
            count(*) FILTER (WHERE coalesce(trim(source_row_id), '') = '')
              AS missing_row_id_count,
            count(*) FILTER (WHERE source_updated_at IS NULL)
              AS missing_updated_at_count
          FROM repeated)
        SELECT *, incoming_count - deduplicated_count AS duplicates_removed FROM c""",
    "missing_keys": f"""WITH {REPEATED} SELECT * FROM repeated
        WHERE coalesce(trim(incident_report_number), '') = ''
          OR coalesce(trim(source_row_id), '') = '' OR source_updated_at IS NULL""",
    "batch_problems": f"""WITH {REPEATED}
        SELECT 'Records without a business key.' AS problem FROM repeated
          WHERE coalesce(trim(incident_report_number), '') = '' GROUP BY 1
        UNION ALL SELECT 'Records without a source row id.' FROM repeated
          WHERE source_row_id IS NULL GROUP BY 1
        UNION ALL SELECT 'Records without an update time.' FROM repeated
          WHERE source_updated_at IS NULL GROUP BY 1
        UNION ALL SELECT 'A full snapshot must hold one record per key.' FROM repeated
          GROUP BY 1 HAVING count(*) > count(DISTINCT incident_report_number) + 1""",
    "dedupe_latest": f"""WITH {REPEATED},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY incident_report_number
            ORDER BY {_instant("source_updated_at")} DESC NULLS LAST,
              CAST(source_version AS BIGINT) DESC NULLS LAST,
              source_row_id DESC NULLS LAST) AS place FROM repeated)
        SELECT * EXCLUDE (place) FROM ranked WHERE place = 1""",
    "merge_candidates": f"WITH {MERGE} SELECT * FROM candidates",
    "merge_candidates_text": f"WITH {MERGE} SELECT * FROM candidates",
    "unapplied_rows": f"WITH {MERGE} {_UNAPPLIED.format(stored='target')}",
    "upsert": f"WITH {MERGE} SELECT * FROM merged",
    "upsert_touched_buckets": f"WITH {MERGE} SELECT * FROM merged",
    "summary_by_deltas": f"WITH {_moved(MART)} SELECT * FROM mart",
    "rates_by_deltas": f"WITH {_moved(RATES)} SELECT * FROM rates",
    "silver_touched_years": f"WITH {_moved(CLEAN)} SELECT * FROM clean",
    "upsert_small_batch": f"WITH {MERGE} SELECT * FROM merged",
    "upsert_bucketed": f"WITH {MERGE} SELECT * FROM merged",
    "upsert_idempotent": f"""WITH {MERGE}
        SELECT (SELECT count(*) FROM candidates) AS first_rows,
          CAST(0 AS BIGINT) AS again_rows,
          (SELECT count(*) FROM ({_UNAPPLIED.format(stored="merged")}))
            AS unapplied_rows,
          (SELECT count(*) FROM merged) AS merged_rows""",
    "snapshot_replace": f"WITH {LATER} SELECT * EXCLUDE (k) FROM later",
    "commit_history": f"""WITH {MERGE}
        SELECT CAST(1 AS BIGINT) AS version, 'append' AS operation,
          (SELECT count(*) FROM target) AS record_count
        UNION ALL
        SELECT CAST(2 AS BIGINT), 'overwrite', (SELECT count(*) FROM merged)""",
    "snapshot_diff": f"""WITH {LATER},
        pairs AS (
          SELECT a.incident_report_number AS old_key, b.incident_report_number AS new_key,
            a.crime_type IS NOT DISTINCT FROM b.crime_type
              AND a.occ_date IS NOT DISTINCT FROM b.occ_date
              AND a.clearance_status IS NOT DISTINCT FROM b.clearance_status
              AND a.council_district IS NOT DISTINCT FROM b.council_district
              AND a.sector IS NOT DISTINCT FROM b.sector AS same,
            a.source_updated_at IS DISTINCT FROM b.source_updated_at AS t,
            a.source_version IS DISTINCT FROM b.source_version AS v,
            a.source_row_id IS DISTINCT FROM b.source_row_id AS r
          FROM base a FULL JOIN later b USING (incident_report_number)),
        both_sides AS (SELECT * FROM pairs
          WHERE old_key IS NOT NULL AND new_key IS NOT NULL)
        SELECT (SELECT count(*) FROM pairs WHERE old_key IS NULL) AS inserted,
          (SELECT count(*) FROM pairs WHERE new_key IS NULL) AS removed,
          count(*) FILTER (WHERE NOT same) AS changed,
          count(*) FILTER (WHERE same) AS unchanged,
          count(*) FILTER (WHERE t) AS source_updated_at_changed,
          count(*) FILTER (WHERE v) AS source_version_changed,
          count(*) FILTER (WHERE r) AS source_row_id_changed
        FROM both_sides""",
    "silver_standardize": f"WITH {CLEAN} SELECT * FROM clean",
    "partitioned_write": f"""WITH {CLEAN}
        SELECT incident_report_number, occ_date, crime_type,
          CAST(year(occ_date) AS INTEGER) AS occ_year
        FROM clean WHERE occ_date BETWEEN DATE '1996-03-01' AND DATE '1998-10-31'""",
    "partitioned_rows": f"""WITH {CLEAN}
        SELECT incident_report_number, occ_date, crime_type,
          CAST(year(occ_date) AS INTEGER) AS occ_year FROM clean""",
    "partition_stats": f"""WITH {CLEAN}
        SELECT CAST(year(occ_date) AS INTEGER) AS occ_year, count(*) AS record_count,
          true AS has_files FROM clean GROUP BY 1""",
    "enrich_delays": f"""WITH {ENRICHED}
        SELECT incident_report_number, occ_date, rep_date, clearance_date,
          reporting_delay_days, clearance_delay_days, has_date_sequence_issue
        FROM enriched""",
    "fact": f"WITH {FACT} SELECT * FROM fact",
    "monthly_summary": f"WITH {MART} SELECT * FROM mart",
    "monthly_trends": f"WITH {MART} SELECT * FROM mart",
    "clearance_rates": f"WITH {RATES} SELECT * FROM rates",
    "gold_totals": f"""WITH {MART}
        SELECT count(*) AS gold_row_count,
          CAST(sum(incident_count) AS BIGINT) AS total_incidents,
          CAST(sum(known_clearance_count) AS BIGINT) AS total_known_clearance,
          CAST(sum(cleared_count) AS BIGINT) AS total_cleared,
          CAST(sum(family_violence_count) AS BIGINT) AS total_family_violence
        FROM mart""",
    "latest_months_top": f"""WITH {MART} SELECT * FROM mart
        ORDER BY occ_month DESC NULLS LAST, incident_count DESC,
          crime_type NULLS FIRST, council_district NULLS FIRST LIMIT 20""",
    "key_profile": f"""WITH {REPEATED}
        SELECT count(*) AS record_count,
          count(DISTINCT source_row_id) AS distinct_source_row_ids,
          count(*) FILTER (WHERE coalesce(trim(source_row_id), '') = '')
            AS missing_source_row_ids,
          count(DISTINCT incident_report_number) AS distinct_incident_report_numbers,
          count(*) FILTER (WHERE coalesce(trim(incident_report_number), '') = '')
            AS missing_incident_report_numbers
        FROM repeated""",
    "duplicate_keys": f"""WITH {REPEATED}
        SELECT incident_report_number, count(*) AS record_count FROM repeated
        WHERE trim(incident_report_number) <> '' GROUP BY 1 HAVING count(*) > 1
        ORDER BY record_count DESC, incident_report_number LIMIT 10""",
    "date_coverage": f"""WITH {BASE}
        SELECT min(occ_date) AS earliest_occ_date, max(occ_date) AS latest_occ_date,
          count(*) - count(occ_date) AS missing_occ_date,
          min(rep_date) AS earliest_rep_date, max(rep_date) AS latest_rep_date,
          count(*) - count(rep_date) AS missing_rep_date,
          count(*) - count(clearance_date) AS missing_clearance_date,
          count(*) - count(source_created_at) AS missing_source_created_at,
          count(*) - count(source_updated_at) AS missing_source_updated_at
        FROM base""",
    "status_breakdown": f"""WITH {BASE}
        SELECT coalesce(clearance_status, 'MISSING') AS clearance_status,
          count(*) AS record_count,
          count(clearance_date) AS records_with_clearance_date,
          count(*) - count(clearance_date) AS records_without_clearance_date
        FROM base GROUP BY 1""",
    "value_frequency": f"""WITH {BASE}
        SELECT coalesce(family_violence, 'MISSING') AS family_violence,
          count(*) AS record_count FROM base GROUP BY 1""",
    "date_sample": f"""WITH {BASE}
        SELECT incident_report_number, occ_date, occ_date_time, rep_date,
          rep_date_time, clearance_date, source_created_at, source_updated_at
        FROM base WHERE clearance_date IS NOT NULL
        ORDER BY incident_report_number LIMIT 10""",
    "distinct_keys": f"""WITH {REPEATED} SELECT count(*) AS unique_count
        FROM (SELECT DISTINCT incident_report_number FROM repeated)""",
    "missing_from_target": f"""WITH {KEYS}
        SELECT k AS incident_report_number, CAST(1 AS BIGINT) AS source_rows
        FROM lacking""",
    "missing_from_source": f"""WITH {KEYS}
        SELECT k AS incident_report_number, CAST(1 AS BIGINT) AS target_rows
        FROM extra""",
    "timestamp_mismatch": f"""WITH {KEYS}
        SELECT k AS incident_report_number, source_t AS source_source_updated_at,
          stored_t AS target_source_updated_at FROM differing""",
    "reconcile_summary": f"""WITH {KEYS}
        SELECT (SELECT count(*) FROM source) AS source_count,
          (SELECT count(DISTINCT k) FROM source) AS source_unique_count,
          CAST(0 AS BIGINT) AS source_null_keys,
          CAST(0 AS BIGINT) AS source_repeated_keys,
          (SELECT count(*) FROM stored) AS target_count,
          (SELECT count(DISTINCT k) FROM stored) AS target_unique_count,
          CAST(0 AS BIGINT) AS target_null_keys,
          CAST(0 AS BIGINT) AS target_repeated_keys,
          (SELECT count(*) FROM lacking) AS missing_from_target,
          (SELECT count(*) FROM extra) AS missing_from_source,
          (SELECT count(*) FROM differing) AS timestamp_mismatches""",
    "reconcile_profile": f"""WITH {REPEATED},
        stored AS (SELECT CAST(o_orderkey AS VARCHAR) AS k FROM orders)
        SELECT count(*) AS source_count,
          (SELECT count(*) FROM (SELECT DISTINCT incident_report_number FROM repeated))
            AS source_unique_count,
          count(*) FILTER (WHERE incident_report_number IS NULL) AS source_null_keys,
          (SELECT count(*) FROM stored) AS target_count,
          (SELECT count(DISTINCT k) FROM stored) AS target_unique_count,
          CAST(0 AS BIGINT) AS target_null_keys,
          count(*) FILTER (WHERE incident_report_number IS NULL
            OR incident_report_number NOT IN (SELECT k FROM stored))
            AS missing_from_target,
          (SELECT count(*) FROM stored WHERE k NOT IN (SELECT incident_report_number
            FROM repeated WHERE incident_report_number IS NOT NULL))
            AS missing_from_source
        FROM repeated""",
    "summary_compare": f"""WITH {MERGE},
        s AS (SELECT count(*) AS n, max({_instant("source_updated_at")}) AS t FROM base),
        u AS (SELECT count(*) AS n, max({_instant("source_updated_at")}) AS t
          FROM updates)
        SELECT s.n AS source_record_count, s.t AS source_max_updated_at,
          u.n AS target_record_count, u.t AS target_max_updated_at,
          s.n = u.n AS counts_match, s.t IS NOT DISTINCT FROM u.t AS timestamps_match,
          s.n = u.n AND s.t IS NOT DISTINCT FROM u.t AS summaries_match
        FROM s CROSS JOIN u""",
    "layer_counts": f"""WITH {MART},
        c AS (SELECT (SELECT count(*) FROM base) AS bronze_count,
          (SELECT count(*) FROM clean) AS silver_count,
          (SELECT CAST(sum(incident_count) AS BIGINT) FROM mart) AS gold_count,
          (SELECT CAST(sum(incident_count) AS BIGINT) FROM fact) AS fact_count,
          (SELECT CAST(sum(incident_count) AS BIGINT) FROM mart) AS mart_count)
        SELECT *, bronze_count > 0 AND silver_count = bronze_count
          AND gold_count = bronze_count AND fact_count = bronze_count
          AND mart_count = bronze_count AS layers_agree FROM c""",
    "bag_diff": """
        WITH a AS (SELECT l_suppkey, l_linenumber, l_returnflag FROM lineitem),
        b AS (SELECT l_suppkey,
            CASE WHEN l_partkey % 50 = 1 THEN 1 ELSE l_linenumber END AS l_linenumber,
            CASE WHEN l_partkey % 20 <> 3 THEN l_returnflag END AS l_returnflag
          FROM lineitem),
        over_a AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
        over_b AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
        SELECT *, count(*) AS surplus FROM over_a GROUP BY ALL
        UNION ALL
        SELECT *, -count(*) AS surplus FROM over_b GROUP BY ALL""",
    "bag_diff_counts": f"""WITH {MART},
        moved AS (SELECT * REPLACE (CASE WHEN council_district <> 4
            THEN council_district END AS council_district) FROM mart)
        SELECT CAST(0 AS BIGINT) AS same_left_only, CAST(0 AS BIGINT) AS same_right_only,
          (SELECT count(*) FROM (SELECT * FROM mart EXCEPT ALL SELECT * FROM moved))
            AS moved_left_only,
          (SELECT count(*) FROM (SELECT * FROM moved EXCEPT ALL SELECT * FROM mart))
            AS moved_right_only""",
    "dq_not_null": f"""WITH {FACT},
        n AS (SELECT 'crime_type' AS column_name, count(*) AS null_count FROM fact
            WHERE crime_type IS NULL
          UNION ALL SELECT 'occ_date', count(*) FROM fact WHERE occ_date IS NULL
          UNION ALL SELECT 'council_district', count(*) FROM fact
            WHERE council_district IS NULL
          UNION ALL SELECT 'incident_count', count(*) FROM fact
            WHERE incident_count IS NULL
          UNION ALL SELECT 'source_row_id', count(*) FROM fact
            WHERE source_row_id IS NULL
          UNION ALL SELECT 'incident_report_number', count(*) FROM fact
            WHERE incident_report_number IS NULL)
        SELECT * FROM n WHERE null_count > 0""",
    "dq_unique": """SELECT l_orderkey AS value, count(*) AS record_count
        FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "dq_accepted_values": """SELECT o_orderstatus AS value, count(*) AS record_count
        FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1""",
    "totals_match": f"""WITH {MART}
        SELECT (SELECT CAST(sum(incident_count) AS BIGINT) FROM fact) AS fact_incidents,
          (SELECT CAST(sum(incident_count) AS BIGINT) FROM mart) AS mart_incidents,
          (SELECT sum(incident_count) FROM fact)
            = (SELECT sum(incident_count) FROM mart) AS totals_agree""",
    "clearance_balance": f"""WITH {RATES},
        wrong AS (SELECT * REPLACE (known_clearance_count
            + CASE WHEN council_district = 3 THEN 1 ELSE 0 END AS known_clearance_count)
          FROM rates)
        SELECT * FROM wrong
        WHERE NOT (incident_count - known_clearance_count = unknown_clearance_count
          AND known_clearance_count - cleared_count - not_cleared_count = 0
          AND coalesce(clearance_rate BETWEEN 0 AND 1, true))""",
    "run_summary": f"WITH {CONTROL} SELECT * FROM overview",
    "latest_runs": f"""WITH {CONTROL}
        SELECT pipeline_run_id, extract_batch_id, run_type, pipeline_status,
          batch_status, pages_downloaded, record_count, pipeline_started_at,
          pipeline_finished_at, watermark_value, is_last_successful_run
        FROM overview ORDER BY pipeline_started_at DESC NULLS FIRST, pipeline_run_id,
          extract_batch_id NULLS FIRST LIMIT 10""",
    "watermark_decision": f"""WITH {CONTROL}
        SELECT *, CASE decision WHEN 'ADVANCE' THEN window_end
          WHEN 'ALREADY_FINALIZED' THEN current_watermark END AS new_watermark
        FROM judged""",
    "watermark_advance": f"""WITH {CONTROL},
        won AS (SELECT dataset_id, pipeline_run_id, window_end FROM judged
          WHERE decision = 'ADVANCE' QUALIFY row_number() OVER (PARTITION BY dataset_id
            ORDER BY window_end DESC, pipeline_run_id DESC) = 1)
        SELECT m.dataset_id, m.watermark_column,
          coalesce(w.window_end, m.watermark_value) AS watermark_value,
          coalesce(w.pipeline_run_id, m.last_successful_pipeline_run_id)
            AS last_successful_pipeline_run_id,
          CASE WHEN w.dataset_id IS NULL THEN m.updated_at
            ELSE TIMESTAMP '2002-06-01 00:00:00' END AS updated_at
        FROM marks m LEFT JOIN won w ON w.dataset_id = m.dataset_id""",
    "failure_decision": f"WITH {CONTROL} SELECT * FROM failures",
    "run_closing": f"""WITH {CONTROL}
        SELECT r.pipeline_run_id, r.pipeline_name, r.run_type,
          CASE WHEN f.decision IS NULL THEN r.status ELSE 'FAILED' END AS status,
          r.started_at,
          CASE WHEN f.decision IS NULL THEN r.finished_at
            ELSE TIMESTAMP '2002-06-01 00:00:00' END AS finished_at,
          coalesce(f.failure_category, r.failure_category) AS failure_category,
          coalesce(f.error_message, r.error_message) AS error_message, r.created_at
        FROM runs r LEFT JOIN (SELECT * FROM failures WHERE decision = 'MARK_FAILED') f
          ON f.pipeline_run_id = r.pipeline_run_id""",
    "watermark_seed": f"""WITH {CONTROL},
        latest AS (SELECT 'ds-' || (l_suppkey + 5) AS dataset_id, max(l_shipdate) AS t
          FROM lineitem GROUP BY 1)
        SELECT coalesce(m.dataset_id, l.dataset_id) AS dataset_id,
          'updated_at' AS watermark_column,
          CASE WHEN l.dataset_id IS NULL THEN m.watermark_value ELSE l.t END
            AS watermark_value,
          CASE WHEN l.dataset_id IS NULL THEN m.last_successful_pipeline_run_id
            ELSE 'run-1' END AS last_successful_pipeline_run_id,
          CASE WHEN l.dataset_id IS NULL THEN m.updated_at
            ELSE TIMESTAMP '2002-06-01 00:00:00' END AS updated_at
        FROM marks m FULL JOIN latest l ON l.dataset_id = m.dataset_id""",
    "complete_months": f"WITH {MART} SELECT * FROM mart WHERE {MONTHS}",
    "dashboard_filters": f"""WITH {MART} SELECT * FROM mart
        WHERE occ_month >= DATE '1997-02-01' AND occ_month < DATE '2000-05-01'
          AND crime_type IN ('1-URGENT/1', '5-LOW/3', '2-HIGH/0')""",
    "metric_totals": f"""WITH {MART}
        SELECT CAST(sum(incident_count) AS BIGINT) AS total_incidents,
          CAST(sum(cleared_count) AS BIGINT) AS cleared_incidents FROM mart""",
    "metric_clearance_rate": f"""WITH {MART}
        SELECT CAST(sum(cleared_count) AS DOUBLE)
          / nullif(sum(known_clearance_count), 0) AS clearance_rate FROM mart""",
    "metric_fv_rate": f"""WITH {MART}
        SELECT CAST(sum(family_violence_count) AS DOUBLE)
          / nullif(sum(incident_count), 0) AS family_violence_rate FROM mart""",
    "district_share": f"""WITH {MART},
        g AS (SELECT council_district, CAST(sum(incident_count) AS BIGINT)
            AS total_incidents
          FROM mart WHERE {MONTHS} AND council_district IS NOT NULL GROUP BY 1
          ORDER BY 2 DESC, 1 LIMIT 100)
        SELECT *, CAST(total_incidents AS DOUBLE)
          / (SELECT sum(total_incidents) FROM g) AS contribution FROM g""",
    "monthly_series": f"""WITH {MART}
        SELECT occ_month, CAST(sum(incident_count) AS BIGINT) AS total_incidents
        FROM mart WHERE {MONTHS} GROUP BY 1""",
    "monthly_series_range": f"""WITH {MART}
        SELECT occ_month, CAST(sum(incident_count) AS BIGINT) AS total_incidents
        FROM mart WHERE occ_month >= DATE '1996-08-01'
          AND occ_month < DATE '2001-08-01' GROUP BY 1""",
    "top_types": f"""WITH {MART}
        SELECT crime_type, CAST(sum(incident_count) AS BIGINT) AS total_incidents
        FROM mart WHERE {MONTHS} GROUP BY 1
        ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10""",
    "incidents_by_district": f"""WITH {MART}
        SELECT council_district, CAST(sum(incident_count) AS BIGINT) AS total_incidents
        FROM mart WHERE {MONTHS} AND council_district IS NOT NULL GROUP BY 1""",
}
# The same results reached by events.
ORACLES["file_ledger_events"] = ORACLES["file_ledger_upsert"]
ORACLES["run_closing_events"] = ORACLES["run_closing"]
ORACLES["reconcile_by_ranges"] = ORACLES["reconcile_summary"]
ORACLES["mismatch_by_ranges"] = ORACLES["timestamp_mismatch"]
ORACLES["model_tests"] = f"""WITH {FACT},
    keys AS (SELECT incident_report_number, count(*) AS n FROM fact GROUP BY 1),
    blocks AS (SELECT census_block_group, count(*) AS n FROM fact GROUP BY 1)
    SELECT count(*) AS rows,
      sum(CASE WHEN incident_report_number IS NULL THEN 1 ELSE 0 END)::BIGINT
        AS null_incident_report_number,
      sum(CASE WHEN incident_count IS NULL THEN 1 ELSE 0 END)::BIGINT
        AS null_incident_count,
      sum(CASE WHEN crime_type IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_crime_type,
      sum(CASE WHEN council_district IS NULL THEN 1 ELSE 0 END)::BIGINT
        AS null_council_district,
      (SELECT sum(n - 1) FROM keys WHERE incident_report_number IS NOT NULL)::BIGINT
        AS repeated_incident_report_number,
      (SELECT sum(n - 1) FROM blocks WHERE census_block_group IS NOT NULL)::BIGINT
        AS repeated_census_block_group,
      sum(CASE WHEN incident_count <> 1 THEN 1 ELSE 0 END)::BIGINT
        AS outside_incident_count,
      sum(CASE WHEN clearance_status NOT IN ('C', 'N') THEN 1 ELSE 0 END)::BIGINT
        AS outside_clearance_status,
      sum(incident_count)::BIGINT AS sum_incident_count,
      sum(reporting_delay_days)::BIGINT AS sum_reporting_delay_days
    FROM fact"""
ORACLES["version_diff"] = ORACLES["snapshot_diff"]
ORACLES["keyset_page_directory"] = ORACLES["keyset_page"]
