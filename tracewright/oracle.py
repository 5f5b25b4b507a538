"""The catalog's queries as SQL over the raw tables, written independently.

Each query is a chain of common table expressions that ends in one SELECT; the
shared steps are spelled out once below. Word lists, field lists and labels in them are
fixed values, the same as in the operators.
"""

from __future__ import annotations


def _audit(grain: str) -> str:
    day = " || '-' || strftime(ts, '%d')" if grain == "day" else ""
    return f"""
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS BIGINT) AS k,
         CAST(ts AS DATE) + to_hours(CAST(floor(hour(ts) / 6) * 6 AS BIGINT)) AS slot
  FROM events),
ev2 AS (
  SELECT *, CASE event_type
    WHEN 'signup' THEN CASE k % 5 WHEN 0 THEN 'statecode' WHEN 1 THEN 'statuscode'
                                  WHEN 2 THEN 'ownerid' WHEN 3 THEN 'exchangerate'
                                  ELSE 'stepname' END
    WHEN 'click' THEN 'stepname'
    WHEN 'view' THEN CASE k % 5 WHEN 0 THEN 'statuscode' WHEN 1 THEN 'statecode'
                                WHEN 2 THEN 'msdyn_forecastcategory'
                                WHEN 3 THEN 'estimatedclosedate' ELSE 'actualclosedate' END
    WHEN 'purchase' THEN CASE k % 3 WHEN 0 THEN 'developproposal'
                                    WHEN 1 THEN 'the000g_revenuetype'
                                    ELSE 'purchaseprocess' END
    ELSE CASE k % 5 WHEN 0 THEN 'ownerid' WHEN 1 THEN 'customerid' WHEN 2 THEN 'exchangerate'
                    WHEN 3 THEN 'ExchangeRate' ELSE 'zz_unmapped' END END AS field
  FROM ev),
audit AS (
  SELECT event_id AS ingest_ord,
    'ITEM-' || lpad(CAST(user_id AS VARCHAR), 6, '0'){day} AS case_key,
    CASE WHEN event_type = 'signup' THEN 'Create' ELSE 'Update' END AS operation,
    field,
    CASE WHEN event_type <> 'signup' AND k % 3 > 0 THEN
      CASE WHEN field = 'stepname' THEN CASE (k + 1) % 3 WHEN 0 THEN '14-Qualify'
             WHEN 1 THEN '15-Develop' ELSE '16-Propose' END
           ELSE CAST(k % 5 AS VARCHAR) END END AS old_value,
    CASE field
      WHEN 'stepname' THEN CASE k % 6 WHEN 0 THEN '14-Qualify' WHEN 1 THEN '15-Develop'
             WHEN 2 THEN '16-Propose' WHEN 3 THEN '17-Close' WHEN 4 THEN 'Qualify' ELSE '' END
      WHEN 'statecode' THEN CAST(k % 4 AS VARCHAR)
      WHEN 'statuscode' THEN CAST(k % 7 AS VARCHAR)
      ELSE CAST(k AS VARCHAR) END AS new_value,
    'ACTOR-000' || CAST(k % 9 AS VARCHAR) AS actor,
    CASE event_id % 10
      WHEN 0 THEN strftime(slot, '%d/%m/%Y %H:%M')
      WHEN 1 THEN strftime(slot, '%Y/%m/%d %H:%M:%S')
      WHEN 2 THEN strftime(slot, '%d/%m/%Y %I:%M:%S %p')
      WHEN 3 THEN strftime(slot, '%d/%m/%Y %I:%M %p')
      WHEN 4 THEN strftime(slot, '%d/%m/%Y %H:%M:%S')
      WHEN 5 THEN strftime(slot, '%m/%d/%y %H:%M')
      WHEN 6 THEN strftime(slot, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 7 THEN strftime(slot, '%Y-%m-%dT%H:%M:%S+05:30')
      WHEN 8 THEN strftime(slot, '%Y-%m-%dT%H:%M:%S')
      ELSE CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'null' WHEN 2 THEN 'garbage'
                      ELSE '31/02/2024 10:00' END END AS logged_at,
    CASE event_id % 4 WHEN 0 THEN strftime(slot, '%d/%m/%Y %H:%M')
                      WHEN 1 THEN strftime(slot, '%d/%m/%y %H:%M')
                      WHEN 2 THEN strftime(slot, '%m/%d/%y %H:%M')
                      ELSE strftime(slot, '%-d/%-m/%y %H:%M') END AS logged_at_forensic
  FROM ev2)"""


def _format(column: str, pattern: str, fmt: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '{pattern}') "
        f"THEN try_strptime({column}, '{fmt}') END"
    )


_D, _M, _T = "[0-9]{1,2}", "[0-9]{1,2}", "[0-9]{1,2}:[0-9]{1,2}"
_ISO = "[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
_PIPELINE = "coalesce(" + ", ".join(
    [
        _format("logged_at", _ISO + "Z", "%Y-%m-%dT%H:%M:%SZ"),
        f"CASE WHEN regexp_full_match(logged_at, '{_ISO}[+]05:30') THEN "
        "try_strptime(left(logged_at, 19), '%Y-%m-%dT%H:%M:%S') "
        "- INTERVAL 330 MINUTE END",
        _format("logged_at", _ISO, "%Y-%m-%dT%H:%M:%S"),
        _format("logged_at", f"[0-9]{{4}}/{_M}/{_D} {_T}:[0-9]{{1,2}}", "%Y/%m/%d %H:%M:%S"),
        _format("logged_at", f"{_D}/{_M}/[0-9]{{4}} {_T}:[0-9]{{1,2}} [AP]M", "%d/%m/%Y %I:%M:%S %p"),
        _format("logged_at", f"{_D}/{_M}/[0-9]{{4}} {_T} [AP]M", "%d/%m/%Y %I:%M %p"),
        _format("logged_at", f"{_D}/{_M}/[0-9]{{4}} {_T}:[0-9]{{1,2}}", "%d/%m/%Y %H:%M:%S"),
        _format("logged_at", f"{_D}/{_M}/[0-9]{{4}} {_T}", "%d/%m/%Y %H:%M"),
        _format("logged_at", f"{_M}/{_D}/[0-9]{{2}} {_T}", "%m/%d/%y %H:%M"),
    ]
) + ")"
_DAY_FIRST = _format("logged_at", f"{_D}/{_M}/[0-9]{{4}} {_T}", "%d/%m/%Y %H:%M")
_FORENSIC = "coalesce(" + ", ".join(
    [
        _format("logged_at_forensic", f"{_D}/{_M}/[0-9]{{4}} {_T}", "%d/%m/%Y %H:%M"),
        _format("logged_at_forensic", f"{_D}/{_M}/[0-9]{{2}} {_T}", "%d/%m/%y %H:%M"),
        _format("logged_at_forensic", f"{_M}/{_D}/[0-9]{{2}} {_T}", "%m/%d/%y %H:%M"),
    ]
) + ")"

# Pipeline: all rows with ts; rows with a time; case sizes.
_TIMED = f"""
parsed AS (SELECT *, case_key AS case_id, {_PIPELINE} AS ts FROM audit),
timed AS (SELECT * FROM parsed WHERE ts IS NOT NULL),
sizes AS (SELECT case_id AS sized_id, count(*) AS size FROM timed GROUP BY case_id)"""
_UTC = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_utc"


def _local(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S') AS {column}"


_BUCKET = """CASE lower(field) WHEN 'statecode' THEN 'L1_STAGE' WHEN 'statuscode' THEN 'L1_STAGE'
  WHEN 'stepname' THEN 'L1_STAGE' WHEN 'msdyn_forecastcategory' THEN 'L1_STAGE'
  WHEN 'estimatedclosedate' THEN 'L1_STAGE' WHEN 'actualclosedate' THEN 'L1_STAGE'
  WHEN 'developproposal' THEN 'L2_MILESTONE' WHEN 'the000g_revenuetype' THEN 'L2_MILESTONE'
  WHEN 'purchaseprocess' THEN 'L2_MILESTONE' WHEN 'ownerid' THEN 'L3_ADMIN'
  WHEN 'customerid' THEN 'L3_ADMIN' WHEN 'exchangerate' THEN 'KILL_NOISE'
  ELSE 'UNKNOWN' END"""
_LEVEL = """CASE bucket WHEN 'L1_STAGE' THEN 'L1' WHEN 'L2_MILESTONE' THEN 'L2'
  WHEN 'L3_ADMIN' THEN 'L3' WHEN 'KILL_NOISE' THEN 'KILL' ELSE 'UNKNOWN' END"""
_LABEL = """CASE WHEN lower(field) = 'statecode' THEN
    CASE new_value WHEN '0' THEN 'Open' WHEN '1' THEN 'Won' WHEN '2' THEN 'Lost' ELSE new_value END
  WHEN lower(field) = 'statuscode' THEN
    CASE new_value WHEN '1' THEN 'In Progress' WHEN '2' THEN 'On Hold' WHEN '3' THEN 'Won'
      WHEN '4' THEN 'Canceled' WHEN '5' THEN 'Out-Sold' ELSE new_value END
  ELSE new_value END"""
_SEQUENCE = """CASE WHEN lower(field) = 'stepname' THEN
  TRY_CAST(nullif(regexp_extract(new_value, '^([0-9]+)-', 1), '') AS BIGINT) END"""


def _named(source: str) -> str:
    """Classified, translated and named rows of ``source`` without noise fields."""
    return f"""
bucketed AS (SELECT *, {_BUCKET} AS bucket FROM {source} WHERE field <> 'exchangerate'),
labelled AS (SELECT *, {_LEVEL} AS level, {_LABEL} AS translated_value,
    {_SEQUENCE} AS sequence FROM bucketed),
named AS (SELECT *, CASE
    WHEN bucket = 'L2_MILESTONE' AND field = 'developproposal' THEN field || ' completed'
    WHEN field = 'ownerid' THEN 'Owner changed'
    WHEN bucket = 'L3_ADMIN' THEN field || ' changed'
    ELSE field || ' → ' || translated_value END AS activity_name FROM labelled)"""


_MULTI = """
multi AS (SELECT timed.* FROM timed JOIN sizes ON case_id = sized_id WHERE size >= 2)"""
_COLLAPSED = """
creates AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY ts, ingest_ord) AS nr,
    min(sequence) OVER (PARTITION BY case_id) AS least FROM named WHERE operation = 'Create'),
collapsed AS (
  SELECT * EXCLUDE (nr, least, sequence, activity_name), 'Case Created' AS activity_name,
    CASE WHEN sequence IS NOT NULL THEN least END AS sequence, 0 AS later
  FROM creates WHERE nr = 1
  UNION ALL BY NAME
  SELECT *, 1 AS later FROM named WHERE operation <> 'Create')"""
_ORDER = """ts, CASE WHEN bucket = 'L1_STAGE' AND lower(field) = 'statuscode' THEN 0 ELSE 1 END,
  CASE WHEN sequence IS NULL THEN 1 ELSE 0 END, coalesce(sequence, 0), later, ingest_ord"""
_LOG = f"""
copies AS (SELECT *, row_number() OVER (PARTITION BY case_id, activity_name, ts
    ORDER BY {_ORDER}) AS copy FROM collapsed),
log AS (SELECT * EXCLUDE (copy) FROM copies WHERE copy = 1)"""

# Analyses: rows with a time, cases, rows of single-event cases.
_FORENSIC_ROWS = f"""
parsed AS (SELECT ingest_ord, case_key AS case_id, operation, field,
    coalesce(old_value, '') AS old_value, new_value, actor, logged_at_forensic,
    {_FORENSIC} AS ts FROM audit),
f AS (SELECT * FROM parsed WHERE ts IS NOT NULL),
sizes AS (SELECT case_id AS sized_id, count(*) AS size FROM f GROUP BY case_id),
singles AS (SELECT f.* FROM f JOIN sizes ON case_id = sized_id WHERE size = 1)"""
_STAGES = """
st AS (SELECT *, TRY_CAST(nullif(regexp_extract(new_value, '^([0-9]+)-', 1), '') AS BIGINT) AS prefix,
    regexp_replace(new_value, '^[0-9]+-', '') AS stage FROM f WHERE field = 'stepname'),
back AS (
  SELECT case_id, ts, ingest_ord, was AS from_stage, new_value AS to_stage FROM (
    SELECT *, lag(prefix) OVER w AS before, lag(new_value) OVER w AS was
    FROM st WHERE prefix IS NOT NULL
    WINDOW w AS (PARTITION BY case_id ORDER BY ts, ingest_ord))
  WHERE prefix < before)"""
_MOVES = """
moves AS (
  SELECT field, was AS from_value, new_value AS to_value, count(*) AS "count" FROM (
    SELECT field, new_value, lag(new_value) OVER w AS was, row_number() OVER w AS nr
    FROM f WHERE field IN ('stepname', 'statuscode', 'statecode', 'msdyn_forecastcategory',
                           'the000g_revenuetype')
    WINDOW w AS (PARTITION BY field, case_id ORDER BY ts, ingest_ord))
  WHERE nr > 1 GROUP BY field, was, new_value)"""
_CASES = """
cases AS (SELECT case_id, count(*) AS event_count, count(DISTINCT field) AS unique_fields,
    count(DISTINCT actor) AS unique_actors, min(ts) AS first_timestamp, max(ts) AS last_timestamp,
    CAST(printf('%.2f', CAST(date_diff('second', min(ts), max(ts)) AS DOUBLE) / 86400.0::DOUBLE)
         AS DOUBLE) AS duration_days,
    bool_or(operation = 'Create') AS has_create_event,
    min(ts) FILTER (operation = 'Create') AS create_timestamp,
    bool_or(field = 'stepname') AS has_stepname, bool_or(field = 'statuscode') AS has_statuscode,
    bool_or(field = 'statecode') AS has_statecode,
    bool_or(field = 'estimatedclosedate') AS has_estimatedclosedate,
    bool_or(field = 'actualclosedate') AS has_actualclosedate,
    count(*) FILTER (field = 'stepname') AS stepname_count,
    count(*) FILTER (field = 'ownerid') AS owner_changes,
    count(*) FILTER (field = 'the000g_revenuetype') AS revenue_type_changes,
    count(*) FILTER (field = 'msdyn_forecastcategory') AS forecast_changes
  FROM f GROUP BY case_id)"""


def _pct(part: str, whole: str) -> str:
    """Two decimals by the exact binary value."""
    return f"CAST(printf('%.2f', CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100) AS DOUBLE)"


_ROWS = "(SELECT count(*) FROM f)"
_ALL_CASES = "(SELECT count(DISTINCT case_id) FROM f)"
_SEMANTICS = f"""
sem AS (SELECT field, count(*) AS occurrence_count,
    {_pct("count(*)", _ROWS)} AS percentage_of_events,
    count(DISTINCT case_id) AS cases_affected,
    {_pct("count(DISTINCT case_id)", _ALL_CASES)} AS percentage_of_cases,
    count(DISTINCT old_value) AS unique_old_values,
    count(DISTINCT new_value) AS unique_new_values,
    count(*) FILTER (old_value = '') AS empty_old_count,
    count(*) FILTER (new_value = '') AS empty_new_count,
    CASE WHEN field = 'stepname' THEN bool_or(regexp_matches(new_value, '^[0-9]+-')) END
      AS has_prefix
  FROM f GROUP BY field),
noise AS (SELECT field, occurrence_count, percentage_of_cases FROM sem
  WHERE regexp_matches(lower(field), 'discount|base|currency|exchange|price|total')
    AND percentage_of_cases < 30)"""
_COVERAGE = f"""
cov AS (SELECT field, cases, case_pct, CASE WHEN case_pct > 50 THEN 'fields_above_50pct'
    WHEN case_pct > 25 THEN 'fields_25_to_50pct' WHEN case_pct > 10 THEN 'fields_10_to_25pct'
    ELSE 'fields_below_10pct' END AS band FROM (
  SELECT field, count(DISTINCT case_id) AS cases,
    CAST(count(DISTINCT case_id) AS DOUBLE) / CAST({_ALL_CASES} AS DOUBLE) * 100 AS case_pct
  FROM f GROUP BY field))"""
_OVERVIEW = f"""
heads AS (SELECT
    (SELECT count(*) FROM f) AS total_events,
    (SELECT count(*) FROM sizes) AS total_cases,
    (SELECT count(*) FROM singles) AS single_event_cases,
    (SELECT count(*) FROM singles WHERE operation = 'Create') AS single_event_creations,
    (SELECT count(DISTINCT actor) FROM f) AS total_actors,
    (SELECT count(DISTINCT field) FROM f) AS total_fields,
    CAST(floor(date_diff('second', min(ts), max(ts)) / 86400) AS BIGINT) AS timespan_days,
    {_local("min(ts)").replace(" AS min(ts)", " AS min_timestamp")},
    {_local("max(ts)").replace(" AS max(ts)", " AS max_timestamp")},
    count(*) FILTER (ts IS NULL) AS rows_dropped_invalid,
    CAST(printf('%.2f', (1 - CAST(count(*) FILTER (ts IS NULL) AS DOUBLE)
      / CAST(count(*) AS DOUBLE)) * 100) AS DOUBLE) AS parse_success_rate,
    (SELECT {_pct("count(prefix)", "count(*)")} FROM st) AS prefix_coverage,
    (SELECT count(*) FROM back) AS violation_count,
    (SELECT count(DISTINCT case_id) FROM back) AS violation_cases
  FROM parsed),
overview AS (SELECT *, {_pct("single_event_cases", "total_cases")} AS single_event_pct,
    single_event_cases - single_event_creations AS single_event_non_creations FROM heads)"""
_RANKED = "row_number() OVER (PARTITION BY {group} ORDER BY \"count\" DESC, {value}) AS rank"

# Buckets: all rows, unparsed, nulls as empty texts.
_CHARACTERISTICS = f"""
f AS (SELECT field, case_key AS case_id, coalesce(old_value, '') AS old_value, new_value
      FROM audit),
chars AS (SELECT field, count(*) AS total_occurrences,
    count(DISTINCT case_id) AS cases_affected,
    {_pct("count(DISTINCT case_id)", _ALL_CASES)} AS case_coverage_pct,
    count(DISTINCT new_value) AS unique_new_values,
    count(DISTINCT old_value) AS unique_old_values,
    {_pct("count(*) FILTER (trim(old_value) = '')", "count(*)")} AS empty_old_pct
  FROM f GROUP BY field),
suggested AS (SELECT *, CASE
    WHEN regexp_matches(lower(field),
      'discount|base|currency|exchange|price|calculation|error|skip|total')
      AND case_coverage_pct < 40 THEN 'KILL_NOISE'
    WHEN regexp_matches(lower(field),
      'stepname|stage|state|status|forecast|processid|closedate|probability') THEN 'L1_STAGE'
    WHEN regexp_matches(lower(field),
      'identify|confirm|develop|present|complete|capture|resolve|file|pursuit|decision|'
      || 'evaluate|proposal|feedback|review|debrief|purchase|contract|opportunity|revenue|'
      || 'type|influenced|adx_|gdpr|ordertype|rating')
      AND total_occurrences > 5 THEN 'L2_MILESTONE'
    WHEN regexp_matches(lower(field),
      'owner|customer|parent|account|contact|businessunit|workflow|participant') THEN 'L3_ADMIN'
    WHEN case_coverage_pct > 20 OR total_occurrences > 50 THEN 'L3_ADMIN'
    ELSE 'UNKNOWN' END AS suggested_bucket FROM chars)"""
_AUDIT_COLUMNS = ("case_key", "operation", "field", "old_value", "new_value", "actor", "logged_at")


def _cells(table: str, columns: tuple[str, ...]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {table}" for c in columns
    )
    return f"""
cells AS ({parts}),
profile AS (SELECT "column", count(*) AS total_rows, count(*) - count(value) AS null_count,
    count(*) FILTER (value = '') AS empty_string_count, count(value) AS non_null_count,
    count(DISTINCT value) AS unique_values FROM cells GROUP BY "column")"""


_FREQUENT = f"""
freq AS (SELECT "column", value, count(*) AS "count" FROM cells WHERE value IS NOT NULL
  GROUP BY "column", value),
ranked AS (SELECT *, {_RANKED.format(group='"column"', value='value')} FROM freq)"""


_ISO_WEEKS = """
WITH days AS (
  SELECT event_id, event_id % 8 AS form, CAST(ts AS TIMESTAMP) AS ts, isoyear(ts) AS year, weekofyear(ts) AS week,
    date_trunc('week', ts) AS monday, strftime(ts, '%H:%M:%S') AS clock,
    date_trunc('second', ts) - CAST(date_trunc('day', ts) AS TIMESTAMP) AS since FROM events),
texts AS (
  SELECT *, lpad(CAST(week AS VARCHAR), 2, '0') AS number, isodow(ts) AS day FROM days)
SELECT event_id, CASE form
    WHEN 0 THEN year || '-W' || number || '-' || day || 'T' || clock || 'Z'
    WHEN 1 THEN year || 'W' || number || day || ' ' || replace(clock, ':', '')
    WHEN 2 THEN year || '-W' || number
    WHEN 3 THEN year || 'W' || number || 'T' || clock || '+05:30'
    WHEN 4 THEN year || '-W' || number || '-' || left(clock, 5)
    WHEN 5 THEN year || '-W53-4'
    WHEN 6 THEN year || 'W' || number || '8'
    ELSE year || 'W' || number || day END AS logged_at,
  strftime(CASE form
    WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
    WHEN 2 THEN CAST(monday AS TIMESTAMP)
    WHEN 3 THEN CAST(monday AS TIMESTAMP) + since - INTERVAL 330 MINUTE
    WHEN 4 THEN CAST(monday AS TIMESTAMP) + to_hours(hour(ts)) + to_minutes(minute(ts))
    WHEN 5 THEN CASE WHEN weekofyear(make_date(year, 12, 28)) = 53
      THEN CAST(date_trunc('week', make_date(year, 1, 4)) AS TIMESTAMP) + to_days(52 * 7 + 3) END
    WHEN 6 THEN NULL ELSE CAST(date_trunc('day', ts) AS TIMESTAMP) END, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_utc
FROM texts"""
_BAD_LINES = """
  SELECT CASE WHEN ingest_ord % 97 = 0 THEN case_key || ',' || field || ',' || ingest_ord
      WHEN ingest_ord % 89 = 0 THEN line || ',surplus' ELSE '"open ' || line END AS line
  FROM (SELECT *, CASE WHEN ingest_ord % 2 = 0
      THEN concat_ws(',', case_key, operation, field, old, new_value, actor, logged_at, ingest_ord, note)
      ELSE concat_ws(',', ingest_ord, logged_at, old, new_value, field, operation, case_key, actor, note) END AS line
    FROM (SELECT *, coalesce(old_value, '') AS old, '"a ""b"", ' || ingest_ord || '"' AS note FROM audit))
  WHERE ingest_ord % 97 = 0 OR ingest_ord % 89 = 0 OR ingest_ord % 83 = 0"""


def oracle_sql() -> dict[str, str]:
    """Name to SQL."""

    def sql(select: str, *steps: str, grain: str = "day") -> str:
        return "WITH " + ",".join([_audit(grain), *steps]) + "\n" + select

    def timed(select: str, *steps: str) -> str:
        return sql(select, _TIMED, *steps)

    def report(select: str, *steps: str, grain: str = "day") -> str:
        return sql(select, _FORENSIC_ROWS, *steps, grain=grain)

    top = _RANKED.format
    in_log = (_MULTI, _named("multi"), _COLLAPSED, _LOG)
    placed = f"""
placed AS (SELECT *, row_number() OVER (PARTITION BY case_id, level ORDER BY {_ORDER}) AS event_pos
  FROM log WHERE level IN ('L1', 'L2', 'L3'))"""
    bands = """SELECT * FROM (
      SELECT '1_event' AS band, count(*) FILTER (event_count = 1) AS cases FROM cases
      UNION ALL SELECT '2_5_events', count(*) FILTER (event_count BETWEEN 2 AND 5) FROM cases
      UNION ALL SELECT '6_10_events', count(*) FILTER (event_count BETWEEN 6 AND 10) FROM cases
      UNION ALL SELECT '11_plus_events', count(*) FILTER (event_count >= 11) FROM cases)"""
    flags = ("stepname", "statuscode", "statecode", "estimatedclosedate", "actualclosedate")
    actor_counts = '(SELECT actor, count(*) AS "count" FROM f GROUP BY actor)'
    busiest = (
        '(SELECT actor, count(*) AS "count" FROM singles GROUP BY actor '
        'ORDER BY "count" DESC, actor LIMIT 1)'
    )
    hours = "date_diff('second', min(ts), max(ts))"
    found = {
        "audit_scan": sql(
            """SELECT ingest_ord, case_key, operation, field, coalesce(old_value, '') AS old_value,
              new_value, actor, CASE WHEN logged_at = 'null' THEN 'null' ELSE logged_at END
              AS logged_at, logged_at_forensic AS "Extra Note" FROM audit"""
        ),
        "audit_scan_csv": sql(
            """SELECT case_key, operation, field, coalesce(old_value, '') AS old_value, new_value, actor,
              CASE WHEN logged_at = 'null' THEN '' ELSE logged_at END AS logged_at,
              CAST(ingest_ord AS VARCHAR) AS event, 'a "b", ' || ingest_ord AS "Note"
              FROM audit WHERE ingest_ord % 97 <> 0 AND ingest_ord % 89 <> 0 AND ingest_ord % 83 <> 0"""
        ),
        "audit_bad_lines": sql(_BAD_LINES),
        "ts_parse_pipeline": timed(f"SELECT ingest_ord, logged_at, {_UTC} FROM parsed"),
        "ts_parse_forensic": report(
            f"SELECT ingest_ord, logged_at_forensic, {_local('ts')} FROM parsed"
        ),
        "ts_iso_weeks": _ISO_WEEKS,
        "ts_valid_rows": timed(f"SELECT ingest_ord, case_id, {_UTC} FROM timed"),
        "ts_drop_reasons": timed(
            """SELECT ingest_ord, logged_at, CASE WHEN logged_at IN ('', 'null')
              THEN 'DROP_TIMESTAMP_MISSING' ELSE 'DROP_TIMESTAMP_INVALID' END AS drop_reason
              FROM parsed WHERE ts IS NULL"""
        ),
        "utc_invalid_rows": sql(
            f"""SELECT ingest_ord, logged_at FROM audit
              WHERE NOT regexp_full_match(logged_at, '{_ISO}([.][0-9]+)?Z')"""
        ),
        "case_ids_normalized": sql(
            "SELECT ingest_ord, replace(case_key, '-', ' ') AS case_id FROM audit"
        ),
        "multi_event_rows": timed(
            f"""SELECT ingest_ord, case_key, operation, field, old_value, new_value, actor,
              logged_at, case_id, {_UTC} FROM multi""", _MULTI
        ),
        "single_event_rows": timed(
            f"""SELECT ingest_ord, case_key, operation, field, old_value, new_value, actor,
              logged_at, case_id, {_UTC} FROM timed JOIN sizes ON case_id = sized_id
              WHERE size = 1"""
        ),
        "kill_filtered": sql(
            """SELECT * EXCLUDE (logged_at_forensic) FROM audit
              WHERE field <> 'exchangerate'"""
        ),
        "bucketed_events": sql(
            f"""SELECT *, {_LEVEL} AS level FROM (
              SELECT * EXCLUDE (logged_at_forensic), {_BUCKET} AS bucket FROM audit)"""
        ),
        "bucket_counts": timed(
            """SELECT bucket, level, count(*) AS "rows" FROM named GROUP BY bucket, level""",
            _MULTI, _named("multi"),
        ),
        "translated_events": sql(
            f"SELECT * EXCLUDE (logged_at_forensic), {_LABEL} AS translated_value FROM audit"
        ),
        "sequence_numbers": sql(
            f"""SELECT * EXCLUDE (logged_at_forensic),
              CAST({_SEQUENCE} AS VARCHAR) AS sequence FROM audit"""
        ),
        "activity_names": timed(
            """SELECT ingest_ord, bucket, level, translated_value,
              CAST(sequence AS VARCHAR) AS sequence, activity_name FROM named""", _named("timed")
        ),
        "create_aggregated": timed(
            f"""SELECT case_id, ingest_ord, operation, activity_name, level,
              CAST(sequence AS VARCHAR) AS sequence, {_UTC} FROM collapsed""", _named("timed"), _COLLAPSED
        ),
        "canonical_event_order": timed(
            f"""SELECT case_id, row_number() OVER (PARTITION BY case_id ORDER BY {_ORDER})
              AS event_pos, activity_name, ingest_ord, {_UTC} FROM collapsed""",
            _named("timed"), _COLLAPSED,
        ),
        "deduplicated_events": timed(
            f"SELECT case_id, activity_name, ingest_ord, {_UTC} FROM log",
            _named("timed"), _COLLAPSED, _LOG,
        ),
        "event_log": timed(
            f"""SELECT ingest_ord, case_key, operation, field, old_value, new_value, actor,
              logged_at, case_id, bucket, level, translated_value,
              CAST(sequence AS VARCHAR) AS sequence, activity_name, {_UTC},
              row_number() OVER (PARTITION BY case_id ORDER BY {_ORDER}) AS event_pos
              FROM log""", *in_log
        ),
        "events_by_level": timed(
            """SELECT level, count(*) AS events, count(DISTINCT case_id) AS cases
              FROM placed GROUP BY level""", *in_log, placed
        ),
        "xes_traces": timed(
            f"SELECT level, case_id, event_pos, activity_name, {_UTC} FROM placed",
            *in_log, placed,
        ),
        "pipeline_step_counts": timed(
            """SELECT 'rows_loaded' AS step, count(*) AS "rows" FROM audit
              UNION ALL SELECT 'rows_with_time', count(*) FROM timed
              UNION ALL SELECT 'cases_removed', count(*) FROM sizes WHERE size = 1
              UNION ALL SELECT 'rows_multi_event', count(*) FROM multi
              UNION ALL SELECT 'rows_without_noise', count(*) FROM named
              UNION ALL SELECT 'rows_with_sequence', count(sequence) FROM named
              UNION ALL SELECT 'distinct_activities', count(DISTINCT activity_name) FROM named
              UNION ALL SELECT 'rows_creates_collapsed', count(*) FROM collapsed
              UNION ALL SELECT 'rows_deduplicated', count(*) FROM log""", *in_log
        ),
        "case_metrics": report(
            f"""SELECT * REPLACE ({_local("first_timestamp")}, {_local("last_timestamp")},
              {_local("create_timestamp")}) FROM cases""", _CASES
        ),
        "case_size_bands": report(bands, _CASES),
        "case_size_bands_by_user": report(bands, _CASES, grain="user"),
        "case_duration_stats": report(
            """SELECT min(duration_days) AS min_days, max(duration_days) AS max_days,
              avg(duration_days) AS mean_days, median(duration_days) AS median_days,
              count(*) FILTER (duration_days = 0) AS zero_duration_cases FROM cases""",
            _CASES, grain="user",
        ),
        "case_field_presence": report(
            " UNION ALL ".join(
                f"SELECT 'has_{n}' AS flag, count(*) FILTER (has_{n}) AS cases FROM cases"
                for n in flags
            ), _CASES,
        ),
        "field_semantics": report("SELECT * FROM sem", _SEMANTICS),
        "field_operations": report(
            'SELECT field, operation, count(*) AS "count" FROM f GROUP BY field, operation'
        ),
        "field_top_values": report(
            f"""SELECT * FROM (SELECT *, {top(group="field", value="new_value")} FROM (
              SELECT field, new_value, count(*) AS "count" FROM f GROUP BY field, new_value))
              WHERE rank <= 5"""
        ),
        "field_coverage_bands": report("SELECT * FROM cov", _COVERAGE, grain="user"),
        "actor_behavior": report(
            f"""SELECT actor, count(*) AS event_count, {_pct("count(*)", _ROWS)}
              AS percentage_of_events, count(DISTINCT case_id) AS cases_handled,
              {_pct("count(DISTINCT case_id)", _ALL_CASES)} AS percentage_of_cases,
              count(DISTINCT field) AS unique_fields_modified,
              strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS first_activity,
              strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_activity,
              CAST(floor({hours} / 86400) AS BIGINT) AS activity_span_days
              FROM f GROUP BY actor"""
        ),
        "actor_operations": report(
            'SELECT actor, operation, count(*) AS "count" FROM f GROUP BY actor, operation'
        ),
        "actor_top_fields": report(
            f"""SELECT * FROM (SELECT *, {top(group="actor", value="field")} FROM (
              SELECT actor, field, count(*) AS "count" FROM f GROUP BY actor, field))
              WHERE rank <= 5"""
        ),
        "actor_concentration": report(
            f"""SELECT {_pct('max("count")', _ROWS)} AS top_1_actor_pct,
              {_pct(f'(SELECT sum("count") FROM (SELECT "count" FROM {actor_counts} '
                    'ORDER BY "count" DESC LIMIT 3))', _ROWS)} AS top_3_actors_pct,
              count(*) AS total_actors FROM {actor_counts}"""
        ),
        "stage_order": report(
            """SELECT prefix, arg_min(stage, (case_id, ts, ingest_ord)) AS stage,
              count(*) AS "count" FROM st WHERE prefix IS NOT NULL GROUP BY prefix""",
            _STAGES, grain="user",
        ),
        "stepname_totals": report(
            f"""SELECT count(*) AS total_stepname_changes,
              count(DISTINCT case_id) AS cases_with_stepname,
              count(prefix) AS prefix_coverage_count,
              {_pct("count(prefix)", "count(*)")} AS prefix_coverage_pct FROM st""",
            _STAGES, grain="user",
        ),
        "stage_violations": report(
            f"SELECT * REPLACE ({_local('ts')}) FROM back", _STAGES, grain="user"
        ),
        "stage_violation_summary": report(
            """SELECT count(*) AS violation_count, count(DISTINCT case_id) AS cases_affected
              FROM back""", _STAGES, grain="user"
        ),
        "transition_counts": report("SELECT * FROM moves", _MOVES, grain="user"),
        "transition_totals": report(
            """SELECT field, CAST(sum("count") AS BIGINT) AS total_transitions,
              count(*) AS unique_transitions FROM moves GROUP BY field""", _MOVES, grain="user"
        ),
        "top_transitions": report(
            f"""SELECT * FROM (SELECT *, {top(group="field", value="from_value, to_value")}
              FROM moves) WHERE rank <= 10""", _MOVES, grain="user"
        ),
        "ts_format_distribution": report(
            """SELECT CASE WHEN contains(logged_at_forensic, '/202') THEN 'DD/MM/YYYY HH:MM'
              WHEN length(split_part(logged_at_forensic, '/', 1)) = 1
                OR length(split_part(logged_at_forensic, '/', 2)) = 1 THEN 'D/M/YY HH:MM'
              ELSE 'other' END AS shape, count(*) AS "count" FROM f GROUP BY shape"""
        ),
        "timestamp_summary": timed(
            f"""SELECT count(ts) AS rows_after_parse, count(*) - count(ts) AS rows_dropped_invalid,
              strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS min_timestamp,
              strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS max_timestamp,
              CAST(floor({hours} / 86400) AS BIGINT) AS timespan_days FROM parsed"""
        ),
        "temporal_hour": report(
            """SELECT CAST(hour(ts) AS INTEGER) AS "hour", count(*) AS "count"
              FROM f GROUP BY ALL"""
        ),
        "temporal_weekday": report(
            'SELECT dayname(ts) AS day_name, count(*) AS "count" FROM f GROUP BY ALL'
        ),
        "temporal_month": report(
            """SELECT CAST(month(ts) AS INTEGER) AS "month", count(*) AS "count"
              FROM f GROUP BY ALL"""
        ),
        "temporal_daily_volume": report(
            """SELECT avg(n) AS mean_per_day, max(n) AS max_per_day, min(n) AS min_per_day
              FROM (SELECT count(*) AS n FROM f GROUP BY CAST(ts AS DATE))"""
        ),
        "temporal_shares": report(
            f"""SELECT {_pct("count(*) FILTER (isodow(ts) >= 6)", "count(*)")}
              AS weekend_activity_pct,
              {_pct("count(*) FILTER (hour(ts) BETWEEN 9 AND 17)", "count(*)")}
              AS business_hours_pct FROM f"""
        ),
        "single_event_fields": report(
            f"""SELECT field, count(*) AS "count",
              {_pct("count(*)", "(SELECT count(*) FROM singles)")} AS percentage_of_single_events,
              arg_min(new_value, (case_id, ts, ingest_ord)) AS sample_value,
              arg_min(actor, (case_id, ts, ingest_ord)) AS sample_actor
              FROM singles GROUP BY field"""
        ),
        "single_event_actors": report(
            'SELECT actor, count(*) AS "count" FROM singles GROUP BY actor'
        ),
        "single_event_operations": report(
            'SELECT operation, count(*) AS "count" FROM singles GROUP BY operation'
        ),
        "single_event_summary": report(
            f"""SELECT count(*) AS total_cases, {_pct("count(*)", _ALL_CASES)}
              AS percentage_of_cases, count(*) AS total_events,
              count(*) > 0 AND bool_and(operation = 'Create') AS is_creation_driven,
              count(*) FILTER (operation = 'Create') AS creation_count,
              count(*) FILTER (operation <> 'Create') AS non_creation_count,
              (SELECT "count" FROM {busiest}) AS top_actor,
              (SELECT actor FROM {busiest}) AS top_actor_name,
              count(DISTINCT actor) AS unique_actors FROM singles"""
        ),
        "single_event_samples": report(
            f"""SELECT case_id, operation, field, new_value, actor, {_local("ts")} FROM (
              SELECT * FROM singles ORDER BY case_id LIMIT 10)"""
        ),
        "single_event_hypotheses": report(
            """SELECT count(*) FILTER (field = 'the000g_revenuetype') > 0
                AND count(*) FILTER (operation = 'Create') = 0 AS abandoned_opportunities,
              count(*) FILTER (field = 'ownerid') > 0 AND count(DISTINCT actor) <= 2
                AS bulk_assignment,
              count(*) FILTER (operation = 'Create') BETWEEN 1 AND count(*) - 1
                AS incomplete_audit_trail,
              count(*) > 0 AND count(*) FILTER (operation = 'Create') = count(*) AS creation_only
              FROM singles"""
        ),
        "bulk_dates": report(
            """SELECT strftime(ts, '%Y-%m-%d') AS "date", count(*) AS "count" FROM singles
              GROUP BY ALL HAVING count(*) > 5"""
        ),
        "recent_single_event": sql(
            f"""SELECT case_id, {_local("ts")}, operation, field, new_value, actor FROM (
              SELECT *, count(*) OVER (PARTITION BY case_id) AS size FROM (
                SELECT *, case_key AS case_id, {_DAY_FIRST} AS ts FROM audit)
              WHERE ts IS NOT NULL QUALIFY size = 1 ORDER BY ts DESC, case_id LIMIT 10)"""
        ),
        "creation_summary": report(
            """SELECT count(*) AS total_create_events,
              count(DISTINCT case_id) AS cases_with_create,
              CAST(printf('%.2f', CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT case_id) AS DOUBLE))
                AS DOUBLE) AS create_events_per_case FROM f WHERE operation = 'Create'"""
        ),
        "creation_fields": report(
            """SELECT field, count(*) AS "count" FROM f WHERE operation = 'Create'
              GROUP BY field ORDER BY "count" DESC, field LIMIT 20"""
        ),
        "creation_actors": report(
            """SELECT actor, count(*) AS "count" FROM f WHERE operation = 'Create'
              GROUP BY actor ORDER BY "count" DESC, actor LIMIT 10"""
        ),
        "master_overview": report(
            "SELECT * FROM overview", _STAGES, _OVERVIEW, grain="user"
        ),
        "high_signal_fields": report(
            """SELECT field, case_pct FROM cov WHERE case_pct > 50 AND field IN ('stepname',
              'statuscode', 'statecode', 'msdyn_forecastcategory', 'ownerid',
              'estimatedclosedate', 'the000g_revenuetype')""", _COVERAGE, grain="user"
        ),
        "noise_candidates": report("SELECT * FROM noise", _SEMANTICS),
        "pipeline_recommendations": report(
            """SELECT 'timestamp_handler' AS setting, CASE WHEN rows_dropped_invalid > 0
                THEN 'dual_format_required' ELSE 'single_format' END AS value FROM overview
              UNION ALL SELECT 'case_filtering',
                CASE WHEN 100 * single_event_cases > 20 * total_cases
                THEN 'filter_2plus_events_recommended' ELSE 'keep_all_cases' END FROM overview
              UNION ALL SELECT 'sequence_tiebreaker', CASE WHEN prefix_coverage > 90
                THEN 'prefix_primary_with_timestamp_fallback' ELSE 'timestamp_only' END
                FROM overview""", _STAGES, _OVERVIEW, grain="user"
        ),
        "bucket_strategy": report(
            """SELECT 'L1_STAGE' AS bucket, unnest(['stepname', 'statecode', 'statuscode',
                'msdyn_forecastcategory']) AS field
              UNION ALL SELECT 'L3_ADMIN', unnest(['ownerid', 'owningbusinessunit', 'customerid',
                'estimatedclosedate', 'actualclosedate', 'closeprobability', 'new_contractterm',
                'pricelevelid'])
              UNION ALL SELECT 'L2_MILESTONE', field FROM cov
                WHERE band = 'fields_25_to_50pct' AND regexp_matches(field,
                  'proposal|develop|qualify|identify|complete|review|decision')
              UNION ALL SELECT 'KILL_NOISE', field FROM noise""",
            _SEMANTICS, _COVERAGE,
        ),
        "column_profile": sql(
            """SELECT profile.*, CASE WHEN "column" = 'ingest_ord' THEN 'bigint' ELSE 'string' END AS dtype,
              low AS "min", high AS "max", middle AS mean FROM profile LEFT JOIN (
                SELECT 'ingest_ord' AS name, CAST(min(ingest_ord) AS DOUBLE) AS low,
                  CAST(max(ingest_ord) AS DOUBLE) AS high, avg(ingest_ord) AS middle FROM audit) ON name = "column" """,
            _cells("audit", (*_AUDIT_COLUMNS, "ingest_ord", "logged_at_forensic")),
        ),
        "column_profile_typed": "WITH " + _cells(
            "events", ("event_id", "ts", "user_id", "event_type", "value", "props")
        ) + """,
numbers AS (
  SELECT 'event_id' AS "column", 'bigint' AS dtype, CAST(min(event_id) AS DOUBLE) AS "min",
    CAST(max(event_id) AS DOUBLE) AS "max", avg(event_id) AS mean FROM events
  UNION ALL SELECT 'user_id', 'bigint', min(user_id), max(user_id), avg(user_id) FROM events
  UNION ALL SELECT 'ts', 'timestamp_ntz', NULL, NULL, NULL
  UNION ALL SELECT 'value', 'double', min(value), max(value), avg(value) FROM events)
SELECT profile.*, coalesce(dtype, 'string') AS dtype, "min", "max", round(mean, 4) AS mean
FROM profile LEFT JOIN numbers USING ("column")""",
        "date_profile": sql(
            f"""SELECT 'logged_at' AS "column",
              strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS min_timestamp,
              strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS max_timestamp,
              count(*) - count(ts) AS parse_failure_count FROM (
              SELECT {_DAY_FIRST} AS ts FROM audit)"""
        ),
        "value_frequencies": sql(
            f"""SELECT "column", value, "count" AS frequency,
              {_pct('"count"', "(SELECT count(*) FROM audit)")} AS percentage, rank
              FROM ranked WHERE rank <= 20""",
            _cells("audit", (*_AUDIT_COLUMNS, "ingest_ord", "logged_at_forensic")), _FREQUENT,
        ),
        "field_characteristics": sql("SELECT * FROM chars", _CHARACTERISTICS),
        "bucket_suggestions": sql("SELECT * FROM suggested", _CHARACTERISTICS),
        "field_characteristics_values": sql(
            """SELECT field, kind, value, "count", row_number() OVER (
                PARTITION BY field, kind ORDER BY "count" DESC, value) AS rank
              FROM (SELECT field, 'operation' AS kind, operation AS value, count(*) AS "count"
                  FROM audit GROUP BY ALL
                UNION ALL SELECT field, 'new_value', new_value, count(*)
                  FROM audit WHERE new_value IS NOT NULL GROUP BY ALL)
              QUALIFY kind = 'operation' OR rank <= 5"""
        ),
        "suggested_bucket_fields": sql(
            """SELECT suggested_bucket, row_number() OVER (PARTITION BY suggested_bucket
                ORDER BY total_occurrences DESC, field) AS place,
              field, total_occurrences, case_coverage_pct, cases_affected FROM suggested""",
            _CHARACTERISTICS,
        ),
        "suggested_bucket_counts": sql(
            "SELECT suggested_bucket, count(*) AS fields FROM suggested GROUP BY ALL",
            _CHARACTERISTICS,
        ),
    }
    in_table = (*in_log, "f AS (SELECT * FROM log)")
    found["case_metrics_of_table"] = timed(
        f"""SELECT * REPLACE ({_local("first_timestamp")}, {_local("last_timestamp")},
          {_local("create_timestamp")}) FROM cases""", *in_table, _CASES)
    found["stage_violations_of_table"] = timed(f"SELECT * REPLACE ({_local('ts')}) FROM back", *in_table, _STAGES)
    # The same rows by other ways.
    found["xes_read_back"] = found["xes_traces"]
    found["case_metrics_csv"] = found["case_metrics"]
    found["value_frequencies_csv"] = (
        # A reader of the file takes an empty cell for a null.
        f"SELECT * EXCLUDE (rank) REPLACE (nullif(value, '') AS value) FROM ({found['value_frequencies']})")
    found["event_log_of_sources"] = (
        f"SELECT * EXCLUDE (ingest_ord) REPLACE (coalesce(old_value, '') AS old_value) FROM ({found['event_log']})")
    found["cleaned_log"] = found["event_log"]
    found["removed_cases"] = found["single_event_rows"]
    found["pipeline_step_metrics"] = f"SELECT * FROM ({found['pipeline_step_counts']}) WHERE step <> 'distinct_activities'"
    by_day = {
        "transition_totals": report(
            """SELECT field, CAST(sum("count") AS BIGINT) AS total_transitions,
              count(*) AS unique_transitions FROM moves GROUP BY field""", _MOVES),
        "top_transitions": report(
            f"""SELECT * FROM (SELECT *, {top(group="field", value="from_value, to_value")}
              FROM moves) WHERE rank <= 10""", _MOVES),
    }
    documents = {
        "creation_patterns": {
            "creation_summary": ("creation_summary", "total_create_events, cases_with_create, create_events_per_case"),
            "creation_fields": ("creation_fields", "field, count"),
            "creation_actors": ("creation_actors", "actor, count"),
        },
        "transition_matrix": {
            "transition_totals": ("transition_totals", "field, total_transitions, unique_transitions"),
            "top_transitions": ("top_transitions", "field, from_value, to_value, count, rank"),
        },
        "temporal_counts": {
            "temporal_hour": ("temporal_hour", "hour, count"),
            "temporal_weekday": ("temporal_weekday", "day_name, count"),
            "temporal_month": ("temporal_month", "month, count"),
        },
    }
    found["report_documents"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS name, '{{' || {" || ',' || ".join(
            _json_array(part, (found | by_day)[key], columns) for part, (key, columns) in parts.items())} || '}}'
            AS value""" for name, parts in documents.items())
    return found


def _json_array(name: str, query: str, columns: str) -> str:
    """The rows of a query as a JSON array, sorted by their columns."""
    return f"""'"{name}":[' || (SELECT coalesce(string_agg(CAST(to_json(r) AS VARCHAR), ',' ORDER BY r), '')
      FROM (SELECT {{{", ".join(f"'{c}': {c}" for c in columns.replace(" ", "").split(","))}}} AS r
        FROM ({query}))) || ']'"""
