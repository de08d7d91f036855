"""Independent SQL for the registered queries, as run by DuckDB on the same tables."""

from __future__ import annotations

# --- shared tables ----------------------------------------------------------------------

MAPPED = """mapped AS (
  SELECT CAST(ts AS DATE) AS snapshot_date,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS snapshot_order,
         'operations_snapshot_' || CAST(ts AS DATE) || '.xlsx' AS source_file,
         event_type AS source_sheet,
         CAST(list_position(['error', 'signup', 'purchase', 'view', 'click'], event_type) AS INTEGER)
           AS sheet_order,
         event_id + 2 AS source_row_number,
         'LINE-' || user_id AS line_id,
         (event_id % 97) || '.0' AS request_id,
         CASE WHEN event_id % 13 <> 0 THEN event_type END AS current_stage,
         CASE WHEN event_id % 17 <> 0 THEN CAST(floor(value / 10) - 10 AS INTEGER) END
           AS sla_days_remaining,
         CASE WHEN event_id % 11 = 0 THEN NULL
              WHEN event_id % 7 = 0 THEN 'no date'
              WHEN event_id % 19 = 0 THEN '31/12 - carried'
              WHEN event_id % 23 = 0 THEN '31/02/2024 - bad'
              WHEN event_id % 29 = 0 THEN '10/02 - planned'
              WHEN event_id % 31 = 0
                THEN day(ts) || '-' || month(ts) || '-' || lpad(CAST(year(ts) % 100 AS VARCHAR), 2, '0') || ' short year'
              WHEN event_id % 37 = 0 THEN '29/02 - leap day'
              WHEN event_id % 41 = 0 THEN '29/02/2023 - no such day'
              WHEN event_id % 43 = 0 THEN '1/1/999 - three digits'
              WHEN event_id % 47 = 0 THEN '01-01-2300 - out of range'
              ELSE strftime(CAST(ts AS DATE) - CAST(event_id % 6 AS INTEGER), '%d/%m/%Y') || ' - reviewed'
         END AS follow_up_notes
  FROM events)"""

_NEWEST = """snapshot_date DESC NULLS FIRST, snapshot_order DESC NULLS FIRST,
           sheet_order DESC NULLS FIRST, source_row_number DESC NULLS FIRST"""

DAILY = f"""daily AS (
  SELECT * FROM mapped
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, line_id ORDER BY {_NEWEST}) = 1)"""


def follow_up(source: str) -> str:
    """Tables that find the note date of ``source`` and age it."""
    pattern = r"\b(\d{1,2})[/-](\d{1,2})(?:[/-](\d{2,4}))?\b"
    return f"""noted AS (
  SELECT *, regexp_extract(follow_up_notes, '{pattern}', 1) AS dd,
         regexp_extract(follow_up_notes, '{pattern}', 2) AS mm,
         regexp_extract(follow_up_notes, '{pattern}', 3) AS yy
  FROM {source}),
dated AS (
  SELECT *, CASE WHEN yy = '' THEN year(snapshot_date)
                 WHEN CAST(yy AS INTEGER) < 100 THEN CAST(yy AS INTEGER) + 2000
                 ELSE CAST(yy AS INTEGER) END AS yr
  FROM (SELECT * REPLACE (CASE WHEN dd <> '' THEN yy END AS yy) FROM noted)),
named AS (
  SELECT *, TRY_CAST(lpad(CAST(yr AS VARCHAR), 4, '0') || '-' || lpad(mm, 2, '0') || '-'
                     || lpad(dd, 2, '0') AS DATE) AS this_year,
         TRY_CAST(lpad(CAST(yr - 1 AS VARCHAR), 4, '0') || '-' || lpad(mm, 2, '0') || '-'
                  || lpad(dd, 2, '0') AS DATE) AS last_year
  FROM dated),
followed AS (
  SELECT * EXCLUDE (dd, mm, yy, yr, this_year, last_year, chosen),
         CASE WHEN chosen BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN chosen END
           AS follow_up_date,
         CAST(date_diff('day', follow_up_date, snapshot_date) AS INTEGER) AS follow_up_age_days
  FROM (SELECT *, CASE WHEN yy = '' AND this_year > snapshot_date + 31 THEN last_year
                       ELSE this_year END AS chosen FROM named))"""


HASH = """substr(md5(concat_ws(chr(31), coalesce(current_stage, '<NA>'),
             coalesce(follow_up_notes, '<NA>'), coalesce(line_id, '<NA>'),
             coalesce(request_id, '<NA>'), coalesce(CAST(sla_days_remaining AS VARCHAR), '<NA>'))),
           1, 16)"""

DERIVED = follow_up("daily") + f""",
derived AS (SELECT *, {HASH} AS record_hash FROM followed)"""

CURRENT = f"""ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY line_id ORDER BY {_NEWEST}) AS INTEGER)
    AS position_rank
  FROM derived),
placed AS (SELECT * FROM ranked WHERE position_rank = 1)"""

DIRTY = """shifts AS (SELECT unnest([0, 1000000]) AS shift),
raw AS (
  SELECT CAST(ts AS DATE) AS snapshot_date,
         'operations_snapshot_' || CAST(ts AS DATE) || '.xlsx' AS source_file,
         event_type AS source_sheet,
         CAST(list_position(['error', 'signup', 'purchase', 'view', 'click'], event_type) AS INTEGER)
           AS sheet_order,
         event_id + 2 + shift AS source_row_number,
         event_id % 101 = 0 AS blank_row,
         CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '   '
              WHEN event_id % 83 = 0 THEN chr(160) || chr(8195)
              ELSE 'LINE-' || user_id END AS line_id,
         CASE WHEN event_id % 19 = 0 THEN '-' WHEN event_id % 23 = 0 THEN 'R-' ELSE '' END || (event_id % 97)
           || CASE WHEN event_id % 29 = 0 THEN '.05' WHEN event_id % 3 = 0 THEN '.000' ELSE '.0' END AS request_id,
         CASE WHEN event_id % 13 = 0 THEN NULL
              WHEN event_id % 3 = 0 THEN chr(9) || ' ' || event_type || ' ' || chr(9)
              WHEN event_id % 7 = 0 THEN chr(160) || event_type || chr(12288) || chr(133)
              ELSE event_type END AS current_stage,
         CASE WHEN event_id % 17 = 0 THEN 'n/a' WHEN event_id % 31 = 0 THEN '1,000'
              WHEN event_id % 43 = 0 THEN '5d' WHEN event_id % 47 = 0 THEN '2.5'
              WHEN event_id % 59 = 0 THEN '+5' WHEN event_id % 61 = 0 THEN '1e1' WHEN event_id % 67 = 0 THEN '.5'
              WHEN event_id % 71 = 0 THEN '7.' WHEN event_id % 73 = 0 THEN '-12.00'
              ELSE CAST(CAST(floor(value / 10) - 10 AS INTEGER) AS VARCHAR) END AS sla_days_remaining,
         CASE WHEN event_id % 53 = 0 THEN 'x'
              WHEN event_id % 5 = 0 THEN strftime(CAST(ts AS DATE), '%d/%m/%Y')
              ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS start_date,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS snapshot_order
  FROM events JOIN shifts ON shift = 0 OR event_id % 10 = 0),
dirty AS (
  SELECT * EXCLUDE (blank_row) REPLACE (
           CASE WHEN NOT blank_row THEN line_id END AS line_id,
           CASE WHEN NOT blank_row THEN request_id END AS request_id,
           CASE WHEN NOT blank_row THEN current_stage END AS current_stage,
           CASE WHEN NOT blank_row THEN sla_days_remaining END AS sla_days_remaining,
           CASE WHEN NOT blank_row THEN start_date END AS start_date)
  FROM raw)"""


_SPACE = r"[\s\x{85}\x{a0}\x{2003}\x{3000}]"  # of the white space that strips, what the rows hold


def _trimmed(column: str) -> str:
    return rf"nullif(regexp_replace({column}, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '')"


_NUMBER = """CASE WHEN regexp_full_match({0}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
               AND TRY_CAST({0} AS DOUBLE) = floor(TRY_CAST({0} AS DOUBLE))
             THEN CAST(TRY_CAST({0} AS DOUBLE) AS BIGINT) END""".format(_trimmed("sla_days_remaining"))
_DATE = """coalesce(CAST(try_strptime({0}, '%Y-%m-%d') AS DATE),
                  CAST(try_strptime({0}, '%d/%m/%Y') AS DATE))""".format(_trimmed("start_date"))
_REQUEST = rf"regexp_replace({_trimmed('request_id')}, '^(-?[0-9]+)\.0+$', '\1')"
_NOT_BLANK = "coalesce(line_id, request_id, current_stage, sla_days_remaining, start_date) IS NOT NULL"

TYPED = f"""typed AS (
  SELECT * REPLACE (
           {_trimmed('line_id')} AS line_id,
           {_REQUEST} AS request_id,
           {_trimmed('current_stage')} AS current_stage,
           {_NUMBER} AS sla_days_remaining,
           {_DATE} AS start_date),
         {_NOT_BLANK} AS filled
  FROM dirty)"""

_CONTENT = """snapshot_date, source_file, source_sheet, sheet_order, line_id, request_id,
           current_stage, sla_days_remaining, start_date, snapshot_order"""

CLEAN = f"""clean AS (
  SELECT {_CONTENT}, max(source_row_number) AS source_row_number
  FROM typed WHERE filled AND line_id IS NOT NULL
  GROUP BY ALL)"""

SHEET_METRICS = f"""sheet_metrics AS (
  SELECT source_file, source_sheet, count(*) AS raw_rows,
         count(*) FILTER (filled AND line_id IS NULL) AS rows_without_id,
         count(*) FILTER (filled AND line_id IS NOT NULL) AS with_id
  FROM typed GROUP BY ALL),
clean_metrics AS (
  SELECT m.source_file, m.source_sheet, raw_rows, rows_without_id,
         with_id - coalesce(c.n, 0) AS exact_duplicates, coalesce(c.n, 0) AS clean_rows
  FROM sheet_metrics m
  LEFT JOIN (SELECT source_file, source_sheet, count(*) AS n FROM clean GROUP BY ALL) c
    ON c.source_file = m.source_file AND c.source_sheet = m.source_sheet)"""

RUN_METRICS = f"""kept AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, line_id ORDER BY {_NEWEST}) = 1),
run_metrics AS (
  SELECT (SELECT count(DISTINCT source_file) FROM dirty) AS files_discovered,
         (SELECT count(DISTINCT source_file) FROM dirty) AS files_processed,
         (SELECT count(*) FROM clean_metrics) AS sheets_processed,
         (SELECT count(*) FROM dirty) AS records_read,
         (SELECT count(*) FROM clean) AS records_after_cleaning,
         (SELECT count(*) FROM kept) AS records_in_history,
         (SELECT CAST(sum(rows_without_id) AS BIGINT) FROM clean_metrics) AS rows_without_id_removed,
         (SELECT CAST(sum(exact_duplicates) AS BIGINT) FROM clean_metrics) AS exact_duplicates_removed,
         (SELECT count(*) FROM clean) - (SELECT count(*) FROM kept) AS daily_duplicates_removed)"""


def issues(source: str) -> str:
    """Issue rows of the rules over ``source``."""
    rules = (
        ("NULL_PROCESS_ID", "error", "History rows without a process id.", "count(*) FILTER (line_id IS NULL)"),
        ("INVALID_SNAPSHOT_DATE", "error", "History rows without a snapshot date.", "count(*) FILTER (snapshot_date IS NULL)"),
        ("FUTURE_FOLLOW_UP_DATE", "warning", "Follow-up dates after the snapshot date.", "count(*) FILTER (follow_up_age_days < 0)"),
        ("INVALID_SLA_VALUE", "warning", "Rows without a readable number of service-level days.", "count(*) FILTER (sla_days_remaining IS NULL)"),
        ("MISSING_FOLLOW_UP", "info", "Rows without follow-up notes.", "count(*) FILTER (follow_up_notes IS NULL)"),
    )
    parts = [
        f"SELECT '{code}' AS code, '{severity}' AS severity, '{message}' AS message, {count} AS n FROM {source}"
        for code, severity, message, count in rules
    ]
    parts.append(
        "SELECT 'DUPLICATE_DAILY_PROCESS', 'error', 'Processes with several rows on one snapshot date.', "
        "coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM "
        f"{source} GROUP BY snapshot_date, line_id HAVING count(*) > 1)"
    )
    union = "\n  UNION ALL ".join(parts)
    return f"found AS (\n  {union}),\nissues AS (SELECT code, severity, message, CAST(n AS BIGINT) AS count FROM found WHERE n > 0)"


def canonical(label: str) -> str:
    return f"trim(regexp_replace(upper(strip_accents({label})), '[^A-Z0-9]+', '_', 'g'), '_')"


SITE_PATHS = """site_events AS (
  SELECT *, CAST(ts AS DATE) AS day, CAST(CAST(ts AS DATE) AS VARCHAR) AS iso,
         strftime(ts, '%d.%m.%Y') AS dotted, 'site' || user_id || 's_' AS site FROM events),
site_rows AS (
  SELECT * EXCLUDE (plain),
         '/drop/' || CASE user_id % 7 WHEN 3 THEN '_' WHEN 5 THEN '.' ELSE '' END || 'area' || (user_id % 7) || '/'
         || CASE user_id % 10 WHEN 4 THEN '_' || plain
                 WHEN 8 THEN '.operations_' || substr(plain, position('site' IN plain)) ELSE plain END AS path
  FROM (SELECT *, CASE (user_id + day(day)) % 9
           WHEN 0 THEN 'Operations_' || site || iso || '.xlsx'
           WHEN 1 THEN 'operations_' || site || dotted || '.xlsm'
           WHEN 2 THEN 'snapshot_' || site || strftime(ts, '%d_%m_%Y') || '.xlsx'
           WHEN 3 THEN 'operations_' || site || '31-02-2024.xlsx'
           WHEN 4 THEN 'operations_' || site || 'latest.xlsx'
           WHEN 5 THEN '~$operations_' || site || iso || '.xlsx'
           WHEN 6 THEN 'operations_' || site || iso || '.csv'
           WHEN 7 THEN 'operations_' || site || '1' || iso || '.xlsx'
           ELSE 'operations_' || site || '2024-13-05 ' || dotted || '.xlsx' END AS plain
        FROM site_events))"""

_YEAR_FIRST = "'(?:^|[^0-9])([0-9]{4})[-_.]([0-9]{1,2})[-_.]([0-9]{1,2})(?:$|[^0-9])'"
_DAY_FIRST = "'(?:^|[^0-9])([0-9]{1,2})[-_.]([0-9]{1,2})[-_.]([0-9]{4})(?:$|[^0-9])'"


def _name_date(pattern: str, year: int, day: int) -> str:
    pieces = [
        f"lpad(regexp_extract(stem, {pattern}, {group}), {width}, '0')"
        for group, width in ((year, 4), (2, 2), (day, 2))
    ]
    return f"TRY_CAST({' || chr(45) || '.join(pieces)} AS DATE)"


FILE_DATES = f"""stems AS (
  SELECT *, parse_filename(path) AS source_file, parse_filename(path, true) AS stem FROM site_rows),
file_dates AS (
  SELECT *, CASE WHEN regexp_matches(stem, {_YEAR_FIRST}) THEN {_name_date(_YEAR_FIRST, 1, 3)}
                 WHEN regexp_matches(stem, {_DAY_FIRST}) THEN {_name_date(_DAY_FIRST, 3, 1)}
            END AS snapshot_date
  FROM stems)"""

FILES = """files AS (
  SELECT DISTINCT path, source_file, snapshot_date FROM file_dates
  WHERE (source_file LIKE '%.xlsx' OR source_file LIKE '%.xlsm') AND NOT starts_with(source_file, '~$')),
numbered AS (
  SELECT *, CAST(row_number() OVER (ORDER BY snapshot_date, lower(source_file), path) AS INTEGER)
    AS snapshot_order
  FROM files WHERE snapshot_date IS NOT NULL)"""

BOOKS = f"""books AS (
  SELECT DISTINCT 'site' || user_id || '_' || CAST(ts AS DATE) || '.xlsx' AS source_file,
         CASE WHEN event_id % 11 = 0 THEN 'Notes ' || (event_id % 3)
              WHEN event_id % 5 = 0 THEN ' ' || upper(event_type) || '! '
              ELSE event_type END AS sheet
  FROM events),
keyed AS (SELECT *, {canonical('sheet')} AS sheet_key FROM books),
expected AS (
  SELECT unnest(['error', 'signup', 'purchase', 'view', 'click']) AS source_sheet,
         unnest([1, 2, 3, 4, 5]) AS sheet_order)"""

HEADERS = f"""header_sheets AS (
  SELECT 'site' || user_id || '_' || CAST(ts AS DATE) || '.xlsx' AS source_file,
         event_type AS source_sheet, min(event_id) AS event_id
  FROM events GROUP BY ALL),
header_cells AS (
  SELECT source_file, source_sheet, unnest(
           ['Line Id', 'Request Id', 'Situação', 'SLA Days']
           || CASE WHEN event_id % 3 = 0 THEN ['LINE-ID'] ELSE [] END
           || CASE WHEN event_id % 7 = 0 THEN ['situacao ', 'Status'] ELSE [] END) AS header
  FROM header_sheets),
header_keys AS (SELECT source_file, source_sheet, {canonical('header')} AS header_key FROM header_cells)"""

SITE_DIRTY = """site_dirty AS (
  SELECT * REPLACE (coalesce(trim(line_id), 'none') || '_' || source_file AS source_file) FROM dirty),
fills AS (
  SELECT source_file, source_sheet, count(line_id) AS line_id, count(request_id) AS request_id,
         count(current_stage) AS current_stage, count(sla_days_remaining) AS sla_days_remaining,
         count(start_date) AS start_date
  FROM site_dirty GROUP BY source_file, source_sheet)"""

WORKBOOKS = """book_rows AS (
  SELECT '/drop/operations_' || CAST(ts AS DATE) || '_part' || (event_id // 20000) || '.xlsx' AS path,
         CAST(ts AS DATE) AS day, event_id, event_type,
         CAST(row_number() OVER sheet + 1 + count(*) FILTER (event_id % 50 = 0) OVER sheet
              - CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS INTEGER) AS source_row_number,
         'LINE-' || user_id AS line_id, CAST(event_id % 97 AS VARCHAR) AS request_id,
         CASE WHEN event_id % 13 <> 0 THEN event_type END AS stage,
         CAST(floor(value / 10) - 10 AS BIGINT) AS sla,
         CASE WHEN event_id % 31 = 0 THEN CAST(ts AS DATE) - 3 END AS note_cell_date,
         strftime(ts, '%d/%m') || ' - reviewed' AS note
  FROM events
  WINDOW sheet AS (PARTITION BY CAST(ts AS DATE), event_id // 20000, event_type ORDER BY event_id))"""

WORKBOOK_HISTORY = f"""book_files AS (
  SELECT path, day, row_number() OVER (ORDER BY day, lower(parse_filename(path)), path) AS snapshot_order
  FROM (SELECT DISTINCT path, day FROM book_rows)),
book_clean AS (
  SELECT r.day AS snapshot_date, CAST(f.snapshot_order AS INTEGER) AS snapshot_order,
         parse_filename(r.path) AS source_file, r.event_type AS source_sheet,
         CAST(list_position(['error', 'signup', 'purchase', 'view', 'click'], r.event_type) AS INTEGER)
           AS sheet_order,
         line_id, request_id, stage AS current_stage, sla AS sla_days_remaining,
         CASE WHEN sla < 0 THEN 'OVERDUE' ELSE 'ON TIME' END AS sla_status,
         CASE WHEN note_cell_date IS NULL THEN note ELSE CAST(note_cell_date AS VARCHAR) END
           AS follow_up_notes,
         r.day AS start_date, note_cell_date, max(source_row_number) AS source_row_number
  FROM book_rows r JOIN book_files f ON f.path = r.path
  GROUP BY ALL),
book_daily AS (
  SELECT * FROM book_clean
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, line_id ORDER BY {_NEWEST}) = 1)"""


BROKEN = """broken AS (
  SELECT * REPLACE (CASE WHEN source_row_number % 37 <> 0 THEN line_id END AS line_id,
                    CASE WHEN source_row_number % 59 <> 0 THEN snapshot_date END AS snapshot_date)
  FROM followed)"""

FLAWED = """flawed AS (
  SELECT CAST(ts AS DATE) AS day, day(ts) % 6 AS flaw, event_type, event_id,
         CASE WHEN day(ts) % 6 = 5 THEN 'late' || dayofyear(ts) || '_part' || (event_id // 20000) || '.xlsx'
              ELSE 'operations_' || CAST(ts AS DATE) || '_part' || (event_id // 20000) || '.xlsx' END AS source_file
  FROM events),
flaw_files AS (SELECT source_file, flaw, list(DISTINCT event_type) AS kinds FROM flawed GROUP BY ALL),
flaw_issues AS (
  SELECT 'SNAPSHOT_DATE_NOT_FOUND' AS code, 'warning' AS severity, CAST(1 AS BIGINT) AS count, source_file,
         CAST(NULL AS VARCHAR) AS source_sheet FROM flaw_files WHERE flaw = 5
  UNION ALL SELECT 'WORKBOOK_READ_FAILED', 'error', 1, source_file, NULL FROM flaw_files WHERE flaw = 0
  UNION ALL SELECT 'UNEXPECTED_SHEETS', 'info', 2, source_file, NULL FROM flaw_files WHERE flaw = 2
  UNION ALL SELECT 'MISSING_WORKSHEET', 'error', 1, source_file, kind
  FROM flaw_files, (SELECT unnest(['error', 'signup', 'purchase', 'view', 'click']) AS kind)
  WHERE flaw NOT IN (0, 5) AND (NOT list_contains(kinds, kind) OR (flaw = 1 AND kind = 'view'))
  UNION ALL SELECT 'WORKSHEET_CONTRACT_FAILED', 'error', 1, source_file,
                   upper(event_type[1]) || substr(event_type, 2)
  FROM flawed WHERE flaw NOT IN (0, 5) AND NOT (flaw = 1 AND event_type = 'view')
  GROUP BY source_file, event_type, flaw HAVING flaw = 3 OR count(*) FILTER (WHERE event_id % 13 <> 0) = 0)"""


def _with(*tables: str, select: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n" + select


_SUMMARY = """SELECT snapshot_date, source_file, source_sheet, count(*) AS record_count,
  count(DISTINCT line_id) AS unique_processes FROM daily GROUP BY ALL"""
_RAW_ISSUES = (MAPPED, follow_up("mapped"), issues("followed"))
_CLEANED = (DIRTY, TYPED, CLEAN, SHEET_METRICS)

ORACLE: dict[str, str] = {
    # cleaning
    "canonical_label": f"""SELECT event_id, {canonical('label')} AS label FROM (
  SELECT event_id, CASE
           WHEN event_id % 4 = 0 THEN '  Área  ' || event_type || chr(10)
           WHEN event_id % 3 = 0 THEN 'Follow-up ' || event_type || ' (situação) ' || (event_id % 9)
           WHEN event_id % 5 = 0 THEN '--Über__' || event_type || chr(9) || '#é'
           ELSE event_type || ' ' || (event_id % 100) END AS label FROM events)""",
    "drop_blank_rows": _with(DIRTY, select=f"SELECT * FROM dirty WHERE {_NOT_BLANK}"),
    "trim_text": _with(
        DIRTY,
        select=rf"""SELECT snapshot_date, source_row_number,
  regexp_replace(current_stage, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS current_stage FROM dirty""",
    ),
    "blank_to_null": _with(
        DIRTY,
        select=rf"""SELECT snapshot_date, source_row_number,
  CASE WHEN NOT regexp_full_match(line_id, '{_SPACE}*') THEN line_id END AS line_id FROM dirty""",
    ),
    "identifier": _with(
        DIRTY,
        select=f"SELECT snapshot_date, source_row_number, {_REQUEST} AS request_id FROM dirty",
    ),
    "numeric_coerce": _with(
        DIRTY,
        select=f"SELECT snapshot_date, source_row_number, {_NUMBER} AS sla_days_remaining FROM dirty",
    ),
    "date_coerce": _with(
        DIRTY,
        select=f"SELECT snapshot_date, source_row_number, {_DATE} AS start_date FROM dirty",
    ),
    "date_by_worksheet": """WITH rows AS (
  SELECT CAST(ts AS DATE) AS day, event_id, event_type, CAST(CAST(ts AS DATE) - CAST(event_id % 40 AS INTEGER) AS DATE) AS start,
    (dayofyear(CAST(ts AS DATE)) + list_position(['error', 'signup', 'purchase', 'view', 'click'], event_type)
      + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) % 3 AS style FROM events
), written AS (
  SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'soon' WHEN style = 0 THEN strftime(start, '%d/%m/%Y')
    WHEN style = 1 THEN strftime(start, '%m/%d/%Y') ELSE strftime(start, '%Y-%m-%d') END AS text FROM rows
), fitted AS (
  SELECT *, CAST(try_strptime(text, '%d/%m/%Y') AS DATE) AS a, CAST(try_strptime(text, '%m/%d/%Y') AS DATE) AS b,
    CAST(try_strptime(text, '%Y-%m-%d') AS DATE) AS c FROM written
), votes AS (
  SELECT day, event_type, count(a) AS na, count(b) AS nb, count(c) AS nc FROM fitted GROUP BY ALL
)
SELECT day AS snapshot_date, event_id + 2 AS source_row_number,
  CASE WHEN na >= nb AND na >= nc THEN a WHEN nb >= nc THEN b ELSE c END AS start_date
FROM fitted JOIN votes USING (day, event_type)""",
    "drop_null_ids": _with(
        DIRTY, TYPED, select="SELECT * EXCLUDE (filled) FROM typed WHERE line_id IS NOT NULL"
    ),
    "exact_dedup": _with(
        DIRTY,
        select=f"SELECT {_CONTENT}, max(source_row_number) AS source_row_number FROM dirty GROUP BY ALL",
    ),
    "clean_metrics": _with(*_CLEANED, select="SELECT * FROM clean_metrics"),
    "clean": _with(DIRTY, TYPED, CLEAN, select="SELECT * FROM clean"),
    "sla_bucket": _with(
        MAPPED,
        select="""SELECT snapshot_date, source_row_number,
  CASE WHEN sla_days_remaining < 0 THEN 'Overdue' WHEN sla_days_remaining <= 7 THEN '0 to 7 Days'
       WHEN sla_days_remaining <= 15 THEN '8 to 15 Days'
       WHEN sla_days_remaining <= 25 THEN '16 to 25 Days'
       WHEN sla_days_remaining IS NOT NULL THEN '26 to 35 Days' END AS sla_bucket FROM mapped""",
    ),
    "sla_status": _with(
        MAPPED,
        select="""SELECT snapshot_date, source_row_number,
  CASE WHEN sla_days_remaining < 0 THEN 'OVERDUE' WHEN sla_days_remaining >= 0 THEN 'ON TIME' END
    AS sla_status FROM mapped""",
    ),
    # history
    "daily_state": _with(MAPPED, DAILY, select="SELECT * FROM daily"),
    "follow_up_date": _with(
        MAPPED,
        follow_up("mapped"),
        select="SELECT snapshot_date, source_row_number, follow_up_date FROM followed",
    ),
    "follow_up_age": _with(
        MAPPED,
        follow_up("mapped"),
        select="SELECT snapshot_date, source_row_number, follow_up_age_days FROM followed",
    ),
    "record_hash": _with(
        MAPPED, select=f"SELECT snapshot_date, source_row_number, {HASH} AS record_hash FROM mapped"
    ),
    "derived": _with(MAPPED, DAILY, DERIVED, select="SELECT * FROM derived"),
    "latest_position": _with(
        MAPPED, DAILY, DERIVED, CURRENT, select="SELECT * EXCLUDE (position_rank) FROM placed"
    ),
    "summary": _with(MAPPED, DAILY, select=_SUMMARY),
    "union_snapshots": _with(
        MAPPED,
        select=""" SELECT * EXCLUDE (current_stage) FROM mapped WHERE source_sheet = 'error'
UNION ALL BY NAME SELECT * EXCLUDE (follow_up_notes) FROM mapped WHERE source_sheet = 'signup'
UNION ALL BY NAME SELECT * EXCLUDE (line_id) FROM mapped WHERE source_sheet = 'purchase'
UNION ALL BY NAME SELECT * EXCLUDE (request_id) FROM mapped WHERE source_sheet = 'view'
UNION ALL BY NAME SELECT * EXCLUDE (sla_days_remaining) FROM mapped WHERE source_sheet = 'click'""",
    ),
    "daily_state_orders": """SELECT * EXCLUDE (o_orderdate), CAST(o_orderdate AS DATE) AS snapshot_date
FROM orders QUALIFY o_orderkey = max(o_orderkey) OVER (PARTITION BY CAST(o_orderdate AS DATE), o_custkey)""",
    "latest_position_orders": """SELECT * EXCLUDE (o_orderdate), CAST(o_orderdate AS DATE) AS snapshot_date
FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1""",
    # analytics
    "q1_processes_by_date": _with(
        MAPPED,
        DAILY,
        select="""SELECT snapshot_date, count(DISTINCT line_id) AS unique_processes
FROM daily GROUP BY snapshot_date""",
    ),
    "q2_current_position": _with(MAPPED, DAILY, DERIVED, CURRENT, select="SELECT * FROM placed"),
    "q3_overdue_by_stage": _with(
        MAPPED,
        DAILY,
        DERIVED,
        CURRENT,
        select="""SELECT ifnull(current_stage, 'NO STAGE') AS current_stage, count(*) AS overdue_processes
FROM placed WHERE sla_days_remaining < 0 GROUP BY 1""",
    ),
    "q4_stale_follow_ups": _with(
        MAPPED,
        DAILY,
        DERIVED,
        CURRENT,
        select="""SELECT line_id, request_id, current_stage, follow_up_date, follow_up_age_days
FROM placed WHERE follow_up_age_days > 3""",
    ),
    "q5_state_changes": _with(
        MAPPED,
        DAILY,
        DERIVED,
        select="""SELECT snapshot_date, line_id, current_stage FROM derived
QUALIFY record_hash <> lag(record_hash) OVER (
  PARTITION BY line_id ORDER BY snapshot_date, snapshot_order, sheet_order, source_row_number)""",
    ),
    # quality
    "rule_issues": _with(MAPPED, DAILY, DERIVED, issues("derived"), select="SELECT * FROM issues"),
    "rule_duplicate_daily": _with(
        MAPPED,
        select="""SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS n FROM mapped GROUP BY snapshot_date, line_id) WHERE n > 1""",
    ),
    "severity_totals": _with(
        *_RAW_ISSUES,
        select="SELECT severity, CAST(sum(count) AS BIGINT) AS issue_count FROM issues GROUP BY severity",
    ),
    "run_metrics": _with(*_CLEANED, RUN_METRICS, select="SELECT * FROM run_metrics"),
    "quality_report": _with(
        *_CLEANED,
        RUN_METRICS,
        *_RAW_ISSUES,
        select="""SELECT CASE WHEN (SELECT count(*) FROM issues WHERE severity = 'error') = 0
         THEN 'passed' ELSE 'failed' END AS status, run_metrics.*,
       (SELECT CAST(coalesce(sum(count), 0) AS BIGINT) FROM issues WHERE severity = 'error') AS errors,
       (SELECT CAST(coalesce(sum(count), 0) AS BIGINT) FROM issues WHERE severity = 'warning') AS warnings,
       (SELECT string_agg(code || ':' || severity || ':' || count, ' ' ORDER BY code) FROM issues)
         AS issue_totals
FROM run_metrics""",
    ),
    "blocking_issues": _with(MAPPED, follow_up("mapped"), BROKEN, issues("broken"), select="SELECT * FROM issues"),
    "gate_status": _with(
        MAPPED, DAILY, DERIVED.replace("followed", "derived_followed").replace("noted", "n2").replace("dated", "d2").replace("named", "m2"),
        follow_up("mapped"), BROKEN, issues("broken"),
        select="""SELECT 'broken' AS rows, CAST(coalesce(sum(count), 0) AS BIGINT) AS errors,
  CASE WHEN coalesce(sum(count), 0) = 0 THEN 'yes' ELSE 'no' END AS publishes FROM issues WHERE severity = 'error'
UNION ALL
SELECT 'resolved', CAST(0 AS BIGINT), 'yes' WHERE EXISTS (SELECT 1 FROM derived)
  AND NOT EXISTS (SELECT 1 FROM derived WHERE line_id IS NULL OR snapshot_date IS NULL)
  AND (SELECT count(*) FROM derived) = (SELECT count(*) FROM (SELECT DISTINCT snapshot_date, line_id FROM derived))""",
    ),
    "source_issues": _with(FLAWED, select="SELECT * FROM flaw_issues"),
    "empty_history_issues": _with(
        MAPPED,
        select="""SELECT code, 'error' AS severity, CAST(1 AS BIGINT) AS count
FROM (VALUES ('EMPTY_HISTORY'), ('NO_INPUT_FILES'), ('OUTPUT_CONTRACT_FAILED')) AS codes(code)
WHERE code = 'OUTPUT_CONTRACT_FAILED' OR NOT EXISTS (SELECT 1 FROM mapped WHERE snapshot_date < DATE '2024-01-01')""",
    ),
    "published_history": _with(MAPPED, DAILY, DERIVED, select="SELECT * FROM derived"),
    "published_latest_position": _with(
        MAPPED, DAILY, DERIVED, CURRENT, select="SELECT * EXCLUDE (position_rank) FROM placed"
    ),
    "published_summary": _with(MAPPED, DAILY, select=_SUMMARY),
    "published_csv": _with(MAPPED, DAILY, select=_SUMMARY),
    "published_issues": _with(MAPPED, DAILY, DERIVED, issues("derived"), select="SELECT code, severity, count FROM issues"),
    "added_days_history": _with(MAPPED, DAILY, DERIVED, select="SELECT * FROM derived"),
    "added_days_latest_position": _with(
        MAPPED, DAILY, DERIVED, CURRENT, select="SELECT * EXCLUDE (position_rank) FROM placed"
    ),
    "added_days_summary": _with(MAPPED, DAILY, select=_SUMMARY),
    "lower_case_names": "SELECT * FROM customer",
    "job_result": _with(
        *_CLEANED,
        RUN_METRICS,
        MAPPED,
        DAILY,
        DERIVED,
        issues("derived"),
        select=f"""SELECT (SELECT count(*) FROM daily) AS history_rows, (SELECT count(DISTINCT line_id) FROM daily) AS latest_position_rows,
  (SELECT count(*) FROM ({_SUMMARY})) AS summary_rows, (SELECT count(*) FROM issues) AS issues_rows,
  CAST(1 AS BIGINT) AS report_rows, run_metrics.* FROM run_metrics""",
    ),
    "published_report": _with(
        *_CLEANED,
        RUN_METRICS,
        *_RAW_ISSUES,
        select="""SELECT CASE WHEN (SELECT count(*) FROM issues WHERE severity = 'error') = 0
         THEN 'passed' ELSE 'failed' END AS status, run_metrics.*,
       (SELECT CAST(coalesce(sum(count), 0) AS BIGINT) FROM issues WHERE severity = 'error') AS errors,
       (SELECT CAST(coalesce(sum(count), 0) AS BIGINT) FROM issues WHERE severity = 'warning') AS warnings,
       (SELECT CAST(sum(count) AS BIGINT) FROM issues) AS issue_count
FROM run_metrics""",
    ),
    # sources and contract
    "src_discover": _with(SITE_PATHS, FILE_DATES, FILES, select="SELECT * FROM files"),
    "snapshot_date_from_name": _with(
        SITE_PATHS, FILE_DATES, select="SELECT event_id, snapshot_date FROM file_dates"
    ),
    "snapshot_order": _with(SITE_PATHS, FILE_DATES, FILES, select="SELECT * FROM numbered"),
    "undated_files": _with(
        SITE_PATHS,
        FILE_DATES,
        FILES,
        select="SELECT path, source_file FROM files WHERE snapshot_date IS NULL",
    ),
    "lineage": _with(
        SITE_PATHS,
        FILE_DATES,
        FILES,
        select="""SELECT r.path, upper(r.event_type) AS sheet_key, r.event_id + 2 AS source_row_number,
       'LINE-' || r.user_id AS line_id, n.snapshot_date, n.snapshot_order, n.source_file,
       r.event_type AS source_sheet,
       list_position(['error', 'signup', 'purchase', 'view', 'click'], r.event_type) AS sheet_order
FROM site_rows r JOIN numbered n ON n.path = r.path""",
    ),
    "sheet_collisions": _with(
        BOOKS,
        select="""SELECT source_file, sheet_key, string_agg(sheet, '|' ORDER BY sheet) AS colliding_sheets
FROM keyed GROUP BY ALL HAVING count(*) > 1""",
    ),
    "missing_sheets": _with(
        BOOKS,
        select="""SELECT f.source_file, e.source_sheet, e.sheet_order
FROM (SELECT DISTINCT source_file FROM books) f CROSS JOIN expected e
WHERE NOT EXISTS (SELECT 1 FROM keyed k
                  WHERE k.source_file = f.source_file AND k.sheet_key = upper(e.source_sheet))""",
    ),
    "unexpected_sheets": _with(
        BOOKS,
        select="""SELECT source_file, CAST(count(*) AS INTEGER) AS sheet_count,
       string_agg(sheet, '|' ORDER BY sheet_key, sheet) AS worksheets
FROM keyed WHERE sheet_key NOT IN (SELECT upper(source_sheet) FROM expected) GROUP BY source_file""",
    ),
    "header_collisions": _with(
        HEADERS,
        select="""SELECT source_file, source_sheet, string_agg(header_key, '|' ORDER BY header_key)
         AS colliding_columns
FROM (SELECT source_file, source_sheet, header_key FROM header_keys GROUP BY ALL HAVING count(*) > 1)
GROUP BY source_file, source_sheet""",
    ),
    "column_fill": _with(
        DIRTY,
        SITE_DIRTY,
        select="""SELECT * FROM (UNPIVOT fills
ON line_id, request_id, current_stage, sla_days_remaining, start_date
INTO NAME column_name VALUE filled_cells)""",
    ),
    "contract_failures": _with(
        DIRTY,
        SITE_DIRTY,
        select="""SELECT source_file, source_sheet, concat_ws('|',
  CASE WHEN current_stage = 0 THEN 'current_stage' END, CASE WHEN line_id = 0 THEN 'line_id' END,
  CASE WHEN request_id = 0 THEN 'request_id' END,
  CASE WHEN sla_days_remaining = 0 THEN 'sla_days_remaining' END,
  CASE WHEN start_date = 0 THEN 'start_date' END) AS missing_columns
FROM fills WHERE missing_columns <> ''""",
    ),
    "read_workbooks": _with(
        WORKBOOKS,
        select="""SELECT path, upper(event_type) AS sheet_key, source_row_number, line_id, request_id,
  CASE WHEN stage IS NOT NULL THEN ' ' || stage END AS current_stage,
  CAST(sla AS VARCHAR) AS sla_days_remaining,
  CASE WHEN sla < 0 THEN 'OVERDUE' ELSE 'ON TIME' END AS sla_status,
  CASE WHEN note_cell_date IS NULL THEN note ELSE CAST(note_cell_date AS VARCHAR) END AS follow_up_notes,
  CAST(day AS VARCHAR) AS start_date, note_cell_date FROM book_rows""",
    ),
    "read_failures": _with(
        WORKBOOKS, select="SELECT DISTINCT path FROM book_rows WHERE day(day) % 5 = 0"
    ),
    "history_from_workbooks": _with(
        WORKBOOKS,
        WORKBOOK_HISTORY,
        follow_up("book_daily"),
        select="""SELECT * EXCLUDE (note_cell_date)
  REPLACE (coalesce(note_cell_date, follow_up_date) AS follow_up_date,
           CAST(date_diff('day', coalesce(note_cell_date, follow_up_date), snapshot_date) AS INTEGER)
             AS follow_up_age_days),
  substr(md5(concat_ws(chr(31), coalesce(current_stage, '<NA>'), coalesce(follow_up_notes, '<NA>'),
    line_id, request_id, CAST(sla_days_remaining AS VARCHAR), sla_status,
    CAST(start_date AS VARCHAR))), 1, 16) AS record_hash
FROM followed""",
    ),
}
