"""The registered queries as SQL for DuckDB, over the same tables."""

from __future__ import annotations

from checks.fixtures import LEGACY_CHECK, OPEN_YEARS_CHECK, PIVOT_YEARS, PORTAL_CHECK, SOURCE_NAMES, WORKBOOK_CHECK
from tallyport.config import CONTINENTS, MONTHS, REPORT_COLUMNS, SOURCE_RULES, Profile
from tallyport.plans import institution_statistics as plan


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)


def _cases(expression: str, cases) -> str:
    return "CASE " + " ".join(f"WHEN {expression.format(k)} THEN {v}" for k, v in cases) + " END"


MONTH_NAME = _cases("month = {}", ((i, _text(m)) for i, m in enumerate(MONTHS, 1)))
MONTH_FULL = f"lpad(CAST(month AS VARCHAR), 2, '0') || ' - ' || {MONTH_NAME}"
SHORT_MONTH = f"substr({MONTH_NAME}, 1, 3) || lpad(CAST(year % 100 AS VARCHAR), 2, '0')"
CLASS = _cases("source_name LIKE {}", ((_text(p), _text(label)) for p, label in SOURCE_RULES))

TABLES = f"""
usage_log AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_name END AS user_name,
         c_nationkey AS institution_id,
         CASE WHEN c_nationkey = 0 THEN 'ADMIN_GROUP' WHEN c_nationkey = 23 THEN NULL ELSE n_name END AS group_name,
         list_extract([{_list(SOURCE_NAMES)}], CAST(1 + p_partkey % 14 AS INT)) AS source_name,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS request_type,
         CAST(l_quantity AS INT) AS n_codes,
         o_orderdate AS requested_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey),
institution AS (
  SELECT n_nationkey AS institution_id,
         CASE WHEN n_nationkey = 24 THEN NULL WHEN n_nationkey = 3 THEN 'Nation 3, North ' ELSE n_name END
           AS institution_name
  FROM nation),
account AS (
  SELECT c_custkey AS user_id, created_s, access_s
  FROM (SELECT o_custkey, MIN(CAST(epoch(o_orderdate) AS BIGINT)) AS created_s,
               MAX(CASE WHEN o_orderkey % 7 <> 0 THEN CAST(epoch(o_orderdate) AS BIGINT) ELSE 0 END) AS access_s
        FROM orders GROUP BY o_custkey) o RIGHT JOIN customer ON o_custkey = c_custkey),
account_role AS (
  SELECT c_custkey AS user_id, 'authenticated' AS role FROM customer
  UNION ALL SELECT c_custkey, 'subscriber' FROM customer WHERE c_custkey % 2 = 0),
account_institution AS (
  SELECT c_custkey AS user_id, c_nationkey AS institution_id FROM customer
  UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25 FROM customer WHERE c_custkey % 10 = 0),
account_status AS (
  SELECT c_custkey AS user_id,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Student' WHEN 'MACHINERY' THEN 'PhD'
              WHEN 'FURNITURE' THEN 'Administration' ELSE 'Researcher' END AS status
  FROM customer WHERE c_acctbal >= 0
  UNION ALL SELECT c_custkey + 1000000, 'Researcher' FROM customer WHERE c_custkey % 50 = 0)"""


def _relations(profile: Profile) -> str:
    """The cleaned relations of a profile as CTEs, following the portal's own SELECTs."""
    if profile.years is not None:
        in_years = f"year(requested_at) IN ({_list(profile.years)})"
    elif profile.first_year is not None:
        in_years = f"year(requested_at) >= {profile.first_year}"
    else:
        in_years = "TRUE"
    named = "AND group_name IS NOT NULL AND i.institution_name IS NOT NULL" if profile.require_institution else ""
    return f"""{TABLES},
usage AS (
  SELECT *, {MONTH_NAME} AS month2 FROM (
    SELECT DISTINCT user_id AS id_user, user_name, l.institution_id AS id_labo, institution_name,
           CAST(year(requested_at) AS INT) AS year, CAST(month(requested_at) AS INT) AS month,
           source_name AS database_name, request_type AS type_interrogation, n_codes AS nb_codes,
           requested_at AS date_heure_extraction,
           CASE request_type WHEN 1 THEN 'prévisualisation' WHEN 2 THEN 'téléchargement'
                WHEN 3 THEN 'téléchargement' END AS type_interrogation2,
           {CLASS} AS database_name2,
           CASE WHEN source_name LIKE '%histo%' THEN 'Search_Code' ELSE 'Extract_Data' END AS code_ou_data
    FROM usage_log l LEFT JOIN institution i ON l.institution_id = i.institution_id
    WHERE {in_years} AND group_name NOT IN ({_list(profile.excluded_groups)}) {named}
      AND user_id NOT IN ({_list(profile.excluded_users)}))),
subscription AS (
  SELECT *, CAST(year(date_created) AS INT) AS date_create_year,
         CAST(year(date_last_access) AS INT) AS date_last_access_year
  FROM (
    SELECT DISTINCT a.user_id AS id_user, institution_name AS labo_name,
           CAST(make_timestamp(created_s * 1000000) AS DATE) AS date_created,
           CAST(make_timestamp(access_s * 1000000) AS DATE) AS date_last_access, status AS statut
    FROM account a LEFT JOIN account_role r ON r.user_id = a.user_id
         LEFT JOIN account_institution ai ON ai.user_id = a.user_id
         LEFT JOIN institution i ON i.institution_id = ai.institution_id
         FULL JOIN account_status s ON s.user_id = a.user_id
    WHERE a.user_id NOT IN ({_list(profile.excluded_subscribers)})
      AND institution_name NOT IN ({_list(profile.excluded_subscriber_institutions)})
      AND institution_name IS NOT NULL)),
usage_subscription AS (
  SELECT DISTINCT u.* EXCLUDE (institution_name), s.* EXCLUDE (id_user)
  FROM usage u LEFT JOIN subscription s ON u.id_user = s.id_user WHERE labo_name IS NOT NULL),
activity AS (
  SELECT u.*, s.* EXCLUDE (id_user), {MONTH_FULL} AS month_full,
         coalesce(user_name, 'Unknown User') || ' - ' || coalesce(institution_name, 'Unknown Institution') AS user_full
  FROM usage u LEFT JOIN subscription s ON u.id_user = s.id_user),
codes_by_month AS (
  SELECT institution_name, year, month, month2, make_date(year, month, 1) AS date, {SHORT_MONTH} AS month_name,
         CAST(sum(nb_codes) AS BIGINT) AS nb_codes
  FROM usage WHERE institution_name IS NOT NULL GROUP BY ALL),
users_by_month AS (
  SELECT institution_name, year, month, month2, count(*) AS nb_users
  FROM (SELECT DISTINCT institution_name, user_name, year, month, month2 FROM usage)
  WHERE institution_name IS NOT NULL GROUP BY ALL),
users_all AS (
  SELECT year, month, month2, count(*) AS nb_users
  FROM (SELECT DISTINCT institution_name, user_name, year, month, month2 FROM usage) GROUP BY ALL),
codes_by_database AS (
  SELECT institution_name, database_name2, year, CAST(sum(nb_codes) AS BIGINT) AS nb_codes
  FROM usage WHERE institution_name IS NOT NULL AND database_name2 IS NOT NULL GROUP BY ALL),
per_status AS (
  SELECT labo_name, statut, count(*) AS nb_subscribers FROM subscription
  WHERE statut IS NOT NULL GROUP BY ALL),
per_create_year AS (
  SELECT labo_name, statut, date_create_year, count(*) AS nb_subscribers FROM subscription
  WHERE statut IS NOT NULL AND date_create_year IS NOT NULL GROUP BY ALL),
per_access_year AS (
  SELECT labo_name, statut, date_last_access_year, count(*) AS nb_subscribers FROM subscription
  WHERE statut IS NOT NULL AND date_last_access_year IS NOT NULL GROUP BY ALL)"""


def portal(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_relations(PORTAL_CHECK), *ctes]) + "\n" + select


def workbook(select: str) -> str:
    return f"WITH {_relations(WORKBOOK_CHECK)}\n{select}"


def _norm(expression: str) -> str:
    return rf"lower(regexp_replace({expression}, '^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$', '', 'g'))"


def _any_contains(columns, needle: str) -> str:
    """Any-cell test; cells already are normal but for case and outer blanks."""
    return "(" + " OR ".join(
        f"coalesce(contains({_norm(f'CAST({c} AS VARCHAR)')}, {needle}), false)" for c in columns
    ) + ")"


def _line(columns) -> str:
    return " || ' | ' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


def _blocks(extra=()) -> str:
    """The three searched report files (and ``extra`` ones), cut to their columns, joined to the institution names."""
    per_status = ("labo_name", "statut", "nb_subscribers")
    per_year = ("labo_name", "statut", "date_create_year", "nb_subscribers")
    parts = [
        (plan.USERS, REPORT_COLUMNS[plan.USERS], "usage_subscription"),
        (plan.PER_STATUS, per_status, "per_status"),
        (plan.PER_CREATE_YEAR, per_year, "per_create_year"),
        *extra,
    ]
    selects = " UNION ALL ".join(
        f"""SELECT institution, {_text(file)} AS file, {_text(' | '.join(cols))} AS columns, {_line(cols)} AS line
        FROM (SELECT DISTINCT {', '.join(cols)} FROM {rel}) JOIN needles ON {_any_contains(cols, 'institution')}"""
        for file, cols, rel in parts
    )
    return f"""needles AS (
  SELECT DISTINCT {_norm('institution_name')} AS institution FROM institution WHERE institution_name IS NOT NULL),
blocks AS ({selects})"""


def _year_sums() -> str:
    return ", ".join(
        f"CAST(coalesce(sum(nb_codes) FILTER (a.year = {y}), 0) AS BIGINT) AS \"{y}\"" for y in PIVOT_YEARS
    )


def _file_name(column: str) -> str:
    cleaned = rf"regexp_replace({column}, '[^\p{{L}}\p{{N}}_\-. ]', '_', 'g')"
    return (
        f"CASE WHEN regexp_replace({cleaned}, '[_ ]', '', 'g') = '' "
        f"THEN 'empty_name_' || md5({column}) ELSE {cleaned} END"
    )


_PATH = r"""'[<>:"/\\|?*\x00 ]', '_', 'g'"""
_CONTROL = r"'[\x00-\x1f\x7f-\x{9f}]', '', 'g'"

_LOGS = """
lines AS (
  SELECT event_id, 'job_' || CAST(user_id % 7 AS VARCHAR) || '.log' AS log_file,
         strftime(ts, '%Y%m%d %H:%M:%S') || ' - portal -'
         || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END || ' - '
         || CASE WHEN event_type = 'error' AND user_id % 7 > 2 THEN 'ERROR: ' || props
                 WHEN event_type = 'signup' THEN 'ERREUR ' || props ELSE event_type END AS line
  FROM events)"""

_COUNTRIES = ("France", "Japan", "Chile", "Egypt", "Atlantis")
_CONTINENT = _cases(
    "country IN ({})", ((_list(names), _text(code)) for code, names in CONTINENTS.items())
)


def _int_type(column: str) -> str:
    n = f"max(length(CAST({column} AS VARCHAR)))"
    return f"CASE WHEN {n} > 9 THEN 'BIGINT' WHEN {n} > 4 THEN 'INTEGER' ELSE 'SMALLINT' END"


def _profile(*columns: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS position, {_text(c)} AS column_name, {kind} AS sql_type FROM orders"
        for i, (c, kind) in enumerate(columns, 1)
    )


def _varchar(column: str) -> str:
    return f"'VARCHAR(' || CAST(max(length({column})) AS VARCHAR) || ')'"


ORACLE: dict[str, str] = {
    "usage_clean": portal(f"""
        SELECT * EXCLUDE (date_heure_extraction), CAST(date_heure_extraction AS VARCHAR) AS date_heure_extraction,
               CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') AS yearmonth,
               CAST(make_date(year, month, 1) AS VARCHAR) AS date, {SHORT_MONTH} AS month_name
        FROM usage"""),
    "subscription_clean": portal("""
        SELECT * REPLACE (CAST(date_created AS VARCHAR) AS date_created,
                          CAST(date_last_access AS VARCHAR) AS date_last_access) FROM subscription"""),
    "usage_subscription": portal("""
        SELECT * REPLACE (CAST(date_created AS VARCHAR) AS date_created,
                          CAST(date_last_access AS VARCHAR) AS date_last_access,
                          CAST(date_heure_extraction AS VARCHAR) AS date_heure_extraction)
        FROM usage_subscription"""),
    "codes_per_institution_month": portal(
        "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM codes_by_month"
        " ORDER BY institution_name, year, month"
    ),
    "users_per_institution_month": portal("SELECT * FROM users_by_month"),
    "users_all_month": portal("SELECT * FROM users_all"),
    "users_line_chart": portal(
        "SELECT year AS series, month AS position, month2 AS x, nb_users AS y FROM users_all"
    ),
    "codes_per_institution_database_year": portal("SELECT * FROM codes_by_database WHERE nb_codes > 0"),
    "institution_year_slice": portal("""
        SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM codes_by_month
        WHERE institution_name = 'Nation 3, North ' AND year IN (1997, 1999)"""),
    "active_years": portal("SELECT DISTINCT year FROM usage"),
    "active_years_per_institution": portal("SELECT DISTINCT institution_name, year FROM usage"),
    "subscribers_per_status": portal("SELECT * FROM per_status"),
    "subscribers_per_create_year": portal("SELECT * FROM per_create_year"),
    "subscribers_per_access_year": portal("SELECT * FROM per_access_year"),
    "unique_users_month": workbook("""
        SELECT year, month_full, month2, CAST(year AS VARCHAR) || '-' || month2 AS period,
               count(DISTINCT user_name) AS nb_unique_users
        FROM activity GROUP BY ALL ORDER BY year, month_full"""),
    "codes_month": workbook("""
        SELECT year, month_full, month2, CAST(sum(nb_codes) AS BIGINT) AS sum_of_codes
        FROM activity GROUP BY ALL"""),
    "user_monthly_codes": workbook("""
        SELECT user_full, statut, database_name, year, month_full, month2,
               CAST(sum(nb_codes) AS BIGINT) AS sum_of_codes
        FROM activity WHERE statut IS NOT NULL GROUP BY ALL"""),
    "institution_monthly_codes": workbook("""
        SELECT year, month2, institution_name, database_name, month2 || ' - ' || institution_name AS label,
               CAST(sum(nb_codes) AS BIGINT) AS sum_of_codes
        FROM activity WHERE institution_name IS NOT NULL GROUP BY ALL"""),
    "codes_month_by_year_pivot": workbook(f"""
        SELECT CAST(m.month AS INT) AS month, m.month2, {_year_sums()}
        FROM (SELECT unnest(range(1, 13)) AS month, unnest([{_list(MONTHS)}]) AS month2) m
             LEFT JOIN activity a ON a.month2 = m.month2 GROUP BY ALL"""),
    "databases_per_user": portal("""
        SELECT id_user, coalesce(string_agg(DISTINCT database_name2, ', ' ORDER BY database_name2), '') AS databases
        FROM usage_subscription GROUP BY id_user"""),
    "users_per_database": portal("""
        SELECT DISTINCT lower(trim(database_name2)) AS database, user_name FROM usage_subscription
        WHERE database_name2 IS NOT NULL AND user_name IS NOT NULL"""),
    "users_per_institution": portal("""
        SELECT DISTINCT lower(trim(labo_name)) AS institution, user_name FROM usage_subscription
        WHERE user_name IS NOT NULL"""),
    "databases_per_institution": portal("""
        SELECT DISTINCT lower(trim(labo_name)) AS institution, database_name2 FROM usage_subscription
        WHERE database_name2 IS NOT NULL"""),
    "user_profile_dates": portal("""
        SELECT id_user,
               coalesce(string_agg(DISTINCT CAST(date_created AS VARCHAR), ', '
                                   ORDER BY CAST(date_created AS VARCHAR)), '') AS dates_created,
               coalesce(string_agg(DISTINCT CAST(date_last_access AS VARCHAR), ', '
                                   ORDER BY CAST(date_last_access AS VARCHAR)), '') AS dates_last_access
        FROM usage_subscription GROUP BY id_user"""),
    "unknown_institutions": portal("""
        SELECT DISTINCT group_name AS institution_name FROM usage_log
        WHERE group_name IS NOT NULL AND group_name NOT IN (SELECT labo_name FROM subscription)"""),
    "years_without_data": portal("""
        SELECT DISTINCT year FROM (
          SELECT CAST(year(l_shipdate) + 1 AS INT) AS year FROM lineitem
          UNION ALL SELECT CAST(year(o_orderdate) AS INT) FROM orders)
        WHERE year NOT IN (SELECT year FROM usage)"""),
    "any_cell_search": portal(f"""
        SELECT DISTINCT id_user, user_name, labo_name FROM usage_subscription
        WHERE {_any_contains(["user_name", "database_name2", "labo_name"], "'nation_1'")}
           OR {_any_contains(["user_name", "database_name2", "labo_name"], "'esg'")}"""),
    "institution_theta_join": portal(f"""
        SELECT id_user, user_name, labo_name, institution
        FROM (SELECT DISTINCT id_user, user_name, labo_name FROM usage_subscription)
             JOIN (SELECT DISTINCT {_norm('group_name')} AS institution FROM usage_log
                   WHERE group_name IS NOT NULL)
             ON {_any_contains(["id_user", "user_name", "labo_name"], "institution")}"""),
    "institution_report_blocks": portal("SELECT * FROM blocks", _blocks()),
    "report_pages": portal("""
        SELECT institution, file, page, pages,
               institution || ' (' || CAST(page AS VARCHAR) || '/' || CAST(pages AS VARCHAR) || ')' AS title,
               columns, string_agg(line, chr(10) ORDER BY rn) AS lines
        FROM (SELECT *, CAST(ceil(rn / 10.0) AS INT) AS page, CAST(ceil(n / 10.0) AS INT) AS pages
              FROM (SELECT *, row_number() OVER (PARTITION BY institution, file ORDER BY line) AS rn,
                           count(*) OVER (PARTITION BY institution, file) AS n FROM blocks))
        GROUP BY ALL""", _blocks()),
    "folder_scan": portal(f"""
        SELECT {_text(plan.USERS)} AS file, count(*) AS n_rows, count(user_name) AS n_user_names,
               CAST(NULL AS BIGINT) AS nb_subscribers FROM usage_subscription
        UNION ALL SELECT {_text(plan.PER_STATUS)}, count(*), 0, CAST(sum(nb_subscribers) AS BIGINT) FROM per_status
        UNION ALL SELECT {_text(plan.PER_CREATE_YEAR)}, count(*), 0, CAST(sum(nb_subscribers) AS BIGINT)
        FROM per_create_year"""),
    "bar_chart_frames": portal("""
        SELECT chart, institution_name, year, position, x, y,
               CASE WHEN top < 100 THEN 10 ELSE CAST(10 ** (length(CAST(top AS VARCHAR)) - 1) AS BIGINT) END
                 AS axis_step,
               CASE WHEN top <= 100 THEN CAST(top AS DOUBLE) + 10
                    WHEN top <= 50000 THEN CAST(top AS DOUBLE) + CAST(top AS DOUBLE) * CAST(0.5 AS DOUBLE)
                    ELSE CAST(top AS DOUBLE) + CAST(top AS DOUBLE) * CAST(0.35 AS DOUBLE) END AS axis_limit
        FROM (SELECT *, max(y) OVER (PARTITION BY chart, institution_name, year) AS top FROM (
          SELECT 'codes_per_month' AS chart, institution_name, year, month AS position, month2 AS x, nb_codes AS y
          FROM codes_by_month WHERE nb_codes > 0
          UNION ALL SELECT 'users_per_month', institution_name, year, month, month2, nb_users FROM users_by_month
          UNION ALL SELECT 'codes_per_database', institution_name, year, NULL, database_name2, nb_codes
          FROM codes_by_database WHERE nb_codes > 0))"""),
    "sql_source": """
        SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS year, count(*) AS n_orders
        FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""",
    "csv_pipe_roundtrip": portal("SELECT * FROM per_create_year"),
    "csv_delimited_read": """
        SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
        WHERE o_orderstatus IN ('F', 'O')""",
    "snapshot_read_through": "SELECT *, 'saved' AS origin FROM customer",
    "typed_snapshot_texts": """
        SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN 'None' ELSE source END AS label,
               lang, 'saved' AS origin FROM documents""",
    "csv_text_roundtrip": """
        SELECT 'document' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'page', page_id, html FROM pages""",
    "delimited_inference": """
        SELECT sep, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, 'bigint, string, double, string' AS kinds
        FROM orders, (VALUES (';'), ('tab')) AS t(sep)""",
    "numbered_missing": """
        SELECT *, row_number() OVER (PARTITION BY block ORDER BY customer NULLS LAST, o_orderkey) AS row_no,
               count(*) OVER (PARTITION BY block) AS block_rows
        FROM (SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus END AS block,
                     CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS customer FROM orders)""",
    "one_institution": portal("""
        SELECT * EXCLUDE (date_heure_extraction), CAST(date_heure_extraction AS VARCHAR) AS date_heure_extraction
        FROM usage WHERE institution_name = 'NATION_7'"""),
    "text_search": f"""
        SELECT DISTINCT doc_id, institution FROM documents
        JOIN (SELECT DISTINCT {_norm('text')} AS institution FROM benchmark)
             ON contains({_norm('text')}, institution) WHERE institution <> ''""",
    "table_refresh_roundtrip": workbook("""
        SELECT year, month_full, month2, CAST(sum(nb_codes) AS BIGINT) AS sum_of_codes
        FROM activity GROUP BY ALL"""),
    "partitioned_by_institution": portal("""
        SELECT *, replace(replace(trim(institution_name), ',', ''), ' ', '_') AS institution_folder
        FROM codes_by_database"""),
    "latest_snapshot": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 2",
    "versioned_write": portal("SELECT *, 'subscribers_v002' AS version_label FROM per_status"),
    "sanitized_names": rf"""
        SELECT 'page' AS kind, page_id AS id, regexp_replace(url, {_PATH}) AS path, {_file_name('url')} AS file,
               regexp_replace(html, {_CONTROL}) AS printable FROM pages
        UNION ALL
        SELECT 'document', doc_id, regexp_replace(source, {_PATH}), {_file_name('text')},
               regexp_replace(text, {_CONTROL}) FROM documents""",
    "relative_date_window": """
        SELECT o_orderkey, CAST(d - 15 AS VARCHAR) AS date_start, CAST(d AS VARCHAR) AS date_end,
               CAST(d - 365 AS VARCHAR) AS month_start, CAST(year(d - 365) AS VARCHAR) AS previous_year,
               CAST(year(d) AS VARCHAR) AS current_year
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "static_lookups": portal(f"""
        SELECT {_CONTINENT} AS continent,
               CASE instrument WHEN 'actions' THEN 2 WHEN 'indices' THEN 7 WHEN 'fonds' THEN 3 END
                 AS instrument_code,
               CASE instrument WHEN 'actions' THEN 'src_cours_actions' WHEN 'indices' THEN 'src_cours_indices'
                    WHEN 'fonds' THEN 'src_cours_fonds' END AS price_table,
               count(*) AS n_requests
        FROM (SELECT list_extract([{_list(_COUNTRIES)}], CAST(institution_id % 5 + 1 AS INT)) AS country,
                     regexp_extract(source_name, 'actions|indices|fonds') AS instrument FROM usage_log)
        GROUP BY ALL"""),
    "set_inclusion": """
        SELECT o_custkey, bool_and(finished) AS all_in_finished, true AS finished_in_all
        FROM (SELECT o_custkey, o_orderpriority, bool_or(o_orderstatus = 'F') AS finished
              FROM orders GROUP BY ALL) GROUP BY ALL""",
    "business_calendar": """
        SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS date_cotation
        FROM (SELECT unnest(generate_series(CAST(min(CAST(o_orderdate AS DATE)) AS TIMESTAMP),
                                            CAST(max(CAST(o_orderdate AS DATE)) AS TIMESTAMP),
                                            INTERVAL 1 DAY)) AS day FROM orders)
        WHERE isodow(day) <= 5""",
    "schema_contract": """
        SELECT * FROM (
          SELECT 1 AS position, 'event_id' AS column_name, 'int' AS expected_type, 'event_id' AS found_column,
                 true AS present, true AS position_ok, CAST(0 AS BIGINT) AS n_bad
          UNION ALL SELECT 2, 'ts', 'timestamp', 'ts', true, true, 0
          UNION ALL SELECT 3, 'event_type', 'int', 'user_id', true, false,
                 (SELECT count(*) FROM events WHERE user_id IS NOT NULL
                  AND TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) IS NULL)
          UNION ALL SELECT 4, 'user_id', 'float', 'event_type', true, false,
                 (SELECT count(*) FROM events WHERE event_type IS NOT NULL
                  AND TRY_CAST(event_type AS DOUBLE) IS NULL)
          UNION ALL SELECT 5, 'value', 'float', 'value', true, true,
                 (SELECT count(*) FROM events WHERE value IS NOT NULL
                  AND TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) IS NULL)
          UNION ALL SELECT 6, 'props', 'bool', 'props', true, true,
                 (SELECT count(*) FROM events WHERE props IS NOT NULL
                  AND TRY_CAST(props AS BOOLEAN) IS NULL)
          UNION ALL SELECT 7, 'missing', 'str', NULL, false, false, NULL)""",
    "column_profile": _profile(
        ("o_orderkey", _int_type("o_orderkey")), ("o_custkey", _int_type("o_custkey")),
        ("o_orderstatus", _varchar("o_orderstatus")), ("o_totalprice", "max('REAL')"),
        ("o_orderdate", "max('TIMESTAMP')"), ("o_orderpriority", _varchar("o_orderpriority")),
    ),
    "narrowed_load": "SELECT '2024-02-29' AS date_loading, * FROM part",
    "log_error_digest": f"""
        WITH {_LOGS} SELECT DISTINCT log_file, substr(line, 28) AS error FROM lines
        WHERE regexp_matches(line, 'ERREUR|ERROR') ORDER BY log_file, error""",
    "log_status": f"""
        WITH {_LOGS}, errors AS (
          SELECT log_file, event_id, regexp_extract(line, 'ERROR:.*') AS detail FROM lines
          WHERE contains(line, 'ERROR:'))
        SELECT log_file, CASE WHEN n_errors > 0 THEN 'ERROR' ELSE 'SUCCESS' END AS status, n_errors,
               coalesce(first_error, 'SUCCESS - ' || log_file) AS details
        FROM (SELECT DISTINCT log_file FROM lines)
             LEFT JOIN (SELECT log_file, count(*) AS n, min_by(detail, event_id) AS first_error
                        FROM errors GROUP BY log_file) USING (log_file),
             LATERAL (SELECT coalesce(n, 0) AS n_errors)""",
    "log_tail": f"""
        WITH {_LOGS}
        SELECT log_file, n - back + 1 AS line_no, line, least(n, 20) AS shown, n AS total
        FROM (SELECT *, row_number() OVER (PARTITION BY log_file ORDER BY event_id DESC) AS back,
                     count(*) OVER (PARTITION BY log_file) AS n FROM lines)
        WHERE back <= 20""",
    "log_last_lines": f"""
        WITH {_LOGS} SELECT log_file, line FROM lines ORDER BY log_file DESC, event_id DESC LIMIT 20""",
}


# The quarantine keys: a fourth file holds the rows per status whose count is not divisible by three; the others have a
# cell too many and are set aside with their text as written (cells with a separator, quote or line break are quoted,
# quotes doubled, empty texts written as two quotes).
_RAGGED_EVERY = 3
_PAGES = """
        SELECT institution, file, page, pages,
               institution || ' (' || CAST(page AS VARCHAR) || '/' || CAST(pages AS VARCHAR) || ')' AS title,
               columns, string_agg(line, chr(10) ORDER BY rn) AS lines
        FROM (SELECT *, CAST(ceil(rn / 10.0) AS INT) AS page, CAST(ceil(n / 10.0) AS INT) AS pages
              FROM (SELECT *, row_number() OVER (PARTITION BY institution, file ORDER BY line) AS rn,
                           count(*) OVER (PARTITION BY institution, file) AS n FROM blocks))
        GROUP BY ALL"""


def _written(cell: str) -> str:
    text = f"CAST({cell} AS VARCHAR)"
    return (f"CASE WHEN {cell} IS NULL THEN '' WHEN {text} = '' THEN '\"\"' "
            f"WHEN regexp_matches({text}, '[|\"\\n\\r]') THEN '\"' || replace({text}, '\"', '\"\"') || '\"' ELSE {text} END")


ORACLE["quarantined_report_pages"] = portal(_PAGES, _blocks([
    ("stats_ragged.csv", ("labo_name", "statut", "nb_subscribers"),
     f"(SELECT * FROM per_status WHERE nb_subscribers % {_RAGGED_EVERY} <> 0)"),
]))
ORACLE["report_quarantine"] = portal(f"""
SELECT 'stats_ragged.csv' AS file, {_written('labo_name')} || '|' || {_written('statut')} || '|' || {_written('nb_subscribers')} || '|extra' AS line,
       'cells do not fit the header' AS reason
FROM per_status WHERE nb_subscribers % {_RAGGED_EVERY} = 0
UNION ALL SELECT 'stats_empty.csv', NULL, 'no header'
UNION ALL SELECT 'stats_headerless.csv', NULL, 'no header'""")

ORACLE["incremental_codes_month"] = ORACLE["codes_per_institution_month"]
ORACLE["users_rollup_bitmaps"] = portal("""
SELECT 'month' AS level, institution_name, year, month, count(*) AS nb_users
FROM (SELECT DISTINCT institution_name, user_name, year, month FROM usage WHERE year IS NOT NULL AND month IS NOT NULL)
WHERE institution_name IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'year', institution_name, year, CAST(NULL AS INTEGER), count(*)
FROM (SELECT DISTINCT institution_name, user_name, year FROM usage WHERE year IS NOT NULL AND month IS NOT NULL)
WHERE institution_name IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'all', institution_name, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), count(*)
FROM (SELECT DISTINCT institution_name, user_name FROM usage WHERE year IS NOT NULL AND month IS NOT NULL)
WHERE institution_name IS NOT NULL GROUP BY ALL""")
ORACLE["usage_subscription_bucketed"] = ORACLE["usage_subscription"]


def profiled(select: str, profile) -> str:
    return f"WITH {_relations(profile)}\n{select}"


ORACLE["codes_per_institution_month_open_years"] = profiled(
    "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM codes_by_month ORDER BY institution_name, year, month",
    OPEN_YEARS_CHECK)
ORACLE["users_per_institution_month_legacy"] = profiled("SELECT * FROM users_by_month", LEGACY_CHECK)
