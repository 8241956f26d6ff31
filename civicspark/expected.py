"""The registered queries as ANSI SQL over the same tables, to check results against."""

from __future__ import annotations

from civicspark.schemas import STAGED_COLUMNS
from civicspark.workload import (
    AS_OF,
    BATCH_YEAR,
    CURSOR,
    FLOOR,
    HOT_TYPES,
    MOVED,
    PAGE_START,
    RUN_AT,
    SNAPSHOTS,
)

_ZIP = "lpad(CAST({0} AS VARCHAR), CAST(greatest(5, length(CAST({0} AS VARCHAR))) AS INTEGER), '0')"

# The domain views, as CTEs.
_DOMAIN = f"""
WITH raw_income AS (
    SELECT c_name AS name,
           CASE WHEN c_acctbal < 0 THEN '-666666666'
                ELSE CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) END AS amount,
           {_ZIP.format("c_custkey")} AS zip_code
    FROM customer
), silver_income AS (
    SELECT name, zip_code,
           CASE WHEN amount LIKE '%-666666%' THEN 0 ELSE TRY_CAST(amount AS INTEGER) END
               AS median_income
    FROM raw_income
), income AS (
    SELECT zip_code, median_income FROM silver_income
), places AS (
    SELECT c_custkey,
           CASE WHEN n_nationkey <> 24 THEN ' ' || lower(n_name) || ' ' END AS city,
           r_name AS borough
    FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
), joined AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS unique_key,
           CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' ||
               CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS bbl,
           CASE WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN ' closed '
                WHEN o_orderstatus = 'F' THEN 'Closed'
                WHEN o_orderstatus = 'O' THEN 'Open'
                WHEN o_orderstatus = 'P' THEN 'Pending' END AS status,
           CASE WHEN o_orderstatus = 'F' THEN l_shipdate END AS closed_date,
           o_orderdate AS created_date,
           CASE WHEN l_returnflag <> 'N'
                THEN o_orderdate + to_days(CAST(l_quantity AS INTEGER)) END AS due_date,
           CAST(l_suppkey AS VARCHAR) AS agency,
           s_name AS agency_name,
           borough, city,
           p_brand AS complaint_type, p_type AS descriptor, p_name AS descriptor_2,
           {_ZIP.format("o_custkey")} AS incident_zip,
           l_shipdate AS updated_at,
           CAST(date_trunc('year', l_shipdate) AS DATE) AS ingest_date,
           CAST(date_trunc('year', l_shipdate) AS TIMESTAMP) AS ingest_timestamp
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN places ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN part ON l_partkey = p_partkey
), silver AS (
    SELECT *,
           CASE WHEN status = 'Closed'
                THEN CAST(date_diff('day', created_date, closed_date) AS INTEGER) END
               AS resolution_time_days,
           CAST(date_diff('day', created_date, due_date) AS INTEGER) AS "SLA_days"
    FROM joined
), staging AS (
    SELECT unique_key, lower(trim(status)) AS status, closed_date, created_date, due_date,
           CAST(NULL AS TIMESTAMP) AS resolution_action_updated_date, "SLA_days",
           resolution_time_days, CAST(NULL AS VARCHAR) AS address_type, agency, agency_name,
           bbl, borough, upper(trim(city)) AS city, CAST(NULL AS VARCHAR) AS community_board,
           complaint_type, CAST(NULL AS VARCHAR) AS council_district, descriptor, descriptor_2,
           incident_zip, CAST(NULL AS VARCHAR) AS location_type,
           CAST(NULL AS VARCHAR) AS police_precinct, created_date AS created_at, updated_at,
           ingest_date, ingest_timestamp
    FROM silver
), staged AS (
    SELECT * FROM staging
    QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY updated_at DESC, bbl DESC) = 1
), hourly AS (
    SELECT CAST(event_id AS VARCHAR) AS unique_key, event_type AS complaint_type,
           ts AS created_date, {_ZIP.format("user_id")} AS incident_zip,
           upper(trim(city)) AS city, borough
    FROM events LEFT JOIN places ON user_id = c_custkey
)"""

# Grain and measures of the marts, over one row of numbers per request.
_AGENCY = (
    "created_month borough city agency agency_name",
    {
        "total_cases": "keyed",
        "total_cases_closed": "shut",
        "total_resolution_days": "shut_days",
        "total_sla_days": "allowed_days",
    },
)
_RESOLUTION = (
    "created_month zip_code borough city",
    {
        "total_complaints": "keyed",
        "closed_complaints": "shut",
        "total_resolution_time": "days",
        "total_due_date": "due",
        "total_sla_days": "allowed_days",
    },
)


def _mart(source: str, mart: tuple[str, dict[str, str]], valued: bool = False) -> str:
    """A mart over any table of staged requests; ``valued`` ones beside their ZIP code's income."""
    grain = ", ".join(mart[0].split())
    sums = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {name}" for name, m in mart[1].items())
    facts = f"""SELECT CAST(date_trunc('month', created_date) AS TIMESTAMP) AS created_month,
            incident_zip AS zip_code, borough, city, agency, agency_name,
            CAST(unique_key IS NOT NULL AS INTEGER) AS keyed,
            CAST(due_date IS NOT NULL AS INTEGER) AS due,
            CAST(status IS NOT DISTINCT FROM 'closed' AS INTEGER) AS shut,
            resolution_time_days AS days, if(shut = 1, days, 0) AS shut_days,
            "SLA_days" AS allowed_days
        FROM {source}"""
    sql = f"SELECT {grain}, {sums} FROM ({facts}) GROUP BY {grain}"
    if valued:
        usable = "SELECT * FROM income WHERE median_income > 0"
        sql = f"SELECT * FROM ({sql}) JOIN ({usable}) USING (zip_code)"
    return sql


_VIEWS = f"""{_DOMAIN}, agency_mart AS ({_mart("staged", _AGENCY)}),
income_mart AS ({_mart("staged", _RESOLUTION, valued=True)})"""

# The attributes a view was not asked for are null in it.
_BLANK = {
    "place": ("borough", "city"),
    "agency": ("agency_name",),
    "kind": ("complaint_type", "descriptor", "descriptor_2"),
}


def _without(table: str, *attributes: str) -> str:
    blank = [name for a in attributes for name in _BLANK[a]]
    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {name}" for name in blank)
    return f"(SELECT * REPLACE ({nulls}) FROM {table})" if blank else table


def _columns(names: str) -> str:
    return ", ".join(f'"{n}"' for n in names.split())


def _hotspots(source: str, k: int) -> str:
    """The hotspot mart spelled out: the busiest hour is looked up by plain equality, so a
    missing key finds none."""
    return f""", valued AS (
        SELECT complaint_type, city, borough, unique_key, median_income,
               CAST(date_trunc('month', created_date) AS TIMESTAMP) AS created_month,
               CAST(hour(created_date) AS INTEGER) AS at_hour
        FROM {source} JOIN income ON zip_code = incident_zip AND median_income > 0
    ), per_hour AS (
        SELECT complaint_type, city, borough, created_month, at_hour, count(*) AS n
        FROM valued GROUP BY ALL
    ), hotspots AS (
        SELECT created_month, complaint_type, city, borough,
               count(unique_key) AS total_complaints,
               avg(median_income) AS avg_income_of_reporters,
               (SELECT at_hour FROM per_hour
                WHERE per_hour.complaint_type = valued.complaint_type
                  AND per_hour.city = valued.city AND per_hour.borough = valued.borough
                  AND per_hour.created_month = valued.created_month
                ORDER BY n DESC, at_hour LIMIT 1) AS most_common_hour_of_day
        FROM valued
        WHERE complaint_type IN (
            SELECT complaint_type FROM valued GROUP BY complaint_type
            ORDER BY count(*) DESC, complaint_type NULLS LAST LIMIT {k})
        GROUP BY created_month, complaint_type, city, borough
    )"""


_MERGE_COLUMNS = ", ".join(f'"{n}"' for n in STAGED_COLUMNS)


def _latest(table: str, where: str) -> str:
    return f"""SELECT {_MERGE_COLUMNS} FROM {table} WHERE {where}
        QUALIFY row_number() OVER (
            PARTITION BY unique_key ORDER BY updated_at DESC, bbl DESC) = 1"""


def _merged(first: str, second: str, *blank: str) -> str:
    """Latest rows of the second batch, and those of the first whose key it lacks."""
    table = _without("staging", *blank)
    return f""", target AS ({_latest(table, first)}), batch AS ({_latest(table, second)})
        SELECT * FROM batch UNION ALL
        SELECT * FROM target WHERE unique_key NOT IN (SELECT unique_key FROM batch)"""


_EARLY = f"ingest_date < DATE '{BATCH_YEAR}'"
_LATE = f"ingest_date >= DATE '{BATCH_YEAR}'"


def _history() -> str:
    """Versions that were the latest of their key in some snapshot, each ended by the next."""
    taken = [f"ingest_date <= DATE '{day}'" for day in SNAPSHOTS] + ["true"]
    shots = " UNION ALL ".join(
        f"SELECT {n} AS shot, * FROM ({_latest('staging', where)})" for n, where in enumerate(taken)
    )
    return f""", shots AS ({shots}), versions AS (
        SELECT *, min(updated_at) OVER (
            PARTITION BY unique_key ORDER BY updated_at
            RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS ended
        FROM shots
        QUALIFY row_number() OVER (PARTITION BY unique_key, updated_at ORDER BY shot) = 1
    ), history AS (
        SELECT unique_key, status, bbl, updated_at AS dbt_valid_from, ended AS dbt_valid_to,
               md5(unique_key || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S')) AS dbt_scd_id
        FROM versions
    )"""


def expected_sql() -> dict[str, str]:
    merge_late = _merged(_LATE, _EARLY)
    statements = {
        "silver_derived_days": """SELECT unique_key, bbl, status, closed_date, due_date,
            resolution_time_days, "SLA_days" FROM silver""",
        "silver_exact_dedup": """SELECT DISTINCT unique_key, status, created_date, incident_zip
            FROM silver""",
        "income_clean_sentinel": "SELECT name, median_income, zip_code FROM silver_income",
        "income_rebuilt_table": "SELECT zip_code, median_income FROM income",
        "header_rows_table": "SELECT name, median_income, zip_code FROM silver_income",
        "ndjson_scan": """SELECT unique_key, bbl, status, city, borough, created_date,
            closed_date, due_date, updated_at FROM silver""",
        "ndjson_quarantine": """SELECT count(*) AS lines,
            count(*) FILTER (WHERE status = 'Pending') AS bad_lines,
            count(*) FILTER (WHERE status IN ('Pending', ' closed ')) AS keyless_lines
            FROM silver""",
        "silver_partitioned_roundtrip": """SELECT unique_key, bbl, status,
            resolution_time_days, "SLA_days", ingest_date FROM silver""",
        "silver_two_loads": f"""SELECT unique_key, bbl, status, resolution_time_days,
            "SLA_days", TIMESTAMP '{RUN_AT:%Y-%m-%d %H:%M:%S}' AS ingest_timestamp,
            DATE '{RUN_AT:%Y-%m-%d}' AS ingest_date FROM (SELECT DISTINCT * FROM silver)""",
        "external_table_refresh": """SELECT ingest_date, count(*) AS n_rows,
            CAST(sum("SLA_days") AS BIGINT) AS total_sla_days FROM silver GROUP BY ALL""",
        "extract_since_cursor": f"""SELECT unique_key, bbl, status, created_date, updated_at
            FROM silver WHERE updated_at > TIMESTAMP '{CURSOR}'
            AND created_date >= TIMESTAMP '{FLOOR}'""",
        "extract_next_cursor": f"""SELECT max(updated_at) AS next_cursor, count(*) AS fetched
            FROM silver WHERE updated_at > TIMESTAMP '{CURSOR}'
            AND created_date >= TIMESTAMP '{FLOOR}'""",
        "extract_keyset_page": f"""SELECT updated_at, unique_key, bbl FROM silver
            WHERE updated_at >= TIMESTAMP '{PAGE_START}'
            ORDER BY updated_at, unique_key, bbl LIMIT 20000""",
        "extract_two_runs": f"""SELECT unique_key, bbl, updated_at
            FROM silver WHERE updated_at > TIMESTAMP '{CURSOR}'
            AND created_date >= TIMESTAMP '{FLOOR}'""",
        "pages_union": """SELECT unique_key, bbl, status,
            CASE WHEN status IN ('Closed', ' closed ') THEN closed_date END AS closed_date,
            CASE WHEN status NOT IN ('Closed', ' closed ') THEN due_date END AS due_date
            FROM silver WHERE status IS NOT NULL""",
        "run_stamps": """SELECT strftime(ingest_timestamp, '%Y%m%dT%H%M%SZ') AS run,
            count(*) AS n_rows FROM silver GROUP BY ALL""",
        "staging_projection": "SELECT * FROM staging",
        "staging_latest": "SELECT * FROM staged",
        "staging_incremental_slice": f"""SELECT unique_key, bbl, ingest_date FROM silver
            WHERE ingest_date >= (SELECT max(ingest_date) FROM silver
                                  WHERE ingest_date <= DATE '{BATCH_YEAR}')""",
        "staging_merge_upsert": _merged(_EARLY, _LATE, "agency", "kind"),
        "staging_merge_late_batch": merge_late,
        "staging_merge_newer_only": "SELECT * FROM staged",
        "staging_merge_table": merge_late,
        "staging_incremental_job": _ANY_TIE,
        "staging_full_refresh": _ANY_TIE,
        "staging_layout": """SELECT CAST(date_trunc('month', created_date) AS DATE) AS created_part,
            unique_key, borough, complaint_type, incident_zip, created_date FROM staged""",
        "staging_positive_income": """SELECT zip_code, median_income FROM income
            WHERE median_income > 0""",
        "dq_unique": """SELECT unique_key, count(*) AS n_records FROM silver
            WHERE unique_key IS NOT NULL GROUP BY unique_key HAVING count(*) > 1""",
        "dq_not_null": "SELECT unique_key, city, borough FROM staged WHERE city IS NULL",
        "dq_accepted_values": """SELECT status, count(*) AS n_records FROM silver
            WHERE status NOT IN ('open', 'closed', 'pending', 'in progress', 'assigned',
                                 'started', 'unspecified') GROUP BY status""",
        "dq_negative_income": """SELECT zip_code, CAST(sum(CAST(amount AS BIGINT)) AS BIGINT)
            AS total_amount FROM raw_income GROUP BY zip_code HAVING total_amount < 0""",
        "dq_relationships": """SELECT incident_zip, count(*) AS n_records FROM staged
            WHERE incident_zip IS NOT NULL AND incident_zip NOT IN
                (SELECT zip_code FROM income WHERE median_income > 0) GROUP BY incident_zip""",
        "dq_income_key": """SELECT zip_code, count(*) AS n_records
            FROM (SELECT zip_code FROM income UNION ALL
                  SELECT zip_code FROM income WHERE median_income > 0)
            GROUP BY zip_code HAVING count(*) > 1 OR zip_code IS NULL""",
        "dq_summary": f"""SELECT
            (SELECT count(*) FROM (SELECT k FROM ({_FLAWED}) WHERE k IS NOT NULL
                GROUP BY k HAVING count(*) > 1)) AS "unique",
            count(*) FILTER (WHERE k IS NULL) AS not_null,
            count(*) FILTER (WHERE s = 'reopened') AS accepted_values FROM ({_FLAWED})""",
        "agency_efficiency": "SELECT * FROM agency_mart",
        "income_resolution": "SELECT * FROM income_mart",
        "complaint_hotspots": _hotspots("hourly", HOT_TYPES) + " SELECT * FROM hotspots",
        "complaint_hotspots_by_kind": _hotspots("staged", 5) + " SELECT * FROM hotspots",
        "hot_top_types": """SELECT complaint_type FROM staged GROUP BY complaint_type
            ORDER BY count(*) DESC, complaint_type NULLS LAST LIMIT 5""",
        "hot_modal_hour": """SELECT complaint_type, borough,
            CAST(hour(created_date) AS INTEGER) AS busiest_hour
            FROM hourly GROUP BY complaint_type, borough, hour(created_date)
            QUALIFY row_number() OVER (PARTITION BY complaint_type, borough
                ORDER BY count(*) DESC, hour(created_date)) = 1""",
        "hot_left_join_nulls": """, busiest AS (
            SELECT city, borough, CAST(hour(created_date) AS INTEGER) AS busiest_hour
            FROM hourly GROUP BY city, borough, hour(created_date)
            QUALIFY row_number() OVER (PARTITION BY city, borough
                ORDER BY count(*) DESC, hour(created_date)) = 1)
            SELECT t.*, busiest_hour
            FROM (SELECT city, borough, count(unique_key) AS total_complaints
                  FROM hourly GROUP BY ALL) t
            LEFT JOIN busiest b ON t.city = b.city AND t.borough = b.borough""",
        "mart_view": """SELECT borough, CAST(sum(total_cases) AS BIGINT) AS cases,
            CAST(sum(total_sla_days) AS BIGINT) AS sla_days FROM agency_mart GROUP BY borough""",
        "avg_resolution_by_borough": """SELECT borough,
            sum(total_resolution_days)::DOUBLE / nullif(sum(total_cases_closed), 0)::DOUBLE
                AS avg_resolution_days,
            CAST(sum(total_cases_closed) AS BIGINT) AS total_cases_closed
            FROM agency_mart GROUP BY borough""",
        "agency_ranking": """SELECT agency, agency_name,
            sum(total_resolution_days)::DOUBLE / nullif(sum(total_cases_closed), 0)::DOUBLE
                AS avg_resolution_days,
            CAST(sum(total_cases_closed) AS BIGINT) AS total_cases_closed
            FROM agency_mart GROUP BY ALL ORDER BY avg_resolution_days DESC NULLS LAST, agency""",
        "types_by_borough": _hotspots("staged", 5)
        + """ SELECT complaint_type, borough,
            CAST(sum(total_complaints) AS BIGINT) AS total_complaints
            FROM hotspots GROUP BY ALL""",
        "income_scatter": _SCATTER + " SELECT * FROM points",
        # Nothing can be fitted through fewer than two points.
        "income_trendline": _SCATTER
        + """ SELECT points,
            CASE WHEN points > 1 THEN round(slope, 9) END AS slope,
            CASE WHEN points > 1 THEN round(intercept, 6) END AS intercept,
            CASE WHEN points > 1 THEN round(r2, 9) END AS r2,
            CASE WHEN points > 1 THEN round(correlation, 9) END AS correlation
            FROM (SELECT count(*) AS points,
                         regr_slope(avg_resolution_days, median_income) AS slope,
                         regr_intercept(avg_resolution_days, median_income) AS intercept,
                         regr_r2(avg_resolution_days, median_income) AS r2,
                         corr(avg_resolution_days, median_income) AS correlation FROM points)""",
        "scd2_history": _history() + " SELECT * FROM history",
        "scd2_stored_history": _history() + " SELECT * FROM history",
        "status_duration": _history()
        + f""" SELECT status, count(*) AS versions, CAST(sum(days) AS BIGINT) AS total_days,
            avg(days) AS avg_days
            FROM (SELECT status, date_diff('day', dbt_valid_from,
                      coalesce(dbt_valid_to, TIMESTAMP '{AS_OF}')) AS days FROM history)
            GROUP BY status""",
        "stream_silver_available_now": """SELECT unique_key, bbl, status, city,
            resolution_time_days, "SLA_days", updated_at FROM (SELECT DISTINCT * FROM silver)""",
        "stream_upsert": """SELECT unique_key, bbl, status, city, resolution_time_days,
            "SLA_days", updated_at FROM staged""",
        "daily_chain": _CHAIN,
        "daily_chain_layers": _EXTRACTED + _layers("extracted", 5),
        "marts_after_second_batch": f", any_tie AS ({_ANY_TIE_FULL})" + _layers("any_tie", 5),
        "kept_agency_efficiency": f"{_MOVED} {_mart('moved', _AGENCY)}",
        "kept_income_resolution": f"{_MOVED} {_mart('moved', _RESOLUTION, valued=True)}",
        "kept_complaint_hotspots": _MOVED + _hotspots("moved", 5) + " SELECT * FROM hotspots",
        "bronze_microseconds": """SELECT unique_key, bbl,
            updated_at + to_microseconds(CAST(length(bbl) AS INTEGER)) AS updated_at FROM silver""",
        "extract_rejected_lines": f"""SELECT
            count(*) FILTER (WHERE status <> 'Pending' AND updated_at > TIMESTAMP '{CURSOR}'
                AND created_date >= TIMESTAMP '{FLOOR}') AS fetched,
            count(*) FILTER (WHERE status = 'Pending') AS rejected FROM silver""",
        "external_table_flat": "SELECT zip_code, median_income FROM income",
        "extract_all_pages": """SELECT updated_at, unique_key, bbl, CAST(floor((row_number() OVER (
            ORDER BY updated_at, unique_key, bbl) - 1) / 20000) AS BIGINT) AS page FROM silver""",
        "gate_failed_counts": f"""SELECT * FROM (
            SELECT 'unique' AS failing, (SELECT count(*) FROM (SELECT k FROM ({_FLAWED})
                WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1)) AS n
            UNION ALL SELECT 'not_null', count(*) FROM ({_FLAWED}) WHERE k IS NULL
            UNION ALL SELECT 'accepted_values', count(*) FROM ({_FLAWED}) WHERE s = 'reopened'
        ) WHERE n > 0""",
    }
    return {name: _VIEWS + " " + sql for name, sql in statements.items()}


_SCATTER = """, points AS (
    SELECT zip_code, borough, median_income,
           sum(total_resolution_time)::DOUBLE / nullif(sum(closed_complaints), 0)::DOUBLE
               AS avg_resolution_days,
           CAST(sum(closed_complaints) AS BIGINT) AS closed_complaints
    FROM income_mart GROUP BY ALL
    HAVING avg_resolution_days BETWEEN 0 AND 10
)"""

# The jobs break version ties by all other columns, in order.
_ALL_COLUMNS = ", ".join(
    f'"{name}" DESC NULLS LAST'
    for name in ("updated_at", *STAGED_COLUMNS)
    if name not in ("unique_key", "ingest_date", "ingest_timestamp")
)
_ANY_TIE = f"""SELECT * FROM {_without("staging", "agency", "kind")}
    QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY {_ALL_COLUMNS}) = 1"""

_ANY_TIE_FULL = f"""SELECT * FROM staging
    QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY {_ALL_COLUMNS}) = 1"""
# As above, some late versions having another time of creation.
_MOVED = f""", dated AS (
    SELECT * REPLACE (CASE WHEN {_LATE} AND regexp_matches(bbl, '{MOVED}')
        THEN created_date + INTERVAL 40 DAY + INTERVAL 5 HOUR ELSE created_date END AS created_date)
    FROM staging
), moved AS (
    SELECT * FROM dated
    QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY {_ALL_COLUMNS}) = 1
)"""
# Requests of which some lose their key and some have an unknown status.
_FLAWED = """SELECT CASE WHEN status <> 'Pending' THEN unique_key END AS k,
    CASE WHEN bbl LIKE '%9' THEN 'reopened' ELSE lower(trim(status)) END AS s FROM silver"""

_EXTRACTED = f""", extracted AS (
    SELECT * FROM staging
    WHERE updated_at > TIMESTAMP '{FLOOR}' AND created_date >= TIMESTAMP '{FLOOR}'
    QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY {_ALL_COLUMNS}) = 1
)"""
_CHAIN = f"{_EXTRACTED} {_mart('extracted', _RESOLUTION, valued=True)}"


def _layers(source: str, k: int) -> str:
    """Rows and one total of each mart and of the open history."""
    hotspots = _hotspots(source, k)
    return f"""{hotspots}, layers AS (
        SELECT 'fct_agency_efficiency' AS layer, total_cases AS n
        FROM ({_mart(source, _AGENCY)})
        UNION ALL SELECT 'fct_income_resolution', total_complaints
        FROM ({_mart(source, _RESOLUTION, valued=True)})
        UNION ALL SELECT 'fct_complaint_hotspots', total_complaints FROM hotspots
        UNION ALL SELECT 'complaints_snapshots', 1 FROM {source}
    )
    SELECT layer, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total FROM layers GROUP BY layer"""
