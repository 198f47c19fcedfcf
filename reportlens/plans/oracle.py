"""SQL twins of the queries, for an independent engine on the same tables.

They join row to row and aggregate afterwards, unlike the Spark plans, which fold each
table first.
"""

from __future__ import annotations

from ..rules import STATE_WEIGHTS
from .queries import RUN_TS

TEXTS = """
lines AS (
  SELECT l_orderkey AS report_id, upper(trim(p_name)) AS name, upper(trim(p_type)) AS type_text,
         upper(trim(p_brand)) AS brand
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

MANUFACTURER = """
CASE WHEN regexp_matches(brand, 'BRAND#1$|BRAND#11') THEN 'M1'
     WHEN regexp_matches(brand, 'BRAND#2') THEN 'M2'
     WHEN regexp_matches(brand, 'BRAND#3|BRAND#4|BRAND#5') THEN 'M3'
     ELSE {default} END"""

REPORTS = """
reports AS (
  SELECT o_orderkey AS report_id,
         CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS died,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Y' END AS hospital,
         CASE WHEN c_acctbal >= 0 AND c_acctbal < 9000 THEN c_acctbal / 100 END AS age_given,
         CASE WHEN c_nationkey < 20 THEN c_nationkey * 4.0::double END AS age_computed,
         n_name AS state,
         date_trunc('month', o_orderdate)::date AS report_month
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
facts AS (
  SELECT report_id,
         CASE WHEN died IS NOT NULL THEN (died = 'Y')::int::bigint END AS died_flag,
         CASE WHEN hospital IS NOT NULL THEN (hospital = 'Y')::int::bigint END AS hospital_flag,
         coalesce(age_given, age_computed) AS age_clean, died, state, report_month
  FROM reports
)"""

AGE_GROUP = """
CASE WHEN age_clean < 18 THEN '0-17' WHEN age_clean < 65 THEN '18-64'
     WHEN age_clean >= 65 THEN '65+' ELSE 'Unknown' END"""

CURATED = f"""
WITH {TEXTS},
{REPORTS},
targets AS (
  SELECT DISTINCT report_id FROM lines
  WHERE regexp_matches(type_text, 'PROMO') OR brand IN ('BRAND#1', 'BRAND#2', 'BRAND#3')
),
makers AS (
  SELECT report_id, manufacturer
  FROM (SELECT report_id, {MANUFACTURER.format(default="'OTHER'")} AS manufacturer FROM lines)
  WHERE manufacturer IN ('M1', 'M2', 'M3')
),
symptom_rows AS (
  SELECT report_id, name AS symptom FROM lines
  WHERE length(name) > 7 AND NOT regexp_matches(name, 'ANVIL|ROD')
    AND name NOT IN ('BLUE RING', 'HOT PLATE')
),
curated AS (
  SELECT f.*, symptom, manufacturer, {AGE_GROUP} AS age_group
  FROM facts f JOIN symptom_rows USING (report_id) JOIN makers USING (report_id)
  WHERE report_id IN (SELECT report_id FROM targets)
)"""

OUTCOMES = """
coalesce(sum(died_flag), 0)::bigint AS deaths,
coalesce(sum(hospital_flag), 0)::bigint AS hospitalizations"""


def grouped(keys: str, count_name: str, more: str = "") -> str:
    return (
        f"SELECT {keys}, count(*)::bigint AS {count_name}, {OUTCOMES}{more}"
        f" FROM curated GROUP BY {keys}"
    )


MEAN_AGE = ", avg(age_clean) AS avg_age"
SYMPTOMS = f"{CURATED}, symptoms AS ({grouped('manufacturer, symptom', 'total_reports')})"
SEVERITY = (
    f"{CURATED}, severity AS ({grouped('age_group, manufacturer', 'total_cases', MEAN_AGE)})"
)
TOTALS = f"{CURATED}, totals AS ({grouped('manufacturer', 'total_reports', MEAN_AGE)})"


def places(weights) -> str:
    rows = ", ".join(f"('{state}', {factor}::double)" for state, factor in weights)
    return f"{TOTALS}, weights(state, factor) AS (VALUES {rows})" + """,
shares AS (
  SELECT state, factor, manufacturer, deaths, hospitalizations, avg_age,
         greatest(1, trunc(total_reports::double * factor))::bigint AS share
  FROM totals CROSS JOIN weights
)"""


NAMED_PARTS = "WITH named AS (SELECT p_partkey, upper(trim(p_name)) AS name FROM part)"
BRANDED_PARTS = (
    "WITH branded AS (SELECT p_partkey, upper(trim(p_brand)) AS brand FROM part),"
    f" mapped AS (SELECT p_partkey, {MANUFACTURER.format(default=chr(39) + 'OTHER' + chr(39))}"
    " AS manufacturer FROM branded)"
)

TALLY = f"""
{CURATED}
SELECT manufacturer, symptom, age_group, count(*)::bigint AS n_rows, {OUTCOMES},
       round(coalesce(sum(age_clean), 0), 6) AS age_sum, count(age_clean)::bigint AS age_rows
FROM curated GROUP BY manufacturer, symptom, age_group"""

RATES = """
round(deaths * {scale}::double / total_cases, 6) AS death_rate,
round(hospitalizations * {scale}::double / total_cases, 6) AS hospital_rate,
round((deaths + hospitalizations) * {scale}::double / total_cases, 6) AS severe_rate"""

SEVERITY_ROWS = f"""
{SEVERITY}
SELECT age_group, manufacturer, total_cases, deaths, hospitalizations,
       round(avg_age, 6) AS avg_age, {RATES.format(scale=100)},
       deaths + hospitalizations AS severe_cases, 0 AS er_visits,
       manufacturer AS VAX_MANU_CLEAN, '{RUN_TS}' AS __time
FROM severity"""

GEOGRAPHIC_ROWS = f"""
{places(STATE_WEIGHTS)}
SELECT state, manufacturer, share AS total_reports,
       trunc(deaths::double * factor)::bigint AS deaths,
       trunc(hospitalizations::double * factor)::bigint AS hospitalizations,
       round(CASE WHEN avg_age IS NULL OR avg_age = 0 THEN 45.0::double ELSE avg_age END, 6) AS avg_age,
       round(deaths::double * factor * 100::double / share, 6) AS death_rate,
       round(hospitalizations::double * factor * 100::double / share, 6) AS hospital_rate,
       0 AS er_visits, manufacturer AS VAX_MANU_CLEAN, '{RUN_TS}' AS __time
FROM shares"""

EVENT_ROWS = """
SELECT ts AS __time, strftime(ts, '%Y-%m-%d') AS day, event_type, 1::bigint AS event_count,
       value AS total_value
FROM events"""

ORACLE: dict[str, str] = {
    "scan_project": "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size < 25",
    "clean_text": r"""
        SELECT p_partkey,
               upper(regexp_replace(concat(chr(9), ' ', p_name, ' ', chr(13), chr(10)),
                                    '^\s+|\s+$', '', 'g')) AS name
        FROM part""",
    "flag_equals": f"WITH {REPORTS} SELECT report_id, died_flag, hospital_flag FROM facts",
    "first_non_null": f"WITH {REPORTS} SELECT report_id, age_clean FROM facts",
    "map_category": f"{BRANDED_PARTS} SELECT * FROM mapped",
    "map_category_keep": f"""
        WITH branded AS (SELECT p_partkey, upper(trim(p_brand)) AS brand FROM part)
        SELECT p_partkey, {MANUFACTURER.format(default="brand")} AS manufacturer FROM branded""",
    "bucketize": f"""
        WITH {REPORTS}
        SELECT report_id, {AGE_GROUP} AS age_group,
               CASE WHEN age_clean < 18 THEN '0-17'
                    WHEN age_clean < 30 THEN '18-29'
                    WHEN age_clean < 80
                      THEN concat((trunc(age_clean / 10) * 10)::int, '-',
                                  (trunc(age_clean / 10) * 10 + 9)::int)
                    WHEN age_clean >= 80 THEN '80+' ELSE 'Unknown' END AS decade
        FROM facts""",
    "rates": """
        SELECT *, round(discounted * 100::double / line_count, 6) AS percent,
               round(discounted::double / line_count, 6) AS fraction
        FROM (SELECT l_returnflag, l_linestatus,
                     count(*) FILTER (WHERE l_discount > 0.05::double) AS discounted,
                     count(*) AS line_count
              FROM lineitem GROUP BY l_returnflag, l_linestatus)""",
    "tolerant_cast": """
        SELECT event_id,
               try_cast(CASE WHEN event_type = 'click' THEN event_type
                             ELSE value::varchar END AS double) AS value
        FROM events""",
    "iso_timestamp": """
        SELECT event_id,
               CASE WHEN event_type <> 'error' THEN ts
                    ELSE timestamp '1970-01-01 00:00:00' END AS event_time
        FROM events""",
    "conform_union": """
        SELECT c_custkey::varchar AS key, c_name AS name, c_acctbal AS balance, 0::bigint AS flag
        FROM customer
        UNION ALL SELECT s_suppkey::varchar, s_name, NULL, 1 FROM supplier""",
    "target_ids": f"{CURATED} SELECT report_id FROM targets",
    "valid_text": f"{NAMED_PARTS} SELECT * FROM named WHERE length(name) > 7",
    "deny_regex": f"{NAMED_PARTS} SELECT * FROM named WHERE NOT regexp_matches(name, 'ANVIL|ROD')",
    "deny_exact": f"{NAMED_PARTS} SELECT * FROM named WHERE name NOT IN ('BLUE RING', 'HOT PLATE')",
    "allow_list": f"{BRANDED_PARTS} SELECT * FROM mapped WHERE manufacturer IN ('M1', 'M2', 'M3')",
    "clean_curated": f"""
        WITH {TEXTS},
        cleaned AS (
          SELECT l.report_id, p_name AS symptom, {MANUFACTURER.format(default="brand")} AS manufacturer
          FROM (SELECT l_orderkey AS report_id, p_name, upper(trim(p_brand)) AS brand
                FROM lineitem JOIN part ON l_partkey = p_partkey) l
        )
        SELECT manufacturer, symptom, count(*)::bigint AS n_rows, sum(report_id)::bigint AS id_sum
        FROM cleaned
        WHERE manufacturer IN ('M1', 'M2', 'M3')
          AND NOT regexp_matches(upper(symptom), 'ANVIL|ROD') AND length(symptom) > 7
          AND upper(symptom) NOT IN ('BLUE RING', 'HOT PLATE')
        GROUP BY manufacturer, symptom""",
    "semi_join_reports": f"""
        {CURATED}
        SELECT report_id, died_flag, hospital_flag, age_clean FROM facts
        WHERE report_id IN (SELECT report_id FROM targets)""",
    "curate": f"""
        {CURATED}
        SELECT report_id, died_flag, hospital_flag, age_clean, symptom, manufacturer,
               count(*)::bigint AS n_rows
        FROM curated GROUP BY ALL""",
    "tally": TALLY,
    "symptoms": f"{SYMPTOMS} SELECT *, '{RUN_TS}' AS __time FROM symptoms",
    "severity": SEVERITY_ROWS,
    "severity_fraction": f"{SEVERITY} SELECT age_group, manufacturer, {RATES.format(scale=1)} FROM severity",
    "totals": f"{TOTALS} SELECT * REPLACE (round(avg_age, 6) AS avg_age) FROM totals",
    "null_safe_sum": f"""
        WITH {REPORTS}
        SELECT died, state, {OUTCOMES}, round(avg(age_clean), 6) AS avg_age
        FROM facts GROUP BY died, state""",
    "declared_metrics": """
        SELECT l_returnflag, l_linenumber::varchar AS l_linenumber,
               trunc(l_quantity)::bigint AS lines, l_tax AS tax
        FROM lineitem""",
    "allocate": f"""
        {places(STATE_WEIGHTS)}
        SELECT state, manufacturer, share AS total_reports,
               trunc(deaths::double * factor)::bigint AS deaths,
               trunc(hospitalizations::double * factor)::bigint AS hospitalizations,
               round(CASE WHEN avg_age IS NULL OR avg_age = 0 THEN 45.0::double ELSE avg_age END, 6)
                 AS avg_age,
               round(deaths::double * factor * 100::double / share, 6) AS death_rate,
               round(hospitalizations::double * factor * 100::double / share, 6) AS hospital_rate,
               0 AS er_visits, manufacturer AS VAX_MANU_CLEAN, '{RUN_TS}' AS __time
        FROM shares""",
    "allocate_valid": f"""
        {places([*STATE_WEIGHTS, ("US", 0.5), ("USA", 0.2), ("C1", 0.1)])}
        SELECT state, manufacturer, share AS total_reports,
               CASE state WHEN 'US' THEN 'state is a country code'
                          WHEN 'USA' THEN 'state is not two characters'
                          WHEN 'C1' THEN 'state is not alphabetic' END AS reason
        FROM shares""",
    "state_actual": f"""
        {CURATED}, by_state AS ({grouped('state, manufacturer', 'total_reports', MEAN_AGE)})
        SELECT state, manufacturer, total_reports, deaths, hospitalizations,
               round(avg_age, 6) AS avg_age,
               round(deaths * 100::double / total_reports, 6) AS death_rate,
               round(hospitalizations * 100::double / total_reports, 6) AS hospital_rate,
               0 AS er_visits, manufacturer AS VAX_MANU_CLEAN, '{RUN_TS}' AS __time
        FROM by_state""",
    "monthly_trend": f"""
        {CURATED}, by_month AS ({grouped('report_month, manufacturer', 'total_reports', MEAN_AGE)})
        SELECT report_month AS period, manufacturer, total_reports, deaths, hospitalizations,
               round(avg_age, 6) AS avg_age
        FROM by_month""",
    "yearly_trend": f"""
        {CURATED}
        SELECT date_trunc('year', report_month)::date AS period, count(*)::bigint AS total_reports,
               {OUTCOMES}, round(avg(age_clean), 6) AS avg_age
        FROM curated GROUP BY 1""",
    "alerts": f"""
        {SEVERITY}, rated AS (
          SELECT age_group, manufacturer, {RATES.format(scale=100)} FROM severity
        )
        SELECT age_group, manufacturer, 'deaths are high' AS alert, death_rate AS value,
               33.0::double AS threshold
        FROM rated WHERE death_rate > 33
        UNION ALL
        SELECT age_group, manufacturer, 'many severe', severe_rate, 53.0::double
        FROM rated WHERE severe_rate > 53""",
    "reports_by_manufacturer": f"""
        {SYMPTOMS}
        SELECT manufacturer, sum(total_reports)::bigint AS "Total Reportes"
        FROM symptoms GROUP BY manufacturer""",
    "top_symptoms": f"""
        {SYMPTOMS}
        SELECT symptom, sum(total_reports)::bigint AS "Total Reportes"
        FROM symptoms GROUP BY symptom ORDER BY 2 DESC, 1 LIMIT 15""",
    "hospitalizations_by_age": f"""
        {SEVERITY}
        SELECT age_group, sum(hospitalizations)::bigint AS "Hospitalizaciones"
        FROM severity GROUP BY age_group""",
    "reports_by_state": f"""
        {places(STATE_WEIGHTS)}
        SELECT state, sum(share)::bigint AS "Total Reportes"
        FROM shares GROUP BY state ORDER BY 2 DESC, 1 LIMIT 15""",
    "chart_filtered": f"""
        {SYMPTOMS}
        SELECT symptom, sum(total_reports)::bigint AS "Total Reportes"
        FROM symptoms WHERE manufacturer <> 'M2' AND deaths > 10
        GROUP BY symptom ORDER BY 2 DESC, 1 LIMIT 15""",
    "sql_adhoc": """
        SELECT c_mktsegment, count(*) AS order_count, round(sum(o_totalprice), 2) AS revenue
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice > 100000 GROUP BY c_mktsegment""",
    "ndjson_roundtrip": "SELECT *, CASE WHEN p_size > 25 THEN 'large' END AS size_class FROM part",
    "csv_roundtrip": "SELECT * FROM part",
    "csv_quoted_text": "SELECT doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents",
    "table_roundtrip": "SELECT * FROM customer",
    "datasource_ingest": EVENT_ROWS,
    "datasource_rollup": """
        SELECT date_trunc('hour', ts)::timestamp AS __time, strftime(ts, '%Y-%m') AS month,
               event_type, count(*)::bigint AS event_count, round(sum(value), 6) AS total_value
        FROM events GROUP BY ALL""",
    "datasource_replace": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*)::bigint AS event_count,
               round(sum(CASE WHEN ts >= timestamp '2024-01-20' THEN value * 2 ELSE value END), 6)
                 AS total_value
        FROM events GROUP BY ALL""",
    "time_filtered_sums": """
        SELECT event_type, count(*)::bigint AS event_count, round(sum(value), 6) AS total_value
        FROM events WHERE ts >= timestamp '2024-01-10 12:00:00' GROUP BY event_type""",
    "extracts_to_severity": SEVERITY_ROWS,
    "csv_mixed_breaks": """
        SELECT doc_id, md5(concat(lang, chr(13), text, chr(13), chr(10), '"q",', chr(10), chr(13), lang)) AS text_md5
        FROM documents""",
    "csv_permissive": """
        SELECT event_id, CASE WHEN event_type <> 'click' THEN value END AS value,
               CASE WHEN event_type = 'click' THEN 'value' ELSE '' END AS rejected
        FROM events""",
    "iso_timestamp_zone": """
        SELECT event_id,
               CASE WHEN event_type <> 'error' THEN ts
                    ELSE timestamp '1970-01-01 00:00:00' END AS event_time
        FROM events""",
    "allocate_unknown_age": GEOGRAPHIC_ROWS.replace(
        "round(CASE WHEN avg_age IS NULL OR avg_age = 0 THEN 45.0::double ELSE avg_age END, 6)",
        "CASE WHEN manufacturer IN ('M1', 'M2') THEN 45.0::double ELSE round(avg_age, 6) END",
    ),
    "published_symptoms": f"{SYMPTOMS} SELECT *, '{RUN_TS}' AS __time FROM symptoms",
    "published_geographic": GEOGRAPHIC_ROWS,
    "published_chart": f"""
        {SYMPTOMS}
        SELECT symptom, sum(total_reports)::bigint AS "Total Reportes"
        FROM symptoms GROUP BY symptom ORDER BY 2 DESC, 1 LIMIT 15""",
    "published_datasource": f"""
        {SYMPTOMS} SELECT manufacturer, symptom, total_reports, deaths, hospitalizations FROM symptoms""",
    "run_summary": f"""
        {CURATED}, symptoms AS ({grouped('manufacturer, symptom', 'total_reports')})
        SELECT 'reports_read' AS name, count(*)::bigint AS row_count FROM reports
        UNION ALL SELECT 'symptoms_read', count(*)::bigint FROM lines
        UNION ALL SELECT 'vaccines_read', count(*)::bigint FROM lines
        UNION ALL SELECT 'curated_rows', count(*)::bigint FROM curated
        UNION ALL SELECT 'total_results', count(*)::bigint FROM symptoms
        UNION ALL SELECT 'rejected_rows', 0::bigint""",
    "stream_ingest": TALLY,
    "profile": f"""
        WITH {REPORTS}
        SELECT count(*)::bigint AS row_count,
               (count(*) - count(report_id))::bigint AS report_id_nulls,
               (count(*) - count(died))::bigint AS died_nulls,
               (count(*) - count(hospital))::bigint AS hospital_nulls,
               (count(*) - count(age_given))::bigint AS age_given_nulls,
               (count(*) - count(age_computed))::bigint AS age_computed_nulls
        FROM reports""",
    "quality_report": f"""
        WITH {REPORTS}
        SELECT 'outcome known' AS rule, count(*) FILTER (WHERE died IN ('Y', 'N')) AS passed,
               count(*) FILTER (WHERE (died IN ('Y', 'N')) IS NOT TRUE) AS failed FROM reports
        UNION ALL
        SELECT 'age plausible', count(*) FILTER (WHERE age_given < 80),
               count(*) FILTER (WHERE (age_given < 80) IS NOT TRUE) FROM reports
        UNION ALL
        SELECT 'state named', count(*) FILTER (WHERE length(state) > 0),
               count(*) FILTER (WHERE (length(state) > 0) IS NOT TRUE) FROM reports""",
}
