"""SQL twins of the surveillance queries."""

from __future__ import annotations

from .oracle import CURATED, MEAN_AGE, OUTCOMES, TEXTS, grouped

CUBE_RATES = """
round(avg_age, 6) AS avg_age,
round(deaths * 100.0::double / total_reports, 6) AS death_rate,
round(hospitalizations * 100.0::double / total_reports, 6) AS hospital_rate"""


def key_rule(rule: str, table: str, key: str, limit: float) -> str:
    return f"""
        SELECT '{rule}' AS rule, 'unique key' AS kind, sum(n)::bigint AS checked, sum(n - 1)::bigint AS failed,
               round(sum(n - 1) / sum(n)::double, 6) AS measure, sum(n - 1) / sum(n)::double <= {limit} AS passed
        FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"""


def reference_rule(rule: str, condition: str, limit: float) -> str:
    missing = f"l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {condition})"
    return f"""
        SELECT '{rule}', 'reference', count(*), count(*) FILTER (WHERE {missing}),
               round((count(*) FILTER (WHERE {missing})) / count(*)::double, 6),
               (count(*) FILTER (WHERE {missing})) / count(*)::double <= {limit}
        FROM lineitem"""


ORACLE: dict[str, str] = {
    "cooccurring_symptoms": f"""
        WITH {TEXTS}, terms AS (
          SELECT DISTINCT report_id, name AS term FROM lines
          WHERE length(name) > 7 AND NOT regexp_matches(name, 'ANVIL|ROD') AND name NOT IN ('BLUE RING', 'HOT PLATE')
        ),
        counts AS (SELECT term, count(*) AS n FROM terms GROUP BY term),
        everything AS (SELECT count(DISTINCT report_id)::double AS n FROM terms),
        pairs AS (
          SELECT a.term AS term_a, b.term AS term_b, count(*) AS n
          FROM terms a JOIN terms b ON a.report_id = b.report_id AND a.term < b.term
          GROUP BY 1, 2 HAVING count(*) >= 5
        )
        SELECT term_a, term_b, p.n AS reports_both, a.n AS reports_a, b.n AS reports_b,
               round(p.n / e.n, 6) AS support, round(p.n / a.n::double, 6) AS confidence_ab,
               round(p.n / b.n::double, 6) AS confidence_ba, round(p.n * e.n / (a.n::double * b.n), 6) AS lift
        FROM pairs p JOIN counts a ON term_a = a.term JOIN counts b ON term_b = b.term, everything e""",
    "symptom_evolution": f"""
        {CURATED},
        by_month AS (
          SELECT report_month AS period, manufacturer, symptom, count(*) AS total_reports FROM curated GROUP BY ALL
        ),
        calendar AS (
          SELECT unnest(generate_series((SELECT min(period) FROM by_month), (SELECT max(period) FROM by_month),
                                        INTERVAL 1 MONTH))::date AS period
        ),
        dense AS (
          SELECT k.manufacturer, k.symptom, c.period, coalesce(m.total_reports, 0) AS total_reports
          FROM (SELECT DISTINCT manufacturer, symptom FROM by_month) k CROSS JOIN calendar c
          LEFT JOIN by_month m ON m.manufacturer = k.manufacturer AND m.symptom = k.symptom AND m.period = c.period
        ),
        moved AS (
          SELECT *, lag(total_reports) OVER w AS previous,
                 avg(total_reports) OVER (PARTITION BY manufacturer, symptom ORDER BY period ROWS 2 PRECEDING) AS mean
          FROM dense WINDOW w AS (PARTITION BY manufacturer, symptom ORDER BY period)
        )
        SELECT manufacturer, symptom, period, total_reports, previous, round(mean, 6) AS moving_mean,
               total_reports - previous AS change,
               CASE WHEN previous <> 0 THEN round((total_reports - previous) / previous::double, 6) END AS change_rate
        FROM moved""",
    "dashboard_cube": f"""
        {CURATED}, sets AS (
          SELECT manufacturer, symptom, age_group, grouping_id(manufacturer, symptom, age_group)::bigint AS grouping_id,
                 count(*)::bigint AS total_reports, {OUTCOMES}, avg(age_clean) AS avg_age
          FROM curated GROUP BY CUBE (manufacturer, symptom, age_group)
        )
        SELECT manufacturer, symptom, age_group, grouping_id, total_reports, deaths, hospitalizations, {CUBE_RATES}
        FROM sets""",
    "cube_chart": f"""
        {CURATED}, chart AS ({grouped('symptom', 'total_reports', MEAN_AGE).replace('FROM curated', "FROM curated WHERE manufacturer = 'M2'")})
        SELECT symptom, total_reports, deaths, hospitalizations, {CUBE_RATES} FROM chart""",
    "datasource_sketches": """
        SELECT event_type, count(*)::bigint AS event_count, count(DISTINCT user_id)::bigint AS users,
               true AS users_within, true AS median_within
        FROM events GROUP BY event_type""",
    "cross_table_rules": " UNION ALL ".join(
        [
            key_rule("one row per order", "orders", "o_orderkey", 0),
            key_rule("one line per order", "lineitem", "l_orderkey", 0.1),
            reference_rule("lines have an order", "true", 0),
            reference_rule("lines have an open order", "o_orderstatus = 'O'", 0.25),
            """
        SELECT 'status is stable', 'shift', sum(after)::bigint,
               round(sum(greatest(after / all_after - before / all_before, 0)) * any_value(all_after))::bigint,
               round(sum(abs(after / all_after - before / all_before)) / 2, 6),
               sum(abs(after / all_after - before / all_before)) / 2 <= 0.01
        FROM (SELECT o_orderstatus, count(*) FILTER (WHERE o_orderdate < timestamp '1995-06-01') AS before,
                     count(*) FILTER (WHERE o_orderdate >= timestamp '1995-06-01') AS after FROM orders GROUP BY 1),
             (SELECT (count(*) FILTER (WHERE o_orderdate < timestamp '1995-06-01'))::double AS all_before,
                     (count(*) FILTER (WHERE o_orderdate >= timestamp '1995-06-01'))::double AS all_after FROM orders)""",
            """
        SELECT 'price is positive', 'row', count(*), count(*) FILTER (WHERE (o_totalprice > 0) IS NOT TRUE),
               round((count(*) FILTER (WHERE (o_totalprice > 0) IS NOT TRUE)) / count(*)::double, 6),
               count(*) FILTER (WHERE (o_totalprice > 0) IS NOT TRUE) = 0
        FROM orders""",
        ]
    ),
    "alerts_over_batches": """
        WITH measured AS (
          SELECT (ts >= timestamp '2024-01-16')::int AS batch, event_type, hour(ts)::int AS hour,
                 avg(value) AS mean_value, count(*)::double AS n_events
          FROM events GROUP BY ALL
        ),
        limits(alert, threshold) AS (VALUES ('mean is high', 52.0::double), ('many events', 44.0::double)),
        tested AS (
          SELECT batch, event_type, hour, alert, threshold,
                 CASE alert WHEN 'mean is high' THEN mean_value ELSE n_events END AS value
          FROM measured CROSS JOIN limits
        ),
        early AS (SELECT * FROM tested WHERE batch = 0 AND value > threshold),
        late AS (SELECT * FROM tested WHERE batch = 1)
        SELECT coalesce(l.event_type, e.event_type) AS event_type, coalesce(l.hour, e.hour) AS hour,
               coalesce(l.alert, e.alert) AS alert,
               CASE WHEN l.alert IS NULL THEN 'on' WHEN l.value <= l.threshold THEN 'cleared'
                    WHEN e.alert IS NULL THEN 'raised' ELSE 'on' END AS status,
               round(CASE WHEN l.alert IS NULL THEN e.value ELSE l.value END, 6) AS value,
               coalesce(l.threshold, e.threshold) AS threshold,
               CASE WHEN e.alert IS NULL THEN 1 ELSE 0 END::bigint AS since
        FROM late l FULL JOIN early e ON l.event_type = e.event_type AND l.hour = e.hour AND l.alert = e.alert
        WHERE l.alert IS NULL OR l.value > l.threshold OR e.alert IS NOT NULL""",
    "csv_quarantine": """
        SELECT CASE WHEN good THEN event_id END AS event_id, CASE WHEN good THEN event_type END AS event_type,
               CASE WHEN good THEN value END AS value,
               CASE event_type WHEN 'view' THEN 'value' WHEN 'click' THEN 'number of fields'
                    WHEN 'error' THEN 'number of fields' END AS reason,
               CASE event_type WHEN 'view' THEN 'value' WHEN 'click' THEN '' WHEN 'error' THEN '' END AS bad,
               CASE event_type WHEN 'view' THEN concat(event_id, ',"view,', chr(10), '",n/a')
                    WHEN 'click' THEN concat(event_id, ',click')
                    WHEN 'error' THEN concat(event_id, ',"a', chr(10), repeat(chr(34), 2), 'b', repeat(chr(34), 3), ',', event_id, ',more') END AS record
        FROM (SELECT *, event_type NOT IN ('view', 'click', 'error') AS good FROM events)""",
}
