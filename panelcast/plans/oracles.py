"""Independent SQL for the registered queries, run by DuckDB on the same tables.

Named fragments are pulled in with everything they need; each query adds its own final select.
"""

from __future__ import annotations

import math
import re

from panelcast.sources.adapters import EQUIPMENT_COST, EQUIPMENT_TYPES, EQUIPMENT_WEIGHTS, FUNCTIONS

# The documented bound of a device's common variance.
MAX_COMMON = 0.999


def _values(rows) -> str:
    def cell(v):
        return f"'{v}'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


FRAGMENTS: dict[str, str] = {
    "places": "SELECT n_nationkey, n_name AS trust_code, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    "lines": """
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, trust_code, region, p_brand, p_type,
               CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT) AS brand_no, l_quantity, l_linestatus
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN places ON s_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey""",
    "order_lines": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, trust_code, region, o_custkey,
               o_orderstatus, o_orderpriority, o_orderdate, c_mktsegment
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey""",
    "procedures": """
        SELECT date, trust_code, region, 'F' || CAST((brand_no - 1) // 5 AS VARCHAR) AS opcs_chapter,
               p_brand AS procedure_code, CAST(sum(l_quantity) AS BIGINT) AS n_procedures
        FROM lines GROUP BY ALL""",
    "imaging": "SELECT date, trust_code, region, ' ' || p_type || ' ' AS modality, count(*) AS n_tests FROM lines GROUP BY ALL",
    "activity": "SELECT date, trust_code, region, l_linestatus AS activity_type, count(*) AS n_activity FROM lines GROUP BY ALL",
    "rtt": """
        SELECT date, trust_code, region, o_orderpriority AS treatment_function,
               count(*) FILTER (WHERE o_orderstatus <> 'F') AS waiting_list_size,
               100 * avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_within_18wk
        FROM order_lines GROUP BY ALL""",
    "demographics": """
        SELECT year(o_orderdate) AS year, region, c_mktsegment AS age_band, count(DISTINCT o_custkey) AS population
        FROM order_lines GROUP BY ALL""",
    "supply": """
        SELECT CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS quarter,
               p_type AS category, sum(l_extendedprice) AS spend_gbp, CAST(sum(l_quantity) AS BIGINT) AS units
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "sheet_months": """
        SELECT date, CAST(sum(waiting_list_size) AS BIGINT) AS total, year(date) * 12 + month(date) AS month_no
        FROM rtt GROUP BY date""",
    "sheet": """
        SELECT month_no AS row_no, CASE WHEN month_no % 11 = 0 THEN NULL ELSE date END AS day,
               CASE WHEN month_no % 3 = 0 THEN total ELSE total + 5 END AS value FROM sheet_months
        UNION ALL
        SELECT month_no + 1000000, CAST(date + INTERVAL 14 DAY AS DATE), total * 2 FROM sheet_months WHERE month_no % 7 = 0""",
    "national": """
        SELECT CAST(date_trunc('month', day) AS DATE) AS date, CAST(arg_max(value, row_no) AS DOUBLE) AS value
        FROM sheet WHERE day IS NOT NULL GROUP BY ALL""",
    "mapping": f"SELECT * FROM (VALUES {_values(r for r in EQUIPMENT_WEIGHTS if r[2] > 0)}) m(procedure_code, equipment_type, weight, map_type, source)",
    # ---- monthly panel
    "months": """
        SELECT CAST(unnest(generate_series(CAST((SELECT min(date) FROM procedures) AS TIMESTAMP),
               CAST((SELECT max(date) FROM procedures) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS date""",
    "dense": """
        SELECT s.trust_code, s.region, s.procedure_code, m.date, coalesce(p.n_procedures, 0) AS y
        FROM (SELECT DISTINCT trust_code, region, procedure_code FROM procedures) s CROSS JOIN months m
        LEFT JOIN procedures p ON p.trust_code = s.trust_code AND p.region = s.region
             AND p.procedure_code = s.procedure_code AND p.date = m.date""",
    "naive_panel": """
        SELECT trust_code, region, procedure_code, date, y,
               CAST(lag(y, 12) OVER (PARTITION BY trust_code, region, procedure_code ORDER BY date) AS DOUBLE) AS point,
               1.2816 * stddev_samp(y) OVER (PARTITION BY trust_code, region, procedure_code) AS spread
        FROM dense""",
    "leaf": """
        SELECT trust_code, region, procedure_code, date, y AS actual, point AS yhat,
               greatest(point - spread, 0.0) AS yhat_lower, point + spread AS yhat_upper
        FROM naive_panel WHERE point IS NOT NULL
          AND date > (SELECT max(date) FROM procedures) - INTERVAL 12 MONTH""",
    "levels": """
        SELECT 'trust' AS level, trust_code, region, procedure_code, date, yhat, yhat_lower, yhat_upper FROM leaf
        UNION ALL
        SELECT 'regional', NULL, region, procedure_code, date, sum(yhat), sum(yhat_lower), sum(yhat_upper)
        FROM leaf GROUP BY region, procedure_code, date
        UNION ALL
        SELECT 'national', NULL, NULL, procedure_code, date, sum(yhat), sum(yhat_lower), sum(yhat_upper)
        FROM leaf GROUP BY procedure_code, date""",
    "calendar": """
        SELECT *, month(date) AS month, quarter(date) AS quarter, year(date) AS year,
               sin(2 * pi() * month(date) / 12) AS sin_month, cos(2 * pi() * month(date) / 12) AS cos_month,
               (year(date) - (SELECT min(year(date)) FROM procedures)) * 12 + month(date) - 1 AS time_idx
        FROM procedures""",
    "lagged": """
        SELECT *, {lags}, {rolls} FROM calendar
        WINDOW w AS (PARTITION BY trust_code, procedure_code ORDER BY date),
               w3 AS (PARTITION BY trust_code, procedure_code ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
               w6 AS (PARTITION BY trust_code, procedure_code ORDER BY date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING),
               w12 AS (PARTITION BY trust_code, procedure_code ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
        """.format(
        lags=", ".join(f"lag(n_procedures, {k}) OVER w AS n_procedures_lag{k}" for k in (1, 2, 3, 6, 12)),
        rolls=", ".join(
            f"CASE WHEN count(n_procedures) OVER w{k} = {k} THEN avg(n_procedures) OVER w{k} END AS n_procedures_rollmean{k}, "
            f"CASE WHEN count(n_procedures) OVER w{k} = {k} THEN stddev_samp(n_procedures) OVER w{k} END AS n_procedures_rollstd{k}"
            for k in (3, 6, 12))),
    "mixed": """
        SELECT *, n_procedures / nullif(sum(n_procedures) OVER (PARTITION BY trust_code, date), 0)::DOUBLE AS proc_mix_share,
               CASE opcs_chapter WHEN 'F0' THEN '1-URGENT' WHEN 'F1' THEN '2-HIGH' WHEN 'F2' THEN '3-MEDIUM'
                    WHEN 'F3' THEN '4-NOT SPECIFIED' WHEN 'F4' THEN '5-LOW' END AS treatment_function
        FROM lagged""",
    "pressed": """
        SELECT m.*, r.waiting_list_size AS wl_size, r.pct_within_18wk AS wl_pct_18wk
        FROM mixed m LEFT JOIN rtt r USING (date, trust_code, treatment_function)""",
    "older": """
        SELECT region, year, sum(CASE WHEN age_band IN ('BUILDING', 'MACHINERY') THEN population ELSE 0 END)::DOUBLE
               / sum(population) AS pop_65plus_share
        FROM demographics GROUP BY ALL""",
    "shared": """
        SELECT *, last_value(raw_share IGNORE NULLS) OVER (
                   PARTITION BY region ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pop_65plus_share
        FROM (SELECT p.*, o.pop_65plus_share AS raw_share FROM pressed p
              LEFT JOIN older o ON p.region = o.region AND p.year = o.year)""",
    "feature_table": """
        SELECT *, lag(wl_size) OVER w AS wl_size_lag1, lag(wl_pct_18wk) OVER w AS wl_pct_18wk_lag1,
               lag(proc_mix_share) OVER w AS proc_mix_share_lag1,
               lag(wl_size) OVER c AS wl_size_compat, lag(wl_pct_18wk) OVER c AS wl_pct_compat
        FROM shared
        WINDOW w AS (PARTITION BY trust_code, procedure_code ORDER BY date),
               c AS (PARTITION BY trust_code, treatment_function ORDER BY procedure_code, date)""",
    # ---- demand and scenarios
    "demand": """
        SELECT level, trust_code, region, date, equipment_type, demand, greatest(demand - half, 0.0) AS demand_lower,
               demand + half AS demand_upper
        FROM (SELECT level, trust_code, region, date, equipment_type, sum(yhat * weight) AS demand,
                     1.2816 * sqrt(sum(weight * weight * pow((yhat_upper - yhat_lower) / (2 * 1.2816), 2))) AS half
              FROM levels JOIN mapping USING (procedure_code) GROUP BY ALL)""",
    "backlog": """
        SELECT CAST(sum(waiting_list_size) AS DOUBLE) AS total FROM (
            SELECT arg_max(waiting_list_size, date) AS waiting_list_size FROM rtt GROUP BY trust_code, treatment_function)""",
    "uplifted": """
        SELECT l.*, CASE WHEN dense_rank() OVER (ORDER BY date) <= {months}
                         THEN yhat / nullif(sum(yhat) OVER (PARTITION BY date), 0) * (SELECT total FROM backlog) * 0.3 / {months}
                         ELSE 0 END AS uplift FROM leaf l""",
    "capped": """
        SELECT *, first_value(yhat) OVER w * pow(1.05, (row_number() OVER w - 1) / 12.0::DOUBLE) AS ceiling FROM leaf
        WINDOW w AS (PARTITION BY trust_code, region, procedure_code ORDER BY date)""",
    "scenario_leaf": """
        SELECT 'baseline' AS scenario, trust_code, region, procedure_code, date, yhat, yhat_lower, yhat_upper FROM leaf
        UNION ALL
        SELECT 'backlog_clear', trust_code, region, procedure_code, date, yhat + uplift, yhat_lower + uplift, yhat_upper + uplift
        FROM ({uplifted12})
        UNION ALL
        SELECT 'capacity_cap', trust_code, region, procedure_code, date, least(yhat, ceiling), least(yhat_lower, ceiling),
               least(yhat_upper, ceiling) FROM capped""",
    "scenario_levels": """
        SELECT scenario, 'trust' AS level, trust_code, region, procedure_code, date, yhat, yhat_lower, yhat_upper FROM scenario_leaf
        UNION ALL
        SELECT scenario, 'regional', NULL, region, procedure_code, date, sum(yhat), sum(yhat_lower), sum(yhat_upper)
        FROM scenario_leaf GROUP BY scenario, region, procedure_code, date
        UNION ALL
        SELECT scenario, 'national', NULL, NULL, procedure_code, date, sum(yhat), sum(yhat_lower), sum(yhat_upper)
        FROM scenario_leaf GROUP BY scenario, procedure_code, date""",
    "equipment": """
        SELECT scenario, level, trust_code, region, date, equipment_type, demand,
               greatest(demand - half, 0.0) AS demand_lower, demand + half AS demand_upper
        FROM (SELECT scenario, level, trust_code, region, date, equipment_type, sum(yhat * weight) AS demand,
                     1.2816 * sqrt(sum(weight * weight * pow((yhat_upper - yhat_lower) / (2 * 1.2816), 2))) AS half
              FROM scenario_levels JOIN mapping USING (procedure_code) GROUP BY ALL)""",
    # ---- devices
    "raw_events": """
        SELECT event_id, ts, event_type, value, CAST(user_id % 16 AS INT) AS device_no,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS k FROM events""",
    "devices": """
        SELECT 'dev' || device_no AS device_id, 'type' || (device_no % 3) AS device_type,
               'site' || (device_no % 6) AS site_id, 'region' || (device_no % 6 % 3) AS region,
               'specialty' || (device_no % 4) AS specialty,
               CAST(500 + 50 * device_no AS DOUBLE) AS price, CAST(500 + 50 * device_no AS DOUBLE) * 20 AS fixed_cost,
               CAST(500 + 50 * device_no AS DOUBLE) * 20 * 0.35::DOUBLE AS floor_cost,
               CAST(ceil(count(*) FILTER (WHERE event_type IN ('view', 'click'))::DOUBLE
                    / count(DISTINCT CAST(ts AS DATE)) * 1.25::DOUBLE) + device_no % 3 AS INT) AS cap_sessions_day
        FROM raw_events GROUP BY device_no""",
    "active": """
        SELECT 'e' || event_id AS event_id, 'dev' || device_no AS device_id, 'site' || (device_no % 6) AS site_id,
               'op' || (k % 4) AS operator_hash, event_type IN ('view', 'click') AS is_start, ts, event_id AS seq,
               CASE WHEN k % 20 = 0 THEN 0 ELSE value * 10 END AS seconds, k % 3 AS n_errors,
               'Brand#' || (1 + k % 25) AS procedure_code, CASE WHEN k % 33 = 0 THEN 'suspect' ELSE 'ok' END AS quality
        FROM raw_events WHERE event_type <> 'error'""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY device_id, is_start ORDER BY seq) AS pair_no,
               row_number() OVER (PARTITION BY device_id ORDER BY seq) AS place FROM active""",
    "paired": """
        SELECT e.event_id AS session_id, s.device_id, s.site_id, s.operator_hash, s.procedure_code, s.ts AS t_start,
               e.ts AS t_end, CASE WHEN e.seconds > 0 THEN e.seconds ELSE (epoch_us(e.ts) - epoch_us(s.ts)) / 1e6::DOUBLE END AS active_seconds,
               e.n_errors, e.quality
        FROM ranked s JOIN ranked e ON s.device_id = e.device_id AND s.pair_no = e.pair_no
        WHERE s.is_start AND NOT e.is_start""",
    "sessions": "SELECT * EXCLUDE (quality), active_seconds >= 180 AND quality = 'ok' AS billable FROM paired",
    "billed": """
        SELECT s.*, CASE WHEN billable THEN d.price ELSE 0 END AS billed_amount_gbp
        FROM sessions s LEFT JOIN devices d ON s.device_id = d.device_id""",
    "exposure": """
        SELECT 'dev' || device_no AS device_id, CAST(ts AS DATE) AS date,
               (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE / 3600.0::DOUBLE AS exposure_hours
        FROM raw_events GROUP BY ALL""",
    "rollup": """
        SELECT device_id, CAST(t_start AS DATE) AS date, count(*) AS n_sessions,
               count(*) FILTER (WHERE billable) AS n_billable, sum(active_seconds) AS active_seconds,
               CAST(sum(n_errors) AS BIGINT) AS n_errors, count(DISTINCT operator_hash) AS n_operators,
               sum(billed_amount_gbp) AS billed_gbp
        FROM billed GROUP BY ALL""",
    "device_day": """
        SELECT e.device_id, e.date, coalesce(n_sessions, 0) AS n_sessions, coalesce(n_billable, 0) AS n_billable,
               coalesce(active_seconds, 0) AS active_seconds, exposure_hours, coalesce(n_errors, 0) AS n_errors,
               coalesce(n_operators, 0) AS n_operators, coalesce(billed_gbp, 0) AS billed_gbp
        FROM exposure e LEFT JOIN rollup r ON e.device_id = r.device_id AND e.date = r.date""",
    "device_calendar": """
        SELECT *, sin(2 * pi() * (isodow(date) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(date) - 1) / 7) AS dow_cos,
               sin(2 * pi() * dayofyear(date) / 365.25::DOUBLE) AS doy_sin, cos(2 * pi() * dayofyear(date) / 365.25::DOUBLE) AS doy_cos,
               CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
               (date - (SELECT min(date) FROM exposure)) / 365.25::DOUBLE AS trend
        FROM device_day""",
    "herfindahl": """
        SELECT device_id, date, sum(n * n)::DOUBLE / (sum(n) * sum(n))::DOUBLE AS op_herfindahl
        FROM (SELECT d.device_id, d.date, s.operator_hash, count(*) AS n
              FROM (SELECT DISTINCT device_id, CAST(t_start AS DATE) AS date FROM sessions) d
              JOIN sessions s ON s.device_id = d.device_id
                   AND CAST(s.t_start AS DATE) BETWEEN d.date - 27 AND d.date
              GROUP BY ALL) GROUP BY ALL""",
    "device_windows": """
        SELECT c.*, v.region, v.specialty, v.device_type, v.cap_sessions_day, coalesce(h.op_herfindahl, 0) AS op_herfindahl,
               {lags}, {rolls},
               n_errors / nullif(n_sessions, 0)::DOUBLE AS err_per_session,
               CASE WHEN count(*) OVER w28 >= 3 THEN CAST(max(n_operators) OVER w28 AS DOUBLE) ELSE 1.0 END AS active_ops_28,
               (sum(n_billable) OVER (PARTITION BY v.region, c.date) - n_billable)::DOUBLE
                 / greatest(count(*) OVER (PARTITION BY v.region, c.date) - 1, 1) AS peer_util
        FROM device_calendar c LEFT JOIN devices v ON c.device_id = v.device_id
        LEFT JOIN herfindahl h ON c.device_id = h.device_id AND c.date = h.date
        WINDOW w AS (PARTITION BY c.device_id ORDER BY c.date),
               w7 AS (PARTITION BY c.device_id ORDER BY c.date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
               w28 AS (PARTITION BY c.device_id ORDER BY c.date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""".format(
        lags=", ".join(f"lag(n_billable, {k}) OVER w AS n_billable_lag{k}" for k in (1, 7, 14)),
        rolls=", ".join(
            f"CASE WHEN count(n_billable) OVER w{k} >= 2 THEN avg(n_billable) OVER w{k} END AS n_billable_rollmean{k}, "
            f"CASE WHEN count(n_billable) OVER w{k} >= 2 THEN stddev_samp(n_billable) OVER w{k} END AS n_billable_rollstd{k}"
            for k in (7, 28))),
    "device_features": """
        SELECT * EXCLUDE (exposure_hours), greatest(exposure_hours, 0.5) AS exposure_hours, 0.0::DOUBLE AS downtime_frac_28,
               CASE WHEN count(err_per_session) OVER w28 >= 3 THEN avg(err_per_session) OVER w28 ELSE 0.0 END AS err_rate_28,
               coalesce(lag(peer_util) OVER w, 0.0) AS peer_util_lag1
        FROM device_windows
        WINDOW w AS (PARTITION BY device_id ORDER BY date),
               w28 AS (PARTITION BY device_id ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
    "scored": """
        SELECT *, greatest(mu - sqrt(variance), 0.0) AS lo, mu + sqrt(variance) AS hi, CAST(n_billable AS DOUBLE) AS y FROM (
          SELECT *, mu + 0.1::DOUBLE * mu * mu AS variance FROM (
            SELECT *, greatest(exp(-1.2::DOUBLE + dow_sin * 0.05::DOUBLE - dow_cos * 0.03::DOUBLE + n_billable_lag1 * 0.1::DOUBLE
                     + n_billable_rollmean7 * 0.02::DOUBLE + op_herfindahl * 0.03::DOUBLE + ln(exposure_hours)), 1e-6) AS mu
            FROM device_features WHERE n_billable_rollmean7 IS NOT NULL AND n_billable_lag1 IS NOT NULL))""",
    # ---- risk
    "panel": """
        SELECT device_id, date, CAST(sum(n_billable) AS DOUBLE) AS x FROM device_day
        WHERE date >= (SELECT max(date) FROM device_day) - 120 GROUP BY ALL""",
    "centred": """
        SELECT g.device_id, g.date, coalesce(p.x, 0) - avg(coalesce(p.x, 0)) OVER (PARTITION BY g.device_id) AS x
        FROM (SELECT * FROM (SELECT DISTINCT device_id FROM panel) CROSS JOIN (SELECT DISTINCT date FROM panel)) g
        LEFT JOIN panel p ON p.device_id = g.device_id AND p.date = g.date""",
    "sample_cov": """
        SELECT a.device_id AS dev_a, b.device_id AS dev_b, sum(a.x * b.x) / count(*) AS s
        FROM centred a JOIN centred b ON a.date = b.date GROUP BY ALL""",
    "moments": """
        SELECT (SELECT count(DISTINCT date) FROM panel) AS n, (SELECT count(DISTINCT device_id) FROM panel) AS p,
               (SELECT sum(s) FROM sample_cov WHERE dev_a = dev_b) / (SELECT count(DISTINCT device_id) FROM panel) AS m,
               (SELECT sum(s * s) FROM sample_cov) AS s2,
               (SELECT sum(r * r) FROM (SELECT sum(x * x) AS r FROM centred GROUP BY date)) AS r2""",
    "shrink": """
        SELECT n, p, m, CASE WHEN d2 <= 0 THEN 0 ELSE least(greatest((r2 / n - s2) / n, 0), d2) / d2 END AS s
        FROM (SELECT *, s2 - p * m * m AS d2 FROM moments)""",
    "covariance": """
        SELECT dev_a, dev_b, CASE WHEN n < 10 OR p < 2 THEN CASE WHEN dev_a = dev_b THEN 1 ELSE 0 END
               ELSE (1 - k.s) * c.s + CASE WHEN dev_a = dev_b THEN k.s * m ELSE 0 END END AS cov
        FROM sample_cov c CROSS JOIN shrink k""",
    "positions": """
        SELECT g.*, d.site_id, d.region, d.specialty, d.price AS price_per_session_gbp, d.floor_cost * (7 / 30.4::DOUBLE) AS floor_gbp,
               d.fixed_cost * (7 / 30.4::DOUBLE) AS fixed_gbp,
               CAST(cap_day * (SELECT CASE WHEN n > 0 THEN n ELSE 7 END FROM (
                   SELECT count(*) AS n FROM (SELECT DISTINCT date FROM week) WHERE isodow(date) < 6)) AS DOUBLE) AS cap_sessions
        FROM (SELECT device_id, sum(mu) AS exp_sessions, sum(mu + 0.1::DOUBLE * mu * mu) AS var_sessions, min(cap_sessions_day) AS cap_day
              FROM week GROUP BY device_id) g JOIN devices d ON g.device_id = d.device_id""",
    "week": f"""
        SELECT w.device_id, last_date + step AS date, mu, CASE WHEN isodow(last_date + step) >= 6 THEN 4.0::DOUBLE ELSE 10.0::DOUBLE END AS exposure_hours,
               d.cap_sessions_day
        FROM (WITH RECURSIVE walk AS (
                SELECT device_id, 0 AS step, date AS last_date, CAST(n_billable AS DOUBLE) AS mu FROM device_features
                WHERE (device_id, date) IN (SELECT (device_id, max(date)) FROM device_features GROUP BY device_id)
                UNION ALL
                SELECT device_id, step + 1, last_date, greatest(exp(-1.0::DOUBLE
                       + 0.05::DOUBLE * sin({2 * math.pi / 7!r}::DOUBLE * (isodow(last_date + step + 1) - 1)) + 0.04::DOUBLE * mu
                       + ln(CASE WHEN isodow(last_date + step + 1) >= 6 THEN 4.0::DOUBLE ELSE 10.0::DOUBLE END)), 1e-6)
                FROM walk WHERE step < 7) SELECT * FROM walk) w JOIN devices d ON w.device_id = d.device_id WHERE step > 0""",
    "draws": """
        SELECT sim, device_id, sessions, greatest(sessions * price_per_session_gbp, floor_gbp) AS revenue FROM (
            SELECT sim, p.*, least(floor(exp_sessions * (((sim * 7919 + number * 104729) * (sim + 31 * number) % 1000003)
                   / 1000003::DOUBLE + 0.5::DOUBLE)), cap_sessions) AS sessions
            FROM (SELECT *, CAST(regexp_extract(device_id, '([0-9]+)', 1) AS BIGINT) AS number FROM positions) p
            CROSS JOIN range(1, 4001) r(sim))""",
    "books": "SELECT sim, sum(revenue) AS book_revenue FROM draws GROUP BY sim",
    "losses": "SELECT book_revenue, (SELECT sum(fixed_gbp) FROM positions) - book_revenue AS loss FROM books",
    "tail": """
        SELECT avg(book_revenue) AS expected_revenue_gbp, stddev_pop(book_revenue) AS revenue_std_gbp,
               (SELECT sum(fixed_gbp) FROM positions) AS fixed_cost_gbp, -avg(loss) AS expected_margin_gbp,
               (SELECT quantile_cont(loss, 0.95) FROM losses) AS var_loss_gbp,
               avg(loss) FILTER (WHERE loss >= (SELECT quantile_cont(loss, 0.95) FROM losses)) AS cvar_loss_gbp,
               avg(CASE WHEN loss > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS prob_book_loss, 0.05::DOUBLE AS alpha
        FROM losses""",
    "statistics": """
        SELECT d.device_id, avg(revenue) AS exp_revenue, stddev_pop(revenue) AS sigma,
               CASE WHEN avg(revenue) > 0 THEN stddev_pop(revenue) / avg(revenue) ELSE 0 END AS cv,
               CASE WHEN var_pop(book_revenue - revenue) > 0
                    THEN covar_samp(revenue, book_revenue - revenue) / var_pop(book_revenue - revenue) ELSE 0 END AS beta,
               avg(sessions) AS exp_sessions, quantile_cont(sessions, 0.05) AS uar_p5,
               avg(CASE WHEN revenue <= floor_gbp + 1e-6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS floor_breach_prob
        FROM draws d JOIN books b ON d.sim = b.sim JOIN positions p ON d.device_id = p.device_id GROUP BY d.device_id""",
    "priced": """
        SELECT s.*, p.fixed_gbp, p.fixed_gbp / greatest(exp_sessions, 1.0) * (1 + 0.5::DOUBLE * cv + 0.3::DOUBLE
               * tanh(beta / greatest((SELECT avg(sigma) FROM statistics), 1e-9) * sigma)) AS suggested_price
        FROM (SELECT * FROM statistics) s JOIN (SELECT device_id, fixed_gbp FROM positions) p ON s.device_id = p.device_id""",
    "latest_herfindahl": "SELECT device_id, coalesce(arg_max(op_herfindahl, date), 0) AS op_herfindahl FROM device_features GROUP BY device_id",
    "book": """
        SELECT x.device_id, v.site_id, v.region, v.specialty, round(x.exp_sessions, 2) AS expected_sessions,
               round(exp_revenue, 2) AS expected_revenue_gbp, round(suggested_price, 2) AS suggested_price_gbp,
               round(v.price, 2) AS current_price_gbp, round(uar_p5, 2) AS uar_p5_sessions,
               round(h.op_herfindahl, 4) AS op_herfindahl, round(exp_revenue - x.fixed_gbp, 2) AS expected_margin_gbp
        FROM priced x JOIN devices v ON x.device_id = v.device_id LEFT JOIN latest_herfindahl h ON x.device_id = h.device_id""",
    "feed": """
        SELECT CASE WHEN l_linenumber <> 2 THEN l_orderkey END AS key, l_partkey AS part, l_linenumber AS line FROM lineitem""",
    "feed_counts": """
        SELECT (SELECT count(*) FROM feed) AS n, (SELECT count(*) FROM feed WHERE line = 3) AS negatives,
               (SELECT count(*) FROM feed WHERE line = 7) AS bad_dates,
               (SELECT CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM feed GROUP BY key, part)) AS dupes""",
    "feed_checks": """
        SELECT 'feed' AS dataset, 'non_empty' AS name, n >= 1 AS passed, 'error' AS severity, 'rows=' || n AS detail FROM feed_counts
        UNION ALL SELECT 'feed', 'has_col[' || c || ']', c <> 'absent', 'error', '' FROM (VALUES ('key'), ('day'), ('amount'), ('absent')) v(c)
        UNION ALL SELECT 'feed', 'non_negative[amount]', negatives = 0, 'error', negatives || ' negatives' FROM feed_counts
        UNION ALL SELECT 'feed', 'unique_keys', dupes = 0, 'warn', dupes || ' duplicate keys' FROM feed_counts
        UNION ALL SELECT 'feed', 'valid_dates', bad_dates = 0, 'error', bad_dates || ' unparseable dates' FROM feed_counts""",
}
FRAGMENTS["scenario_leaf"] = FRAGMENTS["scenario_leaf"].format(uplifted12=FRAGMENTS["uplifted"].format(months=12))
FRAGMENTS["uplifted"] = FRAGMENTS["uplifted"].format(months=6)

_NAMES = re.compile(r"\b(" + "|".join(FRAGMENTS) + r")\b")


def _needed(text: str, seen: list[str]) -> list[str]:
    """Fragments the text mentions, dependencies first."""
    for name in dict.fromkeys(_NAMES.findall(text)):
        if name not in seen:
            body = FRAGMENTS[name]
            inner = [n for n in dict.fromkeys(_NAMES.findall(body)) if n != name]
            for n in inner:
                if n not in seen:
                    _needed(n, seen)
            if name not in seen:
                seen.append(name)
    return seen


def _sql(body: str, doubles: str = "", digits: int = 6) -> str:
    """Full statement: needed fragments, the body, and rounding of the named double columns."""
    parts = ",\n".join(f"{n} AS ({FRAGMENTS[n]})" for n in _needed(body, []))
    names = doubles.split()
    shown = "*" if not names else "* REPLACE (" + ", ".join(
        f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in names) + ")"
    head = f"WITH {parts}\n" if parts else ""
    return f"{head}SELECT {shown} FROM ({body}) final_rows"


LEAF = "trust_code, region, procedure_code, date"
BAND = "yhat yhat_lower yhat_upper"
DEMAND = "demand demand_lower demand_upper"
ROLLS = [f"n_procedures_roll{s}{k}" for k in (3, 6, 12) for s in ("mean", "std")]
LAGS = [f"n_procedures_lag{k}" for k in (1, 2, 3, 6, 12)]
SERIES = "date, trust_code, procedure_code"
DEVICE_NUMERIC = (
    "dow_sin dow_cos doy_sin doy_cos trend op_herfindahl active_ops_28 err_rate_28 downtime_frac_28 peer_util_lag1 "
    "n_billable_rollmean7 n_billable_rollstd7 n_billable_rollmean28 n_billable_rollstd28 exposure_hours").split()


def _table_counts() -> str:
    from panelcast.schemas import DATASET_TABLE, TABLES

    loaded = {t: n for n, t in DATASET_TABLE.items()}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {len(s.fields)} AS n_columns, "
        + (f"(SELECT count(*) FROM {loaded[t]}) AS n_rows" if t in loaded else "0 AS n_rows")
        for t, s in TABLES.items())


def _spec_checks() -> str:
    from panelcast.operators.quality import SPECS

    rows = []
    for name, spec in SPECS.items():
        head = f"SELECT '{name}' AS dataset, "
        rows.append(head + f"'non_empty' AS name, count(*) >= {spec.min_rows} AS passed, 'error' AS severity, 'rows=' || count(*) AS detail FROM {name}")
        rows += [head + f"'has_col[{c}]', true, 'error', ''" for c in spec.required_cols]
        rows += [head + f"'non_negative[{c}]', true, 'error', '0 negatives'" for c in spec.non_negative]
        if spec.unique_keys:
            rows.append(head + f"""'unique_keys', count(*) = count(DISTINCT ({', '.join(spec.unique_keys)})), 'warn',
                (count(*) - count(DISTINCT ({', '.join(spec.unique_keys)}))) || ' duplicate keys' FROM {name}""")
        if spec.date_col:
            rows.append(head + "'valid_dates', true, 'error', '0 unparseable dates'")
    return " UNION ALL ".join(rows)


def _runs(source: str, columns: str) -> str:
    halves = ", ".join(f"{c} / 2 AS {c}" for c in columns.split())
    return f"""(SELECT * REPLACE ({halves}), '20240101T000000-aaaaaa' AS run_id FROM {source}
        UNION ALL SELECT *, '20240201T000000-bbbbbb' AS run_id FROM {source})"""


def _top(key: str, k: int) -> str:
    return f"(SELECT {key} FROM procedures GROUP BY {key} ORDER BY sum(n_procedures) DESC, {key} LIMIT {k})"


def _history_band(key: str, level: str, k: int) -> str:
    return f"""
        SELECT {key}, date, history, yhat, yhat_lower, yhat_upper
        FROM (SELECT {key}, date, CAST(sum(n_procedures) AS DOUBLE) AS history FROM procedures
              WHERE {key} IN {_top(key, k)} GROUP BY ALL) h
        FULL JOIN (SELECT {key}, date, sum(yhat) AS yhat, sum(yhat_lower) AS yhat_lower, sum(yhat_upper) AS yhat_upper
              FROM levels WHERE level = '{level}' AND {key} IN {_top(key, k)} GROUP BY ALL) f USING ({key}, date)"""


def _pivot(source: str, key: str, column: str, values, expr: str) -> str:
    cells = ", ".join(f"""{expr} FILTER (WHERE {column} = '{v}') AS "{v}" """ for v in values)
    return f"SELECT {key}, {cells} FROM {source} GROUP BY {key}"


def _metric(expr: str, name: str) -> str:
    return f"SELECT procedure_code, {expr} AS {name} FROM leaf GROUP BY procedure_code"


MAE = "avg(abs(actual - {f}))"
RMSE = "sqrt(avg(pow(actual - {f}, 2)))"
MAPE = "avg(abs(actual - {f}) / greatest(abs(actual), 1)) * 100"


def _evaluated(f: str) -> str:
    return f"{MAE.format(f=f)} AS mae, {RMSE.format(f=f)} AS rmse, {MAPE.format(f=f)} AS mape"


def _portfolio_rows() -> str:
    from panelcast.plans.queries_reports import SUMMARY_METRICS

    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS value FROM tail" for m in SUMMARY_METRICS)


def _fiscal() -> str:
    return """CASE WHEN month(d) >= 4 THEN year(d) || '/' || ((year(d) + 1) % 100)
                   ELSE (year(d) - 1) || '/' || (year(d) % 100) END"""


def oracle_sql() -> dict[str, str]:
    from panelcast.plans.queries_reports import REGIONS

    functions = ", ".join(f"('{f}')" for f in FUNCTIONS)
    spend = ", ".join(f"('{e}', {c})" for e, c in EQUIPMENT_COST.items())
    step = 2 * math.pi / 7
    device = "device_id, date"
    out = {
        # ---- sources
        "a1_conform": _sql("""
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(NULL AS VARCHAR) AS trust_code,
                   CAST(NULL AS VARCHAR) AS region, o_orderpriority AS treatment_function,
                   CAST(NULL AS BIGINT) AS waiting_list_size, CAST(NULL AS DOUBLE) AS pct_within_18wk, o_totalprice AS price
            FROM orders""", "price"),
        "a2_modality_labels": _sql("""
            SELECT date, trust_code, region, CASE lower(trim(modality)) WHEN 'economy' THEN 'Economy' WHEN 'standard' THEN 'Standard'
                   WHEN 'promo' THEN 'Promotional' ELSE modality END AS modality, n_tests FROM imaging"""),
        "a3_activity_labels": _sql("""
            SELECT date, trust_code, region, CASE WHEN lower(trim(activity_type)) = 'o' THEN 'open' ELSE activity_type END AS activity_type,
                   n_activity FROM activity"""),
        "a4_national_series": _sql("SELECT * FROM national", "value"),
        "a5_top_down_allocation": _sql(f"""
            SELECT f.date, s.trust_code, s.region, t.treatment_function,
                   CAST(round_even(f.value * (s.size / (SELECT sum(size) FROM
                        (SELECT count(*) AS size FROM customer JOIN places ON c_nationkey = n_nationkey))::DOUBLE / {len(FUNCTIONS)}), 0)
                        AS BIGINT) AS waiting_list_size, CAST(NULL AS DOUBLE) AS pct_within_18wk
            FROM (SELECT trust_code, region, count(*) AS size FROM customer JOIN places ON c_nationkey = n_nationkey GROUP BY ALL) s
            CROSS JOIN (VALUES {functions}) t(treatment_function)
            CROSS JOIN (
                SELECT g.date, coalesce(last_value(n.value IGNORE NULLS) OVER (ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       first_value(n.value IGNORE NULLS) OVER (ORDER BY g.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
                FROM (SELECT CAST(unnest(generate_series((SELECT CAST(min(date) AS TIMESTAMP) FROM national) - INTERVAL 2 MONTH,
                      (SELECT CAST(max(date) AS TIMESTAMP) FROM national) + INTERVAL 3 MONTH, INTERVAL 1 MONTH)) AS DATE) AS date) g
                LEFT JOIN national n ON g.date = n.date) f"""),
        "a6_month_spine": _sql("""
            SELECT CAST(unnest(generate_series(date_trunc('month', (SELECT min(l_shipdate) FROM lineitem)),
                   date_trunc('month', (SELECT max(l_shipdate) FROM lineitem)), INTERVAL 1 MONTH)) AS DATE) AS date"""),
        "a7_future_index": _sql("""
            SELECT trust_code, procedure_code, CAST(d + to_months(CAST(step AS INT)) AS DATE) AS date, CAST(step AS INT) AS step
            FROM (SELECT trust_code, procedure_code, max(date) AS d FROM procedures GROUP BY ALL) CROSS JOIN range(1, 13) r(step)"""),
        "a9_provenance": _sql("""
            SELECT 'activity' AS source, 'live' AS kind, (SELECT count(*) FROM activity) AS n_rows
            UNION ALL SELECT 'procedures', 'fallback', (SELECT count(*) FROM procedures)
            UNION ALL SELECT 'imaging', 'fallback', (SELECT count(*) FROM imaging)
            UNION ALL SELECT 'rtt', 'fallback', (SELECT count(*) FROM rtt)
            UNION ALL SELECT 'demographics', 'fallback', (SELECT count(*) FROM demographics)
            UNION ALL SELECT 'supply', 'fallback', (SELECT count(*) FROM supply)"""),
        "a11_load_feeds": _sql("""
            SELECT 'activity' AS dataset, activity_type AS label, n_activity::DOUBLE AS n FROM activity
            UNION ALL SELECT 'imaging', modality, n_tests FROM imaging
            UNION ALL SELECT 'procedures', procedure_code, n_procedures FROM procedures
            UNION ALL SELECT 'rtt', treatment_function, waiting_list_size FROM rtt
            UNION ALL SELECT 'demographics', age_band, population FROM demographics
            UNION ALL SELECT 'supply', category, spend_gbp FROM supply""", "n"),
        "a12_quarterly_supply": _sql("""
            SELECT quarter, category, round(units * CASE category WHEN 'F0' THEN 1800.0::DOUBLE WHEN 'F1' THEN 950.0
                   WHEN 'F2' THEN 4200.0 WHEN 'F3' THEN 60.0 END, 2) AS spend_gbp, units
            FROM (SELECT CAST(year(date) AS VARCHAR) || 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter, opcs_chapter AS category,
                         CAST(sum(n_procedures) AS BIGINT) AS units FROM procedures GROUP BY ALL)"""),
        "a13_write_snapshot": _sql("""
            SELECT '2024-01-31' AS snapshot_date, count(*) AS n_rows, CAST(sum(n_procedures) AS BIGINT) AS n_procedures
            FROM procedures WHERE year(date) < 1998
            UNION ALL SELECT '2024-02-29', count(*), CAST(sum(n_procedures) AS BIGINT) FROM procedures"""),
        "a14_latest_snapshot": _sql("SELECT '2024-02-29' AS latest, true AS absent_is_null, count(*) AS n_rows FROM procedures"),
        "a15_read_latest": _sql("SELECT * FROM procedures"),
        "a16_list_snapshots": _sql("""
            SELECT '2024-01-31' AS snapshot_date, count(*) AS n_rows FROM procedures WHERE year(date) < 1998
            UNION ALL SELECT '2024-02-29', count(*) FROM procedures"""),
        "a17_replace_table": _sql("SELECT quarter, category, CAST(NULL AS DOUBLE) AS spend_gbp, units FROM supply"),
        "a18_table_catalogue": _sql(_table_counts()),
        "a19_dim_date": _sql(f"""
            SELECT DISTINCT d AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
                   {_fiscal()} AS fiscal_year
            FROM (SELECT date AS d FROM procedures UNION SELECT date FROM imaging UNION SELECT date FROM rtt UNION SELECT date FROM activity)"""),
        "a20_dim_trust": _sql("SELECT DISTINCT trust_code, region FROM procedures"),
        "a21_adhoc_sql": _sql("""
            SELECT p.region, year(p.date) AS year, CAST(volume AS BIGINT) AS volume, CAST(waiting AS BIGINT) AS waiting
            FROM (SELECT region, date, sum(n_procedures) AS volume FROM procedures GROUP BY ALL) p
            LEFT JOIN (SELECT region, date, sum(waiting_list_size) AS waiting FROM rtt GROUP BY ALL) w
              ON p.region = w.region AND p.date = w.date WHERE month(p.date) = 12"""),
        "a22_append_forecasts": _sql("""
            SELECT r AS run_id, 'naive' AS model, level, count(*) AS n_rows, sum(yhat) AS yhat
            FROM levels CROSS JOIN (VALUES ('run-1'), ('run-2')) v(r) GROUP BY ALL""", "yhat", 3),
        "a23_replace_run": _sql("""
            SELECT 'run-1' AS run_id, level, count(*) AS n_rows, sum(yhat) AS yhat FROM levels WHERE level = 'national' GROUP BY ALL
            UNION ALL SELECT 'run-2', level, count(*), sum(yhat) FROM levels GROUP BY ALL""", "yhat", 3),
        "a24_artifacts": _sql("SELECT level, count(*) AS n_rows, sum(yhat) AS yhat FROM levels GROUP BY ALL", "yhat", 3),
        "a25_run_report": _sql("""
            SELECT 'run-1' AS run_id, 12 AS horizon, count(*) AS n_procedure_forecast_rows, 'parquet' AS procedures_source FROM levels"""),
        "a26_mapping": _sql("""
            SELECT m.procedure_code, equipment_type, CAST(weight AS DOUBLE) AS weight, map_type, volume FROM mapping m
            JOIN (SELECT procedure_code, CAST(sum(n_procedures) AS BIGINT) AS volume FROM procedures GROUP BY ALL) v
              ON m.procedure_code = v.procedure_code"""),
        "a27_equipment_spend": _sql(f"""
            SELECT equipment_type, sum(n_procedures * CAST(weight AS DOUBLE)) AS units,
                   sum(n_procedures * CAST(weight AS DOUBLE)) * CAST(any_value(cost) AS DOUBLE) AS spend_gbp
            FROM procedures JOIN mapping USING (procedure_code) JOIN (VALUES {spend}) c(equipment_type, cost) USING (equipment_type)
            GROUP BY equipment_type""", "units spend_gbp", 3),
        # ---- checks
        "b1_non_empty": _sql("SELECT * FROM feed_checks WHERE name = 'non_empty'"),
        "b2_has_col": _sql("SELECT * FROM feed_checks WHERE name LIKE 'has_col%'"),
        "b3_non_negative": _sql("SELECT * FROM feed_checks WHERE name LIKE 'non_negative%'"),
        "b4_unique_keys": _sql("SELECT * FROM feed_checks WHERE name = 'unique_keys'"),
        "b5_valid_dates": _sql("SELECT * FROM feed_checks WHERE name = 'valid_dates'"),
        "b6_validate": _sql(f"SELECT * FROM ({_spec_checks()}) WHERE dataset = 'procedures'"),
        "b7_error_gate": _sql("SELECT * FROM feed_checks WHERE NOT passed AND severity = 'error'"),
        "b8_default_specs": _sql(_spec_checks()),
        "b8_snapshot_drift": _sql("""
            SELECT metric, current, previous, (current - previous) / abs(previous) AS change FROM (
                SELECT 'rows' AS metric, count(*)::DOUBLE AS current, (count(*) FILTER (WHERE year(date) < 1999))::DOUBLE AS previous FROM procedures
                UNION ALL SELECT 'mean[n_procedures]', avg(n_procedures), avg(n_procedures) FILTER (WHERE year(date) < 1999) FROM procedures)""",
            "current previous change"),
        # ---- monthly features
        "c1_calendar": _sql(f"SELECT {SERIES}, month, quarter, year, sin_month, cos_month, time_idx FROM calendar", "sin_month cos_month"),
        "c2_lags": _sql(f"SELECT {SERIES}, {', '.join(LAGS)} FROM lagged"),
        "c3_rolling": _sql(f"SELECT {SERIES}, {', '.join(ROLLS)} FROM lagged", " ".join(ROLLS)),
        "c4_mix_share": _sql(f"SELECT {SERIES}, proc_mix_share FROM mixed", "proc_mix_share"),
        "c5_treatment_function": _sql(f"SELECT {SERIES}, treatment_function FROM mixed"),
        "c6_pressure": _sql(f"SELECT {SERIES}, wl_size, wl_pct_18wk FROM pressed", "wl_pct_18wk"),
        "c7_pressure_lag": _sql(f"SELECT {SERIES}, wl_size_lag1, wl_pct_18wk_lag1 FROM feature_table", "wl_pct_18wk_lag1"),
        "c7_pressure_lag_compat": _sql(
            f"SELECT {SERIES}, wl_size_compat AS wl_size_lag1, wl_pct_compat AS wl_pct_18wk_lag1 FROM feature_table", "wl_pct_18wk_lag1"),
        "c8_older_share": _sql("SELECT * FROM older", "pop_65plus_share"),
        "c9_older_share_filled": _sql(f"SELECT {SERIES}, pop_65plus_share FROM feature_table", "pop_65plus_share"),
        "c10_category_codes": _sql(f"SELECT {SERIES}, " + ", ".join(
            f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}_idx"
            for c in ("trust_code", "region", "opcs_chapter", "procedure_code")) + " FROM procedures"),
    }
    features = ["month", "quarter", "sin_month", "cos_month", "time_idx", "proc_mix_share", "pop_65plus_share",
                *LAGS, *ROLLS, "trust_code", "region", "opcs_chapter", "procedure_code", "n_procedures", "date"]
    rounded_features = "sin_month cos_month proc_mix_share pop_65plus_share wl_pct_18wk_lag1 " + " ".join(ROLLS)
    out.update({
        "c12_feature_table": _sql(
            f"SELECT {', '.join(features)}, wl_size_lag1, wl_pct_18wk_lag1, proc_mix_share_lag1 FROM feature_table",
            rounded_features + " proc_mix_share_lag1"),
        "c12_feature_table_compat": _sql(
            f"SELECT {', '.join(features)}, wl_size_compat AS wl_size_lag1, wl_pct_compat AS wl_pct_18wk_lag1 FROM feature_table",
            rounded_features),
        # ---- forecasting
        "d1_tag": _sql(f"SELECT {LEAF}, yhat, yhat_lower, yhat_upper, 'naive' AS model, 'run-1' AS run_id FROM leaf", BAND, 4),
        "d2_mae": _sql(_metric(MAE.format(f="yhat"), "mae"), "mae"),
        "d3_rmse": _sql(_metric(RMSE.format(f="yhat"), "rmse"), "rmse"),
        "d4_mape": _sql(_metric(MAPE.format(f="yhat"), "mape"), "mape"),
        "d5_evaluate": _sql(f"SELECT {_evaluated('yhat')} FROM leaf", "mae rmse mape"),
        "d6_temporal_split": _sql("""
            SELECT *, CASE WHEN date < (SELECT min(date) FROM (SELECT DISTINCT date FROM procedures ORDER BY date DESC LIMIT 12))
                      THEN 'train' ELSE 'test' END AS part FROM procedures"""),
        "d7_training_rows": _sql(f"SELECT {SERIES}, n_procedures, n_procedures_lag12 FROM lagged WHERE n_procedures_lag12 IS NOT NULL"),
        "d9_ar_state": _sql("SELECT trust_code, procedure_code, " + ", ".join(
            [f"CAST(max(n_procedures) FILTER (WHERE back = {k}) AS DOUBLE) AS n_procedures_lag{k}" for k in (1, 2, 3, 6, 12)]
            + [f"avg(n_procedures) FILTER (WHERE back <= {w}) AS n_procedures_rollmean{w}, "
               f"coalesce(stddev_samp(n_procedures) FILTER (WHERE back <= {w}), 0) AS n_procedures_rollstd{w}" for w in (3, 6, 12)])
            + """ FROM (SELECT *, row_number() OVER (PARTITION BY trust_code, procedure_code ORDER BY date DESC) AS back FROM procedures)
            GROUP BY trust_code, procedure_code""", " ".join(ROLLS)),
        "d10_driver_state": _sql("""
            SELECT trust_code, procedure_code, date AS last_date, region, opcs_chapter, proc_mix_share, CAST(wl_size AS DOUBLE) AS wl_size,
                   wl_pct_18wk, pop_65plus_share
            FROM (SELECT *, row_number() OVER (PARTITION BY trust_code, procedure_code ORDER BY date DESC) AS back FROM feature_table)
            WHERE back = 1""", "proc_mix_share wl_pct_18wk pop_65plus_share"),
        "d11_given_forest": _sql("""
            SELECT trust_code, region, procedure_code, CAST(last + to_months(step) AS DATE) AS date, h[len(h)] AS yhat,
                   b[1] AS yhat_lower, b[3] AS yhat_upper
            FROM (WITH RECURSIVE walk AS (
                SELECT trust_code, arg_max(region, date) AS region, procedure_code, date_trunc('month', max(date)) AS last,
                       list(CAST(n_procedures AS DOUBLE) ORDER BY date) AS h, [0.0::DOUBLE] AS b, 0 AS step
                FROM procedures GROUP BY trust_code, procedure_code
                UNION ALL
                SELECT trust_code, region, procedure_code, last, list_append(h, b[2]), b, step
                FROM (SELECT * REPLACE (list_sort(list_transform([0.5, 1.0, 1.5], lambda s: greatest(0.0, level * (s
                                 + CASE WHEN h[len(h)] / level <= 1 THEN -0.125 ELSE 0.125 END
                                 + CASE WHEN month(last + to_months(step)) <= 6 THEN 0.0625 ELSE -0.0625 END)))) AS b)
                      FROM (SELECT trust_code, region, procedure_code, last, h, b, step + 1 AS step,
                                   greatest(list_avg(h[greatest(len(h) - 11, 1) :]), 1.0) AS level FROM walk WHERE step < 12)))
              SELECT * FROM walk WHERE step > 0)""", BAND, 3),
        "d12_monotone_band": _sql("""
            SELECT date, trust_code, procedure_code, least(a, b, c) AS yhat_lower, a + b + c - least(a, b, c) - greatest(a, b, c) AS yhat,
                   greatest(a, b, c) AS yhat_upper
            FROM (SELECT *, greatest(CAST(n_procedures_lag1 - 20 AS DOUBLE), 0) AS a, greatest(CAST(n_procedures - 40 AS DOUBLE), 0) AS b,
                         CAST(n_procedures_lag2 AS DOUBLE) AS c FROM lagged WHERE n_procedures_lag2 IS NOT NULL)"""),
        "d15_windows": _sql("""
            SELECT date, trust_code, procedure_code, next_value, oldest, newest, window_sum FROM (
                SELECT date, trust_code, procedure_code, n_procedures AS next_value, n_procedures_lag12 AS oldest, n_procedures_lag1 AS newest,
                       CAST(sum(n_procedures) OVER (PARTITION BY trust_code, procedure_code ORDER BY date
                            ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS BIGINT) AS window_sum FROM lagged) WHERE oldest IS NOT NULL"""),
        "d16_zscore": _sql("""
            SELECT p.trust_code, p.procedure_code, p.date, p.n_procedures, mu, sd, (n_procedures - mu) / sd AS z
            FROM procedures p JOIN (
                SELECT trust_code, procedure_code, avg(n_procedures) AS mu, stddev_pop(n_procedures) + 1e-6::DOUBLE AS sd
                FROM procedures GROUP BY ALL HAVING count(*) >= 18) s USING (trust_code, procedure_code)""", "mu sd z", 5),
        "d20_bottom_up": _sql("SELECT * FROM levels", BAND, 4),
        "d20_bottom_up_independent": _sql("""
            SELECT 'trust' AS level, trust_code, region, procedure_code, date, yhat, yhat_lower, yhat_upper FROM leaf
            UNION ALL
            SELECT 'regional', NULL, region, procedure_code, date, sum(yhat), sum(yhat) - sqrt(sum(pow(yhat - yhat_lower, 2))),
                   sum(yhat) + sqrt(sum(pow(yhat_upper - yhat, 2))) FROM leaf GROUP BY region, procedure_code, date
            UNION ALL
            SELECT 'national', NULL, NULL, procedure_code, date, sum(yhat), sum(yhat) - sqrt(sum(pow(yhat - yhat_lower, 2))),
                   sum(yhat) + sqrt(sum(pow(yhat_upper - yhat, 2))) FROM leaf GROUP BY procedure_code, date""", BAND, 4),
        "d21_middle_out": _sql("""
            SELECT 'trust' AS level, s.trust_code, r.region, r.procedure_code, r.date, yhat * coalesce(share, 0) AS yhat,
                   yhat_lower * coalesce(share, 0) AS yhat_lower, yhat_upper * coalesce(share, 0) AS yhat_upper
            FROM (SELECT * FROM levels WHERE level = 'regional') r LEFT JOIN (
                SELECT region, trust_code, procedure_code, sum(n_procedures)::DOUBLE
                       / nullif(sum(sum(n_procedures)) OVER (PARTITION BY region, procedure_code), 0) AS share
                FROM procedures GROUP BY region, trust_code, procedure_code) s ON r.region = s.region AND r.procedure_code = s.procedure_code""", BAND, 4),
        "d22_seasonal_naive": _sql(f"SELECT {LEAF}, actual, yhat, yhat_lower, yhat_upper FROM leaf", BAND, 4),
        "d22_seasonal_naive_future": _sql("""
            SELECT trust_code, region, procedure_code, CAST(date + INTERVAL 12 MONTH AS DATE) AS date, CAST(y AS DOUBLE) AS yhat,
                   greatest(y - spread, 0.0) AS yhat_lower, y + spread AS yhat_upper
            FROM naive_panel WHERE date > (SELECT max(date) FROM procedures) - INTERVAL 12 MONTH""", BAND, 4),
        "d22_weekly_naive": _sql(
            f"SELECT {device}, coalesce(CAST(n_billable_lag7 AS DOUBLE), n_billable_rollmean7) AS naive FROM device_features", "naive"),
        # ---- mapping and scenarios
        "e1_mapping_matrix": _sql("SELECT procedure_code, " + ", ".join(
            f"CAST(coalesce(sum(weight) FILTER (WHERE equipment_type = '{e}'), 0) AS DOUBLE) AS {e}" for e in EQUIPMENT_TYPES)
            + " FROM mapping WHERE procedure_code IN (SELECT p_brand FROM part) GROUP BY procedure_code"),
        "e2_apply_mapping": _sql("""
            SELECT 'run-1' AS run_id, 'naive' AS model, level, trust_code, region, date, equipment_type, sum(yhat * weight) AS demand
            FROM levels JOIN mapping USING (procedure_code) GROUP BY ALL""", "demand", 4),
        "e3_equipment_demand": _sql("SELECT * FROM demand", DEMAND, 4),
        "e4_baseline": _sql(f"SELECT {LEAF}, yhat, yhat_lower, yhat_upper, 'baseline' AS scenario FROM leaf", BAND, 4),
        "e5_backlog_clear": _sql(f"""
            SELECT {LEAF}, yhat + uplift AS yhat, yhat_lower + uplift AS yhat_lower, yhat_upper + uplift AS yhat_upper,
                   'backlog_clear' AS scenario FROM uplifted""", BAND, 4),
        "e6_capacity_cap": _sql(f"""
            SELECT {LEAF}, least(yhat, ceiling) AS yhat, least(yhat_lower, ceiling) AS yhat_lower, least(yhat_upper, ceiling) AS yhat_upper,
                   'capacity_cap' AS scenario FROM capped""", BAND, 4),
        "e7_demand_shock": _sql(f"""
            SELECT {LEAF}, yhat * 0.85::DOUBLE AS yhat, yhat_lower * 0.85::DOUBLE AS yhat_lower, yhat_upper * 0.85::DOUBLE AS yhat_upper,
                   'demand_shock_-15pct' AS scenario FROM leaf""", BAND, 4),
        "e8_scenario_sweep": _sql("SELECT * FROM equipment", DEMAND, 4),
        # ---- devices
        "f1_sessions": _sql("SELECT * FROM sessions", "active_seconds"),
        "f1_sessions_next": _sql("""
            SELECT e.event_id AS session_id, s.device_id, s.site_id, s.operator_hash, s.procedure_code, s.ts AS t_start, e.ts AS t_end,
                   CASE WHEN e.seconds > 0 THEN e.seconds ELSE (epoch_us(e.ts) - epoch_us(s.ts)) / 1e6::DOUBLE END AS active_seconds, e.n_errors,
                   CASE WHEN e.seconds > 0 THEN e.seconds ELSE (epoch_us(e.ts) - epoch_us(s.ts)) / 1e6::DOUBLE END >= 180
                     AND e.quality = 'ok' AS billable
            FROM ranked s JOIN ranked e ON s.device_id = e.device_id AND e.place = s.place + 1 WHERE s.is_start AND NOT e.is_start""",
            "active_seconds"),
        "f2_duration": _sql("SELECT session_id, device_id, active_seconds FROM sessions", "active_seconds"),
        "f3_billable": _sql("SELECT device_id, billable, count(*) AS n_sessions FROM sessions GROUP BY ALL"),
        "f4_billing": _sql("SELECT session_id, device_id, billable, billed_amount_gbp FROM billed", "billed_amount_gbp"),
        "f5_exposure": _sql("SELECT * FROM exposure", "exposure_hours"),
        "f6_session_rollup": _sql("SELECT * FROM rollup", "active_seconds billed_gbp"),
        "f7_device_day": _sql("SELECT * FROM device_day", "active_seconds exposure_hours billed_gbp"),
        "f8_calendar": _sql(
            f"SELECT {device}, dow_sin, dow_cos, doy_sin, doy_cos, is_weekend, trend FROM device_calendar",
            "dow_sin dow_cos doy_sin doy_cos trend"),
        "f9_lags": _sql(f"SELECT {device}, n_billable_lag1, n_billable_lag7, n_billable_lag14 FROM device_features"),
        "f10_rolling": _sql(
            f"SELECT {device}, n_billable_rollmean7, n_billable_rollstd7, n_billable_rollmean28, n_billable_rollstd28 FROM device_features",
            "n_billable_rollmean7 n_billable_rollstd7 n_billable_rollmean28 n_billable_rollstd28"),
        "f11_error_rate": _sql(f"SELECT {device}, err_per_session, err_rate_28 FROM device_features", "err_per_session err_rate_28"),
        "f12_downtime": _sql(f"SELECT {device}, 0.0::DOUBLE AS downtime_frac_28 FROM device_day"),
        "f12_downtime_real": _sql("""
            SELECT a.device_id, a.date, 1 - count(*) / 28.0::DOUBLE AS downtime_frac_28
            FROM device_day a JOIN device_day b ON a.device_id = b.device_id AND b.date BETWEEN a.date - 27 AND a.date
            GROUP BY ALL""", "downtime_frac_28"),
        "f13_herfindahl": _sql("SELECT * FROM herfindahl"),
        "f14_active_operators": _sql(f"SELECT {device}, active_ops_28 FROM device_features", "active_ops_28"),
        "f15_peers": _sql(f"SELECT {device}, peer_util, peer_util_lag1 FROM device_features", "peer_util peer_util_lag1"),
        "f16_exposure_floor": _sql(f"SELECT {device}, exposure_hours FROM device_features", "exposure_hours"),
        "f17_device_features": _sql(f"""
            SELECT {device}, region, specialty, device_type, cap_sessions_day, n_billable, is_weekend, n_billable_lag1, n_billable_lag7,
                   n_billable_lag14, {', '.join(DEVICE_NUMERIC)} FROM device_features""", " ".join(c for c in DEVICE_NUMERIC if c != "op_herfindahl")),
        # ---- count model
        "g1_pinball": _sql("SELECT device_id, " + ", ".join(
            f"avg(greatest({q}::DOUBLE * (y - {c}), ({q}::DOUBLE - 1) * (y - {c}))) AS {n}"
            for n, c, q in (("p05", "lo", 0.05), ("p50", "mu", 0.5), ("p95", "hi", 0.95))) + " FROM scored GROUP BY device_id",
            "p05 p50 p95"),
        "g2_coverage": _sql(
            "SELECT device_id, avg(CASE WHEN y BETWEEN lo AND hi THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS coverage FROM scored GROUP BY device_id",
            "coverage"),
        "g3_design": _sql(f"""
            SELECT {device}, 19 AS width, 1 + dow_sin + dow_cos + doy_sin + doy_cos + trend + is_weekend + op_herfindahl + active_ops_28
                   + err_rate_28 + downtime_frac_28 + peer_util_lag1 + n_billable_lag1 + n_billable_lag7 + n_billable_lag14
                   + n_billable_rollmean7 + n_billable_rollmean28 + n_billable_rollstd7 + n_billable_rollstd28 AS row_sum
            FROM device_features WHERE n_billable_rollmean28 IS NOT NULL AND n_billable_lag14 IS NOT NULL
              AND n_sessions < cap_sessions_day""", "row_sum", 4),
        "g4_training_rows": _sql(f"""
            SELECT {device}, n_billable, n_sessions, cap_sessions_day FROM device_features
            WHERE n_billable_rollmean28 IS NOT NULL AND n_billable_lag14 IS NOT NULL AND n_sessions < cap_sessions_day"""),
        "g6_dispersion": _sql("""
            SELECT device_id, least(greatest(sum(mu * ((pow(y - mu, 2) - y) / mu)) / sum(mu * mu), 1e-4), 10.0) AS alpha
            FROM scored GROUP BY device_id""", "alpha"),
        "g9_predict_mu": _sql(f"SELECT {device}, mu FROM scored", "mu"),
        "g8_fallback_ladder": _sql(f"""
            SELECT {device}, 'naive' AS kind, greatest(exposure_hours * (
                SELECT sum(n_billable) / greatest(sum(exposure_hours), 1.0) FROM device_features
                WHERE n_billable_rollmean28 IS NOT NULL AND n_billable_lag14 IS NOT NULL
                  AND date = (SELECT max(date) FROM device_features)), 1e-6) AS mu FROM device_features""", "mu"),
        "g10_predict_quantiles": _sql(f"""
            WITH law AS (SELECT k, sum(p) OVER (PARTITION BY mu ORDER BY k) AS cdf, mu FROM (
                SELECT mu, k, exp(lgamma(k + 10.0::DOUBLE) - lgamma(10.0::DOUBLE) - lgamma(k + 1.0::DOUBLE)
                       + 10 * ln(10 / (10 + mu)) + CASE WHEN k = 0 THEN 0 ELSE k * ln(mu / (10 + mu)) END) AS p
                FROM (SELECT DISTINCT mu FROM scored) CROSS JOIN range(0, (SELECT CAST(ceil(max(mu)) AS BIGINT) * 8 + 80 FROM scored)) r(k))),
            q AS (SELECT mu, count(*) FILTER (WHERE cdf < 0.05 - 1e-12)::DOUBLE AS q05, count(*) FILTER (WHERE cdf < 0.5 - 1e-12)::DOUBLE AS q50,
                         count(*) FILTER (WHERE cdf < 0.95 - 1e-12)::DOUBLE AS q95 FROM law GROUP BY mu)
            SELECT {device}, round(mu, 6) AS mu, q05, q50, q95 FROM scored JOIN q USING (mu)"""),
        "g11_predictive_variance": _sql(f"SELECT {device}, variance FROM scored", "variance"),
        # ---- risk
        "h1_horizon_forecast_given": _sql("SELECT * FROM week", "mu"),
        "h2_utilisation_panel": _sql("""
            SELECT device_id, date, CAST(sum(n_billable) AS DOUBLE) AS x FROM device_day
            WHERE date >= (SELECT max(date) FROM device_day) - 120 GROUP BY ALL"""),
        "h6_copula_factor": _sql(f"""
            SELECT device_id, date, x * sqrt(common / variance * least(1, {MAX_COMMON} / greatest(share, 1e-300))) AS loading,
                   sqrt(1 - least(share, {MAX_COMMON})) AS idio
            FROM (SELECT *, common * power / variance AS share FROM (
                SELECT c.device_id, c.date, c.x, (1 - k.s) / k.n AS common, power,
                       greatest((1 - k.s) / k.n * power + k.s * k.m, 1e-9) AS variance
                FROM centred c JOIN (SELECT device_id, sum(x * x) AS power FROM centred GROUP BY device_id) w USING (device_id)
                CROSS JOIN shrink k))""", "loading idio"),
        "h3_shrunk_covariance": _sql("SELECT * FROM covariance", "cov"),
        "h4_correlation": _sql("""
            SELECT c.dev_a, c.dev_b, CASE WHEN c.dev_a = c.dev_b THEN 1.0 ELSE least(greatest(
                   c.cov / (sqrt(greatest(a.cov, 1e-9)) * sqrt(greatest(b.cov, 1e-9))), -0.999), 0.999) END AS corr
            FROM covariance c JOIN covariance a ON a.dev_a = c.dev_a AND a.dev_b = c.dev_a
            JOIN covariance b ON b.dev_a = c.dev_b AND b.dev_b = c.dev_b""", "corr"),
        "h5_book_moments": _sql(
            "SELECT * FROM positions", "exp_sessions var_sessions price_per_session_gbp floor_gbp fixed_gbp cap_sessions"),
        "h8_nb_parameters": _sql("""
            SELECT device_id, greatest(r, 1e-3) AS nb_r, least(greatest(r / (r + m), 1e-6), 1 - 1e-6) AS nb_p FROM (
                SELECT device_id, exp_sessions AS m, exp_sessions * exp_sessions
                       / (greatest(var_sessions, exp_sessions + 1e-6::DOUBLE) - exp_sessions) AS r FROM positions)""", "nb_r nb_p", 5),
        "h9_cap_and_floor": _sql("SELECT * FROM draws", "sessions revenue", 4),
        "h10_tail_risk": _sql("SELECT * FROM tail", """expected_revenue_gbp revenue_std_gbp fixed_cost_gbp expected_margin_gbp
            var_loss_gbp cvar_loss_gbp prob_book_loss alpha""", 4),
        "h11_device_statistics": _sql(
            "SELECT device_id, exp_revenue, sigma, cv, beta, exp_sessions FROM statistics", "exp_revenue sigma cv beta exp_sessions", 5),
        "h12_suggested_price": _sql("SELECT device_id, suggested_price FROM priced", "suggested_price", 4),
        "h13_utilisation_at_risk": _sql("SELECT device_id, uar_p5, floor_breach_prob FROM statistics", "uar_p5 floor_breach_prob"),
        "h14_latest_concentration": _sql("SELECT * FROM latest_herfindahl"),
        "h15_diversification": _sql("""
            SELECT n_devices, n_eff AS effective_n_independent, n_eff / greatest(n_devices, 1) AS diversification_ratio FROM (
                SELECT n_devices, CASE WHEN s > 0 THEN least(s * s / greatest((SELECT var_pop(book_revenue) FROM books), 1e-9), n_devices)
                       ELSE n_devices END AS n_eff
                FROM (SELECT count(*) AS n_devices, sum(sigma) AS s FROM statistics))""", "effective_n_independent diversification_ratio"),
        # ---- reports
        "i1_latest_run": _sql(f"SELECT max(run_id) AS run_id FROM {_runs('equipment', DEMAND)} r"),
        "i2_equipment_demand": _sql("""
            SELECT *, '20240201T000000-bbbbbb' AS run_id FROM equipment
            WHERE scenario = 'baseline' AND level = 'regional' AND equipment_type = 'scope'
            ORDER BY date, equipment_type, region LIMIT 50""", DEMAND, 4),
        "i3_procedure_forecast": _sql("""
            SELECT *, 'naive' AS model, '20240201T000000-bbbbbb' AS run_id FROM levels WHERE level = 'trust' AND procedure_code = 'Brand#7'
            ORDER BY date, region, trust_code LIMIT 100""", BAND, 4),
        "i4_demand_by_date": _sql("""
            SELECT date, equipment_type, sum(demand) AS demand, sum(demand_lower) AS lower, sum(demand_upper) AS upper
            FROM equipment WHERE scenario = 'baseline' AND level = 'national' GROUP BY ALL""", "demand lower upper", 3),
        "i5_horizon_totals": _sql("""
            SELECT equipment_type, sum(demand) AS demand FROM equipment
            WHERE scenario = 'capacity_cap' AND level = 'national' GROUP BY ALL""", "demand", 3),
        "i6_top_concentration": _sql(
            "SELECT device_id, specialty, op_herfindahl FROM book ORDER BY op_herfindahl DESC, device_id LIMIT 15"),
        "i7_lowest_utilisation": _sql(
            "SELECT device_id, specialty, uar_p5_sessions FROM book ORDER BY uar_p5_sessions, device_id LIMIT 15"),
        "i8_by_margin": _sql(
            "SELECT device_id, site_id, region, expected_sessions, expected_revenue_gbp, expected_margin_gbp FROM book"),
        "i9_national_history": _sql("SELECT date, CAST(sum(n_procedures) AS BIGINT) AS n_procedures FROM procedures GROUP BY date"),
        "i10_top_codes": _sql(_history_band("procedure_code", "national", 4), "history " + BAND, 3),
        "i11_demand_pivot": _sql(
            _pivot("(SELECT * FROM equipment WHERE scenario = 'baseline' AND level = 'national')", "date", "equipment_type",
                   EQUIPMENT_TYPES, "sum(demand)"), " ".join(EQUIPMENT_TYPES), 3),
        "i12_scenario_totals": _sql(
            "SELECT scenario, date, sum(demand) AS demand FROM equipment WHERE level = 'national' GROUP BY ALL", "demand", 3),
        "i13_waiting_pressure": _sql("""
            SELECT date, sum(waiting_list_size) / 1e6::DOUBLE AS waiting_millions, avg(pct_within_18wk) AS pct_within_18wk
            FROM rtt GROUP BY date""", "waiting_millions pct_within_18wk"),
        "i14_regional_demand": _sql("""
            SELECT region, date, sum(demand) AS demand FROM equipment WHERE scenario = 'baseline' AND level = 'regional' GROUP BY ALL""",
            "demand", 3),
        "i15_region_equipment_mean": _sql(
            _pivot("(SELECT * FROM equipment WHERE scenario = 'baseline' AND level = 'regional')", "region", "equipment_type",
                   EQUIPMENT_TYPES, "avg(demand)"), " ".join(EQUIPMENT_TYPES)),
        "i16_trust_ranking": _sql("""
            SELECT trust_code, region, sum(demand) AS demand FROM equipment WHERE scenario = 'baseline' AND level = 'trust' GROUP BY ALL""",
            "demand", 3),
        "i17_top_trusts": _sql(_history_band("trust_code", "trust", 6), "history " + BAND, 3),
        "i18_regional_history_pivot": _sql("SELECT date, " + ", ".join(
            f"""CAST(coalesce(sum(n_procedures) FILTER (WHERE region = '{r}'), 0) AS BIGINT) AS "{r}" """ for r in REGIONS)
            + " FROM procedures GROUP BY date"),
        "i19_model_comparison": _sql(f"""
            SELECT {_evaluated('yhat')}, 'naive' AS model FROM leaf
            UNION ALL SELECT {_evaluated('yhat * 0.5')}, 'damped' FROM leaf""", "mae rmse mape"),
        "i20_portfolio_table": _sql(_portfolio_rows(), "value", 3),
        "i20_price_adequacy": _sql("""
            SELECT device_id, current_price_gbp, suggested_price_gbp, suggested_price_gbp > current_price_gbp AS under_priced FROM book"""),
        "flow_national_demand": _sql("""
            SELECT date, equipment_type, sum(demand) AS demand, sum(demand_lower) AS lower, sum(demand_upper) AS upper
            FROM demand WHERE level = 'national' GROUP BY ALL""", "demand lower upper", 3),
    })
    return out
