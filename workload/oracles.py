"""SQL twins of the queries, written in the plain, literal form.

Joins fan out, panels are dense, windows repeat totals on rows: none of the
rewrites of the Spark plans is used here, so the comparison tests them.
"""

from __future__ import annotations

import re

# --- inputs as in ``roles`` ----------------------------------------------------
CTES: dict[str, str] = {
    "fac": """
SELECT CAST(c_custkey AS VARCHAR) AS wdid, 'F' || c_custkey AS facility_id,
  c_name AS facility_name, CAST(c_nationkey AS VARCHAR) AS program_category,
  c_mktsegment AS community_type,
  CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END AS federal_facility,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No' ELSE 'Yes' END AS cs_assessment
FROM customer""",
    "ns": """
SELECT CAST(o_custkey AS VARCHAR) AS wdid, CAST(o_orderdate AS DATE) AS spill_date,
  'Category ' || CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END || ' Spill'
    AS spill_type,
  o_orderpriority AS location, o_orderpriority AS status, o_orderkey AS row_no
FROM orders WHERE o_orderdate >= DATE '1998-07-01'""",
    "os": """
SELECT CAST(o_custkey AS VARCHAR) AS wdid, CAST(o_orderdate AS DATE) AS spill_date,
  'Category ' || CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END AS spill_type,
  o_orderpriority AS location, o_orderpriority AS status, o_orderkey AS row_no
FROM orders WHERE o_orderdate < DATE '1998-07-01'""",
    "ar": """
SELECT CAST(o_custkey AS VARCHAR) AS wdid, CAST(year(o_orderdate) AS INTEGER) AS report_year,
  CASE WHEN o_totalprice < 450000 THEN o_totalprice END AS population,
  o_totalprice / 5000 + CASE WHEN o_totalprice < 400000 THEN o_totalprice / 600 END AS length,
  CASE WHEN o_totalprice >= 2000 THEN CAST(o_orderdate AS DATE) END AS updated, o_orderkey AS row_no
FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'""",
    "qn": """
SELECT CAST(c_custkey AS VARCHAR) AS wdid,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END * 15 AS population,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END / 50 + CASE WHEN c_acctbal >= 0 THEN c_acctbal END / 25
    AS length,
  c_custkey AS row_no
FROM customer""",
    "mc": """
SELECT CAST(user_id AS VARCHAR) AS wdid, 'System ' || CAST(user_id // 2 AS VARCHAR) AS system_name,
  CAST(ts AS DATE) AS month, CAST(event_type = 'error' AS INTEGER) AS spill_count,
  CAST(event_type = 'signup' AS INTEGER) AS no_spill_cert
FROM events""",
    "en": """
SELECT 'F' || l_partkey AS facility_id, CAST(l_partkey AS VARCHAR) AS wdid,
  'Customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS facility_name,
  CASE WHEN l_linenumber = 1 THEN 'SSO' ELSE 'Other' END AS program_category,
  CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Closed' END AS status,
  CASE WHEN l_quantity >= 25 THEN 'Active' ELSE 'Closed' END AS status_1,
  CASE l_returnflag WHEN 'A' THEN 'Notice of Violation' WHEN 'R' THEN 'Time Schedule Order'
    ELSE 'Staff Letter' END AS action_type,
  CAST(l_shipdate AS DATE) AS effective_date, l_extendedprice AS amount
FROM lineitem""",
    # --- cleaning and fan-out ---------------------------------------------------
    "clean_new": """
SELECT *, CAST(year(spill_date) AS INTEGER) AS spill_year FROM ns
WHERE wdid IN (SELECT wdid FROM fac)
  AND spill_date >= DATE '1996-01-01' AND spill_date < DATE '2001-01-01'
  AND spill_type IN ('Category 1 Spill', 'Category 2 Spill') AND NOT location ILIKE '%low%'""",
    "clean_old": """
SELECT *, CAST(year(spill_date) AS INTEGER) AS spill_year FROM os
WHERE wdid IN (SELECT wdid FROM fac)
  AND spill_date >= DATE '1996-01-01' AND spill_date < DATE '2001-01-01'
  AND spill_type IN ('Category 1', 'Category 2') AND NOT location ILIKE '%low%'""",
    "fan_new": """
SELECT c.*, a.row_no AS right_row, a.length, a.population
FROM clean_new c LEFT JOIN ar a ON c.wdid = a.wdid""",
    "fan_old": """
SELECT c.*, q.row_no AS right_row, q.length, q.population
FROM clean_old c LEFT JOIN qn q ON c.wdid = q.wdid""",
    "fan_both": """
SELECT *, 0 AS src FROM fan_new UNION ALL BY NAME SELECT *, 1 AS src FROM fan_old""",
    # --- attributes --------------------------------------------------------------
    "len_a": """
SELECT wdid, length AS length_a FROM fan_new WHERE length IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY wdid ORDER BY spill_year DESC, row_no, right_row) = 1""",
    "len_b": """
SELECT wdid, length AS length_b FROM fan_old WHERE length IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY wdid ORDER BY spill_year DESC, row_no, right_row) = 1""",
    "newest_status": """
SELECT wdid, status FROM fan_both
QUALIFY row_number() OVER (PARTITION BY wdid ORDER BY spill_year DESC, src, row_no, right_row) = 1""",
    "newest_pop": """
SELECT wdid, population FROM fan_both WHERE population IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY wdid ORDER BY spill_year DESC, src, row_no, right_row) = 1""",
    "compared": """
SELECT *, CASE WHEN length_a IS NOT NULL AND length_b IS NOT NULL AND greatest(length_a, length_b) <> 0
  THEN abs(length_a - length_b) / greatest(length_a, length_b) END AS length_diff
FROM len_a FULL JOIN len_b USING (wdid)""",
    "recent": """
SELECT s.wdid, s.status, p.population, c.length_a, c.length_b, c.length_diff,
  c.length_diff > 0.20 AS length_diff_large,
  CASE WHEN c.length_a IS NOT NULL AND c.length_b IS NULL THEN c.length_a
    WHEN c.length_a IS NULL AND c.length_b IS NOT NULL THEN c.length_b
    WHEN c.length_diff > 0.20 THEN least(c.length_a, c.length_b) ELSE c.length_a END AS length
FROM newest_status s LEFT JOIN newest_pop p USING (wdid) LEFT JOIN compared c USING (wdid)""",
    "extra_a": """
SELECT wdid, population, length FROM ar
WHERE wdid IN (SELECT wdid FROM fac) AND (population IS NOT NULL OR length IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY wdid ORDER BY report_year DESC NULLS LAST, row_no) = 1""",
    "extra_b": """
SELECT o.wdid, q.population, q.length FROM os o LEFT JOIN qn q ON o.wdid = q.wdid
WHERE o.wdid IN (SELECT wdid FROM fac) AND (q.population IS NOT NULL OR q.length IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY o.wdid ORDER BY o.spill_date DESC, o.row_no, q.row_no) = 1""",
    "extra": """
SELECT f.wdid, CAST(NULL AS VARCHAR) AS status, coalesce(a.population, b.population) AS population,
  a.length AS length_a, b.length AS length_b, CAST(NULL AS DOUBLE) AS length_diff,
  CAST(NULL AS BOOLEAN) AS length_diff_large, least(a.length, b.length) AS length
FROM (SELECT DISTINCT wdid FROM fac WHERE cs_assessment = 'Yes'
      AND wdid NOT IN (SELECT wdid FROM recent)) f
LEFT JOIN extra_a a USING (wdid) LEFT JOIN extra_b b USING (wdid)""",
    "attrs": """
SELECT wdid, status, population, length_a, length_b, length_diff, length_diff_large, length,
  CASE WHEN population > 100000 THEN 'Large' WHEN population > 10000 THEN 'Medium'
    WHEN population >= 2500 THEN 'Small' WHEN population < 2500 THEN 'Micro'
    ELSE 'Not Available' END AS population_class,
  CASE WHEN length >= 500 THEN 'Large' WHEN length >= 100 THEN 'Medium'
    WHEN length >= 25 THEN 'Small' WHEN length < 25 THEN 'Micro'
    ELSE 'Not Available' END AS length_class
FROM (FROM recent UNION ALL BY NAME FROM extra)""",
    # --- five years --------------------------------------------------------------
    "per_feed": """
SELECT src AS feed, wdid, spill_year AS year, count(*) AS spill_count
FROM fan_both GROUP BY ALL""",
    "yearly": """
SELECT p.wdid, a.length_class, a.length, p.year, CAST(sum(p.spill_count) AS BIGINT) AS spill_count
FROM per_feed p LEFT JOIN attrs a USING (wdid) GROUP BY ALL""",
    "dense_years": """
SELECT e.wdid, e.length_class, e.length, CAST(y.year AS INTEGER) AS year,
  coalesce(c.spill_count, 0) AS spill_count
FROM (SELECT DISTINCT wdid, length_class, length FROM yearly) e
CROSS JOIN (SELECT unnest(generate_series(min(year), max(year))) AS year FROM yearly) y
LEFT JOIN yearly c ON c.wdid = e.wdid AND c.year = y.year""",
    "rolled5": """
SELECT wdid, length_class, length, year, rolling_avg FROM (
  SELECT *, avg(spill_count) OVER w AS rolling_avg, count(*) OVER w AS n FROM dense_years
  WINDOW w AS (PARTITION BY wdid, length_class ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
WHERE n = 5""",
    "silent": """
SELECT DISTINCT wdid FROM (
  SELECT wdid, sum(spill_count) OVER w AS spills, sum(no_spill_cert) OVER w AS certs
  FROM mc WHERE month BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'
  WINDOW w AS (PARTITION BY wdid)) WHERE spills < 1 AND certs < 1""",
    "rates5": """
SELECT *, wdid NOT IN (SELECT wdid FROM silent) AS in_baseline,
  CASE WHEN length <> 0 THEN rolling_avg /
    (length / CASE WHEN length < 5 THEN 5.0::DOUBLE WHEN length < 25 THEN 25 ELSE 100 END) END AS rate
FROM rolled5""",
    "quart5": """
SELECT length_class, quantile_cont(rate, 0.25) AS q1, quantile_cont(rate, 0.75) AS q3
FROM rates5 WHERE rate IS NOT NULL AND in_baseline GROUP BY length_class""",
    "bands5": """
SELECT r.*, CASE WHEN rate < q1 THEN 'High Performing' WHEN rate <= q3 THEN 'Medium Performing'
  WHEN rate > q3 THEN 'Low Performing' END AS band
FROM rates5 r LEFT JOIN quart5 q USING (length_class)""",
    # --- twelve months -----------------------------------------------------------
    "monthly": """
SELECT s.wdid, a.length_class, a.length, CAST(date_trunc('month', s.spill_date) AS DATE) AS month,
  count(*) AS spill_count
FROM ns s LEFT JOIN ar r ON s.wdid = r.wdid LEFT JOIN attrs a ON s.wdid = a.wdid
WHERE s.wdid IN (SELECT wdid FROM fac) AND s.spill_date IS NOT NULL GROUP BY ALL""",
    "dense_months": """
SELECT e.wdid, e.length, e.month, c.length_class, coalesce(c.spill_count, 0) AS spill_count
FROM (SELECT wdid, length,
        CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
      FROM monthly GROUP BY wdid, length) e
LEFT JOIN monthly c ON c.wdid = e.wdid AND c.month = e.month
  AND c.length IS NOT DISTINCT FROM e.length""",
    "rolled12": """
SELECT wdid, length, month, length_class, spill_count, rolling_avg FROM (
  SELECT *, avg(spill_count) OVER w AS rolling_avg, count(*) OVER w AS n FROM dense_months
  WINDOW w AS (PARTITION BY wdid, length ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
WHERE n = 12""",
    "rates12": """
SELECT wdid, length_class, length, month, rolling_avg,
  wdid NOT IN (SELECT wdid FROM silent) AS in_baseline,
  CASE WHEN length <> 0 THEN rolling_avg /
    (length / CASE WHEN length < 5 THEN 5.0::DOUBLE WHEN length < 25 THEN 25 ELSE 100 END) END AS rate
FROM rolled12
QUALIFY row_number() OVER (PARTITION BY wdid, length ORDER BY month DESC) = 1""",
    "quart12": """
SELECT length_class, quantile_cont(rate, 0.25) AS q1, quantile_cont(rate, 0.75) AS q3
FROM rates12 WHERE rate IS NOT NULL AND in_baseline GROUP BY length_class""",
    "bands12": """
SELECT r.*, CASE WHEN rate < q1 THEN 'High Performing' WHEN rate <= q3 THEN 'Medium Performing'
  WHEN rate > q3 THEN 'Low Performing' END AS band
FROM rates12 r LEFT JOIN quart12 q ON r.length_class = q.length_class""",
    "low_pairs": """
SELECT a.wdid, a.rate AS rate_5yr, a.band AS band_5yr, a.length_class AS length_class_5yr,
  b.rate AS rate_12mo, b.band AS band_12mo, b.length_class AS length_class_12mo,
  CASE WHEN a.length_class <> b.length_class THEN b.length_class ELSE a.length_class END
    AS length_class_final
FROM bands5 a JOIN bands12 b ON a.wdid = b.wdid
WHERE a.band = 'Low Performing' AND b.band = 'Low Performing'
QUALIFY row_number() OVER (PARTITION BY a.wdid ORDER BY a.year) = 1""",
    "exempted": """
SELECT * FROM low_pairs WHERE length_class_final IN ('Medium', 'Large')
  AND rate_5yr <= 2 AND rate_12mo <= 1""",
    "low_listed": "SELECT * FROM low_pairs WHERE wdid NOT IN (SELECT wdid FROM exempted)",
    # --- reporting ---------------------------------------------------------------
    "certs": """
SELECT DISTINCT f.wdid, f.facility_name, f.program_category, f.cs_assessment FROM (
  SELECT wdid, sum(spill_count) OVER w AS spills, sum(no_spill_cert) OVER w AS certs
  FROM mc WHERE month >= DATE '2024-01-30' AND month < DATE '2024-01-31'
    AND wdid IN (SELECT wdid FROM fac)
  WINDOW w AS (PARTITION BY system_name)) m
JOIN fac f ON f.wdid = m.wdid WHERE spills < 1 AND certs < 1 AND f.cs_assessment = 'Yes'""",
    "noreport": """
SELECT DISTINCT wdid, facility_name, program_category, cs_assessment FROM fac
WHERE cs_assessment = 'Yes' AND wdid NOT IN (SELECT wdid FROM ar)""",
    "gaps": """
SELECT DISTINCT a.* FROM noreport a JOIN certs b
ON a.wdid = b.wdid AND a.facility_name IS NOT DISTINCT FROM b.facility_name
  AND a.program_category IS NOT DISTINCT FROM b.program_category
  AND a.cs_assessment IS NOT DISTINCT FROM b.cs_assessment""",
    "listed": """
SELECT substr(wdid, 1, 1) AS region, wdid, facility_name,
  string_agg(source, ' & ' ORDER BY ord) AS source
FROM (SELECT DISTINCT wdid, facility_name, 'Reporting Criteria' AS source, 0 AS ord FROM gaps
      UNION ALL
      SELECT DISTINCT l.wdid, f.facility_name, 'Low Performance - Spills', 1
      FROM low_listed l LEFT JOIN fac f ON l.wdid = f.wdid)
WHERE wdid IN (SELECT wdid FROM fac WHERE cs_assessment = 'Yes')
GROUP BY wdid, facility_name""",
    # --- enforcement -------------------------------------------------------------
    "active": """
SELECT * FROM en WHERE facility_id IN (SELECT facility_id FROM fac)
  AND program_category = 'SSO' AND status = 'Active' AND status_1 = 'Active'
  AND action_type IN ('Admin Civil Liability', 'Cease and Desist Order',
    'Clean-up and Abatement Order', 'Time Schedule Order', 'Notice of Violation')
  AND effective_date >= DATE '1996-01-01' AND effective_date < DATE '2001-01-01'""",
    "order_totals": """
SELECT o.wdid, count(*) AS enforcement_count, any_value(t.types) AS enforcement_types,
  max(o.effective_date) AS latest_enforcement_date, coalesce(sum(o.amount), 0) AS total_assessment_amount
FROM active o JOIN (
  SELECT wdid, string_agg(action_type, '; ' ORDER BY effective_date, amount, action_type) AS types
  FROM (SELECT * FROM active QUALIFY row_number() OVER
        (PARTITION BY wdid, action_type ORDER BY effective_date, amount) = 1) GROUP BY wdid) t
ON o.wdid = t.wdid GROUP BY o.wdid""",
    "spill_totals": """
SELECT wdid, count(*) AS total_spills, count(*) FILTER (spill_type LIKE '%Category 1%') AS cat1_spills,
  count(*) FILTER (spill_type LIKE '%Category 2%') AS cat2_spills, max(spill_year) AS last_spill_year
FROM fan_both GROUP BY wdid""",
    "unlisted_orders": """
SELECT DISTINCT o.wdid, o.facility_name, substr(o.wdid, 1, 1) AS region,
  a.population_class, a.length_class, a.population, a.length
FROM active o LEFT JOIN attrs a ON o.wdid = a.wdid
WHERE o.wdid IS NOT NULL AND o.wdid NOT IN (SELECT wdid FROM listed)""",
}


def _gesd(prefix: str, rates: str, tie: str) -> None:
    """CTEs ``{prefix}_marks``: the outlier test step by step.

    The critical value needs a t quantile; instead each deviation is turned
    into its t value, whose tail is a finite sum for whole degrees of freedom.
    """
    CTES[f"{prefix}_arr"] = f"""
SELECT length_class, count(*) AS n, greatest(1, CAST(floor(count(*) * 0.10) AS BIGINT)) AS k,
  avg(rate) AS c, list(rate ORDER BY rate, {tie}) AS lo, list(rate ORDER BY rate DESC, {tie}) AS hi,
  list({{'t': ({tie})}} ORDER BY rate, {tie}) AS lo_id,
  list({{'t': ({tie})}} ORDER BY rate DESC, {tie}) AS hi_id
FROM {rates} WHERE rate IS NOT NULL AND in_baseline GROUP BY length_class"""
    CTES[f"{prefix}_walk"] = f"""
SELECT length_class, CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS b,
  CAST(0 AS DOUBLE) AS s, list_sum(list_transform(lo, lambda x: (x - c) * (x - c))) AS q,
  CAST(0 AS DOUBLE) AS r FROM {prefix}_arr
UNION ALL
SELECT length_class, step + 1, a + CAST(low AS BIGINT), b + CAST(NOT low AS BIGINT),
  s - v, q - v * v, greatest(dl, dh) / sqrt((q - s * s / m) / (m - 1))
FROM (SELECT *, CASE WHEN low THEN lx ELSE hx END AS v FROM (
  SELECT *, dl > dh OR (dl = dh AND lid < hid) AS low FROM (
    SELECT w.*, p.n - w.step AS m, p.lo[w.a + 1] - p.c AS lx, p.hi[w.b + 1] - p.c AS hx,
      w.s / (p.n - w.step) - (p.lo[w.a + 1] - p.c) AS dl,
      (p.hi[w.b + 1] - p.c) - w.s / (p.n - w.step) AS dh,
      p.lo_id[w.a + 1] AS lid, p.hi_id[w.b + 1] AS hid
    FROM {prefix}_walk w JOIN {prefix}_arr p USING (length_class) WHERE w.step < p.k)
  WHERE m >= 3 AND lx < hx))"""
    CTES[f"{prefix}_tail"] = f"""
SELECT *, CASE WHEN df % 2 = 0 THEN sqrt(1 - c2) * list_sum(list_transform(range(0, df // 2),
      lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1) + j * ln(c2))))
    ELSE 2 / pi() * (acos(sqrt(c2)) + CASE WHEN df = 1 THEN 0 ELSE sqrt(1 - c2) * sqrt(c2) *
      list_sum(list_transform(range(0, (df - 1) // 2),
        lambda j: exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5) + j * ln(c2)))) END) END AS inside
FROM (SELECT *, df / (df + df * m2 * r * r / ((m2 - 1) * (m2 - 1) - m2 * r * r)) AS c2
  FROM (SELECT w.*, p.n - 2 * w.step + 2 AS m2, p.n - 2 * w.step AS df
        FROM {prefix}_walk w JOIN {prefix}_arr p USING (length_class) WHERE w.step > 0))"""
    CTES[f"{prefix}_last"] = f"""
SELECT length_class, a, b FROM {prefix}_tail
WHERE m2 * r * r >= (m2 - 1) * (m2 - 1) OR 1 - inside < 0.05 / m2
QUALIFY row_number() OVER (PARTITION BY length_class ORDER BY step DESC) = 1"""
    CTES[f"{prefix}_marks"] = f"""
SELECT length_class, {tie}, coalesce(from_low <= l.a OR from_high <= l.b, FALSE) AS is_outlier
FROM (SELECT length_class, {tie},
        row_number() OVER (PARTITION BY length_class ORDER BY rate, {tie}) AS from_low,
        row_number() OVER (PARTITION BY length_class ORDER BY rate DESC, {tie}) AS from_high
      FROM {rates} WHERE rate IS NOT NULL AND in_baseline)
LEFT JOIN {prefix}_last l USING (length_class)"""


_gesd("g5", "rates5", "wdid, year")
_gesd("g12", "rates12", "wdid")

CTES["report"] = """
SELECT DISTINCT l.region, l.wdid, coalesce(l.facility_name, f.facility_name) AS facility_name,
  f.facility_id, f.program_category, l.source,
  CASE WHEN low_both AND no_certificate AND no_report
      THEN 'Low Performance (System Length, 5yr & 12mo) & Reporting Criteria'
    WHEN low_both THEN 'Low Performance - System Length (5yr & 12mo)'
    WHEN no_certificate AND no_report THEN 'Reporting Criteria' ELSE 'Other' END AS reason,
  CAST(low_both AS INTEGER) + CAST(no_certificate AND no_report AS INTEGER) AS criteria_met,
  a.population, a.population_class, a.length, a.length_class,
  b5.band AS band_5yr, b5.rate AS rate_5yr, b12.band AS band_12mo, b12.rate AS rate_12mo,
  s.total_spills, s.cat1_spills, s.cat2_spills, s.last_spill_year,
  low_5yr, low_12mo, low_both, no_certificate, no_report, has_order,
  e.enforcement_count, e.enforcement_types, e.latest_enforcement_date, e.total_assessment_amount,
  f.community_type, f.federal_facility, a.length_a, a.length_b, a.length_diff, a.length_diff_large,
  b5.rolling_avg AS avg_5yr, o5.is_outlier AS outlier_5yr,
  b12.month AS month_12mo, b12.rolling_avg AS avg_12mo, o12.is_outlier AS outlier_12mo
FROM (SELECT *, wdid IN (SELECT wdid FROM bands5 WHERE band = 'Low Performing') AS low_5yr,
    wdid IN (SELECT wdid FROM bands12 WHERE band = 'Low Performing') AS low_12mo,
    wdid IN (SELECT wdid FROM low_listed) AS low_both,
    wdid IN (SELECT wdid FROM certs) AS no_certificate,
    wdid IN (SELECT wdid FROM noreport) AS no_report,
    wdid IN (SELECT wdid FROM unlisted_orders) AS has_order FROM listed) l
LEFT JOIN fac f ON l.wdid = f.wdid
LEFT JOIN attrs a ON l.wdid = a.wdid
LEFT JOIN (SELECT * FROM bands5 QUALIFY row_number() OVER (PARTITION BY wdid ORDER BY year DESC) = 1) b5
  ON l.wdid = b5.wdid
LEFT JOIN g5_marks o5 ON b5.wdid = o5.wdid AND b5.year = o5.year
LEFT JOIN bands12 b12 ON l.wdid = b12.wdid
LEFT JOIN g12_marks o12 ON l.wdid = o12.wdid
LEFT JOIN order_totals e ON l.wdid = e.wdid
LEFT JOIN spill_totals s ON l.wdid = s.wdid"""

CTES["first_a"] = """
SELECT wdid, length AS length_a FROM ar WHERE length IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY wdid ORDER BY row_no) = 1"""
CTES["lengths"] = """
SELECT wdid, length_a, length_b
FROM first_a FULL JOIN (SELECT wdid, length AS length_b FROM qn) USING (wdid)"""
CTES["diffs"] = """
SELECT *, CASE WHEN length_a IS NOT NULL AND length_b IS NOT NULL AND greatest(length_a, length_b) <> 0
  THEN abs(length_a - length_b) / greatest(length_a, length_b) END AS length_diff FROM lengths"""
CTES["members"] = """
SELECT wdid, wdid IN (SELECT wdid FROM ns) AS in_new, wdid IN (SELECT wdid FROM os) AS in_old,
  wdid IN (SELECT wdid FROM ar) AS has_report, wdid IN (SELECT wdid FROM qn) AS has_answer,
  wdid IN (SELECT wdid FROM mc) AS has_month, wdid IN (SELECT wdid FROM en) AS has_order
FROM fac"""

_CLASS_RANGE = """
SELECT {cls} AS {name}, count(*) AS n, min({c}) AS lo, max({c}) AS hi FROM attrs GROUP BY 1"""
_POPULATION_CLASS = """CASE WHEN population IS NULL THEN 'Not Available'
  WHEN population > 100000 THEN 'Large' WHEN population > 10000 THEN 'Medium'
  WHEN population >= 2500 THEN 'Small' ELSE 'Micro' END"""
_LENGTH_CLASS = """CASE WHEN length IS NULL THEN 'Not Available' WHEN length >= 500 THEN 'Large'
  WHEN length >= 100 THEN 'Medium' WHEN length >= 25 THEN 'Small' ELSE 'Micro' END"""

# key -> (SELECT on the CTEs, double columns to round)
_QUERIES: dict[str, tuple[str, str]] = {
    "stage_spills": (
        """
SELECT CASE WHEN o_orderdate >= DATE '1998-07-01' THEN 0 ELSE 1 END AS feed,
  CAST(o_custkey AS VARCHAR) AS wdid, CAST(o_orderdate AS DATE) AS spill_date,
  o_orderstatus AS spill_type, o_orderpriority AS location, o_orderpriority AS status,
  o_orderkey AS row_no FROM orders""",
        "",
    ),
    "null_tokens": (
        """
SELECT c_custkey,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN NULL ELSE c_mktsegment END
    AS facility_text,
  CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN '#N/A'
    ELSE c_mktsegment END AS feed_text FROM customer""",
        "",
    ),
    "snapshot_as_of": (
        """
SELECT event_id, user_id, event_type, value FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
        "value",
    ),
    "read_comma_feed": (
        """
SELECT o_orderkey, o_orderpriority AS status,
  CASE o_orderkey % 3 WHEN 0 THEN 'say "' || o_orderpriority || '", or' || chr(9) || o_orderkey WHEN 2 THEN 'a,b;c' END AS note,
  CAST(o_orderdate AS DATE) AS day, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_no FROM orders""",
        "",
    ),
    "read_tab_feed": (
        """
SELECT o_orderkey, o_orderpriority AS status,
  CASE o_orderkey % 3 WHEN 0 THEN 'say "' || o_orderpriority || '",' || chr(10) || 'or' || chr(9) || o_orderkey WHEN 2 THEN 'a,b;c' END AS note,
  CAST(o_orderdate AS DATE) AS day, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_no FROM orders""",
        "",
    ),
    "snapshot_round_trip": ("SELECT event_id, user_id, event_type, value FROM events", ""),
    "published_results": (
        """
SELECT event_id, user_id, event_type, value, type_count, users
FROM events JOIN (SELECT event_type, count(*) AS type_count, count(DISTINCT user_id) AS users FROM events GROUP BY event_type)
  USING (event_type)
WHERE event_type = 'error'""",
        "",
    ),
    "size_class_lookup": (
        f"""
SELECT wdid, length_class, CASE length_class WHEN 'Large' THEN '>= 500 miles'
  WHEN 'Medium' THEN '100 - 499 miles' WHEN 'Small' THEN '25 - 99 miles'
  WHEN 'Micro' THEN '< 25 miles' ELSE 'NA' END AS description
FROM (SELECT wdid, {_LENGTH_CLASS} AS length_class FROM qn)""",
        "",
    ),
    "stage_audit": (
        """
SELECT 'new_spills' AS stage, count(*) AS row_count, count(DISTINCT wdid) AS id_count FROM ns
UNION ALL SELECT 'old_spills', count(*), count(DISTINCT wdid) FROM os
UNION ALL SELECT 'annual_reports', count(*), count(DISTINCT wdid) FROM ar
UNION ALL SELECT 'clean_new', count(*), count(DISTINCT wdid) FROM clean_new""",
        "",
    ),
    "clean_numeric": (
        """
SELECT l_orderkey, l_linenumber, l_returnflag,
  CASE WHEN l_returnflag IN ('A', 'N') THEN l_extendedprice END AS cleaned,
  CASE WHEN l_returnflag = 'N' OR (l_returnflag = 'A' AND l_extendedprice < 1000)
    THEN l_extendedprice END AS plain FROM lineitem""",
        "cleaned plain",
    ),
    "parse_dates": (
        """
SELECT o_orderkey,
  CASE WHEN o_orderpriority NOT IN ('3-MEDIUM', '5-LOW') THEN CAST(o_orderdate AS DATE) END AS with_time,
  CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_orderdate AS DATE) END AS day_only
FROM orders""",
        "",
    ),
    "parse_month_label": (
        """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS month,
  CAST(o_orderdate AS DATE) AS updated FROM orders""",
        "",
    ),
    "region_code": (
        "SELECT substr(wdid, 1, 1) AS region, count(*) AS systems FROM fac GROUP BY 1",
        "",
    ),
    "population_class": (
        _CLASS_RANGE.format(cls=_POPULATION_CLASS, name="population_class", c="population"),
        "lo hi",
    ),
    "length_class": (
        _CLASS_RANGE.format(cls=_LENGTH_CLASS, name="length_class", c="length"),
        "lo hi",
    ),
    "length_discrepancy": (
        "SELECT wdid, length_diff, length_diff > 0.20 AS large FROM diffs",
        "length_diff",
    ),
    "reconcile_length": (
        """
SELECT wdid, CASE WHEN length_a IS NULL THEN length_b WHEN length_b IS NULL THEN length_a
  WHEN length_diff > 0.20 THEN least(length_a, length_b) ELSE length_a END AS length FROM diffs""",
        "length",
    ),
    "reconcile_length_supplement": (
        """
SELECT wdid, CASE WHEN length_a IS NULL THEN length_b WHEN length_b IS NULL THEN length_a
  WHEN length_a < length_b THEN length_a ELSE length_b END AS length FROM lengths""",
        "length",
    ),
    "scaled_rate": (
        """
SELECT wdid, length, CASE WHEN length IS NULL OR length = 0 THEN NULL
  WHEN length < 5 THEN n / 12 / (length / 5) WHEN length < 25 THEN n / 12 / (length / 25)
  ELSE n / 12 / (length / 100) END AS rate
FROM (SELECT wdid, CAST(count(*) AS DOUBLE) AS n FROM (SELECT wdid FROM ns UNION ALL SELECT wdid FROM os)
      GROUP BY wdid) LEFT JOIN qn USING (wdid)""",
        "length rate",
    ),
    "exclude_pattern": (
        """
SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS location FROM orders
WHERE o_orderpriority NOT ILIKE '%low%'""",
        "",
    ),
    "membership_flags": (
        """
SELECT *, CAST(in_new AS INTEGER) + CAST(in_old AS INTEGER) + CAST(has_report AS INTEGER)
  + CAST(has_answer AS INTEGER) + CAST(has_month AS INTEGER) + CAST(has_order AS INTEGER) AS flags
FROM members""",
        "",
    ),
    "reason_code": (
        """
SELECT wdid, CASE
  WHEN has_order AND NOT has_month AND NOT has_report
    THEN 'Low Performance (System Length, 5yr & 12mo) & Reporting Criteria'
  WHEN has_order THEN 'Low Performance - System Length (5yr & 12mo)'
  WHEN NOT has_month AND NOT has_report THEN 'Reporting Criteria' ELSE 'Other' END AS reason,
  CAST(has_order AS INTEGER) + CAST(NOT has_month AND NOT has_report AS INTEGER) AS criteria_met
FROM members""",
        "",
    ),
    "report_layout": (
        "SELECT wdid, facility_name, community_type, federal_facility FROM fac",
        "",
    ),
    "clean_spills_new": ("SELECT * FROM clean_new", ""),
    "clean_spills_old": ("SELECT * FROM clean_old", ""),
    "fanout_left_join": (
        """
SELECT 0 AS feed, s.row_no, s.wdid, s.spill_date, r.length, r.row_no AS right_row
FROM ns s LEFT JOIN ar r ON s.wdid = r.wdid
UNION ALL SELECT 1, s.row_no, s.wdid, s.spill_date, r.length, r.row_no
FROM os s LEFT JOIN qn r ON s.wdid = r.wdid""",
        "length",
    ),
    "weighted_fanout_count": (
        """
SELECT 0 AS feed, s.wdid, CAST(year(s.spill_date) AS INTEGER) AS year, count(*) AS spill_count
FROM ns s LEFT JOIN ar r ON s.wdid = r.wdid GROUP BY ALL
UNION ALL SELECT 1, s.wdid, CAST(year(s.spill_date) AS INTEGER), count(*)
FROM os s LEFT JOIN qn r ON s.wdid = r.wdid GROUP BY ALL""",
        "",
    ),
    "semi_join_known": (
        """
SELECT feed, row_no, wdid, spill_date FROM
  (SELECT 0 AS feed, * FROM ns UNION ALL BY NAME SELECT 1 AS feed, * FROM os)
WHERE wdid IN (SELECT wdid FROM fac WHERE cs_assessment = 'Yes')""",
        "",
    ),
    "anti_join_missing_report": ("SELECT *, 'No annual report' AS flag_reason FROM noreport", ""),
    "full_join_sources": ("SELECT * FROM lengths", "length_a length_b"),
    "attach_attributes": (
        """
SELECT c.*, a.length, a.length_class, a.population_class
FROM (SELECT wdid, CAST(year(spill_date) AS INTEGER) AS year, count(*) AS spill_count
      FROM (SELECT * FROM ns UNION ALL BY NAME SELECT * FROM os) GROUP BY ALL) c LEFT JOIN attrs a USING (wdid)""",
        "length",
    ),
    "union_feeds": (
        """
SELECT 0 AS feed, row_no, wdid, spill_type FROM ns
UNION ALL SELECT 1, row_no, wdid, spill_type FROM os""",
        "",
    ),
    "annual_counts": ("SELECT * FROM per_feed", ""),
    "monthly_counts": ("SELECT * FROM monthly", "length"),
    "annual_counts_combined": ("SELECT wdid, year, spill_count FROM yearly", ""),
    "latest_per_system": (
        """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
        "o_totalprice",
    ),
    "first_per_key": (
        """
SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1""",
        "o_totalprice",
    ),
    "source_label": (
        """
SELECT wdid, string_agg(source, ' & ' ORDER BY ord) AS source FROM (
  SELECT DISTINCT wdid, 'Reports' AS source, 0 AS ord FROM ar
  UNION ALL SELECT DISTINCT wdid, 'Months', 1 FROM mc
  UNION ALL SELECT DISTINCT wdid, 'Orders', 2 FROM en) GROUP BY wdid""",
        "",
    ),
    "dense_year_panel": ("SELECT * FROM dense_years", "length"),
    "dense_month_panel": ("SELECT * FROM dense_months", "length"),
    "fill_down_up": (
        """
SELECT wdid, year, spill_count, coalesce(
    last_value(v IGNORE NULLS) OVER (PARTITION BY wdid ORDER BY year
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(v IGNORE NULLS) OVER (PARTITION BY wdid ORDER BY year
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS report_length
FROM (SELECT d.wdid, d.year, d.spill_count, r.length AS v FROM dense_years d LEFT JOIN (
  SELECT * FROM ar QUALIFY row_number() OVER (PARTITION BY wdid, report_year ORDER BY row_no) = 1) r
  ON d.wdid = r.wdid AND d.year = r.report_year)""",
        "report_length",
    ),
    "rolling_5yr": ("SELECT * FROM rolled5", "length rolling_avg"),
    "rolling_12mo": (
        "SELECT wdid, length, month, spill_count, rolling_avg FROM rolled12",
        "length rolling_avg",
    ),
    "class_quartiles": ("SELECT * FROM quart5", "q1 q3"),
    "band_5yr": ("SELECT * FROM bands5", "length rolling_avg rate"),
    "band_12mo": ("SELECT * FROM bands12", "length rolling_avg rate"),
    "low_in_both_windows": ("SELECT * FROM low_pairs", "rate_5yr rate_12mo"),
    "low_performer_list": (
        """
SELECT substr(l.wdid, 1, 1) AS region, l.*, f.facility_name, 'Length' AS performance_category
FROM low_listed l LEFT JOIN (SELECT DISTINCT wdid, facility_name FROM fac) f USING (wdid)""",
        "rate_5yr rate_12mo",
    ),
    "absolute_limit_exemption": ("SELECT * FROM exempted", "rate_5yr rate_12mo"),
    "gesd_candidates": (
        """
SELECT wdid, year, length_class, rate FROM rates5 JOIN (
  SELECT length_class, quantile_cont(rate, 0.11) AS lo, quantile_cont(rate, 0.89) AS hi
  FROM rates5 WHERE rate IS NOT NULL AND in_baseline GROUP BY length_class) USING (length_class)
WHERE in_baseline AND (rate <= lo OR rate >= hi)""",
        "rate",
    ),
    "extreme_deviate_step1": (
        """
SELECT length_class, count(*) AS n, CASE WHEN count(*) >= 3 AND stddev_samp(rate) > 0
  THEN max(abs(rate - mean)) / stddev_samp(rate) END AS r_stat
FROM (SELECT *, avg(rate) OVER (PARTITION BY length_class) AS mean
      FROM rates5 WHERE rate IS NOT NULL AND in_baseline) GROUP BY length_class""",
        "r_stat",
    ),
    "gesd_outliers": ("SELECT * FROM g5_marks", ""),
    "nonreporting_entities": ("SELECT * FROM silent", ""),
    "reporting_gap_certificates": ("SELECT *, 'No spills reported' AS flag_reason FROM certs", ""),
    "reporting_gap_both": (
        """
SELECT substr(wdid, 1, 1) AS region, g.*, a.population_class, a.length_class, a.population, a.length
FROM gaps g LEFT JOIN attrs a USING (wdid)""",
        "population length",
    ),
    "reports_filed_by": (
        """
SELECT wdid, row_no, updated FROM ar WHERE updated IS NULL OR updated <= DATE '2001-01-01'""",
        "",
    ),
    "active_orders": ("SELECT * FROM active", "amount"),
    "enforcement_summary": ("SELECT * FROM order_totals", "total_assessment_amount"),
    "spill_summary": ("SELECT * FROM spill_totals", ""),
    "system_attributes": ("SELECT * FROM attrs", "population length_a length_b length_diff length"),
    "inadequacy_list": ("SELECT * FROM listed", ""),
    "under_enforcement": ("SELECT * FROM unlisted_orders", "population length"),
    "system_report": (
        "SELECT * FROM report",
        "population length rate_5yr rate_12mo total_assessment_amount length_a length_b length_diff "
        "avg_5yr avg_12mo",
    ),
    "summary_stats": (
        """
SELECT count(*) AS total_systems,
  count(*) FILTER (low_both AND NOT no_certificate) AS low_perf_only,
  count(*) FILTER (NOT low_both AND no_certificate) AS reporting_only,
  count(*) FILTER (criteria_met > 1) AS multiple_criteria FROM report""",
        "",
    ),
}


def _uses(sql: str) -> set[str]:
    return {w for w in re.findall(r"[a-z]\w*", sql) if w in CTES}


def _compose(sql: str, doubles: str) -> str:
    needed: set[str] = set()
    todo = _uses(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _uses(CTES[name])
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    # Definition order is dependency order, except that the report comes late.
    head = f"WITH RECURSIVE {', '.join(parts)}\n" if parts else ""
    rounding = ", ".join(f"round({c}, 6) AS {c}" for c in doubles.split())
    star = f"* REPLACE ({rounding})" if rounding else "*"
    return f"{head}SELECT {star} FROM ({sql.strip()})"


ORACLES: dict[str, str] = {key: _compose(*spec) for key, spec in _QUERIES.items()}
