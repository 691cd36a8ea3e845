"""The models in DuckDB SQL, over the same test tables: what the DataFrame versions are held against."""

from __future__ import annotations

import re

from ..functions.columns import NULL_PART
from ..sources.testbook import SQL as INPUTS
from .states import STATES
from .warehouse import DEFAULTS, FILLED, PROPERTY, TRACKED, TYPE_NAMES


def key(*parts: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULL_PART}')" for p in parts) + "))"


def fill(column: str, keys: str) -> str:
    tagged = f"{{'d': reporting_period_end_date, 'f': source_file, 'v': {column}}}"
    some = f"FILTER (WHERE {column} IS NOT NULL) OVER (PARTITION BY {keys}"
    return f"coalesce((max({tagged}) {some} ORDER BY reporting_period_end_date)).v, (min({tagged}) {some})).v)"


def months(later: str, earlier: str) -> str:
    return f"(date_part('year', age({later}, {earlier})) * 12 + date_part('month', age({later}, {earlier})))"


def month(later: str, earlier: str) -> str:
    return f"date_part('month', age({later}, {earlier}))"


def div(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0.0))"


def avg(column: str) -> str:
    return f"(CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0))"


_FILL_P = ", ".join(f"{fill(c, 'asset_num, property_num') if n in FILLED else c} AS {n}" for n, c in PROPERTY.items())
_MERGED_P = ", ".join(f"coalesce(p.{n}, b.{n}" + (f", '{DEFAULTS[n]}'" if n in DEFAULTS else "") + f") AS {n}" for n in PROPERTY)
_CHANGES = " OR ".join(
    f"coalesce(coalesce(lag({c}) OVER line, {before if isinstance(before, int) else repr(before)}) <> {c}, false)" for c, before in TRACKED.items()
)
_TYPES = " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in TYPE_NAMES.items())
_STATE_ROWS = ", ".join(str(row) for row in STATES)
_LATE = "delinquency_status <> '0'"
_LINE_P = "OVER (PARTITION BY property_id ORDER BY reporting_date)"

CTES: dict[str, str] = INPUTS | {
    "filled_properties": f"""
SELECT asset_num, property_num, reporting_period_end_date AS reporting_date, trust, company, property_name, source_file, {_FILL_P} FROM properties""",
    "one_property": """
SELECT * EXCLUDE (source_file, n) FROM (
  SELECT *, row_number() OVER (PARTITION BY asset_num, property_num, reporting_date ORDER BY source_file DESC, trust) AS n FROM filled_properties) WHERE n = 1""",
    "int_properties_cleaned": f"""
SELECT *, {key("property_state", "property_city", "property_zip", "property_address")} AS geo_id FROM (
  SELECT p.asset_num, p.property_num, p.reporting_date, p.trust, p.company, p.property_name, {_MERGED_P}
  FROM one_property p LEFT JOIN one_property b
    ON p.asset_num = b.asset_num || 'A' AND p.property_num = b.property_num AND p.reporting_date = b.reporting_date)""",
    "dim_date": """
SELECT d AS date_id, d AS date_day, CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month,
       rpad(strftime(d, '%B'), 9, ' ') AS month_name, CAST(day(d) AS BIGINT) AS day_of_month, CAST(dayofweek(d) AS BIGINT) AS day_of_week,
       rpad(strftime(d, '%A'), 9, ' ') AS day_of_week_name, d = last_day(d) AS is_end_of_month,
       CAST(CASE quarter(d) WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 1 THEN 3 ELSE 4 END AS BIGINT) AS fiscal_quarter,
       CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS BIGINT) AS fiscal_year,
       CAST(date_trunc('month', d) AS DATE) AS first_day_of_month, last_day(d) AS last_day_of_month,
       CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter, CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_quarter,
       CAST(date_trunc('year', d) AS DATE) AS first_day_of_year, CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS last_day_of_year,
       false AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name, dayofweek(d) NOT IN (0, 6) AS is_business_day
FROM (SELECT CAST(unnest(generate_series(DATE '2000-01-01', DATE '2030-12-30', INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_trust": f"""
SELECT {key("t.trust")} AS trust_id, t.trust AS trust_name, company AS issuer, first_reporting_date, latest_reporting_date, orig_loan_count, total_orig_bal,
       current_loan_count, delinquent_loans, current_bal, CASE WHEN total_orig_bal > 0 THEN {div("current_bal", "total_orig_bal")} END AS factor,
       CASE WHEN current_loan_count > 0 THEN {div("delinquent_loans", "current_loan_count")} ELSE 0.0 END AS delinquency_ratio
FROM (SELECT trust, company, min(reporting_period_end_date) AS first_reporting_date, max(reporting_period_end_date) AS latest_reporting_date,
             count(DISTINCT asset_num) AS orig_loan_count, sum(original_loan_amt) AS total_orig_bal FROM loans GROUP BY trust, company) t
LEFT JOIN (SELECT trust, count(DISTINCT asset_num) AS current_loan_count, count(*) FILTER (WHERE payment_status_loan_code IN ('1', '2', '3', '4', '5')) AS delinquent_loans,
                  sum(report_period_end_scheduled_loan_bal_amt) AS current_bal
           FROM loans l WHERE reporting_period_end_date = (SELECT max(reporting_period_end_date) FROM loans m WHERE m.trust = l.trust) GROUP BY trust) n ON n.trust = t.trust""",
    "dim_geo_state": f"""
SELECT {key("state_code")} AS state_id, * FROM (VALUES {_STATE_ROWS}) v(state_code, state_name, region_name, division_name)""",
    "dim_geo_city": f"""
SELECT DISTINCT {key("state_id", "property_city")} AS city_id, state_id, property_city AS city_name
FROM int_properties_cleaned JOIN dim_geo_state ON property_state = state_code""",
    "dim_geo_zip": f"""
SELECT DISTINCT {key("city_id", "property_zip")} AS zip_id, city_id, property_zip AS zip_code
FROM int_properties_cleaned JOIN dim_geo_state s ON property_state = state_code JOIN dim_geo_city c ON c.city_name = property_city AND c.state_id = s.state_id""",
    "dim_geo_address": """
SELECT DISTINCT geo_id AS address_id, zip_id, property_address
FROM int_properties_cleaned JOIN dim_geo_state s ON property_state = state_code JOIN dim_geo_city c ON c.city_name = property_city AND c.state_id = s.state_id
JOIN dim_geo_zip z ON z.zip_code = property_zip AND z.city_id = c.city_id""",
    "geo": """
SELECT address_id AS geo_id, property_address, zip_code, city_name, state_code, state_name, region_name, division_name
FROM dim_geo_address JOIN dim_geo_zip USING (zip_id) JOIN dim_geo_city USING (city_id) JOIN dim_geo_state USING (state_id)""",
    "dim_property": f"""
SELECT property_id, reporting_date AS effective_date, coalesce(lead(reporting_date) OVER (PARTITION BY property_id ORDER BY reporting_date), DATE '9999-12-31') AS end_date,
       property_name, property_type_code, CASE property_type_code {_TYPES} ELSE 'Other' END AS property_type_description, property_status_code, year_built,
       square_feet, unit_count, company AS issuer, trust_id, geo_id
FROM (SELECT *, asset_num || '_' || property_num AS property_id, {_CHANGES} AS changed FROM int_properties_cleaned
      WINDOW line AS (PARTITION BY asset_num, property_num ORDER BY reporting_date))
JOIN dim_trust ON trust = trust_name WHERE changed""",
    "one_loan": f"""
SELECT * EXCLUDE (source_file, n) FROM (
  SELECT *, row_number() OVER (PARTITION BY loan_id, reporting_date ORDER BY source_file DESC, trust_name) AS n FROM (
    SELECT asset_num AS loan_id, reporting_period_end_date AS reporting_date, trust AS trust_name, company AS issuer, source_file, original_loan_amt AS orig_bal,
           report_period_end_scheduled_loan_bal_amt AS current_bal, report_period_begin_schedule_loan_bal_amt AS begin_bal, report_period_intr_rate_pct AS current_intr_rate,
           payment_frequency_code AS payment_frequency, origination_date, modified_indicator AS is_modified, report_period_modification_indicator AS modified_this_period,
           total_scheduled_prin_intr_due_amt AS pmt_due, {fill("maturity_date", "asset_num")} AS maturity_date,
           CASE WHEN payment_status_loan_code IN ('A', 'B') THEN '0' ELSE coalesce(payment_status_loan_code, '0') END AS delinquency_status,
           scheduled_prin_amt + scheduled_intr_amt AS pmt_received FROM loans)) WHERE n = 1""",
    "whole_loan": """
SELECT b.loan_id, b.reporting_date, b.trust_name, b.issuer, coalesce(b.orig_bal, s.orig_bal) AS orig_bal, coalesce(b.current_bal, s.current_bal) AS current_bal,
       coalesce(b.begin_bal, s.begin_bal) AS begin_bal, coalesce(b.current_intr_rate, s.current_intr_rate) AS current_intr_rate,
       coalesce(b.payment_frequency, s.payment_frequency) AS payment_frequency, coalesce(b.origination_date, s.origination_date) AS origination_date,
       coalesce(b.is_modified, s.is_modified) AS is_modified, coalesce(b.modified_this_period, s.modified_this_period) AS modified_this_period,
       coalesce(b.pmt_due, s.pmt_due) AS pmt_due, coalesce(b.maturity_date, s.maturity_date) AS maturity_date,
       coalesce(b.delinquency_status, s.delinquency_status) AS delinquency_status, coalesce(b.pmt_received, s.pmt_received) AS pmt_received
FROM one_loan b LEFT JOIN one_loan s ON s.loan_id = b.loan_id || 'A' AND s.reporting_date = b.reporting_date""",
    "fct_loan_monthly_performance": f"""
SELECT {key("loan_id", "reporting_date", "trust_id")} AS loan_performance_id, loan_id, reporting_date, trust_id, l.current_bal, begin_bal, orig_bal, delinquency_status,
       is_modified, modified_this_period, maturity_date < reporting_date AS is_past_maturity,
       CASE WHEN delinquency_status IN ('1', '2', '3', '4', '5', '6') THEN 30 * CAST(delinquency_status AS BIGINT) ELSE 0 END AS days_past_due,
       CASE WHEN delinquency_status = '0' THEN 'Current' WHEN delinquency_status IN ('1', '2') THEN 'Delinquent < 90 Days'
            WHEN delinquency_status IN ('3', '4', '5', '6') THEN 'Delinquent 90+ Days' ELSE 'Other' END AS loan_status,
       pmt_due, pmt_received, pmt_due - pmt_received AS pmt_shortfall, current_intr_rate, payment_frequency, maturity_date, origination_date, l.issuer,
       CASE WHEN orig_bal > 0 THEN {div("l.current_bal", "orig_bal")} END AS remaining_bal_pct, {month("maturity_date", "reporting_date")} AS months_to_maturity,
       {month("reporting_date", "origination_date")} AS months_since_origination, CASE WHEN {_LATE} THEN pmt_due - pmt_received ELSE 0 END AS delinquent_amt
FROM whole_loan l JOIN dim_trust USING (trust_name)""",
    "fct_loan_modifications": f"""
SELECT {key("loan_id", "reporting_date")} AS modification_id, loan_id, reporting_date AS modification_date, trust_name AS trust_id,
       CASE WHEN modified_this_period THEN 'This Period' WHEN is_modified THEN 'Existing' ELSE 'Unknown' END AS modification_type,
       rate_moved AS has_rate_change, end_moved AS has_maturity_change, was_rate AS previous_intr_rate, current_intr_rate AS new_intr_rate,
       coalesce(current_intr_rate, 0) - coalesce(was_rate, 0) AS intr_rate_change, was_end AS previous_maturity_date, maturity_date AS new_maturity_date,
       CAST(maturity_date - was_end AS BIGINT) AS maturity_extension_days, current_bal
FROM (SELECT *, coalesce(abs(current_intr_rate - was_rate) > 0.0001, false) AS rate_moved, coalesce(maturity_date <> was_end, false) AS end_moved
      FROM (SELECT *, lag(current_intr_rate) OVER line AS was_rate, lag(maturity_date) OVER line AS was_end, lag(reporting_date) OVER line AS was_date
            FROM one_loan WINDOW line AS (PARTITION BY loan_id ORDER BY reporting_date)))
WHERE was_date IS NOT NULL AND (coalesce(modified_this_period, false) OR coalesce(is_modified, false)) AND (rate_moved OR end_moved)""",
    "fct_property_metrics": f"""
SELECT {key("asset_num", "property_num", "reporting_date", "t.trust_id")} AS property_metric_id, v.property_id, reporting_date, t.trust_id, v.property_type_code, v.square_feet, v.unit_count,
       current_valuation, securitization_valuation, current_occupancy_pct, securitization_occupancy_pct, current_revenue, current_expenses, current_noi, current_dscr,
       largest_tenant IS NOT NULL AS has_largest_tenant, second_largest_tenant IS NOT NULL AS has_second_largest_tenant, third_largest_tenant IS NOT NULL AS has_third_largest_tenant,
       v.property_status_code, company AS issuer,
       CASE WHEN securitization_valuation = 0 THEN 0.0 ELSE {div("(current_valuation - securitization_valuation)", "securitization_valuation")} END AS valuation_change_pct,
       coalesce(current_occupancy_pct, 0) - coalesce(securitization_occupancy_pct, 0) AS occupancy_change_pct,
       CASE WHEN current_revenue = 0 THEN 0.0 ELSE {div("current_expenses", "current_revenue")} END AS expense_ratio,
       CASE WHEN v.square_feet > 0 THEN {div("current_revenue", "v.square_feet")} END AS revenue_per_sqft, CASE WHEN v.unit_count > 0 THEN {div("current_revenue", "v.unit_count")} END AS revenue_per_unit
FROM int_properties_cleaned p JOIN dim_property v ON v.property_id = p.asset_num || '_' || p.property_num AND reporting_date >= effective_date AND reporting_date < end_date
JOIN dim_trust t ON t.trust_name = p.trust""",
    "live_loans": "SELECT * FROM fct_loan_monthly_performance WHERE NOT is_past_maturity",
    "loan_aging_metrics": f"""
SELECT loan_id, trust_id, maturity_date, reporting_date, loan_age_months, months_to_maturity, original_term_months, origination_date,
       CASE WHEN loan_age_months <= 30 THEN rate * {div("30", "loan_age_months")} ELSE rate END AS psa_speed, rate AS cpr, {div("paid", "was")} * 100 AS smm,
       fell AS is_prepayment, current_bal, orig_bal, {div("current_bal", "orig_bal")} * 100 AS percent_remaining_balance,
       CAST(date_trunc('year', origination_date) AS DATE) AS origination_vintage_year, CAST(date_trunc('quarter', origination_date) AS DATE) AS origination_vintage_quarter,
       CAST(date_trunc('year', reporting_date + to_months(CAST(months_to_maturity AS INTEGER))) AS DATE) AS maturity_vintage_year,
       CASE WHEN loan_age_months <= 12 THEN '0-1 Year' WHEN loan_age_months <= 24 THEN '1-2 Years' WHEN loan_age_months <= 36 THEN '2-3 Years' WHEN loan_age_months <= 60 THEN '3-5 Years'
            WHEN loan_age_months <= 84 THEN '5-7 Years' WHEN loan_age_months <= 120 THEN '7-10 Years' ELSE 'Over 10 Years' END AS loan_age_bucket,
       CASE WHEN months_to_maturity <= 12 THEN 'Under 1 Year' WHEN months_to_maturity <= 36 THEN '1-3 Years' WHEN months_to_maturity <= 60 THEN '3-5 Years'
            WHEN months_to_maturity <= 120 THEN '5-10 Years' ELSE 'Over 10 Years' END AS remaining_term_bucket
FROM (SELECT *, {div("paid", "current_bal")} * 100 AS rate FROM (
  SELECT *, coalesce(was > current_bal, false) AS fell, CASE WHEN was > current_bal THEN was - current_bal ELSE 0 END AS paid FROM (
    SELECT l.*, lag(current_bal) OVER (PARTITION BY loan_id ORDER BY reporting_date, l.trust_id) AS was, {months("reporting_date", "origination_date")} + 1 AS loan_age_months,
           {months("maturity_date", "origination_date")} + 1 AS original_term_months
    FROM live_loans l JOIN (SELECT DISTINCT loan_id, trust_id FROM live_loans) k USING (loan_id))))""",
    "property_months": """
SELECT m.* EXCLUDE (property_type_code, square_feet, unit_count, expense_ratio, occupancy_change_pct), v.property_type_code, v.square_feet, v.unit_count, g.* EXCLUDE (geo_id)
FROM fct_property_metrics m JOIN dim_property v ON m.property_id = v.property_id AND m.reporting_date >= v.effective_date AND m.reporting_date < v.end_date
LEFT JOIN geo g ON g.geo_id = v.geo_id""",
    "loan_properties": f"""
SELECT split_part(property_id, '_', 1) AS loan_id, reporting_date, sum(current_valuation) AS total_valuation, {avg("current_occupancy_pct")} AS occ, {avg("current_dscr")} AS dscr,
       mode() WITHIN GROUP (ORDER BY property_type_code) AS property_type_code, mode() WITHIN GROUP (ORDER BY state_code) AS property_state
FROM property_months GROUP BY ALL""",
    "scored_loans": f"""
SELECT *, CAST(floor((CASE WHEN ltv > 0.8 THEN 4 WHEN ltv > 0.6 THEN 2 WHEN ltv IS NOT NULL THEN 0 ELSE 2 END
                 + CASE WHEN dscr < 1.2 THEN 4 WHEN dscr < 1.5 THEN 2 WHEN dscr IS NOT NULL THEN 0 ELSE 2 END
                 + CASE WHEN occ < 0.8 THEN 2 WHEN occ < 0.9 THEN 1 WHEN occ IS NOT NULL THEN 0 ELSE 1 END
                 + CASE WHEN delinquency_status IN ('3', '4', '5', '6') THEN 10 WHEN delinquency_status IN ('1', '2') THEN 6 ELSE 0 END) / 2) AS BIGINT) AS risk_score
FROM (SELECT l.*, p.* EXCLUDE (loan_id, reporting_date), CASE WHEN total_valuation > 0 THEN {div("current_bal", "total_valuation")} END AS ltv
      FROM live_loans l LEFT JOIN loan_properties p ON p.loan_id = l.loan_id AND p.reporting_date = l.reporting_date)""",
    "loan_risk_metrics": f"""
SELECT trust_id, property_type_code, property_state, reporting_date, count(*) AS loan_count, sum(current_bal) AS total_loan_amt, round(avg(ltv), 9) AS avg_ltv, round(avg(dscr), 9) AS avg_dscr,
       round(avg(occ), 9) AS avg_occupancy, count(*) FILTER (WHERE ltv > 0.8) / count(*) AS high_ltv_pct, count(*) FILTER (WHERE dscr < 1.2) / count(*) AS high_dscr_pct,
       count(*) FILTER (WHERE occ < 0.8) / count(*) AS high_occupancy_risk_pct, count(*) FILTER (WHERE days_past_due > 60) / count(*) AS high_delinquency_risk_pct, {avg("risk_score")} AS avg_risk_score,
       sum(CASE WHEN risk_score >= 8 THEN current_bal ELSE 0 END) AS high_risk_bal, sum(CASE WHEN risk_score BETWEEN 4 AND 7 THEN current_bal ELSE 0 END) AS medium_risk_bal,
       sum(CASE WHEN risk_score < 4 THEN current_bal ELSE 0 END) AS low_risk_bal, {div("sum(CASE WHEN risk_score >= 8 THEN current_bal ELSE 0 END)", "sum(current_bal)")} AS high_risk_ratio,
       {div("sum(CASE WHEN risk_score BETWEEN 4 AND 7 THEN current_bal ELSE 0 END)", "sum(current_bal)")} AS medium_risk_ratio, {div("sum(CASE WHEN risk_score < 4 THEN current_bal ELSE 0 END)", "sum(current_bal)")} AS low_risk_ratio
FROM scored_loans GROUP BY ALL""",
    "vintages": f"""
SELECT *, CAST((year(reporting_date) - vintage_year) * 12 + month(reporting_date) - 1 AS BIGINT) AS vintage_age_months,
       {div("delinquent_balance", "total_balance")} AS delinquency_rate, {div("severe_delinquent_balance", "total_balance")} AS severe_delinquency_rate, {div("modified_balance", "total_balance")} AS modification_rate
FROM (SELECT reporting_date, CAST(year(origination_date) AS BIGINT) AS vintage_year, count(DISTINCT loan_id) AS loan_count, sum(current_bal) AS total_balance,
             sum(CASE WHEN {_LATE} THEN current_bal ELSE 0 END) AS delinquent_balance, sum(CASE WHEN days_past_due >= 90 THEN current_bal ELSE 0 END) AS severe_delinquent_balance,
             sum(CASE WHEN is_modified THEN current_bal ELSE 0 END) AS modified_balance, {avg("days_past_due")} AS avg_days_past_due, {avg("current_bal")} AS avg_loan_balance
      FROM fct_loan_monthly_performance WHERE year(origination_date) BETWEEN 2000 AND 2002 GROUP BY 1, 2)""",
    "vintage_performance": """
SELECT *, CASE WHEN delinquency_percentile_at_age < 0.25 THEN 'Top Performer' WHEN delinquency_percentile_at_age < 0.5 THEN 'Above Average'
               WHEN delinquency_percentile_at_age < 0.75 THEN 'Below Average' ELSE 'Underperformer' END AS vintage_performance_category,
       CASE WHEN delinquency_3m_change IS NULL THEN 'Insufficient Data' WHEN delinquency_3m_change < -0.01 THEN 'Improving' WHEN delinquency_3m_change > 0.01 THEN 'Deteriorating' ELSE 'Stable' END AS short_term_trend
FROM (SELECT *, round(avg(delinquency_rate) OVER age, 9) AS avg_delinquency_at_age, max(delinquency_rate) OVER age AS max_delinquency_at_age, min(delinquency_rate) OVER age AS min_delinquency_at_age,
             round(delinquency_rate - avg(delinquency_rate) OVER age, 9) AS delinquency_vs_avg_at_age,
             percent_rank() OVER (PARTITION BY vintage_age_months ORDER BY delinquency_rate NULLS LAST) AS delinquency_percentile_at_age,
             delinquency_rate - lag(delinquency_rate, 3) OVER line AS delinquency_3m_change, delinquency_rate - lag(delinquency_rate, 6) OVER line AS delinquency_6m_change,
             delinquency_rate - lag(delinquency_rate, 12) OVER line AS delinquency_12m_change
      FROM vintages WINDOW age AS (PARTITION BY vintage_age_months), line AS (PARTITION BY vintage_year ORDER BY reporting_date))""",
    "property_occupancy_noi": f"""
SELECT property_id, reporting_date, property_type_code, state, region, current_occupancy_pct AS current_occupancy, securitization_occupancy_pct AS securitization_occupancy,
       current_occupancy_pct - securitization_occupancy_pct AS occupancy_change, trailing_12m_avg_occupancy, occupancy_volatility_12m, current_revenue, current_expenses, current_noi,
       noi_per_sqft, {div("current_expenses", "current_revenue")} AS expense_ratio, trailing_12m_noi, {div("(current_noi - ago)", "ago")} * 100 AS noi_yoy_growth, square_feet,
       round(avg(CAST(current_occupancy_pct AS DOUBLE)) OVER kind, 9) AS avg_occupancy_by_property_type, round(avg(noi_per_sqft) OVER kind, 9) AS avg_noi_per_sqft_by_property_type,
       round(avg(CAST(current_occupancy_pct AS DOUBLE)) OVER place, 9) AS avg_occupancy_by_state, round(avg(noi_per_sqft) OVER place, 9) AS avg_noi_per_sqft_by_state
FROM (SELECT *, state_code AS state, region_name AS region, {div("current_noi", "square_feet")} AS noi_per_sqft, lag(current_noi, 12) {_LINE_P} AS ago, date_trunc('month', reporting_date) AS m,
             round(avg(CAST(current_occupancy_pct AS DOUBLE)) OVER y, 9) AS trailing_12m_avg_occupancy, round(stddev(CAST(current_occupancy_pct AS DOUBLE)) OVER y, 6) AS occupancy_volatility_12m,
             sum(current_noi) OVER y AS trailing_12m_noi
      FROM property_months WINDOW y AS (PARTITION BY property_id ORDER BY reporting_date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
WINDOW kind AS (PARTITION BY property_type_code, m), place AS (PARTITION BY state, m)""",
    "delinquency_by_month_trust": f"""
SELECT d.year, d.month, trust_name, sum(l.current_bal) AS total_balance, sum(CASE WHEN days_past_due > 0 THEN l.current_bal ELSE 0 END) AS delinquent_balance,
       {div("sum(CASE WHEN days_past_due > 0 THEN l.current_bal ELSE 0 END)", "sum(l.current_bal)")} AS delinquency_rate
FROM fct_loan_monthly_performance l JOIN dim_date d ON l.reporting_date = d.date_id JOIN dim_trust t ON t.trust_id = l.trust_id GROUP BY 1, 2, 3""",
    "property_by_type": f"""
SELECT property_type_description, {avg("current_occupancy_pct")} AS avg_occupancy, {avg("current_dscr")} AS avg_dscr, round(avg(revenue_per_sqft), 6) AS avg_revenue_per_sqft
FROM fct_property_metrics m JOIN dim_property v USING (property_id) WHERE reporting_date > DATE '1996-01-01' GROUP BY 1""",
    "modification_impact": f"""
SELECT modification_type, {avg("CASE WHEN reporting_date <= modification_date + INTERVAL 3 MONTH THEN days_past_due END")} AS avg_dpd_3m_after,
       {avg("CASE WHEN reporting_date <= modification_date + INTERVAL 6 MONTH THEN CAST(days_past_due = 0 AS INTEGER) END")} AS pct_current_6m_after, count(DISTINCT loan_id) AS loan_count
FROM (SELECT loan_id, modification_date, CASE WHEN intr_rate_change < -1 THEN 'Large Rate Decrease (>1%)' WHEN intr_rate_change < 0 THEN 'Rate Decrease'
                 WHEN intr_rate_change > 1 THEN 'Large Rate Increase (>1%)' WHEN intr_rate_change > 0 THEN 'Rate Increase' ELSE 'No Change' END AS modification_type
      FROM fct_loan_modifications WHERE has_rate_change)
JOIN fct_loan_monthly_performance USING (loan_id) WHERE reporting_date >= modification_date GROUP BY 1""",
}


def _concentration(source: str) -> str:
    category = {
        "Property Type": "coalesce(property_type_code, 'Unknown')",
        "State": "coalesce(state_name, 'Unknown')",
        "City": "city_name || ', ' || coalesce(state_code, '')",
        "ZIP Code": "zip_code",
        "Address": "property_address || ', ' || coalesce(city_name, '') || ', ' || coalesce(state_code, '')",
        "Region": "coalesce(region_name, 'Unknown')",
        "Division": "coalesce(division_name, 'Unknown')",
        "Loan Size": "CASE WHEN current_bal < 1000000 THEN 'Under $1M' WHEN current_bal < 5000000 THEN '$1M - $5M' WHEN current_bal < 10000000 THEN '$5M - $10M' WHEN current_bal < 25000000 THEN '$10M - $25M' WHEN current_bal < 50000000 THEN '$25M - $50M' ELSE 'Over $50M' END",
        "Interest Rate": "CASE WHEN current_intr_rate < 0.03 THEN 'Under 3%' WHEN current_intr_rate < 0.04 THEN '3% - 4%' WHEN current_intr_rate < 0.05 THEN '4% - 5%' WHEN current_intr_rate < 0.06 THEN '5% - 6%' ELSE 'Over 6%' END",
        "Remaining Term": "CASE WHEN maturity_date <= reporting_date THEN 'Matured' "
        + " ".join(f"WHEN maturity_date <= reporting_date + INTERVAL {n} YEAR THEN '{t}'" for n, t in ((1, "Under 1 Year"), (3, "1-3 Years"), (5, "3-5 Years"), (10, "5-10 Years")))
        + " ELSE 'Over 10 Years' END",
    }
    parts = " UNION ALL ".join(f"SELECT reporting_date, loan_id, current_bal, '{k}' AS concentration_type, {v} AS concentration_category FROM {source}" for k, v in category.items())
    place = "rank() OVER (PARTITION BY reporting_date, concentration_type ORDER BY total_balance DESC NULLS FIRST)"
    return f"""
SELECT reporting_date, concentration_type, concentration_category, loan_count, total_balance, {div("total_balance", "loan_count")} AS avg_loan_balance,
       {div("loan_count", "all_loans")} AS pct_of_loans, {div("total_balance", "all_balance")} AS pct_of_balance, {place} AS rank_by_balance, {place} <= 5 AS is_top_5
FROM (SELECT reporting_date, concentration_type, concentration_category, count(DISTINCT loan_id) AS loan_count, sum(current_bal) AS total_balance
      FROM ({parts}) WHERE concentration_category IS NOT NULL GROUP BY 1, 2, 3)
JOIN (SELECT reporting_date, count(DISTINCT loan_id) AS all_loans, sum(current_bal) AS all_balance FROM {source} GROUP BY 1) USING (reporting_date)"""


def _performance(joined: str) -> str:
    usual = {
        "occupancy_pct": "current_occupancy_pct", "value_per_sq_ft": "value_per_sq_ft", "revenue_per_sq_ft": "revenue_per_sq_ft", "noi_per_sq_ft": "noi_per_sq_ft",
        "expense_ratio": "expense_ratio", "debt_yield": "debt_yield", "dscr": "current_dscr",
    }
    averages = ", ".join(f"CASE WHEN property_type_code IS NOT NULL THEN round(avg(CAST({c} AS DOUBLE)) OVER kind, 9) END AS type_avg_{n}" for n, c in usual.items())
    lags = ", ".join(f"{c} - lag({c}, {m}) {_LINE_P} AS {n}_{m}m_change" for m in (3, 12) for n, c in (("valuation", "current_valuation"), ("occupancy", "current_occupancy_pct"), ("noi", "current_noi")))
    per = ", ".join(f"{div(c, 'square_feet')} AS {n}_per_sq_ft, {div(c, 'unit_count')} AS {n}_per_unit" for n, c in (("value", "current_valuation"), ("revenue", "current_revenue"), ("noi", "current_noi")))
    against = lambda c, a: f"CASE WHEN round(CAST({c} AS DOUBLE), 9) > {a} THEN 'Above Average' WHEN round(CAST({c} AS DOUBLE), 9) < {a} THEN 'Below Average' ELSE 'Average' END"
    return f"""
SELECT * EXCLUDE (loan_key), {against("current_occupancy_pct", "type_avg_occupancy_pct")} AS occupancy_vs_type, {against("current_dscr", "type_avg_dscr")} AS dscr_vs_type, {against("noi_per_sq_ft", "type_avg_noi_per_sq_ft")} AS noi_vs_type,
       CASE WHEN current_dscr >= 1.5 AND current_occupancy_pct >= 0.9 THEN 'Strong Performer' WHEN current_dscr >= 1.2 AND current_occupancy_pct >= 0.8 THEN 'Stable Performer'
            WHEN current_dscr < 1.2 OR current_occupancy_pct < 0.8 THEN 'Underperformer' WHEN current_dscr < 1.0 OR current_occupancy_pct < 0.7 THEN 'Distressed' ELSE 'Moderate Performer' END AS performance_category,
       CASE WHEN occupancy_3m_change > 0.02 THEN 'Improving' WHEN occupancy_3m_change < -0.02 THEN 'Declining' ELSE 'Stable' END AS occupancy_trend,
       CASE WHEN noi_3m_change > 0 THEN 'Improving' WHEN noi_3m_change < 0 THEN 'Declining' ELSE 'Stable' END AS noi_trend,
       CAST(CASE WHEN current_dscr >= 1.5 THEN 0 WHEN current_dscr >= 1.2 THEN 1 WHEN current_dscr >= 1.0 THEN 2 ELSE 3 END
          + CASE WHEN current_occupancy_pct >= 0.9 THEN 0 WHEN current_occupancy_pct >= 0.8 THEN 1 WHEN current_occupancy_pct >= 0.7 THEN 1.5 ELSE 2 END
          + CASE WHEN loan_to_value_ratio IS NULL THEN 1 WHEN loan_to_value_ratio <= 0.6 THEN 0 WHEN loan_to_value_ratio <= 0.7 THEN 0.5 WHEN loan_to_value_ratio <= 0.8 THEN 1 ELSE 2 END
          + CASE WHEN debt_yield IS NULL THEN 0.75 WHEN debt_yield >= 0.10 THEN 0 WHEN debt_yield >= 0.08 THEN 0.5 WHEN debt_yield >= 0.06 THEN 1 ELSE 1.5 END
          + CASE WHEN occupancy_3m_change < -0.03 OR noi_3m_change < 0 THEN 1.5 WHEN occupancy_3m_change < -0.02 THEN 1 WHEN occupancy_3m_change < -0.01 THEN 0.5 ELSE 0 END AS DOUBLE) AS property_risk_score
FROM (SELECT *, {lags}, {averages} FROM (
  SELECT p.* EXCLUDE (valuation_change_pct, property_metric_id, trust_id, has_largest_tenant, has_second_largest_tenant, has_third_largest_tenant, property_status_code, issuer, revenue_per_sqft, revenue_per_unit),
         l.loan_id AS loan_key, l.current_bal AS loan_balance, l.current_intr_rate, l.origination_date, CASE WHEN current_valuation > 0 THEN {div("l.current_bal", "current_valuation")} END AS loan_to_value_ratio,
         CASE WHEN l.current_bal > 0 THEN {div("current_noi", "l.current_bal")} END AS debt_yield, {per}, {div("current_expenses", "current_revenue")} AS expense_ratio,
         {div("current_valuation", "securitization_valuation")} - 1 AS valuation_change_pct, current_occupancy_pct - securitization_occupancy_pct AS occupancy_change_pct
  FROM property_months p LEFT JOIN fct_loan_monthly_performance l ON l.loan_id = {joined} AND l.reporting_date = p.reporting_date)
  WINDOW kind AS (PARTITION BY reporting_date, property_type_code))"""


CTES |= {
    "placed_loans": """
SELECT l.*, v.property_type_code, g.* EXCLUDE (geo_id) FROM live_loans l
LEFT JOIN dim_property v ON v.property_id = l.loan_id AND l.reporting_date >= v.effective_date AND l.reporting_date < v.end_date LEFT JOIN geo g ON g.geo_id = v.geo_id""",
    "placed_loans_fixed": """
SELECT l.* EXCLUDE (n), g.* EXCLUDE (geo_id) FROM (
  SELECT l.*, v.property_type_code, v.geo_id, row_number() OVER (PARTITION BY l.loan_id, l.reporting_date, l.trust_id ORDER BY split_part(v.property_id, '_', 2) NULLS LAST) AS n
  FROM live_loans l LEFT JOIN dim_property v ON split_part(v.property_id, '_', 1) = l.loan_id AND l.reporting_date >= v.effective_date AND l.reporting_date < v.end_date) l
LEFT JOIN geo g ON g.geo_id = l.geo_id WHERE n = 1""",
    "portfolio_concentration": _concentration("placed_loans"),
    "portfolio_concentration_fixed": _concentration("placed_loans_fixed"),
    "property_performance_metrics": _performance("p.property_id"),
    "property_performance_fixed": _performance("split_part(p.property_id, '_', 1)"),
}


def needed(text: str, known: dict[str, str]) -> list[str]:
    """Names of the expressions that a query reads, in the order in which they must be defined."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_]\w*", body)):
            if name in known and name not in order and name not in path:
                path.append(name)
                visit(known[name])
                path.pop()
                order.append(name)

    path: list[str] = []
    visit(text)
    return order


#: Names of expressions that are also names of columns or of test tables, so a mention alone is no use of them.
def query(body: str, more: dict[str, str] | None = None) -> str:
    """``body`` with the common table expressions it needs; decimals come as doubles, whole numbers as 64 bits."""
    known = CTES | (more or {})
    text = ",\n".join(f"{n} AS MATERIALIZED ({known[n]})" for n in needed(body, known))
    return (f"WITH {text}\n" if text else "") + body
