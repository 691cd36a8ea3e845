"""Queries over the test tables: one per model, operator, check and metric, each with DuckDB SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import below, filled, ladder, mean, month_part, months_between_parts, parsed_date, ratio, surrogate_key
from ..operators import checks, groups, profile, selection, validate
from ..operators.rows import aligned, as_of_versions, first_per_key, merged, new_rows, numbered, since_latest
from ..sources import clustering, listings, scratch, testbook
from ..sources.rawstore import RawStore
from ..sources.schema import ColumnSpec
from ..sources.versions import VersionedTable
from .metrics import METRICS, SPREAD_SQL, metric, metric_sql, model_of
from .oracle import fill, key, month, months, query
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_MORE = {"vintage_spread": SPREAD_SQL}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    parts = testbook.parts(spark, folder)
    return Warehouse(testbook.loans(spark, folder, parts, dealt=False), testbook.properties(spark, folder), parts=parts, dealt_loans=testbook.loans(spark, folder, parts))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as 64 bits: types that any client reads alike."""
    def cast(name: str, kind: str):
        if kind.startswith("decimal") or kind == "float":
            return F.col(name).cast("double")
        return F.col(name).cast("bigint") if kind in ("tinyint", "smallint", "int") else F.col(name)

    return df.select(*(cast(n, k).alias(n) for n, k in df.dtypes))


def add(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = lambda spark, folder: plain(f(spark, folder))
        if sql is not None:
            ORACLE[name] = query(sql, _MORE)
        return f

    return put


# --- models -----------------------------------------------------------------------------------------------------------

_P = "current_valuation securitization_valuation current_occupancy_pct securitization_occupancy_pct current_revenue current_expenses current_noi current_dscr"
_TREND = " ".join(f"{n}_{m}m_change" for m in (3, 12) for n in ("valuation", "occupancy", "noi"))
#: Each model with its columns of decimals, which results carry as doubles.
MODELS = {
    "int_properties_cleaned": _P,
    "dim_date": "",
    "dim_trust": "total_orig_bal current_bal",
    "dim_geo_state": "",
    "dim_geo_city": "",
    "dim_geo_zip": "",
    "dim_geo_address": "",
    "geo": "",
    "dim_property": "",
    "fct_loan_monthly_performance": "current_bal begin_bal orig_bal pmt_due pmt_received pmt_shortfall current_intr_rate delinquent_amt",
    "fct_loan_modifications": "previous_intr_rate new_intr_rate intr_rate_change current_bal",
    "fct_property_metrics": f"{_P} occupancy_change_pct",
    "loan_aging_metrics": "current_bal orig_bal",
    "loan_risk_metrics": "total_loan_amt high_risk_bal medium_risk_bal low_risk_bal",
    "vintage_performance": "total_balance delinquent_balance severe_delinquent_balance modified_balance",
    "property_performance_metrics": f"{_P} loan_balance current_intr_rate occupancy_change_pct {_TREND}",
    "property_performance_fixed": f"{_P} loan_balance current_intr_rate occupancy_change_pct {_TREND}",
    "portfolio_concentration": "total_balance",
    "portfolio_concentration_fixed": "total_balance",
    "property_occupancy_noi": "current_occupancy securitization_occupancy occupancy_change current_revenue current_expenses current_noi trailing_12m_noi",
    "delinquency_by_month_trust": "total_balance delinquent_balance",
    "property_by_type": "",
    "modification_impact": "",
}


def _doubles(columns: str) -> str:
    return f" REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in columns.split())})" if columns else ""


for _name, _columns in MODELS.items():
    add(f"m_{_name}", f"SELECT *{_doubles(_columns)} FROM {_name}")(lambda s, d, n=_name: warehouse(s, d)[n])


# the two dimensions that come from no table are queried with the rows that refer to them
@add("m_dim_date", "SELECT d.*, coalesce(n, 0) AS loan_rows FROM dim_date d LEFT JOIN (SELECT reporting_period_end_date AS day, count(*) AS n FROM loans GROUP BY 1) ON day = date_id")
def _(s, d):
    w = warehouse(s, d)
    n = w.loans.groupBy(F.col("reporting_period_end_date").alias("date_id")).agg(F.count("*").alias("loan_rows"))
    return w["dim_date"].join(n, "date_id", "left").withColumn("loan_rows", F.coalesce("loan_rows", F.lit(0)))


@add("m_dim_geo_state", "SELECT g.*, coalesce(n, 0) AS property_rows FROM dim_geo_state g LEFT JOIN (SELECT property_state, count(*) AS n FROM properties GROUP BY 1) ON property_state = state_code")
def _(s, d):
    w = warehouse(s, d)
    n = w.properties.groupBy(F.col("property_state").alias("state_code")).agg(F.count("*").alias("property_rows"))
    dim = w["dim_geo_state"]
    return dim.join(n, "state_code", "left").select(*dim.columns, F.coalesce("property_rows", F.lit(0)).alias("property_rows"))


# --- metrics ----------------------------------------------------------------------------------------------------------

for _name in METRICS:
    _by = ("reporting_date",)
    add(f"metric_{_name}", metric_sql([_name], _by))(lambda s, d, n=_name, by=_by: metric(warehouse(s, d), [n], by))

_TOTALS = [n for n in METRICS if model_of(n) == "fct_loan_monthly_performance"]
add("metric_loan_totals", metric_sql(_TOTALS, ()))(lambda s, d: metric(warehouse(s, d), _TOTALS, ()))
add("metric_delinquency_by_trust", metric_sql(_TOTALS, ("trust_id", "reporting_date")))(lambda s, d: metric(warehouse(s, d), _TOTALS, ("trust_id", "reporting_date")))

# --- operators --------------------------------------------------------------------------------------------------------

_L = "report_period_end_scheduled_loan_bal_amt"


@add("q_date_spine", """SELECT day, count(o_orderkey) AS orders FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM
 (SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders)) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY day""")
def _(s, d):
    """Every day from the first order to the last, also those without one."""
    orders = s.read.parquet(f"{d}/orders.parquet").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    days = orders.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.join(orders, "day", "left").select("day", F.coalesce("orders", F.lit(0)).alias("orders"))


@add("q_surrogate_key", f"SELECT asset_num, source_file, {key('asset_num', 'reporting_period_end_date', 'maturity_date')} AS id FROM loans")
def _(s, d):
    return testbook.loans(s, d).select("asset_num", "source_file", surrogate_key("asset_num", "reporting_period_end_date", "maturity_date").alias("id"))


@add("q_distinct_on_loans", """SELECT asset_num, reporting_period_end_date, source_file FROM loans
 QUALIFY row_number() OVER (PARTITION BY asset_num, reporting_period_end_date ORDER BY source_file DESC) = 1""")  # fmt: skip
def _(s, d):
    rows = testbook.loans(s, d).select("asset_num", "reporting_period_end_date", "source_file")
    return first_per_key(rows, ["asset_num", "reporting_period_end_date"], [F.desc("source_file")])


@add("q_drop_duplicates", "SELECT DISTINCT asset_num, reporting_period_end_date FROM loans")
def _(s, d):
    return testbook.loans(s, d).select("asset_num", "reporting_period_end_date").dropDuplicates()


@add("q_duplicate_report", """SELECT asset_num, reporting_period_end_date, count(*) AS count, list_aggregate(list_sort(list(DISTINCT source_file)), 'string_agg', ',') AS source_files,
 count(DISTINCT source_file) > 1 AS is_cross_file FROM loans GROUP BY 1, 2 HAVING count(*) > 1""")  # fmt: skip
def _(s, d):
    found = profile.duplicates(testbook.loans(s, d), ("asset_num", "reporting_period_end_date"))
    return found.withColumn("source_files", F.array_join("source_files", ","))


@add("q_anti_join_new_rows", """SELECT asset_num, reporting_period_end_date, source_file FROM loans WHERE (asset_num, reporting_period_end_date) NOT IN
 (SELECT (asset_num, reporting_period_end_date) FROM loans WHERE reporting_period_end_date < DATE '1998-01-01' OR payment_frequency_code = 1)""")  # fmt: skip
def _(s, d):
    rows = testbook.loans(s, d).select("asset_num", "reporting_period_end_date", "source_file", "payment_frequency_code")
    stored = rows.where("reporting_period_end_date < date'1998-01-01' or payment_frequency_code = 1")
    # stored files spell dates in two ways
    spelled = stored.select("asset_num", F.when(F.col("payment_frequency_code") == 1, F.date_format("reporting_period_end_date", "MM-dd-yyyy")).otherwise(F.date_format("reporting_period_end_date", "yyyy-MM-dd")).alias("t"))
    stored = spelled.select("asset_num", parsed_date(F.col("t")).alias("reporting_period_end_date"))
    return new_rows(rows, stored, ["asset_num", "reporting_period_end_date"]).drop("payment_frequency_code")


@add("q_lookup_impute_date", """SELECT source_file, asset_num, coalesce(CASE WHEN payment_frequency_code <> 2 THEN reporting_period_end_date END, latest) AS reporting_date,
 payment_frequency_code = 2 AS is_reporting_date_imputed FROM loans LEFT JOIN
 (SELECT trust, max(reporting_period_end_date) AS latest FROM loans WHERE payment_frequency_code <> 2 GROUP BY 1) USING (trust)""")  # fmt: skip
def _(s, d):
    rows = testbook.loans(s, d).withColumn("seen", F.when(F.col("payment_frequency_code") != 2, F.col("reporting_period_end_date")))
    latest = rows.groupBy("trust").agg(F.max("seen").alias("latest"))
    return rows.join(latest, "trust", "left").select("source_file", "asset_num", F.coalesce("seen", "latest").alias("reporting_date"), F.col("seen").isNull().alias("is_reporting_date_imputed"))


@add("q_fill_forward_back", f"SELECT source_file, asset_num, reporting_period_end_date, {fill('maturity_date', 'asset_num')} AS maturity_date FROM loans")
def _(s, d):
    whole = Window.partitionBy("asset_num")
    value = filled("maturity_date", whole.orderBy("reporting_period_end_date"), whole, ("reporting_period_end_date", "source_file"))
    return testbook.loans(s, d).select("source_file", "asset_num", "reporting_period_end_date", value.alias("maturity_date"))


@add("q_lag_change", f"""SELECT source_file, CAST({_L} - lag({_L}) OVER w AS DOUBLE) AS change, lag(reporting_period_end_date) OVER w AS previous_date FROM loans
 WINDOW w AS (PARTITION BY asset_num ORDER BY reporting_period_end_date, source_file)""")  # fmt: skip
def _(s, d):
    w = Window.partitionBy("asset_num").orderBy("reporting_period_end_date", "source_file")
    return testbook.loans(s, d).select("source_file", (F.col(_L) - F.lag(_L).over(w)).alias("change"), F.lag("reporting_period_end_date").over(w).alias("previous_date"))


@add("q_scd2_interval_join", """SELECT p.asset_num || '_' || p.property_num AS property_id, reporting_date, effective_date, end_date, v.property_type_code FROM int_properties_cleaned p
 JOIN dim_property v ON v.property_id = p.asset_num || '_' || p.property_num AND reporting_date >= effective_date AND reporting_date < end_date""")  # fmt: skip
def _(s, d):
    w = warehouse(s, d)
    facts = w["int_properties_cleaned"].select(F.concat_ws("_", "asset_num", "property_num").alias("property_id"), "reporting_date")
    return as_of_versions(facts, w["dim_property"].select("property_id", "effective_date", "end_date", "property_type_code"), "property_id", "reporting_date")


@add("q_scd2_interval_join_left", """SELECT loan_id, l.reporting_date, effective_date FROM one_loan l
 LEFT JOIN dim_property v ON split_part(v.property_id, '_', 1) = loan_id AND l.reporting_date >= effective_date AND l.reporting_date < end_date""")  # fmt: skip
def _(s, d):
    w = warehouse(s, d)
    loans = first_per_key(testbook.loans(s, d).select(F.col("asset_num").alias("loan_id"), F.col("reporting_period_end_date").alias("reporting_date"), "source_file"), ["loan_id", "reporting_date"], [F.desc("source_file")])
    versions = w["dim_property"].select(F.split_part("property_id", F.lit("_"), F.lit(1)).alias("loan_id"), "effective_date", "end_date")
    return as_of_versions(loans, versions, "loan_id", "reporting_date", "left").select("loan_id", "reporting_date", "effective_date")


@add("q_split_note_loans", "SELECT b.source_file AS base_file, s.source_file AS split_file FROM loans b JOIN loans s ON s.asset_num = b.asset_num || 'A' AND s.reporting_period_end_date = b.reporting_period_end_date")
def _(s, d):
    rows = testbook.loans(s, d).select("asset_num", "reporting_period_end_date", "source_file")
    base = rows.select(F.concat("asset_num", F.lit("A")).alias("asset_num"), "reporting_period_end_date", F.col("source_file").alias("base_file"))
    return rows.join(base, ["asset_num", "reporting_period_end_date"]).select("base_file", F.col("source_file").alias("split_file"))


@add("q_split_note_properties", """SELECT p.asset_num, p.property_num, p.reporting_period_end_date, b.last_row.city AS property_city FROM properties p LEFT JOIN
 (SELECT asset_num || 'A' AS note, property_num, reporting_period_end_date, max({'file': source_file, 'city': property_city}) AS last_row FROM properties GROUP BY 1, 2, 3) b
 ON b.note = p.asset_num AND b.property_num = p.property_num AND b.reporting_period_end_date = p.reporting_period_end_date""")
def _(s, d):
    """Each row with the city of its base row, the last by file: one row each, however many rows a key has."""
    keys = ["asset_num", "property_num", "reporting_period_end_date"]
    rows = testbook.properties(s, d).select(*keys, "source_file", "property_city")
    base = rows.groupBy(F.concat("asset_num", F.lit("A")).alias("asset_num"), *keys[1:]).agg(F.max(F.struct("source_file", "property_city")).alias("last_row"))
    return rows.select(*keys).join(base, keys, "left").select(*keys, F.col("last_row.property_city").alias("property_city"))


@add("q_geo_rollup", "SELECT region_name, division_name, state_code, count(*) AS places, count(DISTINCT city_name) AS cities FROM geo GROUP BY 1, 2, 3")
def _(s, d):
    return warehouse(s, d)["geo"].groupBy("region_name", "division_name", "state_code").agg(F.count("*").alias("places"), F.count_distinct("city_name").alias("cities"))


@add("q_age_parts", f"""SELECT source_file, {months("reporting_period_end_date", "origination_date")} AS whole_months, {month("reporting_period_end_date", "origination_date")} AS month_part FROM loans""")
def _(s, d):
    a, b = F.col("reporting_period_end_date"), F.col("origination_date")
    return testbook.loans(s, d).select("source_file", months_between_parts(a, b).alias("whole_months"), month_part(a, b).alias("month_part"))


@add("q_string_functions", r"""SELECT p_partkey, lower(trim(p_name)) AS low, length(p_name) AS n, split_part(p_type, ' ', 1) AS first_word, p_brand || '/' || p_type AS joined,
 nullif(regexp_extract(p_brand, '([0-9]+)', 1), '') AS digits, regexp_replace(p_name, '[aeiou]', '', 'g') AS bare, lpad(CAST(p_size AS VARCHAR), 3, '0') AS padded,
 starts_with(p_name, 'a') AS starts, md5(p_name) AS hash FROM part""")  # fmt: skip
def _(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    return p.select(
        "p_partkey", F.lower(F.trim("p_name")).alias("low"), F.length("p_name").alias("n"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("first_word"), F.concat_ws("/", "p_brand", "p_type").alias("joined"),
        F.nullif(F.regexp_extract("p_brand", "([0-9]+)", 1), F.lit("")).alias("digits"), F.regexp_replace("p_name", "[aeiou]", "").alias("bare"), F.lpad(F.col("p_size").cast("string"), 3, "0").alias("padded"),
        F.col("p_name").startswith("a").alias("starts"), F.md5("p_name").alias("hash"),
    )


@add("q_date_functions", """SELECT o_orderkey, CAST(year(x) AS BIGINT) AS y, CAST(quarter(x) AS BIGINT) AS q, CAST(month(x) AS BIGINT) AS m, CAST(day(x) AS BIGINT) AS dom, CAST(dayofweek(x) AS BIGINT) AS dow,
 CAST(date_trunc('month', x) AS DATE) AS month_start, CAST(date_trunc('quarter', x) AS DATE) AS quarter_start, last_day(x) AS month_end, CAST(x + INTERVAL 3 MONTH AS DATE) AS later,
 CAST(x - DATE '1995-01-01' AS BIGINT) AS days, strftime(x, '%m-%d-%Y') AS us, make_date(CAST(year(x) AS INTEGER), 1, 1) AS new_year, rpad(strftime(x, '%B'), 9, ' ') AS month_name
 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS x FROM orders)""")  # fmt: skip
def _(s, d):
    x = F.col("x")
    return s.read.parquet(f"{d}/orders.parquet").withColumn("x", F.to_date("o_orderdate")).select(
        "o_orderkey", F.year(x).alias("y"), F.quarter(x).alias("q"), F.month(x).alias("m"), F.dayofmonth(x).alias("dom"), (F.dayofweek(x) - 1).alias("dow"), F.trunc(x, "month").alias("month_start"),
        F.trunc(x, "quarter").alias("quarter_start"), F.last_day(x).alias("month_end"), F.add_months(x, 3).alias("later"), F.datediff(x, F.lit("1995-01-01").cast("date")).alias("days"),
        F.date_format(x, "MM-dd-yyyy").alias("us"), F.make_date(F.year(x), F.lit(1), F.lit(1)).alias("new_year"), F.rpad(F.date_format(x, "MMMM"), 9, " ").alias("month_name"),
    )


@add("q_null_functions", f"""SELECT source_file, coalesce(maturity_date, origination_date) AS either, nullif(payment_frequency_code, 2) AS code, CAST({_L} AS DOUBLE) / nullif(CAST(original_loan_amt AS DOUBLE), 0.0) AS part,
 maturity_date IS NOT NULL AS known, coalesce(payment_status_loan_code, '0') AS status FROM loans""")  # fmt: skip
def _(s, d):
    return testbook.loans(s, d).select(
        "source_file", F.coalesce("maturity_date", "origination_date").alias("either"), F.nullif(F.col("payment_frequency_code"), F.lit(2)).alias("code"), ratio(_L, "original_loan_amt").alias("part"),
        F.col("maturity_date").isNotNull().alias("known"), F.coalesce("payment_status_loan_code", F.lit("0")).alias("status"),
    )


@add("q_math_functions", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, abs(l_discount - 0.05) AS off, CAST(ceil(l_quantity / 7) AS BIGINT) AS boxes, l_quantity * l_tax AS product, l_partkey // 7 AS sevenths, l_partkey % 7 AS rest, l_extendedprice FROM lineitem")
def _(s, d):
    rows = s.read.parquet(f"{d}/lineitem.parquet")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.abs(F.col("l_discount") - 0.05).alias("off"), F.ceil(F.col("l_quantity") / 7).cast("long").alias("boxes"), (F.col("l_quantity") * F.col("l_tax")).alias("product"),
        F.expr("l_partkey div 7").alias("sevenths"), (F.col("l_partkey") % 7).alias("rest"), "l_extendedprice",
    )


_SUFFIX = "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '-' || (o_orderkey % 100) ELSE '.' || (o_orderkey % 10) END"


@add("q_asset_key_split", f"""SELECT o_orderkey, regexp_replace(k, '[-.][0-9]{{1,3}}$', '') AS asset_number, lpad(regexp_extract(k, '[-.]([0-9]{{1,3}})$', 1), 3, '0') AS property_number
 FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || {_SUFFIX} AS k FROM orders)""")  # fmt: skip
def _(s, d):
    from ..sources.filings import split_asset_number

    rows = s.read.parquet(f"{d}/orders.parquet")
    suffix = ladder([(F.expr("o_orderkey % 3 = 0"), F.lit("")), (F.expr("o_orderkey % 3 = 1"), F.expr("concat('-', o_orderkey % 100)"))], F.expr("concat('.', o_orderkey % 10)"))
    rows = rows.withColumn("k", F.concat(F.col("o_custkey").cast("string"), suffix))
    base, part = split_asset_number(F.col("k"))
    return rows.select("o_orderkey", base.alias("asset_number"), part.alias("property_number"))


@add("q_bucket_loan_size", f"SELECT source_file, CASE WHEN {_L} < 100000 THEN 'small' WHEN {_L} < 250000 THEN 'medium' ELSE 'large' END AS size FROM loans")
def _(s, d):
    return testbook.loans(s, d).select("source_file", below(F.col(_L), [(100000, "small"), (250000, "medium")], "large").alias("size"))


@add("q_filters_3vl", "SELECT source_file FROM loans WHERE NOT (maturity_date < reporting_period_end_date) AND payment_status_loan_code NOT IN ('A', 'B') AND payment_frequency_code BETWEEN 2 AND 3")
def _(s, d):
    rows = testbook.loans(s, d)
    keep = ~(F.col("maturity_date") < F.col("reporting_period_end_date")) & ~F.col("payment_status_loan_code").isin("A", "B") & F.col("payment_frequency_code").between(2, 3)
    return rows.where(keep).select("source_file")


@add("q_star_select", "SELECT n.* REPLACE (CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(n_regionkey AS BIGINT) AS n_regionkey), r_name AS region, false AS is_new FROM nation n JOIN region ON n_regionkey = r_regionkey")
def _(s, d):
    n, r = s.read.parquet(f"{d}/nation.parquet"), s.read.parquet(f"{d}/region.parquet")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(n["*"], F.col("r_name").alias("region"), F.lit(False).alias("is_new"))


@add("q_union_all_by_name", "SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def _(s, d):
    c = s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    p = s.read.parquet(f"{d}/supplier.parquet").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return c.unionByName(p)


@add("q_union_missing_columns", "SELECT c_custkey AS id, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS brand FROM customer UNION ALL SELECT p_partkey, NULL, p_brand FROM part")
def _(s, d):
    c = s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return c.unionByName(s.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand")), allowMissingColumns=True)


@add("q_incremental_filter", "SELECT source_file FROM loans WHERE reporting_period_end_date > (SELECT max(reporting_period_end_date) FROM loans WHERE reporting_period_end_date < DATE '1999-06-01')")
def _(s, d):
    rows = testbook.loans(s, d)
    return since_latest(rows, rows.where("reporting_period_end_date < date'1999-06-01'"), "reporting_period_end_date").select("source_file")


@add("q_keyed_merge", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'changed' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0""")
def _(s, d):
    rows = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus")
    changes = rows.where("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("changed"))
    return merged(rows.where("o_orderkey % 3 <> 0"), changes, ["o_orderkey"])


@add("q_percent_rank_top5", f"""SELECT source_file, percent_rank() OVER (PARTITION BY trust ORDER BY {_L} NULLS LAST, source_file) AS pct, rank() OVER w AS place, rank() OVER w <= 5 AS is_top_5
 FROM loans WINDOW w AS (PARTITION BY trust ORDER BY {_L} DESC NULLS FIRST)""")  # fmt: skip
def _(s, d):
    trust = Window.partitionBy("trust")
    place = F.rank().over(trust.orderBy(F.col(_L).desc_nulls_first()))
    return testbook.loans(s, d).select("source_file", F.percent_rank().over(trust.orderBy(F.col(_L).asc_nulls_last(), "source_file")).alias("pct"), place.alias("place"), (place <= 5).alias("is_top_5"))


@add("q_rolling_12", f"""SELECT source_file, CAST(sum({_L}) OVER w AS DOUBLE) AS total, CAST(sum({_L}) OVER w AS DOUBLE) / nullif(count({_L}) OVER w, 0) AS mean, count(*) OVER w AS n
 FROM loans WINDOW w AS (PARTITION BY asset_num ORDER BY reporting_period_end_date, source_file ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")  # fmt: skip
def _(s, d):
    w = Window.partitionBy("asset_num").orderBy("reporting_period_end_date", "source_file").rowsBetween(-11, 0)
    total = F.sum(_L).over(w)
    return testbook.loans(s, d).select("source_file", total.alias("total"), (total.cast("double") / F.nullif(F.count(_L).over(w), F.lit(0))).alias("mean"), F.count("*").over(w).alias("n"))


@add("q_partition_extremes", f"SELECT source_file, CAST(max({_L}) OVER w AS DOUBLE) AS most, CAST(min({_L}) OVER w AS DOUBLE) AS least FROM loans WINDOW w AS (PARTITION BY trust, date_trunc('month', reporting_period_end_date))")
def _(s, d):
    w = Window.partitionBy("trust", F.trunc("reporting_period_end_date", "month"))
    return testbook.loans(s, d).select("source_file", F.max(_L).over(w).alias("most"), F.min(_L).over(w).alias("least"))


@add("q_global_max", "SELECT source_file, reporting_period_end_date = (SELECT max(reporting_period_end_date) FROM loans) AS is_latest FROM loans")
def _(s, d):
    rows = testbook.loans(s, d)
    return rows.join(F.broadcast(rows.agg(F.max("reporting_period_end_date").alias("top")))).select("source_file", (F.col("reporting_period_end_date") == F.col("top")).alias("is_latest"))


@add("q_mode", "SELECT o_custkey, mode() WITHIN GROUP (ORDER BY o_orderpriority) AS priority FROM orders GROUP BY 1")
def _(s, d):
    return s.read.parquet(f"{d}/orders.parquet").groupBy("o_custkey").agg(F.mode("o_orderpriority", True).alias("priority"))


@add("q_grouping_union", """SELECT 'status' AS kind, o_orderstatus AS category, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 2
 UNION ALL SELECT 'priority', o_orderpriority, count(*), count(DISTINCT o_custkey) FROM orders GROUP BY 2""")  # fmt: skip
def _(s, d):
    pairs = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("category")) for k, c in (("status", "o_orderstatus"), ("priority", "o_orderpriority"))))
    rows = s.read.parquet(f"{d}/orders.parquet").select("o_custkey", F.explode(pairs).alias("p")).select("o_custkey", "p.*")
    return rows.groupBy("kind", "category").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))


@add("q_conditional_aggregates", f"""SELECT trust, count(*) AS n, count(DISTINCT asset_num) AS assets, count(*) FILTER (WHERE payment_status_loan_code = '1') AS late, CAST(sum(CASE WHEN modified_indicator THEN {_L} ELSE 0 END) AS DOUBLE) AS modified,
 CAST(sum({_L}) AS DOUBLE) / nullif(count({_L}), 0) AS mean, min(reporting_period_end_date) AS first_date, max(reporting_period_end_date) AS last_date FROM loans GROUP BY 1""")  # fmt: skip
def _(s, d):
    return testbook.loans(s, d).groupBy("trust").agg(
        F.count("*").alias("n"), F.count_distinct("asset_num").alias("assets"), F.count_if(F.col("payment_status_loan_code") == "1").alias("late"), F.sum(F.when(F.col("modified_indicator"), F.col(_L)).otherwise(0)).alias("modified"),
        mean(_L).alias("mean"), F.min("reporting_period_end_date").alias("first_date"), F.max("reporting_period_end_date").alias("last_date"),
    )


@add("q_sort_limit_first", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(s, d):
    return s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@add("q_null_counts", "SELECT 'maturity_date' AS column_name, count(*) FILTER (WHERE maturity_date IS NULL) AS null_count FROM loans UNION ALL SELECT 'original_loan_amt', count(*) FILTER (WHERE original_loan_amt IS NULL) FROM loans")
def _(s, d):
    return validate.required_nulls(testbook.loans(s, d), ("maturity_date", "original_loan_amt"))


@add("q_theta_join", "SELECT a.source_file AS earlier, b.source_file AS later FROM loans a JOIN loans b ON a.asset_num = b.asset_num AND b.reporting_period_end_date > a.reporting_period_end_date WHERE a.report_period_modification_indicator")
def _(s, d):
    rows = testbook.loans(s, d)
    a = rows.where("report_period_modification_indicator").select("asset_num", F.col("reporting_period_end_date").alias("a_date"), F.col("source_file").alias("earlier"))
    b = rows.select("asset_num", F.col("reporting_period_end_date").alias("b_date"), F.col("source_file").alias("later"))
    return a.join(b, "asset_num").where("b_date > a_date").select("earlier", "later")


@add("q_crawl_manifest", """SELECT 'TRUST ' || (o_custkey % 20) AS trust, 'EX-102' AS exhibit, CAST(o_orderdate AS DATE) AS filing_date, 'u' || o_orderkey AS url FROM orders f
 WHERE o_orderkey % 2 = 0 AND CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AND o_orderkey % 5 = 1
 AND (CAST(o_orderdate AS DATE), o_custkey % 20) NOT IN (SELECT (CAST(o_orderdate AS DATE), o_custkey % 20) FROM orders WHERE o_orderkey % 9 = 0)""")  # fmt: skip
def _(s, d):
    from ..sources import crawl

    rows = s.read.parquet(f"{d}/orders.parquet")
    filings = rows.select(F.col("o_orderkey").alias("filing_id"), F.to_date("o_orderdate").alias("filing_date"), F.concat(F.lit("TRUST "), (F.col("o_custkey") % 20).cast("string")).alias("trust"), F.when(F.col("o_orderkey") % 2 == 0, "ABS-EE").otherwise("8-K").alias("form"))
    exhibits = rows.select(F.col("o_orderkey").alias("filing_id"), F.when(F.col("o_orderkey") % 5 == 1, "EX-102").otherwise("EX-99").alias("exhibit"), F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url"))
    seen = filings.where("filing_id % 9 = 0").select("filing_date", "trust")
    return crawl.manifest(filings, exhibits, seen, "1998-01-01", name_prefix="TRUST")


@add("q_versioned_upsert", """SELECT 1 AS version, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0
 UNION ALL SELECT 2, o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'changed' ELSE o_orderstatus END FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0
 UNION ALL SELECT 3, o_orderkey, CASE WHEN o_orderkey % 16 = 0 THEN 'again' WHEN o_orderkey % 4 = 0 THEN 'changed' ELSE o_orderstatus END FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0""")
def _(s, d):
    rows = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus")
    table = VersionedTable(s, scratch.folder(s, "versions"))
    first = table.create(rows.where("o_orderkey % 3 <> 0"), ["o_orderkey"])  # its reader stays on it
    second = table.upsert(rows.where("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("changed")))
    third = table.upsert(rows.where("o_orderkey % 16 = 0").withColumn("o_orderstatus", F.lit("again")))
    each = [x.select(F.lit(n).alias("version"), "*") for n, x in enumerate((first, second, third), 1)]
    return each[0].unionByName(each[1]).unionByName(each[2])


@add("q_ranks_by_ranges", f"""SELECT source_file, rank() OVER (PARTITION BY payment_frequency_code ORDER BY {_L} DESC NULLS FIRST) AS place,
 percent_rank() OVER (PARTITION BY payment_frequency_code ORDER BY {_L} DESC NULLS FIRST) AS pct FROM loans""")  # fmt: skip
def _(s, d):
    rows = testbook.loans(s, d).select("source_file", "payment_frequency_code", _L)
    return groups.with_rank(rows, ["payment_frequency_code"], _L, "place", "pct", descending=True, nulls_first=True).select("source_file", "place", "pct")


@add("q_group_means", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, round(avg(l_extendedprice) OVER (PARTITION BY l_returnflag, l_linestatus), 4) AS usual_price,
 round(avg(l_quantity) OVER (PARTITION BY l_returnflag, l_linestatus), 6) AS usual_quantity FROM lineitem""")  # fmt: skip
def _(s, d):
    rows = s.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus")
    by = ["l_returnflag", "l_linestatus"]
    found = groups.with_group_means(rows, by, {"usual_price": F.col("l_extendedprice"), "usual_quantity": F.col("l_quantity")}, groups.number_of_groups(rows, by))
    return found.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("usual_price", 4).alias("usual_price"), F.round("usual_quantity", 6).alias("usual_quantity"))


@add("q_exact_medians", " UNION ALL ".join(f"SELECT '{c}' AS column_name, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, count(DISTINCT {c}) AS different FROM lineitem" for c in ("l_partkey", "l_quantity", "l_extendedprice", "l_discount")))
def _(s, d):
    names = ["l_partkey", "l_quantity", "l_extendedprice", "l_discount"]
    rows = s.read.parquet(f"{d}/lineitem.parquet").select(*names)
    middle, different = selection.medians(rows, {n: F.col(n) for n in names}), selection.distinct_counts(rows, names)
    return s.createDataFrame([(n, middle[n], different[n]) for n in names], "column_name string, median double, different long")


@add("q_align_by_index", """SELECT row_number() OVER (ORDER BY number) - 1 AS number, o_orderkey, o_orderstatus, o_totalprice FROM
 (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS number, * FROM orders) WHERE o_orderstatus = 'F'""")  # fmt: skip
def _(s, d):
    orders = numbered(s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"), [F.col("o_orderdate"), F.col("o_orderkey")])
    texts = orders.select("number", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'F'")
    return aligned(orders.select("number", "o_totalprice"), texts)


def _listing_pages(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers as listings of their orders in HTML, three orders a page; some pages lack a column, one listing is a circle."""
    rows = s.read.parquet(f"{d}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy("day", "o_orderkey")) - 1
    rows = rows.withColumn("page", F.floor(at / 3).cast("long"))
    line = F.concat(F.lit("<tr><td>"), F.lit("<a href='/o'>"), F.col("o_orderkey").cast("string"), F.lit("</a></td><td> "), "o_orderstatus", F.lit(" &amp; more<br>second line</td><td>"), F.col("day").cast("string"), F.lit("</td></tr>"))
    pages = rows.groupBy("o_custkey", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day", "o_orderkey", line.alias("l")))), lambda x: x["l"]), "").alias("body"))
    url = lambda n: F.concat_ws("/", F.lit("http://x"), F.col("o_custkey").cast("string"), n.cast("string"))
    broken = (F.col("o_custkey") % 5 == 0) & (F.col("page") == 2)
    head = F.concat(F.lit("<table class='other'></table><table summary=\"r\" class=\"list tableFile2\"><tr><th>Order</th><th>State</th>"), F.when(broken, "<th>Other</th></tr>").otherwise("<th> Filing Date</th></tr>"))
    onward = F.concat(F.lit("<input type=\"button\" value=\"Next 3\" onclick=\"parent.location='"), url(F.col("page") + 1), F.lit("'\">"))
    html = F.concat(head, "body", F.lit("</table>"), onward)
    starts = pages.where("page = 0").select(F.col("o_custkey").alias("listing"), url(F.col("page")).alias("url"))
    return pages.select(url(F.col("page")).alias("url"), html.alias("html")), starts


@add("q_paged_tables", """SELECT o_custkey AS listing, page, (n % 3) AS row, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filing_date, o_orderstatus || ' & more' AS state FROM
 (SELECT *, n // 3 AS page FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS n FROM orders))
 WHERE page < 10 AND (o_custkey % 5 <> 0 OR page < 2)""")  # fmt: skip
def _(s, d):
    pages, starts = _listing_pages(s, d)
    rows = listings.listed(pages, starts, ["Filing Date", "State", "Order"], rows_a_page=3)
    t = F.col("texts")
    return rows.select("listing", "page", "row", t[2].alias("o_orderkey"), t[0].alias("filing_date"), t[1].alias("state"))


@add("q_raw_store", """SELECT url AS key, count(DISTINCT url) AS n_keys, min(sha256(html)) AS sha256 FROM pages WHERE url IS NOT NULL AND html IS NOT NULL GROUP BY url""")
def _(s, d):
    store, pages = RawStore(s, scratch.folder(s, "raw")), s.read.parquet(f"{d}/pages.parquet")
    files = pages.select(F.col("url").alias("key"), F.col("html").cast("binary").alias("content"))
    store.save(files.where(F.xxhash64("key") % 2 == 0))
    store.save(files)  # skips what the first run has stored
    found = store.read()
    return found.groupBy("key").agg(F.count("*").alias("n_keys"), F.min(F.sha2("content", 256)).alias("sha256"))


@add("q_clustered_ranges", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_partkey BETWEEN 40 AND 60 AND l_extendedprice BETWEEN 1000 AND 30000")
def _(s, d):
    folder = scratch.folder(s, "clustered")
    rows = s.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    clustering.write_clustered(rows, folder, ["l_partkey", "l_extendedprice"], 32)
    return clustering.read_ranges(s, folder, {"l_partkey": (40, 60), "l_extendedprice": (1000.0, 30000.0)})


# --- profiles ---------------------------------------------------------------------------------------------------------


def _profiled(s: SparkSession, d: str) -> DataFrame:
    rows = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("price"), F.to_date("o_orderdate").alias("day"))
    rows = rows.withColumns({"price": F.when(F.col("o_orderkey") % 5 != 0, F.col("price")), "big": F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") % 10 == 0), "rare": F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))})
    return profile.profile(rows)


_ROWS = "(SELECT o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 10 = 0 END AS big, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS rare FROM orders)"
_common = lambda c: f"'{c}' AS column_name, count(*) AS total_count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_count"
_number = lambda c: f"SELECT {_common(c)}, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS stddev, quantile_cont({c}, 0.5) AS median, (SELECT count(*) FROM {_ROWS} WHERE abs(({c} - (SELECT avg({c}) FROM {_ROWS})) / (SELECT stddev({c}) FROM {_ROWS})) > 3) AS extreme_count FROM {_ROWS}"
_text = lambda c: f"SELECT {_common(c)}, CAST(sum(length({c})) AS DOUBLE) / count({c}) AS avg_length, max(length({c})) AS max_length, quantile_cont(length({c}), 0.5) AS median_length, count(*) FILTER (WHERE trim({c}) = '') AS empty_count FROM {_ROWS}"


@add("q_profile_numeric", " UNION ALL ".join(_number(c) for c in ("o_orderkey", "price")))
def _(s, d):
    rows = _profiled(s, d).where("data_type in ('bigint', 'double')")
    return rows.select("column_name", "total_count", "null_count", "distinct_count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), "median", "extreme_count")


@add("q_profile_string", " UNION ALL ".join(_text(c) for c in ("o_orderstatus", "o_orderpriority", "rare")))
def _(s, d):
    return _profiled(s, d).where("data_type = 'string'").select("column_name", "total_count", "null_count", "distinct_count", "avg_length", "max_length", "median_length", "empty_count")


@add("q_profile_bool", f"SELECT {_common('big')}, count(*) FILTER (WHERE big) AS true_count, count(*) FILTER (WHERE NOT big) AS false_count, avg(CAST(big AS INTEGER)) AS true_frequency FROM {_ROWS}")
def _(s, d):
    return _profiled(s, d).where("data_type = 'boolean'").select("column_name", "total_count", "null_count", "distinct_count", "true_count", "false_count", "true_frequency")


@add("q_profile_date", f"SELECT {_common('day')}, CAST(min(day) AS VARCHAR) AS earliest_date, CAST(max(day) AS VARCHAR) AS latest_date FROM {_ROWS}")
def _(s, d):
    return _profiled(s, d).where("data_type = 'date'").select("column_name", "total_count", "null_count", "distinct_count", "earliest_date", "latest_date")


@add("q_suspicious_rules", f"""SELECT 'rare' AS column_name, 'high_null_ratio' AS rule, count(*) FILTER (WHERE rare IS NULL) / count(*) AS value FROM {_ROWS} HAVING count(*) FILTER (WHERE rare IS NULL) / count(*) > 0.5
 UNION ALL SELECT 'big', 'extreme_imbalance', count(*) FILTER (WHERE big) / count(big) FROM {_ROWS} HAVING count(*) FILTER (WHERE big) / count(big) >= 0.75 OR count(*) FILTER (WHERE big) / count(big) <= 0.25""")  # fmt: skip
def _(s, d):
    return profile.suspicious(_profiled(s, d))


# --- validation -------------------------------------------------------------------------------------------------------

FILING = {
    "asset": ColumnSpec("string", nullable=False, size=4),
    "note": ColumnSpec("string", size=50),
    "day": ColumnSpec("date"),
    "amount": ColumnSpec("number", whole=3, decimal=2, imputation=0),
    "small": ColumnSpec("UInt8"),
    "flag": ColumnSpec("bool", imputation=False),
    "rate": ColumnSpec("Float32"),
}


def _faulty(s: SparkSession, d: str) -> DataFrame:
    """Events as text columns, with faults on fixed moduli."""
    e = F.col("event_id")
    pick = lambda *values: ladder([(e % m == r, v if not isinstance(v, str) else F.lit(v)) for m, r, v in values[:-1]], values[-1])
    return s.read.parquet(f"{d}/events.parquet").select(
        "event_id",
        pick((97, 0, F.lit(None).cast("string")), (89, 0, "  "), (83, 0, "12345"), F.concat(F.lit("a"), (e % 90).cast("string"))).alias("asset"),
        pick((71, 0, F.concat(F.lit("x"), F.char(F.lit(7)))), (3, 0, "  trimmed "), F.col("event_type")).alias("note"),
        pick((61, 0, "2024/01/01"), (2, 0, "03-31-2001"), F.lit("2001-04-30")).alias("day"),
        pick((59, 0, "1234.5"), (5, 0, F.lit(None).cast("string")), F.lit("12.25")).alias("amount"),
        pick((53, 0, "256"), (51, 0, "7.5"), (e % 200).cast("string")).alias("small"),
        pick((4, 0, "Y"), (4, 1, "0"), (4, 2, "maybe"), F.lit(None).cast("string")).alias("flag"),
        pick((47, 0, "3.5e38"), (43, 0, "abc"), F.lit("0.5")).alias("rate"),
    )


_RULES_SQL = {
    "string length exceeds 4 in asset": "event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 = 0",
    "empty string values in asset": "event_id % 97 <> 0 AND event_id % 89 = 0",
    "null values in non-nullable field asset": "event_id % 97 = 0",
    "invalid control characters in note": "event_id % 71 = 0",
    "invalid date values in day": "event_id % 61 = 0",
    "numeric value exceeds 3.2 format in amount": "event_id % 59 = 0",
    "outside UInt8 range in small": "event_id % 53 = 0 OR event_id % 51 = 0",
    "invalid floating-point values in rate": "event_id % 47 = 0 OR event_id % 43 = 0",
}


@add("dq_validate_messages", " UNION ALL ".join(f"SELECT '{m}' AS message WHERE EXISTS (SELECT 1 FROM events WHERE {c})" for m, c in _RULES_SQL.items()))
def _(s, d):
    return validate.messages(_faulty(s, d), FILING)


@add("dq_error_explode", " UNION ALL ".join(f"SELECT '{m}' AS message, count(*) AS n FROM events WHERE {c} HAVING count(*) > 0" for m, c in _RULES_SQL.items()))
def _(s, d):
    found = F.array(*(F.when(bad, F.lit(text)) for n, spec in FILING.items() for bad, text in validate.rules(n, spec)))
    return _faulty(s, d).select(F.explode(F.array_compact(found)).alias("message")).groupBy("message").agg(F.count("*").alias("n"))


_CLEAN_SQL = """SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN '' WHEN event_id % 83 = 0 THEN '12345' ELSE 'a' || (event_id % 90) END AS asset,
 CASE WHEN event_id % 71 = 0 THEN 'x' WHEN event_id % 3 = 0 THEN 'trimmed' ELSE event_type END AS note, CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 2 = 0 THEN DATE '2001-03-31' ELSE DATE '2001-04-30' END AS day,
 {amount} AS amount, CASE WHEN event_id % 53 = 0 THEN 256 WHEN event_id % 51 = 0 THEN 7 ELSE event_id % 200 END AS small, {flag} AS flag FROM events"""


@add("dq_cast_clean", _CLEAN_SQL.format(amount="CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 5 = 0 THEN NULL ELSE 12.25::DOUBLE END", flag="CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false END"))
def _(s, d):
    return validate.cast_clean(_faulty(s, d), FILING).withColumn("small", F.coalesce("small", F.lit(7))).drop("rate")


@add("dq_impute", _CLEAN_SQL.format(amount="CASE WHEN event_id % 59 = 0 THEN 0::DOUBLE WHEN event_id % 5 = 0 THEN 0::DOUBLE ELSE 12.25::DOUBLE END", flag="CASE event_id % 4 WHEN 0 THEN true ELSE false END"))
def _(s, d):
    return validate.imputed(validate.cast_clean(_faulty(s, d), FILING), FILING).withColumn("small", F.coalesce("small", F.lit(7))).drop("rate")


_n = lambda df: df.agg(F.count("*").alias("violations"))
_F = "fct_loan_monthly_performance"
_DQ: dict[str, tuple[str, Callable[[Warehouse], DataFrame]]] = {
    "dq_not_null": (f"FROM {_F} WHERE maturity_date IS NULL", lambda w: checks.not_null(w[_F], "maturity_date")),
    "dq_unique": (f"FROM (SELECT 1 FROM {_F} WHERE loan_id IS NOT NULL GROUP BY loan_id HAVING count(*) > 1)", lambda w: checks.unique(w[_F], "loan_id")),
    "dq_accepted_values": (f"FROM {_F} WHERE delinquency_status NOT IN ('0', '1', '2', '3')", lambda w: checks.accepted_values(w[_F], "delinquency_status", ["0", "1", "2", "3"])),
    "dq_relationships": (
        "FROM dim_property WHERE geo_id IS NOT NULL AND geo_id NOT IN (SELECT address_id FROM dim_geo_address)",
        lambda w: checks.relationships(w["dim_property"], "geo_id", w["dim_geo_address"], "address_id"),
    ),
    "dq_accepted_range": (f"FROM {_F} WHERE remaining_bal_pct < 0 OR remaining_bal_pct > 1", lambda w: checks.accepted_range(w[_F], "remaining_bal_pct", 0, 1)),
    "dq_between_dates": (
        f"FROM {_F} WHERE NOT origination_date BETWEEN DATE '1998-06-01' AND DATE '2001-01-01'",
        lambda w: checks.between(w[_F], "origination_date", F.lit("1998-06-01").cast("date"), F.lit("2001-01-01").cast("date")),
    ),
    "dq_unique_combination": (
        "FROM (SELECT 1 FROM loans GROUP BY asset_num, reporting_period_end_date HAVING count(*) > 1)",
        lambda w: checks.unique_combination(w.loans, ["asset_num", "reporting_period_end_date"]),
    ),
    "dq_exclusive_ranges": (
        "FROM (SELECT end_date, lead(effective_date) OVER (PARTITION BY property_id ORDER BY effective_date, end_date) AS next FROM dim_property) WHERE next < end_date",
        lambda w: checks.exclusive_ranges(w["dim_property"], "effective_date", "end_date", "property_id"),
    ),
}
for _name, (_sql, _f) in _DQ.items():
    add(_name, f"SELECT count(*) AS violations {_sql}")(lambda s, d, f=_f: _n(f(warehouse(s, d))))
