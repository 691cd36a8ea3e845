"""Loan and property snapshots derived from the generic test tables, with nulls, split notes and duplicates on fixed
moduli. All arithmetic is on integers, dates and decimals, so other engines get the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines of orders whose property rows one task gets, so that its memory does not grow with the tables.
LINES = 100_000
#: So many parts' lines, at most, one task joins with their orders: it sorts both, and holds what it deals behind.
JOINED = 12

#: Codes that the snapshots draw from.
TYPES = ("RT", "OF", "MF", "IN", "HC", "LO", "MU", "SS", "WH", "MH", "XX")
STATES = (
    "AL", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS",
    "MO", "NV", "NJ", "NY",
)


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    """n_nationkey, trust, company of each nation: few rows, sent to wherever customers are."""
    rows = _read(spark, folder, "nation").join(_read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return F.broadcast(rows.select("n_nationkey", F.concat(F.lit("TRUST "), "n_name").alias("trust"), F.col("r_name").alias("company")))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """c, trust, company, nation of each customer."""
    joined = _read(spark, folder, "customer").join(_nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.col("c_custkey").alias("c"), "trust", "company", F.col("c_nationkey").cast("long").alias("nation"))


def parts(spark: SparkSession, folder: str) -> int:
    """Into how many parts the snapshots are dealt: the number of lines is in the file's footers."""
    return max(spark.sparkContext.defaultParallelism, -(-_read(spark, folder, "lineitem").count() // LINES))


def _joined(rows: DataFrame, more: DataFrame, key: str, own: str, parts: int | None) -> DataFrame:
    """Rows with those of ``more`` where ``key`` and ``own`` are equal. parts: how many the tables' lines make (``parts``).

    Spark makes parts of a join by what they have on disk, which is several times as much in memory. So both sides of larger
    tables are dealt by the key in parts that grow with the lines, and are as many as Spark's shuffles have at least.
    """
    n = -(-(parts or 0) // JOINED)
    if n > rows.sparkSession.sparkContext.defaultParallelism:
        rows, more = rows.repartition(n, key), more.repartition(n, own)
    return rows.join(more, F.col(key) == F.col(own))


def loans(spark: SparkSession, folder: str, parts: int | None = None, dealt: bool = True) -> DataFrame:
    """One row per order: a monthly loan snapshot.

    parts: rows are dealt by asset number into so many (``_base``, as ``home`` gives it) while they are keys, a date and a
    price. A task holds what it deals in memory, so texts and all that follows from keys are made behind. Not dealt: parts
    only tell how large the tables are.
    """
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    orders = _read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    rows = _joined(orders, _read(spark, folder, "customer").select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey", parts)
    parts = parts if dealt else None
    rows = rows.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "c_nationkey")
    if parts:
        rows = rows.repartition(parts, c.cast("string"))
    rows = rows.join(_nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.element_at(F.array(*(F.lit(x) for x in ("A", "B", None, "1", "2", "3", "6", "0", "0", "0"))), (k % 10 + 1).cast("int"))
    return rows.select(
        F.concat(c.cast("string"), F.when(k % 11 == 0, "A").otherwise("")).alias("asset_num"),
        F.last_day(F.to_date("o_orderdate")).alias("reporting_period_end_date"),
        "trust",
        "company",
        F.concat(F.lit("f"), F.lpad(k.cast("string"), 12, "0"), F.lit(".xml")).alias("source_file"),
        _unless(k % 13 == 0, _money(c % 997 * 1000 + 100000)).alias("original_loan_amt"),
        _unless(k % 17 == 0, _money(F.col("o_totalprice"))).alias("report_period_end_scheduled_loan_bal_amt"),
        _money(_money(F.col("o_totalprice")) + 500).alias("report_period_begin_schedule_loan_bal_amt"),
        ((k % 50 + 20).cast("decimal(9,6)") / 1000).cast("decimal(9,6)").alias("report_period_intr_rate_pct"),
        (k % 4 + 1).alias("payment_frequency_code"),
        F.when(k % 3 == 0, F.date_add(F.lit("2000-01-01").cast("date"), (c % 40 * 100 + k % 2 * 31).cast("int"))).alias("maturity_date"),
        F.date_add(F.lit("1998-01-15").cast("date"), (c % 1200).cast("int")).alias("origination_date"),
        code.alias("payment_status_loan_code"),
        _unless(k % 19 == 0, k % 5 == 0).alias("modified_indicator"),
        (k % 7 == 0).alias("report_period_modification_indicator"),
        _money(k % 500 + 1000).alias("total_scheduled_prin_intr_due_amt"),
        _money(k % 300 + 400).alias("scheduled_prin_amt"),
        _money(k % 200 + 300).alias("scheduled_intr_amt"),
        *([c.cast("string").alias("_base")] if parts else []),
    )


def properties(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer, line parity and month of shipping: a monthly property snapshot, and bare split-note rows.

    Lines are dealt by asset number (``_base``, as ``home`` gives it) while they are narrow. Grouping, customers and whatever
    is done for an asset later need no other shuffle; split-note rows are made beside their base rows, not by a second pass.
    """
    orders = _read(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c"))
    lines = _read(spark, folder, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_linenumber") % 2).alias("half"), F.last_day(F.to_date("l_shipdate")).alias("d"), _money(F.col("l_extendedprice")).alias("price"))
    n = parts(spark, folder)
    rows = _joined(lines, orders, "l_orderkey", "o_orderkey", n).select("c", "half", "d", "l_orderkey", "l_partkey", "price")
    home = F.col("c").cast("string")
    rows = rows.repartition(n, home).withColumn("_base", home)
    rows = rows.groupBy("_base", "c", "half", "d").agg(F.min("l_orderkey").alias("k"), F.min("l_partkey").alias("p"), _money(F.sum("price")).alias("revenue"))
    c, k, y, rev = F.col("c"), F.col("k"), F.year("d").cast("long"), F.col("revenue")
    pick = lambda values, i: F.get(F.array(*(F.lit(v) for v in values)), i.cast("int"))
    spent = _money(rev * F.lit(0.40).cast("decimal(3,2)"))
    name = lambda what, n: _unless(k % n == 0, F.concat(F.lit(f"{what} "), (k % 9).cast("string")))
    fixed = {  # what a customer's rows have in common
        "property_name": F.concat(F.lit("Property "), c.cast("string")),
        "property_address": F.concat(c.cast("string"), F.lit(" Main St")),
        "property_city": F.concat(F.lit("City "), (c % 7).cast("string")),
        "property_zip": F.lpad((c % 90).cast("string"), 5, "0"),
        "property_state": _unless(c % 23 == 0, pick(STATES, F.col("nation"))),
        "units_beds_rooms_num": c % 40,
        "year_built_num": c % 60 + 1950,
        "physical_occupancy_securitization_pct": _unless(c % 8 == 0, ((c % 41 + 60) / 100).cast("decimal(9,4)")),
    }
    own = {
        "property_type_code": pick(TYPES, (c + y) % 12),
        "property_status_code": _unless(c % 6 == 0, ((c + y * 2) % 5).cast("string")),
        "net_rentable_square_feet_num": _unless(c % 9 == 0, (c + y) % 50 * 10 + 1000),
        "most_recent_valuation_amt": _money(rev * 10),
        "valuation_securitization_amt": F.when(k % 31 == 0, None).when(k % 29 == 0, _money(F.lit(0))).otherwise(_money(rev * 9)),
        "most_recent_physical_occupancy_pct": _unless(k % 7 == 0, ((F.col("p") % 51 + 50) / 100).cast("decimal(9,4)")),
        "most_recent_revenue_amt": _unless(k % 4 == 0, rev),
        "operating_expenses_amt": _unless(k % 4 == 0, spent),
        "most_recent_net_operating_income_amt": _unless(k % 4 == 0, _money(rev - spent)),
        "most_recent_debt_service_amt": _unless(k % 10 == 0, ((k % 120 + 80) / 100).cast("decimal(18,2)")),
        "largest_tenant": name("Tenant", 2),
        "second_largest_tenant": name("Tenant", 3),
        "third_largest_tenant": name("Tenant", 5),
    }
    people = customers(spark, folder).select(c.cast("string").alias("_base"), "trust", "company", *(v.alias(n) for n, v in fixed.items()))
    file = F.concat(F.lit("f"), F.lpad(k.cast("string"), 12, "0"), F.lit(".xml")).alias("source_file")
    rows = rows.join(people, "_base").withColumns(own | {"source_file": file, "_notes": F.when(k % 11 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))})
    rows = rows.withColumn("note", F.explode("_notes"))
    full = "property_name property_address property_city property_zip property_state property_type_code property_status_code net_rentable_square_feet_num units_beds_rooms_num year_built_num most_recent_valuation_amt valuation_securitization_amt most_recent_physical_occupancy_pct physical_occupancy_securitization_pct most_recent_revenue_amt operating_expenses_amt most_recent_net_operating_income_amt most_recent_debt_service_amt largest_tenant second_largest_tenant third_largest_tenant".split()
    return rows.select(
        F.concat("_base", F.when(F.col("note"), "A").otherwise("")).alias("asset_num"), F.lpad(F.col("half").cast("string"), 3, "0").alias("property_num"), F.col("d").alias("reporting_period_end_date"), "trust", "company",
        "source_file", *(_unless(F.col("note"), F.col(n)).alias(n) for n in full), "_base",
    )


_TYPE_LIST = ", ".join(f"'{x}'" for x in TYPES)
_STATE_LIST = ", ".join(f"'{x}'" for x in STATES)

#: The same two tables for DuckDB, as common table expressions.
SQL = {
    "customers": """
SELECT c_custkey AS c, 'TRUST ' || n_name AS trust, r_name AS company, c_nationkey AS nation
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "loans": """
SELECT CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderkey % 11 = 0 THEN 'A' ELSE '' END AS asset_num,
       last_day(CAST(o_orderdate AS DATE)) AS reporting_period_end_date, trust, company,
       'f' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.xml' AS source_file,
       CASE WHEN o_orderkey % 13 <> 0 THEN CAST(100000 + 1000 * (o_custkey % 997) AS DECIMAL(18,2)) END AS original_loan_amt,
       CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS report_period_end_scheduled_loan_bal_amt,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 500 AS DECIMAL(18,2)) AS report_period_begin_schedule_loan_bal_amt,
       CAST((20 + o_orderkey % 50) / 1000.0 AS DECIMAL(9,6)) AS report_period_intr_rate_pct,
       1 + o_orderkey % 4 AS payment_frequency_code,
       CASE WHEN o_orderkey % 3 = 0 THEN DATE '2000-01-01' + CAST(100 * (o_custkey % 40) + 31 * (o_orderkey % 2) AS INTEGER) END AS maturity_date,
       DATE '1998-01-15' + CAST(o_custkey % 1200 AS INTEGER) AS origination_date,
       ['A', 'B', NULL, '1', '2', '3', '6', '0', '0', '0'][o_orderkey % 10 + 1] AS payment_status_loan_code,
       CASE WHEN o_orderkey % 19 <> 0 THEN o_orderkey % 5 = 0 END AS modified_indicator,
       o_orderkey % 7 = 0 AS report_period_modification_indicator,
       CAST(1000 + o_orderkey % 500 AS DECIMAL(18,2)) AS total_scheduled_prin_intr_due_amt,
       CAST(400 + o_orderkey % 300 AS DECIMAL(18,2)) AS scheduled_prin_amt,
       CAST(300 + o_orderkey % 200 AS DECIMAL(18,2)) AS scheduled_intr_amt
FROM orders JOIN customers ON o_custkey = c""",
    "property_base": f"""
SELECT CAST(c AS VARCHAR) AS asset_num, lpad(CAST(half AS VARCHAR), 3, '0') AS property_num, d AS reporting_period_end_date,
       trust, company, 'f' || lpad(CAST(k AS VARCHAR), 12, '0') || '.xml' AS source_file, k,
       'Property ' || c AS property_name, c || ' Main St' AS property_address, 'City ' || (c % 7) AS property_city,
       lpad(CAST(c % 90 AS VARCHAR), 5, '0') AS property_zip,
       CASE WHEN c % 23 <> 0 THEN [{_STATE_LIST}][nation + 1] END AS property_state,
       [{_TYPE_LIST}][(c + y) % 12 + 1] AS property_type_code,
       CASE WHEN c % 6 <> 0 THEN CAST((c + 2 * y) % 5 AS VARCHAR) END AS property_status_code,
       CASE WHEN c % 9 <> 0 THEN 1000 + 10 * ((c + y) % 50) END AS net_rentable_square_feet_num,
       c % 40 AS units_beds_rooms_num, 1950 + c % 60 AS year_built_num,
       CAST(revenue * 10 AS DECIMAL(18,2)) AS most_recent_valuation_amt,
       CASE WHEN k % 31 = 0 THEN NULL WHEN k % 29 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(revenue * 9 AS DECIMAL(18,2)) END AS valuation_securitization_amt,
       CASE WHEN k % 7 <> 0 THEN CAST((50 + p % 51) / 100.0 AS DECIMAL(9,4)) END AS most_recent_physical_occupancy_pct,
       CASE WHEN c % 8 <> 0 THEN CAST((60 + c % 41) / 100.0 AS DECIMAL(9,4)) END AS physical_occupancy_securitization_pct,
       CASE WHEN k % 4 <> 0 THEN revenue END AS most_recent_revenue_amt,
       CASE WHEN k % 4 <> 0 THEN CAST(revenue * 0.40 AS DECIMAL(18,2)) END AS operating_expenses_amt,
       CASE WHEN k % 4 <> 0 THEN CAST(revenue - CAST(revenue * 0.40 AS DECIMAL(18,2)) AS DECIMAL(18,2)) END AS most_recent_net_operating_income_amt,
       CASE WHEN k % 10 <> 0 THEN CAST((80 + k % 120) / 100.0 AS DECIMAL(18,2)) END AS most_recent_debt_service_amt,
       CASE WHEN k % 2 <> 0 THEN 'Tenant ' || (k % 9) END AS largest_tenant,
       CASE WHEN k % 3 <> 0 THEN 'Tenant ' || (k % 9) END AS second_largest_tenant,
       CASE WHEN k % 5 <> 0 THEN 'Tenant ' || (k % 9) END AS third_largest_tenant
FROM (SELECT g.*, year(d) AS y, trust, company, nation
      FROM (SELECT o_custkey AS c, l_linenumber % 2 AS half, last_day(CAST(l_shipdate AS DATE)) AS d, min(l_orderkey) AS k,
                   min(l_partkey) AS p, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) g JOIN customers USING (c))""",
    "properties": """
SELECT * EXCLUDE (k) FROM property_base
UNION ALL BY NAME
SELECT asset_num || 'A' AS asset_num, property_num, reporting_period_end_date, trust, company, source_file
FROM property_base WHERE k % 11 = 0""",
}
