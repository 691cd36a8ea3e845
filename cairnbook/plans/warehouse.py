"""The warehouse: dimensions, facts and marts as pure functions of the loan and property snapshots.

``Warehouse(loans, properties)[name]`` builds a model from those it needs. Most are lazy; the two marts of properties, whose
rows are read for averages and again beside them, write these rows to the shared folder when they are built, and bounds on
numbers of groups are counted. ``materialise`` writes models as tables, so that later ones read instead of recomputing.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import FOREVER, below, double, home, ladder, mean, month_part, months_between_parts, ratio, surrogate_key
from ..operators.groups import GROUPS_SENT, number_of_groups, with_group_means, with_rank
from ..operators.rows import as_of_versions, first_per_key, joined_at_home
from ..sources.scratch import kept
from .states import STATES

MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {}
#: Of models that have columns which cost a further pass: those columns, and the same rows without them, lazy.
LEAN: dict[str, tuple[re.Pattern[str], Callable[[Warehouse], DataFrame]]] = {}


class Warehouse:
    """Models by name over one pair of inputs. as_of: the date that stands for today.

    Rows of both are dealt by asset (``home``), in ``parts`` parts or as many as Spark's shuffles have. Inputs with a column
    ``_base`` that holds it are dealt by it already. dealt_loans: the same loans, dealt while they are narrow; what reads
    few columns of loans reads ``loans``, which need not be dealt.
    """

    def __init__(self, loans: DataFrame, properties: DataFrame, as_of: str = "2002-01-01", parts: int | None = None, dealt_loans: DataFrame | None = None):
        self.spark: SparkSession = loans.sparkSession
        self.loans, self.properties, self.as_of, self.parts = loans, properties, as_of, parts
        self.dealt_loans = loans if dealt_loans is None else dealt_loans
        self.written: set[str] = set()
        self._built: dict[str, DataFrame] = {}
        self._days: int | None = None
        self._trusts: DataFrame | None = None
        self.few_trusts = False

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name](self)
        return self._built[name]

    def rows(self, name: str, *texts: str) -> DataFrame:
        """A model's rows with the columns that the SQL texts name, at least: without those that cost a further pass, if no
        text names one and the model is not built yet."""
        if name in LEAN and name not in self._built and not any(LEAN[name][0].search(x) for x in texts):
            return LEAN[name][1](self)
        return self[name]

    def days(self) -> int:
        """A bound on the reporting dates of loans, null being one, from a scan of that column alone."""
        if self._days is None:
            self._days = self.loans.select("reporting_period_end_date").distinct().count() + 1
        return self._days

    def trusts(self) -> DataFrame:
        """trust and trust_id of each row of the trust dimension.

        Up to GROUPS_SENT rows are read once and then sent as they are (``few_trusts``), so the bound costs no second scan;
        with more, the table stays lazy and Spark joins it by its own measure.
        """
        if self._trusts is None:
            rows = self.loans.select("trust", "company").distinct()
            known = rows.select("trust").limit(GROUPS_SENT + 1).collect()
            self.few_trusts = len(known) <= GROUPS_SENT
            if self.few_trusts:
                rows = F.broadcast(self.spark.createDataFrame(known, "trust string"))
            self._trusts = rows.select("trust", surrogate_key("trust").alias("trust_id"))
        return self._trusts

    def materialise(self, name: str, folder: str, partition: bool = False) -> DataFrame:
        """Writes a model as Parquet, by month if asked, and uses the written table from then on."""
        df = self[name]
        writer = df.withColumn("_month", F.trunc("reporting_date", "MM")).write.partitionBy("_month") if partition else df.write
        writer.mode("overwrite").parquet(f"{folder}/{name}")
        self._built[name] = self.spark.read.parquet(f"{folder}/{name}").select(df.columns)
        self.written.add(name)
        return self._built[name]


def model(f: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    MODELS[f.__name__] = f
    return f


# --- cleaned snapshots ------------------------------------------------------------------------------------------------

#: Property columns by their names in the cleaned snapshot; those in FILLED carry forward, then back.
PROPERTY = {
    "property_type_code": "property_type_code",
    "square_feet": "net_rentable_square_feet_num",
    "unit_count": "units_beds_rooms_num",
    "year_built": "year_built_num",
    "property_status_code": "property_status_code",
    "property_state": "property_state",
    "property_city": "property_city",
    "property_zip": "property_zip",
    "property_address": "property_address",
    "current_valuation": "most_recent_valuation_amt",
    "securitization_valuation": "valuation_securitization_amt",
    "current_occupancy_pct": "most_recent_physical_occupancy_pct",
    "securitization_occupancy_pct": "physical_occupancy_securitization_pct",
    "current_revenue": "most_recent_revenue_amt",
    "current_expenses": "operating_expenses_amt",
    "current_noi": "most_recent_net_operating_income_amt",
    "current_dscr": "most_recent_debt_service_amt",
    "largest_tenant": "largest_tenant",
    "second_largest_tenant": "second_largest_tenant",
    "third_largest_tenant": "third_largest_tenant",
}
FILLED = frozenset(PROPERTY) - {"square_feet", "unit_count", "year_built", "property_address", "largest_tenant", "second_largest_tenant", "third_largest_tenant"}
DEFAULTS = {"property_state": "UNK", "property_city": "Unknown", "property_zip": "UNK", "property_address": "Unknown"}


def _latest_filled(df: DataFrame, keys: list[str], trust: str, columns: dict[str, str], fill: set[str]) -> DataFrame:
    """One row per key and date, the last by file, with ``columns`` (new name: old name); those in ``fill`` carry the
    latest value up to the date forward, or the first one back.

    One sort serves all: on the row that stays, the running value has seen every row of its date.
    """
    line = Window.partitionBy(*keys).orderBy("reporting_period_end_date", "source_file", F.desc(trust))
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = [
        (F.coalesce(F.last(old, True).over(line.rowsBetween(Window.unboundedPreceding, 0)), F.first(old, True).over(whole)) if new in fill else F.col(old)).alias(new)
        for new, old in columns.items()
    ]
    after = F.lead("reporting_period_end_date").over(line)
    rows = df.select(*keys, F.col("reporting_period_end_date").alias("reporting_date"), *values, after.alias("_after"))
    return rows.where(F.col("_after").isNull() | (F.col("_after") != F.col("reporting_date"))).drop("_after")


def _notes_together(w: Warehouse, df: DataFrame, asset: str = "asset_num") -> DataFrame:
    """df dealt by the home of its assets (``_base``): one shuffle serves all windows over an asset, a date, or a note and
    its base, as long as they are partitioned by ``_base`` too, and joins of loans and properties."""
    if "_base" in df.columns:
        return df
    dealt = df.withColumn("_base", home(asset))
    return dealt.repartition(w.parts, "_base") if w.parts else dealt.repartition("_base")


def _beside(values: list[str], keys: list[str], step: int) -> dict[str, Column]:
    """The values of the note whose number has one 'A' less (step -1) or more (step 1), on the same date.

    Each for itself, not as one struct: so models that need few of them carry no others through the windows.
    """
    line = Window.partitionBy(*keys, F.rtrim("asset_num", F.lit("A"))).orderBy(F.length("asset_num"))
    find = F.lag if step < 0 else F.lead
    next_to = find(F.length("asset_num")).over(line) == F.length("asset_num") + step
    return {n: F.when(next_to, find(n).over(line)) for n in values}


@model
def property_snapshots(w: Warehouse) -> DataFrame:
    """Property snapshots, filled; a split-note row ('A' after the asset number) takes what it lacks from its base row."""
    line = ["_base", "asset_num", "property_num"]
    columns = {"trust": "trust", "company": "company", "property_name": "property_name"} | PROPERTY
    rows = _latest_filled(_notes_together(w, w.properties), line, "trust", columns, FILLED)
    note = _beside(list(PROPERTY), ["_base", "property_num", "reporting_date"], -1)
    values = {n: F.coalesce(n, v, *([F.lit(DEFAULTS[n])] if n in DEFAULTS else [])) for n, v in note.items()}
    out = rows.select(*line, "reporting_date", "trust", "company", "property_name", *(v.alias(n) for n, v in values.items()))
    return out.withColumn("geo_id", surrogate_key("property_state", "property_city", "property_zip", "property_address"))


@model
def int_properties_cleaned(w: Warehouse) -> DataFrame:
    return w["property_snapshots"].drop("_base")


# --- dimensions -------------------------------------------------------------------------------------------------------


@model
def dim_date(w: Warehouse) -> DataFrame:
    days = w.spark.range(1).select(F.explode(F.sequence(F.lit("2000-01-01").cast("date"), F.lit("2030-12-30").cast("date"))).alias("date_day"))
    d = F.col("date_day")
    month, dow = F.month(d), F.dayofweek(d) - 1
    start = {unit: F.trunc(d, unit) for unit in ("month", "quarter", "year")}
    last = {"month": F.last_day(d), "quarter": F.date_sub(F.add_months(start["quarter"], 3), 1), "year": F.date_sub(F.add_months(start["year"], 12), 1)}
    long = lambda c: c.cast("long")
    return days.select(
        d.alias("date_id"), d, long(F.year(d)).alias("year"), long(F.quarter(d)).alias("quarter"), long(month).alias("month"),
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"), long(F.dayofmonth(d)).alias("day_of_month"), long(dow).alias("day_of_week"),
        F.rpad(F.date_format(d, "EEEE"), 9, " ").alias("day_of_week_name"), (d == last["month"]).alias("is_end_of_month"),
        long((F.quarter(d) + 1) % 4 + 1).alias("fiscal_quarter"), long(F.year(d) + F.when(month >= 7, 1).otherwise(0)).alias("fiscal_year"),
        *(x for unit in start for x in (start[unit].alias(f"first_day_of_{unit}"), last[unit].alias(f"last_day_of_{unit}"))),
        F.lit(False).alias("is_holiday"), F.lit(None).cast("string").alias("holiday_name"), (~dow.isin(0, 6)).alias("is_business_day"),
    )


@model
def dim_trust(w: Warehouse) -> DataFrame:
    bal = "report_period_end_scheduled_loan_bal_amt"
    totals = w.loans.groupBy("trust", "company").agg(
        F.min("reporting_period_end_date").alias("first_reporting_date"), F.max("reporting_period_end_date").alias("latest_reporting_date"),
        F.count_distinct("asset_num").alias("orig_loan_count"), F.sum("original_loan_amt").alias("total_orig_bal"),
    )
    latest = w.loans.groupBy("trust").agg(F.max("reporting_period_end_date").alias("reporting_period_end_date"))
    late = F.col("payment_status_loan_code").isin("1", "2", "3", "4", "5")
    w.trusts()
    latest = F.broadcast(latest) if w.few_trusts else latest
    now = w.loans.join(latest, ["trust", "reporting_period_end_date"]).groupBy("trust").agg(
        F.count_distinct("asset_num").alias("current_loan_count"), F.count_if(late).alias("delinquent_loans"), F.sum(bal).alias("current_bal")
    )
    return totals.join(now, "trust", "left").select(
        surrogate_key("trust").alias("trust_id"), F.col("trust").alias("trust_name"), F.col("company").alias("issuer"),
        "first_reporting_date", "latest_reporting_date", "orig_loan_count", "total_orig_bal", "current_loan_count", "delinquent_loans", "current_bal",
        F.when(F.col("total_orig_bal") > 0, ratio("current_bal", "total_orig_bal")).alias("factor"),
        F.when(F.col("current_loan_count") > 0, ratio("delinquent_loans", "current_loan_count")).otherwise(0.0).alias("delinquency_ratio"),
    )


@model
def dim_geo_state(w: Warehouse) -> DataFrame:
    rows = w.spark.createDataFrame(STATES, "state_code string, state_name string, region_name string, division_name string")
    return rows.select(surrogate_key("state_code").alias("state_id"), "*")


def _placed(w: Warehouse) -> DataFrame:
    """Distinct places of properties in known states, with the keys of all four levels of the hierarchy."""
    place = w["int_properties_cleaned"].select("geo_id", "property_state", "property_city", "property_zip", "property_address").distinct()
    placed = place.join(F.broadcast(w["dim_geo_state"]), F.col("property_state") == F.col("state_code"))
    placed = placed.withColumn("city_id", surrogate_key("state_id", "property_city"))
    return placed.withColumn("zip_id", surrogate_key("city_id", "property_zip"))


@model
def dim_geo_city(w: Warehouse) -> DataFrame:
    return _placed(w).select("city_id", "state_id", F.col("property_city").alias("city_name")).distinct()


@model
def dim_geo_zip(w: Warehouse) -> DataFrame:
    return _placed(w).select("zip_id", "city_id", F.col("property_zip").alias("zip_code")).distinct()


@model
def dim_geo_address(w: Warehouse) -> DataFrame:
    return _placed(w).select(F.col("geo_id").alias("address_id"), "zip_id", "property_address").distinct()


@model
def geo(w: Warehouse) -> DataFrame:
    """The hierarchy flattened: one row per address. Equal to following the four keys, in one join."""
    return _placed(w).select(
        "geo_id", "property_address", F.col("property_zip").alias("zip_code"), F.col("property_city").alias("city_name"),
        "state_code", "state_name", "region_name", "division_name",
    )


#: Names of property type codes.
TYPE_NAMES = {
    "RT": "Retail", "OF": "Office", "MF": "Multifamily", "IN": "Industrial", "HC": "Healthcare", "LO": "Lodging/Hotel",
    "MU": "Mixed Use", "SS": "Self Storage", "WH": "Warehouse", "MH": "Mobile Home",
}
PLACE = ("property_state", "property_city", "property_zip", "property_address")
TRACKED = {"property_type_code": "first_row", "property_status_code": "first_row", "square_feet": -1, "unit_count": -1, "geo_id": "first_row", "trust": "first_row"}


def _versioned(w: Warehouse) -> DataFrame:
    """Snapshots, whether each begins a version, and the version that is valid at its date, with its place beside it.

    A version begins whenever a tracked attribute changes to a value; a change to null begins none.
    """
    line = Window.partitionBy("_base", "asset_num", "property_num").orderBy("reporting_date")
    changed = F.lit(False)
    for c, before in TRACKED.items():
        changed = changed | F.coalesce(F.coalesce(F.lag(c).over(line), F.lit(before)) != F.col(c), F.lit(False))
    rows = w["property_snapshots"].withColumn("_changed", changed)
    valid = lambda *names: F.last(F.when(F.col("_changed"), F.struct(*names)), True).over(line)
    version = valid("property_type_code", "property_status_code", "square_feet", "unit_count", "geo_id")
    return rows.withColumns({"_version": version, "_place": valid(*PLACE), "property_id": F.concat_ws("_", "asset_num", "property_num")})


def _kind(code: str) -> Column:
    return ladder([(F.col(code) == c, name) for c, name in TYPE_NAMES.items()], "Other")


def _versions(w: Warehouse) -> DataFrame:
    """The property dimension with the place of each version, and its home. Versions with one property_id never overlap."""
    until = F.lead("reporting_date").over(Window.partitionBy("_base", "property_id").orderBy("reporting_date"))
    rows = _versioned(w).where("_changed").withColumn("end_date", F.coalesce(until, F.lit(FOREVER).cast("date")))
    return rows.join(w.trusts(), "trust").select(
        "property_id", F.col("reporting_date").alias("effective_date"), "end_date", "property_name", "property_type_code",
        _kind("property_type_code").alias("property_type_description"), "property_status_code", "year_built", "square_feet", "unit_count",
        F.col("company").alias("issuer"), "trust_id", "geo_id", *PLACE, "_base",
    )


@model
def dim_property(w: Warehouse) -> DataFrame:
    return _versions(w).drop(*PLACE, "_base")


# --- facts ------------------------------------------------------------------------------------------------------------

LOAN = {
    "orig_bal": "original_loan_amt", "current_bal": "report_period_end_scheduled_loan_bal_amt", "begin_bal": "report_period_begin_schedule_loan_bal_amt",
    "current_intr_rate": "report_period_intr_rate_pct", "payment_frequency": "payment_frequency_code", "origination_date": "origination_date",
    "is_modified": "modified_indicator", "modified_this_period": "report_period_modification_indicator", "pmt_due": "total_scheduled_prin_intr_due_amt",
}


def _loan_rows(w: Warehouse) -> DataFrame:
    """One row per loan and date: the last by file, with the maturity filled over all rows of the loan."""
    more = {"trust_name": "trust", "issuer": "company", "maturity_date": "maturity_date"}
    own = {c: c for c in ("payment_status_loan_code", "scheduled_prin_amt", "scheduled_intr_amt")}
    rows = _latest_filled(_notes_together(w, w.dealt_loans), ["_base", "asset_num"], "trust", LOAN | more | own, {"maturity_date"})
    status = F.col("payment_status_loan_code")
    rows = rows.withColumns({
        "delinquency_status": F.when(status.isin("A", "B") | status.isNull(), "0").otherwise(status), "pmt_received": F.col("scheduled_prin_amt") + F.col("scheduled_intr_amt"),
    })
    return rows.drop(*own)


def _loan_facts(w: Warehouse) -> DataFrame:
    """Loan months with their home, dealt by it: as they are built, or from the table where that was written."""
    if "fct_loan_monthly_performance" in w.written:
        return _notes_together(w, w["fct_loan_monthly_performance"], "loan_id")
    return _built_loan_facts(w)


@model
def fct_loan_monthly_performance(w: Warehouse) -> DataFrame:
    return _built_loan_facts(w).drop("_base")


def _built_loan_facts(w: Warehouse) -> DataFrame:
    """A base note takes what it lacks from its split note ('A' after the loan's number)."""
    values = [*LOAN, "maturity_date", "delinquency_status", "pmt_received"]
    rows = _loan_rows(w).withColumns({n: F.coalesce(n, v) for n, v in _beside(values, ["_base", "reporting_date"], 1).items()}).withColumnRenamed("asset_num", "loan_id")
    rows = rows.withColumnRenamed("trust_name", "trust").join(w.trusts(), "trust")
    status, short = F.col("delinquency_status"), F.col("pmt_due") - F.col("pmt_received")
    return rows.select(
        surrogate_key("loan_id", "reporting_date", "trust_id").alias("loan_performance_id"), "loan_id", "reporting_date", "trust_id",
        "current_bal", "begin_bal", "orig_bal", "delinquency_status", "is_modified", "modified_this_period",
        (F.col("maturity_date") < F.col("reporting_date")).alias("is_past_maturity"),
        F.when(status.isin("1", "2", "3", "4", "5", "6"), status.try_cast("long") * 30).otherwise(0).cast("long").alias("days_past_due"),
        ladder([(status == "0", "Current"), (status.isin("1", "2"), "Delinquent < 90 Days"), (status.isin("3", "4", "5", "6"), "Delinquent 90+ Days")], "Other").alias("loan_status"),
        "pmt_due", "pmt_received", short.alias("pmt_shortfall"), "current_intr_rate", "payment_frequency", "maturity_date", "origination_date", "issuer",
        F.when(F.col("orig_bal") > 0, ratio("current_bal", "orig_bal")).alias("remaining_bal_pct"),
        month_part(F.col("maturity_date"), F.col("reporting_date")).alias("months_to_maturity"),
        month_part(F.col("reporting_date"), F.col("origination_date")).alias("months_since_origination"),
        F.when(status != "0", short).otherwise(0).alias("delinquent_amt"), "_base",
    )


@model
def fct_loan_modifications(w: Warehouse) -> DataFrame:
    line = Window.partitionBy("_base", "asset_num").orderBy("reporting_date")
    rows = _loan_rows(w).withColumn("loan_id", F.col("asset_num")).withColumns({
        "previous_intr_rate": F.lag("current_intr_rate").over(line), "previous_maturity_date": F.lag("maturity_date").over(line), "previous_date": F.lag("reporting_date").over(line),
    })
    rate, before = F.col("current_intr_rate"), F.col("previous_intr_rate")
    new_rate = F.coalesce(F.abs(rate - before) > F.lit("0.0001").cast("decimal(9,6)"), F.lit(False))
    new_end = F.coalesce(F.col("maturity_date") != F.col("previous_maturity_date"), F.lit(False))
    this, ever = F.coalesce("modified_this_period", F.lit(False)), F.coalesce("is_modified", F.lit(False))
    rows = rows.where((this | ever) & F.col("previous_date").isNotNull() & (new_rate | new_end))
    return rows.select(
        surrogate_key("loan_id", "reporting_date").alias("modification_id"), "loan_id", F.col("reporting_date").alias("modification_date"), F.col("trust_name").alias("trust_id"),
        ladder([(this, "This Period"), (ever, "Existing")], "Unknown").alias("modification_type"), new_rate.alias("has_rate_change"), new_end.alias("has_maturity_change"),
        "previous_intr_rate", rate.alias("new_intr_rate"), (F.coalesce(rate, F.lit(0)) - F.coalesce(before, F.lit(0))).alias("intr_rate_change"),
        "previous_maturity_date", F.col("maturity_date").alias("new_maturity_date"),
        F.datediff("maturity_date", "previous_maturity_date").cast("long").alias("maturity_extension_days"), "current_bal",
    )


#: What tells a property's months: windows over them need no shuffle, as snapshots are dealt by the first of these already.
LINE = ["_base", "asset_num", "property_num"]


def _property_facts(w: Warehouse) -> DataFrame:
    """Metrics of each property month with the attributes of the version valid then, and its place.

    The version comes from the window that finds it, not from a join of snapshots and versions by their intervals.
    """
    own = [
        "property_id", "reporting_date", "trust", F.col("company").alias("issuer"), *LINE, "current_valuation", "securitization_valuation",
        "current_occupancy_pct", "securitization_occupancy_pct", "current_revenue", "current_expenses", "current_noi", "current_dscr",
        *(F.col(c).isNotNull().alias(f"has_{c}") for c in ("largest_tenant", "second_largest_tenant", "third_largest_tenant")),
    ]
    rows = _versioned(w).where("_version is not null").select(*own, "_version.*", "_place.*").join(w.trusts(), "trust")
    now, then = F.col("current_valuation"), F.col("securitization_valuation")
    per = lambda n: F.when(F.col(n) > 0, ratio("current_revenue", n))
    return rows.select(
        surrogate_key("asset_num", "property_num", "reporting_date", "trust_id").alias("property_metric_id"), "property_id", "reporting_date", "trust_id",
        "property_type_code", "square_feet", "unit_count", "current_valuation", "securitization_valuation", "current_occupancy_pct", "securitization_occupancy_pct",
        "current_revenue", "current_expenses", "current_noi", "current_dscr", "has_largest_tenant", "has_second_largest_tenant", "has_third_largest_tenant",
        "property_status_code", "issuer",
        F.when(then == 0, 0.0).otherwise(ratio(now - then, then)).alias("valuation_change_pct"),
        (F.coalesce("current_occupancy_pct", F.lit(0)) - F.coalesce("securitization_occupancy_pct", F.lit(0))).alias("occupancy_change_pct"),
        F.when(F.col("current_revenue") == 0, 0.0).otherwise(ratio("current_expenses", "current_revenue")).alias("expense_ratio"),
        per("square_feet").alias("revenue_per_sqft"), per("unit_count").alias("revenue_per_unit"), *PLACE, *LINE,
    )


@model
def fct_property_metrics(w: Warehouse) -> DataFrame:
    return _property_facts(w).drop(*PLACE, *LINE)


# --- marts ------------------------------------------------------------------------------------------------------------


def _live(w: Warehouse) -> DataFrame:
    """Loan months before maturity, with their home; rows without a maturity are neither before nor after it."""
    return _loan_facts(w).where(~F.col("is_past_maturity"))


@model
def loan_aging_metrics(w: Warehouse) -> DataFrame:
    """Age, prepayment and vintage of each loan month.

    A loan in several trusts multiplies its months by the number of trusts it has months in.
    """
    # the trusts of a loan are few, and counted in the window that its months are in anyway
    trusts = F.size(F.collect_set("trust_id").over(Window.partitionBy("loan_id")))
    live = _live(w).withColumn("_trusts", trusts).withColumn("_times", F.explode(F.array_repeat(F.lit(1), F.col("_trusts")))).drop("_trusts", "_times")
    line = Window.partitionBy("loan_id").orderBy("reporting_date", "trust_id")
    age = months_between_parts(F.col("reporting_date"), F.col("origination_date")) + 1
    term = months_between_parts(F.col("maturity_date"), F.col("origination_date")) + 1
    before = F.lag("current_bal").over(line)
    rows = live.withColumns({"before": before, "loan_age_months": age, "original_term_months": term})
    fell = F.coalesce(F.col("before") > F.col("current_bal"), F.lit(False))
    paid = F.when(fell, F.col("before") - F.col("current_bal")).otherwise(0)
    rate = ratio(paid, "current_bal") * 100
    months = F.col("loan_age_months")
    end = F.add_months("reporting_date", F.col("months_to_maturity").cast("int"))
    return rows.select(
        "loan_id", "trust_id", "maturity_date", "reporting_date", "loan_age_months", "months_to_maturity", "original_term_months", "origination_date",
        F.when(months <= 30, rate * ratio(F.lit(30), months)).otherwise(rate).alias("psa_speed"), rate.alias("cpr"), (ratio(paid, "before") * 100).alias("smm"),
        fell.alias("is_prepayment"), "current_bal", "orig_bal", (ratio("current_bal", "orig_bal") * 100).alias("percent_remaining_balance"),
        F.trunc("origination_date", "year").alias("origination_vintage_year"), F.trunc("origination_date", "quarter").alias("origination_vintage_quarter"),
        F.trunc(end, "year").alias("maturity_vintage_year"),
        below(months, [(12, "0-1 Year"), (24, "1-2 Years"), (36, "2-3 Years"), (60, "3-5 Years"), (84, "5-7 Years"), (120, "7-10 Years")], "Over 10 Years", True).alias("loan_age_bucket"),
        below(F.col("months_to_maturity"), [(12, "Under 1 Year"), (36, "1-3 Years"), (60, "3-5 Years"), (120, "5-10 Years")], "Over 10 Years", True).alias("remaining_term_bucket"),
    )


def _placed_rows(w: Warehouse, rows: DataFrame) -> DataFrame:
    """rows with the place columns of the geography hierarchy: null for a state that it does not have."""
    states = F.broadcast(w["dim_geo_state"].drop("state_id"))
    rows = rows.join(states, F.col("property_state") == F.col("state_code"), "left").withColumnsRenamed({"property_address": "_address"})
    known = lambda c: F.when(F.col("state_code").isNotNull(), F.col(c))
    rows = rows.withColumns({"property_address": known("_address"), "zip_code": known("property_zip"), "city_name": known("property_city")})
    return rows.drop("_address", "property_state", "property_city", "property_zip")


def _property_months(w: Warehouse, *more: str) -> DataFrame:
    """Property metrics with the attributes of the version valid then, and the named parts of where it stands."""
    own = ["property_id", "reporting_date", "current_valuation", "securitization_valuation", "current_occupancy_pct", "securitization_occupancy_pct", "current_revenue", "current_expenses", "current_noi", "current_dscr", "valuation_change_pct", "property_type_code", "square_feet", "unit_count"]
    return _placed_rows(w, _property_facts(w)).select(*own, *more)


@model
def loan_risk_metrics(w: Warehouse) -> DataFrame:
    rows = _property_months(w, "state_code", "_base").groupBy(F.col("_base").alias("_home"), F.substring_index("property_id", "_", 1).alias("_loan"), F.col("reporting_date").alias("_date")).agg(
        F.sum("current_valuation").alias("total_valuation"), mean("current_occupancy_pct").alias("occupancy"), mean("current_dscr").alias("dscr"),
        F.mode("property_type_code", True).alias("property_type_code"), F.mode("state_code", True).alias("property_state"),
    )
    live = _live(w)
    rows = joined_at_home(live, rows, live["_base"] == rows["_home"], live["loan_id"] == rows["_loan"], live["reporting_date"] == rows["_date"], "left").withColumn("ltv", F.when(F.col("total_valuation") > 0, ratio("current_bal", "total_valuation")))
    ltv, dscr, occ, status, dpd = (F.col(c) for c in ("ltv", "dscr", "occupancy", "delinquency_status", "days_past_due"))
    points = (
        ladder([(ltv > 0.8, 4), (ltv > 0.6, 2), (ltv.isNotNull(), 0)], 2)
        + ladder([(dscr < 1.2, 4), (dscr < 1.5, 2), (dscr.isNotNull(), 0)], 2)
        + ladder([(occ < 0.8, 2), (occ < 0.9, 1), (occ.isNotNull(), 0)], 1)
        + ladder([(status.isin("3", "4", "5", "6"), 10), (status.isin("1", "2"), 6)], 0)
    )
    rows = rows.withColumn("risk_score", F.floor(points / 2).cast("long"))
    share = lambda bad: F.count_if(bad) / F.count("*")
    score, bal = F.col("risk_score"), F.col("current_bal")
    levels = {"high": score >= 8, "medium": (score >= 4) & (score < 8), "low": score < 4}
    part = lambda level: F.sum(F.when(levels[level], bal).otherwise(0))
    # averages of doubles depend on the order of addition; nine decimals do not
    near = lambda c: F.round(F.avg(c), 9)
    return rows.groupBy("trust_id", "property_type_code", "property_state", "reporting_date").agg(
        F.count("*").alias("loan_count"), F.sum(bal).alias("total_loan_amt"), near(ltv).alias("avg_ltv"), near(dscr).alias("avg_dscr"), near(occ).alias("avg_occupancy"),
        share(ltv > 0.8).alias("high_ltv_pct"), share(dscr < 1.2).alias("high_dscr_pct"), share(occ < 0.8).alias("high_occupancy_risk_pct"), share(dpd > 60).alias("high_delinquency_risk_pct"),
        mean("risk_score").alias("avg_risk_score"), *(part(x).alias(f"{x}_risk_bal") for x in levels), *(ratio(part(x), F.sum(bal)).alias(f"{x}_risk_ratio") for x in levels),
    )


@model
def vintage_performance(w: Warehouse) -> DataFrame:
    bal, late, severe = F.col("current_bal"), F.col("delinquency_status") != "0", F.col("days_past_due") >= 90
    rows = w["fct_loan_monthly_performance"].withColumn("vintage_year", F.year("origination_date").cast("long"))
    rows = rows.where(F.col("vintage_year").between(2000, F.year(F.lit(w.as_of).cast("date"))))
    part = lambda c: F.sum(F.when(c, bal).otherwise(0))
    modified = F.coalesce("is_modified", F.lit(False))
    rows = rows.groupBy("reporting_date", "vintage_year").agg(
        F.count_distinct("loan_id").alias("loan_count"), F.sum(bal).alias("total_balance"), part(late).alias("delinquent_balance"), part(severe).alias("severe_delinquent_balance"),
        part(modified).alias("modified_balance"), mean("days_past_due").alias("avg_days_past_due"), ratio(part(late), F.sum(bal)).alias("delinquency_rate"),
        ratio(part(severe), F.sum(bal)).alias("severe_delinquency_rate"), ratio(part(modified), F.sum(bal)).alias("modification_rate"), mean(bal).alias("avg_loan_balance"),
    )
    months = (F.year("reporting_date") - F.col("vintage_year")) * 12 + F.month("reporting_date") - 1
    rows = rows.withColumn("vintage_age_months", months.cast("long"))
    same_age, line, r = Window.partitionBy("vintage_age_months"), Window.partitionBy("vintage_year").orderBy("reporting_date"), F.col("delinquency_rate")
    usual = F.round(F.avg(r).over(same_age), 9)
    rows = rows.withColumns({
        "avg_delinquency_at_age": usual, "max_delinquency_at_age": F.max(r).over(same_age), "min_delinquency_at_age": F.min(r).over(same_age),
        "delinquency_vs_avg_at_age": F.round(r - F.avg(r).over(same_age), 9),
        "delinquency_percentile_at_age": F.percent_rank().over(same_age.orderBy(r.asc_nulls_last())),
        **{f"delinquency_{n}m_change": r - F.lag(r, n).over(line) for n in (3, 6, 12)},
    })
    rank, trend = F.col("delinquency_percentile_at_age"), F.col("delinquency_3m_change")
    return rows.withColumns({
        "vintage_performance_category": below(rank, [(0.25, "Top Performer"), (0.5, "Above Average"), (0.75, "Below Average")], "Underperformer"),
        "short_term_trend": ladder([(trend.isNull(), "Insufficient Data"), (trend < -0.01, "Improving"), (trend > 0.01, "Deteriorating")], "Stable"),
    })


@model
def property_performance_metrics(w: Warehouse) -> DataFrame:
    return property_performance(w, strict=True)


@model
def property_performance_fixed(w: Warehouse) -> DataFrame:
    """With loans found by the asset number in the property's key; the strict form looks for the whole key, in vain."""
    return property_performance(w, strict=False)


def _performance_rows(w: Warehouse, strict: bool) -> DataFrame:
    """Property months with their changes and their loans, before ratios; lazy."""
    places = ["property_address", "zip_code", "city_name", "state_code", "state_name", "region_name", "division_name"]
    rows = _property_months(w, *places, *LINE).drop("valuation_change_pct")
    line = Window.partitionBy(*LINE).orderBy("reporting_date")
    moving = {"valuation": "current_valuation", "occupancy": "current_occupancy_pct", "noi": "current_noi"}
    rows = rows.withColumns({f"{n}_{m}m_change": F.col(c) - F.lag(c, m).over(line) for m in (3, 12) for n, c in moving.items()}).drop("asset_num", "property_num")
    key = F.col("property_id") if strict else F.substring_index("property_id", "_", 1)
    loans = _loan_facts(w).select(F.col("_base").alias("_home"), F.col("loan_id").alias("_loan"), F.col("reporting_date").alias("_date"), F.col("current_bal").alias("loan_balance"), "current_intr_rate", "origination_date")
    rows = rows.withColumn("_key", key)
    return joined_at_home(rows, loans, rows["_base"] == loans["_home"], rows["_key"] == loans["_loan"], rows["reporting_date"] == loans["_date"], "left").drop("_base", "_key", "_home", "_loan", "_date")


def _with_ratios(rows: DataFrame) -> DataFrame:
    value, then, rev, noi, sqft, units, bal, occ = (F.col(c) for c in ("current_valuation", "securitization_valuation", "current_revenue", "current_noi", "square_feet", "unit_count", "loan_balance", "current_occupancy_pct"))
    return rows.withColumns({
        "loan_to_value_ratio": F.when(value > 0, ratio(bal, value)), "debt_yield": F.when(bal > 0, ratio(noi, bal)),
        **{f"{n}_per_sq_ft": ratio(c, sqft) for n, c in (("value", value), ("revenue", rev), ("noi", noi))},
        **{f"{n}_per_unit": ratio(c, units) for n, c in (("value", value), ("revenue", rev), ("noi", noi))},
        "expense_ratio": ratio("current_expenses", rev), "valuation_change_pct": ratio(value, then) - 1, "occupancy_change_pct": occ - F.col("securitization_occupancy_pct"),
    })


def _judged() -> dict[str, Column]:
    """What a property month's own values and ratios tell, whatever those of its type are."""
    occ, dscr = F.col("current_occupancy_pct"), F.col("current_dscr")
    ltv, debt, occ3, noi3 = F.col("loan_to_value_ratio"), F.col("debt_yield"), F.col("occupancy_3m_change"), F.col("noi_3m_change")
    score = (
        ladder([(dscr >= 1.5, 0.0), (dscr >= 1.2, 1.0), (dscr >= 1.0, 2.0)], 3.0)
        + ladder([(occ >= 0.9, 0.0), (occ >= 0.8, 1.0), (occ >= 0.7, 1.5)], 2.0)
        + ladder([(ltv.isNull(), 1.0), (ltv <= 0.6, 0.0), (ltv <= 0.7, 0.5), (ltv <= 0.8, 1.0)], 2.0)
        + ladder([(debt.isNull(), 0.75), (debt >= 0.10, 0.0), (debt >= 0.08, 0.5), (debt >= 0.06, 1.0)], 1.5)
        + ladder([((occ3 < -0.03) | (noi3 < 0), 1.5), (occ3 < -0.02, 1.0), (occ3 < -0.01, 0.5)], 0.0)
    )
    return {
        "performance_category": ladder([
            ((dscr >= 1.5) & (occ >= 0.9), "Strong Performer"), ((dscr >= 1.2) & (occ >= 0.8), "Stable Performer"), ((dscr < 1.2) | (occ < 0.8), "Underperformer"), ((dscr < 1.0) | (occ < 0.7), "Distressed"),
        ], "Moderate Performer"),
        "occupancy_trend": ladder([(occ3 > 0.02, "Improving"), (occ3 < -0.02, "Declining")], "Stable"), "noi_trend": ladder([(noi3 > 0, "Improving"), (noi3 < 0, "Declining")], "Stable"),
        "property_risk_score": score,
    }


def property_performance(w: Warehouse, strict: bool) -> DataFrame:
    rows = _with_ratios(kept(_performance_rows(w, strict), "property-performance"))  # read twice, for the averages and beside them
    occ, dscr = F.col("current_occupancy_pct"), F.col("current_dscr")
    # a type's averages; rows without a type have none
    usual = {"occupancy_pct": occ, "value_per_sq_ft": F.col("value_per_sq_ft"), "revenue_per_sq_ft": F.col("revenue_per_sq_ft"), "noi_per_sq_ft": F.col("noi_per_sq_ft"), "expense_ratio": F.col("expense_ratio"), "debt_yield": F.col("debt_yield"), "dscr": dscr}
    rows = with_group_means(rows, ["reporting_date", "property_type_code"], {f"type_avg_{n}": double(c) for n, c in usual.items()}, number_of_groups(rows, ["reporting_date", "property_type_code"]), 9)
    rows = rows.withColumns({f"type_avg_{n}": F.when(F.col("property_type_code").isNotNull(), F.col(f"type_avg_{n}")) for n in usual})

    def against(c: Column, average: str) -> Column:
        c = F.round(double(c), 9)
        return ladder([(c > F.col(average), "Above Average"), (c < F.col(average), "Below Average")], "Average")

    return rows.withColumns({
        "occupancy_vs_type": against(occ, "type_avg_occupancy_pct"), "dscr_vs_type": against(dscr, "type_avg_dscr"), "noi_vs_type": against(F.col("noi_per_sq_ft"), "type_avg_noi_per_sq_ft"),
        **_judged(),
    })


for _name, _strict in (("property_performance_metrics", True), ("property_performance_fixed", False)):
    LEAN[_name] = re.compile(r"type_avg_|_vs_type|\*", re.IGNORECASE), lambda w, strict=_strict: _with_ratios(_performance_rows(w, strict)).withColumns(_judged())


@model
def portfolio_concentration(w: Warehouse) -> DataFrame:
    return concentration(w, strict=True)


@model
def portfolio_concentration_fixed(w: Warehouse) -> DataFrame:
    """With properties found by asset number: each loan takes its first property valid at the date."""
    return concentration(w, strict=False)


def concentration(w: Warehouse, strict: bool) -> DataFrame:
    """Ten kinds of concentration from one pass: each loan month becomes its (kind, category) pairs.

    strict: versions of properties whose key equals the loan's, which there are none of; so places are unknown.
    """
    versions = _versions(w).select("property_id", "effective_date", "end_date", "property_type_code", *PLACE, "_base")
    if not strict:
        versions = versions.withColumn("property_num", F.split_part("property_id", F.lit("_"), F.lit(2))).withColumn("property_id", F.substring_index("property_id", "_", 1))
    rows = as_of_versions(_live(w), versions.withColumnRenamed("property_id", "loan_id"), "loan_id", "reporting_date", "left", home="_base")
    # each loan counts once a date: of its months, those of a trust with several issuers, the first does
    if strict:
        first = F.row_number().over(Window.partitionBy("_base", "loan_id", "reporting_date").orderBy("trust_id")) == 1
    else:
        rows, first = first_per_key(rows, ["_base", "loan_id", "reporting_date", "trust_id"], [F.col("property_num").asc_nulls_last()]), F.lit(True)
    rows = rows.withColumn("_loan", F.when(first, F.col("loan_id")))
    rows = _placed_rows(w, rows)
    bal, rate, end, date = (F.col(c) for c in ("current_bal", "current_intr_rate", "maturity_date", "reporting_date"))
    million = 1000000
    size = below(bal, [(million, "Under $1M"), (5 * million, "$1M - $5M"), (10 * million, "$5M - $10M"), (25 * million, "$10M - $25M"), (50 * million, "$25M - $50M")], "Over $50M")
    term = ladder([(end <= date, "Matured"), *((end <= F.add_months(date, 12 * y), n) for y, n in ((1, "Under 1 Year"), (3, "1-3 Years"), (5, "3-5 Years"), (10, "5-10 Years")))], "Over 10 Years")
    interest = below(rate, [(0.03, "Under 3%"), (0.04, "3% - 4%"), (0.05, "4% - 5%"), (0.06, "5% - 6%")], "Over 6%")
    known = lambda c: F.coalesce(c, F.lit("Unknown"))
    empty = lambda c: F.coalesce(c, F.lit(""))
    kinds = {
        "Property Type": known("property_type_code"), "State": known("state_name"), "Region": known("region_name"), "Division": known("division_name"),
        "City": F.when(F.col("city_name").isNotNull(), F.concat_ws(", ", "city_name", empty("state_code"))), "ZIP Code": F.col("zip_code"),
        "Address": F.when(F.col("property_address").isNotNull(), F.concat_ws(", ", "property_address", empty("city_name"), empty("state_code"))),
        "Loan Size": size, "Interest Rate": interest, "Remaining Term": term,
    }
    # a kind without a name is the whole day: its row gives the totals, so that loan months are read once
    kinds = {**kinds, None: F.lit("")}
    pairs = F.array(*(F.struct(F.lit(k).cast("string").alias("concentration_type"), v.alias("concentration_category")) for k, v in kinds.items()))
    long = rows.select("reporting_date", "_loan", "current_bal", F.explode(pairs).alias("p")).select("reporting_date", "_loan", "current_bal", "p.*")
    # only counts of categories are shuffled; they are read for totals, quantiles, ranges and ranks
    found = long.where("concentration_category is not null").groupBy("reporting_date", "concentration_type", "concentration_category")
    found = kept(found.agg(F.count("_loan").alias("loan_count"), F.sum("current_bal").alias("total_balance")), "concentration")
    whole, days = F.col("concentration_type").isNull(), w.days()
    totals = found.where(whole).select(F.col("reporting_date").alias("_day"), F.col("loan_count").alias("all_loans"), F.col("total_balance").alias("all_balance"))
    totals = F.broadcast(totals) if days <= GROUPS_SENT else totals
    found = with_rank(found.where(~whole), ["reporting_date", "concentration_type"], "total_balance", "place", descending=True, nulls_first=True, groups=days * len(kinds))
    found, place = found.join(totals, F.col("_day").eqNullSafe(F.col("reporting_date")), "left"), F.col("place")
    return found.select(
        "reporting_date", "concentration_type", "concentration_category", "loan_count", "total_balance", ratio("total_balance", "loan_count").alias("avg_loan_balance"),
        ratio("loan_count", "all_loans").alias("pct_of_loans"), ratio("total_balance", "all_balance").alias("pct_of_balance"), place.alias("rank_by_balance"), (place <= 5).alias("is_top_5"),
    )


@model
def property_occupancy_noi(w: Warehouse) -> DataFrame:
    rows = _property_months(w, "state_code", "region_name", *LINE).withColumnRenamed("state_code", "state").withColumnRenamed("region_name", "region")
    line = Window.partitionBy(*LINE).orderBy("reporting_date")
    year = line.rowsBetween(-11, 0)
    occ, noi = F.col("current_occupancy_pct"), F.col("current_noi")
    ago = F.lag(noi, 12).over(line)
    rows = rows.withColumns({
        "occupancy_change": occ - F.col("securitization_occupancy_pct"), "trailing_12m_avg_occupancy": F.round(F.avg(double(occ)).over(year), 9),
        "occupancy_volatility_12m": F.round(F.stddev(double(occ)).over(year), 6), "noi_per_sqft": ratio(noi, "square_feet"), "expense_ratio": ratio("current_expenses", "current_revenue"),
        "trailing_12m_noi": F.sum(noi).over(year), "noi_yoy_growth": ratio(noi - ago, ago) * 100, "_month": F.trunc("reporting_date", "month"),
    })
    stored, usual = kept(rows, "property-occupancy"), []  # read for each kind of average and beside them
    rows = stored
    for name, column in (("property_type", "property_type_code"), ("state", "state")):
        means = {f"avg_occupancy_by_{name}": double(occ), f"avg_noi_per_sqft_by_{name}": double(F.col("noi_per_sqft"))}
        rows = with_group_means(rows, [column, "_month"], means, number_of_groups(stored, [column, "_month"]), 9)
        usual += means
    return rows.select(
        "property_id", "reporting_date", "property_type_code", "state", "region", occ.alias("current_occupancy"), F.col("securitization_occupancy_pct").alias("securitization_occupancy"),
        "occupancy_change", "trailing_12m_avg_occupancy", "occupancy_volatility_12m", "current_revenue", "current_expenses", "current_noi", "noi_per_sqft", "expense_ratio",
        "trailing_12m_noi", "noi_yoy_growth", "square_feet", *usual,
    )


# --- documented analyses ----------------------------------------------------------------------------------------------


@model
def delinquency_by_month_trust(w: Warehouse) -> DataFrame:
    bal, late = F.col("current_bal"), F.col("days_past_due") > 0
    rows = w["fct_loan_monthly_performance"].join(F.broadcast(w["dim_date"].select("date_id", "year", "month")), F.col("reporting_date") == F.col("date_id"))
    rows = rows.join(w.trusts().withColumnRenamed("trust", "trust_name"), "trust_id")
    part = F.sum(F.when(late, bal).otherwise(0))
    return rows.groupBy("year", "month", "trust_name").agg(F.sum(bal).alias("total_balance"), part.alias("delinquent_balance"), ratio(part, F.sum(bal)).alias("delinquency_rate"))


@model
def property_by_type(w: Warehouse) -> DataFrame:
    """Over all versions of a property, whenever they were valid: months count once per version.

    So a property's months are summed up once, and the sums count once per version; no pairs of months and versions are made.
    """
    rows = _versioned(w).join(w.trusts(), "trust")
    counts = F.col("_version").isNotNull() & (F.col("reporting_date") > F.lit("1996-01-01").cast("date"))
    sqft = F.col("_version.square_feet")
    values = {"occupancy": F.col("current_occupancy_pct"), "dscr": F.col("current_dscr"), "revenue_per_sqft": F.when(sqft > 0, ratio("current_revenue", sqft))}
    rows = rows.groupBy("_base", "property_id").agg(
        F.collect_list(F.when(F.col("_changed"), _kind("property_type_code"))).alias("_kinds"), F.count_if(counts).alias("_months"),
        *(f(F.when(counts, v)).alias(f"{x}_{n}") for n, v in values.items() for x, f in (("sum", F.sum), ("n", F.count))),
    )
    rows = rows.where("_months > 0").select(F.explode("_kinds").alias("property_type_description"), "*")
    total = lambda n: F.sum(f"sum_{n}").cast("double") / F.nullif(F.sum(f"n_{n}"), F.lit(0))
    return rows.groupBy("property_type_description").agg(
        total("occupancy").alias("avg_occupancy"), total("dscr").alias("avg_dscr"), F.round(total("revenue_per_sqft"), 6).alias("avg_revenue_per_sqft")
    )


@model
def modification_impact(w: Warehouse) -> DataFrame:
    change = F.col("intr_rate_change")
    kind = ladder([(change < -1, "Large Rate Decrease (>1%)"), (change < 0, "Rate Decrease"), (change > 1, "Large Rate Increase (>1%)"), (change > 0, "Rate Increase")], "No Change")
    changes = w["fct_loan_modifications"].where("has_rate_change").select("loan_id", "modification_date", kind.alias("modification_type"))
    rows = w["fct_loan_monthly_performance"].select("loan_id", "reporting_date", "days_past_due").join(changes, "loan_id").where("reporting_date >= modification_date")
    within = lambda n: F.col("reporting_date") <= F.add_months("modification_date", n)
    dpd = F.col("days_past_due")
    return rows.groupBy("modification_type").agg(
        mean(F.when(within(3), dpd)).alias("avg_dpd_3m_after"), mean(F.when(within(6), (dpd == 0).cast("int"))).alias("pct_current_6m_after"), F.count_distinct("loan_id").alias("loan_count")
    )
