"""The metric layer: measures and ratios by name, compiled to one aggregate over their model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .warehouse import Warehouse


@dataclass(frozen=True)
class Measure:
    """An aggregate (sum, avg, min, max, count_distinct) of a SQL expression over a model."""

    model: str
    agg: str
    expr: str

    def column(self) -> Column:
        x = F.expr(self.expr)
        if self.agg == "count_distinct":
            return F.count_distinct(x)
        if self.agg == "avg":  # from the exact sum where there is one
            return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.agg](x)

    def sql(self) -> str:
        if self.agg == "count_distinct":
            return f"count(DISTINCT {self.expr})"
        if self.agg == "avg":
            return f"CAST(sum({self.expr}) AS DOUBLE) / nullif(count({self.expr}), 0)"
        return f"{self.agg}({self.expr})"


@dataclass(frozen=True)
class Ratio:
    """One measure over another of the same model; null where the lower one is zero."""

    top: str
    bottom: str


_LOANS, _PROPERTIES, _SHARES, _VINTAGES, _PERFORMANCE = "fct_loan_monthly_performance", "fct_property_metrics", "portfolio_concentration", "vintage_performance", "property_performance_metrics"
_near = lambda x: f"CAST(round({x}, 9) AS DECIMAL(28,9))"  # noqa: E731  sums of doubles depend on their order
_share = lambda kind: f"CASE WHEN concentration_type = '{kind}' THEN pct_of_balance END"
_flag = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"

METRICS: dict[str, Measure | Ratio] = {
    "total_current_balance": Measure(_LOANS, "sum", "current_bal"),
    "total_delinquent_balance": Measure(_LOANS, "sum", "CASE WHEN days_past_due > 0 THEN current_bal ELSE 0 END"),
    "delinquency_rate": Ratio("total_delinquent_balance", "total_current_balance"),
    "beginning_balance": Measure(_LOANS, "sum", "begin_bal"),
    "delinquent_loan_count": Measure(_LOANS, "sum", _flag("days_past_due > 0")),
    "total_loan_count": Measure(_LOANS, "count_distinct", "loan_id"),
    "average_interest_rate": Measure(_LOANS, "avg", "current_intr_rate"),
    "average_occupancy": Measure(_PROPERTIES, "avg", "current_occupancy_pct"),
    "average_dscr": Measure(_PROPERTIES, "avg", "current_dscr"),
    "total_property_count": Measure(_PROPERTIES, "count_distinct", "property_id"),
    "average_valuation_change": Measure(_PROPERTIES, "avg", _near("valuation_change_pct")),
    "current_valuation": Measure(_PROPERTIES, "sum", "current_valuation"),
    "total_noi": Measure(_PROPERTIES, "sum", "current_noi"),
    "total_square_feet": Measure(_PROPERTIES, "sum", "square_feet"),
    "total_occupancy_weighted": Measure(_PROPERTIES, "sum", "current_occupancy_pct * square_feet"),
    "weighted_average_occupancy": Ratio("total_occupancy_weighted", "total_square_feet"),
    "weighted_average_noi_per_sqft": Ratio("total_noi", "total_square_feet"),
    "top_property_type_concentration": Measure(_SHARES, "max", _share("Property Type")),
    "top_state_concentration": Measure(_SHARES, "max", _share("State")),
    "herfindahl_index": Measure(_SHARES, "sum", _near("CASE WHEN concentration_type = 'Property Type' THEN pct_of_balance * pct_of_balance END")),
    "pct_of_balance": Measure(_SHARES, "max", "pct_of_balance"),
    "concentration_loan_count": Measure(_SHARES, "sum", "loan_count"),
    "concentration_balance": Measure(_SHARES, "sum", "total_balance"),
    "best_vintage_delinquency": Measure(_VINTAGES, "min", "delinquency_rate"),
    "worst_vintage_delinquency": Measure(_VINTAGES, "max", "delinquency_rate"),
    "vintage_delinquency_spread": Measure("vintage_spread", "max", "spread"),
    "vintage_loan_count": Measure(_VINTAGES, "sum", "loan_count"),
    "vintage_balance": Measure(_VINTAGES, "sum", "total_balance"),
    "distressed_properties_pct": Measure(_PERFORMANCE, "avg", _flag("performance_category = 'Distressed'")),
    "average_property_risk_score": Measure(_PERFORMANCE, "avg", _near("property_risk_score")),
    "declining_occupancy_properties_pct": Measure(_PERFORMANCE, "avg", _flag("occupancy_trend = 'Declining'")),
    "noi_growth_rate": Measure(_PERFORMANCE, "avg", _near("CAST(noi_12m_change AS DOUBLE) / nullif(CAST(current_noi - noi_12m_change AS DOUBLE), 0.0)")),
}

#: The time column that stands for a model's period, under which metrics are grouped by default.
PERIOD = "reporting_date"

SPREAD_SQL = """SELECT *, round(delinquency_rate - avg(delinquency_rate) OVER (PARTITION BY reporting_date), 9) AS spread FROM vintage_performance"""


def spread(w: Warehouse) -> DataFrame:
    """Vintages with the distance of their delinquency from the average of all at the date."""
    at = Window.partitionBy("reporting_date")
    return w["vintage_performance"].withColumn("spread", F.round(F.col("delinquency_rate") - F.avg("delinquency_rate").over(at), 9))


def model_of(name: str) -> str:
    m = METRICS[name]
    return model_of(m.top) if isinstance(m, Ratio) else m.model


def metric(w: Warehouse, names: Sequence[str], by: Sequence[str] = (PERIOD,), where: str | None = None) -> DataFrame:
    """Metrics of one model, grouped by its columns, over the rows that ``where`` (SQL) keeps."""
    models = {model_of(n) for n in names}
    if len(models) != 1:
        raise ValueError(f"metrics of several models: {', '.join(sorted(models))}")
    source = models.pop()
    df = spread(w) if source == "vintage_spread" else w.rows(source, metric_sql(names, by), where or "")
    if where:
        df = df.where(where)

    def column(name: str) -> Column:
        m = METRICS[name]
        if isinstance(m, Ratio):
            return METRICS[m.top].column().cast("double") / F.nullif(METRICS[m.bottom].column().cast("double"), F.lit(0.0))
        return m.column()

    return df.groupBy(*by).agg(*(column(n).alias(n) for n in names))


def metric_sql(names: Sequence[str], by: Sequence[str] = (PERIOD,)) -> str:
    def text(name: str) -> str:
        m = METRICS[name]
        if isinstance(m, Ratio):
            return f"CAST({METRICS[m.top].sql()} AS DOUBLE) / nullif(CAST({METRICS[m.bottom].sql()} AS DOUBLE), 0.0)"
        if m.agg == "sum" and ("count" in name or name == "total_square_feet"):
            return f"CAST({m.sql()} AS BIGINT)"
        return m.sql() if m.agg == "count_distinct" else f"CAST({m.sql()} AS DOUBLE)"

    columns = ", ".join([*by, *(f"{text(n)} AS {n}" for n in names)])
    grouped = f" GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT {columns} FROM {model_of(names[0])}{grouped}"
