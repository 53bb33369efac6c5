"""Semantic metric layer: named measures and dimensions compiled to one groupBy().agg() (M)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}
_GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    aggregation: str = "sum"

    def column(self) -> Column:
        if self.aggregation not in _AGGREGATES:
            raise ValueError(f"unknown aggregation {self.aggregation!r}")
        return _AGGREGATES[self.aggregation](F.expr(self.expr)).alias(self.name)


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: str
    is_time: bool = False


@dataclass(frozen=True)
class MetricTable:
    name: str
    measures: Mapping[str, Measure]
    dimensions: Mapping[str, Dimension]


@dataclass(frozen=True)
class MetricModel:
    tables: Mapping[str, MetricTable] = field(default_factory=dict)

    @staticmethod
    def from_dict(spec: Mapping) -> "MetricModel":
        """Model from nested mappings (as read from YAML or JSON)."""
        tables = {}
        for t in spec["tables"]:
            measures = {
                m["name"]: Measure(m["name"], str(m.get("expr", m["name"])), m.get("default_aggregation", "sum"))
                for m in t.get("measures", ())
            }
            dims = {d["name"]: Dimension(d["name"], d.get("expr", d["name"])) for d in t.get("dimensions", ())}
            for d in t.get("time_dimensions", ()):
                dims[d["name"]] = Dimension(d["name"], d.get("expr", d["name"]), is_time=True)
            tables[t["name"]] = MetricTable(t["name"], measures, dims)
        return MetricModel(tables)


def metric_query(
    model: MetricModel,
    table: str,
    source: DataFrame,
    measures: Sequence[str],
    dims: Sequence[str] = (),
    where: Column | str | None = None,
    grain: str | None = None,
    order: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Measures by dimensions over one table; `grain` truncates the time dimensions."""
    spec = model.tables[table]
    unknown = [m for m in measures if m not in spec.measures] + [d for d in dims if d not in spec.dimensions]
    if unknown:
        raise KeyError(f"{table} has no {unknown}")
    if grain is not None and grain not in _GRAINS:
        raise ValueError(f"grain must be one of {_GRAINS}")
    rows = source.where(where) if where is not None else source
    keys = []
    for name in dims:
        d = spec.dimensions[name]
        expr = F.expr(d.expr)
        if d.is_time and grain:
            expr = F.date_trunc(grain, expr)
        keys.append(expr.alias(name))
    out = rows.groupBy(*keys).agg(*[spec.measures[m].column() for m in measures])
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit is not None else out


# Tables, measures and default aggregations of the model.
FINANCE_MODEL = MetricModel.from_dict(
    {
        "tables": [
            {
                "name": "customer_360",
                "dimensions": [
                    {"name": n}
                    for n in (
                        "customer_id", "customer_name", "city", "country", "employment_status", "customer_segment",
                    )
                ],
                "time_dimensions": [{"name": "signup_date"}],
                "measures": [
                    {"name": "total_balance", "default_aggregation": "sum"},
                    {"name": "total_transactions", "default_aggregation": "sum"},
                    {"name": "total_spent", "default_aggregation": "sum"},
                    {"name": "latest_risk_score", "default_aggregation": "avg"},
                    {"name": "total_tickets", "default_aggregation": "sum"},
                    {"name": "annual_income", "default_aggregation": "avg"},
                    {"name": "credit_score", "default_aggregation": "avg"},
                    {"name": "customer_count", "expr": "1", "default_aggregation": "sum"},
                ],
            },
            {
                "name": "daily_financial_metrics",
                "dimensions": [{"name": "metric_date"}],
                "time_dimensions": [{"name": "metric_date_ts", "expr": "CAST(metric_date AS TIMESTAMP)"}],
                "measures": [
                    {"name": "total_transactions", "default_aggregation": "sum"},
                    {"name": "total_volume", "default_aggregation": "sum"},
                    {"name": "avg_transaction", "default_aggregation": "avg"},
                    {"name": "unique_customers", "default_aggregation": "sum"},
                    {"name": "flagged_count", "default_aggregation": "sum"},
                    {"name": "flagged_rate", "default_aggregation": "avg"},
                ],
            },
            {
                "name": "channel_performance",
                "dimensions": [{"name": "channel"}, {"name": "metric_date"}],
                "time_dimensions": [{"name": "metric_date_ts", "expr": "CAST(metric_date AS TIMESTAMP)"}],
                "measures": [
                    {"name": "transaction_count", "default_aggregation": "sum"},
                    {"name": "total_volume", "default_aggregation": "sum"},
                    {"name": "avg_amount", "default_aggregation": "avg"},
                    {"name": "unique_customers", "default_aggregation": "sum"},
                ],
            },
            {
                "name": "risk_dashboard",
                "dimensions": [{"name": n} for n in ("customer_id", "customer_name", "risk_tier")],
                "measures": [
                    {"name": "latest_risk_score", "default_aggregation": "avg"},
                    {"name": "credit_score", "default_aggregation": "avg"},
                    {"name": "total_balance", "default_aggregation": "sum"},
                    {"name": "customer_count", "expr": "1", "default_aggregation": "sum"},
                ],
            },
        ]
    }
)
