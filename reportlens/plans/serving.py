"""Chart-style queries and SQL over the published datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import OUTPUT_STEMS

AGGREGATES = {
    "SUM": F.sum,
    "AVG": F.avg,
    "MIN": F.min,
    "MAX": F.max,
    "COUNT": F.count,
    "COUNT_DISTINCT": F.count_distinct,
}


@dataclass(frozen=True)
class Metric:
    aggregate: str
    column: str
    label: str

    def expression(self) -> Column:
        return AGGREGATES[self.aggregate.upper()](F.col(self.column)).alias(self.label)


@dataclass(frozen=True)
class ChartSpec:
    """Group, aggregate, then optionally sort by the first metric and keep the top rows."""

    dataset: str
    group_by: tuple[str, ...]
    metrics: tuple[Metric, ...]
    row_limit: int | None = None
    order_desc: bool = False

    @classmethod
    def from_params(cls, dataset: str, params: Mapping) -> ChartSpec:
        """Read a chart's parameter document, with one ``metric`` or a list of ``metrics``."""
        declared = params.get("metrics") or [params["metric"]]
        return cls(
            dataset=dataset,
            group_by=tuple(params["groupby"]),
            metrics=tuple(
                Metric(m["aggregate"], m["column"]["column_name"], m["label"]) for m in declared
            ),
            row_limit=params.get("row_limit"),
            order_desc=params.get("order_desc", False),
        )


SYMPTOMS, SEVERITY, GEOGRAPHIC = (OUTPUT_STEMS[k][1] for k in ("symptoms", "severity", "geographic"))

# The four dashboard charts with their labels.
CHARTS = {
    "reports_by_manufacturer": ChartSpec(
        SYMPTOMS, ("manufacturer",), (Metric("SUM", "total_reports", "Total Reportes"),)
    ),
    "top_symptoms": ChartSpec(
        SYMPTOMS, ("symptom",), (Metric("SUM", "total_reports", "Total Reportes"),), 15, True
    ),
    "hospitalizations_by_age": ChartSpec(
        SEVERITY,
        ("age_group",),
        (Metric("SUM", "hospitalizations", "Hospitalizaciones"),),
        order_desc=True,
    ),
    "reports_by_state": ChartSpec(
        GEOGRAPHIC, ("state",), (Metric("SUM", "total_reports", "Total Reportes"),), 15, True
    ),
}
# End of fixed values.


def chart_query(
    source: SparkSession | DataFrame, spec: ChartSpec, filters: Sequence[Column | str] = ()
) -> DataFrame:
    """Answer a chart from a registered dataset, or from a given DataFrame.

    Filters apply before aggregation. Group columns break ties, so a top list is stable.
    """
    df = source if isinstance(source, DataFrame) else source.table(spec.dataset)
    for condition in filters:
        df = df.where(condition)
    result = df.groupBy(*spec.group_by).agg(*[m.expression() for m in spec.metrics])
    if spec.order_desc or spec.row_limit:
        first = F.col(f"`{spec.metrics[0].label}`")
        result = result.orderBy(first.desc() if spec.order_desc else first.asc(), *spec.group_by)
    return result.limit(spec.row_limit) if spec.row_limit else result


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Ad-hoc SQL with named parameters (``:name``) over the registered datasets."""
    return spark.sql(text, args=dict(args or {}))
