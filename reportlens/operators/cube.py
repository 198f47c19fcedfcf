"""All cross filters of a dashboard from one pass over the tally."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rate

DIMENSIONS = ("manufacturer", "symptom", "age_group")


def all_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset of the dimensions, the empty one included."""
    return [chosen for n in range(len(dims) + 1) for chosen in combinations(dims, n)]


def dashboard_cube(
    tally: DataFrame,
    dims: Sequence[str] = DIMENSIONS,
    sets: Sequence[Sequence[str]] | None = None,
    scale: float = 100.0,
) -> DataFrame:
    """Counts, mean age and rates per grouping set (all of them by default).

    ``grouping_id`` has a bit for each dimension that is summed over, the last dimension's lowest,
    and tells a summed dimension from one whose value is NULL. Means and rates come from sums, so
    each set's are right by themselves.
    """
    sets = all_sets(dims) if sets is None else sets
    wrong = sorted({name for chosen in sets for name in chosen} - set(dims))
    if wrong:
        raise ValueError(f"not among the dimensions: {', '.join(wrong)}")
    grouped = tally.groupingSets([[F.col(n) for n in chosen] for chosen in sets], *[F.col(n) for n in dims]).agg(
        F.grouping_id().cast("bigint").alias("grouping_id"),
        F.sum("n_rows").alias("total_reports"),
        F.sum("deaths").alias("deaths"),
        F.sum("hospitalizations").alias("hospitalizations"),
        F.try_divide(F.sum("age_sum"), F.sum("age_rows")).alias("avg_age"),
    )
    return grouped.where(F.col("total_reports").isNotNull()).select(
        "*",
        rate("deaths", "total_reports", scale).alias("death_rate"),
        rate("hospitalizations", "total_reports", scale).alias("hospital_rate"),
    )


def chart_slice(cube: DataFrame, dims: Sequence[str], keep: Sequence[str], filters: dict[str, str] | None = None) -> DataFrame:
    """The rows of a chart: grouped by ``keep`` under equality ``filters`` on other dimensions."""
    filters = filters or {}
    held = [*keep, *filters]
    bits = sum(1 << (len(dims) - 1 - place) for place, name in enumerate(dims) if name not in held)
    rows = cube.where(F.col("grouping_id") == bits)
    for name, value in filters.items():
        rows = rows.where(F.col(name) == value)
    return rows.drop("grouping_id", *[name for name in dims if name not in keep])
