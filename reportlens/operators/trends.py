"""Trend and alert reports on top of the tally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .analyses import roll_up


def reports_per_period(
    tally: DataFrame, date_col: str, period: str = "month", keys: Sequence[str] = ("manufacturer",)
) -> DataFrame:
    """Joined report rows and outcomes per calendar period; the tally must carry ``date_col``."""
    periods = tally.withColumn("period", F.date_trunc(period, date_col).cast("date"))
    return roll_up(periods, ["period", *keys], "total_reports")


def evolution(
    counts: DataFrame,
    measure: str,
    keys: Sequence[str],
    period: str = "month",
    span: int = 3,
    period_col: str = "period",
) -> DataFrame:
    """How a measure per key moves from period to period, over one calendar for all keys.

    Periods without reports count 0, from the first to the last period of all keys. ``previous``
    and ``change`` are NULL in the first, ``change_rate`` also after a period of 0;
    ``moving_mean`` is over the last ``span`` periods, fewer at the start. A key has as many rows
    as the calendar has periods, however many reports.
    """
    first, last = counts.agg(F.min(period_col), F.max(period_col)).first()
    if first is None:
        first = last = F.lit(None)
    step = F.expr(f"interval 1 {period}")
    calendar = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), step)
    dense = counts.select(*keys).distinct().select(*keys, F.explode(calendar).alias(period_col))
    known = counts.groupBy(*keys, period_col).agg(F.sum(measure).alias(measure))
    on = [dense[name].eqNullSafe(known[name]) for name in keys] + [dense[period_col] == known[period_col]]
    filled = dense.join(known, on, "left").select(
        *[dense[name] for name in keys], dense[period_col], F.coalesce(known[measure], F.lit(0)).alias(measure)
    )
    order = Window.partitionBy(*keys).orderBy(period_col)
    recent = order.rowsBetween(1 - span, Window.currentRow)
    return (
        filled.withColumn("previous", F.lag(measure).over(order))
        .withColumn("moving_mean", F.avg(measure).over(recent))
        .withColumn("change", F.col(measure) - F.col("previous"))
        .withColumn("change_rate", F.try_divide(F.col("change").cast("double"), F.col("previous").cast("double")))
    )


def alerts(df: DataFrame, limits: Sequence[tuple[str, str, float]], keys: Sequence[str]) -> DataFrame:
    """One row per key and exceeded limit; a limit is ``(name, metric column, threshold)``."""

    def exceeded(name: str, metric: str, threshold: float) -> Column:
        value = F.col(metric).cast("double")
        alert = F.struct(
            F.lit(name).alias("alert"), value.alias("value"), F.lit(threshold).alias("threshold")
        )
        return F.when(value > threshold, alert)

    raised = F.array_compact(F.array(*[exceeded(*limit) for limit in limits]))
    return df.select(*keys, F.inline(raised))
