"""Spread manufacturer totals over weighted places and check the resulting rows.

The places are simulated: the weights are fixed shares, no report's own state is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import default_if_falsy, guarded_ratio, int_share
from ..rules import DEFAULT_RULES, FALLBACK_STATES, STATE_WEIGHTS, Rules

DEFAULT_AGE = 45.0


def allocate_by_weights(
    totals: DataFrame,
    run_ts: str,
    weights: Sequence[tuple[str, float]] = STATE_WEIGHTS,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """One row per manufacturer and weighted state.

    Shares are truncated (at least one report per state), so they need not add up to the
    total. Rates divide the untruncated share of the outcome by the truncated report share.
    The weights travel inside the plan as a literal array: no join and no shuffle.
    """
    places = F.array(
        *[
            F.struct(F.lit(state).alias("state"), F.lit(float(factor)).alias("factor"))
            for state, factor in weights
        ]
    )
    spread = totals.where(F.col("manufacturer").isin(list(rules.makers))).select(
        "*", F.inline(places)
    )
    factor = F.col("factor")
    return spread.withColumn("share", int_share("total_reports", factor, 1)).select(
        "state",
        "manufacturer",
        F.col("share").alias("total_reports"),
        int_share("deaths", factor, 0).alias("deaths"),
        int_share("hospitalizations", factor, 0).alias("hospitalizations"),
        default_if_falsy("avg_age", DEFAULT_AGE).alias("avg_age"),
        guarded_ratio("deaths", factor, "share").alias("death_rate"),
        guarded_ratio("hospitalizations", factor, "share").alias("hospital_rate"),
        F.lit(0).alias("er_visits"),
        F.col("manufacturer").alias("VAX_MANU_CLEAN"),
        F.lit(run_ts).alias("__time"),
    )


def geographic_rules(rules: Rules = DEFAULT_RULES) -> list[tuple[str, Column]]:
    """Named conditions a geographic row must meet."""
    state = F.col("state")
    return [
        ("state is a country code", state != "US"),
        ("state is not two characters", F.length(state) == 2),
        ("state is not alphabetic", state.rlike(r"\A\p{L}+\z")),
        ("unknown manufacturer", F.col("manufacturer").isin(list(rules.makers))),
        ("no reports", F.col("total_reports") > 0),
    ]


def failed_rule(conditions: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first condition that is not TRUE, NULL where all hold."""
    passes = [(name, F.coalesce(condition, F.lit(False))) for name, condition in conditions]
    return F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in passes])


def split_valid(
    df: DataFrame, conditions: Sequence[tuple[str, Column]]
) -> tuple[DataFrame, DataFrame]:
    """Rows that meet all conditions, and the others with a ``reason`` column."""
    marked = df.withColumn("reason", failed_rule(conditions))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(
        F.col("reason").isNotNull()
    )


def fallback_rows(spark: SparkSession, run_ts: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Placeholder geographic rows, for demonstrations only; nothing calls this by default."""
    rows = [
        (state, maker, 100, 1, 5, 45.0, 1.0, 5.0, 0, maker, run_ts)
        for state in FALLBACK_STATES
        for maker in rules.makers
    ]
    return spark.createDataFrame(
        rows,
        "state string, manufacturer string, total_reports bigint, deaths bigint,"
        " hospitalizations bigint, avg_age double, death_rate double, hospital_rate double,"
        " er_visits int, VAX_MANU_CLEAN string, `__time` string",
    )
