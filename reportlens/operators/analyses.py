"""Aggregate analyses.

All analyses roll up one small *tally*: measures per manufacturer, symptom and age group
(and any extra report dimension). ``report_tally`` computes it straight from the three
tables; ``tally_rows`` computes the same columns from an already joined table.
Rates and means are always recomputed from additive columns, never summed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bucketize, null_safe_sum, rate
from ..rules import DEFAULT_RULES, Rules
from .curate import (
    dose_counts,
    join_symptoms,
    maker_column,
    report_facts,
    rows_per_maker,
    symptom_counts,
)

MEASURES = ("n_rows", "deaths", "hospitalizations", "age_sum", "age_rows")


def age_group(rules: Rules = DEFAULT_RULES) -> Column:
    return bucketize("age_clean", rules.age_breaks, rules.age_labels, rules.age_unknown)


def fact_measures(count_name: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias(count_name),
        null_safe_sum("died_flag").alias("deaths"),
        null_safe_sum("hospital_flag").alias("hospitalizations"),
        F.coalesce(F.sum("age_clean"), F.lit(0.0)).alias("age_sum"),
        F.count("age_clean").alias("age_rows"),
    ]


def tally_rows(
    curated: DataFrame, rules: Rules = DEFAULT_RULES, extra: Sequence[str] = ()
) -> DataFrame:
    """Tally of a row-level curated table."""
    return (
        curated.withColumn("age_group", age_group(rules))
        .groupBy("manufacturer", "symptom", "age_group", *extra)
        .agg(*fact_measures("n_rows"))
    )


def report_tally(
    reports: DataFrame,
    symptoms: DataFrame,
    vaccines: DataFrame,
    rules: Rules = DEFAULT_RULES,
    extra: Sequence[str] = (),
    salt_buckets: int = 1,
) -> DataFrame:
    """Tally of ``curate(reports, symptoms, vaccines)`` without joining row to row.

    Each table is folded per id before the join, and a joined row contributes the product
    of its counts. ``extra`` names report columns to keep as further dimensions.
    """
    key = rules.id_col
    dims = ["age_group", *extra]
    counted_reports = (
        report_facts(reports, rules, extra)
        .withColumn("age_group", age_group(rules))
        .groupBy(key, *dims)
        .agg(*fact_measures("report_rows"))
    )
    exposures = counted_reports.join(dose_counts(vaccines, rules), key)
    joined = join_symptoms(exposures, symptom_counts(symptoms, rules), rules, salt_buckets)

    sources = dict(zip(MEASURES, ("report_rows", *MEASURES[1:])))
    doses = [maker_column(i) for i in range(len(rules.makers))]
    wide = joined.groupBy("symptom", *dims).agg(
        *[
            F.sum(F.col(source) * F.col("symptom_rows") * F.col(dose)).alias(f"{name}_{dose}")
            for name, source in sources.items()
            for dose in doses
        ]
    )
    measures = {
        name: {maker: F.col(f"{name}_{dose}") for maker, dose in zip(rules.makers, doses)}
        for name in MEASURES
    }
    tally = rows_per_maker(wide, rules, ["symptom", *dims], measures)
    return tally.where(F.col("n_rows") > 0).select("manufacturer", "symptom", *dims, *MEASURES)


def roll_up(tally: DataFrame, keys: Sequence[str], count_name: str) -> DataFrame:
    """Counts and outcome sums of a tally per ``keys``, with the mean age of known ages."""
    return tally.groupBy(*keys).agg(
        F.sum("n_rows").alias(count_name),
        F.sum("deaths").alias("deaths"),
        F.sum("hospitalizations").alias("hospitalizations"),
        F.try_divide(F.sum("age_sum"), F.sum("age_rows")).alias("avg_age"),
    )


def symptoms_by_manufacturer(tally: DataFrame, run_ts: str) -> DataFrame:
    """Reports, deaths and hospitalizations per manufacturer and symptom, largest first."""
    return (
        roll_up(tally, ["manufacturer", "symptom"], "total_reports")
        .drop("avg_age")
        .withColumn("__time", F.lit(run_ts))
        .orderBy(F.desc("total_reports"), "manufacturer", "symptom")
    )


def severity_by_age(tally: DataFrame, run_ts: str, scale: float = 100.0) -> DataFrame:
    """Outcome counts and rates per age group and manufacturer.

    A row with both outcomes counts twice as severe, so ``severe_rate`` can pass 100.
    """
    severe = F.col("deaths") + F.col("hospitalizations")
    return roll_up(tally, ["age_group", "manufacturer"], "total_cases").select(
        "*",
        rate("deaths", "total_cases", scale).alias("death_rate"),
        rate("hospitalizations", "total_cases", scale).alias("hospital_rate"),
        rate(severe, "total_cases", scale).alias("severe_rate"),
        severe.alias("severe_cases"),
        F.lit(0).alias("er_visits"),
        F.col("manufacturer").alias("VAX_MANU_CLEAN"),
        F.lit(run_ts).alias("__time"),
    )


def manufacturer_totals(tally: DataFrame) -> DataFrame:
    return roll_up(tally, ["manufacturer"], "total_reports")


def reports_by_state(
    tally: DataFrame, state_col: str, run_ts: str, scale: float = 100.0
) -> DataFrame:
    """Outcomes per real state and manufacturer; the tally must carry ``state_col``."""
    return roll_up(tally, [state_col, "manufacturer"], "total_reports").select(
        F.col(state_col).alias("state"),
        "manufacturer",
        "total_reports",
        "deaths",
        "hospitalizations",
        "avg_age",
        rate("deaths", "total_reports", scale).alias("death_rate"),
        rate("hospitalizations", "total_reports", scale).alias("hospital_rate"),
        F.lit(0).alias("er_visits"),
        F.col("manufacturer").alias("VAX_MANU_CLEAN"),
        F.lit(run_ts).alias("__time"),
    )


#: Types of declared metrics, and that of the field each reads.
METRIC_TYPES = {"longSum": "bigint", "doubleSum": "double", "HLLSketchBuild": "string", "quantilesDoublesSketch": "double"}
#: Accuracy of sketches: 2^12 registers (standard error 1.6 %), and 200 levels (rank error 1.33 %).
HLL_BITS, KLL_SIZE = 12, 200
METRIC_BUILDS = {
    "longSum": F.sum,
    "doubleSum": F.sum,
    "HLLSketchBuild": lambda c: F.hll_sketch_agg(c, HLL_BITS),
    "quantilesDoublesSketch": lambda c: F.kll_sketch_agg_double(c, KLL_SIZE),
}
#: How stored metrics are aggregated further.
METRIC_MERGES = {
    "longSum": F.sum,
    "doubleSum": F.sum,
    "HLLSketchBuild": F.hll_union_agg,
    "quantilesDoublesSketch": F.kll_merge_agg_double,
}
SKETCHES = frozenset({"HLLSketchBuild", "quantilesDoublesSketch"})
#: Fields whose sum means nothing.
RATIOS = frozenset({"avg_age", "death_rate", "hospital_rate", "severe_rate"})


def aggregate_metrics(
    df: DataFrame,
    dimensions: Sequence[str],
    metrics: Sequence[Mapping[str, str]],
    rollup: bool = False,
    time_cols: Sequence[str] = (),
) -> DataFrame:
    """Apply declared metrics ``{name, type, fieldName}`` over text dimensions.

    Without ``rollup`` rows are only projected, renamed and cast. With it they are summed
    per dimensions and time; ``RATIOS`` are refused, as they have to be derived from the sums.
    Sketches of distinct values and of quantiles exist only in a rollup.
    """
    sketches = sorted(metric["name"] for metric in metrics if metric["type"] in SKETCHES)
    if sketches and not rollup:
        raise ValueError(f"only a rollup has sketches: {', '.join(sketches)}")
    refused = sorted({metric["fieldName"] for metric in metrics} & RATIOS)
    if rollup and refused:
        raise ValueError(f"a rollup can't sum {', '.join(refused)}")
    fields = [
        (metric["name"], F.col(metric["fieldName"]).cast(METRIC_TYPES[metric["type"]]), METRIC_BUILDS[metric["type"]])
        for metric in metrics
    ]
    texts = [F.col(name).cast("string").alias(name) for name in dimensions]
    if not rollup:
        return df.select(*time_cols, *texts, *[value.alias(name) for name, value, _ in fields])
    return df.groupBy(*time_cols, *texts).agg(*[build(value).alias(name) for name, value, build in fields])


def merge_metrics(
    stored: DataFrame, dimensions: Sequence[str], metrics: Sequence[Mapping[str, str]], time_cols: Sequence[str] = ()
) -> DataFrame:
    """Roll a rollup up further: sums add up, sketches are merged, so nothing is counted twice."""
    merged = [METRIC_MERGES[metric["type"]](F.col(metric["name"])).alias(metric["name"]) for metric in metrics]
    return stored.groupBy(*time_cols, *dimensions).agg(*merged)


def distinct_estimate(sketch: str) -> Column:
    """Number of distinct values that went into a sketch, about."""
    return F.hll_sketch_estimate(sketch)


def quantile_estimate(sketch: str, rank: float) -> Column:
    """The value of about the given rank (0 to 1) of those that went into a sketch."""
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(rank))
