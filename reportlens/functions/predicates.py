"""Row predicates. Each keeps only rows where it is TRUE, so NULL never passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import Rules
from .columns import as_column, clean_text, contains_pattern, map_category


def in_population(
    type_col: Column | str, maker_col: Column | str, type_pattern: str, makers: Sequence[str]
) -> Column:
    """Cleaned type matches the pattern, or cleaned manufacturer is one of ``makers``."""
    return contains_pattern(type_col, type_pattern) | as_column(maker_col).isin(list(makers))


def valid_text(col: Column | str, min_length: int) -> Column:
    """Present and longer than ``min_length`` characters."""
    return F.coalesce(F.length(as_column(col)) > min_length, F.lit(False))


def deny_regex(col: Column | str, pattern: str) -> Column:
    """Pattern does not match anywhere in the text."""
    return ~contains_pattern(col, pattern)


def deny_exact(col: Column | str, values: Sequence[str]) -> Column:
    return ~as_column(col).isin(list(values))


def allow_list(col: Column | str, values: Sequence[str]) -> Column:
    return as_column(col).isin(list(values))


def select_where(
    df: DataFrame, columns: Sequence[Column | str], condition: Column
) -> DataFrame:
    """Compute ``columns``, then keep the rows that meet a condition on them.

    Catalyst would move the filter below the projection and repeat a column's expression for
    every use in the condition. A filter that also looks at the task number cannot move, so
    each expression runs once per row.
    """
    computed = df.select(*columns, F.spark_partition_id().alias("task_number"))
    return computed.where(condition).where(F.col("task_number") >= 0).drop("task_number")


def clean_curated(df: DataFrame, rules: Rules) -> DataFrame:
    """Clean an already joined table: standard manufacturer names, no excluded symptoms.

    Unlike the cleaning done before the joins, an unknown manufacturer keeps its own name
    until the allow-list drops it, and the symptom text itself is not changed.
    """
    texts = df.select(
        rules.id_col,
        "died_flag",
        "hospital_flag",
        "age_clean",
        "symptom",
        F.upper("symptom").alias("upper_symptom"),
        clean_text("manufacturer").alias("maker_text"),
    )
    maker = map_category("maker_text", rules.maker_rules, F.col("maker_text"))
    kept = select_where(
        texts,
        ["*", maker.alias("manufacturer")],
        allow_list("manufacturer", rules.makers)
        & deny_regex("upper_symptom", rules.curated_deny_pattern)
        & (F.length("symptom") > rules.symptom_min_length)
        & deny_exact("upper_symptom", rules.symptom_deny_terms),
    )
    return kept.drop("upper_symptom", "maker_text")
