"""Input checks, profiles and rule reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import as_list, file_sizes, path_exists


def check_files(spark: SparkSession, paths: Sequence[str]) -> dict[str, float]:
    """Size in MB of every required path; raises ``FileNotFoundError`` for a missing one."""
    sizes = {}
    for path in as_list(paths):
        if not path_exists(spark, path):
            raise FileNotFoundError(path)
        total = file_sizes(spark, path).agg(F.sum("length")).first()[0] or 0
        sizes[path] = total / 1024 / 1024
    return sizes


def check_columns(df: DataFrame, names: Sequence[str], label: str = "input") -> None:
    """Raise when named columns are absent, as in a placeholder file without data."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{label}: columns not found: {', '.join(missing)}")


def check_not_empty(df: DataFrame, label: str = "input") -> None:
    """Raise when there is no row; stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"{label} has no rows")


def sample_shape(df: DataFrame, rows: int = 5) -> tuple[int, int]:
    """Height and width of the first rows, a cheap readability check."""
    return df.limit(rows).count(), len(df.columns)


def profile(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Row count and number of NULLs per key column, in one pass and one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name in key_columns],
    )


def rule_report(df: DataFrame, conditions: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows that pass and fail each named condition; all conditions share one pass."""
    names = [name for name, _ in conditions]
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(condition).alias(name) for name, condition in conditions],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"`{name}`").alias("passed"),
                (F.col("row_count") - F.col(f"`{name}`")).alias("failed"),
            )
            for name in names
        ]
    )
    return counted.select(F.inline(rows))


def check_outputs(spark: SparkSession, word: str = "vaers", minimum: int = 3) -> list[str]:
    """Names of the published datasets containing ``word``; raises if too few or one is empty."""
    names = sorted(t.name for t in spark.catalog.listTables() if word in t.name.lower())
    if len(names) < minimum:
        raise ValueError(f"expected {minimum} datasets named like {word!r}, found {names}")
    for name in names:
        check_not_empty(spark.table(name), name)
    return names
