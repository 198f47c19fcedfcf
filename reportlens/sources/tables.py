"""Catalog and relational tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..rules import CSV_SUFFIX, OUTPUT_STEMS
from .files import path_exists, read_result_csv

# Columns of the three result files, in file order.
RESULT_SCHEMAS = {
    "symptoms": (
        "manufacturer string, symptom string, total_reports bigint, deaths bigint,"
        " hospitalizations bigint, `__time` string"
    ),
    "severity": (
        "age_group string, manufacturer string, total_cases bigint, deaths bigint,"
        " hospitalizations bigint, avg_age double, death_rate double, hospital_rate double,"
        " severe_rate double, severe_cases bigint, er_visits bigint, VAX_MANU_CLEAN string,"
        " `__time` string"
    ),
    "geographic": (
        "state string, manufacturer string, total_reports bigint, deaths bigint,"
        " hospitalizations bigint, avg_age double, death_rate double, hospital_rate double,"
        " er_visits bigint, VAX_MANU_CLEAN string, `__time` string"
    ),
}
# End of fixed values.


def read_table(
    spark: SparkSession,
    name: str,
    url: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A catalog table, or a table behind a JDBC url.

    For a large JDBC table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in ``options`` so that it is read in parallel.
    """
    if url is None:
        return spark.table(name)
    return spark.read.format("jdbc").options(url=url, dbtable=name, **(options or {})).load()


def write_table(
    df: DataFrame,
    name: str,
    url: str | None = None,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Replace a catalog table (at ``path`` if given), or a table behind a JDBC url."""
    writer = df.write.mode("overwrite").options(**(options or {}))
    if url is None:
        writer.options(**({"path": path} if path else {})).saveAsTable(name)
    else:
        writer.format("jdbc").options(url=url, dbtable=name).save()


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table or a registered dataset; an absent one is not an error."""
    spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def register(df: DataFrame, name: str) -> DataFrame:
    """Publish or refresh a dataset under ``name`` for SQL and chart queries."""
    df.createOrReplaceTempView(name)
    return df


def load_results(
    spark: SparkSession,
    out_dir: str,
    analyses: Sequence[str] = tuple(OUTPUT_STEMS),
    url: str | None = None,
    options: Mapping[str, str] | None = None,
    on_missing: str = "skip",
) -> dict[str, bool]:
    """Load result files into their tables, replacing what is there.

    Returns which tables were loaded. A missing file is skipped, or raises with
    ``on_missing="fail"``.
    """
    loaded = {}
    for analysis in analyses:
        stem, table, _ = OUTPUT_STEMS[analysis]
        path = f"{out_dir.rstrip('/')}/{stem}{CSV_SUFFIX}"
        loaded[table] = path_exists(spark, path)
        if loaded[table]:
            write_table(read_result_csv(spark, path, RESULT_SCHEMAS[analysis]), table, url, options)
        elif on_missing == "fail":
            raise FileNotFoundError(path)
    return loaded
