"""CSV records that can't be used, kept apart for inspection.

Every record carries where it begins through the parser. One scan lands all of them: those that
have as many fields as the header and values that fit their types as rows, the others as raw text
with a reason. Rows and quarantined records together are the input's records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .files import CSV_OPTIONS, as_list
from .quoted import quoted_records

WRONG_WIDTH, WRONG_VALUE = "number of fields", "value"


@dataclass(frozen=True)
class Intake:
    """``rows`` are usable; ``broken`` has ``path, split_start, line, reason, columns, record``.

    ``split_start`` is the first byte of the split in which the record begins, ``line`` its line
    within the split, ``columns`` those whose values don't fit.
    """

    rows: DataFrame
    broken: DataFrame


def read_csv_apart(
    spark: SparkSession, paths: str | Sequence[str], columns: Mapping[str, str], folder: str | None = None
) -> Intake:
    """Named columns of CSV files, cast to the given types, and the records that don't fit, landed below
    ``folder``."""
    paths = as_list(paths)
    folder = folder or scratch_path(spark, "intake")
    header, records = quoted_records(spark, paths, CSV_OPTIONS)
    missing = [name for name in columns if name not in header]
    if missing:
        raise ValueError(f"{', '.join(paths)}: columns not found: {', '.join(missing)}")
    odd = "reportlens_odd"
    schema = ", ".join(f"`{name}` string" for name in [*header, odd])
    parser = {**CSV_OPTIONS, "mode": "PERMISSIVE", "header": "false", "multiLine": "true", "columnNameOfCorruptRecord": odd}
    parsed = records.withColumn("fields", F.from_csv("record", schema, parser))
    values = {name: F.col("fields")[name].try_cast(kind) for name, kind in columns.items()}
    failed = F.array_compact(
        F.array(*[F.when(F.col("fields")[n].isNotNull() & v.isNull(), F.lit(n)) for n, v in values.items()])
    )
    wrong_width = F.col("fields")[odd].isNotNull()
    judged = parsed.withColumn("failed", F.when(wrong_width, F.array().cast("array<string>")).otherwise(failed)).withColumn(
        "reason", F.when(wrong_width, WRONG_WIDTH).when(F.size("failed") > 0, WRONG_VALUE)
    )
    landed = judged.select(
        F.struct(*[v.alias(n) for n, v in values.items()]).alias("values"),
        "file",
        "split_start",
        "line",
        "reason",
        F.col("failed").alias("columns"),
        F.when(F.col("reason").isNotNull(), F.col("record")).alias("record"),
        F.col("reason").isNull().alias("usable"),
    )
    landed.write.partitionBy("usable").parquet(folder)
    stored = spark.read.schema(landed.schema).parquet(folder)
    # One row per file.
    names = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("path"), F.xxhash64("_metadata.file_path").alias("file")
    )
    broken = stored.where("not usable").join(names, "file", "left")
    return Intake(
        stored.where("usable").select("values.*"),
        broken.select("path", "split_start", "line", "reason", "columns", "record"),
    )
