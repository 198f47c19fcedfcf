"""Clean-up of vector tables, shared by the two searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, id_col: str, vector_col: str, zero_ok: bool, every_row: bool = False) -> DataFrame:
    """``id`` long and ``v`` array<double>: the vectors that take part in a search.

    Left out are rows with a null id, null or empty vectors, vectors with a null or non-finite
    component, all-zero ones unless ``zero_ok``, and vectors of another dimension than most
    (of equally frequent dimensions the larger counts). Of rows that share an id, the one with
    the smallest vector stays. Other columns are ignored. With ``every_row`` rows that share an id
    all stay, and so do those with a null id.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    ).where((F.col("id").isNotNull() | F.lit(every_row)) & v.isNotNull() & (F.size(v) > 0) & finite)
    if not zero_ok:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dimension = common["n"] if common else 0
    rows = rows.where(F.size(v) == dimension)
    return rows if every_row else rows.groupBy("id").agg(F.min("v").alias("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
