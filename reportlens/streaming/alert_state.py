"""Alerts that last over the batches of a stream.

Each batch's state is a table of its own: the alerts that are raised, still on, or cleared by that
batch. It follows from the state of the batch before and the batch's own measures, so a batch that
is replayed writes the same table again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import file_sizes, path_exists

RAISED, ON, CLEARED = "raised", "on", "cleared"
Limit = tuple[str, str, float]


def state_schema(measured: DataFrame, keys: Sequence[str]) -> str:
    kinds = dict(measured.dtypes)
    named = ", ".join(f"`{name}` {kinds[name]}" for name in keys)
    return f"{named}, alert string, status string, value double, threshold double, since bigint"


def last_batch(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Number of the last batch with a state, below ``before`` if given."""
    files = f"{path}/batch=*/*.parquet"
    if not path_exists(spark, files):
        return None
    number = F.regexp_extract("path", r"batch=(\d+)", 1).cast("bigint")
    known = file_sizes(spark, files).select(number.alias("batch"))
    return (known if before is None else known.where(F.col("batch") < before)).agg(F.max("batch")).first()[0]


def next_state(measured: DataFrame, earlier: DataFrame, limits: Sequence[Limit], keys: Sequence[str], batch: int) -> DataFrame:
    """The state after a batch.

    A measured key above a limit is raised, or still on if it was before; one that was on and no
    longer is above, or has no value any more, is cleared. Keys that the batch doesn't measure
    stay on. Alerts cleared before are gone.
    """
    tests = [
        F.struct(F.lit(name).alias("alert"), F.col(metric).cast("double").alias("now"), F.lit(float(limit)).alias("limit"))
        for name, metric, limit in limits
    ]
    current = measured.select(*keys, F.inline(F.array(*tests)))
    active = earlier.where(F.col("status") != CLEARED)
    on = [current[name].eqNullSafe(active[name]) for name in (*keys, "alert")]
    joined = current.join(active, on, "full")
    above = F.coalesce(F.col("now") > F.col("limit"), F.lit(False))
    was_on, seen = F.col("status").isNotNull(), F.col("limit").isNotNull()
    status = (
        F.when(seen & above & was_on, ON).when(seen & above, RAISED).when(seen & was_on, CLEARED).when(~seen, ON)
    )
    began = F.when(was_on & (F.col("status").isNotNull()), F.col("since")).otherwise(F.lit(batch).cast("bigint"))
    return joined.select(
        *[F.when(seen, current[name]).otherwise(active[name]).alias(name) for name in keys],
        F.when(seen, current["alert"]).otherwise(active["alert"]).alias("alert"),
        status.alias("status"),
        F.when(seen, F.col("now")).otherwise(F.col("value")).alias("value"),
        F.when(seen, F.col("limit")).otherwise(F.col("threshold")).alias("threshold"),
        began.alias("since"),
    ).where(F.col("status").isNotNull())


def keep_alerts(measured: DataFrame, path: str, limits: Sequence[Limit], keys: Sequence[str], batch: int) -> None:
    """Write the state after ``batch``; replaying the batch writes the same state."""
    spark, schema = measured.sparkSession, state_schema(measured, keys)
    before = last_batch(spark, path, batch)
    earlier = spark.createDataFrame([], schema) if before is None else spark.read.schema(schema).parquet(f"{path}/batch={before}")
    next_state(measured, earlier, limits, keys, batch).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_alerts(spark: SparkSession, path: str) -> DataFrame | None:
    """The state after the last batch."""
    last = last_batch(spark, path)
    return None if last is None else spark.read.parquet(f"{path}/batch={last}")


def watch(
    stream: DataFrame,
    measure: Callable[[DataFrame], DataFrame],
    path: str,
    limits: Sequence[Limit],
    keys: Sequence[str],
    progress: str,
) -> None:
    """Take in what a stream has, batch by batch: ``measure`` gives a row per key of a batch."""

    def handle(batch: DataFrame, number: int) -> None:
        keep_alerts(measure(batch), path, limits, keys, number)

    (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
