"""Take in extract files as they arrive and keep the tally up to date.

The three tables arrive separately and a symptom row may come long after its report, so
there is no event time to join on. A file stream therefore only lands new files, each once,
as Parquet batches, whose rows lie in buckets by the hash of their id. All rows of an id are in one
bucket of each batch, so the tally of a bucket needs no other bucket. ``refresh`` reads only the
buckets in which new rows fell, tallies each of them anew and leaves the others' tallies as they
are. Late rows are correct however late they are, and nothing needs a watermark.

Every step can be repeated: a batch replaces its own folder, and a version counts only after its
manifest is written, one file that says which batches it includes and which version holds each
bucket's tally.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analyses import MEASURES, report_tally
from ..rules import DEFAULT_RULES, Rules
from ..sources.files import file_sizes, path_exists, read_csv

KINDS = ("reports", "symptoms", "vaccines")
TALLY_KEYS = ("manufacturer", "symptom", "age_group")
#: Buckets of ids. A store keeps the number it was begun with; large ones should begin with more.
BUCKETS = 64
BUCKET = "id_bucket"
MANIFEST = "version bigint, kind string, batch bigint, bucket int, tally_version string"


def schemas(rules: Rules) -> dict[str, dict[str, str]]:
    return dict(zip(KINDS, (rules.report_schema, rules.symptom_schema, rules.vaccine_schema)))


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of an id; rows without an id are in bucket 0."""
    return F.coalesce(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"), F.lit(0))


def land_new_files(
    spark: SparkSession,
    source: str,
    store: str,
    kind: str,
    rules: Rules = DEFAULT_RULES,
    mode: str = "FAILFAST",
    files_per_batch: int = 1000,
    buckets: int = BUCKETS,
) -> None:
    """Land the files of ``source`` that no earlier call has landed, then return.

    The stream hands over file names only, at most ``files_per_batch`` at a time; executors
    read the contents through the same CSV reader as a batch run. The rebalance hint gathers
    each bucket into few files and lets AQE split one that an id dominates.
    """
    schema = schemas(rules)[kind]

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in batch.select("path").collect()]
        if paths:
            rows = read_csv(batch.sparkSession, paths, schema, mode)
            bucketed = rows.withColumn(BUCKET, bucket_of(F.col(rules.id_col), buckets))
            out = bucketed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
            out.parquet(f"{store}/{kind}/batch={batch_id}")

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(source)
    )
    (
        arrivals.select("path")
        .writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", f"{store}/progress/{kind}")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def landed(spark: SparkSession, store: str, kind: str) -> DataFrame | None:
    path = f"{store}/{kind}"
    if not path_exists(spark, f"{path}/batch=*/{BUCKET}=*/*.parquet"):
        return None
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def latest_manifest(spark: SparkSession, store: str) -> DataFrame | None:
    """The last complete manifest: the batches it includes, and each bucket's tally version."""
    files = f"{store}/manifests/*/*.parquet"
    if not path_exists(spark, files):
        return None
    last = file_sizes(spark, files).agg(F.max(F.regexp_extract("path", "manifests/([^/]+)/", 1))).first()[0]
    return spark.read.schema(MANIFEST).parquet(f"{store}/manifests/{last}")


def version(spark: SparkSession, store: str) -> int:
    """How often the tally was refreshed."""
    manifest = latest_manifest(spark, store)
    return 0 if manifest is None else manifest.agg(F.max("version")).first()[0]


def bucket_tallies(spark: SparkSession, store: str, held: dict[int, str]) -> DataFrame | None:
    """The tallies of the given buckets, each from the version that holds it."""
    folders = [f"{store}/tally/version={v}/{BUCKET}={bucket}" for bucket, v in sorted(held.items())]
    if not folders:
        return None
    return spark.read.option("basePath", f"{store}/tally").parquet(*folders).drop("version")


def tally_schema() -> str:
    sums = ", ".join(f"{name} {'double' if name == 'age_sum' else 'bigint'}" for name in MEASURES)
    return f"{', '.join(f'{name} string' for name in TALLY_KEYS)}, {sums}"


def read_tally(spark: SparkSession, store: str) -> DataFrame | None:
    """The tally over all buckets as of the last refresh."""
    manifest = latest_manifest(spark, store)
    if manifest is None:
        return None
    held = {row.bucket: row.tally_version for row in manifest.where("bucket is not null").collect()}
    tallies = bucket_tallies(spark, store, held)
    if tallies is None:
        return spark.createDataFrame([], tally_schema())
    return tallies.groupBy(*TALLY_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def batches_of(df: DataFrame) -> set[int]:
    return {row.batch for row in df.select("batch").distinct().collect()}


def rows_to_tally(tables: dict[str, DataFrame], fresh: dict[str, set[int]]) -> tuple[list[int], dict[str, DataFrame]]:
    """The buckets that the fresh batches touch, and all rows in them; other buckets aren't read."""
    touched: set[int] = set()
    for kind, df in tables.items():
        new = df.where(F.col("batch").isin(sorted(fresh[kind])))
        touched |= {row[0] for row in new.select(BUCKET).distinct().collect()}  # at most a row per bucket
    buckets = sorted(touched)
    return buckets, {kind: df.where(F.col(BUCKET).isin(buckets)) for kind, df in tables.items()}


def refresh(spark: SparkSession, store: str, rules: Rules = DEFAULT_RULES) -> DataFrame | None:
    """Bring the stored tally up to date with the landed batches and return it.

    NULL until all three tables have rows.
    """
    tables = {kind: landed(spark, store, kind) for kind in KINDS}
    if any(df is None for df in tables.values()):
        return None
    manifest = latest_manifest(spark, store)
    known = [] if manifest is None else manifest.collect()  # a row per batch and bucket
    number = max((row.version for row in known), default=0) + 1
    held = {row.bucket: row.tally_version for row in known if row.bucket is not None}
    included = {kind: {row.batch for row in known if row.kind == kind} for kind in KINDS}
    present = {kind: batches_of(df) for kind, df in tables.items()}
    if present == included:
        return read_tally(spark, store)

    fresh = {kind: present[kind] - included[kind] for kind in KINDS}
    buckets, rows = rows_to_tally(tables, fresh)
    reports = rows["reports"].drop("batch")
    symptoms, vaccines = (rows[kind].drop("batch", BUCKET) for kind in ("symptoms", "vaccines"))
    tally = report_tally(reports, symptoms, vaccines, rules, extra=(BUCKET,))
    name = f"{number:09}-{uuid.uuid4().hex}"
    tally.write.partitionBy(BUCKET).parquet(f"{store}/tally/version={name}")
    written = spark.read.schema(tally.schema).parquet(f"{store}/tally/version={name}")
    filled = {row[0] for row in written.select(BUCKET).distinct().collect()}
    held = {b: v for b, v in held.items() if b not in buckets} | {b: name for b in filled}
    lines = [(number, kind, batch, None, None) for kind in KINDS for batch in sorted(present[kind])]
    lines += [(number, None, None, bucket, v) for bucket, v in sorted(held.items())]
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.parquet(f"{store}/manifests/{name}")
    return read_tally(spark, store)
