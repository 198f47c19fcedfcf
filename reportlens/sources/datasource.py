"""Time-partitioned datasources described by a declarative spec.

A load writes its segments to a folder of its own; a manifest, written last as one file, says which
load holds each segment. Readers go by the latest manifest, so a load that breaks off midway, or
one under way, changes nothing for them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import EPOCH, iso_timestamp
from ..operators.analyses import METRIC_TYPES, aggregate_metrics
from ..rules import NDJSON_SUFFIX, OUTPUT_STEMS
from .files import file_sizes, path_exists, read_ndjson

TIME = "__time"


def long_sum(name: str, source: str | None = None) -> dict[str, str]:
    return {"name": name, "type": "longSum", "fieldName": source or name}


def distinct_sketch(name: str, source: str | None = None) -> dict[str, str]:
    return {"name": name, "type": "HLLSketchBuild", "fieldName": source or name}


def quantile_sketch(name: str, source: str | None = None) -> dict[str, str]:
    return {"name": name, "type": "quantilesDoublesSketch", "fieldName": source or name}


def double_sum(name: str, source: str | None = None) -> dict[str, str]:
    return {"name": name, "type": "doubleSum", "fieldName": source or name}


@dataclass(frozen=True)
class DatasourceSpec:
    """What to load: text dimensions, typed metrics and the time column.

    ``segment`` is the partition unit, ``day`` or ``month``.
    """

    name: str
    dimensions: tuple[str, ...]
    metrics: tuple[Mapping[str, str], ...] = field(hash=False)
    name_filter: str = "*.json"
    time_column: str = TIME
    time_missing: str = EPOCH
    segment: str = "day"
    rollup: bool = False

    @classmethod
    def from_ingestion(cls, ingestion: Mapping) -> DatasourceSpec:
        """Read an ingestion task document (``{"spec": {"dataSchema": ..., ...}}``)."""
        schema = ingestion["spec"]["dataSchema"]
        granularity, time = schema["granularitySpec"], schema["timestampSpec"]
        return cls(
            name=schema["dataSource"],
            dimensions=tuple(schema["dimensionsSpec"]["dimensions"]),
            metrics=tuple(schema["metricsSpec"]),
            name_filter=ingestion["spec"]["ioConfig"]["inputSource"]["filter"],
            time_column=time["column"],
            time_missing=time.get("missingValue", EPOCH),
            segment=granularity["segmentGranularity"].lower(),
            rollup=granularity["rollup"],
        )

    @property
    def source_schema(self) -> str:
        """Schema of the fields the spec reads from its input."""
        fields = {self.time_column: "string", **{name: "string" for name in self.dimensions}}
        fields |= {m["fieldName"]: METRIC_TYPES[m["type"]] for m in self.metrics}
        return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


# Dimensions and metrics of the three published datasources.
SYMPTOMS_SPEC = DatasourceSpec(
    name=OUTPUT_STEMS["symptoms"][2],
    name_filter=OUTPUT_STEMS["symptoms"][0] + NDJSON_SUFFIX,
    dimensions=("manufacturer", "symptom"),
    metrics=(long_sum("total_reports"), long_sum("deaths"), long_sum("hospitalizations")),
)
SEVERITY_SPEC = DatasourceSpec(
    name=OUTPUT_STEMS["severity"][2],
    name_filter=OUTPUT_STEMS["severity"][0] + NDJSON_SUFFIX,
    dimensions=("age_group", "VAX_MANU_CLEAN"),
    metrics=(
        long_sum("total_reports", "total_cases"),
        long_sum("deaths"),
        long_sum("hospitalizations"),
        long_sum("er_visits"),
        long_sum("severe_cases"),
        double_sum("death_rate"),
        double_sum("hospital_rate"),
        double_sum("severe_rate"),
        double_sum("avg_age"),
    ),
)
GEOGRAPHIC_SPEC = DatasourceSpec(
    name=OUTPUT_STEMS["geographic"][2],
    name_filter=OUTPUT_STEMS["geographic"][0] + NDJSON_SUFFIX,
    dimensions=("state", "VAX_MANU_CLEAN"),
    metrics=(
        long_sum("total_reports"),
        long_sum("deaths"),
        long_sum("hospitalizations"),
        long_sum("er_visits"),
        double_sum("avg_age"),
        double_sum("death_rate"),
        double_sum("hospital_rate"),
    ),
)
# End of fixed values.

SPECS = {"symptoms": SYMPTOMS_SPEC, "severity": SEVERITY_SPEC, "geographic": GEOGRAPHIC_SPEC}

SEGMENT_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def segment_of(time: Column, segment: str) -> Column:
    return F.date_format(time, SEGMENT_FORMATS[segment])


def datasource_rows(
    df: DataFrame, spec: DatasourceSpec, time_type: str = "timestamp"
) -> DataFrame:
    """Rows as the datasource stores them: time, segment, dimensions, metrics."""
    time = iso_timestamp(spec.time_column, spec.time_missing, time_type)
    timed = df.withColumn(TIME, time).withColumn(
        spec.segment, segment_of(F.col(TIME), spec.segment)
    )
    return aggregate_metrics(
        timed, spec.dimensions, spec.metrics, spec.rollup, time_cols=[TIME, spec.segment]
    )


MANIFEST = "segment string, load string, schema string"


def latest_manifest(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """Number and rows of the latest complete manifest: the load of each segment, and a row without
    segment for the schema."""
    files = f"{path}/manifests/*/*.parquet"
    if not path_exists(spark, files):
        return 0, None
    name = F.regexp_extract("path", "manifests/([^/]+)/", 1)
    last = file_sizes(spark, files).agg(F.max(name)).first()[0]
    return int(last.split("-")[0]), spark.read.schema(MANIFEST).parquet(f"{path}/manifests/{last}")


def ingest_datasource(
    df: DataFrame,
    spec: DatasourceSpec,
    path: str,
    replace: str = "all",
    time_type: str = "timestamp",
) -> None:
    """Write a datasource partitioned by its segment, replacing rather than appending.

    ``replace="all"`` drops every older segment, ``"touched"`` only the segments present in
    ``df``. The rebalance hint gathers each segment into few files and lets AQE split a
    segment that is much larger than the others.
    """
    if replace not in ("all", "touched"):
        raise ValueError(f"replace is 'all' or 'touched', not {replace!r}")
    spark = df.sparkSession
    rows = datasource_rows(df, spec, time_type)
    number, earlier = latest_manifest(spark, path)
    load, folder = uuid.uuid4().hex, f"{path}/loads"
    rows.hint("rebalance", spec.segment).write.partitionBy(spec.segment).parquet(f"{folder}/load={load}")
    stored = spark.read.schema(rows.schema).option("basePath", folder).parquet(f"{folder}/load={load}")
    # One row per day or month.
    held = [(row[0], load, "") for row in stored.select(spec.segment).distinct().collect()]
    if earlier is not None and replace == "touched":
        new = {segment for segment, _, _ in held}
        held += [tuple(row) for row in earlier.collect() if row.segment is not None and row.segment not in new]
    manifest = spark.createDataFrame([*held, (None, load, rows.schema.json())], MANIFEST)
    manifest.coalesce(1).write.parquet(f"{path}/manifests/{number + 1:09}-{load}")


def ingest_files(
    spark: SparkSession, base_dir: str, spec: DatasourceSpec, path: str, replace: str = "all"
) -> None:
    """Load the NDJSON files a spec names; fails when they are missing."""
    source = f"{base_dir.rstrip('/')}/{spec.name_filter}"
    if not path_exists(spark, source):
        raise FileNotFoundError(source)
    rows = read_ndjson(spark, base_dir, spec.name_filter, spec.source_schema)
    ingest_datasource(rows, spec, path, replace)


def read_datasource(spark: SparkSession, spec: DatasourceSpec, path: str) -> DataFrame:
    """A stored datasource as its latest complete load left it. The segment is text."""
    _, manifest = latest_manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"{path} holds no complete load")
    rows = manifest.collect()
    schema = StructType.fromJson(json.loads(next(row.schema for row in rows if row.segment is None)))
    folders = [f"{path}/loads/load={row.load}/{spec.segment}={row.segment}" for row in rows if row.segment is not None]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/loads").parquet(*folders).drop("load")


def since(df: DataFrame, moment: str, segment: str = "day") -> DataFrame:
    """Rows from ``moment`` on; the segment condition lets the scan skip older partitions."""
    start = F.lit(moment).cast(dict(df.dtypes)[TIME])
    return df.where(F.col(TIME) >= start).where(F.col(segment) >= segment_of(start, segment))
