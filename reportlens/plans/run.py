"""The full run: read, tally, write the three analyses, summarise."""

from __future__ import annotations

import time
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.allocate import allocate_by_weights, geographic_rules, split_valid
from ..operators.analyses import (
    manufacturer_totals,
    report_tally,
    severity_by_age,
    symptoms_by_manufacturer,
)
from ..operators.quality import check_columns, check_files, check_not_empty
from ..rules import CSV_SUFFIX, DEFAULT_RULES, NDJSON_SUFFIX, OUTPUT_STEMS, REQUIRED_FILES, Rules
from ..session import scratch_path
from ..sources.files import file_sizes, read_csv_text, typed_columns, write_csv, write_ndjson


def run_timestamp() -> str:
    """Current time in the format of the ``__time`` column, in UTC."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def input_paths(data_dir: str) -> dict[str, str]:
    """Default file names of the three inputs below one folder."""
    base = data_dir.rstrip("/")
    return {
        kind: f"{base}/{name}"
        for kind, name in zip(("reports", "symptoms", "vaccines"), REQUIRED_FILES)
    }


def read_inputs(
    spark: SparkSession,
    paths: Mapping[str, str],
    rules: Rules = DEFAULT_RULES,
    mode: str = "FAILFAST",
    look_for_rows: bool = True,
) -> dict[str, DataFrame]:
    """The three inputs, checked: files present, columns present, at least one row.

    The last check starts a scan of each input; a run that counts rows anyway leaves it out.
    """
    check_files(spark, list(paths.values()))
    schemas = {
        "reports": rules.report_schema,
        "symptoms": rules.symptom_schema,
        "vaccines": rules.vaccine_schema,
    }
    inputs = {}
    for kind, schema in schemas.items():
        text = read_csv_text(spark, paths[kind], mode)
        check_columns(text, list(schema), kind)
        if look_for_rows:
            check_not_empty(text, kind)
        inputs[kind] = typed_columns(text, schema, mode)
    return inputs


def land(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and read back, so that later jobs do not recompute ``df``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_inputs(inputs: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The inputs as Parquet, for further runs that then read only the columns they need."""
    return {kind: land(df, f"{folder.rstrip('/')}/{kind}") for kind, df in inputs.items()}


def spread_totals(tally: DataFrame, run_ts: str, rules: Rules = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """The distribution over states: rows that meet the rules, and the others with a reason."""
    spread = allocate_by_weights(manufacturer_totals(tally), run_ts, rules=rules)
    return split_valid(spread, geographic_rules(rules))


def analyses(tally: DataFrame, run_ts: str, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The three published analyses of a tally."""
    geographic, _ = spread_totals(tally, run_ts, rules)
    return {
        "symptoms": symptoms_by_manufacturer(tally, run_ts),
        "severity": severity_by_age(tally, run_ts),
        "geographic": geographic,
    }


def save_analysis(df: DataFrame, out: str, stem: str) -> None:
    write_ndjson(df, f"{out.rstrip('/')}/{stem}{NDJSON_SUFFIX}")
    write_csv(df, f"{out.rstrip('/')}/{stem}{CSV_SUFFIX}")


def run_analyses(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: str,
    run_ts: str | None = None,
    rules: Rules = DEFAULT_RULES,
    mode: str = "FAILFAST",
    salt_buckets: int = 1,
    landing: str | None = None,
) -> dict[str, object]:
    """Read the inputs, write the three analyses below ``out`` and return a summary.

    The inputs are read once each, by the job that lands the tally in the scratch folder;
    the analyses work on that small table. With ``landing`` the inputs are first kept there
    as Parquet. Any failure stops the run.
    """
    started = time.monotonic()
    run_ts = run_ts or run_timestamp()
    inputs = read_inputs(spark, paths, rules, mode, look_for_rows=False)
    files = sum(file_sizes(spark, path).count() for path in paths.values())
    if landing:
        inputs = land_inputs(inputs, landing)
    counts = {kind: Observation(f"{kind}-{run_ts}") for kind in inputs}
    observed = {
        kind: df.observe(counts[kind], F.count(F.lit(1)).alias("rows")) for kind, df in inputs.items()
    }
    tally = land(
        report_tally(
            observed["reports"], observed["symptoms"], observed["vaccines"], rules,
            salt_buckets=salt_buckets,
        ),
        scratch_path(spark, "tally"),
    )
    if tally.isEmpty():
        # AQE drops the rest of the plan once a side turns out empty, row counts included.
        for kind, df in inputs.items():
            check_not_empty(df, kind)
        return {"status": "no_results", "input_files": files}

    results = analyses(tally, run_ts, rules)
    for name, df in results.items():
        save_analysis(df, out, OUTPUT_STEMS[name][0])
    return {
        "status": "success",
        "duration_seconds": time.monotonic() - started,
        "input_files": files,
        "rows_read": {kind: counts[kind].get["rows"] for kind in inputs},
        "curated_rows": tally.agg(F.sum("n_rows")).first()[0],
        "total_results": results["symptoms"].count(),
        "rejected_rows": spread_totals(tally, run_ts, rules)[1].count(),
        "output_path": out,
    }
