"""Time the headline queries and one full CSV run; prints a single JSON line.

The full run starts from three CSV files, which Spark first derives from the sample tables:
reports carry a document as their narrative text, quotes and line breaks included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from reportlens.operators.quality import check_files  # noqa: E402
from reportlens.plans import analogue, queries  # noqa: E402
from reportlens.plans.analogue import ANALOGUE_RULES as RULES  # noqa: E402
from reportlens.plans.run import run_analyses  # noqa: E402
from reportlens.session import local_session, scratch_path  # noqa: E402
from reportlens.sources.files import write_csv  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = (
    "semi_join_reports",
    "curate",
    "tally",
    "symptoms",
    "severity",
    "totals",
    "allocate",
    "state_actual",
    "monthly_trend",
    "clean_curated",
    "top_symptoms",
    "chart_filtered",
    "quality_report",
    "datasource_ingest",
    "time_filtered_sums",
)


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median_time(action, warm_up: int = 1) -> float:
    for _ in range(warm_up):
        action()
    return round(statistics.median(timed(action) for _ in range(REPEATS)), 3)


def write_extracts(spark) -> dict[str, str]:
    """The three tables as CSV files, one file each, as an extract would arrive."""
    reports, symptoms, vaccines = analogue.inputs(spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    count = documents.count()
    narrative = documents.select("doc_id", F.col("text").alias("narrative"))
    reports = reports.join(narrative, F.col("report_id") % count == F.col("doc_id")).drop("doc_id")
    folder = scratch_path(spark, "extracts")
    paths = {}
    for kind, df in (("reports", reports), ("symptoms", symptoms), ("vaccines", vaccines)):
        paths[kind] = f"{folder}/{kind}"
        write_csv(df.coalesce(1), paths[kind])
    return paths


def main() -> None:
    spark = local_session(
        CPUS,
        "16g",
        **{
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-scratch-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")

    def materialise(name):
        return lambda: queries.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    times = {name: median_time(materialise(name)) for name in HEADLINE}

    extracts = write_extracts(spark)
    megabytes = sum(check_files(spark, list(extracts.values())).values())
    summaries = []

    def full_run():
        summaries.append(run_analyses(spark, extracts, scratch_path(spark, "results"), rules=RULES))

    times["csv_to_analyses"] = median_time(full_run)
    seconds = times["csv_to_analyses"]
    rows = summaries[-1]["rows_read"]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "csv_run": {
                    "input_mb": round(megabytes, 1),
                    "rows_read": rows,
                    "mb_per_sec": round(megabytes / seconds, 1),
                    "reports_per_sec": round(rows["reports"] / seconds),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
