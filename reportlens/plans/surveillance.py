"""Queries of the surveillance operators; ``surveillance_sql.py`` holds the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rate
from ..operators import analyses as A
from ..operators import clustering, cooccurrence, cube, expectations
from ..operators import trends as T
from ..session import scratch_path
from ..sources import datasource as D
from ..sources import quarantine
from ..streaming import alert_state
from . import analogue
from .analogue import ANALOGUE_RULES as RULES
from .queries import read, rounded, tally

Query = Callable[[SparkSession, str], DataFrame]


def cooccurring_symptoms(spark, sf_dir):
    """Pairs of symptoms that five reports share."""
    return rounded(cooccurrence.cooccurrence(analogue.symptoms(spark, sf_dir), RULES, min_reports=5))


def symptom_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and mean age, in hundreds of years, per symptom."""
    rolled = A.roll_up(tally(spark, sf_dir), ["symptom"], "total_reports")
    return rolled.select(
        "symptom",
        rate("deaths", "total_reports", 1.0).alias("death_rate"),
        rate("hospitalizations", "total_reports", 1.0).alias("hospital_rate"),
        (F.col("avg_age") / 100).alias("age"),
    )


def symptom_clusters(spark, sf_dir):
    """Symptoms with like outcomes and ages."""
    profiles = symptom_profiles(spark, sf_dir)
    return rounded(clustering.clusters(profiles, "symptom", ["death_rate", "hospital_rate", "age"], 4))


def symptom_evolution(spark, sf_dir):
    """Reports per manufacturer, symptom and month, with months without reports."""
    keys = ["manufacturer", "symptom"]
    by_month = T.reports_per_period(tally(spark, sf_dir, "report_month"), "report_month", "month", keys)
    return rounded(T.evolution(by_month, "total_reports", keys))


def dashboard_cube(spark, sf_dir):
    return rounded(cube.dashboard_cube(tally(spark, sf_dir)))


def cube_chart(spark, sf_dir):
    """A chart under a cross filter, from the cube."""
    whole = cube.dashboard_cube(tally(spark, sf_dir), sets=[["manufacturer", "symptom"], ["symptom"]])
    return rounded(cube.chart_slice(whole, cube.DIMENSIONS, ["symptom"], {"manufacturer": "M2"}))


SKETCH_SPEC = D.DatasourceSpec(
    name="events_sketched",
    dimensions=("event_type",),
    metrics=(
        D.long_sum("event_count", "one"),
        D.distinct_sketch("users", "user_id"),
        D.quantile_sketch("values", "value"),
    ),
    time_column="day_start",
    rollup=True,
)


def datasource_sketches(spark, sf_dir):
    """Distinct users and the median value per event type, from sketches rolled up by day and then over
    days; whether they are within their error of the exact numbers."""
    events = read(spark, sf_dir, "events")
    daily = events.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day_start"), "event_type", "user_id", "value", F.lit(1).alias("one"))
    path = scratch_path(spark, SKETCH_SPEC.name)
    D.ingest_datasource(daily, SKETCH_SPEC, path, time_type="timestamp_ntz")
    stored = D.read_datasource(spark, SKETCH_SPEC, path)
    merged = A.merge_metrics(stored, ["event_type"], SKETCH_SPEC.metrics).select(
        "event_type",
        "event_count",
        A.distinct_estimate("users").alias("users_about"),
        A.quantile_estimate("values", 0.5).alias("median_about"),
    )
    exact = (
        events.join(merged.select("event_type", "median_about"), "event_type")
        .groupBy("event_type")
        .agg(
            F.count_distinct("user_id").alias("users"),
            (F.count_if(F.col("value") <= F.col("median_about")) / F.count("value")).alias("rank"),
        )
    )
    near = F.abs(F.col("users_about") - F.col("users")) <= F.greatest(F.lit(1.0), 0.05 * F.col("users"))
    return merged.join(exact, "event_type").select(
        "event_type",
        "event_count",
        "users",
        near.alias("users_within"),
        (F.abs(F.col("rank") - 0.5) <= 0.03).alias("median_within"),
    )


def cross_table_rules(spark, sf_dir):
    """Keys, references and shifts between the tables, in one report."""
    orders, lines = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    early = F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz")
    report = expectations.expectation_report(
        [
            expectations.unique_key(orders, "one row per order", ["o_orderkey"]),
            expectations.unique_key(lines, "one line per order", ["l_orderkey"], 0.1),
            expectations.references(lines, "lines have an order", "l_orderkey", orders, "o_orderkey"),
            expectations.references(
                lines, "lines have an open order", "l_orderkey", orders.where("o_orderstatus = 'O'"), "o_orderkey", 0.25
            ),
            expectations.shift(orders.where(early), orders.where(~early), "status is stable", "o_orderstatus", 0.01),
            expectations.row_rule(orders, "price is positive", F.col("o_totalprice") > 0),
        ]
    )
    return rounded(report)


ALERT_LIMITS = [("mean is high", "mean_value", 52.0), ("many events", "n_events", 44.0)]
ALERT_KEYS = ["event_type", "hour"]


def event_measures(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", F.hour("ts").alias("hour")).agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n_events")
    )


def alerts_over_batches(spark, sf_dir):
    """Alerts after two arrivals, the second of which is replayed."""
    folder = scratch_path(spark, "alerts")
    events = read(spark, sf_dir, "events").select("event_type", "ts", "value")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for number, arrival in enumerate((early, ~early)):
        events.where(arrival).write.parquet(f"{folder}/arrivals/{number}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/arrivals")
        alert_state.watch(stream, event_measures, f"{folder}/state", ALERT_LIMITS, ALERT_KEYS, f"{folder}/progress")
    again = event_measures(spark.read.parquet(f"{folder}/arrivals/1"))
    alert_state.keep_alerts(again, f"{folder}/state", ALERT_LIMITS, ALERT_KEYS, 1)
    return rounded(alert_state.read_alerts(spark, f"{folder}/state"))


def csv_quarantine(spark, sf_dir):
    """Events as CSV records, some with fields missing or too many or with bad values: all of them again."""
    path = scratch_path(spark, "csv-broken")
    number, kind, value = F.col("event_id").cast("string"), F.col("event_type"), F.col("value").cast("string")
    record = (
        F.when(kind == "click", F.concat_ws(",", number, kind))
        .when(kind == "error", F.concat_ws(",", number, F.lit('"a\n""b"""'), number, F.lit("more")))
        .when(kind == "view", F.concat_ws(",", number, F.lit('"view,\n"'), F.lit("n/a")))
        .otherwise(F.concat_ws(",", number, kind, value))
    )
    # Every file needs its header: it precedes the first record of each task.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0
    line = F.when(first, F.concat(F.lit("event_id,event_type,value\n"), record)).otherwise(record)
    read(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    intake = quarantine.read_csv_apart(spark, path, {"event_id": "bigint", "event_type": "string", "value": "double"})
    nothing = F.lit(None).cast("string")
    kept = intake.rows.select("event_id", "event_type", "value", nothing.alias("reason"), nothing.alias("bad"), nothing.alias("record"))
    broken = intake.broken.select(
        F.lit(None).cast("bigint").alias("event_id"),
        nothing.alias("event_type"),
        F.lit(None).cast("double").alias("value"),
        "reason",
        F.array_join("columns", ",").alias("bad"),
        "record",
    )
    return kept.unionByName(broken)


QUERIES: dict[str, Query] = {
    "cooccurring_symptoms": cooccurring_symptoms,
    "symptom_clusters": symptom_clusters,
    "symptom_evolution": symptom_evolution,
    "dashboard_cube": dashboard_cube,
    "cube_chart": cube_chart,
    "datasource_sketches": datasource_sketches,
    "cross_table_rules": cross_table_rules,
    "alerts_over_batches": alerts_over_batches,
    "csv_quarantine": csv_quarantine,
}

#: Iterative: tested against a plain version instead of SQL.
WITHOUT_TWIN = frozenset({"symptom_clusters"})
