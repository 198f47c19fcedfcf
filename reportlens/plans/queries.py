"""One query per operator over the given tables; ``oracle.py`` holds the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from ..functions.schema import conform_schema
from ..operators import allocate as alloc
from ..operators import analyses as A
from ..operators import curate as K
from ..operators import quality as Q
from ..operators import trends as T
from ..rules import CSV_SUFFIX, DECADE_BREAKS, DECADE_LABELS, OUTPUT_STEMS, STATE_WEIGHTS
from ..session import scratch_path
from ..sources import datasource as D
from ..sources import files, tables
from ..streaming import ingest as stream
from . import analogue, run, serving
from .analogue import ANALOGUE_RULES as RULES
from .analogue import inputs

RUN_TS = "2024-01-01T00:00:00.000000Z"

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, whose last digits depend on the order of summation."""
    return df.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def tally(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return A.report_tally(*inputs(spark, sf_dir), RULES, extra)


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analogue.tables(spark, sf_dir)("part")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return analogue.tables(spark, sf_dir)(name)


# --- projections ------------------------------------------------------------------------


def scan_project(spark, sf_dir):
    return (
        part(spark, sf_dir).where(F.col("p_size") < 25).select("p_partkey", "p_name", "p_retailprice")
    )


def clean_text(spark, sf_dir):
    padded = F.concat(F.lit("\t "), F.col("p_name"), F.lit(" \r\n"))
    return part(spark, sf_dir).select("p_partkey", C.clean_text(padded).alias("name"))


def flag_equals(spark, sf_dir):
    return analogue.reports(spark, sf_dir).select(
        "report_id",
        C.flag_equals("died", "Y").alias("died_flag"),
        C.flag_equals("hospital", "Y").alias("hospital_flag"),
    )


def first_non_null(spark, sf_dir):
    return K.report_facts(analogue.reports(spark, sf_dir), RULES).select("report_id", "age_clean")


def map_category(spark, sf_dir):
    texts = part(spark, sf_dir).select("p_partkey", C.clean_text("p_brand").alias("maker_text"))
    return texts.select("p_partkey", K.manufacturer_of(RULES).alias("manufacturer"))


def map_category_keep(spark, sf_dir):
    text = C.clean_text("p_brand")
    kept = C.map_category(text, RULES.maker_rules, text)
    return part(spark, sf_dir).select("p_partkey", kept.alias("manufacturer"))


def bucketize(spark, sf_dir):
    facts = K.report_facts(analogue.reports(spark, sf_dir), RULES)
    decades = C.bucketize("age_clean", DECADE_BREAKS, DECADE_LABELS, "Unknown")
    return facts.select("report_id", A.age_group(RULES).alias("age_group"), decades.alias("decade"))


def rates(spark, sf_dir):
    shares = read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.count(F.lit(1)).alias("line_count"),
    )
    return rounded(
        shares.select(
            "*",
            C.rate("discounted", "line_count").alias("percent"),
            C.rate("discounted", "line_count", 1.0).alias("fraction"),
        )
    )


def tolerant_cast(spark, sf_dir):
    text = F.when(F.col("event_type") == "click", F.col("event_type")).otherwise(
        F.col("value").cast("string")
    )
    return read(spark, sf_dir, "events").select("event_id", C.tolerant_cast(text, "double").alias("value"))


def iso_timestamp(spark, sf_dir):
    text = F.when(
        F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    return read(spark, sf_dir, "events").select(
        "event_id", C.iso_timestamp(text, "1970-01-01T00:00:00", "timestamp_ntz").alias("event_time")
    )


def conform_union(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit(1).alias("flag")
    )
    schema = {"key": "string", "name": "string", "balance": "double", "flag": "bigint"}
    return conform_schema([customers, suppliers], schema, {"flag": 0}, ["balance"])


# --- filters ----------------------------------------------------------------------------


def target_ids(spark, sf_dir):
    return K.target_ids(analogue.vaccines(spark, sf_dir), RULES)


def named_parts(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", C.clean_text("p_name").alias("name"))


def valid_text(spark, sf_dir):
    return named_parts(spark, sf_dir).where(P.valid_text("name", RULES.symptom_min_length))


def deny_regex(spark, sf_dir):
    return named_parts(spark, sf_dir).where(P.deny_regex("name", RULES.symptom_deny_pattern))


def deny_exact(spark, sf_dir):
    return named_parts(spark, sf_dir).where(P.deny_exact("name", RULES.symptom_deny_terms))


def allow_list(spark, sf_dir):
    return map_category(spark, sf_dir).where(P.allow_list("manufacturer", RULES.makers))


def clean_curated(spark, sf_dir):
    raw = analogue.order_parts(spark, sf_dir).select(
        "report_id",
        F.lit(0).alias("died_flag"),
        F.lit(0).alias("hospital_flag"),
        F.lit(None).cast("double").alias("age_clean"),
        F.col("p_name").alias("symptom"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit("\t")).alias("manufacturer"),
    )
    cleaned = P.clean_curated(raw, RULES)
    return cleaned.groupBy("manufacturer", "symptom").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("report_id").alias("id_sum")
    )


# --- joins and analyses -----------------------------------------------------------------


def semi_join_reports(spark, sf_dir):
    reports, _, vaccines = inputs(spark, sf_dir)
    return K.select_reports(reports, K.target_ids(vaccines, RULES), RULES)


def curate(spark, sf_dir):
    return K.curate_counted(*inputs(spark, sf_dir), RULES)


def symptoms(spark, sf_dir):
    return A.symptoms_by_manufacturer(tally(spark, sf_dir), RUN_TS)


def severity(spark, sf_dir):
    return rounded(A.severity_by_age(tally(spark, sf_dir), RUN_TS))


def severity_fraction(spark, sf_dir):
    result = A.severity_by_age(tally(spark, sf_dir), RUN_TS, scale=1.0)
    return rounded(result.select("age_group", "manufacturer", "death_rate", "hospital_rate", "severe_rate"))


def totals(spark, sf_dir):
    return rounded(A.manufacturer_totals(tally(spark, sf_dir)))


def null_safe_sum(spark, sf_dir):
    facts = K.report_facts(analogue.reports(spark, sf_dir), RULES, ("died", "state"))
    return rounded(
        facts.groupBy("died", "state").agg(
            C.null_safe_sum("died_flag").alias("deaths"),
            C.null_safe_sum("hospital_flag").alias("hospitalizations"),
            F.avg("age_clean").alias("avg_age"),
        )
    )


def declared_metrics(spark, sf_dir):
    return A.aggregate_metrics(
        read(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linenumber"],
        [D.long_sum("lines", "l_quantity"), D.double_sum("tax", "l_tax")],
    )


def geographic(spark, sf_dir, weights=STATE_WEIGHTS):
    return alloc.allocate_by_weights(
        A.manufacturer_totals(tally(spark, sf_dir)), RUN_TS, weights, RULES
    )


def allocate(spark, sf_dir):
    return rounded(geographic(spark, sf_dir))


def allocate_valid(spark, sf_dir):
    weights = [*STATE_WEIGHTS, ("US", 0.5), ("USA", 0.2), ("C1", 0.1)]
    conditions = alloc.geographic_rules(RULES)
    valid, rejected = alloc.split_valid(geographic(spark, sf_dir, weights), conditions)
    columns = ["state", "manufacturer", "total_reports", "reason"]
    return valid.withColumn("reason", F.lit(None).cast("string")).select(columns).unionByName(
        rejected.select(columns)
    )


def state_actual(spark, sf_dir):
    return rounded(A.reports_by_state(tally(spark, sf_dir, "state"), "state", RUN_TS))


def monthly_trend(spark, sf_dir):
    by_month = tally(spark, sf_dir, "report_month")
    return rounded(T.reports_per_period(by_month, "report_month", "month"))


def yearly_trend(spark, sf_dir):
    by_month = tally(spark, sf_dir, "report_month")
    return rounded(T.reports_per_period(by_month, "report_month", "year", []))


def alerts(spark, sf_dir):
    result = A.severity_by_age(tally(spark, sf_dir), RUN_TS)
    limits = [("deaths are high", "death_rate", 33.0), ("many severe", "severe_rate", 53.0)]
    return rounded(T.alerts(result, limits, ["age_group", "manufacturer"]))


# --- serving ----------------------------------------------------------------------------


def chart(name, source, filters=()):
    def query(spark, sf_dir):
        return serving.chart_query(source(spark, sf_dir), serving.CHARTS[name], filters)

    return query


def sql_adhoc(spark, sf_dir):
    for name in ("orders", "customer"):
        tables.register(read(spark, sf_dir, name), f"adhoc_{name}")
    return serving.run_sql(
        spark,
        """
        SELECT c_mktsegment, count(*) AS order_count, round(sum(o_totalprice), 2) AS revenue
        FROM adhoc_orders JOIN adhoc_customer ON o_custkey = c_custkey
        WHERE o_totalprice > :floor GROUP BY c_mktsegment
        """,
        {"floor": 100000.0},
    )


# --- round trips ------------------------------------------------------------------------


def ndjson_roundtrip(spark, sf_dir):
    source = part(spark, sf_dir).withColumn(
        "size_class", F.when(F.col("p_size") > 25, F.lit("large"))
    )
    folder = scratch_path(spark, "ndjson")
    files.write_ndjson(source, f"{folder}/part.json")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in source.dtypes)
    return files.read_ndjson(spark, folder, "*.json", schema)


def csv_roundtrip(spark, sf_dir):
    source = part(spark, sf_dir)
    path = scratch_path(spark, "csv")
    files.write_csv(source, path)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in source.dtypes)
    return files.read_result_csv(spark, path, schema)


def csv_quoted_text(spark, sf_dir):
    """Whole documents, with their quotes and line breaks, through CSV."""
    path = scratch_path(spark, "csv-text")
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars")
    files.write_csv(documents, path)
    schema = {"doc_id": "bigint", "lang": "string", "text": "string", "n_chars": "bigint"}
    text = files.read_csv(spark, path, schema, breaks="quoted")
    return text.select("doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


def table_roundtrip(spark, sf_dir):
    name = "reportlens_customer_copy"
    tables.write_table(read(spark, sf_dir, "customer"), name, path=scratch_path(spark, "table"))
    return tables.read_table(spark, name)


EVENTS_SPEC = D.DatasourceSpec(
    name="events_by_type",
    dimensions=("event_type",),
    metrics=(D.long_sum("event_count", "one"), D.double_sum("total_value", "value")),
    time_column="ts",
)


def load_events(spark, sf_dir, spec=EVENTS_SPEC, path=None, condition=None, replace="all", value=None):
    events = read(spark, sf_dir, "events").withColumn("one", F.lit(1))
    if condition is not None:
        events = events.where(condition)
    if value is not None:
        events = events.withColumn("value", value)
    path = path or scratch_path(spark, spec.name)
    D.ingest_datasource(events, spec, path, replace, time_type="timestamp_ntz")
    return path


def datasource_ingest(spark, sf_dir):
    return D.read_datasource(spark, EVENTS_SPEC, load_events(spark, sf_dir))


def datasource_rollup(spark, sf_dir):
    hourly = D.DatasourceSpec(
        name="events_rolled_up",
        dimensions=("event_type",),
        metrics=EVENTS_SPEC.metrics,
        time_column="hour",
        segment="month",
        rollup=True,
    )
    events = read(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        "event_type",
        "value",
        F.lit(1).alias("one"),
    )
    path = scratch_path(spark, hourly.name)
    D.ingest_datasource(events, hourly, path, time_type="timestamp_ntz")
    return rounded(D.read_datasource(spark, hourly, path))


def datasource_replace(spark, sf_dir):
    """Load everything, then replace only the days from 20 January on with doubled values."""
    path = load_events(spark, sf_dir)
    late = F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")
    load_events(spark, sf_dir, path=path, condition=late, replace="touched", value=F.col("value") * 2)
    stored = D.read_datasource(spark, EVENTS_SPEC, path)
    return rounded(
        stored.groupBy("day", "event_type").agg(
            F.sum("event_count").alias("event_count"), F.sum("total_value").alias("total_value")
        )
    )


def csv_mixed_breaks(spark, sf_dir):
    """Whole documents whose text gets line breaks of all three kinds, through CSV."""
    path = scratch_path(spark, "csv-breaks")
    text = F.concat("lang", F.lit("\r"), "text", F.lit('\r\n"q",\n\r'), "lang")
    files.write_csv(read(spark, sf_dir, "documents").select("doc_id", text.alias("text")), path)
    stored = files.read_csv(spark, path, {"doc_id": "bigint", "text": "string"})
    return stored.select("doc_id", F.md5("text").alias("text_md5"))


def csv_permissive(spark, sf_dir):
    """Events with values that are no numbers: kept, with the columns named."""
    path = scratch_path(spark, "csv-bad")
    value = F.when(F.col("event_type") == "click", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    files.write_csv(read(spark, sf_dir, "events").select("event_id", value.alias("value")), path)
    stored = files.read_csv(spark, path, {"event_id": "bigint", "value": "double"}, mode="PERMISSIVE")
    return stored.select("event_id", "value", F.array_join(files.REJECTED, ",").alias("rejected"))


def iso_timestamp_zone(spark, sf_dir):
    """Times as text that names the zone."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    events = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", text).alias("time"))
    moment = C.iso_timestamp("time").cast("timestamp_ntz")
    return events.select("event_id", moment.alias("event_time"))


def allocate_unknown_age(spark, sf_dir):
    """Totals without a mean age, or with 0, get the default age."""
    totals_ = A.manufacturer_totals(tally(spark, sf_dir))
    age = F.when(F.col("manufacturer") == "M2", F.lit(0.0)).when(F.col("manufacturer") != "M1", F.col("avg_age"))
    return rounded(alloc.allocate_by_weights(totals_.withColumn("avg_age", age), RUN_TS, rules=RULES))


def full_run(spark, sf_dir):
    """Folder of the results and summary of a run from CSV; the reports' text has quotes and breaks."""
    folder = scratch_path(spark, "extracts")
    reports, symptom_rows, vaccines = inputs(spark, sf_dir)
    narrative = F.concat(F.lit('said "fine",\nlives in '), "state", F.lit("\n"))
    extracts = {
        "reports": reports.withColumn("narrative", narrative),
        "symptoms": symptom_rows,
        "vaccines": vaccines,
    }
    paths = {kind: f"{folder}/{kind}" for kind in extracts}
    for kind, rows in extracts.items():
        files.write_csv(rows, paths[kind])
    results = f"{folder}/results"
    return results, run.run_analyses(spark, paths, results, RUN_TS, RULES)


def published(analysis):
    """The result file of one analysis after a full run."""

    def query(spark, sf_dir):
        results, _ = full_run(spark, sf_dir)
        path = f"{results}/{OUTPUT_STEMS[analysis][0]}{CSV_SUFFIX}"
        stored = files.read_result_csv(spark, path, tables.RESULT_SCHEMAS[analysis])
        if "er_visits" in stored.columns:
            stored = stored.withColumn("er_visits", F.col("er_visits").cast("int"))
        return rounded(stored)

    return query


extracts_to_severity = published("severity")


def published_chart(spark, sf_dir):
    """A dashboard chart on the table that a full run's result was loaded into."""
    results, _ = full_run(spark, sf_dir)
    tables.load_results(spark, results, ["symptoms"], on_missing="fail")
    return serving.chart_query(spark, serving.CHARTS["top_symptoms"])


def published_datasource(spark, sf_dir):
    """A datasource loaded from the NDJSON files of a full run."""
    results, _ = full_run(spark, sf_dir)
    path = scratch_path(spark, "datasource")
    D.ingest_files(spark, results, D.SYMPTOMS_SPEC, path)
    stored = D.read_datasource(spark, D.SYMPTOMS_SPEC, path)
    names = [m["name"] for m in D.SYMPTOMS_SPEC.metrics]
    return stored.select("manufacturer", "symptom", *names)


def run_summary(spark, sf_dir):
    """The counts of a full run's summary, one row each."""
    _, summary = full_run(spark, sf_dir)
    counts = {f"{kind}_read": n for kind, n in summary["rows_read"].items()}
    counts |= {"curated_rows": summary["curated_rows"], "total_results": summary["total_results"]}
    counts["rejected_rows"] = summary["rejected_rows"]
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "name string, row_count bigint")


def stream_ingest(spark, sf_dir):
    """All three tables as arriving CSV files; the symptoms of large parts arrive late."""
    store = scratch_path(spark, "stream")
    lines = analogue.order_parts(spark, sf_dir, "p_size")
    early = {
        "reports": analogue.reports(spark, sf_dir),
        "symptoms": lines.where("p_size <= 25").select("report_id", "p_name"),
        "vaccines": lines.select("report_id", "p_type", "p_brand"),
    }
    late = {"symptoms": lines.where("p_size > 25").select("report_id", "p_name")}
    for number, arrivals in enumerate((early, late)):
        for kind, rows in arrivals.items():
            files.write_csv(rows, f"{store}/arrivals/{kind}/{number}")
            stream.land_new_files(spark, f"{store}/arrivals/{kind}", store, kind, RULES)
        current = stream.refresh(spark, store, RULES)
    return rounded(current)


def time_filtered_sums(spark, sf_dir):
    stored = D.read_datasource(spark, EVENTS_SPEC, load_events(spark, sf_dir))
    tables.register(D.since(stored, "2024-01-10T12:00:00"), "events_by_type")
    return rounded(
        serving.run_sql(
            spark,
            """
            SELECT event_type, sum(event_count) AS event_count, sum(total_value) AS total_value
            FROM events_by_type GROUP BY event_type ORDER BY event_count DESC, event_type
            """,
        )
    )


# --- quality ----------------------------------------------------------------------------


def profile(spark, sf_dir):
    return Q.profile(
        analogue.reports(spark, sf_dir), ["report_id", "died", "hospital", "age_given", "age_computed"]
    )


def quality_report(spark, sf_dir):
    return Q.rule_report(
        analogue.reports(spark, sf_dir),
        [
            ("outcome known", F.col("died").isin("Y", "N")),
            ("age plausible", F.col("age_given") < 80),
            ("state named", F.length("state") > 0),
        ],
    )


QUERIES: dict[str, Query] = {
    "scan_project": scan_project,
    "clean_text": clean_text,
    "flag_equals": flag_equals,
    "first_non_null": first_non_null,
    "map_category": map_category,
    "map_category_keep": map_category_keep,
    "bucketize": bucketize,
    "rates": rates,
    "tolerant_cast": tolerant_cast,
    "iso_timestamp": iso_timestamp,
    "conform_union": conform_union,
    "target_ids": target_ids,
    "valid_text": valid_text,
    "deny_regex": deny_regex,
    "deny_exact": deny_exact,
    "allow_list": allow_list,
    "clean_curated": clean_curated,
    "semi_join_reports": semi_join_reports,
    "curate": curate,
    "tally": lambda spark, sf_dir: rounded(tally(spark, sf_dir)),
    "symptoms": symptoms,
    "severity": severity,
    "severity_fraction": severity_fraction,
    "totals": totals,
    "null_safe_sum": null_safe_sum,
    "declared_metrics": declared_metrics,
    "allocate": allocate,
    "allocate_valid": allocate_valid,
    "state_actual": state_actual,
    "monthly_trend": monthly_trend,
    "yearly_trend": yearly_trend,
    "alerts": alerts,
    "reports_by_manufacturer": chart("reports_by_manufacturer", symptoms),
    "top_symptoms": chart("top_symptoms", symptoms),
    "hospitalizations_by_age": chart("hospitalizations_by_age", severity),
    "reports_by_state": chart("reports_by_state", geographic),
    "chart_filtered": chart(
        "top_symptoms", symptoms, ["manufacturer <> 'M2'", "deaths > 10"]
    ),
    "sql_adhoc": sql_adhoc,
    "ndjson_roundtrip": ndjson_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "csv_quoted_text": csv_quoted_text,
    "table_roundtrip": table_roundtrip,
    "datasource_ingest": datasource_ingest,
    "datasource_rollup": datasource_rollup,
    "datasource_replace": datasource_replace,
    "time_filtered_sums": time_filtered_sums,
    "extracts_to_severity": extracts_to_severity,
    "csv_mixed_breaks": csv_mixed_breaks,
    "csv_permissive": csv_permissive,
    "iso_timestamp_zone": iso_timestamp_zone,
    "allocate_unknown_age": allocate_unknown_age,
    "published_symptoms": published("symptoms"),
    "published_geographic": published("geographic"),
    "published_chart": published_chart,
    "published_datasource": published_datasource,
    "run_summary": run_summary,
    "stream_ingest": stream_ingest,
    "profile": profile,
    "quality_report": quality_report,
}
