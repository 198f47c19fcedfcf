"""Allocation, quality checks, serving, tables and datasources."""

from datetime import date

import pytest
from comparing import close, rows
from pyspark.sql import functions as F

from reportlens.operators import allocate as alloc
from reportlens.operators import quality as Q
from reportlens.operators import trends as T
from reportlens.operators.analyses import aggregate_metrics
from reportlens.plans import serving
from reportlens.plans.run import input_paths, run_analyses
from reportlens.session import scratch_path, shuffle_partitions
from reportlens.sources import datasource as D
from reportlens.sources import tables
from reportlens.streaming import ingest as stream

TS = "2024-05-06T07:08:09.000000Z"
TOTALS = "manufacturer string, total_reports long, deaths long, hospitalizations long, avg_age double"


@pytest.fixture(scope="module")
def totals(spark):
    return spark.createDataFrame(
        [
            ("PFIZER", 1000, 37, 111, None),
            ("MODERNA", 350, 9, 50, 0.0),
            ("JANSSEN", 7, 0, 1, 51.25),
            ("OTHER", 5, 0, 0, 1.0),
        ],
        TOTALS,
    )


def test_allocation(totals):
    spread = alloc.allocate_by_weights(totals, TS)
    assert spread.count() == 45
    shown = {(r.state, r.manufacturer): tuple(r)[2:8] for r in spread.collect()}
    expected = {
        ("CA", "PFIZER"): (180, 6, 19, 45.0, 3.7, 11.1),
        ("IL", "PFIZER"): (70, 2, 7, 45.0, 3.7, 11.1),
        ("NJ", "PFIZER"): (10, 0, 1, 45.0, 3.7, 11.1),
        ("CA", "MODERNA"): (63, 1, 9, 45.0, 2.5714285714285716, 14.285714285714286),
        ("PA", "MODERNA"): (28, 0, 4, 45.0, 2.5714285714285716, 14.285714285714286),
        ("CA", "JANSSEN"): (1, 0, 0, 51.25, 0.0, 18.0),
        ("NJ", "JANSSEN"): (1, 0, 0, 51.25, 0.0, 1.0),
    }
    close([shown[key] for key in expected], list(expected.values()))
    sums = spread.groupBy("manufacturer").agg(F.sum("total_reports"))
    assert rows(sums) == [("JANSSEN", 15), ("MODERNA", 346), ("PFIZER", 1000)]


def test_shares_equal_plain_arithmetic(spark):
    """Truncated double products, value by value."""
    numbers = spark.range(1, 2000).select(
        F.lit("PFIZER").alias("manufacturer"),
        F.col("id").alias("total_reports"),
        (F.col("id") % 97).alias("deaths"),
        (F.col("id") % 31).alias("hospitalizations"),
        F.lit(1.0).alias("avg_age"),
    )
    from reportlens.rules import STATE_WEIGHTS

    got = {}
    for r in alloc.allocate_by_weights(numbers, TS).collect():
        got.setdefault(r.state, []).append((r.total_reports, r.deaths, r.hospitalizations))
    for state, factor in STATE_WEIGHTS:
        want = [
            (max(1, int(n * factor)), int((n % 97) * factor), int((n % 31) * factor))
            for n in range(1, 2000)
        ]
        assert sorted(got[state]) == sorted(want)


def test_split_valid(spark):
    df = spark.createDataFrame(
        [
            ("CA", "PFIZER", 1), ("US", "PFIZER", 1), ("CAL", "PFIZER", 1), ("C1", "PFIZER", 1),
            ("TX", "OTHER", 1), ("TX", "MODERNA", 0), (None, "MODERNA", 1),
        ],
        "state string, manufacturer string, total_reports long",
    )
    valid, rejected = alloc.split_valid(df, alloc.geographic_rules())
    assert rows(valid) == [("CA", "PFIZER", 1)]
    assert sorted(r.reason for r in rejected.collect()) == sorted(
        [
            "state is a country code", "state is not two characters", "state is not alphabetic",
            "unknown manufacturer", "no reports", "state is a country code",
        ]
    )


def test_fallback_rows_pass_the_rules(spark):
    placeholder = alloc.fallback_rows(spark, TS)
    valid, rejected = alloc.split_valid(placeholder, alloc.geographic_rules())
    assert (valid.count(), rejected.count()) == (15, 0)
    assert tuple(valid.where("state = 'CA' and manufacturer = 'PFIZER'").first())[2:9] == (
        100, 1, 5, 45.0, 1.0, 5.0, 0,
    )


def test_file_checks(spark, data_dir, tmp_path):
    paths = input_paths(data_dir)
    sizes = Q.check_files(spark, list(paths.values()))
    assert all(0 < size < 1 for size in sizes.values())
    with pytest.raises(FileNotFoundError, match="none.csv"):
        Q.check_files(spark, [f"{data_dir}/none.csv"])
    folder = tmp_path / "empty"
    folder.mkdir()
    for kind, name in (("reports", "VAERSDATA"), ("symptoms", "VAERSSYMPTOMS"), ("vaccines", "VAERSVAX")):
        text = open(paths[kind]).read()
        (folder / f"{name}.csv").write_text(text if kind != "symptoms" else text.splitlines()[0] + "\n")
    with pytest.raises(ValueError, match="symptoms has no rows"):
        run_analyses(spark, input_paths(str(folder)), str(tmp_path / "out"), TS)


def test_shape_columns_and_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a long, b string")
    assert Q.sample_shape(df, 2) == (2, 2)
    Q.check_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match="columns not found: c"):
        Q.check_columns(df, ["a", "c"])
    assert tuple(Q.profile(df, ["a", "b"]).first()) == (3, 1, 1)
    report = Q.rule_report(df, [("a is small", F.col("a") < 2), ("b is set", F.col("b").isNotNull())])
    assert rows(report) == [("a is small", 1, 2), ("b is set", 2, 1)]


def test_alerts(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("b", 0.5, 9), ("c", None, 0)], "k string, x double, y long")
    got = T.alerts(df, [("x high", "x", 1.0), ("y high", "y", 3.0)], ["k"])
    assert rows(got) == [("a", "x high", 5.0, 1.0), ("b", "y high", 9.0, 3.0)]


def test_periods(spark):
    tally = spark.createDataFrame(
        [(date(2021, 1, 5), "A", 2, 1, 0, 10.0, 1), (date(2021, 1, 30), "A", 3, 0, 0, 0.0, 0)],
        "day date, manufacturer string, n_rows long, deaths long, hospitalizations long, age_sum double, age_rows long",
    )
    assert rows(T.reports_per_period(tally, "day")) == [(date(2021, 1, 1), "A", 5, 1, 0, 10.0)]


def test_chart_from_parameters(spark):
    df = spark.createDataFrame([("x", 1, "a"), ("x", 4, "b"), ("y", 9, "a")], "k string, n long, f string")
    parameters = {
        "groupby": ["k"],
        "metrics": [
            {"aggregate": "SUM", "column": {"column_name": "n"}, "label": "Total"},
            {"aggregate": "COUNT", "column": {"column_name": "n"}, "label": "Rows"},
        ],
        "row_limit": 1,
        "order_desc": True,
    }
    tables.register(df, "chart_data")
    spec = serving.ChartSpec.from_params("chart_data", parameters)
    assert rows(serving.chart_query(spark, spec)) == [("y", 9, 1)]
    assert rows(serving.chart_query(spark, spec, [F.col("f") == "b"])) == [("x", 4, 1)]
    one = {"groupby": ["k"], "metric": {"aggregate": "MAX", "column": {"column_name": "n"}, "label": "m"}}
    assert rows(serving.chart_query(df, serving.ChartSpec.from_params("", one))) == [("x", 4), ("y", 9)]


def test_sql_with_parameters(spark):
    tables.register(spark.range(10).toDF("n"), "numbers")
    assert rows(serving.run_sql(spark, "SELECT n FROM numbers WHERE n > :low", {"low": 7})) == [(8,), (9,)]


def test_jdbc_table_is_replaced(spark):
    """An in-process database: only a local session can see it."""
    url = "jdbc:derby:memory:reports;create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([("PFIZER", 3, 0.5), ("MODERNA", 2, None)], "m string, n long, r double")
    for _ in range(2):
        tables.write_table(df, "totals", url, options)
    assert rows(tables.read_table(spark, "totals", url, options)) == rows(df)


def test_catalog_table_is_replaced_and_dropped(spark):
    for n in (5, 3):
        tables.write_table(spark.range(n), "vaers_temporary")
    assert tables.read_table(spark, "vaers_temporary").count() == 3
    for _ in range(2):
        tables.drop_table(spark, "vaers_temporary")
    assert not spark.catalog.tableExists("vaers_temporary")
    tables.register(spark.range(1), "vaers_temporary")
    tables.drop_table(spark, "vaers_temporary")
    assert not spark.catalog.tableExists("vaers_temporary")


def test_missing_results(spark, tmp_path):
    assert not any(tables.load_results(spark, str(tmp_path)).values())
    with pytest.raises(FileNotFoundError, match="symptoms"):
        tables.load_results(spark, str(tmp_path), on_missing="fail")
    with pytest.raises(FileNotFoundError, match="severity"):
        D.ingest_files(spark, str(tmp_path), D.SEVERITY_SPEC, str(tmp_path / "ds"))


def test_outputs_must_exist_and_have_rows(spark):
    for number in range(3):
        tables.register(spark.range(number), f"zebra_{number}")
    with pytest.raises(ValueError, match="zebra_0 has no rows"):
        Q.check_outputs(spark, "zebra")
    with pytest.raises(ValueError, match="expected 4"):
        Q.check_outputs(spark, "zebra", 4)


def test_ingestion_document(spark):
    document = {
        "type": "index_parallel",
        "spec": {
            "ioConfig": {"inputSource": {"type": "local", "baseDir": "/x", "filter": "severity.json"}},
            "dataSchema": {
                "dataSource": "severity_by_age",
                "timestampSpec": {"column": "__time", "format": "iso", "missingValue": "1970-01-01T00:00:00Z"},
                "dimensionsSpec": {"dimensions": ["age_group"]},
                "metricsSpec": [D.long_sum("total_reports", "total_cases"), D.double_sum("avg_age")],
                "granularitySpec": {"segmentGranularity": "DAY", "queryGranularity": "NONE", "rollup": False},
            },
        },
    }
    spec = D.DatasourceSpec.from_ingestion(document)
    assert (spec.name, spec.segment, spec.rollup) == ("severity_by_age", "day", False)
    df = spark.createDataFrame(
        [("0-17", "3", 4.5, None), ("65+", "2", None, "2024-02-01T10:00:00Z")],
        "age_group string, total_cases string, avg_age double, `__time` string",
    )
    path = scratch_path(spark, "document")
    D.ingest_datasource(df, spec, path)
    stored = D.read_datasource(spark, spec, path)
    assert rows(stored, "day", "age_group", "total_reports", "avg_age") == [
        ("1970-01-01", "0-17", 3, 4.5),
        ("2024-02-01", "65+", 2, None),
    ]
    assert D.since(stored, "2024-01-01").count() == 1


def test_rollup_sums_and_plain_metrics_do_not(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0)], "d int, v double")
    metrics = [D.double_sum("total", "v")]
    assert rows(aggregate_metrics(df, ["d"], metrics)) == [("1", 2.0), ("1", 3.0)]
    assert rows(aggregate_metrics(df, ["d"], metrics, rollup=True)) == [("1", 5.0)]
    rates = df.withColumnRenamed("v", "death_rate")
    with pytest.raises(ValueError, match="death_rate"):
        aggregate_metrics(rates, ["d"], [D.double_sum("death_rate")], rollup=True)


def test_late_files_and_repeated_refresh(spark, data_dir, tmp_path):
    source, store = tmp_path / "arrivals", str(tmp_path / "store")
    paths = input_paths(data_dir)

    def arrive(kind, name, lines):
        folder = source / kind
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(lines) + "\n")

    def take_in():
        for kind in stream.KINDS:
            stream.land_new_files(spark, str(source / kind), store, kind)
        return stream.refresh(spark, store)

    symptoms = open(paths["symptoms"]).read().splitlines()
    for kind in stream.KINDS:
        (source / kind).mkdir(parents=True)
    assert stream.refresh(spark, store) is None
    arrive("reports", "a.csv", open(paths["reports"]).read().splitlines())
    arrive("vaccines", "a.csv", open(paths["vaccines"]).read().splitlines())
    arrive("symptoms", "a.csv", symptoms[:5])
    first = take_in()
    assert first.agg(F.sum("n_rows")).first()[0] == 6
    arrive("symptoms", "b.csv", [symptoms[0], *symptoms[5:]])
    second = take_in()
    assert second.agg(F.sum("n_rows"), F.sum("deaths")).first()[:] == (12, 3)
    assert rows(take_in()) == rows(second)
    assert stream.version(spark, store) == 2


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * 1024**4, 1000) == 81920
