"""What the physical plans look like, and what a single dominant id does to them."""

import io
import re
from contextlib import contextmanager, redirect_stdout

import pytest
from comparing import close, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportlens.operators import analyses as A
from reportlens.operators import curate as K
from reportlens.plans import analogue, queries
from reportlens.plans.analogue import ANALOGUE_RULES as RULES
from reportlens.sources import datasource as D

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def conf(spark, **changes):
    before = {key: spark.conf.get(key, None) for key in changes}
    for key, value in changes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_no_python_and_no_cartesian_product(spark):
    for name in ("curate", "tally", "symptoms", "severity", "allocate", "state_actual", "alerts"):
        text = plan(queries.QUERIES[name](spark, SF_DIR))
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text), name


def test_scans_read_only_what_is_used(spark):
    text = plan(queries.scan_project(spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(p_size), LessThan(p_size,25)]" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int,p_retailprice:double>" in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(queries.severity(spark, SF_DIR)))
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s == "l_orderkey:bigint,l_partkey:bigint" for s in lineitem)


def test_top_list_sorts_only_its_rows(spark):
    assert "TakeOrderedAndProject" in plan(queries.QUERIES["top_symptoms"](spark, SF_DIR))


def test_semi_join_without_collecting(spark):
    assert "LeftSemi" in plan(queries.semi_join_reports(spark, SF_DIR))


def test_old_days_are_not_read(spark):
    path = queries.load_events(spark, SF_DIR)
    df = D.since(D.read_datasource(spark, queries.EVENTS_SPEC, path), "2024-01-20")
    scan = next(line for line in plan(df).splitlines() if line.startswith("PartitionFilters"))
    assert "day" in scan and ">=" in scan


def test_allocation_needs_no_join(spark):
    totals = spark.createDataFrame(
        [("M1", 10, 1, 1, 5.0)],
        "manufacturer string, total_reports long, deaths long, hospitalizations long, avg_age double",
    )
    from reportlens.operators.allocate import allocate_by_weights

    text = plan(allocate_by_weights(totals, "t", rules=RULES))
    assert "Join" not in text and "Exchange" not in text


def dominated(spark, copies=4000):
    """Tables in which one id holds most rows, and its rows take many values."""
    ids = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    base = spark.range(copies).select(ids.alias("report_id"), "id")
    reports = base.select(
        "report_id",
        F.when(F.col("id") % 2 == 0, "Y").otherwise("N").alias("died"),
        F.when(F.col("id") % 5 == 0, "Y").alias("hospital"),
        (F.col("id") % 90).cast("double").alias("age_given"),
        F.lit(None).cast("double").alias("age_computed"),
    )
    symptoms = base.select("report_id", F.concat(F.lit("symptom number "), F.col("id") % 700).alias("p_name"))
    vaccines = base.select(
        "report_id",
        F.lit("promo").alias("p_type"),
        F.concat(F.lit("Brand#"), F.col("id") % 6).alias("p_brand"),
    )
    return reports, symptoms, vaccines


@pytest.mark.parametrize("salt_buckets", [1, 8])
def test_dominant_id(spark, salt_buckets):
    """1334 x 1334 x 1334 row triples of one id are counted, not built."""
    reports, symptoms, vaccines = dominated(spark)
    tally = A.report_tally(reports, symptoms, vaccines, RULES, salt_buckets=salt_buckets)
    hot = tally.groupBy("manufacturer").agg(F.sum("n_rows").alias("n"), F.sum("deaths").alias("d"))

    def per_id(df, *keys):
        return {r[:-1] if len(r) > 2 else r[0]: r[-1] for r in df.groupBy(*keys).count().collect()}

    n_reports = per_id(reports, "report_id")
    n_deaths = per_id(reports.where("died = 'Y'"), "report_id")
    n_symptoms = per_id(K.select_symptoms(symptoms, RULES), "report_id")
    n_doses = per_id(K.select_manufacturers(vaccines, RULES), "report_id", "manufacturer")
    want = {}
    for (key, maker), doses in n_doses.items():
        total = want.setdefault(maker, [0, 0])
        total[0] += n_reports[key] * n_symptoms.get(key, 0) * doses
        total[1] += n_deaths.get(key, 0) * n_symptoms.get(key, 0) * doses
    assert {r.manufacturer: [r.n, r.d] for r in hot.collect()} == want
    assert sum(n for n, _ in want.values()) > 10**9


def test_dominant_id_is_folded_before_the_join(spark):
    reports, symptoms, vaccines = dominated(spark)
    assert K.dose_counts(vaccines, RULES).where("report_id = 1").count() == 1
    assert K.symptom_counts(symptoms, RULES).where("report_id = 1").count() <= 700


def small_skew(spark):
    """Settings with which AQE splits partitions of a few kilobytes."""
    return conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        },
    )


def test_semi_join_splits_a_dominant_id(spark):
    reports, _, vaccines = dominated(spark, 60000)
    with small_skew(spark):
        kept = K.select_reports(reports, K.target_ids(vaccines, RULES), RULES)
        assert len(kept.collect()) == 60000
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()


def test_tally_splits_a_dominant_id_of_different_terms(spark):
    reports, _, vaccines = dominated(spark, 60000)
    ids = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    symptoms = spark.range(60000).select(
        ids.alias("report_id"), F.concat(F.lit("symptom number "), F.col("id")).alias("p_name")
    )
    with small_skew(spark):
        tally = A.report_tally(reports, symptoms, vaccines, RULES)
        tally.collect()
        assert "skew=true" in tally._jdf.queryExecution().executedPlan().toString()


def test_folded_equals_row_by_row_on_sample_tables(spark):
    inputs = analogue.inputs(spark, SF_DIR)
    keys = ["manufacturer", "symptom", "age_group"]
    folded = A.report_tally(*inputs, RULES).orderBy(*keys)
    direct = A.tally_rows(K.curate(*inputs, RULES), RULES).orderBy(*keys)
    columns = [*keys, *A.MEASURES]
    close(
        [tuple(r) for r in folded.select(columns).collect()],
        [tuple(r) for r in direct.select(columns).collect()],
    )


def test_analyses_agree_on_the_number_of_rows(spark):
    inputs = analogue.inputs(spark, SF_DIR)
    tally = A.report_tally(*inputs, RULES).cache()
    total = K.curate(*inputs, RULES).count()
    for df, name in (
        (A.symptoms_by_manufacturer(tally, "t"), "total_reports"),
        (A.severity_by_age(tally, "t"), "total_cases"),
        (A.manufacturer_totals(tally), "total_reports"),
    ):
        assert df.agg(F.sum(name)).first()[0] == total


ids = st.integers(1, 6)
flags = st.sampled_from(["Y", "N", None])
ages = st.one_of(st.none(), st.integers(0, 100).map(float))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    reports=st.lists(st.tuples(ids, flags, flags, ages, ages), min_size=1, max_size=15),
    symptoms=st.lists(
        st.tuples(ids, st.sampled_from(["long enough", " Long Enough\t", "short", "rod of iron", None])),
        min_size=1,
        max_size=15,
    ),
    vaccines=st.lists(
        st.tuples(ids, st.sampled_from(["promo", "other", None]), st.sampled_from(["Brand#1", "brand#2 ", "Brand#9", None])),
        min_size=1,
        max_size=15,
    ),
)
def test_any_tables(spark, reports, symptoms, vaccines):
    """Folded and salted tallies equal the direct joins; splitting the reports changes nothing."""
    reports = spark.createDataFrame(
        reports, "report_id long, died string, hospital string, age_given double, age_computed double"
    )
    symptoms = spark.createDataFrame(symptoms, "report_id long, p_name string")
    vaccines = spark.createDataFrame(vaccines, "report_id long, p_type string, p_brand string")
    direct = rows(A.tally_rows(K.curate(reports, symptoms, vaccines, RULES), RULES))
    columns = ["manufacturer", "symptom", "age_group", *A.MEASURES]
    assert rows(A.report_tally(reports, symptoms, vaccines, RULES), *columns) == direct
    shuffled = [df.repartition(3) for df in (reports, symptoms, vaccines)]
    assert rows(A.report_tally(*shuffled, RULES, salt_buckets=3), *columns) == direct
    parts = [reports.where("died = 'Y'"), reports.where("died is distinct from 'Y'")]
    whole = K.curate(reports, symptoms, vaccines, RULES)
    halves = [K.curate(part, symptoms, vaccines, RULES) for part in parts]
    assert rows(halves[0].unionByName(halves[1])) == rows(whole)
