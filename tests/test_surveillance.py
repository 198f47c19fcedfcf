"""Surveillance operators against plain versions on small tables."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from comparing import close, rows
from pyspark.sql import functions as F

from reportlens.operators import analyses as A
from reportlens.operators import clustering, cooccurrence, cube, expectations
from reportlens.operators.trends import evolution
from reportlens.plans.analogue import ANALOGUE_RULES as RULES
from reportlens.sources import datasource as D
from reportlens.sources.quarantine import read_csv_apart
from reportlens.streaming import alert_state
from reportlens.streaming import ingest as stream

# --- co-occurrence ----------------------------------------------------------------------


def symptom_rows(seed=1):
    draw = random.Random(seed)
    terms = [f"SYMPTOM {k:03}" for k in range(60)]
    data = [(k, draw.choice(terms[:12])) for k in range(80) for _ in range(draw.randint(0, 5))]
    data += [(1000, t) for t in terms for _ in range(30)]  # one report with all terms, again and again
    data += [(None, terms[0]), (3, None), (4, "short"), (5, "ANVIL THING"), (6, " symptom 001 ")]
    draw.shuffle(data)
    return data


def plain_pairs(data, least):
    baskets = {}
    for report, term in data:
        term = (term or "").strip().upper()
        if report is not None and len(term) > 7 and "ANVIL" not in term and "ROD" not in term:
            baskets.setdefault(report, set()).add(term)
    one = Counter(t for b in baskets.values() for t in b)
    two = Counter(p for b in baskets.values() for p in combinations(sorted(b), 2))
    n = len(baskets)
    return sorted(
        (a, b, k, one[a], one[b], k / n, k / one[a], k / one[b], k * n / (one[a] * one[b]))
        for (a, b), k in two.items()
        if k >= least
    )


@pytest.mark.parametrize("least", [1, 3])
@pytest.mark.parametrize("block", [4, 128])
def test_cooccurrence(spark, least, block):
    data = symptom_rows()
    df = spark.createDataFrame(data, "report_id long, p_name string").repartition(4)
    got = sorted(map(tuple, cooccurrence.cooccurrence(df, RULES, least, block).collect()))
    close(got, plain_pairs(data, least))


def test_terms_of_a_wide_report_are_spread(spark):
    wide = spark.createDataFrame([(1, [f"{k:04}" for k in range(1000)])], "report long, terms array<string>")
    dealt = cooccurrence.dealt_blocks(wide, 50)
    assert "hashpartitioning(report" in dealt._jdf.queryExecution().executedPlan().toString()
    sizes = dealt.select(F.size("left") * F.size("right")).collect()
    assert len(sizes) == 20 * 21 // 2 and max(r[0] for r in sizes) == 2500
    assert dealt.select(F.inline(cooccurrence.pairs_of(F.col("left"), F.col("right")))).distinct().count() == 1000 * 999 // 2


def test_cooccurrence_of_nothing(spark):
    empty = spark.createDataFrame([], "report_id long, p_name string")
    assert cooccurrence.cooccurrence(empty, RULES).count() == 0


# --- clusters ---------------------------------------------------------------------------


def profiles(seed, n=300):
    draw = np.random.default_rng(seed)
    middle = np.array([[0.1, 0.2], [0.9, 0.1], [0.5, 0.8], [0.2, 0.9]])
    x = middle[draw.integers(0, 4, n)] + draw.normal(0, 0.05, (n, 2))
    return [(f"k{i:03}", float(a), float(b)) for i, (a, b) in enumerate(x)]


def lloyd(x, centres):
    """Rounds of k-means on whole coordinates, until nothing changes."""
    while True:
        place = ((x[:, None, :].astype(float) - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[place == i].sum(axis=0) / max((place == i).sum(), 1) if (place == i).any() else c for i, c in enumerate(centres)])
        if (new == centres).all():
            return centres, place
        centres = new


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_plain_k_means(spark, seed):
    data = profiles(seed)
    points = clustering.as_points(spark.createDataFrame(data, "key string, a double, b double").repartition(5), "key", ["a", "b"]).cache()
    seeds = clustering.drawn_seeds(points, 4)
    assert 4 <= len(seeds) <= 1 + 4 * clustering.DRAWS * clustering.PER_DRAW * 4
    counted = {r.place: r.n for r in clustering.sums_per_centre(points, seeds).collect()}
    start = clustering.reduced(seeds, [counted.get(i, 0) for i in range(len(seeds))], 4)
    centres, turns = clustering.k_means(points, 4)
    x = np.round(np.array([r[1:] for r in data]) / clustering.UNIT).astype(np.int64)
    want, place = lloyd(x, np.array(start))
    assert sorted(centres) == sorted(map(tuple, want)) and turns > 1
    df = spark.createDataFrame(data, "key string, a double, b double")
    got = clustering.clusters(df, "key", ["a", "b"], 4)
    order = {tuple(c): i for i, c in enumerate(sorted(map(tuple, want)))}
    assert {r[0]: r[1] for r in got.collect()} == {row[0]: order[tuple(want[p])] for row, p in zip(data, place)}
    assert got.agg(F.max("distance")).first()[0] < 0.3


def test_clusters_go_on_from_the_last_round(spark, tmp_path):
    df = spark.createDataFrame(profiles(3), "key string, a double, b double")
    points = clustering.as_points(df, "key", ["a", "b"]).cache()
    state = str(tmp_path / "state")
    clustering.k_means(points, 4, max_rounds=1, state=state)
    centres, turns = clustering.k_means(points, 4, state=state)
    assert (sorted(centres), turns) == (sorted(clustering.k_means(points, 4)[0]), clustering.k_means(points, 4)[1])


def test_few_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", None), ("d", float("nan"))], "key string, x double")
    got = {r[0]: r[1] for r in clustering.clusters(df, "key", ["x"], 5).collect()}
    assert got["a"] == got["b"] != got["c"] == got["d"]
    assert clustering.clusters(df.limit(0), "key", ["x"], 5).count() == 0


# --- cube, evolution, expectations ------------------------------------------------------


def small_tally(spark):
    draw = random.Random(4)
    data = [
        (draw.choice("MN"), draw.choice(["s1", "s2", None]), draw.choice(["0-17", "65+"]), draw.randint(1, 9), draw.randint(0, 3), 1, 10.5, draw.choice([0, 2]))
        for _ in range(40)
    ]
    names = "manufacturer string, symptom string, age_group string, n_rows long, deaths long, hospitalizations long, age_sum double, age_rows long"
    return spark.createDataFrame(data, names)


def test_cube_equals_single_groupings(spark):
    tally = small_tally(spark)
    whole = cube.dashboard_cube(tally).cache()
    assert len(cube.all_sets(cube.DIMENSIONS)) == 8
    for keep in cube.all_sets(cube.DIMENSIONS):
        got = cube.chart_slice(whole, cube.DIMENSIONS, keep)
        want = A.roll_up(tally, list(keep), "total_reports")
        names = [*keep, "total_reports", "deaths", "hospitalizations", "avg_age"]
        close(rows(got, *names), rows(want, *names))
    filtered = cube.chart_slice(whole, cube.DIMENSIONS, ["age_group"], {"manufacturer": "M"})
    close(
        rows(filtered, "age_group", "total_reports"),
        rows(tally.where("manufacturer = 'M'").groupBy("age_group").agg(F.sum("n_rows").alias("total_reports")), "age_group", "total_reports"),
    )
    assert cube.dashboard_cube(tally.limit(0)).count() == 0
    with pytest.raises(ValueError, match="state"):
        cube.dashboard_cube(tally, sets=[["state"]])


def test_evolution_has_every_month(spark):
    data = [("a", "2020-01-01", 4), ("a", "2020-04-01", 2), ("b", "2020-02-01", 3), (None, "2020-02-01", 1)]
    counts = spark.createDataFrame(data, "key string, period string, n long").withColumn("period", F.col("period").cast("date"))
    got = evolution(counts, "n", ["key"], span=2).orderBy("key", "period").collect()
    assert [(r["key"], r["period"].month, r["n"], r["change"]) for r in got if r["key"] != "b"] == [
        (None, 1, 0, None), (None, 2, 1, 1), (None, 3, 0, -1), (None, 4, 0, 0),
        ("a", 1, 4, None), ("a", 2, 0, -4), ("a", 3, 0, 0), ("a", 4, 2, 2),
    ]
    assert [r["moving_mean"] for r in got if r["key"] == "a"] == [4, 2, 0, 1]
    assert [r["change_rate"] for r in got if r["key"] == "a"] == [None, -1, None, None]
    assert evolution(counts.limit(0), "n", ["key"]).count() == 0


def test_expectations(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "b"), (None, None)], "k long, v string")
    right = spark.createDataFrame([(1, "a"), (3, "a"), (None, "a")], "id long, v string")
    report = expectations.expectation_report(
        [
            expectations.unique_key(left, "key", ["k"]),
            expectations.references(left, "ref", "k", right, "id", 0.5),
            expectations.shift(left, right, "shift", "v", 0.5),
            expectations.row_rule(left, "row", F.col("k") > 1, 0.9),
            expectations.unique_key(left.limit(0), "none", ["k"]),
            expectations.references(left.limit(0), "none", "k", right, "id"),
            expectations.shift(left.limit(0), right.limit(0), "none", "v", 0.0),
        ]
    )
    assert [tuple(r) for r in report.collect()] == [
        ("key", "unique key", 5, 2, 0.4, False),
        ("ref", "reference", 3, 1, pytest.approx(1 / 3), True),
        ("shift", "shift", 3, 2, pytest.approx(0.6), False),
        ("row", "row", 5, 4, 0.8, True),
        ("none", "unique key", 0, 0, 0.0, True),
        ("none", "reference", 0, 0, 0.0, True),
        ("none", "shift", 0, 0, 0.0, True),
    ]


# --- sketches and loads -----------------------------------------------------------------


def test_sketches_roll_up(spark, tmp_path):
    draw = random.Random(5)
    data = [(f"2024-01-{1 + k % 9:02}T00:00:00", draw.choice("xy"), draw.randint(0, 5000), float(draw.randint(0, 1000)), 1) for k in range(20_000)]
    df = spark.createDataFrame(data, "day_start string, kind string, who long, v double, one long").repartition(6)
    spec = D.DatasourceSpec(
        "s", ("kind",), (D.long_sum("n", "one"), D.distinct_sketch("people", "who"), D.quantile_sketch("spread", "v")),
        time_column="day_start", rollup=True,
    )
    path = str(tmp_path / "s")
    D.ingest_datasource(df, spec, path)
    stored = D.read_datasource(spark, spec, path)
    assert stored.count() == 18
    twice = A.merge_metrics(stored, ["kind"], spec.metrics)
    direct = A.aggregate_metrics(df, ["kind"], spec.metrics, rollup=True)
    picked = ("kind", "n", A.distinct_estimate("people").alias("people"))
    once = {r["kind"]: r for r in direct.select(*picked).collect()}
    exact = {r[0]: r for r in df.groupBy("kind").agg(F.count_distinct("who"), F.count("v")).collect()}
    for row in twice.select(*picked, A.quantile_estimate("spread", 0.5).alias("middle")).collect():
        kind = row["kind"]
        assert row["n"] == exact[kind][2] == once[kind]["n"]
        assert row["people"] == pytest.approx(once[kind]["people"], rel=0.01)
        assert row["people"] == pytest.approx(exact[kind][1], rel=0.05)
        below = df.where((F.col("kind") == kind) & (F.col("v") <= row["middle"])).count()
        assert abs(below / exact[kind][2] - 0.5) < 0.03
    with pytest.raises(ValueError, match="people"):
        A.aggregate_metrics(df, ["kind"], spec.metrics)


def test_a_failed_load_changes_nothing(spark, tmp_path):
    spec = D.DatasourceSpec("d", ("kind",), (D.long_sum("n"),))
    path = str(tmp_path / "d")
    schema = "__time string, kind string, n long"
    with pytest.raises(FileNotFoundError):
        D.read_datasource(spark, spec, path)
    first = spark.createDataFrame([("2024-01-01T00:00:00", "a", 1), ("2024-01-02T00:00:00", "b", 2)], schema)
    D.ingest_datasource(first, spec, path)
    before = rows(D.read_datasource(spark, spec, path), "day", "kind", "n")
    bad = spark.createDataFrame([("2024-01-01T00:00:00", "x", 7), ("no time", "y", 8)], schema).repartition(2)
    for replace in ("all", "touched"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            D.ingest_datasource(bad, spec, path, replace)
        assert rows(D.read_datasource(spark, spec, path), "day", "kind", "n") == before
    later = spark.createDataFrame([("2024-01-02T00:00:00", "c", 3)], schema)
    D.ingest_datasource(later, spec, path, "touched")
    assert rows(D.read_datasource(spark, spec, path), "day", "kind", "n") == [("2024-01-01", "a", 1), ("2024-01-02", "c", 3)]
    D.ingest_datasource(later.limit(0), spec, path)
    assert D.read_datasource(spark, spec, path).count() == 0


# --- alerts, quarantine, refresh --------------------------------------------------------


def test_alerts_over_batches(spark, tmp_path):
    path, limits = str(tmp_path / "state"), [("high", "m", 10.0), ("low n", "n", 5.0)]
    schema = "key string, m double, n long"
    batches = [
        [("a", 11.0, 1), ("b", 12.0, 9), ("c", 1.0, 1), (None, 20.0, 0)],
        [("a", 13.0, 6), ("b", None, 1), ("c", 11.0, None)],
        [("a", 2.0, 7), ("d", 1.0, 1)],
    ]
    want = [
        [(None, "high", "raised", 0), ("a", "high", "raised", 0), ("b", "high", "raised", 0), ("b", "low n", "raised", 0)],
        [(None, "high", "on", 0), ("a", "high", "on", 0), ("a", "low n", "raised", 1), ("b", "high", "cleared", 0),
         ("b", "low n", "cleared", 0), ("c", "high", "raised", 1)],
        [(None, "high", "on", 0), ("a", "high", "cleared", 0), ("a", "low n", "on", 1), ("c", "high", "on", 1)],
    ]

    def state():
        return sorted(
            (tuple(r) for r in alert_state.read_alerts(spark, path).select("key", "alert", "status", "since").collect()),
            key=lambda r: (r[0] or "", r[1]),
        )

    assert alert_state.read_alerts(spark, path) is None
    for number, data in enumerate(batches):
        for _ in range(2):  # the second is a replay
            alert_state.keep_alerts(spark.createDataFrame(data, schema), path, limits, ["key"], number)
            assert state() == want[number]


def test_quarantine_keeps_every_record(spark, tmp_path):
    lines, broken = ["id,name,v"], []
    for k in range(400):
        record = [f"{k},plain,{k}.5", f'{k},"two\nlines, ""q""",1', f"{k},short", f'{k},"a\nb",1,more', f"x{k},bad,1", f"{k},,"][k % 6]
        lines.append(record)
        if k % 6 in (2, 3, 4):
            broken.append((["", "", "number of fields", "number of fields", "value"][k % 6], "id" if k % 6 == 4 else "", record))
    path = tmp_path / "r.csv"
    path.write_text("\n".join(lines) + "\n")
    settings = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    earlier = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        intake = read_csv_apart(spark, str(path), {"id": "bigint", "v": "double"})
    finally:
        for key, value in earlier.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    got = [(r["reason"], ",".join(r["columns"]), r["record"]) for r in intake.broken.collect()]
    assert sorted(got) == sorted(broken)
    assert intake.rows.count() + len(got) == 400
    assert rows(intake.rows.where("id < 12")) == sorted(
        [(0, 0.5), (1, 1.0), (5, None), (6, 6.5), (7, 1.0), (11, None)], key=lambda r: [(v is None, str(v)) for v in r]
    )
    places = intake.broken.select("path", "split_start", "line").distinct()
    assert places.count() == len(broken) and {r[0].split("/")[-1] for r in places.select("path").collect()} == {"r.csv"}


def test_refresh_reads_only_touched_buckets(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "VAERS_ID long, v int"
    for batch, ids in ((0, range(1000)), (1, [7])):
        for kind in stream.KINDS:
            df = spark.createDataFrame([(k, 1) for k in ids], schema).withColumn(stream.BUCKET, stream.bucket_of(F.col("VAERS_ID"), 16))
            df.write.partitionBy(stream.BUCKET).parquet(f"{store}/{kind}/batch={batch}")
    tables = {kind: stream.landed(spark, store, kind) for kind in stream.KINDS}
    buckets, picked = stream.rows_to_tally(tables, {kind: {1} for kind in stream.KINDS})
    assert len(buckets) == 1
    for df in picked.values():
        assert df.where("VAERS_ID = 7").count() == 2 and df.count() < 150
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({stream.BUCKET}" in plan or f"PartitionFilters: [{stream.BUCKET}" in plan
        assert len(df.inputFiles()) >= 1 and df.where("batch = 0").select(stream.BUCKET).distinct().count() == 1
