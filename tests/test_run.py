"""The domain fixture end to end, with results worked out by hand."""

import json
from pathlib import Path

import pytest
from comparing import close, rows

from reportlens.operators.analyses import (
    manufacturer_totals,
    report_tally,
    severity_by_age,
    symptoms_by_manufacturer,
    tally_rows,
)
from reportlens.operators.curate import curate, curate_counted, target_ids
from reportlens.operators.quality import check_outputs
from reportlens.plans.run import input_paths, read_inputs, run_analyses
from reportlens.plans.serving import CHARTS, chart_query
from reportlens.sources.datasource import SPECS, ingest_files, read_datasource
from reportlens.sources.tables import RESULT_SCHEMAS, load_results
from reportlens.sources.files import read_result_csv

TS = "2024-05-06T07:08:09.000000Z"

SYMPTOM_ROWS = [
    ("PFIZER", "MYOCARDITIS", 3, 2, 3),
    ("MODERNA", "TACHYCARDIA", 2, 0, 0),
    ("JANSSEN", "PYREXIA", 1, 0, 1),
    ("JANSSEN", "RASH", 1, 0, 0),
    ("MODERNA", "DYSPNOEA", 1, 0, 1),
    ("MODERNA", "MYOCARDITIS", 1, 0, 1),
    ("PFIZER", "CHEST PAIN", 1, 0, 1),
    ("PFIZER", "DYSPNOEA", 1, 0, 1),
    ("PFIZER", "RASH", 1, 1, 0),
]
SEVERITY_ROWS = [
    ("0-17", "JANSSEN", 1, 0, 0, 17.5, 0.0, 0.0, 0.0, 0),
    ("18-64", "JANSSEN", 1, 0, 1, 40.0, 0.0, 100.0, 100.0, 1),
    ("18-64", "MODERNA", 2, 0, 2, 33.0, 0.0, 100.0, 100.0, 2),
    ("18-64", "PFIZER", 3, 0, 3, 43.63333333333333, 0.0, 100.0, 100.0, 3),
    ("65+", "MODERNA", 2, 0, 0, 65.0, 0.0, 0.0, 0.0, 0),
    ("65+", "PFIZER", 2, 2, 2, 70.0, 100.0, 100.0, 200.0, 4),
    ("Unknown", "PFIZER", 1, 1, 0, None, 100.0, 0.0, 100.0, 1),
]
TOTAL_ROWS = [
    ("JANSSEN", 2, 0, 1, 28.75),
    ("MODERNA", 4, 0, 2, 49.0),
    ("PFIZER", 6, 3, 5, 54.18),
]


@pytest.fixture(scope="module")
def inputs(spark, data_dir):
    return list(read_inputs(spark, input_paths(data_dir)).values())


@pytest.fixture(scope="module", params=["folded", "salted", "row by row"])
def tally(inputs, request):
    if request.param == "row by row":
        return tally_rows(curate(*inputs)).cache()
    return report_tally(*inputs, salt_buckets=5 if request.param == "salted" else 1).cache()


def test_target_ids(inputs):
    assert [r[0] for r in target_ids(inputs[2]).orderBy("VAERS_ID").collect()] == [
        1, 2, 3, 4, 5, 6, 8, 9, 11,
    ]


def test_curated_rows(inputs):
    curated = curate(*inputs)
    assert curated.count() == 12
    folded = curate_counted(*inputs)
    keys = ["VAERS_ID", "died_flag", "hospital_flag", "age_clean", "symptom", "manufacturer"]
    assert rows(folded, *keys, "n_rows") == rows(curated.groupBy(*keys).count(), *keys, "count")


def test_symptoms(tally):
    got = symptoms_by_manufacturer(tally, TS)
    assert [tuple(r)[:5] for r in got.collect()] == SYMPTOM_ROWS
    assert {r[0] for r in got.select("__time").collect()} == {TS}


def test_severity(tally):
    got = severity_by_age(tally, TS).orderBy("age_group", "manufacturer")
    close([tuple(r)[:10] for r in got.collect()], SEVERITY_ROWS)
    assert {tuple(r) for r in got.select("er_visits", "__time").collect()} == {(0, TS)}


def test_totals(tally):
    close([tuple(r) for r in manufacturer_totals(tally).orderBy("manufacturer").collect()], TOTAL_ROWS)


def test_run_publish_serve(spark, data_dir, tmp_path):
    out = str(tmp_path / "out")
    summary = run_analyses(spark, input_paths(data_dir), out, TS)
    assert summary["status"] == "success"
    assert summary["total_results"] == 9
    assert summary["curated_rows"] == 12
    assert summary["rows_read"] == {"reports": 10, "symptoms": 19, "vaccines": 14}

    lines = []
    for part in sorted(Path(out, "severity_for_druid.json").glob("part-*")):
        lines += [json.loads(line) for line in part.read_text().splitlines()]
    assert len(lines) == 7
    unknown = next(line for line in lines if line["age_group"] == "Unknown")
    assert unknown["avg_age"] is None and unknown["VAX_MANU_CLEAN"] == "PFIZER"

    stored = read_result_csv(spark, f"{out}/chunked_symptoms_analysis.csv", RESULT_SCHEMAS["symptoms"])
    assert rows(stored)[0][:5] == ("JANSSEN", "PYREXIA", 1, 0, 1)

    assert all(load_results(spark, out).values())
    assert len(check_outputs(spark)) == 3
    by_maker = chart_query(spark, CHARTS["reports_by_manufacturer"])
    assert rows(by_maker) == [("JANSSEN", 2), ("MODERNA", 4), ("PFIZER", 6)]
    assert chart_query(spark, CHARTS["top_symptoms"]).first()[:] == ("MYOCARDITIS", 4)
    assert chart_query(spark, CHARTS["hospitalizations_by_age"]).columns == ["age_group", "Hospitalizaciones"]
    assert chart_query(spark, CHARTS["reports_by_state"]).count() == 15

    for name, spec in SPECS.items():
        path = str(tmp_path / name)
        for _ in range(2):
            ingest_files(spark, out, spec, path)
        stored = read_datasource(spark, spec, path)
        assert stored.count() == {"symptoms": 9, "severity": 7, "geographic": 45}[name]
        assert {r[0] for r in stored.select("day").collect()} == {"2024-05-06"}


def test_landed_inputs_give_the_same(spark, data_dir, tmp_path):
    out, landing = str(tmp_path / "out"), str(tmp_path / "landed")
    summary = run_analyses(spark, input_paths(data_dir), out, TS, landing=landing)
    assert (summary["curated_rows"], summary["input_files"]) == (12, 3)
    landed = [spark.read.parquet(f"{landing}/{kind}") for kind in ("reports", "symptoms", "vaccines")]
    got = symptoms_by_manufacturer(report_tally(*landed), TS)
    assert [tuple(r)[:5] for r in got.collect()] == SYMPTOM_ROWS


def test_no_results(spark, data_dir, tmp_path):
    folder = tmp_path / "none"
    folder.mkdir()
    for name in ("VAERSDATA.csv", "VAERSSYMPTOMS.csv"):
        (folder / name).write_text(Path(data_dir, name).read_text())
    (folder / "VAERSVAX.csv").write_text("VAERS_ID,VAX_TYPE,VAX_MANU\n1,FLU4,SANOFI\n")
    summary = run_analyses(spark, input_paths(str(folder)), str(tmp_path / "o"), TS)
    assert summary["status"] == "no_results"
    assert not (tmp_path / "o").exists()
