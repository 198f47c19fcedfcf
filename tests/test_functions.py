"""Column expressions, predicates and schema helpers on hand-made values."""

import re

import pytest
from comparing import rows
from pyspark.sql import functions as F

from reportlens.functions import columns as C
from reportlens.functions import predicates as P
from reportlens.functions.schema import CURATED_SCHEMA, conform_schema
from reportlens.operators import curate as K
from reportlens.rules import (
    DECADE_BREAKS,
    DECADE_LABELS,
    DEFAULT_RULES,
    MAKER_RULES,
    SYMPTOM_DENY_PATTERN,
)


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_clean_text_strips_every_white_space(spark):
    items = ["~a!", "b ", " c", "d\x7f", "é", "", "  a b ", "\tx\n", " nbsp　", "\u0085 y ", "straße", None, "\r\n", "​z"]
    assert values(spark, "string", items, C.clean_text("v")) == [
        "~A!", "B", "C", "D\x7f", "É", "", "A B", "X", "NBSP", "Y", "STRASSE", None, "", "​Z",
    ]


def test_flag_is_three_valued(spark):
    assert values(spark, "string", ["Y", "N", "y", "", None], C.flag_equals("v", "Y")) == [1, 0, 0, 0, None]


def test_map_category(spark):
    items = ["PFIZER\\BIONTECH", "MODERNA", "JOHNSON & JOHNSON", "J&J", "NOVAVAX", None, "MODERNA BIONTECH"]
    mapped = C.map_category("v", MAKER_RULES, "OTHER")
    assert values(spark, "string", items, mapped) == [
        "PFIZER", "MODERNA", "JANSSEN", "JANSSEN", "OTHER", "OTHER", "PFIZER",
    ]
    kept = C.map_category("v", MAKER_RULES, F.col("v"))
    assert values(spark, "string", ["X", None, "J&J"], kept) == ["X", None, "JANSSEN"]


@pytest.mark.parametrize("pattern", [SYMPTOM_DENY_PATTERN, "BRAND#1$|BRAND#11", "A|B", "J&J"])
def test_patterns_mean_the_same_as_regular_expressions(spark, pattern):
    items = [
        "INTESTINAL OBSTRUCTION", "SOFT TISSUE SWELLING", "RASH", "COVID-19 PNEUMONIA", "PRODUCT",
        "INCORRECT DOSE ADMINISTERED", "DOSE", "BRAND#1", "BRAND#12", "BRAND#11", "J&J", "", "covid19",
    ]
    assert values(spark, "string", [*items, None], C.contains_pattern("v", pattern)) == [
        *[re.search(pattern, item) is not None for item in items], None,
    ]


def test_bucketize(spark):
    rules = DEFAULT_RULES
    groups = C.bucketize("v", rules.age_breaks, rules.age_labels, rules.age_unknown)
    items = [0.0, 17.99, 18.0, 64.9, 65.0, 119.0, None]
    assert values(spark, "double", items, groups) == [
        "0-17", "0-17", "18-64", "18-64", "65+", "65+", "Unknown",
    ]
    decades = C.bucketize("v", DECADE_BREAKS, DECADE_LABELS, "Unknown")
    assert values(spark, "double", [29.0, 30.0, 79.9, 80.0], decades) == ["18-29", "30-39", "70-79", "80+"]
    with pytest.raises(ValueError, match="label"):
        C.bucketize("v", [1], ["a"], "b")


def test_shares_and_defaults(spark):
    assert values(spark, "bigint", [1000, 7, 0, 37], C.int_share("v", 0.07, 1)) == [70, 1, 1, 2]
    assert values(spark, "bigint", [1000, 7, 0], C.int_share("v", 0.07, 0)) == [70, 0, 0]
    assert values(spark, "double", [None, 0.0, 51.25], C.default_if_falsy("v", 45.0)) == [45.0, 45.0, 51.25]
    assert values(spark, "bigint", [10, 0], C.guarded_ratio(F.lit(5), 0.5, "v")) == [25.0, 0.0]


def test_tolerant_cast(spark):
    assert values(spark, "string", ["4.5", "old", "", None], C.tolerant_cast("v", "double")) == [
        4.5, None, None, None,
    ]


def test_iso_timestamp(spark):
    items = ["2024-05-06T07:08:09.5Z", "2024-05-06T07:08:09", None]
    text = F.date_format(C.iso_timestamp("v"), "yyyy-MM-dd HH:mm:ss.S")
    assert values(spark, "string", items, text) == [
        "2024-05-06 07:08:09.5", "2024-05-06 07:08:09.0", "1970-01-01 00:00:00.0",
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, "string", ["yesterday"], C.iso_timestamp("v"))


def test_valid_text_counts_characters(spark):
    items = ["éééé", "éé", "", None, "RASH", "FLU"]
    assert values(spark, "string", items, P.valid_text("v", 3)) == [True, False, False, False, True, False]


def test_population_is_kleene_or(spark):
    df = spark.createDataFrame(
        [("covid19-2", None), (None, " Moderna "), (None, "X"), ("FLU", None), ("FLU", "PFIZER\\WYETH")],
        "t string, m string",
    )
    rule = P.in_population(C.clean_text("t"), C.clean_text("m"), DEFAULT_RULES.target_type_pattern, DEFAULT_RULES.target_makers)
    assert [r[0] for r in df.select(rule).collect()] == [True, True, None, None, False]


def test_conform_schema(spark):
    full = spark.createDataFrame(
        [(1, None, 1, "40", "rash", "PFIZER")],
        "VAERS_ID long, died_flag long, hospital_flag int, age_clean string, symptom string, manufacturer string",
    )
    partial = spark.createDataFrame([(2, "unknown", "x")], "VAERS_ID long, age_clean string, extra string")
    union = conform_schema([full, partial])
    assert dict(union.dtypes) == CURATED_SCHEMA
    assert [tuple(r) for r in union.orderBy("VAERS_ID").collect()] == [
        ("1", None, 1, 40.0, "rash", "PFIZER"),
        ("2", 0, 0, None, None, None),
    ]


def test_clean_curated(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 0, 1.0, "Rash", " Pfizer\\BioNTech "),
            (2, 1, 0, 1.0, "Product quality issue", "PFIZER"),
            (3, 1, 0, 1.0, "Intestinal test", "moderna"),
            (4, 1, 0, 1.0, "Fever", "MODERNA"),
            (5, 1, 0, 1.0, "Flu", "MODERNA"),
            (6, 1, 0, 1.0, "Rash", "NOVAVAX"),
            (7, 1, 0, 1.0, None, "MODERNA"),
        ],
        "VAERS_ID long, died_flag long, hospital_flag long, age_clean double, symptom string, manufacturer string",
    )
    cleaned = P.clean_curated(df, DEFAULT_RULES)
    assert rows(cleaned, "VAERS_ID", "symptom", "manufacturer") == [
        (1, "Rash", "PFIZER"),
        (3, "Intestinal test", "MODERNA"),
    ]


def test_rows_without_an_id_drop_out(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b")], "VAERS_ID long, x string")
    ids = spark.createDataFrame([(None,), (1,)], "VAERS_ID long")
    assert rows(K.keep_members(df, ids, "VAERS_ID")) == [(1, "b")]
