"""Which terms are reported together: frequent pairs with support, confidence and lift.

Terms below the minimum support can't be part of a frequent pair, so they go first. What is left
of a report is a sorted array of at most as many terms as are frequent. Its pairs are formed
inside one row, straight into the partial aggregation; a report with more than ``BLOCK`` terms is
dealt out as pairs of blocks of its terms, which are spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.run import land
from ..rules import DEFAULT_RULES, Rules
from ..session import scratch_path
from .curate import keep_members, select_symptoms

#: Terms of a report that are paired in one row.
BLOCK = 128


def reported_terms(symptoms: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Distinct ``report`` and ``term`` of the rows with an id and a usable medical term."""
    rows = select_symptoms(symptoms, rules).where(F.col(rules.id_col).isNotNull())
    return rows.select(F.col(rules.id_col).alias("report"), F.col("symptom").alias("term")).distinct()


def pairs_of(left: Column, right: Column) -> Column:
    """All (a, b) with a from ``left``, b from ``right`` and a before b."""
    return F.flatten(
        F.transform(
            left,
            lambda a: F.transform(
                F.filter(right, lambda b: b > a), lambda b: F.struct(a.alias("term_a"), b.alias("term_b"))
            ),
        )
    )


def dealt_blocks(wide: DataFrame, block: int) -> DataFrame:
    """``left`` and ``right`` blocks of the terms of wide reports, each unordered pair of blocks once,
    spread over the tasks."""
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("terms") - 1) / block).cast("int")),
        lambda i: F.slice("terms", i * block + 1, F.lit(block)),
    )
    blocks = wide.select("report", cut.alias("blocks"))
    lefts = blocks.select("report", "blocks", F.posexplode("blocks").alias("l", "left"))
    later = F.slice("blocks", F.col("l") + 1, F.size("blocks"))
    return lefts.select("report", "l", "left", F.posexplode(later).alias("r", "right")).repartition("report", "l", "r")


def cooccurrence(
    symptoms: DataFrame, rules: Rules = DEFAULT_RULES, min_reports: int = 2, block: int = BLOCK
) -> DataFrame:
    """One row per pair of terms that at least ``min_reports`` reports share, ``term_a`` before ``term_b``.

    ``support`` is the share of all reports with a usable term, ``confidence_ab`` that of the
    reports of ``term_a`` that also have ``term_b``, ``lift`` the quotient of ``support`` and what
    independent terms would give.
    """
    spark = symptoms.sparkSession
    terms = land(reported_terms(symptoms, rules), scratch_path(spark, "report-terms"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_reports)
    counts = land(counts, scratch_path(spark, "frequent-terms"))
    all_reports = terms.agg(F.count_distinct("report")).first()[0]
    kept = keep_members(terms, counts, "term")
    baskets = kept.groupBy("report").agg(F.array_sort(F.collect_list("term")).alias("terms")).where(F.size("terms") > 1)
    baskets = land(baskets, scratch_path(spark, "baskets"))
    narrow = baskets.where(F.size("terms") <= block).select(F.col("terms").alias("left"), F.col("terms").alias("right"))
    wide = dealt_blocks(baskets.where(F.size("terms") > block), block).select("left", "right")
    pairs = narrow.unionByName(wide).select(F.inline(pairs_of(F.col("left"), F.col("right"))))
    counted = pairs.groupBy("term_a", "term_b").agg(F.count(F.lit(1)).alias("reports_both"))
    frequent = counted.where(F.col("reports_both") >= min_reports)
    sides = [counts.select(F.col("term").alias(f"term_{s}"), F.col("n").alias(f"reports_{s}")) for s in "ab"]
    both, a, b = (F.col(f"reports_{x}").cast("double") for x in ("both", "a", "b"))
    return (
        frequent.join(sides[0], "term_a")
        .join(sides[1], "term_b")
        .select(
            "term_a",
            "term_b",
            "reports_both",
            "reports_a",
            "reports_b",
            (both / all_reports).alias("support"),
            (both / a).alias("confidence_ab"),
            (both / b).alias("confidence_ba"),
            (both * all_reports / (a * b)).alias("lift"),
        )
    )
