"""Curation of a training corpus: quality, near copies, personal data, mixture, packing.

Every stage works on all that its predecessor kept. All but the last return the columns of the
documents they were given. Texts pass through Python in batches of a bounded number of rows; as
results are computed after a stage returns, the session keeps that setting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlens.llm import jaccard, mixing, quality, surrogates
from reportlens.llm.common import bound_batches, land, packed, unpacked
from reportlens.llm.packing import pack
from reportlens.llm.queries import table, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents below the threshold go. It learns from the labels of these documents."""
    bound_batches(spark)
    return quality.kept(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


#: Name of the landed row number; documents don't have a column of that name.
ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a landed number per row, so that decisions apply to rows, not to ids."""
    return land(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies one document stays, that with the smallest id.

    Of rows that share this id the first stays; a null id comes last. Documents without words are
    in no group and stay, and so do unrelated texts of one id.
    """
    rows = numbered(docs)
    groups = jaccard.near_copies(rows.select(F.col(ROW).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("of"), "component_id")
    ids = rows.select(F.col(ROW).alias("of"), "doc_id")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "of"))
    chosen = groups.join(ids, "of").groupBy("component_id").agg(best.alias("best")).select(F.col("best.of").alias(ROW))
    chosen = land(packed(chosen, ROW, F.lit(1)), "chosen")
    return unpacked(rows, F.col(ROW), chosen, "__kept").select(docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: surrogates in the texts; ``n_chars`` follows where a length changed."""
    bound_batches(spark)
    done = surrogates.distinct_surrogates(docs)
    return done.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")) if "n_chars" in docs.columns else done


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: every row as often as the mix takes it, up to three times, or not at all."""
    rows = numbered(docs)
    taken = mixing.mix(rows, row_col=ROW).select(F.col("row").alias(ROW), "copies").where("copies > 0")
    taken = land(packed(taken, ROW, F.col("copies"), bits=2), "taken")
    return (
        unpacked(rows, F.col(ROW), taken, "__copies", bits=2)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(docs.columns)
    )


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the place of every piece of every document."""
    return pack(docs, vocabulary())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("pii", pii),
    ("mixing", mixture),
    ("best_fit_packing", best_fit_packing),
]

#: The stages learn, tokenize and draw by methods that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is landed for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
