"""One query per operator over the whole given tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    jaccard,
    ledger,
    likelihood,
    mixing,
    packing,
    postings,
    prefix_trie,
    quality,
    resampling,
    suffixes,
    surrogates,
    threshold,
    twins,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.rank(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op2_suffix_array_dedup(spark, sf_dir):
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


def op3_warc(spark, sf_dir):
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op4_posting_lists(spark, sf_dir):
    return postings.nearest(table(spark, sf_dir, "embeddings"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard.near_copies(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op7_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.distinct_surrogates(docs, count_col="n_entities")


def op9_recurrent_lm(spark, sf_dir):
    return likelihood.likelihoods(table(spark, sf_dir, "documents"))


def op10_threshold_top_k(spark, sf_dir):
    return threshold.top_k(table(spark, sf_dir, "embeddings"), every_row=True)


def op11_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_blob_ledger(spark, sf_dir):
    return ledger.secrets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_warc": op3_warc,
    "op4_posting_lists": op4_posting_lists,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_mixing": op7_mixing,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_recurrent_lm": op9_recurrent_lm,
    "op10_threshold_top_k": op10_threshold_top_k,
    "op11_resampling": op11_resampling,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_blob_ledger": op13_blob_ledger,
}

ORACLE: dict[str, str] = {
    **twins.ORACLE,
    "op10_threshold_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::double) FOR x IN embedding] AS q FROM embeddings
            WHERE embedding IS NOT NULL
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id, rank, vec_id, score FROM (
            SELECT query_id, vec_id, score,
                (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::int AS rank
            FROM scored
        ) WHERE rank <= 5
    """,
    "op3_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), first AS (
            SELECT payload_digest, min(page_id) AS first_id FROM p WHERE strlen(html) >= 100
            GROUP BY payload_digest
        )
        SELECT page_id, strlen(html) AS payload_bytes, p.payload_digest,
            CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN first ON p.payload_digest = first.payload_digest AND strlen(html) >= 100
    """,
}
