import pytest
from pyspark.sql import types as T
from texts import edge_texts, prose

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside.
        T.StructField("score", T.StringType()),
        T.StructField("n", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def edge_rows():
    texts = edge_texts()
    rows = [(k, t, "en", ["a", "b", None, "ä"][k % 4], len(t or ""), "s", "x") for k, t in enumerate(texts)]
    rows.append(rows[7])  # the same row again
    rows.append((None, prose(1, 120), None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
