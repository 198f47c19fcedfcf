"""Helpers shared by the operators: landed tables, text folding, vector clean-up."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = "\\x20\\x09-\\x0D"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that the session names in ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; a cluster must name one,
    since its executors don't share local disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{tempfile.gettempdir()}/reportlens-llm"
    return f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def held_out(doc_id: Column, parts: int) -> Column:
    """True where the fold is 0; a null id is never held out."""
    return F.coalesce(fold_of(doc_id, parts) == 0, F.lit(False))


def text_key(text: Column) -> Column:
    """16 bytes of SHA-256 that identify a text."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


#: Rows of a broadcast table of packed numbers; where there are more, Spark chooses the join.
PACKED = 1 << 22


def packed(numbers: DataFrame, key: str, value: Column, bits: int = 1) -> DataFrame:
    """``word`` and ``bits``: values below 2**bits of non-negative keys, 64 // bits of them in a long."""
    per = 64 // bits
    at = (F.pmod(F.col(key), F.lit(per)) * bits).cast("int")
    word = F.shiftright(F.col(key), per.bit_length() - 1).alias("__word")
    return numbers.groupBy(word).agg(F.bit_or(F.call_function("shiftleft", value.cast("long"), at)).alias("__bits"))


def unpacked(df: DataFrame, key: Column, words: DataFrame, name: str, bits: int = 1) -> DataFrame:
    """Rows of ``df`` whose ``key`` has a value above 0 in ``words``, landed by ``packed``, with that value.

    ``df`` is not shuffled unless there are more than ``PACKED`` words.
    """
    per = 64 // bits
    if words.count() <= PACKED:
        words = F.broadcast(words)
    at = (F.pmod(key, F.lit(per)) * bits).cast("int")
    value = F.call_function("shiftrightunsigned", F.col("__bits"), at).bitwiseAND(F.lit(2**bits - 1).cast("long"))
    found = df.withColumn("__word", F.shiftright(key, per.bit_length() - 1)).join(words, "__word")
    return found.withColumn(name, value.cast("int")).where(F.col(name) > 0).drop("__word", "__bits")


#: Rows of an Arrow batch that holds whole texts or sets.
ARROW_ROWS = 1000


def bound_batches(spark: SparkSession) -> str:
    """From now on the session's Arrow batches have up to ``ARROW_ROWS`` rows; the setting until now."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= ARROW_ROWS:  # 0 and less: no bound
        spark.conf.set(key, str(ARROW_ROWS))
    return before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """``bound_batches`` for what runs inside."""
    before = bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


Batches = Iterator[pa.RecordBatch]


def frugal(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``; its worker, which stays for later tasks, gives free memory back."""

    @wraps(run)
    def whole(batches: Batches) -> Batches:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim:
            trim(0)

    return whole
