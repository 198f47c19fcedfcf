"""CSV files whose quoted fields contain line breaks, read in splits.

Spark reads such a file in one task, because a split that starts in the middle of a quoted
field cannot know it. Here a first scan lets every split report how it would end if it started
outside a quoted field, and if it started inside one. Chaining these answers over the splits of
a file, a window over one row per split, tells each split how it really starts; the states are
landed. Records that lie within a split are then parsed where they are; only the few that cross
a border, at most one per split, are put together by a shuffle, which is left out, with its
scan, if there are none.

Files without any quote, which the first look at them tells, have a record per line: they are read
without Python, and their splits' states are known.

All scans must cut the files alike. Spark sizes the splits of small inputs by the number of cores,
so cores that come or go between scans can change the cut: then a split has no state, or one of
another length, which is an error, not a loss of rows.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# The functions below travel to the executors with the plan: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|)'
FRESH_LINE = re.compile(rf"{FIELD}(?:,{FIELD})*+")
CONTINUED_LINE = re.compile(rf'(?:[^"]++|"")*+"[^,]*+(?:,{FIELD})*+')

SPLIT = ["file", "split_start"]
LOCATED = "file bigint, split_start bigint, line bigint, record string"
NOT_HERE = 2**60
MAX_RECORD_BYTES = 2**31 - 1  # a longer one does not fit a Spark string
BROADCAST_SPLITS = 2**20  # states of some 60 bytes each


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths))


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is still open at the end of ``line``."""
    if '"' not in line:
        return inside
    return (CONTINUED_LINE if inside else FRESH_LINE).fullmatch(line) is None


def split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Cut batches where a new split begins; one split may span several batches."""
    for batch in batches:
        keys = np.stack([batch[name].to_numpy() for name in SPLIT], axis=1)
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *changes.tolist(), len(keys)]
        for start, end in zip(bounds, bounds[1:]):
            if start < end:
                yield tuple(keys[start].tolist()), batch.slice(start, end - start)


def states_after(lines: pa.Array, inside: bool) -> np.ndarray:
    """Whether a quoted field is open after each line; only lines with a quote are looked at."""
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    states = [inside]
    for line in lines.take(pa.array(quoted)).to_pylist():
        states.append(ends_inside(line, states[-1]))
    return np.repeat(states, np.diff([0, *quoted, len(lines)]))


def split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a split looks like from either start, outside or inside a quoted field.

    ``end_*``: is a field open at the end. ``tail_*``: the line after the last record that
    ends in the split. ``head``: the line after the record the split starts in. Started
    inside, both stay NOT_HERE when that record ends in a later split.
    """
    found: dict[tuple[int, int], dict] = {}
    for key, run in split_runs(batches):
        line = run["line"][0].as_py()
        split = found.setdefault(
            key,
            {
                "length": run["length"][0].as_py(),
                "first": line,
                "end": [False, True],
                "tail": [line, NOT_HERE],
                "head": NOT_HERE,
            },
        )
        same = split["end"][0] == split["end"][1]
        for start in (0, 1):
            if start == 0 or not same:
                after = states_after(run["value"], split["end"][start])
            closed = np.flatnonzero(~after)
            if len(closed):
                split["tail"][start] = line + int(closed[-1]) + 1
                if start == 1 and split["head"] == NOT_HERE:
                    split["head"] = line + int(closed[0]) + 1
            split["end"][start] = bool(after[-1])
    rows = [
        (*key, split["length"], split["first"], *map(int, split["end"]), *split["tail"], split["head"])
        for key, split in found.items()
    ]
    if rows:
        names = [*SPLIT, "length", "first", "end_outside", "end_inside", "tail_outside", "tail_inside", "head"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def check_header(record: str, names: Sequence[str]) -> None:
    found = next(csv.reader([record.removeprefix("\ufeff").rstrip("\r")]))
    if found != list(names):
        raise ValueError(f"CSV header {found} differs from {list(names)}")


def whole_records(
    batches: Iterator[pa.RecordBatch], names: Sequence[str]
) -> Iterator[pa.RecordBatch]:
    """Join the lines of each record; ``batches`` hold only records that end in their split.

    A record is located by its file, its split and its first line.
    """
    current, header, pending = None, False, None
    for key, run in split_runs(batches):
        if key != current:
            current, header, pending = key, key[1] == 0, run["value"].slice(0, 0)
        at = run["line"][0].as_py() - len(pending)
        after = states_after(run["value"], len(pending) > 0)
        ends = np.flatnonzero(~np.concatenate([np.ones(len(pending), bool), after])) + 1
        lines = pa.concat_arrays([pending, run["value"]])
        last = int(ends[-1]) if len(ends) else 0
        bounds = pa.array([0, *ends], pa.int32())
        records = pc.binary_join(pa.ListArray.from_arrays(bounds, lines.slice(0, last)), "\n")
        starts = pa.array(at + np.concatenate([[0], ends])[: len(ends)], pa.int64())
        pending = lines.slice(last)
        if header and len(records):
            check_header(records[0].as_py(), names)
            records, starts, header = records.slice(1), starts.slice(1), False
        place = [pa.array(np.full(len(records), k), pa.int64()) for k in key]
        yield pa.RecordBatch.from_arrays([*place, starts, records], names=[*SPLIT, "line", "record"])


def split_states(lines: DataFrame) -> DataFrame:
    """One row per split: its ``length`` and ``first`` line, and ``head`` to ``tail``, the lines of its
    whole records; ``crossed`` unless these are all its lines. ``begun`` is the split where the
    record begins that this split starts in."""
    names = "end_outside", "end_inside", "tail_outside", "tail_inside", "head"
    ends = lines.mapInArrow(
        split_ends, ", ".join(f"{name} bigint" for name in (*SPLIT, "length", "first", *names))
    )
    outside, inside = F.col("end_outside"), F.col("end_inside")
    fixed, flips = outside == inside, (outside > inside).cast("bigint")
    order = Window.partitionBy("file").orderBy("split_start")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = ends.withColumn("flips", F.sum(flips).over(so_far)).withColumn(
        "anchor", F.when(fixed, outside + F.col("flips"))
    )
    start = F.coalesce(F.last("anchor", ignorenulls=True).over(before), F.lit(0)) + F.coalesce(
        F.lag("flips").over(order), F.lit(0)
    )
    starts_inside = F.col("start") == 1
    opened = F.when(~starts_inside | (F.col("head") < NOT_HERE), F.col("split_start"))
    too_long = F.col("split_start") - F.last(opened, ignorenulls=True).over(so_far) > MAX_RECORD_BYTES
    head = F.when(too_long, F.raise_error("a quoted CSV field does not end")).otherwise(F.col("head"))
    tail = (
        F.when(~F.col("crossed"), F.lit(NOT_HERE))
        .when(starts_inside, F.col("tail_inside"))
        .otherwise(F.col("tail_outside"))
    )
    begins_one = F.when(F.col("tail") < NOT_HERE, F.col("split_start"))
    return (
        counted.withColumn("start", start % 2)
        .withColumn("head", head)
        .withColumn("crossed", starts_inside | (outside == 1))
        .withColumn("tail", tail)
        .select(
            *SPLIT,
            "length",
            "first",
            F.when(starts_inside, F.col("head")).otherwise(F.lit(0)).alias("head"),
            "tail",
            "crossed",
            F.last(begins_one, ignorenulls=True).over(before).alias("begun"),
        )
    )


def plain_splits(lines: DataFrame) -> DataFrame:
    """Per split its ``length``, ``first`` line and whether a line has a quote; no Python."""
    return lines.groupBy(*SPLIT).agg(
        F.max("length").alias("length"),
        F.min("line").alias("first"),
        F.max(F.contains("value", F.lit('"'))).alias("quoted"),
    )


def plain_states(splits: DataFrame) -> DataFrame:
    """``split_states`` of files without quotes: every line is a record."""
    return splits.select(
        *SPLIT,
        "length",
        "first",
        F.lit(0).cast("bigint").alias("head"),
        F.lit(NOT_HERE).alias("tail"),
        F.lit(False).alias("crossed"),
        F.lit(None).cast("bigint").alias("begun"),
    )


def plain_records(placed: DataFrame, names: Sequence[str]) -> DataFrame:
    """The lines but the headers, which must give ``names``."""
    header = F.rtrim(F.regexp_replace("value", "^\ufeff", ""), F.lit("\r"))
    differs = F.concat(F.lit("CSV header "), header, F.lit(f" differs from {','.join(names)}"))
    same = F.split(header, ",", -1) == F.array(*map(F.lit, names))
    is_header = (F.col("split_start") == 0) & (F.col("line") == F.col("first"))
    keep = F.when(~is_header, F.lit(True)).otherwise(
        F.when(same, F.lit(False)).otherwise(F.raise_error(differs).cast("boolean"))
    )
    line = (F.col("line") - F.col("first")).alias("line")
    return placed.where(keep).select(*SPLIT, line, F.col("value").alias("record"))


def crossing_records(placed: DataFrame) -> DataFrame:
    """The records that lie in several splits. A record is known by the split it starts in."""
    line, head, tail = F.col("line"), F.col("head"), F.col("tail")
    begun = F.when(line < head, F.col("begun")).otherwise(F.col("split_start"))
    return (
        placed.where(F.col("crossed") & ((line < head) | (line >= tail)))
        .withColumn("begun", begun)
        .withColumn("is_header", (F.col("split_start") == 0) & (line == F.col("first")))
        .groupBy("file", "begun")
        .agg(
            F.sort_array(F.collect_list(F.struct("split_start", "line", "value"))).alias("parts"),
            F.max("is_header").alias("is_header"),
            F.min(F.struct("split_start", line - F.col("first"))).alias("place"),
        )
        .where(~F.col("is_header"))
        .select(
            "file",
            F.col("begun").alias("split_start"),
            F.col("place.col2").alias("line"),
            F.array_join("parts.value", "\n").alias("record"),
        )
    )


def quoted_records(
    spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]
) -> tuple[list[str], DataFrame]:
    """The header's names, and one row per record: its raw text and where it begins.

    ``file`` is the hash of the path, ``split_start`` the split's first byte, ``line`` the line
    within the split. Runs the first scans at once.
    """
    paths = list(paths)
    scratch = scratch_path(spark, "csv-states")
    header = spark.read.options(**options).option("multiLine", "true").csv(paths).columns
    lines = text_lines(spark, paths).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_block_length").alias("length"),
        # Counts the lines of a task: consecutive within a split, the same in every scan.
        F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias("line"),
        F.make_valid_utf8("value").alias("value"),
    )
    found = plain_splits(lines)
    found.write.parquet(f"{scratch}/plain")
    splits = spark.read.schema(found.schema).parquet(f"{scratch}/plain")
    plain = not splits.where("quoted").limit(1).count()
    found = plain_states(splits) if plain else split_states(lines)
    scratch = f"{scratch}/states"
    found.write.parquet(scratch)
    states = spark.read.schema(found.schema).parquet(scratch).withColumnRenamed("length", "known_length")
    known = states.agg(F.count("*"), F.sum(F.col("crossed").cast("int"))).first()
    if known[0] <= BROADCAST_SPLITS:
        states = F.broadcast(states)
    # Every later use of a state goes through the check, so no filter can drop an unmatched line first.
    lost = F.raise_error(F.lit("the files were cut differently by two scans")).cast("bigint")
    same_cut = F.col("known_length") == F.col("length")
    checked = [F.when(same_cut, F.col(n)).otherwise(lost).alias(n) for n in ("first", "head", "tail")]
    placed = lines.join(states, SPLIT, "left").select(
        *SPLIT, "line", "value", *checked, F.when(same_cut, F.col("crossed")).otherwise(lost == 0).alias("crossed"), "begun"
    )
    line, head, tail = F.col("line"), F.col("head"), F.col("tail")
    if plain:
        records = plain_records(placed, header)
    else:
        whole = (
            placed.where((line >= head) & (line < tail))
            .select(*SPLIT, (line - F.col("first")).alias("line"), "value")
            .mapInArrow(partial(whole_records, names=header), LOCATED)
        )
        records = whole.unionByName(crossing_records(placed)) if known[1] else whole
    record = F.col("record")
    record = F.when(record.endswith("\r"), F.rtrim(record, F.lit("\r"))).otherwise(record)
    return header, records.withColumn("record", record).where(F.trim("record") != "")


def read_quoted(
    spark: SparkSession, paths: Sequence[str], options: Mapping[str, str], mode: str
) -> DataFrame:
    """All columns of the files as text, named by the header of the first file."""
    header, records = quoted_records(spark, paths, options)
    schema = ", ".join(f"`{name}` string" for name in header)
    parser = {**options, "mode": mode, "header": "false", "multiLine": "true"}
    return records.select(F.from_csv("record", schema, parser).alias("fields")).select("fields.*")
