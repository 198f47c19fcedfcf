"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of every path is addressed by the SHA-256 of its text. The ledger, a folder of
Parquet tables, holds which blob was scanned by which version of which rule, and what was found.
A run scans the blobs for which a pair of blob and rule version is missing, each once however
many paths hold it, and only by the rules missing; findings then go back to all paths by a join.
A run counts only after its line in ``runs`` is written, so a run that breaks off leaves findings
that nobody reads, and is simply repeated.

Positions come from the texts between the matches: their lengths and those of the matches,
added up in the order of the text. Only texts in which a rule matches are cut up for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import land, shared_path


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``shortest``
    characters at least; shorter ones drop out after matching. A changed rule needs a new version."""

    kind: str
    pattern: str
    group: int
    shortest: int
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three kinds that the contract counts.
BASE = (
    Rule(
        "assign",
        "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
        "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    # The shorter runs never hide a longer one, so the length can be part of the pattern.
    Rule("access", "AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", "[0-9a-f]{32,}", 0, 32),
)
# End of fixed values.

#: Beyond these: the first line of a private key.
RULES = (*BASE, Rule("pem", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", 0, 1))

SCANNED = "blob binary, rule string"
FINDINGS = "blob binary, rule string, kind string, start long, end long, secret binary"
RUNS = "run string"


def complete_runs(spark: SparkSession, ledger: str) -> list[str]:
    """The runs that came to their end; one name per run of the job."""
    try:
        return sorted(row.run for row in spark.read.schema(RUNS).parquet(f"{ledger}/runs").collect())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def known(spark: SparkSession, ledger: str, name: str, schema: str) -> DataFrame:
    """The rows of a ledger's table that belong to complete runs."""
    runs = complete_runs(spark, ledger)
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{ledger}/{name}/{run}" for run in runs])


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def addressed(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The versions with ``blob``, the SHA-256 of their text (null: empty) as 32 bytes, and ``key``."""
    blob = F.unhex(F.sha2(whole(F.col("text")).cast("binary"), 256))
    return versions.withColumn("blob", blob).withColumn("key", F.struct(*keys))


def missing(addresses: DataFrame, scanned: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob``, ``key`` of one of its holders, and ``todo``, the names of the rules not yet applied."""
    one = addresses.groupBy("blob").agg(F.min("key").alias("key"))
    done = scanned.groupBy("blob").agg(F.collect_set("rule").alias("done"))
    names = F.array(*[F.lit(rule.name) for rule in rules])
    todo = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
    return one.join(done, "blob", "left").select("blob", "key", todo.alias("todo")).where(F.size("todo") > 0)


def matches(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, rule, kind, start, end, secret`` of texts with columns ``blob``, ``text``, ``todo``.

    Positions count code points, the end is exclusive; ``secret`` is the SHA-256 of the match.
    """
    text, parts = F.col("text"), []
    for rule in rules:
        pattern = F.lit(rule.pattern)
        between = F.transform(F.split(text, pattern, -1), F.length)
        found = F.regexp_extract_all(text, pattern, F.lit(0))
        cut = F.struct(F.lit(rule.name).alias("rule"), between.alias("between"), found.alias("found"))
        parts.append(F.when(F.array_contains("todo", rule.name) & text.rlike(rule.pattern), cut))
    # Rows that are equal altogether are cut one by one, and give equal spans.
    tagged = texts.withColumn("copy", F.monotonically_increasing_id())
    cuts = tagged.select("blob", "copy", F.explode(F.array_compact(F.array(*parts))).alias("cut"))
    # The text after the last match has no match beside it.
    pairs = F.arrays_zip(F.slice("cut.between", F.lit(1), F.size("cut.found")).alias("between"), F.col("cut.found").alias("found"))
    each = cuts.select("blob", "copy", "cut.rule", F.posexplode(pairs).alias("place", "pair")).select(
        "blob", "copy", "rule", "place", F.col("pair.between").alias("between"), F.col("pair.found").alias("found")
    )
    upto = Window.partitionBy("blob", "copy", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("between") + F.length("found")).over(upto)
    long_enough, kind = F.lit(False), F.lit(None).cast("string")
    for rule in rules:
        picked = F.regexp_extract("found", rule.pattern, rule.group) if rule.group else F.col("found")
        long_enough = F.when(F.col("rule") == rule.name, F.length(picked) >= rule.shortest).otherwise(long_enough)
        kind = F.when(F.col("rule") == rule.name, F.lit(rule.kind)).otherwise(kind)
    return (
        each.withColumn("end", end.cast("long"))
        .where(long_enough)
        .select(
            "blob",
            "rule",
            kind.alias("kind"),
            (F.col("end") - F.length("found")).alias("start"),
            "end",
            F.unhex(F.sha2(F.col("found").cast("binary"), 256)).alias("secret"),
        )
        .distinct()
    )


def update(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, keys: Sequence[str] = ("path", "version")) -> DataFrame:
    """Bring the ledger up to date with ``versions``; returns their addresses.

    ``versions`` has a column ``text`` and the columns ``keys``, which tell its rows apart; all but
    the text come back with ``blob``. The texts of unseen blobs are fetched by one of their
    holders. If Spark finds these few, as in later runs, no text is shuffled at all.
    """
    spark = versions.sparkSession
    source = addressed(versions.drop("blob", "key", "todo"), keys)
    addresses = land(source.drop("text"), "addresses")
    run = uuid.uuid4().hex
    todo = land(missing(addresses, known(spark, ledger, "scanned", SCANNED), rules), "todo")
    texts = source.select("blob", "key", whole(F.col("text")).alias("text")).join(todo, ["blob", "key"])
    matches(texts.select("blob", "text", "todo"), rules).write.parquet(f"{ledger}/findings/{run}")
    todo.select("blob", F.explode("todo").alias("rule")).write.parquet(f"{ledger}/scanned/{run}")
    spark.createDataFrame([(run,)], RUNS).coalesce(1).write.mode("append").parquet(f"{ledger}/runs")
    return addresses.drop("key")


def findings(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """All findings of the given rule versions, one row per blob and span."""
    return known(spark, ledger, "findings", FINDINGS).where(F.col("rule").isin([rule.name for rule in rules]))


def by_path(addresses: DataFrame, found: DataFrame) -> DataFrame:
    """One row per path, version and span.

    Both sides pass an exchange of the join, so AQE can split a blob that very many paths hold.
    """
    return addresses.join(found, "blob")


def joined(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def blob_summary(found: DataFrame, rules: Sequence[Rule], base: Sequence[Rule]) -> DataFrame:
    """Per blob with findings: number of spans per kind of ``base``, their list and that of all spans."""
    order = F.lit(len(rules))
    for place, rule in enumerate(rules):
        order = F.when(F.col("kind") == rule.kind, F.lit(place)).otherwise(order)
    kinds = [rule.kind for rule in base]
    spans = F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "end", "kind")))
    in_base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in kinds]
    return (
        found.groupBy("blob")
        .agg(spans.alias("spans"), *counts)
        .select("blob", *[f"n_{kind}" for kind in kinds], joined(in_base).alias("base"), joined(F.col("spans")).alias("spans"))
    )


def secrets(docs: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per document: ``doc_id``, spans per base kind, their SHA-256 and all spans as text.

    Reads ``doc_id`` and ``text``; other columns are ignored. A null text is empty and holds
    nothing, a null id stays null, equal rows give equal rows, an empty table gives none. A text
    of any length is scanned whole; its spans make one cell.
    """
    spark = docs.sparkSession
    ledger = ledger or shared_path(spark, "ledger")
    addresses = update(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ledger, rules, ["doc_id"])
    summary = land(blob_summary(findings(spark, ledger, rules), rules, BASE), "secrets")
    none = F.lit(0).cast("long")
    return addresses.join(summary, "blob", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{rule.kind}", none).alias(f"n_{rule.kind}") for rule in BASE],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
