"""Select the population and join reports, symptoms and manufacturers.

Every count of the analyses is a count of joined rows: a report with two symptom rows and
three dose rows counts six times. ``curate`` produces exactly that bag. ``curate_counted``
gives the same bag with equal rows folded into one row and a count, without ever building
the pairs, so repeated doses or symptom rows of one report cost nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clean_text, first_non_null, flag_equals, map_category
from ..functions.predicates import (
    allow_list,
    deny_exact,
    deny_regex,
    in_population,
    select_where,
    valid_text,
)
from ..rules import DEFAULT_RULES, Rules


def target_ids(vaccines: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Distinct ids with at least one vaccine row of the population."""
    target = in_population(
        clean_text(rules.type_col),
        clean_text(rules.maker_col),
        rules.target_type_pattern,
        rules.target_makers,
    )
    return vaccines.where(target).select(rules.id_col).distinct()


def keep_members(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is in ``ids``; rows without an id drop out.

    The hash of the id as a second key changes nothing in the result. It makes distinct ids,
    already grouped by id, pass through an exchange of the join like the rows do, and only
    then can AQE split the rows of an id that is much more frequent than the others.
    """
    key_hash = F.xxhash64(id_col).alias("id_hash")
    members = ids.select(id_col, key_hash)
    return df.select("*", key_hash).join(members, [id_col, "id_hash"], "left_semi").select(*df.columns)


def report_facts(
    reports: DataFrame, rules: Rules = DEFAULT_RULES, extra: Sequence[str] = ()
) -> DataFrame:
    """Id, outcome flags and age of every report row."""
    return reports.select(
        rules.id_col,
        flag_equals(rules.died_col, rules.flag_value).alias("died_flag"),
        flag_equals(rules.hospital_col, rules.flag_value).alias("hospital_flag"),
        first_non_null(*rules.age_cols).alias("age_clean"),
        *extra,
    )


def select_reports(
    reports: DataFrame, ids: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Facts of the reports that belong to the population."""
    return report_facts(keep_members(reports, ids, rules.id_col), rules)


def select_symptoms(symptoms: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Id and cleaned symptom of the rows with a usable medical term."""
    return select_where(
        symptoms,
        [rules.id_col, clean_text(rules.symptom_col).alias("symptom")],
        valid_text("symptom", rules.symptom_min_length)
        & deny_regex("symptom", rules.symptom_deny_pattern)
        & deny_exact("symptom", rules.symptom_deny_terms),
    )


def dose_texts(vaccines: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Id, cleaned type and cleaned manufacturer of every dose row."""
    return vaccines.select(
        rules.id_col,
        clean_text(rules.type_col).alias("type_text"),
        clean_text(rules.maker_col).alias("maker_text"),
    )


def manufacturer_of(rules: Rules = DEFAULT_RULES) -> Column:
    """Standard manufacturer of a cleaned text."""
    return map_category("maker_text", rules.maker_rules, rules.maker_default)


def select_manufacturers(vaccines: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Id and standard manufacturer of every dose row of a known manufacturer."""
    return select_where(
        dose_texts(vaccines, rules),
        [rules.id_col, manufacturer_of(rules).alias("manufacturer")],
        allow_list("manufacturer", rules.makers),
    )


def curate(
    reports: DataFrame,
    symptoms: DataFrame,
    vaccines: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """One row per report row, symptom row and dose row with the same id."""
    key = rules.id_col
    return (
        select_reports(reports, target_ids(vaccines, rules), rules)
        .join(select_symptoms(symptoms, rules), key)
        .join(select_manufacturers(vaccines, rules), key)
    )


# --- counted form ---------------------------------------------------------------------


def count_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def maker_column(position: int) -> str:
    return f"doses_{position}"


def dose_counts(vaccines: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per id of the population: how many dose rows each manufacturer has.

    Membership and the counts come from the same pass over the dose rows. The partial
    aggregate folds all rows of one id inside each map task, so an id with a third of the
    table arrives at its reducer as one row per task.
    """
    target = in_population(
        "type_text", "maker_text", rules.target_type_pattern, rules.target_makers
    )
    doses = [maker_column(i) for i in range(len(rules.makers))]
    rows = select_where(
        dose_texts(vaccines, rules),
        [
            rules.id_col,
            F.coalesce(target, F.lit(False)).alias("target"),
            manufacturer_of(rules).alias("manufacturer"),
        ],
        F.col(rules.id_col).isNotNull()
        & (F.col("target") | allow_list("manufacturer", rules.makers)),
    )
    return (
        rows.groupBy(rules.id_col)
        .agg(
            F.max("target").alias("target"),
            *[
                F.count_if(F.col("manufacturer") == maker).alias(name)
                for name, maker in zip(doses, rules.makers)
            ],
        )
        .where(F.col("target"))
        .where(sum((F.col(name) for name in doses), F.lit(0)) > 0)
        .drop("target")
    )


def symptom_counts(symptoms: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per id and symptom, so one id never has more rows than there are terms."""
    return count_rows(select_symptoms(symptoms, rules), [rules.id_col, "symptom"], "symptom_rows")


def join_symptoms(
    exposures: DataFrame, symptoms: DataFrame, rules: Rules, salt_buckets: int = 1
) -> DataFrame:
    """Join symptoms to counted reports and doses on the id.

    The hash of the id as a second key makes the exposures, already grouped by id, pass an
    exchange of the join, so that AQE can split an id with very many symptom rows.
    ``salt_buckets`` above 1 spreads such an id without AQE: its symptom rows go to that many
    partitions and its few exposure rows are repeated in each. Each pair still meets once.
    """
    key = rules.id_col
    if salt_buckets <= 1:
        key_hash = F.xxhash64(key).alias("id_hash")
        hashed = [df.select("*", key_hash) for df in (exposures, symptoms)]
        return hashed[0].join(hashed[1], [key, "id_hash"]).drop("id_hash")
    salted = symptoms.withColumn(
        "salt", F.pmod(F.xxhash64("symptom"), F.lit(salt_buckets)).cast("int")
    )
    repeated = exposures.withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
    )
    return repeated.join(salted, [key, "salt"]).drop("salt")


def rows_per_maker(
    df: DataFrame, rules: Rules, keep: Sequence[str], measures: dict[str, dict[str, Column]]
) -> DataFrame:
    """Turn one column per manufacturer into one row per manufacturer.

    ``measures`` maps an output column to its expression for each manufacturer.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(maker).alias("manufacturer"),
                *[by_maker[maker].alias(name) for name, by_maker in measures.items()],
            )
            for maker in rules.makers
        ]
    )
    return df.select(*keep, F.inline(rows))


def curate_counted(
    reports: DataFrame,
    symptoms: DataFrame,
    vaccines: DataFrame,
    rules: Rules = DEFAULT_RULES,
    salt_buckets: int = 1,
) -> DataFrame:
    """The rows of ``curate`` with equal rows folded, and ``n_rows`` saying how many there are."""
    key = rules.id_col
    facts = ["died_flag", "hospital_flag", "age_clean"]
    counted_reports = count_rows(report_facts(reports, rules), [key, *facts], "report_rows")
    exposures = counted_reports.join(dose_counts(vaccines, rules), key)
    joined = join_symptoms(exposures, symptom_counts(symptoms, rules), rules, salt_buckets)
    n_rows = {
        maker: F.col("report_rows") * F.col("symptom_rows") * F.col(maker_column(i))
        for i, maker in enumerate(rules.makers)
    }
    return rows_per_maker(joined, rules, [key, *facts, "symptom"], {"n_rows": n_rows}).where(
        F.col("n_rows") > 0
    )
