"""Bring tables with differing columns to one fixed schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Schema of the curated table and what a column absent from the input means.
CURATED_SCHEMA = {
    "VAERS_ID": "string",
    "died_flag": "bigint",
    "hospital_flag": "bigint",
    "age_clean": "double",
    "symptom": "string",
    "manufacturer": "string",
}
CURATED_ABSENT = {"died_flag": 0, "hospital_flag": 0}
CURATED_TOLERANT = ("age_clean",)
# End of fixed values.


def conform_schema(
    dfs: Sequence[DataFrame],
    schema: Mapping[str, str] = CURATED_SCHEMA,
    absent_defaults: Mapping[str, object] = CURATED_ABSENT,
    tolerant: Sequence[str] = CURATED_TOLERANT,
) -> DataFrame:
    """Bag union of ``dfs`` cast to ``schema``.

    A default replaces a column that an input does not have; a NULL that is present stays
    NULL. Columns named in ``tolerant`` turn unparsable values into NULL, others raise.
    """

    def conformed(df: DataFrame) -> DataFrame:
        present = set(df.columns)
        picked = []
        for name, type_name in schema.items():
            if name not in present:
                value = F.lit(absent_defaults.get(name)).cast(type_name)
            elif name in tolerant:
                value = F.col(name).try_cast(type_name)
            else:
                value = F.col(name).cast(type_name)
            picked.append(value.alias(name))
        return df.select(*picked)

    return reduce(DataFrame.unionByName, map(conformed, dfs))
