"""Scalar column expressions. All are built-in Spark expressions, so they stay in codegen."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# End of fixed values.

_REGEX_SYNTAX = re.compile(r"[\\^$.?*+()\[\]{}]")

EPOCH = "1970-01-01T00:00:00Z"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col: Column | str) -> Column:
    """Upper-case, then strip white space of any kind (plain ``trim`` strips blanks only).

    Stripping a set of characters is slow. Text that begins and ends with a visible ASCII
    character, nearly all of it, needs none.
    """
    col = as_column(col)
    first_visible = (col >= "!") & (col < "\x7f")
    last = F.substring(col, -1, 1)
    last_visible = (last >= "!") & (last < "\x7f")
    upper = F.upper(col)
    return F.when(first_visible & last_visible, upper).otherwise(F.trim(upper, F.lit(WHITE_SPACE)))


def contains_pattern(col: Column | str, pattern: str) -> Column:
    """TRUE where ``pattern`` matches anywhere in ``col``; NULL stays NULL.

    An alternation of plain words becomes substring tests, which are several times cheaper
    than a regular expression; a word that contains another one of the list is redundant.
    """
    col = as_column(col)
    words = pattern.split("|")
    if _REGEX_SYNTAX.search(pattern) or not all(words):
        return col.rlike(pattern)
    needed = [w for w in dict.fromkeys(words) if not any(o != w and o in w for o in words)]
    return reduce(Column.__or__, [col.contains(word) for word in needed])


def flag_equals(col: Column | str, value: str) -> Column:
    """1 where equal, 0 where different, NULL where unknown."""
    return (as_column(col) == F.lit(value)).cast("bigint")


def first_non_null(*cols: Column | str) -> Column:
    return F.coalesce(*[as_column(c) for c in cols])


def map_category(
    col: Column | str, rules: Sequence[tuple[str, str]], default: Column | str | None
) -> Column:
    """Label of the first rule whose pattern matches, else ``default`` (a literal or a column)."""
    otherwise = default if isinstance(default, Column) else F.lit(default)
    return reduce(
        lambda rest, rule: F.when(contains_pattern(col, rule[0]), F.lit(rule[1])).otherwise(rest),
        reversed(rules),
        otherwise,
    )


def bucketize(
    col: Column | str, breaks: Sequence[float], labels: Sequence[str], null_label: str
) -> Column:
    """Label of the half-open interval the value falls in; ``labels`` has one more than ``breaks``."""
    if len(labels) != len(breaks) + 1:
        raise ValueError("bucketize needs exactly one more label than breaks")
    col = as_column(col)
    expr = F.when(col.isNull(), F.lit(null_label))
    for limit, label in zip(breaks, labels):
        expr = expr.when(col < F.lit(limit), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def tolerant_cast(col: Column | str, type_name: str) -> Column:
    """Cast; text that does not parse becomes NULL."""
    return as_column(col).try_cast(type_name)


def rate(numerator: Column | str, denominator: Column | str, scale: float = 100.0) -> Column:
    """``numerator * scale / denominator`` in double; ``scale=1.0`` gives a fraction."""
    return (
        as_column(numerator).cast("double") * F.lit(float(scale)) / as_column(denominator).cast("double")
    )


def int_share(col: Column | str, factor: Column | float, floor: int) -> Column:
    """Share of a total truncated to an integer, not below ``floor``."""
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    share = (as_column(col).cast("double") * factor).cast("bigint")
    return F.greatest(F.lit(floor).cast("bigint"), share)


def guarded_ratio(
    value: Column | str, factor: Column | float, denominator: Column | str, scale: float = 100.0
) -> Column:
    """``value * factor * scale / denominator`` where the denominator is positive, else 0.0."""
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    denominator = as_column(denominator)
    part = as_column(value).cast("double") * factor * F.lit(float(scale))
    return F.when(denominator > 0, part / denominator.cast("double")).otherwise(F.lit(0.0))


def default_if_falsy(col: Column | str, value: float) -> Column:
    """``value`` where the column is NULL or zero."""
    col = as_column(col)
    return F.when(col.isNull() | (col == 0), F.lit(value)).otherwise(col)


def iso_timestamp(
    col: Column | str, missing: str = EPOCH, type_name: str = "timestamp"
) -> Column:
    """Parse ISO-8601 text; only a missing value takes the default, malformed text raises."""
    fallback = F.lit(missing).cast("timestamp").cast(type_name)
    return F.coalesce(as_column(col).cast(type_name), fallback)


def null_safe_sum(col: Column | str) -> Column:
    """Sum that is 0, not NULL, for a group without values."""
    return F.coalesce(F.sum(as_column(col)), F.lit(0))
