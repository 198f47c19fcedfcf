"""Helpers to compare results."""

import pytest


def rows(df, *columns):
    """Sorted tuples of a small result, for comparisons."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def close(actual, expected):
    """Same tuples in the same order; doubles within 1e-9."""
    assert len(actual) == len(expected)
    for got, want in zip(actual, expected):
        for left, right in zip(got, want):
            assert left == (pytest.approx(right, rel=1e-9, abs=1e-9) if isinstance(right, float) else right)
