"""Joining fields on their coordinate labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridlake.cluster import broadcast_within


def align_inner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose labels are in both fields, with the values of both."""
    return left.join(right, list(keys))


def merge_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose labels are in either field; the other's values are missing there."""
    return left.join(right, list(keys), "full_outer")


def with_dimension(df: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "inner",
                   rows: int | None = None) -> DataFrame:
    """Add the columns of a static table. ``rows`` bounds its length, so that it may be broadcast."""
    return df.join(broadcast_within(dimension, rows), list(keys), how)
