"""Joins that treat null as a key value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys``, where null meets null.  Keys come out once."""
    renamed = right.withColumnsRenamed({key: f"right_{key}" for key in keys})
    matches = [F.col(key).eqNullSafe(F.col(f"right_{key}")) for key in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, matches), "left").drop(
        *[f"right_{key}" for key in keys]
    )
