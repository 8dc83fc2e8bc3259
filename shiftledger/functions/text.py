"""Text keys and names.  ``concat`` is null if any part is null, on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def search_key(*parts: Column) -> Column:
    """Parts run together without a separator; days in ISO form."""
    return F.concat(*[part.cast("string") for part in parts])


def display_text(value: Column) -> Column:
    """A cell as the report table shows it: null is the empty text."""
    return F.coalesce(value.cast("string"), F.lit(""))
