"""Column widths of a report sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PADDING = 2


def column_widths(df: DataFrame) -> DataFrame:
    """Longest text per column, its header included, plus padding.

    Only texts count: dates and numbers never widen a column.  One pass gives
    one row, which is then turned into one row per column.
    """
    columns = df.schema.fields

    def longest(field: T.StructField):
        header = F.lit(len(field.name))
        if not isinstance(field.dataType, T.StringType):
            return F.max(header)
        return F.greatest(F.max(F.length(F.col(f"`{field.name}`"))), F.max(header))

    # An empty table still has its headers.
    measured = df.agg(
        *[F.coalesce(longest(f), F.lit(len(f.name))).alias(f"w{i}") for i, f in enumerate(columns)]
    )
    widths = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column_name"),
                (F.col(f"w{i}") + PADDING).cast("int").alias("width"),
            )
            for i, field in enumerate(columns)
        ]
    )
    return measured.select(F.inline(widths))
