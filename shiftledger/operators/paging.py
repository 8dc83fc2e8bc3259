"""Rows n to n + k of an order, found by rank instead of a sort of all rows.

Every pass picks some rows as pivots and counts the rows between neighbouring
ones.  What lies wholly before or after the page is set aside by the next pass,
so the passes grow with the logarithm of the rows, and only what is left
around the page is sorted.  The driver gets the pivots and their counts.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that are sorted to cut a page from.
SORTED_ROWS = 10_000
#: Groups that rows are dealt to by hash; each gives two pivots.
GROUPS = 64
_ROW, _PIVOTS, _PLACE = "__row", "__pivots", "__place"


class RankedRows:
    """Rows in the order of a key, ascending or descending, then of all columns."""

    def __init__(self, df: DataFrame, key: Column, order: list[Column], ascending: bool) -> None:
        self._columns, self._order, self._ascending = [f"`{name}`" for name in df.columns], order, ascending
        # structs compare nulls as lowest
        self._row = F.struct(F.struct(key).alias("key"), F.struct(*self._columns).alias("all"))
        self._df = df

    def _not_after(self, pivot: Column, row: Column) -> Column:
        """Whether the pivot stands before the row, or equals it."""
        ahead = pivot["key"] < row["key"] if self._ascending else pivot["key"] > row["key"]
        return ahead | ((pivot["key"] == row["key"]) & (pivot["all"] <= row["all"]))

    def _pivots(self, df: DataFrame, depth: int) -> DataFrame:
        """Different rows in order, numbered; two of every group that has two."""
        chance = F.xxhash64(*self._columns, F.lit(depth))
        picked = df.groupBy(F.pmod(chance, F.lit(GROUPS)).alias("group")).agg(
            F.min_by(self._row, chance).alias("least"), F.max_by(self._row, chance).alias("most")
        )
        rows = picked.select(F.explode(F.array("least", "most")).alias(_ROW)).distinct()
        towards = F.col(f"{_ROW}.key").asc() if self._ascending else F.col(f"{_ROW}.key").desc()
        found = rows.orderBy(towards, F.col(f"{_ROW}.all")).toArrow()
        numbered = found.append_column(_PLACE, pa.array(range(found.num_rows), pa.int32()))
        return df.sparkSession.createDataFrame(numbered)

    def _counts(self, df: DataFrame, pivots: DataFrame, many: int) -> list[int]:
        """Rows before the first pivot, and from each pivot to the next."""
        listed = F.sort_array(F.collect_list(F.struct(_PLACE, _ROW)))
        table = pivots.agg(F.transform(listed, lambda p: p[_ROW]).alias(_PIVOTS))
        rows = df.select(self._row.alias(_ROW)).crossJoin(F.broadcast(table))

        def further(place: Column, step: Column) -> Column:
            pivot = F.get(F.col(_PIVOTS), place + step - 1)
            return F.when(self._not_after(pivot, F.col(_ROW)), place + step).otherwise(place)

        steps = [1 << bit for bit in reversed(range(many.bit_length()))]
        place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)
        counted = rows.groupBy(place.alias(_PLACE)).agg(F.count(F.lit(1)).alias("rows"))
        counts = [0] * (many + 1)
        for row in counted.collect():
            counts[row[_PLACE]] = row["rows"]
        return counts

    def _between(self, df: DataFrame, pivots: DataFrame, low: int, high: int, many: int) -> DataFrame:
        """Rows of the ranges from ``low`` to ``high``, counted as in ``_counts``."""

        def pivot(place: int) -> Column:
            return pivots.filter(F.col(_PLACE) == place).select(_ROW).scalar()

        if low > 0:
            df = df.filter(self._not_after(pivot(low - 1), self._row))
        if high < many:
            df = df.filter(~self._not_after(pivot(high), self._row))
        return df

    def _rows(self, df: DataFrame, first: int, end: int, total: int | None, limit: int, depth: int) -> DataFrame:
        if total is not None and total <= limit:
            return df.orderBy(*self._order).offset(first).limit(end - first)
        pivots = self._pivots(df, depth)
        many = pivots.count()
        if many <= 1:  # all rows are equal
            return df.offset(first).limit(end - first)
        counts = self._counts(df, pivots, many)
        starts = [sum(counts[:place]) for place in range(many + 2)]
        end = min(end, starts[-1])
        touched = [p for p in range(many + 1) if counts[p] and starts[p] < end and starts[p + 1] > first]
        if not touched:
            return df.limit(0)
        low, high = touched[0], touched[-1]
        held = starts[high + 1] - starts[low]
        if held <= limit or low == high:
            part = self._between(df, pivots, low, high, many)
            return self._rows(part, first - starts[low], end - starts[low], held, limit, depth + 1)
        # the page ends in one range and begins in another; those in between are part of it
        parts = [
            self._rows(self._between(df, pivots, p, p, many), max(first - starts[p], 0), min(end, starts[p + 1]) - starts[p], counts[p], limit, depth + 1)
            for p in (low, high)
        ]
        if high > low + 1:
            parts.append(self._between(df, pivots, low + 1, high - 1, many))
        return reduce(DataFrame.unionByName, parts)

    def page(self, first: int, size: int, limit: int = SORTED_ROWS) -> DataFrame:
        """Rows ``first`` to ``first + size``, in order."""
        found = self._rows(self._df, first, first + size, None, limit, 0)
        return found.orderBy(*self._order)
