"""Running sums over rows in order, without a window that holds a whole segment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.llm.common import written

_PART, _ROW, _SEGMENT = "__part", "__row", "__segment"
_WRAP = 1 << 64


def _before(values: np.ndarray, new: np.ndarray, carried: np.ndarray) -> np.ndarray:
    """Sums of the values before each row in its segment; ``carried`` goes to the rows before the first new one."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=total[1:])
    start = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    sums = total[:-1] - total[start]
    later = np.flatnonzero(new)
    sums[: later[0] if len(later) else len(sums)] += carried
    return sums


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def running_sums(
    df: DataFrame, order: list[Column], values: list[str], segment: Column | None = None
) -> DataFrame:
    """``df`` with ``<value>_before``: the sum of a long column over the earlier rows in ``order``, modulo 2 ** 64.

    ``segment``, a long that leads the order, starts each sum anew.  Neither the
    values nor the segment may be null.  One range sort; every partition sums its
    rows, then adds what the ones before it leave for its first segment.  The
    driver gets one row per partition.
    """
    segment = F.lit(0) if segment is None else segment
    schema = T.StructType(list(df.schema.fields)).add(_SEGMENT, "long").add(_PART, "integer").add(_ROW, "long")
    kept, names = df.columns, [f"{name}_before" for name in values]
    for name in names:
        schema = schema.add(name, "long")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried, row = None, [np.zeros(1, np.uint64)] * len(values), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held = _column(batch, _SEGMENT)
            new = np.concatenate([[last is None or held[0] != last], held[1:] != held[:-1]])
            own = [_column(batch, name) for name in values]
            sums = [_before(v, new, c) for v, c in zip(own, carried, strict=True)]
            carried = [s[-1:] + v[-1:] for s, v in zip(sums, own, strict=True)]
            last = held[-1]
            rows = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            arrays = [*batch.columns, rows, *map(_longs, sums)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, _ROW, *names])

    ordered = df.withColumn(_SEGMENT, segment.cast("long")).orderBy(*order)
    summed = written(ordered.withColumn(_PART, F.spark_partition_id()).mapInArrow(local, schema), "sums")
    ends = summed.groupBy(_PART).agg(
        F.max_by(F.struct(_SEGMENT, *values, *names), _ROW).alias("last"),
        F.min_by(_SEGMENT, _ROW).alias("first"),
    )
    carry: dict[int, tuple[int, list[int]]] = {}
    at, sums = None, [0] * len(values)
    for end in sorted(ends.collect(), key=lambda r: r[_PART]):
        last = end["last"]
        if at is not None and end["first"] == at:
            carry[end[_PART]] = (at, sums)
        else:
            sums = [0] * len(values)
        if last[_SEGMENT] != end["first"]:
            sums = [0] * len(values)
        at = last[_SEGMENT]
        sums = [(s + last[v] + last[b]) % _WRAP for s, v, b in zip(sums, values, names, strict=True)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, held = (batch.column(n).to_numpy(zero_copy_only=False) for n in (_PART, _SEGMENT))
            out = [_column(batch, name).copy() for name in names]
            for number in np.unique(part):
                if int(number) in carry:
                    of, amounts = carry[int(number)]
                    here = (part == number) & (held == of)
                    for column, amount in zip(out, amounts, strict=True):
                        column[here] += np.uint64(amount)
            arrays = [batch.column(name) for name in kept] + list(map(_longs, out))
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

    schema = T.StructType(list(df.schema.fields))
    for name in names:
        schema = schema.add(name, "long")
    return summed.mapInArrow(add, schema)
