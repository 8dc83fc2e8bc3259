"""SimHash near-duplicates, with pigeonring filtering.

A fingerprint has 64 bits on a ring of 8-bit segments.  If two fingerprints
differ in at most ``radius`` bits, some segment starts a chain in which the
differences of the first l segments stay within ``l * radius / segments``, for
every l.  While that quota is below one, the segments must be equal: they are
the key on which fingerprints meet.  Within a key, chains are followed segment
by segment, and only what survives all quotas has passed the full Hamming check.

Only distinct fingerprints take part.  A key shared by more than ``BUCKET``
of them is refined: the same argument on the ring of its free segments gives
longer keys, down to two free segments, which hold 65,536 fingerprints at most.
A task emits the links of a spanning forest of its bucket, not all pairs.

Defined cases: a text without words, or null, has fingerprint zero and is linked
like any other; rows of equal id keep a row each; a null id gets the component of
its fingerprint; if a component has only null ids, its id is null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import written
from shiftledger.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
SEGMENTS = 8
_WIDTH = 64 // SEGMENTS
#: Fingerprints compared within one task; larger buckets are refined.
BUCKET = 4096
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.array(list(map(xxh64_intdigest, parts, repeat(SEED))), dtype=">u8")
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[start : start + _CHUNK].view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprints(
    documents: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and fingerprint (a long) of every document."""
    rows = documents.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(value.as_py(), shingle) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fingerprint"]
            )

    return rows.mapInArrow(hashed, "doc_id long, fingerprint long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _segment(n: int) -> int:
    return ((1 << _WIDTH) - 1) << (n * _WIDTH)


def key_masks(free: tuple[int, ...], radius: int) -> list[tuple[int, tuple[int, ...], list[tuple[int, int]]]]:
    """For each start on the ring of ``free`` segments: the bits of the key, the
    segments left free, and the chain beyond the key as (bits, quota)."""
    m = len(free)
    run = (m - 1) // radius
    out = []
    for start in range(m) if run else ():
        ring = [free[(start + i) % m] for i in range(m)]
        chain = [
            (sum(map(_segment, ring[:n])), n * radius // m) for n in range(run + 1, m + 1)
        ]
        out.append((sum(map(_segment, ring[:run])), tuple(sorted(ring[run:])), chain))
    return out


def _forest(values: np.ndarray, chain: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints of one bucket."""
    steps = [(np.uint64(bits), quota) for bits, quota in chain]
    left = values
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            differ = left ^ queue.pop()
            near = np.arange(len(left))
            for bits, quota in steps:
                near = near[np.bitwise_count(differ[near] & bits) <= quota]
            if len(near):
                found = left[near]
                yield from ((root, other) for other in found)
                queue.extend(found)
                left = np.delete(left, near)


def _links_in(chains: dict[int, list[tuple[int, int]]]):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current: tuple[int, int] | None = None

        def close(out: list[tuple[int, int]]) -> None:
            values = held[0] if len(held) == 1 else np.concatenate(held)
            if len(values) > 1:
                out.extend(_forest(values, chains[current[0]]))

        def emit(out: list[tuple[int, int]]) -> pa.RecordBatch:
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            mask, value, bits = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
            out: list[tuple[int, int]] = []
            for low, high in zip([0, *cuts], [*cuts, len(mask)], strict=True):
                if low == high:
                    continue
                key = (int(mask[low]), int(value[low]))
                if key != current:
                    if current is not None:
                        close(out)
                    held, current = [], key
                held.append(bits[low:high].view(np.uint64))
            yield emit(out)
        if current is not None:
            out = []
            close(out)
            yield emit(out)

    return compare


def links(
    distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET
) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all within ``radius`` bits."""
    found = distinct.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    if radius < 1:
        return found
    if radius >= SEGMENTS:
        raise ValueError(f"the ring of {SEGMENTS} segments serves a radius below {SEGMENTS}")
    rows, parents = distinct.select("fingerprint"), {None: tuple(range(SEGMENTS))}
    while True:
        keys = {parent: key_masks(free, radius) for parent, free in parents.items()}
        children: dict[int, tuple[int, ...]] = {}
        chains: dict[int, list[tuple[int, int]]] = {}
        choices = {}
        for parent, made in keys.items():
            choices[parent] = []
            for bits, free, chain in made:
                whole = _signed(bits | (0 if parent is None else parent & (1 << 64) - 1))
                # a key reached from several parents follows no chain of one of them: full check
                chains[whole] = chain if whole not in chains else [((1 << 64) - 1, radius)]
                children[whole] = free
                choices[parent].append(whole)
        masks = {p: F.array(*[F.lit(m).cast("long") for m in ms]) for p, ms in choices.items()}
        if parents.keys() == {None}:
            keyed = rows.select("fingerprint", F.explode(masks[None]).alias("mask"))
        else:
            below = F.create_map(*[x for p, m in masks.items() for x in (F.lit(p).cast("long"), m)])
            longer = F.explode(F.element_at(below, F.col("mask")))
            keyed = rows.select("fingerprint", longer.alias("mask")).distinct()
        value = F.col("fingerprint").bitwiseAND(F.col("mask"))
        keyed = keyed.withColumn("value", value)
        refinable = [m for m, free in children.items() if key_masks(free, radius)]
        counts = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        counts = written(counts, "buckets")
        over = (F.col("n") > bucket) & F.col("mask").isin(refinable)
        ordinary = keyed.join(counts.filter(~over).drop("n"), ["mask", "value"])
        ordered = ordinary.select("mask", "value", "fingerprint").repartition("mask", "value")
        ordered = ordered.sortWithinPartitions("mask", "value")
        found = found.unionByName(written(ordered.mapInArrow(_links_in(chains), "a long, b long"), "pairs"))
        hot = counts.filter(over).drop("n")
        if not refinable or hot.isEmpty():
            return found
        rows = written(keyed.join(hot, ["mask", "value"]).select("fingerprint", "mask"), "refined")
        parents = {m: children[m] for m in refinable}


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET, **names
) -> DataFrame:
    """doc_id, fingerprint (a long) and component_id, the smallest id reachable."""
    docs = written(fingerprints(documents, shingle, **names), "fingerprints")
    groups = written(docs.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "groups")
    roots = connected_components(links(groups, radius, bucket))
    of = groups.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    of = written(of, "roots")
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = of.join(least, "root").select("fingerprint", "component_id")
    return docs.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")
