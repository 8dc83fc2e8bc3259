"""Approximate nearest neighbours by cosine, over shifted Hilbert orderings.

Every vector gets one key per ordering: its direction is projected on a few
random orthogonal axes, shifted by a random offset, cut into cells and placed
on a Hilbert curve.  Spark range-sorts all keys.  Around each query the neighbours
within a window on both sides are candidates; they are scored exactly, in double
precision on the original vectors, and the orderings' best are merged.  Queries
visit all blocks their windows reach, so no neighbour is lost to partitioning.

The window is ``window`` at least, and grows until it holds a share of ``recall``
of the true neighbours of ``ASKED`` queries, found by one pass over all vectors.
On vectors without clusters it grows almost with the table, and the work with it.

The cells of an ordering are fitted on at most ``SAMPLE`` vectors, those with
the smallest hash of their id; every vector is indexed.

Equal vectors are one point of the index and carry their smallest ids, one
more than asked for; so a vector that fills a third of the table costs one point.

Defined cases: vectors that are null, all zero, or hold a null or non-finite
component take no part, nor do rows without an id; vectors are compared with
those of their own length only; repeated rows of equal id and vector count
once; with fewer candidates than asked for, all are returned; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import small_frame, with_position, written
from shiftledger.llm.hilbert import hilbert_keys

NEAREST = 5
ORDERINGS = 32
WINDOW = 576
AXES = 12
BITS = 5
SAMPLE = 5_000
SEED = 7
#: Keys in a block; longer windows make longer blocks, up to ``LONGEST``.
BLOCK = 4096
LONGEST = 16_384
#: The window holds this share of the true neighbours of so many queries.
RECALL = 0.95
ASKED = 200
#: Queries scored at once.
CHUNK = 64


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _curves(dim: int, sample: np.ndarray | None, orderings: int, seed: int):
    """Axes, lower ends and cells per unit of every ordering."""
    random = np.random.default_rng([seed, dim])
    count = min(AXES, dim)
    out = []
    for _ in range(orderings):
        axes = np.linalg.qr(random.normal(size=(dim, dim)))[0][:, :count]
        low, high = np.full(count, -4 / dim**0.5), np.full(count, 4 / dim**0.5)
        if sample is not None and len(sample) > 1:
            low, high = np.quantile(sample @ axes, [0.001, 0.999], axis=0)
        span = np.maximum(high - low, 1e-9) * 1.3
        shift = random.uniform(0, 0.25, size=count) - 0.05
        out.append((axes, low - shift * span, (1 << BITS) / span))
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so that no square overflows or vanishes
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _keys(points: DataFrame, curves: dict[int, list], orderings: int, seed: int) -> DataFrame:
    names = ["ordering", "dim", "key", "node", "asked"]

    def keyed(batches):
        made = dict(curves)
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in made:
                    made[dim] = _curves(dim, None, orderings, seed)
                rows = batch.filter(pa.array(dims == dim))
                unit = _unit(_matrix(rows.column("embedding")))
                for n, (axes, low, scale) in enumerate(made[dim]):
                    cells = np.clip((unit @ axes - low) * scale, 0, (1 << BITS) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(unit), n, np.int32)),
                            pa.array(np.full(len(unit), dim, np.int32)),
                            pa.array(hilbert_keys(cells.astype(np.int64), BITS)),
                            rows.column("node"),
                            rows.column("asked"),
                        ],
                        names=names,
                    )

    schema = "ordering int, dim int, key long, node long, asked boolean"
    return points.select("node", "dim", "asked", "embedding").mapInArrow(keyed, schema)


def _exact(points: DataFrame, sample: list[tuple[int, list[float]]], nearest: int) -> dict[int, list[int]]:
    """The true nearest nodes of the points (node, embedding) in ``sample``, by a pass over all points."""
    by_dim: dict[int, list[tuple[int, list[float]]]] = {}
    for node, vector in sample:
        by_dim.setdefault(len(vector), []).append((node, vector))
    asked = {dim: (np.array([n for n, _ in of]), _unit(np.array([v for _, v in of]))) for dim, of in by_dim.items()}

    def best(batches):
        found = {dim: (np.full((len(n), nearest), -np.inf), np.full((len(n), nearest), -1)) for dim, (n, _) in asked.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in set(np.unique(dims).tolist()) & asked.keys():
                rows = batch.filter(pa.array(dims == dim))
                other = rows.column("node").to_numpy()
                queries, unit = asked[dim]
                scores = unit @ _unit(_matrix(rows.column("embedding"))).T
                scores[queries[:, None] == other] = -np.inf
                scores = np.concatenate([found[dim][0], scores], axis=1)
                nodes = np.concatenate([found[dim][1], np.broadcast_to(other, (len(queries), len(other)))], axis=1)
                first = np.argpartition(scores, -nearest, axis=1)[:, -nearest:]
                found[dim] = tuple(np.take_along_axis(a, first, axis=1) for a in (scores, nodes))
        for dim, (scores, nodes) in found.items():
            real = np.isfinite(scores)
            queries = np.repeat(asked[dim][0], real.sum(axis=1))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (queries, nodes[real], scores[real]))), names=["query", "other", "score"])

    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "other")
    found = points.select("node", "dim", "embedding").mapInArrow(best, "query long, other long, score double")
    rows = found.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= nearest).collect()
    out: dict[int, list[int]] = {}
    for row in rows:
        out.setdefault(row["query"], []).append(row["other"])
    return out


def _fitted_window(points: DataFrame, placed: DataFrame, nearest: int, window: int, recall: float) -> int:
    """``window``, or the one that holds a share of ``recall`` of the true neighbours of ``ASKED`` queries."""
    asked = points.filter("asked").orderBy(F.xxhash64("node"), "node").limit(ASKED)
    true = _exact(points, [tuple(r) for r in asked.select("node", "embedding").collect()], nearest)
    pairs = [(query, other) for query, others in true.items() for other in others]
    if not pairs:
        return window
    nodes = np.unique(pairs)
    named = small_frame(points.sparkSession, {"node": pa.array(nodes, pa.int64())})
    rows = placed.join(F.broadcast(named), "node").select("node", "ordering", "position").collect()
    place = np.zeros((len(nodes), 1 + max(r["ordering"] for r in rows)), np.int64)
    for row in rows:
        place[np.searchsorted(nodes, row["node"]), row["ordering"]] = row["position"]
    query, other = np.searchsorted(nodes, np.array(pairs)).T
    gaps = np.abs(place[query] - place[other]).min(axis=1)
    return max(window, int(np.quantile(gaps, recall, method="higher")))


def _best(block: int, nearest: int, window: int):
    """Scores one block for the queries in it or visiting it; returns the nearest of its nodes for each."""

    def score(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        place = table.column("position").to_numpy()
        node = table.column("node").to_numpy()
        curve = table.column("ordering").to_numpy().astype(np.int64) << 32
        curve |= table.column("dim").to_numpy()
        asked = table.column("asked").to_numpy()
        own = place // block == table.column("block").to_numpy()
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for here in np.unique(curve[asked]).tolist():
            rows = np.flatnonzero(curve == here)
            unit = _unit(_matrix(table.column("embedding").take(pa.array(rows))))
            near, queries = np.flatnonzero(own[rows]), np.flatnonzero(asked[rows])
            if not len(near):
                continue
            units, places = unit[near], place[rows[near]]
            for start in range(0, len(queries), CHUNK):
                at = queries[start : start + CHUNK]
                scores = unit[at] @ units.T
                gap = np.abs(place[rows[at]][:, None] - places)
                scores[(gap > window) | (gap == 0)] = -np.inf
                if len(near) > nearest:
                    # products of matrices may round otherwise than the scores below
                    least = np.partition(scores, -nearest, axis=1)[:, -nearest, None] - 1e-9
                    scores[scores < least] = -np.inf
                i, j = np.nonzero(np.isfinite(scores))
                values = np.einsum("ij,ij->i", unit[at[i]], units[j])
                others = node[rows[near[j]]]
                order = np.lexsort((others, -values, i))
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                order = order[rank < nearest]
                found.append((node[rows[at[i[order]]]], others[order], values[order]))
        query, other, value = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table({"query": query, "other": other, "score": value})

    return score


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, nearest: int = NEAREST, orderings: int = ORDERINGS,
    window: int = WINDOW, block: int = BLOCK, seed: int = SEED, vec_id: str = "vec_id", embedding: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the nearest found for each query.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{embedding}`").cast("array<double>").alias("embedding"),
    ).filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))

    # the limit on the rank is applied before the shuffle, so a frequent vector sends a few ids per task
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    least = rows.distinct().withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= nearest + 1)
    points = least.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.filter(is_query).select("vec_id", "embedding").distinct()
    asked_points = asked.select("embedding").distinct().withColumn("asked", F.lit(True))
    points = written(
        points.join(asked_points, "embedding", "left").select(
            F.col("ids")[0].alias("node"),
            "ids",
            F.size("embedding").alias("dim"),
            F.coalesce("asked", F.lit(False)).alias("asked"),
            "embedding",
        ),
        "points",
    )
    sample = points.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").collect()
    by_dim: dict[int, list] = {}
    for (vector,) in sample:
        by_dim.setdefault(len(vector), []).append(vector)
    curves = {
        dim: _curves(dim, _unit(np.array(found)), orderings, seed) for dim, found in by_dim.items()
    }

    keys = _keys(points, curves, orderings, seed)
    order = [F.col(c).asc() for c in ("ordering", "dim", "key", "node")]
    placed = with_position(keys, order).drop("key")
    window = _fitted_window(points, placed, nearest, window, recall)
    block = max(block, min(window, LONGEST))

    def number(position: Column) -> Column:
        return F.floor(position / block)

    position = F.col("position")
    reached = F.sequence(number(F.greatest(position - window, F.lit(0))), number(position + window))
    blocks = F.when(F.col("asked"), reached).otherwise(F.array(number(position)))
    spread = placed.withColumn("block", F.explode(blocks))
    # blocks that no query reaches need no vectors
    busy = spread.filter("asked").select("block").distinct()
    located = spread.join(busy, "block").join(points.select("node", "embedding"), "node")
    best = written(
        located.groupBy("block").applyInArrow(
            _best(block, nearest, window), "query long, other long, score double"
        ),
        "best",
    )
    merged = best.groupBy("query", "other").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "other")
    merged = merged.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= nearest)
    ids = points.select(F.col("node").alias("other"), "ids")
    others = merged.join(ids, "other").select("query", "ids", "score")
    # scaled by the largest component first, as above
    asked_now = points.filter("asked").select(F.col("node").alias("query"), "ids", "embedding")
    largest = F.array_max(F.transform("embedding", F.abs)).alias("largest")
    scaled = F.transform("embedding", lambda x: x / F.col("largest")).alias("scaled")
    square = F.aggregate("scaled", F.lit(0.0), lambda a, x: a + x * x).alias("square")
    selves = asked_now.select("*", largest).select("query", "ids", scaled).select("query", "ids", square)
    selves = selves.select("query", "ids", (F.col("square") / (F.sqrt("square") * F.sqrt("square"))).alias("score"))
    candidates = others.unionByName(selves).select("query", "score", F.explode("ids").alias("vec_id"))
    queries = asked.join(points.filter("asked").select("node", "embedding"), "embedding").select(
        F.col("vec_id").alias("query_id"), F.col("node").alias("query")
    )
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.join(candidates, "query")
        .filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(by_rank))
        .filter(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
