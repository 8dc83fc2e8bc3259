"""Ranks in a linked list that no task holds whole.

The list is contracted round by round.  A task takes a block of neighbouring
ids and follows the links that stay within it, so that each piece of the list
becomes one row: its head, its length and where it leads.  The heads are a
shorter list.  Where ids do not follow the list, and a round leaves more than
half of the rows, a round of random mates joins pairs instead, which takes out a
quarter of any list by expectation.  Then every row adds its place in its piece
to the rank of its head.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import with_position, written

#: Ids followed within one task.
BLOCK = 8192
_PIECES = "id long, head long, offset long, next long, total long"


def _followed(held: pa.Table) -> pa.Table:
    """The pieces of the list within a block, by doubling the steps back."""
    held = held.sort_by("id")
    ids, weight = (held.column(n).to_numpy() for n in ("id", "weight"))
    following = held.column("next").combine_chunks()
    after = following.fill_null(-1).to_numpy(zero_copy_only=False)
    place = np.minimum(np.searchsorted(ids, after), len(ids) - 1)
    inside = ids[place] == after
    back = np.arange(len(ids))
    back[place[inside]] = np.flatnonzero(inside)
    offset = np.where(back == np.arange(len(ids)), 0, weight[back])
    while True:
        further = back[back]
        if np.array_equal(further, back):
            break
        offset, back = offset + offset[back], further
    tail = np.flatnonzero(~inside)
    total, leads = np.zeros(len(ids), np.int64), np.full(len(ids), -1, np.int64)
    total[back[tail]], leads[back[tail]] = offset[tail] + weight[tail], after[tail]
    return pa.table(
        {
            "id": ids,
            "head": ids[back],
            "offset": offset,
            "next": pa.array(leads, mask=leads < 0),
            "total": total,
        }
    )


def _contracted(links: DataFrame) -> DataFrame:
    return written(links.groupBy("block").applyInArrow(_followed, _PIECES), "pieces")


def _mated(links: DataFrame, turn: int) -> DataFrame:
    """Pairs of a row with coin 0 and a follower with coin 1, each a piece; other rows by themselves."""
    tossed = links.withColumn("coin", F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)))
    first = tossed.filter("coin = 0").select("id", "weight", F.col("next").alias("mate"))
    second = tossed.filter("coin = 1").select(
        F.col("id").alias("mate"), F.col("next").alias("mate_next"), F.col("weight").alias("mate_weight")
    )
    pairs = written(first.join(second, "mate"), "pairs")
    taken = pairs.select(F.col("mate").alias("id"), F.col("id").alias("head"), F.col("weight").alias("offset"))
    none = F.lit(None).cast("long")
    taken = taken.withColumns({"next": none, "total": F.lit(0).cast("long")})
    paired = F.col("mate").isNotNull()
    left = (
        links.select("id", "next", "weight")
        .join(pairs.select(F.col("mate").alias("id")), "id", "left_anti")
        .join(pairs.drop("weight"), "id", "left")
        .select(
            "id",
            F.col("id").alias("head"),
            F.lit(0).cast("long").alias("offset"),
            F.when(paired, F.col("mate_next")).otherwise(F.col("next")).alias("next"),
            (F.col("weight") + F.coalesce("mate_weight", F.lit(0))).alias("total"),
        )
    )
    return written(left.unionByName(taken), "mates")


def _heads(pieces: DataFrame) -> DataFrame:
    return pieces.filter("id = head").select("id", "next", F.col("total").alias("weight"))


def list_ranks(links: DataFrame, block: int = BLOCK) -> DataFrame:
    """``links`` (id from 0, next; null at the end) of one list as id and rank, from 0 at its head."""
    links = links.select("id", "next", F.lit(1).cast("long").alias("weight"))
    links = links.withColumn("block", F.floor(F.col("id") / block).cast("long"))
    rounds = [_contracted(links)]
    count, turn = links.count(), 0
    while (heads := _heads(rounds[-1])).count() > 1:
        left = heads.count()
        if 2 * left > count and left > block:
            turn += 1
            rounds.append(_mated(heads, turn))
            heads = _heads(rounds[-1])
        count = left
        placed = with_position(heads, [F.col("id")], "place")
        blocks = placed.withColumn("block", F.floor(F.col("place") / block).cast("long")).drop("place")
        rounds.append(_contracted(written(blocks, "heads")))
    ranks = rounds[-1].select("id", F.col("offset").alias("rank"))
    for pieces in reversed(rounds[:-1]):
        above = ranks.withColumnRenamed("id", "head")
        joined = pieces.join(above, "head")
        ranks = written(joined.select("id", (F.col("rank") + F.col("offset")).alias("rank")), "ranks")
    return ranks
