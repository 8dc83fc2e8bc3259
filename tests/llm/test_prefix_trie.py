"""The trie, its list ranks and its running sums against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shiftledger.llm import prefix_trie as trie
from shiftledger.llm.list_ranks import list_ranks
from shiftledger.llm.running import running_sums

SCHEMA = "conv_id long, turn long, role string, text string, `a.b` int, depth int, node string, size int, words string, number int"
EXTRA = (1, 2, "x", 3, "y", 4)


def by_turn(rows):
    talks = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            talks.setdefault(conv_id, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in talks.items()}


def rebuild(talks):
    out = {}
    for conv_id, turns in talks.items():
        lent = zlib.crc32(str(conv_id).encode()) % 4
        out[conv_id] = talks.get(conv_id - conv_id % 20, [])[:lent] + turns[lent:]
    return out


def expected(talks):
    members = {}
    for conv_id, turns in talks.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv_id)
    rows = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum(
            (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p
        )
        rows.append((
            min(convs),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(convs),
            sum(len(p) == len(path) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            saved,
            hashlib.sha256(",".join(map(str, sorted(c for c in convs if len(talks[c]) == len(path)))).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def found(spark, rows, source=trie.rebuilt_conversations, **options):
    table = spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, trie.prefix_trie(*source(table), **options).collect()), key=str)


def conversations():
    rng = random.Random(5)
    texts = ["", None, "a b", "c\x0bd  e", "żółw x", "a b c"]
    rows = []
    for conv_id in [*range(0, 45), 61, 63, 64, 2**40]:
        for turn in range(rng.randint(1, 6)):
            rows.append((conv_id, turn, rng.choice(["user", "user", None, "bot"]), rng.choice(texts)))
    # a hot conversation that several others repeat in full, and one much longer than a block
    rows += [(c, t, "user", f"same {t}") for c in (100, 101, 102, 103, 104, 120, 140) for t in range(5)]
    rows += [(150, t, "user", f"long {t % 7}") for t in range(400)]
    rows += [(None, 0, "user", "no conversation"), (9, None, "user", "null turn first"), (200, 0, "x", "only"), (201, 0, "x", "only")]
    return rows


@pytest.mark.parametrize("block", [4, 64, 8192])
def test_rebuilt_trie(spark, block):
    rows = conversations()
    assert found(spark, rows, block=block) == expected(rebuild(by_turn(rows)))


def test_whole_conversations_and_ties(spark):
    """Turns of one number have a fixed order, whatever the order of rows; equal ones may swap."""
    rows = [(c, t, "user", f"{t} {c % 3}") for c in range(12) for t in range(3)]
    rows += [(c, 7, "user", "twice") for c in range(4) for _ in range(2)]
    assert found(spark, rows, trie.whole_conversations) == expected(by_turn(rows))
    ties = [(1, 0, "b", "x"), (1, 0, "a", "y"), (2, 0, "a", "y"), (2, 0, "b", "x")]
    assert [r[:4] for r in found(spark, ties, trie.whole_conversations)] == [(1, 0, None, 2), (1, 1, 1, 2), (1, 2, 1, 2)]


def test_conversations_without_turns(spark):
    """Ids whose rebuilt conversation is empty are members of the root."""
    lent = {c: zlib.crc32(str(c).encode()) % 4 for c in range(1, 20)}
    empty = [c for c, n in lent.items() if n]
    rows = [(c, 0, "user", "gone") for c in empty]
    result = found(spark, rows)
    assert result == expected(rebuild(by_turn(rows)))
    assert result[0][:7] == (min(empty), 0, None, len(empty), 0, 1, 0)


def test_a_single_turn_and_no_turn(spark):
    assert found(spark, [(5, None, None, None)], trie.whole_conversations) == expected({5: [("", "")]})
    assert found(spark, []) == []


def test_ends_spread_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 16)
    ids = {(1, 5, 6): range(300), (2, -5, 6): [7], (1, 5, 7): range(10, 14), (0, 0, 0): [3, 1000, 20]}
    rows = [(*key, c) for key, convs in ids.items() for c in convs]
    random.Random(1).shuffle(rows)
    ends = spark.createDataFrame(rows, "depth long, first_sum long, second_sum long, conv_id long")
    result = {tuple(r)[:3]: r["ends_sha256"] for r in trie.ends_of(ends).collect()}
    assert result == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in ids.items()}


@pytest.mark.parametrize("kind", ["along", "against", "random"])
def test_list_ranks(spark, kind):
    ids = list(range(700))
    if kind == "random":
        random.Random(2).shuffle(ids)
    elif kind == "against":
        ids.reverse()
    links = spark.createDataFrame(list(zip(ids, [*ids[1:], None], strict=True)), "id long, next long")
    ranks = {r["id"]: r["rank"] for r in list_ranks(links, block=16).collect()}
    assert ranks == {i: n for n, i in enumerate(ids)}


def test_running_sums(spark):
    rng = random.Random(3)
    rows = [(s, n, rng.choice([-(2**63), 2**63 - 1, rng.randint(-9, 9)]), n) for s in (1, 2, 3, 9) for n in range(rng.choice([1, 200]))]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "s long, n long, x long, y long").repartition(5)
    result = running_sums(table, [F.col("s"), F.col("n")], ["x", "y"], F.col("s")).collect()
    sums = {}
    for s, n, x, y in sorted(rows):
        before = sums.get(s, (0, 0))
        got = next(r for r in result if (r["s"], r["n"]) == (s, n))
        assert ((got["x_before"] - before[0]) % 2**64, got["y_before"]) == (0, before[1])
        sums[s] = ((before[0] + x) % 2**64, before[1] + y)
    assert len(result) == len(rows)
