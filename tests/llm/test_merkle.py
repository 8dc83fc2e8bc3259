"""The manifest against a tree built by hashlib, row by row."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from shiftledger.llm import sha_states as sha
from shiftledger.llm.merkle import build, document_leaves, fold_steps, steps_above, verified_documents

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, `tree.x` int, tree int, place string, size int, digest string, key string"
EXTRA = (1, 2, "x", 3, "y", "z")


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(below[i : i + arity]) for i in range(0, len(below), arity)])
    return levels


def siblings(levels, place, arity):
    out = []
    for level in levels[:-1]:
        low = place - place % arity
        out.append((level[low:place], level[place + 1 : low + arity]))
        place //= arity
    return out


def expected(rows, arity):
    leaves = {}
    for row in rows:
        leaf = digest(map(field, row[:5]))
        leaves.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0), leaf, row))
    groups = [sorted(leaves[g], key=lambda x: x[:2]) for g in sorted(leaves, key=lambda g: (g is not None, (g or "").encode()))]
    trees = [climb([leaf for _, leaf, _ in group], arity) for group in groups]
    top = climb([tree[-1][0] for tree in trees], arity)
    root = top[-1][0]
    out = []
    for number, (group, tree) in enumerate(zip(groups, trees, strict=True)):
        for place, (_, leaf, row) in enumerate(group):
            path = siblings(tree, place, arity) + siblings(top, number, arity)
            doc_id, n_chars = row[0], row[3]
            node = leaf
            if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
                node = digest(map(field, (*row[:3], n_chars + 1, row[4])))
            for left, right in path:
                node = digest([*left, node, *right])
            proof = digest(text for left, right in path for text in left + right)
            out.append((doc_id, leaf, tree[-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA).repartition(3)


def found(spark, rows, **options):
    return sorted(map(tuple, verified_documents(table(spark, rows), **options).collect()), key=str)


def documents(count, langs=("en", "de", None, "zł", "")):
    rng = random.Random(count)
    rows = [(n, rng.choice(["s", None, ""]), rng.choice([*langs, "en", "en"]), rng.choice([n, None]), rng.choice(["ż\n", None, "", str(n)])) for n in range(count)]
    return [*rows, rows[0], rows[0], (None, None, "en", 5, None), (None, None, "en", 6, "x"), (3, "s", "en", 2**63 - 1, ""), (7, "s", "alone", 1, "only leaf")]


@pytest.mark.parametrize("arity, block", [(2, 4), (3, 9), (2, 4096), (5, 25)])
def test_against_hashlib(spark, arity, block):
    rows = documents(150)
    assert found(spark, rows, arity=arity, block=block) == expected(rows, arity)


def test_sizes_around_powers(spark):
    for count in (1, 2, 3, 8, 9):
        rows = [(n, "s", "en", n, "t") for n in range(count)]
        assert found(spark, rows, block=4) == expected(rows, 2)


def test_many_groups(spark):
    """More subroots than a block holds."""
    rows = [(n, "s", f"g{n % 41}", n, "t") for n in range(60)]
    assert found(spark, rows, block=4) == expected(rows, 2)


def test_a_replacement_folds_to_the_root_of_the_changed_table(spark):
    rows = [(n, "s", "en" if n % 3 else "de", n, "t") for n in range(40)]
    changed = [(*row[:3], 999, row[4]) if row[0] == 17 else row for row in rows]
    manifest, other = (build(document_leaves(table(spark, r)), "lang", "doc_id", block=4) for r in (rows, changed))
    leaf = manifest.leaves.filter("doc_id = 17").first()
    new = other.leaves.filter("doc_id = 17").first()
    step = steps_above(manifest).filter(f"tree = {leaf['tree']} and place = {leaf['place'] // 4}").first()
    block = sorted(manifest.leaves.filter(f"tree = {leaf['tree']} and place div 4 = {leaf['place'] // 4}").collect(), key=lambda r: r["place"])
    from shiftledger.llm.merkle import Subtree

    subtree = Subtree(sha.from_bytes(b"".join(bytes(r["digest"]) for r in block)), 2, 2)
    node = subtree.folded(np.array([leaf["place"] % 4]), sha.from_bytes(bytes(new["digest"])))
    steps = [{k: bytes(s[k]) for k in ("state", "left", "right")} for s in step["steps"]]
    assert sha.to_bytes(fold_steps(node, steps)).tobytes().hex() == other.root() != manifest.root()


def test_empty_table(spark):
    assert found(spark, []) == []


def test_states_equal_the_library():
    rng = random.Random(1)
    for blocks in (0, 1, 3):
        data = [rng.randbytes(64 * blocks) for _ in range(5)]
        state = sha.fresh(5)
        for n in range(blocks):
            words = np.frombuffer(b"".join(d[64 * n : 64 * n + 64] for d in data), ">u4").reshape(5, 16).T
            state = sha.compress(state, words.astype(np.uint32))
        assert [bytes(r) for r in sha.to_bytes(sha.closed(state, blocks))] == [hashlib.sha256(d).digest() for d in data]
