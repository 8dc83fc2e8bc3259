"""A Merkle manifest of a dataset, as a tree of SHA-256 midstates.

Every row is a leaf.  The leaves of a group ascend by the order column; runs of
``arity`` nodes become a parent, the digest of their hexadecimal digests, until
one is left, the group's subroot.  The subroots, in the order of the groups,
become the root in the same way.

A parent keeps a copy of its hash state before each child's slot.  To verify a
leaf, or to find the root after a replacement, the fold resumes the state before
the leaf's slot with the replacement and absorbs the siblings right of it alone;
what is left of it is in the state.

Rows are numbered by a range sort.  A task builds a block of ``BLOCK`` leaves up
to one node, the next round does so with those nodes, so the rounds are few and
no task holds more than a block, however large a group is.  On the way down every
block gets the steps above it: per level the state before its slot, and
its siblings.  Nothing but counts and the last node passes the driver.

Defined cases: null fields are ``-``, so they differ from empty texts; a null
group comes first, null order values before others, ties by digest; repeated rows
are leaves of their own; an empty table gives an empty result; columns that are
not named are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.llm import sha_states as sha
from shiftledger.llm.common import with_position, written

ARITY = 2
#: Nodes of a block, at most.
BLOCK = 4096
#: The tree over the subroots.
_TOP = -1
_STEPS = T.ArrayType(
    T.StructType(
        [
            T.StructField("state", T.BinaryType()),
            T.StructField("left", T.BinaryType()),
            T.StructField("right", T.BinaryType()),
        ]
    )
)
_ARROW_STEPS = pa.list_(pa.struct([("state", pa.binary()), ("left", pa.binary()), ("right", pa.binary())]))


def field_text(value: Column) -> Column:
    """``-`` for null, else the bytes of the text, a colon, and the text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256)


def height_of(count: int, arity: int) -> int:
    height = 0
    while count > 1:
        count, height = -(-count // arity), height + 1
    return height


class Subtree:
    """The levels above some nodes, and the state of every parent before each slot."""

    def __init__(self, nodes: np.ndarray, arity: int, height: int) -> None:
        self.arity, self.nodes, self.before = arity, [nodes], []
        for _ in range(height):
            below = self.nodes[-1]
            parents = -(-below.shape[1] // arity)
            state, before = sha.fresh(parents), np.empty((arity, 8, parents), np.uint32)
            for slot in range(arity):
                before[slot] = state
                children = below[:, slot::arity]
                if children.shape[1]:
                    held = slice(children.shape[1])
                    state[:, held] = sha.compress(state[:, held], sha.text_blocks(children))
            self.before.append(before)
            self.nodes.append(sha.closed(state, self._run(below, np.arange(parents))))

    def _run(self, below: np.ndarray, parent: np.ndarray) -> np.ndarray:
        return np.minimum(self.arity, below.shape[1] - parent * self.arity)

    def folded(self, place: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """The topmost node if ``digests`` stood at ``place``, each by itself."""
        for below, before in zip(self.nodes, self.before, strict=False):
            parent, slot = place // self.arity, place % self.arity
            run = self._run(below, parent)
            state = sha.compress(before[slot, :, parent].T, sha.text_blocks(digests))
            for step in range(1, self.arity):
                more = np.flatnonzero(slot + step < run)
                if len(more):
                    right = sha.text_blocks(below[:, place[more] + step])
                    state[:, more] = sha.compress(state[:, more], right)
            digests, place = sha.closed(state, run), parent
        return digests

    def steps(self, place: int) -> list[dict[str, bytes]]:
        """From a node up: the state before its slot, and its siblings left and right."""
        found = []
        for below, before in zip(self.nodes, self.before, strict=False):
            parent, slot = divmod(place, self.arity)
            low, high = place - slot, min(place - slot + self.arity, below.shape[1])
            side = [sha.to_bytes(below[:, a:b]).tobytes() for a, b in ((low, place), (place + 1, high))]
            state = sha.to_bytes(before[slot, :, [parent]].T).tobytes()
            found.append({"state": state, "left": side[0], "right": side[1]})
            place = parent
        return found

    def proofs(self, above: bytes) -> list[str]:
        """Per node the digest of its siblings' texts up to the top, with those ``above`` added."""
        named = [[t.tobytes() for t in sha.texts(below)] for below in self.nodes[:-1]]
        out = []
        for place in range(self.nodes[0].shape[1]):
            proof = hashlib.sha256()
            for level in named:
                low = place - place % self.arity
                for sibling in range(low, min(low + self.arity, len(level))):
                    if sibling != place:
                        proof.update(level[sibling])
                place //= self.arity
            proof.update(above)
            out.append(proof.hexdigest())
        return out


def fold_steps(digests: np.ndarray, steps: list[dict[str, bytes]]) -> np.ndarray:
    """The root if ``digests`` stood at the foot of ``steps``, each by itself."""
    for step in steps:
        state = np.repeat(sha.from_bytes(step["state"]), digests.shape[1], axis=1)
        state = sha.compress(state, sha.text_blocks(digests))
        right = sha.text_blocks(sha.from_bytes(step["right"]))
        for sibling in right.T:
            state = sha.compress(state, np.repeat(sibling[:, None], state.shape[1], axis=1))
        digests = sha.closed(state, (len(step["left"]) + len(step["right"])) // 32 + 1)
    return digests


@dataclass(frozen=True)
class Manifest:
    """Tables of nodes (tree, place, digest, size of the level), from the leaves to the root."""

    leaves: DataFrame
    #: Nodes of every group, a block per node in each next table; in the last one a subroot each.
    groups: list[DataFrame]
    #: The same above the subroots, which carry their group as ``of``.
    top: list[DataFrame]
    arity: int
    block: int

    def root(self) -> str | None:
        last = self.top[-1].first()
        return None if last is None else bytes(last["digest"]).hex()


def _subtree(nodes: pa.Table, arity: int, block: int) -> Subtree:
    size = nodes.column("size")[0].as_py()
    height = height_of(min(size, block), arity)
    return Subtree(sha.from_bytes(b"".join(nodes.column("digest").to_pylist())), arity, height)


def _in_blocks(nodes: DataFrame, block: int):
    return nodes.groupBy("tree", F.floor(F.col("place") / block).cast("long").alias("block_place"))


def _raised(nodes: DataFrame, arity: int, block: int) -> DataFrame:
    """One node for every block."""

    def build(held: pa.Table) -> pa.Table:
        held = held.sort_by("place")
        top = sha.to_bytes(_subtree(held, arity, block).nodes[-1]).tobytes()
        tree, place, size = (held.column(n)[0].as_py() for n in ("tree", "place", "size"))
        return pa.table(
            {
                "tree": pa.array([tree], pa.int64()),
                "place": pa.array([place // block], pa.int64()),
                "size": pa.array([-(-size // block)], pa.int64()),
                "digest": pa.array([top], pa.binary()),
            }
        )

    nodes = nodes.select("tree", "place", "size", "digest")
    raised = _in_blocks(nodes, block).applyInArrow(build, "tree long, place long, size long, digest binary")
    return written(raised, "nodes")


def _climbed(nodes: DataFrame, arity: int, block: int, rounds: int = 0) -> list[DataFrame]:
    levels = [nodes]
    while rounds > 0 or (levels[-1].agg(F.max("size")).first()[0] or 1) > 1:
        levels.append(_raised(levels[-1], arity, block))
        rounds -= 1
    return levels


def build(leaves: DataFrame, group: str, order: str, arity: int = ARITY, block: int = BLOCK) -> Manifest:
    """The manifest of ``leaves``: a group and an order column, ``digest`` (binary), and what else travels along."""
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    block = arity ** max(1, height_of(block // arity + 1, arity))
    leaves = written(leaves, "leaves")
    ordered = [F.col(f"`{group}`").asc_nulls_first(), F.col(f"`{order}`").asc_nulls_first(), F.col("digest")]
    numbered = written(with_position(leaves, ordered, "number"), "numbered")
    trees = numbered.groupBy(F.col(f"`{group}`").alias("group")).agg(
        F.min("number").alias("tree"), F.count(F.lit(1)).alias("size")
    )
    placed = numbered.join(written(trees, "groups"), F.col(f"`{group}`").eqNullSafe(F.col("group")))
    placed = written(placed.withColumn("place", F.col("number") - F.col("tree")).drop("group", "number"), "placed")
    groups = _climbed(placed, arity, block, rounds=1)
    subroots = with_position(groups[-1].select("tree", "digest"), [F.col("tree")], "place")
    subroots = written(subroots.withColumnRenamed("tree", "of"), "subroots")
    count = subroots.count()
    subroots = subroots.withColumns({"tree": F.lit(_TOP).cast("long"), "size": F.lit(count).cast("long")})
    return Manifest(placed, groups, _climbed(subroots, arity, block), arity, block)


def _step_column(steps: list) -> pa.Array:
    return pa.array(steps, _ARROW_STEPS)


def _lowered(nodes: DataFrame, above: DataFrame, arity: int, block: int) -> DataFrame:
    """The steps above every node, from those above its block."""

    def extend(held: pa.Table, over: pa.Table) -> pa.Table:
        held = held.sort_by("place")
        subtree = _subtree(held, arity, block)
        upper = over.column("steps")[0].as_py()
        count = held.num_rows
        columns = {name: held.column(name) for name in ("tree", "place")}
        for name in ("subroot", "root"):
            columns[name] = pa.array(over.column(name).to_pylist() * count, pa.binary())
        columns["steps"] = _step_column([subtree.steps(n) + upper for n in range(count)])
        return pa.table(columns)

    schema = T.StructType.fromDDL("tree long, place long, subroot binary, root binary").add("steps", _STEPS)
    paired = _in_blocks(nodes, block).cogroup(above.groupBy("tree", "place"))
    return written(paired.applyInArrow(extend, schema), "steps")


def steps_above(manifest: Manifest) -> DataFrame:
    """tree, place, subroot, root and steps of every block of leaves."""
    nodes = ["tree", "place", "size", "digest"]
    top = manifest.top[-1].select(
        "tree",
        "place",
        F.lit(None).cast("binary").alias("subroot"),
        F.col("digest").alias("root"),
        F.array().cast(_STEPS).alias("steps"),
    )
    for level in reversed(manifest.top[:-1]):
        top = _lowered(level.select(*nodes), top, manifest.arity, manifest.block)
    subroots = manifest.top[0].select("place", "of", F.col("digest").alias("subroot"))
    paths = top.drop("subroot", "tree").join(subroots, "place").select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "subroot", "root", "steps"
    )
    for level in reversed(manifest.groups[1:-1]):
        paths = _lowered(level.select(*nodes), paths, manifest.arity, manifest.block)
    return paths


def folded(manifest: Manifest, key: str, replacement: str) -> DataFrame:
    """Per leaf: its key, leaf, subroot, root, the digest of its proof, and the root it folds to.

    ``replacement`` names a binary column of the leaves: the digest to fold with
    in place of the leaf's, or null for the leaf itself.
    """
    arity, block = manifest.arity, manifest.block

    def fold(held: pa.Table, over: pa.Table) -> pa.Table:
        held = held.sort_by("place")
        subtree = _subtree(held, arity, block)
        upper = over.column("steps")[0].as_py()
        siblings = b"".join((step["left"] + step["right"]) for step in upper).hex().encode()
        leaf, new = held.column("digest").to_pylist(), held.column("replacement").to_pylist()
        start = sha.from_bytes(b"".join(old if n is None else n for old, n in zip(leaf, new, strict=True)))
        count = held.num_rows
        roots = fold_steps(subtree.folded(np.arange(count), start), upper)
        subroot, root = (over.column(name)[0].as_py().hex() for name in ("subroot", "root"))
        found = [text.tobytes().decode() for text in sha.texts(roots)]
        return pa.table(
            {
                "key": held.column("key"),
                "leaf": [digest.hex() for digest in leaf],
                "subroot": [subroot] * count,
                "root": [root] * count,
                "proof_sha256": subtree.proofs(siblings),
                "folded_root": found,
                "verified": [text == root for text in found],
            }
        )

    leaves = manifest.leaves.select(
        "tree", "place", "size", "digest", F.col(f"`{key}`").alias("key"), F.col(f"`{replacement}`").alias("replacement")
    )
    texts = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = T.StructType([T.StructField("key", leaves.schema["key"].dataType)])
    for name in texts:
        schema = schema.add(name, T.StringType())
    schema = schema.add("verified", T.BooleanType())
    paired = _in_blocks(leaves, block).cogroup(steps_above(manifest).groupBy("tree", "place"))
    return paired.applyInArrow(fold, schema)


def document_leaves(documents: DataFrame) -> DataFrame:
    """doc_id, lang, digest, and for the tampered rows the digest after tampering.

    A row is tampered with where 7 divides the CRC-32 of its decimal id, by
    adding 1 to ``n_chars``; null ids and null counts stay as they are.
    """
    named = documents.select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    # a decimal, as the largest long has no successor
    more = [(F.col("n_chars").cast("decimal(20,0)") + 1) if n == 3 else field for n, field in enumerate(fields)]
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    return named.select(
        "doc_id",
        "lang",
        F.unhex(leaf_digest(fields)).alias("digest"),
        F.when(chosen, F.unhex(leaf_digest(more))).alias("replacement"),
    )


def verified_documents(documents: DataFrame, arity: int = ARITY, block: int = BLOCK) -> DataFrame:
    """The manifest of ``documents`` by language, and what each tampered row folds to."""
    manifest = build(document_leaves(documents), "lang", "doc_id", arity, block)
    return folded(manifest, "doc_id", "replacement").withColumnRenamed("key", "doc_id")
