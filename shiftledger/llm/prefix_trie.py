"""The prefix trie of conversations, by an Euler tour.

A conversation is a sequence of turns (role, text).  Every distinct sequence of
the first d turns is a node of depth d below the textless root; conversations
that start with it are its members.  Caching the text of a node once instead of
once a member saves its words for every further member.

Nodes are told apart by depth and 128 bits, the sums of hashes of the turns with
their places, so that a long conversation is summed in parts.  Every node has an
arc in and an arc out; the tour enters the first child or leaves, and goes on
to the next sibling or out of the parent.  The tour is list-ranked, and sums
of leaves and savings along the ranks give those of a subtree as the
difference between its two arcs.

Siblings follow each other by their smallest member.  Nothing is grouped by
parent but aggregates that combine before the shuffle, so a node with a third of
all children is no group of its own; the join that names the parents can
be split by adaptive execution.  The conversations that end in a node are hashed
in order as streams: a node spread over partitions, in chunks.

Defined cases: turns ascend, null first, those of one number by role, then by the
hash of role and text; null role and text are empty; rows without a conversation
id belong to none and are left out; repeated rows are turns of their own; an empty
table has no root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import WORD, with_position, written
from shiftledger.llm.list_ranks import BLOCK, list_ranks
from shiftledger.llm.running import running_sums

#: Conversations of which one lends its opening to the others.
FAMILY = 20
#: Lent openings are shorter than this many turns.
OPENING = 4
#: Bytes of ids that travel as one row, of a node that several partitions hold.
CHUNK = 1 << 14
_TURN = ["first_half", "second_half", "words"]
_KEY = ["depth", "first_sum", "second_sum"]
_PARENT = ["parent_depth", "parent_first", "parent_second"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, number over all conversations in order, and hash and words of every turn."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.xxhash64(role, text).alias("first_half"),
        F.xxhash64(F.lit("second half"), role, text).alias("second_half"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("first_half"), F.col("second_half")]
    return written(with_position(written(turns, "turns"), order, "number").drop("turn", "role"), "ordered_turns")


def conversation_starts(turns: DataFrame) -> DataFrame:
    """conv_id, the number of its first turn and its size."""
    return turns.groupBy("conv_id").agg(F.min("number").alias("start"), F.count(F.lit(1)).alias("size"))


def whole_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, hash, words, size of the conversation) and conversations (conv_id, size), as they are."""
    turns = ordered_turns(conversations)
    starts = written(conversation_starts(turns), "conversations")
    depth = (F.col("number") - F.col("start") + 1).alias("depth")
    return turns.join(starts, "conv_id").select("conv_id", depth, *_TURN, "size"), starts.select("conv_id", "size")


def rebuilt_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same after each conversation took over its family's opening.

    Of the conversations from a multiple of ``FAMILY`` up to the next, the first
    lends its first h turns, all if it has fewer, in place of the first h of the
    others; h is the CRC-32 of the decimal id, modulo ``OPENING``.
    """
    turns = ordered_turns(conversations)
    lent = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING).alias("lent")
    starts = conversation_starts(turns).withColumns({"lent": lent, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    starts = written(starts, "starts")
    bases = starts.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    taken = F.least("lent", F.coalesce("base_size", F.lit(0)))
    size = F.col("taken") + F.greatest(F.col("size") - F.col("lent"), F.lit(0))
    rebuilt = starts.join(bases, "base", "left").withColumn("taken", taken).withColumn("rebuilt", size)
    rebuilt = written(rebuilt.drop("base_size"), "rebuilt")

    placed = turns.join(rebuilt, "conv_id").withColumn("place", F.col("number") - F.col("start"))
    placed = written(placed, "placed_turns")
    kept = placed.filter("place >= lent").withColumn("depth", F.col("taken") + F.col("place") - F.col("lent") + 1)
    openings = placed.filter((F.col("place") < OPENING - 1) & (F.col("conv_id") == F.col("base")))
    openings = openings.select("base", "place", *_TURN)
    given = rebuilt.filter("taken > 0").join(openings, "base").filter("place < taken")
    given = given.withColumn("depth", F.col("place") + 1)
    columns = ["conv_id", "depth", *_TURN, F.col("rebuilt").alias("size")]
    return kept.select(*columns).unionByName(given.select(*columns)), rebuilt.select("conv_id", F.col("rebuilt").alias("size"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """Turns with the sums that name their node and its parent."""
    halves = [F.xxhash64("first_half", "second_half", "depth"), F.xxhash64(F.lit("sum"), "first_half", "second_half", "depth")]
    tagged = turns.select("conv_id", "depth", "words", "size", halves[0].alias("first"), halves[1].alias("second"))
    summed = running_sums(tagged, [F.col("conv_id"), F.col("depth")], ["first", "second"], F.col("conv_id"))
    names = [*tagged.columns, "first_before", "second_before", "first_sum", "second_sum"]

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sums wrap, which the engine's own addition refuses
        for batch in batches:
            arrays = list(batch.columns)
            for name in ("first", "second"):
                own, before = (batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64) for n in (name, f"{name}_before"))
                arrays.append(pa.array((own + before).view(np.int64)))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = ", ".join(f"{name} long" for name in names)
    return written(summed.mapInArrow(close, schema).drop("first", "second"), "prefixes")


def _nodes(prefixes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every node with its smallest member, members, last words and the key of its parent, numbered along the chains."""
    below = prefixes.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("words").alias("words"),
        (F.col("depth") - 1).alias("parent_depth"),
        F.min("first_before").alias("parent_first"),
        F.min("second_before").alias("parent_second"),
    )
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        *[zero.alias(name) for name in _KEY],
        "conv_id",
        "n_convs",
        zero.alias("words"),
        F.lit(-1).cast("long").alias("parent_depth"),
        zero.alias("parent_first"),
        zero.alias("parent_second"),
    )
    nodes = written(below.unionByName(root), "nodes")
    return written(with_position(nodes, [F.col("conv_id"), F.col("depth")], "node"), "numbered_nodes")


def _tour(nodes: DataFrame, families: DataFrame) -> DataFrame:
    """The links of the Euler tour; a node's arc in is twice its number, its arc out one more."""
    in_order = [F.col(name) for name in (*_PARENT, "conv_id")]
    placed = with_position(nodes.select("node", *_PARENT, "conv_id"), in_order, "place").drop("conv_id")
    placed = written(placed, "siblings")
    follower = placed.select(
        (F.col("place") - 1).alias("place"), F.col("node").alias("sibling"), *[F.col(n).alias(f"{n}_of") for n in _PARENT]
    )
    same = F.lit(True)
    for name in _PARENT:
        same = same & (F.col(name) == F.col(f"{name}_of"))
    siblings = placed.join(follower, "place").filter(same).select("node", "sibling")
    first = families.select("node", "first_child")
    last = families.select(F.col("last_child").alias("node"), F.col("node").alias("parent"))
    around = nodes.select("node").join(first, "node", "left").join(siblings, "node", "left").join(last, "node", "left")
    inward = F.struct(
        (F.col("node") * 2).alias("id"), F.coalesce(F.col("first_child") * 2, F.col("node") * 2 + 1).alias("next")
    )
    outward = F.struct(
        (F.col("node") * 2 + 1).alias("id"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next")
    )
    return written(around.select(F.inline(F.array(inward, outward))), "tour")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of every node whose ids lie between two others of the partition; other ids in chunks."""
    names = [*_KEY, "from_id", "ids", "ends_sha256"]
    out: list[tuple] = []
    key, texts, size, since, whole = None, [], 0, None, False

    def flush(done: bool) -> None:
        nonlocal texts, size, since, whole
        ids = ",".join(texts)
        if done and whole:
            out.append((*key, since, None, hashlib.sha256(ids.encode()).hexdigest()))
        elif texts:
            out.append((*key, since, ids, None))
        texts, size, since, whole = [], 0, None, done

    def rows() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for *found, conv_id in zip(*(batch.column(n).to_pylist() for n in (*_KEY, "conv_id")), strict=True):
            if found != key:
                if key is not None:
                    flush(True)
                key = found
            if since is None:
                since = conv_id
            text = str(conv_id)
            texts.append(text)
            size += len(text) + 1
            if size >= CHUNK:
                whole = False
                flush(False)
        if out:
            yield rows()
    if key is not None:
        whole = False  # it may go on in the next partition
        flush(False)
        if out:
            yield rows()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the nodes whose chunks follow each other."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        values = [*key, digest.hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=[*_KEY, "ends_sha256"])

    for batch in batches:
        for *found, ids in zip(*(batch.column(n).to_pylist() for n in (*_KEY, "ids")), strict=True):
            if found != key:
                if key is not None:
                    yield row()
                key, digest = found, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if key is not None:
        yield row()


def ends_of(ends: DataFrame) -> DataFrame:
    """``ends`` (key of a node, conv_id) as the digest of each node's ids, ascending and joined by commas.

    A digest is sequential, so a node's ids reach one task in the end, if only as
    a stream of chunks.
    """
    names = [*_KEY, "conv_id"]
    ordered = ends.select(*names).orderBy(*[F.col(n) for n in ("first_sum", "second_sum", "depth", "conv_id")])
    schema = ", ".join(f"{n} long" for n in (*_KEY, "from_id")) + ", ids string, ends_sha256 string"
    found = written(ordered.mapInArrow(_chunks, schema), "ends")
    spread = found.filter("ids is not null").repartition(*_KEY).sortWithinPartitions(*_KEY, "from_id")
    schema = ", ".join(f"{n} long" for n in _KEY) + ", ends_sha256 string"
    rest = spread.mapInArrow(_streamed, schema)
    return found.filter("ids is null").select(*_KEY, "ends_sha256").unionByName(rest)


def _keyed(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(_KEY, names, strict=True)))


def prefix_trie(turns: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256; see ``whole_conversations`` for the arguments."""
    prefixes = _prefixes(turns)
    nodes = _nodes(prefixes, conversations)
    children = nodes.filter("depth > 0").groupBy(*_PARENT).agg(
        F.count(F.lit(1)).alias("n_children"),
        F.min_by("node", "conv_id").alias("first_child"),
        F.max_by("node", "conv_id").alias("last_child"),
    )
    children = children.withColumnsRenamed(dict(zip(_PARENT, _KEY, strict=True)))
    families = written(nodes.select(*_KEY, "node").join(children, _KEY), "families")

    ranks = list_ranks(_tour(nodes, families), block)
    arcs = ranks.select("rank", F.shiftright("id", 1).alias("node"), (F.col("id") % 2 == 1).alias("out"))
    facts = nodes.join(families.select("node", "n_children"), "node", "left").select(
        "node",
        F.col("n_children").isNull().cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    inward = ~F.col("out")
    weighed = arcs.join(facts, "node").select(
        "rank", "node", "out", *[F.when(inward, F.col(n)).otherwise(F.lit(0).cast("long")).alias(n) for n in ("leaf", "saved")]
    )
    summed = running_sums(weighed, [F.col("rank")], ["leaf", "saved"])

    def between(name: str) -> Column:
        before = F.col(f"{name}_before")
        return F.max(F.when(F.col("out"), before)) - F.max(F.when(inward, before))

    subtrees = summed.groupBy("node").agg(between("leaf").alias("n_leaves"), between("saved").alias("saved_tokens"))

    zero = F.lit(0).cast("long")
    ended = prefixes.filter("depth = size").select(*_KEY, "conv_id")
    ended = ended.unionByName(conversations.filter("size = 0").select(*[zero.alias(n) for n in _KEY], "conv_id"))
    parents = _keyed(nodes.select(*_KEY, F.col("conv_id").alias("parent_conv_id")), _PARENT)
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(families.select("node", "n_children"), "node", "left")
        .join(written(subtrees, "subtrees"), "node")
        .join(written(ends_of(ended), "digests"), _KEY, "left")
        .join(parents, _PARENT, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
