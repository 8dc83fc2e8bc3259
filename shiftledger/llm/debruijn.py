"""Remove long repeated word spans, by a compacted de Bruijn graph.

Windows of ``WINDOW`` words are the edges of the graph; an edge is repeated if
its words also start anywhere else.  Edges are dealt by anchor, the smallest
hash of the shorter word runs in them, so that equal edges meet.  Neighbouring
edges of one anchor form a path without branches and travel as one row: anchor,
content, document, first edge, number of edges.

* A path whose whole content occurs more than once is repeated from end to end.
* The node between two such paths, the words that the last window of one and the
  first of the next share, does not branch if the one is always followed by the
  other and the other always preceded by the one.  Joins compact paths along
  those nodes, twice as far each round, so that a long repeated span is one path
  of the graph and one row for each place it occurs at.
* Where one anchor has several contents, the graph branches: their edges are
  compared one by one, each distinct content once, at its source coordinates.
* An edge that repeats within its document is found there.

Joins bring the verdicts back to the coordinates, where paths are glued to spans.
Contents that many documents share are counted before the shuffle and compared
once, so the work grows with distinct contents.  Of equal texts one is cut: all
windows of every copy are repeated.

Contents and edges are told apart by 64 bits among those of one anchor only, so
two that differ must also share the run of words with the smallest hash.

Defined cases: null and empty texts have no words; shorter texts than a window
lose nothing; rows of equal id and text are copies of each other; null ids
pass through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import remove, shuffles_removed, written
from shiftledger.llm.windows import Windows, covered, spans_of

WINDOW = 35
#: Words in the runs that anchors are chosen from.
GRAM = 12
_SEED = 1
#: As many windows as a text has.
_ALL = 1 << 40


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _hashed(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.array([xxh3_64_intdigest(w, _SEED) for w in words], np.uint64)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def _paths(window: int, gram: int):
    """Paths of each document; those known to repeat within it have a null anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            inner: list[list[np.ndarray]] = [[], [], []]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                if len(words) < window:
                    continue
                windows = Windows(_hashed(words), window, gram)
                anchor, content, start, size = windows.runs()
                found = (anchor, content, np.full(len(start), key, np.int64), start, size)
                for part, values in zip(parts, found, strict=True):
                    part.append(values)
                start, size = spans_of(windows.repeated())
                for part, values in zip(inner, (np.full(len(start), key, np.int64), start, size), strict=True):
                    part.append(values)
            names = ["anchor", "content", "doc", "start", "size"]
            if parts[0]:
                yield pa.RecordBatch.from_arrays([_longs(np.concatenate(p)) for p in parts], names=names)
                doc, start, size = (_longs(np.concatenate(p)) for p in inner)
                nulls = pa.nulls(len(doc), pa.int64())
                yield pa.RecordBatch.from_arrays([nulls, nulls, doc, start, size], names=names)

    return cut


def _edges(window: int, gram: int):
    """The edges of chosen paths, with their place in the path."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            for text, paths in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                windows = Windows(_hashed(words_of(text.as_py())), window, gram)
                for path in paths:
                    low, size = path["start"], path["size"]
                    for part, values in zip(
                        parts,
                        (
                            np.full(size, path["anchor"], np.int64),
                            windows.hashes(low, low + size),
                            np.full(size, path["content"], np.int64),
                            np.arange(size),
                            np.full(size, path["once"], bool),
                        ),
                        strict=True,
                    ):
                        part.append(values)
            if parts[0]:
                names = ["anchor", "edge", "content", "place", "once"]
                *numbers, once = (np.concatenate(p) for p in parts)
                yield pa.RecordBatch.from_arrays([*map(_longs, numbers), pa.array(once)], names=names)

    return cut


def keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text and a key that only rows equal in both share."""
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.withColumn("doc", F.xxhash64("doc_id", "text"))


def _copies(rows: DataFrame, window: int) -> DataFrame:
    """doc of every row whose text occurs in another row, and whether a smaller doc has it too.

    Texts are told apart by 128 bits; those too short for a window are left out.
    """
    text = ["first_half", "second_half"]
    hashed = rows.filter(F.octet_length("text") >= 2 * window - 1).select(
        "doc", F.xxhash64("text").alias(text[0]), F.xxhash64(F.lit("second half"), "text").alias(text[1])
    )
    counted = hashed.groupBy(*text).agg(F.count(F.lit(1)).alias("rows"), F.min("doc").alias("least"))
    equal = written(counted.filter("rows > 1").drop("rows"), "equal_texts")
    marked = hashed.join(equal, text).select("doc", (F.col("doc") > F.col("least")).alias("later"))
    copies = written(marked.distinct(), "copies")
    remove(equal)
    return copies


def _distinct_texts(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """doc and text of one row of each group of copies, and of all other rows.

    Only rows that are equal in id and text as well are grouped.
    """
    first = rows.select("doc", "text").join(copies.filter("later").select("doc"), "doc", "left_anti")
    equal = written(first.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc"), "equal_rows")
    one = first.join(equal, "doc", "left_semi").groupBy("doc").agg(F.first("text").alias("text"))
    return first.join(equal, "doc", "left_anti").unionByName(one)


def _repeated_places(contents: DataFrame, texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Of contents that occur once, the places of their edges that other contents of the anchor hold."""
    branching = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1").select("anchor")
    path = F.struct("anchor", "content", "at.start", "at.size", (F.col("n") == 1).alias("once"))
    branching = written(branching, "branching")
    chosen = contents.join(branching, "anchor", "left_semi").groupBy("at.doc")
    chosen = chosen.agg(F.collect_list(path).alias("paths"))
    schema = "anchor long, edge long, content long, place long, once boolean"
    sources = texts.join(chosen, "doc").select("text", "paths")
    edges = written(sources.mapInArrow(_edges(window, gram), schema), "edges")
    here = F.struct("content", "place")
    repeated = edges.groupBy("anchor", "edge").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    # a table of its own, so that the join can split an edge that many contents hold
    repeated = written(repeated.filter("first <> last").select("anchor", "edge"), "repeated_edges")
    places = edges.filter("once").join(repeated, ["anchor", "edge"]).groupBy("anchor", "content")
    places = written(places.agg(F.array_sort(F.collect_list("place")).alias("places")), "places")
    remove(branching, edges, repeated)
    return places


def _contents(paths: DataFrame) -> DataFrame:
    """Each distinct path: how often it occurs, one of its places, and the paths it always comes between."""
    key = F.struct("anchor", "content")
    along = Window.partitionBy("doc").orderBy("start")
    end = F.col("start") + F.col("size")
    linked = paths.withColumns(
        {
            "next": F.when(F.lead("start").over(along) == end, F.lead(key).over(along)),
            "before": F.when(F.lag(end).over(along) == F.col("start"), F.lag(key).over(along)),
        }
    )

    def always(name: str) -> Column:
        same = (F.count(name) == F.count(F.lit(1))) & (F.min(name) == F.max(name))
        return F.when(same, F.min(name)).alias(name)

    at = F.min(F.struct("doc", "start", "size")).alias("at")
    return linked.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), at, always("next"), always("before"))


def _compacted(repeated: DataFrame) -> DataFrame:
    """anchor, content and number of edges of the maximal nonbranching paths, under the path each begins with.

    A document ends, so paths that always follow each other form no circle.
    """
    own = F.struct("anchor", "content")
    after = repeated.select(own.alias("next"), F.col("before").alias("key")).filter("key is not null")
    links = repeated.select(own.alias("key"), "next").filter("next is not null").join(after, ["key", "next"])
    links = written(links, "links")
    sizes = repeated.select(own.alias("key"), F.col("at.size").alias("size"))
    begun = sizes.join(links.select(F.col("next").alias("key")), "key", "left_anti")
    held = [written(sizes.join(links, "key", "left"), "chains")]
    while held[-1].filter("next is not null").limit(1).count():
        rows = held[-1]
        further = rows.select(F.col("key").alias("next"), F.col("size").alias("more"), F.col("next").alias("beyond"))
        open_rows = rows.filter("next is not null").join(further, "next")
        stepped = open_rows.select("key", (F.col("size") + F.col("more")).alias("size"), F.col("beyond").alias("next"))
        held.append(written(stepped.unionByName(rows.filter("next is null")), "chains"))
        remove(rows)
    heads = held[-1].select("key", "size").join(begun.select("key"), "key", "left_semi")
    heads = written(heads.select("key.anchor", "key.content", "size"), "compacted")
    remove(links, held[-1])
    return heads


def repeated_spans(
    rows: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """doc, start and size: ``size`` neighbouring windows of a document that are repeated.

    For copies of a text ``size`` is more than the text has.
    """
    copies = _copies(rows, window)
    texts = _distinct_texts(rows, copies)
    schema = "anchor long, content long, doc long, start long, size long"
    cut = written(texts.mapInArrow(_paths(window, gram), schema), "paths")
    paths = cut.filter("anchor is not null")
    shared = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    shared = written(shared, "shared_anchors")
    inner = written(cut.filter("anchor is null").select("doc", "start", "size"), "inner")
    paths = written(paths.join(shared, "anchor", "left_semi"), "shared_paths")
    remove(cut, shared)
    contents = written(_contents(paths), "contents")
    compacted = _compacted(contents.filter("n > 1"))
    places = _repeated_places(contents, texts, window, gram)
    whole = paths.drop("size").join(compacted, ["anchor", "content"])
    partial = paths.join(places, ["anchor", "content"]).select(
        "doc",
        F.explode(F.transform("places", lambda p: F.col("start") + p)).alias("start"),
        F.lit(1).cast("long").alias("size"),
    )
    equal = copies.select("doc", F.lit(0).cast("long").alias("start"), F.lit(_ALL).cast("long").alias("size"))
    spans = inner.unionByName(whole.select("doc", "start", "size")).unionByName(partial).unionByName(equal)
    spans = written(spans, "spans")
    remove(inner, paths, contents, compacted, places, copies)
    return spans


def without_repeats(
    documents: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space."""
    rows = keyed(documents, doc_id, text)
    with shuffles_removed(documents.sparkSession):
        spans = repeated_spans(rows, window, gram)
        # a table of its own, so that the join can split rows that are equal in id and text
        arrays = [F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes")]
        per_doc = written(spans.groupBy("doc").agg(*arrays), "spans_of_docs")
    remove(spans)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        for batch in batches:
            out: list[tuple] = []
            for value, starts, sizes in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                words = words_of(value.as_py())
                kept = words
                if starts.is_valid and len(words) >= window:
                    low = starts.values.to_numpy()
                    gone = covered(len(words), low, np.minimum(sizes.values.to_numpy(), len(words) - window + 1 - low), window)
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                joined = b" ".join(kept)
                digest = hashlib.sha256(joined).hexdigest()
                out.append((len(words), len(words) - len(kept), digest, joined.decode("utf-8", "replace")))
            n, removed, digest, joined = zip(*out, strict=True) if out else ((), (), (), ())
            arrays = [pa.array(n, pa.int64()), pa.array(removed, pa.int64())]
            arrays += [pa.array(digest, pa.string()), pa.array(joined, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, kept string"
    joined = rows.join(per_doc, "doc", "left").select("doc_id", "text", "starts", "sizes")
    return joined.mapInArrow(keep, schema)
