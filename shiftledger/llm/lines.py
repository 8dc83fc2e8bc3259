r"""Drop lines that many documents share.

Lines are exploded with their position and normalised: stripped of spaces and of
the control characters tab to carriage return at both ends, A-Z lower-cased.  A
normalised line of at least ``MIN_CHARS`` code points that is found in at least
``MIN_DOCUMENTS`` documents is dropped from all of them but the one with the
largest id, where every repeat of it stays.  What is left is reassembled by
position, as it was.

Lines meet by hash.  A first count by 64 bits, combined before its shuffle, sets
aside what cannot reach the threshold; the rest is told apart by 128 bits and
counted per (line, document), then per line, so a line that a third of all
documents hold is one row a task.  The join that brings the verdicts to the
lines can be split by adaptive execution.  Only positions travel to the
documents, once each, however often a row is repeated.

Defined cases: a null or empty text is one empty line; rows of equal id are one
document, and so are all rows without an id, which is below every other; each row keeps
a result of its own; a text with nothing to drop comes back unchanged; if all
lines go, the empty text is left; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import bound, written

MIN_CHARS = 20
MIN_DOCUMENTS = 3
_BREAK = "\n"
_BLANK = " \t\n\x0b\x0c\r"
#: The two halves of a line's hash.
_HASH = ["first_half", "second_half"]


def split_lines(text: Column) -> Column:
    return F.split(text, _BREAK, -1)


def line_key(line: Column) -> Column:
    lowered = F.translate(line, string.ascii_uppercase, string.ascii_lowercase)
    return F.btrim(lowered, F.lit(_BLANK))


def _placed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, version, position and hash of every line that is long enough."""
    placed = rows.select("doc_id", "version", F.posexplode(split_lines(F.col("text"))).alias("position", "line"))
    keyed = placed.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_chars)
    halves = [F.xxhash64("key"), F.xxhash64(F.lit("second half"), F.col("key"))]
    named = [half.alias(name) for half, name in zip(halves, _HASH, strict=True)]
    return keyed.select("doc_id", "version", "position", *named)


def dropped_positions(
    rows: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """doc_id, version and the set of positions to drop, of the ``rows`` (doc_id, version, text) that lose a line."""
    placed = _placed_lines(rows, min_chars)
    often = placed.groupBy(_HASH[0]).agg(F.count(F.lit(1)).alias("found"))
    often = often.filter(F.col("found") >= min_documents).select(_HASH[0])
    # read back, so that the join has an exchange of its own, whose hot partitions can be split
    repeated = written(placed.join(written(often, "frequent_lines"), _HASH[0]), "repeated_lines")
    holders = repeated.groupBy(*_HASH, "doc_id").agg(F.count(F.lit(1)).alias("found"))
    common = holders.groupBy(*_HASH).agg(
        F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("keeper")
    )
    common = common.filter(F.col("documents") >= min_documents).select(*_HASH, "keeper")
    gone = repeated.join(written(common, "common_lines"), _HASH).filter(
        ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    )
    return gone.groupBy("doc_id", "version").agg(F.collect_set("position").alias("dropped"))


def _reassembled(text: Column, dropped: Column) -> Column:
    """The lines that are not dropped, in order; linear in the lines."""

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(places, lambda place: F.get(lines, place)), _BREAK)

    return bound(split_lines(text), kept)


def without_common_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that is kept, a row for each row."""
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).withColumn("version", F.xxhash64("text"))
    positions = written(dropped_positions(rows, min_chars, min_documents), "dropped_lines")
    positions = positions.withColumnsRenamed({"doc_id": "of", "version": "of_version"})
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version"))
    dropped = F.col("dropped")
    return rows.join(positions, same, "left").select(
        "doc_id",
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(dropped.isNull(), F.col("text")).otherwise(_reassembled(F.col("text"), dropped)).alias("kept"),
    )
