"""Find benchmark items in documents: SimHash of item-sized windows.

A window of a document has as many words as the item it is held against.  Its
SimHash, over shingles of five words, is looked up in a multi-index: the 64
bits are cut into six blocks, and two fingerprints within ``RADIUS`` bits agree
in some block up to ``RADIUS // 6`` bits.  Items are listed under every such
neighbour of each of their blocks, so no fingerprint within the radius is
missed.  What meets there passes the Hamming check and then the exact
similarity: shingles weigh as often as they occur, and the weights of the
common ones must reach ``SIMILARITY`` of the weights of all.

A window that reaches the similarity shares at least that part of the item's
shingles.  So only windows with as many shingles of items of their size are
fingerprinted, which loses none.  Documents without any shingle of an item are
put aside by a bitmap of the items' shingles, within the scan: a bitmap of
bounded size can let too many pass but never too few.

Everything is built-in functions; texts are compared in lower case, by their
runs of letters and digits.

Defined cases: documents and items that are null or have fewer than five words
match nothing; a document shorter than an item is one window; equal ids with
several texts are searched together; repeated items or documents do not repeat
results; an empty table on either side gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import bound, small_frame, written

SHINGLE = 5
SIMILARITY = 0.8
#: Shingles that differ in a fifth of their weight differ in 10 bits on average, 17 at most but for one in 200.
RADIUS = 17
BLOCKS = 6
#: Bits of the bitmap, as a power of two: 64 for each shingle of the items, within these.
BITMAP = (16, 22)


def words_of(text: Column) -> Column:
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of all runs of five words; empty for fewer words."""

    def of(w: Column) -> Column:
        last = F.size(w) - SHINGLE
        hashed = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])
        )
        return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))

    return bound(words, of)


def _shifted(value: Column, bits: Column) -> Column:
    """Shifted right by a column of bits, without the sign."""
    return F.call_function("shiftrightunsigned", value, bits)


def _one_at(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def simhash(hashes: Column) -> Column:
    """A bit is 1 if set in over half of the hashes."""

    def bit(found: Column, b: Column) -> Column:
        ones = F.aggregate(
            hashes, F.lit(0).cast("bigint"),
            lambda n, h: n + _shifted(h, b).bitwiseAND(F.lit(1).cast("bigint")),
        )
        one = _one_at(b)
        return F.when(ones * 2 > F.size(hashes), found.bitwiseOR(one)).otherwise(found)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), bit)


def similarity(a: Column, b: Column) -> Column:
    """Common weight over all weight; the weight of a shingle is how often it occurs.

    Both are sorted into one array and read once, a shingle at a time.
    """

    def count(in_a: Column, in_b: Column, value: Column, common: Column) -> Column:
        counts = [c.cast("int").alias(n) for c, n in ((in_a, "in_a"), (in_b, "in_b"), (common, "common"))]
        return F.struct(value.alias("value"), *counts)

    def read(held: Column, x: Column) -> Column:
        of_a = F.when(x["of_a"], 1).otherwise(0)
        more = count(held["in_a"] + of_a, held["in_b"] + 1 - of_a, x["value"], held["common"])
        return F.when(held["value"] == x["value"], more).otherwise(count(of_a, 1 - of_a, x["value"], closed(held)))

    def closed(held: Column) -> Column:
        return held["common"] + F.least(held["in_a"], held["in_b"])

    def tagged(array: Column, of_a: bool) -> Column:
        return F.transform(array, lambda x: F.struct(x.alias("value"), F.lit(of_a).alias("of_a")))

    every = F.sort_array(F.concat(tagged(a, True), tagged(b, False)))
    none = count(F.lit(0), F.lit(0), F.lit(None).cast("bigint"), F.lit(0))
    return bound(
        F.aggregate(every, none, read, closed), lambda common: common / (F.size(a) + F.size(b) - common)
    )


def _widths() -> list[tuple[int, int]]:
    """First bit and width of each block."""
    cuts = [64 * n // BLOCKS for n in range(BLOCKS + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:], strict=False)]


def _block(fingerprint: Column, n: int) -> Column:
    low, width = _widths()[n]
    return F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def blocks_of(fingerprint: str) -> Column:
    """Number and value of every block."""
    return F.array(
        *[F.struct(F.lit(n).alias("block"), _block(F.col(fingerprint), n).alias("value")) for n in range(BLOCKS)]
    )


def _flips(n: int, radius: int) -> list[int]:
    """Masks of up to ``radius // BLOCKS`` bits within a block."""
    _, width = _widths()[n]
    near = radius // BLOCKS
    return [sum(1 << b for b in bits) for k in range(near + 1) for bits in combinations(range(width), k)]


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, length in words and shingles of the items that have any."""
    words = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), words_of(F.col(f"`{text}`")).alias("words"))
    return (
        words.filter(F.size("words") >= SHINGLE)
        .distinct()
        .select("item_id", F.size("words").alias("length"), shingles_of(F.col("words")).alias("item_shingles"))
    )


def _bitmap(shingles: DataFrame) -> tuple[Column, int]:
    """Two bits of a bitmap for each shingle, as an array of longs; and its size.

    The driver gets one long per 64 bits, 65,536 at most.
    """
    wanted = max(1, 64 * shingles.count())
    power = min(max((wanted - 1).bit_length(), BITMAP[0]), BITMAP[1])
    bits = shingles.select(F.explode(F.array(*_probes(F.col("shingle"), power))).alias("bit"))
    one = _one_at(F.col("bit").bitwiseAND(F.lit(63)))
    filled = bits.groupBy((F.shiftright("bit", 6)).alias("at")).agg(F.bit_or(one).alias("long")).collect()
    longs = [0] * (1 << power - 6)
    for at, value in filled:
        longs[at] = value
    # a text that the optimizer folds into one array
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>"), power


def _probes(shingle: Column, power: int) -> list[Column]:
    mask = F.lit((1 << power) - 1).cast("bigint")
    return [F.shiftrightunsigned(shingle, s).bitwiseAND(mask).cast("int") for s in (0, 32)]


def _may_occur(shingle: Column, bitmap: Column, power: int) -> Column:
    def is_set(bit: Column) -> Column:
        held = F.get(bitmap, F.shiftright(bit, 6))
        return _shifted(held, bit.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("bigint")) == 1

    first, second = _probes(shingle, power)
    return is_set(first) & is_set(second)


def contaminated(
    documents: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = SIMILARITY,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, item_id, the largest similarity and the first word of such a window (from 0)."""
    items = written(benchmark_items(benchmark), "items")
    of_items = items.select("length", F.explode("item_shingles").alias("shingle")).distinct()
    bitmap, power = _bitmap(of_items.select("shingle").distinct())

    docs = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), shingles_of(words_of(F.col(f"`{text}`"))).alias("shingles"))
    suspects = docs.filter(F.exists("shingles", lambda h: _may_occur(h, bitmap, power)))
    suspects = written(suspects.withColumn("row", F.monotonically_increasing_id()), "suspects")

    hits = suspects.select("row", F.size("shingles").alias("n"), F.posexplode("shingles").alias("at", "shingle")).join(
        of_items, "shingle"
    )
    # in shingles: a window of ``length`` words has ``length - 4``, or all the document has
    wide = F.least(F.col("length") - (SHINGLE - 1), F.col("n"))
    # a hit counts from the first start whose window holds it until its own place
    counted = hits.select("row", "n", "length", wide.alias("wide"), "at").select(
        "row", "length", "wide", (F.col("n") - F.col("wide")).alias("last"),
        F.explode(
            F.array(
                F.struct(F.greatest(F.col("at") - F.col("wide") + 1, F.lit(0)).alias("start"), F.lit(1).alias("more")),
                F.struct((F.col("at") + 1).alias("start"), F.lit(-1).alias("more")),
            )
        ).alias("change"),
    ).select("row", "length", "wide", "last", "change.*").filter("start <= last")
    # the starts up to the next change have as many hits; of changes at one start only the last is followed by any
    along = Window.partitionBy("row", "length").orderBy("start")
    counted = counted.withColumns({"hits": F.sum("more").over(along), "next": F.lead("start").over(along)})
    # a window needs this many of its positions to hit, or it cannot reach the similarity
    enough = F.col("hits") >= F.ceil((F.col("length") - (SHINGLE - 1)) * F.lit(threshold) - 1e-9)
    end = F.coalesce(F.col("next") - 1, F.col("last"))
    runs = counted.filter(enough).withColumn("end", end).filter("start <= end")
    windows = runs.select("row", "length", "wide", F.explode(F.sequence("start", "end")).alias("start"))
    cut = windows.join(suspects, "row").select(
        "doc_id", "length", "start", F.slice("shingles", F.col("start") + 1, F.col("wide")).alias("window")
    )
    cut = written(cut, "windows")
    prints = cut.select("window", "length").distinct().withColumn("print", simhash(F.col("window")))
    probes = prints.select("*", F.explode(blocks_of("print")).alias("b")).select("window", "length", "print", "b.*")

    spark = documents.sparkSession
    flips = [(n, mask) for n in range(BLOCKS) for mask in _flips(n, radius)]
    table = small_frame(
        spark, {"block": pa.array([n for n, _ in flips], pa.int32()), "flip": pa.array([m for _, m in flips], pa.int64())}
    )
    listed = items.withColumn("item_print", simhash(F.col("item_shingles")))
    listed = listed.select("item_id", "length", "item_shingles", "item_print", F.explode(blocks_of("item_print")).alias("b"))
    index = listed.select("item_id", "length", "item_shingles", "item_print", "b.*").join(F.broadcast(table), "block")
    index = index.withColumn("value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")

    near = probes.join(index, ["length", "block", "value"]).filter(
        F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    )
    pairs = near.select("window", "length", "item_id", "item_shingles").distinct()
    matches = pairs.withColumn("similarity", similarity(F.col("window"), F.col("item_shingles"))).filter(
        F.col("similarity") >= threshold
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before")))
    return (
        cut.join(matches.select("window", "length", "item_id", "similarity"), ["window", "length"])
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.similarity", (-F.col("best.before")).alias("first_word"))
    )

