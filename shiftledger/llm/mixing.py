"""Mix sources to target weights by repeating documents.

Sizes are summed per source.  The targets share the total by weight; no target
exceeds ``max_rate`` times its source, and what a capped source leaves is shared
among the others by weight.  A document is emitted ``floor(rate)`` times, with
``rate`` the target over the size of its source, and once more with the
fraction as probability, drawn from a hash of seed and document id.

Defined cases: a null text has size 0; null is a source of its own, ordered
last; a source of size 0 has target 0 and emits nothing; equal ids of one source
draw alike; an empty table gives an empty result.  Columns other than the named
ones are not read by ``copies`` and pass through ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import WORD, columns_of, free_name, with_position, written

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = "mix"
#: The draw has this many hexadecimal digits, which a double holds exactly.
_DIGITS = 13


def draw(seed: str, key: Column) -> Column:
    """A number in [0, 1) that depends on seed and key alone."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.substring(F.md5(text), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: float = MAX_RATE
) -> DataFrame:
    """``sizes`` (source, source_size; one row each) with ``target``.

    Sources take the weights in turn, in code point order.  The level that
    meets the total rises with each source found to be capped; every round is
    one aggregate of the small table.
    """
    ordered = with_position(sizes, [F.col("source").asc_nulls_last()], "rank")
    turns = F.array(*[F.lit(w) for w in weights])
    plan = written(
        ordered.withColumn(
            "weight", F.element_at(turns, (F.col("rank") % len(weights) + 1).cast("int"))
        ),
        "sources",
    )
    limit = F.col("source_size") * max_rate

    def level(at: float | None) -> float:
        capped = F.lit(False) if at is None else limit < F.col("weight") * F.lit(at)
        total, taken, weight = plan.agg(
            F.sum("source_size"),
            F.sum(F.when(capped, F.col("source_size"))),
            F.sum(F.when(~capped, F.col("weight"))),
        ).first()
        return (total - max_rate * (taken or 0)) / weight if weight else at or 0.0

    at, risen = None, level(None)
    while at is None or risen > at:
        at, risen = risen, level(risen)
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(at))
    return plan.select("source", "source_size", target.alias("target"))


def copies(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_rate: float = MAX_RATE,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """doc_id, size, source, source_size, target and copies of every document."""
    sized = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0))
        .cast("long")
        .alias("size"),
        F.col(f"`{source}`").alias("source"),
    )
    sized = written(sized, "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: broadcast by Spark if small, else adaptive execution splits hot sources
    targets = written(source_targets(totals, weights, max_rate), "targets")
    targets = targets.withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    extra = draw(seed, F.col("doc_id")) < F.col("rate") - whole
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("of")), "inner")
        .withColumn("rate", rate)
        .withColumn("copies", whole + extra.cast("long"))
        .select("doc_id", "size", "source", "source_size", "target", "copies")
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it.

    The rate belongs to the source, so documents meet the small table of
    sources and are never shuffled.
    """
    names = {k: options.get(k, k) for k in ("doc_id", "source")}
    of, rate_of, copy = (free_name(documents.columns, name) for name in ("of", "rate", "copy"))
    rates = copies(documents, **options).groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    rates = written(rates, "rates").select(
        F.col("source").alias(of),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0)
        .alias(rate_of),
    )
    joined = documents.join(
        rates, documents[f"`{names['source']}`"].eqNullSafe(F.col(of)), "inner"
    )
    rate = F.col(rate_of)
    whole = F.floor(rate)
    extra = draw(options.get("seed", SEED), F.col(f"`{names['doc_id']}`")) < rate - whole
    times = (whole + extra.cast("long")).cast("int")
    repeated = joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*columns_of(documents))
