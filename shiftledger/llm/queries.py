"""The queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.llm import (
    debruijn,
    decontaminate,
    lines,
    merkle,
    mixing,
    neighbours,
    prefix_trie,
    simhash,
    suffixes,
    surrogates,
    token_ids,
    toxicity,
    warc,
)

#: Where the tokenizer of the token-id query lies; None: the file the package names.
TOKENIZER: str | None = None


def tokenizer_path() -> str:
    if TOKENIZER:
        return TOKENIZER
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages")).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op2_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.without_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 50 == 0)


#: The key of the surrogates; a production run sets its own.
SURROGATE_KEY = "change-me"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(documents, SURROGATE_KEY)[0]


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def toxicity_chain(documents: DataFrame, labels: DataFrame) -> toxicity.Chain:
    """The labels of quality first, then those of toxicity."""
    categories = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    return toxicity.fit_chain(documents, labels.select("doc_id", "quality", "toxic"), categories)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    chain = toxicity_chain(documents, _table(spark, sf_dir, "labels"))
    rejected = F.col("toxic") >= toxicity.THRESHOLD
    return toxicity.scores(documents, chain).withColumn("rejected", rejected)


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_earlier(_table(spark, sf_dir, "documents")).drop("kept")


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.encoded_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt_conversations(_table(spark, sf_dir, "conversations")))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.without_common_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_debruijn": op2_debruijn,
    "op3_hilbert": op3_hilbert,
    "op4_surrogates": op4_surrogates,
    "op5_decontaminate": op5_decontaminate,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_suffixes": op8_suffixes,
    "op9_token_ids": op9_token_ids,
    "op10_mixing": op10_mixing,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lines": op13_lines,
}
