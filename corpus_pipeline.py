"""From raw documents to token shards: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir).  All but the last return the columns of
documents, so that each result can be written and read again.  Rows are told
apart by id and text, so rows of one id with different texts are different documents.
Null texts are empty, other columns may have any name and pass through, and an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.llm import decontaminate, mixing, simhash, token_ids, toxicity
from shiftledger.llm.common import columns_of, free_name, written
from shiftledger.llm.queries import tokenizer_path, toxicity_chain

#: The classifier has no SQL form; the tests hold the stages against plain rules.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier chain does not reject, by their text alone.

    Rows without an id are judged too.  Without labels nothing is rejected.
    """
    chain = toxicity_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.kept_documents(docs, chain, "toxic")


def _keyed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """Rows with two hashes of id and text, under names of their own."""
    first = free_name(docs.columns, "row")
    second = free_name([*docs.columns, first], "row_again")
    hashes = {first: F.xxhash64("doc_id", "text"), second: F.xxhash64(F.lit("again"), "text", "doc_id")}
    return docs.withColumns(hashes), first, second


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one row: that with the smallest id, null last.

    Of rows with that id the smallest by hash of id and text stays, and of rows
    equal in both the first by all columns as JSON.
    """
    keyed, row, again = _keyed(docs)
    found = simhash.near_duplicates(keyed, doc_id=row)
    classes = found.select(F.col("doc_id").alias(row), "component_id").distinct()
    rows = keyed.select(F.col("doc_id").alias("id"), row, again)
    order = F.struct(F.col("id").isNull().alias("without"), "id", row, again)
    kept = written(rows.join(written(classes, "classes"), row).groupBy("component_id").agg(F.min(order).alias("least")), "kept")
    key = [F.col(f"least.{row}").alias(row), F.col(f"least.{again}").alias(again)]
    kept = keyed.join(kept.select(*key).distinct(), [row, again], "left_semi")
    counted = kept.groupBy(row, again).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    repeated = written(counted.select(row, again), "repeated")
    once = kept.join(repeated, [row, again], "left_anti").select(*columns_of(docs))
    whole = F.struct(*columns_of(docs))
    copies = kept.join(repeated, [row, again], "left_semi")
    first = copies.groupBy(row, again).agg(F.min_by(whole, F.to_json(whole)).alias("whole"))
    return once.unionByName(first.select("whole.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in whose text no benchmark item is found; rows without an id count."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, row, _ = _keyed(docs)
    found = decontaminate.contaminated(keyed, benchmark, doc_id=row).select(F.col("doc_id").alias(row)).distinct()
    return keyed.join(written(found, "contaminated"), row, "left_anti").select(*columns_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; null is a source, and rows of one id and source are taken alike."""
    return mixing.mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all rows in the order of their ids, and what is read back from them."""
    return token_ids.encoded_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_to_target_weights", mix_sources),
    ("token_ids", token_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
