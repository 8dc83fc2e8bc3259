"""The registered queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shiftledger.llm import decontaminate, mixing, simhash, toxicity
from shiftledger.llm.common import written
from shiftledger.llm.oracles import ORACLES
from shiftledger.llm.queries import QUERIES, toxicity_chain

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    database = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = database.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    found = [tuple(r) for r in QUERIES[name](spark, SF_DIR).select(*columns).collect()]
    assert sorted(found, key=str) == sorted(result.fetchall(), key=str)


def test_pipeline(spark):
    """Each stage against its rule, on its own input; then all of them in one go."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    chain = toxicity_chain(docs, labels)
    clean = toxicity.scores(docs, chain).filter(F.col("toxic") < toxicity.THRESHOLD)
    clear = [simhash.near_duplicates, lambda d: decontaminate.contaminated(d, benchmark)]
    expected = [
        lambda d: ids(clean),
        lambda d: ids(clear[0](d).filter("doc_id = component_id")),
        lambda d: sorted(set(ids(d)) - set(ids(clear[1](d)))),
        lambda d: sorted(r["doc_id"] for r in mixing.copies(d).collect() for _ in range(r["copies"])),
        ids,
    ]
    for (name, stage), rule in zip(corpus_pipeline.STAGES, expected, strict=True):
        kept = written(stage(spark, docs, SF_DIR), name)
        assert ids(kept) == rule(docs), name
        if name != "token_ids":
            assert kept.columns == docs.columns
            docs = kept
    again = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, kept.collect()))


def test_contaminated_rows_without_an_id_are_dropped(spark):
    """And clean rows stay that share the id of a contaminated one."""
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, item), (None, "clean and short"), (1, item), (1, "another clean text"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
