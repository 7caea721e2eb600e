"""Every query with SQL against it, the brute-force ones at full tables, and the pipeline."""

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__
import corpus_pipeline
from fireledger.llm.queries import ORACLES, QUERIES

FOLDER = str(TESTDATA / "sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, FOLDER).toPandas()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    both = [df[columns].sort_values(columns, ignore_index=True) for df in (got, expected)]
    assert both[0].values.tolist() == both[1].values.tolist()


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= __spark_entry__.queries().keys()


def test_repeats_of_all_documents(spark):
    from test_pairs import brute_repeats

    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op2_remove_repeats"](spark, FOLDER).collect())
    assert got == brute_repeats(rows, 50)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.columns == [*docs.columns, "mix_copy"]
    rows = result.collect()
    texts = {r.doc_id: r.text for r in rows}
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) > len(texts) > 500
    assert all(len(t) <= len(whole[i]) for i, t in texts.items())
    assert not any(t in text for text in texts.values() for t in items)
    copies = [sorted(r.mix_copy for r in rows if r.doc_id == i) for i in list(texts)[:50]]
    assert all(c == list(range(1, len(c) + 1)) for c in copies)


def test_stages_take_odd_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.createDataFrame([(1, "an item of the benchmark that no document holds")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "words in a text", None, "s", 15)], docs.schema
    )
    for given in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, given, str(tmp_path))
            assert made.columns[:5] == docs.columns
            made.collect()
