import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from barloom.llm import queries
from barloom.session import stored
from tests.llm.llm_data import clashing, docs_of, odd_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_operator_and_the_pipeline_are_registered():
    found = contract.queries()
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)


def test_stages_work_on_what_their_predecessors_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
            counts.append(docs.count())
            left = {r[0] for r in docs.select("doc_id").collect()}
            assert left <= {r[0] for r in before.select("doc_id").collect()}
    assert counts[0] > counts[1] >= counts[3] == counts[4] and counts[1] == counts[2]
    assert not docs.where("length > 2048 OR octet_length(ids) <> 4 * length OR crc32(ids) <> ids_crc32").count()
    assert {r[0] for r in docs.select("doc_id").distinct().collect()} == left


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"empty-{name}")
        assert docs.count() == 0


def test_stages_on_odd_rows_and_clashing_columns(spark):
    """Nulls, blank and long texts, ties and repeated rows pass every stage beside the given documents."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = docs_of(spark, [(None if i is None else i - 1_000_000, t) for i, t in odd_rows()])
    docs = clashing(given.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        odd.withColumn("n_chars", odd["n_chars"].cast(given.schema["n_chars"].dataType))))
    columns = docs.columns
    docs = stored(docs.withColumn("n_removed", docs["n"]), "odd-docs")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), f"odd-{name}")
        if name != "packing":
            assert docs.columns == [*columns, "n_removed"]
            assert not docs.where("n <> 'n' OR found <> 'found' OR n_removed <> 'n'").count()
    # Every row that came to packing has its pieces; their lengths sum up to its ids.
    whole = docs.groupBy("doc_id").agg({"length": "sum"}).count()
    assert whole == before.select("doc_id").distinct().count()
