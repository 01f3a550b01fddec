"""The registered queries and the pipeline's stages, on whole small tables."""

import corpus_pipeline
import pytest
from check import compare, connect
from llm_cases import documents, empty, odd_rows
from test_copies import kept as near_copies_left
from test_decontam import expected as contaminated

from wardstar.llm import queries as llm
from wardstar.llm.common import read_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), llm.queries()[name], llm.oracle_sql()[name], SF_DIR) == ""


@pytest.mark.parametrize("name", [n for n in llm.queries() if n not in llm.oracle_sql()])
def test_query_gives_a_row_for_every_row_of_its_table(spark, name):
    table = "embeddings" if name == "op7_itq" else "documents"
    key = "vec_id" if name == "op7_itq" else "doc_id"
    ids = sorted(r[0] for r in read_table(spark, SF_DIR, table).select(key).collect())
    assert sorted(r[0] for r in llm.queries()[name](spark, SF_DIR).select(key).collect()) == ids


def test_stages_equal_brute_force(spark):
    docs = read_table(spark, SF_DIR, "documents")
    items = [tuple(r) for r in read_table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        rows = stage(spark, docs, SF_DIR)
        after = {r.doc_id: r for r in rows.collect()}
        plain = [(i, r.text) for i, r in before.items()]
        if name == "simhash_near_dedup":
            assert set(after) == near_copies_left(plain)
        elif name == "benchmark_decontamination":
            assert set(after) == {r[0] for r in contaminated(plain, items) if not r[5]}
            assert len(after) < len(before)
        else:  # every text here has letters of a learned language; mixing and sharding drop nothing
            assert set(after) == set(before)
        if name != "shard":
            assert rows.columns == docs.columns
            assert all(after[i] == before[i] for i in after)
        docs = rows
    assert set(docs.columns) > set(read_table(spark, SF_DIR, "documents").columns)


def test_run_gives_what_the_stages_give(spark):
    docs = read_table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    once = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert once == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("make", [empty, lambda spark: documents(spark, odd_rows(), "vslot")])
def test_stages_on_odd_and_empty_tables(spark, make):
    docs = make(spark)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF_DIR)
        if name != "shard":
            assert rows.columns == docs.columns
        assert rows.count() <= n
        docs = rows
