"""The registered queries against their SQL, and the pipeline stage by stage."""

import os

import corpus_pipeline
import pytest
from cases import documents, empty
from compare import database, spark_rows, sql_rows
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from newslake.llm import exact, oracles, pii, quality, queries, simhash

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_one_query_for_each_operator():
    names = list(queries.all_queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry_module.queries())
    assert set(oracles.all_oracles()) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.all_oracles()))
def test_query_equals_sql(spark, name):
    got = spark_rows(queries.all_queries()[name](spark, SF))
    assert got == sql_rows(database(SF), oracles.all_oracles()[name])


@pytest.mark.parametrize("name", sorted(set(queries.all_queries()) - set(oracles.all_oracles())))
def test_query_has_a_row_for_each_document(spark, name):
    ids = {r.doc_id for r in queries.all_queries()[name](spark, SF).select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}


def test_pipeline_is_its_operators_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows, feistel = {r.doc_id: r for r in docs.collect()}, pii.Feistel(queries.TRIAL_KEY)
    left = {i: r for i, r in rows.items() if quality.judge(r.text, field)[2]}
    best = {}
    for i, r in left.items():
        best.setdefault(exact.normalised(r.text), []).append((-len(r.text), i))
    left = {min(v)[1]: left[min(v)[1]] for v in best.values()}
    ids = sorted(left)
    prints = [simhash.fingerprint(left[i].text) for i in ids]
    lead = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and lead[a] != lead[b]:
                low, high = sorted((lead[a], lead[b]))
                lead = [low if x == high else x for x in lead]
    want = {ids[k]: pii.pseudonymise(left[ids[k]].text, feistel)[0] for k in range(len(ids)) if lead[k] == k}
    got = {}
    for piece in corpus_pipeline.run(spark, SF).orderBy("doc_id", "start").collect():
        got.setdefault(piece.doc_id, []).extend(piece.ids)
    library = Tokenizer.from_file(queries.public_tokenizers.path("word_bpe_49k.json"))
    assert set(got) == set(want)
    for i, text in want.items():
        assert library.encode(text, add_special_tokens=False).ids + [2] == got[i]


@pytest.mark.parametrize("clashes", [False, True])
def test_stages_take_edge_cases(spark, clashes):
    good = " ".join(f"word{k}" for k in range(80))
    docs = documents(spark, [None, "", good, good + " ", good + " mail a@b.org", good.upper()], clashes)
    for rows in (docs, empty(docs)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, rows, SF)
            assert after.columns == rows.columns and after.dtypes == rows.dtypes
            rows = spark.createDataFrame(after.collect(), after.schema)
        corpus_pipeline.STAGES[-1][1](spark, rows, SF).count()
