"""Inputs by one scan, against one read for each input."""

import json

import pytest
from pyspark.sql import functions as F

from newslake.plans import jobs
from newslake.sources.articles import read_articles
from newslake.sources.globs import read_inputs, scan_roots

KEYS = ["a/x.json", "a/y.json", "a/b/x.json", "a b+c/1.json", "c1/z.json", "c2/z.json", "c%203/z.json", "deep/er/and/deeper.json", "a,b/q.json"]
GLOBS = ["a/*.json", "a", "{a,c1}/*", "c?/z.json", "c[12]/*.json", "c[!1]/z.json", "*/*.json", "deep/*/*", "a b+c", "a/x.json", "{c1,c2}/z.json", "*/b", "c[0-1]*"]


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("globs")
    for k, key in enumerate(KEYS):
        path = root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps([{"id": f"i{k}", "url": key}, {"id": "same", "url": key}, {"id": "same", "url": key}]))
    return str(root)


def test_each_input_gets_its_files(spark, lake):
    globs = [f"{lake}/{g}" for g in GLOBS]
    got = {(r["_input"], r.url, r.id, r.n) for r in read_inputs(spark, globs).groupBy("_input", "url", "id").agg(F.count("*").alias("n")).collect()}
    want = set()
    for i, glob in enumerate(globs):
        want |= {(i, r.url, r.id, r.n) for r in read_articles(spark, glob).groupBy("url", "id").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_one_scan_and_only_named_files(spark, lake, tmp_path):
    globs = [f"{lake}/{g}" for g in GLOBS]
    rows = read_inputs(spark, globs)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    (tmp_path / "good").mkdir()
    (tmp_path / "bad").mkdir()
    (tmp_path / "good" / "1.json").write_text('[{"id": "1"}]')
    (tmp_path / "good" / "2.json").write_text('[{"id": "2"}]')
    (tmp_path / "bad" / "1.json").write_text("no JSON at all {")
    # Broken files that no input names do not fail the read.
    got = read_inputs(spark, [f"{tmp_path}/*/2.json", f"{tmp_path}/good/1.json"])
    assert sorted((r["_input"], r.id) for r in got.collect()) == [(0, "2"), (1, "1")]
    with pytest.raises(FileNotFoundError):
        read_inputs(spark, [f"{lake}/a", f"{lake}/nothing*"])


def test_roots_do_not_overlap():
    assert scan_roots(["/l/a/*.json", "/l/a/b/x", "/l/ab/*", "file:/l/a/c", "/m/{x,y}/*"]) == ["/l/a", "/l/ab", "/m"]


def test_concat_keeps_copies_of_different_inputs(spark, lake):
    rows = jobs.concat_inputs(spark, [f"{lake}/a/*.json", f"{lake}/a/x.json", f"{lake}/c?"])
    assert sorted(r.id for r in rows.collect()) == ["i0", "i0", "i1", "i4", "i5", "same", "same", "same"]
