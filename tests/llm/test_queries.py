"""The registered queries against SQL, and the pipeline stage by stage, on the smallest driver tables."""

import os

import pytest

import compare
import corpus_pipeline
from sparklogs.llm import quality, queries
from sparklogs.llm.common import stored
from test_operators import brute_leaks

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF_DIR), compare.connect(SF_DIR), queries.SQL[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "mixture"]
    before = docs
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == columns
        ids, left = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in after.collect()}
        if name == "quality_rules":
            kept = {r.doc_id for r in quality.measure(before, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect() if r.kept}
            assert set(left) == kept
        if name == "decontamination":
            assert set(left) == {i for i, t in ids.items() if not brute_leaks(t, items)[1]}
        if name == "personal_data":
            assert set(left) == set(ids)
        before = after
    assert corpus_pipeline.run(spark, SF_DIR).columns == columns + ["copy"]


def test_pipeline_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and repeated rows, columns with the names the stages use, and empty tables."""
    base = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = ["gone_node", "again_id", "_node", "_name", "_pii_key", "_pii_key_own", "_pii_own", "_row", "stratum", "target", "copies", "n_words", "kept"]
    odd = [(None, None, None, None, None), (None, None, None, None, None), (-1, "", None, "s", 0), (-2, "mail a@b.example " + "word " * 60, None, None, 1),
           (-3, " ".join(f"w{i}" for i in range(70)) + " mail jo@site.example", "en", "", None), (-3, " ".join(f"w{i}" for i in range(70)) + " mail jo@site.example", "en", "", None),
           (-4, " ".join(f"w{i}" for i in range(69)) + " mail jo@site.example", "en", None, None)]
    docs = base.unionByName(spark.createDataFrame(odd, base.schema))
    wide = docs.selectExpr("*", *[f"concat('own-', doc_id) as {c}" for c in extra])
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        nulls = spark.createDataFrame([(None,) * len(table.columns)], table.schema)
        table.unionByName(nulls).write.parquet(f"{tmp_path}/some/{name}.parquet")
        table.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    plain, full = docs, wide
    for name, stage in corpus_pipeline.STAGES:
        plain, full = (stored(stage(spark, f, f"{tmp_path}/some"), "test-odd") for f in (plain, full))
        assert full.columns[:len(wide.columns)] == wide.columns
        assert sorted(map(str, full.select(*docs.columns).collect())) == sorted(map(str, plain.select(*docs.columns).collect()))
        assert full.filter("not (gone_node <=> concat('own-', doc_id) and _pii_key_own <=> concat('own-', doc_id))").isEmpty()
        if name == "near_duplicates":
            assert {r.doc_id for r in plain.filter("doc_id < 0").collect()} == {-4}
    empty = wide.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, f"{tmp_path}/none")
    assert empty.collect() == []
