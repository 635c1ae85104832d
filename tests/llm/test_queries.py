"""Registered queries: SQL comparison, registration, and the pipeline stage by stage."""

import inspect
import re

import duckdb
import pytest

import corpus_pipeline
from bourse.llm import mixing, queries, secrets
from bourse.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.01"])
def test_sql(spark, name, sf_dir):
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = db.execute(ORACLE[name])
    columns = sorted(c[0] for c in result.description)
    at = [[c[0] for c in result.description].index(c) for c in columns]
    expected = sorted((tuple(r[k] for k in at) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in queries.QUERIES[name](spark, sf_dir).select(*columns).collect()), key=repr) == expected


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_only_the_entry_point_swallows_import_errors():
    for module in (corpus_pipeline, queries, mixing, secrets):
        assert "except ImportError" not in inspect.getsource(module)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(str(tmp_path / str(k)))
        tables.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(t.columns == columns for t in tables[:-1])
    ids = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in tables]
    assert ids[5] == ids[4] <= ids[3] == ids[2] <= ids[1] <= ids[0]
    kept = {r["doc_id"] for r in queries.op9_quality_rules(spark, SF).where("kept").collect()}
    assert ids[1] == kept
    assert len(ids[2]) < len(ids[1])
    redacted = {r["doc_id"]: r["text"] for r in tables[3].collect()}
    assert redacted == {r["doc_id"]: secrets.redact(r["text"]) for r in tables[2].collect()}
    found = secrets.scan(tables[2]).where("spans <> ''").count()
    assert sum(secrets.REDACTED in t for t in redacted.values()) == found
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(tables[3]).where("taken > 0").collect()}
    assert {r["doc_id"]: r["count"] for r in tables[4].groupBy("doc_id").count().collect()} == copies
    last = tables[5]
    assert last.count() == tables[4].count() and last.where("not round_trip").count() == 0
    assert {"ids", "scores", "n_pieces"} <= set(last.columns)


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "SentencePiece encoding and decoding"]
