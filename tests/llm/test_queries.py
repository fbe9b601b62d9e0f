"""Registered queries against DuckDB, and the pipeline."""

import duckdb
import pytest
from helpers import SF001, brute_fingerprint, documents, union_find
from test_texts import brute_contained

import corpus_pipeline
from faultscore.llm import mixing
from faultscore.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    df = QUERIES[name](spark, SF001)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())


def test_there_is_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_equals_brute_force(spark):
    """run() against one document of each group, less leaks, replicated."""
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    fp = {r.doc_id: brute_fingerprint(r.text) for r in rows if any(c.isalpha() for c in r.text or "")}
    classes = union_find(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    kept = [r for r in rows if classes.get(r.doc_id) == r.doc_id]
    leaked = {d for d, *_ in brute_contained([(r.doc_id, r.text) for r in kept], items)}
    clean = [r for r in kept if r.doc_id not in leaked]
    out = corpus_pipeline.run(spark, SF001)
    want = mixing.mix(spark.createDataFrame(clean, rows and spark.read.parquet(f"{SF001}/documents.parquet").schema))
    assert out.columns == want.columns
    pairs = lambda df: sorted((r.doc_id, r.copy_no) for r in df.select("doc_id", "copy_no").collect())
    assert pairs(out) == pairs(want)
    text = {r.doc_id: r.text for r in rows}
    for r in out.collect():
        assert r.text == text[r.doc_id] or ("<secret>" in r.text and r.n_chars == len(r.text))


def test_each_stage_takes_awkward_rows_and_keeps_the_columns(spark):
    rows = [(1, None), (2, ""), (3, "the cat sat on the mat " * 5), (4, "the cat sat on the mat " * 5), (None, "some words here"), (3, "other words here entirely"), (5, "12 34"), (6, "password = abcdefgh1234"), (7, "word " * 20_000)]
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF001).collect() == []
    ids = lambda df: sorted(str(r.doc_id) for r in df.select("doc_id").collect())
    assert ids(corpus_pipeline.near_duplicates(spark, docs, SF001)).count("3") == 1
    assert ids(corpus_pipeline.secrets(spark, docs, SF001)) == ids(docs)
    assert ids(corpus_pipeline.decontaminate(spark, docs, SF001)) == ids(docs)
    assert corpus_pipeline.mixture(spark, docs.limit(0), SF001).collect() == []
