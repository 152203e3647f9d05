"""The pipeline stage by stage, and the queries against their SQL twins."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from wayloom.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        found.append(docs)
    return [f.collect() for f in found]


def test_columns_and_order(stages):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "packing"]
    for rows in stages[:-1]:
        assert set(rows[0].asDict()) == set(pipeline.COLUMNS)


def test_each_stage_does_its_part(spark, stages):
    source, calm, shorter, single, clean, packed = stages
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    scored = queries.op2_toxicity(spark, SF).where("predicted = 0").collect()
    assert ids(calm) == ids(scored)
    count = {}
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").lower()
    for r in calm:
        for k in {key(s) for s in r["text"].split("\n")}:
            count[k] = count.get(k, 0) + 1
    want = {r["doc_id"]: "\n".join(s for s in r["text"].split("\n") if not key(s) or count[key(s)] < 10) for r in calm}
    assert {r["doc_id"]: r["text"] for r in shorter} == want
    words = {i: t.encode().lower().split() for i, t in want.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    linked = {
        b for a in sets for b in sets
        if a < b and (n := len(sets[a] & sets[b])) and 100 * n >= 80 * len(sets[a] | sets[b])
    }
    # `linked` have a link to a smaller id, so no component loses its least.
    assert set(ids(single)) >= set(want) - linked and len(single) == len(set(ids(single)))
    neighbours = {i: {j for j in sets if len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j]) and sets[i]} for i in sets}
    for i in ids(single):
        assert not sets[i] or min(neighbours[i]) == i
    items = [re.findall(r"\w+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in single:
        text = " ".join(re.findall(r"\w+", r["text"].lower()))
        if any(" ".join(item) in text for item in items):
            assert r["doc_id"] not in ids(clean)
    assert set(ids(packed)) == set(ids(clean))


def test_stages_take_odd_rows(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = source.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    more = source.limit(2).withColumns({"text": F.lit("")})
    docs = source.union(odd).union(odd).union(more).union(source.limit(3)).withColumn("score", F.lit(1)).withColumn("_hash", F.lit("x"))
    for i, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(tmp_path / f"{i}"))
        docs = spark.read.parquet(str(tmp_path / f"{i}"))
    kept = docs.collect()
    assert sum(r["doc_id"] is None for r in kept) == 2
    texts = [r["text"] for r in kept if r["text"]]
    assert len(texts) == len(set(texts))


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    have = queries.QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(have.columns)
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, have.select(columns).collect()), key=order) == sorted(want.fetchall(), key=order)
