"""The pipeline's stages against plain versions."""

import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import cases

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "near_duplicates", "repeated_passages", "packing"]
    rows = {r.doc_id: r for r in docs.collect()}

    clean = steps["toxicity"](spark, docs, SMALL)
    assert clean.columns == COLUMNS
    left = {r.doc_id: r for r in clean.collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SMALL}/labels.parquet'").fetchall())
    fine = [d for d, y in labels.items() if y == 0 and d in rows]
    assert all(left[d] == rows[d] for d in left) and sum(d in left for d in fine) >= 0.9 * len(fine)

    groups = cases.plain_components([(r.doc_id, r.text) for r in rows.values()], 5)
    kept = steps["near_duplicates"](spark, docs, SMALL)
    assert kept.columns == COLUMNS
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in groups.items() if d == c)

    gone = cases.plain_removal([(r.doc_id, r.text) for r in rows.values()], corpus_pipeline.PASSAGE_BYTES)
    cut = steps["repeated_passages"](spark, docs, SMALL)
    assert cut.columns == COLUMNS
    for r in cut.collect():
        raw = rows[r.doc_id].text.encode()
        most = np.frombuffer(raw, np.uint8)[~gone[r.doc_id]].tobytes()
        assert len(most) <= len(r.text.encode()) <= len(most) + 6 * max(1, len(raw) // 100) and (gone[r.doc_id].any() or r == rows[r.doc_id])
        assert not gone[r.doc_id].any() or r.n_chars == len(r.text)

    pieces = steps["packing"](spark, cut, SMALL).collect()
    texts = {r.doc_id: r.text for r in cut.collect()}
    for p in pieces:
        ids = np.append(cases.plain_ids(texts[p.doc_id]), 0).astype("<u4")
        assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
    assert {p.doc_id for p in pieces} == set(texts)


def test_run_follows_the_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SMALL)
    assert sorted(r.doc_id for r in out.where("start = 0").collect()) == sorted(r.doc_id for r in docs.collect())


def test_odd_rows(spark):
    docs = cases.frame(spark)
    clashing = docs.withColumns({c: F.lit(1) for c in (
        "predicted", "toxicity", "removal", "Removal_", "_kept", "_n_removed", "_n_bytes", "_n_spans", "kept", "same", "c0", "made",
        "block", "marks", "copies", "_id", "_toxic")})
    repeated = docs.unionAll(docs).unionAll(docs.withColumn("doc_id", F.lit(None).cast("long")))
    for name, step in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0), clashing, repeated):
            out = step(spark, given, SMALL)
            assert name == "packing" or out.columns == given.columns
            assert out.count() >= 0
