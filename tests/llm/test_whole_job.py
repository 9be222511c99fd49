"""Tables on which an operator once did less than its whole job."""

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from formfold.llm import ann, bpe, toxicity


def trained(network):
    return {**network.weights, "shifts": network.shifts, "constant": network.constant}


def test_repeated_documents_train_as_single_ones(spark):
    words = ["w%d" % i for i in range(50)]
    rows = [(i, " ".join([words[i % 50], words[i * 7 % 50], "foul" if i % 3 == 0 else "fair"])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    once = trained(toxicity.fit(docs, labels, sample=60))
    assert once["constant"] is None
    hot = docs.unionAll(docs.where("doc_id % 10 = 1").select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("col"))
    for repeated in (docs.unionAll(docs), hot):
        again = trained(toxicity.fit(repeated, labels, sample=60))
        assert again.keys() == once.keys() and all(np.array_equal(again[k], once[k]) for k in once)


def test_bpe_of_equal_blocks(spark):
    """Equal rows in partitions of their own, and one row repeated over several blocks of a partition."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(5, "one two two")] * 6, 6), "doc_id long, text string")
    out = bpe.encode_documents(docs, vocabulary, public_tokenizers.PATTERN).collect()
    assert len(out) == 6 and len({(r.doc_id, bytes(r.ids)) for r in out}) == 1
    names = bpe.exploded(docs.coalesce(1), public_tokenizers.PATTERN, 8, False, most=1).select("block").distinct()
    assert names.count() == 6


def test_scan_of_many_queries_stays_small():
    rng = np.random.default_rng(4)
    rows, queries = rng.normal(size=(1500, 6)), rng.normal(size=(5000, 6))
    ids, names = np.arange(1500), np.arange(10_000, 15_000)
    tracemalloc.start()
    q, v, s = ann.scan(names, queries, np.full(5000, -np.inf), ids, rows, (rows ** 2).sum(1).max(), ann.rotation(7, 1), 3, 4, 9.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # an array of all pairs of a chunk has 41 MB
    assert (q.reshape(-1, 3) == names[:, None]).all()
    assert (v.reshape(-1, 3) == np.argsort(-queries @ rows.T, axis=1)[:, :3]).all()
    assert np.allclose(s, (queries[q - 10_000] * rows[v]).sum(1))


def test_nearest_by_blocks_of_queries(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=5)]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    x = np.array([r[1] for r in rows])
    out = ann.nearest(vectors, 4, 5, probed=1.0, doubt=9.0, part=16, query_block=7).orderBy("query_id", "rank").collect()
    scores = x[::5] @ x.T
    scores[np.arange(60), np.arange(0, 300, 5)] = -np.inf
    assert [r.vec_id for r in out] == np.argsort(-scores, axis=1)[:, :4].ravel().tolist()


def test_every_labelled_document_trains(spark):
    """Also those beyond the first unit, and long ones: each toxic document has a word of its own kind."""
    rows = [(i, f"w{i * 7 % 50} w{i % 30} " + (f"foul{i // 3 % 16}" if i % 3 == 0 else "fair")) for i in range(600)]
    long = next(i for i in range(600, 700) if zlib.crc32(str(i).encode()) % 5)
    rows.append((long, "long " * 20_500))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] + [(9999, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    units = toxicity.units_of(docs, labels, 40).persist()
    trained_on = sorted(i for r in units.collect() for i in r.ids)
    assert trained_on == [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5] and long in trained_on
    assert units.count() > 5
    seen, _, sizes = toxicity.counted(units, toxicity.Network())
    assert sizes[:, 0].sum() == len(trained_on) and sizes[:, 1].sum() == sum(i % 3 == 0 for i in trained_on)
    scored = toxicity.score_documents(docs, toxicity.fit(docs, labels, sample=40)).where("doc_id < 600").collect()
    assert sum(r.toxicity.predicted == (r.doc_id % 3 == 0) for r in scored) > 570
    units.unpersist()


def test_thresholds_over_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(0, 3)), i, float(np.round(rng.normal() * 3, 2)), int(rng.integers(0, 2))) for i in range(500)]
    found = toxicity.best_cuts(spark.createDataFrame(rows, "lang int, id long, logit double, toxic int").repartition(6))
    for lang, cut in found.items():
        some = [r for r in rows if lang in (-1, r[0])]
        assert cut.n == len(some) and cut.toxic == sum(r[3] for r in some)
        assert cut.cut == toxicity.best_cut(np.array([r[2] for r in some]), np.array([r[3] for r in some]))
