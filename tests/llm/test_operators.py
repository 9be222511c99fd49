"""Each operator on hand-made odd rows and on a small table, against plain versions."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from formfold.llm import ann, bpe, idfile, minhash, packing, queries, sharding, suffixes, topk, toxicity, urls
from formfold.llm.shared import components
from tests.conftest import SMALL
from tests.llm import cases

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
IDS = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark).persist()


@pytest.fixture(scope="module")
def none(spark):
    return cases.frame(spark, [])


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1]) for r in cases.documents()]


@pytest.fixture(scope="module")
def twice(spark):
    """Repeated rows, null doc_ids."""
    some = cases.documents()[:3]
    return cases.frame(spark, some + some + [(None, *r[1:]) for r in some])


def run(name, spark):
    return queries.queries()[name](spark, SMALL)


def small_documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY 1").fetchall()


# sharding

def test_shards_are_gapless_and_grow_into_the_new_one_only(spark, docs, rows, none, twice):
    out = sharding.shard_documents(docs, 7).collect()
    assert len(out) == len(rows)
    for s in range(7):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    by = dict(rows)
    assert all(r.size == len((by[r.doc_id] or "").encode()) + 16 for r in out)
    assert all(r.text_crc32 == zlib.crc32((by[r.doc_id] or "").encode()) for r in out)
    assert all(r.grown_shard in (r.shard, 7) for r in out)
    assert sharding.shard_documents(none, 7).count() == 0
    again = sharding.shard_documents(twice, 7).collect()
    assert len(again) == 9 and all(r.shard == {x.doc_id: x.shard for x in again}[r.doc_id] for r in again)


def test_weights_move_rows_within_their_subtree_only(spark):
    keys = spark.range(4000)
    tree = sharding.even_tree(8, per_rack=2, racks_per_region=2)
    heavy = sharding.Tree((tree.regions[0], (tree.regions[1][0], {6: 3.0, 7: 1.0})))
    moved = keys.select(sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), heavy).alias("b")).where(
        "a <> b").distinct().collect()
    # region 1 and its rack 3 grow: whatever moves ends in region 1
    assert moved and all(m.b >= 4 for m in moved)
    counts = [r["count"] for r in keys.groupBy(sharding.shard_of(F.col("id"), tree).alias("s")).count().collect()]
    assert len(counts) == 8 and min(counts) > 400


def test_sharding_query(spark):
    out = run("op1_sharding", spark)
    assert out.columns[:6] == ["doc_id", "size", "text_crc32", "law", "shard", "slot"]
    assert out.count() == len(small_documents())


# toxicity

def test_toxicity_on_held_out_rows(spark):
    out = {r.doc_id: r for r in queries.queries()["op2_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall()
    held = [(out[d], y) for d, y in labels if zlib.crc32(str(d).encode()) % 5 == 0 and d in out]
    assert all(r.held_out for r, _ in held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r, _ in held)
    hit = sum(r.predicted == y == 1 for r, y in held)
    assert hit / sum(y for _, y in held) > 0.8 and hit / sum(r.predicted for r, _ in held) > 0.8


def test_toxicity_of_odd_rows(spark, docs, none, rows):
    text_only = docs.select("doc_id", "text", F.col("n"), F.col("lang"))
    labels = spark.createDataFrame([(r[0], i % 3 == 0 and 1 or 0) for i, r in enumerate(rows)] + [(None, 1), (9999, None)],
                                   "doc_id long, toxic int")
    network = toxicity.fit(docs, labels)
    out = toxicity.score_documents(text_only, network).collect()
    assert len(out) == len(rows) and all(0 <= r.toxicity.score <= 1 for r in out)
    empty = {r.toxicity.score for r in out if not (r.text or "").strip()}
    assert len(empty) == 1
    assert toxicity.score_documents(none.select("doc_id", "text"), network).count() == 0
    one_class = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.toxicity.score for r in toxicity.score_documents(text_only, one_class).collect()} == {0.0}


# byte-level BPE

def test_bpe(spark, docs, rows, none, twice):
    coded = bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN)
    out = {r.doc_id: r for r in bpe.decode_documents(coded, VOCABULARY).collect()}
    assert len(out) == len(rows)
    for d, t in rows:
        assert np.frombuffer(bytes(out[d].ids), "<u4").tolist() == cases.plain_bpe().encode_ordinary(t or "")
        assert bytes(out[d].decoded) == (t or "").encode()
    assert bpe.encode_documents(none, VOCABULARY, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode_documents(twice, VOCABULARY, public_tokenizers.PATTERN).count() == 9


def test_bpe_query(spark):
    out = {r.doc_id: r for r in run("op3_bpe", spark).collect()}
    for d, t in small_documents():
        ids = np.array(cases.plain_bpe().encode_ordinary(t or ""), "<u4")
        assert (out[d].n_tokens, out[d].ids_sha256, out[d].decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_unknown_ids_are_an_error(spark):
    odd = spark.createDataFrame([(1, bytearray(np.array([10 ** 6], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode_documents(odd, VOCABULARY).collect()


# token-id files

@pytest.mark.parametrize("ids", [[], [7], [0] * 3000, list(range(2500)), list(np.random.default_rng(1).integers(0, 65536, 4000))])
def test_range_coder_round_trip(ids):
    ids = np.array(ids, "<u4")
    words, sizes, sums = idfile.pack_group(ids, 256)
    assert (idfile.unpack_group(words, sizes, sums, len(ids), 256) == ids).all()
    if len(ids):
        broken = np.frombuffer(sums, "<u4").copy()
        broken[0] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            idfile.unpack_group(words, sizes, broken.tobytes(), len(ids), 256)


def test_repeated_ids_take_few_bytes():
    assert len(idfile.pack_group(np.tile(np.arange(50, dtype="<u4"), 400), 1024)[0]) < 4000


def test_id_files(spark, docs, rows, none, twice, folder):
    idfile.write_ids(docs, f"{folder}/a", IDS, block=64, group=500)
    out = {r.doc_id: r for r in idfile.read_ids(spark, f"{folder}/a").collect()}
    start = 0
    for d, t in sorted(rows):
        ids = np.append(cases.plain_ids(t), 0).astype("<u4")
        assert (out[d].start, out[d].n_tokens, bytes(out[d].ids)) == (start, len(ids), ids.tobytes())
        start += len(ids)
    idfile.write_ids(none, f"{folder}/b", IDS)
    assert idfile.read_ids(spark, f"{folder}/b").count() == 0
    idfile.write_ids(twice, f"{folder}/c", IDS)
    assert idfile.read_ids(spark, f"{folder}/c").count() == 9


def test_idfile_query(spark):
    start = 0
    for r, (d, t) in zip(run("op4_idfile", spark).orderBy("doc_id").collect(), small_documents(), strict=True):
        ids = np.append(cases.plain_ids(t), 0).astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


# packing

def test_packing(spark, docs, rows, none, twice):
    out = packing.pack_documents(docs, IDS, window=64).collect()
    by = {d: np.append(cases.plain_ids(t), 0).astype("<u4") for d, t in rows}
    for d, ids in by.items():
        own = sorted((r for r in out if r.doc_id == d), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes() and all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own][:-1]]).tolist()
    for s in {r.sequence_id for r in out}:
        own = sorted((r for r in out if r.sequence_id == s), key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own][:-1]]).tolist()
        assert sum(r.length for r in own) <= 64
    assert packing.pack_documents(none, IDS).count() == 0
    assert packing.pack_documents(twice, IDS).count() == packing.pack_documents(twice.where("doc_id IS NULL"), IDS).count() * 3


def test_packer_takes_the_least_sum_of_squares():
    rng = np.random.default_rng(2)
    packer, fills = packing.Packer(40), {}
    for size in rng.integers(1, 41, 3000).tolist():
        levels = np.bincount([f for f in fills.values() if f < 40], minlength=41)
        squares = {}
        for f in range(0, 40 - size + 1):
            if f == 0 or levels[f]:
                after = levels.copy()
                after[f] -= f > 0
                after[f + size] += f + size < 40
                squares[f] = (after[1:40] ** 2).sum()
        number, at = packer.place(size)
        assert squares[at] == min(squares.values()) and fills.get(number, 0) == at
        fills[number] = at + size
    assert sum(fills.values()) / (40 * len(fills)) > 0.97


# vectors

VECTORS = "vec_id long, embedding array<float>, label int, rank int, list int, score double"
NAN, INF = float("nan"), float("inf")


def odd_vectors(n=150, dims=6):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=dims)]) for i in range(n)]
    rows[10:20] = [(i, rows[10][1]) for i in range(10, 20)]  # equal vectors
    rows += [rows[4], rows[5], (None, rows[1][1]), (700, None), (720, [1.0, None]), (740, [NAN] * dims), (760, [INF] * dims),
             (780, [0.0] * dims), (800, [1.0, 2.0])]
    return [(*r, 1, 2, 3, 0.5) for r in rows]


def plain_top(vectors, k, every, score):
    out = {}
    for q in (v for v in vectors if v % every == 0):
        best = sorted((-score(vectors[q], vectors[c]), c) for c in vectors if c != q)[:k]
        out[q] = [(c, -s) for s, c in best]
    return out


def usable(zeros):
    return {v[0]: v[1] for v in odd_vectors() if v[0] is not None and v[1] is not None
            and all(x is not None and np.isfinite(x) for x in v[1]) and (zeros or any(v[1]))}


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_exact_top_k(spark):
    vectors = spark.createDataFrame(odd_vectors(), VECTORS)
    whole = lambda x: [int(np.floor(256 * v)) for v in x]
    want = plain_top(usable(True), 5, 10, lambda a, b: sum(x * y for x, y in zip(whole(a), whole(b))))
    assert collected(topk.top_k(vectors, 5, 10, query_block=4, candidate_block=40)) == want
    assert topk.top_k(vectors.where("vec_id < 0"), 5, 10).count() == 0
    few = topk.top_k(vectors.where("vec_id IN (10, 11, 12)"), 5, 10)
    assert [r.vec_id for r in few.orderBy("rank").collect()] == [11, 12]


def test_huge_components_keep_their_order(spark):
    rows = [(0, [3e20, 1.0]), (1, [1e20, 0.0]), (2, [-1e20, 0.0]), (3, [0.5, 0.5])]
    out = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 5, 50).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [1, 3, 2] and out[0].score == 2 ** 63 - 1 and out[2].score == -2 ** 63


def test_nearest_of_odd_vectors(spark):
    vectors = spark.createDataFrame(odd_vectors(), VECTORS)
    want = plain_top(usable(False), 5, 10, lambda a, b: sum(x * y for x, y in zip(a, b)))
    got = collected(ann.nearest(vectors, 5, 10, probed=1.0, doubt=9.0, part=16))
    assert got.keys() == want.keys()
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]])
    assert ann.nearest(vectors.where("vec_id < 0"), 5, 10).count() == 0
    few = ann.nearest(vectors.where("vec_id IN (10, 11, 12)"), 5, 10)
    assert [r.vec_id for r in few.orderBy("rank").collect()] == [11, 12]


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall(spark, size):
    path = f"/root/testdata/{size}/embeddings.parquet"
    found = collected(queries.queries()["op5_ann"](spark, f"/root/testdata/{size}"))
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}' ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hit, total = hit + len(best & {v for v, _ in found[int(ids[i])]}), total + 20
        assert len(found[int(ids[i])]) == 20
    assert hit / total >= 0.9


# near-duplicates

def test_near_duplicates(spark, docs, rows, none, twice):
    for width in (4, 5):
        want = cases.plain_components(rows, width)
        out = minhash.near_duplicates(docs, width=width, block=3).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(rows)
    assert minhash.near_duplicates(none).count() == 0
    again = minhash.near_duplicates(twice).collect()
    assert len(again) == 9 and all(r.component_id is None and r.kept for r in again if r.doc_id is None)


def test_chains_and_large_groups(spark):
    """A chain of near copies, a large group of them, and a group that shares much but not enough."""
    rng = np.random.default_rng(9)
    base = ["v%d" % i for i in range(60)]
    rows = [(i, " ".join([*base[i // 2:], *["c%d" % j for j in range(i // 2)]])) for i in range(30)]
    for i in range(60):
        words = list(base)
        words[int(rng.integers(60))] = "x%d" % i
        rows.append((100 + i, " ".join(words)))
    for i in range(40):
        rows.append((300 + i, " ".join(["s%d" % j for j in range(50)] + ["own%d_%d" % (i, j) for j in range(18)])))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    out = minhash.near_duplicates(made, width=4, block=7).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == cases.plain_components(rows, 4)


def test_near_duplicates_query(spark):
    want = cases.plain_components(small_documents(), 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run("op6_minhash", spark).collect()} == want


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (105, 101), (7, 7), (3, 2)]
    out = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 105: 100}
    assert {r.node: r.component for r in out} == want and len(out) == len(want)


# repeated passages

def same_removal(docs, rows, length, **options):
    """The operator's rows against the plain ones, repeated doc_ids and rows included."""
    got = sorted(((r.doc_id, r.text, r.removal.n_bytes, r.removal.n_removed, r.removal.n_spans, bytes(r.removal.kept))
                  for r in suffixes.remove_repeats(docs, length, **options).select("doc_id", "text", "removal").collect()), key=repr)
    want = []
    for (d, t), gone in zip(rows, cases.plain_removal_of_rows(rows, length)):
        raw = (t or "").encode()
        want.append((d, t, len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()),
                     np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("length", [17, 50, 100, 300])
def test_removal(docs, rows, none, length):
    same_removal(docs, rows, length)
    assert suffixes.remove_repeats(none, length).count() == 0


@pytest.mark.parametrize("options", [{"block_bytes": 1}, {"hot": 1, "block_bytes": 2000}, {"hot": 0, "block_bytes": 1}])
def test_removal_by_small_blocks(spark, docs, rows, options):
    same_removal(docs, rows, 50, **options)
    line = "This line stands in every document of the source, word for word, as licences do. "
    own = [(i, f"own words of number {i} " + line + f"more of document {i * i}") for i in range(80)]
    same_removal(cases.texts(spark, own), own, 50, **options)


def test_whole_characters_only(spark, docs):
    for r in suffixes.remove_repeats(docs, 50, characters=True).collect():
        assert bytes(r.removal.kept).decode("utf-8") is not None


def test_removal_where_doc_ids_repeat(spark, rows):
    """A doc_id names several rows: equal ones, copies of others, and texts of their own."""
    a, b = "A" + "first text, of which there are copies, with enough bytes " * 2, "Another text that stands nowhere else at all, of its own. " * 2
    for block_bytes in (1, 4 << 20):
        for some in ([(1, a), (2, a), (2, b)], [(1, a), (2, "zz " + a), (2, "short text")], [(1, a), (2, "zz " + a), (2, b + b)],
                     [(1, a), (1, a), (2, a), (2, a), (2, a + b), (1, b)], [(2, a), (2, b), (2, a + b)],
                     [(None, a), (1, a), (None, b), (3, a), (2, None), (2, ""), (2, a + b)],
                     [(d % 5, t) for d, t in rows]):
            same_removal(cases.texts(spark, some), some, 50, block_bytes=block_bytes)


def test_removal_keeps_clashing_columns(spark):
    some = spark.createDataFrame([(1, "x " * 60, 7, {"k": 1}, None), (2, "x " * 60, 8, None, 2.5)],
                                 "doc_id int, text string, removal int, same map<string,int>, c0 double")
    out = suffixes.remove_repeats(some, 50)
    assert out.columns == [*some.columns, "removal_"] and out.schema.fields[:5] == some.schema.fields
    assert sorted((r.doc_id, r.removal, r.same, r.c0, r.removal_.n_removed) for r in out.collect()) == [
        (1, 7, {"k": 1}, None, 0), (2, 8, None, 2.5, 120)]


def test_removal_query(spark):
    want = cases.plain_removal(small_documents(), 50)
    texts = {d: (t or "").encode() for d, t in small_documents()}
    for r in run("op7_suffixes", spark).collect():
        gone = want[r.doc_id]
        assert r.n_removed == int(gone.sum())
        assert r.kept_sha256 == hashlib.sha256(np.frombuffer(texts[r.doc_id], np.uint8)[~gone].tobytes()).hexdigest()


# URL filters

def test_urls(spark):
    pages = [(1, "https://EXAMPLE.com/en/x?q#f"), (2, "http://a.www.example.com/en/"), (3, "ftp://x.com"), (4, None), (5, ""),
             (6, "no scheme"), (7, "https://notexample.com/en/x"), (8, "http://x.net/es/"), (9, "http://x.net/es"),
             (10, "http://net/fr/1"), (11, "://com/"), (12, "http://" + "a." * 3000 + "com" + "/d" * 3000), (13, "http://x.com?y=/en/"),
             (1, "https://EXAMPLE.com/en/x?q#f"), (None, "http://x.com/"), (14, "http://com/#://net/fr/"), (15, "http://É.Com/")]
    made = spark.createDataFrame([(*p, "h", "host", "rule") for p in pages], "page_id long, url string, html string, host string, rule string")
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    out = urls.judge_urls(made, rules).collect()
    assert len(out) == len(pages)
    by = {r.page_id: r for r in out}
    want = {1: "example.com/en/", 2: "www.example.com/en/", 3: None, 4: None, 5: None, 6: None, 7: "com/", 8: "net/es/", 9: None,
            10: "net/fr/", 11: "com/", 12: "com/", 13: None, None: "com/", 14: "com/", 15: "com/"}
    assert {k: r.rule for k, r in by.items()} == want
    assert by[1].verdict == "block" and by[2].verdict == "allow" and by[9].verdict == "allow" and by[15].host == "É.com"
    assert urls.judge_urls(made.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_urls(made, rules.limit(0), "block").collect()} == {"block"}


# whole queries against SQL

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = run(name, spark)
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, got.select(*names).collect())) == sorted(
        repr(r) for r in spark.createDataFrame(found.fetchall(), got.select(*names).schema).collect())
