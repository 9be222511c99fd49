"""Sharding and toxicity against plain versions, row by row."""

import math
import struct
import zlib

import duckdb
import numpy as np
import xxhash

from formfold.llm import queries, sharding, toxicity
from tests.conftest import SMALL
from tests.llm import cases


def plain_shard(key, tree):
    """A walk down the tree: at each node the child of the shortest waiting time."""
    def chosen(children):
        times = []
        for name, weight, child in children:
            h = 42
            if key is not None:
                h = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=h)
            u = (xxhash.xxh64_intdigest(name.encode(), seed=h) >> 11) + 0.5
            times.append((-math.log(u / 2.0 ** 53) / weight, child))
        return min(times, key=lambda t: t[0])[1]

    weigh = lambda rack: sum(rack.values())
    i = chosen([(f"region {i}", sum(map(weigh, r)), i) for i, r in enumerate(tree.regions)])
    j = chosen([(f"region {i} rack {j}", weigh(r), j) for j, r in enumerate(tree.regions[i])])
    return chosen([(f"shard {s}", w, s) for s, w in tree.regions[i][j].items()])


def test_shards_of_all_documents(spark):
    tree = sharding.even_tree(queries.SHARDS)
    more = sharding.grown(tree)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    out = queries.queries()["op1_sharding"](spark, SMALL).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in out) == sorted(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "key", plain_shard(d, tree), plain_shard(d, more))
        for d, t in rows)
    for s in range(queries.SHARDS):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


def test_shards_of_null_and_odd_keys(spark):
    tree = sharding.Tree((({0: 1.0, 1: 2.5}, {2: 0.5}), ({3: 4.0},)))
    keys = [None, 0, -1, 2 ** 62, -(2 ** 63), 7, 7]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = df.select("k", sharding.shard_of(df.k, tree).alias("s")).collect()
    assert all(r.s == plain_shard(r.k, tree) for r in got)


def plain_score(text, network):
    """One text by the definition: every window of every width, the largest response of each filter."""
    words = [zlib.crc32(toxicity.word_of(p).encode()) for p in (text or "").split()]
    table = network.weights["table"].astype(np.float64)
    places = [(w % network.rows, (w * 0x9E3779B97F4A7C15 % 2 ** 64 >> 40) % network.rows) for w in words]
    embedded = [table[a] + table[b] for a, b in places] + [np.zeros(network.dims)] * max(network.widths)
    pooled = []
    for w in network.widths:
        filters, base = network.weights[f"f{w}"].astype(np.float64), network.weights[f"b{w}"]
        windows = [sum(embedded[i + j] @ filters[j] for j in range(w)) + base for i in range(len(embedded) - w + 1)]
        pooled.append(np.maximum(np.max(windows, axis=0), 0))
    common = [sum(words.count(zlib.crc32(c.encode())) for c in toxicity.COMMON[name].split()) for name in toxicity.LANGUAGES[1:]]
    told = 1 + common.index(max(common)) if max(common) else 0
    logit = np.concatenate(pooled) @ network.weights["out"] + network.weights["base"][0] - network.shifts[told]
    return 1 / (1 + math.exp(-logit))


def test_scores_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    network = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert network.constant is None
    odd = spark.createDataFrame([(r[0], r[1]) for r in cases.documents()], "doc_id long, text string")
    for rows in (odd, docs.select("doc_id", "text").limit(40)):
        for r in toxicity.score_documents(rows, network).collect():
            want = plain_score(r.text, network)
            assert abs(r.toxicity.score - want) < 1e-4 and (r.toxicity.predicted == int(want >= 0.5) or abs(want - 0.5) < 1e-4)


def test_thresholds_have_the_best_f1():
    rng = np.random.default_rng(2)
    for _ in range(50):
        logits, toxic = np.round(rng.normal(size=30), 1), rng.integers(0, 2, 30)
        if not toxic.any():
            continue

        def f1(cut):
            told = logits >= cut
            return 2 * (told & (toxic == 1)).sum() / max(1, told.sum() + toxic.sum())

        order = np.argsort(-logits, kind="stable")
        best = max(2 * toxic[order[:k]].sum() / (k + toxic.sum()) for k in range(1, 31))
        cut = toxicity.best_cut(logits, toxic)
        assert f1(cut) <= best + 1e-12
        if len(set(logits)) == 30:
            assert abs(f1(cut) - best) < 1e-12


def test_ids_of_pieces_in_lines():
    """Lines of pieces have the ids of the pieces one by one, in far fewer calls."""
    import public_tokenizers

    from formfold.llm import tokens
    encode = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["x", "don't", "a\nb", "\n", "\r", "\x1c", "\x1fz", "\u0085", "", "\u200b", "e\u0301", "\u6f22\u5b57", "<|endoftext|>", "(1,2)", "\u00bd", "\U0001f600", "'s"]
    pieces = odd + [f"w{i * 37}.{i}" for i in range(1000)] + odd
    plain = encode.tokenizer.encode_batch([" " + p for p in pieces], add_special_tokens=False)
    texts, library = [], encode.tokenizer

    class Counted:
        def encode_batch_fast(self, some, **options):
            texts.extend(some)
            return library.encode_batch_fast(some, **options)

    encode.tokenizer = Counted()
    assert [np.frombuffer(x, np.uint32).tolist() for x in encode.spaced(pieces)] == [e.ids for e in plain]
    assert len(texts) < 50


def test_pieces_are_put_together_from_known_parts():
    """Letters are not encoded again for each mark or line's end beside them."""
    import public_tokenizers

    from formfold.llm import tokens
    encode = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    library, seen = encode.tokenizer, []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, some, **options):
            seen.extend(some)
            return self.inner.encode_batch_fast(some, **options)

    encode.tokenizer, encode.model = Counted(library), Counted(getattr(encode, "model", library))
    words = ["".join(chr(97 + (i * k) % 26) for k in (3, 5, 7, 11, 2)) for i in range(1, 26)] + ["\u00e0\u00e9", "\u00ed\u00f1o", "\u00aa"]
    texts = [f"A {a}.\n{b.title()}### {a}{m} end" for a in words for b in words for m in ("", "...", "'", "%%%")]
    coded = [np.frombuffer(x, np.uint32).tolist() for x in encode.encode(texts)]
    spent = sum(map(len, seen))
    assert coded == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert spent < 2000
    odd = ["don't a's a.'s x' it's.\nThe", "a\nb\nc of.\n \nA A.\n\nB", "a<|endoftext|>b <|endoftext|>", "a'll. a.'ll a\rb x\u00a0y", "\u017f. \u01c5a \u0250. \u6f22\u5b57.", "", " ", "\n", "a\n", "A.\nB.\nC"]
    for t, x in zip(odd, encode.encode(odd)):
        assert np.frombuffer(x, np.uint32).tolist() == library.encode(t, add_special_tokens=False).ids, t
