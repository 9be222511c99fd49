"""The Merkle manifest against a plain walk."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from formfold.llm import manifest, queries
from tests.conftest import SMALL
from tests.llm import cases

DDL = "doc_id long, source string, lang string, n_chars long, text string, tree int, rank string, total int, leaf string"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r):
    return h("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[1], r[2], r[3], r[4]))


def plain_tree(nodes):
    """(root, the siblings of each node on its way up, with its place in each run)"""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, merged = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a:a + 16]
            for j in range(len(run)):
                for i in groups[a + j]:
                    paths[i].append((j, run[:j] + run[j + 1:]))
            above.append(h(run))
            merged.append([i for g in groups[a:a + 16] for i in g])
        nodes, groups = above, merged
    return nodes[0], paths


def lowered(t):
    return t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def plain_proofs(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[s] = plain_tree([plain_leaf(r) for r in by[s]])
    root, tops = plain_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(by[s], trees[s][1]):
            path = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            one = plain_leaf((*r[:4], lowered(r[4]))) if tampered else plain_leaf(r)
            for j, near in path:
                one = h(near[:j] + [one] + near[j:])
            out.append((r[0], plain_leaf(r), trees[s][0], root, h(x for _, near in path for x in near), one, one == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(docs):
    return [tuple(r) for r in manifest.Manifest(docs).proofs().select(COLUMNS).collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def test_odd_rows(spark):
    texts = [None, "", "A", "ABC def", "é" * 90, "x" * 20_000, "1:a"]
    rows = [(i if i % 11 else None, [None, "", "a", "é", "b"][i % 5], [None, "en"][i % 2], [None, 3][i % 3 == 0], texts[i % 7])
            for i in range(300)]
    rows += rows[:40] + [(7, "hot", "en", 1, "SAME")] * 500
    docs = spark.createDataFrame([(*r, 1, "r", 2, "l") for r in rows], DDL).repartition(5)
    assert same(found(docs), plain_proofs(rows))
    assert found(docs.limit(0)) == []
    assert same(found(docs.where("doc_id = 4")), plain_proofs([r for r in rows if r[0] == 4]))


def test_several_strata(spark, monkeypatch):
    """Segments of 16**1 nodes: five strata of a tree in place of one."""
    monkeypatch.setattr(manifest, "HEIGHT", 1)
    monkeypatch.setattr(manifest, "SEGMENT", 16)
    leaves = [h([str(i)]) for i in range(1100)]
    root, paths = plain_tree(leaves)
    strata, nodes = [], leaves
    while True:  # the builder as tasks run it, without Spark's workers, which would not see the patch
        strata.append([manifest.appended(nodes[a:a + 16], 1 if len(nodes) > 1 else 0) for a in range(0, len(nodes), 16)])
        nodes = [s[-1] for s in strata[-1]]
        if len(nodes) == 1:
            break
    assert nodes == [root] and len(strata) == 3
    for i in (0, 15, 16, 500, 1088, 1099):
        path, at = b"", i
        for s in strata:
            segment = s[at // 16]
            base = len(segment) - 1
            path += manifest.path_of(at % 16, bytes.fromhex("".join(segment)), base, 1)
            at //= 16
        assert [(p, n) for p, n in manifest.siblings(path)] == paths[i]
        assert manifest.folded(leaves[i], path) == root


@pytest.mark.parametrize("base", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096])
def test_log_is_in_postorder(base):
    leaves = [h([str(i)]) for i in range(base)]
    height = manifest.height_of(base)
    log = manifest.appended(leaves, height)
    seen = [manifest.position(j, i, base, height) for j in range(height + 1) for i in range(-(-base // 16 ** j))]
    assert sorted(seen) == list(range(len(log)))
    assert log[-1] == plain_tree(leaves)[0] and [log[manifest.position(0, i, base, height)] for i in range(base)] == leaves


def test_positions_of_a_long_source(spark):
    """More leaves than a segment holds: the log of two strata is gapless, and proofs hold."""
    rows = [(i, "one", None, None, f"T{i}") for i in range(9000)] + [(i, "two", None, None, "x") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    made = manifest.Manifest(docs)
    log = manifest.positions(made.strata, made.sources)
    sizes = {r.tree: (r.n, r.low, r.high) for r in log.groupBy("tree").agg(
        F.count_distinct("position").alias("n"), F.min("position").alias("low"), F.max("position").alias("high")).collect()}
    assert sizes == {0: (9000 + 563 + 36 + 3 + 1, 0, 9602), 1: (23, 0, 22)} and log.count() == 9603 + 23
    assert same([tuple(r) for r in made.proofs().select(COLUMNS).collect()], plain_proofs(rows))


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    out = queries.queries()["op13_manifest"](spark, SMALL)
    assert out.columns == COLUMNS
    assert same([tuple(r) for r in out.collect()], plain_proofs([tuple(r) for r in docs.collect()]))
