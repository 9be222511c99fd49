"""Removal of recurring passages against a table of all runs of words."""

import hashlib
import re
import tracemalloc

import duckdb
import numpy as np
import pytest

from formfold.llm import phrases, queries
from tests.conftest import SMALL

DDL = "doc_id long, text string, block long, spans string, n int, words int, copies string, data string"


def plain(rows, width):
    """(doc_id, words, removed, kept words) of each row."""
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    counts: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            counts[key] = counts.get(key, 0) + 1
    out = []
    for (doc, _), w in zip(rows, words):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = True
        out.append((doc, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def found(docs, **options):
    return sorted((tuple(r) for r in phrases.remove_phrases(docs, **options).collect()), key=repr)


def odd_rows():
    rng = np.random.default_rng(11)
    w = ["w%x" % i for i in rng.integers(0, 3000, 6000)]
    passage, other = " ".join(w[:60]), "\t".join(w[100:145])
    texts = [
        None, "", " \n ", "one", passage, passage, "  " + passage.replace(" ", "\n\r ") + "\x0b", passage.upper(),
        "a " + passage + " b " + passage + " c", "x y " + other + " z", other.replace("\t", " ") + " é é",
        " ".join(w[:35]), " ".join(w[:34]), " ".join(w[20:55]) + " tail", "same " * 50, "same " * 36, "same " * 34 + "end",
        " ".join(w[500:3500]), " ".join(w[500:1500] + ["cut"] + w[1501:2600]), " ".join(w[3000:5999]),
        "ab ba " * 40, "ba ab " * 30 + "x", "q" * 70_000 + " " + passage, "日本 語 " * 30, "ｗ " * 40,
    ]
    rows = [(i * 7 % 50, t) for i, t in enumerate(texts)]
    rows += [(1, "edge%d " % i + passage + " after%d" % i) for i in range(30)]  # a frequent passage, doc_ids repeat
    return rows + [(None, passage + " z"), (None, None), (3, " ".join(w[4000:4100]))] + rows[4:6]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, 1, "s", 2, 3, "c", "d") for d, t in rows], DDL).repartition(parts)


@pytest.mark.parametrize("options", [
    {}, {"block_bytes": 2000}, {"block_bytes": 1}, {"hot": 1, "block_bytes": 5000}, {"gram": 35}, {"gram": 1, "shard_bytes": 1000}])
def test_odd_rows(spark, options):
    rows = odd_rows()
    assert found(frame(spark, rows), **options) == plain(rows, 35)


@pytest.mark.parametrize("width", [1, 2, 8])
def test_short_runs(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, " ".join("abcdef"[j] for j in rng.integers(0, 6, n))) for i, n in enumerate(rng.integers(0, 40, 60))]
    assert found(frame(spark, rows), width=width, gram=max(1, width // 2), block_bytes=100) == plain(rows, width)


def test_tables_without_words(spark):
    assert found(frame(spark, []), width=5, gram=2) == []
    assert found(frame(spark, [(1, None), (2, "")]), width=5, gram=2) == [(1, 0, 0, ""), (2, 0, 0, "")]


def test_words_decide_where_hashes_agree(monkeypatch):
    ids = np.array([1, 2, 3, 1, 2, 4, 2, 3, 9, 1, 2])
    bounds = np.array([0, 3, 6, 9, 11])
    expected = phrases.recurring(ids, bounds, np.ones(4, int), 2)
    assert expected.tolist() == [True, True, False, True, False, False, True, False, False, True, False]
    monkeypatch.setattr(phrases, "runs", lambda h, n: np.zeros(len(h) - n + 1, np.uint64))
    assert (phrases.recurring(ids, bounds, np.ones(4, int), 2) == expected).all()


def test_more_words_than_letters(monkeypatch):
    texts = [b"a b c d e f g", b"x b c d y", b"e f g a", b"c d e"]
    one = np.ones(4, int)
    expected = phrases.located(texts, one, 3)
    assert expected == [[(1, 7)], [(1, 4)], [(0, 3)], [(0, 3)]]
    monkeypatch.setattr(phrases, "LETTERS", 3)
    assert phrases.Letters(8).wide == 2 and phrases.located(texts, one, 3) == expected


def test_letters_beyond_the_surrogates():
    line = phrases.Letters(100_000)(np.arange(100_000))
    assert len(set(line)) == 100_000


def test_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    out = queries.queries()["op12_phrases"](spark, SMALL)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        (d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, n, m, t in plain(rows, 35))


def test_memory_of_a_block():
    """Hashes of a block of 4 MB take little beside the block, and do not depend on how many are made at a time."""
    rng = np.random.default_rng(5)
    words = [b"w%x" % i for i in rng.integers(0, 1 << 20, 600_000)] + [b"q" * 70_000, b"end"]
    data = b" ".join(words)
    starts, ends = phrases.edges(data)
    tracemalloc.start()
    try:
        hashes = phrases.word_hashes(data, starts, ends)
        assert tracemalloc.get_traced_memory()[1] < 8 * len(data)
    finally:
        tracemalloc.stop()
    few = [*range(5), *range(phrases.WORDS - 3, phrases.WORDS + 3), len(words) - 2, len(words) - 1]
    assert [hashes[i] for i in few] == [phrases.word_hashes(words[i], *phrases.edges(words[i]))[0] for i in few]
