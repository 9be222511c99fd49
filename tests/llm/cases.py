"""Hand-made rows with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

DDL = ("doc_id long, text string, lang string, source string, n_chars long, score double, ids string, bucket int, "
       "`_id` long, n int, digest string, key long, block int, lead string, data string, component string")
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew near the old mill at dawn"


def documents() -> list[tuple]:
    """Nulls, empty and long texts, copies, near copies, shared passages, odd white space."""
    rng = np.random.default_rng(5)
    words = ["w%x" % i for i in rng.integers(0, 4000, 3000)]
    base = " ".join(words[:120])
    near = " ".join(words[:118] + ["changed", "ending"])
    texts = [
        base, base, near, None, "", " ", "a", "one two", "ONE two", "one  two\n three\t four ",
        "x " * 40 + PASSAGE + " tail " * 9, "y " * 30 + PASSAGE + " é" * 60, PASSAGE, PASSAGE.upper(),
        "é" * 70, "é" * 70 + "z", "ab" * 120, "日本語 テキスト　です " * 12, "a b  c it's 'S 12345 ½ <|endoftext|>",
        " ".join(words[200:2800]), " ".join(words[200:2700]), "\x00\x01 \x1c \x85 ퟿", "trailing  ", "  leading",
        " ".join(words[:100]) + " " + " ".join(words[2900:2920]), "q" * 3000, "q" * 3000,
    ]
    rows = [(i * 3 + 7 if i % 2 else 400 - i, t, "en", "src0", len(t or ""), 0.5, "ids", 1, 2, 3, "d", 4, 5, "l", "x", "c")
            for i, t in enumerate(texts)]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DDL).repartition(3)


def texts(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


@lru_cache(maxsize=None)
def plain_tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def plain_ids(text: str | None) -> np.ndarray:
    return np.array(plain_tokenizer().encode(text or "", add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=None)
def plain_bpe():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_sets(rows, width):
    out = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        out[d] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    return out


def plain_components(rows, width, percent=80):
    """doc_id -> (set size, smallest reachable doc_id), by comparing all pairs."""
    sets = plain_sets(rows, width)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def plain_removal(rows, length):
    """doc_id -> which bytes go, for rows of distinct doc_ids."""
    return dict(zip([d for d, _ in rows], plain_removal_of_rows(rows, length)))


def plain_removal_of_rows(rows, length):
    """Which bytes of each row go, by a table of all strings with their least doc_id."""
    least = {}
    raws = [(t or "").encode() for _, t in rows]
    for (d, _), raw in zip(rows, raws):
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if d is not None and d < least.get(s, d + 1):
                least[s] = d
    out = []
    for (d, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if d is not None and least[raw[i:i + length]] < d:
                gone[i:i + length] = True
        out.append(gone)
    return out
