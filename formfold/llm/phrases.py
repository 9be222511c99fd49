"""Removal of recurring passages by Aho-Corasick automata over words.

A word goes if it is covered by `width` consecutive words that also start anywhere else, in the
same document or in another.

1. Documents are packed in blocks, words parted by one space, and written once.  Of each run of
   `width` words the anchor is the `gram` words of smallest hash in it; equal runs have it at
   the same place.  A block sends each anchor's hash once, with a count.
2. Documents of equal words are found by digest: they go whole, and only the first of them is
   searched for what others repeat.
3. A block cuts the pieces around anchors that are there twice: all words of the runs that
   have this anchor.  Equal pieces of a block travel once, to the shard that the anchor's hash
   names.  An anchor with more than `hot` places sends each of its runs by its own hash, so
   that what surrounds a very frequent passage is spread over all shards.
4. A shard confirms, word by word, which runs are there twice.  The longest passages made of
   such runs are compiled into an automaton (a letter a word), and all pieces are streamed
   through it; each occurrence is a span of words that goes back to its block.
   What is outside of the pieces has no anchor that recurs, so no passage can be there.
5. A block removes the spans and gives its documents out.

Words are [^\\x20\\x09-\\x0D]+, compared byte by byte.  A null text has no words.  Documents of
fewer than `width` words lose nothing.  Each row of docs gives a row; rows of equal or null
doc_id are documents of their own, and equal rows are copies of each other.  An empty table
gives no row.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.llm.minhash import mixed
from formfold.llm.shared import give_back, stage, tidy
from formfold.llm.suffixes import sliding

U = np.uint64
VALUES = mixed(np.arange(1, 257, dtype=U))
STEP = U(0x9E3779B97F4A7C15)
LETTERS = 1_000_000
#: Words that are hashed at a time.
WORDS = 50_000


def powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[U(1)], np.full(max(n - 1, 0), STEP)]))[:n]


def edges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words parted by one space begin and end."""
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out, letters = np.zeros(len(starts), U), np.frombuffer(data, np.uint8)
    for i in range(0, len(starts), WORDS):  # eight bytes a letter and more: not for all words at once
        first, last = starts[i:i + WORDS], ends[i:i + WORDS]
        sizes = last - first
        factors = powers(min(int(sizes.max()) + 1, 1 << 16))
        at = np.arange(first[0], last[-1]) - np.repeat(first, np.append(sizes[:-1] + 1, sizes[-1]))
        raw = VALUES[letters[first[0]:last[-1]]]
        raw *= factors[at % len(factors)]
        raw[last[:-1] - first[0]] = 0  # the space after a word
        out[i:i + WORDS] = mixed(np.add.reduceat(raw, first - first[0]) + sizes.astype(U))
    return out


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n consecutive items."""
    out = np.zeros(max(len(hashes) - n + 1, 0), U)
    for j, p in enumerate(powers(n)):
        out += hashes[j:j + len(out)] * p
    return mixed(out)


class Block:
    """Documents as words parted by one space; sizes: words of each document."""

    def __init__(self, data: bytes, sizes: np.ndarray):
        self.data, self.sizes = data, sizes
        self.starts, self.ends = edges(data)
        self.firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def anchors(self, width: int, gram: int, skip: np.ndarray):
        """(place, first, last, hash) of the anchors: the runs that begin at first to last have the
        anchor at place.  Documents marked in skip have none."""
        grams = runs(word_hashes(self.data, self.starts, self.ends), gram)
        w, n = width - gram + 1, len(self.starts) - width + 1
        if n < 1:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),)
        least = sliding(np.minimum, grams, w)
        place = np.arange(n)
        for o in range(w - 1, -1, -1):
            place = np.where(grams[o:o + n] == least, np.arange(o, o + n), place)
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        fits = (doc[:n] == doc[width - 1:]) & ~skip[doc[:n]]
        run, place = np.flatnonzero(fits), place[fits]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(run) != 1)]))[:len(run)]
        last = np.append(new[1:], len(run))[:len(new)] - 1
        return place[new], run[new], run[last], grams[place[new]]

    def text(self, a: int, b: int) -> bytes:
        """The words a to b - 1."""
        return self.data[self.starts[a]:self.ends[b - 1]] if b > a else b""

    def kept(self, gone: np.ndarray) -> list[bytes]:
        """Each document's words that stay."""
        out = []
        for a, b in zip(self.firsts[:-1], self.firsts[1:]):
            marks = gone[a:b]
            if not marks.any():
                out.append(self.text(a, b))
                continue
            flips = np.flatnonzero(np.diff(np.concatenate([[True], marks, [True]]).astype(np.int8)))
            out.append(b" ".join(self.text(a + x, a + y) for x, y in zip(flips[::2], flips[1::2])))
        return out


PACKED = "block long, bytes long, digests array<struct<high:long,low:long,at:int,n:int>>, anchors array<struct<hash:long,n:int>>, data binary"


def packer(width: int, gram: int, block_bytes: int):
    def pack(batches):
        number, waiting, held = 0, [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                waiting.append((doc, b" ".join((text or b"").split())))
                held += len(text or b"")
                if held >= block_bytes:
                    yield packed(waiting, number)
                    number, waiting, held = number + 1, [], 0
        if waiting:
            yield packed(waiting, number)

    def packed(rows, number):
        texts = [text for _, text in rows]
        sizes = np.array([text.count(b" ") + bool(text) for text in texts], np.int64)
        block = Block(b" ".join(t for t in texts if t), sizes)
        places, _, _, hashes = block.anchors(width, gram, np.zeros(len(rows), bool))
        hashes, counts = np.unique(hashes, return_counts=True)
        equal: dict[bytes, list[int]] = {}
        for i, text in enumerate(texts):
            if sizes[i] >= width:
                equal.setdefault(hashlib.blake2b(text, digest_size=16).digest(), []).append(i)
        digests = []
        for key, at in equal.items():
            high, low = np.frombuffer(key, "<i8").tolist()
            digests.append({"high": high, "low": low, "at": at[0], "n": len(at)})
        head = pa.table({"doc_id": pa.array([doc for doc, _ in rows], pa.int64()), "words": sizes})
        copies = pa.table({"at": pa.array([i for a in equal.values() for i in a], pa.int32()),
                           "first": pa.array([a[0] for a in equal.values() for _ in a], pa.int32())})
        data = b"".join(zipped(t) for t in (ipc(head), ipc(copies), block.data))
        return pa.RecordBatch.from_pydict({
            "block": pa.array([TaskContext.get().partitionId() << 32 | number], pa.int64()),
            "bytes": pa.array([len(block.data)], pa.int64()),
            "digests": pa.array([digests], pa.list_(pa.struct(
                [("high", pa.int64()), ("low", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))),
            "anchors": pa.ListArray.from_arrays(pa.array([0, len(hashes)], pa.int32()), pa.StructArray.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int32))], names=["hash", "n"])),
            "data": pa.array([data], pa.binary())})

    return pack


def ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def zipped(part: bytes) -> bytes:
    made = zstandard.ZstdCompressor(level=3).compress(part)
    return len(made).to_bytes(8, "little") + made


def unpacked(data: bytes) -> tuple[pa.Table, pa.Table, bytes]:
    out, at = [], 0
    for _ in range(3):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(zstandard.ZstdDecompressor().decompress(data[at + 8:at + 8 + n]))
        at += 8 + n
    return pa.ipc.open_stream(out[0]).read_all(), pa.ipc.open_stream(out[1]).read_all(), out[2]


def opened(data: bytes, copies: list[dict] | None):
    """The block, its doc_ids, which documents are copies, and which of those others stand for."""
    head, equal, text = unpacked(data)
    block = Block(text, head["words"].to_numpy())
    whole, later = np.zeros(head.num_rows, bool), np.zeros(head.num_rows, bool)
    first = {c["at"]: c["first"] for c in copies or []}
    for at, of in zip(equal["at"].to_pylist(), equal["first"].to_pylist()):
        if of in first:
            whole[at], later[at] = True, at != of or not first[of]
    return block, head["doc_id"], whole, later


# ---- pieces -----------------------------------------------------------------------

PIECES = "shard int, block long, places binary, text binary"


def cutter(width: int, gram: int, shards: int):
    """Pieces of blocks: rows of (block, data, recurring: hashes with a flag, copies)."""
    def rows(b):
        for i in range(b.num_rows):
            number, data, copies = (b.column(c)[i].as_py() for c in ("block", "data", "copies"))
            asked = b.column("recurring")[i].values
            yield {"block": number, "data": data, "copies": copies,
                   "hashes": asked.field("hash").to_numpy(), "hot": asked.field("hot").to_numpy(zero_copy_only=False)}

    def cut(batches):
        for b in batches:
            for row in rows(b):
                out = [[], [], []]
                for shard, places, text in pieces_of(row):
                    for column, x in zip(out, (shard, places, text)):
                        column.append(x)
                    if len(out[0]) == 20_000:
                        yield made(row["block"], out)
                        out = [[], [], []]
                yield made(row["block"], out)

    def made(block, out):
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), pa.array([block] * len(out[0]), pa.int64()),
             pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=["shard", "block", "places", "text"])

    def pieces_of(row):
        block, _, _, later = opened(row["data"], row["copies"])
        _, first, last, hashes = block.anchors(width, gram, later)
        asked = row["hashes"].view(U)
        hot = row["hot"]
        by = np.argsort(asked)
        asked, hot = asked[by], hot[by]
        at = np.minimum(np.searchsorted(asked, hashes), len(asked) - 1)
        known = asked[at] == hashes
        one = known & ~hot[at]
        # runs of hot anchors go one by one, each by its own hash
        many = np.flatnonzero(known & hot[at])
        single = np.concatenate([np.arange(first[i], last[i] + 1) for i in many] or [np.zeros(0, np.int64)])
        keys = np.zeros(0, U)
        if len(single):
            keys = runs(word_hashes(block.data, block.starts, block.ends), width)[single]
        begin = np.concatenate([first[one], single]).astype(np.int64)
        stop = np.concatenate([last[one], single]).astype(np.int64) + width
        shard = (mixed(np.concatenate([hashes[one], keys])) % U(shards)).astype(np.int64)
        data, held = block.data, {}
        for a, x, y, s in zip(begin.tolist(), block.starts[begin].tolist(), block.ends[stop - 1].tolist(), shard.tolist()):
            held.setdefault(data[x:y], (s, []))[1].append(a)
        for text, (s, places) in held.items():
            yield s, array("I", places).tobytes(), text

    return cut


# ---- shards -----------------------------------------------------------------------

class Numbers(dict):
    """A number for each key, in the order in which they are asked for first."""

    def __missing__(self, key):
        self[key] = len(self)
        return self[key]


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Words as numbers, where each text begins and ends among them, and how many differ."""
    known, ids = Numbers(), array("I")
    for t in texts:
        ids.extend(map(known.__getitem__, t.split(b" ")))
    bounds = np.concatenate([[0], np.cumsum([t.count(b" ") + 1 for t in texts])]).astype(np.int64)
    return np.array(ids, np.int64), bounds, len(known)


def recurring(ids: np.ndarray, bounds: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Which of the runs that begin at each word are there twice; places: occurrences of each text."""
    sizes = np.diff(bounds)
    left = np.repeat(bounds[1:], sizes) - np.arange(len(ids))
    at = np.flatnonzero(left >= width)
    out = np.zeros(len(ids), bool)
    if not len(at):
        return out
    keys = runs(mixed(ids.astype(U) + U(1)), width)[at]
    weight = np.repeat(places, sizes)[at]
    order = np.argsort(keys, kind="stable")
    group = np.cumsum(np.concatenate([[False], keys[order][1:] != keys[order][:-1]]))
    # the words decide, not the hash: whoever differs from the first of its group is compared by its words
    first = order[np.searchsorted(group, group)]
    same = np.ones(len(order), bool)
    for i in range(0, len(order), 100_000):
        a, b = at[order[i:i + 100_000]], at[first[i:i + 100_000]]
        for j in range(width):
            same[i:i + 100_000] &= ids[a + j] == ids[b + j]
    total = np.bincount(group[same], weight[order][same], minlength=group[-1] + 1)
    out[at[order[same]]] = total[group[same]] >= 2
    others: dict[bytes, list[int]] = {}
    for k in order[~same]:
        others.setdefault(ids[at[k]:at[k] + width].tobytes(), []).append(k)
    for ks in others.values():
        out[at[ks]] = weight[ks].sum() >= 2
    return out


class Letters:
    """Word numbers as text, a letter a word, or two where there are more words than letters."""

    def __init__(self, words: int):
        self.wide = 1
        while LETTERS ** self.wide < words:
            self.wide += 1

    def __call__(self, ids: np.ndarray) -> str:
        digits = np.stack([ids // LETTERS ** i % LETTERS for i in range(self.wide)], 1).reshape(-1) + 1
        return (digits + np.where(digits >= 0xD800, 0x800, 0)).astype("<u4").tobytes().decode("utf-32-le")


def automaton(phrases, wide: int) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for p in phrases:
        made.add_word(p, len(p) // wide)
    made.make_automaton()
    return made


def located(texts: list[bytes], places: np.ndarray, width: int) -> list[list[tuple[int, int]]]:
    """Spans of words of each text that recurring runs cover; places: occurrences of each text."""
    ids, bounds, words = numbered(texts)
    again = recurring(ids, bounds, places, width)
    letters = Letters(words)
    line = letters(ids)
    wide = letters.wide
    starts = np.flatnonzero(again)
    # runs that follow each other in one text are one passage
    text_of = np.searchsorted(bounds, starts, "right")
    cuts = np.flatnonzero(np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(text_of) != 0)]))[:len(starts)]
    lasts = np.append(cuts[1:], len(starts))[:len(cuts)] - 1
    phrases = {line[wide * starts[a]:wide * (starts[z] + width)] for a, z in zip(cuts, lasts)}
    if not phrases:
        return [[] for _ in texts]
    find, out = automaton(phrases, wide), []
    for a, b in zip(bounds[:-1], bounds[1:]):
        spans = []
        for end, length in find.iter(line[wide * a:wide * b]):
            if (end + 1) % wide == 0:
                stop = (end + 1) // wide
                start = stop - length
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, stop))
        out.append(spans)
    return out


def search_shard(table: pa.Table, width: int) -> pa.Table:
    texts = [t.as_py() for t in table["text"]]
    places = [np.frombuffer(p.as_py(), "<u4").astype(np.int64) for p in table["places"]]
    spans = located(texts, np.array([len(p) for p in places]), width)
    keep = [i for i, s in enumerate(spans) if s]
    marks = [np.concatenate([(places[i][:, None] + [[a, b]]).reshape(-1) for a, b in spans[i]]).astype("<u4").tobytes() for i in keep]
    return pa.table({"block": table["block"].take(pa.array(keep, pa.int64())), "spans": pa.array(marks, pa.binary())})


# ---- removal ----------------------------------------------------------------------

REMOVED = "doc_id long, n_words long, n_removed long, kept string"


def remover(width: int):
    """Documents of blocks without their spans: rows of (data, copies, spans)."""
    def remove(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                block, ids, whole, _ = opened(row["data"], row["copies"])
                n = len(block.starts) + 1
                ends = np.frombuffer(b"".join(row["spans"] or []), "<u4").reshape(-1, 2).astype(np.int64)
                steps = np.bincount(ends[:, 0], minlength=n) - np.bincount(ends[:, 1], minlength=n)
                gone = np.cumsum(steps[:-1]) > 0
                gone |= np.repeat(whole, block.sizes)
                counts = np.diff(np.concatenate([[0], np.cumsum(gone)])[block.firsts])
                yield pa.RecordBatch.from_arrays(
                    [ids.combine_chunks(), pa.array(block.sizes), pa.array(counts),
                     pa.array(block.kept(gone), pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])

    return remove


def remove_phrases(docs: DataFrame, width: int = 35, gram: int = 12, hot: int = 10_000, block_bytes: int = 4 << 20,
                   shard_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, parted by one space) of every row."""
    if not 0 < gram <= width:
        raise ValueError("an anchor has from 1 to `width` words")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    blocks = stage(texts.mapInArrow(tidy(packer(width, gram, block_bytes)), PACKED), "phrase-blocks")
    shards = max(8, (blocks.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes)
    # rows of a key are a row a block: sums over them are small windows
    digests = blocks.select("block", F.inline("digests")).selectExpr(
        "block", "at", "sum(n) OVER (PARTITION BY high, low) AS n", "min(block) OVER (PARTITION BY high, low) = block AS first")
    copies = stage(digests.where("n > 1").groupBy("block").agg(F.collect_list(F.struct("at", "first")).alias("copies")), "copies")
    anchors = blocks.select("block", F.inline("anchors")).selectExpr("block", "hash", "sum(n) OVER (PARTITION BY hash) AS n")
    asked = anchors.where("n > 1").groupBy("block").agg(
        F.collect_list(F.struct("hash", (F.col("n") > hot).alias("hot"))).alias("recurring"))
    whole = blocks.select("block", "data")
    pieces = whole.join(asked, "block").join(copies, "block", "left").mapInArrow(tidy(cutter(width, gram, shards)), PIECES)

    def search(table):  # applyInArrow hands a shard over at a time
        try:
            return search_shard(table, width)
        finally:
            give_back()

    spans = pieces.groupBy("shard").applyInArrow(search, "block long, spans binary")
    spans = spans.groupBy("block").agg(F.collect_list("spans").alias("spans"))
    return whole.join(spans, "block", "left").join(copies, "block", "left").select("data", "copies", "spans").mapInArrow(
        tidy(remover(width)), REMOVED)
