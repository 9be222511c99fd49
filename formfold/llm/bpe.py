"""Byte-level BPE over a global shuffle of distinct words.

Texts are split into pre-tokens by the pattern.  A task takes documents in blocks, explodes
them into pre-tokens with positions and keeps, per block, each distinct word once and the
words' numbers in order of position.  Words are dealt by their hash, packed by (block,
bucket); a bucket sees each of its words from all blocks and encodes each distinct one once.
Ids go back to the blocks that asked, and there the positions turn them into documents.
A word has one entry a block whatever its frequency, so frequent words are no burden, and a
bucket holds about as many words as a task of the input, whatever the size of the input.

Both shuffles read the documents anew, which is cheaper than to keep the positions; a
block's name is a hash of its place (partition and number in it) and its content: equal
blocks stay apart, and a block that was read differently the second time stops the job
rather than give wrong ids.

Decoding joins ids with the table of token bytes: token numbers are dense, so that the join
is a gather from an Arrow array of the vocabulary, which has a fixed size.

Null texts are empty and have no ids; null or repeated doc_ids keep a row each; other
columns are not looked at.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.llm.tokens import pieces_of


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def merger(path: str):
    """bytes -> ids of one pre-token by the ranks of a vocabulary file."""
    import tiktoken
    made = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks(path), special_tokens={})
    return made._encode_single_piece


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.Array:
    table: list[bytes | None] = [None] * (1 + max(ranks(path).values()))
    for token, rank in ranks(path).items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


class Splitter:
    """Numbers the pre-tokens of a block's texts; a piece between spaces is split once."""

    def __init__(self, pattern: str):
        import regex
        self.find = regex.compile(pattern).findall
        self.words: dict[str, int] = {}
        self.first: dict[str, tuple[int, ...]] = {}
        self.later: dict[str, tuple[int, ...]] = {}

    def numbers(self, text: str, known: dict[str, tuple[int, ...]], piece: str) -> tuple[int, ...]:
        words = self.words
        found = known[piece] = tuple([words.setdefault(w, len(words)) for w in self.find(text)])
        return found

    def split(self, text: str, into: array) -> None:
        first, later = self.first, self.later
        pieces = pieces_of(text)
        into.extend(first.get(pieces[0]) or self.numbers(pieces[0], first, pieces[0]))
        for p in pieces[1:]:
            into.extend(later.get(p) or self.numbers(" " + p, later, p))


def packed(items: list[bytes]) -> bytes:
    """Count, lengths and bytes of a list of byte strings, compressed."""
    return squeeze(np.array([len(items), *map(len, items)], "<u4").tobytes() + b"".join(items))


def unpacked(data: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    stops = (np.cumsum(np.frombuffer(data, "<u4", n, 4)) + 4 + 4 * n).tolist()
    return [data[a:b] for a, b in zip([4 + 4 * n, *stops], stops)]


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def planes(numbers: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, which compress far better than whole words."""
    return squeeze(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def numbers_of(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)


EXPLODED = pa.schema([("block", pa.binary()), ("bucket", pa.int32()), ("data", pa.binary()), ("counts", pa.binary()),
                      ("doc_ids", pa.list_(pa.int64()))])
EXPLODED_DDL = "block binary, bucket int, data binary, counts binary, doc_ids array<bigint>"


def exploded(docs: DataFrame, pattern: str, buckets: int, words_only: bool, most: int = 9_000_000) -> DataFrame:
    """For each block: a row a bucket with its words, or one row (bucket -1) with the words'
    numbers by position, the number of pre-tokens of each document, and the doc_ids.

    Words are numbered by bucket and then by first position."""

    def block_rows(place_read: tuple[int, int], names: list, texts: list[str]):
        cut, numbers, counts = Splitter(pattern), array("I"), []
        for t in texts:
            n = len(numbers)
            if t:
                cut.split(t, numbers)
            counts.append(len(numbers) - n)
        words = [w.encode("utf-8") for w in cut.words]
        at = np.array([zlib.crc32(w) % buckets for w in words], np.int64)
        order = np.argsort(at, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        refs = place[np.frombuffer(numbers, np.uint32)] if numbers else np.zeros(0, np.uint32)
        counts = np.array(counts, "<u4").tobytes()
        name = blake2b(repr((place_read, names)).encode(), digest_size=16)
        for part in (refs.tobytes(), counts, b"\0".join(words)):
            name.update(part)
        block = name.digest()
        if words_only:
            edges = np.searchsorted(at[order], np.arange(buckets + 1)).tolist()
            rows = [(block, b, packed([words[i] for i in order[s:e].tolist()]), None, None)
                    for b, (s, e) in enumerate(zip(edges, edges[1:])) if s < e]
        else:
            rows = [(block, -1, planes(refs), counts, names)]
        if not rows:
            return pa.RecordBatch.from_pylist([], schema=EXPLODED)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), EXPLODED.types)], schema=EXPLODED)

    def explode(batches):
        partition, number = TaskContext.get().partitionId(), 0
        names, texts, size = [], [], 0
        for b in batches:
            for name, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                names.append(name)
                texts.append(text)
                size += len(text or "")
                if size >= most:
                    yield block_rows((partition, number), names, texts)
                    number += 1
                    names, texts, size = [], [], 0
        if names:
            yield block_rows((partition, number), names, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(explode, EXPLODED_DDL)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, buckets: int | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of every document."""
    buckets = buckets or max(8, 4 * docs.rdd.getNumPartitions())
    def encode(table: pa.Table) -> pa.Table:
        merge, known = merger(vocabulary), {}
        coded = []
        for data in table["data"]:
            ids = []
            for word in unpacked(data.as_py()):
                got = known.get(word)
                if got is None:
                    got = known[word] = np.array(merge(word), "<u4").tobytes()
                ids.append(got)
            coded.append(packed(ids))
        return pa.table({"block": table["block"], "bucket": table["bucket"], "data": pa.array(coded, pa.binary()),
                         "counts": pa.nulls(len(coded), pa.binary()),
                         "doc_ids": pa.nulls(len(coded), pa.list_(pa.int64()))})

    words = exploded(docs, pattern, buckets, True).groupBy("bucket").applyInArrow(encode, EXPLODED_DDL)

    def reassemble(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        if table["bucket"][0].as_py() != -1 or len(table) > 1 and table["bucket"][1].as_py() == -1:
            raise RuntimeError("a block of documents was not read the same way twice; give a stored table")
        refs = numbers_of(table["data"][0].as_py())
        coded = [x for data in table["data"][1:] for x in unpacked(data.as_py())]
        sizes = np.array([len(x) for x in coded], np.int64) // 4
        flat = np.frombuffer(b"".join(coded), "<u4")
        starts = np.cumsum(sizes) - sizes
        counts = np.frombuffer(table["counts"][0].as_py(), "<u4").astype(np.int64)
        if len(refs) != counts.sum() or len(refs) and refs.max() >= len(sizes):
            raise RuntimeError("a block of documents was not read the same way twice; give a stored table")
        out, stops = [], np.cumsum(counts)
        for s in range(0, len(counts), 500):
            some = counts[s:s + 500]
            part = refs[int(stops[s] - counts[s]):int(stops[s + len(some) - 1])]
            n = sizes[part]
            ends = np.cumsum(n)
            ids = flat[np.repeat(starts[part] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
            edges = (4 * np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(some)])]).tolist()
            out += [ids[a:b] for a, b in zip(edges, edges[1:])]
        return pa.table({"doc_id": pa.array(table["doc_ids"][0].as_py(), pa.int64()), "ids": pa.array(out, pa.binary())})

    return (exploded(docs, pattern, buckets, False).unionByName(words).groupBy("block")
            .applyInArrow(reassemble, "doc_id long, ids binary"))


def decode_documents(coded: DataFrame, vocabulary: str) -> DataFrame:
    """The rows with `decoded`, the bytes of the ids; null ids are empty, unknown ids are an error."""
    names = coded.columns
    at = names.index("ids")

    def decode(batches):
        table = token_bytes(vocabulary)
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                raw = [x or b"" for x in part.column(at).to_pylist()]
                ids = np.frombuffer(b"".join(raw), "<u4")
                if len(ids) and ids.max() >= len(table):
                    raise ValueError("an id is not in the vocabulary")
                joined = table.take(pa.array(ids, pa.uint32()))
                if joined.null_count:
                    raise ValueError("an id is not in the vocabulary")
                edges = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])])
                places = np.frombuffer(joined.buffers()[1], np.int64)[edges] if len(ids) else edges
                data = joined.buffers()[2].to_pybytes() if len(ids) else b""
                text = [data[x:y] for x, y in zip(places.tolist(), places[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.binary())], names=[*names, "decoded"])

    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(decode, f"{typed}, decoded binary")
