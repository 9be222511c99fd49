"""Token-id files: adaptive context-mixing range coder in independent, checksummed blocks.

A file set is a Parquet folder, so that any store Spark reaches can hold it.  A row is a
group of whole documents in ascending doc_id: their ids and lengths, and the stream of their
ids in blocks of `block` ids.  Every block starts with an empty model, has its own bytes and
the CRC-32 of its ids, and can be decoded alone.

The model of a block predicts each id from its past: order 2 and order 1 name the id that
followed the same two or one ids last time, order 0 offers every id seen so far, by its place
in the block, and new ids have equal shares.  Adaptive weights mix the four: counts of which
order was right, halved as they grow, kept apart by whether orders 2 and 1 agree and by which
order was right last.  The mixed probability narrows a 64-bit range; 16-bit words go out.

numpy codes all blocks of a group in step: step t handles the t-th id of every block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.llm.tokens import encoder, slices

U = np.uint64
SLOTS, TOP, BOTTOM, LOW = 1024, U(1 << 48), U(1 << 32), U((1 << 32) - 1)
CONTEXTS, STEP, MOST = 8, 24, 1024
FIELD, EACH, HALF = U(0xFFFF), U(0x0001000100010001), U(0x7FFF7FFF7FFF7FFF)


class Model:
    """The state of many blocks at once.  The four weights of a context are the 16-bit fields
    of one word, so that a multiplication gives their running sums.  What followed an id and
    where it was last seen stand side by side: this step's place of an id is read from memory
    together with the next step's prediction."""

    def __init__(self, lanes: int, block: int):
        if block > 1 << 16:
            raise ValueError("a block holds at most 65536 ids")
        self.n, self.lane = lanes, np.arange(lanes)
        self.at = self.lane * SLOTS
        self.two, self.known = np.zeros(lanes * SLOTS, np.uint16), np.zeros(lanes * SLOTS, "<u4")
        self.fields = self.known.view("<u2")  # the id that followed, the place of the last
        self.history = np.zeros(block * lanes, np.uint16)
        self.before, self.last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.i1, self.p1 = self.at, np.zeros(lanes, np.uint16)
        self.base = self.lane * CONTEXTS
        self.right = np.zeros(lanes, np.int64)
        self.weights = np.full(lanes * CONTEXTS, EACH, U)
        self.bits = np.array([0, 0, 0, 16], U)

    def predict(self, t: int) -> np.ndarray:
        """Running sums of the weights; sets what order 2 predicts.  Order 1 has its prediction since `enter`."""
        self.i2 = self.at + (((self.last << 5) ^ (self.before * 37) ^ (self.last >> 7)) & SLOTS - 1)
        self.p2 = self.two.take(self.i2)
        self.context = self.base + self.right + ((self.p2 == self.p1).astype(np.int64) << 2)
        self.w = self.weights.take(self.context)
        self.bits[2] = max(t - 1, 0).bit_length()  # of a place in the block so far
        return self.w * EACH

    def enter(self, t: int, ids: np.ndarray, short: np.ndarray, places: bool = True) -> np.ndarray | None:
        """Note the ids (short: with 16 bits) and what the next step's order 1 predicts; returns where they were last seen."""
        self.two[self.i2] = short
        self.fields[self.i1 << 1] = short
        self.i1 = self.at + (ids & SLOTS - 1)
        entry = self.known.take(self.i1)
        self.p1 = entry.astype(np.uint16)
        self.history[t * self.n:(t + 1) * self.n] = short
        self.before, self.last = self.last, ids
        if not places:
            return None
        self.fields[(self.i1 << 1) + 1] = t
        return (entry >> 16).astype(np.int64)

    def weigh(self, order: np.ndarray, shift: np.ndarray) -> None:
        """order says which prediction was right, shift is 16 times that."""
        self.right = order
        w = self.w + (U(STEP) << shift)
        heavy = np.flatnonzero((w >> shift) & FIELD > U(MOST))
        if len(heavy):
            w[heavy] = (w[heavy] >> U(1)) & HALF | EACH
        self.weights[self.context] = w


def shifted_out(low, span, lane=None):
    """Which ranges have a settled top word, after ranges too small to go on were cut short."""
    apart = (low ^ (low + span)) >= TOP
    small = span < BOTTOM
    tight = apart & small
    if tight.any():
        span[tight] = (U(0) - low[tight]) & LOW
    return ~apart | small


def compress(ids: np.ndarray, lanes: int, block: int) -> list[bytes]:
    """ids of shape (block, lanes), a column a block, to the bytes of each."""
    model = Model(lanes, block)
    shorts = ids.astype(np.uint16)
    low, span = np.zeros(lanes, U), np.full(lanes, U(2 ** 64 - 1))
    room = block * 3 + 8
    words = np.zeros(lanes * room, np.uint16)
    fill = np.arange(lanes) * room
    for t in range(block):
        sums = model.predict(t)
        now, short = ids[t], shorts[t]
        wrong2, wrong1 = (model.p2 != short).view(np.int8), (model.p1 != short).view(np.int8)
        place = model.enter(t, now, short)
        new = (model.history.take(place * lanes + model.lane) != short).view(np.int8) if t else np.ones(lanes, np.int8)
        order = (wrong2 * (1 + wrong1 * (1 + new))).astype(np.int64)
        shift = (order << 4).astype(U)
        span = span // (sums >> U(48))
        low += span * ((sums << U(16) >> shift) & FIELD)
        span = span * ((model.w >> shift) & FIELD) >> model.bits.take(order)
        low += span * (np.where(order == 3, now, place) * (order > 1)).astype(U)
        model.weigh(order, shift)
        out = shifted_out(low, span)
        words[fill] = (low >> U(48)).astype(np.uint16)
        step = out.astype(U) << U(4)
        low <<= step
        span <<= step
        fill += out
        again = np.flatnonzero(((low ^ (low + span)) < TOP) | (span < BOTTOM))
        while len(again):
            lo, sp = low[again], span[again]
            out = shifted_out(lo, sp)
            again, lo, sp = again[out], lo[out], sp[out]
            words[fill[again]] = lo >> U(48)
            fill[again] += 1
            low[again], span[again] = lo << U(16), sp << U(16)
    for down in (48, 32, 16, 0):
        words[fill] = low >> U(down) & FIELD
        fill += 1
    return [words[a:b].astype("<u2").tobytes() for a, b in zip(range(0, lanes * room, room), fill.tolist())]


def decompress(payload: np.ndarray, starts: np.ndarray, block: int) -> np.ndarray:
    """Ids of shape (block, lanes) from the words of all blocks and where each begins."""
    lanes = len(starts)
    model = Model(lanes, block)
    payload = np.concatenate([payload, np.zeros(8, np.uint16)])
    at = starts.astype(np.int64)
    low, span, code = np.zeros(lanes, U), np.full(lanes, U(2 ** 64 - 1)), np.zeros(lanes, U)
    for _ in range(4):
        code = code << U(16) | payload[at].astype(U)
        at = at + 1
    for t in range(block):
        sums = model.predict(t)
        span = span // (sums >> U(48))
        value = (code - low) // span
        order = ((value >= (sums & FIELD)).astype(np.int8) + (value >= (sums >> U(16) & FIELD)) + (value >= (sums >> U(32) & FIELD))).astype(np.int64)
        shift = (order << 4).astype(U)
        low += span * ((sums << U(16) >> shift) & FIELD)
        span = span * ((model.w >> shift) & FIELD) >> model.bits.take(order)
        literal = np.flatnonzero(order > 1)
        place = (code[literal] - low[literal]) // span[literal]
        low[literal] += span[literal] * place
        now = np.where(order == 0, model.p2, model.p1).astype(np.int64)
        place, old = place.astype(np.int64), order[literal] == 2
        now[literal] = np.where(old, model.history.take(np.where(old, place, 0) * lanes + literal), place)
        model.enter(t, now, now.astype(np.uint16), places=False)
        model.weigh(order, shift)
        out = shifted_out(low, span)
        step = out.astype(U) << U(4)
        low <<= step
        span <<= step
        code = np.where(out, code << U(16) | payload.take(at), code)
        at += out
        again = np.flatnonzero(((low ^ (low + span)) < TOP) | (span < BOTTOM))
        while len(again):
            lo, sp = low[again], span[again]
            out = shifted_out(lo, sp)
            again, lo, sp = again[out], lo[out], sp[out]
            code[again] = code[again] << U(16) | payload[at[again]].astype(U)
            at[again] += 1
            low[again], span[again] = lo << U(16), sp << U(16)
    return model.history.reshape(block, lanes)


def pack_group(ids: np.ndarray, block: int) -> tuple[bytes, bytes, bytes]:
    """(words, bytes of each block, CRC-32 of each block's ids)"""
    lanes = -(-len(ids) // block)
    if len(ids) and ids.max() >= 1 << 16:
        raise ValueError("ids above 65535 are not supported by this format")
    padded = np.zeros(lanes * block, np.int64)
    padded[:len(ids)] = ids
    padded = padded.reshape(lanes, block)
    parts = compress(np.ascontiguousarray(padded.T), lanes, block) if lanes else []
    sums = [zlib.crc32(row.astype("<u4").tobytes()) for row in padded]
    return b"".join(parts), np.array([len(p) for p in parts], "<u4").tobytes(), np.array(sums, "<u4").tobytes()


def unpack_group(payload: bytes, sizes: bytes, sums: bytes, count: int, block: int) -> np.ndarray:
    sizes = np.frombuffer(sizes, "<u4").astype(np.int64) // 2
    if not len(sizes):
        return np.zeros(0, "<u4")
    ids = np.ascontiguousarray(decompress(np.frombuffer(payload, "<u2"), np.cumsum(sizes) - sizes, block).T).astype("<u4")
    for row, known in zip(ids, np.frombuffer(sums, "<u4")):
        if zlib.crc32(row.tobytes()) != known:
            raise ValueError("a block's checksum does not match its ids")
    return ids.reshape(-1)[:count]


GROUPS = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("n_ids", pa.int64()), ("block", pa.int32()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("sizes", pa.binary()), ("sums", pa.binary()), ("payload", pa.binary())])
GROUP_DDL = ("part int, number int, n_ids long, block int, doc_ids array<bigint>, lengths array<bigint>, "
             "sizes binary, sums binary, payload binary")


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int = 0, block: int = 512, group: int = 2_000_000) -> None:
    """Write the ids of all documents, each followed by `end`, in ascending doc_id.

    Null texts are empty, null doc_ids come first, repeated doc_ids follow one another.  A
    group takes whole documents until it has `group` ids.
    """

    def encoded(batches):
        encode, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4").tobytes()
        names: list = []
        held: list[bytes] = []

        def row():
            lengths = [len(x) // 4 for x in held]
            ids = np.frombuffer(b"".join(held), "<u4")
            words, sizes, sums = pack_group(ids, block)
            values = part, number, len(ids), block, names, lengths, sizes, sums, words
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, GROUPS.types)], schema=GROUPS)

        size = 0
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for first, some in slices(texts):
                for name, coded in zip(ids[first:first + len(some)], encode.encode(some)):
                    names.append(name)
                    held.append(coded + last)
                    size += len(held[-1]) // 4
                    if size >= group:
                        yield row()
                        names, held, size, number = [], [], 0, number + 1
        if held:
            yield row()

    # the tie-break spreads a repeated doc_id over partitions
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        "doc_id", F.crc32(F.encode("text", "UTF-8"))).sortWithinPartitions("doc_id")
    ordered.mapInArrow(encoded, GROUP_DDL).write.option("compression", "none").parquet(path)


def read_ids(spark, path: str, **instead: Column) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document in the files.

    instead: named expressions of the ids to return in their place, so that the ids
    themselves need not be shuffled to the place where starts are joined.
    """
    rows = spark.read.schema(GROUP_DDL).parquet(path)

    def decoded(batches):
        for b in batches:
            for r in range(b.num_rows):
                part, number, n, block, names, lengths, sizes, sums, payload = (c[r].as_py() for c in b.columns)
                ids = unpack_group(payload, sizes, sums, n, block)
                stops = np.cumsum(lengths)
                starts = stops - lengths
                raw = ids.tobytes()
                for i in range(0, len(names), 2000):
                    s, e = starts[i:i + 2000], stops[i:i + 2000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part] * len(s), pa.int32()), pa.array([number] * len(s), pa.int32()),
                        pa.array(names[i:i + 2000], pa.int64()), pa.array(s, pa.int64()), pa.array(e - s, pa.int64()),
                        pa.array([raw[4 * x:4 * y] for x, y in zip(s.tolist(), e.tolist())], pa.binary())],
                        names=["part", "number", "doc_id", "within", "n_tokens", "ids"])

    docs = rows.mapInArrow(decoded, "part int, number int, doc_id long, within long, n_tokens long, ids binary")
    if instead:
        docs = docs.select("part", "number", "doc_id", "within", "n_tokens", *[e.alias(n) for n, e in instead.items()])
    parts = rows.groupBy("part").agg(F.sum("n_ids").alias("n")).selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS earlier")
    groups = rows.selectExpr("part", "number", "sum(n_ids) OVER (PARTITION BY part ORDER BY number) - n_ids AS before")
    base = groups.join(parts, "part").selectExpr("part", "number", "before + earlier AS base")
    return docs.join(base, ["part", "number"]).selectExpr("doc_id", "base + within AS start", "n_tokens", *(instead or ["ids"]))
