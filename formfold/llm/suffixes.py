"""Removal of repeated passages by a distributed sparse suffix array over bytes.

A byte goes if it is covered by a string of `length` bytes that also starts in a document of
smaller doc_id.  Any such string holds an anchor: the `k` bytes of smallest hash in it, and
equal strings have it at the same place.  So only suffixes that begin at anchors are
sorted, and each is compared to its left as far as a string may reach.

Documents are packed in blocks and written once; a row is named by its block and its place
there, so rows of equal doc_id stay apart, and doc_id only says who is smaller.

1. Texts that equal one of a smaller doc_id are decided by a digest.
2. Anchors meet by hash: a block sends each hash once, packed by bucket, and gets bits back:
   which of them other texts have too, and which of them more than `hot` blocks have.
3. The suffixes of shared anchors (`length` bytes, with the bytes before them) are partitioned
   by range of their leading bytes, by splitters sampled from `sample` texts; splitters never
   part suffixes of equal leading bytes.  A block sends equal suffixes once, for the smallest
   document; the others are decided.  Strings around a hot anchor go one by one, by their own
   hash, so that what surrounds a very frequent passage is spread over all tasks.
4. A range sorts its suffixes by multikey quicksort, a word of eight bytes at a time.  From
   the common prefixes of neighbours it reads, for every distance to the left, which
   suffixes go on alike; those with equal bytes before them form the groups in which every
   document but the smallest repeats.  A range is read whole, so that no boundary parts a
   run of equal suffixes.
5. Marks go back to the blocks, which give their rows out.

A task of 2 or 4 handles some 2 million anchors or half a million suffixes, whatever the size
of the input; small inputs have 64 tasks each.

Bytes before a suffix and leading bytes are compared by 64-bit hashes within groups of equal
suffixes.  Null texts are empty; documents shorter than `length` lose nothing; a row without
doc_id takes no part and keeps its text; rows of equal doc_id do not count as smaller, whether
their texts are equal or not.  Every row of the input comes back once, with all its columns,
and an empty table gives no row; the result is one column under a name the caller chooses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.llm.minhash import mixed
from formfold.llm.shared import free_name, stage, tidy

U = np.uint64


def gram(length: int) -> int:
    """Bytes of an anchor: long ones are shared by chance less often, short ones are fewer; at
    most 64 strings of `length` bytes hold one at different places."""
    if length < 16:
        raise ValueError("length must be 16 at least")
    return max(length // 2, length - 63)


class Anchors:
    """Places and hashes of the anchors of a text."""

    def __init__(self, length: int):
        self.length, self.k = length, gram(length)
        self.values = mixed(np.arange(1, 257, dtype=U))
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        base = 0x9E3779B97F4A7C15
        both = []
        for b in (base, pow(base, -1, 2 ** 64)):
            p = np.ones(1, U)
            while len(p) < n:
                p = np.concatenate([p, p * U(pow(b, len(p), 2 ** 64))])
            both.append(p)
        self.powers, self.inverses = both

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        n, k, w = len(text), self.k, self.length - self.k + 1
        if n < self.length:
            return np.zeros(0, np.int64), np.zeros(0, U)
        if n > len(self.powers):
            self.grow(n)
        sums = np.zeros(n + 1, U)
        np.cumsum(self.values[np.frombuffer(text, np.uint8)] * self.powers[:n], out=sums[1:])
        h = mixed((sums[k:] - sums[:-k]) * self.inverses[:n - k + 1])
        least = sliding(np.minimum, h, w)
        edge = np.zeros(w - 1, U)
        at = np.flatnonzero(sliding(np.maximum, np.concatenate([edge, least, edge]), w) == h)
        return at, h[at]


def sliding(pick, x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = pick(x[:-n], x[n:])
        n *= 2
    return pick(x[:n - width], x[width - n:]) if n < width else x


def sorted_order(words: np.ndarray) -> np.ndarray:
    """Row order of big-endian words by multikey quicksort: runs that agree in a word are
    sorted by the next one."""
    order = np.argsort(words[:, 0], kind="stable")
    run = np.zeros(len(order), np.int64)
    for j in range(1, words.shape[1] + 1):
        before = words[order, j - 1]
        run = np.cumsum(np.concatenate([[True], (run[1:] != run[:-1]) | (before[1:] != before[:-1])])[:len(order)]) - 1
        if j == words.shape[1]:
            break
        size = np.bincount(run)
        tied = np.flatnonzero(size[run] > 1)
        if not len(tied):
            break
        order[tied] = order[tied][np.lexsort((words[order[tied], j], run[tied]))]
    return order


def common_prefix(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row shares with the one before it."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def repeats(docs: np.ndarray, left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray,
            length: int) -> np.ndarray:
    """For each suffix the bits of the distances o at which the string that starts o bytes
    before it also starts in a smaller document.  left holds the bytes before, nearest first."""
    pad = -right.shape[1] % 8
    words = np.ascontiguousarray(np.pad(right, ((0, 0), (0, pad)))).view(">u8").astype(U)
    order = sorted_order(words)
    del words
    docs, left, n_left, n_right = docs[order], left[order], n_left[order], n_right[order]
    prefix = common_prefix(right[order])
    marks, before = np.zeros(len(order), U), np.zeros(len(order), U)
    values = mixed(np.arange(1, 257, dtype=U))
    for o in range(left.shape[1] + 1):
        if o:
            before = mixed(before + values[left[:, o - 1]])
        rows = np.flatnonzero((n_left >= o) & (n_right >= length - o))
        if len(rows) < 2:
            continue
        run = np.cumsum(prefix < length - o)[rows]
        key = mixed(mixed(run.astype(U)) + before[rows])
        by = np.lexsort((docs[rows], key))
        first = np.concatenate([[True], key[by][1:] != key[by][:-1]])
        least = docs[rows][by][np.flatnonzero(first)][np.cumsum(first) - 1]
        again = rows[by][docs[rows][by] > least]
        marks[again] |= U(1) << U(o)
    out = np.zeros(len(order), U)
    out[order] = marks
    return out


def full_marks(n_left: np.ndarray, n_right: np.ndarray, length: int) -> np.ndarray:
    """Bits of all distances at which a string fits."""
    low = np.maximum(length - n_right, 0).astype(U)
    ones = lambda n: np.where(n >= 64, U(2 ** 64 - 1), (U(1) << np.minimum(n, 63).astype(U)) - U(1))
    return ones((n_left + 1).astype(np.int64)) & ~ones(low.astype(np.int64))


def covered(size: int, places: np.ndarray, marks: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of a text go, by the marks at its places."""
    edges = np.zeros(size + 1, np.int64)
    for i in range(0, len(places), 10_000):
        row, o = np.nonzero((marks[i:i + 10_000, None] >> np.arange(64, dtype=U)) & U(1))
        starts = places[i:i + 10_000][row] - o
        edges += np.bincount(starts, minlength=size + 1) - np.bincount(starts + length, minlength=size + 1)
    return np.cumsum(edges[:-1]) > 0


def within_characters(text: bytes, gone: np.ndarray) -> np.ndarray:
    """Keeps every character of which a byte stays."""
    if not gone.any() or gone.all():
        return gone
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    character = np.cumsum(lead) - lead[0]
    return np.bincount(character, weights=~gone)[character] == 0


# ---- blocks -----------------------------------------------------------------------

PACKED = "block long, bytes long, texts long, digests array<struct<high:long,low:long,at:int,least:long,most:long>>, data binary"


def packer(at_id: int, at_text: int, length: int, block_bytes: int):
    """Rows of any columns to blocks of about so many bytes of text.  Each row gets the place of
    the first row of equal text (-1: takes no part), each such text its least and largest doc_id."""
    def pack(batches):
        number, waiting, held = 0, [], 0
        for b in batches:
            sizes = pa.compute.binary_length(b.column(at_text)).fill_null(0).to_numpy(zero_copy_only=False)
            start = 0
            for i, size in enumerate(sizes.tolist(), 1):
                held += size
                if held >= block_bytes:
                    yield packed([*waiting, b.slice(start, i - start)], number)
                    number, waiting, held, start = number + 1, [], 0, i
            if start < b.num_rows:
                waiting.append(b.slice(start))
        if waiting:
            yield packed(waiting, number)

    def packed(batches, number):
        table = pa.Table.from_batches(batches)
        same, known, total = [], {}, 0
        for i, (doc, text) in enumerate(zip(table.column(at_id).to_pylist(), table.column(at_text).to_pylist())):
            raw = (text or "").encode("utf-8", "surrogatepass")
            total += len(raw)
            if doc is None or len(raw) < length:
                same.append(-1)
                continue
            found = known.setdefault(hashlib.blake2b(raw, digest_size=16).digest(), [i, doc, doc])
            found[1:] = min(found[1], doc), max(found[2], doc)
            same.append(found[0])
        digests = [dict(zip(("high", "low"), np.frombuffer(d, "<i8").tolist()), at=x[0], least=x[1], most=x[2])
                   for d, x in known.items()]
        data = squeezed(table.append_column("same", pa.array(same, pa.int32())))
        return pa.RecordBatch.from_pydict({
            "block": pa.array([TaskContext.get().partitionId() << 32 | number], pa.int64()),
            "bytes": pa.array([total], pa.int64()), "texts": pa.array([len(known)], pa.int64()),
            "digests": pa.array([digests], pa.list_(pa.struct(
                [("high", pa.int64()), ("low", pa.int64()), ("at", pa.int32()), ("least", pa.int64()), ("most", pa.int64())]))),
            "data": pa.array([data], pa.binary())})

    return pack


def squeezed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


class Block:
    """The rows of a block.  units: places of the texts that take part, each once; docs: their
    least doc_id; raw: their bytes."""

    def __init__(self, data: bytes, at_id: int, at_text: int):
        self.table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()
        self.same = self.table.column("same").to_numpy()
        self.at_text = at_text
        self.ids = self.table.column(at_id).fill_null(0).to_numpy()
        self.units = np.flatnonzero(self.same == np.arange(len(self.same)))
        least = np.full(len(self.same), np.iinfo(np.int64).max)
        part = np.flatnonzero(self.same >= 0)
        np.minimum.at(least, self.same[part], self.ids[part])
        self.docs = least[self.units]
        texts = self.table.column(at_text)
        self.raw = [texts[int(u)].as_py().encode("utf-8", "surrogatepass") for u in self.units]

    def anchors(self, find: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, place, hash) of all anchors."""
        found = [find(raw) for raw in self.raw]
        unit = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        place = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        return unit, place, np.concatenate([f[1] for f in found] or [np.zeros(0, U)])


def dealt(hashes: np.ndarray, buckets: int):
    """The distinct hashes by bucket and then by size, where each bucket begins, and the number
    of each hash among them."""
    known, inverse = np.unique(hashes, return_inverse=True)
    at = (known % U(buckets)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return known[order], np.searchsorted(at[order], np.arange(buckets + 1)), rank[inverse]


def asker(at_id: int, at_text: int, length: int, buckets: int):
    """A row a bucket: upper halves of the hashes of a block's anchors, and which of them two of
    its texts share.  Within a bucket the half tells anchors apart well enough for a filter."""
    def ask(batches):
        find = Anchors(length)
        for b in batches:
            for i in range(b.num_rows):
                number, data = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                unit, _, hashes = Block(data, at_id, at_text).anchors(find)
                known, edges, rank = dealt(hashes, buckets)
                shared = several(rank, unit, len(known))
                out = [(bucket, (known[x:y] >> U(32)).astype("<u4").tobytes() + np.packbits(shared[x:y]).tobytes(), y - x)
                       for bucket, (x, y) in enumerate(zip(edges.tolist(), edges[1:].tolist())) if x < y]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([number] * len(out), pa.int64()),
                     pa.array([o[2] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())],
                    names=["bucket", "block", "n", "data"])

    return ask


def several(group: np.ndarray, owner: np.ndarray, groups: int) -> np.ndarray:
    """Which groups have more than one owner."""
    low, high = np.full(groups, np.iinfo(np.int64).max), np.full(groups, -1)
    np.minimum.at(low, group, owner)
    np.maximum.at(high, group, owner)
    return low < high


def answer(table: pa.Table, hot: int) -> pa.Table:
    """For each block's row of a bucket: bits of the hashes that it or another block has twice,
    and of those that more than `hot` blocks have."""
    sizes = table["n"].to_numpy().astype(np.int64)
    raw = [d.as_py() for d in table["data"]]
    h = np.concatenate([np.frombuffer(r, "<u4", n) for r, n in zip(raw, sizes)])
    own = np.concatenate([np.unpackbits(np.frombuffer(r, np.uint8, -1, 4 * n))[:n] for r, n in zip(raw, sizes)]).astype(bool)
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    count = np.diff(np.append(first, len(h)))
    shared, many = np.zeros(len(h), bool), np.zeros(len(h), bool)
    shared[order] = np.repeat((count > 1) | np.bitwise_or.reduceat(own[order], first), count)
    many[order] = np.repeat(count > hot, count)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    bits = [[np.packbits(x[a:b]).tobytes() for a, b in zip(edges, edges[1:])] for x in (shared, many)]
    return pa.table({"block": table["block"], "bucket": table["bucket"],
                     "shared": pa.array(bits[0], pa.binary()), "many": pa.array(bits[1], pa.binary())})


# ---- suffixes ---------------------------------------------------------------------

SENT = "bucket int, block long, done boolean, data binary"


def leads_of(right: np.ndarray, k: int) -> np.ndarray:
    """The leading bytes of suffixes, as byte strings that sort like them."""
    wide = min(k, 24)
    return np.ascontiguousarray(right[:, :wide]).view(f"S{wide}").reshape(-1)


def first_of_equal(rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Of equal rows of bytes, which are not of the least document."""
    if not len(rows):
        return np.zeros(0, bool)
    _, group = np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").reshape(-1), return_inverse=True)
    least = np.full(group.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, docs)
    return docs > least[group]


def row_hashes(rows: np.ndarray) -> np.ndarray:
    out, values = np.zeros(len(rows), U), mixed(np.arange(1, 257, dtype=U))
    for j in range(rows.shape[1]):
        out = mixed(out + values[rows[:, j]])
    return out


class Suffixes:
    """Suffixes as arrays: the unit and doc_id they are of, their place, how many bytes before
    and behind it count, and those bytes."""

    FIELDS = (("unit", "<u4"), ("place", "<u4"), ("doc", "<i8"), ("n_left", "<u2"), ("n_right", "<u2"))

    def __init__(self, unit, place, doc, n_left, n_right, pieces):
        self.unit, self.place, self.doc, self.n_left, self.n_right, self.pieces = unit, place, doc, n_left, n_right, pieces

    def take(self, rows: np.ndarray) -> "Suffixes":
        return Suffixes(*[x[rows] for x in (self.unit, self.place, self.doc, self.n_left, self.n_right, self.pieces)])

    def packed(self) -> bytes:
        fields = [getattr(self, n).astype(t).tobytes() for n, t in self.FIELDS]
        return zstandard.ZstdCompressor(level=1).compress(
            np.array([len(self.unit)], "<u4").tobytes() + b"".join(fields) + self.pieces.tobytes())

    @classmethod
    def unpacked(cls, data: list[bytes], step: int) -> tuple["Suffixes", list[int]]:
        """The suffixes of several packets, and how many each has."""
        parts: list[list[np.ndarray]] = [[] for _ in range(6)]
        sizes = []
        for one in data:
            raw = zstandard.ZstdDecompressor().decompress(one)
            n, at = int(np.frombuffer(raw, "<u4", 1)[0]), 4
            sizes.append(n)
            for column, (name, kind) in zip(parts, cls.FIELDS):
                column.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
                at += n * np.dtype(kind).itemsize
            parts[5].append(np.frombuffer(raw, np.uint8, n * step, at).reshape(n, step))
        return cls(*[np.concatenate(p) for p in parts]), sizes


def packed_marks(unit: np.ndarray, place: np.ndarray, marks: np.ndarray) -> bytes:
    return unit.astype("<u4").tobytes() + place.astype("<u4").tobytes() + marks.astype("<u8").tobytes()


def unpacked_marks(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = [[], [], []]
    for p in packed:
        n = len(p) // 16
        for column, kind, at in zip(out, ("<u4", "<u4", "<u8"), (0, 4 * n, 8 * n)):
            column.append(np.frombuffer(p, kind, n, at))
    unit, place, marks = (np.concatenate(c or [np.zeros(0, U)]) for c in out)
    return unit.astype(np.int64), place.astype(np.int64), marks.astype(U)


def cutter(at_id: int, at_text: int, length: int, buckets: int, ranges: int, splitters: np.ndarray):
    """Suffixes of blocks by range, and the marks that a block can tell by itself: rows of (block,
    data, copies, answers) to SENT."""
    k, reach = gram(length), length - gram(length)

    def cut(batches):
        find = Anchors(length)
        for b in batches:
            for i in range(b.num_rows):
                (row,) = b.slice(i, 1).to_pylist()
                out = list(sent(row, find))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([row["block"]] * len(out), pa.int64()),
                     pa.array([o[1] for o in out], pa.bool_()), pa.array([o[2] for o in out], pa.binary())],
                    names=["bucket", "block", "done", "data"])

    def sent(row, find) -> Iterator[tuple[int, bool, bytes]]:
        block = Block(row["data"], at_id, at_text)
        unit, place, hashes = block.anchors(find)
        known, edges, rank = dealt(hashes, buckets)
        shared, many = np.zeros(len(known), bool), np.zeros(len(known), bool)
        for a in row["answers"]:
            x, y = edges[a["bucket"]], edges[a["bucket"] + 1]
            for bits, name in ((shared, "shared"), (many, "many")):
                bits[x:y] = np.unpackbits(np.frombuffer(a[name], np.uint8))[:y - x]
        # texts that a smaller document has need no search
        searched = np.ones(len(block.units), bool)
        for c in row["copies"] or []:
            i = int(np.searchsorted(block.units, c["at"]))
            searched[i] = block.docs[i] == c["least"]
        asked = np.flatnonzero(shared[rank] & searched[unit])
        for first in range(0, len(asked), 50_000):
            some = asked[first:first + 50_000]
            yield from routed(block, row["block"], unit[some], place[some], many[rank[some]])

    def routed(block, number, unit, place, many):
        pieces = np.zeros((len(unit), reach + length), np.uint8)
        bounds = np.searchsorted(unit, np.unique(unit)).tolist() + [len(unit)]
        for x, y in zip(bounds, bounds[1:]):
            wide = np.frombuffer(bytes(reach) + block.raw[unit[x]] + bytes(length), np.uint8)
            pieces[x:y] = wide[place[x:y, None] + np.arange(reach + length)]
        sizes = np.array([len(r) for r in block.raw], np.int64)
        n_left, n_right = np.minimum(place, reach), np.minimum(sizes[unit] - place, length)
        every = Suffixes(unit, place, block.docs[unit], n_left, n_right, pieces)
        # the smallest document of equal suffixes stands for them; in the others every string repeats
        plain = every.take(np.flatnonzero(~many))
        sides = np.column_stack([plain.n_left, plain.n_right]).astype("<u2").view(np.uint8).reshape(-1, 4)
        later = first_of_equal(np.column_stack([plain.pieces, sides]), plain.doc)
        own = int(mixed(np.array([number], np.int64).view(U))[0] % U(ranges))
        if later.any():
            x = plain.take(np.flatnonzero(later))
            yield own, True, packed_marks(x.unit, x.place, full_marks(x.n_left, x.n_right, length))
        plain = plain.take(np.flatnonzero(~later))
        yield from by_bucket(plain, np.searchsorted(splitters, leads_of(plain.pieces[:, reach:], k), side="right"))
        hot = every.take(np.flatnonzero(many))
        if not len(hot.unit):
            return
        parts = []
        for o in range(reach + 1):  # each string around a hot anchor, once
            x = hot.take(np.flatnonzero((hot.n_left >= o) & (hot.n_right >= length - o)))
            strings = np.zeros((len(x.unit), reach + length), np.uint8)
            strings[:, reach:] = x.pieces[:, reach - o:reach - o + length]
            parts.append(Suffixes(x.unit, x.place - o, x.doc, np.zeros(len(x.unit), np.int64), np.full(len(x.unit), length), strings))
        single = Suffixes(*[np.concatenate([getattr(p, n) for p in parts]) for n in ("unit", "place", "doc", "n_left", "n_right", "pieces")])
        _, once = np.unique(single.unit << 32 | single.place, return_index=True)
        single = single.take(once)
        later = first_of_equal(single.pieces, single.doc)
        if later.any():
            yield own, True, packed_marks(single.unit[later], single.place[later], np.ones(int(later.sum()), U))
        single = single.take(np.flatnonzero(~later))
        yield from by_bucket(single, ranges + (row_hashes(single.pieces[:, reach:]) % U(ranges)).astype(np.int64))

    def by_bucket(suffixes: Suffixes, at: np.ndarray):
        order = np.argsort(at, kind="stable")
        names, starts = np.unique(at[order], return_index=True)
        for name, rows in zip(names.tolist(), np.split(order, starts[1:])):
            yield name, False, suffixes.take(rows).packed()

    return cut


def sort_bucket(table: pa.Table, length: int) -> pa.Table:
    """Marks of a range, packed by block; what is done already goes through."""
    reach = length - gram(length)
    done = table.filter(table["done"]).select(["block", "data"])
    todo = table.filter(pa.compute.invert(table["done"]))
    blocks, packed = done["block"].to_pylist(), done["data"].to_pylist()
    if todo.num_rows:
        s, sizes = Suffixes.unpacked(todo["data"].to_pylist(), reach + length)
        marks = repeats(s.doc, s.pieces[:, :reach][:, ::-1], s.pieces[:, reach:], s.n_left, s.n_right, length)
        owner = np.repeat(todo["block"].to_numpy(), sizes)
        keep = np.flatnonzero(marks)
        keep = keep[np.argsort(owner[keep], kind="stable")]
        names, starts = np.unique(owner[keep], return_index=True)
        for name, rows in zip(names.tolist(), np.split(keep, starts[1:])):
            blocks.append(name)
            packed.append(packed_marks(s.unit[rows], s.place[rows], marks[rows]))
    return pa.table({"block": pa.array(blocks, pa.int64()), "data": pa.array(packed, pa.binary())})


def sampled_leads(blocks: DataFrame, at_id: int, at_text: int, length: int, sample: int) -> np.ndarray:
    """Leading bytes of the suffixes of about `sample` texts, sorted."""
    each, k = 50, gram(length)

    def leads(batches):
        find = Anchors(length)
        for b in batches:
            for data in b.column(0).to_pylist():
                block = Block(data, at_id, at_text)
                for raw in block.raw[::1 + len(block.raw) // each]:
                    at, _ = find(raw)
                    at = at[::1 + len(at) // 200]
                    wide = np.frombuffer(raw + bytes(length), np.uint8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leads_of(wide[at[:, None] + np.arange(k)], k).tolist() if len(at) else [], pa.binary())], names=["lead"])

    apart = max(1, blocks.count() * each // sample)
    some = blocks.where(F.pmod(F.xxhash64("block"), F.lit(apart)) == 0).select("data").limit(2 * sample // each)
    return np.sort(np.array([x or b"" for x in some.mapInArrow(leads, "lead binary").toArrow()["lead"].to_pylist()], f"S{min(k, 24)}"))


# ---- removal ----------------------------------------------------------------------

REMOVAL = "struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>"


def remover(at_id: int, at_text: int, length: int, characters: bool, columns: list[str]):
    """Rows of blocks with what is left of them: rows of (data, copies, marks)."""
    def remove(batches):
        for b in batches:
            for i in range(b.num_rows):
                (row,) = b.slice(i, 1).to_pylist()
                block = Block(row["data"], at_id, at_text)
                yield from results(block, row["copies"] or [], row["marks"] or [])

    def results(block, copies, marks):
        least = {c["at"]: c["least"] for c in copies}
        unit, place, bits = unpacked_marks(marks)
        order = np.argsort(unit, kind="stable")
        bounds = np.searchsorted(unit[order], np.arange(len(block.units) + 1))
        number = {int(u): i for i, u in enumerate(block.units)}
        done: dict[tuple[int, bool], tuple] = {}
        out: list[tuple] = []
        for i, (of, doc) in enumerate(zip(block.same.tolist(), block.ids.tolist())):
            if of < 0:
                raw = (block.table.column(block.at_text)[i].as_py() or "").encode("utf-8", "surrogatepass")
                out.append((len(raw), 0, 0, raw))
                continue
            key = of, of in least and doc > least[of]
            if key not in done:
                done[key] = left(block.raw[number[of]], key[1], *[x[order[bounds[number[of]]:bounds[number[of] + 1]]] for x in (place, bits)])
            out.append(done[key])
        columns_ = [block.table.column(c).combine_chunks() for c in range(len(columns))]
        for s in range(0, len(out), 1000):
            some = list(zip(*out[s:s + 1000]))
            made = pa.StructArray.from_arrays([*[pa.array(c, pa.int64()) for c in some[:3]], pa.array(some[3], pa.binary())],
                                              names=["n_bytes", "n_removed", "n_spans", "kept"])
            yield pa.RecordBatch.from_arrays([*[c.slice(s, 1000) for c in columns_], made], names=[*columns, "removal"])

    def left(raw, whole, place, bits):
        if not whole and not len(place):
            return len(raw), 0, 0, raw
        gone = np.ones(len(raw), bool) if whole else covered(len(raw), place, bits, length)
        if characters:
            gone = within_characters(raw, gone)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        return len(raw), len(raw) - len(kept), spans, kept

    return remove


def remove_repeats(docs: DataFrame, length: int = 50, characters: bool = False, into: str | None = None, sample: int = 2000,
                   hot: int = 512, block_bytes: int = 2 << 20) -> DataFrame:
    """The rows of docs with a struct of n_bytes, n_removed, n_spans and kept (the bytes that stay),
    in a column named `into` (by default `removal`, with underscores until no column has that name).
    characters: remove whole characters only."""
    names = docs.columns
    into = into or free_name(names, "removal")
    at_id, at_text = names.index("doc_id"), names.index("text")
    inner = [f"c{i}" for i in range(len(names))]
    plain = docs.toDF(*inner)
    plain = plain.withColumn(inner[at_id], F.col(inner[at_id]).cast("long"))
    typed = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(inner, plain.schema))
    blocks = stage(plain.mapInArrow(tidy(packer(at_id, at_text, length, block_bytes)), PACKED), "repeat-blocks")
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    # tasks of bounded size, 64 at least
    buckets, ranges = max(64, total >> 25), max(64, total >> 24)
    leads = sampled_leads(blocks, at_id, at_text, length, sample)
    splitters = leads[np.arange(1, ranges) * len(leads) // ranges] if len(leads) else leads

    digests = blocks.select("block", F.inline("digests")).selectExpr(
        "block", "at", "most", "min(least) OVER (PARTITION BY high, low) AS least")
    copies = stage(digests.where("most > least").groupBy("block").agg(
        F.collect_list(F.struct("at", "least")).alias("copies")), "copies")
    whole = blocks.select("block", "data")
    answers = whole.mapInArrow(tidy(asker(at_id, at_text, length, buckets)), "bucket int, block long, n int, data binary").groupBy(
        "bucket").applyInArrow(lambda t: answer(t, hot), "block long, bucket int, shared binary, many binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "shared", "many")).alias("answers"))
    sent = whole.join(answers, "block").join(copies, "block", "left").mapInArrow(
        tidy(cutter(at_id, at_text, length, buckets, ranges, splitters)), SENT)
    marks = sent.groupBy("bucket").applyInArrow(lambda t: sort_bucket(t, length), "block long, data binary")
    marks = marks.groupBy("block").agg(F.collect_list("data").alias("marks"))
    done = whole.join(marks, "block", "left").join(copies, "block", "left").select("data", "copies", "marks").mapInArrow(
        tidy(remover(at_id, at_text, length, characters, inner)), f"{typed}, removal {REMOVAL}")
    return done.toDF(*names, into).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
