"""Near-duplicates by b-bit MinHash.

A document's set holds the 64-bit hashes of its distinct word shingles.  Of each of the
`bands * rows` minima only a few low bits are kept, packed into longs; full minima live just
long enough to name the band buckets.  Steps:

1. Documents of equal sets form a class, its smallest doc_id stands for it.
2. In each band bucket the smallest member is the hub; every member is a candidate partner
   of its hub, so a bucket of n gives n - 1 pairs.
3. Candidates are kept if the similarity that the matching bits suggest, corrected for bits
   that agree by chance, is not far below the threshold (`doubt` standard errors), and are
   then confirmed on full sets.  Links give first components.
4. Buckets whose members are still in several components are compared exhaustively in tasks
   of at most two blocks of members: first by bit counts, which leave the members that have
   a possible partner in another component, then on the full sets of these, and only pairs
   that are not connected yet.  No link between components is lost, no group emits all pairs.

A pair of similarity s shares a bucket with probability 1 - (1 - s^rows)^bands: for s = 0.8,
4 rows and 28 bands all but 4 in 10 million.  Documents
without words have an empty set and are linked with nothing; so are rows without doc_id.
Rows that repeat a doc_id count as one document in links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.llm.shared import components, stage, tidy

U = np.uint64
BITS = 4


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads their bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingles:
    """The distinct shingle hashes of a text, ascending.  A-Z count as a-z; words part at
    space, tab, line feed, vertical tab, form feed and carriage return."""

    def __init__(self, width: int, remembered: int = 250_000):
        self.width, self.remembered = width, remembered
        self.known: dict[bytes, int] = {}
        self.factors = mixed(np.arange(1, width + 1, dtype=U)) | U(1)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, U)
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], U)
        if len(h) < self.width:
            return mixed((h * self.factors[:len(h)]).sum(keepdims=True) + U(len(h)))
        n = len(h) - self.width + 1
        out = np.zeros(n, U)
        for j in range(self.width):
            out += h[j:j + n] * self.factors[j]
        return np.unique(mixed(out))


def minima(values: np.ndarray, count: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    turn, factor = (rng.integers(0, 2 ** 64, (count, 1), dtype=U) for _ in range(2))
    out = np.full(count, U(2 ** 64 - 1))
    for s in range(0, len(values), 1024):
        out = np.minimum(out, ((values[s:s + 1024] ^ turn) * (factor | U(1))).min(1))
    return out


def packed_bits(low: np.ndarray) -> np.ndarray:
    """BITS low bits of each minimum, 16 to a long."""
    low = (mixed(low) & U((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=U) * U(BITS)), axis=1).view(np.int64)


def signatures(docs: DataFrame, width: int, bands: int, rows: int, seed: int) -> DataFrame:
    """doc_id, n, digest (hash of the set), bits, keys (a bucket's name for each band)."""

    def sign(batches):
        shingles = Shingles(width)
        salt = mixed(np.arange(1, bands + 1, dtype=U))
        factors = mixed(np.arange(101, 101 + rows, dtype=U)) | U(1)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingles(text)
                m = minima(s, bands * rows, seed)
                keys = mixed((m.reshape(bands, rows) * factors).sum(1) + salt)
                for column, value in zip(out, (name, len(s), xxhash.xxh3_128_digest(s.tobytes()), packed_bits(m), keys.view(np.int64))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                 pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.list_(pa.int64()))],
                names=["doc_id", "n", "digest", "bits", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tidy(sign), "doc_id long, n long, digest binary, bits array<bigint>, keys array<bigint>")


def differing(a: Column, b: Column, longs: int) -> Column:
    """How many of the packed minima differ."""
    total = F.lit(0)
    for i in range(longs):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111))
        total = total + F.bit_count(x)
    return total


def most_differing(count: int, percent: int, doubt: float = 6.0) -> int:
    """Minima that may differ at the threshold, chance agreement and sampling error counted in."""
    share = (1 - percent / 100) * (1 - 0.5 ** BITS)
    return int(np.ceil(count * share + doubt * np.sqrt(count * share * (1 - share))))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def partners(table: pa.Table, percent: int, most: int):
    """(x, ys): for each member of a task the later ones of another component that its size and
    bits allow; of two blocks only cross pairs."""
    labels, block = table["component"].to_numpy(), table["block"].to_numpy()
    sizes = table["n"].to_numpy()
    bits = table["bits"].combine_chunks().flatten().to_numpy().reshape(len(table), -1).view(U)
    two = table["i"][0].as_py() != table["j"][0].as_py()
    for x in range(len(table)):
        y = np.arange(x + 1, len(table))
        y = y[labels[y] != labels[x]]
        if two:
            y = y[block[y] != block[x]]
        low, high = np.minimum(sizes[y], sizes[x]), np.maximum(sizes[y], sizes[x])
        y = y[100 * low >= percent * high]
        d = bits[y] ^ bits[x]
        d |= d >> U(1)
        d = (d | d >> U(2)) & U(0x1111111111111111)
        yield x, y[np.bitwise_count(d).sum(1) <= most]


def partnered(table: pa.Table, percent: int, most: int) -> pa.Table:
    """The members of a task that have a partner."""
    hit = np.zeros(len(table), bool)
    for x, y in partners(table, percent, most):
        if len(y):
            hit[x] = True
            hit[y] = True
    return table.select(["key", "rep"]).filter(pa.array(hit))


def block_links(table: pa.Table, percent: int, most: int) -> list[tuple[int, int]]:
    """Links that join components among a task's members, confirmed on full sets."""
    names, label = table["rep"].to_pylist(), table["component"].to_pylist()
    sets = [np.frombuffer(x, U) for x in table["values"].to_pylist()]
    root = {x: x for x in label}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for x, y in partners(table, percent, most):
        for k in y.tolist():
            a, b = find(label[x]), find(label[k])
            if a != b and alike(sets[x], sets[k], percent):
                root[max(a, b)] = min(a, b)
                links.append((names[x], names[k]))
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 28, rows: int = 4,
                    block: int = 512, seed: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    if bands * rows % (64 // BITS):
        raise ValueError("bands * rows must fill whole longs")
    count, longs = bands * rows, bands * rows * BITS // 64
    most = most_differing(count, percent)
    signed = stage(signatures(docs, width, bands, rows, seed), "signatures")
    part = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = part.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    # rows of equal doc_id and equal set are one
    reps = part.withColumnRenamed("doc_id", "rep").join(classes, ["digest", "rep"], "left_semi").select(
        "rep", "digest", "n", "bits", "keys").dropDuplicates(["rep", "digest"])
    reps = stage(reps, "classes")
    member = reps.select("rep", F.explode("keys").alias("key"))
    shared = member.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = stage(member.join(shared, "key"), "buckets")
    involved = members.select("rep").distinct()

    def sets_of(batches):
        shingles = Shingles(width)
        for b in batches:
            for s in range(0, b.num_rows, 500):
                p = b.slice(s, 500)
                values = [shingles(t).tobytes() for t in p.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [p.column(0), pa.array([xxhash.xxh3_128_digest(v) for v in values], pa.binary()), pa.array(values, pa.binary())],
                    names=["rep", "digest", "values"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    # the ids are a share of all documents: the join is planned alike at every size
    found = texts.join(involved.hint("merge"), "rep", "left_semi").mapInArrow(
        tidy(sets_of), "rep long, digest binary, values binary")
    sets = stage(reps.drop("keys").join(found.dropDuplicates(["rep", "digest"]), ["rep", "digest"]), "sets")

    hubs = members.where("rep <> hub").select("rep", "hub").distinct()
    a = sets.select(F.col("rep"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = sets.select(F.col("rep").alias("hub"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    close = (hubs.join(a, "rep").join(b, "hub")
             .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
             .where(differing(F.col("bits_a"), F.col("bits_b"), longs) <= most).select("rep", "hub").distinct())
    close = close.join(sets.select("rep", F.col("values").alias("values_a")), "rep").join(
        sets.select(F.col("rep").alias("hub"), F.col("values").alias("values_b")), "hub").select("rep", "hub", "values_a", "values_b")

    def confirm(batches):
        for p in batches:
            keep = [alike(np.frombuffer(x, U), np.frombuffer(y, U), percent)
                    for x, y in zip(p.column(2).to_pylist(), p.column(3).to_pylist())]
            yield p.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    links = stage(close.mapInArrow(tidy(confirm), "a long, b long"), "links")
    first = components(links)
    labelled = members.join(first.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    # of buckets with the same members one is enough
    several = (labelled.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size"),
        F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("sum")).where("least <> most")
        .groupBy("size", "sum", "least", "most").agg(F.min("key").alias("key")))
    def dealt(open_: DataFrame, *extra: str) -> DataFrame:
        """Members of buckets, once for every pair of blocks they are in."""
        placed = open_.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn(
            "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep",
            "component", "n", "bits", *extra)

    waiting = labelled.join(several.select("key", "size"), "key")
    # by their bits alone first: few members have a partner, and only these need their sets
    paired = dealt(waiting.join(sets.select("rep", "n", "bits"), "rep")).groupBy("key", "i", "j").applyInArrow(
        lambda t: partnered(t, percent, most), "key long, rep long").distinct()
    waiting = waiting.join(paired, ["key", "rep"], "left_semi").join(sets, "rep")
    more = dealt(waiting, "values").groupBy("key", "i", "j").applyInArrow(
        lambda t: pa.table(dict(zip("ab", [pa.array(c, pa.int64()) for c in zip(*block_links(t, percent, most))] or
                                    [pa.array([], pa.int64())] * 2))), "a long, b long")
    last = components(links.unionByName(stage(more, "links")))
    owner = classes.join(last.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("digest").alias("set"), F.coalesce("component", "rep").alias("component"))
    out = signed.join(owner, F.expr("digest = set AND n > 0 AND doc_id IS NOT NULL"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
