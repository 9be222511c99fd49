"""A Merkle manifest of a dataset as a postorder append log, with a proof for every row.

Every row is a leaf.  The leaves of a source, in order, are the base of a tree in which runs of
16 nodes become one; the roots of the sources, in order, are the base of one more tree.  An
aligned builder takes 16**3 neighbours of a base and appends each node to its segment of the log
when its last leaf is there, so that a segment is in postorder.  The roots of the segments are
the base of the next stratum, and so on: a tree of n leaves has log(n)/log(4096) strata, and no
task ever sees more than 4096 nodes of a base, whatever the size of a source.

Where a node stands in the log follows from the sizes of the subtrees before it (`position`), so
siblings are addressed, never searched.  Proofs are extracted from the top: a segment hands each
node of its base the siblings on its way up, after those it got itself.

Nulls in any column: the field is `-`; a null source is a source of its own, before the others.
Empty texts are `0:`.  Rows of equal doc_id (null first) stand in the order of their leaf digests,
equal rows beside each other, one leaf each.  An empty table has no leaf, and no row comes back.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.llm.shared import stage

RUN, HEIGHT = 16, 3
SEGMENT = RUN ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values: dict[str, Column]) -> Column:
    """The digest of a row: each field with its length before it."""
    parts = []
    for name in FIELDS:
        value = values[name].cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def height_of(base: int) -> int:
    """Levels above a base of so many nodes."""
    levels = 0
    while base > 1:
        base, levels = -(-base // RUN), levels + 1
    return levels


def position(level: int, index: int, base: int, height: int) -> int:
    """Where a node is in the log of a tree of `base` leaves: after the nodes that end before
    its last leaf, and after those of its own subtree that end with it."""
    last = min((index + 1) * RUN ** level, base) - 1
    return sum(last // RUN ** j for j in range(height + 1)) + level


def appended(leaves: list[str], height: int) -> list[str]:
    """The nodes above and including the leaves in completion order."""
    log, levels = [], [[] for _ in range(height + 1)]
    for end, one in enumerate(leaves, 1):
        levels[0].append(one)
        log.append(one)
        for level in range(1, height + 1):
            if end % RUN ** level and end < len(leaves):
                break
            below = levels[level - 1]
            node = digest(below[RUN * len(levels[level]):])
            levels[level].append(node)
            log.append(node)
    return log


def path_of(index: int, data: bytes, base: int, height: int) -> bytes:
    """Of each level on the way up: the place in the run, the number of siblings, the siblings."""
    out = []
    for level in range(height):
        at, count = index // RUN ** level, -(-base // RUN ** level)
        first = at - at % RUN
        near = [i for i in range(first, min(first + RUN, count)) if i != at]
        out.append(bytes([at % RUN, len(near)]))
        for i in near:
            p = 32 * position(level, i, base, height)
            out.append(data[p:p + 32])
    return b"".join(out)


def siblings(path: bytes):
    """(place, siblings as hex) level by level."""
    at = 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        text = path[at + 2:at + 2 + 32 * n].hex()
        yield place, [text[i:i + 64] for i in range(0, len(text), 64)]
        at += 2 + 32 * n


def folded(one: str, path: bytes) -> str:
    """The root that a leaf and its siblings give."""
    for place, near in siblings(path):
        one = digest([*near[:place], one, *near[place:]])
    return one


def proof_digest(path: bytes) -> str:
    return digest(x for _, near in siblings(path) for x in near)


# ---- order ------------------------------------------------------------------------

def in_order(df: DataFrame, by: list, name: str) -> DataFrame:
    """The rows range-sorted, with _at: ascending, and gapless within a partition (_at >> 33)."""
    return stage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "_at", F.monotonically_increasing_id()), name)


def ranked(df: DataFrame, by: list, name: str) -> DataFrame:
    """The rows with _rank, gapless from 0 in the order of `by`."""
    rows = in_order(df, by, name).withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    parts = parts.selectExpr("_part", "sum(_n) OVER (ORDER BY _part) - _n - _first AS _shift")  # a row a partition
    return rows.join(parts, "_part").withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def placed_leaves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, total, rank, doc_id, leaf, tampered) of every row, and (tree, source, total) of
    every source; tampered is the leaf of the altered row, null where nothing is altered."""
    own = {n: docs[n] for n in FIELDS}
    lower = F.translate(own["text"], string.ascii_uppercase, string.ascii_lowercase)
    altered = F.crc32(own["doc_id"].cast("string").cast("binary")) % 5 == 0
    rows = stage(docs.select(
        own["doc_id"].alias("doc_id"), own["source"].alias("source"), leaf(own).alias("leaf"),
        F.when(altered, leaf({**own, "text": lower})).alias("tampered"), F.monotonically_increasing_id().alias("_row")), "leaves")
    # _row parts equal rows, so that a row that is there a million times is no hot range
    rows = in_order(rows, ["source", "doc_id", "leaf", "_row"], "leaves-in-order").withColumn("_part", F.shiftright("_at", 33))
    rows = rows.withColumn("_named", F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("-")))
    runs = rows.groupBy("_named", "_part").agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("_n"),
                                               F.min("_at").alias("_first"))
    sources = ranked(runs.groupBy("_named").agg(F.first("source").alias("source"), F.sum("_n").alias("total")),
                     ["source"], "sources").withColumnRenamed("_rank", "tree")
    sources = stage(sources, "sources-in-order")
    shifts = runs.selectExpr("_named", "_part", "sum(_n) OVER (PARTITION BY _named ORDER BY _part) - _n - _first AS _shift")
    shifts = shifts.join(sources.select("_named", "tree", "total"), "_named")
    leaves = rows.join(shifts, ["_named", "_part"]).select(
        "tree", "total", (F.col("_at") + F.col("_shift")).alias("rank"), "doc_id", "leaf", "tampered")
    return leaves, sources.select("tree", "source", "total")


# ---- log --------------------------------------------------------------------------

SEGMENTS = "tree long, part long, total long, base int, height int, root string, data binary"


def build_segment(table: pa.Table) -> pa.Table:
    table = table.sort_by("rank")
    total = table["total"][0].as_py()
    height = min(HEIGHT, height_of(total))
    log = appended(table["digest"].to_pylist(), height)
    return pa.table({
        "tree": table["tree"][:1], "part": table["part"][:1], "total": table["total"][:1],
        "base": pa.array([table.num_rows], pa.int32()), "height": pa.array([height], pa.int32()),
        "root": pa.array([log[-1]]), "data": pa.array([bytes.fromhex("".join(log))], pa.binary())})


def segment_of(rank) -> Column:
    return F.floor(F.col(rank) / F.lit(SEGMENT)).cast("long")


def append_strata(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The segments of all strata above (tree, total, rank, digest); most: the largest total."""
    strata = []
    while True:
        made = nodes.select("tree", "total", "rank", "digest", segment_of("rank").alias("part")).groupBy(
            "tree", "part").applyInArrow(build_segment, SEGMENTS)
        strata.append(stage(made, f"{name}-{len(strata)}"))
        if most <= SEGMENT:
            return strata
        most = -(-most // SEGMENT)
        nodes = strata[-1].where(F.col("total") > SEGMENT).select(
            "tree", F.ceil(F.col("total") / F.lit(SEGMENT)).cast("long").alias("total"),
            F.col("part").alias("rank"), F.col("root").alias("digest"))


def roots(strata: list[DataFrame]) -> DataFrame:
    """(tree, root): each tree ends in the stratum where it is one segment."""
    last = [s.where(F.col("total") <= SEGMENT).select("tree", "root") for s in strata]
    out = last[0]
    for one in last[1:]:
        out = out.unionAll(one)
    return out


def positions(strata: list[DataFrame], sizes: DataFrame) -> DataFrame:
    """(tree, level, index, position, digest): the log a node a row, for readers of the log;
    sizes: (tree, total) of the leaves."""
    def nodes(batches, below):
        for b in batches:
            for row in b.to_pylist():
                out = {k: [] for k in ("tree", "level", "index", "position", "digest")}
                high = height_of(row["leaves"])
                for level in range(row["height"] + 1):
                    for i in range(-(-row["base"] // RUN ** level)):
                        if below and not level:
                            continue  # the root of a segment below
                        p = 32 * position(level, i, row["base"], row["height"])
                        at = row["part"] * RUN ** (HEIGHT - level) + i
                        for k, v in zip(out, (row["tree"], level + below, at, position(level + below, at, row["leaves"], high),
                                              row["data"][p:p + 32].hex())):
                            out[k].append(v)
                yield pa.RecordBatch.from_pydict(out)

    def one(segments, below):
        return segments.join(sizes.select("tree", F.col("total").alias("leaves")), "tree").mapInArrow(
            lambda batches: nodes(batches, below), "tree long, level long, index long, position long, digest string")

    out = one(strata[0], 0)
    for i, s in enumerate(strata[1:], 1):
        out = out.unionAll(one(s, i * HEIGHT))
    return out


# ---- proofs -----------------------------------------------------------------------

def handed_down(batches):
    """Of each segment: the path of every node of its base."""
    for b in batches:
        for row in b.to_pylist():
            n = row["base"]
            yield pa.RecordBatch.from_pydict({
                "tree": [row["tree"]] * n, "part": [row["part"] * SEGMENT + i for i in range(n)],
                "subroot": pa.array([row["subroot"]] * n, pa.string()),
                "path": [path_of(i, row["data"], n, row["height"]) + row["path"] for i in range(n)]})


PATHS = "tree long, part long, subroot string, path binary"


def with_paths(strata: list[DataFrame], topped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The segments of the lowest stratum with the path above them; topped gives the last
    segments of their trees subroot and path."""
    below = None
    for i, segments in reversed(list(enumerate(strata))):
        rows = topped(segments.where(F.col("total") <= SEGMENT))
        if below is not None:
            rows = rows.unionByName(segments.where(F.col("total") > SEGMENT).join(below, ["tree", "part"]))
        if i == 0:
            return rows
        below = stage(rows.mapInArrow(handed_down, PATHS), "paths")
    raise ValueError("a manifest has at least one stratum")


def prove(key, leaves: pa.Table, segments: pa.Table, root: str) -> pa.Table:
    row = segments.to_pylist()[0]
    out = {k: [] for k in ("proof_sha256", "folded_root")}
    for rank, one, tampered in zip(*(leaves[c].to_pylist() for c in ("rank", "leaf", "tampered"))):
        path = path_of(rank - row["part"] * SEGMENT, row["data"], row["base"], row["height"]) + row["path"]
        out["proof_sha256"].append(proof_digest(path))
        out["folded_root"].append(folded(tampered or one, path))
    n = leaves.num_rows
    return pa.table({
        "doc_id": leaves["doc_id"], "leaf": leaves["leaf"], "subroot": pa.array([row["subroot"]] * n, pa.string()),
        "root": pa.array([root] * n, pa.string()), "proof_sha256": pa.array(out["proof_sha256"], pa.string()),
        "folded_root": pa.array(out["folded_root"], pa.string()),
        "verified": pa.array([x == root for x in out["folded_root"]], pa.bool_()),
        "rank": leaves["rank"], "tree": leaves["tree"]})


class Manifest:
    """The log of a table: strata of every source's tree (`strata`) and of the tree above them
    (`upper`), the leaves in order, the sources, and the root (None for an empty table)."""

    def __init__(self, docs: DataFrame):
        self.leaves, self.sources = placed_leaves(docs)
        sizes = self.sources.agg(F.max("total"), F.count(F.lit(1))).first()
        self.doc_id, self.root = docs.schema["doc_id"].dataType.simpleString(), None
        if not sizes[1]:
            return
        self.strata = append_strata(self.leaves.withColumnRenamed("leaf", "digest"), sizes[0], "log")
        self.subroots = roots(self.strata)
        tops = self.subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(sizes[1]).cast("long").alias("total"),
                                    F.col("tree").alias("rank"), F.col("root").alias("digest"))
        self.upper = append_strata(tops, sizes[1], "upper-log")
        self.root = roots(self.upper).first()["root"]

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, rank, tree."""
        schema = (f"doc_id {self.doc_id}, leaf string, subroot string, root string, proof_sha256 string, "
                  "folded_root string, verified boolean, rank long, tree long")
        if self.root is None:
            return self.leaves.sparkSession.createDataFrame([], schema)
        root = self.root
        upper = with_paths(self.upper, lambda rows: rows.withColumns({"subroot": F.lit(root), "path": F.lit(b"")}))
        above = upper.mapInArrow(handed_down, PATHS).select(F.col("part").alias("tree"), "path")
        tops = self.subroots.withColumnRenamed("root", "subroot").join(above, "tree")
        segments = with_paths(self.strata, lambda rows: rows.join(tops, "tree"))
        leaves = self.leaves.withColumn("part", segment_of("rank"))
        return leaves.groupBy("tree", "part").cogroup(segments.groupBy("tree", "part")).applyInArrow(
            lambda key, left, right: prove(key, left, right, root), schema)
