"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks and shards; a node weighs what its shards weigh.  A row descends
the three levels.  At each node every child draws a waiting time -ln(u) / weight, where u
is a hash of the row's key and the child's name, and the shortest time wins.  A child's draw
depends on its own name and weight only: a change of weight inside one subtree moves rows
only into or out of that subtree, never between its unchanged siblings.  A shard that
arrives as a subtree of its own (`grown`) takes rows only into itself.

Null keys hash by the child's name alone and share one shard.  An empty table gives an
empty result.  Columns other than the key are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.llm.shared import stage


@dataclass(frozen=True)
class Tree:
    """regions -> racks -> {shard: weight}"""

    regions: tuple[tuple[dict[int, float], ...], ...]

    def shards(self) -> list[int]:
        return sorted(s for region in self.regions for rack in region for s in rack)


def even_tree(shards: int, per_rack: int = 5, racks_per_region: int = 4) -> Tree:
    racks = [{s: 1.0 for s in range(i, min(i + per_rack, shards))} for i in range(0, shards, per_rack)]
    return Tree(tuple(tuple(racks[i:i + racks_per_region]) for i in range(0, len(racks), racks_per_region)))


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, in a rack and region of its own: rows move only into it."""
    return Tree((*tree.regions, ({max(tree.shards(), default=-1) + 1: weight},)))


def levels(tree: Tree) -> list[list[list[tuple[int, str, float]]]]:
    """For each level, by parent: (own number, name, weight) of the children."""
    weigh = lambda rack: float(sum(rack.values()))
    regions = [[(i, f"region {i}", sum(map(weigh, region))) for i, region in enumerate(tree.regions)]]
    racks, shards, n = [], [], 0
    for i, region in enumerate(tree.regions):
        racks.append([(n + j, f"region {i} rack {j}", weigh(rack)) for j, rack in enumerate(region)])
        n += len(region)
        shards += [[(s, f"shard {s}", float(w)) for s, w in rack.items()] for rack in region]
    return [regions, racks, shards]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard number of a key."""
    at = F.lit(0)
    for parents in levels(tree):
        children = F.array(*[F.array(*[
            F.struct(F.lit(i).alias("id"), F.lit(name).alias("name"), F.lit(w).alias("weight"))
            for i, name, w in group if w > 0]) for group in parents])
        draws = F.transform(F.element_at(children, at + 1), lambda c: F.struct(
            (-F.log((F.shiftrightunsigned(F.xxhash64(key, c["name"]), 11) + F.lit(0.5)) / F.lit(2.0 ** 53))
             / c["weight"]).alias("time"), c["id"].alias("id")))
        at = F.array_min(draws)["id"]
    return at


def numbered(df: DataFrame, group: str, slot: str) -> DataFrame:
    """Rows with a gapless number from 0 within each group.

    Each task numbers its own rows; a table of (task, group) counts turns them into global
    numbers.  Rows are not shuffled, so a group of any size is spread over all tasks.  The
    numbered rows are staged, which makes them the same for every later reader.
    """
    names = df.columns

    def number(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            groups = b.column(names.index(group)).to_numpy(zero_copy_only=False)
            own = np.empty(len(groups), np.int64)
            order = np.argsort(groups, kind="stable")
            values, starts, sizes = np.unique(groups[order], return_index=True, return_counts=True)
            for v, s, n in zip(values.tolist(), starts, sizes):
                own[order[s:s + n]] = np.arange(n) + seen.get(v, 0)
                seen[v] = seen.get(v, 0) + int(n)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(groups), task, np.int32)), pa.array(own)],
                names=[*names, "_task", "_own"])

    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    rows = stage(df.mapInArrow(number, f"{typed}, _task int, _own long"), "numbered")
    counts = rows.groupBy("_task", group).count()
    before = counts.selectExpr("_task", group, f"sum(count) OVER (PARTITION BY {group} ORDER BY _task) - count AS _before")
    return rows.join(before, ["_task", group]).withColumn(slot, F.col("_own") + F.col("_before")).drop(
        "_task", "_own", "_before")


def shard_documents(docs: DataFrame, shards: int, tree: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    size is the UTF-8 length of the text (null: none) plus 16; a null text has the checksum
    of the empty text.  Repeated doc_ids keep one row each and share a shard.
    """
    tree = tree or even_tree(shards)
    if tree.shards() != list(range(shards)):
        raise ValueError("the tree must hold the shards 0 to shards - 1")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), grown(tree)).alias("grown_shard"))
    return numbered(rows, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
