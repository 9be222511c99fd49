"""Exact top-k search by exhaustive term-at-a-time accumulation.

Components are quantised to floor(256 * x); a component's place is a term, a vector's
nonzero components are its postings.  Queries and candidates are dealt into blocks by a hash
of their id and every block of queries meets every block of candidates in one task, which
holds two blocks and one score array.  There, term by term, each query row scatters its
weight times the term's postings into a dense row of scores; the best k of the block are
selected by partition, and the blocks' winners are merged per query.

Vectors that take part: see `vectors.one_per_id`.  Vectors of different lengths meet as if
the shorter ended in zeros.  Scores are exact integers; those beyond a long, which need
components above about 10^8, are held to its range.  No queries or no candidates: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.llm.shared import bucket_count, stage
from formfold.llm.vectors import matrix, merged, one_per_id, top, width

LONG = 2 ** 63
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(rows: np.ndarray, scale: float) -> np.ndarray:
    whole = np.floor(scale * rows)
    if whole.size and np.abs(whole).max() >= 2.0 ** 62:
        return np.array([[int(x) for x in row] for row in whole], dtype=object).reshape(whole.shape)
    return whole.astype(np.int64)


def accumulator(queries: np.ndarray, candidates: np.ndarray):
    """The narrowest type that surely holds every score."""
    most = lambda m: max((abs(int(x)) for x in (m.max(), m.min())), default=0) if m.size else 0
    bound = most(queries) * most(candidates) * max(1, queries.shape[1])
    return np.int32 if bound < 2 ** 31 else np.int64 if bound < LONG else object


def search_block(queries: pa.Table, candidates: pa.Table, k: int, scale: float, rows: int = 32) -> pa.Table:
    if not len(queries) or not len(candidates):
        return FOUND.empty_table()
    dims = width(queries["embedding"], candidates["embedding"])
    ids = candidates["vec_id"].to_numpy()
    order = np.argsort(ids)
    ids, c = ids[order], quantised(matrix(candidates["embedding"], dims), scale)[order]
    query_ids, q = queries["vec_id"].to_numpy(), quantised(matrix(queries["embedding"], dims), scale)
    kind = accumulator(q, c)
    q, c = q.astype(kind), c.astype(kind)
    postings = []
    for t in range(dims):
        at = np.flatnonzero(c[:, t])
        postings.append((slice(None) if len(at) == len(ids) else at, c[at, t]))
    out: list[list[np.ndarray]] = [[], [], []]
    for start in range(0, len(q), rows):
        part = q[start:start + rows]
        scores = np.zeros((len(part), len(ids)), kind)
        for t, (at, weights) in enumerate(postings):
            for i in np.flatnonzero(part[:, t]):
                scores[i, at] += part[i, t] * weights
        for i, row in enumerate(scores):
            own = np.searchsorted(ids, query_ids[start + i])
            mine = own < len(ids) and ids[own] == query_ids[start + i]
            keep = np.delete(np.arange(len(ids)), own) if mine else np.arange(len(ids))
            best = keep[top(row[keep], ids[keep], k)]
            out[0].append(np.full(len(best), query_ids[start + i]))
            out[1].append(ids[best])
            score = row[best]
            out[2].append(score.astype(np.int64) if kind is not object else np.array(
                [max(-LONG, min(LONG - 1, x)) for x in score], np.int64))
    return pa.table([pa.array(np.concatenate(x)) for x in out], schema=FOUND)


def top_k(vectors: DataFrame, k: int, every: int, scale: float = 256.0,
          query_block: int = 4096, candidate_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other vectors for each vector whose
    id is divisible by `every`."""
    rows = stage(one_per_id(vectors), "vectors")
    is_query = F.col("vec_id") % every == 0
    n = rows.agg(F.count("*").alias("all"), F.count(F.when(is_query, 1)).alias("queries")).first()
    nq, nc = bucket_count(n.queries, query_block), bucket_count(n.all, candidate_block)
    deal = lambda blocks, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks)).cast("int")
    every_block = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = rows.where(is_query).select(
        deal(nq, 1).alias("q"), every_block(nc).alias("c"), "vec_id", "embedding")
    candidates = rows.select(every_block(nq).alias("q"), deal(nc, 2).alias("c"), "vec_id", "embedding")
    found = queries.groupBy("q", "c").cogroup(candidates.groupBy("q", "c")).applyInArrow(
        lambda left, right: search_block(left, right, k, scale), "query_id long, vec_id long, score long")
    return merged(found, k)
