"""Approximate nearest neighbours by an adaptive dimension scan.

Largest inner product becomes smallest distance: every vector gets one more coordinate that
brings its norm to the largest one, queries get a zero there.  Vectors are rotated by a
random orthogonal matrix, after which any prefix of coordinates estimates the whole
distance, and are dealt into lists by their nearest centroid.  A query probes its nearest
lists.  Within a list coordinates are read in column blocks; after each block the scaled
partial distance is tested against the distance of the query's k-th best so far, and
candidates that are surely (to `doubt`) farther are abandoned.  What survives all blocks
gets its exact score from the original vector in double precision, coordinate by coordinate.

Centroids are fitted on at most `sample` vectors, those with the smallest hash of their id;
every vector is in a list.  A list above `part` vectors is split by a hash of the id and its
queries go to each split; above `query_block` queries these are dealt into blocks by a hash,
and a task takes one block's queries of one split.  A query first searches its home, the
nearest tenth of the lists or as many as hold more than k vectors; its k-th best there is the
bound for the other probes.
So k are found where there are k.  `probed` is the share of lists a query visits.

Vectors that take part: see `vectors.one_per_id`; zero vectors do not.  Shorter vectors are
padded with zeros.  No vectors or no queries: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.llm.shared import bucket_count, stage
from formfold.llm.vectors import matrix, merged, one_per_id, top

FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def lifted(rows: np.ndarray, square: float | None, turn: np.ndarray) -> np.ndarray:
    """Rotated vectors with the extra coordinate; square: the largest squared norm (None: a query)."""
    extra = np.zeros(len(rows)) if square is None else np.sqrt(np.maximum(square - (rows ** 2).sum(1), 0))
    return np.column_stack([rows, extra]) @ turn


def nearest_order(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (centroids ** 2).sum(1) - 2 * rows @ centroids.T


def centroids_of(rows: np.ndarray, lists: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = rows[rng.permutation(len(rows))[:lists]].copy()
    for _ in range(rounds):
        at = nearest_order(rows, centers).argmin(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, at, rows)
        n = np.bincount(at, minlength=len(centers))
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


def exact(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the columns i of a and j of b, summed coordinate by coordinate:
    equal columns give equal sums."""
    out = np.zeros(len(i))
    for x, y in zip(a, b):
        out += x[i] * y[j]
    return out


def scan(query_ids, queries, bounds, ids, rows, square, turn, k, block, doubt, chunk=1024, slice_rows=256):
    """The k best of `rows` for each query as (query, vec_id, score) arrays; ids must ascend.

    Queries go in slices, so that no array has more than slice_rows * chunk pairs."""
    c, across = lifted(rows, square, turn), np.ascontiguousarray(rows.T)
    found = [scan_slice(query_ids[s:s + slice_rows], queries[s:s + slice_rows], bounds[s:s + slice_rows],
                        ids, c, across, square, turn, k, block, doubt, chunk) for s in range(0, len(query_ids), slice_rows)]
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(empty, *found))


def scan_slice(query_ids, queries, bounds, ids, c, across, square, turn, k, block, doubt, chunk):
    """c: the lifted rows; across: the rows themselves, a column each."""
    dims = turn.shape[0]
    q, down = lifted(queries, None, turn), np.ascontiguousarray(queries.T)
    base = (queries ** 2).sum(1) + square
    slack = 1e-9 * (base + square)
    bounds = bounds.copy()
    best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in query_ids]
    for start in range(0, len(ids), chunk):
        limit = base - 2 * bounds + slack
        live = np.arange(start, min(start + chunk, len(ids)))  # candidates some query still follows
        partial = np.where(ids[live] == query_ids[:, None], np.inf, 0.0)
        for d in range(0, dims, block):
            e = min(d + block, dims)
            qb, cb = q[:, d:e], c[live, d:e]
            partial += (qb ** 2).sum(1)[:, None] + (cb ** 2).sum(1) - 2 * qb @ cb.T
            test = limit * (1 + doubt / np.sqrt(e)) ** 2 if e < dims else limit
            partial[partial * (dims / e) > test[:, None]] = np.inf
            keep = np.isfinite(partial).any(0)
            live, partial = live[keep], partial[:, keep]
            if not len(live):
                break
        qi, ci = np.nonzero(np.isfinite(partial))
        ci = live[ci]
        if not len(qi):
            continue
        scores = exact(down, qi, across, ci)
        edges = np.searchsorted(qi, np.arange(len(query_ids) + 1))
        for i in np.unique(qi):
            s = np.concatenate([best[i][0], scores[edges[i]:edges[i + 1]]])
            v = np.concatenate([best[i][1], ids[ci[edges[i]:edges[i + 1]]]])
            order = np.lexsort((v, -s))[:k]
            best[i] = s[order], v[order]
            if len(order) == k:
                bounds[i] = max(bounds[i], s[order[-1]])
    return (np.concatenate([np.full(len(b[1]), i) for i, b in zip(query_ids, best)] or [np.zeros(0, np.int64)]),
            np.concatenate([b[1] for b in best] or [np.zeros(0, np.int64)]),
            np.concatenate([b[0] for b in best] or [np.zeros(0)]))


def nearest(vectors: DataFrame, k: int, every: int, probed: float = 0.7, sample: int = 16384, part: int = 4096,
            query_block: int = 16384, block: int = 16, doubt: float = 1.8, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found among all other vectors for each
    vector whose id is divisible by `every`."""
    rows = stage(one_per_id(vectors, zeros=False), "vectors")
    square_of = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    about = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dims"), F.max(square_of).alias("square"),
                     F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("queries")).first()
    dims, square = about.dims or 1, about.square or 0.0
    fitted = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample).toArrow()
    known_ids, known = fitted["vec_id"].to_numpy(), matrix(fitted["embedding"], dims)
    order = np.argsort(known_ids)
    known_ids, known = known_ids[order], known[order]
    turn = rotation(dims + 1, seed)
    lists = max(1, min(int(about.n ** 0.5), len(known_ids) // 32))
    centers = centroids_of(lifted(known, square, turn), lists, seed) if len(known_ids) else np.zeros((1, dims + 1))

    def deal(batches):
        for b in batches:
            at = nearest_order(lifted(matrix(b.column("embedding"), dims), square, turn), centers).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32))], names=[*b.schema.names, "list"])

    kind = dict(rows.dtypes)["embedding"]
    dealt = stage(rows.mapInArrow(deal, f"vec_id long, embedding {kind}, list int"), "lists")
    # one row a list: bounded by the fit, whatever the number of vectors
    sizes = np.zeros(lists, np.int64)
    for r in dealt.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    parts = np.maximum(1, -(-sizes // part))

    def probe(batches):
        # few queries at a time: each becomes a row for every split it visits
        for b in (x.slice(s, 64) for x in batches for s in range(0, x.num_rows, 64)):
            ids, q = b.column("vec_id").to_numpy(), matrix(b.column("embedding"), dims)
            close = np.argsort(nearest_order(lifted(q, None, turn), centers), axis=1, kind="stable")
            first = (np.cumsum(sizes[close], axis=1) <= k).sum(1) + 1  # lists that surely hold k others
            first = np.maximum(first, -(-lists // 10))
            take = np.minimum(np.maximum(int(np.ceil(probed * lists)), first), lists)
            i = np.repeat(np.arange(len(ids)), take)
            rank = np.arange(len(i)) - np.repeat(np.cumsum(take) - take, take)
            lst = close[i, rank]
            n = parts[lst]
            j = np.repeat(np.arange(len(i)), n)
            split = np.arange(len(j)) - np.repeat(np.cumsum(n) - n, n)
            i, lst, rank = i[j], lst[j], rank[j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lst.astype(np.int32)), pa.array(split.astype(np.int32)), pa.array(rank < first[i]),
                 pa.array(ids[i]), b.column("embedding").take(pa.array(i))],
                names=["list", "split", "first", "vec_id", "embedding"])

    blocks = bucket_count(about.queries, query_block)
    asked = dealt.where(F.col("vec_id") % every == 0).select("vec_id", "embedding").mapInArrow(
        probe, f"list int, split int, first boolean, vec_id long, embedding {kind}").withColumn(
        "block", F.pmod(F.xxhash64("vec_id", F.lit(seed + 1)), F.lit(blocks)).cast("int"))
    split_of = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("list") + 1)
    candidates = dealt.select("list", F.pmod(F.xxhash64("vec_id", F.lit(seed)), split_of).cast("int").alias("split"),
                              F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "embedding")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return FOUND.empty_table()
        right = right.sort_by("vec_id")
        found = scan(left["vec_id"].to_numpy(), matrix(left["embedding"], dims), left["bound"].to_numpy(),
                     right["vec_id"].to_numpy(), matrix(right["embedding"], dims), square, turn, k, block, doubt)
        return pa.table([pa.array(x, t) for x, t in zip(found, FOUND.types)], schema=FOUND)

    def among(queries: DataFrame) -> DataFrame:
        key = ["list", "split", "block"]
        return queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(
            search, "query_id long, vec_id long, score double")

    home = stage(among(asked.where("first").withColumn("bound", F.lit(float("-inf")))), "home")
    bounds = merged(home, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    other = asked.where("NOT first").join(bounds, "vec_id", "left").withColumn(
        "bound", F.coalesce("bound", F.lit(float("-inf"))))
    return merged(home.unionByName(among(other)), k)
