"""What the vector searches share: which rows take part, and how rows become matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_id(vectors: DataFrame, zeros: bool = True) -> DataFrame:
    """(vec_id, embedding) without null ids, null vectors and null or non-finite components
    (and, if zeros is false, without zero vectors).  A vec_id names one vector: of rows that
    repeat it the smallest vector counts.  The minimum is taken before the shuffle too, so a
    repeated id is no burden."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    keep = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad))
    if not zeros:
        keep = keep.where(F.exists("embedding", lambda x: x != 0))
    return keep.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of doubles, padded with zeros to dims."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def width(*columns) -> int:
    return max((int(np.diff(c.combine_chunks().offsets.to_numpy()).max()) for c in columns if len(c)), default=0)


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; ids must ascend."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        places = np.concatenate([above, equal[:k - len(above)]])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))]


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's rows (query_id, vec_id, score), ranked from 1."""
    return found.selectExpr(
        "query_id", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank",
        "vec_id", "score").where(F.col("rank") <= k)
