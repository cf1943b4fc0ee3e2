"""Exact top-k inner-product search by distributed histogram selection.

Every query is scored against every vector.  For each query an interval that holds its k-th best score is cut
into buckets; tasks count scores per bucket, the counts are summed, and the bucket that holds the k-th score
becomes the next interval, until it is one score wide or few scores are left at or above it.  Then the vectors at
or above the interval's lower end are kept and ranked, ties by the smaller id.

A task sends, per query, only its topmost buckets down to its own k-th score: a bucket below them cannot hold
the global k-th score, as this task alone has k scores above it.  So neither the counts nor the final rows grow
with ties, however many vectors are equal.  Queries go in blocks of about ``block`` rows, so what tasks are sent is
bounded; each block is one series of full passes.

Defined results: vectors that are null or hold null or non-finite components, and rows without an id, take no
part; a query with fewer than k candidates returns all; vectors of another dimension than the query's are no
candidates; repeated ids other than the query's are ranked each; of repeated query ids the smallest vector asks;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

BUCKETS = 256


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<long>): floor(256 x) of each component of the usable vectors."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    used = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    return used.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, rows) of a batch, 1,000 rows at a time."""
    ids = batch.column(0).to_numpy()
    lists = batch.column(1)
    n = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(n):
        rows = np.flatnonzero(n == dim)
        for k in range(0, len(rows), 1000):
            part = lists.take(pa.array(rows[k : k + 1000]))
            yield int(dim), ids[rows[k : k + 1000]], part.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _scores(queries: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    """Exact integer products: in doubles where every partial sum is below 2**53, else in 64-bit integers."""
    return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64) if exact else queries @ rows.T


def search(embeddings: DataFrame, is_query, k: int = 5, block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best for each row of ``embeddings`` for which ``is_query`` holds."""
    spark = embeddings.sparkSession
    vectors = quantised(embeddings)
    asked = stored(vectors.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = -(-asked.count() // block)
    norm = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()[0] or 0.0
    out = None
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()
        if part:
            found = _search_block(vectors, part, float(norm), k)
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def _search_block(vectors: DataFrame, asked: list, norm: float, k: int) -> DataFrame:
    ids = np.array([r[0] for r in asked], np.int64)
    dims = np.array([len(r[1]) for r in asked])
    groups = {int(d): (np.flatnonzero(dims == d), np.array([r[1] for r in asked if len(r[1]) == d], np.int64)) for d in np.unique(dims)}
    most = np.array([np.sqrt(sum(float(x) ** 2 for x in r[1]) * norm) for r in asked])
    exact = bool(most.max() < 2**52)
    bound = np.minimum(most * 1.0001 + 1, 2.0**61).astype(np.int64)
    low, high = -bound, bound + 1
    least = -(1 << 62)

    def scored(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for dim, own, rows in _matrices(batch):
            if dim in groups:
                at, q = groups[dim]
                s = _scores(q, rows, exact)
                s[ids[at][:, None] == own[None, :]] = least
                yield at, own, s

    def histogram(low: np.ndarray, width: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros((len(ids), BUCKETS + 1), np.int64)
            for batch in batches:
                for at, _, s in scored(batch):
                    # scores at or above the interval count in the last bucket
                    k_ = np.minimum(np.maximum(s - low[at][:, None], -1) // width[at][:, None], BUCKETS)
                    ok = k_ >= 0
                    key = (at[:, None] * (BUCKETS + 1) + k_)[ok]
                    n += np.bincount(key, minlength=n.size).reshape(n.shape)
            above = np.cumsum(n[:, ::-1], axis=1)[:, ::-1] - n
            q, bucket = np.nonzero((n > 0) & (above < k))
            yield pa.record_batch([pa.array(q.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(n[q, bucket])], names=["q", "bucket", "n"])

        return run

    down = Window.partitionBy("q").orderBy(F.col("bucket").desc())
    while (high - low > 1).any():
        width = np.maximum(1, -(-(high - low) // BUCKETS))
        counts = vectors.mapInArrow(histogram(low, width), "q int, bucket int, n long").groupBy("q", "bucket").agg(F.sum("n").alias("n"))
        reached = counts.withColumn("total", F.sum("n").over(down)).where("total >= %d and total - n < %d" % (k, k)).collect()  # a row a query
        if not reached:
            break
        few = True
        hit = np.zeros(len(ids), bool)
        for q, bucket, _, total in reached:
            hit[q] = True
            few &= total <= 8 * k
            if bucket < BUCKETS:
                low[q], high[q] = low[q] + bucket * width[q], low[q] + (bucket + 1) * width[q]
        low[~hit], high[~hit] = -bound[~hit], -bound[~hit] + 1  # fewer than k candidates: all are kept
        if few:
            break

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, v, s = (np.empty(0, np.int64) for _ in range(3))
        for batch in batches:
            for at, own, score in scored(batch):
                a, b = np.nonzero(score >= low[at][:, None])
                q, v, s = np.concatenate([q, at[a]]), np.concatenate([v, own[b]]), np.concatenate([s, score[a, b]])
                order = np.lexsort((v, -s, q))
                q, v, s = q[order], v[order], s[order]
                first = np.searchsorted(q, q)
                best = np.arange(len(q)) - first < k  # of this task: a worse one cannot be among the k best of all
                q, v, s = q[best], v[best], s[best]
        yield pa.record_batch([pa.array(ids[q]), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kept = vectors.mapInArrow(keep, "query_id long, vec_id long, score long")
    return kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
