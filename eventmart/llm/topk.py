"""Exact top-k by integer inner product, with a uniform threshold in three phases.

Vectors are cut into ``lists`` slices of dimensions; a slice's inner product is
a list of partial scores, and a score is the sum of its partial scores.

1. Every task gathers, per query and list, the rows of the k highest partial
   scores, and sends the k best whole scores among them. The k-th best score
   that any task sent is a safe cutoff: k rows reach it.
2. The cutoff goes back to the tasks. A row that reaches it has a partial score
   of cutoff / lists or more in some list; such entries suffice, and all others
   are left alone.
3. The remaining partial scores of those rows are resolved, exactly. A row's
   slices lie in one task, so this needs no join; each task sends its k best
   rows that reach the cutoff, by score and then by vec_id.

Queries are taken in blocks, so what is sent to tasks is bounded by the block,
not by the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.storage import materialize

#: Queries of a block, and cells of the score matrix a task holds at once.
QUERY_BLOCK = 4096
CELLS = 2_000_000


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and ``v``: floor(scale * x) of every component; vectors that are null or hold null or non-finite ones go."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    usable = F.coalesce(~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))), F.lit(False))
    return vectors.where(usable & F.col("vec_id").isNotNull()).select(
        "vec_id", F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix; longer ones are cut to ``width``, shorter ones filled with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    for i, (end, n) in enumerate(zip(np.cumsum(lengths), lengths)):
        out[i, : min(n, width)] = flat[end - n : end - n + min(n, width)]
    return out


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point where that is exact."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if bound < 2**53:
        return np.rint(queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _slices(width: int, lists: int) -> list[slice]:
    cuts = np.linspace(0, width, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def _parts(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


_LONG = pa.int64()
_SCORED = "query_id long, vec_id long, score long"


def _scored(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _LONG) for c in (query, vec, score)], ["query_id", "vec_id", "score"])


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best rows of each query, by score and then by smaller vec_id; of one vec_id the best row counts."""
    order = np.lexsort((-score, vec, query))
    again = np.zeros(len(order), bool)
    again[1:] = (query[order][1:] == query[order][:-1]) & (vec[order][1:] == vec[order][:-1])
    order = order[~again]
    order = order[np.lexsort((vec[order], -score[order], query[order]))]
    query = query[order]
    first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return order[place < k]


def _block_top_k(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, lists: int) -> DataFrame:
    width = queries.shape[1]
    cuts = _slices(width, lists)
    step = max(1, CELLS // len(ids))

    def partials(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        vec, rows = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width)
        return vec, [_products(queries[:, cut], rows[:, cut]) for cut in cuts], ids[:, None] == vec[None, :]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64),) * 3
        for batch in _parts(batches, step):
            vec, parts, own = partials(batch)
            whole = sum(parts)
            near = np.zeros(own.shape, bool)
            for p in parts:
                high = np.argpartition(p, -k - 1, axis=1)[:, -k - 1 :] if p.shape[1] > k + 1 else np.broadcast_to(np.arange(p.shape[1]), p.shape)
                np.put_along_axis(near, high, True, axis=1)
            q, i = np.nonzero(near & ~own)
            held = tuple(np.concatenate(x) for x in zip(held, (q, vec[i], whole[q, i])))
            keep = _best(*held, k)
            held = tuple(x[keep] for x in held)
        yield _scored(ids[held[0]], held[1], held[2])

    local = vectors.mapInArrow(gather, _SCORED).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # one vec_id counts once, or equal rows would raise the cutoff
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    kth = local.withColumn("_n", place).where(F.col("_n") <= k).groupBy("query_id").agg(F.count("*"), F.min("score"))
    known = {r[0]: r[2] for r in kth.collect() if r[1] == k}
    lowest = np.iinfo(np.int64).min // (4 * lists)
    cutoff = np.array([known.get(int(q), lowest) for q in ids], np.int64)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, step):
            vec, parts, own = partials(batch)
            enough = np.zeros(own.shape, bool)
            for p in parts:
                enough |= p * lists >= cutoff[:, None]
            q, i = np.nonzero(enough & ~own)
            score = sum(p[q, i] for p in parts)
            reach = score >= cutoff[q]
            q, vec, score = q[reach], vec[i][reach], score[reach]
            keep = _best(q, vec, score, k)
            yield _scored(ids[q[keep]], vec[keep], score[keep])

    return vectors.mapInArrow(resolve, _SCORED)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, lists: int = 2, scale: int = 1024) -> DataFrame:
    """The k rows of highest score of each query: query_id, rank (from 1), vec_id, score.

    ``vectors``: vec_id, embedding. Candidates are all rows but those with the
    query's own vec_id; ties go to the smaller vec_id. Null vectors, vectors
    with null or non-finite components and rows without a vec_id take no part.
    Components beyond a query's length count as 0. Rows that repeat a vec_id are
    one candidate, with the higher score; as a query, the one with the smaller
    vector. Fewer than k candidates are all returned; an empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    whole = materialize(quantized(vectors, scale).withColumn("vec_id", F.col("vec_id").cast("long")), "topk-vectors")
    queries = whole.where(is_query)
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    result = None
    for b in range(n_blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).groupBy("vec_id").agg(F.min("v").alias("v"))
        found = sorted((r.vec_id, r.v) for r in block.collect())
        if not found:
            continue
        width = max(len(v) for _, v in found)
        matrix = np.array([v + [0] * (width - len(v)) for _, v in found], np.int64).reshape(len(found), width)
        part = _block_top_k(whole, np.array([q for q, _ in found], np.int64), matrix, k, min(lists, max(1, width)))
        result = part if result is None else result.unionByName(part)
    if result is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    one = result.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
