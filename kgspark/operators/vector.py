"""Vector top-k by cosine: a stated query set against all rows, a block of queries at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: scores that a task holds at once
_SCORES = 1 << 20


def _first_k(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the k greatest scores, ties to the smaller id, with their ids, in that order."""
    n, width = score.shape
    if width > k:
        # below the k-th greatest score of its row nothing counts
        bar = -np.partition(-score, k - 1, axis=1)[:, k - 1]
        row, col = np.nonzero(score >= bar[:, None])
    else:
        row, col = (x.ravel() for x in np.indices((n, width)))
    order = np.lexsort((ids[row, col], -score[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, col, place = row[place < k], col[place < k], place[place < k]
    shape = (n, min(k, width))
    out_id, out = np.zeros(shape, dtype=np.int64), np.full(shape, -np.inf)
    out_id[row, place], out[row, place] = ids[row, col], score[row, col]
    return out_id, out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """(query, id, score, rank) of the k nearest vectors (id, embedding) of each query (query, embedding).

    Queries go out in blocks of at most `block`; each task keeps the k best of
    each query, so at most k rows a query and task are shuffled, and holds no more
    scores at once than _SCORES and one for each query.
    """
    spark, parts, start = vectors.sparkSession, [], None
    n = queries.count()
    for b in range(max(1, -(-n // block))):
        part = queries.where(F.expr(f"pmod(xxhash64(query), {max(1, -(-n // block))}) = {b}"))
        held = [(r[0], np.asarray(r[1], dtype=np.float64)) for r in part.select("query", "embedding").collect()]
        if not held:
            continue
        ids, matrix = np.array([h[0] for h in held]), np.stack([h[1] for h in held])
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
        sent = spark.sparkContext.broadcast((ids, matrix))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, matrix = sent.value
            best_id, best = np.empty((len(ids), 0), dtype=np.int64), np.empty((len(ids), 0))
            # so many rows at a time that their scores stay few
            step = max(1, _SCORES // len(ids))
            for batch in batches:
                for i in range(0, batch.num_rows, step):
                    part = batch.slice(i, step)
                    x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, -1)
                    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                    score = np.hstack([best, np.round(matrix @ x.T, 6)])
                    of = np.hstack([best_id, np.broadcast_to(part.column(0).to_numpy(zero_copy_only=False), (len(ids), part.num_rows))])
                    best_id, best = _first_k(of, score, k)
            if best.size:
                held = best > -np.inf
                where = np.nonzero(held)[0]
                yield pa.RecordBatch.from_arrays([pa.array(ids[where]), pa.array(best_id[held]), pa.array(best[held])], names=["query", "id", "score"])

        parts.append(vectors.select(F.col("id").cast("long"), "embedding").mapInArrow(run, "query long, id long, score double"))
    if not parts:
        return spark.createDataFrame([], "query long, id long, score double, rank int")
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)
