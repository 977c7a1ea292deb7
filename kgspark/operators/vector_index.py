"""An approximate vector index: inverted lists of product-quantized residuals, re-ranked exactly.

Centroids and codebooks are fitted to a bounded sample; every row is then put into the
cell of its nearest centroid and coded.  The index is two tables partitioned by cell:
small codes to scan and whole vectors to re-rank, so that a search reads the folders
of the cells that it probes and, of the vectors, only what the codes leave over.

How many cells a query probes, and how far a code's score may be off, are measured on
the sample for a target recall.  No list is cut at a number of rows: what stays after
the scan is whatever may still be among the k nearest, given that error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IndexSettings:
    """cells: inverted lists (0: about the root of the number of rows, most_cells at most);
    parts: pieces that a vector is coded in, a byte each; most_sample: rows that centroids
    and codebooks are fitted to, the first in order of a hash of the id; target: share
    of the k nearest to be found; rounds: of the fit."""

    cells: int = 0
    most_cells: int = 4096
    parts: int = 16
    most_sample: int = 65_536
    target: float = 0.95
    k: int = 10
    rounds: int = 8
    seed: int = 7


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _nearest(x: np.ndarray, centers: np.ndarray, block: int = 4096) -> np.ndarray:
    """Index of the nearest center of each row, by distance."""
    half = (centers * centers).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + block] @ centers.T - half, axis=1) for i in range(0, len(x), block)] or [np.empty(0, np.int64)])


def _means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """k centers of the rows of x; a center that loses its rows takes a row anew."""
    centers = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        at = _nearest(x, centers)
        n = np.bincount(at, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, at, x)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
        centers[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return centers


@dataclass(frozen=True)
class Quantizer:
    """centroids (cells, size) and codebooks (parts, 256, size / parts); probes: cells that a
    query looks into; error: by how much a code's score may be off."""

    centroids: np.ndarray
    codebooks: np.ndarray
    probes: int
    error: float

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, code) of unit rows; sizes that the parts don't divide are padded with zeros."""
        cell = _nearest(x, self.centroids)
        rest = self._padded(x - self.centroids[cell])
        pieces = np.split(rest, len(self.codebooks), axis=1)
        return cell, np.stack([_nearest(p, book) for p, book in zip(pieces, self.codebooks)], axis=1).astype(np.uint8)

    def decode(self, cell: np.ndarray, code: np.ndarray) -> np.ndarray:
        rest = np.concatenate([book[code[:, i]] for i, book in enumerate(self.codebooks)], axis=1)
        return self.centroids[cell] + rest[:, : self.centroids.shape[1]]

    def _padded(self, x: np.ndarray) -> np.ndarray:
        size = self.codebooks.shape[0] * self.codebooks.shape[2]
        return np.pad(x, ((0, 0), (0, size - x.shape[1])))

    def probed(self, q: np.ndarray) -> np.ndarray:
        """The cells that each query looks into: those of the nearest centroids."""
        half = (self.centroids**2).sum(axis=1) / 2
        return np.argsort(-(q @ self.centroids.T - half), axis=1, kind="stable")[:, : self.probes]


def fit(sample: np.ndarray, cells: int, settings: IndexSettings) -> Quantizer:
    """Centroids, codebooks, probes and error for unit rows, measured with rows of the sample as queries."""
    rng = np.random.default_rng(settings.seed)
    centroids = _means(sample, cells, settings.rounds, rng)
    parts = max(1, min(settings.parts, sample.shape[1]))
    width = -(-sample.shape[1] // parts)
    rest = sample - centroids[_nearest(sample, centroids)]
    rest = np.pad(rest, ((0, 0), (0, parts * width - rest.shape[1])))
    books = np.stack([_means(p, 256, settings.rounds, rng) for p in np.split(rest, parts, axis=1)])
    trial = Quantizer(centroids, books, cells, 0.0)
    cell, code = trial.encode(sample)
    asked = rng.choice(len(sample), min(256, len(sample)), replace=False)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -2.0
    k = max(1, min(settings.k, len(sample) - 1))
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    # how many cells are nearer to the query than that of each of its neighbours
    order = np.argsort(trial.probed(sample[asked]), axis=1)
    place = np.take_along_axis(order, cell[best], axis=1)
    share = 1 - (1 - settings.target) / 2  # half of the loss is for cells, half for codes
    probes = min(cells, int(np.quantile(place, share, method="higher")) + 1)
    off = np.abs((sample[asked] @ trial.decode(cell, code).T)[np.arange(len(asked))[:, None], best] - scores[np.arange(len(asked))[:, None], best])
    return Quantizer(centroids, books, probes, float(np.quantile(off, share, method="higher")))


_MODEL = "kind string, place int, values array<double>"


@dataclass(frozen=True)
class VectorIndex:
    """An index in a folder that the driver and all executors share."""

    spark: SparkSession
    path: str
    quantizer: Quantizer

    @classmethod
    def build(cls, vectors: DataFrame, path: str, settings: IndexSettings = IndexSettings()) -> VectorIndex:
        """Fit to a sample of vectors (id, embedding) and index every row of them.

        Rows without an embedding have no place in it.  Ids that repeat are rows of their own.
        """
        spark = vectors.sparkSession
        some = vectors.where("embedding IS NOT NULL").select("id", "embedding")
        n = some.count()
        if not n:
            raise ValueError("no vectors to index")
        sample = some.orderBy(F.xxhash64("id"), "id").limit(settings.most_sample).select("embedding")
        x = _unit(np.stack([np.asarray(r[0], np.float64) for r in sample.collect()]))
        cells = settings.cells or max(1, min(settings.most_cells, round(n**0.5), len(x)))
        index = cls(spark, path.rstrip("/"), fit(x, cells, settings))
        q = index.quantizer
        rows = [("centroid", i, v.tolist()) for i, v in enumerate(q.centroids)] + [("book", i, b.ravel().tolist()) for i, b in enumerate(q.codebooks)]
        spark.createDataFrame([*rows, ("found", 0, [float(q.probes), q.error])], _MODEL).coalesce(1).write.mode("overwrite").parquet(f"{index.path}/model")
        index._write(some, "overwrite")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        held: dict[str, list] = {}
        for r in spark.read.parquet(f"{path.rstrip('/')}/model").orderBy("kind", "place").collect():
            held.setdefault(r["kind"], []).append(np.array(r["values"]))
        centroids, probes = np.stack(held["centroid"]), held["found"][0]
        books = np.stack(held["book"]).reshape(len(held["book"]), 256, -1)
        return cls(spark, path.rstrip("/"), Quantizer(centroids, books, int(probes[0]), float(probes[1])))

    def add(self, vectors: DataFrame) -> None:
        """Index more rows (id, embedding) under the same centroids."""
        self._write(vectors.where("embedding IS NOT NULL").select("id", "embedding"), "append")

    def _write(self, rows: DataFrame, mode: str) -> None:
        sent = self.spark.sparkContext.broadcast(self.quantizer)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    x = _unit(np.stack(batch.column(1).to_numpy(zero_copy_only=False)))
                    cell, code = sent.value.encode(x)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary())], names=["id", "embedding", "cell", "code"])

        kind, value = rows.schema["id"].dataType.simpleString(), rows.schema["embedding"].dataType.simpleString()
        coded = rows.mapInArrow(run, f"id {kind}, embedding {value}, cell int, code binary")
        # a cell's rows meet in few files; salted, so that a large cell is no single task
        dealt = coded.repartition("cell", F.expr("pmod(xxhash64(id), 4)")).sortWithinPartitions("cell", "id")
        dealt.write.mode(mode).partitionBy("cell").parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        """(id, embedding, code, cell) of every row; `cell` is the partition column, and columns not asked for are not read."""
        return self.spark.read.parquet(f"{self.path}/rows")

    def search(self, queries: DataFrame, k: int, block: int = 4096) -> DataFrame:
        """(query, id, score, rank) of the k nearest rows of each query (query, embedding), by cosine, as vector.top_k gives them.

        Queries go out in blocks of at most `block`.  Each reads the probed cells only;
        each task keeps what may be among its k best.
        """
        n, found = queries.count(), None
        blocks = max(1, -(-n // block))
        for b in range(blocks):
            part = queries.where(F.expr(f"pmod(xxhash64(query), {blocks}) = {b}")).select("query", "embedding")
            one = self._search(part, k)
            found = one if found is None else found if one is None else found.unionByName(one)
        if found is None:
            kinds = {c: s.schema[c].dataType.simpleString() for c, s in (("query", queries), ("id", self.rows()))}
            return self.spark.createDataFrame([], f"query {kinds['query']}, id {kinds['id']}, score double, rank int")
        return found

    def candidates(self, queries: DataFrame, k: int) -> DataFrame | None:
        """(query, id, cell, near) of the rows that may be among the k nearest; near: the code's score.  None without queries."""
        held = [(r[0], np.asarray(r[1], np.float64)) for r in queries.collect()]
        if not held:
            return None
        ids, q = [h[0] for h in held], _unit(np.stack([h[1] for h in held]))
        probed = self.quantizer.probed(q)
        asks = {int(c): np.flatnonzero((probed == c).any(axis=1)) for c in np.unique(probed)}
        sent, slack = self.spark.sparkContext.broadcast((q, asks, self.quantizer)), 2 * self.quantizer.error

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q, asks, quantizer = sent.value
            kth = np.full(len(q), -np.inf)  # the k-th best score so far: what lies below it by more than the slack is out
            top = np.full((len(q), k), -np.inf)
            held = []
            for batch in batches:
                cells, codes = batch.column(2).to_numpy(), batch.column(1)
                for c in np.unique(cells):
                    at = np.flatnonzero(cells == c)
                    code = np.frombuffer(b"".join(codes.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)
                    mine = asks[int(c)]
                    score = q[mine] @ quantizer.decode(np.full(len(at), c), code).T
                    top[mine] = -np.sort(-np.concatenate([top[mine], score], axis=1), axis=1)[:, :k]
                    kth[mine] = top[mine, -1]
                    who, which = np.nonzero(score >= kth[mine, None] - slack)
                    held.append((mine[who], score[who, which], batch.column(0).take(pa.array(at[which])), np.full(len(who), c, np.int32)))
            for who, score, id_, cell in held:
                stay = np.flatnonzero(score >= kth[who] - slack)
                yield pa.RecordBatch.from_arrays([pa.array(who[stay], pa.int32()), id_.take(pa.array(stay)), pa.array(cell[stay]), pa.array(score[stay])], names=["at", "id", "cell", "near"])

        rows = self.rows().where(F.col("cell").isin(sorted(asks))).select("id", "code", "cell")
        kind = rows.schema["id"].dataType.simpleString()
        scanned = rows.mapInArrow(run, f"at int, id {kind}, cell int, near double")
        best = Window.partitionBy("at")
        scanned = scanned.withColumn("_r", F.row_number().over(best.orderBy(F.desc("near"), "id")))
        kept = scanned.withColumn("_k", F.min(F.when(F.col("_r") <= k, F.col("near"))).over(best)).where(F.col("near") >= F.col("_k") - slack)
        names = self.spark.createDataFrame(list(enumerate(ids)), f"at int, query {queries.schema['query'].dataType.simpleString()}")
        return kept.join(F.broadcast(names), "at").select("query", "id", "cell", "near")

    def _search(self, queries: DataFrame, k: int) -> DataFrame | None:
        near = self.candidates(queries, k)
        if near is None:
            return None
        asked = F.broadcast(queries.select("query", F.col("embedding").alias("_q")))
        # an id that repeats is in the candidates as often as among the rows
        whole = self.rows().select("id", "cell", F.col("embedding").alias("_x"))
        joined = near.select("query", "id", "cell").distinct().join(whole, ["cell", "id"]).join(asked, "query")
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
        size = F.sqrt(dot("_q", "_q")) * F.sqrt(dot("_x", "_x"))
        scored = joined.select("query", "id", F.round(dot("_q", "_x") / F.greatest(size, F.lit(1e-12)), 6).alias("score"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
        return scored.withColumn("rank", rank).where(F.col("rank") <= k)
