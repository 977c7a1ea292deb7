"""Quality scores by Bradley-Terry pairwise ranking.

Each labelled pair (better, worse) says that one document's score exceeds the
other's; scores are linear in the documents' features, and the weights minimise
the logistic loss of feature differences.  A quantile of the training scores
becomes the decision threshold, and a logistic curve through it turns scores
into numbers from 0 to 1.

All labelled rows are learnt from.  They lie in blocks, pairs are drawn inside a
block, and whatever the fit needs is a sum over the blocks: means, spreads, slopes
and curvatures of each of Newton's steps, and the histogram that gives the quantile.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.llm import text as tx
from kgspark.llm.shared import drop_table, materialize

#: characters that are counted one by one; upper case, digits, line ends and the rest count as groups
_SINGLE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASS = np.full(256, 4, dtype=np.int64)
_CLASS[65:91] = 0
_CLASS[48:58] = 1
_CLASS[10] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[128:] = 5
for _i, _c in enumerate(_SINGLE):
    _CLASS[_c] = 6 + _i
_CLASSES = 6 + len(_SINGLE)
N_FEATURES = 2 * _CLASSES + 12


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of features for each text: shares of character classes (plain and as
    square roots), lengths, repeated words, windows and lines."""
    n, size = len(off) - 1, np.diff(off)
    row = np.repeat(np.arange(n), size)
    count = np.bincount(row * _CLASSES + _CLASS[buf], minlength=n * _CLASSES).reshape(n, _CLASSES)
    share = count / np.maximum(size, 1)[:, None]
    w = tx.words(buf, off)
    words = np.diff(w.ptr)
    one = np.maximum(words, 1)
    length = (w.end - w.start).astype(np.float64)
    owner = np.repeat(np.arange(n), words)
    mean = np.bincount(owner, length, n) / one
    square = np.bincount(owner, length * length, n) / one

    def repeated(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, of))
        k, o = keys[order], of[order]
        again = np.zeros(len(k), bool)
        again[1:] = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
        return np.bincount(o[again], minlength=n) / np.maximum(np.bincount(of, minlength=n), 1)

    inside = np.arange(len(w.hash)) + 3 <= w.ptr[owner + 1] if len(owner) else np.empty(0, bool)
    cut = np.unique(np.concatenate((np.flatnonzero(buf == 10) + 1, off)))
    line = tx.sequences(tx.words(buf, cut)) if len(cut) > 1 else np.empty(0, np.uint64)
    line_owner = np.searchsorted(off, cut[:-1], "right") - 1
    with_word = line != 0
    per_line = words / np.maximum(np.bincount(line_owner, minlength=n), 1)
    first_upper = np.zeros(len(w.start))
    if len(w.start):
        first_upper = (_CLASS[buf[w.start]] == 0).astype(np.float64)
    more = [
        np.log1p(words), np.log1p(words) ** 2 / 10, mean, np.sqrt(np.maximum(square - mean * mean, 0)), repeated(w.hash, owner), repeated(tx.ngrams(w, 3)[inside], owner[inside]),
        repeated(line[with_word], line_owner[with_word]), np.log1p(per_line), np.bincount(owner, first_upper, n) / one, np.bincount(owner, length > 20, n) / one, (words < 10).astype(float), (words < 50).astype(float),
    ]
    return np.hstack([share, np.sqrt(share), np.stack(more, 1)]).astype(np.float32)


@dataclass(frozen=True)
class Ranking:
    """block_rows: labelled rows in a block, about; pairs: preference pairs drawn from all
    blocks, more where that is less than two a row; ridge: weight of the squared norm;
    threshold: score at and above which a document is good."""

    block_rows: int = 20_000
    pairs: int = 200_000
    ridge: float = 1e-3
    threshold: float = 0.7
    seed: int = 5


@dataclass(frozen=True)
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    spread: float
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the quantile that the fit chose scores exactly `threshold`."""
        z = (self.raw(x) - self.cut) / self.spread + np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: pairs whose differences are held at once
_PAIRS = 1 << 15
#: bins of the histogram of training scores
_BINS = 1 << 16


def _block(table: pa.Table) -> pa.Table:
    """A block's rows (bucket, h, doc_id, quality, x) as one row (bucket, x, good)."""
    table = table.sort_by([("h", "ascending"), ("doc_id", "ascending"), ("quality", "ascending")])
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("x").chunks])
    good = table.column("quality").to_numpy() == 1
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "x": pa.array([x.astype(np.float32).tobytes()], pa.binary()), "good": pa.array([good.tobytes()], pa.binary())})


def _summed(blocks: DataFrame, size: int, of) -> np.ndarray:
    """The sum of the `size` numbers of(bucket, x, good) over all blocks; a task sends one row."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for bucket, x, good in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                total += of(bucket, np.frombuffer(x, np.float32).reshape(-1, N_FEATURES).astype(np.float64), np.frombuffer(good, bool))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

    return np.sum([np.zeros(size), *[r["s"] for r in blocks.select("bucket", "x", "good").mapInArrow(run, "s array<double>").collect()]], axis=0)


def fit(blocks: DataFrame, how: Ranking = Ranking()) -> Scorer:
    """Weights from preference pairs of blocks (bucket, x, good) by Newton's method; without pairs all weights are 0."""
    d = N_FEATURES
    first = _summed(blocks, d + 3, lambda _, x, good: np.concatenate((x.sum(0), [len(x), good.sum(), 1])))
    n, n_good, n_blocks = first[d], first[d + 1], first[d + 2]
    if not n:
        return Scorer(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 1.0, how.threshold)
    mean = first[:d] / n
    scale = np.maximum(np.sqrt(_summed(blocks, d, lambda _, x, good: ((x - mean) ** 2).sum(0)) / n), 1e-4)
    shifted = lambda x: np.clip((x - mean) / scale, -8, 8)
    weight = np.zeros(d)

    def newton(bucket: int, x: np.ndarray, good: np.ndarray) -> np.ndarray:
        z, rng, out = shifted(x), np.random.default_rng((how.seed, bucket)), np.zeros(d + d * d + 1)
        better, worse = np.flatnonzero(good), np.flatnonzero(~good)
        if not len(better) or not len(worse):
            return out
        # in turn, so that every row is in a pair
        pairs = max(int(how.pairs / n_blocks), 2 * len(x))
        left, right = (rng.permutation(np.resize(rng.permutation(side), pairs)) for side in (better, worse))
        for i in range(0, pairs, _PAIRS):
            diff = z[left[i : i + _PAIRS]] - z[right[i : i + _PAIRS]]
            p = 1 / (1 + np.exp(-np.clip(diff @ weight, -30, 30)))
            out[:d] += diff.T @ (p - 1)
            out[d:-1] += ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()
        out[-1] = pairs
        return out

    for _ in range(25):
        told = _summed(blocks, d + d * d + 1, newton)
        if not told[-1]:
            break
        step = np.linalg.solve(told[d:-1].reshape(d, d) / told[-1] + how.ridge * np.eye(d), told[:d] / told[-1] + how.ridge * weight)
        weight = weight - step
        if np.abs(step).max() < 1e-6:
            break
    low, high, middle, spread = _range(blocks, lambda x: shifted(x) @ weight)
    if high <= low:
        return Scorer(mean, scale, weight, low, 1.0, how.threshold)
    counts = _histogram(blocks, lambda x: shifted(x) @ weight, low, high)
    # of the quantiles near the share of bad documents, the one that separates best; counts below each edge are of all rows
    below = np.vstack((np.zeros(2), counts.cumsum(0)))
    levels = np.clip(1 - n_good / n + np.linspace(-0.05, 0.1, 31), 0, 1)
    edges = np.unique(np.minimum(np.searchsorted(below.sum(1), levels * n), _BINS))
    balance = (n_good - below[edges, 1]) / max(1, n_good) + below[edges, 0] / max(1, n - n_good)
    cut = low + (high - low) / _BINS * edges[int(np.argmax(balance))]
    return Scorer(mean, scale, weight, float(cut), float(max(spread, 1e-6)), how.threshold)


def _range(blocks: DataFrame, raw) -> tuple[float, float, float, float]:
    """(least, greatest, mean, standard deviation) of raw(x) over all rows."""

    def run(batches):
        for batch in batches:
            for x in batch.column(0).to_pylist():
                r = raw(np.frombuffer(x, np.float32).reshape(-1, N_FEATURES).astype(np.float64))
                yield pa.RecordBatch.from_pydict({"n": [len(r)], "low": [r.min()], "high": [r.max()], "mean": [r.mean()], "square": [((r - r.mean()) ** 2).sum()]})

    # Chan's formula adds up squares around the blocks' own means
    each = blocks.select("x").mapInArrow(run, "n long, low double, high double, mean double, square double")
    n, m = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    one = each.agg(F.min("low"), F.max("high"), m, F.sum("square") / n, F.sum(F.col("n") * F.col("mean") * F.col("mean")) / n).first()
    return one[0], one[1], one[2], float(np.sqrt(max(0.0, one[3] + one[4] - one[2] ** 2)))


def _histogram(blocks: DataFrame, raw, low: float, high: float) -> np.ndarray:
    """Rows with raw(x) in each bin from low to high: (bad, good)."""

    def run(batches):
        total = np.zeros((_BINS, 2), np.int64)
        for batch in batches:
            for x, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                r = raw(np.frombuffer(x, np.float32).reshape(-1, N_FEATURES).astype(np.float64))
                at = np.clip(((r - low) / (high - low) * _BINS).astype(np.int64), 0, _BINS - 1)
                total += np.bincount(2 * at + np.frombuffer(good, bool), minlength=2 * _BINS).reshape(-1, 2)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_pydict({"bin": some, "bad": total[some, 0], "good": total[some, 1]})

    out = np.zeros((_BINS, 2))
    for r in blocks.select("x", "good").mapInArrow(run, "bin long, bad long, good long").groupBy("bin").agg(F.sum("bad"), F.sum("good")).collect():
        out[r[0]] = r[1], r[2]
    return out


def featurize(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of docs (doc_id, text); x: features as array<float>."""

    def run(batches):
        for batch in batches:
            buf, off = tx.bytes_of(batch.column(1))
            for i, j, part, o in tx.chunks(buf, off):
                x = features(part, o)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("x", T.ArrayType(T.FloatType()))]))


def score_documents(docs: DataFrame, labels: DataFrame, how: Ranking = Ranking()) -> DataFrame:
    """(doc_id, score, predicted) of docs (doc_id, text), learnt from labels (doc_id, quality 0 or 1).

    Only the text enters a score.  Null texts count as empty and get a score too; a
    text of any length gives one row of features.  Rows of labels with a null are
    ignored, all others are learnt from; repeated rows count as often as they occur.  Without both kinds
    of label every score is the threshold.  An empty table gives an empty result;
    other columns are ignored.
    """
    known = materialize(featurize(docs))
    told = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)").withColumn("h", F.xxhash64("doc_id"))
    buckets = max(1, -(-told.count() // how.block_rows))
    rows = known.join(told, "doc_id").select(F.pmod("h", F.lit(buckets)).alias("bucket"), "h", "doc_id", F.col("quality").cast("int").alias("quality"), "x")
    blocks = materialize(rows.groupBy("bucket").applyInArrow(_block, "bucket long, x binary, good binary"))
    scorer = fit(blocks, how)
    drop_table(blocks)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x = batch.column(1).flatten().to_numpy().reshape(n, -1).astype(np.float64) if n else np.zeros((0, N_FEATURES))
            s = scorer.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= how.threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return materialize(known.mapInArrow(run, T.StructType([known.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])), known)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    scored = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")
