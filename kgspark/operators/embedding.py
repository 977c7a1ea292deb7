"""The pluggable embedding step: backends, and vectors of chunks through a cache."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import md5
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.functions.ids import cache_key

CACHE = "cache_key string, embedding array<double>"
_WORD = re.compile(r"[a-z0-9]+")


class Embedder(Protocol):
    """Answers a list of texts with a matrix of one row each; `name` tells models apart in the cache."""

    name: str

    def embed(self, texts: list[str]) -> np.ndarray: ...


@lru_cache(maxsize=1 << 20)
def _feature(word: str, size: int) -> tuple[int, float]:
    """Place and sign of a word: the first eight hex digits of its MD5, and whether the ninth is even."""
    digits = md5(word.encode()).hexdigest()
    return int(digits[:8], 16) % size, 1.0 if int(digits[8], 16) % 2 == 0 else -1.0


class HashingEmbedder:
    """Signed feature hashing of the ASCII words of a text, to unit length; needs no model and is the same everywhere."""

    def __init__(self, size: int = 64):
        self.size, self.name = size, f"hash-{size}"

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size))
        for row, text in zip(out, texts):
            for word in _WORD.findall(text.lower()):
                at, sign = _feature(word, self.size)
                row[at] += sign
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


_EMBEDDERS: dict[str, Callable[..., Embedder]] = {"hash": HashingEmbedder}


def register_embedder(name: str, make: Callable[..., Embedder]) -> None:
    _EMBEDDERS[name.strip().lower()] = make


def make_embedder(name: str, **options) -> Embedder:
    if name.strip().lower() not in _EMBEDDERS:
        raise ValueError(f"unknown embedder {name!r}")
    return _EMBEDDERS[name.strip().lower()](**options)


def embed(chunks: DataFrame, make: Callable[[], Embedder], cache: DataFrame | None = None, batch: int = 256) -> DataFrame:
    """(chunk_id, cache_key, embedding, cached) of chunks (chunk_id, text); a null text counts as empty.

    Each distinct text that the cache (cache_key, embedding) lacks is asked for once,
    `batch` of them a call; the embedder is made once a task.  Its key is a digest
    of the embedder's name and the text.
    """
    spark = chunks.sparkSession
    cache = spark.createDataFrame([], CACHE) if cache is None else cache
    keyed = chunks.select("chunk_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("cache_key", cache_key(F.lit(make().name), F.col("text")))
    known = cache.groupBy("cache_key").agg(F.min("embedding").alias("embedding"))
    missing = keyed.join(known, "cache_key", "left_anti").groupBy("cache_key").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedder = make()
        for rows in batches:
            for start in range(0, len(rows), batch):
                part = rows.slice(start, batch)
                vectors = np.asarray(embedder.embed(part.column(1).to_pylist()), np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(vectors), pa.list_(pa.float64()))], names=["cache_key", "embedding"])

    fresh = missing.select("cache_key", "text").mapInArrow(run, CACHE)
    vectors = known.withColumn("cached", F.lit(True)).unionByName(fresh.withColumn("cached", F.lit(False)))
    return keyed.join(vectors, "cache_key").select("chunk_id", "cache_key", "embedding", "cached")
