"""Sharding by a hypergeometric communication matrix.

Rows fall into logical parts by a hash.  One draw of the matrix with the parts'
row counts as row sums and the exact shard sizes as column sums says how many
rows each part sends to each shard.  Every part permutes its rows and deals them
by those counts; every shard permutes what it received.  The result is a uniform
shuffle with shard sizes at most one row apart.
"""

from __future__ import annotations

import math
import random
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.columns import packed, unpacked
from kgspark.llm.order import buckets_for, shuffled
from kgspark.llm.shared import materialize


#: logical parts at most, so that the matrix stays small; beyond it parts get larger
MOST_PARTS = 65_536


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good items among `draws` of good + bad, by inversion from the mode outwards: O(standard deviation)."""
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    left, u = at_mode, rng.random()
    u -= left
    if u < 0:
        return mode
    down, up, p_down, p_up = mode, mode, at_mode, at_mode
    while down > low or up < high:
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u < 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u < 0:
                return down
    return mode


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that part p sends to shard s: row sums `counts`, column sums at most one apart."""
    rng, total = random.Random(seed), sum(counts)
    open_ = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for count in counts:
        row, rest, draws = [], sum(open_), count
        for s in range(shards):
            rest -= open_[s]
            k = draws if s == shards - 1 else hypergeometric(rng, open_[s], rest, draws)
            row.append(k)
            draws -= k
        open_ = [o - k for o, k in zip(open_, row)]
        matrix.append(row)
    return matrix


def shard(docs: DataFrame, shards: int = 8, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with `shard` (0 to shards - 1) and `slot` (0 and up in each shard, gapless).

    Columns of docs named shard or slot are replaced; all others keep names and
    values, whatever they are called.  Nulls in any column are values like others, a null
    text counting as empty; rows that tie in key and text are interchangeable, and
    repeated rows are dealt like distinct ones; a text of any length is one row; an
    empty table gives an empty result.  Equal texts need not stay together: this law
    is about row counts.  One count per part reaches the driver, at most MOST_PARTS.
    """
    spark = docs.sparkSession
    rows = docs.count()
    parts = min(MOST_PARTS, buckets_for(rows))
    named = docs.select(packed(docs).alias("row"), F.col(key).alias("key"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"))
    split = named.withColumn("part", F.expr(f"pmod(xxhash64(key, crc, {seed}), {parts})"))
    found = {p: n for p, n in split.groupBy("part").count().collect()}
    matrix = communication_matrix([found.get(p, 0) for p in range(parts)], shards, seed)
    # the running sums of each part's row of the matrix: a part's rows below edge s + 1 go to shard s
    edges = spark.createDataFrame([(p, list(accumulate(row))) for p, row in enumerate(matrix)], "part bigint, edges array<bigint>")
    local = shuffled(split, ["part"], ["key", "crc"], seed + 1, 1)
    dealt = local.join(F.broadcast(edges), "part").withColumn("shard", F.expr("cast(size(filter(edges, e -> before >= e)) as int)")).drop("before", "edges", "part")
    placed = shuffled(dealt, ["shard"], ["key", "crc"], seed + 2, parts)
    return placed.select(*unpacked(docs.columns, ("shard", "slot")), "shard", F.col("before").alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    narrow = materialize(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")))
    placed = shard(narrow.withColumn("text", F.col("text_crc32").cast("string")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
