"""Arriving files as micro-batches, and what is known of each source from one batch to the next."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: what arrives: a source's path, the hash of its content (null: it was deleted), and a number that orders arrivals
ARRIVAL = "path string, hash string, seq bigint"
STATUS = "path string, seq bigint, hash string, version int, status string"


def on_arrival(spark: SparkSession, folder: str, schema: str, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Start a query that gives every new Parquet file of a folder to `handle` once and then stops."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The status of each arrival of one path, in order, against the state that the one before left."""
    known, version = state.get if state.exists else (None, 0)
    arrived = pd.concat(list(frames)).sort_values("seq", kind="stable")
    out = []
    for seq, hash_ in zip(arrived["seq"], arrived["hash"]):
        hash_ = None if pd.isna(hash_) else hash_
        if hash_ == known:
            status = "absent" if hash_ is None else "unchanged"
        else:
            status = "new" if known is None else "deleted" if hash_ is None else "changed"
            known, version = hash_, version + 1
        out.append((key[0], seq, hash_, version, status))
    state.update((known, version))
    yield pd.DataFrame(out, columns=["path", "seq", "hash", "version", "status"])


def statuses(arrivals: DataFrame) -> DataFrame:
    """(path, seq, hash, version, status) of a stream of arrivals (path, hash, seq).

    Each path's last hash and number of versions are state: a path that arrives is
    new, changed, unchanged, deleted, or, deleted before it was ever seen or twice,
    absent.  The state of a deleted path stays, so that its versions go on.
    """
    return arrivals.groupBy("path").applyInPandasWithState(_step, STATUS, "hash string, version int", "append", GroupStateTimeout.NoTimeout)


def batch_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that may see a batch again: each batch has a folder that is overwritten."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")

    return write


def track(spark: SparkSession, folder: str, out: str, checkpoint: str, handle: Callable[[DataFrame, int], None] | None = None, files: int = 64) -> None:
    """Take in what has arrived in a folder of Parquet files since the last call, at most `files` of them a batch, and write the statuses under `out`.

    handle: called with each batch of statuses as well, after it is written; it must
    take a batch that it has seen before.  A call that is broken off goes on at the next.
    """
    write = batch_writer(out)

    def both(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if handle is not None:
            handle(spark.read.parquet(f"{out.rstrip('/')}/batch_id={batch_id}"), batch_id)

    stream = spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", files).parquet(folder)
    query = statuses(stream).writeStream.foreachBatch(both).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_statuses(spark: SparkSession, out: str) -> DataFrame:
    """All statuses written so far, each with its batch_id."""
    return spark.read.schema(f"{STATUS}, batch_id int").parquet(out)
