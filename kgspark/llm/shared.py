"""Tables written to the folder that the driver and all executors share.

Lineage is cut only by writing Parquet under ``spark.checkpoint.dir``: a lost
executor then costs a reread, never a recomputation of the whole plan.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: a key is heavy if it holds more than one row in this many; so at most this many are
HEAVY = 10_000
#: folders of the tables made in each open scope, innermost last
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path under spark.checkpoint.dir; where that is unset, a folder of our own in local mode, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="kgspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/kgspark/{uuid.uuid4().hex}"


def materialize(df: DataFrame, *used: DataFrame, rows_a_file: int = 0) -> DataFrame:
    """Write df as a shared table and read it back; then delete the tables `used`, which nothing else needs.

    rows_a_file: rows of a file at most, for rows of megabytes: Parquet's writer and
    reader hold thousands of rows at once, as many as a file has (0: no limit).
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    if _scopes:
        _scopes[-1].append(path)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_a_file).parquet(path)
    for table in used:
        drop_table(table)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table made by materialize()."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/kgspark/" in folder:
            _delete(df.sparkSession, folder)


class Left:
    """Tables that a returned DataFrame still reads, each deleted once no plan refers to it any more.

    Every plan over a table holds the file index that the table was read with, also
    plans derived from it; a weak reference in the JVM tells whether one is left.
    """

    def __init__(self):
        self._tables: list[tuple[SparkSession, str, object]] = []

    def add(self, table: DataFrame) -> None:
        spark = table.sparkSession
        index = table._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            self._tables.append((spark, folder, spark.sparkContext._jvm.java.lang.ref.WeakReference(index)))

    def sweep(self) -> None:
        """Delete the tables that nothing can read again; the others stay for a later call."""
        self._tables = [t for t in self._tables if t[0].sparkContext._jsc is not None]
        if not self._tables:
            return
        gc.collect()
        self._tables[0][0].sparkContext._jvm.System.gc()
        for spark, folder, index in list(self._tables):
            if index.get() is None:
                self._tables.remove((spark, folder, index))
                _delete(spark, folder)


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes, at its end, the tables made inside; those put into the list that it gives stay."""
    made, kept = [], []
    _scopes.append(made)
    try:
        yield kept
    finally:
        _scopes.remove(made)
        stay = {f.rpartition("/")[0].rpartition("/")[2] for df in kept for f in df.inputFiles()}
        for folder in made:
            if folder.rpartition("/")[2] not in stay:
                _delete(spark, folder)
            elif _scopes:
                _scopes[-1].append(folder)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Objects that Python has let go reach the JVM a little later, and the first
    collection after that only queues what it finds: so there are two.
    """
    gc.collect()
    for _ in range(2):
        time.sleep(0.2)
        spark.sparkContext._jvm.System.gc()


def attach(left: DataFrame, right: DataFrame, *keys: str, counts: DataFrame | None = None) -> DataFrame:
    """left LEFT JOIN right USING (keys), for tables that can be read again; right has each key once.

    Keys that hold more than one row in HEAVY, at most that many, meet their rows
    by a broadcast, the others by a shuffle; rows of a null key move nowhere.
    counts: (keys, count) of left, where that is known.
    """
    key, some = list(keys), left
    for k in keys:
        some = some.where(F.col(k).isNotNull())
    counts = some.groupBy(*key).count() if counts is None else counts
    total = left.count()
    heavy = F.broadcast(counts.where(F.col("count") * HEAVY > total).where("count > 1000").select(*key))
    many = some.join(heavy, key, "left_semi").join(F.broadcast(right.join(heavy, key, "left_semi")), key, "left")
    few = some.join(heavy, key, "left_anti").join(right, key, "left")
    order = [*left.columns, *[c for c in right.columns if c not in key]]
    out = many.select(order).union(few.select(order))
    if any(left.schema[k].nullable for k in key):
        null = " OR ".join(f"`{k}` IS NULL" for k in key)
        out = out.union(left.where(null).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in key]))
    return out
