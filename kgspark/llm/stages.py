"""The operators as stages over `documents`: each returns a table of documents.

Every stage takes whole tables and whole texts of any length.  A null text counts
as empty, a null source is a source of its own without a host's verdict, a null
doc_id is an id.  Columns beyond those of documents stay, whatever they are called;
an empty table gives an empty one.  Tables that a result reads are deleted when a
stage begins after no plan refers to them any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.columns import packed, unpacked
from kgspark.llm.op1_decontamination import matches
from kgspark.llm.op3_mixing import mix
from kgspark.llm.op5_ngram_join import ngram_components
from kgspark.llm.op9_host_rules import judge
from kgspark.llm.op10_sharding import shard
from kgspark.llm.shared import Left, materialize


#: tables that results of stages read; a stage deletes, when it begins, those that nothing reads any more
_left = Left()


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule and no host verdict rejects; repeated rows are judged alike."""
    _left.sweep()
    judged = judge(docs.select(packed(docs).alias("row"), F.col("source").alias("host"), "text"))
    _left.add(judged)
    return judged.where("kept").select(*unpacked(docs.columns))


#: rows of ids up to which they are broadcast, so that no text moves; beyond it texts and ids are shuffled
FEW = 1_000_000


def _meet(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs (as l) joined with ids (as r), a table (id, ...) that can be read again."""
    right = F.broadcast(ids) if ids.count() <= FEW else ids
    return docs.alias("l").join(right.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.id")), how)


def _without(docs: DataFrame, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """docs but for the rows that find(docs (doc_id, text)) names, a table (id).

    Where ids repeat or are null, rows are numbered in order of their ids first, so
    that a row goes for its own text only, not for that of another row of its id.
    """
    if not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count():
        gone = find(docs.select("doc_id", "text"))
        _left.add(gone)
        return _meet(docs, gone, "left_anti")
    ordered = docs.select(packed(docs).alias("row")).orderBy(F.col("row.doc_id").asc_nulls_last())
    rows = materialize(ordered.select(F.monotonically_increasing_id().alias("doc_id"), "row"))
    gone = find(rows.select("doc_id", "row.text"))
    for table in (rows, gone):
        _left.add(table)
    return _meet(rows, gone, "left_anti").select(*unpacked(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingle links join: the one of the smallest doc_id.

    Of rows that repeat a doc_id, or have none, each is a document of its own: it goes
    only where its text equals or is near to one that stays.  Only ids are
    joined to the texts.
    """
    _left.sweep()

    def later(rows: DataFrame) -> DataFrame:
        found = ngram_components(rows)
        gone = materialize(found.where("NOT doc_id <=> component_id").select(F.col("doc_id").alias("id")).distinct(), found)
        return gone

    return _without(docs, later)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; of rows that repeat an id, those that have one go."""
    _left.sweep()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, lambda rows: materialize(matches(rows, items).select(F.col("doc_id").alias("id")).distinct()))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its words taken over its size, rounded.

    Rows that repeat a doc_id are taken as often as all of them together, evenly.
    """
    _left.sweep()
    mixed_ = mix(docs)
    times = mixed_.groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).where("size > 0")
    times = times.select(F.col("doc_id").alias("id"), F.round(F.col("taken") / F.col("size")).cast("int").alias("times")).where("times > 0")
    times = materialize(times, mixed_)
    _left.add(times)
    joined = _meet(docs, times, "inner")
    row = F.struct(*[F.col("l.`" + c.replace("`", "``") + "`") for c in docs.columns])
    return joined.select(F.explode(F.array_repeat(row, F.col("r.times"))).alias("row")).select(*unpacked(docs.columns))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; ties and repeated rows are dealt like others."""
    _left.sweep()
    return shard(docs)
