"""N-gram Jaccard join: documents that share 75% of their five-word shingles.

Method: multiple global orders.  Candidates must share prefix tokens under each of
three token orders; the filters are intersected before any set is moved or
verified.  See kgspark.llm.simjoin for the join itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.blocks import compare, forest
from kgspark.llm.components import components
from kgspark.llm.shared import attach, drop_table, materialize
from kgspark.llm.simjoin import Found, Join, similarity_join


def link_components(found: Found, join: Join) -> DataFrame:
    """(node, label) of every node with a link, the links within hot groups included; label: the component's smallest node."""
    labels = components(found.links)
    members = found.members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # the members that the group's pivot does not reach are open
    heads = members.where("node = pivot").select("pivot", F.col("label").alias("_head"))
    mixed = members.join(heads, "pivot").select("pivot", "node", "n", (F.col("label") != F.col("_head")).alias("open"), "label")
    more = materialize(compare(mixed, found.sets, join, forest))
    if not more.limit(1).count():
        drop_table(more)
        return labels
    joined = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more.select("a", "b"))
    whole = components(joined)
    drop_table(more), drop_table(labels)
    return whole


def ngram_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text).

    component_id: the smallest doc_id that links reach, the row's own included; a
    null doc_id counts only where a component has no other.
    Rows of equal sets are one node; a text without words (or null) has no
    shingles and is its own component.  Repeated rows come out as often as they
    went in; rows that tie in doc_id are rows like others.  A text is one set at any
    length.  An empty table gives an empty result.  Other columns are ignored.
    """
    found = similarity_join(docs, join)
    labels = link_components(found, join)
    # the smallest document of each node, then of each component: no row meets its whole component
    least = materialize(found.records.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least")))
    linked = materialize(labels.join(least, "node"))
    of = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    named = materialize(attach(linked, of, "label").select("node", "component_id"))
    whole = attach(found.records, least.join(named, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id")), "node")
    out = materialize(whole.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
    for table in (labels, least, linked, named):
        drop_table(table)
    found.drop()
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
