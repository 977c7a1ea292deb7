"""Line deduplication by an exact set-similarity join of lines.

The tokens of a line are its five-word shingles, ordered by rarity; prefix,
positional and length filters leave few candidates, whose Jaccard similarity is
verified (kgspark.llm.simjoin).  A line goes if an earlier line, itself removed or
not, is similar to it: so no line goes without a match before it, and the result does
not depend on the order in which lines are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.blocks import compare, earlier
from kgspark.llm.shared import attach, drop_table, materialize
from kgspark.llm.simjoin import LINES, Join, similarity_join


def later_matches(docs: DataFrame, join: Join = LINES) -> DataFrame:
    """(doc_id, line, first_doc_id, first_line) of every line to remove.

    Lines are the \\n-split lines of texts, counted from 0, in order of (doc_id,
    line), null ids first; lines without a word are never removed.  first_*: an
    earlier line that the line matches; of its equals, the first.  Null and empty
    texts have no lines with words.  Rows that repeat a doc_id repeat its lines: of
    rows equal in doc_id and line none goes for the sake of the other.  A line is
    one set at any length.  An empty table gives an empty result.  Other columns are
    ignored.
    """
    found = similarity_join(docs, join)
    nodes = materialize(found.records.groupBy("node").agg(F.count("*").alias("count"), F.min("doc_id").alias("doc_id"), F.min("line").alias("line")))
    repeated = nodes.where("count > 1").select("node", "count")
    lines = materialize(attach(found.records.select("doc_id", "line", "node"), repeated, "node", counts=repeated).where("count > 1").drop("count"))
    wanted = found.links.select(F.col("a").alias("node")).union(found.links.select("b")).union(found.members.select("node")).distinct()
    # the order of lines, as one of nodes: each at its first line
    heads = lines.groupBy("node").agg(F.min(F.struct("doc_id", "line", "node")).alias("first"))
    single = nodes.where("count = 1").join(wanted, "node", "left_semi").select("node", F.struct("doc_id", "line", "node").alias("first"))
    firsts = materialize(heads.select("*", F.lit(True).alias("again")).union(single.select("*", F.lit(False))), nodes)
    places = materialize(firsts.join(wanted, "node").select("node", "first"))
    links = found.links
    for x in "ab":
        links = links.join(places.select(F.col("node").alias(x), F.col("first").alias(f"f{x}")), x)
    met = materialize(links.select(F.when(F.col("fa") > F.col("fb"), F.col("a")).otherwise(F.col("b")).alias("node"), F.least("fa", "fb").alias("match")).groupBy("node").agg(F.min("match").alias("match")))
    # members of hot groups without an earlier match yet are open
    members = found.members.join(places, "node").join(met.select("node", F.lit(False).alias("_open")), "node", "left")
    members = members.select("pivot", "node", "n", F.coalesce("_open", F.lit(True)).alias("open"), "first.doc_id", "first.line")
    more = compare(members, found.sets, join, earlier).join(places.select(F.col("node").alias("b"), F.col("first").alias("match")), "b")
    whole = materialize(met.union(more.select(F.col("a").alias("node"), "match")).groupBy("node").agg(F.min("match").alias("match")))
    told = materialize(firsts.join(whole, "node", "left"))
    copies = attach(lines, told.where("again").select("node", "first", "match"), "node")
    copies = copies.withColumn("_first", F.expr("doc_id <=> first.doc_id AND line = first.line")).where("NOT _first OR match IS NOT NULL")
    copies = copies.select("doc_id", "line", F.when(F.col("_first"), F.col("match")).otherwise(F.col("first")).alias("match"))
    single = told.where("NOT again AND match IS NOT NULL").select("first.doc_id", "first.line", "match")
    out = materialize(copies.distinct().union(single).select("doc_id", "line", F.col("match.doc_id").alias("first_doc_id"), F.col("match.line").alias("first_line")))
    for table in (lines, firsts, places, met, whole, told):
        drop_table(table)
    found.drop()
    return out


def remove_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) without the lines of `removed` (doc_id, line); other lines keep their order.

    Texts without a removed line are unchanged, null included.  Columns of docs keep
    their names and values whatever they are called; rows that repeat a doc_id lose
    the same lines.  An empty table gives an empty result.
    """
    drops = removed.groupBy(F.col("doc_id").alias("id")).agg(F.map_from_entries(F.collect_set(F.struct("line", F.lit(True)))).alias("lines"))
    drops = drops.select("id", F.struct("lines").alias("drop"))
    left, right = docs.alias("l"), drops.alias("r")
    joined = left.join(right, F.col("l.doc_id").eqNullSafe(F.col("r.id")), "left")
    kept = F.expr("array_join(filter(split(l.text, '\\n'), (x, i) -> r.drop.lines[cast(i AS bigint)] IS NULL), '\\n')")
    text = F.when(F.col("r.drop").isNull(), F.col("l.text")).otherwise(kept)
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"l.`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return later_matches(spark.read.parquet(f"{sf_dir}/documents.parquet"))
