"""Readers of markdown corpora, golden sets, histories and published graphs."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.functions import ids, paths

GOLDEN = (
    "doc_id string, canonical_path string, expected_entities array<struct<name: string, type: string, aliases: array<string>>>, "
    "expected_relationships array<struct<source: string, target: string, predicate: string>>, expected_top_doc_for_query map<string, string>, notes string"
)
GRAPH = (
    "schema_version string, metadata struct<generated_at: string, doc_count: int, entity_count: int, edge_count: int>, "
    "nodes array<struct<id: string, type: string, subtype: string, properties: struct<name: string, title: string, aliases: array<string>, canonical_path: string, content_hash: string>>>, "
    "edges array<struct<id: string, type: string, source: string, target: string, properties: struct<confidence: double, provenance_tag: string, source_doc_ids: array<string>>>>"
)
_STRINGS = ["title", "source_url", "parent", "created", "updated", "fetched_at", "content_hash", "license", "error"]
_FRONT = T.StructType([T.StructField(n, T.ArrayType(T.StringType()) if n in ("aliases", "tags") else T.StringType()) for n in ("title", "aliases", "tags", *_STRINGS[1:])])


def missing_folders(spark: SparkSession, sources: Sequence[tuple[str, str, str]]) -> list[str]:
    """The folders of sources (folder, repo, layout) that are not there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths_ = {folder: jvm.org.apache.hadoop.fs.Path(folder) for folder, _, _ in sources}
    return [folder for folder, p in paths_.items() if not p.getFileSystem(conf).exists(p) or not p.getFileSystem(conf).getFileStatus(p).isDirectory()]


def read_markdown(spark: SparkSession, sources: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(src_ord, source_repo, layout, rel, content) of the .md files of sources (folder, repo, layout), any Hadoop path."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), None
    for i, (folder, repo, layout) in enumerate(sources):
        if layout not in ("flat", "nested"):
            raise ValueError(f"layout {layout!r} is neither flat nor nested")
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(folder, wholetext=True)
        at = jvm.org.apache.hadoop.fs.Path(folder)
        base = at.getFileSystem(conf).makeQualified(at).toUri().getPath().rstrip("/") + "/"
        path = F.url_decode(F.replace(F.expr("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        rel = F.substr(path, F.instr(path, F.lit(base)) + len(base))
        one = files.select(F.lit(i).alias("src_ord"), F.lit(repo).alias("source_repo"), F.lit(layout).alias("layout"), rel.alias("rel"), F.col("value").alias("content"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no source folder given")
    return out


@F.pandas_udf(_FRONT)
def parse_front(yaml_text: pd.Series) -> pd.DataFrame:
    names = ["title", "aliases", "tags", "source_url", "parent", "created", "updated", "fetched_at", "content_hash", "license", "error"]
    rows = []
    for t in yaml_text:
        try:
            d = yaml.safe_load(t) if t else {}
            d = d if isinstance(d, dict) else {}
            row = [None if d.get(n) is None else [str(x) for x in d[n]] if isinstance(d[n], list) else str(d[n]) for n in names[:-1]]
            for i in (1, 2):
                row[i] = [row[i]] if isinstance(row[i], str) else row[i] or []
            rows.append([*row, None])
        except yaml.YAMLError as e:
            rows.append([None, [], [], *[None] * 7, str(e).split("\n")[0]])
    return pd.DataFrame(rows, columns=names)


def canonicalize(files: DataFrame, run_date: str) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of files as read_markdown returns them.

    A file with a bad name, bad front matter or a blank body becomes a row of
    errors (rel, message), and the run goes on.
    """
    shape = r"(?s)\A\s*---[ \t]*\n(.*?)\n---[ \t]*\n?(.*)\z"
    has = F.col("content").rlike(shape)
    f = files.withColumn("front", parse_front(F.when(has, F.regexp_extract("content", shape, 1)))).withColumn("body", ids.strip(F.when(has, F.regexp_extract("content", shape, 2)).otherwise(F.col("content"))))
    name = F.element_at(F.split("rel", "/"), -1)
    f = f.withColumn("segs", F.when(F.col("layout") == "flat", paths.flat_segments(name)).otherwise(paths.nested_segments(F.col("rel"))))
    f = f.withColumn("canonical_path", paths.canonical_path(F.col("source_repo"), F.col("segs")))
    stem = F.element_at("segs", -1)
    f = f.withColumn("title", F.coalesce(F.when(F.trim("front.title") != "", F.col("front.title")), paths.title_of(F.col("segs"))))
    message = (
        F.when(F.col("segs").isNull() | (F.size("segs") == 0), "empty path segment").when(F.col("front.error").isNotNull(), F.concat(F.lit("front matter: "), "front.error"))
        .when(F.col("body") == "", "empty body").when(F.coalesce(F.col("title"), F.lit("")) == "", "no title")
        .when(F.col("front.content_hash").isNotNull() & ~F.col("front.content_hash").rlike("^sha256:[0-9a-f]{64}$"), "bad content_hash")
    )
    f = f.withColumn("message", message)
    empty = F.array().cast("array<string>")
    docs = f.where("message IS NULL").select(
        ids.doc_id(F.col("canonical_path")).alias("doc_id"), "canonical_path", "title", paths.clean_aliases(F.coalesce("front.aliases", empty), stem).alias("aliases"), paths.clean_tags(F.coalesce("front.tags", empty)).alias("tags"),
        paths.resolve_parent(F.col("front.parent"), F.col("canonical_path")).alias("parent"), F.col("front.source_url").alias("source_url"), F.coalesce("front.content_hash", ids.content_hash(F.col("body"))).alias("content_hash"),
        paths.coerce_date(F.col("front.created")).alias("created"), F.coalesce(paths.coerce_date(F.col("front.updated")), paths.coerce_date(F.col("front.fetched_at")), F.lit(run_date).cast("date")).alias("updated"),
        "source_repo", F.col("rel").alias("source_path"), "src_ord", "body",
    )
    return docs, f.where("message IS NOT NULL").select("rel", "message")


def both_layouts(articles: DataFrame) -> DataFrame:
    """(source_repo, layout, rel, body) of articles (segments, body): each once flat, once nested."""
    flat = F.struct(F.lit("flat").alias("layout"), F.concat(F.array_join("segments", "__"), F.lit(".md")).alias("rel"))
    nested = F.struct(F.lit("nested").alias("layout"), F.concat(F.array_join("segments", "/"), F.lit(".md")).alias("rel"))
    kept = [c for c in articles.columns if c != "segments"]
    return articles.select(*kept, F.explode(F.array(flat, nested)).alias("l")).select(*kept, "l.*")


def without_collisions(files: DataFrame) -> DataFrame:
    """files (source_repo, name) with `unique_name`: names that several repositories have get their repository's before them."""
    shared = files.groupBy("name").agg((F.min("source_repo") != F.max("source_repo")).alias("_shared"))
    return files.join(shared, "name").withColumn("unique_name", F.when(F.col("_shared"), F.concat("source_repo", F.lit("_"), "name")).otherwise(F.col("name"))).drop("_shared")


def golden_rows(golden: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, relationships, queries) that golden rows expect, one row each."""
    ents = golden.select("doc_id", F.explode("expected_entities").alias("e")).select("doc_id", "e.*")
    rels = golden.select("doc_id", F.explode("expected_relationships").alias("r")).select("doc_id", "r.*")
    return ents, rels, golden.select("doc_id", F.explode("expected_top_doc_for_query").alias("query", "top_doc"))


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden rows of a JSON-lines file; bad JSON fails the read, blank lines are skipped."""
    return spark.read.schema(GOLDEN).option("mode", "FAILFAST").json(path)


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a published graph document."""
    doc = spark.read.schema(GRAPH).option("multiLine", True).json(path)
    return doc.select(F.inline("nodes")), doc.select(F.inline("edges"))


def append_history(run: DataFrame, path: str) -> None:
    run.write.mode("append").json(path)
