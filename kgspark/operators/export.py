"""Exports of the graph; every format is one projection per row and is written by Spark's own writers."""

from __future__ import annotations

import json
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def escape_xml(c: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def node_rows(entities: DataFrame) -> DataFrame:
    """A node's aliases and description are written where the table has them."""
    rest = [c for c in ("aliases", "description") if c in entities.columns]
    return entities.select("entity_id", F.to_json(F.struct(F.col("entity_id").alias("id"), F.lit("Entity").alias("type"), F.col("type").alias("subtype"), F.struct("name", "mention_count", "first_seen_doc", *rest).alias("properties"))).alias("json"))


def edge_rows(edges: DataFrame) -> DataFrame:
    return edges.select("edge_id", F.to_json(F.struct(F.col("edge_id").alias("id"), F.col("predicate").alias("type"), F.col("source_id").alias("source"), F.col("target_id").alias("target"), F.struct("confidence", "provenance_tag").alias("properties"))).alias("json"))


def source_rows(table: DataFrame, value: str) -> DataFrame:
    """A row for each document or span of an edge (edge_documents, edge_spans); they are in the order of `first`."""
    return table.select("edge_id", F.to_json(F.struct(F.col("edge_id").alias("edge"), value, F.struct(*[c for c in ("g", "ord") if c in table.columns]).alias("first"))).alias("json"))


def graphml_rows(entities: DataFrame) -> DataFrame:
    xml = F.concat(F.lit('<node id="'), "entity_id", F.lit('"><data key="subtype">'), escape_xml(F.col("type")), F.lit('</data><data key="name">'), escape_xml(F.col("name")), F.lit("</data></node>"))
    return entities.select("entity_id", xml.alias("xml"))


def graphml_edges(edges: DataFrame) -> DataFrame:
    data = [F.concat(F.lit(f'<data key="{k}">'), escape_xml(F.col(c).cast("string")), F.lit("</data>")) for k, c in (("type", "predicate"), ("confidence", "confidence"), ("provenance_tag", "provenance_tag"))]
    return edges.select("edge_id", F.concat(F.lit('<edge id="'), "edge_id", F.lit('" source="'), "source_id", F.lit('" target="'), "target_id", F.lit('">'), *data, F.lit("</edge>")).alias("xml"))


def index_row(versions: DataFrame, keep: int = 50) -> DataFrame:
    """One row: the discovery document of the last `keep` versions (version, published_at), newest first."""
    last = versions.orderBy(F.desc("published_at"), F.desc("version")).limit(keep)
    listed = F.sort_array(F.collect_list(F.struct("published_at", "version")), asc=False)
    return last.agg(listed.alias("v")).select(F.to_json(F.struct(F.get("v", F.lit(0))["version"].alias("latest"), F.transform("v", lambda x: x["version"]).alias("versions"))).alias("json"))


def hub_report(nodes: DataFrame, degrees: DataFrame, top: int = 10) -> DataFrame:
    """(line) of a markdown report: the `top` nodes of the most edges, ties by id."""
    best = degrees.orderBy(F.desc("degree"), "entity_id").limit(top).join(nodes.select("entity_id", "name", "type"), "entity_id")
    return best.select("entity_id", F.concat(F.lit("- **"), "name", F.lit("** ("), "type", F.lit("): "), F.col("degree").cast("string"), F.lit(" edges")).alias("line"))


def jsonld_rows(entities: DataFrame) -> DataFrame:
    body = F.concat(F.lit('{"@id":"'), "entity_id", F.lit('","@type":"'), "type", F.lit('","kg:name":'), F.to_json(F.array("name")), F.lit("}"))
    return entities.select("entity_id", body.alias("jsonld"))


def vault_pages(entities: DataFrame, least: int = 2) -> DataFrame:
    """A page for each entity that is mentioned at least twice."""
    page = F.concat(F.lit("# "), "name", F.lit("\n\ntype: "), "type", F.lit("\nmentions: "), F.col("mention_count").cast("string"), F.lit("\n"))
    return entities.where(F.col("mention_count") >= least).select("entity_id", page.alias("page"))


def write_graph(entities: DataFrame, edges: DataFrame, folder: str, metadata: dict, documents: DataFrame | None = None, spans: DataFrame | None = None) -> None:
    """nodes/ and edges/ as JSON lines, and graph.meta.json/ with counts, under a folder Spark can write.

    documents and spans (edge_documents, edge_spans) go to folders of these names, a line each.
    """
    spark = entities.sparkSession
    for name, value, table in (("edge_documents", "doc_id", documents), ("edge_spans", "evidence_span", spans)):
        if table is not None:
            source_rows(table, value).select("json").write.mode("overwrite").text(str(PurePosixPath(folder) / name))
    node_rows(entities).select("json").write.mode("overwrite").text(str(PurePosixPath(folder) / "nodes"))
    edge_rows(edges).select("json").write.mode("overwrite").text(str(PurePosixPath(folder) / "edges"))
    meta = metadata | {"schema_version": "1.0", "entity_count": entities.count(), "edge_count": edges.count()}
    spark.range(1).select(F.lit(json.dumps(meta, sort_keys=True)).alias("value")).write.mode("overwrite").text(str(PurePosixPath(folder) / "graph.meta.json"))


def major_version_ok(version: Column, major: int = 1) -> Column:
    return F.split(version, r"\.")[0] == F.lit(str(major))
