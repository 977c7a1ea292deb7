"""From folders of markdown to a published version of the graph and the report of the run.

A home folder keeps what one run leaves to the next: the extraction cache, the versions
of the graph, and a report for each run.  A run takes in only the documents whose
bodies are new or changed since the current version; what these, and the documents
that are gone, say in the graph is built again, and all else is kept.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.operators import chunker, extraction, graph, incremental
from kgspark.plans import ingest
from kgspark.plans.tables import cut
from kgspark.sources import corpus
from kgspark.sources.graph_store import GraphStore, Snapshot, adjacency

Sources = Sequence[tuple[str, str, str]]
_ENTITY_FACT = ["doc_id", "entity_id", "name", "type", "aliases", "description", "ord"]
_EDGE_FACT = ["doc_id", "source_id", "target_id", "predicate", "confidence", "provenance_tag", "evidence_span", "ord"]


def _cache(spark: SparkSession, store: GraphStore) -> DataFrame:
    return spark.read.schema(ingest.CACHE).parquet(f"{store.files.base}/cache") if store.files.fs.exists(store.files.path("cache")) else spark.createDataFrame([], ingest.CACHE)


def _changed(docs: DataFrame, before: Snapshot | None, prompt_version: str) -> DataFrame:
    """(doc_id, status) of documents against those of a version: new, changed, unchanged or deleted; another prompt changes all."""
    now = docs.select(F.col("doc_id").alias("path"), F.col("body_hash").alias("hash"))
    spark = docs.sparkSession
    then = spark.createDataFrame([], "path string, hash string") if before is None else before.table("documents").select(F.col("doc_id").alias("path"), F.col("body_hash").alias("hash"))
    if before is not None and before.manifest["note"].get("prompt_version") != prompt_version:
        then = then.withColumn("hash", F.concat(F.lit("other prompt "), "hash"))
    return incremental.manifest_diff(then, now).select(F.col("path").alias("doc_id"), "status")


def ingest_folders(
    spark: SparkSession, sources: Sources, home: str, make: Callable[[], extraction.Backend], prompt_version: str = "v0",
    settings: chunker.ChunkSettings = chunker.ChunkSettings(), now: datetime | None = None, attempts: int = 4, wait: float = 0.0,
) -> dict:
    """Run canonicalize, chunk, extract and build over sources (folder, repo, layout), publish a version, write and return the report.

    Folders that are missing, files that cannot be read as documents and chunks that
    fail are errors of the report; the run goes on.  A document with a failed chunk is
    not taken as done: it is tried again by the next run.
    """
    started = now or datetime.now(UTC)
    if not sources:
        raise ValueError("no source folder given")
    run_id, store = started.strftime("%Y%m%dT%H%M%SZ"), GraphStore(spark, home)
    absent = corpus.missing_folders(spark, sources)
    there = [s for s in sources if s[0] not in absent]
    if not there:
        raise FileNotFoundError(f"no source folder is there: {', '.join(absent)}")
    found, broken = corpus.canonicalize(corpus.read_markdown(spark, there), started.strftime("%Y-%m-%d"))
    docs, broken = cut(found.withColumn("body_hash", F.sha2("body", 256)).dropDuplicates(["doc_id"])), cut(broken)
    before = store.current()
    status = cut(_changed(docs, before, prompt_version))
    todo = docs.join(status.where("status IN ('new', 'changed')"), "doc_id", "left_semi")
    run = ingest.ingest(todo, make, _cache(spark, store), prompt_version, settings, attempts, wait)
    run.cache.write.mode("append").parquet(f"{store.files.base}/cache")
    failed = run.failed.join(run.chunks.select("chunk_id", "doc_id"), "chunk_id").select("doc_id", "error")
    tables = _tables(before, docs, status, run, failed)
    version = f"graph-v{started.strftime('%Y%m%d%H%M%S')}"
    store.publish(version, tables, {"adjacency": "node_id"}, {"prompt_version": prompt_version, "run_id": run_id})
    counts = spark.createDataFrame([(docs.count(), broken.count() + len(absent))], "docs_canonicalized long, docs_failed long")
    row = ingest.report(run, counts).first().asDict()
    kinds = {r["status"]: r["count"] for r in status.groupBy("status").count().collect()}
    messages = broken.orderBy("rel", "message").limit(100).collect()
    row |= {
        "run_id": run_id, "version": version, "prompt_version": prompt_version, "started_at": started.isoformat(), "finished_at": (now or datetime.now(UTC)).isoformat(),
        "canonicalization_errors": [f"{a}: no such folder" for a in absent] + [f"{r['rel']}: {r['message']}" for r in messages], **{f"docs_{k}": kinds.get(k, 0) for k in ("new", "changed", "unchanged", "deleted")},
    }
    store.files.fs.mkdirs(store.files.path(f"runs/{run_id}"))
    store.files.put(f"runs/{run_id}/report.json", json.dumps(row, sort_keys=True, indent=2))
    return row


def _tables(before: Snapshot | None, docs: DataFrame, status: DataFrame, run: ingest.Run, failed: DataFrame) -> dict[str, DataFrame]:
    """The tables of the next version: facts of changed documents replaced, and what they speak of built again."""
    touched = cut(status.where("status != 'unchanged'").select("doc_id"))
    fresh = {"entity_facts": cut(run.entity_facts.select(*_ENTITY_FACT)), "relation_facts": cut(run.relation_facts.select(*_EDGE_FACT))}
    held = ["doc_id", "canonical_path", "title", "aliases", "tags", "parent", "source_url", "content_hash", "created", "updated", "source_repo", "source_path"]
    # without its hash a document that failed is a changed one next time
    done = docs.join(failed.select("doc_id").distinct().withColumn("_failed", F.lit(True)), "doc_id", "left")
    tables = {"documents": done.select(*held, F.when(F.col("_failed"), "failed").otherwise(F.col("body_hash")).alias("body_hash"))}
    builds = (("entities", "entity_facts", graph.entities, ["entity_id"]), ("edges", "relation_facts", graph.edges, graph.TRIPLE))
    for name, facts, build, keys in builds:
        if before is None:
            tables[facts], tables[name] = fresh[facts], cut(build(fresh[facts]))
        else:
            old = before.table(facts)
            tables[facts] = graph.replace_documents(old, touched, fresh[facts])
            tables[name] = cut(graph.maintained(before.table(name), old, touched, fresh[facts], build, keys))
    return tables | {"edge_documents": graph.edge_documents(tables["relation_facts"]), "adjacency": adjacency(tables["edges"])}
