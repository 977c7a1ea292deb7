"""From canonical documents to a graph and the report of the run."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.operators import chunker, extraction, graph, rules, scoring
from kgspark.plans.tables import cut

CACHE = "cache_key string, payload string"


@dataclass(frozen=True)
class Run:
    """Tables of one ingest; `cache` has the entries to add, `failed` the chunks without an extraction."""

    chunks: DataFrame
    extracted: DataFrame
    entity_facts: DataFrame
    relation_facts: DataFrame
    cache: DataFrame
    failed: DataFrame


def ingest(docs: DataFrame, make: Callable[[], extraction.Backend], cache: DataFrame | None = None, prompt_version: str = "v0", settings: chunker.ChunkSettings = chunker.ChunkSettings(), attempts: int = 4, wait: float = 0.0) -> Run:
    """Chunk docs (doc_id, canonical_path, body), extract each chunk once, and lay out the facts.

    The answers are written as a table before anything reads them, so no backend
    is called twice for a chunk whatever is computed from them later.
    """
    spark = docs.sparkSession
    cache = spark.createDataFrame([], CACHE) if cache is None else cache
    chunks = cut(chunker.chunk_documents(docs, settings))
    asked = chunks.withColumn("message", extraction.user_message(F.col("canonical_path"), F.col("chunk_id"), F.col("heading"), F.col("text")))
    extracted = cut(extraction.extract(asked.select("chunk_id", "message", "text"), cache, make, prompt_version, attempts, wait))
    ents, rels = extraction.facts(extracted, chunks)
    return Run(chunks, extracted, ents, rels, extraction.fresh_entries(extracted), extracted.where("error IS NOT NULL").select("chunk_id", "error"))


def report(run: Run, n_docs: DataFrame, shown: int = 20) -> DataFrame:
    """One row: what was read, asked, cached, paid, built and grounded.

    n_docs has one row with docs_canonicalized and docs_failed.  Rates of nothing
    are 1; flagged_examples are the first `shown` flags in order of the documents.
    """
    e = run.extracted.agg(
        F.count("*").alias("chunks_total"), F.count_if(~F.col("cached") & F.col("error").isNull()).alias("chunks_extracted"), F.count_if("cached").alias("chunks_cache_hits"), F.count("error").alias("chunks_failed"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"cost_{c}") for c in ("input_tokens", "output_tokens")], F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 6).alias("cost_usd"),
    )
    typed = run.relation_facts.withColumn("type_ok", F.coalesce(rules.signature_ok(F.col("predicate"), F.col("source_type"), F.col("target_type")), F.lit(False)))
    scored = cut(scoring.score(typed).select("ord", "predicate", "span_grounded", "chunk_grounded", "type_ok", "flags"))
    rates = scoring.report(scored).withColumnsRenamed({"span_grounded_rate": "evidence_grounding_rate", "chunk_grounded_rate": "chunk_grounding_rate", "type_ok_rate": "predicate_type_ok_rate", "n": "n_relationships_scored", "n_flags": "flagged_count"})
    rates = rates.drop("n_span_grounded", "n_chunk_grounded", "n_type_ok")
    first = scored.where(F.size("flags") > 0).orderBy("ord").limit(shown).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "flags"))), lambda x: x["flags"]).alias("f"))
    first = first.select(F.slice(F.flatten("f"), 1, shown).alias("flagged_examples"))
    row = n_docs
    for part in (e, graph.builder_stats(run.entity_facts, run.relation_facts), rates, first):  # single rows, side by side
        row = row.withColumn("_k", F.lit(1)).join(part.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return row.withColumnsRenamed({"edges_created": "relationships_created", "edges_updated": "relationships_updated"})


def write_report(one: DataFrame, folder: str, run_id: str, prompt_version: str) -> None:
    """The report as one JSON line under folder/run_id, with the run's id and prompt version."""
    one.withColumns({"run_id": F.lit(run_id), "prompt_version": F.lit(prompt_version)}).coalesce(1).write.mode("overwrite").json(f"{folder.rstrip('/')}/{run_id}")


class RuleBackend:
    """Reads `source -PREDICATE-> target` lines of a chunk; for tests and fixtures.  Types come before a colon."""

    def call(self, message: str) -> dict:
        body = message.split("<chunk>\n", 1)[1].rsplit("\n</chunk>", 1)[0]
        ents, rels = {}, []
        for line in body.split("\n"):
            left, arrow, right = line.partition("-> ")
            ends = [left.rpartition(" -")[0], right]
            if not arrow or not all(":" in x for x in ends):
                continue
            names = []
            for kind, _, name in (x.partition(":") for x in ends):
                ents.setdefault((kind, name), {"name": name, "type": kind, "aliases": [], "description": None})
                names.append(name)
            rels.append({"source": names[0], "target": names[1], "predicate": left.rpartition(" -")[2], "evidence_span": line, "confidence": 0.9, "provenance_tag": "EXTRACTED"})
        return {"payload": json.dumps({"entities": list(ents.values()), "relationships": rels}), "input_tokens": 10, "output_tokens": 5, "cost_usd": 0.0}
