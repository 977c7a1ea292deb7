"""The pluggable extraction step: backends, validation, cache."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions import json_schema
from kgspark.functions.ids import cache_key, entity_id, strip
from kgspark.operators.fuzzy import merge_entities
from kgspark.operators.rules import ENTITY_TYPES, PROVENANCE_TAGS

EXTRACTION = (
    "struct<entities: array<struct<name: string, type: string, aliases: array<string>, description: string>>, "
    "relationships: array<struct<source: string, target: string, predicate: string, evidence_span: string, confidence: double, provenance_tag: string>>>"
)
#: dollars for a million input, output and cached input tokens of known models (fixed values)
PRICES = {"sonnet": (3.0, 15.0, 0.30)}


class Backend(Protocol):
    """Answers a user message with the JSON of an extraction and its usage."""

    def call(self, message: str) -> dict: ...


@dataclass
class MockBackend:
    """Fixed answers by user message, else the default, else an error; every call costs 10 and 5 tokens."""

    answers: dict[str, dict] = field(default_factory=dict)
    default: dict | None = None

    def call(self, message: str) -> dict:
        answer = self.answers.get(message, self.default)
        if answer is None:
            raise LookupError("no answer for this message")
        return {"payload": json.dumps(answer), "input_tokens": 10, "output_tokens": 5, "cost_usd": 0.0}


_BACKENDS: dict[str, Callable[..., Backend]] = {"mock": MockBackend}


def register_backend(name: str, make: Callable[..., Backend]) -> None:
    _BACKENDS[name.strip().lower()] = make


def backends() -> list[str]:
    return sorted(_BACKENDS)


def backend_maker(name: str, **options) -> Callable[[], Backend]:
    """What makes the backend of this name: looked up here, so that tasks need not know what was registered."""
    if name.strip().lower() not in _BACKENDS:
        raise ValueError(f"unknown backend {name!r}")
    return partial(_BACKENDS[name.strip().lower()], **options)


def make_backend(name: str, **options) -> Backend:
    return backend_maker(name, **options)()


def tool_definition() -> dict:
    """The tool that a model answers with, its schema made from the types and tags that problems() accepts."""
    text = {"type": "string", "minLength": 1}

    def record(required: list[str], **fields: dict) -> dict:
        return {"type": "object", "properties": fields, "required": required, "additionalProperties": False}

    entity = record(["name", "type"], name=text, type={"type": "string", "enum": list(ENTITY_TYPES)}, aliases={"type": "array", "items": text}, description={"type": ["string", "null"]})
    relationship = record(
        ["source", "target", "predicate", "evidence_span", "confidence", "provenance_tag"],
        source=text, target=text, predicate={"type": "string", "pattern": "^[A-Z][A-Z0-9_]*$"}, evidence_span=text,
        confidence={"type": "number", "minimum": 0, "maximum": 1}, provenance_tag={"type": "string", "enum": list(PROVENANCE_TAGS)},
    )
    lists = {"entities": {"type": "array", "items": entity}, "relationships": {"type": "array", "items": relationship}}
    return {"name": "record_extractions", "description": "Record what the chunk says; ends of relationships are names of entities.", "input_schema": record(list(lists), **lists)}


def as_function_call(tool: dict) -> dict:
    """A tool definition in the function-call shape of chat completion APIs."""
    return {"type": "function", "function": {"name": tool["name"], "description": tool["description"], "parameters": tool["input_schema"]}}


def user_message(path: Column, chunk_id: Column, heading: Column, text: Column) -> Column:
    shown = F.when(F.coalesce(heading, F.lit("")) == "", "").otherwise(F.concat(F.lit("\nSection heading: "), heading))
    return F.concat(F.lit("Document path: "), path, F.lit("\nChunk id: "), chunk_id, shown, F.lit("\n\n<chunk>\n"), text, F.lit("\n</chunk>"))


def problems(entities: Column, relationships: Column) -> Column:
    """Names of the rules that an extraction breaks; empty for a valid one."""
    names = F.transform(entities, lambda e: strip(e["name"]))
    checks = {
        "entity_name": F.exists(entities, lambda e: F.coalesce(F.length(strip(e["name"])), F.lit(0)) == 0),
        "entity_type": F.exists(entities, lambda e: ~F.coalesce(e["type"].isin(*ENTITY_TYPES), F.lit(False))),
        "predicate": F.exists(relationships, lambda r: ~F.coalesce(r["predicate"].rlike(r"^[A-Z][A-Z0-9_]*$"), F.lit(False))),
        "confidence": F.exists(relationships, lambda r: ~F.coalesce(r["confidence"].between(0.0, 1.0), F.lit(False))),
        "provenance": F.exists(relationships, lambda r: ~F.coalesce(r["provenance_tag"].isin(*PROVENANCE_TAGS), F.lit(False))),
        "evidence": F.exists(relationships, lambda r: F.coalesce(F.length(r["evidence_span"]), F.lit(0)) == 0),
        "endpoint": F.exists(relationships, lambda r: ~(F.array_contains(names, r["source"]) & F.array_contains(names, r["target"]))),
    }
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())


def cleaned(payload: dict) -> dict:
    """payload without white space around names, aliases and ends of relationships, and without blank aliases; what has another shape stays."""
    bare = lambda x: x.strip() if isinstance(x, str) else x

    def record(x: object, fields: tuple[str, ...]) -> object:
        if not isinstance(x, dict):
            return x
        out = x | {f: bare(x[f]) for f in fields if f in x}
        if isinstance(x.get("aliases"), list):
            out["aliases"] = [a for a in map(bare, x["aliases"]) if a]
        return out

    fields = {"entities": ("name",), "relationships": ("source", "target")}
    return payload | {k: [record(x, f) for x in payload[k]] for k, f in fields.items() if isinstance(payload.get(k), list)}


def _more_keys(payload: dict) -> bool:
    """Whether a payload, or a record in it, has a key that the tool does not know."""
    lists = tool_definition()["input_schema"]["properties"]
    known = {k: set(v["items"]["properties"]) for k, v in lists.items()}
    return bool(set(payload) - set(known)) or any(set(x) - known[k] for k in known for x in payload[k])


def problems_of(payload: dict) -> list[str]:
    """Names of the rules that a parsed payload breaks: problems() for the step that calls a backend, and keys that are not known."""
    ents, rels = payload.get("entities"), payload.get("relationships")
    if not isinstance(ents, list) or not isinstance(rels, list) or not all(isinstance(x, dict) for x in ents + rels):
        return ["shape"]
    names = {str(e.get("name") or "").strip() for e in ents}
    within = lambda c: isinstance(c, (int, float)) and not isinstance(c, bool) and 0 <= c <= 1
    checks = {
        "keys": _more_keys(payload),
        "entity_name": any(not str(e.get("name") or "").strip() for e in ents),
        "entity_type": any(e.get("type") not in ENTITY_TYPES for e in ents),
        "predicate": any(not re.fullmatch(r"[A-Z][A-Z0-9_]*", str(r.get("predicate") or "")) for r in rels),
        "confidence": any(not within(r.get("confidence")) for r in rels),
        "provenance": any(r.get("provenance_tag") not in PROVENANCE_TAGS for r in rels),
        "evidence": any(not r.get("evidence_span") for r in rels),
        "endpoint": any(r.get("source") not in names or r.get("target") not in names for r in rels),
    }
    return [n for n, broken in checks.items() if broken]


def settle(payload: dict, threshold: float = 90) -> dict:
    """A valid payload with similar entities merged and relationships pointing at the kept names; else ValueError."""
    payload = cleaned(payload)
    if broken := problems_of(payload):
        raise ValueError("invalid extraction: " + ", ".join(broken))
    ents = [{"name": e["name"].strip(), "type": e["type"], "aliases": list(e.get("aliases") or []), "description": e.get("description")} for e in payload["entities"]]
    kept, renamed = merge_entities(ents, threshold)
    out = {"entities": kept, "relationships": [r | {end: renamed.get(r[end], r[end]) for end in ("source", "target")} for r in payload["relationships"]]}
    if broken := problems_of(out):
        raise ValueError("invalid after merging: " + ", ".join(broken))
    return out


_RESULT = "chunk_id string, cache_key string, payload string, cached boolean, input_tokens long, output_tokens long, cost_usd double, error string"


def extract(chunks: DataFrame, cache: DataFrame, make: Callable[[], Backend], prompt_version: str = "v0", attempts: int = 4, wait: float = 0.0) -> DataFrame:
    """(chunk_id, cache_key, payload, cached, input_tokens, output_tokens, cost_usd, error) of chunks (chunk_id, message, text).

    Cached payloads (cache_key, payload) that are valid are used as they are; of the
    rest each distinct text is asked for once, for the chunk whose id comes first, and
    the other chunks of that text take its answer as cached.  The backend is made once a task.  An answer is validated,
    its entities are merged and its relationships renamed within the attempt, so an
    invalid answer is asked for again like a failed call.  A chunk that fails
    `attempts` times gives a row with its error and no payload, and the run goes
    on.  See fresh_entries for what belongs into the cache afterwards.
    """
    keyed = chunks.withColumn("cache_key", cache_key(F.lit(prompt_version), F.col("text")))
    parsed = cache.select("cache_key", "payload", F.from_json("payload", EXTRACTION).alias("x")).where(F.try_parse_json("payload").isNotNull() & F.col("x.entities").isNotNull() & F.col("x.relationships").isNotNull())
    parsed = parsed.where(F.size(json_schema.errors_of_text(tool_definition()["input_schema"], F.col("payload"))) == 0)
    valid = parsed.where(F.size(problems(F.col("x.entities"), F.col("x.relationships"))) == 0).groupBy("cache_key").agg(F.min("payload").alias("payload"))
    found = keyed.join(valid, "cache_key", "left")
    zero = [F.lit(0).cast("long").alias("input_tokens"), F.lit(0).cast("long").alias("output_tokens"), F.lit(0.0).alias("cost_usd"), F.lit(None).cast("string").alias("error")]
    hits = found.where("payload IS NOT NULL").select("chunk_id", "cache_key", "payload", F.lit(True).alias("cached"), *zero)
    misses = found.where("payload IS NULL").select("chunk_id", "cache_key", "message")
    asked = misses.groupBy("cache_key").agg(F.min(F.struct("chunk_id", "message")).alias("m")).select("m.chunk_id", "cache_key", "m.message")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make()
        for frame in frames:
            rows = []
            for chunk, key, message in zip(frame["chunk_id"], frame["cache_key"], frame["message"]):
                answer, payload, error = {}, None, None
                for i in range(attempts):
                    try:
                        answer = backend.call(message)
                        payload, error = json.dumps(settle(json.loads(answer["payload"]))), None
                        break
                    except Exception as e:  # any error of the backend or its answer is retried, then reported in the row
                        error = f"{type(e).__name__}: {e}"
                        if wait and i + 1 < attempts:
                            time.sleep(min(20.0, wait * 2**i))
                rows.append((chunk, key, payload, False, answer.get("input_tokens", 0), answer.get("output_tokens", 0), answer.get("cost_usd", 0.0), error))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _RESULT.split(", ")])

    answers = asked.mapInPandas(run, _RESULT).withColumnRenamed("chunk_id", "_asked")
    told = misses.select("chunk_id", "cache_key").join(answers, "cache_key")
    own = F.col("chunk_id") == F.col("_asked")
    spent = [F.when(own, F.col(c)).otherwise(z).alias(c) for c, z in (("input_tokens", F.lit(0).cast("long")), ("output_tokens", F.lit(0).cast("long")), ("cost_usd", F.lit(0.0)))]
    return hits.unionByName(told.select("chunk_id", "cache_key", "payload", (~own & F.col("payload").isNotNull()).alias("cached"), *spent, "error"))


def fresh_entries(extracted: DataFrame) -> DataFrame:
    """(cache_key, payload) that a run adds to the cache: one for each key it had to ask for."""
    return extracted.where("NOT cached AND payload IS NOT NULL").groupBy("cache_key").agg(F.min("payload").alias("payload"))


def facts(extracted: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity facts, relation facts) of extracted rows and their chunks (chunk_id, doc_id, chunk_ord, text), as operators.graph takes them.

    Relations carry their ends' ids, types and aliases, found in the chunk's own
    entities: of those of one name the last counts.  No shuffle but the join.
    """
    x = extracted.where("payload IS NOT NULL").select("chunk_id", F.from_json("payload", EXTRACTION).alias("x")).join(chunks.select("chunk_id", "doc_id", "chunk_ord", "text"), "chunk_id")
    key = F.struct("doc_id", "chunk_ord", "chunk_id").alias("key")
    ents = x.select("doc_id", "chunk_id", key, F.posexplode("x.entities").alias("ent_ord", "e")).select("doc_id", "chunk_id", "key", "ent_ord", "e.*")
    ents = ents.withColumn("entity_id", entity_id(F.col("name"), F.col("type"))).withColumn("ord", F.struct("key", "ent_ord"))
    rels = x.select("doc_id", "chunk_id", key, F.col("text").alias("chunk_text"), F.col("x.entities").alias("es"), F.posexplode("x.relationships").alias("rel_ord", "r")).select("*", "r.*").drop("r")
    for end in ("source", "target"):
        name = F.col(end)
        at = F.try_element_at(F.filter("es", lambda e: e["name"] == name), F.lit(-1))
        rels = rels.withColumn("_e", at).withColumn(f"{end}_type", F.col("_e.type")).withColumn(f"{end}_aliases", F.col("_e.aliases")).withColumn(f"{end}_id", entity_id(F.col("_e.name"), F.col("_e.type"))).drop("_e")
    return ents, rels.drop("es").withColumn("ord", F.struct("key", "rel_ord"))


def cost(model: Column, tokens_in: Column, tokens_out: Column, cache_read: Column) -> Column:
    """Dollars of a call; 0 for a model without a price."""
    out = F.lit(0.0)
    for name, (i, o, c) in PRICES.items():
        out = F.when(model == name, (tokens_in * i + tokens_out * o + cache_read * c) / 1e6).otherwise(out)
    return out
