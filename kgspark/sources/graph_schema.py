"""The form of a published graph, as a JSON Schema (fixed values: names, patterns and bounds that consumers rely on)."""

from __future__ import annotations

from kgspark.operators.rules import PROVENANCE_TAGS

_TEXT = {"type": "string"}
_COUNT = {"type": "integer", "minimum": 0}
_TEXTS = {"type": "array", "items": _TEXT, "uniqueItems": True}

GRAPH_SCHEMA = {
    "type": "object",
    "required": ["schema_version", "metadata", "nodes", "edges"],
    "additionalProperties": False,
    "properties": {
        "schema_version": {"type": "string", "pattern": r"^\d+\.\d+$"},
        "metadata": {
            "type": "object",
            "required": ["generated_at", "doc_count", "entity_count", "edge_count"],
            "properties": {
                "generated_at": _TEXT, "framework_commit": {"type": "string", "pattern": "^[0-9a-f]{7,40}$"}, "source_manifest_hashes": {"type": "object", "additionalProperties": _TEXT},
                "doc_count": _COUNT, "entity_count": _COUNT, "edge_count": _COUNT, "prompt_version": _TEXT,
            },
        },
        "nodes": {"type": "array", "items": {"$ref": "#/$defs/node"}},
        "edges": {"type": "array", "items": {"$ref": "#/$defs/edge"}},
    },
    "$defs": {
        "node": {
            "type": "object",
            "required": ["id", "type", "properties"],
            "additionalProperties": False,
            "properties": {
                "id": {"type": "string", "pattern": "^[a-z]+_[A-Za-z0-9_]+$"}, "type": {"type": "string", "enum": ["Document", "Entity"]}, "subtype": _TEXT,
                "properties": {"oneOf": [{"$ref": "#/$defs/documentProperties"}, {"$ref": "#/$defs/entityProperties"}]},
            },
        },
        "documentProperties": {
            "type": "object",
            "required": ["canonical_path", "content_hash"],
            "properties": {"canonical_path": _TEXT, "source_url": {"type": ["string", "null"]}, "content_hash": {"type": "string", "pattern": "^sha256:[0-9a-f]{64}$"}, "updated_at": _TEXT, "title": _TEXT},
        },
        "entityProperties": {
            "type": "object",
            "required": ["name"],
            "properties": {"name": {"type": "string", "minLength": 1}, "aliases": _TEXTS, "description": _TEXT, "mention_count": {"type": "integer", "minimum": 1}, "first_seen_doc": _TEXT},
        },
        "edge": {
            "type": "object",
            "required": ["id", "type", "source", "target", "properties"],
            "additionalProperties": False,
            "properties": {
                "id": {"type": "string", "pattern": "^edge_[A-Za-z0-9_]+$"}, "type": {"type": "string", "pattern": "^[A-Z][A-Z0-9_]*$"}, "source": _TEXT, "target": _TEXT,
                "properties": {
                    "type": "object",
                    "properties": {
                        "confidence": {"type": "number", "minimum": 0.0, "maximum": 1.0}, "provenance_tag": {"type": "string", "enum": list(PROVENANCE_TAGS)}, "source_doc_ids": _TEXTS,
                        "evidence_spans": {"type": "array", "items": _TEXT}, "chunk_offset": _COUNT, "predicate": _TEXT,
                    },
                },
            },
        },
    },
}


def schema_of(kind: str) -> dict:
    """The schema of one `node` or `edge`, with the definitions that it refers to."""
    return {"$ref": f"#/$defs/{kind}", "$defs": GRAPH_SCHEMA["$defs"]}
