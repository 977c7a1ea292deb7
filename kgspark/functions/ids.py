"""Stable ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space as Python has it: four control characters more than Java's
_WHITE = r"\s\x1c-\x1f"


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.regexp_replace(c, rf"(?U)^[{_WHITE}]+|[{_WHITE}]+$", "")


def normalize_name(c: Column) -> Column:
    """Lower case, white space and underscores as one space, then no punctuation."""
    spaced = F.regexp_replace(strip(F.lower(c)), rf"(?U)[{_WHITE}_]+", " ")
    return strip(F.regexp_replace(spaced, rf"(?U)[^\p{{L}}\p{{N}}_{_WHITE}]", ""))


def digest(prefix: str, *parts: Column, sep: str = "\0") -> Column:
    """prefix and the first 16 hex digits of the SHA-256 of the joined parts."""
    joined = parts[0]
    for p in parts[1:]:
        joined = F.concat(joined, F.lit(sep), p)
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined.cast("binary"), 256), 1, 16))


#: the sign of a long is turned round, so that numbers order as the ids do
_SIGN = -(1 << 63)


def id_number(id_: Column) -> Column:
    """The 64 bits of an id that digest() made, in its order: as many ids, a third of the bytes."""
    return F.conv(F.substring_index(id_, "_", -1), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))


def id_of_number(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lower(F.lpad(F.hex(number.bitwiseXOR(F.lit(_SIGN))), 16, "0")))


def entity_id(name: Column, kind: Column) -> Column:
    return digest("ent_", normalize_name(name), strip(kind))


def edge_id(source: Column, target: Column, predicate: Column) -> Column:
    """Directed: source and target do not commute."""
    return digest("edge_", source, target, strip(predicate))


def doc_id(canonical_path: Column) -> Column:
    return digest("doc_", canonical_path)


def chunk_id(doc: Column, offset: Column, text: Column) -> Column:
    return digest("chk_", doc, offset.cast("string"), text, sep="|")


def cache_key(prompt_version: Column, chunk_text: Column) -> Column:
    return F.sha2(F.concat(prompt_version, F.lit("\0"), chunk_text).cast("binary"), 256)


def content_hash(body: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(body.cast("binary"), 256))


def token_estimate(text: Column) -> Column:
    """Tokens of a text at 3.5 characters each: 0 for empty, else at least 1."""
    return F.when(F.length(text) == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.length(text) / F.lit(3.5)).cast("int") + 1)).cast("long")
