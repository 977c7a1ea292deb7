"""Grounding of relationships in their evidence, and the run's rates."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.operators.fuzzy import near

#: words of a name that ground nothing on their own (fixed values)
STOPWORDS = ("a an the and or of in on at to for with by is as dr mr mrs ms st sir lord lady").split()


def name_tokens(surface: str) -> list[str]:
    """ASCII words of four letters or more that are no stopwords."""
    return [w for w in re.split("[^a-z0-9]+", surface.lower()) if len(w) >= 4 and w not in STOPWORDS]


def _inside(surface: str, text: str) -> bool:
    """Whether a surface is inside a text, both in lower case, by any of the three tests."""
    if surface in text:
        return True
    if any(w in text and w in set(re.findall(r"\w+", text)) for w in name_tokens(surface)):
        return True
    return near(surface, text)


#: short texts repeat; what a worker keeps is bounded by the number of entries and the length of their texts
_inside_short = lru_cache(maxsize=1 << 16)(_inside)


def grounded(surfaces: Iterable[str | None], target: str | None) -> bool:
    """Whether any surface is inside the target, by a whole word of it, or nearly (partial similarity of 85 or more)."""
    text = (target or "").lower()
    test = _inside_short if len(text) <= 200 else _inside
    return bool(text) and any(test(s, text) for s in ((s or "").strip().lower() for s in surfaces) if s)


_ENDS = ["source_span", "target_span", "source_chunk", "target_chunk"]


@F.pandas_udf(T.StructType([T.StructField(n, T.BooleanType()) for n in _ENDS]))
def _grounded_ends(sources: pd.Series, targets: pd.Series, span: pd.Series, chunk: pd.Series) -> pd.DataFrame:
    """Both ends in span and chunk; an end whose surfaces are null is known to be in the span, a null chunk is the span."""
    rows = []
    for ends, s, c in zip(zip(sources, targets), span, chunk):
        inside = [e is None or grounded(e, s) for e in ends]
        rows.append((*inside, *[i or (c is not None and grounded(e, c)) for i, e in zip(inside, ends)]))
    return pd.DataFrame(rows, columns=_ENDS, dtype=bool)


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def score(rows: DataFrame) -> DataFrame:
    """rows (source, target, predicate, evidence_span, chunk_text, type_ok) with span_grounded, chunk_grounded and flags.

    Columns source_aliases and target_aliases, where there, give further surfaces
    of the ends; source_type and target_type are shown in flags.  A null chunk
    text counts as the span; a null span grounds nothing.
    """
    has = set(rows.columns)
    span, none = F.coalesce("evidence_span", F.lit("")), F.array().cast("array<string>")
    ends = []
    for e in ("source", "target"):
        # a name that stands in the span as it is needs no further test, and no row in Python
        plain = F.coalesce((F.trim(e) != "") & F.contains(F.lower(span), F.lower(e)), F.lit(False))
        ends.append(F.when(~plain, F.concat(F.array(e), F.coalesce(F.col(f"{e}_aliases"), none) if f"{e}_aliases" in has else none)))
    open_ = ends[0].isNotNull() | ends[1].isNotNull()
    out = rows.withColumn("_g", _grounded_ends(*ends, F.when(open_, span), F.when(open_, F.col("chunk_text"))))
    out = out.withColumn("span_grounded", F.col("_g.source_span") & F.col("_g.target_span")).withColumn("chunk_grounded", F.col("_g.source_chunk") & F.col("_g.target_chunk"))
    missing = F.array_join(F.filter(F.array(*[F.when(~F.col(f"_g.{e}_chunk"), F.concat(F.lit(f"{e} "), _quoted(F.col(e)))) for e in ("source", "target")]), lambda x: x.isNotNull()), ", ")
    kinds = [F.coalesce(F.col(f"{e}_type"), F.lit("?")) if f"{e}_type" in has else F.lit("?") for e in ("source", "target")]
    flags = F.array(
        F.when(~F.col("chunk_grounded"), F.concat(F.lit("hallucinated["), "predicate", F.lit("]: "), missing, F.lit(" absent from chunk; cited span: "), _quoted(F.substring(span, 1, 80)))),
        F.when(~F.col("type_ok"), F.concat(F.lit("type-violation["), "predicate", F.lit("]: ("), kinds[0], F.lit(" -> "), kinds[1], F.lit(")"))),
    )
    return out.withColumn("flags", F.filter(flags, lambda x: x.isNotNull())).drop("_g")


def report(scored: DataFrame) -> DataFrame:
    """One row of counts and rates; rates of nothing are 1."""
    n = F.count("*")
    counts = scored.agg(n.alias("n"), *[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(f"n_{c}") for c in ("span_grounded", "chunk_grounded", "type_ok")], F.coalesce(F.sum(F.size("flags").cast("long")), F.lit(0)).alias("n_flags"))
    return counts.select("*", *[F.when(F.col("n") == 0, 1.0).otherwise(F.round(F.col(f"n_{c}") / F.col("n"), 6)).alias(f"{c}_rate") for c in ("span_grounded", "chunk_grounded", "type_ok")])
