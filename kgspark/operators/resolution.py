"""Entities of all documents that are one: equal once normalized, similar, or judged to be.

Names are sets of character trigrams.  Pairs of one type whose Jaccard similarity may
reach the lower bound are found by a prefix filter: with a name's trigrams in order
of rarity, two such names share some among their first few, so names are joined by these together;
how few follows from both sizes.
Pairs above the upper bound are links; those between the bounds go to a judge, each
pair of names once, through a cache of verdicts.  Links are then resolved as a greedy
pass over the entities in order would: each joins the first entity before it that
stands for itself and is linked to it, or stands for itself.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions.ids import cache_key, normalize_name
from kgspark.plans.tables import cut, discard

VERDICT = "pair_key string, same boolean"


class Judge(Protocol):
    """Says whether two names of one type mean the same entity."""

    def same(self, kind: str, a: str, b: str) -> bool: ...


class SameDigits:
    """A judge without a model: names are one if their digits are."""

    def same(self, kind: str, a: str, b: str) -> bool:
        return [c for c in a if c.isdigit()] == [c for c in b if c.isdigit()]


def trigrams(norm: Column) -> Column:
    """The distinct trigrams of a normalized name between blanks; none of an empty one."""
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    each = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substr(padded, i, F.lit(3)))
    return F.when(F.length(norm) > 0, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))


#: grams that a key is made of, where sizes differ by at most one and where they differ by more
_NEAR, _FAR = 4, 3
#: grams that the largest sets with such keys share, and the longest prefix that keys are chosen from
_MOST_GRAMS, _MOST_PREFIX = 24, 30


class _Prefixes:
    """How many first grams, in order of rarity, keys are made of for each size of a set.

    Sets that share o grams share the first k of these among their first n - o + k,
    and o follows from both sizes: near[n] is for partners whose size differs by one at
    most, large[n] and small[n] for those that are smaller or larger by more.  Sets of
    over `most` grams, of which there would be too many choices, and those that may have
    fewer than k in common have a key for each gram of their prefix (see single).
    Whatever two sets are similar have one kind of key both.
    """

    def __init__(self, least: float):
        low = least - 5e-7  # similarities are rounded to six digits
        whole = lambda x: math.ceil(x - 1e-9)
        need = lambda n, m: whole(low / (1 + low) * (n + m))
        fits = lambda n, m: min(n, m) >= low * max(n, m) - 1e-9
        first = lambda n, sizes, k: max((n - max(need(n, m), k) + k for m in sizes if m > 0 and fits(n, m)), default=0) if n >= k else 0
        top = min(math.floor(_MOST_GRAMS / low + 1e-9), math.floor(_MOST_PREFIX / max(1 - low, 1e-6)))
        self.low = low
        self.most = max(n for n in range(top + 1) if n - whole(low * n) + _NEAR <= _MOST_PREFIX)
        sizes = range(self.most + 1)
        self.near = [first(n, (n - 1, n, n + 1), _NEAR) for n in sizes]
        self.large = [first(n, range(1, n - 1), _FAR) for n in sizes]
        self.small = [first(n, (n + 2,), _FAR) for n in sizes]

    def single(self, n: Column) -> Column:
        """The length of the prefix of which each gram is a key, of sets that need such keys; else 0."""
        shared = F.greatest(F.ceil(F.lit(self.low) * n - F.lit(1e-9)), F.lit(1))
        return F.when((shared < _NEAR) | (n >= math.floor(self.low * (self.most + 1))), (n - shared + 1).cast("int")).otherwise(0)


def _choices(n: Column, prefixes: list[int], k: int) -> Column:
    """All choices of k places of the prefix that sets of size n have, eight bits a place.

    In order of their last place the choices are the same for all sets: those of a shorter prefix come first.
    """
    ways = sorted(itertools.combinations(range(max(prefixes)), k), key=lambda c: c[::-1])
    ways = [sum(i << 8 * at for at, i in enumerate(c)) for c in ways] or [0]
    many = F.coalesce(F.get(F.lit([math.comb(p, k) for p in prefixes]), n.cast("int")), F.lit(0))
    return F.slice(F.lit(ways), F.lit(1), many)


def _key(grams: Column, choice: Column, k: int) -> Column:
    """The key of a choice of k grams; that of a prefix's single gram where k is 1."""
    chosen = [choice] if k == 1 else [F.get(grams, F.shiftright(choice, 8 * at).bitwiseAND(255)) for at in range(k)]
    return F.xxhash64(F.lit(k), *chosen)


def _chosen(sets: DataFrame, choices: Column, k: int) -> DataFrame:
    """sets once for each choice, with its key."""
    return sets.select("*", F.explode(choices).alias("_c")).select(*sets.columns, _key(F.col("grams"), F.col("_c"), k).alias("key"))


def _keys(grams: Column, n: Column, least: float) -> Column:
    """All keys of a set of n grams, each in order of rarity, in one array; similar_pairs has a row for each."""
    how = _Prefixes(least)
    each = lambda choices, k: F.transform(choices, lambda c: _key(grams, c, k))
    far = [each(_choices(n, sizes, _FAR), _FAR) for sizes in (how.large, how.small)]
    return F.array_distinct(F.concat(each(F.slice(grams, F.lit(1), how.single(n)), 1), each(_choices(n, how.near, _NEAR), _NEAR), *far))


def similar_pairs(entities: DataFrame, least: float) -> DataFrame:
    """(type, a, b, similarity) of the pairs of entities (entity_id, name, type) of one type whose names' similarity is `least` or more; a < b.

    Exact: no such pair lacks a common key (see _Prefixes) or passes the bounds on sizes.
    Sets go along with their keys, so pairs are compared where they meet and only
    those that are similar move on.  Names are normalized and sets ordered once, as tables.
    """
    named = cut(entities.select("entity_id", "type", normalize_name(F.col("name")).alias("norm")).distinct())
    # three code points of 21 bits are one number
    padded = F.concat(F.lit(" "), F.col("norm"), F.lit(" "))
    code = lambda at, bits: F.ascii(F.substring(padded, F.col("i") + at, F.lit(1))).cast("long") * (1 << bits)
    rows = named.where("length(norm) > 0").select("*", F.explode(F.sequence(F.lit(1), F.length("norm"))).alias("i"))
    rows = rows.select("entity_id", "type", (code(0, 42) + code(1, 21) + code(2, 0)).alias("gram"))
    rarity = rows.groupBy("type", "gram").agg(F.count("*").alias("df"))
    ordered = rows.join(rarity, ["type", "gram"]).groupBy("type", "entity_id").agg(F.sort_array(F.collect_set(F.struct("df", "gram"))).alias("o"))
    sets = cut(ordered.select("type", "entity_id", F.col("o")["gram"].alias("grams"), F.size("o").alias("n")))
    how, n = _Prefixes(least), F.col("n")
    alike = _chosen(sets, _choices(n, how.near, _NEAR), _NEAR).unionByName(_chosen(sets, F.slice("grams", F.lit(1), how.single(n)), 1))
    large, small = (_chosen(sets, _choices(n, sizes, _FAR), _FAR) for sizes in (how.large, how.small))
    side = lambda t, s: t.select("key", "type", F.col("entity_id").alias(s), F.col("grams").alias(f"{s}_g"), F.col("n").alias(f"{s}_n"))
    met = side(alike, "a").join(side(alike, "b"), ["key", "type"]).where("a < b")
    apart = side(large, "a").join(side(small, "b"), ["key", "type"]).where("a_n - b_n >= 2")
    shared = F.size(F.array_intersect("a_g", "b_g"))
    found = None
    for pairs in (met, apart):
        pairs = pairs.where(F.least("a_n", "b_n") >= F.lit(how.low) * F.greatest("a_n", "b_n") - 1e-9)
        scored = pairs.select("type", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.round(shared / (F.col("a_n") + F.col("b_n") - shared), 6).alias("similarity"))
        scored = scored.where(F.col("similarity") >= least)
        found = scored if found is None else found.unionByName(scored)
    return found.distinct()


def judged(pairs: DataFrame, names: DataFrame, make: Callable[[], Judge], verdicts: DataFrame | None = None) -> DataFrame:
    """(type, a, b, pair_key, same, cached) of pairs (type, a, b), as a table; names: (entity_id, name).

    A verdict is kept by a digest of the type and the two names: what the verdicts
    (pair_key, same) lack is asked for once, by a judge that is made once a task.
    """
    spark = pairs.sparkSession
    verdicts = spark.createDataFrame([], VERDICT) if verdicts is None else verdicts
    named = pairs.select("type", "a", "b")
    for s in ("a", "b"):
        named = named.join(names.select(F.col("entity_id").alias(s), F.col("name").alias(f"{s}_name")), s)
    named = named.withColumn("pair_key", cache_key(F.concat_ws("\0", "type", "a_name"), F.col("b_name")))
    known = verdicts.groupBy("pair_key").agg(F.min("same").alias("same"))
    asked = named.join(known, "pair_key", "left_anti").groupBy("pair_key").agg(F.min(F.struct("type", "a_name", "b_name")).alias("p")).select("pair_key", "p.*")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = make()
        for f in frames:
            yield pd.DataFrame({"pair_key": f["pair_key"], "same": [bool(judge.same(*x)) for x in zip(f["type"], f["a_name"], f["b_name"])]})

    told = known.withColumn("cached", F.lit(True)).unionByName(asked.mapInPandas(run, VERDICT).withColumn("cached", F.lit(False)))
    return cut(named.join(told, "pair_key").select("type", "a", "b", "pair_key", "same", "cached"))


def greedy(entities: DataFrame, links: DataFrame) -> DataFrame:
    """(entity_id, canonical_id) of entities (entity_id, place) and links (a, b) between them, in either direction.

    place: what orders them, ties by id.  In each round an entity looks at the first
    entity before it that it is linked to and that may still stand for itself: if
    none is left it stands for itself; if that one does it joins it; else it waits.
    Rounds follow the longest chain of such waits, not the number of entities.
    """
    keys = entities.select("entity_id", F.struct("place", "entity_id").alias("key"))
    ends = links.select("a", "b").where("a != b").distinct()
    both = ends.join(keys.select(F.col("entity_id").alias("a"), F.col("key").alias("ka")), "a").join(keys.select(F.col("entity_id").alias("b"), F.col("key").alias("kb")), "b")
    earlier = F.col("ka") < F.col("kb")
    open_ = cut(both.select(F.when(earlier, F.col("a")).otherwise(F.col("b")).alias("head"), F.when(earlier, F.col("ka")).otherwise(F.col("kb")).alias("key"), F.when(earlier, F.col("b")).otherwise(F.col("a")).alias("entity_id"), F.lit(False).alias("stands")).distinct())
    waiting, joined = cut(entities.select("entity_id")), []
    while open_.limit(1).count():
        best = open_.groupBy("entity_id").agg(F.min(F.struct("key", "head", "stands")).alias("m"))
        joins = cut(best.where("m.stands").select("entity_id", F.col("m.head").alias("canonical_id")))
        stands = cut(waiting.join(best, "entity_id", "left_anti"))
        joined += [joins, stands.select("entity_id", F.col("entity_id").alias("canonical_id"))]
        done = joins.select("entity_id").union(stands)
        rest = open_.join(done, "entity_id", "left_anti").join(joins.select(F.col("entity_id").alias("head")), "head", "left_anti")
        rest = rest.join(stands.select(F.col("entity_id").alias("head"), F.lit(True).alias("now")), "head", "left").select("head", "key", "entity_id", (F.col("stands") | F.coalesce("now", F.lit(False))).alias("stands"))
        left = cut(waiting.join(done, "entity_id", "left_anti"))
        rest = cut(rest)
        for table in (open_, waiting):
            discard(table)
        open_, waiting = rest, left
    out = waiting.select("entity_id", F.col("entity_id").alias("canonical_id"))
    for one in joined:
        out = out.unionByName(one)
    return out


def resolve_entities(entities: DataFrame, make: Callable[[], Judge], low: float = 0.75, high: float = 0.9, verdicts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(resolved, verdicts) of entities (entity_id, name, type, mention_count), an id once.

    resolved: (entity_id, canonical_id); entities come in order of their mentions, most
    first, then of their ids.  Names that are empty once normalized join nothing.
    verdicts: (pair_key, same), those to add to the cache.
    """
    pairs = cut(similar_pairs(entities, low))
    grey = judged(pairs.where(F.col("similarity") < high), entities.select("entity_id", "name"), make, verdicts)
    links = pairs.where(F.col("similarity") >= high).select("a", "b").union(grey.where("same").select("a", "b"))
    fresh = grey.where("NOT cached").select("pair_key", "same").distinct()
    return greedy(entities.select("entity_id", (-F.col("mention_count")).alias("place")), links), fresh
