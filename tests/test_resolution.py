"""Entity resolution against all pairs and a plain greedy pass."""

import itertools
import random

import pytest

from kgspark.operators import fuzzy, resolution


def grams(name):
    norm = fuzzy.normalize(name)
    padded = f" {norm} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)} if norm else set()


def some_entities(seed, n=70):
    rng = random.Random(seed)
    stems = ["Supplier 10", "Supplier 11", "red house", "red houses", "the red house", "Blue Boat", "blue_boat!", "x", "!!", "", "漢字 社", "漢字社"]
    rows = {}
    for i in range(n):
        name = rng.choice(stems) + rng.choice(["", "", str(rng.randrange(30)), " Ltd", "s", "."])
        rows[f"e{i:03}"] = (f"e{i:03}", name, rng.choice("AB"), rng.randrange(1, 5))
    return list(rows.values())


def close(a, b):
    x, y = grams(a), grams(b)
    return round(len(x & y) / len(x | y), 6) if x and y else 0.0


@pytest.mark.parametrize(("seed", "least"), [(1, 0.5), (2, 0.75)])
def test_similar_pairs(spark, seed, least):
    rows = some_entities(seed)
    got = resolution.similar_pairs(spark.createDataFrame(rows, "entity_id string, name string, type string, mention_count long"), least)
    want = {(a[2], a[0], b[0], close(a[1], b[1])) for a, b in itertools.combinations(sorted(rows), 2) if a[2] == b[2] and close(a[1], b[1]) >= least}
    assert len(want) > 20 and {tuple(r) for r in got.collect()} == want


def plain_greedy(order, linked):
    stands, out = [], {}
    for e in order:
        out[e] = next((s for s in stands if frozenset((e, s)) in linked), e)
        if out[e] == e:
            stands.append(e)
    return out


def test_greedy_follows_the_order(spark):
    for seed in (3, 4):
        rng = random.Random(seed)
        ids = [f"n{i:02}" for i in range(40)]
        place = {i: rng.randrange(6) for i in ids}
        pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(60)] + [(ids[i], ids[i + 1]) for i in range(20, 30)]
        got = resolution.greedy(spark.createDataFrame(list(place.items()), "entity_id string, place int"), spark.createDataFrame(pairs, "a string, b string"))
        want = plain_greedy(sorted(ids, key=lambda i: (place[i], i)), {frozenset(p) for p in pairs if p[0] != p[1]})
        assert {r["entity_id"]: r["canonical_id"] for r in got.collect()} == want


def test_the_grey_band_is_judged_once_for_each_pair_of_names(spark, tmp_path):
    log = str(tmp_path / "asked")

    class Logging(resolution.SameDigits):
        def same(self, kind, a, b):
            with open(log, "a") as f:
                f.write(f"{kind}|{a}|{b}\n")
            return [c for c in a if c.isdigit()] == [c for c in b if c.isdigit()]

    rows = some_entities(5)
    entities = spark.createDataFrame(rows, "entity_id string, name string, type string, mention_count long")
    resolved, fresh = resolution.resolve_entities(entities, Logging, 0.6, 0.9)
    linked, names = set(), {}
    for a, b in itertools.combinations(sorted(rows), 2):
        near = close(a[1], b[1]) if a[2] == b[2] else 0
        digits = [[c for c in x if c.isdigit()] for x in (a[1], b[1])]
        if near >= 0.9 or near >= 0.6 and digits[0] == digits[1]:
            linked.add(frozenset((a[0], b[0])))
        if 0.6 <= near < 0.9:
            names[f"{a[2]}|{a[1]}|{b[1]}"] = 1
    want = plain_greedy([r[0] for r in sorted(rows, key=lambda r: (-r[3], r[0]))], linked)
    assert {r["entity_id"]: r["canonical_id"] for r in resolved.collect()} == want and len(set(want.values())) < len(want)
    asked = open(log).read().split("\n")[:-1]
    assert sorted(asked) == sorted(names) and fresh.count() == len(names)
    again, more = resolution.resolve_entities(entities, Logging, 0.6, 0.9, fresh)
    assert {r["entity_id"]: r["canonical_id"] for r in again.collect()} == want
    assert more.count() == 0 and len(open(log).read().split("\n")[:-1]) == len(asked)  # all verdicts came from the cache
