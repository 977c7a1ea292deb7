"""Keys of sets of trigrams: similar sets share one, and few others do."""

import random

from pyspark.sql import functions as F

from kgspark.operators import resolution


def test_similar_sets_share_a_key(spark):
    rng, least = random.Random(4), 0.75
    sets = []
    for i in range(60):
        base = rng.sample(range(60), rng.choice((1, 2, 3, 4, 5, 9, 15, 22, 24, 25, 31, 33, 40)))
        sets += [sorted(base), sorted(base[: max(1, len(base) * 9 // 10)]), sorted({*base, *rng.sample(range(60), 1 + len(base) // 8)})]
    rows = spark.createDataFrame(list(enumerate(sets)), "i int, g array<bigint>").repartition(4)
    keys = {r["i"]: set(r["k"]) for r in rows.select("i", resolution._keys(F.col("g"), F.size("g"), least).alias("k")).collect()}
    near = [(i, j) for i in range(len(sets)) for j in range(i) if len({*sets[i]} & {*sets[j]}) >= least * len({*sets[i]} | {*sets[j]})]
    assert len(near) > 100 and all(keys[i] & keys[j] for i, j in near)
    # fifteen grams of which a single one is common are not compared
    one = spark.createDataFrame([(0, list(range(15))), (1, [0, *range(100, 114)])], "i int, g array<bigint>")
    got = [set(r["k"]) for r in one.select(resolution._keys(F.col("g"), F.size("g"), least).alias("k")).collect()]
    assert not got[0] & got[1]


def test_names_of_middle_length_are_not_joined_by_single_grams(spark):
    least, rng = 0.75, random.Random(5)
    for n in (19, 22):  # before, sets of over 18 grams had a key for each single gram of their prefix
        one = spark.createDataFrame([(0, list(range(n))), (1, [0, 1, *range(100, 98 + n)])], "i int, g array<bigint>")
        got = [set(r["k"]) for r in one.select(resolution._keys(F.col("g"), F.size("g"), least).alias("k")).collect()]
        assert got[0] and not got[0] & got[1]
    # equal sizes need no more keys than equal sizes do: 15 choices of four, and 35 and 5 of three for others (before, 70 of four)
    n16 = spark.createDataFrame([(rng.sample(range(99), 16),)], "g array<bigint>").select(F.size(resolution._keys(F.col("g"), F.size("g"), least)).alias("k"))
    assert n16.first()["k"] <= 55
