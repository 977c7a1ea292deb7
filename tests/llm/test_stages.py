"""Stages over repeated and missing ids, side by side, and personal data in texts made to stall a search."""

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from kgspark.llm import op4_pii as op4
from kgspark.llm import stages

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS).repartition(3)


def texts(docs):
    return sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)


def test_rows_that_share_an_id_or_have_none_go_for_their_own_text_only(spark, tmp_path):
    rng = random.Random(1)
    own = [prose(rng, 60) for _ in range(7)]
    rows = [(i, t, "s") for i, t in zip([None, None, None, None, 7, 7, 8], own)]
    assert texts(stages.near_duplicates(spark, table(spark, rows), "")) == texts(table(spark, rows))
    near = own[0].split()
    near[30] = "changed"
    more = [(7, own[4], "s"), (9, " ".join(near), "s"), (3, own[6], "s"), (None, None, "s"), (None, None, "s"), (5, "", "s"), (5, "", "s")]
    got = texts(stages.near_duplicates(spark, table(spark, rows + more), ""))
    # equal rows leave one; of near ones that with an id stays, of equal ones the smaller id; texts without words are no copies
    gone = [(None, own[0]), (8, own[6])]
    want = [(i, t) for i, t, _ in rows if (i, t) not in gone] + [(9, " ".join(near)), (3, own[6]), (None, None), (None, None), (5, ""), (5, "")]
    assert got == sorted(want, key=str)
    spark.createDataFrame([(1, own[4])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leaks = rows + [(None, prose(rng, 20) + " " + own[4], "s")]
    assert texts(stages.decontaminated(spark, table(spark, leaks), str(tmp_path))) == sorted(((i, t) for i, t, _ in rows if t != own[4]), key=str)


def folders(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    made = f"{base}/kgspark"
    return set(os.listdir(made)) if os.path.isdir(made) else set()


def test_stages_side_by_side(spark, tmp_path):
    rng = random.Random(2)
    one, two = (table(spark, [(i, prose(rng, 40), f"s{i % 3}") for i in range(n)]) for n in (12, 9))
    spark.createDataFrame([(1, prose(rng, 30))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    a, b = stages.rules(spark, one, ""), stages.rules(spark, two, "")
    c = stages.rules(spark, one, "").where("doc_id < 5")  # only a plan over the result is kept
    assert (a.count(), b.count(), c.count()) == (12, 9, 5)
    composed = stages.sharded(spark, stages.mixed(spark, stages.decontaminated(spark, stages.near_duplicates(spark, a, ""), str(tmp_path)), ""), "")
    assert composed.select("doc_id").distinct().count() > 6 and b.count() == 9
    assert stages.near_duplicates(spark, two, "").count() == 9


def test_tables_go_when_nothing_reads_them(spark):
    rng = random.Random(3)
    docs = table(spark, [(i, prose(rng, 40), f"s{i % 3}") for i in range(12)])
    before = folders(spark)
    a = stages.rules(spark, docs, "")
    left = folders(spark) - before
    assert left and a.count() == 12
    stages._left.sweep()
    assert left & folders(spark) and a.count() == 12
    del a
    for _ in range(5):  # objects that Python has let go reach the JVM a little later
        time.sleep(0.2)
        stages._left.sweep()
    assert not {f.rpartition("/")[2] for _, f, _ in stages._left._tables} & left


_SPELT = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]|\x20?(?i:\(dot\)|\[dot\]|\bdot\b)\x20?)*\x20?\Z")


def test_local_parts_are_those_of_the_pattern():
    rng = random.Random(4)
    parts = ["a", "dot", " dot ", "(dot)", "[dot]", " ", "  ", ".", "-", "DOT", "x1", "(", "[", ")", " (dot) ", "é", "\n", "dots", "_dot_"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9))) + rng.choice(["@", "at@", " @"])
        m = _SPELT.search(text, max(0, len(text) - 97), len(text) - 1)
        assert op4.local_start(text, len(text) - 1) == (m.start() if m else None), text


@pytest.fixture(scope="module")
def judge():
    return op4.train(examples=300)


@pytest.mark.parametrize("text", ["a" + " dot" * 25_000 + "!@x.com", "a" + " dot" * 25_000 + " at x dot com", "a" + " dot" * 18 + "!@x.com ", "1" * 100_000, "a dot " * 16_000 + "@", "@" * 100_000, " at " * 25_000, "+1(" * 33_000, "a1" * 50_000, "a@b." * 25_000, "x" * 100_000])
def test_texts_made_to_stall(judge, text):
    """Time grows with the text: ten times as much takes about ten times as long."""
    took = []
    for times in (1, 10):
        start = time.perf_counter()
        base = op4.base_spans(text * times)
        op4.find_spans(text * times, base, *judge)
        took.append(time.perf_counter() - start)
    assert took[1] < 30 * took[0] + 2


def test_dense_digit_groups_stay_linear(judge):
    took = []
    for n in (1000, 4000):
        start = time.perf_counter()
        op4.find_spans("1 (" * n, [], *judge)
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * took[0] + 1
