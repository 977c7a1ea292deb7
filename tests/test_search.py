"""Embeddings, the vector index, subgraphs, paths, stored versions and arrivals against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgspark.operators import embedding, graph, search, vector
from kgspark.operators.vector_index import IndexSettings, VectorIndex
from kgspark.sources import graph_store
from kgspark.streaming import arrivals

# --- embeddings ------------------------------------------------------------------


def test_each_distinct_text_is_embedded_once(spark):
    class Counting(embedding.HashingEmbedder):
        """Each text's vector also has the size of the call that it was in."""

        def embed(self, texts):
            return np.column_stack([embedding.HashingEmbedder.embed(self, texts), np.full(len(texts), len(texts))])

    rows = [(1, "alpha beta"), (2, "alpha beta"), (3, None), (4, ""), (5, "gamma gamma"), (5, "gamma gamma")]
    chunks = spark.createDataFrame(rows, "chunk_id int, text string")
    first = embedding.embed(chunks, lambda: embedding.HashingEmbedder(8))
    got = {(r["chunk_id"], r["cached"]): r["embedding"] for r in first.collect()}
    assert first.count() == 6 and got[1, False] == got[2, False] and set(got[3, False]) == {0.0}
    assert np.isclose(np.linalg.norm(got[5, False]), 1)
    again = embedding.embed(chunks, lambda: embedding.HashingEmbedder(8), first.select("cache_key", "embedding").where("chunk_id < 5"))
    assert {(r["chunk_id"], r["cached"]) for r in again.collect()} == {(1, True), (2, True), (3, True), (4, True), (5, False)}
    other = embedding.embed(chunks, lambda: embedding.HashingEmbedder(9), first.select("cache_key", "embedding"))
    assert not any(r["cached"] for r in other.collect())  # another model's vectors are no answer
    sizes = embedding.embed(spark.range(10).select(F.col("id").alias("chunk_id"), F.col("id").cast("string").alias("text")).coalesce(1), lambda: Counting(4), batch=4)
    assert max(r["embedding"][-1] for r in sizes.collect()) <= 4
    with pytest.raises(ValueError):
        embedding.make_embedder("none")
    assert embedding.make_embedder(" HASH ", size=3).size == 3


# --- the vector index --------------------------------------------------------------


def recall(found, exact):
    a, b = ({(r["query"], r["id"]) for r in x.collect()} for x in (found, exact))
    return len(a & b) / len(b)


@pytest.mark.parametrize("shape", ["even", "clustered"])
def test_the_index_finds_the_nearest(spark, tmp_path, shape):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24))
    if shape == "clustered":
        x = x * 0.3 + rng.normal(size=(12, 24))[rng.integers(0, 12, 3000)]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<float>").repartition(4)
    asked = vectors.where("id % 100 = 0").select(F.col("id").alias("query"), "embedding")
    index = VectorIndex.build(vectors, f"{tmp_path}/index", IndexSettings(cells=40, most_sample=1500, parts=8))
    exact = vector.top_k(vectors, asked, 10)
    found = index.search(asked, 10, block=7)
    assert recall(found, exact) >= 0.9
    scores = {(r["query"], r["id"]): r["score"] for r in exact.collect()}
    told = [(r, scores[r["query"], r["id"]]) for r in found.collect() if (r["query"], r["id"]) in scores]
    assert all(abs(r["score"] - s) < 2e-6 for r, s in told)  # codes only choose: scores are those of the whole vectors
    assert sorted(r["id"] for r in index.rows().collect()) == list(range(3000))
    if shape == "clustered":
        assert index.quantizer.probes < 20
        plan = index.candidates(asked.limit(1), 10)._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
        assert "ReadSchema: struct<id:bigint,code:binary>" in plan  # whole vectors are not scanned
        few = index.candidates(asked, 10).count()
        assert few < 30 * 3000 / 8


def test_the_index_is_opened_again_and_grows(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 10))
    rows = [(f"v{i}", v.tolist()) for i, v in enumerate(x)] + [("none", None), ("zero", [0.0] * 10), ("v3", x[3].tolist())]
    vectors = spark.createDataFrame(rows, "id string, embedding array<double>")
    VectorIndex.build(vectors, f"{tmp_path}/index", IndexSettings(cells=5, parts=3))
    index = VectorIndex.open(spark, f"{tmp_path}/index")
    assert index.rows().count() == 202  # all but the row without a vector; the repeated id twice
    asked = spark.createDataFrame([("q", x[3].tolist())], "query string, embedding array<double>")
    assert [(r["id"], r["score"]) for r in index.search(asked, 2).orderBy("rank").collect()] == [("v3", 1.0), ("v3", 1.0)]
    index.add(spark.createDataFrame([("new", (x[3] * 5).tolist())], "id string, embedding array<double>"))
    assert {r["id"] for r in index.search(asked, 3).collect()} == {"v3", "new"}
    assert index.search(asked.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        VectorIndex.build(vectors.where("id = 'none'"), f"{tmp_path}/empty")


# --- subgraphs and paths -------------------------------------------------------------


def some_graph(seed, n=40, m=70):
    rng = random.Random(seed)
    rows = {(f"e{i}", f"n{a:02}", f"n{b:02}", rng.choice("PQR"), rng.choice([0.5, 0.8, 1.0])) for i, (a, b) in enumerate((rng.randrange(n), rng.randrange(n)) for _ in range(m))}
    return sorted(rows)


_EDGE = "edge_id string, source_id string, target_id string, predicate string, confidence double"


def dense_pagerank(rows, start, rounds, damping=0.85):
    ids = sorted({x for r in rows for x in r[1:3]} | set(start))
    at = {x: i for i, x in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for _, a, b, _, c in rows:
        w[at[a], at[b]] += c
        w[at[b], at[a]] += c
    for x in start:
        if not w[at[x]].any():
            w[at[x], at[x]] = 1
    p = w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300)
    s = np.zeros(len(ids))
    for x, v in start.items():
        s[at[x]] = v / sum(start.values())
    r = s.copy()
    for _ in range(rounds):
        r = damping * (r @ p) + (1 - damping) * s
    return {x: r[at[x]] for x in ids if r[at[x]] > 0}


def test_pagerank_against_a_dense_matrix(spark):
    rows = some_graph(1)
    start = {"n01": 2.0, "n07": 1.0, "lone": 0.5}
    got = search.personalized_pagerank(spark.createDataFrame(rows, _EDGE), spark.createDataFrame(list(start.items()), "entity_id string, score double"), rounds=7)
    got = {r["entity_id"]: r["rank"] for r in got.collect()}
    want = dense_pagerank(rows, start, 7)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    assert abs(sum(got.values()) - 1) < 1e-9


def test_query_graph(spark):
    rows = some_graph(2)
    ids = sorted({x for r in rows for x in r[1:3]})
    names = {x: f"{['Red', 'Blue', 'Green'][i % 3]} {['House', 'Boat'][i % 2]} {x}" for i, x in enumerate(ids)}
    nodes = spark.createDataFrame([(x, names[x], "Work", [f"the {names[x].split()[0]} one"]) for x in ids], "entity_id string, name string, type string, aliases array<string>")
    edges = spark.createDataFrame(rows, _EDGE)
    sources = spark.createDataFrame([(r[0], f"d{k}", k) for r in rows for k in range(4)], "edge_id string, doc_id string, ord int")
    question = f"Where is the BLUE boat, {ids[4]}?"
    sub = search.query_graph(nodes, edges, question, max_hops=1, top=3, rounds=5, sources=sources, shown=2)
    words = {x: set(names[x].lower().split()) | {"the", "one"} for x in ids}
    df = lambda t: sum(t in w for w in words.values())
    asked = {"where", "is", "the", "blue", "boat", ids[4]}
    score = {x: (round(sum(round(np.log(1 + len(ids) / df(t)), 6) for t in words[x] & asked), 6), len(words[x] & asked)) for x in ids if words[x] & asked}
    best = sorted(score, key=lambda x: (-score[x][0], x))[:3]
    assert {(r["entity_id"], r["score"], r["matched"]) for r in sub.seeds.collect()} == {(x, *score[x]) for x in best}
    near = {x: 0 for x in best}
    for _, a, b, _, _ in rows:
        for x, y in ((a, b), (b, a)):
            if x in best:
                near.setdefault(y, 1)
    inside = [r for r in rows if r[1] in near and r[2] in near]
    rank = dense_pagerank(inside, {x: score[x][0] for x in best}, 5)
    assert {r["entity_id"]: r["distance"] for r in sub.nodes.collect()} == near
    assert all(abs(r["rank"] - rank[r["entity_id"]]) < 1e-9 for r in sub.nodes.collect())
    assert {(r["edge_id"], *r["source_doc_ids"]) for r in sub.edges.collect()} == {(r[0], "d0", "d1") for r in inside}
    assert search.query_graph(nodes, edges, "nothing known", 1, rounds=1).nodes.count() == 0


def first_shortest(rows, a, b, most):
    ways = {}
    for _, x, y, _, _ in rows:
        ways.setdefault(x, set()).add(y)
        ways.setdefault(y, set()).add(x)
    for n in range(most + 1):
        found, frontier = [], [(a,)]
        for _ in range(n):
            frontier = [p + (y,) for p in frontier for y in ways.get(p[-1], ()) if y not in p]
        found = [p for p in frontier if p[-1] == b and p[0] in ways]
        if found:
            return min(found)
    return ()


@pytest.mark.parametrize(("seed", "ends"), [(3, ("n00", "n01")), (4, ("n02", "n30")), (5, ("n11", "n12"))])
def test_shortest_path(spark, seed, ends):
    rows = some_graph(seed, 30, 42)
    edges = spark.createDataFrame(rows, _EDGE)
    for most in (2, 6):
        want = first_shortest(rows, *ends, most)
        got = search.shortest_path(edges, *ends, most).orderBy("step").collect()
        assert tuple(r["entity_id"] for r in got) == want
        for x, r in zip(want, got[1:]):
            both = [(p, e, d, c) for e, a, b, p, c in rows for d, (s, t) in (("out", (a, b)), ("in", (b, a))) if (s, t) == (x, r["entity_id"])]
            assert (r["predicate"], r["edge_id"], r["direction"], r["confidence"]) == min(both)


def test_paths_at_the_edges(spark):
    rows = [("e1", "a", "b", "P", 1.0), ("e2", "c", "d", "P", 1.0), ("e3", "b", "b", "Q", 1.0)]
    edges = spark.createDataFrame(rows, _EDGE)
    assert search.shortest_path(edges, "a", "d").count() == 0 and search.shortest_path(edges, "a", "x").count() == 0
    assert [(r["step"], r["entity_id"], r["edge_id"]) for r in search.shortest_path(edges, "b", "b").collect()] == [(0, "b", None)]
    assert search.shortest_path(edges, "x", "x").count() == 0
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "entity_id string")
    assert [r["distance"] for r in graph.shortest_path_length(edges, ids("a"), ids("b"), 3).collect()] == [1]
    assert graph.shortest_path_length(edges, ids("a"), ids("d"), 3).count() == 0
    assert {(r["entity_id"], r["distance"]) for r in graph.k_hop(edges, ids("a", "c"), 2).collect()} == {("a", 0), ("c", 0), ("b", 1), ("d", 1)}


# --- what is kept up to date -----------------------------------------------------------


def test_maintained_tables_equal_a_rebuild(spark):
    rng = random.Random(6)
    fact = lambda d, k: (f"d{d}", rng.choice("abcde"), rng.choice("abcde"), rng.choice("PQ"), rng.choice(["EXTRACTED", "INFERRED"]), rng.random(), (d, k))
    kind = "doc_id string, source_id string, target_id string, predicate string, provenance_tag string, confidence double, ord struct<d: int, k: int>"
    facts = spark.createDataFrame([fact(d, k) for d in range(12) for k in range(4)], kind)
    changed = spark.createDataFrame([("d2",), ("d3",), ("d20",), ("d2",)], "doc_id string")  # d3 is deleted, d20 is new
    fresh = spark.createDataFrame([fact(d, k) for d in (2, 20) for k in range(3)], kind)
    got = graph.maintained(graph.edges(facts), facts, changed, fresh, graph.edges, graph.TRIPLE)
    want = graph.edges(graph.replace_documents(facts, changed, fresh))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    untouched = graph.maintained(graph.edges(facts), facts, changed.limit(0), fresh.limit(0), graph.edges, graph.TRIPLE)
    assert untouched.count() == graph.edges(facts).count()


def test_versions_are_published_at_once_or_not_at_all(spark, tmp_path):
    store = graph_store.GraphStore(spark, str(tmp_path))
    assert store.current() is None and store.versions() == []
    first = store.publish("v1", {"nodes": spark.range(5)}, {"nodes": "id"}, {"run": 1})
    assert (first.version, first.manifest["tables"], first.manifest["before"]) == ("v1", {"nodes": 5}, None)

    @F.udf("long")
    def broken(x):
        raise RuntimeError("executor lost")

    with pytest.raises(Exception):  # noqa: B017  whatever ends a write
        store.publish("v2", {"nodes": spark.range(7), "edges": spark.range(4).select(broken("id").alias("id"))})
    assert store.current().version == "v1" and store.current().table("nodes").count() == 5
    assert store.versions() == ["v1"] and "v2" in store.files.folders("versions")
    second = store.publish("v2", {"nodes": spark.range(7)})  # the same name again, now whole
    assert store.current().version == "v2" and second.manifest["before"] == "v1"
    assert first.table("nodes").count() == 5  # a reader stays with the version that it opened
    with pytest.raises(ValueError):
        store.publish("v2", {"nodes": spark.range(1)})
    with pytest.raises(ValueError):
        store.publish("../v3", {})
    with pytest.raises(KeyError):
        second.table("edges")
    assert store.roll_back("v1").version == "v1" and store.current().version == "v1"
    store.publish("v3", {"nodes": spark.range(1)})
    store.publish("v4", {"nodes": spark.range(1)})
    store.roll_back("v2")
    assert store.prune(1) == ["v1", "v3"] and store.versions() == ["v2", "v4"]
    assert store.prune(5) == [] and store.prune(0) == ["v4"]


def test_stored_neighbors_are_a_filter_of_the_scan(spark, tmp_path):
    rows = some_graph(7)
    store = graph_store.GraphStore(spark, str(tmp_path))
    snapshot = store.publish("v1", {"adjacency": graph_store.adjacency(spark.createDataFrame(rows, _EDGE))}, {"adjacency": "node_id"})
    got = graph_store.stored_neighbors(snapshot, ["n01", "n02"])
    want = {("out", a, b, e) for e, a, b, _, _ in rows if a in ("n01", "n02")} | {("in", b, a, e) for e, a, b, _, _ in rows if b in ("n01", "n02")}
    assert {(r["direction"], r["node_id"], r["other_id"], r["edge_id"]) for r in got.collect()} == want
    plan = got._jdf.queryExecution().toString()
    assert "PushedFilters: [In(node_id, [n01,n02])]" in plan and "Exchange" not in plan
    assert graph_store.stored_neighbors(snapshot, ["n01"], "out", "P").count() == sum(a == "n01" and p == "P" for _, a, _, p, _ in rows)


# --- arrivals --------------------------------------------------------------------------


def expected_statuses(rows):
    known, out = {}, []
    for path, hash_, seq in sorted(rows, key=lambda r: r[2]):
        old, version = known.get(path, (None, 0))
        status = ("absent" if hash_ is None else "unchanged") if hash_ == old else "new" if old is None else "deleted" if hash_ is None else "changed"
        known[path] = (hash_, version + (hash_ != old))
        out.append((path, seq, hash_, known[path][1], status))
    return sorted(out, key=str)


def test_arrivals_go_on_after_a_restart(spark, tmp_path):
    rng = random.Random(8)
    runs = [[(f"p{rng.randrange(12)}", rng.choice(["h1", "h2", None]), 100 * run + i) for i in range(25)] for run in range(3)]
    folder, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    seen = []
    fails = [True]

    def handle(batch, batch_id):
        seen.append((batch_id, batch.count()))
        if batch_id == 1 and fails.pop():
            fails.append(False)
            raise RuntimeError("broken off in the middle")

    for rows in runs[:2]:
        spark.createDataFrame(rows, arrivals.ARRIVAL).coalesce(1).write.mode("append").parquet(folder)
        try:
            arrivals.track(spark, folder, out, state, handle, files=1)
        except Exception:  # noqa: BLE001  the second run breaks off after it has written its batch
            arrivals.track(spark, folder, out, state, handle, files=1)
    spark.createDataFrame(runs[2], arrivals.ARRIVAL).coalesce(1).write.mode("append").parquet(folder)
    arrivals.track(spark, folder, out, state, handle, files=1)
    got = sorted((tuple(r)[:5] for r in arrivals.read_statuses(spark, out).select("path", "seq", "hash", "version", "status").collect()), key=str)
    assert got == expected_statuses(list(itertools.chain(*runs)))
    assert [b for b, _ in seen] == [0, 1, 1, 2]  # the batch that was broken off came again, and its rows count once
