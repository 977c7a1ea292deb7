"""Facts with numbers for their ids give the graph that facts without give, narrow and without sorting."""

import pytest
from pyspark.sql import functions as F

from kgspark.functions.ids import id_number, id_of_number
from kgspark.operators import graph, rules, search

_D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    """Entity and relation facts of few names and documents, some tags null, dealt to several partitions."""
    rows = rules.payloads(spark, _D).where("doc_num < 300")
    ents = rules.entity_facts(rows).withColumn("name", F.when(F.col("at") % 3 == 0, F.concat("name", F.lit("!"))).otherwise(F.col("name"))).withColumn("aliases", F.array(F.lower("name")))
    rels = rules.relation_facts(rows).withColumn("provenance_tag", F.when(F.col("key.l_suppkey") != 3, F.col("provenance_tag")))
    return [f.repartition(3).localCheckpoint() for f in (ents, rels)]


def _same(got, want):
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))


def test_numbers_and_ids(spark):
    ids = spark.createDataFrame([("ent_0000000000000000",), ("ent_7fffffffffffffff",), ("ent_8000000000000000",), ("ent_ffffffffffffffff",)], "i string")
    got = ids.select("i", id_number(F.col("i")).alias("n")).withColumn("back", id_of_number("ent_", F.col("n"))).orderBy("n").collect()
    assert [r["i"] for r in got] == sorted(r["i"] for r in got) and all(r["i"] == r["back"] for r in got)


def test_graph_from_numbered_facts(facts):
    ents, rels = facts
    plain = ents.drop("entity_num"), rels.drop("source_num", "target_num")
    assert graph.numbered(rels, "source_num") and not graph.numbered(plain[1], "source_num")
    _same(graph.edges(rels), graph.edges(plain[1]))
    _same(graph.entities(ents), graph.entities(plain[0]))
    _same(graph.entities(ents, listed=False), graph.entities(plain[0]))
    for build, value in ((graph.edge_documents, "doc_id"), (graph.edge_spans, "evidence_span")):
        where = F.struct(F.col("ord.key.l_orderkey").alias("a"), F.col("ord.key.l_linenumber").alias("b"))
        at = F.struct(F.col("ord.doc_num").alias("a"), F.shiftright("ord.at", 32).cast("int").alias("b"))
        _same(build(rels).select("edge_id", value, at.alias("first")), build(plain[1]).select("edge_id", value, where.alias("first")))


def test_maintained_numbered_facts(facts):
    _, rels = facts
    changed = rels.where("doc_num % 3 = 0").select("doc_id", "doc_num").distinct()
    fresh = rels.where("doc_num % 3 = 0 AND key.l_linenumber != 1").withColumn("confidence", F.lit(1.0))
    got = graph.maintained(graph.packed_edges(rels), rels, changed, fresh, graph.packed_edges, graph.PACKED)
    _same(graph.unpacked(got).drop("source_num", "target_num"), graph.edges(graph.replace_documents(rels, changed, fresh).drop("source_num")))


def test_searches_by_numbers(facts):
    _, rels = facts
    by_id, by_number = graph.edges(rels).localCheckpoint(), graph.unpacked(graph.packed_edges(rels)).localCheckpoint()
    ends = [by_id.where("predicate = 'BOUGHT'").agg(f("source_id")).first()[0] for f in (F.min, F.max)]
    _same(search.shortest_path(by_number, *ends), search.shortest_path(by_id, *ends))
    seed = by_id.select(F.lit(ends[0]).alias("entity_id")).limit(1)
    _same(graph.k_hop(by_number, seed, 2), graph.k_hop(by_id, seed, 2))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_added_up_without_sorting(spark):
    """What no query reads is not carried, and sums need no sorting of facts."""
    rows = rules.payloads(spark, _D)
    logical, physical = _plan(graph.edges(rules.relation_facts(rows)))
    assert "SortAggregate" not in physical
    assert "doc_id" not in logical and "chunk_id" not in logical
    _, physical = _plan(graph.packed_edges(rules.relation_facts(rows)))
    # by document nothing moves: the facts lie by document, so one exchange follows them
    assert physical.count("hashpartitioning(source_num") == 1 and "hashpartitioning(doc_num" not in physical


def _moves(df):
    """Shuffles in a plan that adaptive execution has not changed yet."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_facts_that_lie_by_document_are_resolved_where_they_lie(spark):
    surfaces = spark.createDataFrame([(1, "a", "x", 7, 0), (1, "a", "x", 8, 1), (1, "a", "y", 9, 2), (2, "b", "x", 5, 0)], "doc_num long, chunk_id string, name string, entity_num long, ent_ord int").repartition(3, "doc_num")
    said = spark.createDataFrame([(1, "a", "x", "y", "P"), (1, "a", "x", "y", "P"), (1, "a", "x", "z", "P"), (2, "b", "y", "x", "P"), (2, "b", "x", "x", "Q"), (3, "c", None, "x", "P")], "doc_num long, chunk_id string, source string, target string, predicate string").repartition(3, "doc_num")
    found = graph.resolve(said, surfaces)
    assert sorted((r.chunk_id, r.source_num, r.target_num, r.predicate) for r in found.collect()) == [("a", 8, 9, "P"), ("a", 8, 9, "P"), ("b", 5, 5, "Q")]
    lost = graph.unresolved(said, surfaces)
    assert sorted((r.chunk_id, r.source, r.target) for r in lost.where("source IS NOT NULL").collect()) == [("a", "x", "z"), ("b", "y", "x")] and lost.count() == 3
    assert _moves(found) == 2 and _moves(lost) == 2  # the two repartitions above


def test_edges_do_not_move_to_few_nodes(spark):
    rows = [(i, j, "P") for i in range(4) for j in range(4)]
    edges = graph.unpacked(spark.createDataFrame(rows, "source_num long, target_num long, predicate string"))
    ids = graph.unpacked(spark.createDataFrame([(i, i, "P") for i in (1, 2, 2)], "source_num long, target_num long, predicate string")).select(F.col("source_id").alias("entity_id"))
    lost = graph.orphan_edges(edges, ids)
    assert sorted((r.source_num, r.target_num) for r in lost.collect()) == [(i, j) for i, j, _ in rows if not {i, j} <= {1, 2}]
    assert _moves(lost) == 0
    plain = graph.orphan_edges(edges.drop("source_num", "target_num"), ids)
    assert plain.count() == lost.count()


def test_a_line_moves_without_its_supplier(spark):
    """Suppliers' names and ids are added where a document's lines lie already."""
    plan = rules.payloads(spark, _D).select("doc_num", "s_name", "n_name", "r_name", "s_num")._jdf.queryExecution().optimizedPlan().toString()
    assert "s_name" not in plan[plan.index("RepartitionByExpression") : plan.index("p_partkey")]
