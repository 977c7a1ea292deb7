"""Golden vectors, folds against hand-made cases, and queries against DuckDB."""

import json
import os
from random import Random

import pytest
from pyspark.sql import functions as F

from kgspark.functions import ids
from kgspark.operators import chunker, export, extraction, fuzzy, graph, metrics, scoring
from kgspark.plans import ingest
from kgspark.plans.queries import ORACLE, QUERIES
from kgspark.sources import corpus

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("raw", "norm"), [("Dr. Sheldon  Cooper", "dr sheldon cooper"), ("A - B", "a  b"), ("Íñigo_Montoya's", "íñigo montoyas"), ("!!!", "")])
def test_normalize(spark, raw, norm):
    assert one(spark, ids.normalize_name(F.lit(raw))) == norm == fuzzy.normalize(raw)


def test_ids(spark):
    a, b = (one(spark, ids.entity_id(F.lit(n), F.lit(t))) for n, t in (("Sheldon Cooper", "Character"), ("Caltech", "Organization")))
    assert (a, b) == ("ent_fbf63b26fe8c2751", "ent_202e9fb13334323d")
    assert one(spark, ids.edge_id(F.lit(a), F.lit(b), F.lit("WORKS_AT"))) == "edge_9e008c672f929527"
    assert one(spark, ids.doc_id(F.lit("corpus-a/BBT/Series/Overview"))) == "doc_efaf24d478766d22"
    assert one(spark, ids.chunk_id(F.lit("doc_abc"), F.lit(0), F.lit("hello"))) == "chk_49c03a05623e55a0"


@pytest.mark.parametrize(("n", "want"), [(0, 0), (1, 1), (7, 3), (108, 31), (109, 32), (700, 201), (5246, 1499), (5250, 1501)])
def test_token_estimate(spark, n, want):
    assert chunker.tokens("x" * n) == want == one(spark, ids.token_estimate(F.lit("x" * n)))


def test_similarities():
    assert fuzzy.token_set_ratio("season 5", "season 5 finale") == 100
    assert fuzzy.token_set_ratio("season 5", "season 6") == pytest.approx(87.5)
    assert fuzzy.token_set_ratio("supplier000000000", "supplier000000001") == pytest.approx(94.12, abs=0.01)
    assert fuzzy.partial_ratio("the series", "and another, in the meantime") == pytest.approx(60.0)


def test_near_equals_partial_ratio():
    """The pruned test answers as the full measure does."""
    random = Random(5)
    word = lambda n: "".join(random.choice("abc ") for _ in range(n))
    for _ in range(1500):
        a, b = word(random.randrange(1, 12)), word(random.randrange(1, 30))
        if random.random() < 0.5:  # a text that has most of the name
            b = b[:9] + a[: len(a) // 2] + random.choice(["", "c"]) + a[len(a) // 2 :] + b[9:]
        assert fuzzy.near(a, b) == (fuzzy.partial_ratio(a, b) >= 85), (a, b)


def test_merge_keeps_types_apart():
    e = lambda n, t, d="": {"name": n, "type": t, "aliases": [], "description": d}
    kept, renamed = fuzzy.merge_entities([e("Sheldon Cooper", "Character"), e("Dr. Sheldon Cooper", "Character", "long"), e("Mercury", "Concept"), e("Mercury", "Location")])
    assert [k["name"] for k in kept] == ["Sheldon Cooper", "Mercury", "Mercury"]
    assert renamed["Dr. Sheldon Cooper"] == "Sheldon Cooper" and kept[0]["description"] == "long" and kept[0]["aliases"] == ["Dr. Sheldon Cooper"]


def test_chunker():
    assert chunker.chunk_body("d", None) == [] == chunker.chunk_body("d", "  \n ")
    long = "word " * 60
    body = f"intro {long}\n\n## One\n\n{long}\n\n### Two\n\n{long}\n\n# not a boundary\n"
    assert [c["heading"] for c in chunker.chunk_body("d", body)] == [None, "One", "Two"]
    tiny = chunker.chunk_body("d", f"## A\n\n{long}\n\n## B\n\nshort")
    assert len(tiny) == 1 and tiny[0]["text"].endswith("## B\n\nshort")
    packed = chunker.chunk_body("d", "\n\n".join([long] * 20), chunker.ChunkSettings(300, 50, 32))
    assert len(packed) > 3 and packed[1]["offset"] > 0
    with pytest.raises(ValueError):
        chunker.ChunkSettings(100, 100)


def test_metrics_on_empty_sets(spark):
    none = spark.createDataFrame([], "k int")
    assert metrics.prf(none, none, ["k"]).first().asDict() == {"precision": 0.0, "recall": 0.0, "f1": 0.0}
    assert metrics.coverage(none, none, ["k"]).first()[0] == 1.0
    with pytest.raises(ValueError):
        metrics.recall_at_k(none, 0)


def test_backend_errors_become_rows(spark):
    chunks = spark.createDataFrame([("c1", "m", "t")], "chunk_id string, message string, text string")
    cache = spark.createDataFrame([], "cache_key string, payload string")
    row = extraction.extract(chunks, cache, extraction.MockBackend, attempts=2).first()
    assert row["payload"] is None and "LookupError" in row["error"]
    with pytest.raises(ValueError):
        extraction.make_backend("unheard of")


def _answer(*names, target="Caltech", span="Sheldon works at Caltech"):
    ents = [{"name": n, "type": "Character", "aliases": ["Shelly"], "description": None} for n in names] + [{"name": "Caltech", "type": "Organization", "aliases": [], "description": "a school"}]
    return {"entities": ents, "relationships": [{"source": names[-1], "target": target, "predicate": "WORKS_AT", "evidence_span": span, "confidence": 0.9, "provenance_tag": "EXTRACTED"}]}


def test_extraction_validates_merges_and_renames(spark):
    """An invalid answer is asked for again; a cached payload that is not valid is not used."""
    wrong, right = json.dumps(_answer("Sheldon", target="Nowhere")), json.dumps(_answer("Sheldon Cooper", "Dr. Sheldon Cooper"))

    class Flaky:
        calls = 0

        def call(self, message):
            self.calls += 1
            return {"payload": wrong if self.calls == 1 else right, "input_tokens": 10, "output_tokens": 5, "cost_usd": 0.5}

    chunks = spark.createDataFrame([("c1", "m", "t", "d1", 0)], "chunk_id string, message string, text string, doc_id string, chunk_ord int").coalesce(1)
    key = one(spark, ids.cache_key(F.lit("v0"), F.lit("t")))
    cache = spark.createDataFrame([(key, wrong), (key, "not json"), (key, "{}")], "cache_key string, payload string")
    out = extraction.extract(chunks, cache, Flaky)
    row = out.first()
    assert not row["cached"] and row["error"] is None
    got = json.loads(row["payload"])
    assert [e["name"] for e in got["entities"]] == ["Sheldon Cooper", "Caltech"] and got["relationships"][0]["source"] == "Sheldon Cooper"
    again = extraction.extract(chunks, extraction.fresh_entries(out), extraction.MockBackend).first()
    assert again["cached"] and json.loads(again["payload"]) == got
    ents, rels = extraction.facts(out, chunks)
    assert {(r["name"], r["type"]) for r in ents.collect()} == {("Sheldon Cooper", "Character"), ("Caltech", "Organization")}
    rel = rels.first()
    assert (rel["source_type"], rel["target_type"], rel["source_aliases"]) == ("Character", "Organization", ["Dr. Sheldon Cooper", "Shelly"])
    assert rel["source_id"] == one(spark, ids.entity_id(F.lit("Sheldon Cooper"), F.lit("Character")))


@pytest.mark.parametrize(("span", "chunk", "in_span", "in_chunk"), [
    ("Sheldon Cooper is at Caltech", None, True, True),  # whole names
    ("Shelly is at Caltech", None, True, True),  # an alias
    ("young sheldon is at Caltech", None, True, True),  # a word of the name
    ("xSheldonCooperx is at Caltech", None, True, True),  # nearly the name
    ("he is there", "Sheldon Cooper is at Caltech", False, True),
    ("he is at Caltech", "nobody is at Caltech", False, False),
    (None, None, False, False),
])
def test_grounding_takes_aliases_words_and_near_names(spark, span, chunk, in_span, in_chunk):
    kind = "source string, target string, predicate string, evidence_span string, chunk_text string, type_ok boolean, source_aliases array<string>"
    row = scoring.score(spark.createDataFrame([("Sheldon Cooper", "Caltech", "WORKS_AT", span, chunk, True, ["Shelly", " ", None])], kind)).first()
    assert (row["span_grounded"], row["chunk_grounded"]) == (in_span, in_chunk)
    assert bool(row["flags"]) != in_chunk and all("source 'Sheldon Cooper'" in f for f in row["flags"])


def test_ingest_report(spark, tmp_path):
    """A run, then one over its cache: nothing is asked again; a broken signature and a failed chunk are reported."""
    docs = spark.createDataFrame(
        [("d1", "c/A", "## A\n\nPerson:Ann -WORKS_AT-> Organization:Acme\nPerson:Ann -AUTHORED-> Location:Rome"), ("d2", "c/B", "## B\n\nPerson:Ann -WORKS_AT-> Organization:Acme"), ("d3", "c/C", " "), ("d4", "c/D", "## D\n\n:x -WORKS_AT-> Organization:y")],
        "doc_id string, canonical_path string, body string",
    )
    n = docs.agg(F.count("*").alias("docs_canonicalized")).withColumn("docs_failed", F.lit(1))
    run = ingest.ingest(docs, ingest.RuleBackend, attempts=2)
    got = ingest.report(run, n).first()
    assert (got["chunks_total"], got["chunks_extracted"], got["chunks_failed"], got["chunks_cache_hits"]) == (3, 2, 1, 0)
    assert (got["entities_created"], got["mentions_created"], got["relationships_created"], got["relationships_updated"]) == (3, 5, 2, 1)
    assert got["flagged_count"] == 1 and got["flagged_examples"] == ["type-violation[AUTHORED]: (Person -> Location)"] and got["predicate_type_ok_rate"] == pytest.approx(2 / 3, abs=1e-6)
    again = ingest.report(ingest.ingest(docs, ingest.RuleBackend, run.cache, attempts=1), n).first()
    assert (again["chunks_cache_hits"], again["chunks_extracted"], again["cost_input_tokens"], again["entities_created"]) == (2, 0, 10, 3)  # the failed chunk is asked again
    ingest.write_report(ingest.report(run, n), str(tmp_path / "runs"), "r1", "v0")
    assert spark.read.json(str(tmp_path / "runs" / "r1")).first()["chunks_total"] == 3
    empty = ingest.report(ingest.ingest(docs.limit(0), ingest.RuleBackend), n).first()
    assert (empty["chunks_total"], empty["evidence_grounding_rate"], empty["flagged_examples"]) == (0, 1.0, [])


def test_tool_definition_names_what_is_validated():
    tool = extraction.tool_definition()
    fields = {k: v["items"] for k, v in tool["input_schema"]["properties"].items()}
    answer = _answer("Sheldon")
    for kind, rows in answer.items():
        assert all(set(fields[kind]["required"]) <= set(r) <= set(fields[kind]["properties"]) for r in rows)
    assert extraction.problems_of(answer) == []
    assert set(fields["entities"]["properties"]["type"]["enum"]) >= {"Character", "Organization"}
    call = extraction.as_function_call(tool)
    assert call["type"] == "function" and call["function"]["parameters"] is tool["input_schema"]


def test_canonicalize_routes_errors(spark, tmp_path):
    (tmp_path / "BBT__Series__Overview.md").write_text("---\ntitle: T\ntags: [' a ', a, '']\nupdated: 2026-04-27\n---\n\nBody\n")
    (tmp_path / "Foo____Bar.md").write_text("body")
    (tmp_path / "Blank__One.md").write_text("  \n")
    docs, errors = corpus.canonicalize(corpus.read_markdown(spark, [(str(tmp_path), "corpus-a", "flat")]), "2026-01-01")
    row = docs.first()
    assert row["doc_id"] == "doc_efaf24d478766d22" and row["tags"] == ["a"] and row["parent"] == "[[corpus-a/BBT/Series]]" and str(row["updated"]) == "2026-04-27"
    assert {r["rel"]: r["message"] for r in errors.collect()} == {"Foo____Bar.md": "empty path segment", "Blank__One.md": "empty body"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["doc_ids", "nested_segments", "entity_ids", "md_sections", "graph_entities", "builder_stats", "halluc_report", "prf1_overall", "ndcg_at_k", "neighbors_both", "manifest_diff", "graph_merge", "cache_hits", "gate_regression_strict"])
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(frame):
        return sorted(tuple(round(float(v), 5) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))

    assert rows(got) == rows(want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_names_are_normalized_to_the_end_of_the_text(spark):
    import duckdb

    # the query's own SQL cuts the texts; here it takes them whole
    sql = ORACLE["normalize_names"].replace("FROM documents", f"FROM '{SF}/documents.parquet'")
    want = dict(duckdb.sql(sql).fetchall())
    assert {r["doc_id"]: r["norm"] for r in QUERIES["normalize_names"](spark, SF).collect()} == want


def _small_graph(spark, name, spans):
    ents = [("a", name, ["x"], "first", "d1", 1), ("a", name, ["y", "x"], "second", "d2", 2), ("b", "B", [], None, "d1", 3)]
    facts = spark.createDataFrame([(i, n, "Work", al, de, d, o) for i, n, al, de, d, o in ents], "entity_id string, name string, type string, aliases array<string>, description string, doc_id string, ord int")
    facts = facts.withColumn("entity_id", ids.entity_id(F.col("name"), F.col("type")))
    rels = spark.createDataFrame([(d, s, o) for o, (d, s) in enumerate(spans)], "doc_id string, evidence_span string, ord int")
    ends = {"source_id": ids.entity_id(F.lit(name), F.lit("Work")), "target_id": ids.entity_id(F.lit("B"), F.lit("Work")), "predicate": F.lit("P"), "provenance_tag": F.lit("INFERRED"), "confidence": F.lit(0.7)}
    rels = rels.withColumns(ends).withColumn("edge_id", ids.edge_id(F.col("source_id"), F.col("target_id"), F.col("predicate")))
    return (graph.entities(facts), graph.edges(rels)), graph.edge_documents(rels), graph.edge_spans(rels)


def test_graphs_keep_descriptions_aliases_documents_and_spans(spark, tmp_path):
    one, docs1, spans1 = _small_graph(spark, "A", [("d2", "s2"), ("d1", "s1"), ("d1", "s2"), ("d3", None)])
    two, docs2, spans2 = _small_graph(spark, "a!", [("d9", "s1"), ("d1", "s9")])
    assert [r["evidence_span"] for r in spans1.orderBy("ord").collect()] == ["s2", "s1"]
    nodes, edges = graph.merge([one, two])
    a = nodes.where("name = 'A'").first()
    assert (a["description"], a["aliases"], a["first_seen_doc"], a["n_graphs"]) == ("first", ["x", "A", "y", "a!"], "d1", 2)
    edge = edges.collect()
    assert [(e["provenance_tag"], e["n_facts"]) for e in edge] == [("INFERRED", 6)]
    documents, spans = graph.merge_sources([one, two], [docs1, docs2], "doc_id"), graph.merge_sources([one, two], [spans1, spans2], "evidence_span")
    assert [(r["edge_id"], r["doc_id"]) for r in documents.orderBy("g", "ord").collect()] == [(edge[0]["edge_id"], d) for d in ("d2", "d1", "d3", "d9")]
    assert [r["evidence_span"] for r in spans.orderBy("g", "ord").collect()] == ["s2", "s1", "s9"]
    export.write_graph(nodes, edges, str(tmp_path), {}, documents, spans)
    written = {n: [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / n)).collect()] for n in ("nodes", "edge_documents", "edge_spans")}
    assert {n["properties"]["name"]: n["properties"]["aliases"] for n in written["nodes"]}["A"] == ["x", "A", "y", "a!"]
    assert {r["doc_id"] for r in written["edge_documents"]} == {"d1", "d2", "d3", "d9"} and {r["evidence_span"] for r in written["edge_spans"]} == {"s1", "s2", "s9"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["edge_spans", "export_nodes", "export_edge_rows", "export_edges", "graph_edges"])
def test_graph_tables_match_sql(spark, name):
    test_queries_match_sql(spark, name)


def test_normalized_names_are_the_same_in_spark_and_python(spark):
    """Over every code point that both Unicode versions assign; see the README for the others."""
    names = [f"a{chr(c)}b" for c in [*range(1, 0x0870), 0x0301, 0x094D, 0x00B2, *range(0x2000, 0x2C00), *range(0x3040, 0x3100)]]
    got = spark.createDataFrame([(n,) for n in names], "name string").select("name", ids.normalize_name(F.col("name")).alias("norm")).collect()
    assert not [r["name"] for r in got if r["norm"] != fuzzy.normalize(r["name"])]
