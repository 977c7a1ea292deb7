"""Queries over indexes, subgraphs, paths, and what is kept up to date, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kgspark.functions import ids, json_schema
from kgspark.operators import embedding, export, graph, resolution, search, vector_index
from kgspark.plans.queries import CHUNKS, EDGES, NODES, RELS, _AT, _seed, edge_table, ent, entity_facts, node_table, norm, query, read, relation_facts
from kgspark.plans.tables import cut, folder
from kgspark.sources import graph_schema, graph_store
from kgspark.streaming import arrivals

# --- embeddings and the vector index -------------------------------------------


@query(r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents),
f AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::UBIGINT % 64 AS place, CASE WHEN substr(md5(w), 9, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') THEN 1 ELSE -1 END AS s FROM w),
v AS (SELECT doc_id, place, sum(s)::DOUBLE AS x FROM f GROUP BY ALL), n AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM v GROUP BY doc_id)
SELECT doc_id, place::INTEGER AS place, round(x / n, 6) AS value FROM v JOIN n USING (doc_id) WHERE x <> 0""")
def text_embeddings(spark, d):
    """The non-zero entries of every document's hashed embedding; a third of the distinct texts come from the cache."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    make = embedding.HashingEmbedder
    first = embedding.embed(docs.where("chunk_id % 3 = 0"), make)
    cache = cut(first.select("cache_key", "embedding"))
    out = embedding.embed(docs, make, cache)
    return out.select(F.col("chunk_id").alias("doc_id"), F.posexplode("embedding").alias("place", "value")).where("value != 0").withColumn("value", F.round("value", 6))


def _index(spark, d) -> vector_index.VectorIndex:
    return vector_index.VectorIndex.build(read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), folder(spark))


@query(None)
def vector_index_topk(spark, d):
    """The ten nearest of every row whose id is divisible by 100, against all rows, through the index; the row itself is left out."""
    asked = read(spark, d, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), "embedding")
    found = _index(spark, d).search(asked, 11).where("query != id")
    rank = F.row_number().over(search.Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where("rank <= 10").select("query", "id", "score", F.col("rank").cast("long").alias("rank"))


@query("SELECT vec_id AS id, 1::BIGINT AS n, 16::BIGINT AS code_bytes FROM embeddings")
def vector_index_rows(spark, d):
    """Every vector is in the index once, in one cell, with a code of one byte a part."""
    return _index(spark, d).rows().groupBy("id").agg(F.count_distinct("cell").alias("n"), F.sum(F.octet_length("code")).alias("code_bytes"))


# --- questions and paths ---------------------------------------------------------

_QUESTION = "Which parts did the customers of Supplier#000000001 in AFRICA and Supplier#000000002 buy?"
_WORDS = f"(SELECT unnest(string_split({norm(chr(39) + _QUESTION + chr(39))}, ' ')) AS token)"
_SEEDS = f"""{NODES}, words AS (
  SELECT DISTINCT entity_id, token FROM (SELECT entity_id, unnest(string_split({norm('name')}, ' ')) AS token FROM nodes) WHERE token <> ''
), idf AS (SELECT token, ln(1 + (SELECT count(*) FROM nodes) / count(*)) AS idf FROM words GROUP BY token),
seeds AS (
  SELECT entity_id, round(sum(round(idf, 6)), 6) AS score, count(*) AS matched FROM words JOIN idf USING (token) WHERE token IN (SELECT token FROM {_WORDS}) GROUP BY entity_id ORDER BY score DESC, entity_id LIMIT 5
)"""


def _stored_edges(spark, d):
    """All edges as a table that holds their ids as numbers."""
    return graph.unpacked(cut(graph.packed_edges(relation_facts(spark, d))))


def _asked(spark, d, hops: int, rounds: int = 15) -> search.Subgraph:
    nodes, edges = cut(node_table(spark, d)), _stored_edges(spark, d)
    return search.query_graph(nodes, edges, _QUESTION, hops, index=cut(search.name_index(nodes)), rounds=rounds, sources=graph.edge_documents(relation_facts(spark, d)))


@query(f"WITH {_SEEDS} SELECT * FROM seeds")
def query_graph_seeds(spark, d):
    # the index reads the nodes three times
    return search.seeds(cut(search.name_index(cut(node_table(spark, d)))), _QUESTION)


@query(f"""WITH RECURSIVE {_SEEDS}, {EDGES.replace(CHUNKS + ', ', '')}, ways AS (SELECT source_id AS a, target_id AS b FROM edges UNION SELECT target_id, source_id FROM edges),
hop AS (SELECT entity_id, 0 AS d FROM seeds UNION SELECT b, d + 1 FROM hop JOIN ways ON a = entity_id WHERE d < 1), inside AS (SELECT DISTINCT entity_id FROM hop),
docs AS (SELECT edge_id, doc_id, min((k1, k2, k3, k4, o)) AS p FROM rels GROUP BY ALL), shown AS (SELECT edge_id, string_agg(doc_id, ',' ORDER BY p) AS source_doc_ids FROM (SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY p) <= 20) GROUP BY edge_id)
SELECT edge_id, source_id, target_id, predicate, confidence, provenance_tag, source_doc_ids FROM edges JOIN shown USING (edge_id) WHERE source_id IN (SELECT entity_id FROM inside) AND target_id IN (SELECT entity_id FROM inside)""")
def query_graph_edges(spark, d):
    """The subgraph within one edge of the seeds, with the edges' properties and first sources."""
    e = _asked(spark, d, 1, 1).edges
    return e.select("edge_id", "source_id", "target_id", "predicate", "confidence", "provenance_tag", F.array_join("source_doc_ids", ",").alias("source_doc_ids"))


@query(None)
def query_graph(spark, d):
    """The nodes within two edges of the seeds, ranked by a walk that restarts at these."""
    return _asked(spark, d, 2).nodes.select("entity_id", "name", "type", "distance", F.round("rank", 9).alias("rank"))


_ENDS = tuple(ent(f"'{n}'", "'Location'") for n in ("AFRICA", "ASIA"))


@query(f"""WITH RECURSIVE {EDGES}, ways AS (SELECT source_id AS a, target_id AS b FROM edges UNION SELECT target_id, source_id FROM edges),
ahead AS (SELECT {_ENDS[0]} AS id, 0 AS d UNION SELECT b, d + 1 FROM ahead JOIN ways ON a = id WHERE d < 6), back AS (SELECT {_ENDS[1]} AS id, 0 AS d UNION SELECT b, d + 1 FROM back JOIN ways ON a = id WHERE d < 6),
x AS (SELECT id, min(d) AS d FROM ahead GROUP BY id), y AS (SELECT id, min(d) AS d FROM back GROUP BY id), l AS (SELECT d AS l FROM x WHERE id = {_ENDS[1]}),
onpath AS (SELECT id, x.d FROM x JOIN y USING (id), l WHERE x.d + y.d = l), nxt AS (SELECT a, min(b) AS b FROM ways JOIN onpath p ON p.id = a JOIN onpath q ON q.id = b WHERE q.d = p.d + 1 GROUP BY a),
steps AS (SELECT 0 AS step, {_ENDS[0]} AS entity_id, NULL::VARCHAR AS before FROM l UNION ALL SELECT step + 1, b, entity_id FROM steps JOIN nxt ON a = entity_id),
told AS (SELECT step, edge_id, predicate, 'out' AS direction, confidence FROM steps JOIN edges ON source_id = before AND target_id = entity_id UNION ALL SELECT step, edge_id, predicate, 'in', confidence FROM steps JOIN edges ON target_id = before AND source_id = entity_id),
best AS (SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY step ORDER BY predicate, edge_id) = 1)
SELECT step, entity_id, edge_id, predicate, direction, confidence FROM steps LEFT JOIN best USING (step)""")
def graph_path(spark, d):
    """From one region to another over the whole graph."""
    at = spark.range(1).select(*[ids.entity_id(F.lit(n), F.lit("Location")) for n in ("AFRICA", "ASIA")]).first()
    return search.shortest_path(_stored_edges(spark, d), at[0], at[1], 6)


# --- what is kept up to date -----------------------------------------------------

# a third of the orders come again: their first lines are gone and memberships are certain
_AGAIN = f"""{RELS}, now AS (SELECT * REPLACE (CASE WHEN k1 % 3 = 0 AND predicate = 'MEMBER_OF' THEN 1.0 ELSE confidence END AS confidence, CASE WHEN k1 % 3 = 0 AND predicate = 'MEMBER_OF' THEN 'EXTRACTED' ELSE provenance_tag END AS provenance_tag) FROM rels WHERE NOT (k1 % 3 = 0 AND k2 = 1))"""


def _again(facts):
    """(documents that come again, their facts now)."""
    old = facts.where(F.col("ord.key.l_orderkey") % 3 == 0)
    now = old.where(F.col("ord.key.l_linenumber") != 1)
    if "predicate" in facts.columns:
        sure = F.col("predicate") == "MEMBER_OF"
        now = now.withColumn("confidence", F.when(sure, 1.0).otherwise(F.col("confidence"))).withColumn("provenance_tag", F.when(sure, "EXTRACTED").otherwise(F.col("provenance_tag")))
    return old.select("lot", "doc_num").distinct(), now


@query(f"""WITH {_AGAIN} SELECT edge_id, min(source_id) AS source_id, min(target_id) AS target_id, min(predicate) AS predicate, arg_min(provenance_tag, (k1, k2, k3, k4, o)) AS provenance_tag,
  round(max(confidence)::DOUBLE, 6) AS confidence, count(*) AS n_facts, count(DISTINCT doc_id) AS n_docs FROM now GROUP BY edge_id""")
def graph_delta_edges(spark, d):
    """Edges after a third of the documents changed: only what these speak of is built again, the rest is taken from the store."""
    facts = relation_facts(spark, d)
    store = graph_store.GraphStore(spark, folder(spark))
    before = store.publish("v1", {"edges": graph.packed_edges(facts)})
    changed, now = _again(facts)
    after = graph.maintained(before.table("edges"), facts, changed, now, graph.packed_edges, graph.PACKED)
    return graph.unpacked(store.publish("v2", {"edges": after}).table("edges")).drop("source_num", "target_num")


@query(f"""WITH {NODES.replace('FROM ents GROUP BY', 'FROM ents WHERE NOT (k1 % 3 = 0 AND k2 = 1) GROUP BY')} SELECT * FROM nodes""")
def graph_delta_entities(spark, d):
    facts = entity_facts(spark, d)
    changed, now = _again(facts)
    build = lambda *f: graph.entities(*f, listed=False)
    return graph.maintained(cut(build(facts)), facts, changed, now, build, ["entity_id"])


@query(f"""WITH {EDGES} SELECT {_AT} AS node_id, 'out' AS direction, target_id AS other_id, predicate, confidence FROM edges WHERE source_id = {_AT} UNION ALL SELECT {_AT}, 'in', source_id, predicate, confidence FROM edges WHERE target_id = {_AT}""")
def stored_neighbors(spark, d):
    """The edges of a node from a stored table of edge ends, sorted by node."""
    store = graph_store.GraphStore(spark, folder(spark))
    found = store.publish("v1", {"adjacency": graph_store.adjacency(graph.packed_edges(relation_facts(spark, d)))}, {"adjacency": "node_num"})
    return graph_store.stored_neighbors(found, [_seed(spark, d).first()["entity_id"]]).select("node_id", "direction", "other_id", "predicate", "confidence")


@query("""WITH a AS (SELECT doc_id AS path, sha256(text) AS h FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id AS path, sha256(CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 4 <> 0)
SELECT path::VARCHAR AS path, CASE WHEN a.h IS NULL THEN 'new' WHEN b.h IS NULL THEN 'deleted' WHEN a.h <> b.h THEN 'changed' ELSE 'unchanged' END AS status, CASE WHEN a.h IS NULL OR a.h = b.h THEN 1 ELSE 2 END AS version FROM a FULL JOIN b USING (path)""")
def arrival_statuses(spark, d):
    """Documents arrive as files, the stream ends, other files arrive, and it starts again: the statuses are those of manifest_diff."""
    docs = read(spark, d, "documents")
    base, path = folder(spark), F.col("doc_id").cast("string").alias("path")
    sent = lambda rows, hash_, seq: rows.select(path, hash_.alias("hash"), F.lit(seq).cast("long").alias("seq"))
    sent(docs.where("doc_id % 3 != 0"), F.sha2("text", 256), 1).write.mode("append").parquet(f"{base}/in")
    arrivals.track(spark, f"{base}/in", f"{base}/out", f"{base}/state")
    after = F.sha2(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256)
    gone = docs.where("doc_id % 3 != 0 AND doc_id % 4 = 0")
    sent(docs.where("doc_id % 4 != 0"), after, 2).union(sent(gone, F.lit(None).cast("string"), 2)).write.mode("append").parquet(f"{base}/in")
    arrivals.track(spark, f"{base}/in", f"{base}/out", f"{base}/state")
    return arrivals.read_statuses(spark, f"{base}/out").where("seq = 2").select("path", "status", "version")


# --- the published form ------------------------------------------------------------


@query(f"""WITH {NODES}, n AS (SELECT 'node' AS kind, entity_id AS id, right(entity_id, 1) AS x FROM nodes), {EDGES.replace(CHUNKS + ', ', '')}, e AS (SELECT 'edge' AS kind, edge_id AS id, right(edge_id, 1) AS x FROM edges),
r AS (SELECT * FROM (VALUES ('node', '0', '/id', 'pattern'), ('node', '1', '/type', 'enum'), ('node', '2', '/colour', 'additionalProperties'), ('node', '3', '/properties', 'oneOf'), ('node', '4', '/properties', 'oneOf'), ('node', '5', '/type', 'required'), ('node', '6', '', 'json'),
  ('edge', '0', '/properties/confidence', 'maximum'), ('edge', '1', '/type', 'pattern'), ('edge', '2', '/properties/provenance_tag', 'enum'), ('edge', '3', '/source', 'type'), ('edge', '4', '/properties/source_doc_ids', 'uniqueItems'), ('edge', '5', '/properties/source_doc_ids/1', 'type')) AS t(kind, x, pointer, rule))
SELECT kind, id, pointer, rule FROM (SELECT * FROM n UNION ALL SELECT * FROM e) JOIN r USING (kind, x)""")
def schema_errors(spark, d):
    """Exported nodes and edges against the published schema; the last digit of an id decides which rule its row was made to break."""
    x = F.right("id", F.lit(1))
    n = export.node_rows(node_table(spark, d, listed=True)).withColumnRenamed("entity_id", "id")
    e = export.edge_rows(edge_table(spark, d)).withColumnRenamed("edge_id", "id")
    node_faults = {"0": ('"id":"ent', '"id":"ENT'), "1": ('"type":"Entity"', '"type":"Thing"'), "2": (r"^\{", '{"colour":1,'), "3": (r'"mention_count":\d+', '"mention_count":0'), "4": (r'"name":"[^"]*"', '"name":""'), "5": ('"type":"Entity",', ""), "6": (r"\}$", "")}
    edge_faults = {"0": (r'"confidence":[0-9.]+', '"confidence":1.5'), "1": (r'"type":"[A-Z_]+"', '"type":"bought"'), "2": (r'"provenance_tag":"[A-Z]+"', '"provenance_tag":"GUESSED"'), "3": (r'"source":"[^"]*"', '"source":7'), "4": (r'"properties":\{', '"properties":{"source_doc_ids":["a","b","a"],'), "5": (r'"properties":\{', '"properties":{"source_doc_ids":["a",2],')}
    found = None
    for kind, rows, faults in (("node", n, node_faults), ("edge", e, edge_faults)):
        text = F
        for digit, (old, new) in faults.items():
            text = text.when(x == digit, F.regexp_replace("json", old, new))
        text = text.otherwise(F.col("json"))
        one = json_schema.invalid(rows.select(F.lit(kind).alias("kind"), "id", text.alias("json")), graph_schema.schema_of(kind))
        found = one if found is None else found.unionByName(one)
    return found


# --- entities that are one -----------------------------------------------------------

# a third of the suppliers is written with a hyphen, and every tenth customer's name has a letter twice
_SPELT = """s AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'Supplier-' || s_suppkey || ' Ltd' ELSE 'Supplier ' || s_suppkey || ' Ltd' END AS name, 'Organization' AS type, 1 + s_suppkey % 4 AS mention_count FROM supplier
  UNION ALL SELECT 'Customerr ' || c_custkey, 'Person', 1 FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT 'Customer ' || c_custkey, 'Person', 2 FROM customer UNION ALL SELECT p_name, 'Work', count(*) FROM part GROUP BY 1)"""


def _spelt(spark, d):
    s, c, p = read(spark, d, "supplier"), read(spark, d, "customer"), read(spark, d, "part")
    name = lambda word, key: F.concat(F.lit(word), F.col(key).cast("string"))
    rows = s.select(F.concat(F.when(F.col("s_suppkey") % 3 == 0, name("Supplier-", "s_suppkey")).otherwise(name("Supplier ", "s_suppkey")), F.lit(" Ltd")).alias("name"), F.lit("Organization").alias("type"), (1 + F.col("s_suppkey") % 4).cast("long").alias("mention_count"))
    rows = rows.union(c.where("c_custkey % 10 = 0").select(name("Customerr ", "c_custkey"), F.lit("Person"), F.lit(1).cast("long"))).union(c.select(name("Customer ", "c_custkey"), F.lit("Person"), F.lit(2).cast("long")))
    rows = rows.union(p.groupBy("p_name").agg(F.count("*").alias("n")).select("p_name", F.lit("Work"), "n"))
    return rows.withColumn("entity_id", ids.entity_id(F.col("name"), F.col("type")))


@query(f"""WITH {_SPELT}, e AS (SELECT DISTINCT {ent('name', 'type')} AS id, type, ' ' || {norm('name')} || ' ' AS p FROM s),
g AS (SELECT id, type, list_distinct(list_transform(range(1, len(p) - 1), lambda i: substr(p, i, 3))) AS g FROM e),
x AS (SELECT a.type, a.id AS a, b.id AS b, len(list_intersect(a.g, b.g)) AS c, len(a.g) + len(b.g) AS n FROM g a JOIN g b ON a.type = b.type AND a.id < b.id)
SELECT type, a, b, round(c / (n - c), 6) AS similarity FROM x WHERE round(c / (n - c), 6) >= 0.75""")
def entity_links(spark, d):
    """All pairs of similar names of one type."""
    return resolution.similar_pairs(_spelt(spark, d), 0.75)


@query(None)
def entity_resolution(spark, d):
    """Every entity and the one that it is, by similarity and a judge that compares digits."""
    return resolution.resolve_entities(cut(_spelt(spark, d)), resolution.SameDigits)[0]
