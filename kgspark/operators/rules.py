"""A deterministic extractor over the relational test tables: an order is a document, a line item a chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgspark.functions.ids import entity_id, id_number, id_of_number

#: allowed types of both ends of each predicate (fixed values)
SIGNATURES = {
    "WORKS_AT": (("Person", "Character"), ("Organization", "Location")),
    "MEMBER_OF": (("Person", "Character"), ("Organization",)),
    "MARRIED_TO": (("Person", "Character"), ("Person", "Character")),
    "ROOMMATES_WITH": (("Person", "Character"), ("Person", "Character")),
    "PORTRAYS": (("Person",), ("Character",)),
    "LOCATED_IN": (("Location", "Organization"), ("Location",)),
    "PART_OF": (("Event", "Work", "Location", "Organization", "Concept"),) * 2,
    "AUTHORED": (("Person", "Character"), ("Work",)),
    "FOUNDED_BY": (("Organization",), ("Person", "Character")),
}
#: entity types and provenance tags (fixed values)
ENTITY_TYPES = ("Person", "Character", "Organization", "Location", "Work", "Event", "Concept")
PROVENANCE_TAGS = ("EXTRACTED", "INFERRED", "AMBIGUOUS")


def provenance_band(confidence):
    return F.when(confidence >= 0.85, "EXTRACTED").when(confidence >= 0.7, "INFERRED").otherwise("AMBIGUOUS")


#: lines a task: the number of tasks follows that of the lines, so no task grows with the tables
_LINES = 1 << 18
#: suppliers, parts or customers up to which they are broadcast (about 70 MB); beyond it they are shuffled
_FEW = 1 << 19


def _named(table: DataFrame, name: str, kind: str, num: str) -> DataFrame:
    """A table with the number of the entity id of its names: hashed once a row here, not once a fact, and narrow in joins."""
    return table.withColumn(num, id_number(entity_id(F.col(name), F.lit(kind))))


def _with(rows: DataFrame, key: str, table: DataFrame, own: str, tasks: int) -> DataFrame:
    """rows joined with a table by its key: broadcast while it has few rows, else both are dealt to as many tasks as the lines need."""
    if table.count() <= _FEW:
        return rows.join(F.broadcast(table), F.col(key) == F.col(own))
    return rows.repartition(tasks, key).join(table.repartition(tasks, own), F.col(key) == F.col(own))


def _by_lot(rows: DataFrame, key: str, lot: str, tasks: int) -> DataFrame:
    """rows dealt by the number that a key gives, which is told with how many there are."""
    return rows.withColumn(lot, F.pmod(F.hash(key), F.lit(tasks)).alias(lot, metadata={"lots": tasks})).repartitionById(tasks, lot)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per chunk with the names and ids of its five entities and the scores of its edges.

    All chunks of a document lie in one partition.  doc_num is the number in doc_id;
    at orders a document's chunks as key does: the line number in its upper half,
    the place among all lines of the order in the lower one.  lot: the number of that
    partition (see graph.lots); however many partitions Spark makes of a shuffle by
    default, here their number follows that of the lines.
    """
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("lineitem", "orders", "customer", "supplier", "nation", "region", "part")}
    for table, name, kind, num in (("customer", "c_name", "Person", "c_num"), ("supplier", "s_name", "Organization", "s_num"), ("nation", "n_name", "Location", "n_num"), ("region", "r_name", "Location", "r_num"), ("part", "p_name", "Work", "p_num")):
        t[table] = _named(t[table], name, kind, num)
    tasks = max(spark.sparkContext.defaultParallelism, -(-t["lineitem"].count() // _LINES))
    places = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    few = t["supplier"].count() <= _FEW
    lines = _with(t["lineitem"], "l_partkey", t["part"], "p_partkey", tasks)
    # what a broadcast can add is added where the lines of a document lie already: a line moves with its supplier's key alone
    lines = _by_lot(lines if few else _with(lines, "l_suppkey", places, "s_suppkey", tasks), "l_orderkey", "lot", tasks)
    placed = F.rank().over(Window.partitionBy("lot", "l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    orders = _by_lot(_with(t["orders"], "o_custkey", t["customer"], "c_custkey", tasks), "o_orderkey", "o_lot", tasks)
    lines = lines.join(orders, (F.col("lot") == F.col("o_lot")) & (F.col("l_orderkey") == F.col("o_orderkey")))
    if few:
        lines = lines.join(F.broadcast(places), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = (
        lines
        .select(
            F.concat(F.lit("doc_"), F.col("l_orderkey").cast("string")).alias("doc_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("chunk_id"),
            F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"),
            "s_name", "n_name", "r_name", "p_name", "c_name", "s_num", "n_num", "r_num", "p_num", "c_num",
            (1 - F.col("l_discount")).alias("located"), (1 - F.col("l_tax")).alias("member"),
            F.col("l_orderkey").alias("doc_num"), (F.col("l_linenumber").cast("long") * (1 << 32) + placed * 32).alias("at"), "lot",
        )
    )
    return rows.select("*", *[id_of_number("ent_", F.col(f"{c}_num")).alias(f"{c}_id") for c in "snrpc"])


def _each(rows: DataFrame, place: str, kinds: list[dict[str, Column]]) -> DataFrame:
    """A row for each of `kinds` and row, with its place among them.

    Values are picked by the place, not held in an array, so those that nobody reads are not carried.
    """
    kept = [c for c in ("doc_id", "chunk_id", "key", "doc_num", "at", "lot") if c in rows.columns]
    out = rows.withColumn(place, F.explode(F.array(*[F.lit(i) for i in range(len(kinds))])))

    def pick(name: str) -> Column:
        found = F.lit(None)
        for i in reversed(range(len(kinds))):
            found = F.when(F.col(place) == i, kinds[i][name]).otherwise(found) if i < len(kinds) - 1 else kinds[i][name]
        return found

    return out.select(*kept, place, *[pick(n).alias(n) for n in kinds[0]]).withColumn("ord", F.struct("key", place)).withColumn("at", F.col("at") + F.col(place) * 4)


def entity_facts(rows: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, key, ent_ord, name, type, entity_id, aliases, ord), and the numbers that graph.entities adds up by."""
    ents = [("s", "Organization"), ("n", "Location"), ("r", "Location"), ("p", "Work"), ("c", "Person")]
    out = _each(rows, "ent_ord", [{"name": F.col(f"{c}_name"), "type": F.lit(k), "entity_num": F.col(f"{c}_num")} for c, k in ents])
    return out.withColumn("entity_id", id_of_number("ent_", F.col("entity_num"))).withColumn("aliases", F.array(F.lower("name")))


def relation_facts(rows: DataFrame) -> DataFrame:
    """relations with the ids of their ends, and the numbers that graph.edges adds up by; the rule extractor knows both ends' types.

    The edge's own id is made from these three keys once an edge is put together.
    """
    rel = lambda s, st, t, tt, p, c: {
        "source": F.col(f"{s}_name"), "source_type": F.lit(st), "target": F.col(f"{t}_name"), "target_type": F.lit(tt), "predicate": F.lit(p),
        "confidence": c.cast("double"), "source_num": F.col(f"{s}_num"), "target_num": F.col(f"{t}_num"),
    }
    out = _each(rows, "rel_ord", [
        rel("s", "Organization", "n", "Location", "LOCATED_IN", F.col("located")),
        rel("n", "Location", "r", "Location", "LOCATED_IN", F.lit(0.95)),
        rel("c", "Person", "s", "Organization", "MEMBER_OF", F.col("member")),
        rel("p", "Work", "s", "Organization", "FOUNDED_BY", F.lit(0.80)),
        rel("c", "Person", "p", "Work", "BOUGHT", F.lit(0.60)),
    ])
    for end in ("source", "target"):
        out = out.withColumn(f"{end}_id", id_of_number("ent_", F.col(f"{end}_num")))
    return out.withColumn("provenance_tag", provenance_band(F.col("confidence"))).withColumn("evidence_span", F.concat_ws(" ", "source", F.lower("predicate"), "target"))


def relations(rows: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, source, target, predicate, confidence, provenance_tag, evidence_span, types, ord), ends by name only."""
    return relation_facts(rows).drop("source_id", "target_id", "source_num", "target_num")


def signature_ok(predicate, source_type, target_type, signatures=SIGNATURES):
    """Whether the types fit the predicate's signature, by a map like SIGNATURES; predicates without one pass."""
    ok = F.lit(True)
    for p, (left, right) in signatures.items():
        ok = F.when(predicate == p, source_type.isin(*left) & target_type.isin(*right)).otherwise(ok)
    return ok
