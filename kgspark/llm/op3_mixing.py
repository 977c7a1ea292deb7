"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule takes the van der Corput point of i through the cumulative
slots that the sources need, which names its source; the slots of a source are
ranked, and the slot of rank r takes block r (modulo the source's blocks) of the
source's shuffled texts, cut into blocks of equal token counts.  A source below the
common block length has one block of its own size.  After every prefix of the
schedule each source is within a few blocks of its share; at its end, slots beyond
a source's target go, missing ones come, and the last one is cut to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgspark.llm.columns import n_words
from kgspark.llm.order import buckets_for, shuffled
from kgspark.llm.shared import materialize

#: bits of a van der Corput point; more than the slots of any schedule
_BITS = 40


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """(source, source_size, target) of a table (source, size).

    Sources in code point order, null last, take the weights in turn.  The sum
    of all sizes is dealt by weight; a target stops at `repeats` times its
    source's size and the rest is dealt again: the highest common level L with
    sum(min(cap, weight * L)) = total.  Sources are few rows next to documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("_r", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weigh = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_r") % len(weights) + 1).cast("int")).cast("decimal(38,0)")
    one = ranked.withColumn("w", weigh).withColumn("cap", (F.col("source_size") * repeats).cast("decimal(38,0)"))
    # sources in the order in which they reach their caps
    by = Window.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), "_r")
    earlier, every = by.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = one.withColumns({
        "_capped": F.coalesce(F.sum("cap").over(earlier), F.lit(0)),
        "_gone": F.coalesce(F.sum("w").over(earlier), F.lit(0)),
        "_all": F.sum("source_size").over(every),
        "_w": F.sum("w").over(every),
    })
    level = (F.col("_all") - F.col("_capped")).cast("double") / (F.col("_w") - F.col("_gone")).cast("double")
    one = one.withColumn("_k", F.row_number().over(by))
    # the level that holds when all earlier sources are capped and this one is not
    one = one.withColumn("_level", F.min(F.when(level * F.col("w").cast("double") <= F.col("cap").cast("double"), F.struct("_k", level.alias("l")))).over(every)["l"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("_level") * F.col("w").cast("double"), F.col("cap").cast("double")))
    return one.select("source", "source_size", target.alias("target"))


def van_der_corput(i: Column) -> Column:
    """The base-2 radical inverse of i in [0, 1): its bits reversed behind the point."""
    bits = F.reverse(F.lpad(F.bin(i), _BITS, "0"))
    return F.conv(bits, 2, 10).cast("double") / float(1 << _BITS)


def schedule(spark: SparkSession, targets: DataFrame, slots: int) -> DataFrame:
    """(slot, source_key, rank): the source of each slot and its rank among the source's slots.

    The targets, one row a source, are joined as intervals of [0, 1) on a grid of
    cells: a slot meets only the sources whose intervals touch its cell.
    """
    cells = 1024
    upto = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, 0)
    share = targets.withColumn("hi", F.sum("target").over(upto)).withColumn("_t", F.sum("target").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    share = share.where("target > 0").select("source_key", ((F.col("hi") - F.col("target")) / F.col("_t")).alias("lo"), (F.col("hi") / F.col("_t")).alias("hi"))
    share = share.withColumn("hi", F.when(F.col("hi") > 1 - 1e-12, 1.0).otherwise(F.col("hi")))
    share = share.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))))
    points = spark.range(slots).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("x")).withColumn("cell", F.floor(F.col("x") * cells))
    chosen = points.join(share, "cell").where("x >= lo AND x < hi").select("slot", "source_key")
    # ranks within a source: slots are grouped by range first, so that no task ranks a whole source
    width = 16_384
    part = chosen.withColumn("_p", F.floor(F.col("slot") / width))
    counts = part.groupBy("source_key", "_p").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source_key").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source_key", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source_key", "_p").orderBy("slot")
    return part.withColumn("_i", F.row_number().over(inside) - 1).join(counts, ["source_key", "_p"]).select("slot", "source_key", (F.col("_base") + F.col("_i")).alias("rank"))


def block_plan(targets: DataFrame, block: int, repeats: int) -> DataFrame:
    """(source_key, source_size, _len, _blocks, _slots, _short) of sources with words.

    _len: tokens of the source's own blocks, at most `block`; _slots: slots that reach
    the target; _short: tokens by which the last of them would go beyond it.
    """
    plan = targets.where("source_size > 0").withColumn("_goal", F.expr(f"least(cast(round(target) AS bigint), {repeats} * source_size)"))
    plan = plan.withColumn("_len", F.expr(f"source_size DIV ((source_size + {block} - 1) DIV {block}) + if(source_size % ((source_size + {block} - 1) DIV {block}) > 0, 1, 0)"))
    plan = plan.withColumn("_blocks", F.expr("(source_size + _len - 1) DIV _len")).withColumn("_rest", F.expr("_goal % source_size"))
    plan = plan.withColumn("_slots", F.expr("_goal DIV source_size * _blocks + (_rest + _len - 1) DIV _len"))
    short = F.expr("if(_rest = 0, 0, least(source_size, (_rest + _len - 1) DIV _len * _len) - _rest)")
    return plan.where("_slots > 0").select("source_key", "source_size", "_len", "_blocks", "_slots", short.alias("_short"))


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3, block_tokens: int = 4096, least_slots: int = 512, seed: int = 20) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs (doc_id, source, text).

    block_tokens: tokens of a block, made smaller where a schedule would have fewer
    than least_slots slots a source, and for a source to its size over its number of blocks.  taken: words of the row that the schedule
    takes, repeats counted, never more than `repeats` times its size.  A null or
    empty text has size 0 and gives nothing; a null source is a source of its own.
    Rows equal in doc_id and size are interchangeable.  Reruns agree, as the
    shuffle depends on doc_id, size and seed only.  An empty table gives an empty
    result.  Other columns are ignored; a text of any length is one row.
    """
    spark = docs.sparkSession
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    rows, total, sources = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.count_distinct(F.coalesce("source", F.lit("")), F.col("source").isNull())).first()
    targets = materialize(source_targets(sized, weights, repeats).withColumn("source_key", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))))
    block = max(1, min(block_tokens, total // max(1, sources * least_slots)))
    plan = materialize(block_plan(targets, block, repeats))
    slots = plan.agg(F.coalesce(F.sum("_slots"), F.lit(0))).first()[0]
    # each block's number of slots; the discrepancy of the schedule never goes beyond the slots of a source
    dealt = schedule(spark, plan.select("source_key", F.col("_slots").cast("double").alias("target")), slots).join(plan, "source_key").where("rank < _slots")
    dealt = dealt.groupBy("source_key", F.expr("rank % _blocks").alias("block")).agg(F.count("*").alias("times"))
    # and where it gives a source too few, the next ranks follow
    served = plan.join(dealt.groupBy("source_key").agg(F.sum("times").alias("_served")), "source_key", "left").withColumn("_served", F.coalesce("_served", F.lit(0)))
    missing = served.where("_served < _slots").withColumn("rank", F.explode(F.expr("sequence(_served, _slots - 1)"))).select("source_key", F.expr("rank % _blocks").alias("block"), F.lit(1).cast("long").alias("times"))
    taken = dealt.union(missing).groupBy("source_key", "block").agg(F.sum("times").alias("times")).join(plan, "source_key")
    # one of the slots of the last block ends at _upto
    upto = F.expr("least(source_size, (block + 1) * _len) - if(block = (_slots - 1) % _blocks, _short, 0)")
    taken = taken.select("source_key", "block", "times", upto.alias("_upto"))
    placed = shuffled(sized.join(targets.select(F.col("source").alias("_src"), "source_key", "source_size", "target"), F.col("source").eqNullSafe(F.col("_src"))).drop("_src"), ["source_key"], ["doc_id", "size"], seed, buckets_for(rows), "size")
    placed = materialize(placed.withColumn("_id", F.monotonically_increasing_id()))
    pieces = placed.where("size > 0").join(plan.select("source_key", "_len"), "source_key")
    pieces = pieces.select("_id", "source_key", "before", "size", "_len", F.explode(F.expr("sequence(before DIV _len, (before + size - 1) DIV _len)")).alias("block"))
    pieces = pieces.select("_id", "source_key", "block", F.expr("greatest(before, block * _len)").alias("_lo"), F.expr("least(before + size, (block + 1) * _len)").alias("_hi"))
    words = F.expr("(_hi - _lo) * times - greatest(0, _hi - greatest(_lo, _upto))")
    got = pieces.join(taken, ["source_key", "block"]).groupBy("_id").agg(F.sum(words).alias("taken"))
    return materialize(placed.join(got, "_id", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")), sized, targets, plan, placed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
