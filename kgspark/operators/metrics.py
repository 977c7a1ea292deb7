"""Extraction and retrieval metrics, and publish gates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b == 0, empty).otherwise(a / b)


def prf(predicted: DataFrame, expected: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """precision, recall and f1 of two sets of keys, by group if asked; all 0 for two empty sets."""
    by = by or []
    p, e = predicted.select(*by, *keys).distinct().withColumn("p", F.lit(1)), expected.select(*by, *keys).distinct().withColumn("e", F.lit(1))
    both = p.join(e, [*by, *keys], "full_outer")
    n = both.groupBy(*by).agg(F.coalesce(F.sum("p"), F.lit(0)).alias("n_p"), F.coalesce(F.sum("e"), F.lit(0)).alias("n_e"), F.coalesce(F.sum(F.col("p") * F.col("e")), F.lit(0)).alias("tp"))
    precision, recall = _ratio(F.col("tp"), F.col("n_p")), _ratio(F.col("tp"), F.col("n_e"))
    out = n.withColumn("precision", precision).withColumn("recall", recall)
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.select(*by, F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round(f1, 6).alias("f1"))


def coverage(predicted: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Share of the expected keys that are predicted; 1 where none is expected."""
    e = expected.select(*keys).distinct().join(predicted.select(*keys).distinct().withColumn("hit", F.lit(1)), keys, "left")
    return e.agg(F.when(F.count("*") == 0, 1.0).otherwise(F.round(F.count("hit") / F.count("*"), 6)).alias("coverage"))


def check_k(k: int) -> int:
    if k <= 0:
        raise ValueError("k must be positive")
    return k


def recall_at_k(ranked: DataFrame, k: int) -> DataFrame:
    """Mean over queries of whether a relevant item is in the first k (query, rank, relevant)."""
    hit = ranked.groupBy("query").agg(F.max(((F.col("rank") <= check_k(k)) & F.col("relevant")).cast("int")).alias("hit"))
    return hit.agg(F.round(F.avg("hit"), 6).alias("recall"))


def mrr(ranked: DataFrame) -> DataFrame:
    first = ranked.groupBy("query").agg(F.coalesce(1 / F.min(F.when(F.col("relevant"), F.col("rank"))), F.lit(0.0)).alias("rr"))
    return first.agg(F.round(F.coalesce(F.avg("rr"), F.lit(0.0)), 6).alias("mrr"))


def ndcg_at_k(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Mean binary nDCG over queries; relevant (query, n): relevant items of each query."""
    gain = ranked.where(F.col("relevant") & (F.col("rank") <= check_k(k))).groupBy("query").agg(F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + F.lit(1.0)))
    each = relevant.join(gain, "query", "left").select(F.when(F.col("n") == 0, 0.0).otherwise(F.coalesce("dcg", F.lit(0.0)) / ideal).alias("v"))
    return each.agg(F.round(F.avg("v"), 6).alias("ndcg"))


@dataclass(frozen=True)
class Thresholds:
    f1_floor: float = 0.80
    coverage_floor: float = 0.90
    recall_floor: float = 0.75
    mrr_floor: float = 0.50
    cost_ceiling: float = 0.05
    max_drop: float = 0.03
    type_drop: float = 0.05
    min_runs: int = 3
    warmup: int = 50


def gate_floors(runs: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """runs (run_id, f1, coverage, recall, mrr, cost, n_golden) with reasons and outcome; small golden sets warm up."""
    reasons = F.array(
        F.when(F.col("f1") < t.f1_floor, "f1"), F.when(F.col("coverage") < t.coverage_floor, "coverage"), F.when(F.col("recall") < t.recall_floor, "recall"),
        F.when(F.col("mrr") < t.mrr_floor, "mrr"), F.when(F.col("cost") > t.cost_ceiling, "cost"),
    )
    reasons = F.array_join(F.filter(reasons, lambda r: r.isNotNull()), ",")
    warm = F.col("n_golden") < t.warmup
    return runs.select("run_id", F.when(warm, "").otherwise(reasons).alias("reasons"), F.when(warm, "warmup").when(reasons != "", "block").otherwise("pass").alias("outcome"))


def gate_regression(runs: DataFrame, metric: str, mode: str = "strict", t: Thresholds = Thresholds()) -> DataFrame:
    """Whether a metric's drop has persisted (run_id, seq, metric).

    compat: the baseline is the run before and must also lie above itself, so with
    two or more runs asked for nothing ever blocks.  strict: the baseline is the
    run before the last min_runs - 1 runs, all of which must show the drop.
    Histories are runs, few rows, hence one window.
    """
    w, need = Window.orderBy("seq"), t.min_runs - 1
    base = F.lag(metric, 1 if mode == "compat" else need + 1).over(w)
    last = F.collect_list(metric).over(w.rowsBetween(-need, -1)) if need else F.array().cast("array<double>")
    out = runs.withColumn("_base", base).withColumn("_last", last)
    lasting = F.forall("_last", lambda m: F.col("_base") - m > t.max_drop) & (F.size("_last") >= need)
    return out.select("run_id", F.coalesce((F.col("_base") - F.col(metric) > t.max_drop) & lasting, F.lit(False)).alias("blocked"))


def gate_per_type(current: DataFrame, baseline: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Types (type, f1) whose F1 fell by more than type_drop; types without a baseline are skipped."""
    both = current.join(baseline.withColumnRenamed("f1", "old"), "type")
    return both.select("type", F.round(F.col("old") - F.col("f1"), 6).alias("fell"), (F.col("old") - F.col("f1") > t.type_drop).alias("blocked"))


def rolling_alerts(runs: DataFrame, columns: list[str], width: int = 7, factor: float = 2.0) -> DataFrame:
    """runs with a flag per column: above `factor` times its average over the last `width` runs."""
    w = Window.orderBy("seq").rowsBetween(-width, -1)
    return runs.select("run_id", *[F.coalesce(F.col(c) > factor * F.avg(c).over(w), F.lit(False)).alias(f"{c}_alert") for c in columns])


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """One row: the expected calibration error of rows (confidence, right) over equal bins; 0 without rows."""
    at = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1))
    each = scored.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.avg("confidence").alias("c"), F.avg(F.col("right").cast("double")).alias("r"))
    return each.agg(F.round(F.coalesce(F.sum(F.col("n") * F.abs(F.col("c") - F.col("r"))) / F.sum("n"), F.lit(0.0)), 6).alias("ece"), F.count("*").alias("bins_used"))


def error_alerts(runs: DataFrame, most: float = 0.05) -> DataFrame:
    """(run_id, error_alert) of runs (run_id, errors, total): more than `most` of the total failed."""
    return runs.select("run_id", F.coalesce(F.col("errors") > most * F.col("total"), F.lit(False)).alias("error_alert"))
