"""Change detection, staleness and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, status) of two manifests (path, hash): new, changed, unchanged or deleted."""
    both = before.select("path", F.col("hash").alias("old")).join(after.select("path", F.col("hash").alias("new")), "path", "full_outer")
    status = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "deleted").when(F.col("old") != F.col("new"), "changed").otherwise("unchanged")
    return both.select("path", status.alias("status"))


def stale(checks: DataFrame, today: str, days: int = 7) -> DataFrame:
    """Documents (doc_id, checked_at) last checked more than `days` days before today."""
    last = checks.groupBy("doc_id").agg(F.max("checked_at").alias("last_checked"))
    return last.where(F.datediff(F.lit(today).cast("date"), F.col("last_checked")) > days)


def changed_upstream(checks: DataFrame) -> DataFrame:
    """(doc_id, checked_at, status) of checks (doc_id, checked_at, http_status, etag, last_modified, hash), each against the one before.

    The first sign that both checks have decides: a 304 answer, then the ETag, the
    date, the hash.  A first check, or one without a common sign, is `unknown`.
    """
    w = Window.partitionBy("doc_id").orderBy("checked_at")
    status = F.lit("unknown")
    for c in ("hash", "last_modified", "etag"):
        old = F.lag(c).over(w)
        status = F.when(old.isNotNull() & F.col(c).isNotNull(), F.when(old == F.col(c), "fresh").otherwise("stale")).otherwise(status)
    first = F.lag("checked_at").over(w).isNull()
    return checks.select("doc_id", "checked_at", F.when(first, "unknown").when(F.col("http_status") == 304, "fresh").otherwise(status).alias("status"))


def upsert(table: DataFrame, fresh: DataFrame, key: str = "chunk_id", gone: DataFrame | None = None) -> DataFrame:
    """table with the rows of fresh instead of its own of the same key, and without the documents of gone (doc_id)."""
    kept = table.join(fresh.select(key), key, "left_anti").select(*table.columns)
    if gone is not None:
        kept = kept.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(*table.columns)
    return kept.unionByName(fresh)


def force(publishes: DataFrame, reasons: DataFrame) -> DataFrame:
    """publishes (version, blocked) that go out: not blocked, or forced with a reason (version, reason) that is kept beside them."""
    told = publishes.join(reasons.where(F.trim("reason") != "").select("version", F.col("reason").alias("_r")), "version", "left")
    forced = F.col("blocked") & F.col("_r").isNotNull()
    return told.select(*publishes.columns, forced.alias("forced_publish"), F.when(forced, F.col("_r")).alias("forced_reason"), (~F.col("blocked") | forced).alias("published"))


def prune(publishes: DataFrame, today: str, keep_days: int, keep_last: int) -> DataFrame:
    """Publishes (version, published_at) with `pruned`: older than keep_days and not among the last keep_last."""
    rank = F.row_number().over(Window.orderBy(F.desc("published_at"), F.desc("version")))
    old = F.datediff(F.lit(today).cast("date"), F.col("published_at")) > keep_days
    return publishes.select("version", ((rank > keep_last) & old).alias("pruned"))


def url_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, rule_id, action) of the first rule (rule_id, pattern, action) whose pattern the URL matches.

    Rules are a short configured list: they are folded into one expression.
    """
    first = F.lit(None).cast("struct<rule_id: int, action: string>")
    for r in sorted(rules.collect(), key=lambda r: -r["rule_id"]):
        first = F.when(F.col("url").rlike(r["pattern"]), F.struct(F.lit(r["rule_id"]).alias("rule_id"), F.lit(r["action"]).alias("action"))).otherwise(first)
    return pages.select("page_id", first.alias("r")).where("r IS NOT NULL").select("page_id", "r.*")
