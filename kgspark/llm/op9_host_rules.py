"""Quality rules of documents and of their hosts, in Spark expressions only.

Each document is held against rules.  Their failures are summed by host (the
`source` column); a beta prior fitted to all hosts shrinks each host's failure
rates towards the mean, so that a host of few documents is not condemned by
them; a host with a shrunk rate above a limit is rejected with all it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.columns import SPACE, packed, unpacked
from kgspark.llm.shared import attach, materialize

#: rejected hosts up to which they are broadcast; beyond it only those of many documents are
_FEW_HOSTS = 50_000


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the text (null: none).

    Repeated windows are found by sorting the hashes of all five-word windows of
    the text; only texts that have one sort (hash, position) pairs as well.
    """
    t = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    t = t.withColumn("_s", F.trim(F.col("_t"), F.lit(SPACE)))
    t = t.withColumn("_w", F.when(F.col("_s") == "", F.array().cast("array<string>")).otherwise(F.split("_s", r"[\x20\x09-\x0D]+")))
    t = t.withColumn("n_words", F.size("_w").cast("long"))
    t = t.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t = t.withColumn("_h", F.expr("CASE WHEN size(_w) < 5 THEN array() ELSE transform(sequence(0, size(_w) - 5), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2], _w[i + 3], _w[i + 4])) END"))
    t = t.withColumn("_p", F.expr("CASE WHEN size(array_distinct(_h)) < size(_h) THEN sort_array(transform(_h, (h, i) -> struct(h, i))) ELSE cast(array() as array<struct<h: bigint, i: int>>) END"))
    t = t.withColumn("_p", F.expr("sort_array(transform(filter(transform(_p, (x, j) -> struct(x.i AS i, x.h = get(_p, j - 1).h OR x.h = get(_p, j + 1).h AS twice)), x -> x.twice), x -> x.i))"))
    # each repeated window adds the words that the one before it has not covered
    repeat = F.expr("aggregate(_p, struct(-5 AS last, 0L AS n), (a, i) -> struct(i AS last, a.n + least(5, i - a.last) AS n), a -> a.n)")
    return t.withColumns({
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": repeat,
    }).drop("_t", "_s", "_w", "_l", "_h", "_p")


def rules() -> dict[str, Column]:
    """Rules by name: true where a document with the columns of text_counts fails."""
    n = F.col("n_words")
    return {
        "base": (n < 10) | (100 * F.col("n_repeat_words") > 20 * n),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "lines": 4 * F.col("n_dup_lines") > n,
    }


def host_verdicts(judged: DataFrame, names: list[str], host: str = "source", limit: float = 0.5) -> DataFrame:
    """(host, rejected) of each host that is not null, from boolean columns of rule failures.

    The prior of a rule is the beta distribution with the mean and the variance
    of the hosts' rates; only these few numbers reach the driver.
    """
    hosts = judged.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in names])
    moments = hosts.agg(*[f(F.col(r) / F.col("n")).alias(f"{k}_{r}") for r in names for k, f in (("m", F.avg), ("v", F.var_pop))]).first()
    bad = F.lit(False)
    for r in names:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        strength = min(1e6, max(1.0, m * (1 - m) / v - 1)) if v > 0 else 1e6
        bad = bad | ((F.col(r) + m * strength) / (F.col("n") + strength) > limit)
    return hosts.select(host, bad.alias("rejected"))


def keep_by_host(judged: DataFrame, names: list[str], host: str = "source", limit: float = 0.5) -> DataFrame:
    """judged, a table that can be read twice, with base_failed and kept instead of the rule columns."""
    rejected = materialize(host_verdicts(judged, names, host, limit).where("rejected"))
    if rejected.count() <= _FEW_HOSTS:
        joined = judged.join(F.broadcast(rejected), host, "left")
    else:
        joined = attach(judged, rejected, host)
    return joined.select(
        *[c for c in judged.columns if c not in names],
        F.col("_base").alias("base_failed"),
        (~F.col("_base") & ~F.coalesce("rejected", F.lit(False))).alias("kept"),
    )


_MADE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def judge(rows: DataFrame, limit: float = 0.5) -> DataFrame:
    """rows (row, host, text) with the columns of _MADE instead of host and text."""
    judged = text_counts(rows).withColumns({f"_{r}": c for r, c in rules().items()}).drop("text")
    return keep_by_host(materialize(judged), [f"_{r}" for r in rules()], "host", limit).drop("host")


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text", limit: float = 0.5) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    Columns of docs with these names are replaced; all others keep names and values,
    whatever they are called.  A null text counts as empty and fails; a null host gets
    no verdict; repeated rows, and hosts that tie, are judged each by itself and count as
    often as they occur; a text is judged whole at any length, its words being one
    array in memory; an empty table gives an empty result.
    """
    rows = docs.select(packed(docs).alias("row"), F.col(host).alias("host"), F.col(text).alias("text"))
    return judge(rows, limit).select(*unpacked(docs.columns, _MADE), *_MADE)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs.select(F.struct("doc_id").alias("row"), F.col("source").alias("host"), "text")).select("row.doc_id", *_MADE)


SQL = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT *, len(w)::BIGINT AS n_words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
    CASE WHEN len(w) < 5 THEN [] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS h
  FROM t
), p AS (
  SELECT doc_id, unnest(h) AS x, generate_subscripts(h, 1) AS i FROM g
), d AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM p
), r AS (
  SELECT doc_id, sum(least(5, coalesce(i - prev, 5)))::BIGINT AS n FROM (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM d WHERE c > 1
  ) GROUP BY doc_id
), f AS (
  SELECT g.doc_id, source, n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM g LEFT JOIN r USING (doc_id)
), j AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    10 * n_symbols > word_chars AS symbols, 4 * n_dup_lines > n_words AS lines
  FROM f
), hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::BIGINT) AS b, sum(symbols::BIGINT) AS s, sum(lines::BIGINT) AS l FROM j WHERE source IS NOT NULL GROUP BY source
), m AS (
  SELECT avg(b / n) AS mb, var_pop(b / n) AS vb, avg(s / n) AS ms, var_pop(s / n) AS vs, avg(l / n) AS ml, var_pop(l / n) AS vl FROM hosts
), k AS (
  SELECT *,
    CASE WHEN vb > 0 THEN least(1e6, greatest(1, mb * (1 - mb) / vb - 1)) ELSE 1e6 END AS kb,
    CASE WHEN vs > 0 THEN least(1e6, greatest(1, ms * (1 - ms) / vs - 1)) ELSE 1e6 END AS ks,
    CASE WHEN vl > 0 THEN least(1e6, greatest(1, ml * (1 - ml) / vl - 1)) ELSE 1e6 END AS kl
  FROM m
), v AS (
  SELECT source FROM hosts, k
  WHERE (b + mb * kb) / (n + kb) > 0.5 OR (s + ms * ks) / (n + ks) > 0.5 OR (l + ml * kl) / (n + kl) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM v)) AS kept
FROM j
"""
