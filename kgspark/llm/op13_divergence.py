"""How far the sources of each language lie apart in their words, counted exactly behind a sketch.

Terms are runs of letters and of characters beyond ASCII; a language keeps those in
at least `min_docs` of its documents.  Most distinct terms of a corpus are not kept,
so they should not be shuffled either:

1. Each task fills a count-min sketch of document frequencies by (language, term);
   cells stop at min_docs, one byte each.  Cells of all tasks are added up; a cell
   counts every document that has any of its terms, so it never underestimates.
2. A second pass drops the terms whose cells stay below min_docs, adds up the others
   in the task and shuffles them by their strings: these counts are exact, and so is
   the cut that follows.
3. Smoothed rates p = 1 + floor(10^9 (count + 1) / (N + V)) are whole numbers.  Of two
   sources only the terms that both have are joined; a term that one or both lack has
   a rate that depends on the source alone, so it enters by a histogram of counts:

       sum f(p, q) = V f00 + sum over a's terms of (f(p, q0) - f00)
                   + sum over b's terms of (f(p0, q) - f00)
                   + sum over common terms of (f(p, q) - f(p, q0) - f(p0, q) + f00)

   with f(p, q) = floor((p - q)^2 / q) and p0, q0 the rates of an absent term.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgspark.llm import sketch
from kgspark.llm import text as tx
from kgspark.llm.shared import materialize

U64 = np.uint64
#: bytes that are in no term: all of ASCII but the letters
_GAP = np.zeros(256, dtype=bool)
_GAP[:128] = True
_GAP[65:91] = _GAP[97:123] = False
#: rows of the sketch
_ROWS = 2
#: (source, term) counts that a task holds before it hands them on
_HELD = 1 << 17
#: groups up to which they are broadcast; beyond it they are shuffled
_FEW = 100_000


@dataclass(frozen=True)
class Audit:
    """min_docs: documents of a language that a kept term needs; top: terms reported for a source.

    cell_bytes: bytes of text to a cell of the sketch; most_cells: cells of a row at most,
    so that the sketch, which is collected and broadcast, takes 128 MB whatever the
    input; a crowded sketch lets more terms pass to the exact
    counts and changes no result.
    """

    min_docs: int = 3
    top: int = 200
    cell_bytes: int = 64
    most_cells: int = 1 << 26

    def width(self, size: int) -> int:
        """Cells of a row for so many bytes of text."""
        return sketch.width_for(size // self.cell_bytes, self.most_cells)


@dataclass
class Terms:
    """Terms of some documents: their bytes, their hashes with the language, and each one's document."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray


def _seed(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


def _terms(batch: pa.RecordBatch) -> Iterator[Terms]:
    """The terms of a batch (lang, text, ...), whole documents of about a megabyte at a time."""
    seeds = {x: _seed(x) for x in batch.column(0).unique().to_pylist()}
    seed = np.array([seeds[x] for x in batch.column(0).to_pylist()], U64)
    for first, _, buf, off in tx.chunks(*tx.bytes_of(batch.column(1))):
        w = tx.words(buf, off, _GAP)
        doc = np.repeat(np.arange(first, first + len(off) - 1), np.diff(w.ptr))
        yield Terms(buf, w.start, w.end, tx.mix(w.hash + seed[doc]), doc)


def _sketched(width: int, full: int):
    """The sketch of a task's documents, as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = sketch.Sketch(width, full, _ROWS)
        for batch in batches:
            bits = U64(max(1, (len(batch) - 1).bit_length()))
            for t in _terms(batch):
                for row in range(_ROWS):
                    # a cell once for each document
                    pairs = np.unique(sketch.cells(t.hash, row, width) << bits | t.doc.astype(U64))
                    made.add(row, *np.unique(pairs >> bits, return_counts=True))
        yield from made.parts()
        tx.trim()

    return run


def document_sketch(rows: DataFrame, width: int, full: int) -> np.ndarray:
    """The count-min sketch of rows (lang, text): for each cell the documents with a term there, `full` at most."""
    return sketch.merged(rows.select("lang", "text").mapInArrow(_sketched(width, full), sketch.SCHEMA), width, full, _ROWS)


_COUNTED = "lang string, source string, term string, n bigint, df bigint"


def _counted(sent, full: int):
    """Counts of the terms that the sketch lets pass, added up over what a task can hold."""

    def flush(held: list, groups: list[tuple[str, str]]) -> pa.RecordBatch:
        key, group, n, df = (np.concatenate(x) for x in zip(*(h[:4] for h in held)))
        _, first, at = np.unique(key, return_index=True, return_inverse=True)
        term = pa.concat_arrays([h[4] for h in held]).take(pa.array(first)).cast(pa.string())
        langs, sources = (pa.array([g[i] for g in groups], pa.string()).take(pa.array(group[first])) for i in (0, 1))
        sums = [np.bincount(at, x, len(first)).astype(np.int64) for x in (n, df)]
        return pa.RecordBatch.from_arrays([langs, sources, term, pa.array(sums[0]), pa.array(sums[1])], names=["lang", "source", "term", "n", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        groups: dict[tuple[str, str], int] = {}
        for batch in batches:
            group = np.array([groups.setdefault(g, len(groups)) for g in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())], np.int64)
            for t in _terms(batch):
                at = np.flatnonzero(sketch.passes(sent.value, t.hash, full))
                doc, mine = t.doc[at], group[t.doc[at]]
                key = tx.mix(t.hash[at] + mine.astype(U64) * U64(0xD1342543DE82EF95))
                order = np.lexsort((doc, key))
                key, doc, mine, at = key[order], doc[order], mine[order], at[order]
                if not len(key):
                    continue
                new = np.concatenate(([True], key[1:] != key[:-1]))
                edge = np.flatnonzero(new)
                fresh = new | np.concatenate(([True], doc[1:] != doc[:-1]))
                held.append((key[edge], mine[edge], np.diff(edge, append=len(key)), np.add.reduceat(fresh.astype(np.int64), edge), tx.strings(t.buf, t.start[at[edge]], t.end[at[edge]])))
                size += len(edge)
                if size >= _HELD:
                    yield flush(held, list(groups))
                    held, size = [], 0
        if held:
            yield flush(held, list(groups))
        tx.trim()

    return run


def term_counts(rows: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, term, source, n, lang_n, first) of rows (lang, source, text) without nulls, as a table.

    n: occurrences in the source, lang_n: in the language, of kept terms; first: true
    in one row of each (lang, term).
    """
    spark, full = rows.sparkSession, max(1, min(audit.min_docs, 255))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sent = spark.sparkContext.broadcast(document_sketch(rows, audit.width(size), full))
    passed = rows.select("lang", "text", "source").mapInArrow(_counted(sent, full), _COUNTED)
    summed = passed.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    over = Window.partitionBy("lang", "term")
    every = summed.select("*", F.sum("n").over(over).alias("lang_n"), F.sum("df").over(over).alias("docs"), (F.row_number().over(over.orderBy("source")) == 1).alias("first"))
    kept = materialize(every.where(F.col("docs") >= audit.min_docs).select("lang", "term", "source", "n", "lang_n", "first"))
    sent.destroy()
    return kept


def _rate(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + kept)), in whole numbers of 38 digits."""
    return F.lit(1).cast("long") + F.call_function("div", (n + 1).cast("decimal(19,0)") * F.lit(1_000_000_000), (total + kept).cast("decimal(19,0)"))


def _far(p: str, q: str) -> str:
    """f(p, q) of two columns: rates are at most 10^9 + 1, so that all fits into 64 bits."""
    return f"(({p} - {q}) * ({p} - {q}) DIV {q})"


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= _FEW else df


def divergences(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (text, lang, source).

    part `pair`: each other source of the language as item, and how far the source's
    rates lie from that one's, over all kept terms.  part `term`: the kept terms that
    the source has at a higher rate than its language, by how far, the first
    audit.top.  Ranks run from 1 for each source and part, the largest value first, ties
    by item in byte order.

    A null text, lang or source counts as ''.  Sources without terms are compared too.
    Repeated rows are documents of their own.  Texts of any length are read whole, a
    document being one task's.  Columns beyond the three are ignored, whatever they are
    called; an empty table gives an empty result.
    """
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = term_counts(rows, audit)
    langs = counts.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("kept"), F.sum("n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")])
    # without kept terms there is nothing to sum and no rate
    none = F.when(F.col("kept") > 0, _rate(F.lit(0), F.col("total"), F.col("kept"))).otherwise(F.lit(1).cast("long"))
    groups = materialize(groups.withColumn("absent", none))
    few = _small(groups)
    rated = materialize(counts.join(few, ["lang", "source"]).select(
        "lang", "term", "source", "n", _rate(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "absent", _rate(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    ), counts)
    found = _pairs(rated, groups, few).unionByName(_leading(rated, audit.top))
    return found.select("lang", "source", "part", "item", "value", "rank")


def _pairs(rated: DataFrame, groups: DataFrame, few: DataFrame) -> DataFrame:
    side = lambda s: few.select("lang", F.col("source").alias(s), F.col("absent").alias(f"{s}0"))
    own = groups.select("lang", F.col("source").alias("a"), "kept", F.col("absent").alias("a0"))
    pairs = own.join(side("b"), "lang").where("a != b").withColumn("f00", F.expr(_far("a0", "b0")))
    # terms that one of both has, by how often it has them; sums of products have 38 digits
    often = materialize(rated.groupBy("lang", "source", "p").agg(F.count("*").alias("m")))
    one = lambda s, f: pairs.join(often.withColumnRenamed("source", s), ["lang", s]).groupBy("lang", "a", "b").agg(F.sum(F.expr(f"cast(m AS decimal(19,0)) * cast({f} - f00 AS decimal(19,0))")).alias("v"))
    # terms that both have: each pair once, both of its directions at a time
    left, right = (rated.select("lang", "term", F.col("source").alias(s), F.col("p").alias(f"{s}p"), F.col("absent").alias(f"{s}0")) for s in ("a", "b"))
    both = left.join(right, ["lang", "term"]).where("a < b")
    extra = lambda a, b: F.expr(f"{_far(f'{a}p', f'{b}p')} - {_far(f'{a}p', f'{b}0')} - {_far(f'{a}0', f'{b}p')} + {_far(f'{a}0', f'{b}0')}")
    both = both.select("lang", "a", "b", extra("a", "b").alias("ab"), extra("b", "a").alias("ba"))
    # the high and the low bits are summed apart, so that no sum passes 64 bits
    halves = lambda c: [F.sum(F.shiftright(c, 31)).alias(f"{c}_high"), F.sum(F.col(c).bitwiseAND(F.lit((1 << 31) - 1))).alias(f"{c}_low")]
    sums = materialize(both.groupBy("lang", "a", "b").agg(*halves("ab"), *halves("ba")))
    whole = lambda c: F.expr(f"cast({c}_high AS decimal(38,0)) * 2147483648 + {c}_low").alias("v")
    common = sums.select("lang", "a", "b", whole("ab")).unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), whole("ba")))
    base = pairs.select("lang", "a", "b", F.expr("cast(kept AS decimal(19,0)) * cast(f00 AS decimal(19,0))").alias("v"))
    parts = [base, one("a", _far("p", "b0")), one("b", _far("a0", "p")), common]
    total = parts[0]
    for p in parts[1:]:
        total = total.union(p.select("lang", "a", "b", "v"))
    total = total.groupBy("lang", "a", "b").agg(F.sum("v").cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "a").orderBy(F.desc("value"), "b"))
    return total.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value", rank.alias("rank"))


def _leading(rated: DataFrame, top: int) -> DataFrame:
    high = rated.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_far("p", "q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return high.withColumn("rank", rank).where(F.col("rank") <= top)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 3
), l AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), c AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), s AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT s.lang, s.source, kept.term, coalesce(c.n, 0) AS n, (1 + 1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT // (s.total + l.v)::HUGEINT)::BIGINT AS p,
    (1 + 1000000000 * (kept.n + 1)::HUGEINT // (l.total + l.v)::HUGEINT)::BIGINT AS q
  FROM s JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = kept.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) AS v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms
QUALIFY rank <= 200
"""
