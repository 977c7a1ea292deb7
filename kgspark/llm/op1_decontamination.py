"""Benchmark decontamination: CGK embedding, bit-sampling LSH, edit verification.

Texts and benchmark items are word sequences.  The CGK random walk (Chakraborty,
Goldenberg, Koucky, 2016) maps a window of m words to 3m symbols: step j emits
the word under the cursor and moves on if a random bit of (j, word) says so.
Sequences at a small edit distance come out at a small Hamming distance, so they
agree on a random sample of positions with fair probability; several walks with
several samples each find most passages.  Windows are item-sized: lengths
run over a geometric grid, and an item is embedded by its first words, as many as
the largest grid length that it has.  Every candidate is verified by the exact
edit distance between the whole item and its best place in the text.

What the embedding misses, exact pieces find: an item that may lose k words to
edits is cut into k + 1 disjoint pieces, of which k edits leave one whole, at most
k words off its own place.  So no match is lost at any length and any kind of
edits, nor at the ends of a text or where the text is shorter than the item.

A gate that loses nothing spares most windows of the embedding: with at most k edits a passage
keeps n - 1 - 2k of an item's n - 1 word pairs, so a place without enough of
the items' word pairs nearby can't match.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kgspark.llm import text as tx

U64 = np.uint64


@dataclass(frozen=True)
class Search:
    """percent: most word edits, in hundredths of an item's words; least_words: words
    below which an item must occur word for word; walks, samples, bits:
    CGK walks, samples a walk, positions a sample; block: items held at once."""

    percent: int = 20
    least_words: int = 8
    walks: int = 4
    samples: int = 8
    bits: int = 7
    block: int = 20_000
    seed: int = 11


def grid(n: int, least: int) -> int:
    """The largest length of the grid least, 5/4 least, ... that n reaches."""
    m = least
    while m * 5 // 4 + 1 <= n:
        m = m * 5 // 4 + 1
    return m


def embed_keys(h: np.ndarray, start: np.ndarray, m: int, search: Search) -> np.ndarray:
    """LSH keys (walks * samples, windows) of the windows h[start : start + m]."""
    keys = np.zeros((search.walks * search.samples, len(start)), dtype=U64)
    for walk in range(search.walks):
        rng = np.random.default_rng([search.seed, m, walk])
        steps = 3 * m
        odd = rng.integers(0, 1 << 63, steps, dtype=U64) * U64(2) + U64(1)
        picked: dict[int, list[int]] = {}
        for s in range(search.samples):
            for j in rng.choice(steps, search.bits, replace=False).tolist():
                picked.setdefault(j, []).append(walk * search.samples + s)
        at = np.zeros(len(start), dtype=np.int64)
        for j in range(max(picked) + 1):
            symbol = np.where(at < m, h[np.minimum(start + at, len(h) - 1)], U64(0))
            for s in picked.get(j, ()):
                keys[s] = tx.mix(keys[s] * U64(0x9E3779B97F4A7C15) + symbol + U64(j + 1))
            at += ((symbol * odd[j]) >> U64(63)).astype(np.int64) | (at >= m)
    return keys


def least_edits(item: np.ndarray, words: np.ndarray) -> int:
    """Edits at the best place of `words`, as in best_place, by bit-parallel columns (Myers, 1999)."""
    peq: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        peq[w] = peq.get(w, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best = score
    for w in words.tolist():
        eq = peq.get(w, 0)
        down = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(across | plus))
        fall = plus & across
        score += bool(up & top) - bool(fall & top)
        up, fall = (up << 1) & full, (fall << 1) & full
        plus, minus = fall | (full & ~(down | up)), up & down
        best = min(best, score)
    return best


def best_place(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end): the place of `words` at the least edit distance from the item (Sellers, 1980)."""
    row = [(0, j) for j in range(len(words) + 1)]
    words_ = words.tolist()
    for i, w in enumerate(item.tolist(), 1):
        left = (i, 0)
        above, new = row, [left]
        for j, x in enumerate(words_, 1):
            a, b = above[j - 1], above[j]
            best = (a[0] + (w != x), a[1])
            if b[0] + 1 < best[0]:
                best = (b[0] + 1, b[1])
            if left[0] + 1 < best[0]:
                best = (left[0] + 1, left[1])
            left = best
            new.append(best)
        row = new
    end = min(range(len(row)), key=lambda j: (row[j][0], j))
    return row[end][0], row[end][1], end


class Index:
    """LSH tables of a block of items (item_id, text)."""

    def __init__(self, ids: list, texts: list[str | None], search: Search):
        self.search, column = search, pa.array(texts, pa.large_string())
        w = tx.words(*tx.bytes_of(column))
        n = np.diff(w.ptr)
        keep = np.flatnonzero(n > 0)
        self.ids = [ids[i] for i in keep]
        self.words = [w.hash[w.ptr[i] : w.ptr[i + 1]] for i in keep]
        pairs = tx.ngrams(w, 2)
        inside = np.zeros(len(pairs), bool)
        for i in keep:
            inside[w.ptr[i] : w.ptr[i + 1] - 1] = True
        self.pairs = np.unique(pairs[inside])
        self.mask = np.zeros(1 << 20, bool)
        self.mask[(self.pairs & U64((1 << 20) - 1)).astype(np.int64)] = True
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        # an item of few words is one exact piece and needs no embedding
        lengths = np.array([grid(len(x), search.least_words) if len(x) >= search.least_words else 0 for x in self.words], dtype=np.int64)
        for m in np.unique(lengths[lengths > 0]).tolist():
            of = np.flatnonzero(lengths == m)
            flat = np.concatenate([self.words[i][:m] for i in of])
            keys = embed_keys(flat, np.arange(len(of)) * m, m, search)
            self.tables[m] = [(k[o := np.argsort(k, kind="stable")], of[o]) for k in keys]
        self.pieces = self.cut(w, keep)

    def edits(self, n: int) -> int:
        return n * self.search.percent // 100 if n >= self.search.least_words else 0

    def cut(self, w: tx.Words, keep: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: sorted (key, item, offset) of the edits + 1 disjoint pieces of every item."""
        held: dict[int, list[tuple[int, int, int]]] = {}
        for k, i in enumerate(keep.tolist()):
            n = len(self.words[k])
            ends = np.linspace(0, n, self.edits(n) + 2).astype(np.int64).tolist()
            for a, b in zip(ends, ends[1:]):
                held.setdefault(b - a, []).append((k, a, int(w.ptr[i]) + a))
        out = {}
        for size, rows in held.items():
            item, offset, at = np.array(rows, dtype=np.int64).T
            key = tx.ngrams(w, size)[at]
            o = np.argsort(key, kind="stable")
            out[size] = key[o], item[o], offset[o]
        return out

    def seeds(self, w: tx.Words) -> np.ndarray:
        """Distinct (text, item, start): where an item would start by a piece that the text holds."""
        doc = np.repeat(np.arange(len(w.ptr) - 1), np.diff(w.ptr))
        found = [np.zeros((0, 3), dtype=np.int64)]
        for size, (known, item, offset) in self.pieces.items():
            at = np.flatnonzero(np.arange(len(w.hash)) + size <= w.ptr[doc + 1])
            key = tx.ngrams(w, size)[at]
            lo = np.searchsorted(known, key)
            hit = known[np.minimum(lo, len(known) - 1)] == key
            at, key, lo = at[hit], key[hit], lo[hit]
            many = np.searchsorted(known, key, "right") - lo
            row = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
            at = np.repeat(at, many)
            found.append(np.stack([doc[at], item[row], at - offset[row]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def windows(self, w: tx.Words, m: int) -> np.ndarray:
        """Starts of m-word windows within a text that pass the gate."""
        doc = np.repeat(np.arange(len(w.ptr) - 1), np.diff(w.ptr))
        starts = np.flatnonzero(np.arange(len(w.hash)) + m <= w.ptr[doc + 1])
        total = self.total
        # the first m words of an item may hold all its edits, but no more than its whole length allows
        least = max(1, m - 1 - 2 * self.edits(m * 5 // 4 + 1))
        return starts[total[starts + m - 1] - total[starts] >= least]

    def search_texts(self, w: tx.Words) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, start word, words) of the best place of each item in each text."""
        if not len(w.hash) or not self.words:
            return []
        pairs = tx.ngrams(w, 2)
        hit = self.mask[(pairs & U64((1 << 20) - 1)).astype(np.int64)]
        some = np.flatnonzero(hit)
        hit[some] = self.pairs[np.minimum(np.searchsorted(self.pairs, pairs[some]), len(self.pairs) - 1)] == pairs[some]
        self.total = np.concatenate(([0], np.cumsum(hit)))
        found: set[tuple[int, int, int]] = set(map(tuple, self.seeds(w).tolist()))
        for m, tables in self.tables.items():
            start = self.windows(w, m)
            if not len(start):
                continue
            text = np.searchsorted(w.ptr, start, "right") - 1
            for key, (known, item) in zip(embed_keys(w.hash, start, m, self.search), tables):
                lo, hi = np.searchsorted(known, key), np.searchsorted(known, key, "right")
                at = np.flatnonzero(hi > lo)
                for i in at.tolist():
                    for k in range(lo[i], hi[i]):
                        found.add((int(text[i]), int(item[k]), int(start[i])))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        seen: dict[tuple[int, int], int] = {}
        for t, k, s in sorted(found):
            item = self.words[k]
            slack = max(1, self.edits(len(item)))
            # a candidate that a verified stretch covers adds nothing
            if s < seen.get((t, k), s):
                continue
            lo, hi = max(int(w.ptr[t]), s - 2 * slack), min(int(w.ptr[t + 1]), s + len(item) + 3 * slack)
            seen[t, k] = s + slack
            least = least_edits(item, w.hash[lo:hi])
            if least <= self.edits(len(item)) and ((t, k) not in best or least < best[t, k][0]):
                d, a, b = best_place(item, w.hash[lo:hi])
                best[t, k] = (d, lo + a - int(w.ptr[t]), b - a)
        return [(t, k, *x) for (t, k), x in sorted(best.items())]


def matches(docs: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """(doc_id, item_id, item_words, edits, start_word, n_words): the best place of each item in each text that has one.

    Items of fewer than least_words words match word for word only; null items and
    those without words match nothing.  Null and empty texts have no match; a text
    shorter than an item matches where the words that it lacks are within the edits
    allowed, and a text of any length is searched whole, in one piece.  Of places
    that tie in edits, the first found in the text counts.  Ids may be of any type.
    Repeated rows match as often as they occur, repeated items likewise; an empty
    table on either side gives no rows; other columns are ignored.  Items are
    held in blocks of bounded size, each against all texts, without a shuffle.
    """
    spark, rows = docs.sparkSession, docs.select("doc_id", "text")
    items = items.select("item_id", "text")
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("item_words", T.LongType()),
        T.StructField("edits", T.LongType()), T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType()),
    ])
    id_type = to_arrow_type(items.schema["item_id"].dataType)
    blocks, parts = max(1, -(-items.count() // search.block)), []
    for b in range(blocks):
        held = items.where(F.expr(f"pmod(xxhash64(item_id, text), {blocks}) = {b}")).orderBy("item_id", "text").collect() if blocks > 1 else items.orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast(([r[0] for r in held], [r[1] for r in held]))

        def run(batches, sent=sent):
            index = Index(*sent.value, search)
            for batch in batches:
                buf, off = tx.bytes_of(batch.column(1))
                for i, _, part, o in tx.chunks(buf, off, 1 << 20):
                    if out := index.search_texts(tx.words(part, o)):
                        t, k, d, s, n = zip(*out)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(np.array(t) + i)), pa.array([index.ids[x] for x in k], id_type)]
                            + [pa.array(x, pa.int64()) for x in ([len(index.words[x]) for x in k], d, s, n)],
                            names=schema.names,
                        )

        parts.append(rows.mapInArrow(run, schema))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
