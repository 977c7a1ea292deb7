"""Phrases that hold together, mined from vertical positional inverted lists.

Texts are dealt into blocks of one language.  A block keeps a list of positions for
each of its words; positions skip one at the end of a piece, so that neighbours in a
list of positions are neighbours in a piece.  Level by level:

1. Each block tells the length of each of its lists; the lengths of a phrase, added
   up over the blocks, are its exact frequency.  A sketch of all lengths, which never
   underestimates, spares those that cannot be frequent.  Only what is frequent goes
   back to the blocks, with an id.
2. A block drops the lists of infrequent phrases and merges the others: a phrase at
   position p is extended by the word after it where the phrase that ends there, which
   begins at p + 1, is frequent too; the positions p of each such pair are the list of
   a phrase one word longer.

No more than lists of positions, lengths and ids ever moves; of phrases of two and more
words a block sends what falls into a bucket of phrases as one row, and gets its answers so.  The id of a phrase is the
place (block and list) where it first occurs, so phrases are told apart exactly.  What
follows works on frequent phrases alone: each carries the frequencies of its first and
of its last 1, 2, ... words, from which all cuts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgspark.llm import sketch
from kgspark.llm import text as tx
from kgspark.llm.op6_language_model import _pack, _unpack
from kgspark.llm.shared import drop_table, materialize

U64 = np.uint64
#: bytes that end a piece, and those that end a word
_PIECE = np.zeros(256, dtype=bool)
_PIECE[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _PIECE.copy()
_GAP[[9, 32]] = True
#: bits of a phrase's id that tell its list within its first block; the others tell the block
_LIST_BITS = 28
#: blocks in a file, so that a task that reads or writes many holds few at once
_ROWS_A_FILE = 4
#: words of all texts for each bucket of phrases, about
_BUCKET = 1 << 23
#: languages up to which their totals are broadcast; beyond it they are shuffled
_FEW = 100_000


@dataclass(frozen=True)
class Mining:
    """min_count: occurrences in its language that a candidate needs; most_words: words of the longest;
    top: phrases reported for a language; block_bytes: bytes of text in a block, about;
    most_cells: cells of a row of the sketch at most, so that it takes 64 MB whatever the input."""

    min_count: int = 100
    most_words: int = 5
    top: int = 2000
    block_bytes: int = 8 << 20
    most_cells: int = 1 << 26


class Block:
    """Words of one language from some texts, as they come: their bytes and positions."""

    def __init__(self):
        self.hash, self.term, self.at, self.next, self.bytes = [], [], [], 0, 0

    def add(self, buf: np.ndarray, off: np.ndarray) -> None:
        """The words of the texts buf[off[i]:off[i + 1]]."""
        w = tx.words(buf, off, _GAP)
        if not len(w.hash):
            return
        ends = np.concatenate(([0], np.cumsum(_PIECE[buf])))[w.start]
        new = np.ones(len(w.hash), bool)
        new[1:] = ends[1:] != ends[:-1]
        new[w.ptr[:-1][np.diff(w.ptr) > 0]] = True
        at = self.next + np.cumsum(new) + np.arange(len(new))
        _, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        self.hash.append((w.hash[first], inverse))
        self.term.append(tx.strings(buf, w.start[first], w.end[first]))
        self.at.append(at)
        self.next, self.bytes = int(at[-1]) + 1, self.bytes + len(buf)

    def row(self, block: int, lang: str) -> pa.RecordBatch:
        """(block, lang, words, n, lists): the lists of positions in order of the words' hashes."""
        keys = np.concatenate([k for k, _ in self.hash])
        _, first, local = np.unique(keys, return_index=True, return_inverse=True)
        start = np.concatenate(([0], np.cumsum([len(k) for k, _ in self.hash])))
        word = np.concatenate([local[s + inverse] for s, (_, inverse) in zip(start, self.hash)])
        n, lists = _lists(word, np.concatenate(self.at), len(first))
        words = pa.concat_arrays(self.term).take(pa.array(first)).cast(pa.string())
        one = lambda x, kind: pa.array([x], pa.list_(kind))
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([lang]), one(words, pa.string()), one(n, pa.int64()), pa.array([lists])], names=["block", "lang", "words", "n", "lists"])


def _lists(key: np.ndarray, at: np.ndarray, keys: int) -> tuple[np.ndarray, bytes]:
    """(lengths, packed positions) of the lists of keys 0, 1, ...; positions by key, each list in order, as steps."""
    order = np.argsort(key, kind="stable")
    n = np.bincount(key, minlength=keys)
    return n, _pack(np.diff(at[order], prepend=0).astype(np.int64))


def _blocks(block_bytes: int):
    """Rows (lang, text) as blocks; whole texts, but that a text larger than a chunk is cut between pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, Block] = {}

        def full(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            block = held.pop(lang)
            if block.at:
                made += 1
                yield block.row(task << 15 | made - 1, lang)

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(langs.indices.to_numpy() == code)
                for _, _, buf, off in tx.chunks(*tx.bytes_of(batch.column(1).take(pa.array(mine)))):
                    for part, ends in _cut(buf, off):
                        block = held.setdefault(lang, Block())
                        block.add(part, ends)
                        if block.bytes >= block_bytes:
                            yield from full(lang)
                        while sum(b.bytes for b in held.values()) > 2 * block_bytes:  # many languages in one task
                            yield from full(max(held, key=lambda x: held[x].bytes))
        for lang in list(held):
            yield from full(lang)
        tx.trim()

    return run


def _cut(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A chunk of several texts as it is; a single long text in parts that end where a piece ends."""
    start = 0
    while len(off) == 2 and len(buf) - start > tx.CHUNK:
        ends = np.flatnonzero(_PIECE[buf[start : start + tx.CHUNK]])
        if len(ends):
            end = start + int(ends[-1]) + 1
        else:  # a piece of more than a chunk stays whole
            later = np.flatnonzero(_PIECE[buf[start + tx.CHUNK :]])
            if not len(later):
                break
            end = start + tx.CHUNK + int(later[0]) + 1
        yield buf[start:end], np.array([0, end - start])
        start = end
    yield buf[start:], off - start if len(off) == 2 and start else off


_LONGER = "block bigint, prefix array<bigint>, suffix array<bigint>, n array<bigint>, lists binary"


def _extended(lists: pa.Table, told: pa.Table) -> pa.Table:
    """A block's lists of phrases one word longer, from its lists (block, n, lists) and what is frequent (block, list, id)."""
    names = [x.split(" ")[0] for x in _LONGER.split(", ")]
    kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
    schema = pa.schema(list(zip(names, kinds)))
    if not len(told) or not len(lists):
        return schema.empty_table()
    n = lists.column("n")[0].values.to_numpy()
    at = np.cumsum(_unpack(lists.column("lists")[0].as_py(), np.int64))
    ids = np.full(len(n), -1, np.int64)
    if "ids" in told.column_names:
        for place, found in zip(told.column("list"), told.column("ids")):
            ids[np.cumsum(_unpack(place.as_py(), np.int64))] = _unpack(found.as_py(), np.int64)
    else:
        ids[told.column("list").to_numpy()] = told.column("id").to_numpy()
    id_ = np.repeat(ids, n)
    at, id_ = at[id_ >= 0], id_[id_ >= 0]
    # all lists merged by position: what follows at once begins with the next word
    order = np.argsort(at)
    at, id_ = at[order], id_[order]
    near = np.flatnonzero(np.diff(at) == 1)
    known, local = np.unique(id_, return_inverse=True)
    pair = local[near] * len(known) + local[near + 1]
    keys, key = np.unique(pair, return_inverse=True)
    if not len(keys):
        return schema.empty_table()
    size, packed = _lists(key, at[near], len(keys))
    cells = [lists.column("block")[0].as_py(), known[keys // len(known)], known[keys % len(known)], size, packed]
    return pa.table([pa.array([x], kind) for x, kind in zip(cells, kinds)], schema=schema)


def _hashes(batch: pa.RecordBatch, row: int, key: list[str]) -> np.ndarray:
    """A hash of each key of a block: of its language and word, or of the ids of its two ends."""
    names = batch.schema.names
    parts = [batch.column(names.index(k))[row].values for k in key]
    if len(parts) == 1:
        buf, off = tx.bytes_of(parts[0])
        seed = int.from_bytes(blake2b(batch.column(names.index("lang"))[row].as_py().encode(), digest_size=8).digest(), "little")
        return tx.mix(tx.hashes(buf, off[:-1], off[1:]) + U64(seed))
    return tx.mix(tx.mix(parts[0].to_numpy().astype(U64)) + parts[1].to_numpy().astype(U64))


def _sketched(key: list[str], width: int, full: int):
    """The lengths of all lists of a task's blocks, in a sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = sketch.Sketch(width, full, 1)
        for batch in batches:
            for row in range(len(batch)):
                made.add_hashes(_hashes(batch, row, key), batch.column(batch.schema.names.index("n"))[row].values.to_numpy())
        yield from made.parts()
        tx.trim()

    return run


def _told(key: list[str], sent, full: int):
    """Rows (block, list, n, lang?, *key) of the lists that the sketch lets pass, numbered in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for row in range(len(batch)):
                at = pa.array(np.flatnonzero(sketch.passes(sent.value, _hashes(batch, row, key), full)))
                cells = [pa.repeat(batch.column(names.index(c))[row], len(at)) for c in ("block", "lang") if c in names]
                lists = [batch.column(names.index(c))[row].values.take(at) for c in ("n", *key)]
                yield pa.RecordBatch.from_arrays([cells[0], pa.array(np.arange(len(at))), *cells[1:], *lists], names=["block", "list", *names[1 : len(cells)], "n", *key])
        tx.trim()

    return run


_SENT = "bucket int, block bigint, list binary, n binary, prefix binary, suffix binary"
_COUNTED = "block bigint, list binary, ids binary, id bigint, prefix bigint, suffix bigint, f bigint"


def _steps(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=0))


def _sent(key: list[str], sent, full: int, buckets: int):
    """The lists that the sketch lets pass, numbered in their order: a row for each block and bucket of phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for row in range(len(batch)):
                h = _hashes(batch, row, key)
                at = np.flatnonzero(sketch.passes(sent.value, h, full))
                bucket = ((h[at] >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
                n, prefix, suffix = (batch.column(names.index(c))[row].values.to_numpy() for c in ("n", *key))
                cells = {c: [] for c in ("list", "n", "prefix", "suffix")}
                some = np.flatnonzero(np.diff(edge))
                for b in some.tolist():
                    mine = order[edge[b] : edge[b + 1]]
                    for c, x in zip(cells, (_steps(mine), _pack(n[at[mine]]), _steps(prefix[at[mine]]), _pack(suffix[at[mine]]))):
                        cells[c].append(x)
                if len(some):
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "block": pa.repeat(batch.column(names.index("block"))[row], len(some)), **{c: pa.array(x, pa.binary()) for c, x in cells.items()}})
        tx.trim()

    return run


def _counted(least: int):
    """Rows in order of their bucket: for each block the ids of its frequent lists (list, ids), and each frequent phrase (id, prefix, suffix, f)."""
    kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    names = [x.split(" ")[0] for x in _COUNTED.split(", ")]

    def rows(m: int, **cells) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cells[c], k) if c in cells else pa.nulls(m, k) for c, k in zip(names, kinds)], names=names)

    def close(held: list) -> Iterator[pa.RecordBatch]:
        blocks, lists, n, prefix, suffix = zip(*held)
        block, list_ = np.repeat(blocks, [len(x) for x in lists]), np.concatenate(lists)
        n, prefix, suffix = np.concatenate(n), np.concatenate(prefix), np.concatenate(suffix)
        place = block << _LIST_BITS | list_
        order = np.lexsort((place, suffix, prefix))
        new = np.ones(len(order), bool)
        new[1:] = (prefix[order[1:]] != prefix[order[:-1]]) | (suffix[order[1:]] != suffix[order[:-1]])
        head = np.flatnonzero(new)
        f = np.add.reduceat(n[order], head)
        stay = f >= least
        if not stay.any():
            return
        first = order[head]
        ids = np.full(len(order), -1, np.int64)
        ids[order] = np.repeat(np.where(stay, place[first], -1), np.diff(np.append(head, len(order))))
        yield rows(int(stay.sum()), id=place[first][stay], prefix=prefix[first][stay], suffix=suffix[first][stay], f=f[stay])
        edge = np.cumsum([0, *map(len, lists)]).tolist()
        for one, a, b in zip(blocks, edge[:-1], edge[1:]):
            known = ids[a:b] >= 0
            if known.any():
                yield rows(1, block=[one], list=[_steps(list_[a:b][known])], ids=[_pack(ids[a:b][known])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for bucket, block, *cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *batch.columns[2:]):
                if bucket != last and held:
                    yield from close(held)
                    held = []
                last = bucket
                list_, n, prefix, suffix = (_unpack(x.as_py(), np.int64) for x in cells)
                held.append((block, np.cumsum(list_), n, np.cumsum(prefix), suffix))
        if held:
            yield from close(held)
        tx.trim()

    return run


def _thinned(key: list[str], sent, full: int):
    """Rows (block, n, lists) with the lists only that the sketch lets pass: what is left moves to the answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for row in range(len(batch)):
                stay = sketch.passes(sent.value, _hashes(batch, row, key), full)
                if not stay.any():
                    continue
                n = batch.column(names.index("n"))[row].values.to_numpy()
                at = np.cumsum(_unpack(batch.column(names.index("lists"))[row].as_py(), np.int64))[np.repeat(stay, n)]
                cells = [pa.array([n[stay]], pa.list_(pa.int64())), pa.array([_pack(np.diff(at, prepend=0))], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(names.index("block")).slice(row, 1), *cells], names=["block", "n", "lists"])
        tx.trim()

    return run


def _frequent(lists: DataFrame, key: list[str], mining: Mining, words: int) -> tuple[DataFrame, DataFrame]:
    """(told, thinned): (block, list, id, f, *key) of what is frequent, as a table, and the blocks' lists that it may
    be about, (block, n, lists), in the same numbering.  Rows of lists have the key's arrays, n and lists.

    The key is given once for each phrase, in the row of the place that is its id; where it is two
    ids, told has rows of their own for the phrases (see _counted).
    words: of all texts; the sketch has a cell for each eight of them.
    """
    # a language is part of a word's key; ids of phrases differ between languages
    spark, lead = lists.sparkSession, [c for c in ("lang",) if c in lists.columns]
    full, width = max(1, min(mining.min_count, 255)), sketch.width_for(words // 8, mining.most_cells)
    told = lists.select("block", *lead, "n", *key)
    sent = spark.sparkContext.broadcast(sketch.merged(told.mapInArrow(_sketched(key, width, full), sketch.SCHEMA), width, full, 1))
    thin = lists.select("block", *lead, "n", *key, "lists").mapInArrow(_thinned(key, sent, full), "block bigint, n array<bigint>, lists binary")
    if key == ["prefix", "suffix"]:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // _BUCKET))
        dealt = told.mapInArrow(_sent(key, sent, full, parts), _SENT).repartition(parts, "bucket").sortWithinPartitions("bucket")
        return materialize(dealt.mapInArrow(_counted(mining.min_count), _COUNTED)), thin
    rows = told.mapInArrow(_told(key, sent, full), f"block bigint, list bigint, lang string, n bigint, {key[0]} string")
    place = F.shiftleft("block", _LIST_BITS) + F.col("list")
    over = Window.partitionBy(*lead, *key)
    found = rows.select("*", F.sum("n").over(over).alias("f"), F.min(place).over(over).alias("id")).where(F.col("f") >= mining.min_count)
    out = materialize(found.select("block", "list", "id", "f", *[F.when(place == F.col("id"), F.col(k)).alias(k) for k in [*lead, *key]]))
    return out, thin


def _best_cut(k: int) -> Column:
    """(score, cut, l, r) of the lowest-scoring cut of a phrase of k words, from its columns first, last, f and n."""
    cuts = []
    for j in range(1, k):
        l, r = F.col("first")[j - 1], F.col("last")[k - j - 1]
        wide = lambda c: c.cast("decimal(19,0)")
        score = F.call_function("div", wide(F.col("f")) * wide(F.col("n")) * F.lit(1000), wide(l) * wide(r))
        cuts.append(F.struct(score.alias("score"), F.lit(j).alias("cut"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def phrases(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of docs (text, lang): each language's best phrases.

    a: occurrences of the phrase, l and r: of its parts at the lowest-scoring cut, n: of
    all words, score: floor(1000 a n / (l r)), which is how much oftener than by chance
    the parts meet, in thousandths.  Phrases inside a longer candidate that occurs as
    often are dropped.  Ranks run from 1: score, then a, largest first, then phrase in byte order.

    A null text counts as empty, a null lang as `und`; repeated rows count as often as
    they occur; texts of any length are read whole (a long one is cut between pieces; a
    piece of more than 2^28 words is not supported).  Columns beyond the two are
    ignored, whatever they are called; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    lists = materialize(rows.mapInArrow(_blocks(mining.block_bytes), "block bigint, lang string, words array<string>, n array<bigint>, lists binary"), rows_a_file=_ROWS_A_FILE)
    totals = materialize(lists.groupBy("lang").agg(F.sum(F.expr("aggregate(n, 0L, (a, x) -> a + x)")).alias("n")))
    words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    told, thin = _frequent(lists, ["words"], mining, words)
    once = told.where("words IS NOT NULL")
    known = [materialize(once.select("id", "lang", F.col("words").alias("phrase"), F.col("words").alias("end"), F.array("f").alias("first"), F.array("f").alias("last"), "f"))]
    inside: list[DataFrame] = []
    for k in range(2, mining.most_words + 1):
        if not told.limit(1).count():
            break
        answers = told.where("block IS NOT NULL").select("block", "list", "ids" if "ids" in told.columns else "id")
        longer = thin.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_extended, _LONGER)
        lists = materialize(longer, lists, told, rows_a_file=_ROWS_A_FILE)
        told, thin = _frequent(lists, ["prefix", "suffix"], mining, words)
        p, s = (known[-1].select(*[F.col(c).alias(f"{side}_{c}") for c in names]) for side, names in (("p", ("id", "lang", "phrase", "first")), ("s", ("id", "end", "last"))))
        grown = told.where("prefix IS NOT NULL").select("id", "prefix", "suffix", "f").join(p, F.col("prefix") == F.col("p_id")).join(s, F.col("suffix") == F.col("s_id"))
        more = lambda c: F.concat(f"{c}", F.array("f"))
        known.append(materialize(grown.select("id", "prefix", "suffix", F.col("p_lang").alias("lang"), F.concat_ws(" ", "p_phrase", "s_end").alias("phrase"), F.col("s_end").alias("end"), more("p_first").alias("first"), more("s_last").alias("last"), "f")))
        # the longest of equally frequent phrases stays: whatever holds a phrase has an end of it one word longer
        inside.append(known[-1].where(F.col("first")[k - 2] == F.col("f")).select(F.col("prefix").alias("id")).union(known[-1].where(F.col("last")[k - 2] == F.col("f")).select(F.col("suffix").alias("id"))))
    drop_table(lists)
    drop_table(told)
    found = None
    few = F.broadcast(totals) if totals.count() <= _FEW else totals
    for k, table in enumerate(known[1:], 2):
        left = table if k > len(inside) else table.join(inside[k - 1], "id", "left_anti")
        one = left.join(few, "lang").withColumn("cut", _best_cut(k)).select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= mining.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), n AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) AS ks
  ) GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT f.lang, f.k, f.phrase, f.f AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS tail
  FROM f, (SELECT unnest([1, 2, 3, 4]) AS j) AS js WHERE j < f.k
), s AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.j, l.f AS l, r.f AS r, n.n, (1000 * c.a::HUGEINT * n.n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM c JOIN n ON n.lang = c.lang JOIN f AS l ON l.lang = c.lang AND l.phrase = c.head JOIN f AS r ON r.lang = c.lang AND r.phrase = c.tail
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM f AS q WHERE q.lang = best.lang AND q.k > best.k AND 100 * q.f >= 100 * best.a AND contains(' ' || q.phrase || ' ', ' ' || best.phrase || ' ')
  )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY rank <= 2000
"""
