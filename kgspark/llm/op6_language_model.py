"""Scoring texts with a weighted backoff automaton of a word trigram model.

States are contexts: the pairs of words seen in training, the words seen in
training (and the start of a text), and the empty context.  A state has an arc for
each word that followed its context, and a failure arc to the state of its
context without the first word.  Weights are smoothed probabilities (Dirichlet,
strength m, each order falling back on the next):

    p(w)        = (c(w) + 1/2) / (N + (V + 1) / 2)
    p(w | v)    = (c(v, w) + m p(w)) / (c(v) + m)
    p(w | u v)  = (c(u, v, w) + m p(w | v)) / (c(u, v) + m)

    arc of w in a state      log10 of its p
    failure arc of a state   log10(m / (c(context) + m))

so that an arc and its failure path agree where the longer count is 0, and every
state's weights sum to one over the known words and one unknown.  A text is
traversed once from left to right: the walk carries its state, takes failure arcs
until the state has an arc for the next word, takes that arc to its target, and adds
up the weights.

The model grows with the corpus and is never held in one place.  Texts are dealt
into blocks; each block sends the distinct words, pairs and triples that it needs,
with its own training counts, to the buckets of their hashes; each bucket sums and
answers with the totals; each block builds its part of the automaton and walks
through its texts.  Texts move packed and compressed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.llm import text as tx
from kgspark.llm.shared import materialize, release

U64 = np.uint64
#: hashes of the end and of the start of a text
END, START = U64(0x0123456789ABCDEF), U64(0xFEDCBA9876543210)
#: orders of n-grams that are counted
ORDERS = (1, 2, 3)
#: orders that are asked for at a time: what a round has moved is deleted before the next
_ROUNDS = ((1, 2), (3,))
_STEP = U64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Model:
    """strength: Dirichlet strength m; block_bytes: bytes of text in a block, about;
    bucket_bytes: bytes of text whose n-grams a bucket counts, about."""

    strength: float = 1.0
    block_bytes: int = 8 << 20
    bucket_bytes: int = 4 << 20


@dataclass
class Tokens:
    """Tokens of a block's texts, ends included: the text of each, and the n-grams that
    end there, as positions in the sorted distinct hashes of their order."""

    text: np.ndarray
    gram: list[np.ndarray]
    known: list[np.ndarray]

    @classmethod
    def of(cls, column: pa.Array) -> Tokens:
        buf, off = tx.bytes_of(column)
        parts = [tx.words(p, o) for _, _, p, o in tx.chunks(buf, off)]
        count = np.concatenate([np.diff(w.ptr) for w in parts] or [np.empty(0, np.int64)])
        text = np.repeat(np.arange(len(count)), count + 1)
        word = np.empty(len(text), U64)
        last = np.cumsum(count + 1) - 1
        first = last - count
        inner = np.ones(len(text), bool)
        inner[last] = False
        word[inner] = np.concatenate([w.hash for w in parts] or [np.empty(0, U64)])
        word[last] = END
        before = np.empty(len(text), U64)
        before[1:] = word[:-1]
        before[first] = START
        pair = tx.mix(before * _STEP + word)
        triple = np.empty(len(text), U64)
        triple[1:] = tx.mix(pair[:-1] * _STEP + word[1:])
        triple[first] = pair[first]  # only the start stands before: the same arc as of the pair
        found = [np.unique(x, return_inverse=True) for x in (word, pair, triple)]
        return cls(text, [at for _, at in found], [keys for keys, _ in found])


def _dealt(blocks: int):
    """Rows (doc_id, text, held_out, block) as packed tables, one for each block that a batch has."""

    def run(batches):
        for batch in batches:
            ids = batch.column(3).to_numpy()
            order = np.argsort(ids, kind="stable")
            rows = pa.Table.from_batches([batch]).select([0, 1, 2]).take(pa.array(order))
            ids = ids[order]
            edge = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1, append=ids[-1:] + 1))
            out, held = [], []
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as stream:
                    stream.write_table(rows.slice(s, e - s).combine_chunks())
                out.append(zstandard.compress(sink.getvalue(), 1))
                held.append(int(ids[s]))
            if out:
                yield pa.RecordBatch.from_pydict({"block": pa.array(held, pa.int64()), "rows": pa.array(out, pa.binary())})
        tx.trim()

    return run


def _table(packed: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(zstandard.decompress(x)).read_all() for x in packed]).combine_chunks()


def _pack(x: np.ndarray) -> bytes:
    """Byte planes of an array, compressed: the codec of shuffles has no entropy coder."""
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of each bucket in sorted keys."""
    return np.searchsorted((keys >> U64(32)) * U64(buckets) >> U64(32), np.arange(buckets + 1, dtype=U64))


def _runs(batches, key: int):
    """(key, rows as dicts) of rows in order of the key."""
    held, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            at = row[batch.schema.names[key]]
            if held and at != last:
                yield last, held
                held = []
            last = at
            held.append(row)
    if held:
        yield last, held


_ASK = "bucket int, kind int, block bigint, keys binary, counts binary"


def _ask(buckets: int, orders: tuple[int, ...]):
    """What each block needs: for each bucket the hashes of its n-grams and their training counts here."""

    def run(batches):
        for block, held in _runs(batches, 0):
            table = _table([x["rows"] for x in held])
            t = Tokens.of(table.column(1))
            train = ~np.asarray(table.column(2).to_numpy(zero_copy_only=False), bool)[t.text]
            for kind in orders:
                keys, at = t.known[kind - 1], t.gram[kind - 1]
                counts = np.bincount(at[train], minlength=len(keys)).astype(np.uint32)
                edge = _cut(keys, buckets)
                for b in np.flatnonzero(np.diff(edge)).tolist():
                    s = slice(edge[b], edge[b + 1])
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "kind": pa.array([kind], pa.int32()), "block": pa.array([block], pa.int64()), "keys": [_pack(np.diff(keys[s], prepend=U64(0)))], "counts": [_pack(counts[s])]})
        tx.trim()

    return run


_ANSWER = "block bigint, bucket int, kind int, counts binary, tokens bigint, types bigint"


def _answer(batches):
    """The corpus counts of what the blocks asked, a bucket at a time."""
    for bucket, rows in _runs(batches, 0):
        for kind in ORDERS:
            asked = [(x["block"], np.cumsum(_unpack(x["keys"], U64)), _unpack(x["counts"], np.uint32)) for x in rows if x["kind"] == kind]
            if not asked:
                continue
            keys, at = np.unique(np.concatenate([k for _, k, _ in asked]), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([c for *_, c in asked]).astype(np.float64), minlength=len(keys)).astype(np.int64)
            sums, start = (int(total.sum()), int((total > 0).sum())) if kind == 1 else (0, 0), 0
            for i, (block, k, _) in enumerate(asked):
                mine = total[at[start : start + len(k)]]
                start += len(k)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "bucket": pa.array([bucket], pa.int32()), "kind": pa.array([kind], pa.int32()), "counts": [_pack(mine)], "tokens": pa.array([sums[0] if i == 0 else 0], pa.int64()), "types": pa.array([sums[1] if i == 0 else 0], pa.int64())})
    tx.trim()


class Automaton:
    """The part of the model that a block's texts can reach.

    An n-gram that training has is an arc, from the state of its first words to the
    state of its last ones; pairs and words that training has are states too.
    arc[k], failure[k]: weights by position in the sorted hashes of (k + 1)-grams,
    not a number where there is no arc or no state.
    """

    def __init__(self, t: Tokens, counts: list[np.ndarray], total: int, types: int, strength: float):
        one, two, three = counts
        m, word, pair, triple = strength, *t.gram
        p1 = (one + 0.5) / (total + 0.5 * (types + 1))
        # every text that trained the model starts once and ends once
        ends = np.searchsorted(t.known[0], END)
        starts = int(one[ends]) if ends < len(one) and t.known[0][ends] == END else 0
        first = np.ones(len(t.text), bool)
        first[1:] = t.text[1:] != t.text[:-1]
        self.first, self.starts = first, starts
        # how often each n-gram's context was followed, by n-gram: from any of its places
        seen1 = np.empty(len(two), np.int64)
        seen1[pair[1:]] = one[word[:-1]]
        seen1[pair[first]] = starts
        low = np.empty(len(two))
        low[pair] = p1[word]
        p2 = (two + m * low) / (seen1 + m)
        seen2, base = np.zeros(len(three), np.int64), np.empty(len(three))
        seen2[triple[1:]] = two[pair[:-1]]
        base[triple] = p2[pair]
        with np.errstate(divide="ignore", invalid="ignore"):
            self.base = np.log10(p1)
            self.arc = [np.where(c > 0, np.log10(p), np.nan) for c, p in ((one, p1), (two, p2), (three, (three + m * base) / (seen2 + m)))]
        self.failure = [np.log10(m / (c + m)) for c in (one, two)]
        self.start = float(np.log10(m / (starts + m)))
        self.t = t

    def walk(self) -> np.ndarray:
        """The weight of each text: one walk from left to right that carries its state."""
        word, pair, triple = self.t.gram
        total = np.zeros(int(self.t.text[-1]) + 1 if len(word) else 0)
        fall1, fall2 = np.empty(len(word)), np.empty(len(word))
        fall1[1:], fall2[1:] = self.failure[0][word[:-1]], self.failure[1][pair[:-1]]
        fall1[self.first] = self.start
        edge = [*np.flatnonzero(self.first).tolist(), len(word)]
        arcs = [a[g] for a, g in zip(self.arc, self.t.gram)]
        root = self.base[word]
        for text, (s, e) in enumerate(zip(edge, edge[1:])):
            state, sum_ = 1, 0.0  # words of the state's context: at first, the start of the text
            for a1, a2, a3, f1, f2, p in zip(*(x[s:e].tolist() for x in (arcs[0], arcs[1], arcs[2], fall1, fall2, root))):
                if state == 2:
                    if a3 == a3:  # the state has an arc for the word
                        sum_ += a3
                        continue
                    sum_ += f2
                    state = 1
                if state == 1:
                    if a2 == a2:
                        sum_ += a2
                        state = 2
                        continue
                    sum_ += f1
                sum_ += p
                state = 1 if a1 == a1 else 0
            total[text] = sum_
        return total


def _placed(spark: SparkSession, blocks: int) -> list[int]:
    """A number for each block, so that hashing the numbers deals one block to each of as many tasks."""
    if blocks > 4096:
        return []
    found = spark.range(64 * blocks).select("id", F.expr(f"pmod(hash(id), {blocks})").alias("p")).groupBy("p").agg(F.min("id").alias("id")).orderBy("p").collect()
    return [r["id"] for r in found] if len(found) == blocks else []


def score_texts(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of docs (doc_id, text, held_out).

    The model learns from the rows whose held_out is false (null: false).  A null
    text counts as empty: one token, its end.  Repeated rows, and rows that tie in
    doc_id, count and are scored as often as they occur.  A text of any length is
    scored whole, in one block.  With nothing to learn from every count is 0.  An
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, parts = max(1, -(-size // model.block_bytes)), int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * parts, -(-size // model.bucket_bytes))
    # rows that repeat an id and a length are spread by their place
    block = F.expr(f"pmod(xxhash64(doc_id, octet_length(text), monotonically_increasing_id()), {blocks})")
    placed = _placed(spark, blocks)
    block = F.element_at(F.array(*[F.lit(x).cast("long") for x in placed]), (block + 1).cast("int")) if placed else block.cast("long")
    dealt = rows.withColumn("block", block).mapInArrow(_dealt(blocks), "block bigint, rows binary")
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    blocked = materialize(dealt)
    told = []
    for orders in _ROUNDS:
        asked = blocked.repartition(int(blocks), "block").sortWithinPartitions("block").mapInArrow(_ask(buckets, orders), _ASK)
        told.append(materialize(asked.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_answer, _ANSWER)))
        del asked
        release(spark)
    answers = told[0].union(told[1])
    total, types = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()

    def score(batches):
        for _, held in _runs(batches, 0):
            texts = [x["rows"] for x in held if x["rows"] is not None]
            if not texts:
                continue
            table = _table(texts)
            t = Tokens.of(table.column(1))
            told = [x for x in held if x["counts"] is not None]
            counts = [np.concatenate([_unpack(x["counts"], np.int64) for x in sorted((x for x in told if x["kind"] == k), key=lambda x: x["bucket"])]) for k in ORDERS]
            a = Automaton(t, counts, total, types, model.strength)
            n, word = table.num_rows, t.gram[0]
            yield pa.RecordBatch.from_arrays(
                [
                    table.column(0).combine_chunks(), table.column(2).combine_chunks(), pa.array(np.bincount(t.text, minlength=n)), pa.array(np.bincount(t.text, counts[0][word] > 0, n).astype(np.int64)),
                    pa.array(np.full(n, total, np.int64)), pa.array(np.bincount(t.text, a.base[word], n)), pa.array(a.walk()),
                ],
                names=schema.names,
            )
        tx.trim()

    texts = blocked.select("block", "rows", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("int").alias("kind"), F.lit(None).cast("binary").alias("counts"))
    counted = answers.select("block", F.lit(None).cast("binary").alias("rows"), "bucket", "kind", "counts")
    return materialize(texts.union(counted).repartition(int(blocks), "block").sortWithinPartitions("block").mapInArrow(score, schema), *told, blocked)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_texts(docs.select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1).alias("held_out")))
