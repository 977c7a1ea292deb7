"""Exact set-similarity self-join over shingle sets.

Records (whole documents, or their lines) become sets of 64-bit shingles.  The
join is exact for Jaccard similarity >= percent / 100:

1. Records with equal sets fold into one node (a 64-bit fingerprint of the set).
2. A count sketch of fixed size over all shingles gives each a rarity level.  A
   global order sorts by (level, hash): rare shingles first.  There are `orders` of
   them, each with a hash of its own.
3. Two similar sets of n tokens share one of the first n - ceil(t n) + 1 tokens
   under *any* global order, and more of a longer prefix.  A token is indexed if it
   is in the prefix under one of the orders, with the orders of which that holds;
   nodes under one token form a group.
4. Groups of bounded size give pairs that pass the length filter and, where
   postings carry positions, the positional filter: two sets that share a token at
   positions i and j have at most min(i, j) tokens in common before it and as many
   after it as the shorter rest.  The candidates are the intersection over all
   orders: a pair must share as many prefix tokens as its two sizes demand under
   each of them (see _need).  This comes before any set is moved.
5. A hot group is not expanded into pairs: each class of set sizes in it has a pivot,
   the node with the most shared tokens for its size; each member is checked
   against the pivots of its own class and of the next smaller one, so any two
   members whose sizes allow a link share a pivot.  In the index a hot token costs
   one row per map task.  What the pivots leave open is compared in blocks
   (kgspark.llm.blocks), which give links, not pairs.

What is broadcast has a fixed size: the level table (2**sketch_bits bytes) and
a Bloom filter (2**bloom_bits bits) of nodes with candidates.  Neither affects
results: any total order is valid, and a full Bloom filter only lets more rows
through to an exact join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.llm import text as tx
from kgspark.llm.shared import attach, drop_table, materialize, release

U64 = np.uint64
_PARTS = 16
#: pairs that a task holds at once before they are filtered, about
_PAIRS = 250_000
#: rows of one kind that a task adds up before it sends them on, about
_SUMS = 1_000_000
#: buckets of postings that a task gathers, one after the other
_BUCKETS = 3
#: marks the one posting that stands for a group that is hot within its task
_MARK = np.uint32(1 << 31)


@dataclass(frozen=True)
class Join:
    """shingle: words a token; percent: least Jaccard similarity in hundredths, 50 or more;
    lines: records are lines with a word, not whole texts; orders: global token orders
    that candidates must agree under; extra: further tokens that the index holds under
    each order, in hundredths of a set, for a stronger filter; sketch_bits: log2 of
    the sketch's counters; bloom_bits: log2 of the Bloom filter's bits;
    flush: postings that a map task holds before it sends them on; bucket: postings
    that a task gathers at once, about; group: nodes under one token beyond which its
    group is hot; block: nodes of a hot group that are compared at once."""

    shingle: int = 5
    percent: int = 75
    lines: bool = False
    orders: int = 3
    extra: int = 10
    sketch_bits: int = 20
    bloom_bits: int = 25
    flush: int = 400_000
    bucket: int = 1_000_000
    group: int = 16
    block: int = 512

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Tokens of a set of n that any similar set shares one of, under any global order."""
        return n - (n * self.percent + 99) // 100 + 1

    def indexed(self, n: np.ndarray) -> np.ndarray:
        """Tokens of a set of n that the index holds under each order: the prefix and `extra` more."""
        return np.minimum(n, self.prefix(n) + (n * self.extra + 99) // 100)


#: lines hold one order with positions
LINES = Join(lines=True, orders=1, group=32)


def _line_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, row, line) of the \\n-split lines of all texts; a line keeps its \\n, which is no word."""
    inner = np.flatnonzero(buf == 10) + 1
    cut = np.unique(np.concatenate((inner, off)))
    if len(cut) < 2:
        return np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    row = np.searchsorted(off, cut[:-1], "right") - 1
    head = np.searchsorted(cut, off[row])
    return cut, row, np.arange(len(row)) - head


def _records(batch: pa.RecordBatch, join: Join) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]]:
    """(row, line, tokens, ptr) for runs of a batch's records."""
    buf, off = tx.bytes_of(batch.column(1))
    for i, _, part, o in tx.chunks(buf, off):
        if join.lines:
            cut, row, line = _line_bounds(part, o)
            tokens, ptr = tx.shingle_sets(tx.words(part, cut), join.shingle)
            yield row + i, line, tokens, ptr
        else:
            tokens, ptr = tx.shingle_sets(tx.words(part, o), join.shingle)
            yield np.arange(len(o) - 1) + i, None, tokens, ptr


def _nodes(tokens: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A fingerprint of each set (sums do not depend on the order of tokens)."""
    size = np.diff(ptr)
    out = np.zeros(len(size), dtype=U64)
    if len(tokens):
        at = ptr[:-1][size > 0]
        out[size > 0] = tx.mix(np.add.reduceat(tx.mix(tokens ^ U64(0x5851F42D4C957F2D)), at) + tx.mix(size[size > 0].astype(U64)))
    return out.view(np.int64)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, (pa.Array, list)) else pa.array(v) for k, v in columns.items()})


def _planes(x: np.ndarray) -> bytes:
    """The bytes of an array plane by plane, which compresses well."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplanes(data: np.ndarray, kind) -> np.ndarray:
    return data.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _pack(tokens: np.ndarray) -> bytes:
    """A sorted set of tokens."""
    return _planes(np.diff(tokens, prepend=U64(0)))


def unpack(blob) -> np.ndarray:
    return np.cumsum(_unplanes(np.frombuffer(blob.as_buffer(), np.uint8), U64))


def _marks(tokens: np.ndarray) -> bytes:
    """24 bits of each token, sorted: a quarter of the set's bytes."""
    marks = (tx.mix(tokens) >> U64(40)).astype(np.uint32)
    marks.sort()
    return _planes(np.diff(marks, prepend=np.uint32(0)))


def _read_marks(blob) -> np.ndarray:
    return np.cumsum(_unplanes(np.frombuffer(blob.as_buffer(), np.uint8), np.uint32), dtype=np.uint32)


def _describe(join: Join):
    """Records as rows, and this task's part of the sketch as blobs."""

    def run(batches):
        size, counts = 1 << join.sketch_bits, None
        for batch in batches:
            for row, line, tokens, ptr in _records(batch, join):
                n = np.diff(ptr).astype(np.int64)
                keep = n > 0 if join.lines else np.ones(len(n), bool)
                node = _nodes(tokens, ptr)
                add = np.bincount((tokens & U64(size - 1)).astype(np.int64), minlength=size)
                counts = add if counts is None else np.add(counts, add, out=counts)
                if keep.any():
                    ids = batch.column(0).take(pa.array(row[keep]))
                    m = int(keep.sum())
                    yield _batch(doc_id=ids, line=(line[keep] if line is not None else np.zeros(m, np.int64)), n=n[keep], node=pa.array(node[keep], mask=n[keep] == 0), part=pa.nulls(m, pa.int32()), blob=pa.nulls(m, pa.binary()))
        if counts is not None:
            blobs = [_planes(x.astype(np.uint32)) for x in np.split(counts, _PARTS)]
            none = pa.nulls(_PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(_PARTS, batch.column(0).type), none, none, none, pa.array(range(_PARTS), pa.int32()), pa.array(blobs)], names=["doc_id", "line", "n", "node", "part", "blob"])

    return run


def _fold(blobs: DataFrame, read, add) -> dict[int, np.ndarray]:
    """The blobs (part, blob) of each part, read and added up in two rounds; a task holds one sum a part."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = read(np.frombuffer(blob.as_buffer(), np.uint8))
                held[part] = add(held[part], x, out=held[part]) if part in held else x.copy()
        for part, x in held.items():
            yield _batch(part=np.array([part], np.int32), blob=[x.tobytes()])

    def again(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(blob.as_buffer(), kind)
                held[part] = add(held[part], x, out=held[part]) if part in held else x.copy()
        for part, x in held.items():
            yield _batch(part=np.array([part], np.int32), blob=[x.tobytes()])

    kind = read(np.zeros(8, np.uint8)).dtype
    schema = "part int, blob binary"
    first = blobs.withColumn("salt", F.monotonically_increasing_id()).repartition("part", "salt").select("part", "blob").mapInArrow(run, schema)
    return {part: np.frombuffer(blob, kind) for part, blob in first.repartition(_PARTS, "part").mapInArrow(again, schema).collect()}


def _levels(described: DataFrame, join: Join) -> np.ndarray:
    """Rarity level of each counter: 0 up to twice the mean count, then the log2 of their ratio."""
    parts = _fold(described.where("part IS NOT NULL").select("part", "blob"), lambda b: _unplanes(b, np.uint32).astype(np.int64), np.add)
    counts = np.zeros(1 << join.sketch_bits, np.int64)
    for part, one in parts.items():
        counts[part * len(one) : (part + 1) * len(one)] = one
    return np.clip(np.log2((counts + 1) / (counts.mean() + 1)), 0, 60).astype(np.uint8)


def _prefix_keys(tokens: np.ndarray, ptr: np.ndarray, level: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, record, told) of all indexed tokens.  told: with one order the token's
    position under it, else the orders under which the token is in the prefix, as bits."""
    rank = level[(tokens & U64(len(level) - 1)).astype(np.int64)].astype(U64) << U64(58)
    key = (tx.mix(tokens ^ U64(0x2545F4914F6CDD1D)) >> U64(6)) | rank
    n = np.diff(ptr)
    length = np.where(n > 0, join.indexed(n), 0)
    record = np.repeat(np.arange(len(n)), n)
    if join.orders == 1:
        for a, b in zip(ptr[:-1][n > 1].tolist(), ptr[1:][n > 1].tolist()):
            key[a:b].sort()
        told = np.arange(len(key)) - ptr[record]
        held = told < length[record]
    else:
        told = np.zeros(len(key), np.int64)
        most = np.zeros(len(n), U64)
        some = np.flatnonzero(n > 0)
        at = list(zip(some.tolist(), ptr[some].tolist(), ptr[some + 1].tolist(), (length[some] - 1).tolist()))
        for k in range(join.orders):
            by = key if k == 0 else (tx.mix(key ^ U64(k)) >> U64(6)) | rank
            for i, a, b, p in at:
                most[i] = np.partition(by[a:b], p)[p]
            told |= (by <= most[record]).astype(np.int64) << k
        held = told > 0
    return tx.mix(key[held]), record[held], told[held].astype(np.uint32)


@dataclass
class _Groups:
    """Postings by token, without repeats; hot: groups that are too large here, or were in a map task."""

    key: np.ndarray
    node: np.ndarray
    n: np.ndarray
    told: np.ndarray
    at: np.ndarray
    size: np.ndarray
    hot: np.ndarray
    join: Join

    @classmethod
    def of(cls, key: np.ndarray, node: np.ndarray, n: np.ndarray, told: np.ndarray, join: Join) -> _Groups:
        order = np.lexsort((node, key))
        key, node, n, told = key[order], node[order], n[order], told[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        marked = np.bitwise_or.reduceat(told, np.flatnonzero(head)) >= _MARK if len(key) else np.empty(0, bool)
        key, node, n, told, head = key[fresh], node[fresh], n[fresh], told[fresh] & ~_MARK, head[fresh]
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(key)))
        return cls(key, node, n, told, at, size, (size > join.group) | marked, join)

    def bits(self, told: np.ndarray) -> list[np.ndarray]:
        """For each order, whether it holds the posting in its prefix."""
        if self.join.orders == 1:
            return [np.ones(len(told), np.int64)]
        return [(told >> np.uint32(k) & np.uint32(1)).astype(np.int64) for k in range(self.join.orders)]

    def members(self) -> Iterator[pa.RecordBatch]:
        """Hot groups: kind 1, (token, node)."""
        member = np.repeat(self.hot, self.size)
        if member.any():
            yield _rows(1, self.key[member].view(np.int64), self.node[member], self.n[member], self.bits(self.told[member]))

    def shared(self) -> Iterator[tuple]:
        """Other groups of two or more: (node, 0), its size and its number of tokens here."""
        take = np.repeat(~self.hot & (self.size > 1), self.size)
        node = self.node[take]
        if len(node):
            found, first, at = np.unique(node, return_index=True, return_inverse=True)
            yield found, np.zeros_like(found), self.n[take][first].astype(np.int64), [np.bincount(at, b, len(found)).astype(np.int64) for b in self.bits(self.told[take])]

    def runs(self) -> Iterator[tuple[np.ndarray, int]]:
        """Heads and size of groups of two or more that are not hot, with a bounded number of pairs at a time."""
        for m in np.unique(self.size[~self.hot & (self.size > 1)]).tolist():
            heads, step = self.at[~self.hot & (self.size == m)], max(1, _PAIRS // (m * (m - 1) // 2))
            for k in range(0, len(heads), step):
                yield heads[k : k + step], m

    def pairs(self) -> Iterator[tuple]:
        """Other groups, of bounded size: (larger node, smaller node), 0 and their number of common tokens here."""
        t, a, b, told = self.join.percent, [], [], []
        for heads, m in self.runs():
            at = heads[:, None] + np.arange(m)
            i, j = (at[:, x].ravel() for x in np.triu_indices(m, 1))
            x, y = self.n[i].astype(np.int64), self.n[j].astype(np.int64)
            pass_ = 100 * np.minimum(x, y) >= t * np.maximum(x, y)
            if self.join.orders == 1:
                p, q = self.told[i].astype(np.int64), self.told[j].astype(np.int64)
                pass_ &= np.minimum(p, q) + 1 + np.minimum(x - p, y - q) - 1 >= ((x + y) * t + 99 + t) // (100 + t)
                both = np.ones(len(i), np.uint32)
            else:
                both = self.told[i] & self.told[j]
                pass_ &= both > 0
            i, j, both = i[pass_], j[pass_], both[pass_]
            a.append(np.maximum(self.node[i], self.node[j]))
            b.append(np.minimum(self.node[i], self.node[j]))
            told.append(both)
        if sum(map(len, a)):
            a, b, told = np.concatenate(a), np.concatenate(b), np.concatenate(told)
            yield _added(a, b, np.zeros(len(a), np.int64), self.bits(told))


def _added(a: np.ndarray, b: np.ndarray, n: np.ndarray, counts: list[np.ndarray]) -> tuple:
    """Rows (a, b, n, counts) with each (a, b) once and its counts added up."""
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(fresh)
    return a[at], b[at], n[at], [np.add.reduceat(x[order], at) for x in counts]


class _Sums:
    """Rows of one kind that a task adds up over its buckets, up to a bounded number."""

    def __init__(self, kind: int):
        self.kind, self.held = kind, []

    def add(self, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        self.held += rows
        if sum(len(x[0]) for x in self.held) > _SUMS:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            a, b, n, counts = zip(*self.held)
            self.held = []
            yield _rows(self.kind, *_added(np.concatenate(a), np.concatenate(b), np.concatenate(n), [np.concatenate(x) for x in zip(*counts)]))


def _rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, counts: list[np.ndarray], bucket: np.ndarray | None = None) -> pa.RecordBatch:
    m = len(a)
    return _batch(
        bucket=np.zeros(m, np.int32) if bucket is None else bucket.astype(np.int32), kind=np.full(m, kind, np.int32), a=a, b=b, n=n.astype(np.int64),
        **{f"c{k}": c.astype(np.int64) for k, c in enumerate(counts)}, keys=pa.nulls(m, pa.binary()), nodes=pa.nulls(m, pa.binary()),
    )


def _postings(join: Join) -> str:
    counts = ", ".join(f"c{k} bigint" for k in range(join.orders))
    return f"bucket int, kind int, a bigint, b bigint, n bigint, {counts}, keys binary, nodes binary"


def _post(join: Join, level, buckets: int):
    """Members of groups that are hot within this task (kind 1), and for each bucket of
    tokens one blob of postings (kind 0), in which one marked posting stands
    for a hot group: so a hot token costs the reducer a row for each map task."""

    def bucket_of(key):
        return (key >> U64(32)) * U64(buckets) >> U64(32)

    def flush(held):
        g = _Groups.of(*(np.concatenate(x) for x in zip(*held)), join)
        for rows in g.members():
            yield rows.set_column(0, "bucket", pa.array(bucket_of(rows.column(2).to_numpy().view(U64)).astype(np.int32)))
        g.told[g.at[g.hot]] |= _MARK
        sent = np.repeat(~g.hot, g.size)
        sent[g.at] = True
        key, node, n, told = g.key[sent], g.node[sent], g.n[sent], g.told[sent]
        edge = np.searchsorted(bucket_of(key), np.arange(buckets + 1, dtype=U64))
        zero = np.zeros(1, np.int64)
        for b in np.flatnonzero(np.diff(edge)).tolist():
            s = slice(edge[b], edge[b + 1])
            # nodes that occur often are named once
            names, first, at = np.unique(node[s], return_index=True, return_inverse=True)
            if 2 * len(names) > len(at):
                names, rest = np.empty(0, np.int64), node[s].tobytes() + _planes(n[s])
            else:
                rest = names.tobytes() + _planes(n[s][first]) + _planes(at.astype(np.uint32))
            yield _batch(
                bucket=np.array([b], np.int32), kind=np.zeros(1, np.int32), a=zero, b=zero, n=np.array([len(names)], np.int64), **{f"c{k}": zero for k in range(join.orders)},
                keys=[_pack(key[s])], nodes=[rest + _planes(told[s])],
            )

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for _, _, tokens, ptr in _records(batch, join):
                node = _nodes(tokens, ptr)
                sole = np.zeros(len(node), bool)
                sole[np.unique(node, return_index=True)[1]] = True
                key, record, told = _prefix_keys(tokens, ptr, level.value, join)
                take = sole[record]
                record = record[take]
                held.append((key[take], node[record], np.diff(ptr)[record].astype(np.uint32), told[take]))
                n += len(record)
                if n > join.flush:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)
        tx.trim()

    return run


def _gather(join: Join):
    """Groups across tasks, from rows in order of buckets, a bucket's postings at a time."""
    columns = ["bucket", "kind", "a", "b", "n", *(f"c{k}" for k in range(join.orders)), "keys", "nodes"]

    def close(held, shared, pairs):
        g = _Groups.of(*(np.concatenate(x) for x in zip(*held)), join)
        yield from g.members()
        yield from shared.add(g.shared())
        yield from pairs.add(g.pairs())

    def run(batches):
        held, last, sums = [], None, (_Sums(2), _Sums(3))
        for batch in batches:
            kind = batch.column(1).to_numpy()
            if (kind == 1).any():
                yield pa.RecordBatch.from_arrays(batch.filter(pa.array(kind == 1)).columns, names=columns)
            sent = batch.filter(pa.array(kind == 0))
            for b, named, k, v in zip(sent.column(0).to_pylist(), sent.column(4).to_pylist(), sent.column(-2), sent.column(-1)):
                if b != last and held:
                    yield from close(held, *sums)
                    held = []
                last, key = b, unpack(k)
                rest, m = np.frombuffer(v.as_buffer(), np.uint8), len(key)
                u = named or m
                node, n = rest[: 8 * u].copy().view(np.int64), _unplanes(rest[8 * u : 12 * u], np.uint32)
                if named:
                    at = _unplanes(rest[12 * u : 12 * u + 4 * m], np.uint32)
                    node, n = node[at], n[at]
                held.append((key, node, n, _unplanes(rest[len(rest) - 4 * m :], np.uint32)))
        if held:
            yield from close(held, *sums)
        for x in sums:
            yield from x.close()
        tx.trim()

    return run


def _bloom_at(node: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = tx.mix(node.view(U64))
    return (h & U64((1 << bits) - 1)).astype(np.int64), (h >> U64(64 - bits)).astype(np.int64)


def _bloom(nodes: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of a bigint column, as packed bits."""

    def part(batches):
        mask = np.zeros(1 << bits, bool)
        seen = False
        for batch in batches:
            for at in _bloom_at(batch.column(0).to_numpy(), bits):
                mask[at] = True
                seen = True
        if seen:
            for i, x in enumerate(np.split(mask, _PARTS)):
                yield _batch(part=np.array([i], np.int32), blob=[np.packbits(x).tobytes()])

    mask = np.zeros((1 << bits) // 8, np.uint8)
    size = len(mask) // _PARTS
    for i, blob in _fold(nodes.mapInArrow(part, "part int, blob binary"), lambda b: b, np.bitwise_or).items():
        mask[i * size : (i + 1) * size] = blob
    return mask


def _pick_sets(join: Join, bloom):
    """(node, set) of records that the Bloom filter lets through, each node once a task."""

    def run(batches):
        mask, seen = np.unpackbits(bloom.value).astype(bool), set()
        bits = join.bloom_bits
        for batch in batches:
            for _, _, tokens, ptr in _records(batch, join):
                node = _nodes(tokens, ptr)
                one, two = _bloom_at(node, bits)
                hit = np.flatnonzero(mask[one] & mask[two] & (np.diff(ptr) > 0))
                take = [i for i in hit.tolist() if node[i] not in seen and not seen.add(node[i])]
                if take:
                    each = [tokens[ptr[i] : ptr[i + 1]] for i in take]
                    yield _batch(node=node[take], tokens=[_pack(x) for x in each], marks=[_marks(x) for x in each])
        tx.trim()

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets reaches percent / 100."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def may_be_similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """False only if the sets of which these are the marks are not similar: common tokens have common marks."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    most = min(int((y[at] == x).sum()), len(y))
    return 100 * most >= percent * (len(x) + len(y) - most)


def _passing(join: Join, read, test):
    """The pairs of rows (a, b, x, y) that pass a test of x and y."""

    def run(batches):
        last, pivot = None, None
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ok = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                if b[i] != last:
                    last, pivot = b[i], read(y)
                ok[i] = test(read(x), pivot, join.percent)
            yield _batch(a=a[ok], b=b[ok])

    return run


def verify(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The similar ones of pairs (a, b) of nodes: marks first, whole sets of those that may be."""
    for column, read, test in (("marks", _read_marks, may_be_similar), ("tokens", unpack, similar)):
        left = pairs.join(sets.select(F.col("node").alias("a"), F.col(column).alias("x")), "a")
        both = left.join(sets.select(F.col("node").alias("b"), F.col(column).alias("y")), "b")
        pairs = both.select("a", "b", "x", "y").mapInArrow(_passing(join, read, test), "a bigint, b bigint")
    return pairs


@dataclass
class Found:
    """records: (doc_id, line, n, node), node null for an empty set; links: verified pairs
    (a, b) of nodes; members: (pivot, node, n), the hot groups, in which
    only links to the pivot are known yet; sets: (node, tokens) of all nodes in links and members.
    The tables stay until drop()."""

    records: DataFrame
    links: DataFrame
    members: DataFrame
    sets: DataFrame

    def drop(self) -> None:
        for table in (self.records, self.links, self.members, self.sets):
            drop_table(table)
        release(self.records.sparkSession)


def similarity_join(docs: DataFrame, join: Join = Join()) -> Found:
    """Links between the records of docs (doc_id, text), but for those within hot groups.

    Null or empty texts, and texts without words, have empty sets: they get a
    record without a node and no links (in line mode no record).  Repeated rows
    are records of one node.  An empty table gives empty results.  Other columns
    of docs are ignored; a text is one record at any length.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType
    described = materialize(rows.mapInArrow(_describe(join), T.StructType([T.StructField("doc_id", kind), T.StructField("line", T.LongType()), T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("blob", T.BinaryType())])))
    level = spark.sparkContext.broadcast(_levels(described, join))
    records = described.where("part IS NULL").select("doc_id", "line", "n", "node")
    tokens = records.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = 1 - (join.percent - join.extra) / 100
    postings = int(tokens * (1 - (1 - share) ** join.orders))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // (_BUCKETS * join.bucket)))
    posted = rows.mapInArrow(_post(join, level, _BUCKETS * parts), _postings(join))
    across = materialize(posted.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_gather(join), _postings(join)).drop("bucket", "keys", "nodes"))
    release(spark)
    each = range(join.orders)
    hot = materialize(across.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("node"), "n", *[f"c{k}" for k in each]).distinct())
    zero = F.lit(0).cast("long")
    mine = hot.groupBy("node").agg(F.first("n").alias("n"), *[F.sum(f"c{k}").alias(f"h{k}") for k in each], *[zero.alias(f"s{k}") for k in each])
    mine = mine.union(across.where("kind = 2").groupBy("a").agg(F.first("n"), *[zero for _ in each], *[F.sum(f"c{k}") for k in each]))
    held = mine.groupBy("node").agg(F.first("n").alias("n"), *[F.sum(f"{x}{k}").alias(f"{x}{k}") for x in "hs" for k in each])
    for k in each:
        held = held.where(f"h{k} + s{k} >= {_least(join)}").where(f"{_free(join, k)} >= (n * {join.percent} + 99) DIV 100")
    held = materialize(held)
    told = held.select("node", "n", ((F.col("h0") + F.col("s0")) / F.col("n")).alias("common"))
    classed = hot.where("c0 > 0").select("token", "node").join(told, "node").withColumn("own", F.expr(_size(join)))
    classed = materialize(classed.withColumn("size", F.explode(F.array("own", F.col("own") - 1))), hot)
    pivots = materialize(classed.where("own = size").groupBy("token", "size").agg(F.max_by("node", F.struct("common", "node")).alias("pivot")))
    members = attach(classed, pivots, "token", "size")
    members = materialize(members.where("pivot IS NOT NULL").select("pivot", "node", "n").distinct(), classed, pivots)
    pairs = across.where("kind = 3").groupBy("a", "b").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in each])
    for x in "ab":
        pairs = pairs.join(held.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), *[F.col(f"h{k}").alias(f"h{x}{k}") for k in each]), x)
    for k in each:
        pairs = pairs.where(f"c{k} + least(ha{k}, hb{k}) >= {_need(join)}")
    stars = members.where("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    pairs = materialize(pairs.select("a", "b").union(stars).distinct())
    drop_table(across), drop_table(held)
    live = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    bloom = spark.sparkContext.broadcast(_bloom(live, join.bloom_bits))
    picked = rows.mapInArrow(_pick_sets(join, bloom), "node bigint, tokens binary, marks binary").join(live, "node", "left_semi")
    sets = materialize(picked.groupBy("node").agg(F.first("tokens").alias("tokens"), F.first("marks").alias("marks")))
    links = materialize(verify(pairs, sets, join))
    drop_table(pairs)
    release(spark)
    return Found(records, links, members, sets)


def _need(join: Join) -> str:
    """SQL for the least number of tokens indexed under one order that a pair of at least
    this similarity shares (na, nb: set sizes), and for sizes that do not rule the pair out.

    With overlap o a set of n tokens has n - o others.  Of the set whose indexed
    tokens, p in number, end first, those that the other set has are indexed
    there too: p - (n - o) at least.  Either set may be that one.
    """
    t, extra = join.percent, join.extra
    overlap = f"((na + nb) * {t} + {99 + t}) DIV {100 + t}"
    over = [f"least(0, 1 - (n{x} * {t} + 99) DIV 100 + (n{x} * {extra} + 99) DIV 100)" for x in "ab"]
    return f"{overlap} + least({over[0]}, {over[1]}) AND 100 * least(na, nb) >= {t} * greatest(na, nb)"


def _size(join: Join) -> str:
    """SQL for the class of a set of n: sets that may be similar are of the same or of adjacent classes."""
    return f"cast(floor(ln(n) / {max(1.001 * math.log(100 / join.percent), 0.01)}) AS int)"


def _free(join: Join, order: int) -> str:
    """SQL for the tokens of a set of n that another set may have: all but the indexed ones that no other set holds."""
    return f"n - (least(n, n - (n * {join.percent} + 99) DIV 100 + 1 + (n * {join.extra} + 99) DIV 100) - h{order} - s{order})"


def _least(join: Join) -> str:
    """SQL for a lower bound of _need over all sizes of a partner of a set of n."""
    t, extra = join.percent, join.extra
    over = lambda m: f"least(0, 1 - ({m} * {t} + 99) DIV 100 + ({m} * {extra} + 99) DIV 100)"
    f = lambda a, b: f"((({a} + {b}) * {t} + {99 + t}) DIV {100 + t} + {over(b)})"
    return f"least({f(f'((n * {t} + 99) DIV 100)', 'n')}, {f('n', f'(n * 100 DIV {t})')}) - 2"
