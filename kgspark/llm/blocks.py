"""Links within hot groups that the pivots leave open, found block by block.

The open members of a group (see `open_`) are dealt into blocks of bounded size, the
closed ones too; each open block meets every block once.  A task counts the
common tokens of two blocks by products of their incidence matrices and returns
only what matters of the similar pairs: in `components` a forest over the labels,
in `earlier` one earlier match for each open member.  So rows stay in proportion to
the members, while a group with many open members, near the limit of
similarity from each other, costs time as their number by that of all members;
two blocks at a time is all that a task holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.llm import text as tx
from kgspark.llm.simjoin import Join, unpack

#: tokens of a block, about
_TOKENS = 1 << 20
#: columns of an incidence matrix that are multiplied at once
_COLUMNS = 4096


@dataclass
class Side:
    """Members of a block: their sets, one after the other, and what else is known of them."""

    node: np.ndarray
    size: np.ndarray
    tokens: np.ndarray
    told: list[pa.Array]

    @classmethod
    def of(cls, rows: list[pa.RecordBatch]) -> Side:
        table = pa.Table.from_batches(rows)
        sets = [unpack(x) for c in table.column("tokens").chunks for x in c]
        return cls(table.column("node").to_numpy(), np.array([len(s) for s in sets], np.int64), np.concatenate(sets), [table.column(i).combine_chunks() for i in range(7, table.num_columns)])


def similar_matrix(x: Side, y: Side, percent: int) -> np.ndarray:
    """Whether the Jaccard similarity of the members of x (rows) and y (columns) reaches percent / 100."""
    values, at = np.unique(np.concatenate((x.tokens, y.tokens)), return_inverse=True)
    i, j = at[: len(x.tokens)], at[len(x.tokens) :]
    shared = np.zeros(len(values), bool)
    shared[i] = True
    other = np.zeros(len(values), bool)
    other[j] = True
    shared &= other
    column = np.cumsum(shared) - 1
    common = np.zeros((len(x.node), len(y.node)), np.float32)
    cells = []
    for side, of in ((x, i), (y, j)):
        row, keep = np.repeat(np.arange(len(side.node)), side.size), shared[of]
        row, col = row[keep], column[of[keep]]
        order = np.argsort(col, kind="stable")
        cells.append((row[order], col[order], len(side.node)))
    for lo in range(0, int(shared.sum()), _COLUMNS):
        width = min(_COLUMNS, int(shared.sum()) - lo)
        parts = []
        for row, col, n in cells:
            a, b = np.searchsorted(col, (lo, lo + width))
            part = np.zeros((n, width), np.float32)
            part[row[a:b], col[a:b] - lo] = 1
            parts.append(part)
        common += parts[0] @ parts[1].T
    common = common.astype(np.int64)
    return 100 * common >= percent * (x.size[:, None] + y.size[None, :] - common)


def forest(x: Side, y: Side, linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """(label, label) pairs that connect what `linked` connects."""
    names = np.concatenate([s.told[0].to_numpy() for s in (x, y)])
    _, start = np.unique(names, return_inverse=True)
    a, b = start[: len(x.node)], start[len(x.node) :]
    linked = linked & (a[:, None] != b[None, :])
    some, too = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    if not len(some):
        return
    linked, a, b = linked[np.ix_(some, too)], a[some], b[too]
    least = np.arange(start.max() + 1)
    while True:
        p, q = least[a], least[b]
        lower = np.minimum(p, np.where(linked, q[None, :], len(least)).min(1)), np.minimum(q, np.where(linked, p[:, None], len(least)).min(0))
        after = least.copy()
        np.minimum.at(after, a, lower[0])
        np.minimum.at(after, b, lower[1])
        after = after[after]
        if (after == least).all():
            break
        least = after
    name = np.empty(len(least), np.int64)
    name[start] = names
    for k in np.flatnonzero(least != np.arange(len(least))).tolist():
        yield int(name[k]), int(name[least[k]])


def earlier(x: Side, y: Side, linked: np.ndarray, both: bool) -> Iterator[tuple[int, int]]:
    """(node, earlier node): one similar earlier member of y for each member of x, and with `both` the other way too."""
    place = sorted((v is not None, v if v is not None else 0, n, k) for s, o in ((x, 0), (y, len(x.node))) for k, (v, n) in enumerate(zip(s.told[0].to_pylist(), s.told[1].to_pylist()), o))
    rank = np.empty(len(place), np.int64)
    rank[[p[-1] for p in place]] = np.arange(len(place))
    sides = ((x, y, rank[: len(x.node)], rank[len(x.node) :], linked), (y, x, rank[len(x.node) :], rank[: len(x.node)], linked.T))
    for p, q, a, b, m in sides[: 2 if both else 1]:
        before = np.where(m & (b[None, :] < a[:, None]), b[None, :], len(rank))
        first = before.argmin(1)
        for k in np.flatnonzero(before[np.arange(len(a)), first] < len(rank)).tolist():
            yield int(p.node[k]), int(q.node[first[k]])


def _compare(join: Join, find: Callable):
    """Groups of rows in order of (pivot, closed, i, j, other)."""

    def close(held):
        sides = [[b.filter(pa.array(b.column(4).to_numpy(zero_copy_only=False) == o)) for b in held] for o in (False, True)]
        x = Side.of(sides[0]) if any(b.num_rows for b in sides[0]) else None
        if x is None:
            return
        closed, i, j = (held[0].column(k)[0].as_py() for k in (1, 2, 3))
        same = not closed and i == j
        if not same and not any(b.num_rows for b in sides[1]):
            return
        y = x if same else Side.of(sides[1])
        linked = similar_matrix(x, y, join.percent)
        if same:
            np.fill_diagonal(linked, False)
        pairs = list(forest(x, y, linked) if find is forest else earlier(x, y, linked, not closed and not same))
        if pairs:
            a, b = zip(*pairs)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def run(batches):
        held, last = [], None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], 1)
            edge = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(keys)]):
                if e > s:
                    if last is not None and tuple(keys[s]) != last:
                        yield from close(held)
                        held = []
                    last = tuple(keys[s])
                    held.append(batch.slice(s, e - s))
        if held:
            yield from close(held)
        tx.trim()

    return run


def compare(members: DataFrame, sets: DataFrame, join: Join, find: Callable) -> DataFrame:
    """(a, b) that `find` (forest or earlier) gives for the open members of each group.

    members: (pivot, node, n, open, *told), told being what `find` asks for.
    """
    told = members.columns[4:]
    sizes = members.groupBy("pivot").agg(*[F.expr(f"cast(greatest(ceil(count_if({c}) / {join.block}), ceil(coalesce(sum(n) FILTER (WHERE {c}), 0) / {_TOKENS})) AS int)").alias(x) for x, c in (("_open", "open"), ("_shut", "NOT open"))]).where("_open > 0")
    dealt = members.join(sizes, "pivot").withColumn("_b", F.expr("cast(pmod(xxhash64(node), if(open, _open, _shut)) AS int)"))
    place = "struct(%s AS closed, %s AS i, %s AS j, %s AS other)"
    mine = f"transform(sequence(0, _open - 1), k -> {place % ('false', 'least(k, _b)', 'greatest(k, _b)', 'k < _b')})"
    theirs = f"if(_shut > 0, transform(sequence(0, _shut - 1), k -> {place % ('true', '_b', 'k', 'false')}), array())"
    shut = f"transform(sequence(0, _open - 1), k -> {place % ('true', 'k', '_b', 'true')})"
    dealt = dealt.select("pivot", F.explode(F.expr(f"if(open, concat({mine}, {theirs}), {shut})")).alias("_p"), "node", "n", *told)
    rows = dealt.join(sets.select("node", "tokens"), "node").select("pivot", "_p.closed", "_p.i", "_p.j", "_p.other", "node", "tokens", *told)
    rows = rows.repartition("pivot", "closed", "i", "j").sortWithinPartitions("pivot", "closed", "i", "j")
    return rows.mapInArrow(_compare(join, find), T.StructType([T.StructField(x, T.LongType()) for x in "ab"]))
