"""Rows of a key that lie more than a gap apart, by one ordered scan.

Per key, in (time, id) order, a row is taken when it is more than ``gap`` after
the key's last taken row; the first is always taken.  Which rows are taken
depends on all before them, so the rows are dealt by ranges of (key, time, id),
sorted, and every task walks its range once, jumping from each taken row to the
first one beyond the gap.

Only the first key of a range can have begun in an earlier one; every other
key's rows are settled by the walk.  The walk leaves that first key's rows *open*:
it writes them all, marked with what would be taken if nothing came before, and a
summary line (its first, last and last taken time).  The driver goes through these
lines, one a range, and carries each key's last taken time across the edges:

* a range whose first key begins there, or begins beyond the gap, stands as
  marked;
* a range that lies wholly within the gap has nothing to take;
* any other is walked again from the time carried in, with all such ranges of
  different keys in one job.

So a key with a third of all rows is spread over a third of the tasks, and walked
again at most once for each row taken from it at an edge.  Few rows
(``FEW``) are walked in one task.
"""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import scratch_path, staged, staged_with_count

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds of written rows: taken, open, open and taken if nothing came before,
#: summary of the first key, summary of the last key.
TAKEN, OPEN, ALONE, FIRST, LAST = range(5)
FEW = 20_000
_KIND, _RANGE, _A, _B, _C = "_kind", "_range", "_first_ms", "_last_ms", "_taken_ms"


def walk(times: np.ndarray, gap: int, last: int | None) -> tuple[list[int], int | None]:
    """(places taken, last taken time) in sorted times, after ``last``."""
    taken, n = [], len(times)
    i = 0 if last is None else int(np.searchsorted(times, last + gap, side="right"))
    while i < n:
        taken.append(i)
        last = int(times[i])
        i = int(np.searchsorted(times, last + gap, side="right"))
    return taken, last


def _runs(batch: pa.RecordBatch, keys: list[str]):
    """(start, stop, key) of the runs of equal keys in a sorted batch."""
    columns = [batch.column(k).to_pylist() for k in keys]
    rows = list(zip(*columns))
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i] != rows[start]:
            yield start, i, rows[start]
            start = i


def spaced_rows(rows: DataFrame, keys: list[str], time: str, order: str, gap: int) -> DataFrame:
    """The taken rows.  ``time`` holds whole numbers without nulls; null keys
    are a key."""
    columns = rows.columns
    rows, count = staged_with_count(rows, "spaced")
    by = [*keys, time, order]
    if count <= FEW:
        dealt = rows.coalesce(1)
    else:
        dealt = rows.repartitionByRange(*by)
    dealt = dealt.sortWithinPartitions(*by).withColumn(_RANGE, F.spark_partition_id())
    schema = T.StructType([*dealt.schema.fields, *[T.StructField(c, T.LongType()) for c in (_KIND, _A, _B, _C)]])
    arrow = [(f.name, f.dataType) for f in schema.fields]

    def scan(batches):
        key = head = None
        at_head, last, first_ms, last_ms, edge = True, None, None, None, None

        def out(part: pa.RecordBatch, kind, a=None, b=None, c=None):
            n = part.num_rows
            kinds = pa.array(np.full(n, kind) if np.isscalar(kind) else kind, pa.int64())
            more = [pa.array([x] * n, pa.int64()) for x in (a, b, c)]
            return pa.RecordBatch.from_arrays([*part.columns, kinds, *more], [n for n, _ in arrow])

        for batch in batches:
            times = batch.column(time).to_numpy(zero_copy_only=False)
            for start, stop, own in _runs(batch, keys):
                part = batch.slice(start, stop - start)
                if head is None:
                    head = key = own
                if own != key:
                    if at_head:
                        yield out(edge, FIRST, first_ms, last_ms, last)
                    key, last, at_head, first_ms = own, None, False, None
                taken, last = walk(times[start:stop], gap, last)
                first_ms = int(times[start]) if first_ms is None else first_ms
                last_ms, edge = int(times[stop - 1]), part.slice(part.num_rows - 1)
                if at_head:
                    kind = np.full(part.num_rows, OPEN)
                    kind[taken] = ALONE
                    yield out(part, kind)
                elif taken:
                    yield out(part.take(pa.array(taken)), TAKEN)
        if edge is not None:
            yield out(edge, FIRST if at_head else LAST, first_ms, last_ms, last)

    walked = staged(dealt.mapInArrow(scan, schema), "spaced-walk")
    if count <= FEW:  # one range, before which nothing comes
        return walked.filter(F.col(_KIND).isin(TAKEN, ALONE)).select(*columns)
    lines = walked.filter(F.col(_KIND).isin(FIRST, LAST)).select(*keys, _RANGE, _KIND, _A, _B, _C).collect()  # two a range
    alone, again = _carry(walked, lines, keys, time, order, gap)
    settled = F.col(_KIND) == TAKEN
    if alone:
        settled = settled | ((F.col(_KIND) == ALONE) & F.col(_RANGE).isin(*alone))
    out = walked.filter(settled).select(*columns)
    for found in again:
        out = out.unionByName(found.select(*columns))
    return out


def _carry(walked: DataFrame, lines: list, keys: list[str], time: str, order: str, gap: int) -> tuple[list[int], list[DataFrame]]:
    """(ranges whose first key stands as marked, the rows taken by walks from a
    time carried in)."""
    ranges: dict[int, dict[int, tuple]] = {}
    for r in lines:
        ranges.setdefault(r[_RANGE], {})[r[_KIND]] = (tuple(r[k] for k in keys), r[_A], r[_B], r[_C])
    # Spans of ranges that share a key across their edges, in order.
    spans, key, last = [], None, None
    for n in sorted(ranges):
        own, *summary = ranges[n][FIRST]
        if spans and own == key:
            spans[-1][1].append((n, *summary))
        else:
            spans.append((own, [(n, *summary)]))
            last = None
        key, last = ranges[n].get(LAST, (own,))[0], None
        if LAST in ranges[n]:
            spans.append((key, [(n, None, None, ranges[n][LAST][3])]))  # settled: only what it carries on
    alone, again = [], []
    waiting = [(None, parts) for _, parts in spans]
    while waiting:
        ask = []
        for last, parts in waiting:
            for i, (n, first_ms, last_ms, taken_ms) in enumerate(parts):
                if first_ms is None:
                    last = taken_ms
                elif last is None or first_ms > last + gap:
                    alone.append(n)
                    last = taken_ms
                elif last_ms > last + gap:
                    ask.append((n, last, parts[i + 1 :]))
                    break
        if not ask:
            break
        found = _walk_again(walked, {n: last for n, last, _ in ask}, time, order, gap)
        again.append(found)
        new = {r[_RANGE]: r["m"] for r in found.groupBy(_RANGE).agg(F.max(time).alias("m")).collect()}
        waiting = [(new[n], rest) for n, _, rest in ask if rest]
    return alone, again


def _walk_again(walked: DataFrame, carried: dict[int, int], time: str, order: str, gap: int) -> DataFrame:
    rows = walked.filter(F.col(_KIND).isin(OPEN, ALONE) & F.col(_RANGE).isin(*carried))
    rows = rows.repartition(F.col(_RANGE)).sortWithinPartitions(_RANGE, time, order)

    def scan(batches):
        last = dict(carried)
        for batch in batches:
            times, at = batch.column(time).to_numpy(zero_copy_only=False), batch.column(_RANGE).to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                taken, last[int(at[a])] = walk(times[a:b], gap, last[int(at[a])])
                if taken:
                    yield batch.slice(a, b - a).take(pa.array(taken))

    path = scratch_path(walked.sparkSession, "flowlens-staged", f"spaced-again-{uuid.uuid4().hex}")
    rows.mapInArrow(scan, rows.schema).write.parquet(path)
    return walked.sparkSession.read.schema(rows.schema).parquet(path)
