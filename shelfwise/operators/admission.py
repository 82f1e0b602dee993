"""Admission under a sliding limit, replayed in parallel over time.

A call is admitted when fewer than ``limit`` admitted calls lie in the span
before it. With calls numbered by time and g(i) the first call a span after
call i, the k-th admitted call is

    a[k] = max(a[k-1] + 1, g(a[k-limit]))

Both operators are monotone, so they distribute over max: what a slice of calls
does to any state is known from what it does to each single call that may be
the next one to find room. Such a call u starts a burst B(u) (the rule from an
empty history, u admitted first). If the calls at which room opens are
u[1] <= u[2] <= ... when a slice begins, its c-th admission is

    max over p of B(u[p])[c - p + 1]

1. Calls are range-partitioned by (server, time), so parts have equal numbers of
   rows however the calls are spread over servers and time.
2. Every part gives the effect of its first server on an unknown state: the
   bursts of all calls in the part's first span, or the call times where these
   take less room. Servers that begin inside a part begin from nothing.
3. The effects of a server are joined in order by a scan, which gives each part
   its state at the beginning: at most ``limit`` times.
4. All parts are replayed at once.

Only effects pass the scan. A part of n calls with w calls in a span passes
3 w limit numbers, or n where that is less.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.staging import stage


def first_after(times: np.ndarray, span: int) -> np.ndarray:
    """For every call the number of the first call a span later; the number of calls where there is none."""
    return np.searchsorted(times, times + span, "left")


def replay(times: list[int], limit: int, span: int, recent: deque) -> list[bool]:
    """The rule, call by call; ``recent`` holds the admitted times that still count, and is kept up to date."""
    verdicts = []
    for t in times:
        while recent and recent[0] <= t - span:
            recent.popleft()
        admitted = len(recent) < limit
        if admitted:
            recent.append(t)
        verdicts.append(admitted)
    return verdicts


def bursts(times: np.ndarray, limit: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, last) for the bursts of every call in the first span, and of "no room before the first span ends".

    ``counts[u]`` admissions lie in the slice; ``last[u, k]`` is the time of
    the k-th last of them, for k below 3 * limit.
    """
    n, depth = len(times), 3 * limit
    ahead = np.append(first_after(times, span), n)
    starts = np.arange(ahead[0] + 1)
    ring = np.full((depth, len(starts)), -1, np.int64)  # admissions k, k - depth, ... of each burst
    counts, at, k = np.zeros(len(starts), np.int64), starts, 0
    while True:
        inside = at < n
        if not inside.any():
            break
        ring[k % depth] = np.where(inside, at, ring[k % depth])
        counts += inside
        k += 1
        following = np.minimum(at + 1, n)
        if k >= limit:
            # Bursts that have ended stay ended: their ring is not written any more, so it is not read either.
            following = np.where(inside, np.maximum(following, ahead[ring[(k - limit) % depth]]), n)
        at = following
    back = (counts[:, None] - 1 - np.arange(depth)[None, :])
    found = ring[back % depth, starts[:, None]]
    return counts, np.where(back >= 0, np.append(times, 0)[found], 0)


def room(times: np.ndarray, recent: list[int], limit: int, span: int) -> np.ndarray:
    """The calls at which room opens, one for each admission the limit allows; calls beyond the slice count as its end."""
    opens = np.searchsorted(times, np.array(recent, np.int64) + span, "left") if recent else np.zeros(0, np.int64)
    return np.concatenate([np.zeros(limit - len(recent), np.int64), opens])


def after_bursts(first: np.ndarray, counts: np.ndarray, last: np.ndarray, recent: list[int], limit: int, span: int) -> list[int]:
    """The last ``limit`` admitted times after a slice that is known by its bursts."""
    u = room(first, recent, limit, span)
    places = np.arange(limit)
    total = int((counts[u] + places).min())
    admitted = []
    for c in range(max(1, total - limit + 1), total + 1):
        p = places[:c]
        admitted.append(int(last[u[p], counts[u[p]] - (c - p)].max()))
    return [*recent, *admitted][-limit:]


def after_times(times: np.ndarray, recent: list[int], limit: int, span: int) -> list[int]:
    """The last ``limit`` admitted times after a slice that is known by its calls; one step an admission."""
    recent, at = list(recent), 0
    while at < len(times):
        if len(recent) == limit:
            at = max(at, int(np.searchsorted(times, recent[0] + span, "left")))
            if at >= len(times):
                break
            recent.pop(0)
        recent.append(int(times[at]))
        at += 1
    return recent


#: An effect: of bursts, with the times of the first span; or only times. Servers that begin in the part have their state.
EFFECT = pa.schema([
    ("server", pa.string()), ("part", pa.int32()), ("limit", pa.int32()), ("times", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("state", pa.list_(pa.int64()))])
_EFFECT = ("server string, part int, limit int, times array<long>, counts array<long>, last array<long>, state array<long>")


def _effect(key: tuple, times: np.ndarray, span: int, first: bool) -> dict:
    server, part, limit = key
    row = {"server": server, "part": part, "limit": limit, "times": None, "counts": None, "last": None, "state": None}
    if limit <= 0:
        return row | {"state": []}
    if not first:
        return row | {"state": after_times(times, [], limit, span)}
    width = int(np.searchsorted(times, times[0] + span, "left"))
    if 3 * limit * (width + 1) > len(times):
        return row | {"times": times}
    counts, last = bursts(times, limit, span)
    return row | {"times": times[:width], "counts": counts, "last": last.ravel()}


def _effects(span: int):
    """The effects of a part's first and last server, from rows sorted by (part, server, ts, seq)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, part = None, [], None
        first = True

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_effect(key, np.concatenate(held), span, first)], EFFECT)

        for batch in batches:
            times = batch.column("ts").to_numpy()
            for at, end, new in _runs(batch):
                if new != key:
                    # A server that neither begins nor ends the part concerns no other part.
                    if key is not None and (first or new[1] != part):
                        yield done()
                    first, key, part, held = new[1] != part, new, new[1], []
                held.append(times[at:end])
        if key is not None:
            yield done()
    return run


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, tuple]]:
    """(from, to, key) of the runs of equal (server, part, limit) in a sorted batch."""
    server, part, limit = (batch.column(c).to_pylist() for c in ("server", "part", "limit"))
    at = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or server[i] != server[at] or part[i] != part[at]:
            yield at, i, (server[at], part[at], limit[at])
            at = i


def _scan(span: int):
    """The state at the beginning of every part that continues a server, from its effects in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        server, part, state = None, None, []
        for batch in batches:
            out = []
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                name, now, limit = (row.column(c)[0].as_py() for c in ("server", "part", "limit"))
                if part is None or name != server:
                    state = []
                elif now != part and state:
                    out.append({"server": name, "part": now, "state": state})
                server, part = name, now

                def numbers(column: str, row=row) -> np.ndarray:
                    return row.column(column).flatten().to_numpy()

                if row.column("state")[0].is_valid:
                    state = row.column("state")[0].as_py()
                elif row.column("counts")[0].is_valid:
                    counts = numbers("counts")
                    state = after_bursts(numbers("times"), counts, numbers("last").reshape(len(counts), -1), state, limit, span)
                else:
                    state = after_times(numbers("times"), state, limit, span)
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("server", pa.string()), ("part", pa.int32()), ("state", pa.list_(pa.int64()))]))
    return run


def _verdicts(span: int):
    """``admitted`` for sorted calls; a part's state precedes the calls of its first server."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, recent = None, deque()
        for batch in batches:
            states, times, limits = batch.column("state"), batch.column("ts").to_pylist(), batch.column("limit").to_pylist()
            admitted = []
            for at, end, new in _runs(batch):
                if new[:2] != key:
                    key, recent = new[:2], deque()
                if states[at].is_valid:
                    recent.extend(states[at].as_py())
                    admitted.append(None)
                    at += 1
                if at < end:
                    admitted += replay(times[at:end], limits[at], span, recent)
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq"), batch.column("server"), pa.array(admitted, pa.bool_())], names=["seq", "server", "admitted"])
    return run


def sliced(calls: DataFrame) -> DataFrame:
    """Staged calls (seq, ts, server, limit) with the ``part`` of their place in (server, ts, seq) order."""
    return stage(calls.repartitionByRange("server", "ts", "seq").withColumn("part", F.spark_partition_id()), "call-parts")


def verdicts(calls: DataFrame, span: int) -> DataFrame:
    """(seq, server, admitted) of calls (seq, ts, server, limit); ``seq`` is unique and decides between equal times."""
    parts = sliced(calls)
    in_order = ["part", "server", "ts", "seq"]
    ordered = parts.repartitionByRange("part").sortWithinPartitions(*in_order)
    effects = ordered.select("part", "server", "ts", "limit").mapInArrow(_effects(span), _EFFECT)
    states = effects.repartition("server").sortWithinPartitions("server", "part").mapInArrow(
        _scan(span), "server string, part int, state array<long>")
    rows = parts.withColumn("state", F.lit(None).cast("array<long>")).unionByName(
        stage(states, "call-states").select("server", "part", "state"), allowMissingColumns=True)
    # Null times come first, so the state precedes its calls.
    told = rows.repartitionByRange("part").sortWithinPartitions(*in_order).mapInArrow(
        _verdicts(span), f"seq {calls.schema['seq'].dataType.simpleString()}, server string, admitted boolean")
    return told.where("admitted is not null")
