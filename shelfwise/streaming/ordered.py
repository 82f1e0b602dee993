"""Sliding-window admission of a call stream in event time, with timers and expiring state."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shelfwise.operators.audit import DEFAULT_RATE_LIMIT, RATE_LIMITS, SPAN

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VERDICT = "seq bigint, server string, admitted boolean"


class _Admission(StatefulProcessor):
    """Calls wait in slots of event time; a slot is judged when the watermark has passed it.

    State of a server: ``waiting``, the calls of each slot, and ``recent``, the
    admitted times of the last span, at most its limit. Both are empty once the
    server has been idle for a span.
    """

    def __init__(self, limits: dict[str, int], default: int, span: int, slot_ms: int):
        self.limits, self.default, self.span, self.slot_ms = limits, default, span, slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slot bigint", "ts array<bigint>, seq array<bigint>")
        self.recent = handle.getValueState("recent", "ts array<bigint>")

    def _admitted_so_far(self) -> deque:
        return deque(self.recent.get()[0] if self.recent.exists() else ())

    def _judge(self, server: str, calls: list[tuple[int, int]], recent: deque) -> Iterator[pd.DataFrame]:
        limit, verdicts = self.limits.get(server, self.default), []
        for ts, _ in calls:
            while recent and recent[0] <= ts - self.span:
                recent.popleft()
            admitted = len(recent) < limit
            if admitted:
                recent.append(ts)
            verdicts.append(admitted)
        yield pd.DataFrame({"seq": [seq for _, seq in calls], "server": server, "admitted": verdicts})

    def _keep(self, recent: deque) -> None:
        if recent:
            self.recent.update((list(recent),))
            self.handle.registerTimer(max(recent) // 1000 + self.span // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        late = []
        for batch in rows:
            batch = batch.dropna(subset=["seq"])
            timeless = batch[batch["ts"].isna()]
            if len(timeless):
                yield pd.DataFrame({"seq": timeless["seq"].astype("int64"), "server": key[0],
                                    "admitted": pd.Series([None] * len(timeless), dtype="boolean").to_numpy()})
            batch = batch.dropna(subset=["ts"]).astype({"ts": "int64", "seq": "int64"})
            slots = (batch["ts"] // (1000 * self.slot_ms) + 1) * self.slot_ms
            for slot, calls in batch.groupby(slots.to_numpy()):
                ts, seq = calls["ts"].tolist(), calls["seq"].tolist()
                if slot < passed:
                    late += zip(ts, seq)
                    continue
                held = self.waiting.getValue((int(slot),)) if self.waiting.containsKey((int(slot),)) else None
                self.waiting.updateValue((int(slot),), ([*held[0], *ts], [*held[1], *seq]) if held else (ts, seq))
                if not held:
                    self.handle.registerTimer(int(slot))
        if late:
            recent = self._admitted_so_far()
            yield from self._judge(key[0], sorted(late), recent)
            self._keep(recent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expired, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        recent = self._admitted_so_far()
        if self.waiting.containsKey((expired,)):
            # All due slots in order of time; their own timers then find nothing left.
            for slot in sorted(k[0] for k in self.waiting.keys() if k[0] <= passed):
                yield from self._judge(key[0], sorted(zip(*self.waiting.getValue((slot,)))), recent)
                self.waiting.removeKey((slot,))
            self._keep(recent)
        elif recent and max(recent) // 1000 + self.span // 1000 < passed and not any(True for _ in self.waiting.keys()):
            self.recent.clear()

    def close(self) -> None:
        pass


def admit_in_order(
    calls: DataFrame, late: str, limits: dict[str, int] = RATE_LIMITS, default: int = DEFAULT_RATE_LIMIT,
    span: int = SPAN, slot_ms: int = 1000,
) -> DataFrame:
    """Admission verdicts of ``(seq, ts, server)`` calls in order of (ts, seq), over all micro-batches.

    ``ts`` is a timestamp, ``span`` microseconds. A call waits until the
    watermark, the youngest time seen less ``late``, has passed its slot. One
    that comes later than that is judged on arrival, against the calls admitted
    so far. Calls without a time get a
    null verdict; rows without ``seq`` get none and only move the watermark.
    The stream needs :data:`STATE_STORE` as its state store.
    """
    timed = calls.withWatermark("ts", late).select("seq", F.unix_micros("ts").alias("ts"), "server")
    return timed.groupBy("server").transformWithStateInPandas(
        _Admission(limits, default, span, slot_ms), VERDICT, "append", "EventTime")
