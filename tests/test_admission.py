"""Admission in parallel over time against the sequential rule."""

import random
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import admission


def _times(draw, n, kind):
    if kind == "regular":
        return list(range(0, 7 * n, 7))
    if kind == "one moment":
        return [5] * n
    if kind == "bursts":
        return sorted(draw.choice([0, 100, 130, 131, 400]) + draw.randint(0, 3) for _ in range(n))
    now, out = 0, []
    for _ in range(n):
        now += draw.choice([0, 1, 1, 2, 9]) if kind == "dense" else draw.choice([0, 5, 40, 90])
        out.append(now)
    return out


def _state(times, limit, span):
    recent, kept = deque(), []
    for t, ok in zip(times, admission.replay(times, limit, span, recent)):
        kept += [t] * ok
    return kept[-limit:]


@pytest.mark.parametrize("kind", ["regular", "one moment", "bursts", "dense", "loose"])
@pytest.mark.parametrize("limit,span", [(1, 100), (2, 13), (5, 100), (7, 250)])
def test_effects_of_slices_join_to_the_rule(kind, limit, span):
    draw = random.Random(f"{kind}{limit}")
    for _ in range(25):
        times = _times(draw, draw.randint(1, 160), kind)
        cuts = sorted(draw.randint(0, len(times)) for _ in range(draw.randint(0, 4)))
        by_bursts, by_times = [], []
        for a, b in zip([0, *cuts], [*cuts, len(times)]):
            if a == b:
                continue
            part = np.array(times[a:b])
            width = int(np.searchsorted(part, part[0] + span, "left"))
            counts, last = admission.bursts(part, limit, span)
            assert len(counts) == width + 1 and counts.max() - counts.min() <= limit
            by_bursts = admission.after_bursts(part[:width], counts, last, by_bursts, limit, span)
            by_times = admission.after_times(part, by_times, limit, span)
            want = _state(times[:b], limit, span)
            assert by_bursts == want and by_times == want


SCHEMA = "seq long, ts long, server string, limit int"


def test_a_server_that_is_always_overloaded_is_spread_over_all_tasks(spark, many_parts):
    draw = random.Random(8)
    span, limit = 1000, 4
    rows = [(i, t, "busy", limit) for i, t in enumerate(np.cumsum([draw.choice([1, 20, 60, 90]) for _ in range(6000)]).tolist())]
    rows += [(10_000 + i, 7 * i, f"calm{i % 3}", 2) for i in range(60)] + [(20_000 + i, i, None, 1) for i in range(30)]
    draw.shuffle(rows)
    many_parts(16)
    calls = spark.createDataFrame(rows, SCHEMA)
    sizes = [r["count"] for r in admission.sliced(calls).where("server = 'busy'").groupBy("part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 2 * 6000 / 15
    got = {r.seq: r.admitted for r in admission.verdicts(calls, span).collect()}
    want = {}
    for server in {r[2] for r in rows}:
        own = sorted((t, seq, n) for seq, t, s, n in rows if s == server)
        want |= zip([seq for _, seq, _ in own], admission.replay([t for t, _, _ in own], own[0][2], span, deque()))
    assert got == want
    # Bursts are what passes for the busy server: it has more calls than room for their times.
    effects = admission.sliced(calls).repartitionByRange("part").sortWithinPartitions("part", "server", "ts", "seq").select(
        "part", "server", "ts", "limit").mapInArrow(admission._effects(span), admission._EFFECT)
    assert effects.where("counts is not null").count() >= 1 and effects.agg(F.max(F.size("times"))).first()[0] < 400


def test_no_calls_no_room_and_one_minute(spark, many_parts):
    many_parts(9)
    calls = spark.createDataFrame([(i, 100 + i // 500, "a", 3) for i in range(2000)] + [(9000 + i, i, "b", 0) for i in range(40)], SCHEMA)
    got = {r.seq: r.admitted for r in admission.verdicts(calls, 60).collect()}
    assert [s for s, ok in sorted(got.items()) if ok] == [0, 1, 2] and len(got) == 2040
    assert admission.verdicts(calls.limit(0), 60).collect() == []
