import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import audit

SPAN = 1000


def brute(calls, limits, default):
    recent, verdict = {}, {}
    for seq, ts, server, _ in sorted(calls, key=lambda c: (c[1], c[0])):
        kept = [t for t in recent.get(server, []) if t > ts - SPAN]
        verdict[seq] = len(kept) < limits.get(server, default)
        recent[server] = kept + [ts] if verdict[seq] else kept
    return verdict


def make_calls(seed):
    rng, calls, seq = random.Random(seed), [], 0
    for server, step in (("hot", 40), ("bursty", 300), ("calm", 900)):
        now = 0
        for _ in range(700 if server == "hot" else 250):
            now += 0 if rng.random() < 0.1 else rng.choice([step, step // 3, step * (12 if server == "bursty" else 1)])
            calls.append((seq, now, server, f"t{seq % 3}"))
            seq += 1
    rng.shuffle(calls)
    return calls


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [1, 3, 37])
def test_admission_matches_the_sequential_rule(spark, many_parts, seed, parts):
    calls = make_calls(seed)
    df = spark.createDataFrame(calls, "seq long, ts long, server string, tool string")
    many_parts(parts)
    got = {r.seq: r.admitted for r in audit.admit(df, {"hot": 5}, 3, SPAN).collect()}
    want = brute(calls, {"hot": 5}, 3)
    assert got == want and len(set(want.values())) == 2


@pytest.mark.parametrize("parts", [1, 23])
def test_offered_load_matches_counting(spark, many_parts, parts):
    calls = make_calls(3)
    df = spark.createDataFrame(calls, "seq long, ts long, server string, tool string")
    many_parts(parts)
    got = {r.seq: r.load for r in audit.offered_load(df, SPAN).collect()}
    want = {seq: sum(s == server and ts - SPAN < t <= ts for _, t, s, _ in calls) for seq, ts, server, _ in calls}
    assert got == want


def test_a_call_one_span_old_is_out(spark):
    df = spark.createDataFrame([(1, 0, "s", "t"), (2, SPAN - 1, "s", "t"), (3, SPAN, "s", "t")],
                               "seq long, ts long, server string, tool string")
    got = {r.seq: r.admitted for r in audit.admit(df, {}, 1, SPAN).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_outcomes(spark):
    rows = [(1, 0, "data_server", "get_top_products", None), (2, 1, "data_server", "drop_all", None),
            (3, 2, "data_server", "answer_question", None), (4, 3, "data_server", "get_top_products", None),
            (5, 4, "llm_server", "answer_question", "boom")]
    df = spark.createDataFrame(rows, "seq long, ts long, server string, tool string, error string").withColumn(
        "result", F.lit("abc"))
    out = {r.seq: (r.allowed, r.reason, r.result_size) for r in audit.call_outcomes(df, limits={"data_server": 1}).collect()}
    assert out[1] == (True, "OK", 3) and out[2] == (False, "Unknown tool", 0)
    assert out[3][1] == "Tool 'answer_question' not permitted for server 'data_server'"
    assert out[4][1] == "Rate limit exceeded: 1 calls/min for 'data_server'" and out[5][1] == "error"


def test_stats(spark):
    df = spark.createDataFrame([(i, i, "s", "t", i % 4 != 0, float(i)) for i in range(20)],
                               "seq long, ts long, server string, tool string, allowed boolean, latency_ms double")
    row = audit.audit_stats(df, 8).first()
    assert (row.total_calls, row.blocked_calls, row.block_rate, row.avg_latency_ms) == (8, 2, 0.25, 15.5)
    assert [r.seq for r in audit.recent_entries(df, 2).collect()] == [19, 18]
