import json
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import audit, dedup
from shelfwise.streaming import calls, history, ordered

CALL = "seq long, ts long, server string"


def drain(df, tmp_path, name):
    df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(
        availableNow=True).start(str(tmp_path / name)).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / name))


def test_admission_keeps_state_between_batches(spark, tmp_path):
    rows = [(i, i * 100, "a" if i % 3 else "b") for i in range(60)]
    for part in range(3):
        spark.createDataFrame(rows[part * 20:part * 20 + 20], CALL).coalesce(1).write.parquet(str(tmp_path / f"in/{part}"))
    source = spark.readStream.schema(CALL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    got = {r.seq: r.admitted for r in drain(calls.admit(source, {"a": 2}, 1, 1000), tmp_path, "out").collect()}
    batch = spark.createDataFrame([(*r, "t") for r in rows], f"{CALL}, tool string")
    want = {r.seq: r.admitted for r in audit.admit(batch, {"a": 2}, 1, 1000).collect()}
    assert got == want and len(set(want.values())) == 2


@pytest.fixture
def timers(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ordered.STATE_STORE)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def in_batches(spark, tmp_path, batches):
    shape = "seq long, t long, server string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, shape).select("seq", F.timestamp_micros("t").alias("ts"), "server").coalesce(
            1).write.parquet(str(tmp_path / f"in/{i}"))
    return spark.readStream.schema("seq long, ts timestamp, server string").option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in/*"))


def test_ordered_admission_holds_late_calls(spark, tmp_path, timers):
    rng = random.Random(3)
    rows = [(i, rng.randrange(0, 20_000_000), rng.choice("ab")) for i in range(300)]
    arriving = sorted(rows, key=lambda r: r[1] + rng.randrange(0, 4_000_000))
    source = in_batches(spark, tmp_path, [arriving[i:i + 60] for i in range(0, 300, 60)] + [[(None, 9 * 10**9, "a")]])
    verdicts = ordered.admit_in_order(source, "5 seconds", {"a": 2}, 1, 1_000_000)
    query = verdicts.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(
        availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    got = {r.seq: r.admitted for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = spark.createDataFrame([(*r, "t") for r in rows], f"{CALL}, tool string")
    assert got == {r.seq: r.admitted for r in audit.admit(batch, {"a": 2}, 1, 1_000_000).collect()}
    assert len(set(got.values())) == 2
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress]
    assert max(held) > 0 and held[-1] == 0


def test_ordered_admission_of_calls_too_late_or_without_time(spark, tmp_path, timers):
    batches = [[(1, 1_000_000, "a"), (2, 60_000_000, "a"), (3, None, "a"), (4, 61_000_000, None)],
               [(5, 60_500_000, "a")], [(6, 1_200_000, "a"), (7, 200_000_000, "b")], [(None, 9 * 10**9, "b")]]
    got = drain(ordered.admit_in_order(in_batches(spark, tmp_path, batches), "2 seconds", {}, 1, 1_000_000), tmp_path, "out")
    # Call 6 comes when the watermark has passed its slot: the one place is taken by call 2 by then.
    assert {r.seq: (r.server, r.admitted) for r in got.collect()} == {
        1: ("a", True), 2: ("a", True), 3: ("a", None), 4: (None, True), 5: ("a", False), 6: ("a", False), 7: ("b", True)}


def test_minute_stats_from_json_lines(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    entries = [{"ts": f"2024-01-01T00:0{i}:05", "server": "s", "tool": "t", "allowed": i != 1, "reason": "OK",
                "latency_ms": 2.0 * i, "result_size": 1} for i in range(5)]
    (log / "a.jsonl").write_text("\n".join(map(json.dumps, entries)))
    rows = drain(calls.minute_stats(calls.read_audit_log(spark, str(log))), tmp_path, "stats").orderBy("window_start").collect()
    assert [(r.calls, r.blocked, r.avg_latency_ms) for r in rows] == [(1, 0, 0.0), (1, 1, 2.0), (1, 0, 4.0)]


def test_history_over_batches(spark, tmp_path):
    shape = "seq long, title string, price double, platform string, scraped_at string, rating double"
    runs = [[(1, "A", 1.0, "s", "t", 1.0), (2, "B", 1.0, "s", "t", 1.0)], [(1, "A", 1.0, "s", "t", 2.0)]]
    for i, rows in enumerate(runs):
        spark.createDataFrame(rows, shape).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        source = spark.readStream.schema(shape).parquet(str(tmp_path / "in/*"))
        history.accumulate(source, str(tmp_path / "log"), str(tmp_path / "state"), 4).awaitTermination()
    kept = history.current(spark, str(tmp_path / "log"), source.schema)
    assert {(r.title, r.rating) for r in kept.collect()} == {("A", 2.0), ("B", 1.0)}
    assert dedup.HISTORY_KEYS[-1] == "scraped_at" and kept.where(F.col("rating").isNull()).count() == 0
