"""Streaming call log: rolling statistics and sliding-window admission."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwise import schema
from shelfwise.operators.audit import DEFAULT_RATE_LIMIT, RATE_LIMITS, SPAN


def read_audit_log(spark: SparkSession, folder: str) -> DataFrame:
    """Audit entries as they are appended to a folder of JSON lines."""
    return spark.readStream.schema(schema.AUDIT).json(folder).withColumn(
        "ts", F.try_to_timestamp("ts"))


def minute_stats(log: DataFrame, late: str = "1 minute", width: str = "1 minute") -> DataFrame:
    """Calls, blocked calls and mean latency per server and window."""
    return (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "server")
        .agg(F.count("*").alias("calls"), F.count_if(~F.col("allowed")).alias("blocked"),
             F.avg("latency_ms").alias("avg_latency_ms"))
        .select(F.col("window.start").alias("window_start"), "server", "calls", "blocked", "avg_latency_ms")
    )


def keep_minute_stats(log: DataFrame, folder: str, state: str, late: str = "1 minute", width: str = "1 minute"):
    """Start writing every changed window of each micro-batch to ``folder``; open windows come out too.

    A batch writes to a folder of its own number, so a batch that runs again
    after a failure replaces what it wrote before.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{folder}/{number:020d}")

    return minute_stats(log, late, width).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", state).trigger(availableNow=True).start()


def current_minute_stats(spark: SparkSession, folder: str) -> DataFrame:
    """The latest state of every (window, server)."""
    rows = spark.read.parquet(f"{folder}/*")
    latest = rows.groupBy("window_start", "server").agg(F.max_by(F.struct("calls", "blocked", "avg_latency_ms"), "batch").alias("s"))
    return latest.select("window_start", "server", "s.*")


def admit(
    calls: DataFrame,
    limits: dict[str, int] = RATE_LIMITS,
    default: int = DEFAULT_RATE_LIMIT,
    span: int = SPAN,
) -> DataFrame:
    """Admission verdicts of ``(seq, ts, server)`` calls; ``ts`` in microseconds.

    The state of a server is the admitted timestamps of the last span, at most
    its limit. Calls are taken in (ts, seq) order within a micro-batch; one
    that arrives after younger calls of an earlier batch is judged on arrival.
    """
    def judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        server = key[0]
        limit = limits.get(server, default)
        recent = deque(state.get[0] if state.exists else ())
        calls_now = pd.concat([b[["ts", "seq"]] for b in batches]).sort_values(["ts", "seq"])
        verdicts = []
        for ts in calls_now["ts"].tolist():
            while recent and recent[0] <= ts - span:
                recent.popleft()
            admitted = len(recent) < limit
            if admitted:
                recent.append(ts)
            verdicts.append(admitted)
        state.update((list(recent),))
        yield pd.DataFrame({"seq": calls_now["seq"].to_numpy(), "server": server, "admitted": verdicts})

    return calls.select("seq", "ts", "server").groupBy("server").applyInPandasWithState(
        judge, "seq bigint, server string, admitted boolean", "recent array<bigint>",
        "append", GroupStateTimeout.NoTimeout)
