"""Call logs: permissions, offered load, admission, statistics.

A call frame has ``seq`` (unique, in arrival order), ``ts`` in microseconds,
``server`` and ``tool``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.operators import admission
from shelfwise.staging import stage

MICROS = 1_000_000
SPAN = 60 * MICROS

# Tools each server may run, and calls per minute.
PERMISSIONS = {
    "data_server": ["get_top_products", "get_cluster_profile", "get_association_rules", "get_market_stats"],
    "llm_server": [
        "summarize_product", "generate_trend_report", "build_client_profile",
        "recommend_strategy", "answer_question", "generate_bi_report",
    ],
}
RATE_LIMITS = {"llm_server": 20, "data_server": 60}
DEFAULT_RATE_LIMIT = 100


def permission_table(spark: SparkSession, permissions: dict[str, list[str]] = PERMISSIONS) -> DataFrame:
    rows = [(server, tool) for server, tools in permissions.items() for tool in tools]
    return spark.createDataFrame(rows, "server string, tool string")


def check_permissions(calls: DataFrame, permissions: dict[str, list[str]] = PERMISSIONS) -> DataFrame:
    """``permitted`` per call; the permission table is a constant, so it is broadcast."""
    table = permission_table(calls.sparkSession, permissions).withColumn("_ok", F.lit(True))
    return calls.join(F.broadcast(table), ["server", "tool"], "left").select(
        *calls.columns, F.coalesce("_ok", F.lit(False)).alias("permitted")
    )


def denied_calls(calls: DataFrame, permissions: dict[str, list[str]] = PERMISSIONS) -> DataFrame:
    table = permission_table(calls.sparkSession, permissions)
    return calls.join(F.broadcast(table), ["server", "tool"], "left_anti")


def offered_load(calls: DataFrame, span: int = SPAN) -> DataFrame:
    """``load``: calls to the same server in the ``span`` up to and including this one.

    Calls of one moment are counted first. Moments, and for each moment the
    question how many calls came up to a span earlier, are sorted together into
    ranges of equal numbers of rows and numbered there; the load is a
    difference of two running counts. So neither a busy server nor a busy
    minute meets in one task.
    """
    moments = stage(calls.groupBy("server", "ts").agg(F.count("*").alias("n")), "moments")
    asked = moments.select("server", (F.col("ts") - span).alias("t"), "ts", F.lit(0).cast("long").alias("n"), F.lit(True).alias("asks"))
    line = moments.select("server", F.col("ts").alias("t"), "ts", "n", F.lit(False).alias("asks")).unionByName(asked)
    order = ["server", "t", "asks"]
    parts = stage(line.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "call-line")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.sum("n").alias("_size")).select(
        "part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    counted = parts.withColumn("_upto", upto).join(F.broadcast(offsets), "part").select(
        F.col("server").alias("_server"), F.col("ts").alias("_ts"),
        F.when(F.col("asks"), -F.col("_upto") - F.col("_offset")).otherwise(F.col("_upto") + F.col("_offset")).alias("count"))
    loads = counted.groupBy("_server", "_ts").agg(F.sum("count").alias("load"))
    return calls.join(loads, F.col("server").eqNullSafe(F.col("_server")) & (F.col("ts") == F.col("_ts"))).select(*calls.columns, "load")


def rate_limit_of(server: Column, limits: dict[str, int], default: int) -> Column:
    limit = F
    for name, value in limits.items():
        limit = limit.when(server == name, value)
    return limit.otherwise(default) if limits else F.lit(default)


def _verdicts(calls: DataFrame, limits: dict[str, int], default: int, span: int) -> DataFrame:
    limit = rate_limit_of(F.col("server"), limits, default).cast("int").alias("limit")
    return admission.verdicts(calls.select("seq", "ts", "server", limit), span).select("seq", "admitted")


def admit(
    calls: DataFrame,
    limits: dict[str, int] = RATE_LIMITS,
    default: int = DEFAULT_RATE_LIMIT,
    span: int = SPAN,
) -> DataFrame:
    """``admitted`` per call under a sliding limit; denied calls use no budget.

    Replayed in parallel over parts of equal numbers of calls, see
    :mod:`shelfwise.operators.admission`.
    """
    return calls.join(_verdicts(calls, limits, default, span), "seq").select(*calls.columns, "admitted")


def call_outcomes(
    calls: DataFrame,
    permissions: dict[str, list[str]] = PERMISSIONS,
    limits: dict[str, int] = RATE_LIMITS,
    default: int = DEFAULT_RATE_LIMIT,
    span: int = SPAN,
) -> DataFrame:
    """Gateway verdict per call: unknown tool, denied, limited, error or ok.

    Only permitted calls take part in the rate limit. ``error`` (optional
    column) marks calls whose tool failed; ``result`` gives the result size.
    """
    routed = sorted({tool for tools in permissions.values() for tool in tools})
    checked = check_permissions(calls, permissions).withColumn("_routed", F.col("tool").isin(routed))
    permitted = checked.where("permitted")
    limited = _verdicts(permitted, limits, default, span)
    joined = checked.join(limited, "seq", "left")
    failed = F.col("error").isNotNull() if "error" in calls.columns else F.lit(False)
    size = F.length(F.coalesce(F.col("result"), F.lit(""))) if "result" in calls.columns else F.lit(0)
    allowed = F.col("permitted") & F.coalesce("admitted", F.lit(False))
    reason = (
        F.when(~F.col("_routed"), "Unknown tool")
        .when(~F.col("permitted"), F.concat(F.lit("Tool '"), "tool", F.lit("' not permitted for server '"),
                                            "server", F.lit("'")))
        .when(~F.col("admitted"), F.concat(
            F.lit("Rate limit exceeded: "), rate_limit_of(F.col("server"), limits, default).cast("string"),
            F.lit(" calls/min for '"), "server", F.lit("'")))
        .when(failed, "error").otherwise("OK")
    )
    return joined.select(
        *calls.columns, allowed.alias("allowed"), reason.alias("reason"),
        F.when(allowed, size).otherwise(0).cast("bigint").alias("result_size"),
    )


def recent_entries(log: DataFrame, n: int = 50, order: list[str] = ("ts", "seq")) -> DataFrame:
    """The last ``n`` log entries (a distributed top-k)."""
    return log.orderBy(*[F.desc(c) for c in order]).limit(n)


def audit_stats(log: DataFrame, n: int = 1000) -> DataFrame:
    """Totals, block rate and mean latency over the last ``n`` entries."""
    blocked = F.count_if(~F.col("allowed"))
    return recent_entries(log, n).agg(
        F.count("*").alias("total_calls"), blocked.alias("blocked_calls"),
        F.round(blocked / F.count("*"), 3).alias("block_rate"),
        F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
    )


def audit_by_server(log: DataFrame, n: int = 1000) -> DataFrame:
    return recent_entries(log, n).groupBy("server").agg(F.count("*").alias("calls"))


def minute_stats(log: DataFrame, span: int = SPAN) -> DataFrame:
    """Batch twin of the streaming rollup: calls per server and minute."""
    start = F.floor(F.col("ts") / F.lit(span)) * span
    return log.groupBy(start.alias("window_start"), "server").agg(
        F.count("*").alias("calls"), F.count_if(~F.col("allowed")).alias("blocked"),
        F.round(F.avg("latency_ms"), 3).alias("avg_latency_ms"),
    )
