"""Exact duplicates by distributed most-significant-digit radix partitioning.

A digit is a block of successive bytes of the normalised text. A round counts
the rows of each (group, digit): single rows are done, groups whose text has
ended are classes of equal texts, and what remains is split again by the next
block. The block grows eightfold a round, so a text of n bytes takes
log8(n / 64) rounds. Equality is decided by bytes alone; digests are output only.

* The first round counts 64-byte digits without moving texts, and rows whose
  digit is their own leave there. Later rounds carry only open rows.
* Counts merge map-side, so a group that holds a third of all rows costs one
  row a task. Rows then meet their group's record in a merge join that the
  adaptive planner can split, never in a window or a collected list. The join
  is the same at every size, as the number of groups follows the rows.
* Every round is a written table, so lost executors re-read files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.staging import stage

FIRST_WIDTH, GROWTH = 64, 8
_WHITE = "[\\x20\\x09-\\x0D]+"


def normalised(text: str) -> F.Column:
    """UTF-8 bytes of the text without ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.encode(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _WHITE, ""), "UTF-8")


def _digit(column: str, width: int) -> F.Column:
    return F.substring(column, 1, width)


def _first_round(rows: DataFrame, width: int) -> DataFrame:
    """Rows alone with their first digit are closed; the others get a group number and the rest of their bytes."""
    shared = (rows.select(_digit("body", width).alias("digit")).groupBy("digit").count().where("count > 1")
              .select("digit", F.monotonically_increasing_id().alias("gid")))
    shared = stage(shared, "radix-groups")
    return rows.withColumn("digit", _digit("body", width)).join(shared.hint("merge"), "digit", "left").select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "n_points", F.unhex(F.sha2("body", 256)).alias("sha"),
        F.col("gid").isNotNull().alias("open"), F.lit(1).cast("bigint").alias("group_size"),
        F.col("doc_id").alias("keep_id"), F.lit(True).alias("kept"), "gid",
        F.when(F.col("gid").isNotNull(), F.substring("body", width + 1, 2**31 - 1 - width)).alias("rest"))


def _next_round(rows: DataFrame, width: int) -> DataFrame:
    """Split open groups by the next block of bytes."""
    keyed = rows.withColumn("digit", _digit("rest", width))
    first = F.struct((-F.col("n_points")).alias("longest"), F.col("doc_id").isNull().alias("nameless"),
                     F.col("doc_id").alias("doc_id"), F.col("uid").alias("uid"))
    groups = stage(
        keyed.groupBy("gid", "digit").agg(F.count("*").alias("n"), F.min(first).alias("keep"))
        .select("gid", "digit", "n", "keep", F.monotonically_increasing_id().alias("new")), "radix-groups")
    met = keyed.join(groups.hint("merge"), ["gid", "digit"])
    ended = F.length("digit") < width
    still = (F.col("n") > 1) & ~ended
    return met.select(
        "uid", "doc_id", "n_points", "sha", still.alias("open"), F.col("n").alias("group_size"),
        F.col("keep.doc_id").alias("keep_id"), (F.col("keep.uid") == F.col("uid")).alias("kept"),
        F.when(still, F.col("new")).alias("gid"),
        F.when(still, F.substring("rest", width + 1, 2**31 - 1 - width)).alias("rest"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = FIRST_WIDTH,
                     growth: int = GROWTH) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``.

    Texts are equal when identical without white space. The row with the most
    code points in its original text stays, then the smallest doc_id; null ids
    come last, and of rows that repeat a doc_id one stays. Null texts count as
    empty and form one class with empty ones. An empty table gives an empty
    result. Other columns are not read.
    """
    body = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("body"),
                       F.length(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("n_points"))
    current, closed = stage(_first_round(body, width), "radix"), []
    while True:
        closed.append(current.where("not open"))
        todo = current.where("open")
        if todo.isEmpty():
            break
        width *= growth
        current = stage(_next_round(todo, min(width, 2**30)), "radix")
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
