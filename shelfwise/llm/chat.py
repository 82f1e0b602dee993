"""Preference pairs as training text. DataFrame functions only.

The turns of a chosen and a rejected conversation meet at their positions; the
longest common prefix of turns is rendered once as prompt, what follows it is
each side's completion, with the ranges that count for the loss.

* One shuffle by pair serves the numbering, the meeting of the sides, the
  prefix and the offsets. Offsets are running sums, so a conversation of n
  turns costs n log n. What a task holds at a time is one pair, as its output
  is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "<|end|>"


def rendered(role: Column, text: Column) -> Column:
    """``<|role|>``, a line end, the text, ``<|end|>`` and a line end."""
    return F.concat(header(role), plain(text), F.lit(f"{END}\n"))


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), plain(role), F.lit("|>\n"))


def plain(text: Column) -> Column:
    """Text in which no marker can begin; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|", "< |")


def preference_rows(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn",
                    role: str = "role", text: str = "text", learner: str = "assistant") -> DataFrame:
    """(pair_id, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask), one row for each pair.

    Both inputs hold one row a turn. Masks are arrays of [start, end) in code
    points of a completion: the learner's texts with their end marker. Turns
    are ordered by number, then role, then text; repeated turns stay. A pair
    that only one side has gets an empty completion on the other. Null roles
    and texts count as empty, a null pair id is a pair of its own, and ``<|``
    inside texts becomes ``< |``. Other columns are not read.
    """
    def side(df: DataFrame, is_chosen: bool) -> DataFrame:
        return df.select(F.col(pair).alias("pair_id"), F.lit(is_chosen).alias("is_chosen"), F.col(turn).alias("turn"),
                         F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    turns = side(chosen, True).unionByName(side(rejected, False)).repartition("pair_id")
    number = F.row_number().over(Window.partitionBy("pair_id", "is_chosen").orderBy("turn", "role", "text"))
    said = F.struct("role", "text")
    met = turns.withColumn("pos", number).groupBy("pair_id", "pos").agg(
        F.max(F.when(F.col("is_chosen"), said)).alias("c"), F.max(F.when(~F.col("is_chosen"), said)).alias("r"))

    order = Window.partitionBy("pair_id").orderBy("pos")
    same = F.min(F.coalesce(F.col("c") == F.col("r"), F.lit(False))).over(order)
    rows = met.withColumn("common", same)
    for s in ("c", "r"):
        piece = F.when(F.col(s).isNotNull(), rendered(F.col(f"{s}.role"), F.col(f"{s}.text")))
        own = F.when(F.col("common"), 0).otherwise(F.coalesce(F.length(f"{s}_piece"), F.lit(0)))
        rows = rows.withColumn(f"{s}_piece", piece).withColumn(
            f"{s}_at", F.coalesce(F.sum(own).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def joined(piece: str, when: Column) -> Column:
        parts = F.sort_array(F.collect_list(F.when(when & F.col(piece).isNotNull(), F.struct("pos", F.col(piece).alias("p")))))
        return F.array_join(F.transform(parts, lambda x: x["p"]), "")

    def mask(s: str) -> Column:
        start = F.col(f"{s}_at") + F.length(header(F.col(f"{s}.role")))
        end = F.col(f"{s}_at") + F.length(f"{s}_piece") - 1
        learns = ~F.col("common") & (F.col(f"{s}.role") == learner)
        return F.sort_array(F.collect_list(F.when(learns, F.struct(start.alias("start"), end.alias("end")))))

    return rows.groupBy("pair_id").agg(
        F.sum(F.col("common").cast("bigint")).alias("n_prefix"), joined("c_piece", F.col("common")).alias("prompt"),
        joined("c_piece", ~F.col("common")).alias("chosen"), joined("r_piece", ~F.col("common")).alias("rejected"),
        mask("c").alias("chosen_mask"), mask("r").alias("rejected_mask"))


def with_stale_reply(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                     text: str = "text", learner: str = "assistant") -> DataFrame:
    """The conversations with their last learner's reply replaced by the one before it, or by nothing.

    A rejected side for tables that hold good conversations only: the reply
    ignores what was last said.
    """
    order = Window.partitionBy(conv).orderBy(turn, role, text)
    speaks = F.coalesce(F.col(role) == learner, F.lit(False))
    reply = F.when(speaks, F.coalesce(F.col(text), F.lit("")))
    later = F.max(F.when(speaks, 1)).over(order.rowsBetween(1, Window.unboundedFollowing))
    before = F.last(reply, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return turns.select(conv, turn, role, F.when(speaks & later.isNull(), F.coalesce(before, F.lit("")))
                        .otherwise(F.col(text)).alias(text))


def spans_text(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
