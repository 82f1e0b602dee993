"""CSV records with quoted line ends, read by many tasks a file.

The text reader cuts a file into blocks at line ends, quoted or not. What a
line does to the reader's state (between records, or inside a quoted cell) is
an effect on two states: it keeps the state, flips it or forces one. Effects
compose, so running effects inside a block, and then over the blocks of a
file, tell the state in which every line begins. Lines that begin inside a
quoted cell belong to the record before them, which may have begun blocks
earlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.staging import stage

# States of a reader inside a line. FIELD: at the begin of a cell; PLAIN: in an unquoted cell; QUOTED: in a quoted
# cell; CLOSING: after a quote there, which ends the cell unless another quote follows. LINE comes before any cell.
FIELD, PLAIN, QUOTED, CLOSING, LINE = range(5)


def _ends_quoted(line: Column, begins_quoted: bool) -> Column:
    """Whether a line leaves a quoted cell open. A quote inside an unquoted cell is a plain character."""
    def step(state: Column, piece: Column) -> Column:
        # The quote before the piece, then the piece itself, which holds no quote.
        opened = (F.when(state.isin(FIELD, CLOSING), QUOTED).when(state == QUOTED, CLOSING)
                  .when(state == LINE, FIELD).otherwise(PLAIN))
        return F.when((piece == "") | (opened == QUOTED), opened).when(piece.endswith(","), FIELD).otherwise(PLAIN)

    # CLOSING and LINE stand for the state that a quote before the first piece would give: QUOTED and FIELD.
    start = F.lit(CLOSING if begins_quoted else LINE)
    return F.aggregate(F.split(line, '"'), start, step) == QUOTED


def _with_effect(lines: DataFrame) -> DataFrame:
    """``forced``: the line leads to state ``bit`` from any state; else it adds ``bit`` to the state (1: quoted)."""
    quotes = F.col("value").contains('"')
    zero, one = _ends_quoted(F.col("value"), False).cast("int"), _ends_quoted(F.col("value"), True).cast("int")
    return (lines.withColumn("_ends", F.when(quotes, F.struct(zero.alias("zero"), one.alias("one"))))
            .withColumn("forced", F.coalesce(F.col("_ends.zero") == F.col("_ends.one"), F.lit(False)))
            .withColumn("bit", F.coalesce("_ends.zero", F.lit(0))).drop("_ends"))


def _running_effect(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``all_forced`` and ``all_bit``: the effect of each row and all before it in its group."""
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    flips = F.sum(F.when(~F.col("forced"), F.col("bit")).otherwise(0)).over(so_far)
    last = F.last(F.when(F.col("forced"), F.struct("bit", "_flips")), ignorenulls=True).over(so_far)
    bit = F.coalesce("_last.bit", F.lit(0)) + F.col("_flips") - F.coalesce("_last._flips", F.lit(0))
    return (rows.withColumn("_flips", flips).withColumn("_last", last)
            .withColumn("all_forced", F.col("_last").isNotNull()).withColumn("all_bit", (bit % 2).cast("int"))
            .drop("_flips", "_last"))


def _block_states(lines: DataFrame) -> DataFrame:
    """One row a block of a file: ``begins`` (state), whether it is ``calm``, and ``carried``, its first lines' record.

    A block is calm when it begins between records and every line of it is a record. Two windows see a block's
    turning lines and a file's blocks.
    """
    turning = lines.where("forced OR bit = 1")
    effects = _running_effect(turning, ["file", "block"], "n").groupBy("file", "block").agg(
        F.max_by(F.struct("all_forced", "all_bit"), "n").alias("e"))
    counted = lines.groupBy("file", "block").agg(
        F.max(F.col("forced") & (F.col("bit") == 1)).alias("_opens"),
        F.max(~F.col("forced") & (F.col("bit") == 1)).alias("_flips_any"))
    blocks = counted.join(effects, ["file", "block"], "left").select(
        "file", "block", (F.col("_opens") | F.col("_flips_any")).alias("stirred"),
        F.coalesce("e.all_forced", F.lit(False)).alias("forced"), F.coalesce("e.all_bit", F.lit(0)).alias("bit"))
    by_file = Window.partitionBy("file").orderBy("block")
    after = _running_effect(blocks, ["file"], "block")
    return after.select("file", "block", F.coalesce(F.lag("all_bit").over(by_file), F.lit(0)).alias("begins"),
                        "stirred").withColumn("calm", ~F.col("stirred") & (F.col("begins") == 0)).drop("stirred")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files: ``file``, ``block`` and ``n`` (place of the first line), ``text`` without its line end.

    Lines end in \\n or \\r\\n; empty lines are no records. A quoted cell that
    is never closed runs to the end of its file. Blocks without open cells are
    not shuffled; the lines of other blocks are, once, and the lines of records
    of several lines a second time.
    """
    # Staged, so that all passes see the same blocks even when executors come or go.
    scanned = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), "value")
    lines = stage(_with_effect(scanned), "csv-lines")
    blocks = stage(_block_states(lines.drop("value")), "csv-blocks")
    known = lines.join(blocks, ["file", "block"])

    calm = known.where("calm").select("file", "block", "n", F.col("value").alias("text"))
    in_block = Window.partitionBy("file", "block").orderBy("n")
    open_lines = _running_effect(known.where("NOT calm"), ["file", "block"], "n").withColumn(
        "ends", F.when(F.col("all_forced"), F.col("all_bit")).otherwise((F.col("all_bit") + F.col("begins")) % 2)
    ).withColumn("state", F.lag("ends").over(in_block)).withColumn("state", F.coalesce("state", "begins"))
    alone = open_lines.where("state = 0 AND ends = 0").select("file", "block", "n", F.col("value").alias("text"))

    parts = open_lines.where("state = 1 OR ends = 1").withColumn(
        "own", F.last(F.when(F.col("state") == 0, F.struct("block", "n")), ignorenulls=True).over(
            in_block.rowsBetween(Window.unboundedPreceding, 0)))
    parts = stage(parts.select("file", "block", "n", "value", "own"), "csv-parts")
    # The record that is open where a block ends: the last that began in it or in a block before it.
    begun = parts.groupBy("file", "block").agg(F.max("own").alias("last"))
    by_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = begun.select("file", "block", F.last("last", ignorenulls=True).over(by_file).alias("carried"))
    whole = parts.join(carried, ["file", "block"]).withColumn("at", F.coalesce("own", "carried")).groupBy("file", "at").agg(
        F.sort_array(F.collect_list(F.struct("block", "n", "value"))).alias("lines")).select(
        "file", "at.block", "at.n", F.array_join("lines.value", "\n").alias("text"))
    records = calm.unionByName(alone).unionByName(whole)
    return records.withColumn("text", F.regexp_replace("text", "\r$", "")).where("text <> ''")
