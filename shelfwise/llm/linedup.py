"""Repeated runs of lines, found by winnowing over line hashes. DataFrame functions only.

* A gram is the shortest run of lines from a line with words on that has
  ``noise`` words; blank lines inside it count for its hash, but have no words.
  Of the grams that start within ``guarantee - noise`` words the least hash is
  the window's fingerprint. So two runs of at least ``guarantee`` equal words
  share a fingerprint, and nothing under ``noise`` words ever matches.
* A fingerprint's first occurrence comes from an aggregation that merges
  map-side; every other occurrence joins that one position, so a passage that
  a third of all documents share makes one pair a copy.
* Matches on one diagonal are one run, and only its two ends are extended until
  the lines differ: first by up to ``REACH`` lines, whose context is read for the
  matched documents only. What still agrees goes on by hashes of blocks, each
  round's ``REACH`` times as long, and back by shorter blocks to the difference.
  A round has one row an end, so a text that repeats itself a thousand times
  costs a thousand rows. Each deleted line has an equal, earlier line.
* Windows run inside one document; joins on hot fingerprints are left to the
  adaptive skew split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.staging import drop_stage, stage

NOISE, GUARANTEE = 40, 50
#: Lines, then blocks of lines, by which a round extends a run's ends: a power of two.
REACH = 64


def document_key(doc_id: str, text: str) -> Column:
    """Non-null key of a document: rows that repeat id and text are one document, null ids come last."""
    return F.struct(F.col(doc_id).isNull().alias("nameless"), F.col(doc_id).alias("id"),
                    F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash"))


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, pos, h, words, start, total, place) of every line of every document.

    ``start`` are the words before the line, ``total`` those of the document;
    ``place`` counts the lines with words before it, so blank lines share the
    place of the next line with words.
    """
    lines = docs.select(document_key(doc_id, text).alias("doc"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    own = Window.partitionBy("doc")
    before = own.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (lines.select("doc", "pos", F.md5("line").alias("h"), F.regexp_count("line", F.lit(r"\S+")).cast("bigint").alias("words"))
            .repartition("doc").distinct()
            .select("doc", "pos", "h", "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"),
                    F.sum("words").over(own).alias("total"),
                    F.coalesce(F.sum(F.when(F.col("words") > 0, 1).otherwise(0)).over(before), F.lit(0)).alias("place")))


def fingerprints(lines: DataFrame, noise: int, guarantee: int) -> DataFrame:
    """(doc, gram, pos, lines): the window minima of every document."""
    with_words = F.col("words") > 0
    blank = F.sort_array(F.collect_list(F.when(~with_words, F.struct("pos", "h"))))
    marked = lines.groupBy("doc", "place").agg(
        F.when(F.size(blank) > 0, F.md5(F.array_join(blank["h"], "."))).otherwise("").alias("blank"),
        *[F.max(F.when(with_words, F.col(c))).alias(c) for c in ("pos", "h", "start", "total")]).where("pos IS NOT NULL")
    order = Window.partitionBy("doc").orderBy("start")
    run = order.rangeBetween(0, noise - 1)
    parts = F.transform("run", lambda x, i: F.when(i == 0, x["h"]).otherwise(F.concat(x["blank"], F.lit(","), x["h"])))
    grams = marked.withColumns({"run": F.collect_list(F.struct("blank", "h")).over(run), "last": F.max("pos").over(run)}).select(
        "doc", "start", "total", F.struct(F.md5(F.array_join(parts, ";")).alias("gram"), "pos",
                                          (F.col("last") - F.col("pos") + 1).alias("lines")).alias("g"))
    least = F.min("g").over(order.rangeBetween(0, guarantee - noise))
    return grams.withColumn("f", least).where(F.col("total") - F.col("start") >= guarantee).select("doc", "f.*").distinct()


def _agree(a: str, b: str) -> Column:
    """Number of leading elements in which two arrays are equal."""
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    return F.when(at > 0, at - 1).otherwise(F.least(F.size(a), F.size(b)))


def _contexts(blocks: DataFrame, cuts: DataFrame, unit: int) -> DataFrame:
    """(doc, cut, left, near): hashes of the ``REACH`` blocks of ``unit`` lines before or from a cut, nearest first.

    Blocks and cuts meet in one shuffle by document, which also serves the windows.
    """
    at = cuts.select("doc", "cut", "left").unionByName(
        cuts.select(F.col("doc0").alias("doc"), F.col("cut0").alias("cut"), "left")).distinct()
    met = blocks.join(at.select("doc").distinct(), "doc", "left_semi").select(
        "doc", "pos", F.xxhash64("h").alias("h"), F.lit(False).alias("left"), F.lit(False).alias("right")).unionByName(
        at.select("doc", F.col("cut").alias("pos"), F.lit(None).cast("bigint").alias("h"), "left", (~F.col("left")).alias("right")))
    rows = met.repartition("doc").groupBy("doc", "pos").agg(
        F.max("h").alias("h"), F.max("left").alias("left"), F.max("right").alias("right"))
    order = Window.partitionBy("doc", F.pmod("pos", F.lit(unit))).orderBy("pos")
    around = rows.select("doc", "pos", "left", "right",
                         F.collect_list("h").over(order.rowsBetween(-REACH, -1)).alias("before"),
                         F.collect_list("h").over(order.rowsBetween(0, REACH - 1)).alias("after")).where("left OR right")
    sides = F.array(F.when(F.col("left"), F.struct(F.lit(True).alias("left"), F.reverse("before").alias("near"))),
                    F.when(F.col("right"), F.struct(F.lit(False).alias("left"), F.col("after").alias("near"))))
    return around.select("doc", "pos", F.explode(F.array_compact(sides)).alias("s")).select("doc", F.col("pos").alias("cut"), "s.*")


def _blocks(blocks: DataFrame, unit: int) -> DataFrame:
    """(doc, pos, h): hash of ``REACH`` blocks of ``unit`` lines in a row, for every line with so many lines from it on."""
    order = Window.partitionBy("doc").orderBy("pos")
    for k in range(REACH.bit_length() - 1):
        blocks = blocks.withColumn("h", F.md5(F.concat("h", F.lead("h", unit << k).over(order))))
    return blocks.where("h IS NOT NULL")


def _advanced(blocks: DataFrame, ends: DataFrame, unit: int) -> DataFrame:
    """``ends`` with n raised by the equal blocks beyond, at most ``REACH`` of them, and whether it is ``full`` so many."""
    side = F.when(F.col("left"), -1).otherwise(1)
    cuts = ends.withColumns({"cut": F.col("pos") + side * F.col("n"), "cut0": F.col("pos0") + side * F.col("n")})
    context = stage(_contexts(blocks, cuts, unit), "winnow-context")
    met = cuts.join(context, ["doc", "cut", "left"]).join(
        context.select(F.col("doc").alias("doc0"), F.col("cut").alias("cut0"), "left", F.col("near").alias("near0")),
        ["doc0", "cut0", "left"]).withColumn("equal", _agree("near", "near0"))
    out = stage(met.select("doc", "pos", "left", "doc0", "pos0", (F.col("n") + unit * F.col("equal")).alias("n"),
                           (F.col("equal") == REACH).alias("full")), "winnow-met")
    drop_stage(context)
    return out


def _extended(lines: DataFrame, ends: DataFrame) -> DataFrame:
    """``ends`` with the number n of equal lines beyond them: blocks grow while all agree, then shrink to the difference."""
    levels, stopped, going = [lines.select("doc", "pos", "h")], [], ends.withColumn("n", F.lit(0))
    while True:
        unit = REACH ** len(stopped)
        met = _advanced(levels[-1], going, unit)
        stopped.append(met.where("NOT full").drop("full"))
        going = met.where("full").drop("full")
        if going.isEmpty():
            break
        docs = going.select("doc").unionByName(going.select(F.col("doc0").alias("doc"))).distinct()
        levels.append(stage(_blocks(levels[-1].join(docs, "doc", "left_semi"), unit), "winnow-blocks"))
    done = stopped.pop()
    while stopped:
        levels.pop()
        done = _advanced(levels[-1], done, REACH ** (len(stopped) - 1)).drop("full").unionByName(stopped.pop())
    return done


def repeated_lines(lines: DataFrame, noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """(doc, spans): ranges [first, last] of line positions that repeat an earlier run."""
    found = stage(fingerprints(lines, noise, guarantee), "winnow-fingerprints")
    firsts = found.groupBy("gram").agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1")
    pairs = (found.join(firsts.select("gram", "first"), "gram").where(F.struct("doc", "pos") != F.col("first"))
             .select("doc", "pos", "lines", F.col("first.doc").alias("doc0"), (F.col("pos") - F.col("first.pos")).alias("shift")))
    diagonal = Window.partitionBy("doc", "doc0", "shift").orderBy("pos")
    until = F.max(F.col("pos") + F.col("lines")).over(diagonal.rowsBetween(Window.unboundedPreceding, -1))
    runs = stage(
        pairs.withColumn("new", F.when(F.col("pos") <= until, 0).otherwise(1)).withColumn("run", F.sum("new").over(diagonal))
        .groupBy("doc", "doc0", "shift", "run").agg(
            F.min("pos").alias("a"), (F.max(F.col("pos") + F.col("lines")) - 1).alias("b")).drop("run"), "winnow-runs")

    def ends_of(cut: Column, left: bool) -> DataFrame:
        return runs.select("doc", cut.alias("pos"), F.lit(left).alias("left"), "doc0", (cut - F.col("shift")).alias("pos0"))

    ends = stage(ends_of(F.col("a"), True).unionByName(ends_of(F.col("b") + 1, False)), "winnow-ends")
    beyond = _extended(lines, ends).where("n > 0").select(
        "doc", F.when(F.col("left"), F.col("pos") - F.col("n")).otherwise(F.col("pos")).alias("a"),
        (F.when(F.col("left"), F.col("pos")).otherwise(F.col("pos") + F.col("n")) - 1).alias("b"))
    spans = runs.select("doc", "a", "b").unionByName(beyond).distinct()
    by_start = Window.partitionBy("doc").orderBy("a", "b")
    reached = F.max("b").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.select("doc", "a", "b", F.when(F.col("a") <= reached + 1, 0).otherwise(1).alias("new")).select(
        "doc", "a", "b", F.sum("new").over(by_start).alias("island"))
    merged = islands.groupBy("doc", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return merged.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", noise: int = NOISE,
                 guarantee: int = GUARANTEE) -> DataFrame:
    """(row, spans, new_text): each row of ``docs`` as a struct, its deleted line ranges and its text without them.

    A run of lines is deleted where it occurs earlier, by doc_id and then by
    position, also inside one document. Runs of ``guarantee`` words or more are
    found, runs under ``noise`` words never. ``spans`` is empty and the text as
    it was where nothing is deleted; a null text stays null. Rows that repeat id
    and text are one document and lose the same lines. Null ids come last. All
    columns of ``docs`` stay inside ``row``, so names cannot clash.
    """
    lines = stage(line_table(docs, doc_id, text), "winnow-lines")
    spans = repeated_lines(lines, noise, guarantee)
    rows = docs.select(document_key(doc_id, text).alias("doc"), F.struct("*").alias("row")).join(spans, "doc", "left")
    kept = F.expr(f"array_join(filter(split(row.`{text}`, '\n'), (line, i) -> "
                  "NOT exists(spans, s -> i BETWEEN s.a AND s.b)), '\n')")
    return rows.select("row", F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")).alias("spans"),
                       F.when(F.col("spans").isNull(), F.col(f"row.{text}")).otherwise(kept).alias("new_text"))


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed, text_sha256), one row for each row of ``docs``.

    ``removed`` lists the deleted ranges as ``first-last``, joined by commas;
    the digest is of the text that remains. A null text has no lines and a null
    digest.
    """
    found = deduplicated(docs.select(doc_id, text), doc_id, text, **options)
    return found.select(
        F.col(f"row.{doc_id}").alias("doc_id"),
        F.coalesce(F.size(F.split(f"row.{text}", "\n")), F.lit(0)).cast("bigint").alias("n_lines"),
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"] + 1).alias("n_removed"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["a"].cast("string"), s["b"].cast("string"))),
                     ",").alias("removed"),
        F.sha2("new_text", 256).alias("text_sha256"))


def clean_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without their repeated lines, with all their columns in order.

    A document that loses all its words goes; ``n_chars``, where there is one,
    follows a changed text.
    """
    found = deduplicated(docs, doc_id, text, **options)
    emptied = (F.size("spans") > 0) & ~F.col("new_text").rlike(r"\S")
    changed = {text: F.col("new_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("new_text").cast(kind)).otherwise(F.col("row.n_chars"))
    return found.where(~emptied).select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
