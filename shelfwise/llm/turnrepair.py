"""Repair of conversation structure by weighted interval parsing.

A repaired conversation has the role initials ``(s?(ua)+)?``. The grammar of
all repairs is in Chomsky normal form: a nonterminal ``(p, q)`` stands for the
edits that lead the role automaton from state p to state q, with the rules

    (p, q) -> (p, r) (r, q)      (p, q) -> one row kept, given a role, or deleted

and the insertions as closure around every row. A cell holds, for each
nonterminal, the least (cost, audit) over its span of rows. Two audits of one
span and one cost never are prefixes of each other (their rows' letters would
agree and the longer would have paid for more insertions), so the least audit
survives joining on both sides, joining is associative, and one split of a span
gives what all splits give. Spans are therefore combined bottom-up by length:
1, 2, 4, ... rows, then what is left.

* Rows are range-partitioned by their place in their conversation, so a
  conversation of any length is spread over tasks; a task holds one cell per
  power of two. The parts of a conversation are combined like its rows.
* "Seen earlier" is a pre-aggregated count by digest; only texts that repeat in
  their conversation are joined.
* Texts move once, to write repaired conversations in order. That is a sorted
  stream of one task per conversation, since a digest is sequential; it holds
  one row and the conversation's audit.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import _arrow_type
from shelfwise.staging import stage

WHITE = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Costs of the edits.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
#: The role automaton: start, after s, after u, after a; the first and the last accept.
STATES, START, ACCEPTING = 4, 0, (0, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = {"su", "ua", "au"}

Cell = dict[tuple[int, int], tuple[int, str]]


def _least(found: Iterable[tuple[tuple[int, int], tuple[int, str]]]) -> Cell:
    cell: Cell = {}
    for ends, best in found:
        if ends not in cell or best < cell[ends]:
            cell[ends] = best
    return cell


def joined(left: Cell, right: Cell) -> Cell:
    """The rule (p, q) -> (p, r) (r, q)."""
    return _least(((p, q), (c + d, a + b)) for (p, r), (c, a) in left.items() for (s, q), (d, b) in right.items() if r == s)


@functools.cache
def insertions() -> Cell:
    """Closure of the insertions: edits that use no row."""
    one = {(p, q): (INSERT, "I") for (p, role), q in STEP.items() if role in "ua"}
    closed = {(p, p): (0, "") for p in range(STATES)}
    while True:
        more = _least([*closed.items(), *joined(closed, one).items()])
        if more == closed:
            return closed
        closed = more


@functools.cache
def row_cell(initial: str, fault: int) -> Cell:
    """The cell of one row, insertions on both sides included."""
    ways = [((p, p), (DELETE, "D")) for p in range(STATES)]
    if fault not in (BLANK, DUPLICATE):
        extra = UNFINISHED if fault == TRUNCATED else 0
        ways += [((p, q), (extra, "K")) for (p, role), q in STEP.items() if role == initial]
        ways += [((p, q), (REROLE + extra, "R")) for (p, role), q in STEP.items() if role in "ua"]
    return joined(joined(insertions(), _least(ways)), insertions())


class Span:
    """Bottom-up combination of rows, or of parts, of one conversation, in order."""

    def __init__(self):
        self.levels: list[tuple[int, Cell]] = []
        self.rows = self.illegal = self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.first = self.last = self.low = self.high = None

    def _push(self, rows: int, cell: Cell) -> None:
        self.levels.append((rows, cell))
        while len(self.levels) > 1 and self.levels[-2][0] <= self.levels[-1][0]:
            (a, left), (b, right) = self.levels[-2:]
            self.levels[-2:] = [(a + b, joined(left, right))]

    def add(self, initial: str, fault: int, turn: int | None) -> None:
        self._push(1, row_cell(initial, fault))
        self._meet(initial, initial, 0)
        self._turns(turn, turn, 1)
        self.rows += 1
        self.faults[fault] += 1

    def add_part(self, part: dict) -> None:
        if not part["rows"]:
            return
        self._push(part["rows"], {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in part["cells"]})
        self._meet(part["first"], part["last"], part["illegal"])
        self._turns(part["low"], part["high"], part["turns"])
        self.rows += part["rows"]
        self.faults = [a + b for a, b in zip(self.faults, part["faults"])]

    def _meet(self, first: str, last: str, illegal: int) -> None:
        if self.rows:
            self.illegal += self.last + first not in LEGAL
        else:
            self.first = first
        self.illegal += illegal
        self.last = last

    def _turns(self, low: int | None, high: int | None, distinct: int) -> None:
        if low is None:
            return
        self.turns += distinct - (self.high == low)
        self.low = low if self.low is None else self.low
        self.high = high

    def cell(self) -> Cell:
        whole = insertions()
        for _, one in reversed(self.levels):
            whole = joined(one, whole)
        return whole

    def part(self) -> dict:
        return {"rows": self.rows, "illegal": self.illegal, "turns": self.turns, "faults": self.faults, "first": self.first,
                "last": self.last, "low": self.low, "high": self.high,
                "cells": [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in self.cell().items()]}

    def report(self) -> dict:
        cell = self.cell()
        cost, audit = min(cell[START, q] for q in ACCEPTING if (START, q) in cell)
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return {"gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "cost": cost, "audit": audit}


def _by_conversation(add, result):
    """A pass over rows sorted by conversation and place: one row for each conversation and run of the pass."""
    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        key, span, done = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if span is None or row["conv_id"] != key:
                    if span is not None:
                        done.append({"conv_id": key, **result(span)})
                    key, span = row["conv_id"], Span()
                add(span, row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if span is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": key, **result(span)}], schema)
    return run


def _passed(df: DataFrame, added: str, run) -> DataFrame:
    """``df`` through an ordered pass that keeps conv_id and gives the columns ``added``."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    fields = StructType([df.schema["conv_id"], *_parse_datatype_string(added).fields])
    schema = pa.schema([(f.name, _arrow_type(f)) for f in fields.fields])
    return df.mapInArrow(lambda batches: run(batches, schema), fields)


PART = ("rows long, illegal long, turns long, faults array<long>, first string, last string, low long, high long, "
        "cells array<struct<p:int,q:int,cost:long,audit:string>>")
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
ORDER = ["turn", "role", "head", "digest", "uid"]


def _ordered_turns(turns: DataFrame) -> DataFrame:
    """Staged rows with the keys of their order, first fault and role initial."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    own = F.when(F.length(trimmed) == 0, BLANK).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    rows = stage(turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), "gone",
    ).select("*", F.substring("text", 1, 64).alias("head"),
             F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
             own.alias("own"), F.monotonically_increasing_id().alias("uid")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "uid")
    repeated = rows.where("not gone").groupBy("conv_id", "digest").agg(
        F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select(
        F.col("conv_id").alias("k"), F.col("digest").alias("d"), F.col("first.uid").alias("first_uid"))
    met = rows.join(repeated.hint("merge"), F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")), "left")
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("first_uid") != F.col("uid"), DUPLICATE).otherwise(F.col("own"))
    return met.select("conv_id", *ORDER, "text", "gone", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"))


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           gone: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(reports, repaired): one report for each conversation, and the turns of the repaired conversations.

    ``reports``: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit. ``repaired``: conv_id, place (from 0), edit, role, text; the rows of a
    conversation lie in order in one partition, beginning with one of edit ''.

    Rows count by turn, null turns first; rows of one turn by role, the first 64
    characters and the digest of the text. Null roles and texts count as one
    space, null conv_ids are a conversation. A repeated row is a duplicate.
    Rows marked in ``gone`` are no turns, but their conversation is reported.
    An empty table gives empty results; other columns are not read.
    """
    named = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                         F.col(text).alias("text"), (F.col(gone) if gone else F.lit(False)).alias("gone"))
    rows = stage(_ordered_turns(named), "turns-judged")
    keys = ["conv_id", *ORDER]
    spread = rows.select(*keys, "initial", "fault", "gone").repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv_id", "turn", "initial", "fault", "gone", F.spark_partition_id().alias("part"))

    def add_row(span: Span, row: dict) -> None:
        span.at = row["part"]
        if not row["gone"]:
            span.add(row["initial"], row["fault"], row["turn"])

    parts = _passed(spread, f"part int, {PART}", _by_conversation(add_row, lambda s: {"part": s.at, **s.part()}))
    together = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    reports = stage(_passed(together, REPORT, _by_conversation(Span.add_part, Span.report)), "turns-reports")

    nothing = {"turn": "long", "role": "string", "head": "string", "digest": "binary", "uid": "long", "fault": "int", "initial": "string"}
    heads = reports.select("conv_id", F.col("audit").alias("text"), F.lit(0).alias("body"),
                           *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    bodies = rows.where("not gone").withColumn("body", F.lit(1)).select(*heads.columns)
    stream = heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "body", *ORDER)
    repaired = _passed(stream.select("conv_id", "body", "role", "text"), "place long, edit string, role string, text string", _write)
    return reports, repaired


def _write(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Repaired turns from each conversation's audit and its rows in order.

    A repaired conversation ends after an assistant, so a given role follows
    from the number of turns still to come.
    """
    key = audit = None
    at = place = left = 0

    def turn(edit: str, role: str | None, text: str) -> dict:
        nonlocal place, left
        left -= 1
        place += 1
        return {"conv_id": key, "place": place - 1, "edit": edit, "text": text,
                "role": role if edit == "K" else "user" if left % 2 else "assistant"}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["body"] == 0:
                key, audit, at, place = row["conv_id"], row["text"], 0, 0
                left = len(audit) - audit.count("D")
                out.append({"conv_id": key, "place": None, "edit": "", "role": None, "text": None})
            else:
                edit = audit[at]
                at += 1
                if edit != "D":
                    out.append(turn(edit, row["role"], row["text"]))
            while at < len(audit) and audit[at] == "I":
                out.append(turn("I", None, ""))
                at += 1
        yield pa.RecordBatch.from_pylist(out, schema)


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines, newline-joined, as ``repair`` wrote them in order."""
    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if not row["edit"]:
                    if digest is not None:
                        done.append({"conv_id": key, "repaired_sha256": digest.hexdigest()})
                    key, digest = row["conv_id"], hashlib.sha256()
                    continue
                if row["place"]:
                    digest.update(b"\n")
                digest.update(f"{row['role']}:{row['text']}".encode())
            yield pa.RecordBatch.from_pylist(done, schema)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": key, "repaired_sha256": digest.hexdigest()}], schema)

    return _passed(repaired, "repaired_sha256 string", run)


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Test damage by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space): (conv_id, turn, role, text, gone).

    0 marks the row as gone, 1 empties its text, 2 removes ``[.!?]``, 3 repeats
    the row, 4 makes its role user. Repeated rows are damaged alike.
    """
    def known(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known(conv_id), F.lit(":"), known(turn)).cast("binary")) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known(text), "[.!?]", "")).otherwise(known(text))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.when(kind == 4, "user").otherwise(known(role)).alias("role"),
        body.alias("text"), (kind == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def repair_report(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """The reports of :func:`repair` with ``repaired_sha256``, one row for each conversation."""
    reports, repaired = repair(turns, gone=gone)
    digests = conversation_digests(repaired).withColumnRenamed("conv_id", "k")
    return reports.join(digests, F.col("conv_id").eqNullSafe(F.col("k"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
