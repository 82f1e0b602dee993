"""Conversation repair against exhaustive search and plain code."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from shelfwise.llm import turnrepair

SCHEMA = "conv_id long, turn long, role string, text string"
FINE = re.compile("(s?(ua)+)?")


def _cheapest(rows):
    """Least (cost, audit) and repaired lines by best-first search over edits of rows (role, text, fault)."""
    queue, seen = [(0, "", 0, "", ())], {}
    while queue:
        cost, audit, at, initials, lines = heapq.heappop(queue)
        state = (at, initials[:1] + initials[-1:] + str(len(initials) > 1), )
        if at == len(rows) and FINE.fullmatch(initials):
            return cost, audit, lines
        if seen.get(state, (cost, audit)) < (cost, audit):
            continue
        seen[state] = (cost, audit)
        for role in ("user", "assistant"):
            if initials + role[0] == "u" or (initials + role[0])[-2:] in ("su", "ua", "au"):
                heapq.heappush(queue, (cost + 5, audit + "I", at, initials + role[0], (*lines, f"{role}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, initials, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for name, edit, price in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                    new = initials + name[:1]
                    if name[:1] and (new in ("s", "u") or new[-2:] in ("su", "ua", "au")) and (new[-1] != "s" or len(new) == 1):
                        heapq.heappush(queue, (cost + price + more, audit + edit, at + 1, new, (*lines, f"{name}:{text}")))
    raise AssertionError


def _plain_report(rows):
    """The contract, read plainly, for the rows (turn, role, text) of one conversation after damage."""
    rows = sorted([(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows], key=lambda r: (
        r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    judged, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "sound"
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    faults = [f for _, _, f in judged]
    cost, audit, lines = _cheapest(judged)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _got(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def test_cells_hold_the_least_cost_and_audit_whatever_the_split():
    draw = random.Random(2)
    for _ in range(150):
        rows = [(draw.choice("suax"), draw.randrange(4)) for _ in range(draw.randint(0, 7))]
        span = turnrepair.Span()
        for initial, fault in rows:
            span.add(initial, fault, None)
        name = ["sound", "blank", "duplicate", "truncated"]
        got = span.report()
        want = _cheapest([(r, "", name[f]) for r, f in rows])
        assert (got["cost"], got["audit"]) == want[:2]
        # Full interval table over all splits gives the same cell.
        if rows:
            table = {(i, i + 1): turnrepair.row_cell(*rows[i]) for i in range(len(rows))}
            for width in range(2, len(rows) + 1):
                for i in range(len(rows) - width + 1):
                    table[i, i + width] = turnrepair._least(
                        x for k in range(i + 1, i + width) for x in turnrepair.joined(table[i, k], table[k, i + width]).items())
            assert table[0, len(rows)] == span.cell()


@pytest.mark.parametrize("partitions", [1, 23])
def test_reports_equal_exhaustive_search(spark, partitions):
    draw = random.Random(partitions)
    texts = ["ok.", "ok.", "Why?", "no end", "", " \n", "x" * 70 + "a.", "x" * 70 + "b.", "wow! \t", None]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    by_conv = {c: [(draw.choice([None, 0, 1, 2, 3, 7, 9]), draw.choice(roles), draw.choice(texts)) for _ in range(draw.randint(1, 8))]
               for c in [*range(40), None]}
    rows = [(c, *r) for c, own in by_conv.items() for r in own]
    draw.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = _got(turnrepair.repair_report(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {c: _plain_report(own) for c, own in by_conv.items()}


def test_one_long_conversation_is_spread_over_tasks(spark):
    draw = random.Random(9)
    rows = [(1, i // 3, draw.choice(["user", "assistant"]), draw.choice(["a.", "b", ""]) + str(i)) for i in range(3000)]
    reports, repaired = turnrepair.repair(spark.createDataFrame(rows, SCHEMA).repartition(5))
    report = reports.first()
    span = turnrepair.Span()
    for _, turn, role, text in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        span.add(role[0], turnrepair.TRUNCATED, turn)
    assert (report.cost, report.audit) == (span.report()["cost"], span.report()["audit"])
    lines = [r for r in repaired.orderBy("place").collect() if r.edit]
    assert FINE.fullmatch("".join(r.role[0] for r in lines)) and [r.place for r in lines] == list(range(len(lines)))


def test_damage_and_odd_tables(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}. Done!") for c in range(60) for t in range(4)]
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (200, 5, "user", "y" * 300_000 + "."), (200, 6, "assistant", "z.")]
    frame = spark.createDataFrame([(*r, "x", True) for r in rows], SCHEMA + ", audit string, gone boolean")
    got = _got(turnrepair.repair_report(turnrepair.damaged(frame), gone="gone"))
    want = {}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        own = want.setdefault(c, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert got == {c: _plain_report(own) for c, own in want.items()}
    gone = spark.createDataFrame([(1, 0, "user", "a.", True)], SCHEMA + ", gone boolean")
    assert _got(turnrepair.repair_report(gone, gone="gone")) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert turnrepair.repair_report(frame.limit(0)).count() == 0


def test_repeated_rows_and_extreme_turns(spark):
    rows = [(1, 2, "user", "a.")] * 500 + [(2, -2**63, "user", "q?"), (2, 2**63 - 1, "assistant", "r.")]
    got = _got(turnrepair.repair_report(spark.createDataFrame(rows, SCHEMA)))
    # 499 duplicates have to go; to delete the first row too is cheaper than to answer it.
    assert got[1][:7] == (0, 0, 499, 0, 499, 1000, "D" * 500)
    assert got[2][0] == 2**63 - 1 and got[2][5:7] == (0, "KK")
