"""Personal data by weak supervision.

Strict patterns give the base spans, which always stay. Wider patterns give
candidates. Regex, gazetteer and context labelers vote on every span;
expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is, and its posteriors train the span classifier that
decides on the candidates.

* One pass over the scan finds, votes and describes; what is written per
  document are its spans. Both models see all spans of all documents, as counts
  of vote and feature codes, whose number is bounded by the code space.
* Every pattern runs in linear time on hostile texts: it starts at a run's
  begin only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import texts, with_computed
from shelfwise.staging import stage

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
YES, NO, SILENT = 1, 0, 2
N_LABELERS = 5

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Candidates: an address spelt out, four dotted numbers, long digit runs, and grouped digits without a plus.
_AT = (" at ", "(at)", "[at]")
_SPELT = re.compile(r" ?[A-Za-z0-9-]{1,63}+(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}+){1,8}")
_WIDE_CARD = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9])++(?![0-9A-Za-z])")
_WIDE_IP = re.compile(r"(?<![0-9A-Za-z.])[0-9]++(?:\.[0-9]++){3}(?![0-9A-Za-z])")
_DIGIT = re.compile("[0-9]")
_WIDE_PHONE = re.compile(r"(?<![0-9A-Za-z])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])")

#: Word lists of the gazetteer and context labelers.
DOMAINS_ = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "it", "nl", "ch", "at"}
CALLING = ("1", "33", "34", "39", "41", "43", "44", "49", "31", "32", "52", "54", "55", "61", "81", "86", "91", "7")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "62", "22", "23", "24", "25", "26", "27")
RESERVED = ("0.", "127.", "255.", "224.")
CUES = {"mail", "email", "contact", "write", "phone", "call", "tel", "mobile", "fax", "card", "visa", "pay", "ip",
        "address", "host", "server", "correo", "telefono", "llame", "telefon", "anrufen", "karte", "carte", "appelez"}
DENIALS = {"version", "release", "isbn", "issn", "page", "order", "section", "chapter", "figure", "token", "password",
           "hash", "commit", "serial", "number", "lot"}
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the address pattern: what precedes an ``@`` is its whole run."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = []
    if not text:
        return out
    out += [(EMAIL, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [(IP, *m.span()) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((CARD, *m.span()))
    out += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def wide_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Candidates of each kind, base spans among them."""
    for sign in _AT:
        at = text.find(sign)
        while at >= 0:
            end = at - (text[at - 1:at] == " ")
            start = end
            while start > max(0, end - 64) and _LOCAL.match(text, start - 1):
                start -= 1
            found = _SPELT.match(text, at + len(sign)) if start < end else None
            if found:
                yield EMAIL, start, found.end()
            at = text.find(sign, at + 1)
    if not _DIGIT.search(text):
        return
    yield from ((IP, *m.span()) for m in _WIDE_IP.finditer(text))
    for m in _WIDE_CARD.finditer(text):
        if 13 <= len(_digits(m.group())) <= 19:
            yield CARD, *m.span()
    yield from ((PHONE, *m.span()) for m in _WIDE_PHONE.finditer(text))


def plausible(kind: int, span: str, digits: str) -> bool:
    """Check digits, number ranges and lengths of the kind."""
    if kind == IP:
        return _octets(span)
    if kind == CARD:
        return luhn(digits)
    return kind == EMAIL or 8 <= len(digits) <= 15 and len(set(digits)) > 2


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> list[int]:
    """One vote a labeler: strict pattern, check digits and ranges, gazetteer, context words, neighbours."""
    span, digits = text[start:end], _digits(text[start:end])
    words = _WORD.findall(text[max(0, start - 40):start].lower())[-4:]
    near = text[start - 1:start] + text[end:end + 1]
    valid = plausible(kind, span, digits)
    listed = {EMAIL: lambda: re.split(r"[^A-Za-z]+", span)[-1].lower() in DOMAINS_, IP: lambda: not span.startswith(RESERVED),
              CARD: lambda: digits.startswith(ISSUERS), PHONE: lambda: digits.startswith(CALLING)}[kind]()
    cue, denial = any(w in CUES for w in words), any(w in DENIALS for w in words)
    return [YES if strict else SILENT,
            YES if valid else NO,
            YES if listed else SILENT if kind in (EMAIL, PHONE) else NO,
            SILENT if cue == denial else YES if cue else NO,
            NO if any(c.isalnum() or c in "_=\"'#$/" for c in near) else SILENT]


FEATURES = [("kind", 4), ("digits", 8), ("separator", 5), ("left", 5), ("right", 5), ("words", 3), ("valid", 2)]


def describe(text: str, kind: int, start: int, end: int) -> int:
    """The span's features as one code; the code space has 24,000 values."""
    span, digits = text[start:end], _digits(text[start:end])
    words = _WORD.findall(text[max(0, start - 40):start].lower())[-4:]

    def side(c: str) -> int:
        return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4

    separator = 0 if span.isalnum() else 1 if " " in span else 2 if "-" in span else 3 if "." in span else 4
    values = [kind, min(7, len(digits) // 3), separator, side(text[start - 1:start]), side(text[end:end + 1]),
              1 if any(w in CUES for w in words) else 2 if any(w in DENIALS for w in words) else 0,
              int(plausible(kind, span, digits))]
    code = 0
    for value, (_, size) in zip(values, FEATURES):
        code = code * size + value
    return code


def found_in(text: str | None) -> list[dict]:
    """Base spans and the candidates that overlap none, with votes and features."""
    base = base_spans(text)
    if not text:
        return []
    strict, taken, extra, at = set(base), sorted((a, b) for _, a, b in base), [], 0
    for kind, a, b in sorted(set(wide_spans(text)) - strict, key=lambda s: (s[1], s[0])):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if not any(s < b and e > a for s, e in taken[at:at + 4]):
            extra.append((kind, a, b))
    out = []
    for kind, a, b in base + extra:
        code = 0
        for vote in votes(text, kind, a, b, (kind, a, b) in strict):
            code = code * 3 + vote
        out.append({"kind": kind, "start": a, "end": b, "base": (kind, a, b) in strict, "votes": code,
                    "features": describe(text, kind, a, b)})
    return out


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation over vote patterns (rows of YES, NO, SILENT) and their counts.

    Gives the probability of personal data for each pattern, the prior, and
    P(vote | class) as an array (labeler, class, vote). Starts from the majority.
    """
    yes, no = (patterns == YES).sum(1), (patterns == NO).sum(1)
    posterior = (yes + 0.5) / (yes + no + 1.0)
    for _ in range(rounds):
        prior = float((posterior @ counts + 1) / (counts.sum() + 2))
        table = np.empty((patterns.shape[1], 2, 3))
        for vote in range(3):
            said = patterns == vote
            table[:, 1, vote] = said.T @ (posterior * counts) + 0.5
            table[:, 0, vote] = said.T @ ((1 - posterior) * counts) + 0.5
        table /= table.sum(2, keepdims=True)
        log = np.log([1 - prior, prior])[None, :] + sum(np.log(table[i, :, patterns[:, i]]) for i in range(patterns.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - posterior).max() < 1e-9:
            return new, prior, table
        posterior = new
    return posterior, prior, table


def _one_hot(codes: np.ndarray) -> np.ndarray:
    columns, rest = [], codes.copy()
    for _, size in reversed(FEATURES):
        columns.append(np.eye(size)[rest % size])
        rest = rest // size
    return np.hstack([*columns, np.ones((len(codes), 1))])


def train(codes: np.ndarray, targets: np.ndarray, counts: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression of the posteriors on the span features, by Newton steps."""
    x = _one_hot(codes)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (counts * (p - targets)) + penalty * weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def accepted_codes(counted: pd.DataFrame) -> list[int]:
    """Feature codes that the trained classifier takes for personal data; implausible spans never are.

    ``counted``: votes, features and their number of spans n.
    """
    if not len(counted):
        return []
    kinds = counted["features"].to_numpy() // (np.prod([s for _, s in FEATURES[1:]]))
    target = np.zeros(len(counted))
    for kind in np.unique(kinds):
        own = np.flatnonzero(kinds == kind)
        codes = counted["votes"].to_numpy()[own]
        patterns = np.stack([codes // 3 ** (N_LABELERS - 1 - i) % 3 for i in range(N_LABELERS)], axis=1)
        target[own], _, _ = reliabilities(patterns, counted["n"].to_numpy(dtype=float)[own])
    features, n = counted["features"].to_numpy(), counted["n"].to_numpy(dtype=float)
    weights = train(features, target, n)
    each = np.unique(features)
    return [int(c) for c in each[(_one_hot(each) @ weights >= 0) & (each % 2 == 1)]]


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), one row for each row of ``docs``.

    Counts and digest are of the base spans; ``spans`` lists these and the
    added ones as ``kind:start:end`` by kind and start, in code points. An added
    span overlaps no base span. Null and empty texts have no spans. Repeated
    rows are judged alike; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stage(with_computed(
        rows, "spans array<struct<kind:int,start:int,end:int,base:boolean,votes:int,features:int>>",
        lambda batch: [[found_in(t) for t in texts(batch)]], drop=["text"]), "pii-spans")
    counted = found.select(F.explode("spans").alias("s")).groupBy("s.votes", "s.features").agg(F.count("*").alias("n"))
    accepted = accepted_codes(counted.toPandas())  # at most 3**5 votes by 24,000 features, in practice hundreds
    base = F.filter("spans", lambda s: s["base"])
    final = F.filter("spans", lambda s: s["base"] | s["features"].isin(accepted)) if accepted else base

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")

    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(final).alias("spans"),
                        (F.size(final) - F.size(base)).cast("bigint").alias("n_added"))
