"""Secrets in texts and in what their texts wrap.

Strict patterns give the base spans of a text, which always stay. A worklist
then unwraps layers until nothing new comes: lines with URL, Unicode or entity
escapes, base64 runs (also wrapped over lines) that hold text, and base64 runs
that hold zlib, gzip, bzip2 or xz streams, however nested. Every layer is scanned
like the text, and its spans are mapped back through all layers to code points
of the text: to the very characters for escapes and base64, to the whole
wrapped run for compressed layers.

* All patterns are ASCII and never cross a line end, so an escaped line is a
  layer of its own and other characters above ASCII need no exact value.
* An escape that decodes to the beginning of another one is followed at once,
  so chains of escaped escapes take one pass.
* A layer whose bytes equal those of a layer around it is not entered again
  (a stream that unpacks to itself).
* Layers are taken from a stack: only those on one path are held at a time.
  A stream that unpacks to more than ``max_layer`` bytes stays wrapped, as
  memory has to be bounded; its run is scanned as it stands.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import texts, with_computed

KINDS = ["assign", "access", "hex"]
ASSIGN, ACCESS, HEX = range(3)
MAX_LAYER = 1 << 26
#: The least zlib stream has 9 bytes, 12 characters of base64; no shorter run can wrap a finding.
LEAST_RUN = 12

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("[0-9a-f]{16,}")
_ESCAPE = re.compile(
    r"%([0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_LONGEST_ESCAPE = 10
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{60,80}\r?\n)+[A-Za-z0-9+/]*={0,2}|[A-Za-z0-9+/_-]{12,}={0,2}")
_SEPARATED = re.compile("[A-Za-z0-9]{12,}={0,2}")
_CONTROL = re.compile(rb"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")

Span = tuple[int, int]
Locate = Callable[[int, int], Span]


def base_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, leftmost and without overlaps in each kind."""
    for m in _ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= 12:
            yield ASSIGN, *m.span()
    if "AKIA" in text:
        yield from ((ACCESS, *m.span()) for m in _ACCESS.finditer(text))
    yield from ((HEX, *m.span()) for m in _HEX.finditer(text))


def _character(found: re.Match) -> str:
    groups = found.groups()
    decimal = groups[-1]
    code = int(decimal) if decimal else int(next(g for g in groups if g), 16)
    return chr(code) if code < 0x80 else "\ufffd"


def unescaped(text: str, start: int, end: int) -> tuple[str, array, array, array]:
    """The line ``text[start:end]`` decoded, and for each decoded character its place and the source's start and end."""
    out, places, starts, ends, length, at = [], array("q"), array("q"), array("q"), 0, start
    while found := _ESCAPE.search(text, at, end):
        out.append(text[at:found.start()])
        length += len(out[-1])
        char, stop = _character(found), found.end()
        while char in "%\\&":
            more = _ESCAPE.match(char + text[stop:min(end, stop + _LONGEST_ESCAPE)])
            if not more:
                break
            char, stop = _character(more), stop + more.end() - 1
        places.append(length)
        starts.append(found.start())
        ends.append(stop)
        out.append(char)
        length += 1
        at = stop
    out.append(text[at:end])
    return "".join(out), places, starts, ends


def _escaped_lines(text: str) -> Iterator[tuple[str, Locate, array]]:
    """Every line with escapes, decoded, with the mapping back and the places of decoded characters."""
    at = 0
    while found := _ESCAPE.search(text, at):
        start = text.rfind("\n", 0, found.start()) + 1
        end = text.find("\n", found.end())
        end = len(text) if end < 0 else end
        line, places, starts, ends = unescaped(text, start, end)

        def source(place: int, start=start, places=places, starts=starts, ends=ends) -> Span:
            k = bisect_right(places, place) - 1
            if k < 0:
                return start + place, start + place + 1
            if places[k] == place:
                return starts[k], ends[k]
            literal = ends[k] + place - places[k] - 1
            return literal, literal + 1

        yield line, lambda a, b, source=source: (source(a)[0], source(b - 1)[1]), places
        at = end


def _unpacked(data: bytes, limit: int) -> tuple[str, bytes] | None:
    """Format and content of a compressed stream; nothing for other data, broken streams and those beyond the limit."""
    if data[:3] == b"\x1f\x8b\x08":
        name, stream = "gzip", zlib.decompressobj(31)
    elif len(data) > 8 and data[0] == 0x78 and not (data[0] * 256 + data[1]) % 31 and not data[1] & 0x20:
        name, stream = "zlib", zlib.decompressobj()
    elif data[:3] == b"BZh":
        name, stream = "bzip2", bz2.BZ2Decompressor()
    elif data[:6] == b"\xfd7zXZ\x00":
        name, stream = "xz", lzma.LZMADecompressor(memlimit=limit)
    else:
        return None
    try:
        content = stream.decompress(data, limit)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return None
    return (name, content) if stream.eof else None


def _is_text(data: bytes) -> bool:
    if len(data) < LEAST_RUN or _CONTROL.search(data):
        return False
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _decoded(run: str) -> bytes | None:
    """Bytes of a base64 run in either alphabet, padded or not."""
    body = run.rstrip("=")
    if len(body) % 4 == 1:
        return None
    if "-" in body or "_" in body:
        body = body.replace("-", "+").replace("_", "/")
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


def _base64_runs(text: str) -> Iterator[tuple[str, Locate]]:
    """Candidate runs with the mapping of their characters; parts between separators are candidates of their own."""
    for found in _BASE64.finditer(text):
        run, start = found.group(), found.start()
        if "\n" in run:
            kept = [i for i, c in enumerate(run) if c not in "\r\n"]
            yield "".join([run[i] for i in kept]), lambda a, b, kept=kept, start=start: (start + kept[a], start + kept[b - 1] + 1)
            continue
        if not (("+" in run or "/" in run) and ("-" in run or "_" in run)):
            yield run, lambda a, b, start=start: (start + a, start + b)
        if not run.rstrip("=").isalnum():
            for part in _SEPARATED.finditer(run):
                yield part.group(), lambda a, b, start=start + part.start(): (start + a, start + b)


def _layers(text: str, fresh: array | None, limit: int) -> Iterator[tuple[str, array | None, str, Locate]]:
    """(way, fresh places, text, mapping) of what this layer wraps.

    ``fresh`` are the places of characters that an escape gave; runs without
    any, inside or beside them, were unwrapped in the layer around it already.
    """
    for line, locate, places in _escaped_lines(text):
        yield "escape", places, line, locate
    for run, locate in _base64_runs(text):
        if fresh is not None:
            a, b = locate(0, len(run))
            if bisect_right(fresh, b) == bisect_right(fresh, a - 2):
                continue
        data = _decoded(run)
        if data is None:
            continue
        ways, seen = "base64", set()
        packed = _unpacked(data, limit)
        whole = packed is not None
        while packed is not None and (digest := hashlib.sha256(data).digest()) not in seen:
            seen.add(digest)
            ways, data = f"{ways}/{packed[0]}", packed[1]
            packed = _unpacked(data, limit)
        if packed is None and _is_text(data):
            last = len(run.rstrip("="))
            inside = (lambda a, b, locate=locate, last=last: locate(0, last)) if whole else (
                lambda a, b, locate=locate: locate(8 * a // 6, (8 * b - 1) // 6 + 1))
            yield ways, None, data.decode("latin-1"), inside


def found_in(text: str | None, limit: int = MAX_LAYER) -> list[dict]:
    """Base spans and those of all layers that no span of their kind contains, by start and kind."""
    if not text:
        return []
    base = set(base_spans(text))
    added: dict[tuple[int, int, int], str] = {}
    work = [(text, None, "", lambda a, b: (a, b), ())]
    while work:
        layer, fresh, ways, locate, around = work.pop()
        if ways:
            for kind, a, b in base_spans(layer):
                span = (kind, *locate(a, b))
                if span not in base:
                    added.setdefault(span, ways)
        trail = around
        if ways:
            digest = hashlib.sha256(layer.encode("utf-8", "surrogatepass")).digest()
            if digest in around:
                continue
            trail = (*around, digest)
        for way, places, inner, inside in _layers(layer, fresh, limit):
            outer = locate
            work.append((inner, places, f"{ways}/{way}" if ways else way,
                         lambda a, b, inside=inside, outer=outer: outer(*inside(a, b)), trail))
    spans, reach = [], [(-1, -1)] * len(KINDS)
    every = [(kind, a, b, "") for kind, a, b in base] + [(*span, ways) for span, ways in added.items()]
    for kind, a, b, ways in sorted(every, key=lambda s: (s[1], -s[2], s[0], s[3])):
        if ways and b <= reach[kind][1]:
            continue
        reach[kind] = max(reach[kind], (a, b), key=lambda r: r[1])
        spans.append({"kind": kind, "start": a, "end": b, "base": not ways, "layers": ways})
    return sorted(spans, key=lambda s: (s["start"], s["kind"], s["end"]))


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_layer: int = MAX_LAYER) -> DataFrame:
    """(doc_id, found), one row for each row of ``docs``; ``found`` has (kind, start, end, base, layers) by start and kind.

    Places are code points of the original text, end exclusive; ``layers`` is
    the way to an added span, such as ``escape/base64/gzip``. An added span
    lies in no other span of its kind. Null and empty texts have no spans;
    repeated rows are judged alike, an empty table gives an empty result, and
    other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_computed(
        rows, "found array<struct<kind:int,start:int,end:int,base:boolean,layers:string>>",
        lambda batch: [[found_in(t, max_layer) for t in texts(batch)]], drop=["text"])


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added): counts and digest of base spans, and all spans.

    Handles what :func:`secrets` handles, with the same results.
    """
    found = secrets(docs, doc_id, text)
    base = F.filter("found", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")

    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"),
                        (F.size("found") - F.size(base)).cast("bigint").alias("n_added"))
