"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of the benchmark items. Patterns of equal length
share one table set: the shift table tells for a block of two words how far
the search may jump, the suffix bucket of a block with shift zero selects the
patterns that end in it, the prefix block thins them out, and a direct
comparison of all words confirms an occurrence.

* Documents are searched where they are read: no shuffle, no partition state.
* The benchmark is split by item into blocks of bounded bytes, and each block
  is one pass; between two passes the rows are written out. So any benchmark
  works, and what driver and workers hold stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import texts, with_computed
from shelfwise.staging import drop_stage, stage

WINDOW = 10
#: Bytes of item text whose tables a worker holds at a time.
BLOCK_BYTES = 16_000_000
#: ASCII letters and digits in lower case and all bytes beyond ASCII stay; the rest separates words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """All runs of ``size`` words; a shorter item that has words is one run."""
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


class WuManber:
    """Shift table and buckets for patterns of one length, over words as symbols."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key, far = pattern[end - self.block:end], length - end
                if far < self.shift.get(key, self.jump):
                    self.shift[key] = far
            self.buckets.setdefault(pattern[-self.block:], {}).setdefault(pattern[:self.block], []).append(
                (pattern, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(start, item ids) of every occurrence, from left to right."""
        n, block, length, jump = len(words), self.block, self.length, self.jump
        shift, end = self.shift.get, length
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            far = shift(key, jump)
            if far:
                end += far
                continue
            start = end - length
            for pattern, items in self.buckets[key].get(tuple(words[start:start + block]), ()):
                if tuple(words[start:end]) == pattern:
                    yield start, items
            end += 1


def tables_of(items: list[tuple[str, str]], size: int) -> list[WuManber]:
    by_length: dict[int, dict[tuple, list[str]]] = {}
    for item_id, text in items:
        for window in windows_of(words_of(text), size):
            by_length.setdefault(len(window), {}).setdefault(window, []).append(item_id)
    return [WuManber(patterns, length) for length, patterns in sorted(by_length.items())]


def hits_in(words: list[bytes], tables: list[WuManber]) -> tuple[list[list[int]], set[str]]:
    """Merged word ranges inside occurrences, and the ids of the items found."""
    ranges, items = [], set()
    for table in tables:
        for start, ids in table.search(words):
            ranges.append((start, start + table.length))
            items.update(ids)
    return merged(ranges), items


def merged(ranges) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _search_block(items: list[tuple[str, str]], size: int):
    """A pass over rows (row struct, text, spans, items) that adds what one block of items finds."""
    tables: list[WuManber] = []

    def arrays(batch: pa.RecordBatch) -> list:
        if not tables:
            tables.extend(tables_of(items, size))
        n_words, spans, ids = [], [], []
        for text, old_spans, old_ids in zip(texts(batch), batch.column("spans"), batch.column("items")):
            words = words_of(text)
            ranges, found = hits_in(words, tables)
            n_words.append(len(words))
            spans.append(merged([*map(tuple, old_spans.as_py()), *map(tuple, ranges)]))
            ids.append(sorted({*old_ids.as_py(), *(i for i in found if i is not None)}))
        return [n_words, spans, ids]

    return arrays


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """Items with a text, in blocks of about ``block_bytes`` bytes, chosen by a hash; the driver holds one at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    for number in range(count):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == number) if count > 1 else items
        yield [tuple(r) for r in block.collect()]


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
              item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, n_words, spans, items): each row of ``docs`` as a struct with what was found in it.

    ``spans`` are merged word ranges [start, end) inside occurrences of a
    window; ``items`` the ids, as sorted strings, of items with a window that
    occurs. Null and empty texts have no words and no hits. Items without words
    are no items; words inside windows of items without an id are hit, but such
    items are not listed; rows that repeat an item_id are one item. All columns
    of ``docs`` stay inside ``row``, so names cannot clash. With several blocks
    the rows are written out after each, so a worker holds one block's tables
    and the plan does not grow.
    """
    found = docs.select(
        F.struct("*").alias("row"), F.col(text).alias("text"), F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<array<int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    staged = None
    for number, block in enumerate(item_blocks(benchmark, item_id, item_text, block_bytes)):
        if number:
            before, staged = staged, stage(found, "benchmark-block")
            found = staged
            if before is not None:
                drop_stage(before)
        found = with_computed(found, "n_words bigint, spans array<array<int>>, items array<string>",
                              _search_block(block, size))
    return found.drop("text")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of ``docs``.

    The digest is of the item ids sorted as strings and joined by commas, so of
    the empty string where nothing was found.
    """
    found = find_hits(docs.select(doc_id, options.get("text", "text")), benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return found.select(
        F.col(f"row.{doc_id}").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with all their columns."""
    return find_hits(docs, benchmark, **options).where(F.size("spans") == 0).select("row.*")
