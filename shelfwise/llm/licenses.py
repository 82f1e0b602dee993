"""License notices by patience alignment.

Words that occur once in the text and once in the template are anchors. Their
longest increasing subsequence splits both sides into gaps, which are aligned
the same way; the share of template words that found a partner is the coverage.

* Where to align is exact: a text part that covers a share c of a template of
  n words holds one of any n - ceil(c * n) + 1 of them, so windows around the
  template's longest words suffice.
* Repeated notices leave no word that occurs once. Where a window repeats the word
  it was opened for, or aligns too little, windows of about one template decide.
* One pass over the scan without a shuffle; templates are a parameter of
  bounded size. Windows bound the work on documents of any length.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import texts, with_computed

COVERAGE, DENSITY = 0.8, 0.5
MAX_TEMPLATE_WORDS = 200_000

#: Notices of public licences.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits, in lower case, and of characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def increasing(positions: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    top_at: list[int] = []
    back: list[int] = []
    for i, p in enumerate(positions):
        pile = bisect_left(tops, p)
        tops[pile:pile + 1], top_at[pile:pile + 1] = [p], [i]
        back.append(top_at[pile - 1] if pile else -1)
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Pairs (i, j) with a[i] == b[j], rising on both sides."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            pairs.append((i_end, j_end))
        if i >= i_end or j >= j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {w: k for k, w in enumerate(b[j:j_end], j) if in_b[w] == 1}
        anchors = [(k, place[w]) for k, w in enumerate(a[i:i_end], i) if in_a[w] == 1 and w in place]
        chain = [anchors[k] for k in increasing([y for _, y in anchors])]
        pairs.extend(chain)
        if chain:
            edges = [(i - 1, j - 1), *chain, (i_end, j_end)]
            todo.extend((x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:]))
    return sorted(pairs)


class Template(NamedTuple):
    name: str
    words: list[bytes]
    counts: Counter
    least: int


def prepared(templates: dict[str, list[str]], coverage: float) -> tuple[list[Template], dict[bytes, list[int]]]:
    """The templates, and for each seed word the templates that it may begin."""
    ready, seeds = [], {}
    for name, texts in sorted(templates.items()):
        for text in texts:
            words = words_of(text)
            if not words:
                continue
            least = -int(-coverage * len(words) // 1)  # rounded up
            by_length = sorted(range(len(words)), key=lambda i: (-len(words[i]), i))
            for i in by_length[:len(words) - least + 1]:
                numbers = seeds.setdefault(words[i], [])
                if len(ready) not in numbers:
                    numbers.append(len(ready))
            ready.append(Template(name, words, Counter(words), least))
    return ready, seeds


def _aligned(words: list[bytes], begin: int, end: int, template: Template) -> list[tuple[int, int]]:
    """The alignment of a window, by position in the text, if it is a notice."""
    begin = max(begin, 0)
    pairs = [(begin + i, j) for i, j in align(words[begin:end], template.words)]
    dense = len(pairs) >= template.least and len(pairs) >= DENSITY * (pairs[-1][0] - pairs[0][0] + 1)
    return pairs if dense else []


def _around(words: list[bytes], at: int, least: int, template: Template) -> list[tuple[int, int]]:
    """The best notice in windows of about one template around a word, not before ``least``; the shortest of equal ones."""
    n, best = len(template.words), []
    for j in (j for j, w in enumerate(template.words) if w == words[at]):
        for slack in (0, n // 8, n // 4, n // 2):
            for before, after in {(slack, slack), (slack, 0), (0, slack)}:
                pairs = _aligned(words, max(least, at - j - before), at - j + n + after, template)
                if pairs and pairs[0][0] <= at <= pairs[-1][0]:
                    best = max(best, pairs, key=lambda p: (len(p), p[0][0] - p[-1][0], -p[0][0]) if p else (0, 0, 0))
    return best


def matches_in(words: list[bytes], ready: list[Template], seeds: dict[bytes, list[int]]) -> list[dict]:
    """Notices in a text, by position; of overlapping ones that with the most words, then the best covered."""
    found, done = [], {}
    for at, word in enumerate(words):
        for number in seeds.get(word, ()):
            template = ready[number]
            if at < done.get(number, 0):
                continue
            reach = len(template.words) + len(template.words) // 2 + 4
            begin = max(done.get(number, 0), at - reach)
            counts = Counter(words[begin:at + reach + 1])
            if sum((counts & template.counts).values()) < template.least:
                continue
            pairs = _around(words, at, begin, template) if counts[word] > template.counts[word] else []
            pairs = pairs or _aligned(words, begin, at + reach + 1, template) or _around(words, at, begin, template)
            if not pairs or pairs[0][0] > at:  # one that begins later has a seed of its own
                continue
            start, end = pairs[0][0], pairs[-1][0] + 1
            done[number] = end
            found.append({"license": template.name, "start": start, "end": end, "matched": len(pairs),
                          "coverage": len(pairs) / len(template.words)})
    kept: list[dict] = []  # by start; none overlaps another
    for one in sorted(found, key=lambda m: (-m["matched"], -m["coverage"], m["license"], m["start"])):
        at = bisect_left(kept, one["start"], key=lambda m: m["start"])
        if (at == 0 or kept[at - 1]["end"] <= one["start"]) and (at == len(kept) or one["end"] <= kept[at]["start"]):
            kept.insert(at, one)
    return kept


def license_notices(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    templates: dict[str, list[str]] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, n_words, notices), one row for each row of ``docs``.

    ``notices``: array of (license, start, end, matched, coverage) by position
    in words; ``coverage`` is the matched share of the template. Null and empty
    texts have none; repeated rows are judged alike; no templates give no
    notices. Other columns are not read.
    """
    ready, seeds = prepared(TEMPLATES if templates is None else templates, coverage)
    if sum(len(t.words) for t in ready) > MAX_TEMPLATE_WORDS:
        raise ValueError("templates go to every task; scan a larger set in several calls")

    def arrays(batch: pa.RecordBatch) -> list:
        n_words, notices = [], []
        for one in texts(batch):
            words = words_of(one)
            n_words.append(len(words))
            notices.append(matches_in(words, ready, seeds))
        return [n_words, notices]

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_computed(rows, "n_words bigint, notices array<struct<license:string,start:int,end:int,matched:int,"
                               "coverage:double>>", arrays, drop=["text"])
