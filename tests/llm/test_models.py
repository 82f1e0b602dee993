"""Classifier, span labelling, piece lattice, licence alignment and chat rendering."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import chat, licenses, pieces, pii, quality
from shelfwise.llm.queries import PIECES

# --- quality ----------------------------------------------------------------


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = quality.quality_scores(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id").toPandas()
    held = out[out.held_out]
    assert ((held.score >= 0) & (held.score <= 1)).all() and (held.predicted == (held.score >= 0.5)).all()
    assert set(out.doc_id[out.held_out]) == {i for i in out.doc_id if zlib.crc32(str(i).encode()) % 3 == 1}
    good = held.quality == 1
    assert held.predicted[good].mean() > 0.99 and held.predicted[~good].mean() < 0.05


def test_scores_of_odd_rows_and_without_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (1, "", 0.1), (None, "a b", 0.1), (3, "x " * 200_000, 0.1)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    out = quality.quality_scores(docs, none).collect()
    assert len(out) == 4 and all(r.score == 0.5 and r.predicted == 1 for r in out)
    assert quality.quality_scores(docs.limit(0), none).count() == 0
    kept = quality.accepted_documents(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4


def test_contradicting_and_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "bad bad bad") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(i, 1) for i in range(0, 60, 2)], "doc_id long, quality int")
    assert quality.fit(docs, labels) is None  # every row of class 0 is contradicted
    ok = labels.limit(60)
    lie = ok.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit(docs, ok), quality.fit(docs, lie)
    assert all(np.array_equal(a, b) for a, b in zip(one, two))


def plain_slots(text):
    """Slots by definition, with whole numbers and one n-gram at a time."""
    def slot(code, kind):
        mixed = (code + kind) % 2**64 * 0x9E3779B97F4A7C15 % 2**64
        return ((mixed ^ (mixed >> 29)) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - quality.BITS)

    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return []
    codes = [1 if i and w == words[i - 1] else zlib.crc32(w) for i, w in enumerate(words)]
    found = {slot(c, 1) for c in codes} | {slot((a * 31 + b * 2**32) % 2**64, 2) for a, b in zip(codes, codes[1:])}
    shapes = [97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in raw]
    for length in (1, 2, 3, 4, 6):
        for i in range(len(shapes) - length + 1):
            found.add(slot(int.from_bytes(bytes(shapes[i:i + length]), "big"), 16 + length))
    return sorted(found)


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_features_by_definition_in_slices_of_any_size(monkeypatch, size):
    monkeypatch.setattr(quality, "SLICE", size)
    draw = random.Random(size)
    texts = ["".join(draw.choice(["a", "bb", " ", "\u00e9", "\n", "  ", "X9", "ab ab ab ", "\x85", "\x1c", "\t"])
                     for _ in range(draw.randrange(40))) for _ in range(150)]
    for text in [None, "", " ", "a", *texts]:
        assert quality.features(text).tolist() == plain_slots(text), repr(text)


def test_ratios_and_scores_by_definition(spark):
    draw = random.Random(4)
    words = {0: ["buy", "NOW", "!!!", "99", "the"], 1: ["the", "river", "ran", "past", "old"]}
    rows = [(i, " ".join(draw.choice(words[i % 2]) for _ in range(6)), i % 2) for i in range(90)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, "the the 99"), (1001, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    ratios, weights, bias = quality.fit(docs, labels)
    seen = [(plain_slots(t), y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    sizes = [sum(y == c for _, y in seen) for c in (0, 1)]
    for slot in {s for slots, _ in seen for s in slots}:
        n = [sum(slot in slots for slots, y in seen if y == c) for c in (0, 1)]
        assert ratios[slot] == pytest.approx(np.log(((n[1] + 1) / (sizes[1] + 2)) / ((n[0] + 1) / (sizes[0] + 2))), rel=1e-6, abs=1e-7)
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    for i, text in [*((i, t) for i, t, _ in rows), (1000, "the the 99"), (1001, None)]:
        own = [float(ratios[s]) for s in plain_slots(text)]
        length = sum(r * r for r in own) ** 0.5
        margin = bias + (sum(r * float(weights[s]) for r, s in zip(own, plain_slots(text))) / length if own else 0.0)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-4 * margin)), abs=1e-6)


def test_sample_is_bounded_in_slots(spark):
    docs = spark.createDataFrame([(i, f"word{i} " + ("good" if i % 2 else "BAD!")) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert quality.fit(docs, labels, max_slots=1) is None
    all_rows, same = quality.fit(docs, labels), quality.fit(docs, labels, max_slots=60 * 200)
    fewer = quality.fit(docs, labels, max_slots=200)
    assert np.array_equal(all_rows[0], same[0]) and 0 < np.count_nonzero(fewer[1]) < np.count_nonzero(all_rows[1])


def test_dual_coordinate_descent_closes_the_duality_gap():
    draw = np.random.default_rng(0)
    rows = [np.sort(draw.choice(30, 6, replace=False)).astype(np.int32) for _ in range(80)]
    values = [draw.normal(size=6) for _ in rows]
    labels = draw.integers(0, 2, 80)
    cost = np.full(80, 0.7)
    w, b = quality.dual_coordinate_descent(rows, values, labels, cost, epochs=2000)
    sign = np.where(labels == 1, 1, -1)
    margins = np.array([w[r] @ v + b for r, v in zip(rows, values)]) * sign
    primal = 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - margins)).sum()
    for _ in range(200):  # no direction lowers the primal objective
        dw, db = np.zeros_like(w), draw.normal() * 1e-3
        dw[:30] = draw.normal(size=30) * 1e-3
        m = np.array([(w + dw)[r] @ v + b + db for r, v in zip(rows, values)]) * sign
        assert 0.5 * ((w + dw) @ (w + dw) + (b + db) ** 2) + (cost * np.maximum(0, 1 - m)).sum() >= primal - 1e-6


# --- pieces -----------------------------------------------------------------


def _toy():
    texts = ["<unk>", "▁", "a", "b", "ab", "▁a", "▁ab", "ba", "aba", "bb", "▁▁"] + [f"<0x{b:02X}>" for b in range(256)]
    scores = [0, -9, -4, -5, -6, -7, -8, -6, -11, -12, -3] + [0] * 256
    return pieces.Vocabulary(texts, scores, [False] + [True] * 10 + [False] * 256, list(range(11, 267)))


def _all_paths(segmenter, chunk):
    into = {}
    for start, end, score, ids in segmenter.edges(chunk):
        into.setdefault(end, []).append((start, score, ids))

    def paths(end):
        if end == 0:
            return [(0, ())]
        return [(s + score, (*p, *ids)) for start, score, ids in into.get(end, []) for s, p in paths(start)]

    return sorted(paths(len(chunk)), key=lambda x: -x[0])


def test_n_best_matches_all_segmentations():
    vocabulary = _toy()
    draw = random.Random(2)
    for n in (1, 3, 6):
        segmenter = pieces.Segmenter(vocabulary, n)
        for _ in range(150):
            text = "".join(draw.choices("ab  \néx", k=draw.randint(1, 9)))
            ids, score, best = segmenter.encode(text)
            chunk = pieces.SPACE + text.replace(" ", pieces.SPACE)
            want = _all_paths(segmenter, chunk)
            assert [b["score"] for b in best] == [s for s, _ in want[:n]]
            options = {p for _, p in want}
            got = [tuple(pieces.apply_edits(ids.tolist(), b["edits"])) for b in best]
            assert len(set(got)) == len(got) and set(got) <= options and best[0] == {"score": score, "edits": []}
            assert segmenter.decode(ids.tolist()) == text


def test_words_solved_together_as_alone():
    segmenter = pieces.Segmenter(pieces.load_vocabulary(PIECES))
    words = ["▁hello", "▁theé", "x", "▁", "▁" + "ab" * 20, "漢", "▁▁▁", "▁1234", "▁" + "ab" * 40, "𝄞a"]
    words += ["▁" + w for w in "the quick brown fox jumps over lazy dogs 12345 naïve".split()]
    solved = segmenter.solve(words)
    together = {w: (solved.ids[a:a + n].astype(np.int32).tobytes(), score, gap) for w, a, n, score, gap in zip(
        words, solved.start.tolist(), solved.count.tolist(), solved.score.tolist(), solved.gap.tolist())}
    assert {w: segmenter.search(w) for w in words} == together
    for w in words:
        best = segmenter.n_best(w, 2)
        assert best[0][0] == together[w][1] and (len(best) < 2 or best[0][0] - best[1][0] == together[w][2])


def test_remembered_words_are_bounded():
    table = pieces.Remembered(4)
    for i in range(100):
        table.put(str(i), i + 1)
        table.put("often", 7)
        assert len(table.young) + len(table.old) <= 5 and table.get("often") == 7


def test_round_trip_and_columns(spark):
    texts = ["Hello  world\n", "", None, " ", "漢字 ☃ \u0000", "a" * 3000, "tab\t é", "x ▁ y", "\n\n"]
    docs = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)] + [(None, "a", [1])], "doc_id long, text string, ids array<int>")
    out = pieces.encode(docs, PIECES)
    back = {r.doc_id: r for r in pieces.decode(out, PIECES).collect()}
    for i, t in enumerate(texts):
        assert back[i].round_trip == ("▁" not in (t or "")) and back[i].n_pieces == len(back[i].ids)
        assert back[i].text == (t or "").replace("▁", " ")
        assert [b.score for b in back[i].nbest] == sorted((b.score for b in back[i].nbest), reverse=True)
    assert back[2].ids == [] and len(back) == 10 and pieces.encode(docs.limit(0), PIECES).count() == 0


# --- personal data ----------------------------------------------------------


def _plain_base(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_match_the_patterns():
    draw = random.Random(6)
    bits = ["@", "a", ".", "-", "+", "1", "9", "25", "4111111111111111", "1.2.3.4", " ", "(", ")", "%", "é", "x@y.z", "\n"]
    for _ in range(20_000):
        t = "".join(draw.choices(bits, k=draw.randint(1, 25)))
        assert pii.base_spans(t) == _plain_base(t), t


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_em_finds_the_reliable_labelers():
    draw = np.random.default_rng(8)
    truth = draw.random(20_000) < 0.3
    right = [0.95, 0.9, 0.85, 0.55]
    said = np.stack([np.where(draw.random(len(truth)) < p, truth, ~truth).astype(int) for p in right], axis=1)
    said[draw.random(said.shape) < 0.2] = pii.SILENT
    patterns, counts = np.unique(said, axis=0, return_counts=True)
    posterior, prior, table = pii.reliabilities(patterns, counts.astype(float))
    assert abs(prior - 0.3) < 0.03
    spoken = table[:, 1, pii.YES] / (table[:, 1, pii.YES] + table[:, 1, pii.NO])
    assert np.abs(spoken - right).max() < 0.05
    where = {tuple(p): q for p, q in zip(patterns, posterior)}
    assert np.mean([(where[tuple(s)] > 0.5) == t for s, t in zip(said, truth)]) > 0.93


def test_personal_data_rows(spark):
    rows = [(1, "é mail a.b@c.de, call +1 (555) 123-4567 now", 3), (2, None, 3), (3, "", 3), (3, "", 3),
            (4, "ip 10.0.0.256 and 8.8.8.8", 3), (None, "card 4111 1111 1111 1111.", 3), (5, "1" * 100_000, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_ip int")
    out = {r.doc_id: r for r in pii.personal_data(frame).collect()}
    assert (out[1].n_email, out[1].n_phone, out[1].spans.startswith("email:7:15,")) == (1, 1, True)
    assert "phone:22:39" in out[1].spans.split(",") and "ip:18:25" in out[4].spans.split(",")
    assert out[4].n_ip == 1 and out[None].n_card == 1 and out[2].spans == out[3].spans == out[5].spans == ""
    for doc, text, _ in rows:
        names = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text)]
        digest = spark.range(1).select(F.sha2(F.lit(",".join(names)), 256)).first()[0]
        r = out[doc]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in pii.base_spans(text)) for k in range(4)]
        assert out[doc].base_sha256 == digest and set(names) <= set(out[doc].spans.split(",")) | {""}
    assert pii.personal_data(frame.limit(0)).count() == 0


def test_candidates_beside_base_spans():
    text = "write to jane at mail dot org or call 555-123-4567 please"
    kinds = [(pii.KINDS[s["kind"]], text[s["start"]:s["end"]], s["base"]) for s in pii.found_in(text)]
    assert kinds == [("email", "jane at mail dot org", False), ("phone", "555-123-4567", False)]


# --- licences ---------------------------------------------------------------


def test_longest_increasing_subsequence():
    draw = random.Random(1)
    for _ in range(200):
        p = [draw.randint(0, 9) for _ in range(draw.randint(0, 9))]
        got = [p[i] for i in licenses.increasing(p)]
        best = max((len(c) for n in range(len(p) + 1) for c in itertools.combinations(p, n)
                    if all(x < y for x, y in zip(c, c[1:]))), default=0)
        assert len(got) == best and all(x < y for x, y in zip(got, got[1:]))


def test_alignment_pairs_rise_and_agree():
    draw = random.Random(2)
    for _ in range(300):
        a, b = draw.choices("abcdef", k=draw.randint(0, 12)), draw.choices("abcdef", k=draw.randint(0, 12))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < i2 and j < j2 for (i, j), (i2, j2) in zip(pairs, pairs[1:]))
    assert len(licenses.align(list("xabcdy"), list("abcd"))) == 4


def test_notices(spark):
    mit = licenses.TEMPLATES["MIT"][1]
    worn = mit.replace("free of charge, ", "").replace("merge, publish", "merge and publish")
    rows = [(1, "x y\nLicensed under CC BY-NC 4.0. z"), (2, "Licensed under CC BY 4.0"), (3, "word " * 500 + worn + " tail" * 500),
            (4, None), (5, ""), (5, "the license of software is free"), (6, "Released under the MIT License. " * 3),
            (None, "This work is licensed under the GNU General Public License, version 3.")]
    out = licenses.license_notices(spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_words int")).collect()
    got = sorted((r.doc_id or 0, [(n.license, n.start) for n in r.notices]) for r in out)
    assert got == [(0, [("GPL-3.0", 0)]), (1, [("CC-BY-NC-4.0", 2)]), (2, [("CC-BY-4.0", 0)]), (3, [("MIT", 500)]), (4, []),
                   (5, []), (5, []), (6, [("MIT", 0), ("MIT", 5), ("MIT", 10)])]
    assert licenses.license_notices(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_notices_between_other_text():
    ready, seeds = licenses.prepared(licenses.TEMPLATES, licenses.COVERAGE)

    def starts(text):
        return [(m["license"], m["start"]) for m in licenses.matches_in(licenses.words_of(text), ready, seeds)]

    mit = licenses.TEMPLATES["MIT"][1]
    n, cc = len(licenses.words_of(mit)), "Licensed under CC BY 4.0.\n"
    step = len(licenses.words_of(cc))
    for times in (1, 2, 3, 7):
        for tail in ("", "foo bar baz"):
            assert starts("x y z\n" + cc * times + tail) == [("CC-BY-4.0", 3 + step * k) for k in range(times)]
            assert starts("x y z " + (mit + "\n") * times + tail) == [("MIT", 3 + n * k) for k in range(times)]
    worn = mit.replace("free of charge, ", "").replace("merge, publish", "merge and publish")
    assert starts("x y z " + worn + " and " + mit + " " + worn + " q r") == [("MIT", 3), ("MIT", 2 + n), ("MIT", 2 + 2 * n)]


# --- chat -------------------------------------------------------------------

TURNS = "pair_id long, turn int, role string, text string, prompt string"


def _turns(spark, rows):
    return spark.createDataFrame([(*r, "-") for r in rows], TURNS)


def test_preference_pairs(spark):
    both = [(1, 0, "system", "be <|end|> kind"), (1, 1, "user", "hi")]
    chosen = _turns(spark, both + [(1, 2, "assistant", "héllo"), (1, 3, "user", "and?"), (1, 4, "assistant", "")]
                    + [(2, 0, "user", "a"), (3, 0, "user", None), (None, 0, None, "n"), (5, 0, "user", "q"), (5, 0, "user", "q")])
    rejected = _turns(spark, both + [(1, 2, "assistant", "no")] + [(2, 0, "user", "a"), (4, 0, "assistant", "only"),
                                                                    (5, 0, "user", "q"), (5, 0, "user", "q")])
    out = {r.pair_id: r for r in chat.preference_rows(chosen, rejected).collect()}
    assert set(out) == {1, 2, 3, 4, 5, None}
    one = out[1]
    assert one.n_prefix == 2 and one.prompt == "<|system|>\nbe < |end|> kind<|end|>\n<|user|>\nhi<|end|>\n"
    assert one.chosen == "<|assistant|>\nhéllo<|end|>\n<|user|>\nand?<|end|>\n<|assistant|>\n<|end|>\n"
    assert [one.chosen[m.start:m.end] for m in one.chosen_mask] == ["héllo<|end|>", "<|end|>"]
    assert [one.rejected[m.start:m.end] for m in one.rejected_mask] == ["no<|end|>"]
    assert (out[2].n_prefix, out[2].chosen, out[2].rejected, out[2].chosen_mask) == (1, "", "", [])
    assert out[3].rejected == "" and out[3].chosen == "<|user|>\n<|end|>\n" and out[4].chosen == "" and out[4].n_prefix == 0
    assert out[5].n_prefix == 2 and out[None].chosen == "<||>\nn<|end|>\n"
    assert chat.preference_rows(chosen.limit(0), rejected.limit(0)).count() == 0


def test_stale_replies(spark):
    turns = _turns(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"),
                           (1, 4, "user", "e"), (2, 0, "assistant", "x"), (3, 0, "user", "y")])
    out = sorted((r.pair_id, r.turn, r.text) for r in chat.with_stale_reply(turns, "pair_id").collect())
    assert out == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, "b"), (1, 4, "e"), (2, 0, ""), (3, 0, "y")]


@pytest.mark.parametrize("n", [3000])
def test_a_conversation_of_many_turns(spark, n):
    turns = _turns(spark, [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(n)])
    out = chat.preference_rows(turns, chat.with_stale_reply(turns, "pair_id")).first()
    assert out.n_prefix == n - 1 and out.rejected == f"<|assistant|>\nt{n - 3}<|end|>\n"
