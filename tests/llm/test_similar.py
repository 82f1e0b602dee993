"""Near-duplicates and repeated lines against plain Python."""

import random

import numpy as np

from shelfwise.llm import linedup, minhash

SCHEMA = "doc_id long, text string, component_id string, kept int"


def _texts(draw, n):
    words = ["w%d" % i for i in range(400)]
    out = []
    for _ in range(n):
        base = draw.choices(words, k=draw.choice([1, 3, 5, 20, 60]))
        for _ in range(draw.choice([1, 1, 3])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2])):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            out.append(" ".join(copy))
    return out


def _sets(texts, size):
    return [set(minhash.shingles(t, size).tolist()) for t in texts]


def _plain_components(ids, sets, percent):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [least[find(i)] for i in range(len(ids))]


def test_components_match_all_pairs(spark):
    draw = random.Random(9)
    texts = _texts(draw, 60) + ["", None, " \n", "Same words", "same WORDS", "a b c", "a b d"]
    ids = draw.sample(range(1000), len(texts))
    for size in (4, 5):
        want = _plain_components(ids, _sets(texts, size), 80)
        docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], SCHEMA)
        out = {r.doc_id: r for r in minhash.near_duplicates(docs, size=size).collect()}
        assert [out[i].component_id for i in ids] == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in out.values())
        assert [out[i].n_shingles for i in ids] == [len(s) for s in _sets(texts, size)]
        kept = minhash.representatives(docs, size=size)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, w in zip(ids, want) if i == w)


def _family(draw, n):
    """Copies of one text with nine edits each, which link to none, and two with four edits, which link to each other.

    What a linked pair shares here is common to the family, so they meet in no small bucket.
    """
    base = ["b%d" % i for i in range(400)]

    def edited(times, places):
        out = list(base)
        for k in draw.sample(places, times):
            out[k] = "x%d" % draw.randrange(10**9)
        return " ".join(out)

    copies = [edited(9, range(400)) for _ in range(n)]
    copies[n // 3], copies[n // 2] = (edited(4, range(start, 400, 12)) for start in (0, 6))
    return copies


def _family_components(ids, texts):
    """Components of all pairs, with the common shingles counted by a product of matrices."""
    sets = _sets(texts, 5)
    seen = {}
    for s in sets:
        for x in s:
            seen[x] = seen.get(x, 0) + 1
    place = {x: k for k, x in enumerate(x for x in seen if seen[x] > 1)}
    has = np.zeros((len(sets), len(place)), np.float32)
    for i, s in enumerate(sets):
        has[i, [place[x] for x in s if x in place]] = 1
    common, n = (has @ has.T).astype(np.int64), np.array([len(s) for s in sets])
    edges = np.argwhere(np.triu(100 * common >= 80 * (n[:, None] + n[None] - common), 1))
    least = dict(zip(range(len(ids)), ids))
    for _ in range(len(ids)):
        was = dict(least)
        for u, v in edges:
            least[u] = least[v] = min(least[u], least[v])
        if was == least:
            break
    return [least[i] for i in range(len(ids))], len(edges)


def test_lone_links_inside_a_large_family_are_found(spark):
    draw = random.Random(21)
    texts = _family(draw, 1500)
    ids = draw.sample(range(10**6), len(texts))
    want, n = _family_components(ids, texts)
    assert 1 <= n < 100
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert [out[i] for i in ids] == want


def test_pipeline_keeps_one_text_of_a_lone_link_in_a_family(spark):
    import corpus_pipeline

    draw = random.Random(22)
    texts = _family(draw, 1200)
    ids = draw.sample(range(10**6), len(texts))
    want, n = _family_components(ids, texts)
    assert n >= 1
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == sorted(set(want))


def test_rows_without_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"),
                                  (None, None), (None, "z"), (8, "")], "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert out == sorted([(None, 2, 7, False)] * 2 + [(7, 2, 7, True)] * 2 + [(None, 0, None, True), (None, 1, None, True),
                                                                                (8, 0, 8, True)], key=repr)
    assert sorted((r.doc_id, r.text) for r in minhash.representatives(docs).collect() if r.doc_id) == [(7, "a b c d e f"), (8, "")]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_signatures_estimate_similarity_and_bands_meet():
    draw, met = np.random.default_rng(1), 0
    for n in (3, 10, 50, 500) * 25:
        a = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64))
        b = a[: int(np.ceil(0.8 * len(a)))]
        left, right = minhash.signature(a), minhash.signature(b)
        met += bool((minhash.band_keys(left) == minhash.band_keys(right)).any())
        share = len(b) / len(a)
        assert (left == right).mean() >= share - 5 * np.sqrt(0.16 / min(minhash.BINS, n))
    assert met == 100


def test_words_and_short_texts():
    assert len(minhash.shingles("a b", 4)) == 1 and len(minhash.shingles("a b c d e", 4)) == 2
    assert list(minhash.shingles("A\u00a0b", 1)) == list(minhash.shingles("a\u00a0B", 1))  # no break at U+00A0
    assert list(minhash.shingles("a b", 4)) != list(minhash.shingles("a b", 1)) and len(minhash.shingles("\v\f", 2)) == 0


def _line(k, n):
    return " ".join(f"l{k}w{i}" for i in range(n))


def test_repeated_runs_are_found_and_short_ones_stay(spark):
    a, b, c, d = (_line(k, 25) for k in range(4))
    long = _line(9, 60)
    docs = [
        (1, "\n".join([_line(20, 5), a, b, "", c, _line(21, 5)])),
        (2, "\n".join([_line(22, 7), a, b, "", c, _line(23, 9)])),  # 75 words again
        (3, "\n".join([_line(24, 30), a, _line(25, 30)])),          # 25 words again: stays
        (4, "\n".join([long, _line(26, 3), long])),                 # twice in one text
        (5, long), (6, long), (7, None), (8, ""), (8, ""), (9, "\n\n\n"), (10, d + "\n" + a + "\n" + b),
    ]
    frame = spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in docs], "doc_id long, text string, removed string, n_chars long")
    out = {r.doc_id: r for r in linedup.line_report(frame).collect()}
    assert {i: r.removed for i, r in out.items() if r.removed} == {2: "1-4", 4: "2-2", 5: "0-0", 6: "0-0", 10: "1-2"}
    assert out[7].n_lines == 0 and out[7].text_sha256 is None and out[9].n_lines == 4 and out[2].n_removed == 4
    clean = linedup.clean_documents(frame)
    assert clean.columns == frame.columns
    left = {r.doc_id: r for r in clean.collect()}
    assert set(left) == {1, 2, 3, 4, 7, 8, 9, 10}
    assert left[2].text == _line(22, 7) + "\n" + _line(23, 9) and left[2].n_chars == len(left[2].text)
    assert left[4].text == long + "\n" + _line(26, 3) and left[10].text == d
    assert linedup.line_report(frame.limit(0)).count() == 0


def test_every_long_repetition_is_deleted(spark):
    """Guarantee: where 50 words of whole lines occur earlier, something is deleted; deleted lines have an earlier equal."""
    draw = random.Random(4)
    lines = [_line(k, draw.choice([1, 2, 5, 11, 30])) for k in range(14)]
    docs = [(i, [draw.choice(lines) for _ in range(draw.randint(1, 30))]) for i in range(40)]
    frame = spark.createDataFrame([(i, "\n".join(t)) for i, t in docs], "doc_id long, text string")
    gone = {i: {p for s in filter(None, r.split(",")) for p in range(int(s.split("-")[0]), int(s.split("-")[1]) + 1)}
            for i, r in linedup.line_report(frame).select("doc_id", "removed").collect()}
    seen_runs, seen_lines = set(), set()
    for i, text in docs:
        for p, line in enumerate(text):
            if p in gone[i]:
                assert line in seen_lines
            n, run = 0, []
            for q in range(p, len(text)):
                n, run = n + len(text[q].split()), run + [text[q]]
                if n >= 50:
                    if tuple(run) in seen_runs:
                        assert gone[i] & set(range(p, q + 1))
                    seen_runs.add(tuple(run))
                    break
            seen_lines.add(line)


def test_runs_go_on_to_the_first_difference_and_blank_lines_are_no_words(spark):
    long, end = _line(1, 60), _line(2, 5)
    few = [f"one{k}" for k in range(32)]
    docs = [(1, "\n".join([long, *[""] * 100, end])), (2, "\n".join([long, *[""] * 100, end])),
            (3, "\n".join([*[""] * 300, end, long, *[" "] * 200, end])),       # other blank lines: one line is the same
            (4, "\n" * 205), (5, "\n" * 205), (6, "\n".join(few)), (7, "\n".join(few)),
            (8, "\n".join([_line(3, 9), *[""] * 150, _line(4, 9), "", _line(5, 33)])),
            (9, "\n".join(["x", _line(3, 9), *[""] * 150, _line(4, 9), "", _line(5, 33), "y"]))]  # 51 words, a long gap
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r.removed for r in linedup.line_report(frame).collect()}
    assert out == {1: "", 2: "0-101", 3: "301-301", 4: "", 5: "", 6: "", 7: "", 8: "", 9: "1-154"}


def _whole_runs(docs):
    """Lines that lie in a run of at least 50 words which occurs earlier, whole to the first difference; by trying all pairs."""
    gone = {i: set() for i, _ in docs}
    for n, (i, text) in enumerate(docs):
        for other in docs[:n + 1]:
            for shift in range(-len(other[1]), len(text)):
                if other[0] == i and shift <= 0:
                    continue
                run = []
                for p in [*range(len(text)), None]:
                    if p is not None and 0 <= p - shift < len(other[1]) and text[p] == other[1][p - shift]:
                        run.append(p)
                        continue
                    if sum(len(text[q].split()) for q in run) >= 50:
                        gone[i] |= set(run)
                    run = []
    return gone


def test_whole_runs_of_distinct_passages(spark):
    """Where a passage has one earlier place, all of its run goes, as trying all pairs of places finds it."""
    draw = random.Random(12)
    docs, passages = [], [[_line(100 * k + j, draw.choice([0, 0, 2, 9, 14])) for j in range(draw.randint(8, 90))] for k in range(6)]
    for i in range(12):
        text = []
        for k in draw.sample(range(6), 2) if i < 3 else [draw.randrange(6)]:
            text += [_line(10_000 + 100 * i + k, 3)] + (passages[k] if i else [x for p in passages for x in [*p, _line(20_000, 1)]])
        docs.append((i, text))
    frame = spark.createDataFrame([(i, "\n".join(t)) for i, t in docs], "doc_id long, text string")
    got = {i: {p for s in filter(None, r.split(",")) for p in range(int(s.split("-")[0]), int(s.split("-")[1]) + 1)}
           for i, r in linedup.line_report(frame).select("doc_id", "removed").collect()}
    want = _whole_runs(docs)
    assert sum(map(len, want.values())) > 200
    # Documents after the first, where every passage has its first place.
    assert {i: g for i, g in got.items() if i} == {i: w for i, w in want.items() if i}


def _removed(frame):
    return {r.doc_id: r.removed for r in linedup.line_report(frame).select("doc_id", "removed").collect()}


def _join_rows(plan):
    """Most rows that a join of an executed plan made."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _join_rows(plan.executedPlan())
    below = [plan.plan()] if kind.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().apply("numOutputRows").value() if "Join" in kind else 0
    return max([own, *map(_join_rows, below)])


def test_a_text_that_repeats_itself_costs_rows_by_its_length(spark, monkeypatch):
    """Every line but the first few starts a run that goes on to the end of the text: one row a run, not one a line of each."""
    made, plain = [], linedup.stage

    def measured(df, name):
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        made.append(_join_rows(execution.executedPlan()))
        return plain(df, name)

    monkeypatch.setattr(linedup, "stage", measured)
    n = 600
    docs = [(1, "\n".join([_line(1, 12)] * n)), (2, "\n".join([_line(2, 20), _line(3, 20), ""] * (n // 3)))]
    assert _removed(spark.createDataFrame(docs, "doc_id long, text string")) == {1: "1-599", 2: "3-599"}
    assert n < max(made) <= 4 * len(docs) * n  # two ends of a run for each line


def test_runs_go_on_over_blocks_of_blocks(spark, monkeypatch):
    """Runs that end anywhere between the lengths of blocks, at either side and at a text's end."""
    draw, docs = random.Random(7), []
    monkeypatch.setattr(linedup, "REACH", 4)
    for k, n in enumerate([3, 4, 5, 15, 16, 17, 63, 64, 65, 81, 150]):
        left, right = ([f"d{k}{s}{i}" for i in range(n)] for s in "lr")
        core, cut = [_line(1000 + k, 60)], draw.randrange(1, n)
        docs += [(3 * k, ["a", *left, *core, *right, "b"]), (3 * k + 1, ["c", *left, *core, *right]),
                 (3 * k + 2, [*left[cut:], *core, *right[:cut], "e"])]
    want = {i: {2: f"0-{len(t) - 2}", 1: f"1-{len(t) - 1}", 0: ""}[i % 3] for i, t in docs}
    assert _removed(spark.createDataFrame([(i, "\n".join(t)) for i, t in docs], "doc_id long, text string")) == want


def test_rows_without_ids_lose_what_others_have(spark):
    long = _line(1, 60)
    frame = spark.createDataFrame([(None, long), (None, long), (3, long), (3, long)], "doc_id long, text string")
    out = sorted(((r.doc_id, r.removed) for r in linedup.line_report(frame).collect()), key=repr)
    assert out == [(3, ""), (3, ""), (None, "0-0"), (None, "0-0")]


def test_a_pair_is_made_about_once_by_the_exact_join(spark, monkeypatch):
    """Nodes of a cut family have many elements in common; the join makes their pairs, not one row an element."""
    made, plain = [], minhash.stage

    def measured(df, name):
        out = plain(df, name)
        if name == "minhash-tested" and "total" in out.columns:
            execution = df._jdf.queryExecution()
            execution.toRdd().count()
            made.append((_join_rows(execution.executedPlan()), out.count()))
        return out

    monkeypatch.setattr(minhash, "stage", measured)
    texts = _family(random.Random(3), 600)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    want, _ = _family_components(list(range(len(texts))), texts)
    assert [got[i] for i in range(len(texts))] == list(want)
    [(rows, pairs)] = made
    assert 0 < rows <= 1.8 * pairs  # a pair may have several centres
