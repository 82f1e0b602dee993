"""Every registered query against its SQL twin, and the pipeline against plain Python."""

import re

import pytest

import corpus_pipeline
from check_oracle import oracle, rows_of
from shelfwise.llm import decontaminate, minhash, quality
from shelfwise.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, name):
    got = QUERIES[name](spark, folder).toPandas()
    if name in ORACLE:
        want = oracle(folder).execute(ORACLE[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
    assert len(got)


def test_one_query_an_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "pieces"]


def test_stages(spark, folder):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    frames = [docs]
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, frames[-1], folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        frames.append(spark.createDataFrame(out.collect(), docs.schema))
    raw, good, lines, unique, clean = [{r.doc_id: r for r in f.collect()} for f in frames]

    scores = {r.doc_id: r.predicted for r in quality.quality_scores(docs, labels).collect()}
    assert set(good) == {i for i in raw if scores[i]} and all(good[i] == raw[i] for i in good)

    seen = set()
    for i in sorted(good):
        old, new = good[i].text.split("\n"), lines[i].text.split("\n") if i in lines else []
        rest = iter(new)
        kept = next(rest, None)
        for line in old:
            if line == kept:
                kept = next(rest, None)
            else:
                assert line in seen
            seen.add(line)
        assert kept is None
    assert all(lines[i].n_chars == len(lines[i].text) for i in lines)

    sets = {i: set(minhash.shingles(lines[i].text, 5).tolist()) for i in lines}
    ids = sorted(lines)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(unique) == {i for i in ids if find(i) == i}

    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        windows |= decontaminate.windows_of(decontaminate.words_of(r.text), 10)
    size = {len(w) for w in windows}

    def leaks(text):
        w = decontaminate.words_of(text)
        return any(tuple(w[k:k + n]) in windows for n in size for k in range(len(w) - n + 1))

    assert set(clean) == {i for i in unique if not leaks(unique[i].text)}
    final = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in final.select("doc_id").collect()} == set(clean)
    assert final.where("NOT round_trip").count() == 0
