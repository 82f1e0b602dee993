"""Quality scores by Naive Bayes support vectors.

A document is the set of its n-grams: words and word pairs, and short runs of
character shapes. An indicator is scaled by the log ratio of its frequencies
in the two classes, rows are brought to unit length, and dual coordinate
descent fits a linear hinge-loss model to them.

* The fit reads a bounded sample of labelled rows (``per_class`` rows and
  ``max_slots`` slots of each class, least hashes first), whatever the size of
  the tables. Features of the sample are computed where the rows are read; one
  task solves the dual.
* The model is one vector of 2**18 weights. Scoring is one pass over the scan
  without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.batches import texts, with_computed
from shelfwise.staging import drop_stage, stage

BITS = 18
#: Labelled rows of each class that the fit reads.
PER_CLASS = 4000
#: Slots of the sample's rows of each class; rows beyond that, by hash, are left out of the fit.
MAX_SLOTS = 10_000_000
#: Bytes of a text whose words or shapes are arrays at a time.
SLICE = 1 << 20
SMOOTHING, COST, EPOCHS, STEEPNESS = 1.0, 1.0, 20, 4.0
#: Runs of shapes: lower-case letters and bytes beyond ASCII are one shape, capitals and digits one each.
SHAPE_RUNS = (1, 2, 3, 4, 6)
_SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
               for b in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_DOWN = np.uint64(64 - BITS)
_GAP = re.compile(rb"[\t-\r ]")
_seen = np.zeros(1 << BITS, bool)


def _slots(codes: np.ndarray, kind: int) -> np.ndarray:
    mixed = (codes + np.uint64(kind)) * _FACTOR
    return ((mixed ^ (mixed >> np.uint64(29))) * _FACTOR) >> _DOWN


def _word_slices(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in parts of about ``SLICE`` bytes; no word is cut."""
    start = 0
    while start < len(raw):
        gap = _GAP.search(raw, start + SLICE)
        end = gap.start() if gap else len(raw)
        yield raw[start:end].split()
        start = end


def features(text: str | None) -> np.ndarray:
    """Sorted slots of the n-grams that occur in the text; none for null and empty texts.

    A text is taken in slices, so memory beyond its bytes and its longest word
    does not grow with it.
    """
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    if not raw.strip():
        return np.empty(0, np.int32)
    own = carried = None  # the last word's code before and after repeated words were merged
    for words in _word_slices(raw):
        if not words:
            continue
        plain = np.array(list(map(zlib.crc32, words)), dtype=np.uint64)
        codes, before = plain.copy(), np.concatenate((plain[:1] + np.uint64(1) if own is None else [own], plain[:-1]))
        codes[plain == before] = 1  # a repeated word is one and the same token
        _seen[_slots(codes, 1)] = True
        chain = codes if carried is None else np.concatenate(([carried], codes))
        _seen[_slots(chain[:-1] * np.uint64(31) + chain[1:] * np.uint64(1 << 32), 2)] = True
        own, carried = plain[-1], codes[-1]
    overlap = max(SHAPE_RUNS) - 1
    for start in range(0, len(raw), SLICE):
        part = raw[max(0, start - overlap):start + SLICE]
        shape = np.frombuffer(part.translate(_SHAPE), np.uint8).astype(np.uint64)
        run = np.zeros(len(shape), np.uint64)
        for length in range(1, min(max(SHAPE_RUNS), len(shape)) + 1):
            run = (run[:len(shape) - length + 1] << np.uint64(8)) | shape[length - 1:]
            if length in SHAPE_RUNS:
                _seen[_slots(run, 16 + length)] = True
    found = np.flatnonzero(_seen)
    _seen[found] = False
    return found.astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of each slot in class 1 and class 0."""
    share = []
    for label in (1, 0):
        counts = np.full(1 << BITS, SMOOTHING)
        for row, own in zip(rows, labels):
            if own == label:
                counts[row] += 1
        share.append(counts / (np.count_nonzero(labels == label) + 2 * SMOOTHING))
    return np.log(share[0] / share[1])


def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of the row's slots: their ratios, brought to unit length."""
    values = ratios[row]
    length = np.sqrt(values @ values)
    return values / length if length else values


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: np.ndarray,
                            epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss support vector machine; the bias is a constant feature of value 1."""
    weights, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    diagonal = np.array([v @ v for v in values]) + 1.0
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in draw.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                largest = max(largest, abs(step))
                alpha[i] = new
        if largest < 1e-4:
            break
    return weights, bias


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"label": batch["label"], "doc_id": batch["doc_id"].astype(str),
                            "slots": [features(t).tobytes() for t in batch["text"]]})


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sample = pd.concat([b for b in batches if len(b)] or [pd.DataFrame({"label": [], "doc_id": [], "slots": []})])
    sample = sample.sort_values("doc_id")
    labels = sample["label"].to_numpy(dtype=int)
    if len(set(labels)) < 2:
        return
    rows = [np.frombuffer(s, np.int32) for s in sample["slots"]]
    ratios = log_count_ratios(rows, labels)
    values = [scaled(row, ratios) for row in rows]
    each = np.array([np.count_nonzero(labels == 0), np.count_nonzero(labels == 1)])
    cost = COST * (len(labels) / 2 / each)[labels]
    weights, bias = dual_coordinate_descent(rows, values, labels, cost)
    yield pd.DataFrame({"ratios": [ratios.astype(np.float32).tobytes()],
                        "weights": [weights.astype(np.float32).tobytes()], "bias": [bias]})


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows of fold 1 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        per_class: int = PER_CLASS, max_slots: int = MAX_SLOTS):
    """(ratios, weights, bias), or None where a class has no labelled row outside fold 1.

    The sample has at most ``per_class`` rows and ``max_slots`` slots of each
    class, least hashes first.

    Labels that contradict each other for one doc_id are left out; null labels
    and ids are not read. A repeated doc_id trains on its least text.
    """
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("y")).where("y in (0, 1) and doc_id is not null")
             .where(fold(F.col("doc_id")) != 1)
             .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y1")).where("y = y1"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    sample = chosen[0].unionByName(chosen[1]).select("doc_id", F.col("y").cast("int").alias("label"))
    read = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .join(F.broadcast(sample), "doc_id")  # at most 2 * per_class ids
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    rows = stage(read.mapInPandas(_extract, "label int, doc_id string, slots binary"), "quality-sample")
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    kept = rows.select("label", "doc_id", F.octet_length("slots").alias("bytes")).withColumn(
        "so_far", F.sum("bytes").over(by_hash.rowsBetween(Window.unboundedPreceding, 0))).where(
        F.col("so_far") <= 4 * max_slots).select("doc_id")
    model = (rows.join(F.broadcast(kept), "doc_id").select("label", "doc_id", "slots")  # at most 2 * per_class ids
             .repartition(1).mapInPandas(_fit, "ratios binary, weights binary, bias double").first())
    drop_stage(rows)
    return model and (np.frombuffer(model["ratios"], np.float32), np.frombuffer(model["weights"], np.float32), model["bias"])


def _scorer(model):
    ratios, weights, bias = model or (None, None, 0.0)

    def score(text: str | None) -> float:
        row, margin = features(text), bias
        if model and len(row):
            r = ratios[row].astype(np.float64)
            margin += (r @ weights[row]) / max(np.sqrt(r @ r), 1e-9)
        return float(1 / (1 + np.exp(-STEEPNESS * margin)))

    return lambda batch: [[score(t) for t in texts(batch)]]


def scored(docs: DataFrame, model, carry: list[Column], text: str = "text") -> DataFrame:
    """The ``carry`` columns of each row and its ``score`` from 0 to 1.

    A text without words scores by the bias alone; without a model all scores
    are 0.5.
    """
    return with_computed(docs.select(*carry, F.col(text).alias("text")), "score double", _scorer(model), drop=["text"])


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    Scores come from the text alone. Null and empty texts are scored; repeated
    rows score alike; a null doc_id is not held out. Other columns are not read.
    """
    model = fit(docs, labels, doc_id, text, **options)
    found = scored(docs, model, [F.col(doc_id).alias("doc_id")], text)
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents whose score is 0.5 or more, with all their columns."""
    model = fit(docs, labels, doc_id, text, **options)
    return scored(docs, model, [F.struct("*").alias("row")], text).where("score >= 0.5").select("row.*")
