"""Near-duplicates by one-permutation hashing.

One hash a shingle fills all bins of a signature: the top bits choose the bin,
the least hash of a bin is its value. Empty bins borrow by optimal
densification: bin j probes h(j, 1), h(j, 2), ... until it meets a bin with a
value. Bands of bins are bucket keys.

* Documents with equal shingle sets become one class first, merged map-side,
  so a group of copies that holds a third of all rows is one node.
* A bucket gives star edges only: every member to the member with the least
  hash. So candidates grow with the rows, and the buckets of a family of edited
  copies, which share nearly all members, agree in few centres.
* The signature drops a pair only when its estimate is five standard
  deviations below the threshold; every link is confirmed on full shingle sets.
* Each document is first checked against its most frequent centre in a quarter
  of the bands, which connects most groups.
* What is left in buckets of several groups is joined exactly. A node becomes its
  difference to the bucket's centre. By the triangle inequality two linked nodes
  of which one is not linked to the centre share a part of their differences, so
  a prefix filter over the rarest elements finds them also in a family whose
  shingles are common to all. Any fixed order will do, so rarity is a sketch.
* Texts move once to be cut to the candidates; every step is a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.batches import texts, with_computed
from shelfwise.operators.components import connected_components
from shelfwise.staging import drop_stage, stage

BINS, ROWS_PER_BAND = 128, 4
#: Bands of the first round, which connects most groups.
FIRST_BANDS = 8
#: Counters of the sketch that orders elements by rarity, and values that a written batch holds.
SLOT_BITS, BATCH_VALUES = 20, 1_000_000
#: Elements before one in which two nodes are looked up, so that a pair with many in common is met about once.
BEFORE = 32
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PROBES = np.random.default_rng(11).integers(0, BINS, (BINS, 4096), dtype=np.int64)
_LOW_BITS = np.uint64(2**57 - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Fewer words than
    ``size`` are one shingle; no words give none.
    """
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, words)), dtype=np.uint64)
    take = min(size, len(words))
    total = np.full(len(words) - take + 1, take, np.uint64)
    for i in range(take):
        total += _mix(hashes[i:len(words) - take + 1 + i] * _ODD[i])
    return np.unique(_mix(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Bin values of a non-empty sorted set of hashes, densified."""
    bins = (hashes >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    values, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], filled[bins[first]] = hashes[first] & _LOW_BITS, True
    todo, attempt = np.flatnonzero(~filled), 0
    while len(todo):
        donors = _PROBES[todo, attempt]
        met = filled[donors]
        values[todo[met]] = values[donors[met]]
        todo, attempt = todo[~met], attempt + 1
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    """One bucket key a band."""
    parts = values.reshape(-1, ROWS_PER_BAND)
    return _mix((parts * _ODD[:ROWS_PER_BAND]).sum(axis=1, dtype=np.uint64) + _ODD[16] * np.arange(len(parts), dtype=np.uint64))


def _describe(size: int):
    def arrays(batch: pa.RecordBatch) -> list:
        n, set_key, bands, sig = [], [], [], []
        for text in texts(batch):
            hashes = shingles(text, size)
            n.append(len(hashes))
            values = signature(hashes) if len(hashes) else None
            set_key.append(None if values is None else xxhash.xxh3_128_digest(hashes.tobytes()))
            bands.append(None if values is None else band_keys(values).view(np.int64))
            sig.append(None if values is None else (values & np.uint64(255)).astype(np.uint8).tobytes())
        return [n, set_key, bands, sig]
    return arrays


def _confirm(size: int, percent: int):
    """Keeps the pairs that are linked on their whole sets; texts are read one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(texts(batch, "u_text"), texts(batch, "v_text")):
                left, right = shingles(a, size), shingles(b, size)
                common = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * common >= percent * (len(left) + len(right) - common))
            yield batch.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))
    return run


def _likely(percent: int):
    """Keeps rows whose signatures agree as a pair at the threshold would, within five standard deviations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal = percent / 100
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
                           for c in ("sig", "c_sig"))
            drawn = np.minimum(BINS, np.minimum(*(batch.column(c).to_numpy() for c in ("n", "c_n"))))
            least = goal - 5 * np.sqrt(goal * (1 - goal) / drawn)
            yield batch.select(["node", "centre", "times"]).filter(pa.array((left == right).mean(axis=1) >= least))
    return run


def _stars(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(u, v, times): every member of a bucket with its centre, where set sizes and signatures allow the threshold.

    The centre is the node with the least hash, so the buckets of a family
    agree in few centres. Sizes and signatures meet distinct pairs only.
    """
    centre = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("c"))
    met = members.join(centre.select("bucket", F.col("c.node").alias("centre")), "bucket").where("node <> centre").groupBy(
        "node", "centre").agg(F.count("*").alias("times"))
    known = classes.select("node", "n", "sig")
    sized = met.join(known, "node").join(known.select(
        F.col("node").alias("centre"), F.col("n").alias("c_n"), F.col("sig").alias("c_sig")), "centre").where(
        F.least("n", "c_n") * 100 >= F.greatest("n", "c_n") * percent)
    likely = sized.select("node", "centre", "times", "n", "sig", "c_n", "c_sig").mapInArrow(
        _likely(percent), "node bigint, centre bigint, times bigint")
    return likely.groupBy(F.least("node", "centre").alias("u"), F.greatest("node", "centre").alias("v")).agg(
        F.sum("times").alias("times"))


def _linked(edges: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    both = (edges.select("u", "v").join(
        bodies.select(F.col("node").alias("u"), F.col("text").alias("u_text")).hint("merge"), "u")
            .join(
            bodies.select(F.col("node").alias("v"), F.col("text").alias("v_text")).hint("merge"), "v"))
    return both.mapInArrow(_confirm(size, percent), "u bigint, v bigint")


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *rows])))


def _slots(centre: int, d: np.ndarray) -> np.ndarray:
    """Counter of the sketch for each element of a difference to the centre."""
    return (_mix(d.view(np.uint64) + _mix(np.array([centre], np.uint64) + _ODD[17])) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _differences(size: int, percent: int):
    """(node, centre, n, c_n, linked, d): the shingles that only one of node and centre has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, begin = batch.select(["node", "centre", "n", "c_n"]), 0
            linked, rows, held = [], [], 0
            for i, (a, b) in enumerate(zip(texts(batch, "u_text"), texts(batch, "v_text"))):
                left, right = shingles(a, size), shingles(b, size)
                rows.append(np.setxor1d(left, right, assume_unique=True).view(np.int64))
                total, apart = len(left) + len(right), len(rows[-1])
                linked.append(100 * (total - apart) >= percent * (total + apart))
                held += apart
                if held >= BATCH_VALUES or i == len(batch) - 1:
                    part = known.slice(begin, len(rows))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(linked, pa.bool_()), _lists(rows)],
                                                     names=[*part.schema.names, "linked", "d"])
                    linked, rows, held, begin = [], [], 0, i + 1
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, times) of the sketch over one partition."""
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in batches:
        for centre, d in zip(batch.column("centre").to_pylist(), batch.column("d")):
            np.add.at(counts, _slots(centre, d.values.to_numpy(zero_copy_only=False)), 1)
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["slot", "times"])


def _excess(n, apart, percent: int):
    """Two nodes are linked if they share at least (excess + excess) / (2 * (100 + percent)) of their differences."""
    return (100 + percent) * apart - (100 - percent) * n


def _prefixes(counts: np.ndarray, percent: int):
    """The rarest elements of each difference, one of which a linked node of another group must have in its own.

    A node that is not linked to the centre has an excess above that of the
    empty set against it (``bar``), a linked one at least ``-bar``. ``short``
    elements serve partners that are not linked to the centre, the further ones
    partners that are; two linked ones are in one group already.
    """
    twice = 2 * (100 + percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, picked, held = 0, [], 0
            fixed = batch.select(["node", "centre", "n", "c_n", "linked", "component"])
            for i, (row, d) in enumerate(zip(fixed.to_pylist(), batch.column("d"))):
                d = d.values.to_numpy(zero_copy_only=False)
                e, bar = _excess(row["n"], len(d), percent), (100 - percent) * row["c_n"]
                farthest = (100 - percent) * (row["n"] + 100 * row["n"] // percent) // (100 + percent) if percent else len(d)
                least = [max(-(-low // twice), len(d) - farthest, 1) for low in (e + bar + 1, e - bar)]
                short, long = (max(0, len(d) - o + 1) for o in least)
                take = short if row["linked"] else max(short, long)
                order = np.lexsort((d, counts[_slots(row["centre"], d)]))[:take]
                picked.append((d[order], len(d) - np.arange(take), np.arange(take) < short, np.full(take, e)))
                held += take
                if held >= BATCH_VALUES or i == len(fixed) - 1:
                    part = pa.Table.from_batches([fixed.slice(begin, len(picked))]).take(
                        pa.array(np.repeat(np.arange(len(picked)), [len(p[0]) for p in picked]))).combine_chunks()
                    for known in part.to_batches():
                        values = [np.concatenate([p[k] for p in picked]) for k in range(4)]
                        yield pa.RecordBatch.from_arrays(
                            [*(known.column(c) for c in ("node", "centre", "n", "linked", "component")), *map(pa.array, values)],
                            names=["node", "centre", "n", "linked", "component", "f", "rest", "short", "e"])
                    begin, picked, held = i + 1, [], 0
    return run


def _confirm_apart(percent: int):
    """Keeps the pairs that are linked, by their whole differences to one centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b, total in zip(batch.column("u_d"), batch.column("v_d"), batch.column("total").to_pylist()):
                a, b = (x.values.to_numpy(zero_copy_only=False) for x in (a, b))
                apart = len(a) + len(b) - 2 * len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * (total - apart) >= percent * (total + apart))
            yield batch.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))
    return run


def _finished(members: DataFrame, sizes: DataFrame, group: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """The groups after all links between nodes that share a bucket.

    Only buckets of several groups matter. Their centre is the node with the
    least hash, so that the buckets of one family agree in few centres.
    """
    centres = members.join(group, "node").groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("c")).where("low <> high").select(
        "bucket", F.col("c.node").alias("centre"))
    open_buckets = members.join(centres, "bucket").where("node <> centre").select("node", "centre").distinct()
    near = stage(open_buckets.join(sizes, "node").join(
        sizes.select(F.col("node").alias("centre"), F.col("n").alias("c_n")), "centre").select("node", "n", "centre", "c_n"),
        "minhash-open")
    both = near.join(bodies.select("node", F.col("text").alias("u_text")).hint("merge"), "node").join(
        bodies.select(F.col("node").alias("centre"), F.col("text").alias("v_text")).hint("merge"), "centre")
    apart = stage(both.mapInArrow(_differences(size, percent),
                                  "node bigint, centre bigint, n bigint, c_n bigint, linked boolean, d array<bigint>"),
                  "minhash-differences")
    drop_stage(near)
    every = apart
    group = stage(_merged(group, apart.where("linked").select(F.col("centre").alias("u"), F.col("node").alias("v"))),
                  "minhash-groups")
    placed = apart.select("node", "centre", "linked").join(group, "node")
    open_ = placed.groupBy("centre").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                         F.bool_and("linked").alias("all")).where("low <> high AND NOT all").select("centre")
    apart = apart.join(open_, "centre", "left_semi")

    counts = np.zeros(1 << SLOT_BITS, np.int64)
    sketch = apart.select("centre", "d").mapInArrow(_counted, "slot bigint, times bigint").groupBy("slot").agg(
        F.sum("times").alias("times")).toArrow()
    counts[sketch.column("slot").to_numpy()] = sketch.column("times").to_numpy()
    rare = stage(apart.join(group, "node").mapInArrow(
        _prefixes(counts, percent), "node bigint, centre bigint, n bigint, linked boolean, component bigint, f bigint, "
                                    "rest bigint, short boolean, e bigint"), "minhash-rare")
    several = rare.groupBy("centre", "f").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("centre", "f")
    before = Window.partitionBy("node", "centre").orderBy(F.desc("rest")).rowsBetween(-BEFORE, -1)
    first, rare = rare, stage(rare.join(several.hint("merge"), ["centre", "f"]).withColumn(
        "before", F.collect_list("f").over(before)), "minhash-rare")
    drop_stage(first)
    a, b = rare.where("NOT linked").alias("a"), rare.alias("b")
    met = a.hint("merge").join(b, F.expr(
        "a.centre = b.centre AND a.f = b.f AND a.component <> b.component"
        " AND (b.linked OR (a.short AND b.short AND a.node < b.node))"
        f" AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {int(percent)}"
        f" AND a.e + b.e <= {2 * (100 + percent)} * least(a.rest, b.rest)"
        # What a pair meets at an element holds at the ones before it, so it has met at one that both have there.
        " AND NOT arrays_overlap(a.before, b.before)"))
    pairs = stage(met.groupBy(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).agg(
        F.min("a.centre").alias("centre"), F.any_value(F.col("a.n") + F.col("b.n")).alias("total")), "minhash-tested")
    links = stage(pairs.join(apart.select(F.col("node").alias("u"), "centre", F.col("d").alias("u_d")).hint("merge"),
                             ["u", "centre"])
                  .join(apart.select(F.col("node").alias("v"), "centre", F.col("d").alias("v_d")).hint("merge"),
                        ["v", "centre"])
                  .mapInArrow(_confirm_apart(percent), "u bigint, v bigint"), "minhash-links")
    for done in (every, rare, pairs):
        drop_stage(done)
    return stage(_merged(group, links), "minhash-groups")


def _key(doc_id: str, text: str) -> F.Column:
    """Non-null key of a document; rows without an id come last."""
    return F.struct(F.col(doc_id).isNull().alias("nameless"), F.col(doc_id).alias("id"),
                    F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash"))


def _with_groups(pairs: DataFrame, group: DataFrame) -> DataFrame:
    return pairs.join(group.select(F.col("node").alias("u"), F.col("component").alias("u_c")), "u").join(
        group.select(F.col("node").alias("v"), F.col("component").alias("v_c")), "v")


def _merged(group: DataFrame, links: DataFrame) -> DataFrame:
    """The groups after more links."""
    edges = _with_groups(links, group).select(F.col("u_c").alias("u"), F.col("v_c").alias("v")).distinct()
    ends = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    roots = connected_components(ends, edges).select(F.col("node").alias("component"), F.col("component").alias("root"))
    return group.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))


def components(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(key, n, set_key) of every row, and (set_key, first): the first document of each set's component."""
    rows = docs.select(_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    described = stage(with_computed(rows, "n bigint, set_key binary, bands array<bigint>, sig binary", _describe(size),
                                    drop=["text"]), "minhash-rows")
    classes = stage(
        described.where("n > 0").groupBy("set_key").agg(
            F.min("key").alias("key"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"),
            F.any_value("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("node"), "set_key", "key", "n", "bands", "sig"), "minhash-classes")
    members = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("bucket").count().where("count > 1").select("bucket")
    members = stage(members.join(shared.hint("merge"), "bucket"), "minhash-buckets")
    nodes = stage(members.select("node").distinct(), "minhash-nodes")
    bodies = stage(rows.join(classes.select("node", "key").join(nodes, "node").hint("merge"), "key")
                   .groupBy("node").agg(F.any_value("text").alias("text")), "minhash-texts")

    edges = _stars(members.where(F.col("band") < FIRST_BANDS), classes, percent)
    by_end = edges.select("u", "v", "times", F.explode(F.array("u", "v")).alias("node"))
    tested = stage(by_end.groupBy("node").agg(F.max(F.struct("times", "u", "v")).alias("e")).select("e.u", "e.v").distinct(),
                   "minhash-tested")
    links = stage(_linked(tested, bodies, size, percent), "minhash-links")
    group = stage(connected_components(nodes, links), "minhash-groups")
    drop_stage(tested)
    drop_stage(links)
    group = _finished(members.select("node", "bucket"), classes.select("node", "n"), group, bodies, size, percent)
    drop_stage(bodies)
    drop_stage(members)
    final = classes.select("node").join(group, "node", "left").select("node", F.coalesce("component", "node").alias("root"))

    named = classes.select("node", "set_key", "key").join(final.select("node", "root"), "node")
    first = named.groupBy("root").agg(F.min("key").alias("first"))
    return described, named.select("set_key", "root").join(first, "root").select("set_key", "first")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                    percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    Two documents are linked when 100 * common >= percent * united over their
    sets of ``size``-word shingles; ``component_id`` is the smallest doc_id
    reachable over links. Null and empty texts have no shingles and are their
    own component. Rows that repeat a doc_id are the same document and are kept
    or not together; null ids come last, so only a component without any id has
    a null one. Other columns are not read.
    """
    described, by_set = components(docs, doc_id, text, size, percent)
    least = F.when(F.col("set_key").isNull(), F.col("key.id")).otherwise(F.col("first.id"))
    return described.select("key", "n", "set_key").join(by_set, "set_key", "left").select(
        F.col("key.id").alias("doc_id"), F.col("n").alias("n_shingles"), least.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                    percent: int = 80) -> DataFrame:
    """The first document of every component, with all its columns.

    Documents without words stay. Rows that repeat both id and text are one
    document, of which one row stays.
    """
    described, by_set = components(docs, doc_id, text, size, percent)
    stays = by_set.select(F.col("first").alias("key")).unionByName(described.where("n = 0").select("key")).distinct()
    rows = docs.select(_key(doc_id, text).alias("key"), F.struct("*").alias("row"))
    return rows.groupBy("key").agg(F.any_value("row").alias("row")).join(stays, "key", "left_semi").select("row.*")
