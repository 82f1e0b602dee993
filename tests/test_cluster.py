import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfwise.operators import cluster, components, density, hierarchy, kdtree, lloyd
from shelfwise.plans import catalogue
from shelfwise.staging import stage


def frame(spark, x):
    rows = [(str(i), [float(v) for v in p]) for i, p in enumerate(x)]
    return stage(spark.createDataFrame(rows, "product_id string, x array<double>").select(
        "product_id", array_to_vector("x").alias("features")))


def labels_of(df, name):
    rows = df.select(F.col("product_id").cast("int").alias("i"), name).orderBy("i").collect()
    return np.array([r[name] for r in rows])


def brute_dbscan(x, eps, m):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core, label, c = near.sum(1) >= m, np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack, label[i] = [i], c
            while stack:
                for b in np.flatnonzero(near[stack.pop()] & core & (label < 0)):
                    label[b] = c
                    stack.append(b)
            c += 1
    for i in np.flatnonzero(~core):
        reach = label[near[i] & core]
        label[i] = reach.min() if len(reach) else -1
    return label


def blobs(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(c, s, (n, 2)) for c, s, n in
             (((0, 0), .05, 150), ((.5, .1), .05, 80), ((.25, .05), .08, 25), ((3, 3), .02, 60))]
    return np.round(np.vstack([*parts, rng.uniform(-1, 4, (40, 2)), np.tile([[2.0, 2.0]], (30, 1))]), 4)


@pytest.mark.parametrize("leaf", [64, 2])
def test_dbscan_matches_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(density, "LEAF", leaf)
    x = blobs(leaf)
    got = labels_of(density.dbscan(frame(spark, x), 0.12, 6), "dbscan_label")
    want = brute_dbscan(x, 0.12, 6)
    assert (got == want).all() and len(set(want)) > 3


def test_dbscan_decides_dense_blocks_by_their_boxes(spark, monkeypatch):
    monkeypatch.setattr(density, "LEAF", 16)
    x = blobs(7)
    got = labels_of(density.dbscan(frame(spark, x), 0.4, 12), "dbscan_label")
    assert (got == brute_dbscan(x, 0.4, 12)).all() and len(set(got)) > 1


def test_dbscan_of_nothing_and_of_null_features(spark):
    none = stage(spark.createDataFrame([("1", None), ("2", None)], "product_id string, x array<double>").select(
        "product_id", F.when(F.col("x").isNotNull(), array_to_vector("x")).alias("features")))
    assert [r.dbscan_label for r in density.dbscan(none).collect()] == [density.NOISE] * 2
    assert density.dbscan(none.where("false")).count() == 0


def test_dbscan_all_noise(spark):
    x = np.arange(20, dtype=float).reshape(10, 2)
    assert set(labels_of(density.dbscan(frame(spark, x), 0.3, 5), "dbscan_label")) == {-1}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 240)]
    parent = list(range(300))

    def root(a):
        return a if parent[a] == a else root(parent[a])

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    nodes = spark.range(300).select(F.col("id").alias("node"))
    got = components.connected_components(nodes, spark.createDataFrame(edges, "u long, v long"))
    assert {r.node: r.component for r in got.collect()} == {a: root(a) for a in range(300)}


def naive_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        def cost(p):
            a, b = x[groups[p[0]]], x[groups[p[1]]]
            return len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()
        i, j = min(((i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))), key=cost)
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


def partition(labels):
    return {frozenset(np.flatnonzero(labels == c)) for c in set(labels)}


def test_ward_on_few_points_is_plain_ward(spark):
    x = np.random.default_rng(5).normal(size=(40, 3))
    got = labels_of(hierarchy.ward(frame(spark, x), 4), "hc_label")
    assert partition(got) == naive_ward(x, 4)


@pytest.mark.parametrize("dims,k,finish", [(4, 13, 30)])
def test_ward_in_rounds_is_plain_ward(spark, dims, k, finish):
    rng = np.random.default_rng(dims)
    # Two far points are each other's nearest at once: their merge is one of the dearest, though of the first round.
    x = np.vstack([rng.normal(c, .3, (30, dims)) for c in (0, 1, 4)] + [np.full((1, dims), 90.), np.full((1, dims), 99.)])
    x = np.vstack([x, x[:7]])
    got = labels_of(hierarchy.ward(frame(spark, x), k, finish=finish, leaf=32), "hc_label")
    distinct, back = np.unique(x, axis=0, return_inverse=True)
    # Plain Ward merges equal rows first, at no cost.
    assert partition(got) == naive_ward(x, k) and sorted(set(got)) == list(range(k)) and len(distinct) == 92
    assert (np.bincount(got)[:-1] >= np.bincount(got)[1:]).all()


def test_ward_of_more_clusters_than_points(spark):
    got = labels_of(hierarchy.ward(frame(spark, [[1.0], [2.0], [1.0]]), 5), "hc_label")
    assert got[0] == got[2] != got[1]


def test_split_blocks_are_small_disjoint_boxes(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(300, 3)), np.tile([[1.0, 2.0, 3.0]], (40, 1)), np.round(rng.normal(size=(100, 3)))])
    points = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, x array<double>")
    blocks = {}
    split = stage(kdtree.split(points, 3, 32))
    for r in split.collect():
        blocks.setdefault(r.block, []).append(r.id)
    assert sorted(i for own in blocks.values() for i in own) == list(range(len(x)))
    assert all(len(own) <= 32 or len({tuple(x[i]) for i in own}) == 1 for own in blocks.values())
    pairs = kdtree.near_pairs(
        kdtree.packed(split, ["id"], 3), 3, kdtree.gap2("a_", "b_", 3) <= 0.25, {}).collect()
    near = {(r.a, r.b) for r in pairs}
    block = {i: b for b, own in blocks.items() for i in own}
    close = ((x[:, None] - x[None]) ** 2).sum(-1) <= 0.25
    assert {(block[i], block[j]) for i, j in zip(*np.nonzero(close))} <= near and len(near) < len(blocks) ** 2
    assert all((b, a) in near for a, b in near)


def test_sweep_and_kmeans(spark, folder):
    rows = catalogue.matrix(spark, folder).select("product_id", "features")
    found = cluster.k_sweep(rows, k_max=4, n_init=2).orderBy("k").collect()
    inertia = [r.inertia for r in found]
    assert inertia == sorted(inertia, reverse=True) and sum(r.best for r in found) == 1
    assert all(-1 < r.silhouette <= 1 for r in found)


def plain_lloyd(x, centres):
    while True:
        own = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        new = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        if ((new - centres) ** 2).sum(1).max() <= lloyd.TOLERANCE ** 2:
            return centres, ((x - centres[own]) ** 2).sum()
        centres = new


def test_models_that_step_together_end_like_single_ones(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, .5, (80, 3)) for c in ((0, 0, 0), (4, 0, 1), (0, 5, 5))] + [np.zeros((5, 3))])
    df = frame(spark, x)
    points = lloyd.points_of(df.repartition(3))
    begin = lloyd.starts(points, [(2, 0), (3, 0), (3, 1), (6, 0)], 42)
    begin[4, 9] = np.vstack([x[:3], [[99.0, 99.0, 99.0]]])  # the last centre never gets a point
    together = lloyd.fit_all(points, begin)
    for m, start in begin.items():
        centres, cost = plain_lloyd(x, start)
        assert np.allclose(together[m].centres, centres, atol=1e-9) and abs(together[m].cost - cost) < 1e-6
    assert len({f.steps for f in together.values()}) > 1
    best = lloyd.best_of(together)
    assert best[3].cost == min(together[3, 0].cost, together[3, 1].cost)
    scores = lloyd.squared_silhouettes(points, best)
    for k in (2, 3, 6):
        labelled = best[k].transform(df)
        assert abs(scores[k] - cluster.silhouette(labelled)) < 1e-9
    assert (labels_of(best[3].transform(df), "cluster") == ((x[:, None] - best[3].centres[None]) ** 2).sum(-1).argmin(1)).all()


def test_names(spark):
    rows = ([(0, 100.0, 4.0, 10, 0.0)] * 3 + [(1, 1.0, 4.0, 100, 30.0)] * 6 + [(2, 1.0, 4.5, 300, 0.0)] * 6
            + [(3, 1.0, 3.0, 10, 0.0)] * 6 + [(4, 1.0, 3.0, 100, 0.0)] * 6 + [(-1, 1.0, 3.0, 100, 0.0)])
    df = spark.createDataFrame([(*r, "t") for r in rows], "cluster int, price double, rating double, "
                               "review_count int, discount_pct double, title string")
    names = {r.cluster: r.cluster_label for r in cluster.label_products(df).select("cluster", "cluster_label").distinct().collect()}
    assert names == {0: cluster.PREMIUM, 1: cluster.PROMO, 2: cluster.TOP_RATED, 3: cluster.NICHE,
                     4: cluster.MAINSTREAM, -1: cluster.ANOMALY}


def test_pca_matches_numpy(spark):
    x = np.random.default_rng(8).normal(size=(60, 4)) * [3, 2, 1, .5] + 10
    df = frame(spark, x)
    models = cluster.pca(df)
    rows = cluster.project(df, models).select(F.col("product_id").cast("int").alias("i"), "pc1", "pc2").orderBy("i").collect()
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = np.abs((u * s)[:, :2])
    assert np.allclose(np.abs([[r.pc1, r.pc2] for r in rows]), want, atol=1e-6)
    shares = [r.ratio for r in cluster.explained_variance(models, spark).collect()]
    assert np.allclose(shares, (s ** 2 / (s ** 2).sum())[:2], atol=1e-6)


def test_partners_without_a_shuffle_of_pairs(spark):
    """Blocks are read by the tasks that need them; of equally cheap partners the least id, on a grid full of ties."""
    rng = np.random.default_rng(8)
    x, w = np.unique(rng.integers(0, 7, (400, 3)), axis=0).astype(float) + 1e4, None
    w = rng.integers(1, 4, len(x))
    points = spark.createDataFrame([(i, int(n), [float(v) for v in p]) for i, (n, p) in enumerate(zip(w, x))], "id long, w long, x array<double>")
    found = hierarchy.nearest(stage(kdtree.split(stage(points), 3, 16)), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" in plan and "hashpartitioning" not in plan and plan.count("Exchange") == 1
    cost = ((x[:, None] - x[None]) ** 2).sum(-1) * (w[:, None] * w[None] / (w[:, None] + w[None]))
    np.fill_diagonal(cost, np.inf)
    rows = {r.id: r for r in found.collect()}
    assert sorted(rows) == list(range(len(x)))
    for i, r in rows.items():
        assert r.cost == cost[i].min() and r.other == np.flatnonzero(cost[i] == cost[i].min())[0]


def test_neighbours_without_a_shuffle_of_pairs(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.random((300, 2)), 1) + 1e4  # distances of exactly eps, far from the origin
    points = spark.createDataFrame([(i, 1 + i % 3, [float(v) for v in p]) for i, p in enumerate(x)], "pid long, w long, x array<double>")
    packs = stage(kdtree.packed(kdtree.split(stage(points), 2, 16), ["pid", "w"], 2)).withColumn(
        "id", F.flatten(F.transform(F.arrays_zip("pid", "w"), lambda m: F.array(m["pid"], m["w"]))))
    every = packs.select(F.col("block").alias("a")).crossJoin(packs.select(F.col("block").alias("b")))
    eps2 = float(((x[0] - x[1:]) ** 2).sum(1).min())
    found = density._around(packs, packs, stage(every), 2, eps2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" in plan and "hashpartitioning" not in plan
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps2
    want = near @ (1 + np.arange(300) % 3)
    assert {r.pid: r.around for r in found.collect()} == dict(enumerate(want.tolist()))
