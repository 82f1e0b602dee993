import random

import pytest

from shelfwise.operators import dedup
from shelfwise.sources import bucketed

SHAPE = "seq long, title string, price double, platform string, scraped_at string, rating double"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_run(draw, n, titles):
    return [(i, draw.choice(titles), draw.choice([1.0, None]), draw.choice(["s", None]), "t", draw.random()) for i in range(n)]


def test_merges_keep_the_last_copy_of_every_key(spark, tmp_path):
    draw, want = random.Random(5), {}
    titles = [f"t{i}" for i in range(30)] + [None, ""]
    for n in (60, 0, 25):
        run = random_run(draw, n, titles)
        bucketed.merge(spark.createDataFrame(run, SHAPE), str(tmp_path / "h"), buckets=4)
        want.update({r[1:5]: r for r in run})
    got = bucketed.read(spark, str(tmp_path / "h"), spark.createDataFrame([], SHAPE).schema)
    assert rows_of(got) == sorted(want.values(), key=repr)


def test_a_small_run_rewrites_its_own_buckets_only(spark, tmp_path):
    folder, buckets = str(tmp_path / "h"), 64
    first = spark.createDataFrame([(i, f"t{i}", 1.0, "s", "t", 0.0) for i in range(2000)], SHAPE)
    assert bucketed.merge(first, folder, buckets=buckets) == 0
    second = spark.createDataFrame([(9000, "t7", 1.0, "s", "t", 5.0), (9001, "new", 1.0, "s", "t", 6.0)], SHAPE)
    assert bucketed.merge(second, folder, buckets=buckets) == 1
    written = [p.name for p in (tmp_path / "h/data/v=1").glob("bucket=*")]
    touched = second.select(bucketed.bucket_of(dedup.HISTORY_KEYS, buckets).alias("b")).distinct().collect()
    assert sorted(written) == sorted(f"bucket={r.b}" for r in touched) and len(written) <= 2
    now = bucketed.read(spark, folder, first.schema)
    assert now.count() == 2001 and {r.rating for r in now.where("title in ('t7', 'new')").collect()} == {5.0, 6.0}
    assert bucketed.read(spark, folder, first.schema, version=0).count() == 2000
    assert bucketed.vacuum(spark, folder) == len(touched)
    assert bucketed.read(spark, folder, first.schema).count() == 2001


def test_replayed_and_unfinished_merges(spark, tmp_path):
    folder = str(tmp_path / "h")
    run = spark.createDataFrame([(1, "a", 1.0, "s", "t", 1.0)], SHAPE)
    later = spark.createDataFrame([(2, "a", 1.0, "s", "t", 2.0)], SHAPE)
    assert bucketed.read(spark, folder, run.schema).count() == 0
    bucketed.merge(run, folder, buckets=2, version=3)
    bucketed.merge(later, folder, buckets=2, version=3)
    assert [r.rating for r in bucketed.read(spark, folder, run.schema).collect()] == [1.0]
    # Data without a log is not seen, and the next merge of that version replaces it.
    later.write.parquet(f"{folder}/data/v=4/bucket=0")
    assert [r.rating for r in bucketed.read(spark, folder, run.schema).collect()] == [1.0]
    bucketed.merge(later, folder, buckets=2, version=4)
    assert [r.rating for r in bucketed.read(spark, folder, run.schema).collect()] == [2.0]
    with pytest.raises(ValueError):
        bucketed.merge(run, folder, buckets=2, version=1)
