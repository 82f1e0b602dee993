"""A table that keeps one row per key, in buckets of keys, and is merged by rewriting only the buckets a run touches.

Layout below a folder::

    data/v=<version>/bucket=<b>/   the files of the buckets that a merge wrote
    log/<version>/                 one row a bucket: the version that holds its rows

A merge reads the newest log, joins the run with the rows of its own buckets
alone, writes those under a new version and then writes the log. The log is the
last step, so readers see a merge whole or not at all, and a merge that died or
is replayed writes its version again. Untouched buckets keep their files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import dedup

#: Buckets of a table; a few hundred MB each is a good size, so count them for the final size.
BUCKETS = 256
_LOG = "bucket int, version long"


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions with a finished log, newest last."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/log")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [(s.getPath().getName(), s.getPath()) for s in files.listStatus(path)]
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(int(name) for name, place in names if name.isdigit() and files.exists(done(place, "_SUCCESS")))


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _log(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(_LOG).parquet(f"{folder}/log/{version}")


def _rows(spark: SparkSession, folder: str, places: dict[int, int], schema: T.StructType) -> DataFrame:
    """Rows of the named buckets; ``places`` has the version of each, at most one entry a bucket of the table."""
    paths = [f"{folder}/data/v={v}/bucket={b}" for b, v in sorted(places.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge(
    run: DataFrame, folder: str, keys: list[str] = dedup.HISTORY_KEYS, seq: str = "seq", buckets: int = BUCKETS,
    version: int | None = None,
) -> int:
    """Merge a run into the table and return the new version; the run's copy of a key replaces the table's.

    Of several copies in the run the one with the highest ``seq`` stays; ``seq``
    is stored. Null keys are equal. ``buckets`` must stay the same for a
    table. A ``version`` that is given and has a log already is not merged again,
    so a replayed batch changes nothing; versions must grow.
    """
    spark = run.sparkSession
    if "bucket" in run.columns:
        raise ValueError("bucket is the table's own column")
    done = _versions(spark, folder)
    if version is not None and version in done:
        return version
    new = version if version is not None else (done[-1] + 1 if done else 0)
    if done and new < done[-1]:
        raise ValueError(f"version {new} comes before {done[-1]}")
    before = {r["bucket"]: r["version"] for r in _log(spark, folder, done[-1]).collect()} if done else {}
    if before and max(before) >= buckets:
        raise ValueError("the table has more buckets")
    fresh = dedup.keep_last(run, keys, seq).withColumn("bucket", bucket_of(keys, buckets))
    touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
    held = _rows(spark, folder, {b: before[b] for b in touched if b in before}, run.schema)
    same = [held[k].eqNullSafe(fresh[k]) for k in keys]
    kept = held.join(fresh.select(*keys), same, "left_anti").withColumn("bucket", bucket_of(keys, buckets))
    rows = kept.unionByName(fresh)
    # A bucket goes to few tasks; a large one is cut by its keys, so none is a single task's work.
    rows.repartition(F.col("bucket"), F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(8))).write.mode("overwrite").partitionBy(
        "bucket").parquet(f"{folder}/data/v={new}")
    after = {**before, **{b: new for b in touched}}
    spark.createDataFrame(sorted(after.items()), _LOG).coalesce(1).write.mode("overwrite").parquet(f"{folder}/log/{new}")
    return new


def read(spark: SparkSession, folder: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The table at its newest or at a given version; a table without a merge is empty."""
    done = _versions(spark, folder)
    if version is None:
        version = done[-1] if done else None
    if version is None:
        return spark.createDataFrame([], schema)
    return _rows(spark, folder, {r["bucket"]: r["version"] for r in _log(spark, folder, version).collect()}, schema)


def vacuum(spark: SparkSession, folder: str) -> int:
    """Delete bucket folders that the newest version does not use, and older logs; returns how many folders went."""
    done = _versions(spark, folder)
    if not done:
        return 0
    used = {(r["version"], r["bucket"]) for r in _log(spark, folder, done[-1]).collect()}
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = make(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = 0
    for state in files.listStatus(make(f"{folder}/data")):
        version = int(state.getPath().getName().split("=")[1])
        if version > done[-1]:
            continue
        for bucket in files.listStatus(state.getPath()):
            name = bucket.getPath().getName()
            if name.startswith("bucket=") and (version, int(name.split("=")[1])) not in used:
                files.delete(bucket.getPath(), True)
                gone += 1
    for version in done[:-1]:
        files.delete(make(f"{folder}/log/{version}"), True)
    return gone
