"""Shared helpers of the corpus operators.

``staged``        writes a frame to the cluster's shared checkpoint folder and
                  reads it back: cuts lineage, survives executor loss and fixes
                  row ids for every later recomputation.
``gapless_rank``  0..n-1 inside each key without a task per key.
``running_sum``   exclusive running sum inside each key, same construction.
``sole_cache``    a Python worker's cache that outlives tasks; it holds one at a time.
``free_name``     a column name that a user's table does not have.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

ROWS_PER_BUCKET = 50_000
MIN_BUCKETS = 256


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}   # whole texts go to Python in batches of this many rows

_CACHE: dict[str, object] = {}


def sole_cache(name: str, make):
    """The cache ``name`` of this Python worker, made at first use; caches of other operators are dropped.

    Workers serve one operator after another, so caches kept side by side would add up."""
    if name not in _CACHE:
        release_caches()
        _CACHE[name] = make()
    return _CACHE[name]


def release_caches() -> None:
    """Drop the caches that earlier tasks left in this worker and give their memory back to the machine."""
    import ctypes

    import pyarrow as pa
    _CACHE.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:      # a C library without it
        pass


@contextmanager
def session_settings(spark, settings: dict):
    """SQL settings that hold inside the block and are put back after it."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder of ``spark.checkpoint.dir`` and read it back.

    No later step reads the shuffle files of the write, so Spark deletes them
    when it ends instead of at some later collection of the driver's heap."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    with session_settings(spark, {SHUFFLE_CLEANUP: "true", **ARROW_ROWS}):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete a staged table that no later step reads (loop intermediates)."""
    path = getattr(df, "_staged_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def free_name(columns, name: str) -> str:
    """``name``, lengthened until none of ``columns`` has it (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame, name: str = "rid") -> DataFrame:
    """A unique row id; stage the result before joining on it."""
    return df.withColumn(name, F.monotonically_increasing_id())


def bucket_count(n_rows: int) -> int:
    return max(MIN_BUCKETS, -(-n_rows // ROWS_PER_BUCKET))


def _bucketed(df, keys, rid, n_rows, value):
    """Rows with their bucket and the exclusive offset of (keys, bucket)."""
    nb = bucket_count(n_rows)
    rows = df.withColumn("_b", F.pmod(F.xxhash64(rid), F.lit(nb)).cast("int"))
    per = rows.groupBy(*keys, "_b").agg(F.sum(value).cast("long").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    cond = [rows[k].eqNullSafe(per[k]) for k in keys] + [rows["_b"] == per["_b"]]
    joined = rows.join(per, cond, "inner")
    for k in [*keys, "_b"]:
        joined = joined.drop(per[k])
    return joined


def gapless_rank(df: DataFrame, keys: list[str], rid: str, n_rows: int, out: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps.

    Rows fall into hash buckets of about ``ROWS_PER_BUCKET``; a window numbers
    each (key, bucket) and the small table of bucket counts supplies offsets,
    so a key with a third of all rows is spread over all buckets.  ``rid`` must
    be unique and fixed (staged)."""
    j = _bucketed(df, keys, rid, n_rows, F.lit(1))
    w = Window.partitionBy(*keys, "_b").orderBy(rid)
    return j.withColumn(out, (F.row_number().over(w) - 1 + F.col("_off")).cast("long")).drop("_b", "_off")


def running_sum(df: DataFrame, keys: list[str], rid: str, n_rows: int, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` inside each key (see ``gapless_rank``)."""
    j = _bucketed(df, keys, rid, n_rows, F.col(value))
    w = Window.partitionBy(*keys, "_b").orderBy(rid).rowsBetween(Window.unboundedPreceding, -1)
    return j.withColumn(out, (F.coalesce(F.sum(value).over(w), F.lit(0)) + F.col("_off")).cast("long")).drop("_b", "_off")


def held_out(doc_id="doc_id"):
    """crc32 of the id as text, modulo 5, is 0.  A null id is held out (never learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))
