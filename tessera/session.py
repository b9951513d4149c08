"""Session helpers.

The library never creates its own cluster settings when a session already
exists: every operator takes the caller's ``SparkSession``.  ``get_spark``
is only for tests, the benchmark and the examples.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows per shuffle partition we aim for when an operator sizes its own
# bucketing (rank / prefix-sum buckets, bracket refinement).
TARGET_ROWS_PER_TASK = 2_000_000


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None) -> SparkSession:
    master = master or os.environ.get("TESSERA_MASTER", "local[*]")
    parts = shuffle_partitions or int(os.environ.get("TESSERA_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only when nothing is configured (local tests) do we pick a
    scratch folder ourselves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss), never a local one.

    The frame is persisted first: writing a reliable checkpoint re-runs the
    plan unless its blocks are cached, so this computes it once."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


def write_shared(df, name: str):
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage like :func:`cut_lineage`; besides, the planner knows the size
    of the files when it chooses a join."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def drop_shared(df) -> None:
    """Delete a table of :func:`write_shared` that no later step reads."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df._shared_path)
    path.getFileSystem(conf).delete(path, True)


ROWS_PER_PARTITION = 50_000


def right_size(df, n_rows: int | None = None, rows_per_partition: int = ROWS_PER_PARTITION):
    """Coalesce a small frame to ceil(n / rows_per_partition) partitions
    (never raises the count): tiny training sets stop paying per-task
    overhead, large ones keep their parallelism."""
    n = df.count() if n_rows is None else n_rows
    return df.coalesce(max(1, -(-n // rows_per_partition)))


def spread(df, rows_per_task: int, n_rows: int | None = None):
    """Even partitions for a fit that works long on every row: as many as the
    session has cores, of ``rows_per_task`` rows at least.  A frame for which
    that is no more than :func:`right_size` makes stays as it is."""
    n = df.count() if n_rows is None else n_rows
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(-(-n // rows_per_task), cores)
    return df.repartition(parts) if parts > max(1, -(-n // ROWS_PER_PARTITION)) else df


BROADCAST_ROWS = 20_000


def join_rows(left, right, on, n_rows: int, how: str = "inner"):
    """Join of two tables that both grow with the input (``n_rows``: about their size).  Spark would
    broadcast one, through the driver, up to its size threshold; beyond ``BROADCAST_ROWS`` both are sorted instead."""
    return left.join(right.hint("merge") if n_rows > BROADCAST_ROWS else right, on, how)


def load(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
