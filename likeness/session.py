"""Session helpers: a local session for tests/bench and a shared scratch
folder derived from ``spark.checkpoint.dir``."""

from __future__ import annotations

import gc
import hashlib
import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "likeness") -> SparkSession:
    """Session used by tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins; only when it is unset on a local
    master (tests) a fresh temporary folder is created and registered.  On a
    cluster such a folder would be another one on every machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="likeness-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str):
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    return a DataFrame reading it back.

    Cuts the lineage (an executor lost later re-reads files instead of
    recomputing the plan), runs the plan exactly once (an eager RDD
    checkpoint of an uncached plan computes it twice), and gives AQE exact
    sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def input_parallelism(df):
    """Repartition a scan that yields fewer partitions than the cluster has
    cores (a single unsplittable file); a no-op for real multi-file inputs,
    which already scan in parallel."""
    sc = df.sparkSession.sparkContext
    want = sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def input_fingerprint(spark: SparkSession, path: str) -> tuple:
    """(path, files, digest of every file's name, length and modification time)
    through the Hadoop FileSystem API, so it works for local and cluster file
    systems alike.  The digest does not depend on the order of the listing, and
    no list of files is kept."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    n = total = 0
    found = fs.listFiles(p, True)      # descends into partition folders
    while found.hasNext():
        st = found.next()
        text = f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}"
        n, total = n + 1, (total + int.from_bytes(hashlib.sha256(text.encode()).digest()[:16])) % 2**128
    return (path, n, total)


_WRITTEN: dict = {}


def written(spark: SparkSession, name: str, inputs: list[str], params: tuple, build):
    """A derived table written once per (application, inputs, parameters).

    ``inputs`` are the source paths whose files key the table (so changed
    inputs are recomputed); ``build()`` returns the DataFrame to write.  Later
    queries over the same inputs read the written table - the hand-off of
    intermediate files between jobs, without recomputation.
    """
    key = (spark.sparkContext.applicationId, name,
           tuple(input_fingerprint(spark, p) for p in inputs), params)
    if key not in _WRITTEN:
        _WRITTEN[key] = materialize(build(), name)
        collect_garbage(spark)
    return _WRITTEN[key]


def collect_garbage(spark: SparkSession) -> None:
    """Shuffle files of plans that are done stay on the executors' disks until the
    driver's garbage collector finds the plans: have it look now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


GARBAGE_S = 2


@contextmanager
def garbage_collected(spark: SparkSession, every: float = GARBAGE_S):
    """``collect_garbage`` now and then while one long call (a fit) runs inside."""
    done = threading.Event()

    def run():
        while not done.wait(every):
            spark.sparkContext._jvm.System.gc()

    beside = threading.Thread(target=run, daemon=True)
    beside.start()
    try:
        yield
    finally:
        done.set()
        beside.join()
        collect_garbage(spark)


# Fixed value: most rows a side may have to be broadcast by ``bounded_broadcast``.
BROADCAST_MAX_ROWS = 1_000_000


def bounded_broadcast(df, max_rows: int = BROADCAST_MAX_ROWS):
    """Broadcast hint only after checking the size: ``df`` is counted
    (callers pass small, usually written, tables) and meets in a shuffle join
    when it has more than ``max_rows`` rows.  That is said by a hint: a file that
    compresses well is far smaller than its rows in the driver's memory, and would
    be broadcast by its size."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= max_rows else shuffled(df)


def shuffled(df):
    """``df`` as a side that meets in a shuffle join whatever its size: one that
    grows with the users and is not worth a count.  Its file says nothing of its rows
    (lists of 20 items, alike for many users, take half a byte a row)."""
    return df.hint("merge")
