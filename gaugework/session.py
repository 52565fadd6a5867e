"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan here relies on: AQE picks the join strategy from measured shuffle sizes and
# splits skewed join partitions even where that costs one more exchange.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Bytes after which an Arrow batch of texts ends. Spark's 64 MB are held by the JVM, on the way and by the worker, for each task.
BATCH_BYTES = 4 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Switch the adaptive settings on in a session that somebody else made."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return short_batches(spark)


def short_batches(spark: SparkSession) -> SparkSession:
    """Let Arrow batches end at BATCH_BYTES, whatever the length of the texts; a longer text is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, name: str = "gaugework") -> SparkSession:
    """Session for tests and the bench; on a cluster use the session spark-submit gives and `tune` it."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # no call sites in error messages: noting them costs more than the rest of building an expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a temporary folder of this machine, one for the process.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="gaugework-"))
    return _local_root[0]


def forget_local() -> None:
    """Local mode only: later steps start from an empty folder, so nothing stored before is found again."""
    _local_root.clear()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
