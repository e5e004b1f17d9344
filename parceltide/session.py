"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"

# What the plans of this package rely on. Everything else stays as the cluster sets it.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a busy parcel even if a later step has to shuffle the rows again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tables between steps are written once and read a few times: smaller files are worth the processor time.
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes a few years keeps a file of each open instead of sorting all its rows by year.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Set where the cluster says nothing. 128 MB of such tables hold so many rows that a task would spill when it sorts them.
_SCAN_KEY, _SCAN_BYTES = "spark.sql.files.maxPartitionBytes", "32m"


def build_session(app: str = "parceltide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, _SCAN_KEY: _SCAN_BYTES, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_session_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    if spark.conf.get(_SCAN_KEY, None) is None:
        spark.conf.set(_SCAN_KEY, _SCAN_BYTES)
    return spark


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without: on a cluster the executors could not see a temporary
    folder of the driver, so a missing setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or context.getConf().get(_CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="parceltide-")
    return _local_roots[context.applicationId]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate to a fresh shared folder and read it back: what follows starts from files."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and nobody reads any more."""
    spark = df.sparkSession
    names = df.inputFiles()
    if names:
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(names[0])).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps. It learns what is unreachable from a collection
    of the driver's garbage, which else may be half an hour away."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` and the iterative learners a reliable folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "rdd-checkpoint"))
