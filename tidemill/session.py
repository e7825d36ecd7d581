"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings the pipelines rely on. Shuffle partition counts and split sizes are left to the
# cluster: AQE coalesces small shuffles, and a fixed number would be wrong at one scale or another.
SETTINGS = {
    # log days and hours are UTC days and hours
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # one user or order may own a third of all rows: let AQE split such join partitions even when
    # that costs the next operator a shuffle of its own
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # stored lines and messages repeat much; zstd writes a third less than the default
    "spark.sql.parquet.compression.codec": "zstd",
    # a log line may repeat a field; the last one counts, as for JSON readers in general
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # join buffers and window state outgrow the heap long before they outgrow local disk
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit what changed rather than whole files, and do not read a key only to count it
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings applied; ``conf`` uses ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, for stream checkpoints and written tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where every task runs on this
    machine, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Partitions that the shuffles of a job start from at least; AQE puts small ones together.
PARTITIONS = 200


def job_session(spark: SparkSession) -> SparkSession:
    """A session for jobs: one state partition per core, fixed by the first run. Jobs without stream state are
    planned by AQE, which starts from the partitions that the given session has, or from ``PARTITIONS`` where these
    are fewer, so that the sorts of a large batch stay in memory. The shuffle files of a query go when it ends."""
    session = configure(spark.newSession())
    session.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                     str(max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    # else they stay until the driver happens to collect its garbage, those of every batch and run
    session.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    session.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session
