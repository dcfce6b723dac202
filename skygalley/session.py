"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skygalley")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Runtime settings for wide projections; settings made by the user stay as they are.

    HotSpot never compiles a method above 8000 bytes of bytecode, so a fused stage that grows past
    it runs interpreted. Below this limit Spark runs such a stage operator by operator, compiled.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


# Bytes of stored columns a scan task reads, bytes of a shuffle a task reads, and input bytes behind one shuffle partition.
SCAN_BYTES = 8 << 20
SHUFFLE_BYTES = 16 << 20
INPUT_BYTES = 8 << 20
# Scans above this size are cut by a Bloom filter over the keys of a filtered dimension up to that size, before they are shuffled
# to a join with it. Spark's own limits are 10 GB and 10 MB.
FILTERED_BYTES = 16 << 20
FILTER_BYTES = 256 << 20
# The number of shuffle partitions set here, by application: what the user set is never in it.
_partitions: dict[str, str] = {}


def small_tasks(spark: SparkSession, folder: str) -> None:
    """Tasks over the tables of a folder that hold their rows in memory; settings made by the user stay as they are.

    Rows take ten to twenty times the bytes that they have in compressed columns. With Spark's 128 MB a scan, and tasks joined
    until there are as many as cores, a whole-row distinct, or the sort before a write by month, spills more the larger the input is.
    """
    def default(name: str, of: str) -> bool:
        return spark.conf.get(name, of) == of

    if default("spark.sql.files.maxPartitionBytes", "134217728b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if default(advisory, "67108864b"):
        spark.conf.set(advisory, str(SHUFFLE_BYTES))
    bloom = "spark.sql.optimizer.runtime.bloomFilter"
    if spark.conf.get(f"{bloom}.applicationSideScanSizeThreshold") in ("10GB", "10737418240b"):
        spark.conf.set(f"{bloom}.applicationSideScanSizeThreshold", str(FILTERED_BYTES))
    if spark.conf.get(f"{bloom}.creationSideThreshold") in ("10MB", "10485760b"):
        spark.conf.set(f"{bloom}.creationSideThreshold", str(FILTER_BYTES))
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = -(-_stored_bytes(spark, folder) // INPUT_BYTES)
    app, now = spark.sparkContext.applicationId, spark.conf.get(initial, None)
    # a number set for an earlier, smaller folder grows; the user's stays
    own = now is None or now == _partitions.get(app)
    if own and wanted > int(now or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(initial, str(wanted))
        _partitions[app] = str(wanted)


def _stored_bytes(spark: SparkSession, folder: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.getContentSummary(path).getLength() if store.exists(path) else 0


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where nothing names one (a local session, as in tests) a new temporary folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="skygalley-", dir=os.environ.get("TMPDIR"))
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_table_root(spark: SparkSession) -> str:
    """A fresh sub-folder of the shared folder, never used by another run."""
    return f"{shared_folder(spark).rstrip('/')}/skygalley-{uuid.uuid4().hex}"
