"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    CHANGELOG: "true",
}


def build_session(app="fleetpulse", master=None, **conf):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BATCH_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark):
    """Day partitions and clock text follow UTC whatever the host's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_stream_settings(spark, live=True):
    """Settings of the streams started next.

    A live stream commits its many small micro-batches as changes. A run that drains its source (``live``
    off) has a few large ones and leaves its state as files: the next start fetches what is still held,
    where changes are applied again one by one, those of closed windows included. Each kind reads the other's.
    """
    for key, value in {**STREAM_CONF, CHANGELOG: str(live).lower()}.items():
        spark.conf.set(key, value)
    return spark


def use_parts_policy(spark, policy):
    """Whether a stream of several watermarks follows the slowest (min) or the newest (max); a
    query keeps the policy of its first start."""
    if policy not in ("min", "max"):
        raise ValueError("parts_policy: min|max")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)


def scratch_path(spark, label):
    """A fresh folder below the shared ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a folder of
    this machine; on a cluster such a folder would not be seen by executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="fleetpulse-")
    return f"{base.rstrip('/')}/fleetpulse/{label}-{uuid.uuid4().hex}"


def saved(df, label):
    """Write a small intermediate result to the scratch folder and read it from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark, path):
    """(file system, path) pair for a location of any scheme."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def is_directory(spark, path):
    fs, target = hadoop_path(spark, path)
    return fs.getFileStatus(target).isDirectory()
