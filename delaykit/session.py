"""Session set-up and the shared working folder."""

import os
import uuid

from pyspark.sql import SparkSession

# Adaptive execution replans joins from measured shuffle sizes: a side that
# turns out small is broadcast, a hot key's partition is split over many tasks.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def object_store_conf(env) -> dict[str, str]:
    """s3a settings; credentials come from the environment only."""
    endpoint = env.get("OBJECT_STORE_ENDPOINT")
    if not endpoint:
        return {}
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if env.get("OBJECT_STORE_ACCESS_KEY"):
        conf["spark.hadoop.fs.s3a.access.key"] = env["OBJECT_STORE_ACCESS_KEY"]
        conf["spark.hadoop.fs.s3a.secret.key"] = env.get("OBJECT_STORE_SECRET_KEY", "")
    return conf


def catalog_conf(env) -> dict[str, str]:
    """Lakehouse catalog and key-value store settings."""
    conf = {}
    if env.get("LAKEHOUSE_WAREHOUSE"):
        name = env.get("LAKEHOUSE_CATALOG", "lakehouse")
        conf[f"spark.sql.catalog.{name}"] = "org.apache.iceberg.spark.SparkCatalog"
        conf[f"spark.sql.catalog.{name}.type"] = "hadoop"
        conf[f"spark.sql.catalog.{name}.warehouse"] = env["LAKEHOUSE_WAREHOUSE"]
    if env.get("CASSANDRA_HOST"):
        conf["spark.cassandra.connection.host"] = env["CASSANDRA_HOST"]
        conf["spark.cassandra.connection.port"] = env.get("CASSANDRA_PORT", "9042")
    return conf


def shuffle_conf(shuffle_bytes: int, partition_bytes: int = 512 * 1024**2) -> dict[str, str]:
    """Number of shuffle partitions for the bytes a job's largest shuffle moves.

    Adaptive execution merges partitions that turn out small but cannot make
    more of them, so a large job has to start with enough.
    """
    return {"spark.sql.shuffle.partitions": str(max(200, -(-int(shuffle_bytes) // partition_bytes)))}


def build_session(app_name="delaykit", conf=None, master=None, env=None) -> SparkSession:
    """Session with adaptive defaults, store settings from ``env``, then ``conf``."""
    env = os.environ if env is None else env
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**ADAPTIVE_CONF, **object_store_conf(env), **catalog_conf(env), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Below the default file system, where ``spark.checkpoint.dir`` is not set.
WORK_FOLDER = "/tmp/checkpoints"


def check_shared(master: str, file_system: str | None) -> None:
    """Raises where executors on other machines would not see the default file system."""
    if not master.startswith("local") and (file_system or "file:").startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_work_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors must see.

    Without that setting it lies in the default file system; on a cluster that must not be a machine's own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        check_shared(spark.sparkContext.master, spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS"))
        root = WORK_FOLDER
    return f"{root.rstrip('/')}/delaykit/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
