"""Session configuration, object-store settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Row groups of times written like this are skipped by a time bound; the default form never is.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also the size at which a partitioned write starts another file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def object_store_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """Session settings for ``s3a://`` roots.

    With an endpoint: path-style access and static keys, for S3-compatible stores. Without one:
    the default credential chain. Other URI schemes need none of this.
    """
    conf = {"fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if endpoint:
        conf["fs.s3a.endpoint"] = endpoint
        conf["fs.s3a.path.style.access"] = "true"
        conf["fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
        if access_key and secret_key:
            conf["fs.s3a.access.key"] = access_key
            conf["fs.s3a.secret.key"] = secret_key
    else:
        conf["fs.s3a.aws.credentials.provider"] = (
            "software.amazon.awssdk.auth.credentials.DefaultCredentialsProvider"
        )
    return {f"spark.hadoop.{name}": value for name, value in conf.items()}


def build_session(app_name: str = "perigee", extra: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Hourly windows align to UTC; make sure parsing and display do too, and that written times can be pruned."""
    for name in ("spark.sql.session.timeZone", "spark.sql.parquet.outputTimestampType"):
        spark.conf.set(name, SESSION_DEFAULTS[name])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local session without one may fall back to a temporary folder: on a cluster a
    machine-local path would vanish with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="perigee-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
