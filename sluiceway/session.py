"""Session settings for lake, topic and object-store access.

All of it is configuration: nothing here is needed for a session that already
exists, such as a cluster's.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

import pyspark
from pyspark.sql import SparkSession

# Partition values stay text (a brand ``007`` is not a number); times are in UTC.
BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Hot brands and keys are split by adaptive execution, which therefore is required.
    # Its target for a task decides how large the files of a gathered write become.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

# Class names of the object store's connector.
S3A_FILE_SYSTEM = "org.apache.hadoop.fs.s3a.S3AFileSystem"
S3A_KEY_PROVIDER = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"

# Class names that Delta registers with a session.
DELTA_SETTINGS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


@dataclass(frozen=True)
class ObjectStore:
    """An S3-compatible store. Without keys, the environment's credentials are used."""

    endpoint: str
    access_key: str | None = field(default=None, repr=False)
    secret_key: str | None = field(default=None, repr=False)
    path_style: bool = True
    tls: bool = True

    def settings(self) -> dict[str, str]:
        prefix = "spark.hadoop.fs.s3a"
        found = {
            f"{prefix}.impl": S3A_FILE_SYSTEM,
            f"{prefix}.endpoint": self.endpoint,
            f"{prefix}.path.style.access": str(self.path_style).lower(),
            f"{prefix}.connection.ssl.enabled": str(self.tls).lower(),
        }
        if self.access_key and self.secret_key:
            found |= {
                f"{prefix}.access.key": self.access_key,
                f"{prefix}.secret.key": self.secret_key,
                f"{prefix}.aws.credentials.provider": S3A_KEY_PROVIDER,
            }
        return found


def kafka_package(scala: str = "2.13") -> str:
    """Coordinate of the Kafka source that belongs to this Spark."""
    return f"org.apache.spark:spark-sql-kafka-0-10_{scala}:{pyspark.__version__}"


def delta_package(version: str, scala: str = "2.13") -> str:
    """Coordinate of the Delta format; its versions are tied to Spark's by its release notes."""
    return f"io.delta:delta-spark_{scala}:{version}"


def s3a_package(hadoop: str) -> str:
    """Coordinate of the object-store connector for this Spark's Hadoop version, which
    ``hadoop_version`` tells."""
    return f"org.apache.hadoop:hadoop-aws:{hadoop}"


def hadoop_version() -> str:
    """The Hadoop version that comes with this Spark."""
    jars = Path(pyspark.__file__).parent / "jars"
    found = sorted(jars.glob("hadoop-client-api-*.jar"))
    if not found:
        raise RuntimeError(f"no Hadoop client in {jars}; give the version that the cluster runs")
    return found[0].stem.removeprefix("hadoop-client-api-")


def session_settings(
    *,
    delta: bool = False,
    store: ObjectStore | None = None,
    metastore_uri: str | None = None,
    packages: tuple[str, ...] = (),
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Settings of a session; ``extra`` wins over all others."""
    settings = dict(BASE_SETTINGS)
    if delta:
        settings |= DELTA_SETTINGS
    if store:
        settings |= store.settings()
    if metastore_uri:
        settings |= {
            "spark.sql.catalogImplementation": "hive",
            "spark.hadoop.hive.metastore.uris": metastore_uri,
        }
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    return settings | dict(extra or {})


def open_session(app_name: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """Get or create the session; the master is left to ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (session_settings() if settings is None else settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
