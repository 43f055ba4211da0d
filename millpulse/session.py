"""Session settings.

Nothing is hard-coded: endpoints, references and credentials are arguments,
and anything the caller or the cluster already set can be overridden through
``conf``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS: dict[str, str] = {
    # Hour-of-day, dates and 15-minute buckets are all defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Replaying a micro-batch replaces only the partitions that batch wrote.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Window state lives on local disk of the executor and is backed up to the
    # checkpoint, so the number of open windows is not bound by the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "millpulse",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the duration of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def versioned_catalog_conf(
    catalog: str,
    uri: str,
    warehouse: str,
    ref: str = "main",
    catalog_impl: str = "org.apache.iceberg.nessie.NessieCatalog",
    extensions: str | None = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Settings that mount an Iceberg catalog at one named reference.

    The catalog jar must be on the class path (``spark.jars.packages``).
    """
    prefix = f"spark.sql.catalog.{catalog}"
    conf = {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.catalog-impl": catalog_impl,
        f"{prefix}.uri": uri,
        f"{prefix}.ref": ref,
        f"{prefix}.warehouse": warehouse,
    }
    if extensions:
        conf["spark.sql.extensions"] = extensions
    for key, value in (options or {}).items():
        conf[f"{prefix}.{key}"] = value
    return conf


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
) -> dict[str, str]:
    """S3A settings; leave the keys out to use the cluster's credential provider."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if access_key is not None and secret_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf
