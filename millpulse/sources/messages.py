"""Message streams: anything with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    security_protocol: str = "PLAINTEXT",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``max_offsets_per_trigger`` bounds a micro-batch after a long stop;
    ``min_partitions`` lets one fat topic partition be read by several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.security.protocol": security_protocol,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return {**options, **extra}


def kafka_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream from a topic. The Kafka connector must be on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | str | None = None,
) -> DataFrame:
    """Stream of text files with one message per line, as binary ``value`` like a topic.

    A micro-batch is bounded by the number of files or by their size (bytes, or text
    such as "10g"); a file larger than that is a batch of its own.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None and max_bytes_per_trigger is not None:
        raise ValueError("a step is bounded by files or by bytes, not by both")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        reader = reader.option("maxBytesPerTrigger", size(str(max_bytes_per_trigger)))
    return reader.load(path).selectExpr("cast(value as binary) as value")
