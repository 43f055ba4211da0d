"""Publishing JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def publish_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send ``value`` to a topic from all tasks in parallel, without a key.

    Rows without a key go round-robin over the topic partitions, so a busy
    machine does not fill one of them.
    """
    messages.select("value").write.format("kafka").options(
        **kafka_sink_options(servers, topic, options)
    ).save()


def kafka_sink_options(
    servers: str, topic: str, options: Mapping[str, str] | None = None
) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(options or {})}


def publish_files(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Write one message per line, one file per task, or as many as stated.

    A stated number costs a shuffle of the messages.
    """
    lines = messages.select("value")
    if files is not None:
        lines = lines.repartition(files)
    lines.write.mode("append").text(path)
