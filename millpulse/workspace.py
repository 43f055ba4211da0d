"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_made: list[str] = []


def _local_base() -> str:
    """A temporary folder of this machine, deleted when the process ends."""
    base = tempfile.mkdtemp(prefix="millpulse-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def release_scratch(spark: SparkSession) -> int:
    """Delete all scratch folders that this process has made; their results must
    not be read any more. Returns how many there were."""
    count = len(_made)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)
    return count


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder.

    A temporary folder of this machine is used only in local mode, where the
    executors are threads of the same process. Folders stay until
    ``release_scratch``: a result that was returned may still read them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: a cluster needs a shared folder "
                "for stream checkpoints and intermediate tables"
            )
        base = _local_base()
    _made.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _made[-1]
