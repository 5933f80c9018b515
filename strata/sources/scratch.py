"""Where throw-away tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder that every executor reaches; it goes when the session's JVM ends."""
    folder = f"{scratch_base(spark)}/scratch-{uuid.uuid4().hex}"
    _delete_at_exit(spark, folder)
    return folder


def scratch_base(spark: SparkSession) -> str:
    """The first shared place that the session names.

    In this order: ``spark.checkpoint.dir``, the folder given to
    ``setCheckpointDir``, and the warehouse where its address names a shared
    file system. Only a session that runs in one process may fall back to a
    local temporary folder; any other raises, because each executor would write
    to a disk of its own.
    """
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or _shared_warehouse(spark)
    )
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="strata-")
    return base.rstrip("/")


def _shared_warehouse(spark: SparkSession) -> str | None:
    """A place in the warehouse, if its address has a scheme other than a local disk's."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or ""
    scheme = re.match(r"([a-z][a-z0-9+.-]*):", warehouse)
    return f"{warehouse.rstrip('/')}/_scratch" if scheme and scheme[1] != "file" else None


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Create the folder and let Hadoop remove it when the driver's JVM ends."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
