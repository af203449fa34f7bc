"""Where intermediate tables go: a folder every executor can reach."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; on a
    cluster a machine-local folder would be lost with its executor, so the
    setting is required there.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="palimpsest-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return base.rstrip("/")


def new_location(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder; nothing is created there yet."""
    return f"{shared_folder(spark)}/palimpsest/{purpose}-{uuid.uuid4().hex}"


def remove_location(spark: SparkSession, path: str) -> bool:
    """Delete a folder that ``new_location`` named, once nothing reads it any more.

    Paths elsewhere are refused. Returns whether there was anything to delete.
    """
    ours = f"{shared_folder(spark)}/palimpsest/"
    name = path.removeprefix(ours).rstrip("/")
    if not path.startswith(ours) or not name or "/" in name or name in (".", ".."):
        raise ValueError(f"not a folder below {ours}: {path}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.delete(folder, True)


def ship_library(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application.

    Tasks that call its functions then find it wherever the driver was started from.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    _shipped.add(context.applicationId)
    archive = f"{tempfile.mkdtemp(prefix='palimpsest-')}/{package.name}"
    context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
