"""Shared folders. On a cluster they lie under the folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections import defaultdict
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_lock = threading.Lock()
_made: defaultdict[str, list[str]] = defaultdict(list)
_shipped: set[str] = set()


def _configured_folder(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING, None)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, without overriding a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_configured_folder(spark) or _local_folder(spark))


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach. Only sessions without the setting get a local one."""
    base = _configured_folder(spark)
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}" if base else f"{_local_folder(spark)}/{label}"
    with _lock:
        _made[spark.sparkContext.applicationId].append(folder)
    return folder


def clear_scratch(spark: SparkSession) -> int:
    """Delete all scratch folders that this application made so far, and return their number.

    Results are lazy and read them: call this when all results have been written or collected.
    """
    with _lock:
        folders = _made.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not be able to import it from where they run. Once a session."""
    application = spark.sparkContext.applicationId
    with _lock:
        if application in _shipped:
            return
        _shipped.add(application)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def _local_folder(spark: SparkSession) -> str:
    """A folder of this machine, where all of the session runs on it; on a cluster other machines would not see it."""
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all machines share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
