"""Where jobs put intermediate data.

On a cluster every executor must see the folder, so it comes from
`spark.checkpoint.dir` or is the folder set by `setCheckpointDir`. A machine-local folder is
used only in local mode, and removed when the session's process ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Folders made for local sessions that name none, by application.
_own_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if set_by_caller := spark.sparkContext.getCheckpointDir():
        return set_by_caller.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.TemporaryDirectory(prefix="loanloom-", ignore_cleanup_errors=True)
    return _own_folders[application].name


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage in the shared folder."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
