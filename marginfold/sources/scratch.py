"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_bases: dict[str, str] = {}
_own_folders: dict[tuple[str, str], str] = {}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Writes under way and the setting before the first of them, by session.
_writing: dict[str, tuple[int, str]] = {}
_writing_lock = threading.Lock()


def shared_base(spark: SparkSession) -> str:
    """The session's checkpoint folder, from its setting or from ``setCheckpointDir``.

    Where neither is given, a session in one process (``local[n]``), as in tests, gets a temporary
    folder that goes with the process; on a cluster this raises, because executors there would not
    see one another's files.
    """
    context = spark.sparkContext
    base = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if base:
        return base
    master = context.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_bases:
        made = tempfile.mkdtemp(prefix="marginfold-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_bases[context.applicationId] = made
    return _local_bases[context.applicationId]


def scratch_folder(spark: SparkSession) -> str:
    """A new folder path below the shared folder, in the application's own folder, which goes when it ends."""
    application = (spark.sparkContext.applicationId, shared_base(spark))
    if application not in _own_folders:
        own = f"{application[1].rstrip('/')}/marginfold-{uuid.uuid4().hex}"
        target = spark._jvm.org.apache.hadoop.fs.Path(own)
        store = target.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(target)
        store.deleteOnExit(target)
        _own_folders[application] = own
    return f"{_own_folders[application]}/{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside delete their shuffle files as they end.

    By itself Spark keeps them until the driver happens to collect its garbage, so a build would hold the
    shuffles of all its steps at once. A write has a plan of its own, so nothing reads them again. The
    session's setting is as before when the last of several writes at a time has ended.
    """
    session = spark._jsparkSession.sessionUUID()
    with _writing_lock:
        writes, before = _writing.get(session) or (0, spark.conf.get(_CLEANUP, "false"))
        _writing[session] = (writes + 1, before)
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _writing_lock:
            writes, before = _writing.pop(session)
            if writes > 1:
                _writing[session] = (writes - 1, before)
            else:
                spark.conf.set(_CLEANUP, before)


def written(frame: DataFrame, path: str | None = None, compression: str | None = None) -> DataFrame:
    """The frame as a Parquet table: computed once, read column by column by later steps."""
    path = path or scratch_folder(frame.sparkSession)
    with shuffles_freed(frame.sparkSession):
        frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
