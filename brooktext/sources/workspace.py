"""The shared folder for staged files, model state and stream checkpoints.

A cluster names the folder in ``spark.checkpoint.dir``; every executor can
read it, so nothing is lost with a machine. Only a local session without that
setting gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# By application id: the folder of a local session without the setting, and
# the paths staged by ``materialize`` that are not deleted yet.
_LOCAL_ROOTS: dict[str, str] = {}
_STAGED: dict[str, list[tuple[SparkSession, str]]] = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can read")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="brooktext-")
    return _LOCAL_ROOTS[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; it is created by the first write."""
    return f"{shared_root(spark)}/brooktext/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of each query run inside as soon as it ends.

    For writes of staged tables: once the table stands, nothing reads the
    shuffles it came from.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, purpose: str, **options: str | int) -> DataFrame:
    """Write ``df`` once and read it back.

    For a frame that several passes need: the passes read narrow Parquet
    columns instead of tokenising the text again, and a lost executor costs a
    re-read, not a recomputation of the lineage. ``discard`` deletes the copy;
    ``release`` and the end of the program delete all that is left. ``options`` are of the Parquet writer.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append((spark, path))
    with shuffles_dropped(spark):
        df.write.options(**options).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def discard(*frames: DataFrame) -> None:
    """Delete the staged copies behind ``frames``; nothing may read them later."""
    for df in frames:
        spark, path = df.sparkSession, df.staged_path
        delete(spark, path)
        left = _STAGED.get(spark.sparkContext.applicationId, [])
        left[:] = [entry for entry in left if entry[1] != path]


def release(spark: SparkSession) -> None:
    """Delete every copy staged in this application.

    To be called when the results that read them have been used.
    """
    for session, path in _STAGED.pop(spark.sparkContext.applicationId, []):
        delete(session, path)


@atexit.register
def _release_at_exit() -> None:
    for entries in list(_STAGED.values()):
        with suppress(Exception):  # the session may have been stopped
            release(entries[0][0])


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def bytes_in(spark: SparkSession, path: str) -> int:
    fs, target = _hadoop_path(spark, path)
    return fs.getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside and renamed, so that a reader finds the old one or the new one."""
    fs, target = _hadoop_path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(beside, target):
        # Not every store renames over an existing file.
        fs.delete(target, False)
        fs.rename(beside, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    if not exists(spark, path):
        return None
    return "\n".join(row.value for row in spark.read.text(path).collect())
