"""The few file-system calls Spark's readers and writers do not cover, through Hadoop."""
import atexit
from uuid import uuid4

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import SparkSession


def join_path(*parts: str) -> str:
    return "/".join(part.rstrip("/") for part in parts)


def _path(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def total_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of everything the paths (globs allowed) stand for."""
    total = 0
    for path in paths:
        fs, hadoop_path = _path(spark, path)
        for status in fs.globStatus(hadoop_path) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    fs, hadoop_path = _path(spark, path)
    if fs.exists(hadoop_path) and not fs.delete(hadoop_path, True):
        raise OSError(f"cannot delete {path}")


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a file or folder when the driver ends, whether the session still runs or not.

    The file system is asked for it now: it outlives the session, as its JVM does.
    """
    fs, hadoop_path = _path(spark, path)
    atexit.register(_delete_late, fs, hadoop_path)


def _delete_late(fs, hadoop_path) -> None:
    try:
        fs.delete(hadoop_path, True)
    except (Py4JError, Py4JNetworkError, ConnectionError):
        pass  # the JVM is gone already


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to ``target``, replacing what was there.

    What was there is moved aside first and comes back if the move fails.
    """
    fs, source_path = _path(spark, source)
    _, target_path = _path(spark, target)
    _, aside = _path(spark, f"{target}.replaced-{uuid4().hex}")
    earlier = fs.exists(target_path)
    if earlier and not fs.rename(target_path, aside):
        raise OSError(f"cannot move {target} aside")
    moved = False
    try:
        moved = fs.rename(source_path, target_path)
        if not moved:
            raise OSError(f"cannot move {source} to {target}")
    finally:
        if earlier and not moved:
            fs.rename(aside, target_path)
    if earlier:
        fs.delete(aside, True)


def joined_parts(spark: SparkSession, folder: str, target: str, head: str) -> None:
    """Write ``head`` and then the part files of ``folder``, in the order of their names.

    Bytes are copied through a buffer of fixed size; no part is held.
    """
    fs, pattern = _path(spark, join_path(folder, "part-*"))
    target_fs, target_path = _path(spark, target)
    copy = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    parts = sorted((status.getPath().toString(), status.getPath()) for status in fs.globStatus(pattern) or [])
    out = target_fs.create(target_path, True)
    try:
        out.write(head.encode("utf-8"))
        for _, part in parts:
            source = fs.open(part)
            try:
                copy(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()
