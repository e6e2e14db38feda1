"""Look at files through Hadoop's file system, so any cluster storage works."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def join(*parts: str) -> str:
    """Join path parts with ``/``; works for local paths and URIs alike."""
    return posixpath.join(*parts)


def _matches(spark: SparkSession, pattern: str):
    """File statuses matching a path or glob pattern, as an array on the Java side."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)


def count(spark: SparkSession, pattern: str) -> int:
    """Number of files and folders a path or glob pattern matches."""
    return len(_matches(spark, pattern) or [])


def exists(spark: SparkSession, pattern: str) -> bool:
    """True when a path or glob pattern matches anything."""
    return count(spark, pattern) > 0


# What Spark puts into a folder last.
MARKER = "_SUCCESS"


def finished(spark: SparkSession, folder: str) -> bool:
    """True when a folder was written to the end."""
    return exists(spark, join(folder, MARKER))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory; empty if it does not exist."""
    return [found.getPath().getName() for found in _matches(spark, join(path, "*")) or []]


def scanned_bytes(scan: DataFrame) -> int:
    """Bytes of the files behind a frame that was just read.

    Spark has listed them already, in parallel where there are many; asking for each file
    again from the driver would take minutes for hundreds of thousands of them.
    """
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Suffixes of compressed text files, and how much larger their text is taken to be.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")
EXPANSION = 4


# Spark's estimates from here on mean that it does not know.
UNKNOWN = 2**60


def text_bytes(frame: DataFrame) -> int:
    """Spark's estimate of a frame's bytes, allowing for compressed text files.

    0 if it reads no files or the estimate is no figure.
    """
    files, size = frame._jdf.inputFiles(), scanned_bytes(frame)
    if not len(files) or size >= UNKNOWN:
        return 0
    return size * (EXPANSION if str(files[0]).endswith(COMPRESSED) else 1)


def _system(spark: SparkSession, path: str):
    """A path on the Java side, and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    """Contents of a small text file."""
    found, system = _system(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole small file in place unless there is one; False if there was.

    Of several callers at once exactly one gets True, and no reader sees half a file: the text
    is written beside the path first, then linked (local files) or renamed without overwriting,
    which file systems such as HDFS do in one step.
    """
    jvm = spark._jvm
    target, system = _system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getUri().getScheme() == "file":
            ends = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), _strings(spark)) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*ends)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                system.getUri(), spark._jsc.hadoopConfiguration()
            )
            keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            keep[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(draft, target, keep)
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(draft, False)


def _strings(spark: SparkSession):
    """An empty Java string array, for varargs."""
    return spark.sparkContext._gateway.new_array(spark._jvm.String, 0)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables in the cluster's shared folder.

    The folder is the one named by ``spark.checkpoint.dir``, or the checkpoint folder the
    session was given in code. Without either a local master gets a temporary folder; a
    cluster, where that would be one machine's disk, an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return join(shared, f"txnkpi-{uuid.uuid4().hex}", name)
