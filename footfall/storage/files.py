"""Directory operations through Hadoop's file system, so any cluster store works."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Makes a directory that goes with all in it when the driver ends."""
    fs, target = _open(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, destination = _open(spark, target)
    fs.mkdirs(destination.getParent())
    _, origin = _open(spark, source)
    if not fs.rename(origin, destination):
        raise OSError(f"cannot move {source} to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a directory; nothing if there is none."""
    fs, root = _open(spark, path)
    if not fs.exists(root):
        return []
    return sorted(entry.getPath().getName() for entry in fs.listStatus(root))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a directory."""
    fs, root = _open(spark, path)
    return fs.getContentSummary(root).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; stops if it is there already."""
    fs, target = _open(spark, path)
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative names of the partition directories ``depth`` levels below ``path``."""
    fs, root = _open(spark, path)
    if not fs.exists(root):
        return []
    names = [""]
    for _ in range(depth):
        names = [
            f"{name}/{entry.getPath().getName()}" if name else entry.getPath().getName()
            for name in names
            for entry in fs.listStatus(_open(spark, f"{path}/{name}" if name else path)[1])
            if entry.isDirectory() and "=" in entry.getPath().getName()
        ]
    return sorted(names)


def shared_folder(spark: SparkSession) -> str:
    """The path of a new table in the folder that the cluster shares between its machines.

    The cluster names the folder in ``spark.checkpoint.dir``. Only a local session, whose
    machine is the whole cluster, may go without. The table goes when the driver ends.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="footfall-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        context.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/footfall-{uuid4().hex}"
    delete_at_exit(spark, folder)
    return f"{folder}/table"
