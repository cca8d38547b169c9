"""File-system steps through Hadoop's own interface, so that they reach any
store Spark reads (and nothing but file names passes the driver)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder (none if it does not exist)."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def move(spark: SparkSession, path: str, folder: str, suffix: str = "") -> None:
    """Move a file into ``folder`` (made if needed) under its name + ``suffix``."""
    fs, p = _at(spark, path)
    _, to = _at(spark, folder)
    fs.mkdirs(to)
    target = spark._jvm.org.apache.hadoop.fs.Path(to, p.getName() + suffix)
    if not fs.rename(p, target):
        raise OSError(f"could not move {path} to {target}")


def remove(spark: SparkSession, folder: str) -> None:
    fs, p = _at(spark, folder)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength()


def write_text(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small text file (a header, say) through Hadoop's file system."""
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    out.write("".join(f"{line}\n" for line in lines).encode("utf-8"))
    out.close()


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.
    A local session without that setting gets a temporary folder; a cluster
    session must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='cardwatch-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
