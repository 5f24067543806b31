"""Small files beside the data: published whole, and only once under a name.

The rows of a job never pass through here; these are commit records, chunk
plans and manifests, written by the driver. ``publish`` is the one atomic step
that runs compete for: of several writers of one name exactly one succeeds,
and what it wrote appears whole. Files of a ``file:`` path (a shared mount) are
linked to their name, which fails if the name is taken; on other Hadoop file
systems a renaming without overwriting does the same (atomic on HDFS).
"""

from __future__ import annotations

import os
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    """(Hadoop file system, qualified path, local path or None)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    q = fs.makeQualified(p)
    return fs, q, q.toUri().getPath() if q.toUri().getScheme() == "file" else None


def local_path(spark: SparkSession, path: str) -> str | None:
    """Path on a mounted file system, or None where ``path`` lies elsewhere."""
    return _opened(spark, path)[2]


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make ``path`` with this content; False (and nothing done) if there is such a file."""
    fs, q, local = _opened(spark, path)
    data = text.encode()
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}.tmp")
        with open(part, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(part, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
    part = spark._jvm.org.apache.hadoop.fs.Path(q.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(part, True)
    out.write(bytearray(data))
    out.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    none = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
    try:
        jvm.FileContext.getFileContext(q.toUri(), spark._jsc.hadoopConfiguration()).rename(part, q, none)
        return True
    except Py4JJavaError as e:
        fs.delete(part, False)
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def make_folder(spark: SparkSession, path: str) -> None:
    fs, q, _ = _opened(spark, path)
    fs.mkdirs(q)


def files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, size) of a folder's own visible files, by name; none if there is no such folder."""
    fs, q, _ = _opened(spark, folder)
    if not fs.exists(q):
        return []
    found = [(s.getPath().getName(), s.getPath().toString(), int(s.getLen())) for s in fs.listStatus(q) if s.isFile()]
    return [(path, size) for name, path, size in sorted(found) if not name.startswith(("_", "."))]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that this library wrote."""
    fs, q, _ = _opened(spark, path)
    fs.delete(q, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished file its name, in place of an older one."""
    fs, q, local = _opened(spark, target)
    if local is not None:
        os.replace(local_path(spark, source), local)
        return
    if fs.exists(q):
        fs.delete(q, False)
    if not fs.rename(_opened(spark, source)[1], q):
        raise OSError(f"can't rename {source} to {target}")


def truncate(spark: SparkSession, path: str, size: int) -> None:
    """Cut a file to ``size`` bytes (HDFS)."""
    fs, q, _ = _opened(spark, path)
    done = fs.truncate(q, size)
    while not done:  # the last block is being recovered
        time.sleep(0.5)
        done = fs.isFileClosed(q)


def concat(spark: SparkSession, target: str, parts: list[str]) -> None:
    """Append whole files to ``target`` by the file system itself (HDFS), without reading them."""
    fs, q, _ = _opened(spark, target)
    paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, p in enumerate(parts):
        paths[i] = _opened(spark, p)[1]
    fs.concat(q, paths)


def write(spark: SparkSession, path: str, text: str) -> None:
    """A small file by the driver, replacing an older one."""
    fs, q, _ = _opened(spark, path)
    out = fs.create(q, True)
    out.write(bytearray(text.encode()))
    out.close()
