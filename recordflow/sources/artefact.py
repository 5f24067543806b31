"""One file put together from ordered part files, by position.

Each part's place in the file follows from the sizes of the parts before it,
so the parts can be brought there independently of one another. On a mounted
file system that executors share, tasks copy pieces of the parts to their
places in a file made beforehand; a piece that is copied again writes the same
bytes. On HDFS the file system joins the parts itself, without reading them.
The driver sees the names and sizes of the parts only. The file gets its name
when it is whole, and the parts are removed then.
"""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import storage

PIECE = 256 << 20  # bytes that one task copies


def _copier(target: str):
    def copy(batches):
        import os

        for batch in batches:
            done = []
            with open(target, "r+b") as out:
                for path, start, place, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    left = size
                    with open(path, "rb") as part:
                        part.seek(start)
                        out.seek(place)
                        while left:
                            data = part.read(min(left, 8 << 20))
                            if not data:
                                raise OSError(f"{path} is shorter than it was")
                            out.write(data)
                            left -= len(data)
                    done.append(size)
                out.flush()
                os.fsync(out.fileno())
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["n"])

    return copy


def assemble(spark: SparkSession, folder: str, target: str, head: str = "", tail: str = "", drop_last: int = 0, piece: int = PIECE) -> int:
    """Make ``target`` from ``head``, the part files of ``folder`` in name order without the last ``drop_last`` bytes, and ``tail``; its size."""
    parts = [(p, size) for p, size in storage.files(spark, folder) if size]
    first, last = head.encode(), tail.encode()
    total = len(first) + sum(size for _, size in parts) - drop_last + len(last)
    made = f"{os.path.dirname(target)}/.{os.path.basename(target)}.{uuid.uuid4().hex}.tmp"
    local = storage.local_path(spark, made)
    if local is None:
        _joined(spark, parts, made, head, tail, drop_last)
    else:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as f:
            f.write(first)
            f.truncate(total)
            f.seek(total - len(last))
            f.write(last)
        rows, place = [], len(first)
        for i, (path, size) in enumerate(parts):
            size -= drop_last if i == len(parts) - 1 else 0
            rows += [(storage.local_path(spark, path), at, place + at, min(piece, size - at)) for at in range(0, size, piece)]
            place += size
        if rows:
            pieces = spark.createDataFrame(rows, "path string, start long, place long, size long").repartition(min(len(rows), 1 << 14))
            copied = pieces.mapInArrow(_copier(local), "n long").agg(F.sum("n")).first()[0]
            if copied != total - len(first) - len(last):
                raise OSError(f"{copied} bytes of {target} were copied instead of {total - len(first) - len(last)}")
    storage.rename(spark, made, target)
    storage.delete(spark, folder)
    return total


def _joined(spark: SparkSession, parts: list[tuple[str, int]], made: str, head: str, tail: str, drop_last: int) -> None:
    if parts and drop_last:
        storage.truncate(spark, parts[-1][0], parts[-1][1] - drop_last)
    storage.write(spark, made, head)
    ends = f"{made}.tail"
    storage.write(spark, ends, tail)
    storage.concat(spark, made, [p for p, _ in parts] + [ends])
