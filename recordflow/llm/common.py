"""Helpers shared by the operators: written intermediate tables, words and hashes in numpy."""

from __future__ import annotations

import ctypes
import io
import os
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ..session import run_dir
from ..storage import delete
from .files import open_folder, whole_file

ARROW_ROWS = 512  # rows of one Arrow batch: bounds a task's memory with long texts
BLOCK_BYTES = 1 << 20  # texts are worked on in blocks of about this size

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session's application, once."""
    sc = spark.sparkContext
    if getattr(sc, "_recordflow_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(root)))
    folder = run_dir(spark, "code")
    with whole_file(folder, "recordflow.zip") as out:
        out.write(raw.getvalue())
    system, path = open_folder(folder)
    sc.addPyFile(f"{folder}/recordflow.zip" if "://" in folder or folder.startswith("file:") else f"{path}/recordflow.zip")
    sc._recordflow_shipped = True


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Let Arrow batches of this session hold ``rows`` rows at most, and its workers import this package."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


_open: list[list[str]] = []  # written tables of the blocks that are open, innermost last


def stored(df: DataFrame, kind: str, keep: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe against lost executors.

    Inside a ``temporary`` block the table goes when the block ends, unless it is to ``keep``.
    """
    spark = df.sparkSession
    path = run_dir(spark, kind)
    df.write.parquet(path)
    if _open and not keep:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, kind: str, *measures: Column) -> tuple[DataFrame, dict]:
    """``df`` stored, and aggregates of its rows by name, taken by the run that writes them."""
    seen = Observation()
    out = stored(df.observe(seen, *measures), kind)
    return out, seen.get


@contextmanager
def temporary(spark: SparkSession):
    """Removes the tables stored inside, whose last use must be inside as well."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)


def blocks(rows: Iterator[tuple], size_of, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Rows in lists whose sizes add up to about ``limit``; a larger row stands alone."""
    out, size = [], 0
    for r in rows:
        n = size_of(r)
        if out and size + n > limit:
            yield out
            out, size = [], 0
        out.append(r)
        size += n
    if out:
        yield out


def give_back() -> None:
    """Return memory that this process has freed, but its allocators still hold, to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # a C library without it
        pass


def frugal(run: Callable, every: int = 4) -> Callable:
    """``run`` (batches to batches), giving freed memory back after every few batches and at its end.

    A worker goes on to other tasks; what its allocators keep from the largest
    blocks of each kind would add up beside the executor's heap.
    """
    def bounded(batches):
        try:
            for k, out in enumerate(run(batches), 1):
                yield out
                if k % every == 0:
                    del out
                    give_back()
        finally:
            give_back()

    return bounded


def class_table(word_bytes: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(word_bytes)] = True
    return t


# The two word classes of the contracts, by UTF-8 byte.
NOT_SPACE = class_table(bytes(b for b in range(256) if b not in b" \t\n\x0b\x0c\r"))
WORD_CHARS = class_table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased, all else as it is; empty for null."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def mix(z: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit changes every output bit."""
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


class Words:
    """The words of several texts, in a row: start, end (bytes of the block), hash and text number of each."""

    def __init__(self, texts: list[bytes], member: np.ndarray = NOT_SPACE, want_hash: bool = True):
        self.texts = texts
        self.buf = b"\n".join(texts) + b"\n" + bytes(8)
        b = np.frombuffer(self.buf, np.uint8)
        inside = member[b]
        inside[-9:] = False
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.start, self.end = edge[0::2], edge[1::2]
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(sizes)])  # of each text in the block
        self.first = np.searchsorted(self.start, self.offset)  # first word of each text, and the number of words
        self.per = np.diff(self.first)
        if want_hash:
            self.hash = hash_slices(b, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.per)


def hash_slices(b: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hashes of slices of ``b``, which goes on for 8 bytes after the last."""
    size = (end - start).astype(np.int64)
    h = mix(size.astype(_U) + _U(seed))
    if not len(start):
        return h
    eight = np.lib.stride_tricks.sliding_window_view(b, 8)
    at = np.arange(len(start))
    done = 0
    while len(at):
        x = np.ascontiguousarray(eight[start[at] + done]).view("<u8").ravel()
        left = np.minimum(size[at] - done, 8).astype(_U)
        x &= _U(0xFFFFFFFFFFFFFFFF) >> (_U(64) - _U(8) * left)
        h[at] = mix(h[at] ^ (x * _U(0xD6E8FEB86659FD93)))
        done += 8
        at = at[size[at] > done]
    return h


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words that lie in one text (a shorter text: its whole run), and their number by text."""
    per = np.where(words.per >= k, words.per - (k - 1), np.minimum(words.per, 1))
    at = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum())
    left = np.repeat(np.minimum(words.per, k), per)
    h = mix(left.astype(_U) + _U(0x51_7CC1B727220A95))
    w = words.hash
    for j in range(k):
        use = left > j
        if use.all():
            h = mix(h ^ w[at + j])
        else:
            h[use] = mix(h[use] ^ w[at[use] + j])
    return h, per
