"""Token ids in files under a static range asymmetric numeral system.

One frequency table, made from all ids of the corpus, is shared by all blocks.
A block holds whole documents and can be decoded by itself: its lanes take its
ids in turn, each lane with its own state, and put their 32-bit words into one
stream. The checkpoint of a block (file, offset, size, documents, ids) is a row
of the manifest, so blocks are decoded in parallel from any place on. Block and
table carry checksums.

File: ``MAGIC``, blocks, directory (JSON of the blocks' checkpoints), its length
and checksum. Block: header of five unsigned 32-bit numbers (documents, ids,
lanes, words, checksum of what follows), document ids (signed 64 bits) with a
null bitmap byte each, ids per document (32 bits), lane states (64 bits), words.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import run_dir
from .common import arrow_batches, blocks, stored
from .files import open_file, whole_file
from .tokens import ChunkEncoder, loaded, vocabulary

MAGIC = b"RANSIDS1"
SCALE = 20  # the table's frequencies add up to 2**SCALE
LOW = 31  # states lie in [2**LOW, 2**(LOW + 32))
LANES = 1024
BLOCK_IDS = 1 << 18  # a block is closed when it has so many ids
END_ID = 2

_U = np.uint64
_HEAD = struct.Struct("<5I")


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to add up to 2**SCALE; every id that occurs keeps 1 at least."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.int64)
    f = np.where(counts > 0, np.maximum(1, counts * (1 << SCALE) // total), 0).astype(np.int64)
    left = (1 << SCALE) - int(f.sum())
    if left > 0:
        f[int(counts.argmax())] += left
    while left < 0:  # rounding up of rare ids: taken back from frequent ones, in proportion
        room = np.maximum(f - 1, 0)
        take = np.minimum(room, room * -left // int(room.sum()) + (np.arange(len(f)) == int(room.argmax())))
        take = np.minimum(take, np.maximum(0, -left - (np.cumsum(take) - take)))
        f -= take
        left += int(take.sum())
    return f


class Coder:
    """Encodes and decodes blocks of ids under one table."""

    def __init__(self, f: np.ndarray):
        self.f = f.astype(_U)
        self.c = (np.cumsum(f) - f).astype(_U)
        self.symbol = np.repeat(np.arange(len(f), dtype=np.uint16), f)

    def encode(self, ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Lanes, lane states and words."""
        lanes = int(min(LANES, max(1, len(ids) // 256)))
        x = np.full(lanes, 1 << LOW, _U)
        f, c = self.f[ids], self.c[ids]
        top, rest = f << _U(LOW - SCALE + 32), _U(1 << SCALE) - f
        words = []
        for at in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
            row = slice(at, min(at + lanes, len(ids)))
            own = x[: row.stop - at]
            out = np.flatnonzero(own >= top[row])
            over = own[out]
            words.append(over.astype(np.uint32))
            own[out] = over >> _U(32)
            own += own // f[row] * rest[row] + c[row]  # (own // f << SCALE) + own % f + c
        return lanes, x, np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)

    def decode(self, n: int, x: np.ndarray, words: np.ndarray) -> np.ndarray:
        lanes, x, words = len(x), x.copy(), words.astype(_U)
        ids, p, mask = np.empty(n, np.uint16), 0, _U((1 << SCALE) - 1)
        for at in range(0, n, lanes):
            stop = min(at + lanes, n)
            own = x[: stop - at]
            slot = own & mask
            s = self.symbol[slot]
            ids[at:stop] = s
            own = self.f[s] * (own >> _U(SCALE)) + slot - self.c[s]
            need = np.flatnonzero(own < _U(1 << LOW))
            own[need] = (own[need] << _U(32)) | words[p:p + len(need)]
            p += len(need)
            x[: stop - at] = own
        if p != len(words) or (x != _U(1 << LOW)).any():
            raise ValueError("block does not decode to its end")
        return ids


def pack_block(coder: Coder, docs: list, per: np.ndarray, ids: np.ndarray) -> bytes:
    lanes, x, words = coder.encode(ids)
    known = np.array([d is not None for d in docs], np.uint8)
    body = b"".join([np.array([d or 0 for d in docs], "<i8").tobytes(), known.tobytes(), per.astype("<u4").tobytes(), x.astype("<u8").tobytes(), words.astype("<u4").tobytes()])
    return _HEAD.pack(len(docs), len(ids), lanes, len(words), zlib.crc32(body)) + body


def unpack_block(coder: Coder, raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, ids per document, ids."""
    n_docs, n, lanes, n_words, crc = _HEAD.unpack_from(raw)
    body = memoryview(raw)[_HEAD.size:]
    if zlib.crc32(body) != crc or len(body) != 13 * n_docs + 8 * lanes + 4 * n_words:
        raise ValueError("block checksum is wrong")
    at = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    docs, known, per = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    x, words = take("<u8", lanes), take("<u4", n_words)
    return [int(d) if k else None for d, k in zip(docs, known)], per.astype(np.int64), coder.decode(n, x, words)


def token_table(docs: DataFrame, id_col: str, text_col: str, path: str, spaces: bool, end_id: int = END_ID, extra: list[str] | None = None) -> DataFrame:
    """(doc_id, ids: unsigned 16-bit ids with the end id, further columns) of whole texts, written once."""
    extra = extra or []
    arrow_batches(docs.sparkSession)

    def run(batches):
        enc = loaded(ChunkEncoder, path, spaces)
        for batch in batches:
            out = []
            for part in blocks(iter(batch.column(1).to_pylist()), lambda t: len(t or "")):
                flat, per = enc.encode([t or "" for t in part])
                raw = np.insert(flat, np.cumsum(per), end_id).tobytes()
                ends = [0, *(2 * np.cumsum(per + 1)).tolist()]
                out += [raw[a:b] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), *[batch.column(2 + i) for i in range(len(extra))]], names=["doc_id", "ids", *extra])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)
    kinds = "".join(f", {c} {plain.schema[c].dataType.simpleString()}" for c in extra)
    return stored(plain.mapInArrow(run, f"doc_id long, ids binary{kinds}"), "tokens")


def _counted(batches):
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        lists = [x for x in batch.column(0).to_pylist() if x]
        for some in blocks(iter(lists), len):
            total += np.bincount(np.frombuffer(b"".join(some), np.uint16), minlength=1 << 16)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])


def write_ids(tokens: DataFrame, folder: str) -> DataFrame:
    """Write a token table's ids in ascending doc_id order (nulls first) and return the manifest, a row per block."""
    spark = tokens.sparkSession
    counts = np.zeros(1 << 16, np.int64)
    for r in tokens.select("ids").mapInArrow(_counted, "id long, n long").groupBy("id").sum("n").collect():  # a row per id of the vocabulary
        counts[r[0]] = r[1]
    f = frequencies(counts)
    table = f.astype("<u4").tobytes()
    with whole_file(folder, "table.bin") as out:
        out.write(struct.pack("<II", len(f), zlib.crc32(table)) + table)

    def write(batches):
        coder = Coder(read_table(folder))
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}.rans"
        rows = ((d, np.frombuffer(x, np.uint16)) for b in batches for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        made = []
        with whole_file(folder, name) as out:
            out.write(MAGIC)
            at = len(MAGIC)
            for group in blocks(rows, lambda r: len(r[1]), BLOCK_IDS):
                per = np.array([len(x) for _, x in group], np.int64)
                raw = pack_block(coder, [d for d, _ in group], per, np.concatenate([x for _, x in group]))
                out.write(raw)
                made.append((part, name, len(made), at, len(raw), len(group), int(per.sum())))
                at += len(raw)
            directory = json.dumps([m[2:] for m in made]).encode()
            out.write(directory + struct.pack("<QI", len(directory), zlib.crc32(directory)))
        cols = list(zip(*made)) if made else [[] for _ in range(7)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 1 else pa.int64()) for i, c in enumerate(cols)], names=["part", "file", "block", "offset", "size", "docs", "ids"])

    ordered = tokens.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stored(ordered.mapInArrow(write, "part long, file string, block long, offset long, size long, docs long, ids long"), "rans/manifest")


def read_table(folder: str) -> np.ndarray:
    with open_file(folder, "table.bin") as src:
        raw = src.read()
    n, crc = struct.unpack_from("<II", raw)
    if zlib.crc32(raw[8:]) != crc or len(raw) != 8 + 4 * n:
        raise ValueError("frequency table checksum is wrong")
    return np.frombuffer(raw, "<u4", n, 8).astype(np.int64)


def checkpoints(folder: str, name: str) -> list[list[int]]:
    """A file's own directory: block, offset, size, documents and ids of each block."""
    with open_file(folder, name) as src:
        end = src.size()
        src.seek(end - 12)
        n, crc = struct.unpack("<QI", src.read(12))
        src.seek(end - 12 - n)
        raw = src.read(n)
    if zlib.crc32(raw) != crc:
        raise ValueError("directory checksum is wrong")
    return json.loads(raw)


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Decode every block of a manifest: doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("all")).select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = manifest.join(parts, "part").select("file", "offset", "size", (F.col("base") + F.coalesce(F.sum("ids").over(inner), F.lit(0))).alias("first"))

    def decode(batches):
        coder = None
        for batch in batches:
            for file, offset, size, first in zip(*(batch.column(i).to_pylist() for i in range(4))):
                coder = coder or Coder(read_table(folder))
                with open_file(folder, file) as src:
                    src.seek(offset)
                    docs, per, ids = unpack_block(coder, src.read(size))
                wide, ends = ids.astype("<u4"), np.concatenate([[0], np.cumsum(per)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(first + ends[:-1], pa.int64()), pa.array(per, pa.int64()),
                    pa.array([zlib.crc32(wide[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return at.repartition(n).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None, spaces: bool = True) -> DataFrame:
    """Encode whole texts, write the ids as files, read the files back: a row per document.

    Null and empty texts have the end id alone. Null ids come first in the
    order; rows that share an id stand next to each other, in any order. Other
    columns are not read. An empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    folder = run_dir(spark, "rans/files")
    tokens = token_table(docs, id_col, text_col, vocabulary_path or vocabulary("byte_bpe_50k.json"), spaces)
    return read_ids(write_ids(tokens, folder), folder)
