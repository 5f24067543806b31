"""Packing documents into token sequences at a fixed mixture of sources.

Each source is a queue of ids (its documents one after the other, cut freely).
Every window of ``size`` ids takes from each queue what brings the source
closest to its target share of all ids served so far: a deficit round robin in
which a source's deficit after any number of windows is a function of that
number alone. A source with weight w is due to serve its i-th id (counted from
0) at time (i + 1/2) / w; the ids served in the first N are the N with the
earliest times, ties going to the source that comes first. So any task can work
out any window's cuts by itself, deficits carry over windows and partitions
without a sequential pass, and a queue that ends leaves its share to the others.

All windows but the last are full. The last is cut into sequences whose lengths
are powers of two, so nothing is padded at all.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, blocks, frugal, stored
from .tokens import ChunkEncoder, loaded, vocabulary

SIZE = 4096
END_ID = 2


class Mixture:
    """Cuts of the queues: how many ids each source has served after so many windows."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, size: int = SIZE):
        self.n, self.w, self.size = totals.astype(np.int64), weights.astype(np.float64), size
        self.total = int(self.n.sum())
        self.windows = -(-self.total // size)
        # Queues end one after the other; between two ends the served ids grow in a straight line of time.
        ends = np.sort(self.n / self.w)
        self.time = np.concatenate([[0.0], ends])
        self.ids = np.minimum(self.n[None, :], self.time[:, None] * self.w[None, :]).sum(1)

    def served(self, window: np.ndarray) -> np.ndarray:
        """A row per window number, a column per source."""
        due = np.minimum(window.astype(np.int64) * self.size, self.total)
        t = np.interp(due, self.ids, self.time)
        a = np.clip(np.floor(t[:, None] * self.w + 0.5).astype(np.int64), 0, self.n)
        # Rounding leaves a few ids too many or too few: give to the earliest next, take from the latest last.
        while True:
            off = due - a.sum(1)
            more, less = np.flatnonzero(off > 0), np.flatnonzero(off < 0)
            if not len(more) and not len(less):
                break
            if len(more):
                nxt = np.where(a[more] < self.n, (a[more] + 0.5) / self.w, np.inf)
                a[more, nxt.argmin(1)] += 1
            if len(less):
                last = np.where(a[less] > 0, (a[less] - 0.5) / self.w, -np.inf)
                pick = last.shape[1] - 1 - last[:, ::-1].argmax(1)
                a[less, pick] -= 1
        # The ids served must be the earliest ones: exchange any that are out of order.
        while True:
            nxt = np.where(a < self.n, (a + 0.5) / self.w, np.inf)
            last = np.where(a > 0, (a - 0.5) / self.w, -np.inf)
            give, take = nxt.argmin(1), last.shape[1] - 1 - last[:, ::-1].argmax(1)
            rows = np.arange(len(a))
            wrong = (nxt[rows, give] < last[rows, take]) | ((nxt[rows, give] == last[rows, take]) & (give < take))
            if not wrong.any():
                return a
            a[rows[wrong], give[wrong]] += 1
            a[rows[wrong], take[wrong]] -= 1

    def window_near(self, source: int, position: int) -> int:
        """A window at or before the one that serves this id of this source."""
        served = np.interp((position + 0.5) / self.w[source], self.time, self.ids)
        return max(0, int(served) // self.size - 1 - len(self.n) // self.size)

    def tail(self) -> list[tuple[int, int]]:
        """(offset, length) of the last window's sequences; empty if it is full."""
        left, out, at = self.total % self.size, [], 0
        for b in reversed(range(left.bit_length())):
            if left >> b & 1:
                out.append((at, 1 << b))
                at += 1 << b
        return out


class _Cuts:
    """Windows of one source from some number on, worked out in runs as they are needed."""

    RUN = 256

    def __init__(self, mix: Mixture, source: int, position: int):
        self.mix, self.source, self.next = mix, source, mix.window_near(source, position)
        self.window, self.lo, self.hi, self.offset = (np.empty(0, np.int64) for _ in range(4))

    def covering(self, start: int, end: int):
        """(window, first id, end, offset of the first id) of the windows that serve ids start..end-1."""
        keep = self.hi > start
        self.window, self.lo, self.hi, self.offset = self.window[keep], self.lo[keep], self.hi[keep], self.offset[keep]
        while (not len(self.hi) or self.hi[-1] < end) and self.next < self.mix.windows:
            w = np.arange(self.next, min(self.next + self.RUN, self.mix.windows) + 1)
            a = self.mix.served(w)
            took = np.diff(a, axis=0)
            s = self.source
            new = (w[:-1], a[:-1, s], a[1:, s], took[:, :s].sum(1))
            use = (new[2] > new[1]) & (new[2] > start)
            self.window, self.lo, self.hi, self.offset = (np.concatenate([old, x[use]]) for old, x in zip((self.window, self.lo, self.hi, self.offset), new))
            self.next = int(w[-1])
        use = (self.lo < end) & (self.hi > start)
        return zip(self.window[use].tolist(), self.lo[use].tolist(), self.hi[use].tolist(), self.offset[use].tolist())


def _tokenised(path: str, spaces: bool, end_id: int):
    def run(batches):
        enc = loaded(ChunkEncoder, path, spaces)
        part, at = TaskContext.get().partitionId(), {}
        for batch in batches:
            docs, texts, sources = (batch.column(i).to_pylist() for i in range(3))
            ids, n, start = [], [], []
            for group in blocks(iter(zip(texts, sources)), lambda r: len(r[0] or "")):
                flat, per = enc.encode([t or "" for t, _ in group])
                ends = np.concatenate([[0], np.cumsum(per)])
                for (_, s), a, b in zip(group, ends, ends[1:]):
                    ids.append(np.append(flat[a:b], np.uint16(end_id)).tobytes())
                    n.append(int(b - a) + 1)
                    start.append(at.get(s, 0))
                    at[s] = start[-1] + n[-1]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(sources, pa.string()), pa.array([part] * len(docs), pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "source", "part", "start", "n", "ids"])

    return run


def _pieces(mix: Mixture, number: dict):
    tail = mix.tail()

    def run(batches):
        cuts: dict = {}
        for batch in batches:
            out = []
            for doc, source, queue, n, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ids = np.frombuffer(raw, np.uint16).astype("<u4")
                key = number[source]
                own = cuts.get(key)
                if own is None or own[1] > queue:  # positions of a source grow within a run of rows; a step back starts anew
                    own = cuts[key] = [_Cuts(mix, key, queue), queue]
                own[1] = queue
                for window, lo, hi, offset in own[0].covering(queue, queue + n):
                    a, b = max(lo, queue), min(hi, queue + n)
                    at, seq = offset + a - lo, window
                    if tail and window == mix.windows - 1:
                        for k, (first, size) in enumerate(tail):
                            x, y = max(at, first), min(at + b - a, first + size)
                            if x < y:
                                p = a + x - at - queue
                                out.append((doc, p, y - x, zlib.crc32(ids[p:p + y - x]), n, seq + k, x - first, source))
                    else:
                        out.append((doc, a - queue, b - a, zlib.crc32(ids[a - queue:b - queue]), n, seq, at, source))
            kinds = [pa.int64()] * 7 + [pa.string()]
            cols = zip(*out) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_NAMES)

    return run


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: dict | None = None,
         size: int = SIZE, vocabulary_path: str | None = None, spaces: bool = False, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    ``weights``: target share by source (need not add up to 1); without them a
    source's share is its share of all ids. Sources missing from ``weights``
    weigh what their ids would. Every id of every document, with ``end_id``
    after each, lies in exactly one piece. Null and empty texts have the end id
    alone. A null source is a source of its own. Null and repeated ids change
    nothing: each row is packed by itself. Other columns are not read. An empty
    table gives an empty result. A row per source goes through the driver.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    plain = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.col(source_col).cast("string"))
    tokens = stored(plain.mapInArrow(frugal(_tokenised(vocabulary_path or vocabulary("word_bpe_49k.json"), spaces, end_id), 1),
                                     "doc_id long, source string, part long, start long, n long, ids binary"), "packing/tokens")
    # Where each task's run of a source begins in the source's queue.
    runs = tokens.groupBy("part", "source").agg(F.sum("n").alias("all"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(runs.select("part", "source", "all", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base")), "packing/runs")
    totals = sorted(((r[0], int(r[1])) for r in base.groupBy("source").sum("all").collect()), key=lambda r: (r[0] is not None, r[0] or ""))
    if not totals:
        return spark.createDataFrame([], PIECES)
    ids = np.array([n for _, n in totals])
    w = ids.astype(float)
    if weights:
        given = np.array([float(weights.get(s, np.nan)) for s, _ in totals])
        w = np.where(np.isnan(given), ids / ids.sum() * np.nansum(given), given)
        if (w <= 0).any():
            raise ValueError("weights must be over 0")
    mix = Mixture(ids, w / w.sum(), size)
    b = base.select(F.col("part").alias("_part"), F.col("source").alias("_source"), "base")
    placed = tokens.join(b, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", (F.col("base") + F.col("start")).alias("queue"), "n", "ids")
    return placed.mapInArrow(frugal(_pieces(mix, {s: i for i, (s, _) in enumerate(totals)})), PIECES)
