"""Benchmark decontamination with an FM-index over the words of each training shard.

A shard is a run of whole documents of one task. Words that no benchmark item
has can't be part of an occurrence; neither can a run of benchmark words that
is shorter than the shortest window. Both become separators, and what is left
is the shard's word string. Its suffix array gives the Burrows-Wheeler string;
a wavelet tree answers rank queries on it. All windows are searched backwards
at once. Occurrences are located by walking to the next sampled suffix
position, turned into spans, and merged by document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_CHARS, Words, arrow_batches, blocks, frugal, lower_ascii, stored

WINDOW = 10  # words
SHARD_BYTES = 4 << 20  # text of one shard
SAMPLE = 16  # every 16th position of the word string is kept
GROUP_BYTES = 16 << 20  # benchmark text whose windows are sent to the tasks at once; more text makes more groups

_U = np.uint64


class WaveletTree:
    """Rank of any symbol at any place, one bit array per bit of the symbols (a wavelet matrix)."""

    def __init__(self, s: np.ndarray, bits: int):
        self.bits, self.zeros, self.ones = bits, [], []
        for b in range(bits - 1, -1, -1):
            bit = (s >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(s) - int(self.ones[-1][-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before place ``i``."""
        lo, hi = np.zeros_like(i), i
        for level in range(self.bits):
            one, z = self.ones[level], self.zeros[level]
            bit = (symbol >> (self.bits - 1 - level)) & 1
            a, b = one[lo], one[hi]
            lo, hi = np.where(bit == 1, z + a, lo - a), np.where(bit == 1, z + b, hi - b)
        return hi - lo

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place ``i``, and how often it stands before."""
        lo, out = np.zeros_like(i), np.zeros_like(i)
        for level in range(self.bits):
            one, z = self.ones[level], self.zeros[level]
            bit = one[i + 1] - one[i]
            out = out * 2 + bit
            a, b = one[lo], one[i]
            lo, i = np.where(bit == 1, z + a, lo - a), np.where(bit == 1, z + b, i - b)
        return out, i - lo


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``s`` by doubling; only ranks that are still tied are sorted again."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    key = s[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    k = 1
    while not head.all():
        # Groups of tied suffixes: sort their members by the rank k places on.
        tied = ~(head & np.append(head[1:], True))
        at = np.flatnonzero(tied)
        pos = order[at]
        nxt = np.where(pos + k < n, rank[np.minimum(pos + k, n - 1)], -1)
        group = rank[pos]
        again = np.lexsort((nxt, group))
        order[at] = pos[again]
        g, x = group[again], nxt[again]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (x[1:] != x[:-1])])
        head[at] = new
        rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        k *= 2
    return order


class FMIndex:
    """Backward search and location in a string of symbols >= 1; 0 ends it."""

    def __init__(self, s: np.ndarray, symbols: int):
        s = np.append(s, 0)
        self.n = len(s)
        sa = suffix_array(s)
        bwt = s[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])
        self.tree = WaveletTree(bwt, max(1, int(symbols - 1).bit_length()))
        self.marked = sa % SAMPLE == 0
        self.marks = np.concatenate([[0], np.cumsum(self.marked)])
        self.sampled = sa[self.marked]

    def search(self, phrases: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each row of ``phrases`` (padded on the left)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            live = live[(size[live] >= phrases.shape[1] - j) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = phrases[live, j]
            lo[live] = self.before[c] + self.tree.rank(c, lo[live])
            hi[live] = self.before[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by steps back to a sampled one."""
        out = np.empty(len(row), np.int64)
        at, i = np.arange(len(row)), row.copy()
        step = 0
        while len(at):
            hit = self.marked[i]
            out[at[hit]] = self.sampled[self.marks[i[hit]]] + step
            at, i = at[~hit], i[~hit]
            symbol, rank = self.tree.at(i)
            i = self.before[symbol] + rank
            step += 1
        return out


class Phrases:
    """The benchmark's distinct windows over its own vocabulary, and the items each belongs to."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        texts = [lower_ascii(t) for _, t in items]
        w = Words(texts, WORD_CHARS)
        self.window, self.vocab = window, np.unique(w.hash) if len(w) else np.empty(0, _U)
        ids = np.searchsorted(self.vocab, w.hash) + 2 if len(w) else np.empty(0, np.int64)  # 0 ends, 1 separates
        # Every item's windows as rows, shorter ones padded on the left, then each window once.
        per = np.where(w.per > 0, np.maximum(w.per - window, 0) + 1, 0)
        owner = np.repeat(np.arange(len(items)), per)
        start = w.first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        size = np.minimum(w.per[owner], window)
        seat = np.arange(window)[None, :] - (window - size)[:, None]
        rows = np.where(seat >= 0, ids[np.minimum(start[:, None] + np.maximum(seat, 0), max(len(ids) - 1, 0))], 0) if len(owner) else np.empty((0, window), np.int64)
        self.rows, phrase = np.unique(rows, axis=0, return_inverse=True) if len(owner) else (rows, np.empty(0, np.int64))
        self.size = (self.rows > 0).sum(1)
        pairs = np.unique(np.stack([phrase.ravel(), owner], 1), axis=0)
        self.names = [item for item, _ in items]
        self.owners, self.owned_at = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        self.shortest = int(self.size.min()) if len(self.rows) else 0

    def items(self, phrase: int) -> set:
        """The items that a window belongs to."""
        return {self.names[k] for k in self.owners[self.owned_at[phrase]:self.owned_at[phrase + 1]]}


def spans(texts: list[bytes], phrases: Phrases) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a shard, and for each occurrence its first word and its phrase."""
    w = Words(texts, WORD_CHARS)
    none = np.empty(0, np.int64)
    if not len(w) or not len(phrases.size):
        return w, none, none
    at = np.minimum(np.searchsorted(phrases.vocab, w.hash), len(phrases.vocab) - 1)
    known = phrases.vocab[at] == w.hash
    # Runs of known words within one document that are long enough.
    text = w.text_of()
    broken = np.concatenate([[True], ~known[1:] | ~known[:-1] | (text[1:] != text[:-1])])
    run = np.cumsum(broken) - 1
    fits = known & (np.bincount(run)[run] >= phrases.shortest)
    word = np.flatnonzero(fits)
    if not len(word):
        return w, none, none
    gap = np.concatenate([[0], np.cumsum(run[word][1:] != run[word][:-1])])
    place = np.arange(len(word)) + gap
    s = np.ones(place[-1] + 1, np.int64)
    s[place] = at[word] + 2
    word_at = np.full(len(s) + 1, -1, np.int64)
    word_at[place] = word
    index = FMIndex(s, len(phrases.vocab) + 2)
    lo, hi = index.search(phrases.rows, phrases.size)
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(n)), n)
    row = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return w, word_at[index.locate(row)], which


def _shards(phrases, handle, width: int):
    def run(batches):
        p = phrases.value

        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(width)))

        for part in blocks(rows(), lambda r: len(r[width - 1] or ""), SHARD_BYTES):
            yield handle(part, p)

    return frugal(run, 1)


def _hits(texts: list[bytes], p: Phrases, earlier: list | None = None) -> tuple[Words, np.ndarray, list[set]]:
    """The words of a shard, which of them lie in an occurrence, and the items found in each text.

    ``earlier``: for each text what other phrase groups found: (first words, lengths, items) each, or None.
    """
    w, first, which = spans(texts, p)
    cover = np.zeros(len(w) + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + p.size[which] if len(which) else first, -1)
    items: list[set] = [set() for _ in texts]
    doc = np.searchsorted(w.first, first, side="right") - 1
    for d, k in np.unique(np.stack([doc, which], 1), axis=0) if len(which) else ():
        items[d].update(map(str, p.items(k)))
    for d, found in enumerate(earlier or []):
        for group in found or ():
            at = w.first[d] + np.array(group["first"], np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + np.array(group["size"], np.int64), -1)
            items[d].update(group["items"])
    return w, np.cumsum(cover[:-1]) > 0, items


def _found(part, p: Phrases) -> pa.RecordBatch:
    """A phrase group's runs of hit words and its items, for the rows that have any."""
    w, hit, items = _hits([lower_ascii(t) for _, t in part], p)
    out = []
    for k, (row, _) in enumerate(part):
        own = hit[w.first[k]:w.first[k + 1]]
        if own.any():
            edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            out.append((row, edge[0::2].tolist(), (edge[1::2] - edge[0::2]).tolist(), sorted(items[k])))
    cols = list(zip(*out)) if out else [[]] * 4
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["row", "first", "size", "items"])


def _report(part, p: Phrases) -> pa.RecordBatch:
    w, hit, items = _hits([lower_ascii(r[-1]) for r in part], p, [r[-2] for r in part])
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[w.first[1:]] - total[w.first[:-1]]
    names = [sorted(s) for s in items]
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in part], pa.int64()), pa.array(w.per, pa.int64()), pa.array(n_hit, pa.int64()),
        pa.array([len(x) for x in names], pa.int64()),
        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]), pa.array(n_hit > 0)],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _phrase_groups(benchmark: DataFrame, window: int, item_col: str, text_col: str):
    """The phrase groups one after the other, each made of a hash share of the items of about ``GROUP_BYTES`` and sent to the tasks."""
    b = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).where("item is not null and text is not null")
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // GROUP_BYTES))
    for g in range(count):
        own = b.where(F.pmod(F.xxhash64("item"), F.lit(count)) == g) if count > 1 else b
        yield benchmark.sparkSession.sparkContext.broadcast(Phrases([(r.item, r.text) for r in own.toLocalIterator()], window))


def _searched(docs: DataFrame, text_col: str, benchmark: DataFrame, window: int, item_col: str) -> tuple[DataFrame, str, object]:
    """(docs with a column of what all phrase groups but the last found, its name, the last group).

    With one group the column is null. With several, the rows are written once
    with numbers, each group is searched over all of them, and the runs found
    are gathered by row: at most one entry per group.
    """
    name = "found"
    while name in docs.columns or f"{name}_row" in docs.columns:
        name = f"_{name}"
    kind = "array<struct<first: array<bigint>, size: array<bigint>, items: array<string>>>"
    groups = list(_phrase_groups(benchmark, window, item_col, "text"))
    if len(groups) == 1:
        return docs.withColumn(name, F.lit(None).cast(kind)), name, groups[0]
    row = f"{name}_row"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "fm/rows")
    plain = rows.select(F.col(row), F.col(text_col).cast("string"))
    found = None
    for p in groups[:-1]:
        one = stored(plain.mapInArrow(_shards(p, _found, 2), "row long, first array<long>, size array<long>, items array<string>"), "fm/found")
        found = one if found is None else found.unionByName(one)
    gathered = found.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("first", "size", "items")).cast(kind).alias(name))
    return rows.join(gathered, row, "left").drop(row), name, groups[-1]


REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of ASCII letters and digits (A-Z lower-cased) and non-ASCII
    characters. A window is ``window`` consecutive words of an item; a shorter
    item is one window; an item without words is none. Null and empty texts
    have no words and aren't contaminated. Repeated rows are judged one by one.
    Items with a null id or text are left out. An empty benchmark hits nothing,
    an empty table gives an empty result. Texts of any length are read whole; a
    benchmark over ``GROUP_BYTES`` is searched group by group.
    """
    arrow_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows, found, last = _searched(plain, "text", benchmark, window, item_col)
    return rows.select("id", found, "text").mapInArrow(_shards(last, _report, 3), REPORT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", max_share: float = 1.0) -> DataFrame:
    """``docs`` with the merged spans of benchmark windows cut out of their texts.

    A cut goes from the first to the last character of a merged span; the text
    around it stays as it is. Rows whose words were hit by more than
    ``max_share`` are dropped (1.0: none). Null and empty texts stay as they
    are, each of several equal rows is cut alike, and an empty table or
    benchmark changes nothing. Texts of any length are read whole.
    """
    arrow_batches(docs.sparkSession)
    schema, names = docs.schema, docs.columns
    order = [*[c for c in names if c != text_col], text_col]
    rows, found, last = _searched(docs, text_col, benchmark, window, "item_id")

    def cut(part, p):
        w, hit, _ = _hits([lower_ascii(r[-1]) for r in part], p, [r[-2] for r in part])
        part = [(*r[:-2], r[-1]) for r in part]
        out = []
        for k, r in enumerate(part):
            own = hit[w.first[k]:w.first[k + 1]]
            if own.any():
                if own.mean() > max_share:
                    continue
                text, keep, at = r[-1].encode("utf-8", "surrogatepass"), [], 0
                edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                for a, b in zip(edge[0::2] + w.first[k], edge[1::2] + w.first[k] - 1):
                    keep.append(text[at:w.start[a] - w.offset[k]])
                    at = w.end[b] - w.offset[k]
                r = (*r[:-1], b"".join([*keep, text[at:]]).decode("utf-8", "surrogatepass"))
            out.append(r)
        cols = list(zip(*out)) if out else [[] for _ in order]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], names=order)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = list(to_arrow_schema(docs.select(*order).schema))
    cleaned = rows.select(*order[:-1], found, text_col).mapInArrow(_shards(last, cut, len(order) + 1), docs.select(*order).schema)
    return cleaned.select(*names).to(schema)
