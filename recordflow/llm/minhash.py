"""Near-duplicate documents by circulant MinHash.

Two permutations make the whole signature: the first places a shingle on a
ring, the second is read at that place and at the places after it. Coordinate
k is the smallest value that any shingle reads k places on, so one gather of
consecutive values per shingle gives all coordinates. Bands of coordinates
become bucket keys; documents that share a bucket are compared on their full
shingle sets.

Documents with equal sets form one class; only the class's smallest id goes on.
In a bucket every member is first compared with one hub, which joins a bucket of
near copies at one comparison per member. Buckets whose members are then still
in different components are taken up again: members are held against each other
by their signatures (in blocks of bounded size), and pairs of different
components whose signatures don't rule the link out are compared on their sets,
first a spanning forest of the most alike, then all that are left. A pair of
different components that shares a bucket so goes uncompared only if its
signatures agree in under ``ALIKE`` of their places, six standard deviations
below 0.8.

A link of similarity 0.8 is missed with probability (1 - 0.8**7)**50 = 8e-6, one
of 0.85 with 1e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow_batches, blocks, frugal, lower_ascii, mix, shingles, stored, temporary
from .components import component_stars

RING = 1 << 20  # places of the ring
BANDS, ROWS = 50, 7
ALIKE = 0.66  # least share of equal places (their low bytes) of two signatures worth a comparison
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20  # members of a bucket, and their shingles, that make a part; a block has two parts at most

_U = np.uint64
_rings: dict[tuple, tuple] = {}


def _ring(seed: int, width: int) -> tuple[np.ndarray, int, int]:
    """Windows of ``width`` values of the second permutation, and the first one's step and shift."""
    if (seed, width) not in _rings:
        rng = np.random.default_rng(seed)
        values = rng.permutation(RING).astype(np.uint32)
        around = np.concatenate([values, values[:width]])
        _rings[seed, width] = (np.lib.stride_tricks.sliding_window_view(around, width), int(rng.integers(RING // 2)) * 2 + 1, int(rng.integers(RING)))
    return _rings[seed, width]


def signature(distinct: np.ndarray, seed: int, width: int) -> np.ndarray:
    """``width`` coordinates of a set of hashes that isn't empty."""
    window, step, shift = _ring(seed, width)
    at = ((distinct * _U(step) + _U(shift)) & _U(RING - 1)).astype(np.int64)
    out = None
    for i in range(0, len(at), 1024):
        low = window[at[i:i + 1024]].min(axis=0)
        out = low if out is None else np.minimum(out, low)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """The bucket keys of signatures: a row per signature, a column per band."""
    m = sig.reshape(len(sig), BANDS, ROWS).astype(_U)
    keys = np.broadcast_to(mix(np.arange(BANDS, dtype=_U) + _U(77)), (len(sig), BANDS)).copy()
    for r in range(ROWS):
        keys = mix(keys ^ m[:, :, r])
    return keys


def sets_of(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, per = shingles(Words([lower_ascii(t) for t in texts]), k)
    at = 0
    for n in per:
        yield np.unique(h[at:at + n])
        at += n


def _sketcher(k: int, seed: int):
    def sketch(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for part in blocks(rows, lambda r: len(r[1] or "")):
                ids, n, hi, lo, sig = [], [], [], [], []
                for (doc, _), s in zip(part, sets_of([t for _, t in part], k)):
                    ids.append(doc)
                    n.append(len(s))
                    hi.append(int(mix(s).sum(dtype=_U)))
                    lo.append(int(mix(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U)))
                    sig.append(signature(s, seed, BANDS * ROWS) if len(s) else np.zeros(BANDS * ROWS, np.uint32))
                keys = band_keys(np.stack(sig))
                signed = lambda x: pa.array(np.array(x, _U).view(np.int64))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sig) + 1) * BANDS, BANDS), pa.int32()), pa.array(keys.ravel().view(np.int64)))
                low = [x.astype(np.uint8).tobytes() for x in sig]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), signed(hi), signed(lo), bands, pa.array(low, pa.binary())], names=["id", "n", "hi", "lo", "bands", "low"])

    return sketch


def _verifier(k: int, percent: int):
    def verify(batches):
        for batch in batches:
            a, b, ta, tb = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for part in blocks(iter(range(len(a))), lambda i: len(ta[i] or "") + len(tb[i] or "")):
                sets = list(sets_of([ta[i] for i in part] + [tb[i] for i in part], k))
                for i, x, y in zip(part, sets, sets[len(part):]):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if len(x) and len(y) and 100 * common >= percent * (len(x) + len(y) - common):
                        keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    return verify


def _candidates(n, comp, half, low, percent: int):
    """For each member but the last, the later members worth a comparison and how alike they are. ``half`` is 0 or 1, or -1 where all are compared."""
    for i in range(len(n) - 1):
        j = np.arange(i + 1, len(n))
        j = j[(comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])) & ((half[i] < 0) | (half[j] != half[i]))]
        if len(j):
            same = (low[j] == low[i]).mean(1)
            yield i, j[same >= ALIKE], same[same >= ALIKE]


def _forest(ids, comp, found) -> list[tuple[int, int]]:
    """Pairs that join the components of a block, the most alike first."""
    up = {int(c): int(c) for c in comp}

    def root(c):
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    out = []
    for _, i, k in sorted(((s, i, k) for i, j, same in found for s, k in zip(same.tolist(), j.tolist())), key=lambda x: -x[0]):
        a, b = root(int(comp[i])), root(int(comp[k]))
        if a != b:
            up[a] = b
            out.append((min(int(ids[i]), int(ids[k])), max(int(ids[i]), int(ids[k]))))
    return out


def _first_here(key: int, bands: np.ndarray, i: int, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) share no earlier bucket than this one."""
    return bands[i][(bands[j] == bands[i]).argmax(1)] == key


def _by_block(width: int, handle, empty):
    """Batches sorted by block (key, p, q), a row per member: ``handle`` gets each block's key and columns."""

    def run(batches):
        at, rows = None, []
        for batch in batches:
            out = []
            for key, p, q, *row in zip(*(batch.column(i).to_pylist() for i in range(width))):
                if (key, p, q) != at:
                    out += handle(at, list(zip(*rows))) if len(rows) > 1 else []
                    at, rows = (key, p, q), []
                rows.append(row)
            yield empty(out)
        yield empty(handle(at, list(zip(*rows))) if len(rows) > 1 else [])

    return run


def _numbers(*columns):
    return [np.array(c, np.int64) for c in columns]


def _spanning(percent: int):
    def handle(at, columns):
        ids, n, comp, half = _numbers(*columns[:4])
        low = np.frombuffer(b"".join(columns[4]), np.uint8).reshape(len(ids), -1)
        return _forest(ids, comp, _candidates(n, comp, half, low, percent))

    return _by_block(9, handle, _pairs)


def _members(percent: int):
    """The members of each block that stand in a pair still to be compared there."""

    def handle(at, columns):
        ids, n, comp, half = _numbers(*columns[:4])
        low = np.frombuffer(b"".join(columns[4]), np.uint8).reshape(len(ids), -1)
        bands = np.array(columns[5], np.int64)
        use = np.zeros(len(ids), bool)
        for i, j, _ in _candidates(n, comp, half, low, percent):
            j = j[_first_here(at[0], bands, i, j)] if len(j) else j
            use[j] = True
            use[i] |= len(j) > 0
        return [(*at, int(ids[i]), int(comp[i]), int(half[i])) for i in np.flatnonzero(use)]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)], names=["key", "p", "q", "id", "comp", "half"])

    return _by_block(9, handle, batch)


def _confirmed_blocks(k: int, percent: int, seed: int):
    """Links of each block, from its members' whole texts."""

    def handle(at, columns):
        ids, comp, half = _numbers(*columns[:3])
        sets = [s for part in blocks(iter(columns[3]), lambda t: len(t or "")) for s in sets_of(part, k)]
        if not all(map(len, sets)):  # an id that also stands at an empty text
            fine = [i for i, s in enumerate(sets) if len(s)]
            ids, comp, half, sets = ids[fine], comp[fine], half[fine], [sets[i] for i in fine]
        if len(sets) < 2:
            return []
        sig = np.stack([signature(s, seed, BANDS * ROWS) for s in sets])
        bands, low, n = band_keys(sig).view(np.int64), sig.astype(np.uint8), np.array([len(s) for s in sets])
        links = []
        for i, j, _ in _candidates(n, comp, half, low, percent):
            for x in j[_first_here(at[0], bands, i, j)] if len(j) else ():
                common = len(np.intersect1d(sets[i], sets[x], assume_unique=True))
                if 100 * common >= percent * (n[i] + n[x] - common) and ids[i] != ids[x]:
                    links.append((min(int(ids[i]), int(ids[x])), max(int(ids[i]), int(ids[x]))))
        return links

    return _by_block(7, handle, _pairs)


def _pairs(pairs: list) -> pa.RecordBatch:
    pairs = sorted(set(pairs))
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, seed: int = 20240607) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * common >= ``percent`` * union of their
    distinct shingles of ``words`` words (white-space words, A-Z lower-cased).

    Null, empty or blank texts have no shingles, link with nothing and are kept.
    A text with fewer than ``words`` words is one shingle. Rows that share an id
    are one document and stay or go together. A row with a null id can't be
    named: it links with nothing, has a null component and is kept. Other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = stored(plain.mapInArrow(frugal(_sketcher(words, seed)), "id long, n long, hi long, lo long, bands array<long>, low binary"), "minhash/sketch")

    # Classes of equal sets, named by their smallest id.
    named = sketch.where("n > 0 and id is not null")
    least = named.groupBy("hi", "lo", "n").agg(F.min("id").alias("rep"))
    member = stored(named.select("id", "hi", "lo", "n").join(least, ["hi", "lo", "n"]).select("id", "rep", "n"), "minhash/member")

    # Members of the buckets that hold two classes at least.
    band = named.join(member.where("id = rep").select("id").distinct(), "id", "left_semi").select("id", "n", F.explode("bands").alias("key"))
    full = band.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    bucket = stored(band.join(full, "key").select("key", "id", "n", "size", "weight", "hub"), "minhash/bucket")
    # Written first, so that Spark knows how short this list is before it decides on a shuffle of the texts.
    asked = stored(bucket.select("id").distinct(), "minhash/asked")
    texts = stored(plain.join(asked, "id", "left_semi"), "minhash/texts")
    check = _verifier(words, percent)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among ``pairs``, which are distinct and have the smaller id first."""
        both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
                 .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
        return stored(both.mapInArrow(frugal(check), "a long, b long"), "minhash/links")

    def near(x: str, y: str) -> str:
        return f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"

    hubs = bucket.where("id = hub").select("key", F.col("n").alias("hub_n")).distinct()
    pairs = bucket.where("id <> hub").join(hubs, "key").where(near("n", "hub_n")).select(F.col("id").alias("a"), F.col("hub").alias("b"))
    tested = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash/pairs")
    comp = component_stars(confirmed(tested))  # a component's smallest member has no row
    low = stored(named.join(asked, "id", "left_semi").select("id", "low", "bands"), "minhash/low")

    def blocked(comp: DataFrame) -> DataFrame:
        """Buckets still in several components, in blocks: a bucket of g parts has a block for each two parts."""
        of = bucket.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        split = of.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        parts = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
        rest = of.join(split, "key", "left_semi").withColumn("g", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("g")).cast("int"))
        half = F.when(F.col("part") == F.col("other"), -1).otherwise((F.col("part") > F.col("other")).cast("int"))
        rest = (rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
                .select("key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "id", "n", "comp", half.alias("half")))
        return in_blocks(rest.join(low, "id").select("key", "p", "q", "id", "n", "comp", "half", "low", "bands"))

    def in_blocks(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "id")

    def with_links(comp: DataFrame, found: DataFrame) -> DataFrame:
        if found.isEmpty():
            return comp
        return component_stars(found.union(comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))))

    pairs = blocked(comp).mapInArrow(_spanning(percent), "a long, b long").distinct().join(tested, ["a", "b"], "left_anti")
    comp = with_links(comp, confirmed(pairs))
    left = stored(blocked(comp).mapInArrow(_members(percent), "key long, p long, q long, id long, comp long, half long"), "minhash/left")
    last = in_blocks(left.join(texts, "id").select("key", "p", "q", "id", "comp", "half", "text"))
    comp = with_links(comp, stored(last.mapInArrow(_confirmed_blocks(words, percent, seed), "a long, b long").distinct(), "minhash/links"))

    named_comp = member.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "id", "n", F.coalesce("comp", "rep").alias("component_id"))
    lone = sketch.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    out = named_comp.unionByName(lone)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates; rows with null ids stay."""
    with temporary(docs.sparkSession):
        gone = near_duplicates(docs, id_col, text_col, words, percent).where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
        gone = stored(gone, "minhash/gone", keep=True)  # its size is known then: the documents are shuffled only against a long list
    return docs.join(gone, id_col, "left_anti")
