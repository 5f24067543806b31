"""Quality scores by random Fourier features over document statistics.

Statistics of a text (lengths, character classes, repetition, line shape) are
standardised; random cosines of them approximate a Gaussian kernel. Ridge
regression on the cosines is fitted from normal equations that each task sums
over its rows. An isotonic curve, fitted on labelled rows that the regression
did not see, turns raw scores into probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow_batches, blocks, mix, stored
from .fertility import _dup_lines, _repeats

FEATURES = 256  # random cosines
RIDGE = 1e-3
STEPS = 1024  # raw scores are calibrated in steps of 1 / STEPS
THRESHOLD = 0.7
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:", b"!?", b"#*$%&|<>", b"()[]{}\"'/\\@^_`~+=-", bytes(range(128, 256)), b"\n", b" \t"]
STATS = ["log_words", "word_bytes", "word_spread", "log_lines", "dup_lines", "repeat_words", "equal_neighbours", "distinct", "top_word", "word_entropy", "mixed_words",
         *[f"class_{i}" for i in range(len(CLASSES))]]

_U = np.uint64


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row per text, a column per name in ``STATS``; all 0 for null and empty texts."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    w = Words(raw)
    b, n = np.frombuffer(w.buf, np.uint8), np.maximum(w.per, 1)
    text, size = w.text_of(), np.maximum(np.diff(w.offset) - 1, 1)
    out = {}

    def by_text(x: np.ndarray) -> np.ndarray:
        return np.bincount(text, x, len(texts))

    length = (w.end - w.start).astype(float)
    out["log_words"] = np.log1p(w.per)
    out["word_bytes"] = np.minimum(by_text(length) / n, 40)
    out["word_spread"] = np.minimum(np.sqrt(np.maximum(by_text(length ** 2) / n - (by_text(length) / n) ** 2, 0)), 40)
    shares = []
    for c in CLASSES:
        own = np.zeros(256, bool)
        own[list(c)] = True
        total = np.concatenate([[0], np.cumsum(own[b])])
        shares.append((total[w.offset[1:] - 1] - total[w.offset[:-1]]) / size)
        if c == CLASSES[5]:
            out["mixed_words"] = by_text((total[w.end] > total[w.start]).astype(float)) / n
    lines = np.round(shares[8] * size)
    out["log_lines"] = np.log1p(lines) - np.log1p(w.per)
    out["dup_lines"] = _dup_lines(w) / (lines + 1)
    out["repeat_words"] = _repeats(w) / n
    same = np.concatenate([[False], (w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])]) if len(w) else np.zeros(0, bool)
    out["equal_neighbours"] = by_text(same.astype(float)) / n
    key = np.sort(mix(w.hash ^ mix(text.astype(_U) + _U(1))) >> _U(20) | (text.astype(_U) << _U(44))) if len(w) else np.zeros(0, _U)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts, of = np.diff(np.append(edge, len(key))), (key[edge] >> _U(44)).astype(np.int64)
    out["distinct"] = np.bincount(of, minlength=len(texts)) / np.sqrt(n)
    top = np.zeros(len(texts))
    np.maximum.at(top, of, counts)
    out["top_word"] = top / n
    p = counts / n[of]
    out["word_entropy"] = np.bincount(of, -p * np.log2(p), len(texts))
    return np.stack([*(out[k] for k in STATS[:11]), *shares], 1)


def _stats(batches):
    for batch in batches:
        for part in blocks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), lambda r: len(r[1] or "")):
            x = statistics([t for _, t in part])
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in part], pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["doc_id", "x"])


class Cosines:
    """Random Fourier features of standardised statistics, the statistics themselves and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int, features: int):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = rng.standard_normal((len(mean), features)) / np.sqrt(len(mean))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.concatenate([np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b)), z / 6, np.ones((len(z), 1))], 1)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _normal_equations(train: DataFrame, phi: Cosines) -> tuple[np.ndarray, np.ndarray, int]:
    """Z'Z, Z'y and the number of rows: summed by task, then by group of tasks, then here."""

    def sums(batches):
        a = None
        for batch in batches:
            if len(batch):
                z = np.concatenate([phi(_matrix(batch.column(0))), batch.column(1).to_numpy()[:, None].astype(float)], 1)
                a = z.T @ z if a is None else a + z.T @ z
        if a is not None:
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary())], names=["a"])

    def add(batches):
        a = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                x = np.frombuffer(raw)
                a = x.copy() if a is None else a + x
        if a is not None:
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary())], names=["a"])

    width = train.sparkSession.sparkContext.defaultParallelism
    parts = train.select("x", "y").repartition(width).mapInArrow(sums, "a binary")
    total = None
    for r in parts.repartition(max(1, int(width ** 0.5))).mapInArrow(add, "a binary").toLocalIterator():
        x = np.frombuffer(r[0])
        total = x.copy() if total is None else total + x
    if total is None:
        return np.zeros((0, 0)), np.zeros(0), 0
    m = int(round(len(total) ** 0.5))
    total = total.reshape(m, m)
    return total[:-1, :-1], total[:-1, -1], int(round(total[-2, -2]))


def isotonic(score: np.ndarray, hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rising means of ``hits / n`` in the order of ``score`` (pool adjacent violators)."""
    value, weight, size = [], [], []
    for h, k in zip((hits / n)[np.argsort(score, kind="stable")].tolist(), n[np.argsort(score, kind="stable")].tolist()):
        value.append(h)
        weight.append(k)
        size.append(1)
        while len(value) > 1 and value[-2] >= value[-1]:
            v, k2, s = value.pop(), weight.pop(), size.pop()
            value[-1] = (value[-1] * weight[-1] + v * k2) / (weight[-1] + k2)
            weight[-1] += k2
            size[-1] += s
    return np.repeat(value, size)


def fold(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % 4


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  threshold: float = THRESHOLD, features: int = FEATURES, seed: int = 11) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    Labels count only for ids whose ``fold`` is not 2: folds 0 and 1 fit the
    regression, fold 3 the calibration (folds 0 and 1 where 3 has no label).
    Null labels and null ids teach nothing; a label row without a document is
    left out, a repeated one counts again. A null id is not held out. Null and
    empty texts have all statistics 0 and are scored like any text. Without
    labels every score is 0.5. Other columns are not read.
    """
    arrow_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    stats = stored(plain.mapInArrow(_stats, "doc_id long, x array<double>"), "quality/statistics")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).where("doc_id is not null and y is not null")
    known = known.withColumn("fold", fold(F.col("doc_id"))).where("fold <> 2")
    train = stored(known.join(stats, "doc_id").select("x", "y", "fold"), "quality/train")

    k = len(STATS)
    cols = [f(F.col("x")[i]).alias(f"{n}{i}") for n, f in (("m", F.avg), ("s", F.stddev_pop)) for i in range(k)]
    moments = train.agg(*cols).first()
    score, held_out = F.lit(0.5), F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    if moments[0] is None:
        return stats.select("doc_id", held_out.alias("held_out"), score.alias("score"), F.lit(0).alias("predicted"))
    phi = Cosines(np.array(moments[:k]), np.array(moments[k:]), seed, features)
    rows = train.where("fold < 2")
    a, b, n = _normal_equations(rows, phi)
    if not n:
        a, b, n = _normal_equations(train, phi)
    beta = np.linalg.solve(a + RIDGE * n * np.eye(len(a)), b)

    def raw(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.round(np.clip(phi(_matrix(batch.column(0))) @ beta, -0.5, 1.5) * STEPS).astype(np.int64)) if len(batch) else pa.array([], pa.int64()), batch.column(1)], names=["step", "y"])

    def curve(rows: DataFrame) -> list:
        return rows.select("x", "y").mapInArrow(raw, "step long, y double").groupBy("step").agg(F.sum("y"), F.count("y")).collect()  # at most 2 * STEPS + 1 rows

    points = sorted(curve(train.where("fold = 3")) or curve(train))
    at, hits, count = (np.array(c, float) for c in zip(*points))
    rising = isotonic(at, hits, count)

    def scored(batches):
        for batch in batches:
            if len(batch):
                s = np.interp(np.clip(phi(_matrix(batch.column(1))) @ beta, -0.5, 1.5) * STEPS, at, rising)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(scored, "doc_id long, score double, predicted int").select("doc_id", held_out.alias("held_out"), "score", "predicted")
