"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads a text word by word (white-space words, A-Z lower-cased),
from both ends of each word, and labels every byte with a probability per
language. A document's probabilities pool those of all its bytes. A word's
labels depend on the word alone, so each task works out a word once.

The weights are trained here, in numpy, by backpropagation through time, on
words of a bounded sample of documents (``DOCS_PER_LANGUAGE`` documents of each
language, ``WORDS_PER_DOC`` words spread over each document's whole text).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, blocks, lower_ascii, stored
from .kernel_quality import fold
from .tokens import _Index

HIDDEN = 16
UNIT = 32  # bytes; a longer word is read in pieces
DOCS_PER_LANGUAGE = 400
WORDS_PER_DOC = 48
EPOCHS, BATCH, RATE = 4, 256, 0.01
MIN_STEPS = 300  # a small sample is gone through more often
CACHE_WORDS = 500_000

_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


class Network:
    """Two gated recurrent layers, one per direction, and a softmax over languages at every byte."""

    def __init__(self, languages: int, hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = hidden
        self.h = h
        make = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = make(256, 3 * h, scale=0.3)  # input weights by byte, with the biases
            self.p[f"u{d}"] = make(h, 3 * h, scale=1 / np.sqrt(h))
        self.p["o"] = make(2 * h, languages, scale=1 / np.sqrt(2 * h))
        self.p["c"] = np.zeros(languages, np.float32)

    def _read(self, words: np.ndarray, d: str, keep: bool):
        """States after each byte (and what backpropagation needs). ``words``: bytes, a row per word."""
        x, u, h = self.p[f"x{d}"], self.p[f"u{d}"], self.h
        state = np.zeros((len(words), h), np.float32)
        states, kept = [None] * words.shape[1], [None] * words.shape[1]
        order = range(words.shape[1]) if d == "f" else range(words.shape[1] - 1, -1, -1)
        for t in order:
            i, r = x[words[:, t]], state @ u
            gates = _sigmoid(i[:, :2 * h] + r[:, :2 * h])
            z, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(i[:, 2 * h:] + reset * r[:, 2 * h:])
            before = state
            state = new + z * (before - new)
            states[t] = state
            if keep:
                kept[t] = (before, z, reset, new, r[:, 2 * h:])
        return states, kept

    def label(self, words: np.ndarray) -> np.ndarray:
        """Log probabilities: word, byte, language."""
        f, _ = self._read(words, "f", False)
        b, _ = self._read(words, "b", False)
        o = self.p["o"]
        y = np.stack([f[t] @ o[: self.h] + b[t] @ o[self.h:] for t in range(words.shape[1])], 1) + self.p["c"]
        y -= y.max(2, keepdims=True)
        return y - np.log(np.exp(y).sum(2, keepdims=True))

    def gradients(self, words: np.ndarray, language: np.ndarray) -> dict:
        f, kf = self._read(words, "f", True)
        b, kb = self._read(words, "b", True)
        n, steps = words.shape
        o, h = self.p["o"], self.h
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        back = {"f": [None] * steps, "b": [None] * steps}
        for t in range(steps):
            y = f[t] @ o[:h] + b[t] @ o[h:] + self.p["c"]
            e = np.exp(y - y.max(1, keepdims=True))
            e /= e.sum(1, keepdims=True)
            e[np.arange(n), language] -= 1
            e /= n * steps
            g["o"][:h] += f[t].T @ e
            g["o"][h:] += b[t].T @ e
            g["c"] += e.sum(0)
            back["f"][t], back["b"][t] = e @ o[:h].T, e @ o[h:].T
        for d, kept, order in (("f", kf, range(steps - 1, -1, -1)), ("b", kb, range(steps))):
            u, into = self.p[f"u{d}"], np.zeros((n, h), np.float32)
            for t in order:
                before, z, reset, new, r = kept[t]
                s = into + back[d][t]
                dnew = s * (1 - z) * (1 - new * new)
                dz = s * (before - new) * z * (1 - z)
                dreset = dnew * r * reset * (1 - reset)
                inner = np.concatenate([dz, dreset, dnew], 1)
                outer = np.concatenate([dz, dreset, dnew * reset], 1)
                np.add.at(g[f"x{d}"], words[:, t], inner)
                g[f"u{d}"] += before.T @ outer
                into = s * z + outer @ u.T
        return g

    def train(self, by_length: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 7) -> None:
        """Adam over batches of words of one length; the step size falls to a tenth."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        jobs = [(i, at) for i, (w, _) in enumerate(by_length) for at in range(0, len(w), batch)]
        epochs = max(epochs, -(-MIN_STEPS // max(1, len(jobs))))
        total, step = epochs * len(jobs), 0
        for _ in range(epochs):
            mixed = [rng.permutation(len(w)) for w, _ in by_length]
            for j in rng.permutation(len(jobs)):
                i, at = jobs[j]
                pick = mixed[i][at:at + batch]
                step += 1
                scale = rate * (1 - 0.9 * step / total)
                for k, g in self.gradients(by_length[i][0][pick], by_length[i][1][pick]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= (scale * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


def units(text: bytes) -> list[bytes]:
    """The words of a text; words of over ``UNIT`` bytes in pieces."""
    words = text.split()
    if words and max(map(len, words)) > UNIT:
        words = [w[i:i + UNIT] for w in words for i in range(0, len(w), UNIT)]
    return words


def _stacked(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def by_length(words: list[bytes]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


class Labeller:
    """Sums of a word's byte labels, kept by word; starts anew when ``CACHE_WORDS`` are held."""

    def __init__(self, net: Network):
        self.net, self.languages = net, len(net.p["c"])
        self._clear()

    def _clear(self) -> None:
        self.index, self.n = _Index(), 0
        self.sums = np.zeros((1 << 16, self.languages), np.float32)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if self.n > CACHE_WORDS:
            self._clear()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if len(self.index) > self.n:
            fresh = np.flatnonzero(at >= self.n)
            _, first = np.unique(at[fresh], return_index=True)
            new = [words[i] for i in fresh[first]]
            while self.n + len(new) > len(self.sums):
                self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            for members in by_length(new).values():
                for i in range(0, len(members), 2048):
                    part = np.array(members[i:i + 2048])
                    self.sums[self.n + part] = self.net.label(_stacked([new[j] for j in part])).sum(1)
            self.n += len(new)
        return self.sums[at]


def _sample(batches):
    for batch in batches:
        langs, words = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = units(lower_ascii(text))
            picked = [own[i * len(own) // WORDS_PER_DOC] for i in range(WORDS_PER_DOC)] if len(own) > WORDS_PER_DOC else own
            langs += [lang] * len(picked)
            words += picked
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary())], names=["lang", "word"])


def train_network(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], Network | None]:
    """The languages of ``docs`` and a network trained on a sample of their words."""
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    # The different texts of each language with the smallest hashes: the same
    # ones whatever the partitions, and no more of them however many copies
    # there are. Spark keeps the smallest of each task before it shuffles them.
    hashed = known.withColumn("h", F.xxhash64("text"))
    first = Window.partitionBy("lang").orderBy("h")
    picked = stored(hashed.select("lang", "h").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= DOCS_PER_LANGUAGE).drop("r"), "language/picked")
    names = sorted(r[0] for r in picked.select("lang").distinct().collect())  # a row per language
    if not names:
        return [], None
    chosen = hashed.join(picked, ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")
    rows = sorted((r[0], bytes(r[1])) for r in chosen.mapInArrow(_sample, "lang string, word binary").collect())
    net = Network(len(names))
    words, langs = [w for _, w in rows], np.array([names.index(x) for x, _ in rows], np.int64)
    if words:
        net.train([(_stacked([words[i] for i in members]), langs[members]) for members in by_length(words).values()])
    return names, net


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    Trained on rows with a language whose id's ``fold`` is not 2 (null ids
    teach nothing and are not held out). A text that is null or has no letter
    is ``und`` with score 0, and so is every text when no row has a language.
    Whole texts are read, however long; each row is judged by its text alone,
    so repeated rows agree. Other columns are not read.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    names, net = train_network(docs.where(fold(F.col(id_col)) != 2), text_col, lang_col)
    sent = spark.sparkContext.broadcast((names, net))  # some tens of kB
    kept: list = []

    def predict(batches):
        names, net = sent.value
        if not kept and net is not None:
            kept.append(Labeller(net))
        for batch in batches:
            for part in blocks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), lambda r: len(r[1] or "")):
                words = [units(lower_ascii(t)) for _, t in part]
                cut = np.concatenate([[0], np.cumsum([len(w) for w in words])])
                flat = [w for own in words for w in own]
                if flat and kept:
                    total = np.concatenate([np.zeros((1, len(names))), np.cumsum(kept[0](flat), 0, dtype=np.float64)])
                    size = np.concatenate([[0], np.cumsum([len(w) for w in flat])])
                langs, scores = [], []
                for k, (_, t) in enumerate(part):
                    if net is None or not t or not _LETTER.search(t):
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    mean = (total[cut[k + 1]] - total[cut[k]]) / max(1, size[cut[k + 1]] - size[cut[k]])
                    p = np.exp(mean - mean.max())
                    langs.append(names[int(p.argmax())])
                    scores.append(float(p.max() / p.sum()))
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in part], pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return plain.mapInArrow(predict, "doc_id long, lang_pred string, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
