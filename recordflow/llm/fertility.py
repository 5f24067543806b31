"""Quality rules on how public vocabularies take a text apart.

A text that a vocabulary knows poorly comes out as many short tokens or as
single bytes; a text that says the same over and over uses few of its tokens.
Per document, under a vocabulary of pieces and one of bytes: characters per
token, share of byte-fallback tokens (pieces only) and token entropy, as a
share of the most that so many tokens can have, at most ENTROPY_BITS. They are
held against fixed bands for the text's main script, and against bands that the
corpus itself sets for its language, script and length: quartiles of all texts
that pass the simple counts, equal texts once. Counts of words, symbols and
repeats come from the same pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, arrow_batches, blocks, frugal, hash_slices, mix, stored
from .tokens import WordPairEncoder, loaded, vocabulary

# Scripts by first and last code point; fixed values of the Unicode blocks.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "cjk": [(0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}

# Per script: least and most characters per token, most byte-fallback share,
# least share of the possible token entropy. Wide on purpose: a band rejects
# what no prose of the script comes near. "ascii" is Latin script with hardly a
# byte beyond ASCII: random letters have 1.36 to 1.73 characters per token (under
# 1.7 from 60 words on), prose has 1.85 or more (English in capitals, Swahili,
# Zulu, Vietnamese without its marks). With its marks Vietnamese has 1.26, so
# "latin" must stay wide. "none" is a text without a letter of any script: numbers,
# keys and rules of signs have 0.9 characters per token or so, under the bound of "ascii".
BANDS = {
    "ascii": (1.7, 8.0, 0.10, 0.50),
    "latin": (1.2, 8.0, 0.10, 0.50),
    "greek": (0.9, 6.0, 0.15, 0.45),
    "cyrillic": (1.0, 7.0, 0.10, 0.50),
    "hebrew": (0.7, 6.0, 0.40, 0.40),
    "arabic": (0.7, 6.0, 0.40, 0.40),
    "devanagari": (0.5, 6.0, 0.70, 0.35),
    "thai": (0.4, 6.0, 0.80, 0.35),
    "hangul": (0.3, 3.0, 0.95, 0.30),
    "cjk": (0.3, 3.0, 0.80, 0.30),
    "other": (0.3, 8.0, 0.50, 0.30),
    "none": (1.7, 8.0, 0.10, 0.50),
}
ENTROPY_BITS = 10.0
MAX_HIGH = 0.01  # bytes beyond ASCII of an "ascii" text, by character

# Bands of the corpus, by language, script and size class: a measure lies too low
# under first quartile - (reach + FEW / sqrt(texts)) * (third - first quartile),
# if that is at least ``share`` under the median (which holds where copies make
# up most of a class). Per measure: bins by unit, reach, share. Fits of the
# labelled documents of sf0.1 (prose is up to 6 % under the median entropy of
# its class, symbol-laden text mostly 8 % or more; prose with an address or a
# key in it up to 22 % under the median of characters per token).
CORPUS_BANDS = {
    "chars_per_token": (256, 2.0, 0.25),
    "entropy_share": (8192, 1.0, 0.06),
    "chars_per_byte_token": (256, 2.0, 0.25),
    "byte_entropy_share": (8192, 1.5, 0.08),
}
FEW = 2.0  # quartiles of few texts are unsure, so their bands are wider
MOST_BINS = 1 << 14
SYMBOLS = b"#*$%&|<>"

_U = np.uint64
_NAMES = [*SCRIPTS, "other"]
_KIND = np.full(0x30000, len(_NAMES) - 1, np.uint8)
for _i, _ranges in enumerate(SCRIPTS.values()):
    for _a, _b in _ranges:
        _KIND[_a:_b + 1] = _i


def main_script(text: str) -> str:
    """The script of most letters; "other" where no letter is of a known one, "none" where there is no letter."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    n = np.bincount(_KIND[np.minimum(code, len(_KIND) - 1)], minlength=len(_NAMES))[:-1]
    return _NAMES[int(n.argmax())] if n.any() else "other" if any(map(str.isalpha, text)) else "none"


def _entropy_share(ids: np.ndarray) -> float:
    if len(ids) < 2:
        return 1.0
    s = np.sort(ids)
    counts = np.diff(np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]])))
    share = counts / len(ids)
    return float(-(share * np.log2(share)).sum() / min(np.log2(len(ids)), ENTROPY_BITS))


def _repeats(w: Words, k: int = 5) -> np.ndarray:
    """Per text, the words inside runs of ``k`` words that stand in it twice or more."""
    out = np.zeros(len(w), bool)
    text = w.text_of()
    if len(w) >= k:
        at = np.flatnonzero(text[: len(w) - k + 1] == text[k - 1:])
        h = mix(text[at].astype(_U) + _U(1))
        for j in range(k):
            h = mix(h ^ w.hash[at + j])
        s = np.sort(h)
        twice = np.unique(s[1:][s[1:] == s[:-1]])
        if len(twice):
            at = at[twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h]
            for j in range(k):
                out[at + j] = True
    return np.bincount(text[out], minlength=len(w.texts))


def _dup_lines(w: Words) -> np.ndarray:
    """Per text, the lines that hold a word and equal an earlier line."""
    b = np.frombuffer(w.buf, np.uint8)
    end = np.flatnonzero(b[:-8] == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    # Texts are joined by a line end, so no line crosses a text.
    has = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[has], end[has]
    text = np.searchsorted(w.offset, start, side="right") - 1
    key = mix(text.astype(_U) + _U(1)) ^ hash_slices(b, start, end)
    _, first = np.unique(key, return_index=True)
    return np.bincount(text, minlength=len(w.texts)) - np.bincount(text[first], minlength=len(w.texts))


def _measured(rows, path: tuple[str, str], bands: dict):
    """The measures of (id, text) rows, in their order; ``path``: the two vocabularies."""
    enc = loaded(WordPairEncoder, *path)
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True
    for part in blocks(rows, lambda r: len(r[1] or "")):
        raw = [(t or "").encode("utf-8", "surrogatepass") for _, t in part]
        w = Words(raw)
        b = np.frombuffer(w.buf, np.uint8)
        lead = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
        chars = np.concatenate([[0], np.cumsum(lead[w.end] - lead[w.start])])[w.first]
        chars = np.diff(chars)
        mark = np.concatenate([[0], np.cumsum(marks[b])])
        n_symbols = mark[w.offset[1:]] - mark[w.offset[:-1]]
        high = np.concatenate([[0], np.cumsum(b >= 0x80)])
        n_high = high[w.offset[1:]] - high[w.offset[:-1]]
        repeat, dup = _repeats(w), _dup_lines(w)
        flat, ends = enc.look_up([x for t in raw for x in t.split()]) if len(w) else (np.empty(0, np.uint32), np.zeros(1, np.int64))
        bound = ends[w.first]
        for k, (doc, text) in enumerate(part):
            both = flat[bound[k]:bound[k + 1]]
            ids, level = both[both < enc.split], both[both >= enc.split]
            n, words = len(ids), int(w.per[k])
            kind = main_script(text) if text else "other"
            per_token = float(chars[k] / n) if n else 0.0
            in_bytes = float(enc.is_byte[ids].mean()) if n else 0.0
            entropy = _entropy_share(ids)
            failed = words < 10 or 100 * int(repeat[k]) > 20 * words
            band = bands.get(kind, bands["other"])
            if kind == "latin" and n_high[k] <= MAX_HIGH * chars[k]:
                band = bands.get("ascii", band)
            low, most, most_bytes, least = band
            fine = low <= per_token <= most and in_bytes <= most_bytes and entropy >= least
            yield (doc, words, int(chars[k]), int(n_symbols[k]), int(dup[k]), int(repeat[k]), failed, bool(fine), kind, (n * n).bit_length(),
                   per_token, in_bytes, entropy, float(chars[k] / len(level)) if len(level) else 0.0, _entropy_share(level))


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(_TYPES), _TYPES)]


def _report(path: tuple[str, str], bands: dict):
    """(id, text, group) rows to their measures and the group."""
    def run(batches):
        for batch in batches:
            out = _columns(list(_measured(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), path, bands)))
            yield pa.RecordBatch.from_arrays([*out, batch.column(2)], names=[*_COLUMNS, "language"])

    return run


def _beside(path: tuple[str, str], bands: dict, text_at: int, names: list[str]):
    """Rows as they are, with their measures beside them."""
    def run(batches):
        for batch in batches:
            out = _columns(list(_measured(((None, t) for t in batch.column(text_at).to_pylist()), path, bands)))[1:]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=names)

    return run


_COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "in_fixed_band", "script", "size_class",
            "chars_per_token", "byte_share", "entropy_share", "chars_per_byte_token", "byte_entropy_share"]
_TYPES = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string(), pa.int32()] + [pa.float64()] * 5
_SPARK = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType(), pa.string(): T.StringType(), pa.int32(): T.IntegerType(), pa.float64(): T.DoubleType()}
_MEASURES = T.StructType([T.StructField(c, _SPARK[t]) for c, t in zip(_COLUMNS, _TYPES)])
_CLASS = ["language", "script", "size_class"]


def corpus_bands(measures: DataFrame) -> DataFrame:
    """Per language, script and size class the least value of each measure in ``CORPUS_BANDS``.

    Equal texts count once (by all their measures). Quartiles come from exact
    counts of bins, so they don't depend on how the rows are spread, and a
    class of any size comes down to a bounded number of rows before it meets.
    """
    texts = measures.where("not base_failed").select(*_CLASS, "n_words", "word_chars", *CORPUS_BANDS).distinct()
    each = F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.least(F.floor(F.col(c) * unit), F.lit(MOST_BINS)).cast("int").alias("bin"))
        for c, (unit, _, _) in CORPUS_BANDS.items()])).alias("x")
    bins = texts.select(*_CLASS, each).groupBy(*_CLASS, "x.measure", "x.bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*_CLASS, "measure")
    so_far = bins.withColumn("up_to", F.sum("n").over(whole.orderBy("bin"))).withColumn("texts", F.sum("n").over(whole))
    at = so_far.groupBy(*_CLASS, "measure", "texts").agg(
        *[F.min(F.when(F.col("up_to") * 4 >= F.col("texts") * k, F.col("bin"))).alias(f"q{k}") for k in (1, 2, 3)])
    least = [F.max(F.when(
        F.col("measure") == c,
        F.least(F.col("q1") - (F.lit(reach) + F.lit(FEW) / F.sqrt("texts")) * (F.col("q3") - F.col("q1")), F.col("q2") * (1 - share)) / unit)).alias(f"least_{c}")
        for c, (unit, reach, share) in CORPUS_BANDS.items()]
    return at.groupBy(*_CLASS).agg(*least)


def _verdict(measures: DataFrame) -> DataFrame:
    """``measures`` (a written table) with ``kept`` beside them."""
    least = stored(corpus_bands(measures), "fertility/bands")
    inside = F.lit(True)
    for c in CORPUS_BANDS:
        inside = inside & (F.col(c) >= F.coalesce(F.col(f"least_{c}"), F.lit(0.0)))
    return measures.join(least, _CLASS, "left").withColumn("kept", ~F.col("base_failed") & F.col("in_fixed_band") & inside)


def _at(names: list[str], column: str | None) -> int | None:
    """The place of ``column`` among ``names``, None where there is none."""
    low = [n.lower() for n in names]
    return low.index(column.lower()) if column is not None and column.lower() in low else None


def _language(docs: DataFrame, at: int | None):
    """The column at a place as text, "" for null or no such place."""
    return F.lit("") if at is None else F.coalesce(F.col(docs.columns[at]).cast("string"), F.lit(""))


def _vocabularies(vocabulary_path: str | None, byte_vocabulary_path: str | None) -> tuple[str, str]:
    return vocabulary_path or vocabulary("piece_bpe_32k.model"), byte_vocabulary_path or vocabulary("byte_bpe_50k.json")


def fertility(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None, bands: dict | None = None,
              byte_vocabulary_path: str | None = None, language_col: str | None = "lang") -> DataFrame:
    """Per row of ``docs`` the counts, the measures, and whether it is kept.

    Words are runs without ASCII white space. A text fails at once with fewer
    than 10 words or with over a fifth of its words in repeated 5-word windows;
    else the fixed bands of its main script decide (``bands``: as ``BANDS``,
    with "other" for scripts not named) together with those of the corpus for
    its language (``language_col`` if ``docs`` has it; null is a language of its
    own), script and length (half powers of two of tokens). A mark after every word
    takes some 10 % off the entropy and is rejected where the corpus is prose; so
    is a table whose cells are single words, while code and lists stay. Null, empty and blank
    texts have no words and fail. A very long text is measured whole, in a block
    of its own. Repeated rows are all returned, with one verdict; equal texts
    count once in the bands, so copies don't narrow them. Nulls in the id change
    nothing; further columns aren't read. An empty table gives an empty result.
    """
    arrow_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), _language(docs, _at(docs.columns, language_col)))
    measured = plain.mapInArrow(_report(_vocabularies(vocabulary_path, byte_vocabulary_path), bands or BANDS), T.StructType([*_MEASURES, T.StructField("language", T.StringType())]))
    out = _verdict(stored(measured, "fertility/measures"))
    return out.select(*_COLUMNS[:7], "kept", *_COLUMNS[8:], "language", *[f"least_{c}" for c in CORPUS_BANDS])


def keep_fertile(docs: DataFrame, text_col: str = "text", vocabulary_path: str | None = None, bands: dict | None = None,
                 byte_vocabulary_path: str | None = None, language_col: str | None = "lang") -> DataFrame:
    """``docs`` without the rows that the rules reject, as ``fertility`` judges them.

    The rows are written once with their measures; columns that are named like
    a measure are kept as they are. No row is shuffled but for its measures.
    """
    arrow_batches(docs.sparkSession)
    own = [f"own_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*own)
    at = _at(docs.columns, text_col)
    schema = T.StructType([*plain.schema, *_MEASURES[1:]])
    measured = stored(plain.mapInArrow(frugal(_beside(_vocabularies(vocabulary_path, byte_vocabulary_path), bands or BANDS, at, schema.names), 1), schema), "fertility/rows")
    language = _language(plain, _at(docs.columns, language_col))
    return _verdict(measured.withColumn("language", language)).where("kept").select(*own).toDF(*docs.columns)
