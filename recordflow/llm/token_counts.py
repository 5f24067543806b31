"""Token counts of whole texts: batch encoding that returns lengths only.

Texts go to the vocabulary's library in batches of about equal bytes, so one
call holds the ids of some hundred kilobytes at most. A long text is split
where no token of the whole text can reach across, so the counts of its parts
add up to its own:

- ``tokenizers`` files that cut texts by a pattern before merging (byte-level
  or split-then-byte-level): between a letter, digit or closing mark and
  white space, or between a letter and a digit or an ideographic mark. No
  match of such a pattern goes on there, and none looks back;
- ``sentencepiece`` models without normalisation whose pieces hold the blank
  mark only at their beginning: before a blank that follows another
  character. The blank itself is left to the prefix that the model adds.

A vocabulary that doesn't fit either description, or whose added tokens could
lie across such a place, has its texts encoded whole.

Defined results: a null or empty text has no tokens and no bytes; the strings
of special tokens inside texts count as the library's default takes them. An
empty table gives no rows; equal rows and null ids are rows like any other. A
text without a safe place is encoded whole, however long. Other columns of the
table are not read.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import arrow_batches

PART_CHARS = 1 << 15  # a longer text is split into parts of about this many characters
CALL_BYTES = 1 << 18  # texts given to one call of the library

_PLACE = regex.compile(r"(?<=[\p{L}\p{N}.,;:!?)\]])(?=[ \n\t])|(?<=\p{L})(?=[0-9。，、！？；：])")
_HAS_PLACE = regex.compile(r"[\s0-9。，、！？；：]")
_BLANK_PLACE = regex.compile(r"(?<=[^ ▁])(?= (?s:.))")

_loaded: dict[str, "_Counter"] = {}


def parts(text: str, place: regex.Pattern, size: int) -> list[str]:
    """``text`` cut at places of the pattern into parts of ``size`` characters or a little more; no place, no cut."""
    out, at = [], 0
    while len(text) - at > size:
        m = place.search(text, at + size)
        if m is None or m.start() >= len(text):
            break
        out.append(text[at:m.start()])
        at = m.start()
    return [*out, text[at:]]


class _Counter:
    """Counts for lists of texts; ``place`` is the pattern of safe places, or None."""

    place: regex.Pattern | None = None

    def lengths(self, texts: list[str]) -> list[int]:
        raise NotImplementedError

    def split(self, text: str, size: int) -> list[str]:
        return parts(text, self.place, size) if self.place is not None else [text]

    def count(self, texts: list[str], size: int = PART_CHARS) -> np.ndarray:
        """Number of tokens of each text, in calls of about equal bytes."""
        pieces: list[str] = []
        owner: list[int] = []
        for i, t in enumerate(texts):
            mine = [t] if len(t) <= size else self.split(t, size)
            pieces += mine
            owner += [i] * len(mine)
        sizes = np.array([len(p) if p.isascii() else len(p.encode()) for p in pieces], np.int64)
        calls = np.cumsum(sizes) // CALL_BYTES if len(pieces) else np.empty(0, np.int64)
        edge = np.concatenate([[0], np.flatnonzero(np.diff(calls)) + 1, [len(pieces)]])
        found = np.zeros(len(pieces), np.int64)
        for a, b in zip(edge[:-1], edge[1:]):
            if b > a:
                found[a:b] = self.lengths(pieces[a:b])
        return np.bincount(np.array(owner, np.int64), weights=found, minlength=len(texts)).astype(np.int64)


class FileCounter(_Counter):
    """A ``tokenizers`` file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        if self._cuts_by_pattern(file.get("pre_tokenizer")) and not any(self._across(a) for a in file.get("added_tokens") or []):
            self.place = _PLACE

    @staticmethod
    def _cuts_by_pattern(pre: dict | None) -> bool:
        steps = (pre or {}).get("pretokenizers") or [pre or {}]
        kinds = [s.get("type") for s in steps]
        if kinds == ["ByteLevel"]:
            return bool(steps[0].get("use_regex", True)) and not steps[0].get("add_prefix_space")
        return kinds == ["Split", "ByteLevel"] and not steps[1].get("add_prefix_space")

    @staticmethod
    def _across(added: dict) -> bool:
        return bool(added.get("rstrip") or added.get("single_word") or _HAS_PLACE.search(added["content"]))

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


class ModelCounter(_Counter):
    """A ``sentencepiece`` model."""

    MARK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        begins = all(self.MARK not in p.lstrip(self.MARK) for p in pieces)
        as_written = all(self.model.encode(t, out_type=str) == [self.MARK + x for x in t.split()] for t in ("a a", "a a a")) and \
            self.model.decode(self.model.encode("a  b ")) == "a  b " and self.model.decode(self.model.encode("Ａ b")) == "Ａ b"
        if begins and as_written:
            self.place = _BLANK_PLACE

    def split(self, text: str, size: int) -> list[str]:
        first, *rest = super().split(text, size)
        return [first, *(p[1:] for p in rest)]  # the model puts a blank before each part

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]


def counter(path: str) -> _Counter:
    """The counter of a vocabulary file, made once per worker process."""
    if path not in _loaded:
        _loaded[path] = ModelCounter(path) if path.endswith(".model") else FileCounter(path)
    return _loaded[path]


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text; ``over_limit``: more than ``limit`` tokens."""
    arrow_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        model = counter(vocabulary_path)
        for batch in batches:
            text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            size = pc.binary_length(text).cast(pa.int64())
            n = model.count(text.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, pa.array(n), pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    out = docs.selectExpr(f"`{id_col}` AS id", f"CAST(`{text_col}` AS STRING) AS text") \
        .mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
