"""Encoding many texts at once under a byte-level vocabulary (op7_rans_token_ids)."""

import numpy as np
import pytest
from recordflow.llm import tokens as T

VOCABULARY = "byte_bpe_50k.json"


def _direct(enc, texts):
    return [e.ids for e in enc.tok.encode_batch_fast(texts, add_special_tokens=False)]


def _split(got):
    ids, per = got
    return [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])]


def test_only_long_and_odd_chunks_are_looked_up_one_by_one(monkeypatch):
    enc = T.ChunkEncoder(T.vocabulary(VOCABULARY), True)
    texts = ["Plain words, and more; so on.\nnext line  two blanks x7, été. " * 20] * 30 + ["a\tb", "", " ", "internationalisations, yes"]
    want = _direct(enc, texts)
    asked, look_up = [], T.ChunkCache.look_up
    monkeypatch.setattr(T.ChunkCache, "look_up", lambda self, keys: (asked.extend(keys), look_up(self, keys))[1])
    for _ in range(2):  # new words, then known ones
        asked.clear()
        assert _split(enc.encode(texts)) == want
        assert sorted(asked) == sorted([b"\x00a", b"\x00\tb", b"\x00internationalisations"])


@pytest.mark.parametrize("bits", [4, 22])
def test_short_keys_equal_direct_whatever_is_pushed_out(monkeypatch, bits):
    monkeypatch.setattr(T.ShortKeys, "BITS", bits)
    enc = T.ChunkEncoder(T.vocabulary(VOCABULARY), True)
    rng = np.random.default_rng(7)
    parts = ["a", "b" * 7, "c" * 8, "d" * 9, "e" * 15, "f" * 16, "g" * 17, "é" * 4, "é" * 8, "ß,", " ", " ", " ", "\n", "  ", ", ", ". ", "..", "7,", "it's", "!\n", "日本",
             "\t", "\x00", "\x01", " ", "\x1c", "<|endoftext|>", ":", "x:y", " the", " word"]
    for k in range(12):
        texts = ["".join(rng.choice(parts, rng.integers(0, 20))) for _ in range(150)]
        assert _split(enc.encode(texts)) == _direct(enc, texts)
        enc.short.max_entries = 5 if k % 3 == 0 else 1_000_000  # starts anew now and then


def test_texts_longer_than_one_pass_and_no_texts():
    enc = T.ChunkEncoder(T.vocabulary(VOCABULARY), True)
    text = " ".join(f"w{i % 977}" for i in range(300_000))
    assert _split(enc.encode(["", text, "", "end"])) == _direct(enc, ["", text, "", "end"])
    ids, per = enc.encode([])
    assert not len(ids) and not len(per)
