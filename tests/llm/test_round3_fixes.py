"""Joins against short lists of ids, and words that go straight to a vocabulary's model."""

import contextlib
import io
import time

import numpy as np
import pyarrow as pa
import pytest

from recordflow.llm import common as C
from recordflow.llm import minhash as M
from recordflow.llm import rans as R
from recordflow.llm import tokens as T


def test_documents_are_not_shuffled_against_a_short_list(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + " x"), (4, "quite another text of a few words"), (None, text), (5, None)], "doc_id long, text string")
    out = M.drop_near_duplicates(docs)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "BroadcastHashJoin" in buf.getvalue() and "hashpartitioning" not in buf.getvalue()
    assert sorted(r[0] or 0 for r in out.collect()) == [0, 1, 4, 5]


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_accents_and_marks_go_to_the_model(monkeypatch, name, spaces):
    enc = T.ChunkEncoder(T.vocabulary(name), spaces)
    assert enc.by_model
    words = ["schüpf.", "Ciónque", "ÈRÉCH!!", "oran,###", "ertionon&&&", "àí", "ß", "plain", "a<|", "x()[]{}~`^_@\\"]
    texts = [" ".join(words), "\n".join(words), *words, *(" " + w for w in words)]
    want = [e.ids for e in enc.tok.encode_batch_fast(texts, add_special_tokens=False)]
    calls = []
    monkeypatch.setattr(T.ChunkEncoder, "_together", lambda self, x: calls.append(x))
    flat, per = enc.encode(texts[2:])
    assert not calls and [int(n) for n in per] == [len(w) for w in want[2:]] and flat.tolist() == [i for w in want[2:] for i in w]
    monkeypatch.undo()
    odd = ["it's", "l'été", "don't!'", "été café", "½ª µ º", "İIı", "a­b", "x1y2!", "$word", "a\x00b", "<|endoftext|>a."]
    for texts in ([*odd, *(" " + w for w in odd), " ".join(odd[:-1])],):
        want = [e.ids for e in enc.tok.encode_batch_fast(texts, add_special_tokens=False)]
        flat, per = enc.encode(texts)
        assert [int(n) for n in per] == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def test_a_worker_keeps_one_encoder():
    a = T.loaded(T.ChunkEncoder, T.vocabulary("byte_bpe_50k.json"), True)
    assert T.loaded(T.ChunkEncoder, T.vocabulary("byte_bpe_50k.json"), True) is a
    T.loaded(T.ChunkEncoder, T.vocabulary("word_bpe_49k.json"), False)
    assert len(T._loaded) == 1


def test_an_encoder_learns_many_new_words_and_odd_ones_alike():
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        enc = T.ChunkEncoder(T.vocabulary(name), spaces)
        words = [f"{a}{b}{c}" for a in ("Mach", "ér", "x9", "\x01a", "b\x01", "") for b in ("om", "Ünd", "\x02", "日本") for c in ("", ",", "!?", "\n", "s'")]
        texts = [" ".join(words), "\n".join(words), "  ".join(words), *words]
        want = [e.ids for e in enc.tok.encode_batch_fast(texts, add_special_tokens=False)]
        for _ in range(2):  # new words, then known ones
            flat, per = enc.encode(texts)
            assert [int(n) for n in per] == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]
        assert list(enc.index.values()) == list(range(enc.n))


def test_ids_are_counted_by_block_not_by_row():
    big = np.full(1 << 18, 7, np.uint16).tobytes()
    lists = [np.array([5, 2], np.uint16).tobytes()] * 50_000 + [None, b"", big, np.array([5, 65535], np.uint16).tobytes()]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.binary())], names=["ids"])
    began = time.process_time()
    out, = R._counted(iter([batch]))
    assert time.process_time() - began < 0.5  # an array of all ids added for each row takes a second and more
    assert dict(zip(*(out.column(i).to_pylist() for i in range(2)))) == {2: 50_000, 5: 50_001, 7: 1 << 18, 65535: 1}


def test_coded_blocks_come_back_whole_and_as_before():
    rng = np.random.default_rng(3)
    for n in (1, 255, 1000, 70_001):
        ids = np.minimum(rng.zipf(1.3, n), 60_000).astype(np.uint16)
        ids[0] = 60_000
        coder = R.Coder(R.frequencies(count := np.bincount(ids, minlength=1 << 16)))
        lanes, x, words = coder.encode(ids)
        assert count.sum() == n and (coder.decode(n, x, words) == ids).all()
        state = [1 << R.LOW] * lanes
        sent = []
        for at in range((n - 1) // lanes * lanes, -1, -lanes):  # one id after the other, in whole numbers
            row = []
            for lane, i in enumerate(ids[at:at + lanes].tolist()):
                f, c = int(coder.f[i]), int(coder.c[i])
                if state[lane] >= f << (R.LOW - R.SCALE + 32):
                    row.append(state[lane] & 0xFFFFFFFF)
                    state[lane] >>= 32
                state[lane] = (state[lane] // f << R.SCALE) + state[lane] % f + c
            sent.append(row)
        assert x.tolist() == state and words.tolist() == [w for row in sent[::-1] for w in row]


def test_tasks_give_freed_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(C, "give_back", lambda: given.append(1))
    assert list(C.frugal(lambda batches: (b for b in batches), 2)(iter(range(5)))) == [0, 1, 2, 3, 4] and len(given) == 3
    given.clear()

    def broken(batches):
        yield next(batches)
        raise ValueError

    with pytest.raises(ValueError):
        list(C.frugal(broken)(iter(range(2))))
    assert given == [1]
