"""The bands that a corpus sets for its own texts."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from recordflow.llm import fertility
from recordflow.llm.tokens import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string"


_LEXICON = ["".join(x) for x in np.random.default_rng(1).choice(
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split(), (3000, 3))]


def _prose(rng, n):
    """Sentences of made-up words with 1/rank frequencies."""
    rank = np.minimum((3000 ** rng.random(n)).astype(int), 2999)
    return " ".join(_LEXICON[x] + ("." if j % 11 == 10 else "") for j, x in enumerate(rank))


def _symbols(rng, text):
    return " ".join(w + str(rng.choice(["***", "$$$", "&&&", "%%%", "###"])) for w in text.split())


CODE = """def merge(left, right):
    out = []
    while left and right:
        if left[0] <= right[0]:
            out.append(left.pop(0))
        else:
            out.append(right.pop(0))
    return out + left + right

for name, size in sorted(table.items(), key=lambda x: -x[1]):
    print(f"{name:>20} | {size * 100 // total:3d} %")
    if size > limit and not name.startswith("#"):
        raise ValueError(name)
"""
LIST = "<ul>\n" + "\n".join(f"<li>{x}</li>" for x in ["Wash the apples and cut them into thin slices", "Mix flour with cold butter until it crumbles",
                                                     "Leave the dough in the fridge for an hour", "Bake everything until the crust turns golden"]) + "\n</ul>"


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(7)
    rows = [(i, _prose(rng, int(rng.integers(60, 500))), "xx") for i in range(1200)]
    rows += [(10000 + i, _symbols(rng, _prose(rng, int(rng.integers(60, 200)))), "xx") for i in range(60)]
    return rows + [(2000, CODE, "xx"), (2002, LIST, "xx"),
                   (2003, " ".join(f"0{rng.integers(100, 999)}-{rng.integers(10 ** 6, 10 ** 7)}" for _ in range(40)), "xx"),
                   (2004, None, "xx"), (2005, "", None), (2006, _prose(rng, 60000), None)]


def _kept(spark, rows, schema=SCHEMA):
    out = defaultdict(list)
    for r in fertility.fertility(spark.createDataFrame(rows, schema)).collect():
        out[r["doc_id"]].append(r["kept"])
    return out


def test_symbols_go_by_entropy_and_code_stays(spark, corpus):
    got = {k: v[0] for k, v in _kept(spark, corpus).items()}
    assert sum(got[i] for i in range(1200)) >= 1192
    assert sum(got[10000 + i] for i in range(60)) <= 12
    assert [got[i] for i in (2000, 2002, 2003, 2004, 2005, 2006)] == [True, True, False, False, False, True]


def _entropy(ids):
    if len(ids) < 2:
        return 1.0
    return -sum(n / len(ids) * math.log2(n / len(ids)) for n in Counter(ids).values()) / min(math.log2(len(ids)), fertility.ENTROPY_BITS)


def test_verdict_equals_a_plain_version(spark, corpus):
    import sentencepiece
    from tokenizers import Tokenizer

    piece = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    level = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = [r for r in corpus if r[0] != 2006] + [(3000 + i, r[1], r[2]) for i in range(4) for r in corpus[:20]]
    seen, classes = {}, defaultdict(set)
    for i, text, lang in rows:
        w = WORD.findall(text or "")
        a = [x for t in piece.encode(w) for x in t]
        b = [x for e in level.encode_batch([" " + x for x in w], add_special_tokens=False) for x in e.ids]
        windows = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4))
        hit = {j + d for j in range(len(w) - 4) if windows[tuple(w[j:j + 5])] > 1 for d in range(5)}
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        n = sum(map(len, w))
        measure = (n / len(a) if a else 0.0, _entropy(a), n / len(b) if b else 0.0, _entropy(b))
        by = sum(map(piece.is_byte, a)) / max(len(a), 1)
        script = fertility.main_script(text or "")
        kind = "ascii" if script == "latin" and sum(len(c.encode()) for c in text if ord(c) > 127) <= fertility.MAX_HIGH * n else script
        low, most, most_bytes, least = fertility.BANDS[kind]
        fixed = low <= measure[0] <= most and by <= most_bytes and measure[1] >= least
        group = (lang or "", script, (len(a) ** 2).bit_length())
        seen[i] = (failed, fixed, group, measure)
        if not failed:
            classes[group].add(measure)
    want = {}
    for i, (failed, fixed, group, measure) in seen.items():
        fine = not failed and fixed
        for j, (unit, reach, share) in enumerate(fertility.CORPUS_BANDS.values()):
            v = sorted(math.floor(m[j] * unit) for m in classes.get(group, ()))
            if v:
                q1, q2, q3 = (v[math.ceil(len(v) * k / 4) - 1] for k in (1, 2, 3))
                fine = fine and measure[j] >= min(q1 - (reach + fertility.FEW / math.sqrt(len(v))) * (q3 - q1), q2 * (1 - share)) / unit
        want[i] = fine
    assert {k: v[0] for k, v in _kept(spark, rows).items()} == want


def test_copies_leave_the_bands_wide(spark, corpus):
    """A text held by most rows doesn't make the other texts outliers."""
    rows = [r for r in corpus if r[0] < 300]
    got = _kept(spark, rows + [(5000, rows[0][1], "xx")] * 1500)
    assert sum(got[i][0] for i in range(300)) >= 298
    assert got[5000] == [True] * 1500


def test_rows_come_back_as_they_were(spark):
    """Columns named like measures, nulls in them, repeated rows, a text column at another place."""
    rng = np.random.default_rng(3)
    text = _prose(rng, 80)
    rows = [("a", 1.5, text, None), ("a", 1.5, text, None), (None, None, text + " kalo", 4), ("b", 2.0, "short", 5), ("c", None, None, 6)]
    docs = spark.createDataFrame(rows, "kept string, entropy_share double, Text string, doc_id long")
    out = fertility.keep_fertile(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()[:3]))
    assert fertility.keep_fertile(docs.limit(0)).count() == 0


def test_texts_without_letters_have_a_band_of_their_own(spark):
    """Numbers go; letters of a script without a band of its own aren't taken for them; null and empty texts fail before."""
    tamil = " ".join(chr(0xB95 + i % 19) + chr(0xBBE + i % 3) + chr(0xBB0 + i * 7 % 9) for i in range(40))
    assert [fertility.main_script(t) for t in ("12-34 5", "", tamil, "12 a", "12 \u0431")] == ["none", "none", "other", "latin", "cyrillic"]
    numbers = " ".join(f"{i * 7919 % 1000:03d}-{i * 104729 % 10 ** 6:06d}" for i in range(1, 40))
    rows = fertility.fertility(spark.createDataFrame([(1, numbers, "xx"), (2, tamil, "xx"), (3, None, "xx"), (4, numbers + " and a few words", "xx")], SCHEMA)).collect()
    got = {r["doc_id"]: (r["script"], r["kept"]) for r in rows}
    assert got[1] == ("none", False) and got[2][0] == "other" and got[3][0] == "other" and got[4][0] == "latin"
