"""The training-data operators against plain versions on small fixtures."""

import hashlib
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from recordflow.llm import fertility, fmindex, kernel_quality, language, linetree, minhash, packing, rans, tokens, urlfilter, warc
from recordflow.llm.files import open_folder
from recordflow.session import run_dir

DOC = "doc_id long, text string, lang string, source string"


def _prose(seed, n, vocabulary=4000):
    rng = np.random.default_rng(seed)
    parts = ["ka", "lo", "mi", "ren", "to", "sa", "vu", "del", "pin", "gor"]
    return " ".join("".join(parts[int(c)] for c in str(x)) for x in rng.integers(vocabulary, size=n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, exact and near copies, a chain."""
    base = _prose(1, 300).split()
    near = [" ".join(w if j != 10 * i + 5 else "changed" for j, w in enumerate(base)) for i in range(12)]
    chain = [" ".join(base[8 * i:8 * i + 120]) for i in range(6)]
    rows = [(i, t, "en", "s0") for i, t in enumerate(near)]
    rows += [(100 + i, t, "en", "s1") for i, t in enumerate(chain)]
    rows += [(200 + i, " ".join(base), "en", "s0") for i in range(20)]
    rows += [(300, "", "en", None), (301, None, None, "s1"), (302, " \n\t ", "de", "s1"), (303, "two words", "de", "s2"), (304, "two words", "de", "s2"),
             (305, _prose(2, 30000), "en", "s2"), (306, "x" * 100_000, "en", "s2"), (307, _prose(3, 400), "fr", "s2"), (307, _prose(3, 400), "fr", "s2"),
             (None, " ".join(base), "en", "s0"), (308, "déjà  vu\n\nÉté ici <|endoftext|> \x1c 日本 ok ", "fr", "s0"), (309, "123 456 !!", None, "s0")]
    return spark.createDataFrame([(*r, "clash") for r in rows], DOC + ", n long".replace("long", "string"))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC)


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def _set(text, k):
    w = text.encode().lower().split() if text else []
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[j:j + k]) for j in range(len(w) - k + 1)])


def test_near_duplicates(docs, nothing):
    rows = [(i, _set(t, 4)) for i, t in _pairs(docs) if i is not None]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in rows:
        for j, b in rows:
            if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(docs, words=4).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(dict(rows)[r["doc_id"]]), root(r["doc_id"]))
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert minhash.near_duplicates(nothing).count() == 0


def test_blocks_cut_up_a_bucket(spark, docs, monkeypatch):
    want = {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs, words=4).collect()}
    monkeypatch.setattr(minhash, "BLOCK", 3)
    assert {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs, words=4).collect()} == want


def _tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary(name))


@pytest.mark.parametrize("name,spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_chunked_encoding_equals_direct(docs, name, spaces):
    t, e = _tokenizer(name), tokens.ChunkEncoder(tokens.vocabulary(name), spaces)
    texts = [x or "" for _, x in _pairs(docs)] + ["  a  b ", "\n\nx y", " lead", "a\n", "\tfoo bar", "x ̈y", "'s don't I'LL\r\n q", "...\x01 ok", "a \x01 b", "a\n\nb  c \n d\n e", " \n x", "\n\n", "a   b", "a \n\nb", "end  ", "end\n\n", " ", "\n", "tab\tx  y",
                                                    "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|startoftext|>  y", "A <|ENDOFTEXT|> b", "<| endoftext"]
    texts = [x for x in texts if len(x) < 50_000]
    ids, per = e.encode(texts)
    ends = np.concatenate([[0], np.cumsum(per)])
    for k, x in enumerate(texts):
        assert ids[ends[k]:ends[k + 1]].tolist() == t.encode(x, add_special_tokens=False).ids, x[:80]


def test_large_vocabularies_are_refused(tmp_path):
    from tokenizers import Tokenizer, models

    Tokenizer(models.WordLevel({str(i): i for i in range(70_001)}, unk_token="0")).save(str(tmp_path / "big.json"))
    with pytest.raises(ValueError):
        tokens.ChunkEncoder(str(tmp_path / "big.json"), False)


@pytest.mark.parametrize("name,spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_white_space_runs_and_marks_equal_direct(name, spaces):
    rng = np.random.default_rng(12)
    t, e = _tokenizer(name), tokens.ChunkEncoder(tokens.vocabulary(name), spaces)
    for size in (2, 4, 8, 30):
        texts = ["".join(rng.choice(["a", "bc", " ", "\n", " ", "d", ".", "é", ", ", ". ", "x, ", "Don't", "7", "…", "”, ", "'s", "!\n", "ab. "], size)) for _ in range(1500)]
        ids, per = e.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("name,spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_chunks_with_nul(name, spaces):
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(tokens.vocabulary(name)), tokens.ChunkEncoder(tokens.vocabulary(name), spaces)
    texts = ["bar baz", "foo \x00bar baz", "\x00bar baz", "a \x00 b", "\x00", " \x00\x00x", "a\n\x00b", "foo bar"]
    ids, per = e.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_packing(docs, nothing):
    t = _tokenizer("word_bpe_49k.json")
    got = packing.pack(docs, size=256).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, x in _pairs(docs):
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4")
        own = sorted(by_doc[i], key=lambda r: r["start"])
        copies = sum(1 for j, _ in _pairs(docs) if j == i)
        assert sum(r["length"] for r in own) == copies * len(ids) and {r["doc_tokens"] for r in own} == {len(ids)}
        assert all(zlib.crc32(ids[r["start"]:r["start"] + r["length"]]) == r["ids_crc32"] for r in own)
    padded = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= 256
        padded += at & (at - 1) > 0
    assert padded == 0 and sorted(by_seq) == list(range(len(by_seq)))
    assert packing.pack(nothing).count() == 0


def test_stated_weights_fill_every_window(spark):
    """Three sources at 5 : 3 : 2, the last of them short: shares hold per window until a queue ends, then the rest fill up."""
    rows = [(i, _prose(i, 120), "abc"[i % 3]) for i in range(60)] + [(100 + i, _prose(100 + i, 40), "c") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").where("source <> 'c' OR doc_id < 30 OR doc_id >= 100")
    got = packing.pack(docs, size=256, weights={"a": 5, "b": 3, "c": 2}).collect()
    total, by_seq = Counter(), defaultdict(Counter)
    for r in got:
        total[r["source"]] += r["length"]
        by_seq[r["sequence_id"]][r["source"]] += r["length"]
    shares, served = {"a": 0.5, "b": 0.3, "c": 0.2}, Counter()
    first_end = min(total[s] / shares[s] for s in shares)
    for n, seq in enumerate(sorted(by_seq)):
        served += by_seq[seq]
        if 256 * (n + 1) < first_end - 256:
            assert sum(by_seq[seq].values()) == 256 and all(abs(served[s] - 256 * (n + 1) * shares[s]) <= 1 for s in shares)
    assert served == total


def test_mixture_is_the_sequential_round_robin():
    rng = np.random.default_rng(4)
    for _ in range(20):
        k = int(rng.integers(1, 7))
        n, w = rng.integers(1, 400, k), rng.random(k) + 0.01
        mix = packing.Mixture(n, w, 16)
        order = sorted(((i + 0.5) / w[s], s) for s in range(k) for i in range(n[s]))
        a = mix.served(np.arange(mix.windows + 1))
        for v in range(mix.windows + 1):
            assert a[v].tolist() == np.bincount([s for _, s in order[:16 * v]], minlength=k).tolist()


def test_warc(spark, tmp_path_factory):
    big = "<p>é</p>" * 40
    rows = [(5, "http://a", big), (3, None, big), (None, "http://n", big), (9, "x\r\ny", "small"), (8, "u", "small"), (7, "u", None), (6, "u", ""), (3, None, big)]
    rows += [(100 + i, f"http://h/{i}", f"page {i} " * 30) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = run_dir(spark, "test-warc")
    manifest = warc.write_archives(pages, folder, roll_bytes=1500)
    got = warc.read_archives(manifest, folder).collect()
    assert sum(r["records"] for r in manifest.collect()) == len(rows) == len(got)
    files = manifest.collect()
    assert len(files) > 3
    system, path = open_folder(folder)
    for f in files:
        with system.open_input_file(f"{path}/{f['file']}") as src:
            assert hashlib.sha256(src.read()).hexdigest() == f["sha256"]
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = html == big and i != 3
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    again = run_dir(spark, "test-warc")
    assert sorted(map(tuple, warc.write_archives(pages, again, roll_bytes=1500).collect())) == sorted(map(tuple, files))
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_fertility_counts(docs, nothing):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    got = defaultdict(list)
    for r in fertility.fertility(docs).collect():
        got[r["doc_id"]].append(r)
    for i, t in _pairs(docs):
        w = word.findall(t or "")
        lines = [x for x in (t or "").split("\n") if word.search(x)]
        win, hit = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4)), set()
        for j in range(len(w) - 4):
            if win[tuple(w[j:j + 5])] > 1:
                hit.update(range(j, j + 5))
        r = got[i][0]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w)) and not (r["kept"] and r["base_failed"])
    assert fertility.keep_fertile(docs).count() == sum(r["kept"] for rs in got.values() for r in rs)
    assert fertility.fertility(nothing).count() == fertility.keep_fertile(nothing).count() == 0


def test_fertility_rejects_bytes_and_repetition(spark):
    rng = np.random.default_rng(0)
    junk = " ".join("".join(chr(int(c)) for c in rng.integers(0x1D400, 0x1D4FF, 8)) for _ in range(60))
    mono = " ".join(f"{a}{b}" for a in "ab" for b in "ab" for _ in range(60))
    prose = "The committee met in the old town hall to discuss how the new railway would change trade between both valleys, and nobody agreed."
    got = {r["doc_id"]: r["kept"] for r in fertility.fertility(spark.createDataFrame([(1, junk), (2, mono), (3, prose)], "doc_id long, text string")).collect()}
    assert got == {1: False, 2: False, 3: True}


def test_fertility_rejects_random_letters(spark):
    rng = np.random.default_rng(0)
    prose = ["The committee met in the old town hall to discuss how the new railway would change trade between both valleys, and nobody agreed.",
             "Người dân ở thành phố này thường uống cà phê vào buổi sáng trước khi đi làm việc tại các công ty lớn",
             "Watu wa mji huu hunywa kahawa asubuhi kabla ya kwenda kazini katika makampuni makubwa ya kigeni",
             "THE COMMITTEE MET IN THE OLD TOWN HALL TO DISCUSS HOW THE NEW RAILWAY WOULD CHANGE TRADE & WORK"]
    junk = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(400))]
    got = {r["doc_id"]: r["kept"] for r in fertility.fertility(spark.createDataFrame(list(enumerate(prose + junk)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(5)] == [True] * 4 + [False]


def test_url_filter(spark):
    urls = ["http://A.com/x", "https://sub.com", "http://example.com/en/1", "http://www.example.com/en/2", "http://x.net/es/", "http://x.net/de/", "ftp://list.org/a/?utm_source=1&b=2&a=1",
            "no scheme", None, "", "http://www.list.org/a?a=1&b=2#top", "http://list.org/A?a=1&b=2", "://"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, urls[10])], "page_id long, url string")
    listed = spark.createDataFrame([("http://list.org/a?b=2&a=1",), (None,), ("bad",)], "url string")
    got = {r["page_id"]: r for r in urlfilter.judge(pages, listed).collect() if r["page_id"] is not None}
    assert [got[i]["verdict"] for i in range(len(urls))] == ["allow", "allow", "block", "allow", "block", "allow", "block", "allow", "allow", "allow", "block", "allow", "allow"]
    assert [got[i]["rule"] for i in range(5)] == ["com/", None, "example.com/en/", "www.example.com/en/", "net/es/"]
    assert (got[0]["host"], got[0]["path"], got[8]["host"], got[1]["path"]) == ("a.com", "/x", "", "")
    assert urlfilter.judge(pages, listed.limit(0)).where("listed").count() == 0 and urlfilter.judge(pages.limit(0), listed).count() == 0


def test_bloom_filter_has_no_false_negative(spark):
    urls = spark.range(3000).selectExpr("concat('h', id, '/p') AS url")
    blooms, blocks = urlfilter.bloom_filter(urls, 3000)
    from pyspark.sql import functions as F

    hit = None
    for i in range(urlfilter.WORDS):
        test = F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) != 0
        hit = test if hit is None else hit & test
    probe = lambda df: urlfilter._bits(df, blocks).join(blooms, "block").where(hit).count()
    assert probe(urls) == 3000
    assert probe(spark.range(5000, 25000).selectExpr("concat('h', id, '/p') AS url")) < 600


def test_quality_scores(spark, nothing):
    good = [(i, _prose(i, 80 + i % 50), 1) for i in range(200)]
    bad = [(1000 + i, " ".join(w + "!!" for w in _prose(i, 60).upper().split()), 0) for i in range(100)]
    rows = good + bad
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (5000, ""), (1, good[1][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (3, None), (99999, 0)], "doc_id long, quality int")
    got = kernel_quality.score_quality(docs, labels).collect()
    truth = {i: q for i, _, q in rows}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in got if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held if r["doc_id"] in truth]) > 0.95
    assert {r["score"] for r in kernel_quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert kernel_quality.score_quality(nothing, labels).count() == 0


def test_isotonic_is_the_best_rising_fit():
    got = kernel_quality.isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 0, 2, 3]), np.array([1.0, 1, 4, 3]))
    assert np.allclose(got, [0.5, 0.5, 0.5, 1.0])


def test_rans_blocks():
    rng = np.random.default_rng(3)
    for n in (1, 5, 1000, 70_000):
        ids = np.minimum(rng.geometric(0.01, n), 50_000).astype(np.uint16)
        f = rans.frequencies(np.bincount(ids, minlength=1 << 16))
        assert f.sum() == 1 << rans.SCALE and (f[np.unique(ids)] > 0).all()
        coder = rans.Coder(f)
        per = np.array([n - n // 3, n // 3])
        raw = rans.pack_block(coder, [7, None], per, ids)
        docs, sizes, back = rans.unpack_block(coder, raw)
        assert docs == [7, None] and sizes.tolist() == per.tolist() and (back == ids).all()
        with pytest.raises(ValueError):
            rans.unpack_block(coder, raw[:-1] + bytes([raw[-1] ^ 1]))


def test_rans_files(spark, docs, nothing):
    t = _tokenizer("byte_bpe_50k.json")
    got = sorted(rans.ids_round_trip(docs).collect(), key=lambda r: r["start"])
    enc = defaultdict(list)
    for i, x in _pairs(docs):
        enc[i].append(np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4"))
    at, last = 0, None
    for r in got:
        assert r["start"] == at and (last is None or r["doc_id"] >= last)
        assert any(len(e) == r["n_tokens"] and zlib.crc32(e) == r["ids_crc32"] for e in enc[r["doc_id"]])
        at += r["n_tokens"]
        last = r["doc_id"]
    assert len(got) == docs.count()
    assert rans.ids_round_trip(nothing).count() == 0


def _contaminated(rows, items, window=10):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    win = defaultdict(set)
    for i, t in items:
        w = word.findall(t.encode().lower()) if t else []
        for j in range(max(len(w) - window, 0) + 1 if w else 0):
            win[tuple(w[j:j + window])].add(i)
    sizes = {len(k) for k in win}
    for i, t in rows:
        w, hit, found = word.findall(t.encode().lower()) if t else [], set(), set()
        for j in range(len(w)):
            for n in sizes:
                k = tuple(w[j:j + n])
                if len(k) == n and k in win:
                    hit.update(range(j, j + n))
                    found |= win[k]
        yield i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), len(hit) > 0


def test_decontamination(spark, docs, nothing):
    base = _prose(1, 300)
    items = [(1, " ".join(base.split()[20:45])), (2, "W7 two-words"), (3, "vu\nété"), (12, " ".join(base.split()[30:42])), (4, None), (5, "..."), (None, "two words"), (6, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(map(tuple, fmindex.contamination(docs, bench).collect()))
    assert got == Counter(_contaminated(_pairs(docs), [x for x in items if x[0] is not None]))
    clean = fmindex.decontaminate(docs, bench)
    assert clean.schema == docs.schema and clean.count() == docs.count()
    before = {i: t for i, t in _pairs(docs)}
    for i, t in _pairs(clean):
        if t == before[i]:
            continue
        assert len(t) < len(before[i])
    assert before[307] == dict(_pairs(clean))[307] and dict(_pairs(clean))[303] == ""
    assert fmindex.contamination(nothing, bench).count() == 0 and fmindex.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(9)
    for n in (1, 2, 50, 3000):
        s = rng.integers(1, 5, n)
        index = fmindex.FMIndex(s, 5)
        for size in (1, 2, 5):
            for _ in range(10):
                p = rng.integers(1, 5, size)
                lo, hi = index.search(p[None, :], np.array([size]))
                found = sorted(index.locate(np.arange(lo[0], max(lo[0], hi[0]))).tolist())
                assert found == [i for i in range(n - size + 1) if (s[i:i + size] == p).all()]


def _plain_lines(rows, min_docs=5):
    def parts(line):
        return tuple("\0" if any(48 <= c <= 57 for c in t) else t for t in line.encode().lower().split())

    occ = defaultdict(set)
    for i, t in rows:
        for line in t.split("\n") if i is not None and t is not None else ():
            if len(parts(line)) >= linetree.MIN_TOKENS:
                occ[parts(line)].add(i)
    leaves, template = defaultdict(list), {}
    for k in occ:
        leaves[len(k), k[:linetree.DEPTH]].append(k)
    for leaf, ks in leaves.items():
        if sum(len(occ[k]) for k in ks) < min_docs:
            continue
        n = Counter((p, x) for k in ks for p, x in enumerate(k) for _ in occ[k])
        for k in ks:
            m = k if len(ks) == 1 else tuple((p, x) for p, x in enumerate(k) if x != "\0" and n[p, x] >= min_docs)
            template[k] = (leaf, m), (sum(x != "\0" for x in k) if len(ks) == 1 else len(m)) / len(k)
    docs = defaultdict(set)
    for k, (t, share) in template.items():
        if share >= linetree.CONSTANT:
            docs[t] |= occ[k]
    for i, t in rows:
        keep = []
        for line in t.split("\n") if t is not None else ():
            x = template.get(parts(line))
            if not (i is not None and x and x[1] >= linetree.CONSTANT and len(docs[x[0]]) >= min_docs and min(docs[x[0]]) != i):
                keep.append(line)
        yield i, None if t is None else "\n".join(keep)


def test_line_templates(spark, nothing):
    rows = [(i, f"{_prose(i, 12)}\nUser logged in as bob{'abcdefghijklmnop'[i]} from host ten\nPosted on 2024-01-{i:02d} by the site team\n\n{_prose(50 + i, 9)}\nshort line") for i in range(16)]
    rows += [(50, None), (51, ""), (None, rows[0][1]), (3, rows[3][1]), (52, "User logged in as bob from host ten\r\n"), (53, "\n".join(["same line of five words"] * 9))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_lines string")
    got = linetree.drop_recurring_lines(docs)
    assert got.schema == docs.schema
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(_plain_lines(rows))
    kept = {r["doc_id"]: r["text"] for r in got.collect()}
    assert "Posted on" in kept[0] and "Posted on" not in kept[7] and "logged in" not in kept[7] and "short line" in kept[7]
    assert linetree.drop_recurring_lines(nothing).count() == 0


@pytest.mark.parametrize("n", [30, 300, 10_000])
def test_line_templates_at_any_size(spark, n):
    """Fields with 40 values each: the values recur in a large leaf, the template is one all the same."""
    names = ["".join("abcdefghij"[int(c)] for c in f"{i:02d}") for i in range(40)]
    rng = np.random.default_rng(n)
    rows = [(i, "user logged in as {} from {} via {} today".format(*(names[int(j)] for j in rng.integers(40, size=3)))) for i in range(n)]
    got = {r["doc_id"]: r["text"] for r in linetree.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, t in got.items() if t] == [0]


def test_long_lines_recur_in_two_documents(spark):
    long, short = _prose(70, 51), _prose(71, 50)
    rows = [(i, f"{long}\n{short}\n{_prose(80 + i, 60)}") for i in range(2)] + [(2, long + " end")]
    got = {r["doc_id"]: r["text"] for r in linetree.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: rows[0][1], 1: rows[1][1][len(long) + 1:], 2: rows[2][1]}


def test_equal_digits_are_constant(spark):
    """2 of 8 tokens differ; the other 6 are constant, two of them with digits."""
    rows = [(i, "see rfc 2616 section 14 page " + _prose(90 + i, 2)) for i in range(6)]
    got = {r["doc_id"]: r["text"] for r in linetree.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, t in got.items() if t] == [0]


def test_different_lines_that_begin_alike_stay(spark):
    ends = ["cold night", "long road", "small house", "quiet town", "warm day", "cold day", "long night"]
    rows = [(i, f"it was a {x}\nso they said that it {x}\nfor all of us it is a {x} {_prose(110 + i, 3)}\non day {i} it was {x.split()[1]}\non day {i} they all left") for i, x in enumerate(ends)]
    got = {r["doc_id"]: r["text"] for r in linetree.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: t if i == 0 else t.rsplit("\n", 1)[0] for i, t in rows}


def test_language(spark, nothing):
    words = {"aa": "the and of that with from house water little", "bb": "der und die nicht mit haus wasser klein schön", "cc": "que para con agua casa niño pequeño está"}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[k].split(), 30)), k) for i, k in enumerate(list(words) * 60)]
    rows += [(900, None, "aa"), (901, "", None), (902, "123 !!", "bb"), (903, "the house " * 20_000, None), (None, "der und die", "bb"), (1, rows[1][1], "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    held = [(by[i]["lang_pred"], k) for i, _, k in rows[:180] if by[i]["held_out"]]
    assert held and np.mean([a == b for a, b in held]) > 0.95
    assert language.identify(nothing).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs.selectExpr("doc_id", "text", "CAST(null AS string) AS lang")).collect()} == {"und"}


def test_gradients_are_the_slopes_of_the_loss():
    net = language.Network(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, langs = np.frombuffer(b"abcabdxyzqrs", np.uint8).reshape(3, 4), np.array([0, 2, 1])
    loss = lambda: -net.label(words)[np.arange(3), :, langs].mean()
    g = net.gradients(words, langs)
    rng = np.random.default_rng(0)
    for k, p in net.p.items():
        for _ in range(6):
            i = tuple(int(rng.integers(n)) for n in p.shape) if not k.startswith("x") else (int(rng.choice(words.ravel())), int(rng.integers(p.shape[1])))
            old, eps = p[i], 1e-5
            p[i] = old + eps
            up = loss()
            p[i] = old - eps
            slope, p[i] = (up - loss()) / (2 * eps), old
            assert abs(slope - g[k][i]) < 1e-5, (k, i)


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline as c

    (tmp_path / "t").mkdir()
    bench = spark.createDataFrame([(1, _prose(3, 400)[100:300])], "item_id long, text string")
    folder = run_dir(spark, f"test-pipeline-{uuid.uuid4().hex}")
    docs.write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    d = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, d, folder)
        assert out.columns == docs.columns, name
        d = out
    assert c.run(spark, folder).count() > 0
    assert c.run(spark, folder).columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
