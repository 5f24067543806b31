"""Centroid clustering, token counts and ranked search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from recordflow.llm import geometric, hadamard, token_counts
from recordflow.llm.tokens import vocabulary

VEC = "vec_id long, embedding array<float>, label int, cluster string"


def _plain_clusters(rows, k=8, rounds=10):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x):
            kept.append((i, [math.floor(1024 * v) if abs(v) < 2 ** 53 else int(v) * 1024 for v in map(float, np.array(x, np.float32))]))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(v) for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        mine = defaultdict(list)
        for (d, j), (_, v) in zip(assign(), kept):
            mine[j].append(v)
        for j, vs in mine.items():
            centroids[j] = [sum(col) // len(vs) for col in zip(*vs)]
    found = assign()
    inertia = Counter()
    for d, j in found:
        inertia[j] += d
    top = 2 ** 63 - 1
    return sorted((-1 if i is None else i, j, min(d, top), min(inertia[j], top), min(sum(inertia.values()), top),
                   hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, found))


def _clusters(spark, rows):
    df = spark.createDataFrame([(i, x, 1, "clash") for i, x in rows], VEC)
    out = hadamard.cluster(df)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in out.collect())


def _vectors(seed, n, scale=1.0):
    rng = np.random.default_rng(seed)
    return [[float(v) for v in x] for x in (rng.normal(size=(n, 64)) * scale).astype(np.float32)]


def test_clusters_equal_plain_kmeans(spark):
    v = _vectors(1, 120, 0.2)
    rows = list(enumerate(v)) + [(200, v[0]), (201, v[0]), (202, v[0][:63]), (203, None), (204, [None] + v[0][1:]), (205, [float("nan")] + v[0][1:]),
                                 (206, [float("inf")] + v[0][1:]), (None, v[3]), (7, v[7]), (207, [0.0] * 64)]
    assert _clusters(spark, rows) == _plain_clusters(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(i, x) for i, x in enumerate(_vectors(2, 3))], [(i, [0.5] * 64) for i in range(20)]])
def test_clusters_of_few_or_equal_vectors(spark, rows):
    assert _clusters(spark, rows) == _plain_clusters(rows)


@pytest.mark.parametrize("scale", [2000.0, 1e9, 1e30])
def test_clusters_of_large_components(spark, scale):
    rows = list(enumerate(_vectors(3, 30, scale)))
    assert _clusters(spark, rows) == _plain_clusters(rows)


def test_transform_and_elimination():
    x = np.random.default_rng(4).integers(-3000, 3000, (500, 64))
    t = hadamard.transform(x)
    assert ((t * t).sum(axis=1) == 64 * (x * x).sum(axis=1)).all()
    assert (t[:, 0] == x.sum(axis=1)).all() and (t[:, 1] == x[:, :32].sum(axis=1) - x[:, 32:].sum(axis=1)).all()
    near = np.repeat(x[:8], 60, axis=0) + np.random.default_rng(5).integers(-5, 5, (480, 64))
    number, distance, work = hadamard.nearest(near, x[:8])
    plain = ((near[:, None, :] - x[None, :8, :]) ** 2).sum(axis=2)
    assert (number == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert work < 480 * 8 * 64 / 2  # clear winners leave most fine coefficients uncomputed


def _odd_texts():
    r = random.Random(6)
    words = ["the", "don't", "über", "日本語", "x1y2", "...", "12345", "a<|endoftext|>b", "<|endoftext|>", "!?", "\x1c", "　", " ", "é"]
    gaps = [" ", "  ", "\n", "\t", " \n ", "\r\n", "   "]
    texts = ["".join(r.choice(words) + r.choice(gaps) for _ in range(n)) for n in (1, 3, 50, 400, 3000)]
    return texts + ["", " ", "x" * 5000, "日本語。" * 2000, "ab12" * 3000, "a " * 4000, "\n".join(["line of text"] * 800), "a  b   c ", "  lead and trail  "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_split_texts(name):
    path, texts = vocabulary(name), _odd_texts()
    if name.endswith(".json"):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    else:
        import sentencepiece
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    model = token_counts.counter(path)
    assert model.place is not None
    assert any(len(model.split(t, 100)) > 3 for t in texts)
    for size in (1, 2, 7, 100, 1 << 15):
        assert model.count(texts, size).tolist() == want, size
    assert model.count([]).tolist() == []


def test_token_counts(spark):
    from tokenizers import Tokenizer
    path = vocabulary("byte_bpe_50k.json")
    texts = [*_odd_texts(), None, "same", "same", "long text " * 30000]
    rows = [(None if i == 2 else i, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    tok = Tokenizer.from_file(path)
    want = []
    for i, t, _ in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((-1 if i is None else i, len((t or "").encode()), n, n > 512))
    got = token_counts.token_counts(df, path)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got.collect()) == sorted(want)
    assert token_counts.token_counts(df.where("false"), path).count() == 0


_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _term_list(text):
    return _TERM.findall("".join(c.lower() if c.isascii() else c for c in text)) if text else []


def _plain_search(docs, items, k=10):
    words = [(i, Counter(_term_list(t))) for i, t in docs]
    total = sum(sum(c.values()) for _, c in words)
    n = sum(1 for _, c in words if c)
    df = Counter(t for _, c in words for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(_term_list(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c in words:
            m = 10 + 90 * sum(c.values()) * n // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def collection():
    r = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(r.choices(vocabulary, weights, k=r.choice([5, 40, 200])))) for i in range(400)]
    items = [(i, " ".join(r.choices(vocabulary, weights, k=30)) + ("" if i % 3 else " " + docs[i][1])) for i in range(25)]
    docs += [(500 + i, docs[3][1]) for i in range(90)] + [(600, None), (601, ""), (602, " .,; "), (None, docs[0][1]), (1, docs[1][1]),
             (603, "W1 " * 20000 + "Größe ÄÖ 日本 x1"), (604, docs[9][1].upper())]
    items += [(100, None), (101, ""), (102, "größe äö 日本 X1"), (103, "absent words only"), (104, docs[3][1]), (104, "w77 w78"), (None, docs[5][1])]
    return docs, items


@pytest.mark.parametrize("shard,block,pairs", [(1_000_000, 64, 200_000), (900, 4, 60)])
def test_ranked_search(spark, collection, monkeypatch, shard, block, pairs):
    monkeypatch.setattr(geometric, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(geometric, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(geometric, "BLOCK_DOCS", block)
    docs, items = collection
    d = spark.createDataFrame([(*x, 1.5, "clash") for x in docs], "doc_id long, text string, score double, row string")
    q = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, rank string")
    got = geometric.ranked_search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _plain_search(docs, items)


def test_ranked_search_of_nothing(spark, collection):
    d = spark.createDataFrame(collection[0], "doc_id long, text string")
    q = spark.createDataFrame(collection[1], "item_id long, text string")
    assert geometric.ranked_search(d.where("false"), q).count() == 0
    assert geometric.ranked_search(d, q.where("false")).count() == 0
    assert geometric.ranked_search(d.where("doc_id = 601"), q).count() == 0
    assert geometric.blocked_index(d, q.where("false")).count() == 0


def test_blocks_and_bounds(spark, collection, monkeypatch):
    """Every document of a term's list is in one block, summaries are maxima, and blocks are skipped."""
    monkeypatch.setattr(geometric, "BLOCK_DOCS", 4)
    docs, items = collection
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = geometric.blocked_index(d, q).collect()
    lists = defaultdict(list)
    for r in rows:
        lists[r["term"]] += r["documents"]
        assert r["term"] in r["summary"] and min(r["summary"].values()) > 0
    want = defaultdict(list)
    for i, t in docs:
        for term in set(_term_list(t)):
            want[term].append(i)
    n = sum(1 for _, t in docs if _term_list(t))
    for term, members in lists.items():
        assert sorted(members, key=str) == sorted(want[term], key=str)
    asked = {t for _, x in items for t in _term_list(x)}
    assert {t for t in asked if t in want and (2 * n + 2) / (2 * len(want[t]) + 1) >= math.exp(0.001)} == set(lists)

    rng = np.random.default_rng(8)
    doc = np.repeat(np.arange(400), 12)
    term = np.concatenate([rng.choice(60, 12, replace=False) + 60 * (i % 5) for i in range(400)])
    share = rng.integers(1, 10 ** 6, len(doc))
    queries = [np.sort(rng.choice(60, 8, replace=False) + 60 * (i % 5)) for i in range(20)]
    shard = geometric.Shard(doc, term, share, 400, 300, queries)
    skipped = 0
    for i, found, scores, _, left in shard.search(10):
        plain = np.bincount(doc, weights=np.where(np.isin(term, queries[i]), share, 0), minlength=400).astype(int)
        best = np.sort(plain[plain > 0])[::-1][:10]
        assert np.sort(scores)[::-1][:10].tolist() == best.tolist() and (plain[found] == scores).all()
        skipped += left
    assert skipped > 0
