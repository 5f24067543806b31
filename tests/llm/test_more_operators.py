"""The line template rule, phrase groups, bounded samples and split buckets against plain versions."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from recordflow.llm import fmindex, kernel_quality, language, linetree, minhash


def _prose(seed, n, vocabulary=4000):
    rng = np.random.default_rng(seed)
    parts = ["ka", "lo", "mi", "ren", "to", "sa", "vu", "del", "pin", "gor"]
    return " ".join("".join(parts[int(c)] for c in str(x)) for x in rng.integers(vocabulary, size=n))


# ------------------------------------------------------------------- line rule

def _digit(token):
    return any(48 <= c <= 57 for c in token)


def plain_lines(rows, min_docs=5):
    """(id, text) after the rule of the module's docstring, written out line by line."""
    occ = defaultdict(set)
    for i, t in rows:
        if i is not None and t is not None:
            for line in t.split("\n"):
                key = tuple(line.encode().lower().split())
                if len(key) >= 5:
                    occ[key].add(i)
    leaves, made = defaultdict(list), defaultdict(list)  # made: line -> [(template, documents that make it recur)]
    for key in occ:
        leaves[len(key), tuple(b"\0" if _digit(t) else t for t in key[:3])].append(key)
    for leaf, keys in leaves.items():
        n, everyone = leaf[0], sum(len(occ[k]) for k in keys)
        enough = min(2, min_docs) if n > 50 else min_docs
        for k in keys:
            if everyone >= enough and len(occ[k]) >= enough:
                made[k].append((("line", k), enough))
        if len(keys) == 1 or everyone < min_docs:
            continue
        weight = Counter((s, t) for k in keys for s, t in enumerate(k) for _ in occ[k])
        chains = {}
        for k in keys:
            places = [(-weight[s, t], s, t) for s, t in enumerate(k) if weight[s, t] >= min_docs]
            top = max((-p[0] for p in places), default=0)
            places = sorted(p for p in places if not _digit(p[2]) or -p[0] >= 0.5 * top)
            words = sum(not _digit(t) for t in k)
            for size in range(math.ceil(0.6 * n), len(places) + 1):
                part = places[:size]
                if sum(s >= 3 for _, s, _ in part) < (n - 3) // 2 + 1:
                    continue
                if n < 8 and sum(not _digit(t) for _, _, t in part) < words:
                    continue
                chains[k] = [tuple((s, t) for _, s, t in part[:j + 1]) for j in range(size)]
                break
        have = Counter()
        for k, chain in chains.items():
            for step in chain:
                have[step] += len(occ[k])
        for k, chain in chains.items():
            before, short = everyone, 0
            for step in chain:
                shared = weight[step[-1]] == everyone
                now = everyone if shared else have[step]
                short += now < 0.5 * before
                before = now
            if short <= 1 and before >= min_docs:
                made[k].append((("template", leaf, chain[-1]), min_docs))
    docs = defaultdict(set)
    for k, found in made.items():
        for template, _ in found:
            docs[template] |= occ[k]
    lost = defaultdict(set)
    for k, found in made.items():
        for template, enough in found:
            if len(docs[template]) >= enough:
                for i in occ[k]:
                    if i != min(docs[template]):
                        lost[i].add(k)
    for i, t in rows:
        yield i, t if t is None or i is None else "\n".join(x for x in t.split("\n") if tuple(x.encode().lower().split()) not in lost[i])


def _mixed(seed, n):
    rng = np.random.default_rng(seed)
    words = ["red", "blue", "old", "new", "big", "far"]
    rows = []
    for i in range(n):
        lines = [f"user {rng.choice(words)} came in from host {rng.integers(5)} at port {rng.integers(999)} today ok",
                 "it was a " + " ".join(rng.choice(words, int(rng.integers(2, 8)))),
                 f"see page {rng.integers(3)} of the {rng.choice(words)} book",
                 "for all of us it is the " + " ".join(rng.choice(["x", "y"], 3)), "short one"]
        rng.shuffle(lines)
        rows.append((i if rng.random() > 0.05 else None, "\n".join(lines[:int(rng.integers(1, 6))])))
    return rows + [(1000, None), (1001, ""), (3, rows[3][1])]


@pytest.mark.parametrize("seed,n", [(1, 12), (2, 60), (3, 300)])
def test_line_rule_equals_the_plain_version(spark, seed, n):
    rows = _mixed(seed, n)
    got = linetree.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = Counter(plain_lines(rows))
    assert Counter((r["doc_id"], r["text"]) for r in got) == want and sum(t != dict(rows).get(i) for i, t in want) > 0


@pytest.mark.parametrize("n", [500, 20_000])
def test_lines_of_frequent_words_stay(spark, n):
    """Random nine-token lines with one beginning and words of 1/rank frequency: none that stands once is dropped."""
    rng = np.random.default_rng(n)
    words = np.array([f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)])
    share = 1 / np.arange(1, 401)
    lines = ["he said that " + " ".join(x) for x in words[rng.choice(400, (n, 6), p=share / share.sum())]]
    texts = Counter(lines)
    got = linetree.drop_recurring_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    dropped = [r["doc_id"] for r in got.where("text = ''").collect()]
    assert not [i for i in dropped if texts[lines[i]] == 1]


def test_columns_of_the_counts_are_replaced(spark):
    rows = [(i, "the same long line of words here", "x", 7, "lost") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n_dropped int, lost_lines string")
    got = linetree.drop_recurring_lines(df, counts=True).collect()
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["lost_lines"]) for r in got) == [(i, 1, int(i > 0), "lost") for i in range(6)]
    assert linetree.drop_recurring_lines(df).columns == df.columns


def test_very_long_lines(spark):
    long = _prose(5, 40_000)
    rows = [(0, long), (1, long + "\n" + _prose(6, 9)), (2, "x" * 200_000)]
    got = {r["doc_id"]: r["text"] for r in linetree.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: long, 1: _prose(6, 9), 2: rows[2][1]}


# ------------------------------------------------------------- phrase groups

@pytest.mark.parametrize("size", [2500])
def test_phrase_groups_find_what_one_group_finds(spark, monkeypatch, size):
    text = _prose(1, 400).split()
    docs = [(i, " ".join(text[9 * i:9 * i + 40])) for i in range(30)] + [(50, None), (51, ""), (52, " ".join(text)), (3, " ".join(text[27:67]))]
    items = [(i, " ".join(text[13 * i:13 * i + 6 + i])) for i in range(20)] + [(30, None), (None, "two words"), (31, text[5]), (31, " ".join(text[100:130]))]
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, found string, row int")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = Counter(map(tuple, fmindex.contamination(d, b).collect()))
    clean = Counter(map(tuple, fmindex.decontaminate(d, b).collect()))
    monkeypatch.setattr(fmindex, "GROUP_BYTES", size)
    assert Counter(map(tuple, fmindex.contamination(d, b).collect())) == want
    assert Counter(map(tuple, fmindex.decontaminate(d, b).collect())) == clean
    assert fmindex.decontaminate(d, b).schema == d.schema and any(r[-1] for r in want)
    # Against a plain scan.
    windows = defaultdict(set)
    for i, t in items:
        w = t.split() if t and i is not None else []
        for j in range(max(len(w) - 10, 0) + 1 if w else 0):
            windows[tuple(w[j:j + 10])].add(i)
    for i, t in docs:
        w, hit, found = (t or "").split(), set(), set()
        for p, owners in windows.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j:j + len(p)]) == p:
                    hit.update(range(j, j + len(p)))
                    found |= owners
        assert (i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)) in want


# ------------------------------------------------------------ language sample

def test_copies_leave_every_language_its_sample(spark, monkeypatch):
    """Thousands of copies of a few texts: the sample holds each text once, and each language is predicted."""
    seen = []
    real = language.Network.train
    monkeypatch.setattr(language.Network, "train", lambda self, by_length, **k: (seen.append(sum(len(w) for w, _ in by_length)), real(self, by_length, **k)))
    words = {"aa": "the and of that with from house water little", "bb": "der und die nicht mit haus wasser klein", "cc": "que para con agua casa nuestro donde"}
    rng = np.random.default_rng(4)
    few = {k: [" ".join(rng.choice(w.split(), 40)) for _ in range(4)] for k, w in words.items()}
    rows = [(i, few[k][int(rng.integers(4))], k) for i, k in enumerate(list(words) * 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs)
    assert {r["lang_pred"]: r["n"] for r in got.groupBy("lang_pred").count().withColumnRenamed("count", "n").collect()} == {k: 1500 for k in words}
    assert seen == [3 * 4 * 40]
    monkeypatch.setattr(language, "DOCS_PER_LANGUAGE", 2)
    language.train_network(docs)
    assert seen[-1] == 3 * 2 * 40


# ------------------------------------------------------------------- near-dedup

def _links(rows, words, percent=80):
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = frozenset(tuple(w[j:j + words]) for j in range(len(w) - words + 1))
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def test_ladder_of_similarities(spark):
    """Copies of 40 texts with more and more words changed: every link down to 0.8 is found, none below."""
    rows, rng = [], np.random.default_rng(3)
    for b in range(40):
        base = _prose(200 + b, 150).split()
        for step in range(8):
            other = list(base)
            for j in rng.choice(150, step, replace=False):
                other[j] = f"changed{b}x{step}y{j}"
            rows.append((b * 100 + step, " ".join(other)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()}
    assert got == _links(rows, 4)


@pytest.mark.parametrize("block", [4, 1024])
def test_strays_in_a_bucket_of_near_copies(spark, monkeypatch, block):
    """One large component and a few others that share its buckets."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    base = _prose(7, 200).split()
    rows = [(i, " ".join(w if j != i * 5 else f"n{i}" for j, w in enumerate(base))) for i in range(40)]
    rows += [(100 + k, " ".join(w if j % 23 != k else f"z{k}" for j, w in enumerate(base))) for k in range(6)]
    rows += [(200 + k, " ".join(w if j % 19 != k % 2 else f"y{k % 2}" for j, w in enumerate(base)) + f" t{k}") for k in range(6)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()}
    assert got == _links(rows, 4)


# ------------------------------------------------------------------ ridge scores

def test_scores_equal_a_plain_ridge(spark):
    """Normal equations, coefficients (by least squares on stacked rows) and the isotonic curve (by its max-min form)."""
    good = [(i, _prose(i, 60 + i % 40), 1) for i in range(160)]
    bad = [(1000 + i, " ".join(w + "##"[:i % 3] for w in _prose(i, 50).split()), 0) for i in range(120)]
    rows = good + bad
    y, x = np.array([q for _, _, q in rows], float), kernel_quality.statistics([t for _, t, _ in rows])
    fold = np.array([zlib.crc32(str(i).encode()) % 4 for i, _, _ in rows])
    known = fold != 2
    phi = kernel_quality.Cosines(x[known].mean(0), x[known].std(0), 11, kernel_quality.FEATURES)
    z, n = phi(x[fold < 2]), int((fold < 2).sum())
    table = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x[fold < 2], y[fold < 2])], "x array<double>, y double")
    a, b, count = kernel_quality._normal_equations(table, phi)
    assert count == n and np.allclose(a, z.T @ z) and np.allclose(b, z.T @ y[fold < 2])
    stacked = np.concatenate([z, np.sqrt(kernel_quality.RIDGE * n) * np.eye(z.shape[1])])
    beta = np.linalg.lstsq(stacked, np.concatenate([y[fold < 2], np.zeros(z.shape[1])]), rcond=None)[0]
    raw = np.clip(phi(x) @ beta, -0.5, 1.5) * kernel_quality.STEPS
    at, where = np.unique(np.round(raw[fold == 3]), return_inverse=True)
    hits, size = np.bincount(where, y[fold == 3]), np.bincount(where)
    curve = [max(min(hits[i:j + 1].sum() / size[i:j + 1].sum() for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in kernel_quality.score_quality(docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")).collect()}
    assert np.allclose([got[i] for i, _, _ in rows], np.interp(raw, at, curve), atol=1e-3)
