"""Components of link tables, and how much the driver plans for them."""

import contextlib
import io

import numpy as np
import pytest

from recordflow.llm import components as C
from recordflow.llm import minhash as M

SCHEMA = "a long, b long"


def _plain(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def _links(kind):
    rng = np.random.default_rng(5)
    if kind == "random":
        return [tuple(map(int, p)) for p in rng.integers(-40, 400, (260, 2))]
    if kind == "chain":
        at = [int(x) for x in rng.permutation(90)]
        return list(zip(at, at[1:]))
    if kind == "odd":
        return [(3, 3), (None, 4), (7, None), (5, 9), (9, 5), (5, 9), (9, 2), (2**62, -2**62)]
    return {"hub": [(50, i) for i in range(100)], "self": [(1, 1), (None, None)], "none": []}[kind]


@pytest.mark.parametrize("kind", ["random", "chain", "odd", "hub", "self", "none"])
def test_components_equal_a_plain_version(spark, kind):
    want = _plain(_links(kind))
    links = spark.createDataFrame(_links(kind), SCHEMA)
    got = [tuple(r) for r in C.connected_components(links).collect()]
    assert len(got) == len(want) and dict(got) == want
    stars = [tuple(r) for r in C.component_stars(links).collect()]
    assert sorted(stars) == sorted((x, c) for x, c in want.items() if x != c)


def test_a_step_reads_its_links_four_times(spark, tmp_out):
    """Each further scan, shuffle and join is planned anew in every step, in the driver's memory."""
    spark.createDataFrame(_links("random"), SCHEMA).write.parquet(f"{tmp_out}/links")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        C._small(C._large(spark.read.parquet(f"{tmp_out}/links"))).explain()
    assert buf.getvalue().count("FileScan") <= 4


def test_no_new_links_start_no_new_components(spark, monkeypatch):
    """Steps of the components run only for links that were found, and need no jobs of their own to see an end."""
    began = []
    real = M.component_stars
    monkeypatch.setattr(M, "component_stars", lambda links: (began.append(1), real(links))[1])
    texts = [" ".join(f"w{i}-{j}" for j in range(30)) for i in range(6)]
    docs = spark.createDataFrame([(i, texts[i % 6]) for i in range(12)] + [(12, texts[0] + " x"), (13, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(docs, words=4).collect()}
    assert got == {**{i: i % 6 for i in range(12)}, 12: 0, 13: 13}
    assert len(began) == 1
