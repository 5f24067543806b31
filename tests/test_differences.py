"""Column differences, digest trees, landing profiles, exact times in fingerprints."""

import contextlib
import datetime as dt
import io
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from recordflow.operators import differences as D
from recordflow.operators import quality as Q
from recordflow.operators import reconcile as R
from recordflow.sources import recon_fixtures as RF
from recordflow.sources import testdata as td

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from("ab|\\")), st.one_of(st.none(), st.integers(0, 2))),
                min_size=0, max_size=25)
KIND = "K long, A string, B long"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@settings(**SETTINGS)
@given(rows, rows)
def test_column_diff_equals_brute_force(spark, src, tgt):
    got = {(r["K"], r["column_name"]): tuple(r)[2:] for r in D.column_diff(spark.createDataFrame(src, KIND), spark.createDataFrame(tgt, KIND), "K").collect()}
    want = {}
    for k in {r[0] for r in src} & {r[0] for r in tgt}:
        for i, c in ((1, "A"), (2, "B")):
            a, b = Counter(r[i] for r in src if r[0] == k), Counter(r[i] for r in tgt if r[0] == k)
            more, less = a - b, b - a
            if more or less:
                def text(x):
                    return min((str(v) for v in x if v is not None), default=None)
                want[k, c] = (text(more), text(less), sum(more.values()), sum(less.values()))
    assert got == want


def test_column_diff_counts_and_key_only_tables(spark):
    s = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, None, 3)], KIND)
    t = spark.createDataFrame([(1, "x", 1), (2, "b", 2), (3, "c", None)], KIND)
    got = {r["column_name"]: tuple(r)[1:] for r in D.column_diff_counts(D.column_diff(s, t, "K")).collect()}
    assert got == {"A": (2, 0, 1), "B": (2, 1, 1)}
    assert D.column_diff(s.select("K"), t.select("K"), "K").count() == 0


def test_columns_of_matching_keys_are_not_shuffled(spark):
    """The rows go through a broadcast semi join with the mismatching keys before the only shuffle."""
    o = td.read_table(spark, SF001, "orders")
    t = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 101 == 0, "X").otherwise(F.col("o_orderstatus")))
    p = plan(D.column_diff(o, t, "o_orderkey"))
    tree = p[:p.index("\n\n")]
    last_exchange = [n for n, line in enumerate(tree.splitlines()) if re.search(r"\bExchange\b", line)][-1]
    joins = [n for n, line in enumerate(tree.splitlines()) if "BroadcastHashJoin LeftSemi" in line]
    assert len(joins) == 2 and min(joins) > last_exchange and "SortMergeJoin" not in tree


def test_digest_tree_leaves_agree_with_row_diff(spark):
    src = RF.source(spark, SF001)
    for name, tgt in RF.targets(src).items():
        got = {(r["range_lo"], r["range_hi"]) for r in D.digest_tree(src, tgt, "ORDER_ID", 16, fanout=8).collect()}
        low = src.select("ORDER_ID").unionByName(tgt.select("ORDER_ID")).agg(F.min("ORDER_ID")).first()[0]
        bad = R.row_diff(src, tgt, "ORDER_ID").where("status <> 'match'").select("ORDER_ID").collect()
        want = {(low + (r[0] - low) // 16 * 16, low + (r[0] - low) // 16 * 16 + 15) for r in bad}
        assert got == want, name


def test_digest_tree_of_other_keys(spark):
    a = [(None, 1), ("x", 2), ("y", 3), ("z", 4)]
    s, t = spark.createDataFrame(a, "K string, V int"), spark.createDataFrame([(None, 9), *a[1:3], ("z", 5), ("w", 6)], "K string, V int")
    got = D.digest_tree(s, t, "K", leaf_width=1).collect()
    assert Counter((r["range_lo"] is None, r["source_rows"], r["target_rows"]) for r in got) == Counter([(True, 1, 1), (False, 1, 1), (False, 0, 1)])
    assert D.digest_tree(s, s, "K").count() == 0
    none = s.where("K IS NULL")
    assert D.digest_tree(none, none, "K").count() == 0 and D.digest_tree(s.limit(0), s.limit(0), "K").count() == 0
    times = spark.createDataFrame([(dt.datetime(2024, 1, d), d) for d in range(1, 9)], "K timestamp_ntz, V int")
    day = 86_400_000_000
    got = D.digest_tree(times, times.withColumn("V", F.when(F.col("V") == 3, 0).otherwise(F.col("V"))), "K", leaf_width=day, fanout=2).collect()
    start = int((dt.datetime(2024, 1, 3) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    assert [tuple(r) for r in got] == [(start, start + day - 1, 1, 1)]


def test_tree_levels_read_only_differing_ranges(spark, monkeypatch):
    src = RF.source(spark, SF001)
    tgt = src.withColumn("ST", F.when(F.col("ORDER_ID") == 1000, "X").otherwise(F.col("ST")))
    plans, real = [], D._cells

    def spy(*a):
        out = real(*a)
        plans.append(plan(out))
        return out

    monkeypatch.setattr(D, "_cells", spy)
    assert D.digest_tree(src, tgt, "ORDER_ID", 16, fanout=8).count() == 1
    assert len(plans) >= 3 and "GreaterThanOrEqual(o_orderkey" not in plans[0]
    assert all(re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderkey", p) for p in plans[1:])


def test_landing_reads_the_source_once(spark, tmp_out, monkeypatch):
    src = td.entity(spark, SF001, "ORDER_PROC")
    seen = []
    monkeypatch.setattr(R, "duplicate_profile", lambda *a: seen.append(a) or Q.duplicate_profile(*a))
    same = R.reconcile_landing("ORDER_PROC", src, tmp_out + "/a").report.first()
    assert same["overall_match"] and same["source_checksum"] == R.fingerprint(src).first()[0] and not seen
    assert same.asDict() == R.reconcile([("ORDER_PROC", src, spark.read.parquet(tmp_out + "/a"))]).report.first().asDict()
    lossy = R.reconcile_landing("ORDER_PROC", src, tmp_out + "/b", convert=lambda d: d.where("ORDER_ID % 7 <> 0")).report.first()
    assert not lossy["overall_match"] and lossy["issues_found"] == 3 and len(seen) == 1


def test_landing_is_one_scan_in_the_plan(spark, tmp_out):
    """The write's plan holds the metrics node over a single scan."""
    src = td.entity(spark, SF001, "ORDER_PROC")
    p = plan(src.withColumn("_dg", F.md5(F.lit("x"))).observe("m", *R.lane_sums("_dg")).drop("_dg"))
    assert p.count("Scan parquet") <= 2 and "CollectMetrics" in p


def test_fingerprints_tell_instants_apart(spark):
    """05:30 and 06:30 UTC of the autumn night have one wall time in New York."""
    old = spark.conf.get("spark.sql.session.timeZone")
    a = spark.sql("SELECT timestamp_micros(1730611800000000) AS t")
    b = spark.sql("SELECT timestamp_micros(1730615400000000) AS t")
    utc = R.fingerprint(a).first()[0]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert R.fingerprint(a).first()[0] == utc != R.fingerprint(b).first()[0]
        s, t = (x.withColumn("K", F.lit(1)) for x in (a, b))
        assert R.row_diff(s, t, "K").first()["status"] == "mismatch"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_fingerprints_tell_variants_apart(spark):
    texts = ["1", "1.0", '"1"', "[1]", "{\"a\":1}", "null", "true"]
    prints = {R.fingerprint(spark.sql(f"SELECT parse_json('{x}') AS v")).first()[0] for x in texts}
    assert len(prints) == len(texts)


@pytest.mark.parametrize("text,value,bad", [(".5 - 1", 0.4, True), (".5 - 1", 0.5, False), ("1e3-2e3", 999, True), ("1e3-2e3", 1500, False),
                                            ("(1-5)", 6, True), ("(1-5)", 5, False), ("+1-5", 0, True), ("+1-5", 1, False), ("( >= 3 )", 2, True)])
def test_more_range_forms(spark, text, value, bad):
    df = spark.createDataFrame([(1, float(value), text, None)], "RESULT_ID int, VALUE double, NORMAL_RANGE string, ABNORMAL_IND string")
    got = Q.row_outcomes(df, [Q.RESPIRATORY_RULES[0], Q.UNREADABLE_RANGE]).first()["broken_rules"]
    assert got == (["value_out_of_range"] if bad else [])


def test_split_by_rules(spark, tmp_out):
    df = spark.createDataFrame([(1, 5.0, "0-1", "N"), (2, 0.5, "0-1", "N"), (3, None, "x", "Y")], "RESULT_ID int, VALUE double, NORMAL_RANGE string, ABNORMAL_IND string")
    out = Q.split_by_rules(df, [*Q.RESPIRATORY_RULES, Q.UNREADABLE_RANGE], tmp_out + "/q")
    assert out.clean.schema == df.schema and [r[0] for r in out.clean.collect()] == [2]
    assert {r["RESULT_ID"]: r["broken_rules"] for r in out.quarantined.collect()} == {
        1: ["value_out_of_range", "abnormal_flag_contradiction"], 3: ["missing_result_value", "unreadable_normal_range"]}
    assert (out.clean_rows, out.quarantined_rows) == (1, 2) and out.by_rule["value_out_of_range"] == 1
    none = Q.split_by_rules(df.limit(0), Q.RESPIRATORY_RULES, tmp_out + "/none")
    assert none.clean.count() == none.quarantined.count() == none.clean_rows == 0
    assert Q.split_by_rules(df, [], tmp_out + "/all").clean_rows == 3
