"""Fingerprints, row-level diff and scorecards."""

from conftest import SF01
from recordflow.operators import reconcile as R
from recordflow.operators import scorecard as SC
from recordflow.sources import recon_fixtures as RF


def fp(df, **kw):
    return R.fingerprint(df, **kw).first()[0]


def test_fingerprint_is_order_insensitive_and_counts_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "k long, v string")
    assert fp(a) == fp(b)
    # A duplicated pair must not cancel out (sum, not xor).
    dup = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (3, "z")], "k long, v string")
    base = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    assert fp(dup) != fp(base)


def test_fingerprint_separates_null_empty_and_separator(spark):
    s = "a string, b string"
    rows = [[(None, "x")], [("", "x")], [("\\N", "x")], [("a|b", "")], [("a", "b|")]]
    fps = {fp(spark.createDataFrame(r, s)) for r in rows}
    assert len(fps) == len(rows)


def test_empty_tables_match(spark):
    e = spark.createDataFrame([], "k long")
    assert fp(e) == "0:0:0:0:0"
    r = R.reconcile([("E", e, e)], key="k").report.first()
    assert r["overall_match"]


def test_ordered_fingerprint_sees_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    b = spark.createDataFrame([(1, "y"), (2, "x")], "k long, v string")
    oa = R.ordered_fingerprint(a, ["k"]).first()[0]
    ob = R.ordered_fingerprint(b, ["k"]).first()[0]
    assert oa != ob
    same = R.ordered_fingerprint(spark.createDataFrame([(2, "y"), (1, "x")], "k long, v string"), ["k"]).first()[0]
    assert same == oa


def test_fixture_report_and_scorecard(spark):
    src = RF.source(spark, SF01)
    rep = R.reconcile([(n, src, t) for n, t in RF.targets(src).items()], key="ORDER_ID").report
    got = {r["entity_name"]: r["issues_found"] for r in rep.collect()}
    assert got == {"T_SAME": 0, "T_CHANGED": 1, "T_NULLED": 2, "T_LOSSY": 3, "T_DUPED": 4}
    scores = {r["entity_name"]: (r["overall_percentage"], r["quality_score"])
              for r in SC.score_entities(rep).collect()}
    assert scores == {"T_SAME": (100.0, "excellent"), "T_CHANGED": (75.0, "good"), "T_NULLED": (50.0, "fair"),
                      "T_LOSSY": (25.0, "poor"), "T_DUPED": (0.0, "poor")}
    card = SC.scorecard(SC.score_entities(rep)).first()
    assert (card["overall_percentage"], card["overall_score"], card["total_entities"],
            card["entities_passing"]) == (50.0, "fair", 5, 2)


def test_empty_scorecard_is_poor(spark):
    e = spark.createDataFrame([], "entity_name string, overall_percentage double, quality_score string")
    card = SC.scorecard(e).first()
    assert (card["overall_percentage"], card["overall_score"], card["total_entities"]) == (0.0, "poor", 0)


def test_row_diff_counts(spark):
    o = spark.read.parquet(SF01 + "/orders.parquet")
    t = RF.perturb(o.withColumnRenamed("o_orderkey", "ORDER_ID"), "T_LOSSY", "ORDER_ID", "o_orderstatus", "X") \
          .withColumnRenamed("ORDER_ID", "o_orderkey")
    got = {r["status"]: r["keys"] for r in R.row_diff_summary(R.row_diff(o, t, "o_orderkey")).collect()}
    assert got == {"match": 14698, "mismatch": 147, "target_missing": 155, "source_missing": 30}


def test_row_diff_repeated_keys_compare_as_multisets(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    t = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (2, "c")], "k long, v string")
    got = {r["k"]: (r["status"], r["source_rows"], r["target_rows"]) for r in R.row_diff(s, t, "k").collect()}
    assert got == {1: ("match", 2, 2), 2: ("mismatch", 1, 2)}


def test_reconcile_with_ordered_checksum(spark):
    s = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, v string")
    swapped = spark.createDataFrame([(1, "y"), (2, "x"), (3, "z")], "k long, v string")
    r = R.reconcile([("same", s, s), ("swapped", s, swapped)], key="k", ordered_by=["k"])
    checks = {(x["entity_name"], x["check_name"]): x["match"] for x in r.checks.collect()}
    assert checks[("same", "ordered_checksum")] and not checks[("swapped", "ordered_checksum")]
    assert {x["entity_name"]: x["overall_match"] for x in r.report.collect()} == {"same": True, "swapped": False}
