"""Extract row counts and star-join semantics on the driver's test tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from recordflow.plans import extracts as X
from recordflow.sources import testdata as td

Y98 = dict(start_date="1998-01-01", end_date="1999-01-01")


@pytest.mark.parametrize("name,params,sf,expected", [
    ("extract_orders_psd", Y98, SF001, 959),
    ("extract_orders_psd", Y98, SF01, 9025),
    ("extract_respiratory_results", dict(start_date="2024-01-08", end_date="2024-01-15"), SF01, 2320),
    ("extract_organizational_hierarchy", dict(start_ser_id=1), SF01, 61),
    ("extract_visit_encounters", Y98, SF01, 5579),
    ("extract_patient_demographics", dict(start_patient_id=100), SF01, 19132),
    ("extract_billing_accounts", Y98, SF01, 10264),
])
def test_extract_counts(spark, name, params, sf, expected):
    d = X.EXTRACTS[name]
    t = td.entities(spark, sf, list(d.entities))
    assert X.build_extract(name, t, ordered=False, **params).count() == expected


def test_half_open_range_bounds(spark):
    rows = [(1, "1998-01-01 00:00:00"), (2, "1998-12-31 23:59:59"), (3, "1999-01-01 00:00:00")]
    o = spark.createDataFrame(rows, "ORDER_ID long, ts string").select(
        "ORDER_ID", F.lit(1).alias("PATIENT_ID"), *[F.lit("x").alias(c) for c in
        ("ORDER_TYPE_CD", "ORDER_STATUS_CD")], F.lit(1).alias("ORDERING_PROVIDER_ID"),
        F.col("ts").cast("timestamp_ntz").alias("ORDER_START_DT_TM"),
        F.col("ts").cast("timestamp_ntz").alias("ORDER_END_DT_TM"), F.lit("x").alias("RESULT_STATUS_CD"))
    s = spark.createDataFrame([], "ORDER_ID long, SPECIMEN_ID long, SPECIMEN_TYPE_CD string, "
                                 "COLLECT_DT_TM timestamp_ntz, RECEIVE_DT_TM timestamp_ntz")
    got = X.orders_psd({"ORDER_PROC": o, "SPECIMEN": s}, **Y98)
    assert [r["ORDER_ID"] for r in got.collect()] == [1, 2]
    assert got.where(F.col("SPECIMEN_ID").isNotNull()).count() == 0


def test_org_chain_nulls_last(spark):
    t = td.entities(spark, SF01, ["CLARITY_SER", "CLARITY_DEP", "CLARITY_EMP"])
    rows = X.organizational_hierarchy(t, 0).collect()
    # Region 4 has no departments: one null-extended row, and no employee.
    r4 = [r for r in rows if r["SER_ID"] == 4]
    assert len(r4) == 1 and r4[0]["DEP_ID"] is None and r4[0]["EMP_ID"] is None
    keys = [(r["SER_ID"], r["DEP_ID"] is None, r["DEP_ID"] or 0) for r in rows]
    assert keys == sorted(keys)


def test_billing_totals_vs_star_fanout(spark):
    t = td.entities(spark, SF01, ["ACCOUNT", "PB_AR", "GB_PAYMENT"])
    tot = X.billing_totals(t, **Y98).agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("AR_TOTAL").alias("ar"), F.sum("AR_ROWS").alias("ar_rows"),
        F.sum("PAID_TOTAL").alias("paid"), F.sum("PAYMENT_ROWS").alias("pay_rows")).first()
    assert tot["accounts"] == 2220
    assert tot["ar"] == Decimal("242061353.47") and tot["ar_rows"] == 4500
    assert tot["paid"] == Decimal("237607667.89") and tot["pay_rows"] == 4499
    # Summing the fanned-out star join over-counts AR (bag semantics kept).
    fan = X.billing_accounts(t, ordered=False, **Y98).agg(F.sum("AMOUNT")).first()[0]
    assert fan == Decimal("516327185.22")


def test_unknown_extract_and_params(spark):
    with pytest.raises(ValueError):
        X.build_extract("nope", {})
    with pytest.raises(ValueError):
        X.build_extract("extract_orders_psd", {}, start_date="1998-01-01")


def test_run_extract_counts_with_observation(spark, tmp_out):
    t = td.entities(spark, SF001, ["ORDER_PROC", "SPECIMEN"])
    run = X.run_extract(spark, "extract_orders_psd", t, tmp_out + "/e1", **Y98)
    assert run.status == "success" and run.rows == 959
    assert spark.read.parquet(tmp_out + "/e1").count() == 959
    bad = X.run_extract(spark, "extract_orders_psd", t, tmp_out + "/e2", start_date="1998-01-01")
    assert bad.status == "failed" and bad.rows == 0


def test_salted_left_join_equals_plain_join(spark):
    from recordflow.operators.joins import left_join
    # Key 1 holds most right rows and several left rows; key 3 has no right rows.
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k long, lv string")
    right = spark.range(0, 500).select(F.when(F.col("id") < 450, 1).otherwise(2).cast("long").alias("k"),
                                       F.col("id").alias("rv"))
    def bag(df):
        return sorted(tuple(map(str, r)) for r in df.collect())
    plain = bag(left_join(left, right, "k"))
    salted = bag(left_join(left, right, "k", threshold=100, rows_per_task=60))
    assert salted == plain and len(plain) == 2 * 450 + 50 + 2


def test_hot_key_salts_scale_with_key_size(spark):
    from recordflow.operators.joins import hot_keys
    right = spark.range(0, 1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("k"))
    got = {r["k"]: r["_b"] for r in hot_keys(right, "k", threshold=50, rows_per_task=100).collect()}
    assert got == {1: 9}


def test_extract_with_hot_key_salting_matches(spark):
    t = td.entities(spark, SF01, ["PATIENT", "PATIENT_ALLERGY", "PATIENT_DIAGNOSIS"])
    a = X.build_extract("extract_patient_demographics", t, ordered=False, start_patient_id=0)
    b = X.build_extract("extract_patient_demographics", t, ordered=False, start_patient_id=0, hot_key_threshold=12)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sql_text_extract_with_named_markers(spark):
    from recordflow.plans import sql_extract as SQ
    t = td.entities(spark, SF001, ["ORDER_PROC", "SPECIMEN"])
    SQ.register_entities(t)
    got = SQ.run_sql(spark, SQ.ORDERS_WITH_SPECIMENS_SQL, **Y98)
    assert got.count() == 959
    same = X.build_extract("extract_orders_psd", t, ordered=False, **Y98)
    assert got.exceptAll(same).count() == 0


def test_extract_catalog_categories():
    assert [d.name for d in X.extracts_by_category("fin")] == ["extract_billing_accounts"]
    assert len(X.extracts_by_category("hl7")) == 3 and len(X.EXTRACTS) == 6


def test_run_extract_timeout_cancels_jobs(spark, tmp_out, monkeypatch):
    slow = spark.range(0, 10 ** 12, numPartitions=64).selectExpr("id % 7 AS k").groupBy("k").count()
    monkeypatch.setattr(X, "build_extract", lambda *a, **k: slow)
    run = X.run_extract(spark, "extract_orders_psd", {}, tmp_out + "/slow", timeout_s=3, **Y98)
    assert run.status == "failed" and run.error == "timeout: cancelled after 3 s"
    assert (run.completed_ts - run.started_ts).total_seconds() < 60


def test_user_extracts_run_from_the_catalog(spark, tmp_out):
    t = {"A": spark.createDataFrame([(1, "x"), (2, "y"), (5, None)], "K long, V string"),
         "B": spark.createDataFrame([(1, 10), (1, 11), (9, 12)], "K long, W long")}
    declared = X.ExtractDef("user_declared", "X", "own", ("A", "B"), ("start_k",), bound="K", columns=("K", "V"),
                            joined=(X.Joined("B", "K", ("W",)),), sort=("K", "W"))
    as_text = X.ExtractDef("user_text", "X", "own", ("A", "B"), ("start_k",),
                           text="SELECT A.K, V, W FROM A LEFT JOIN B ON A.K = B.K WHERE A.K >= :start_k")
    try:
        for d in (declared, as_text):
            X.register_extract(d)
            run = X.run_extract(spark, d.name, t, f"{tmp_out}/{d.name}", start_k=1)
            assert (run.status, run.rows) == ("success", 4), run.error
            assert sorted(map(str, spark.read.parquet(run.path).collect())) == sorted(map(str, t["A"].join(t["B"], "K", "left").collect()))
        with pytest.raises(ValueError):
            X.register_extract(declared)
        with pytest.raises(ValueError):
            X.register_extract(X.ExtractDef("bad", "X", "own", ("A", "B"), ("p",), bound="K", columns=("K",), joined=(X.Joined("B", "Z", ("W",)),)))
    finally:
        X.unregister_extract("user_declared")
        X.unregister_extract("user_text")


def test_salted_star_spreads_a_hot_key_without_a_cap(spark):
    """90 % of both sides' rows on one key: no (key, salt) group above a few times the target."""
    from recordflow.operators.joins import hot_keys, left_join
    left = spark.createDataFrame([(1, "l")], "k long, l string")
    right = spark.range(20000).selectExpr("IF(id < 18000, 1L, id) AS k", "id AS r")
    salts = {r["k"]: r["_b"] for r in hot_keys(right, "k", 100).collect()}
    assert salts == {1: 180}
    spread = right.where("k = 1").selectExpr("pmod(xxhash64(k, r), 180) AS s").groupBy("s").count().agg(F.max("count")).first()[0]
    assert spread <= 200
    assert left_join(left_join(left, right, "k", 100), right.withColumnRenamed("r", "r2").where("r2 % 9000 = 0"), "k", 100).count() == 18000 * 2


def test_sort_gets_as_many_ranges_as_its_rows_need(spark, monkeypatch):
    """The join's rows, not the session's number of partitions, say how many tasks sort them."""
    from recordflow.operators import joins as J
    d = X.EXTRACTS["extract_patient_demographics"]
    t = td.entities(spark, SF001, list(d.entities))
    plain = X.build_extract(d.name, t, start_patient_id=0)
    want = [tuple(r) for r in plain.collect()]
    driving = t["PATIENT"].select("PATIENT_ID")
    assert J.joined_rows(driving, [t["PATIENT_ALLERGY"], t["PATIENT_DIAGNOSIS"]], "PATIENT_ID") == (driving.count(), len(want))
    monkeypatch.setattr(J, "ROWS_PER_SORT", len(want) // 10)
    monkeypatch.setattr(J, "will_broadcast", lambda f: False)
    monkeypatch.setattr(X, "will_broadcast", lambda f: False)
    for threshold in (J.AUTO, 12, None):
        wide = X.build_extract(d.name, t, hot_key_threshold=threshold, start_patient_id=0)
        assert wide.rdd.getNumPartitions() >= 10
        got = [tuple(r) for r in wide.collect()]
        assert [r[0] for r in got] == [r[0] for r in want] and sorted(map(str, got)) == sorted(map(str, want))
    assert X.build_extract(d.name, t, ordered=False, start_patient_id=0).count() == len(want)


def test_expected_rows_of_a_chain_and_of_null_keys(spark):
    from recordflow.operators import joins as J
    left = spark.createDataFrame([(1,), (1,), (None,), (3,)], "K long")
    side = spark.createDataFrame([(1,), (1,), (None,), (None,)], "K long")
    assert J.joined_rows(left, [side, side], "K") == (4, 2 * 4 + 1 + 1)
    assert J.joined_rows(left.limit(0), [side], "K") == (0, 0.0)
