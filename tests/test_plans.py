"""Physical-plan properties the operators rely on at scale."""

import contextlib
import io
import re

import pytest

from conftest import SF001
from recordflow.operators import quality as Q
from recordflow.operators import reconcile as R
from recordflow.plans import extracts as X
from recordflow.sources import testdata as td


def plan(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "-1")
    spark.conf.set(keys[2], "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_extract_filter_pushed_and_columns_pruned(spark):
    t = td.entities(spark, SF001, ["ORDER_PROC", "SPECIMEN"])
    p = plan(X.build_extract("extract_orders_psd", t, start_date="1998-01-01", end_date="1999-01-01"), "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,1998-01-01T00:00\).*"
                     r"LessThan\(o_orderdate,1999-01-01T00:00\)", p)
    orders_schema = [l for l in p.splitlines() if l.startswith("ReadSchema") and "o_orderkey" in l][0]
    assert "o_totalprice" not in orders_schema
    lineitem_schema = [l for l in p.splitlines() if l.startswith("ReadSchema") and "l_orderkey" in l][0]
    assert "l_extendedprice" not in lineitem_schema and "l_quantity" not in lineitem_schema


def test_duplicate_check_reads_key_only_and_aggregates_partially(spark):
    d = td.entity(spark, SF001, "SPECIMEN")
    p = plan(Q.duplicate_profile(d, "SPECIMEN_ID"), "formatted")
    rs = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    assert rs == "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>"
    assert "partial_count" in p


def test_fingerprint_has_no_key_shuffle(spark, no_broadcast):
    d = td.entity(spark, SF001, "ORDER_PROC")
    p = plan(R.fingerprint(d))
    assert "hashpartitioning" not in p and "Exchange SinglePartition" in p


def test_star_join_shuffles_each_input_once(spark, no_broadcast):
    t = td.entities(spark, SF001, ["PATIENT_VISIT", "ORDER_REC", "ORDER_MISC"])
    p = plan(X.build_extract("extract_visit_encounters", t, ordered=False, hot_key_threshold=None,
                             start_date="1900-01-01", end_date="2100-01-01"))
    assert p.count("SortMergeJoin") == 2
    assert p.count("Exchange hashpartitioning") == 3     # visits, orders, misc: no re-shuffle between joins


def test_billing_totals_joins_pre_aggregated_branches(spark, no_broadcast):
    t = td.entities(spark, SF001, ["ACCOUNT", "PB_AR", "GB_PAYMENT"])
    p = plan(X.billing_totals(t, "1900-01-01", "2100-01-01"))
    assert p.count("Exchange hashpartitioning") == 3     # the aggregates' shuffles feed the joins
    assert p.count("partial_sum") == 2


def test_reconciliation_plan_has_no_cartesian_join(spark):
    from recordflow.sources import recon_fixtures as RF
    from conftest import SF001 as D
    src = RF.source(spark, D)
    rep = R.reconcile([(n, src, t) for n, t in RF.targets(src).items()], key="ORDER_ID").report
    p = plan(rep)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_incremental_filter_reaches_the_scan(spark):
    import datetime as dt
    from recordflow.plans.incremental import incremental_batch
    src = td.entity(spark, SF001, "ORDER_PROC")
    p = plan(incremental_batch(src, dt.datetime(2001, 1, 1), "UPDATE_DT_TM"), "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThan\(o_orderdate,2001-01-01T00:00\)", p)
