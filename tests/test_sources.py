"""Named-entity scans and the adapters."""

import contextlib
import io

import pytest

from conftest import SF001
from recordflow.sources import testdata as td
from recordflow.sources.entity_source import read_entity


def test_read_entity_by_path_and_table(spark, tmp_out):
    td.entity(spark, SF001, "CLARITY_SER").write.parquet(tmp_out + "/ser")
    by_path = read_entity(spark, "CLARITY_SER", path=tmp_out + "/ser")
    assert by_path.count() == 5
    by_path.createOrReplaceTempView("CLARITY_SER")
    assert read_entity(spark, "CLARITY_SER").count() == 5


def test_read_entity_rejects_unknown_names(spark):
    with pytest.raises(ValueError):
        read_entity(spark, "ORDERS; DROP TABLE X", path="/nowhere")


def test_adapter_row_counts(spark):
    # Whole base tables; lineitem is dealt between the entities of each pair.
    t = td.entities(spark, SF001)
    assert t["CLARITY_DEP"].count() == 25 and t["CLARITY_SER"].count() == 5
    assert t["ORDER_PROC"].count() == spark.read.parquet(SF001 + "/orders.parquet").count()
    lines = spark.read.parquet(SF001 + "/lineitem.parquet").count()
    assert t["ORDER_REC"].count() + t["ORDER_MISC"].count() == lines == t["PB_AR"].count() + t["GB_PAYMENT"].count()
    assert set(t["PATIENT"].columns) >= {"PATIENT_ID", "LAST_NAME", "DOB"}


def test_bucketed_staging_removes_join_shuffles(spark):
    from recordflow.plans import extracts as X
    from recordflow.sources.bucketed import stage_bucketed
    t = td.entities(spark, SF001, ["PATIENT_VISIT", "ORDER_REC", "ORDER_MISC"])
    staged = stage_bucketed(spark, t, "rf_stage", 4)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        q = X.build_extract("extract_visit_encounters", staged, ordered=False, hot_key_threshold=None,
                            start_date="1900-01-01", end_date="2100-01-01")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        plain = X.build_extract("extract_visit_encounters", t, ordered=False,
                                start_date="1900-01-01", end_date="2100-01-01")
        assert q.count() == plain.count() and q.exceptAll(plain).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev)


def test_read_entity_with_known_schema(spark, tmp_out):
    td.entity(spark, SF001, "CLARITY_SER").write.parquet(tmp_out + "/ser")
    df = read_entity(spark, "CLARITY_SER", path=tmp_out + "/ser", schema="SER_ID int, SER_NAME string")
    assert df.columns == ["SER_ID", "SER_NAME"] and df.count() == 5
