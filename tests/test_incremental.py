"""Position ledger, end-to-end runs, streaming variant, distributed ordinals."""

import datetime as dt
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, SF01
from recordflow.operators.ordinals import with_ordinal
from recordflow.plans import incremental as INC
from recordflow.sources import testdata as td
from recordflow.streaming import incremental_stream as ST


def test_incremental_fixture(spark, tmp_out):
    src = td.entities(spark, SF01, ["ORDER_PROC"])["ORDER_PROC"]
    led = INC.PositionLedger(spark, tmp_out + "/ledger")
    led.append("ORDER_PROC", "seed", dt.datetime(2001, 1, 1), 0, INC.SUCCESS)
    r1 = INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/ledger", tmp_out + "/out", "csv")
    assert (r1.status, r1.rows_extracted, r1.rows_exported) == ("success", 1299, 1299)
    assert r1.position_after == dt.datetime(2001, 8, 1)
    r2 = INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/ledger", tmp_out + "/out", "csv")
    assert (r2.status, r2.rows_extracted, r2.position_after) == ("success", 0, dt.datetime(2001, 8, 1))
    r3 = INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/ledger", tmp_out + "/out", "xml")
    assert r3.status == "failed" and "unknown export format" in r3.error_message
    assert led.get("ORDER_PROC") == dt.datetime(2001, 8, 1)
    pos = led.positions().first()
    assert (pos["successful_runs"], pos["failed_runs"], pos["last_status"]) == (3, 1, "failed")


def test_failed_after_success_keeps_success_position(spark, tmp_out):
    led = INC.PositionLedger(spark, tmp_out + "/l")
    led.append("X", "a", dt.datetime(2020, 1, 1), 5, INC.SUCCESS)
    led.append("X", "b", dt.datetime(2099, 1, 1), 0, INC.FAILED, "boom")
    assert led.get("X") == dt.datetime(2020, 1, 1)
    assert led.get("NEVER") == dt.datetime(1900, 1, 1)


def test_fail_on_warning_does_not_advance(spark, tmp_out):
    d = spark.createDataFrame([(1, 1, dt.datetime(2020, 1, 1)), (1, 2, dt.datetime(2020, 1, 2))],
                              "ORDER_ID long, PATIENT_ID long, UPDATE_DT_TM timestamp_ntz")
    r = INC.run_etl_job(spark, "ORDER_PROC", d, tmp_out + "/l", tmp_out + "/o", "csv", fail_on="warning")
    assert r.status == "failed" and r.validation_passed is False
    assert INC.PositionLedger(spark, tmp_out + "/l").get("ORDER_PROC") == dt.datetime(1900, 1, 1)


def test_stream_processes_once(spark, tmp_out):
    schema = td.read_table(spark, SF001, "orders").schema
    kw = dict(transform=lambda s: td.adapt(s, "ORDER_PROC"), path_glob="orders.parquet", export_format="csv")
    ST.run_incremental_stream(spark, SF001, schema, "ORDER_PROC", tmp_out + "/o", tmp_out + "/ck", **kw)
    n1 = ST.stream_output(spark, tmp_out + "/o").count()
    assert n1 == td.entity(spark, SF001, "ORDER_PROC").count()
    # Restart with the same checkpoint: nothing new, nothing repeated.
    ST.run_incremental_stream(spark, SF001, schema, "ORDER_PROC", tmp_out + "/o", tmp_out + "/ck", **kw)
    assert ST.stream_output(spark, tmp_out + "/o").count() == n1
    m = ST.stream_metrics(spark, tmp_out + "/o").first()
    assert m["passed"] and m["rows_checked"] == n1
    assert spark.read.text(tmp_out + "/o/csv/batch=0/data").count() == n1


def test_ordinals_equal_row_number(spark):
    d = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"), F.col("id"))
    o = with_ordinal(d, ["k", "id"], num_partitions=7)
    ref = d.withColumn("rn", F.row_number().over(Window.orderBy("k", "id")))
    bad = o.join(ref, ["k", "id"]).where(F.col("ordinal") != F.col("rn")).count()
    assert bad == 0 and o.count() == 5000


def test_ordinals_on_empty(spark):
    assert with_ordinal(spark.createDataFrame([], "k long"), ["k"]).count() == 0


def test_fail_on_error_blocks_before_reading(spark, tmp_out):
    d = spark.createDataFrame([(1, dt.datetime(2020, 1, 1))], "ORDER_ID long, UPDATE_DT_TM timestamp_ntz")
    r = INC.run_etl_job(spark, "ORDER_PROC", d, tmp_out + "/l", tmp_out + "/o", "csv", fail_on="error")
    assert r.status == "failed" and "required fields missing" in r.error_message
    # Without the gate the same batch is exported and flagged.
    r2 = INC.run_etl_job(spark, "ORDER_PROC", d, tmp_out + "/l", tmp_out + "/o", "csv")
    assert r2.status == "success" and r2.validation_passed is False and r2.rows_exported == 1


def test_ordinals_split_identical_rows(spark):
    d = spark.range(0, 3000).select(F.lit(7).alias("k"))   # every row ties on the order
    o = with_ordinal(d, ["k"], num_partitions=6)
    assert sorted(r["ordinal"] for r in o.collect()) == list(range(1, 3001))


def test_concurrent_success_blocks_second_advance(spark, tmp_out, monkeypatch):
    src = spark.createDataFrame([(1, 1, dt.datetime(2020, 1, 1))], "ORDER_ID long, PATIENT_ID long, UPDATE_DT_TM timestamp_ntz")
    led = INC.PositionLedger(spark, tmp_out + "/l")
    real_export = INC.sinks.export

    def export_then_race(df, fmt, path, **kw):
        res = real_export(df, fmt, path, **kw)
        led.append("ORDER_PROC", "other", dt.datetime(2030, 1, 1), 5, INC.SUCCESS)   # a concurrent run finished
        return res

    monkeypatch.setattr(INC.sinks, "export", export_then_race)
    r = INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/l", tmp_out + "/o", "csv")
    assert r.status == "failed" and "advanced the position" in r.error_message
    assert led.get("ORDER_PROC") == dt.datetime(2030, 1, 1)


def test_overlap_catches_late_rows_once(spark, tmp_out):
    sch = "ORDER_ID long, PATIENT_ID long, UPDATE_DT_TM timestamp_ntz"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    first = spark.createDataFrame([(1, 1, t1), (2, 1, t2)], sch)
    # A row committed late, with a change time equal to the stored position.
    later = spark.createDataFrame([(1, 1, t1), (2, 1, t2), (3, 1, t2)], sch)
    strict = dict(ledger_path=tmp_out + "/ls", out_root=tmp_out + "/os", export_format="csv")
    lapped = dict(ledger_path=tmp_out + "/lo", out_root=tmp_out + "/oo", export_format="csv",
                  overlap=dt.timedelta(days=1))
    for kw in (strict, lapped):
        r = INC.run_etl_job(spark, "ORDER_PROC", first, **kw)
        assert (r.rows_extracted, r.position_after) == (2, t2)
    assert INC.run_etl_job(spark, "ORDER_PROC", later, **strict).rows_extracted == 0   # missed by '>'
    r2 = INC.run_etl_job(spark, "ORDER_PROC", later, **lapped)
    assert (r2.status, r2.rows_extracted, r2.position_after) == ("success", 1, t2)  # caught, exactly once
    assert INC.run_etl_job(spark, "ORDER_PROC", later, **lapped).rows_extracted == 0


def test_etl_job_fhir_export(spark, tmp_out):
    src = td.entities(spark, SF001, ["PATIENT"])["PATIENT"].withColumn("UPDATE_DT_TM", F.col("DOB").cast("timestamp_ntz"))
    r = INC.run_etl_job(spark, "PATIENT", src, tmp_out + "/l", tmp_out + "/o", "fhir", resource_type="Patient",
                        page_size=40, run_ts="2024-01-01 00:00:00", run_id="t")
    n = src.count()
    assert (r.status, r.rows_extracted, r.rows_exported) == ("success", n, n)
    bundles = spark.read.text(r.output_path).count()
    assert bundles == -(-n // 40)


def test_change_date_layout_prunes_partitions(spark, tmp_out):
    import contextlib
    import io
    src = td.entities(spark, SF01, ["ORDER_PROC"])["ORDER_PROC"]
    INC.write_by_change_date(src, tmp_out + "/op", "UPDATE_DT_TM", mode="overwrite")
    laid = spark.read.parquet(tmp_out + "/op")
    pos = dt.datetime(2001, 1, 1)
    pruned = INC.incremental_batch(laid, pos, "UPDATE_DT_TM", "change_date")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pruned.explain("formatted")
    assert re.search(r"PartitionFilters: \[.*change_date", buf.getvalue())
    assert pruned.count() == INC.incremental_batch(src, pos, "UPDATE_DT_TM").count() == 1299
    r = INC.run_etl_job(spark, "ORDER_PROC", laid, tmp_out + "/l", tmp_out + "/o", "csv",
                        date_partition_col="change_date")
    assert r.status == "success" and r.rows_extracted == 15000
