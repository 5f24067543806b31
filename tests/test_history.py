"""Kept run records and findings, published batches, identified reports."""

import datetime

import pytest

from recordflow.operators import reconcile as R
from recordflow.plans import incremental as INC
from recordflow.streaming import incremental_stream as ST


def _orders(spark, n=6):
    return spark.range(n).selectExpr(
        "id AS ORDER_ID", "IF(id = 2, NULL, id) AS PATIENT_ID", "'N' AS ORDER_STATUS_CD",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(id) AS UPDATE_DT_TM")


def test_records_and_findings_by_job_id(spark, tmp_out):
    src, led = _orders(spark), INC.PositionLedger(spark, f"{tmp_out}/ledger")
    ok = INC.run_etl_job(spark, "ORDER_PROC", src, led.path, f"{tmp_out}/out", "csv")
    bad = INC.run_etl_job(spark, "ORDER_PROC", src, led.path, f"{tmp_out}/out", "xml")
    row = led.runs(ok.job_id).first()
    assert (row["status"], row["export_format"], row["rows_exported"], row["output_path"]) == ("success", "csv", 6, ok.output_path)
    assert row["started_ts"] <= row["completed_ts"] and row["issues_found"] == ok.issues_found > 0
    kept = led.issues(ok.job_id).collect()
    assert len(kept) == ok.issues_found and all(r["detected_ts"] for r in kept)
    assert "PATIENT_ID" in {r["field_name"] for r in kept}
    failed = led.runs(bad.job_id).first()
    assert failed["status"] == "failed" and failed["output_path"] is None and "xml" in failed["message"]
    assert led.issues(bad.job_id).count() == 0 and led.runs("no such run").count() == 0


def test_findings_of_a_run_stopped_by_them_are_kept(spark, tmp_out):
    led = INC.PositionLedger(spark, f"{tmp_out}/ledger")
    rec = INC.run_etl_job(spark, "ORDER_PROC", _orders(spark), led.path, f"{tmp_out}/out", "csv", fail_on="warning")
    assert rec.status == "failed" and led.issues(rec.job_id).count() == rec.issues_found
    assert led.get("ORDER_PROC") == INC.FIRST_RUN_POSITION


def test_unfinished_batch_is_not_read(spark, tmp_out):
    src = _orders(spark)
    src.write.parquet(f"{tmp_out}/in")
    ST.run_incremental_stream(spark, f"{tmp_out}/in", src.schema, "ORDER_PROC", f"{tmp_out}/o", f"{tmp_out}/c")
    src.write.parquet(f"{tmp_out}/o/data/batch=77")  # data there, no metrics: the batch died
    assert ST.stream_output(spark, f"{tmp_out}/o").count() == 6


@pytest.mark.parametrize("layout", ["day", "month", "year"])
def test_layouts_give_the_same_pull(spark, tmp_out, layout):
    INC.write_by_change_date(_orders(spark, 800), tmp_out + "/x", "UPDATE_DT_TM", granularity=layout, mode="overwrite")
    got = INC.incremental_batch(spark.read.parquet(tmp_out + "/x"), datetime.datetime(2021, 6, 15), "UPDATE_DT_TM", "change_date")
    assert got.count() == 800 - 532


def test_report_id_and_time(spark):
    src = _orders(spark)
    rec = R.reconcile([("ORDER_PROC", src, src)])
    at = datetime.datetime(2024, 1, 2, 3, 4, 5)
    row = rec.identified("r1", at).first()
    assert (row["report_id"], row["generated_at"], row["overall_match"]) == ("r1", at, True)
    assert rec.identified().first()["report_id"]
