"""The reference's own unit cases, re-typed as DataFrames."""

import datetime as dt

from pyspark.sql import functions as F

from recordflow.operators import quality as Q
from recordflow.operators import reconcile as R
from recordflow.operators import scorecard as SC
from recordflow.plans.incremental import SUCCESS, PositionLedger
from recordflow.sources import sinks


def raw_text(path):
    """Concatenated bytes of the part files (Spark's reader would split on CR)."""
    import glob
    return "".join(open(f, encoding="utf-8", newline="").read() for f in sorted(glob.glob(path + "/part-*")))


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_schema_passes(spark):
    d = df(spark, [("1", "100", "2024-01-01"), ("2", "101", "2024-01-02")],
           "ORDER_ID string, PATIENT_ID string, ORDER_START_DT_TM string")
    assert Q.validate_schema(d, "ORDER_PROC").count() == 0


def test_schema_missing_field(spark):
    d = df(spark, [("1", "100")], "ORDER_ID string, PATIENT_ID string")
    issues = Q.validate_schema(d, "ORDER_PROC").collect()
    assert len(issues) == 1
    assert issues[0]["field_name"] == "ORDER_START_DT_TM" and issues[0]["level"] == "error"
    assert issues[0]["row_count"] == 1


def test_nulls(spark):
    d = df(spark, [("1", None), ("2", "101")], "ORDER_ID string, PATIENT_ID string")
    issues = Q.validate_nulls(d, "ORDER_PROC", ["PATIENT_ID"]).collect()
    assert [i["field_name"] for i in issues] == ["PATIENT_ID"]
    assert issues[0]["row_count"] == 1
    assert issues[0]["message"] == "1 null values found in 'PATIENT_ID'"


def test_duplicates(spark):
    d = df(spark, [("1", "100"), ("1", "101"), ("2", "102")], "ORDER_ID string, PATIENT_ID string")
    issues = Q.validate_duplicates(d, "ORDER_PROC", "ORDER_ID").collect()
    assert len(issues) == 1 and issues[0]["row_count"] == 1
    prof = Q.duplicate_profile(d, "ORDER_ID").first()
    assert prof["surplus_rows"] == 1 and prof["duplicate_keys"] == 1


def test_csv_export(spark, tmp_out):
    d = df(spark, [("1", "100"), ("2", "101")], "ORDER_ID string, PATIENT_ID string")
    res = sinks.write_csv(d, tmp_out + "/csv")
    assert res.format == "csv" and res.record_count == 2
    header = spark.read.text(tmp_out + "/csv/header").first()[0]
    assert "ORDER_ID" in header


def test_hl7_export(spark, tmp_out):
    d = df(spark, [("100", "Smith", "John", "1980-01-01", "M")],
           "PATIENT_ID string, LAST_NAME string, FIRST_NAME string, DOB string, SEX_CD string")
    res = sinks.write_hl7(d, tmp_out + "/hl7", run_ts="2024-01-01 10:30:00", run_id="t")
    assert res.format == "hl7v2" and res.record_count == 1
    text = raw_text(tmp_out + "/hl7")
    assert text.startswith("MSH|^~\\&|")
    assert "\rPID|1|100||Smith^John||1980-01-01|M\r\r" in text
    assert "ORC" not in text


def test_fhir_export(spark, tmp_out):
    d = df(spark, [("100", "Smith", "John", "1980-01-01", "M")],
           "PATIENT_ID string, LAST_NAME string, FIRST_NAME string, DOB string, SEX_CD string")
    res = sinks.write_fhir_bundles(d, tmp_out + "/fhir", "Patient", run_ts="2024-01-01 00:00:00", run_id="t")
    assert res.format == "fhir_r4" and res.record_count == 1
    text = spark.read.text(tmp_out + "/fhir").first()[0]
    assert '"resourceType":"Patient"' in text and '"resourceType":"Bundle"' in text


def test_position_write_then_read(spark, tmp_out):
    led = PositionLedger(spark, tmp_out + "/ledger")
    now = dt.datetime(2024, 5, 1, 12, 0, 0)
    led.append("ORDER_PROC", "r1", now, 100, SUCCESS)
    assert led.get("ORDER_PROC") == now
    row = led.positions().where(F.col("entity_name") == "ORDER_PROC").first()
    assert row["last_rows"] == 100


def _recon(spark, s_rows, t_rows, schema, **kw):
    return R.reconcile([("ORDER_PROC", df(spark, s_rows, schema), df(spark, t_rows, schema))], **kw)


def test_row_counts(spark):
    s = spark.range(100).withColumnRenamed("id", "ORDER_ID")
    t = spark.range(95).withColumnRenamed("id", "ORDER_ID")
    r = R.reconcile([("ORDER_PROC", s, s), ("X", s, t)], key="ORDER_ID").report
    got = {x["entity_name"]: (x["row_count_match"], x["difference"]) for x in r.collect()}
    assert got == {"ORDER_PROC": (True, 0), "X": (False, 5)}


def test_checksums(spark):
    sch = "ORDER_ID string, PATIENT_ID string"
    same = _recon(spark, [("1", "100"), ("2", "101")], [("1", "100"), ("2", "101")], sch).report.first()
    diff = _recon(spark, [("1", "100")], [("2", "101")], sch).report.first()
    assert same["checksum_match"] and not diff["checksum_match"]


def test_null_comparison(spark):
    sch = "PATIENT_ID string"
    c = _recon(spark, [("100",), (None,)], [("100",), (None,)], sch, key="PATIENT_ID").checks
    row = c.where((F.col("check_name") == "null_count") & (F.col("field_name") == "PATIENT_ID")).first()
    assert row["match"] and row["source_value"] == "1"


def test_duplicate_comparison(spark):
    sch = "ORDER_ID string"
    r = _recon(spark, [("1",), ("1",), ("2",)], [("1",), ("1",), ("2",)], sch, key="ORDER_ID").report.first()
    assert r["duplicates_match"] and r["source_duplicates"] == 1


def test_report_generation(spark):
    sch = "ORDER_ID string, PATIENT_ID string"
    rows = [("1", "100"), ("2", "101")]
    r = _recon(spark, rows, rows, sch, key_rule="reconciliation").report.first()
    assert r["overall_match"] and r["issues_found"] == 0


def test_scorecard(spark):
    sch = "ORDER_ID string, PATIENT_ID string"
    rep = _recon(spark, [("1", "100")], [("1", "100")], sch).report
    card = SC.scorecard(SC.score_entities(rep)).first()
    assert card["total_entities"] == 1 and card["entities_passing"] == 1
    assert card["overall_score"] == "excellent"
