"""Export dialects: CSV quoting against Python's csv module, HL7 framing, FHIR shapes."""

import csv
import glob
import io
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from recordflow.sources import sinks
from recordflow.sources import testdata as td


def raw(path):
    return "".join(open(f, encoding="utf-8", newline="").read() for f in sorted(glob.glob(path + "/part-*")))


def test_csv_lines_match_python_csv(spark):
    rows = [("1", 'say "hi"', "a,b"), ("2", "line\nbreak", "cr\rhere"), ("3", "back\\slash", " lead"),
            ("4", None, "")]
    d = spark.createDataFrame(rows, "ID string, A string, B string")
    got = [r["line"] for r in sinks.csv_lines(d).collect()]
    for (i, a, b), line in zip(rows, got):
        buf = io.StringIO()
        csv.writer(buf, lineterminator="").writerow([i, "" if a is None else a, b])
        assert line == buf.getvalue()


def test_csv_booleans_and_times_like_python(spark):
    import datetime as dt
    d = spark.createDataFrame([(True, dt.datetime(2024, 1, 2, 3, 4, 5)), (False, dt.datetime(2024, 1, 2, 3, 4, 5, 120000))],
                              "B boolean, T timestamp_ntz")
    got = sorted(r["line"] for r in sinks.csv_lines(d).collect())
    assert got == ["False,2024-01-02 03:04:05.120000", "True,2024-01-02 03:04:05"]


def test_csv_file_roundtrip(spark, tmp_out):
    d = spark.createDataFrame([("1", "x,y"), ("2", "z")], "ID string, V string")
    res = sinks.write_csv(d, tmp_out + "/c")
    assert res.record_count == 2
    text = raw(tmp_out + "/c/header") + raw(tmp_out + "/c/data")
    assert sorted(text.split("\r\n")) == sorted(["ID,V", '1,"x,y"', "2,z", ""])


def test_csv_empty_has_no_header(spark, tmp_out):
    d = spark.createDataFrame([], "ID string")
    assert sinks.write_csv(d, tmp_out + "/e").record_count == 0
    assert glob.glob(tmp_out + "/e/header/part-*") == []


def test_hl7_orc_rules(spark):
    with_status = spark.createDataFrame([("7", "100", None)], "ORDER_ID string, PATIENT_ID string, ORDER_STATUS_CD string")
    m = sinks.hl7_messages(with_status, "2024-01-01 00:00:00", "r", order_by=["ORDER_ID"]).first()["message"]
    assert m.endswith("\rORC||7\r")            # present status column, null -> empty
    no_status = spark.createDataFrame([(None, "100")], "ORDER_ID string, PATIENT_ID string")
    m = sinks.hl7_messages(no_status, "2024-01-01 00:00:00", "r", order_by=["PATIENT_ID"]).first()["message"]
    assert m.endswith("\rORC|NW|\r")           # absent status column -> NW; null id -> empty
    segs = m.split("\r")
    assert segs[0].split("|")[8:] == ["ORU", "2.4"] and segs[1] == "PID|1|100||^|||"


def test_hl7_escaping_option(spark):
    d = spark.createDataFrame([("1", "O|Brien^X")], "PATIENT_ID string, LAST_NAME string")
    m = sinks.hl7_messages(d, "2024-01-01 00:00:00", "r", order_by=["PATIENT_ID"], escape_fields=True).first()[1]
    assert "O\\F\\Brien\\S\\X^" in m


def test_hl7_ordinals_are_positions(spark):
    t = td.entities(spark, SF01, ["ORDER_PROC"])
    m = sinks.hl7_messages(t["ORDER_PROC"], "2024-01-01 00:00:00", "r", order_by=["ORDER_ID"])
    rows = m.select("ordinal", F.split("message", "\r").getItem(1).alias("pid")).collect()
    assert sorted(r["ordinal"] for r in rows) == list(range(1, 15001))
    assert all(r["pid"].startswith(f"PID|{r['ordinal']}|") for r in rows)


def test_fhir_absent_vs_null(spark):
    d = spark.createDataFrame([("1", None)], "PATIENT_ID string, SEX_CD string")
    r = json.loads(sinks.fhir_resources(d, "Patient").first()[0])
    assert r["gender"] == "unknown" and r["birthDate"] == "" and r["name"] == [{"family": "", "given": [""]}]
    d2 = spark.createDataFrame([("1", None)], "PATIENT_ID string, DOB date")
    assert json.loads(sinks.fhir_resources(d2, "Patient").first()[0])["birthDate"] is None


def test_fhir_resource_shapes(spark):
    t = td.entities(spark, SF01, ["PATIENT_VISIT", "RESPIRATORY"])
    e = json.loads(sinks.fhir_resources(t["PATIENT_VISIT"], "Encounter").first()[0])
    assert e["resourceType"] == "Encounter" and e["status"] == "finished" and e["subject"]["reference"].startswith("Patient/")
    o = json.loads(sinks.fhir_resources(t["RESPIRATORY"], "Observation").first()[0])
    assert o["status"] == "final" and set(o["valueQuantity"]) == {"value", "unit"}
    assert len(o["code"]["coding"]) == 1


def test_fhir_bundles_bounded_and_ordered(spark):
    p = td.entities(spark, SF01, ["PATIENT"])["PATIENT"]
    b = sinks.fhir_bundles(p, "Patient", 64, "2024-01-01 00:00:00", "r", order_by=["PATIENT_ID"])
    rows = b.orderBy("bundle_no").collect()
    assert max(r["entries"] for r in rows) <= 64 and sum(r["entries"] for r in rows) == 1500
    ids = [int(e["resource"]["id"]) for r in rows for e in json.loads(r["bundle"])["entry"]]
    assert ids == sorted(ids) and len(ids) == 1500
    first = json.loads(rows[0]["bundle"])
    assert first["type"] == "collection" and first["timestamp"] == "2024-01-01T00:00:00"


def test_export_dispatch(spark, tmp_out):
    d = spark.createDataFrame([("1",)], "PATIENT_ID string")
    with pytest.raises(ValueError):
        sinks.export(d, "xml", tmp_out + "/x")
    assert sinks.export(d, "csv", tmp_out + "/c").record_count == 1


def test_hl7_long_message_ids(spark):
    d = spark.createDataFrame([("1",), ("2",)], "PATIENT_ID string")
    m = sinks.hl7_messages(d, "2024-01-01 00:00:00", "r", order_by=["PATIENT_ID"], id_length=32)
    ids = [r["message"].split("|")[7] for r in m.collect()]
    assert all(len(i) == 35 and i.startswith("MSG") for i in ids) and len(set(ids)) == 2


def test_fhir_ndjson_one_resource_per_line(spark, tmp_out):
    t = td.entities(spark, SF01, ["RESPIRATORY"])
    res = sinks.write_fhir_ndjson(t["RESPIRATORY"], tmp_out + "/nd", "Observation")
    lines = [l for l in raw(tmp_out + "/nd").split("\n") if l]
    assert res.record_count == 10000 and len(lines) == 10000
    assert all(json.loads(l)["resourceType"] == "Observation" for l in lines[:50])


def test_fhir_gender_code_map(spark):
    from recordflow.functions.fhir import FHIR_GENDER_CODES
    d = spark.createDataFrame([("1", "M"), ("2", "F"), ("3", None), ("4", "Z")], "PATIENT_ID string, SEX_CD string")
    plain = {json.loads(r[0])["id"]: json.loads(r[0])["gender"] for r in sinks.fhir_resources(d).collect()}
    mapped = {json.loads(r[0])["id"]: json.loads(r[0])["gender"]
              for r in sinks.fhir_resources(d, "Patient", FHIR_GENDER_CODES).collect()}
    assert plain == {"1": "m", "2": "f", "3": "unknown", "4": "z"}
    assert mapped == {"1": "male", "2": "female", "3": "unknown", "4": "unknown"}
