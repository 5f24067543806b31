"""Quality checks: edge cases the reference does not test."""

from pyspark.sql import functions as F

from conftest import SF01
from recordflow.entities import Edge, key_for
from recordflow.operators import quality as Q
from recordflow.sources import testdata as td


def test_empty_batch_passes_schema(spark):
    d = spark.createDataFrame([], "ORDER_ID string")
    assert Q.validate_schema(d, "ORDER_PROC").count() == 0
    s = Q.validate_all(d, "ORDER_PROC").summary.first()
    assert s["passed"] and s["rows_checked"] == 0 and s["issues_found"] == 0


def test_absent_column_counts_as_null(spark):
    d = spark.createDataFrame([("1",), ("2",)], "ORDER_ID string")
    issues = {r["field_name"]: r["row_count"] for r in Q.validate_nulls(d, "X", ["PATIENT_ID", "ORDER_ID"]).collect()}
    assert issues == {"PATIENT_ID": 2}


def test_absent_key_groups_all_rows_together(spark):
    d = spark.createDataFrame([("1",), ("2",), ("3",)], "ORDER_ID string")
    p = Q.duplicate_profile(d, "MISSING_ID").first()
    assert p["surplus_rows"] == 2 and p["duplicate_keys"] == 1


def test_null_keys_form_one_group(spark):
    d = spark.createDataFrame([(None,), (None,), ("1",)], "ORDER_ID string")
    p = Q.duplicate_profile(d, "ORDER_ID").first()
    assert p["surplus_rows"] == 1 and p["duplicate_keys"] == 1


def test_key_text_form_groups_equal_text(spark):
    # Grouping is by text form: the same id typed as number and as text collide.
    d = spark.createDataFrame([(1,), (1,)], "ORDER_ID long")
    assert Q.duplicate_profile(d, "ORDER_ID").first()["duplicate_keys"] == 1


def test_validate_all_levels_and_counts(spark):
    d = spark.createDataFrame([("1", None), ("1", "5")], "ORDER_ID string, PATIENT_ID string")
    v = Q.validate_all(d, "ORDER_PROC", key="ORDER_ID")
    s = v.summary.first()
    # missing ORDER_START_DT_TM (error) + PATIENT_ID nulls + duplicate ORDER_ID (warnings)
    assert (s["passed"], s["issues_found"], s["errors"], s["warnings"]) == (False, 3, 1, 2)
    kinds = sorted((r["validation_type"], r["level"]) for r in v.issues.collect())
    assert kinds == [("duplicate", "warning"), ("null_check", "warning"), ("schema", "error")]


def test_name_derived_key_rules():
    assert key_for("ORDER_PROC", "validation") == "ORDER_PRO_ID"
    assert key_for("PATIENT", "validation") == "PATIEN_ID"
    assert key_for("ORDERS", "reconciliation") == "ORDER_ID"
    assert key_for("ORDER_PROC", "reconciliation") == "ORDER_PROC_ID"
    assert key_for("ORDER_PROC") == "ORDER_ID"


def test_referential_orphans_ignore_null_fk(spark):
    parent = spark.createDataFrame([(1,), (2,)], "PK long")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "FK long")
    r = Q.validate_referential({"C": child, "P": parent}, [Edge("C", "FK", "P", "PK")]).first()
    assert (r["child_rows"], r["orphan_rows"], r["orphan_keys"], r["passed"]) == (4, 2, 1, False)


def test_referential_on_test_tables(spark):
    t = td.entities(spark, SF01)
    rows = {r["entity_name"] + "." + r["field_name"]: r["orphan_rows"] for r in Q.validate_referential(t).collect()}
    assert rows["SPECIMEN.ORDER_ID"] == 0
    assert rows["CLARITY_DEP.SER_ID"] == 5         # region 4's nations name a service that isn't there
    assert rows["CLARITY_EMP.DEP_ID"] == 0
    assert rows["ORDER_MISC.VISIT_ID"] > 0 and rows["PATIENT_ALLERGY.PATIENT_ID"] > 0
    assert rows["ORDER_REC.VISIT_ID"] == 0


def test_rules_count_violations(spark):
    d = spark.createDataFrame([(50.0, "N"), (150.0, "Y"), (-1.0, "N"), (None, "N")],
                              "VALUE double, ABNORMAL_IND string").withColumn("NORMAL_RANGE", F.lit("0-100"))
    got = {r["rule_name"]: r["violations"] for r in Q.validate_rules({"RESPIRATORY": d}, Q.RESPIRATORY_RULES).collect()}
    assert got == {"value_out_of_range": 2, "abnormal_flag_contradiction": 1, "missing_result_value": 1}
