"""Values, ranges, numbers and incremental pulls that the table fixtures don't reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordflow.functions import columns as C
from recordflow.operators import quality as Q
from recordflow.operators import reconcile as R
from recordflow.plans import incremental as INC
from recordflow.sources import sinks


def _texts(df, name="v"):
    return [r[0] for r in df.select(C.canonical_text(df, name)).collect()]


def test_doubles_keep_every_bit(spark):
    a = _texts(spark.sql("SELECT explode(array(1e-10D, 4e-10D, 0.1D, 0.1D + 1e-18D, 1e300D, double('NaN'), double('Infinity'))) AS v"))
    assert len(set(a)) == 6 and a[2] == a[3]  # 0.1 + 1e-18 is the same double as 0.1
    z = _texts(spark.sql("SELECT explode(array(0.0D, -0.0D)) AS v"))
    assert z[0] == z[1]


def test_row_diff_sees_a_tiny_change(spark):
    s = spark.sql("SELECT id AS ORDER_ID, CAST(id AS DOUBLE) / 7 AS VALUE FROM range(20)")
    t = s.withColumn("VALUE", F.when(F.col("ORDER_ID") == 3, F.col("VALUE") + 1e-15).otherwise(F.col("VALUE")))
    rep = R.reconcile([("RESPIRATORY", s, t), ("SAME", s, s)]).report.collect()
    assert {r["entity_name"]: r["checksum_match"] for r in rep} == {"RESPIRATORY": False, "SAME": True}


def test_nested_values(spark):
    df = spark.sql("""SELECT struct(timestamp_ntz'2024-01-01 00:00:00.000001' AS t, array(1, null) AS a) AS v
                      UNION ALL SELECT struct(timestamp_ntz'2024-01-01 00:00:00.000002', array(1, null))
                      UNION ALL SELECT null""")
    assert len(set(_texts(df))) == 3
    maps = spark.sql("SELECT map('a', 1, 'b', 2) AS v UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT map('a', 2, 'b', 1)")
    t = _texts(maps)
    assert t[0] == t[1] != t[2]
    arrays = _texts(spark.sql("SELECT array('a|b') AS v UNION ALL SELECT array('a', 'b') UNION ALL SELECT array('a', null)"))
    assert len(set(arrays)) == 3


def test_rules_read_any_range(spark):
    rows = [(1, 4.0, "<5", "N"), (2, 5.0, "<5", "Y"), (3, -7.0, "-5-10", "Y"), (4, -5.0, "-5--1", "N"), (5, 1.0, "see note", "N"),
            (6, 3.0, ">=3", "N"), (7, 2.0, None, None), (8, None, "0-1", "Y"), (9, 2.5, " 1.5 - 2 ", "N")]
    df = spark.createDataFrame(rows, "RESULT_ID int, VALUE double, NORMAL_RANGE string, ABNORMAL_IND string")
    got = {r["rule_name"]: r["violations"] for r in Q.validate_rules({"RESPIRATORY": df}, [*Q.RESPIRATORY_RULES, Q.UNREADABLE_RANGE]).collect()}
    assert got == {"value_out_of_range": 3, "abnormal_flag_contradiction": 1, "missing_result_value": 1, "unreadable_normal_range": 1}


def test_csv_numbers_as_python_prints_them(spark):
    values = [1.0e7, 1e-5, 123456789.5, 0.1, 1e16, 1.5e-7, -2.0, 0.0, 1e22, 0.0001, 9999999999999998.0, 1.0 / 3, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in sinks.csv_lines(df).collect()] == [repr(v) for v in values]


@pytest.mark.parametrize("granularity", ["day", "month", "year"])
def test_no_layout_loses_rows(spark, tmp_out, granularity):
    rows = [(i, dt.datetime(2001, 1, 1) + dt.timedelta(days=30 * i)) for i in range(30)]
    df = spark.createDataFrame(rows, "ORDER_ID int, UPDATE_DT_TM timestamp_ntz")
    INC.write_by_change_date(df, tmp_out + "/x", granularity=granularity)
    back = spark.read.parquet(tmp_out + "/x")
    for pos in ("2001-06-15 00:00:00", "2001-01-01 00:00:00", "2002-12-31 12:00:00"):
        assert INC.incremental_batch(back, pos, date_partition_col="change_date").count() == INC.incremental_batch(df, pos).count()


def test_overlap_is_a_multiset_of_whole_rows(spark):
    t = dt.datetime(2024, 1, 1)
    kind = "ORDER_ID int, PATIENT_ID int, UPDATE_DT_TM timestamp_ntz"
    seen = spark.createDataFrame([(1, 1, t), (None, 5, t), (2, 2, t)], kind)
    now = spark.createDataFrame([(1, 1, t), (1, 9, t), (None, 5, t), (None, 6, t), (2, 2, t), (2, 2, t)], kind)
    left = sorted((r[0] or 0, r[1]) for r in INC._without_seen(now, seen).collect())
    assert left == [(0, 6), (1, 9), (2, 2)]


def test_message_ids_do_not_collide(spark):
    df = spark.range(5_000_000).select(C.message_id(F.col("id"), 32).alias("m"))
    assert df.distinct().count() == 5_000_000


def test_shared_folder_must_be_named_off_local():
    from recordflow.session import shared_dir

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
