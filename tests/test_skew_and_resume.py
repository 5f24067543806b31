"""Joins with hot keys on either side, resumable extracts, racing runs, one-file exports."""

import csv
import datetime as dt
import io
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from recordflow import storage
from recordflow.functions import columns as C
from recordflow.operators import joins as J
from recordflow.plans import extracts as X
from recordflow.plans import incremental as INC
from recordflow.sources import artefact
from recordflow.sources import sinks as SK
from recordflow.sources import testdata as td


@pytest.fixture()
def shuffled(spark):
    """No broadcasts, 16 shuffle partitions that stay apart: every join is a shuffled one."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows_per_task(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def _largest_share(df, tasks=16):
    n = _rows_per_task(df)
    return max(n) / (sum(n) / tasks)


def _bag(df):
    return df.groupBy(*df.columns).count().select(F.sum(F.xxhash64(*df.columns, "count").cast("decimal(38,0)")), F.sum("count")).first()


@pytest.mark.parametrize("hot_left,hot_right", [(True, False), (False, True), (True, True)])
def test_hot_keys_spread_on_either_side(spark, shuffled, hot_left, hot_right):
    """90 % of a side's rows on one key: no task has over three times the mean, in a single join and in a star."""
    many, few = 200_000, 300
    left = spark.range(many if hot_left else few, numPartitions=8).selectExpr("IF(id % 10 < 9, 7L, id) AS k", "id AS l")
    right = spark.range(many if hot_right and not hot_left else few, numPartitions=8).selectExpr(
        "IF(id % 10 < 9, 7L, id) AS k" if hot_right else "id AS k", "id AS r")
    if hot_right and hot_left:
        left = left.where("l < 40000")
    else:
        right = right if hot_right else right.where("r < 200")
    if hot_right and not hot_left:
        left = left.where("l % 10 = 9 OR l < 3")
    single = J.left_join(left, right, "k", J.AUTO)
    assert _bag(single) == _bag(left.join(right, "k", "left").select(*single.columns))
    assert _largest_share(single) < 3
    other = spark.range(50, numPartitions=2).selectExpr("id AS k", "id * 2 AS o")
    star = J.star_join(left, [right, other], "k", J.AUTO)
    assert _bag(star) == _bag(left.join(right, "k", "left").join(other, "k", "left").select(*star.columns))
    assert _largest_share(star) < 3


def test_star_of_three_hot_sides_keeps_every_pair(spark, shuffled):
    left = spark.range(60).selectExpr("id % 3 AS k", "id AS l").unionByName(spark.sql("SELECT CAST(null AS bigint) AS k, -1L AS l"))
    a = spark.range(40).selectExpr("IF(id < 30, 0L, id) AS k", "id AS a")
    b = spark.range(40).selectExpr("IF(id < 20, 0L, 1L) AS k", "id AS b")
    c = spark.range(9).selectExpr("2L AS k", "id AS c")
    got = J.star_join(left, [a, b, c], "k", 5, 3)
    assert _bag(got) == _bag(left.join(a, "k", "left").join(b, "k", "left").join(c, "k", "left").select(*got.columns))


def test_no_hot_key_means_a_plain_plan(spark, shuffled):
    import contextlib
    l, r = spark.range(5000).selectExpr("id AS k", "id AS l"), spark.range(5000).selectExpr("id AS k", "id AS r")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        J.left_join(l, r, "k", J.AUTO).explain()
    assert buf.getvalue().count("Join") == 1 and "Generate" not in buf.getvalue()


def test_equal_rows_of_a_hot_key_spread(spark, shuffled):
    left = spark.range(160_000, numPartitions=32).selectExpr("7L AS k", "'same' AS l")
    right = spark.createDataFrame([(7, "r")], "k long, r string")
    got = J.left_join(left, right, "k", J.AUTO)
    assert got.count() == 160_000 and max(_rows_per_task(got)) < 160_000 / 3


# ---------------------------------------------------------------- resumable runs

PARAMS = dict(start_date="1900-01-01", end_date="2100-01-01")


def test_resume_makes_only_the_missing_chunks(spark, tmp_out):
    t = td.entities(spark, SF001, ["ORDER_PROC", "SPECIMEN"])
    out, log = tmp_out + "/run", tmp_out + "/log"
    first = X.run_extract_resumable(spark, "extract_orders_psd", t, out, chunks=5, stop_after=2, log_path=log, **PARAMS)
    assert (first.status, first.chunks, first.chunks_made) == ("partial", 5, 2)
    before = {i: r["folder"] for i, r in X.committed_chunks(spark, out).items()}
    # A chunk folder of a run that died before its commit is in no result.
    t["ORDER_PROC"].limit(3).write.parquet(f"{out}/chunks/000003-dead")
    second = X.run_extract_resumable(spark, "extract_orders_psd", t, out, chunks=9, log_path=log, **PARAMS)
    whole = X.build_extract("extract_orders_psd", t, ordered=False, **PARAMS)
    assert (second.status, second.chunks, second.chunks_made, second.rows) == ("success", 5, 3, whole.count())
    after = {i: r["folder"] for i, r in X.committed_chunks(spark, out).items()}
    assert all(after[i] == f for i, f in before.items())
    got = X.read_extract(spark, out)
    assert got.exceptAll(whole).count() == whole.exceptAll(got).count() == 0
    third = X.run_extract_resumable(spark, "extract_orders_psd", t, out, log_path=log, **PARAMS)
    assert (third.status, third.chunks_made, third.rows) == ("success", 0, second.rows)
    runs = X.extract_runs(spark, log).orderBy("started_ts").collect()
    assert [r["status"] for r in runs] == ["partial", "success", "success"]
    assert X.extract_runs(spark, log, second.run_id).first()["chunks_made"] == 3
    other = X.run_extract_resumable(spark, "extract_orders_psd", t, out, start_date="1998-01-01", end_date="1999-01-01")
    assert other.status == "failed" and "another run" in other.error


def test_a_failing_chunk_leaves_the_others_committed(spark, tmp_out, monkeypatch):
    t = td.entities(spark, SF001, ["PATIENT", "PATIENT_ALLERGY", "PATIENT_DIAGNOSIS"])
    real, calls = X._write_counted, []

    def fragile(df, path, fmt, name):
        calls.append(path)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(df, path, fmt, name)

    monkeypatch.setattr(X, "_write_counted", fragile)
    run = X.run_extract_resumable(spark, "extract_patient_demographics", t, tmp_out + "/p", chunks=4, start_patient_id=0)
    assert (run.status, run.error, run.chunks_made) == ("failed", "lost", 2)
    run = X.run_extract_resumable(spark, "extract_patient_demographics", t, tmp_out + "/p", chunks=4, start_patient_id=0)
    assert (run.status, run.chunks_made) == ("success", 2)
    assert X.read_extract(spark, tmp_out + "/p").count() == X.build_extract("extract_patient_demographics", t, start_patient_id=0).count()


def test_resume_of_an_empty_range(spark, tmp_out):
    t = td.entities(spark, SF001, ["ORDER_PROC", "SPECIMEN"])
    run = X.run_extract_resumable(spark, "extract_orders_psd", t, tmp_out + "/e", start_date="1800-01-01", end_date="1800-01-02")
    assert (run.status, run.rows, run.chunks) == ("success", 0, 1) and X.read_extract(spark, tmp_out + "/e").count() == 0


# ------------------------------------------------------------------- racing runs

def test_publish_has_one_winner(spark, tmp_out):
    wins, start = [], threading.Barrier(8)

    def go(i):
        start.wait()
        wins.append(storage.publish(spark, f"{tmp_out}/c/1.json", str(i) * 1000))

    threads = [threading.Thread(target=go, args=(i,)) for i in range(8)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert sorted(wins) == [False] * 7 + [True]
    assert len(set(open(f"{tmp_out}/c/1.json").read())) == 1 and os.listdir(f"{tmp_out}/c") == ["1.json"]


def test_two_runs_at_once_advance_the_position_once(spark, tmp_out, monkeypatch):
    src = td.entities(spark, SF001, ["ORDER_PROC"])["ORDER_PROC"]
    INC.PositionLedger(spark, tmp_out + "/l")
    both, real = threading.Barrier(2, timeout=120), INC.sinks.export

    def meet(*a, **k):
        out = real(*a, **k)
        both.wait()  # neither has committed when both have exported
        return out

    monkeypatch.setattr(INC.sinks, "export", meet)
    recs = []
    threads = [threading.Thread(target=lambda: recs.append(INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/l", tmp_out + "/o"))) for _ in range(2)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert sorted(r.status for r in recs) == ["failed", "success"]
    led = INC.PositionLedger(spark, tmp_out + "/l")
    p = led.positions().first()
    assert (p["successful_runs"], p["failed_runs"], p["total_rows"]) == (1, 1, src.count())
    assert "advanced the position" in [r for r in recs if r.status == "failed"][0].error_message
    published = [r["output_path"] for r in led.runs().where("output_path is not null").collect()]
    assert published == [[r for r in recs if r.status == "success"][0].output_path]


def test_retry_after_export_publishes_once(spark, tmp_out, monkeypatch):
    src = td.entities(spark, SF001, ["ORDER_PROC"])["ORDER_PROC"]
    kw = dict(job_id="nightly-7", overlap=dt.timedelta(days=36500))
    real = INC.PositionLedger.commit

    class Died(BaseException):
        pass

    def die(*a, **k):
        raise Died()

    monkeypatch.setattr(INC.PositionLedger, "commit", die)
    with pytest.raises(Died):  # the driver is lost between export and commit
        INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/l", tmp_out + "/o", **kw)
    monkeypatch.setattr(INC.PositionLedger, "commit", real)
    led = INC.PositionLedger(spark, tmp_out + "/l")
    assert led.latest("ORDER_PROC")[1] is None
    r = INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/l", tmp_out + "/o", **kw)
    assert (r.status, r.rows_extracted) == ("success", src.count())
    again = INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/l", tmp_out + "/o", **kw)
    assert (again.status, again.output_path, again.rows_extracted) == ("success", r.output_path, r.rows_extracted)
    assert led.positions().first()["successful_runs"] == 1
    # The dead try's digests don't count: nothing is new, and a repeated row is.
    more = src.unionByName(src.where("ORDER_ID % 100 = 0"))
    late = INC.run_etl_job(spark, "ORDER_PROC", more, tmp_out + "/l", tmp_out + "/o", overlap=dt.timedelta(days=36500))
    assert late.rows_extracted == src.where("ORDER_ID % 100 = 0").count()


def test_positions_go_by_number_not_by_clock(spark, tmp_out, monkeypatch):
    led = INC.PositionLedger(spark, tmp_out + "/l")
    monkeypatch.setattr(INC.time, "time_ns", lambda: 2000)
    led.append("X", "a", dt.datetime(2020, 1, 1), 5, INC.SUCCESS)
    monkeypatch.setattr(INC.time, "time_ns", lambda: 1000)  # a driver whose clock is behind
    led.append("X", "b", dt.datetime(2021, 1, 1), 7, INC.SUCCESS)
    p = led.positions().first()
    assert (p["last_extract_ts"], p["last_rows"], led.latest("X")) == (dt.datetime(2021, 1, 1), 7, (dt.datetime(2021, 1, 1), 2))
    led.append("X", "c", dt.datetime(2021, 1, 1), 0, INC.FAILED, "boom")
    assert led.positions().first()["last_status"] == "failed"


def test_seen_rows_are_looked_up_by_period(spark, tmp_out):
    import contextlib
    src = td.entities(spark, SF001, ["ORDER_PROC"])["ORDER_PROC"]
    INC.run_etl_job(spark, "ORDER_PROC", src, tmp_out + "/l", tmp_out + "/o")
    led = INC.PositionLedger(spark, tmp_out + "/l")
    low = dt.datetime(2001, 6, 15)
    seen = led.seen_since("ORDER_PROC", low)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        seen.explain("formatted")
    assert "PartitionFilters: [" in buf.getvalue() and "period" in buf.getvalue().split("PartitionFilters")[1].split("\n")[0]
    assert seen.count() == src.where(F.date_trunc("month", "UPDATE_DT_TM") >= "2001-06-01").count()


def test_seen_rows_are_kept_as_bytes_and_not_shuffled(spark, tmp_out, monkeypatch):
    import contextlib
    src = td.entities(spark, SF001, ["ORDER_PROC"])["ORDER_PROC"]
    src.repartition(6).write.parquet(tmp_out + "/s")
    led, staged = INC.PositionLedger(spark, tmp_out + "/l"), spark.read.parquet(tmp_out + "/s")
    monkeypatch.setattr(INC, "SEEN_SPLIT", 20_000)
    written, real = [], type(src).write.fget
    monkeypatch.setattr(type(src), "write", property(lambda df: (written.append(df), real(df))[1]))
    led.mark_seen("ORDER_PROC", tmp_out + "/s", staged, "UPDATE_DT_TM")
    monkeypatch.undo()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        written[-1].explain()
    assert "Exchange" not in buf.getvalue()
    kept = spark.read.parquet(tmp_out + "/l-seen")
    assert dict(kept.dtypes)["digest"] == "binary" and {r[0] for r in kept.select(F.length("digest")).distinct().collect()} == {16}
    led.commit("ORDER_PROC", None, "r", dt.datetime(2020, 1, 1), src.count(), staged_path=tmp_out + "/s")
    want = sorted(r[0] for r in src.select(F.md5(C.row_text(src))).collect())
    assert sorted(r[0] for r in led.seen_since("ORDER_PROC", dt.datetime(1900, 1, 1)).collect()) == want
    # An index of text digests, as earlier versions wrote it, is read alike.
    old = src.select(F.md5(C.row_text(src)).alias("digest"), F.lit(tmp_out + "/s").alias("staged_path"), F.lit("2001-01-01").alias("period"))
    old.write.partitionBy("period").parquet(tmp_out + "/l-seen/entity_name=ORDER_PROC/try=old")
    assert sorted(r[0] for r in led.seen_since("ORDER_PROC", dt.datetime(1900, 1, 1)).collect()) == sorted(want * 2)


# -------------------------------------------------------------- one-file exports

@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_assembled_file_is_the_parts_in_order(spark, tmp_out, monkeypatch, piece):
    spark.range(1000).selectExpr("CAST(id AS string) AS v").repartitionByRange(7, F.col("v").cast("int")).sortWithinPartitions(F.col("v").cast("int")) \
        .write.option("lineSep", ",\n").text(tmp_out + "/parts")
    size = artefact.assemble(spark, tmp_out + "/parts", tmp_out + "/x.txt", head="[", tail="]", drop_last=2, piece=piece)
    text = open(tmp_out + "/x.txt").read()
    assert json.loads(text) == list(range(1000)) and len(text) == size and not os.path.exists(tmp_out + "/parts")


def test_one_csv_file(spark, tmp_out):
    rows = [(i, f'a"{i},\n' if i % 3 else None, i / 7) for i in range(500)]
    df = spark.createDataFrame(rows, "K int, V string, D double").repartition(9)
    SK.export(df, "csv_file", tmp_out + "/one.csv", order_by=["K"])
    with open(tmp_out + "/one.csv", newline="") as f:
        raw = f.read()
    want = io.StringIO()
    out = csv.writer(want)
    out.writerow(["K", "V", "D"])
    out.writerows([(k, "" if v is None else v, d) for k, v, d in rows])
    assert raw == want.getvalue()
    SK.export(df.limit(0), "csv_file", tmp_out + "/none.csv", order_by=["K"])
    assert os.path.getsize(tmp_out + "/none.csv") == 0


def test_one_bundle_file(spark, tmp_out):
    p = td.entities(spark, SF001, ["PATIENT"])["PATIENT"]
    n = SK.export(p, "fhir_file", tmp_out + "/b.json", run_ts="2024-01-01 00:00:00", run_id="x", order_by=["PATIENT_ID"]).record_count
    b = json.load(open(tmp_out + "/b.json"))
    assert (b["resourceType"], b["type"], len(b["entry"]), n) == ("Bundle", "collection", p.count(), p.count())
    ids = [int(e["resource"]["id"]) for e in b["entry"]]
    assert ids == sorted(ids)
    SK.export(p.limit(0), "fhir_file", tmp_out + "/e.json", run_ts="2024-01-01 00:00:00", run_id="x")
    assert json.load(open(tmp_out + "/e.json"))["entry"] == []


def test_csv_of_one_column_and_floats(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "v string")
    assert sorted(r[0] for r in SK.csv_lines(df).collect()) == ['""', '""', "a"]
    f = spark.createDataFrame([(1e10,), (0.5,)], "v float")
    assert [r[0] for r in SK.csv_lines(f).collect()] == ["10000000000.0", "0.5"]


def test_empty_rerun_removes_the_header(spark, tmp_out):
    df = spark.createDataFrame([(1,)], "v int")
    r = SK.write_csv(df, tmp_out + "/c")
    assert os.path.exists(r.files["header"])
    SK.write_csv(df.limit(0), tmp_out + "/c")
    assert not os.path.exists(r.files["header"])
