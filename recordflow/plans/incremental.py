"""Incremental pulls with a durable position ledger, and the end-to-end job.

The ledger keeps one record per run: (entity_name, run_id, position_no,
run_seq, last_extract_ts, rows_extracted, status, message) and the rest of the
run's record (format, times, exported rows, validation, output folder).

An entity's successful runs are numbered 1, 2, 3 ... without gaps. Run N + 1 is
won by publishing the file ``N + 1`` in the entity's commit folder: the file
appears whole and only once under its name (``storage.publish``), so of several
runs that started at position N one advances it and the others are fenced
before anything of theirs counts. That file is the run's record; there is no
second step that could be lost between winning and recording. Failed runs
append Parquet rows that carry the position they started from. Order goes by
position numbers, never by the drivers' clocks.

A reader takes, per entity, the successful run of the highest number, so a
failed or half-finished run never moves the position. The folder that
``output_path`` names in a successful record is published; one that a run left
when it died is in no record. Findings of a run's validation are kept in a
second table beside the ledger, digests of the rows that a run pulled in a
third (``seen``, by month of change), which overlapping pulls look up. The
position is the largest change time of the rows actually exported (not the
wall clock), and it stays put on failure or on an empty batch.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..entities import DEFAULT_CHANGE_COLUMN, ENTITIES, FIRST_RUN_POSITION, check_entity, key_for
from ..functions import columns as C
from ..operators.quality import missing_required, validate_all
from ..sources import sinks

SUCCESS, FAILED = "success", "failed"


def _ts_lit(v) -> F.Column:
    if isinstance(v, _dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(str(v)).cast("timestamp_ntz")


_ROW_SCHEMA = ("run_id string, position_no bigint, run_seq bigint, last_extract_ts timestamp_ntz, "
               "rows_extracted bigint, status string, message string, staged_path string, "
               "export_format string, rows_exported bigint, validation_passed boolean, issues_found bigint, "
               "position_before timestamp_ntz, output_path string, started_ts timestamp_ntz, completed_ts timestamp_ntz")
_FIELDS = [c.split() for c in _ROW_SCHEMA.split(", ")]
_AS_TEXT = ", ".join(f"{n} {'string' if t == 'timestamp_ntz' else t}" for n, t in _FIELDS)  # times in commit files
LEDGER_SCHEMA = "entity_name string, " + _ROW_SCHEMA
_SEEN_SCHEMA = "digest binary, staged_path string, entity_name string, try string, period date"
SEEN_SPLIT = 32 << 20  # bytes of staged rows whose digests one task keeps, a file for each of their months
_ISSUE_SCHEMA = ("run_id string, detected_ts timestamp_ntz, level string, validation_type string, "
                 "field_name string, message string, row_count bigint")


class PositionTaken(RuntimeError):
    """Another run of the entity advanced the position first."""


class PositionLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        # Creates the (empty) table folder on first use; "ignore" leaves an
        # existing ledger untouched and needs no failing read to find out.
        spark.createDataFrame([], _ROW_SCHEMA).write.mode("ignore").parquet(self.path)
        storage.make_folder(spark, f"{self.path}-commits")

    def _commits(self, entity: str) -> str:
        return f"{self.path}-commits/entity_name={entity}"

    def read(self, entity: str | None = None) -> DataFrame:
        """All runs' records, or one entity's: the commit files of successes and the rows of failures."""
        names = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]
        failed = self.spark.read.schema(_ROW_SCHEMA + ", entity_name string").parquet(self.path).select(*names)
        kept = self.spark.read.schema(_AS_TEXT + ", entity_name string").json(f"{self.path}-commits").selectExpr(
            "entity_name", *[f"CAST({n} AS {t}) AS {n}" for n, t in _FIELDS])
        runs = failed.unionByName(kept)
        return runs if entity is None else runs.where(F.col("entity_name") == entity)

    def positions(self) -> DataFrame:
        """Per entity: latest successful position and run, plus run counts, in the order of position numbers."""
        led = self.read()
        ok = F.col("status") == SUCCESS
        # A failed run comes after the success whose position it started from.
        order = F.struct("position_no", ~ok, "run_seq")
        return led.groupBy("entity_name").agg(
            F.max_by(F.when(ok, F.col("last_extract_ts")), F.when(ok, F.col("position_no"))).alias("last_extract_ts"),
            F.max_by(F.when(ok, F.col("rows_extracted")), F.when(ok, F.col("position_no"))).alias("last_rows"),
            F.coalesce(F.sum(F.when(ok, F.col("rows_extracted"))), F.lit(0)).cast("bigint").alias("total_rows"),
            F.count_if(ok).cast("bigint").alias("successful_runs"),
            F.count_if(~ok).cast("bigint").alias("failed_runs"),
            F.max_by("status", order).alias("last_status"))

    def latest(self, entity: str) -> tuple[_dt.datetime, int | None]:
        """Position reached by the entity's successful runs, and the number of the last of them (None before the first)."""
        row = (self.read(entity).where(F.col("status") == SUCCESS)
               .agg(F.max("last_extract_ts").alias("p"), F.max("position_no").alias("s")).first())
        if not row or row["s"] is None:
            return FIRST_RUN_POSITION, None
        return row["p"], row["s"]

    def get(self, entity: str) -> _dt.datetime:
        """Stored position of one entity (first-run bound when none)."""
        return self.latest(entity)[0]

    def mark_seen(self, entity: str, staged_path: str, rows: DataFrame, change_col: str) -> None:
        """Keep the digests of a try's rows by month of change; they count once the ledger names its staged folder.

        Digests don't compress, so they are kept as their 16 bytes and not
        shuffled: each task sorts those of its share of the staged files.
        """
        size = sum(n for _, n in storage.files(self.spark, staged_path))
        digests = (rows.select(F.unhex(F.md5(C.row_text(rows))).alias("digest"), _period(F.col(change_col), "month").alias("period"))
                   .coalesce(max(1, -(-size // SEEN_SPLIT))).sortWithinPartitions("period")
                   .select("digest", F.lit(staged_path).alias("staged_path"), "period"))
        # A folder per try, so runs may write at once.
        folder = f"{self.path}-seen/entity_name={entity}/try={uuid.uuid4().hex[:12]}"
        digests.write.mode("append").partitionBy("period").parquet(folder)

    def seen_since(self, entity: str, low) -> DataFrame:
        """(digest) of every row that successful runs pulled and that may have changed after ``low``.

        Only the months from ``low`` on are listed and read; runs that didn't
        succeed drop out by a join with the ledger, not by a collected list.
        """
        path = f"{self.path}-seen"
        storage.make_folder(self.spark, path)
        rows = self.spark.read.schema(_SEEN_SCHEMA).parquet(path).where(
            (F.col("entity_name") == entity) & (F.col("period") >= _period(_ts_lit(low), "month")))
        good = self.read(entity).where(F.col("status") == SUCCESS).select("staged_path").distinct()
        # Indexes of earlier versions hold the digest's 32 hex characters as text.
        text = F.when(F.length("digest") == 32, F.col("digest").cast("string")).otherwise(F.lower(F.hex("digest")))
        return rows.join(good, "staged_path", "left_semi").select(text.alias("digest"))

    def runs(self, run_id: str | None = None) -> DataFrame:
        """The record of every run, or of one (the id's filter reaches the scan)."""
        led = self.read()
        return led if run_id is None else led.where(F.col("run_id") == run_id)

    def issues(self, run_id: str | None = None) -> DataFrame:
        """What the validations of all runs found, or that of one run."""
        path = f"{self.path}-issues"
        self.spark.createDataFrame([], _ISSUE_SCHEMA).write.mode("ignore").parquet(path)
        out = self.spark.read.schema(_ISSUE_SCHEMA + ", entity_name string").parquet(path)
        return out if run_id is None else out.where(F.col("run_id") == run_id)

    def append_issues(self, entity: str, run_id: str, found: list) -> None:
        """Keep a run's findings (one row per failed check, so a few at most)."""
        if found:
            now = _dt.datetime.now()
            rows = [(run_id, now, r["level"], r["validation_type"], r["field_name"], r["message"], r["row_count"]) for r in found]
            self.spark.createDataFrame(rows, _ISSUE_SCHEMA).coalesce(1).write.mode("append") \
                .parquet(f"{self.path}-issues/entity_name={entity}")

    def _row(self, run_id, number, position, rows, status, message, staged_path, record) -> tuple:
        r = record or RunRecord(run_id, "", status, None, rows_exported=None)
        return (run_id, number, time.time_ns(), position, int(rows), status, message, staged_path, r.export_format, r.rows_exported,
                r.validation_passed, r.issues_found, r.position_before, r.output_path, r.started_ts, r.completed_ts)

    def commit(self, entity: str, after: int | None, run_id: str, position, rows: int, message: str | None = None,
               staged_path: str | None = None, record: RunRecord | None = None) -> None:
        """Record a success as the run that follows number ``after``; PositionTaken if another run did so first."""
        number = (after or 0) + 1
        row = self._row(run_id, number, position, rows, SUCCESS, message, staged_path, record)
        text = json.dumps({n: v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v for (n, _), v in zip(_FIELDS, row)})
        if not storage.publish(self.spark, f"{self._commits(entity)}/{number:012d}.json", text):
            raise PositionTaken("another run of this entity advanced the position during this run")

    def append(self, entity: str, run_id: str, position, rows: int, status: str, message: str | None = None,
               staged_path: str | None = None, record: RunRecord | None = None):
        """Record a run as it is: a success takes the next free number, a failure the number it started from."""
        if status != SUCCESS:
            row = self._row(run_id, self.latest(entity)[1] or 0, position, rows, status, message, staged_path, record)
            self.spark.createDataFrame([row], _ROW_SCHEMA).coalesce(1).write.mode("append") \
                .parquet(f"{self.path}/entity_name={entity}")
            return
        while True:
            try:
                return self.commit(entity, self.latest(entity)[1], run_id, position, rows, message, staged_path, record)
            except PositionTaken:
                continue  # numbers only grow: the next look finds a higher one


def incremental_batch(df: DataFrame, position, change_col: str = DEFAULT_CHANGE_COLUMN,
                      date_partition_col: str | None = None) -> DataFrame:
    """Rows changed strictly after ``position`` (the filter reaches the scan).

    When the source is laid out by change date (``write_by_change_date``),
    ``date_partition_col`` adds the implied predicate on the partition
    column, so only partitions that can hold such rows are listed and read.
    The predicate holds for day, month and year layouts alike: it keeps the
    periods that begin on the position's day or later, and those that begin
    with its month or year.
    """
    out = df.where(F.col(change_col) > _ts_lit(position))
    if date_partition_col:
        p, at = F.col(date_partition_col), _ts_lit(position)
        out = out.where((p >= _period(at, "day")) | (p == _period(at, "month")) | (p == _period(at, "year")) | p.isNull())
    return out


def _period(ts: F.Column, granularity: str) -> F.Column:
    if granularity not in ("day", "month", "year"):
        raise ValueError("granularity must be day, month or year")
    return F.to_date(F.date_trunc(granularity, ts))


def write_by_change_date(df: DataFrame, path: str, change_col: str = DEFAULT_CHANGE_COLUMN,
                         partition_col: str = "change_date", granularity: str = "month",
                         mode: str = "append") -> None:
    """Lay an entity out by the day / month / year of its change column.

    A ``rebalance`` hint on the partition column groups each period's rows
    before the write (about one file per period), and AQE splits a period
    that is far larger than the rest instead of writing it from one task.
    """
    (df.withColumn(partition_col, _period(F.col(change_col), granularity))
       .hint("rebalance", partition_col)
       .write.mode(mode).partitionBy(partition_col).parquet(path))


@dataclass
class RunRecord:
    job_id: str
    entity_name: str
    status: str
    export_format: str
    rows_extracted: int = 0
    rows_exported: int = 0
    validation_passed: bool | None = None
    issues_found: int | None = None
    position_before: _dt.datetime | None = None
    position_after: _dt.datetime | None = None
    output_path: str | None = None
    error_message: str | None = None
    started_ts: _dt.datetime | None = None
    completed_ts: _dt.datetime | None = None


def _without_seen(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``batch`` less those of ``seen``, as multisets of whole rows."""
    return _without_digests(batch, seen.select(F.md5(C.row_text(seen.select(batch.columns))).alias("digest")))


def _without_digests(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``batch`` less those that have a digest in ``seen``, as often as it is there.

    Rows are counted by digest; what is left of a digest is its row repeated,
    so no group of equal rows is ever gathered in one task.
    """
    cols = batch.columns
    digest = F.md5(C.row_text(batch))
    one = batch.select("*", digest.alias("_digest")).groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*cols)).alias("_row"))
    had = seen.groupBy(F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("_had"))
    left = one.join(had, "_digest", "left").withColumn("_left", F.col("_n") - F.coalesce("_had", F.lit(0))).where("_left > 0")
    return left.select(F.explode(F.sequence(F.lit(1), F.col("_left"))).alias("_i"), "_row").select("_row.*")


def run_etl_job(spark: SparkSession, entity: str, source: DataFrame, ledger_path: str, out_root: str,
                 export_format: str = "csv", change_col: str = DEFAULT_CHANGE_COLUMN,
                 key: str | None = None, fail_on: str | None = None, job_id: str | None = None,
                 overlap: _dt.timedelta | None = None, date_partition_col: str | None = None,
                 **export_opts) -> RunRecord:
    """Position -> scan -> stage -> validate -> export -> advance position.

    The changed rows are read from the source once and staged as Parquet in
    the run folder (row count and max change time observed during that
    write); validation and export then read the staged copy, so both see
    the same snapshot. Validation findings do not stop the export unless
    ``fail_on`` is ``"error"`` (schema errors) or ``"warning"`` (any issue).
    Any exception records a FAILED run and leaves the position unchanged,
    including the case where another run of the same entity succeeded while
    this one was running: the ledger lets one of them advance the position.

    The job id names the entity and the number of the position it works
    towards. A given ``job_id`` makes a retry safe: if a run of that id has
    succeeded, its record is returned and nothing is done again; if it died at
    any point before, its leftovers are in no record and the rows are pulled
    anew.

    ``overlap``: also re-read rows changed up to this long before the
    position (late arrivals with an old change time, ties at the position)
    and leave out the rows that earlier runs already staged: whole rows are
    compared by digest, as often as they occur, so another row with the same
    key and change time, or a null key, is neither lost nor repeated.
    """
    led = PositionLedger(spark, ledger_path)
    started, attempt = _dt.datetime.now(), uuid.uuid4().hex[:12]
    rec, pos = RunRecord(job_id or attempt, entity, "running", export_format, started_ts=started), FIRST_RUN_POSITION
    try:
        check_entity(entity)
        pos, number = led.latest(entity)
        if job_id is None:
            rec.job_id = job_id = f"{entity}-{(number or 0) + 1}-{attempt}"
        else:
            done = led.runs(job_id).where((F.col("status") == SUCCESS) & (F.col("entity_name") == entity)).first()
            if done is not None:
                return _as_record(done)
        rec.position_before = pos
        if export_format not in sinks.EXPORTERS:
            raise ValueError(f"unknown export format {export_format!r}")
        if fail_on == "error" and missing_required(source, entity):
            raise ValueError(f"required fields missing: {missing_required(source, entity)}")
        run_path = f"{out_root.rstrip('/')}/{entity}/{job_id}"
        if storage.files(spark, f"{run_path}/staged"):  # of a try with this id that died: leave it, it may still be written
            run_path = f"{run_path}-{attempt}"
        key = key or key_for(entity)
        low = pos - overlap if overlap else pos
        batch = incremental_batch(source, low, change_col, date_partition_col)
        if overlap:
            batch = _without_digests(batch, led.seen_since(entity, low))
        obs = Observation(f"stage_{job_id}")
        (batch.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(change_col).alias("max_ts"))
         .write.mode("overwrite").parquet(f"{run_path}/staged"))
        m = obs.get
        staged = spark.read.parquet(f"{run_path}/staged")
        found = validate_all(staged, entity, key).issues.collect()  # one row per failed check
        rec.validation_passed, rec.issues_found = not found, len(found)
        led.append_issues(entity, job_id, found)
        if fail_on == "warning" and not rec.validation_passed:
            raise ValueError(f"validation failed with {rec.issues_found} issue(s)")
        res = sinks.export(staged, export_format, f"{run_path}/{export_format}", **export_opts)
        rec.rows_extracted, rec.rows_exported = int(m["rows"]), int(res.record_count)
        new_pos = max(pos, m["max_ts"]) if rec.rows_extracted > 0 and m["max_ts"] is not None else pos
        if rec.rows_extracted:
            led.mark_seen(entity, f"{run_path}/staged", staged, change_col)
        rec.status, rec.position_after, rec.output_path, rec.completed_ts = SUCCESS, new_pos, res.path, _dt.datetime.now()
        # The one step that counts: a run that was overtaken is fenced here.
        led.commit(entity, number, job_id, new_pos, rec.rows_extracted, staged_path=f"{run_path}/staged", record=rec)
    except Exception as e:
        rec.status, rec.error_message, rec.position_after, rec.output_path = FAILED, str(e), pos, None
        rec.rows_extracted = rec.rows_exported = 0
        rec.completed_ts = _dt.datetime.now()
        if entity in ENTITIES:  # an unknown name is no folder of the ledger
            led.append(entity, rec.job_id, pos, 0, FAILED, rec.error_message, record=rec)
    return rec


def _as_record(row) -> RunRecord:
    """The run record that a ledger row keeps."""
    return RunRecord(row["run_id"], row["entity_name"], row["status"], row["export_format"], row["rows_extracted"], row["rows_exported"],
                     row["validation_passed"], row["issues_found"], row["position_before"], row["last_extract_ts"], row["output_path"],
                     row["message"], row["started_ts"], row["completed_ts"])


RUN_RECORD_SCHEMA = ("job_id string, entity_name string, status string, export_format string, "
                     "rows_extracted bigint, rows_exported bigint, validation_passed boolean, "
                     "issues_found bigint, position_before timestamp_ntz, position_after timestamp_ntz, "
                     "output_path string, error_message string, started_ts timestamp_ntz, "
                     "completed_ts timestamp_ntz")


def records_frame(spark: SparkSession, recs: list[RunRecord]) -> DataFrame:
    """Run records (driver-side metadata, a handful of rows) as a DataFrame."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in recs], RUN_RECORD_SCHEMA)
