"""The parameterised extracts of the catalog and a runner for them.

Every extract is a left outer equi join (plain, chain or star) of a driving
entity, a predicate on the driving entity only, a projection and an
optional ordering. Predicates are applied before the joins, so Catalyst
pushes them into the driving scan; the joined sides are pruned to the
projected columns. Bag semantics are kept: star joins multiply rows per
key (n x m) by design, never de-duplicated.
"""

from __future__ import annotations

import datetime as _dt
import json
import threading
import uuid
from dataclasses import astuple, dataclass
from itertools import groupby

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from .. import storage
from ..operators.joins import AUTO, joined_rows, sorted_rows, star_join, will_broadcast
from ..session import JobTag
from .catalog import EXTRACTS, ExtractDef, Joined, extracts_by_category, register_extract, unregister_extract  # noqa: F401
from .sql_extract import run_sql


def _ts(v) -> F.Column:
    """Bound literal for a timestamp_ntz column (string, date or datetime)."""
    if isinstance(v, F.Column):
        return v
    if isinstance(v, _dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(str(v)).cast("timestamp_ntz")


def _half_open(c: str, start, end) -> F.Column:
    return (F.col(c) >= _ts(start)) & (F.col(c) < _ts(end))


def _declared_range(driving: DataFrame, d: ExtractDef, values: list) -> DataFrame:
    """The driving rows that the parameters select."""
    if isinstance(driving.schema[d.bound].dataType, (TimestampNTZType, TimestampType)):
        values = [_ts(v) for v in values]
    out = driving.where(F.col(d.bound) >= values[0])
    return out.where(F.col(d.bound) < values[1]) if len(values) > 1 else out


def _declared(d: ExtractDef, t: dict[str, DataFrame], values: list, ordered: bool, hot_key_threshold: int | str | None) -> DataFrame:
    out = driving = _declared_range(t[d.entities[0]], d, values).select(*d.columns)
    stars = []
    # In a chain, a null key from an earlier join matches nothing (equi join).
    # Sides on one key are joined together; how often a chain's later keys
    # occur is read off the entity that brings them, not off the joined rows.
    holder = {c: out for c in d.columns}
    for key, group in groupby(d.joined, key=lambda j: j.key):
        sides = [t[j.entity].select(j.key, *[c for c in j.columns if c != j.key]) for j in group]
        stars.append((holder[key].select(key), sides, key))
        out = star_join(out, sides, key, hot_key_threshold, keys_of=stars[-1][0])
        holder = {**{c: s for s in sides for c in s.columns}, **holder}
    out = out.select(*d.output)
    if not (ordered and d.sort):
        return out
    # The source dialect sorts nulls last in ascending order.
    return sorted_rows(out, [F.col(c).asc_nulls_last() for c in d.sort], _expected_rows(driving, stars))


def _expected_rows(driving: DataFrame, stars: list[tuple[DataFrame, list[DataFrame], str]]) -> float:
    """How many rows the joins give: exact for joins on one key, for a chain as its joins multiply the rows of the
    entities that bring their keys. Inputs that Spark would broadcast all together aren't counted (0)."""
    if all(will_broadcast(f) for f in (driving, *(s for _, sides, _ in stars for s in sides))):
        return 0
    rows = None
    for keys, sides, key in stars:
        had, made = joined_rows(keys, sides, key)
        rows = made if rows is None else rows * made / max(1, had)
    return driving.count() if rows is None else rows


def orders_psd(t: dict[str, DataFrame], start_date, end_date, **options) -> DataFrame:
    return build_extract("extract_orders_psd", t, start_date=start_date, end_date=end_date, **options)


def organizational_hierarchy(t: dict[str, DataFrame], start_ser_id, **options) -> DataFrame:
    return build_extract("extract_organizational_hierarchy", t, start_ser_id=start_ser_id, **options)


def billing_accounts(t: dict[str, DataFrame], start_date, end_date, **options) -> DataFrame:
    """The output repeats every AR row once per payment of the same account;
    money totals must come from ``billing_totals`` instead."""
    return build_extract("extract_billing_accounts", t, start_date=start_date, end_date=end_date, **options)


def billing_totals(t: dict[str, DataFrame], start_date, end_date) -> DataFrame:
    """Per-account AR and payment totals without the star-join fan-out.

    Each branch is aggregated by ACCOUNT_ID first (partial aggregation runs
    map-side, so a hot account is reduced before the shuffle), and only the
    one-row-per-account results are joined to ACCOUNT.
    """
    a = (t["ACCOUNT"].where(_half_open("CREATE_DT_TM", start_date, end_date))
         .select("ACCOUNT_ID", "PATIENT_ID", "BALANCE_AMT"))
    ar = t["PB_AR"].groupBy("ACCOUNT_ID").agg(
        F.sum("AMOUNT").cast("decimal(38,2)").alias("AR_TOTAL"),
        F.count(F.lit(1)).alias("AR_ROWS"))
    py = t["GB_PAYMENT"].groupBy("ACCOUNT_ID").agg(
        F.sum("PAYMENT_AMT").cast("decimal(38,2)").alias("PAID_TOTAL"),
        F.count(F.lit(1)).alias("PAYMENT_ROWS"))
    return (a.join(ar, "ACCOUNT_ID", "left").join(py, "ACCOUNT_ID", "left")
            .select("ACCOUNT_ID", "PATIENT_ID", "BALANCE_AMT",
                    F.coalesce("AR_TOTAL", F.lit(0).cast("decimal(38,2)")).alias("AR_TOTAL"),
                    F.coalesce("AR_ROWS", F.lit(0).cast("bigint")).alias("AR_ROWS"),
                    F.coalesce("PAID_TOTAL", F.lit(0).cast("decimal(38,2)")).alias("PAID_TOTAL"),
                    F.coalesce("PAYMENT_ROWS", F.lit(0).cast("bigint")).alias("PAYMENT_ROWS")))


def _checked(d: ExtractDef, params: dict) -> dict:
    missing = [p for p in d.params if p not in params]
    extra = [p for p in params if p not in d.params]
    if missing or extra:
        raise ValueError(f"{d.name}: missing params {missing}, unexpected {extra}")
    return params


def build_extract(name: str, tables: dict[str, DataFrame], ordered: bool = True,
                  hot_key_threshold: int | str | None = AUTO, **params) -> DataFrame:
    """The extract as a DataFrame; parameters are checked by name.

    ``hot_key_threshold``: join keys with more rows than this on either side
    are salted (``operators.joins.star_join``). ``AUTO`` goes by a task's mean
    share and looks for hot keys first, unless Spark would broadcast all joined
    sides anyway; None plans plain joins, as bucketed tables want them.
    """
    d = EXTRACTS.get(name)
    if d is None:
        raise ValueError(f"unknown extract {name!r}; known: {', '.join(EXTRACTS)}")
    _checked(d, params)
    if d.text is not None:
        for entity in d.entities:
            tables[entity].createOrReplaceTempView(entity)
        return run_sql(tables[d.entities[0]].sparkSession, d.text, **params)
    return _declared(d, tables, [params[p] for p in d.params], ordered, hot_key_threshold)


@dataclass
class ExtractRun:
    name: str
    status: str
    rows: int
    path: str | None
    error: str | None = None
    started_ts: _dt.datetime | None = None
    completed_ts: _dt.datetime | None = None
    run_id: str | None = None
    chunks: int | None = None          # of a resumable run: all, and those that this run made
    chunks_made: int | None = None


_RUN_SCHEMA = ("name string, status string, rows bigint, path string, error string, started_ts timestamp_ntz, "
               "completed_ts timestamp_ntz, run_id string, chunks bigint, chunks_made bigint")


def extract_runs(spark: SparkSession, log_path: str, run_id: str | None = None) -> DataFrame:
    """The kept records of extract runs, or of one run (the id's filter reaches the scan)."""
    spark.createDataFrame([], _RUN_SCHEMA).write.mode("ignore").parquet(log_path)
    runs = spark.read.schema(_RUN_SCHEMA).parquet(log_path)
    return runs if run_id is None else runs.where(F.col("run_id") == run_id)


def _kept(spark: SparkSession, run: ExtractRun, log_path: str | None) -> ExtractRun:
    if log_path is not None:
        spark.createDataFrame([astuple(run)], _RUN_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)
    return run


class _Limited:
    """Tags the jobs of a run and cancels them when its time is up."""

    def __init__(self, spark: SparkSession, timeout_s: float | None):
        self.tag, self.timeout_s, self.timer, self.over = JobTag(spark, f"recordflow-extract-{uuid.uuid4().hex}"), timeout_s, None, False

    def __enter__(self):
        self.tag.__enter__()
        if self.timeout_s is not None:
            self.timer = threading.Timer(self.timeout_s, self._cancel)
            self.timer.start()
        return self

    def _cancel(self):
        self.over = True
        self.tag.cancel()

    def message(self, e: Exception) -> str:
        return f"timeout: cancelled after {self.timeout_s} s" if self.over else str(e)

    def __exit__(self, *exc):
        if self.timer is not None:
            self.timer.cancel()
        return self.tag.__exit__(*exc)


def _write_counted(df: DataFrame, path: str, fmt: str, name: str) -> int:
    obs = Observation(f"rows_{name}_{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    return int(obs.get["rows"])


def run_extract(spark: SparkSession, name: str, tables: dict[str, DataFrame], out_path: str,
                fmt: str = "parquet", ordered: bool = False, hot_key_threshold: int | str | None = AUTO,
                timeout_s: float | None = None, log_path: str | None = None, **params) -> ExtractRun:
    """Run one extract into ``out_path`` and report status and row count.

    The count is taken by an ``Observation`` during the write, so the data
    is scanned once. A re-run overwrites its own output folder. With
    ``timeout_s`` the run's jobs are tagged and cancelled when the time is
    up; the run is then reported as failed with a timeout message. With
    ``log_path`` the run's record is kept there, failed runs included.
    """
    started, run_id = _dt.datetime.now(), uuid.uuid4().hex[:12]
    with _Limited(spark, timeout_s) as limit:
        try:
            df = build_extract(name, tables, ordered=ordered, hot_key_threshold=hot_key_threshold, **params)
            rows = _write_counted(df, out_path, fmt, name)
            run = ExtractRun(name, "success", rows, out_path, None, started, _dt.datetime.now(), run_id)
        except Exception as e:  # reported, not raised: mirrors a job record
            run = ExtractRun(name, "failed", 0, None, limit.message(e), started, _dt.datetime.now(), run_id)
    return _kept(spark, run, log_path)


# ------------------------------------------------------------ resumable runs

def _place(df: DataFrame, column: str) -> F.Column:
    """The bound column as an integer: numbers as they are, times in microseconds (whatever the session's zone), dates in days."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.to_timestamp(F.concat(c.cast("string"), F.lit("Z"))))
    if isinstance(kind, TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, IntegralType):
        return c.cast("bigint")
    raise ValueError(f"{column} of type {kind.simpleString()} can't be cut into ranges")


def _at(df: DataFrame, column: str, place: int) -> F.Column:
    """The value of the bound column at an integer place."""
    kind = df.schema[column].dataType
    if isinstance(kind, TimestampNTZType):
        return _ts(_dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=place))
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(place))
    return F.date_from_unix_date(F.lit(place).cast("int")) if isinstance(kind, DateType) else F.lit(place)


def _chunk_plan(spark: SparkSession, d: ExtractDef, driving: DataFrame, folder: str, chunks: int, params: dict) -> list[int]:
    """The places that part a run's chunks, made once and kept: a rerun finds the same ones, however the table has grown."""
    texts = {k: str(v) for k, v in params.items()}
    if not storage.files(spark, folder):
        place = _place(driving, d.bound)
        lo, hi = driving.agg(F.min(place), F.max(place)).first()
        cuts = [] if lo is None else sorted({lo + (hi - lo + 1) * i // chunks for i in range(1, chunks)} - {lo})
        storage.publish(spark, f"{folder}/plan.json", json.dumps({"extract": d.name, "params": texts, "cuts": cuts}))
    plan = json.loads(spark.read.text(f"{folder}/plan.json", wholetext=True).first()[0])
    if (plan["extract"], plan["params"]) != (d.name, texts):
        raise ValueError(f"{folder} holds another run: {plan['extract']} with {plan['params']}")
    return plan["cuts"]


def committed_chunks(spark: SparkSession, out_path: str) -> dict[int, dict]:
    """Chunk number -> its commit record (folder, rows, run)."""
    marks = [p for p, _ in storage.files(spark, f"{out_path}/commits")]
    if not marks:
        return {}
    rows = spark.read.schema("chunk int, folder string, rows bigint, run_id string").json(marks).collect()  # one per chunk
    return {r["chunk"]: r.asDict() for r in rows}


def run_extract_resumable(spark: SparkSession, name: str, tables: dict[str, DataFrame], out_path: str, chunks: int = 16,
                          fmt: str = "parquet", hot_key_threshold: int | str | None = AUTO, timeout_s: float | None = None,
                          log_path: str | None = None, stop_after: int | None = None, **params) -> ExtractRun:
    """Run an extract in ``chunks`` ranges of its bound column, each committed on its own.

    The ranges are planned once per output folder and cover everything that the
    parameters select (the first and last are open). A chunk's rows are written
    to a folder of the attempt, then its commit record is published under the
    chunk's number; a run after a failure, a timeout or a lost driver makes
    only the chunks without a record. Of two runs at once, one commits a chunk
    and the other's copy is ignored. ``read_extract`` reads the committed
    folders. The reported rows are those of all committed chunks. A run that
    is to make no more than ``stop_after`` chunks (a time window, say) ends as
    ``partial`` while others are left.
    """
    started, run_id = _dt.datetime.now(), uuid.uuid4().hex[:12]
    made, total = 0, None
    with _Limited(spark, timeout_s) as limit:
        try:
            d = EXTRACTS[name]
            if d.text is not None:
                raise ValueError(f"{name} is a user's statement: it has no bound column to cut it by")
            driving = tables[d.entities[0]]
            params = _checked(d, params)
            wanted = _declared_range(driving, d, [params[p] for p in d.params])
            cuts = [_at(driving, d.bound, c) for c in _chunk_plan(spark, d, wanted, f"{out_path}/plan", chunks, params)]
            total = len(cuts) + 1
            done = committed_chunks(spark, out_path)
            for i in range(total):
                if i in done or (stop_after is not None and made >= stop_after):
                    continue
                mine = driving
                if i > 0:
                    mine = mine.where(F.col(d.bound) >= cuts[i - 1])
                if i < len(cuts):
                    mine = mine.where(F.col(d.bound) < cuts[i])
                folder = f"{out_path}/chunks/{i:06d}-{run_id}"
                rows = _write_counted(build_extract(name, {**tables, d.entities[0]: mine}, False, hot_key_threshold, **params), folder, fmt, name)
                record = {"chunk": i, "folder": folder, "rows": rows, "run_id": run_id}
                if storage.publish(spark, f"{out_path}/commits/{i:06d}.json", json.dumps(record)):
                    made += 1
            done = committed_chunks(spark, out_path)
            rows, status = sum(r["rows"] for r in done.values()), "success" if len(done) == total else "partial"
            run = ExtractRun(name, status, rows, out_path, None, started, _dt.datetime.now(), run_id, total, made)
        except Exception as e:  # reported, not raised
            run = ExtractRun(name, "failed", 0, None, limit.message(e), started, _dt.datetime.now(), run_id, total, made)
    return _kept(spark, run, log_path)


def read_extract(spark: SparkSession, out_path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of a resumable run: those of its committed chunks."""
    folders = [r["folder"] for _, r in sorted(committed_chunks(spark, out_path).items())]
    if not folders:
        raise ValueError(f"no chunk of {out_path} is committed")
    return spark.read.format(fmt).load(folders)
