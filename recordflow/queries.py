"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the test tables.

Each query reads whole tables (through the entity adapters) and returns a
result whose columns are aliased exactly as in the matching oracle SQL
(``recordflow.oracle``).
"""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import entities as EN
from .functions import columns as C
from .functions import fhir as FH
from .operators import differences as D
from .operators import quality as Q
from .operators import reconcile as R
from .operators import scorecard as SC
from .operators.ordinals import with_ordinal
from .plans import extracts as X
from .plans import incremental as INC
from .plans import sql_extract as SQ
from .session import run_dir
from .sources import recon_fixtures as RF
from .sources import sinks as SK
from .sources import testdata as td
from .sources.entity_source import read_entity
from .streaming import incremental_stream as ST

# Parameters of the registered extracts. They span the whole test tables, so
# every registered query processes all rows; narrow windows are unit-tested.
FULL_START = "1900-01-01"
FULL_END = "2100-01-01"
FULL_MIN_ID = 0


def _t(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return td.entities(spark, sf_dir, list(names))


def q_extract_orders(spark, sf_dir):
    return X.build_extract("extract_orders_psd", _t(spark, sf_dir, "ORDER_PROC", "SPECIMEN"),
                           start_date=FULL_START, end_date=FULL_END)


def q_extract_respiratory(spark, sf_dir):
    return X.build_extract("extract_respiratory_results", _t(spark, sf_dir, "RESPIRATORY"),
                           start_date=FULL_START, end_date=FULL_END)


def q_extract_org(spark, sf_dir):
    return X.build_extract("extract_organizational_hierarchy",
                           _t(spark, sf_dir, "CLARITY_SER", "CLARITY_DEP", "CLARITY_EMP"),
                           start_ser_id=FULL_MIN_ID)


def q_extract_visits(spark, sf_dir):
    return X.build_extract("extract_visit_encounters",
                           _t(spark, sf_dir, "PATIENT_VISIT", "ORDER_REC", "ORDER_MISC"),
                           start_date=FULL_START, end_date=FULL_END)


def q_extract_patients(spark, sf_dir):
    return X.build_extract("extract_patient_demographics",
                           _t(spark, sf_dir, "PATIENT", "PATIENT_ALLERGY", "PATIENT_DIAGNOSIS"),
                           start_patient_id=FULL_MIN_ID)


def q_extract_orders_sql(spark, sf_dir):
    """The orders extract as SQL text with named parameter markers."""
    SQ.register_entities(_t(spark, sf_dir, "ORDER_PROC", "SPECIMEN"))
    return SQ.run_sql(spark, SQ.ORDERS_WITH_SPECIMENS_SQL, start_date=FULL_START, end_date=FULL_END)


# Star join with hot-key salting: keys with more than this many rows on a
# joined side take the salted path (see operators.joins).
HOT_KEY_THRESHOLD = 12


def q_extract_patients_salted(spark, sf_dir):
    return X.build_extract("extract_patient_demographics",
                           _t(spark, sf_dir, "PATIENT", "PATIENT_ALLERGY", "PATIENT_DIAGNOSIS"),
                           start_patient_id=FULL_MIN_ID, hot_key_threshold=HOT_KEY_THRESHOLD)


def q_extract_billing(spark, sf_dir):
    return X.build_extract("extract_billing_accounts", _t(spark, sf_dir, "ACCOUNT", "PB_AR", "GB_PAYMENT"),
                           start_date=FULL_START, end_date=FULL_END)


def _window(name):
    def q(spark, sf_dir):
        return X.build_extract(name, _t(spark, sf_dir, *X.EXTRACTS[name].entities), **td.EXTRACT_WINDOWS[name])

    return q


# Whole-table parameters of each named extract, keyed by extract name.
EXTRACT_PARAMS = {
    "extract_orders_psd": dict(start_date=FULL_START, end_date=FULL_END),
    "extract_respiratory_results": dict(start_date=FULL_START, end_date=FULL_END),
    "extract_organizational_hierarchy": dict(start_ser_id=FULL_MIN_ID),
    "extract_visit_encounters": dict(start_date=FULL_START, end_date=FULL_END),
    "extract_patient_demographics": dict(start_patient_id=FULL_MIN_ID),
    "extract_billing_accounts": dict(start_date=FULL_START, end_date=FULL_END),
}


def q_run_extracts(spark, sf_dir):
    """Run every named extract into the shared folder; status and row count
    per run (counted by an Observation during the write)."""
    base = run_dir(spark, "extracts")

    def one(item):
        name, params = item
        d = X.EXTRACTS[name]
        r = X.run_extract(spark, name, _t(spark, sf_dir, *d.entities), f"{base}/{name}", **params)
        return (name, d.schema, r.status, r.rows)

    # The runs are independent jobs; submitting them from driver threads lets
    # the scheduler overlap them.
    with ThreadPoolExecutor(max_workers=len(EXTRACT_PARAMS)) as pool:
        recs = list(pool.map(one, EXTRACT_PARAMS.items()))
    return spark.createDataFrame(recs, "extract_name string, schema_group string, status string, row_count bigint")


def q_extract_order(spark, sf_dir):
    """Three extracts as written in their sort order: each row's position in the files, and its ids."""
    base, parts = run_dir(spark, "ordered"), []
    for name in ("extract_orders_psd", "extract_organizational_hierarchy", "extract_patient_demographics"):
        d = X.EXTRACTS[name]
        X.run_extract(spark, name, _t(spark, sf_dir, *d.entities), f"{base}/{name}", ordered=True, **EXTRACT_PARAMS[name])
        rows = spark.read.parquet(f"{base}/{name}")
        part = F.regexp_extract(F.col("_metadata.file_name"), "^part-([0-9]+)", 1).cast("long")
        ids = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in d.sort if c.endswith("_ID")])
        placed = with_ordinal(rows.select(part.alias("part"), F.col("_metadata.row_index").alias("at"), ids.alias("ids")), ["part", "at"], "position")
        parts.append(placed.select(F.lit(name).alias("extract_name"), "position", "ids"))
    return _union(parts)


RESUME_CHUNKS, RESUME_STOP = 4, 2


def _resumed(spark, sf_dir):
    """The orders extract in chunks: a first run stopped between them, and a second that makes the rest."""
    base = run_dir(spark, "resume")
    t = _t(spark, sf_dir, "ORDER_PROC", "SPECIMEN")
    for stop in (RESUME_STOP, None):
        X.run_extract_resumable(spark, "extract_orders_psd", t, f"{base}/orders", chunks=RESUME_CHUNKS, stop_after=stop,
                                log_path=f"{base}/log", **EXTRACT_PARAMS["extract_orders_psd"])
    return base


def q_extract_resume(spark, sf_dir):
    return X.read_extract(spark, f"{_resumed(spark, sf_dir)}/orders")


def q_extract_runs(spark, sf_dir):
    """The kept records of extract runs: a stopped run, the one that finished it, a plain run and a failed one."""
    base = _resumed(spark, sf_dir)
    t = _t(spark, sf_dir, "RESPIRATORY")
    X.run_extract(spark, "extract_respiratory_results", t, f"{base}/plain", log_path=f"{base}/log", **EXTRACT_PARAMS["extract_respiratory_results"])
    X.run_extract(spark, "extract_respiratory_results", t, f"{base}/bad", log_path=f"{base}/log", start_date=FULL_START)
    return X.extract_runs(spark, f"{base}/log").select(
        "name", "status", "rows", "chunks", "chunks_made", F.col("path").isNotNull().alias("published"), F.col("error").isNotNull().alias("has_error"),
        (F.col("completed_ts") >= F.col("started_ts")).alias("timed"))


def q_billing_totals(spark, sf_dir):
    return X.billing_totals(_t(spark, sf_dir, "ACCOUNT", "PB_AR", "GB_PAYMENT"), FULL_START, FULL_END)


# ----------------------------------------------------------------- quality

# A batch that lacks a required column: ORDER_PROC reduced to its two ids.
PARTIAL_BATCH = ("ORDER_PROC/ids_only", "ORDER_PROC", ["ORDER_ID", "PATIENT_ID"])


def _batches(spark, sf_dir):
    t = td.entities(spark, sf_dir)
    out = [(n, n, df) for n, df in t.items()]
    label, ent, cols = PARTIAL_BATCH
    out.append((label, ent, t[ent].select(*cols)))
    return out


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_validate_schema(spark, sf_dir):
    rows = []
    for label, ent, df in _batches(spark, sf_dir):
        missing = Q.missing_required(df, ent)
        n = Q.profile(df, [])
        rows.append(n.select(
            F.lit(label).alias("entity_name"),
            ((F.col("rows") == 0) | F.lit(not missing)).alias("passed"),
            F.col("rows").cast("bigint").alias("rows_checked"),
            F.when(F.col("rows") > 0, F.lit(len(missing))).otherwise(F.lit(0)).cast("bigint").alias("issues_found"),
            F.lit(",".join(missing)).alias("missing_fields")))
    return _union(rows)


def q_validate_nulls(spark, sf_dir):
    return _union([Q.validate_nulls(df, ent, label=label) for label, ent, df in _batches(spark, sf_dir)])


def q_validate_duplicates(spark, sf_dir):
    rows = []
    for n, df in td.entities(spark, sf_dir).items():
        k = EN.key_for(n)
        rows.append(Q.duplicate_profile(df, k).select(
            F.lit(n).alias("entity_name"), F.lit(k).alias("key_field"), "surplus_rows", "duplicate_keys",
            (F.col("duplicate_keys") == 0).alias("passed")))
    return _union(rows)


def q_validate_all(spark, sf_dir):
    return _union([Q.validate_all(df, ent, label=label).summary for label, ent, df in _batches(spark, sf_dir)])


def q_validate_all_issues(spark, sf_dir):
    return _union([Q.validate_all(df, ent, label=label).issues for label, ent, df in _batches(spark, sf_dir)])


def q_validate_referential(spark, sf_dir):
    return Q.validate_referential(td.entities(spark, sf_dir))


def q_validate_rules(spark, sf_dir):
    return Q.validate_rules(_t(spark, sf_dir, "RESPIRATORY"), Q.RESPIRATORY_RULES)


# Range texts in every supported form and some unreadable ones, dealt to the results by id.
RANGE_FORMS = ["0-100", "<50", "<=50", ">10", ">=10", "-5-10", "-5--1", " 1.5 - 200 ", ".5 - 1", "1e1-2e2", "(1-150)", "+1-50",
               "see note", None, "10", ""]


def with_range_forms(df: DataFrame) -> DataFrame:
    """RESPIRATORY with a range text of every form, and some missing values."""
    form = F.lit(None).cast("string")
    for i, text in enumerate(RANGE_FORMS):
        form = F.when(F.col("RESULT_ID") % len(RANGE_FORMS) == i, F.lit(text)).otherwise(form)
    return df.withColumn("NORMAL_RANGE", form).withColumn("VALUE", F.when(F.col("RESULT_ID") % 50 != 0, F.col("VALUE")))


def q_quarantine_rows(spark, sf_dir):
    """RESPIRATORY split into clean and quarantined rows, each with the rules that it breaks."""
    df = with_range_forms(_t(spark, sf_dir, "RESPIRATORY")["RESPIRATORY"])
    out = Q.split_by_rules(df, [*Q.RESPIRATORY_RULES, Q.UNREADABLE_RANGE], run_dir(spark, "quarantine"))
    bad = out.quarantined.select("RESULT_ID", F.lit(Q.QUARANTINED).alias("outcome"), F.concat_ws(",", "broken_rules").alias("broken_rules"))
    return bad.unionByName(out.clean.select("RESULT_ID", F.lit(Q.CLEAN).alias("outcome"), F.lit("").alias("broken_rules")))


# ---------------------------------------------------------- reconciliation

def _recon(spark, sf_dir):
    """The source projection of orders against the five perturbed targets."""
    src = RF.source(spark, sf_dir)
    pairs = [(n, src, t) for n, t in RF.targets(src).items()]
    return R.reconcile(pairs, key="ORDER_ID")


def q_recon_row_counts(spark, sf_dir):
    return _recon(spark, sf_dir).report.select(
        "entity_name", "source_count", "target_count", "difference", "row_count_match")


def q_recon_checksum(spark, sf_dir):
    return _recon(spark, sf_dir).report.select(
        "entity_name", "source_checksum", "target_checksum", "checksum_match")


def q_recon_checksum_ordered(spark, sf_dir):
    """Order-sensitive checksums of the source and the five targets, from one
    distributed sort over all six tables."""
    src = RF.source(spark, sf_dir)
    fps = R.ordered_fingerprints({"SOURCE": src, **RF.targets(src)}, ["ORDER_ID"])
    # ``fps`` has one row per table (six rows): a window over them hands the
    # source fingerprint to every target row without a join.
    src_fp = F.max(F.when(F.col("side") == "SOURCE", F.col("fingerprint"))).over(Window.partitionBy())
    return (fps.withColumn("source_checksum", src_fp).where(F.col("side") != "SOURCE")
               .select(F.col("side").alias("entity_name"), "source_checksum",
                       F.col("fingerprint").alias("target_checksum"),
                       (F.col("source_checksum") == F.col("fingerprint")).alias("checksum_match")))


def q_recon_nulls(spark, sf_dir):
    return _recon(spark, sf_dir).null_counts


def q_recon_duplicates(spark, sf_dir):
    return _recon(spark, sf_dir).report.select(
        "entity_name", "key_field", "source_duplicates", "target_duplicates", "duplicates_match")


def q_recon_report(spark, sf_dir):
    return _recon(spark, sf_dir).report.select(
        "entity_name", "overall_match", "issues_found", "row_count_match", "checksum_match",
        "null_checks_match", "duplicates_match")


RECON_ENTITY_COLS = ["entity_name", "source_count", "target_count", "source_checksum", "target_checksum",
                     "source_duplicates", "overall_match", "issues_found"]


def q_recon_entities(spark, sf_dir):
    """Migrate every entity (Parquet copy in the shared folder, read back)
    and reconcile source against target with the entity's explicit key. Each
    source is read once: its profile is taken while it is written.

    Entities are independent: each one's landing and reconciliation run as
    its own jobs from a driver thread, and each returns its one-row report.
    """
    base = run_dir(spark, "migrated")
    t = td.entities(spark, sf_dir)

    def one(item):
        name, src = item
        rep = R.reconcile_landing(name, src, f"{base}/{name}").report
        return tuple(rep.select(*RECON_ENTITY_COLS).first())

    with ThreadPoolExecutor(max_workers=8) as pool:
        rows = list(pool.map(one, t.items()))
    return spark.createDataFrame(rows, "entity_name string, source_count bigint, target_count bigint, "
                                       "source_checksum string, target_checksum string, source_duplicates bigint, "
                                       "overall_match boolean, issues_found bigint")


def q_recon_row_diff(spark, sf_dir):
    o = td.read_table(spark, sf_dir, "orders")
    t = RF.perturb(o.withColumnRenamed("o_orderkey", "ORDER_ID"), "T_LOSSY", "ORDER_ID",
                   "o_orderstatus", "X").withColumnRenamed("ORDER_ID", "o_orderkey")
    return R.row_diff(o, t, "o_orderkey")


# How some landings change what they store; the others keep it as it is.
LANDINGS = {
    "ORDER_PROC": None,
    "RESPIRATORY": lambda df: df.withColumn("VALUE", F.floor("VALUE").cast("double")),
    "ACCOUNT": lambda df: df.withColumn("BALANCE_AMT", F.col("BALANCE_AMT").cast("decimal(18,1)")),
    "SPECIMEN": lambda df: df.where("SPECIMEN_ID % 97 <> 0"),
    "GB_PAYMENT": lambda df: df.unionByName(df.where("PAYMENT_ID % 50 = 0")),
}


def q_recon_landing(spark, sf_dir):
    """Landings that keep, convert, lose and repeat rows, reconciled as they are written."""
    base = run_dir(spark, "landed")
    cols = [*RECON_ENTITY_COLS[:6], "target_duplicates", *RECON_ENTITY_COLS[6:]]

    def one(item):
        name, src = item
        return tuple(R.reconcile_landing(name, src, f"{base}/{name}", convert=LANDINGS[name]).report.select(*cols).first())

    with ThreadPoolExecutor(max_workers=len(LANDINGS)) as pool:
        rows = list(pool.map(one, _t(spark, sf_dir, *LANDINGS).items()))
    return spark.createDataFrame(rows, "entity_name string, source_count bigint, target_count bigint, source_checksum string, "
                                       "target_checksum string, source_duplicates bigint, target_duplicates bigint, "
                                       "overall_match boolean, issues_found bigint")


def _diff_tables(spark, sf_dir):
    """Orders with repeated keys, against a copy with changed, nulled, lost, added and repeated rows."""
    o = td.read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    t = RF.perturb(o.withColumnRenamed("o_orderkey", "ORDER_ID"), "T_LOSSY", "ORDER_ID", "o_orderstatus", "X").withColumnRenamed("ORDER_ID", "o_orderkey")
    t = t.withColumn("o_totalprice", F.when(key % 89 != 0, F.col("o_totalprice")))
    t = t.unionByName(t.where(key % 303 == 0).withColumn("o_custkey", F.col("o_custkey") + 1))
    return o.unionByName(o.where(key % 250 == 0)), t


def q_recon_column_diff(spark, sf_dir):
    return D.column_diff(*_diff_tables(spark, sf_dir), "o_orderkey")


def q_recon_column_counts(spark, sf_dir):
    return D.column_diff_counts(D.column_diff(*_diff_tables(spark, sf_dir), "o_orderkey"))


LEAF_WIDTH = 64


def q_recon_digest_tree(spark, sf_dir):
    """The differing key ranges of the five targets, found level by level; the targets' trees are independent jobs."""
    src = RF.source(spark, sf_dir)

    def one(item):
        name, tgt = item
        return D.digest_tree(src, tgt, "ORDER_ID", LEAF_WIDTH).select(F.lit(name).alias("entity_name"), "*")

    with ThreadPoolExecutor(max_workers=len(RF.TARGETS)) as pool:
        return _union(list(pool.map(one, RF.targets(src).items())))


def q_recon_precision(spark, sf_dir):
    """RESPIRATORY against targets that differ by little: an equal one, and one
    whose values between 1 and 50 lie a few units of the last place off."""
    src = _t(spark, sf_dir, "RESPIRATORY")["RESPIRATORY"]
    off = F.when((F.col("VALUE") > 1) & (F.col("VALUE") < 50), F.col("VALUE") + F.lit(1e-10)).otherwise(F.col("VALUE"))
    rec = R.reconcile([("EQUAL", src, src), ("OFF_BY_1E-10", src, src.withColumn("VALUE", off))], key="RESULT_ID")
    return rec.report.select("entity_name", "source_count", "target_count", "checksum_match", "overall_match")


def q_scorecard_entity(spark, sf_dir):
    return SC.score_entities(_recon(spark, sf_dir).report)


def q_scorecard_overall(spark, sf_dir):
    return SC.scorecard(SC.score_entities(_recon(spark, sf_dir).report))


# ------------------------------------------------------------------ exports

# Fixed run time and run id, so message ids and bundle ids are reproducible.
RUN_TS = "2024-01-01 00:00:00"
RUN_ID = "rf-run"
BUNDLE_PAGE = 100


def q_export_csv_lines(spark, sf_dir):
    return SK.csv_lines(_t(spark, sf_dir, "PATIENT_ALLERGY")["PATIENT_ALLERGY"])


def q_export_csv_orders(spark, sf_dir):
    return SK.csv_lines(_t(spark, sf_dir, "ORDER_PROC")["ORDER_PROC"])


def hl7_input(t):
    o = t["ORDER_PROC"].select("ORDER_ID", "ORDER_STATUS_CD", "PATIENT_ID")
    p = t["PATIENT"].select("PATIENT_ID", "LAST_NAME", "FIRST_NAME", "DOB", "SEX_CD")
    return o.join(p, "PATIENT_ID", "left")


def q_export_hl7(spark, sf_dir):
    df = hl7_input(_t(spark, sf_dir, "ORDER_PROC", "PATIENT"))
    return SK.hl7_messages(df, RUN_TS, RUN_ID, order_by=["ORDER_ID"])


def _res(spark, sf_dir, ent, rtype):
    df = _t(spark, sf_dir, ent)[ent]
    return SK.fhir_resources(df, rtype)


def q_fhir_patient(spark, sf_dir):
    return _res(spark, sf_dir, "PATIENT", "Patient")


def q_fhir_encounter(spark, sf_dir):
    return _res(spark, sf_dir, "PATIENT_VISIT", "Encounter")


def q_fhir_observation(spark, sf_dir):
    return _res(spark, sf_dir, "RESPIRATORY", "Observation")


def q_fhir_passthrough(spark, sf_dir):
    return _res(spark, sf_dir, "ACCOUNT", "Account")


def q_export_fhir_bundle(spark, sf_dir):
    df = _t(spark, sf_dir, "PATIENT")["PATIENT"]
    return SK.fhir_bundles(df, "Patient", BUNDLE_PAGE, RUN_TS, RUN_ID, order_by=["PATIENT_ID"])


def q_export_csv_files(spark, sf_dir):
    """CSV files of results (doubles) and accounts (decimals): header and data lines as read back."""
    base = run_dir(spark, "csv_files")
    parts = []
    for name, df in _t(spark, sf_dir, "RESPIRATORY", "ACCOUNT").items():
        files = SK.export(df, "csv", f"{base}/{name}").files
        parts += [spark.read.option("lineSep", SK.CSV_LINE_SEP).text(files[part]).select(
            F.lit(name).alias("entity_name"), F.lit(part).alias("part"), F.col("value").alias("line"))
            for part in ("header", "data")]
    return _union(parts)


def q_export_hl7_files(spark, sf_dir):
    """HL7 files: the segments as read back, without the empty ones between messages."""
    path = run_dir(spark, "hl7_files")
    SK.export(hl7_input(_t(spark, sf_dir, "ORDER_PROC", "PATIENT")), "hl7", path,
              run_ts=RUN_TS, run_id=RUN_ID, order_by=["ORDER_ID"])
    return (spark.read.option("lineSep", SK.H7.SEGMENT_SEP).text(path)
            .where("value <> ''").select(F.col("value").alias("segment")))


def q_export_fhir_files(spark, sf_dir):
    """FHIR bundle files: one bundle per line, as read back."""
    path = run_dir(spark, "fhir_files")
    SK.export(_t(spark, sf_dir, "PATIENT")["PATIENT"], "fhir", path, resource_type="Patient", page_size=BUNDLE_PAGE,
              run_ts=RUN_TS, run_id=RUN_ID, order_by=["PATIENT_ID"])
    return spark.read.text(path).select(F.col("value").alias("bundle"))


def numbered_lines(spark, path: str, sep: str) -> DataFrame:
    """(line_no, line) of one file, numbered in the order of the file."""
    t = spark.read.option("lineSep", sep).text(path).select("value", F.col("_metadata.file_block_start").alias("start"),
                                                            F.monotonically_increasing_id().alias("at"))
    return with_ordinal(t, ["start", "at"], "line_no").select("line_no", F.col("value").alias("line"))


def q_export_csv_single(spark, sf_dir):
    """ACCOUNT as one ordered CSV file, and an empty batch as an empty one; the lines as read back."""
    base, t = run_dir(spark, "csv_single"), _t(spark, sf_dir, "ACCOUNT")["ACCOUNT"]
    parts = []
    for label, df in (("ACCOUNT", t), ("ACCOUNT/empty", t.where("false"))):
        path = f"{base}/{label.replace('/', '_')}.csv"
        SK.export(df, "csv_file", path, order_by=["ACCOUNT_ID"])
        parts.append(numbered_lines(spark, path, SK.CSV_LINE_SEP).select(F.lit(label).alias("entity_name"), "*"))
    return _union(parts)


def q_export_fhir_single(spark, sf_dir):
    """All patients as one bundle file; its lines as read back."""
    path = f"{run_dir(spark, 'fhir_single')}/patients.json"
    SK.export(_t(spark, sf_dir, "PATIENT")["PATIENT"], "fhir_file", path, resource_type="Patient", run_ts=RUN_TS, run_id=RUN_ID,
              order_by=["PATIENT_ID"])
    return numbered_lines(spark, path, "\n")


def q_scalar_functions(spark, sf_dir):
    p = _t(spark, sf_dir, "PATIENT")["PATIENT"]
    idt = F.col("PATIENT_ID").cast("string")
    row_json = F.to_json(F.struct(*sorted(p.columns)), FH.JSON_OPTS)
    pct = (F.col("PATIENT_ID") % 5).cast("double") * F.lit(25.0)
    dob_ts = F.col("DOB").cast("timestamp_ntz")
    return p.select(
        "PATIENT_ID",
        idt.alias("id_text"),
        C.gender(F.col("SEX_CD")).alias("gender"),
        F.concat(F.coalesce("LAST_NAME", F.lit("")), F.lit("^"), F.coalesce("FIRST_NAME", F.lit(""))).alias("name_hl7"),
        F.concat(F.lit("Patient/"), idt).alias("subject_ref"),
        C.hl7_ts(dob_ts).alias("dob_hl7"),
        C.iso_ts(dob_ts).alias("dob_iso"),
        C.message_id(idt).alias("msg_id"),
        row_json.alias("row_json"),
        F.md5(row_json).alias("row_md5"),
        C.band(pct).alias("band"),
        F.format_string("%d null values found in '%s'", F.col("PATIENT_ID") % 7, F.lit("SEX_CD")).alias("message"))


# -------------------------------------------------------------- incremental


def q_incremental_extract(spark, sf_dir):
    """First run against an empty ledger: the position is the first-run bound."""
    led = INC.PositionLedger(spark, run_dir(spark, "ledger"))
    pos = led.get("ORDER_PROC")
    return INC.incremental_batch(_t(spark, sf_dir, "ORDER_PROC")["ORDER_PROC"], pos, "UPDATE_DT_TM")


def q_incremental_extract_by_date(spark, sf_dir):
    """First run over ORDER_PROC laid out by change date (partition-pruned scan)."""
    base = run_dir(spark, "by_change_date")
    INC.write_by_change_date(_t(spark, sf_dir, "ORDER_PROC")["ORDER_PROC"], base, "UPDATE_DT_TM", mode="overwrite")
    led = INC.PositionLedger(spark, run_dir(spark, "ledger"))
    return INC.incremental_batch(spark.read.parquet(base), led.get("ORDER_PROC"), "UPDATE_DT_TM", "change_date")


STORED_POSITION = "2001-01-01 00:00:00"


def q_incremental_from_position(spark, sf_dir):
    """A pull from a stored position: only rows that changed after it."""
    pos = datetime.datetime.fromisoformat(STORED_POSITION)
    return INC.incremental_batch(_t(spark, sf_dir, "ORDER_PROC")["ORDER_PROC"], pos, "UPDATE_DT_TM")


PERIOD_POSITION = "2000-06-15 10:00:00"


def q_incremental_by_period(spark, sf_dir):
    """The same pull over layouts by day, month and year: each gives the same rows."""
    pos = datetime.datetime.fromisoformat(PERIOD_POSITION)
    src, parts = _t(spark, sf_dir, "ORDER_PROC")["ORDER_PROC"], []
    for layout in ("day", "month", "year"):
        path = run_dir(spark, f"by_{layout}")
        INC.write_by_change_date(src, path, "UPDATE_DT_TM", granularity=layout, mode="overwrite")
        batch = INC.incremental_batch(spark.read.parquet(path), pos, "UPDATE_DT_TM", "change_date")
        parts.append(batch.select(F.lit(layout).alias("layout"), "*"))
    return _union(parts)


def q_entity_scan(spark, sf_dir):
    """ORDER_PROC by a named-entity scan of its files."""
    return td.adapt(read_entity(spark, "ORDER_PROC", path=f"{sf_dir}/orders.parquet"), "ORDER_PROC")


def late_rows(src: DataFrame) -> DataFrame:
    """Rows that arrive after a first run: other rows of known keys and times, null keys, and exact repeats."""
    other = src.where("ORDER_ID % 20 = 0").withColumn("ORDER_STATUS_CD", F.lit("LATE"))
    no_key = src.where("ORDER_ID % 30 = 0").withColumn("ORDER_ID", F.lit(None).cast(src.schema["ORDER_ID"].dataType))
    return other.unionByName(no_key).unionByName(src.where("ORDER_ID % 70 = 0"))


def q_etl_overlap(spark, sf_dir):
    """A run over everything, then two with an overlap window over the table
    with late rows: each late row is exported once, by the second run."""
    base = run_dir(spark, "etl_overlap")
    src = _t(spark, sf_dir, "ORDER_PROC")["ORDER_PROC"]
    later, window = src.unionByName(late_rows(src)), datetime.timedelta(days=36500)
    runs = [INC.run_etl_job(spark, "ORDER_PROC", df, f"{base}/ledger", f"{base}/out", "csv", overlap=overlap)
            for df, overlap in ((src, None), (later, window), (later, window))]
    return _union([spark.read.parquet(f"{base}/out/ORDER_PROC/{r.job_id}/staged").select(
        F.lit(n).cast("bigint").alias("run_no"), "*") for n, r in enumerate(runs[1:], 2)])


# Entity, export format and options of the recorded runs; the last one fails.
RECORDED_RUNS = [
    ("ORDER_PROC", "hl7", dict(run_ts=RUN_TS, run_id=RUN_ID, order_by=["ORDER_ID"])),
    ("ACCOUNT", "csv", {}),
    ("PATIENT_VISIT", "fhir", dict(resource_type="Encounter", page_size=BUNDLE_PAGE, run_ts=RUN_TS, run_id=RUN_ID,
                                   order_by=["VISIT_ID"])),
    ("SPECIMEN", "xml", {}),
]


def _recorded_runs(spark, sf_dir):
    """Runs in all three formats and a failed one: the ledger and the job ids."""
    base = run_dir(spark, "recorded")
    led = INC.PositionLedger(spark, f"{base}/ledger")
    t = _t(spark, sf_dir, *[e for e, _, _ in RECORDED_RUNS])

    def one(item):
        ent, fmt, opts = item
        return INC.run_etl_job(spark, ent, t[ent], led.path, f"{base}/out", fmt,
                               change_col=td.CHANGE_COLUMNS[ent], **opts).job_id

    with ThreadPoolExecutor(max_workers=len(RECORDED_RUNS)) as pool:
        return led, list(pool.map(one, RECORDED_RUNS))


def q_run_history(spark, sf_dir):
    """The kept records of the runs."""
    led, _ = _recorded_runs(spark, sf_dir)
    return led.runs().select(
        "entity_name", "status", "export_format", "rows_extracted", "rows_exported", "validation_passed", "issues_found",
        "position_before", F.col("last_extract_ts").alias("position_after"),
        F.col("output_path").isNotNull().alias("published"), (F.col("completed_ts") >= F.col("started_ts")).alias("timed"))


def q_run_issues(spark, sf_dir):
    """The kept findings, looked up by job id."""
    led, ids = _recorded_runs(spark, sf_dir)
    return _union([led.issues(i) for i in ids]).select(*Q.ISSUE_COLS)


def q_watermark_ledger(spark, sf_dir):
    """Per entity: a full first run, a run with no new rows, and a failed run
    (unknown format); then the ledger's position listing."""
    base = run_dir(spark, "watermark")
    ledger = f"{base}/ledger"
    INC.PositionLedger(spark, ledger)
    t = td.entities(spark, sf_dir, list(td.CHANGE_COLUMNS))

    def runs(item):
        ent, col = item
        for fmt in ("csv", "csv", "xml"):
            INC.run_etl_job(spark, ent, t[ent], ledger, f"{base}/out", fmt, change_col=col)

    # Entities are independent: their runs are submitted as concurrent Spark
    # jobs from driver threads (each entity appends to its own ledger folder).
    with ThreadPoolExecutor(max_workers=len(td.CHANGE_COLUMNS)) as pool:
        list(pool.map(runs, td.CHANGE_COLUMNS.items()))
    return INC.PositionLedger(spark, ledger).positions()


def q_etl_job(spark, sf_dir):
    """Two end-to-end runs on ORDER_PROC: CSV export of everything, then an
    HL7 run that finds no new rows."""
    base = run_dir(spark, "etl_job")
    src = _t(spark, sf_dir, "ORDER_PROC")["ORDER_PROC"]
    r1 = INC.run_etl_job(spark, "ORDER_PROC", src, f"{base}/ledger", f"{base}/out", "csv")
    r2 = INC.run_etl_job(spark, "ORDER_PROC", src, f"{base}/ledger", f"{base}/out", "hl7",
                          run_ts=RUN_TS, run_id=RUN_ID, order_by=["ORDER_ID"])
    recs = INC.records_frame(spark, [r1, r2])
    return recs.select(
        F.when(F.col("job_id") == r1.job_id, 1).otherwise(2).cast("bigint").alias("run_no"),
        "entity_name", "status", "export_format", "rows_extracted", "rows_exported",
        "validation_passed", "issues_found", "position_before", "position_after")


def q_incremental_stream(spark, sf_dir):
    base = run_dir(spark, "stream")
    schema = td.read_table(spark, sf_dir, "orders").schema
    ST.run_incremental_stream(spark, sf_dir, schema, "ORDER_PROC", f"{base}/out", f"{base}/checkpoint",
                              transform=lambda s: td.adapt(s, "ORDER_PROC"), path_glob="orders.parquet",
                              export_format="csv")
    return ST.stream_output(spark, f"{base}/out")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "extract_orders": q_extract_orders,
    "extract_orders_sql": q_extract_orders_sql,
    "extract_respiratory": q_extract_respiratory,
    "extract_org": q_extract_org,
    "extract_visits": q_extract_visits,
    "extract_patients": q_extract_patients,
    "extract_patients_salted": q_extract_patients_salted,
    "extract_billing": q_extract_billing,
    "extract_orders_window": _window("extract_orders_psd"),
    "extract_respiratory_window": _window("extract_respiratory_results"),
    "extract_org_window": _window("extract_organizational_hierarchy"),
    "extract_visits_window": _window("extract_visit_encounters"),
    "extract_patients_window": _window("extract_patient_demographics"),
    "extract_billing_window": _window("extract_billing_accounts"),
    "billing_totals": q_billing_totals,
    "run_extracts": q_run_extracts,
    "extract_order": q_extract_order,
    "extract_resume": q_extract_resume,
    "extract_runs": q_extract_runs,
    "validate_schema": q_validate_schema,
    "validate_nulls": q_validate_nulls,
    "validate_duplicates": q_validate_duplicates,
    "validate_all": q_validate_all,
    "validate_all_issues": q_validate_all_issues,
    "validate_referential": q_validate_referential,
    "validate_rules": q_validate_rules,
    "recon_row_counts": q_recon_row_counts,
    "recon_checksum": q_recon_checksum,
    "recon_checksum_ordered": q_recon_checksum_ordered,
    "recon_nulls": q_recon_nulls,
    "recon_duplicates": q_recon_duplicates,
    "recon_report": q_recon_report,
    "recon_entities": q_recon_entities,
    "recon_precision": q_recon_precision,
    "recon_row_diff": q_recon_row_diff,
    "recon_landing": q_recon_landing,
    "recon_column_diff": q_recon_column_diff,
    "recon_column_counts": q_recon_column_counts,
    "recon_digest_tree": q_recon_digest_tree,
    "quarantine_rows": q_quarantine_rows,
    "scorecard_entity": q_scorecard_entity,
    "scorecard_overall": q_scorecard_overall,
    "export_csv_lines": q_export_csv_lines,
    "export_csv_orders": q_export_csv_orders,
    "export_hl7": q_export_hl7,
    "fhir_patient": q_fhir_patient,
    "fhir_encounter": q_fhir_encounter,
    "fhir_observation": q_fhir_observation,
    "fhir_passthrough": q_fhir_passthrough,
    "export_fhir_bundle": q_export_fhir_bundle,
    "export_csv_files": q_export_csv_files,
    "export_hl7_files": q_export_hl7_files,
    "export_fhir_files": q_export_fhir_files,
    "export_csv_single": q_export_csv_single,
    "export_fhir_single": q_export_fhir_single,
    "scalar_functions": q_scalar_functions,
    "incremental_extract": q_incremental_extract,
    "incremental_extract_by_date": q_incremental_extract_by_date,
    "incremental_from_position": q_incremental_from_position,
    "incremental_by_period": q_incremental_by_period,
    "entity_scan": q_entity_scan,
    "etl_overlap": q_etl_overlap,
    "run_history": q_run_history,
    "run_issues": q_run_issues,
    "watermark_ledger": q_watermark_ledger,
    "etl_job": q_etl_job,
    "incremental_stream": q_incremental_stream,
}
