"""Export sinks: CSV, HL7 v2 and FHIR JSON as partitioned files.

Outputs are written by the executors in parallel (one file per partition);
nothing is gathered into one string on the driver. Record counts come from
an ``Observation`` on the write, so the data is scanned once.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions import fhir as FH
from ..functions import hl7 as H7
from ..functions.columns import iso_ts, plain_text
from ..operators.ordinals import with_ordinal
from . import artefact

CSV_LINE_SEP = "\r\n"
# Minimal quoting, doubled quotes, null and empty as nothing, no trimming.
CSV_OPTS = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": "",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "dateFormat": "yyyy-MM-dd"}


@dataclass
class ExportResult:
    format: str
    record_count: int
    path: str
    files: dict = field(default_factory=dict)


def _python_number(name: str) -> F.Column:
    """A double as Python prints it: plain from 1e-4 to 1e16, else with a two-digit exponent."""
    c = "CAST(`" + name.replace("`", "``") + "` AS DOUBLE)"
    text = f"CAST({c} AS STRING)"
    plain = f"regexp_replace(CAST(CAST({text} AS DECIMAL(38,21)) AS STRING), '0+$', '')"
    mantissa = f"regexp_replace(split_part({text}, 'E', 1), '[.]0$', '')"
    power = f"CAST(split_part({text}, 'E', 2) AS INT)"
    return F.expr(f"""CASE WHEN isnan({c}) THEN 'nan' WHEN abs({c}) = double('Infinity') THEN replace({text}, 'Infinity', 'inf')
        WHEN {c} = 0 THEN {text}
        WHEN abs({c}) >= 1e-4 AND abs({c}) < 1e16 THEN regexp_replace({plain}, '[.]$', '.0')
        ELSE concat({mantissa}, 'e', IF({power} < 0, '-', '+'), lpad(CAST(abs({power}) AS STRING), greatest(2, length(CAST(abs({power}) AS STRING))), '0')) END""")


def _for_text(df: DataFrame) -> DataFrame:
    """Values as text the way Python prints them: times with a fraction only
    when present, booleans as True / False, doubles in Python's notation."""
    def conv(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return plain_text(df, f.name).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):  # Python has one kind of float
            return _python_number(f.name).alias(f.name)
        if isinstance(f.dataType, T.BooleanType):
            return F.when(c, F.lit("True")).when(~c, F.lit("False")).alias(f.name)
        return c
    return df.select(*[conv(f) for f in df.schema.fields])


def csv_header(df: DataFrame) -> str:
    return ",".join(('"' + c.replace('"', '""') + '"') if any(x in c for x in ',"\r\n') else c
                    for c in df.columns)


def csv_lines(df: DataFrame) -> DataFrame:
    """One CSV record per row (no line terminator), in the exporter's dialect.

    A lone empty field is written as ``""``, so that its line isn't blank.
    """
    t = _for_text(df)
    line = F.to_csv(F.struct(*t.columns), CSV_OPTS)
    if len(t.columns) == 1:
        line = F.when(F.coalesce(F.col(t.columns[0]).cast("string"), F.lit("")) == "", F.lit('""')).otherwise(line)
    return t.select(line.alias("line"))


def _observed_write(df: DataFrame, path: str, line_sep: str, name: str) -> int:
    obs = Observation(f"{name}_{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite") \
      .option("lineSep", line_sep).text(path)
    return int(obs.get["n"])


def write_csv(df: DataFrame, path: str) -> ExportResult:
    """``path/data``: CRLF-terminated records; ``path/header``: the header line.

    An empty input writes no header (as the single-buffer exporter did) and
    removes one that an earlier run left.
    """
    spark = df.sparkSession
    n = _observed_write(csv_lines(df), f"{path}/data", CSV_LINE_SEP, "csv_rows")
    if n > 0:
        spark.createDataFrame([(csv_header(df),)], "line string").coalesce(1) \
             .write.mode("overwrite").option("lineSep", CSV_LINE_SEP).text(f"{path}/header")
    else:
        storage.delete(spark, f"{path}/header")
    return ExportResult("csv", n, path, {"data": f"{path}/data", "header": f"{path}/header"})


def _default_order(df: DataFrame, order_by):
    return list(order_by) if order_by else sorted(df.columns)


def hl7_messages(df: DataFrame, run_ts, run_id: str | None = None, msg_type: str = "ORU",
                 order_by: list[str] | None = None, header: dict | None = None,
                 escape_fields: bool = False, id_length: int = 32) -> DataFrame:
    """(ordinal, message) per row; ordinals follow ``order_by`` (a total order)."""
    run_id = run_id or uuid.uuid4().hex
    o = with_ordinal(df, _default_order(df, order_by))
    base = o.drop("ordinal")
    return o.select("ordinal", H7.message(base, F.col("ordinal"), run_ts, run_id, msg_type,
                                          header, escape_fields, id_length).alias("message"))


def write_hl7(df: DataFrame, path: str, run_ts=None, **kw) -> ExportResult:
    """Messages separated by an empty segment (CR): text sink with CR line ends."""
    run_ts = run_ts or _dt.datetime.now()
    m = hl7_messages(df, run_ts, **kw)
    n = _observed_write(m.select("message"), path, H7.SEGMENT_SEP, "hl7_rows")
    return ExportResult("hl7v2", n, path)


def fhir_resources(df: DataFrame, resource_type: str = "Patient", gender_codes: dict | None = None) -> DataFrame:
    return df.select(FH.resource_json(df, resource_type, gender_codes).alias("resource"))


def write_fhir_ndjson(df: DataFrame, path: str, resource_type: str = "Patient") -> ExportResult:
    n = _observed_write(fhir_resources(df, resource_type), path, "\n", "fhir_rows")
    return ExportResult("fhir_ndjson", n, path)


def bundle_id(run_id: str, bundle_no: Column) -> Column:
    """Deterministic UUID-shaped id from md5(run_id:bundle_no)."""
    h = F.md5(F.concat(F.lit(run_id + ":"), bundle_no.cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def fhir_bundles(df: DataFrame, resource_type: str = "Patient", page_size: int = 1000,
                 run_ts=None, run_id: str | None = None,
                 order_by: list[str] | None = None) -> DataFrame:
    """Collection bundles of at most ``page_size`` entries each.

    Rows are numbered in ``order_by`` order and cut into pages by
    position, so every ``collect_list`` group is bounded by the page size
    whatever the data volume or key skew. Entries keep their order.
    """
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    run_id = run_id or uuid.uuid4().hex
    run_ts = run_ts or _dt.datetime.now()
    ts = run_ts if isinstance(run_ts, Column) else F.lit(
        run_ts.isoformat(sep=" ") if isinstance(run_ts, _dt.datetime) else str(run_ts)).cast("timestamp_ntz")
    o = with_ordinal(df, _default_order(df, order_by))
    base = o.drop("ordinal")
    r = o.select(((F.col("ordinal") - 1) / F.lit(page_size)).cast("bigint").alias("bundle_no"),
                 "ordinal", FH.resource(base, resource_type).alias("resource"))
    g = r.groupBy("bundle_no").agg(
        F.count(F.lit(1)).alias("entries"),
        F.array_sort(F.collect_list(F.struct("ordinal", "resource"))).alias("items"))
    bundle = F.struct(
        F.lit("Bundle").alias("resourceType"), bundle_id(run_id, F.col("bundle_no")).alias("id"),
        F.lit("collection").alias("type"), iso_ts(ts).alias("timestamp"),
        F.transform("items", lambda x: F.struct(x["resource"].alias("resource"))).alias("entry"))
    return g.select("bundle_no", F.col("entries").cast("bigint").alias("entries"),
                    F.to_json(bundle, FH.JSON_OPTS).alias("bundle"))


def write_fhir_bundles(df: DataFrame, path: str, resource_type: str = "Patient",
                       page_size: int = 1000, **kw) -> ExportResult:
    b = fhir_bundles(df, resource_type, page_size, **kw)
    obs = Observation(f"fhir_bundles_{uuid.uuid4().hex}")
    b.observe(obs, F.coalesce(F.sum("entries"), F.lit(0)).alias("n")).select("bundle") \
     .write.mode("overwrite").option("lineSep", "\n").text(path)
    return ExportResult("fhir_r4", int(obs.get["n"]), path)


# ------------------------------------------------------------- one-file exports

def _ordered_parts(df: DataFrame, order_by: list[str] | None, lines, path: str, line_sep: str) -> int:
    """Write the lines as part files whose names follow the order; the number of rows."""
    ordered = df.orderBy(*[F.col(c).asc_nulls_last() for c in _default_order(df, order_by)])
    return _observed_write(lines(ordered), path, line_sep, "one_file")


def write_csv_file(df: DataFrame, path: str, order_by: list[str] | None = None) -> ExportResult:
    """One CSV file at ``path``: the header, then the records in order.

    Executors write ordered part files beside it, which are then put together
    by position (``artefact.assemble``); no task or driver passes over all
    rows. An empty input makes an empty file without a header.
    """
    parts = f"{path}.parts"
    n = _ordered_parts(df, order_by, csv_lines, parts, CSV_LINE_SEP)
    artefact.assemble(df.sparkSession, parts, path, head=csv_header(df) + CSV_LINE_SEP if n else "")
    return ExportResult("csv", n, path)


def write_fhir_bundle_file(df: DataFrame, path: str, resource_type: str = "Patient", run_ts=None, run_id: str | None = None,
                           order_by: list[str] | None = None) -> ExportResult:
    """One collection bundle as one JSON file at ``path``, one entry per line, in order.

    Made like ``write_csv_file``; an empty input makes a bundle without entries.
    """
    run_id, run_ts = run_id or uuid.uuid4().hex, run_ts or _dt.datetime.now()
    at = F.lit(run_ts.isoformat(sep=" ") if isinstance(run_ts, _dt.datetime) else str(run_ts)).cast("timestamp_ntz")
    name, stamp = df.sparkSession.range(1).select(bundle_id(run_id, F.lit(0)), iso_ts(at)).first()
    parts, sep = f"{path}.parts", ",\n"

    def entries(ordered):
        return ordered.select(F.concat(F.lit('{"resource":'), FH.resource_json(ordered, resource_type), F.lit("}")).alias("entry"))

    n = _ordered_parts(df, order_by, entries, parts, sep)
    head = f'{{"resourceType":"Bundle","id":"{name}","type":"collection","timestamp":"{stamp}","entry":[\n'
    artefact.assemble(df.sparkSession, parts, path, head=head, tail="\n]}\n" if n else "]}\n", drop_last=len(sep) if n else 0)
    return ExportResult("fhir_r4", n, path)


EXPORTERS = {"csv": write_csv, "hl7": write_hl7, "fhir": write_fhir_bundles,
             "csv_file": write_csv_file, "fhir_file": write_fhir_bundle_file}


def export(df: DataFrame, fmt: str, path: str, **kw) -> ExportResult:
    """Dispatch by format name; an unknown name is an error (no silent CSV)."""
    fn = EXPORTERS.get(fmt)
    if fn is None:
        raise ValueError(f"unknown export format {fmt!r}; known: {', '.join(EXPORTERS)}")
    return fn(df, path, **kw)
