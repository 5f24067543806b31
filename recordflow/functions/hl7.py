"""HL7 v2 message text as Column expressions (MSH + PID [+ ORC] per row)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import hl7_ts, message_id, plain_text

SEGMENT_SEP = "\r"

# Encoding characters, version, and sender and receiver of the
# header segment (unless the caller passes other ones).
ENCODING_CHARS = "^~\\&"
VERSION = "2.4"
DEFAULT_HEADER = {"sending_app": "EHR_SRC", "sending_facility": "SRC_FACILITY",
                  "receiving_app": "RECV_SYS", "receiving_facility": "DEST"}


def escape(c: Column) -> Column:
    """HL7 escapes for field text: \\ -> \\E\\, | -> \\F\\, ^ -> \\S\\, & -> \\T\\, ~ -> \\R\\."""
    for ch, rep in (("\\", "\\E\\"), ("|", "\\F\\"), ("^", "\\S\\"), ("&", "\\T\\"), ("~", "\\R\\")):
        c = F.replace(c, F.lit(ch), F.lit(rep))
    return c


def _lit_ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(str(v)).cast("timestamp_ntz")


def message(df: DataFrame, ordinal: Column, run_ts, run_id: str, msg_type: str = "ORU",
            header: dict | None = None, escape_fields: bool = False, id_length: int = 32) -> Column:
    """One message per row: ``MSH\\rPID\\r[ORC\\r]``.

    * ``ordinal`` is the 1-based position of the row in the batch (PID set id).
    * the ORC segment is present when the frame *has* an ``ORDER_ID`` column;
      its status defaults to ``NW`` only when ``ORDER_STATUS_CD`` is absent.
    * null or absent values print as empty fields.
    * message ids are ``MSG`` + ``id_length`` hex characters of md5(run id,
      position); 8 characters (the usual form) start to collide after tens
      of thousands of messages, so large runs should use up to 32.
    """
    h = {**DEFAULT_HEADER, **(header or {})}

    def txt(name):
        t = plain_text(df, name)
        return escape(t) if escape_fields else t

    mid = message_id(F.concat(F.lit(run_id + ":"), ordinal.cast("string")), id_length)
    msh = F.concat_ws("|", F.lit("MSH"), F.lit(ENCODING_CHARS), F.lit(h["sending_app"]),
                      F.lit(h["sending_facility"]), F.lit(h["receiving_app"]),
                      F.lit(h["receiving_facility"]), hl7_ts(_lit_ts(run_ts)), mid,
                      F.lit(msg_type), F.lit(VERSION))
    pid = F.concat_ws("|", F.lit("PID"), ordinal.cast("string"), txt("PATIENT_ID"), F.lit(""),
                      F.concat(txt("LAST_NAME"), F.lit("^"), txt("FIRST_NAME")), F.lit(""),
                      txt("DOB"), txt("SEX_CD"))
    segs = [msh, pid]
    if "ORDER_ID" in df.columns:
        status = txt("ORDER_STATUS_CD") if "ORDER_STATUS_CD" in df.columns else F.lit("NW")
        segs.append(F.concat_ws("|", F.lit("ORC"), status, txt("ORDER_ID")))
    return F.concat(F.concat_ws(SEGMENT_SEP, *segs), F.lit(SEGMENT_SEP))
