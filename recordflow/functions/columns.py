"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def iso_ts(c: Column) -> Column:
    """ISO-8601 text, fraction only when the time has one (like isoformat)."""
    return F.when(F.date_format(c, "SSSSSS") == "000000",
                  F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")) \
            .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def hl7_ts(c: Column) -> Column:
    """HL7 time text YYYYMMDDHHMM."""
    return F.date_format(c, "yyyyMMddHHmm")


def plain_text(df: DataFrame, name: str) -> Column:
    """Value as plain text the way a Python ``str()`` renders it; '' if null/absent."""
    if name not in df.columns:
        return F.lit("")
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        t = F.when(F.date_format(c, "SSSSSS") == "000000",
                   F.date_format(c, "yyyy-MM-dd HH:mm:ss")) \
             .otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    else:
        t = c.cast("string")
    return F.coalesce(t, F.lit(""))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _escaped(text: str) -> str:
    """SQL: backslash and ``|`` escaped, null as backslash-N."""
    # SQL literals: '\\' is one backslash, '\\\\' two, '\\|' backslash-pipe, '\\N' the null mark.
    return f"coalesce(replace(replace({text}, '\\\\', '\\\\\\\\'), '|', '\\\\|'), '\\\\N')"


def _value_sql(c: str, dtype: T.DataType, depth: int = 0) -> str:
    """Text that differs for any two different values of one type.

    Integers and decimals use their cast text, timestamps without time zone a
    fixed pattern with microseconds, timestamps with time zone their instant in
    microseconds (whatever the session's zone), variants their schema beside
    their JSON (1 and 1.0 differ). A double that nine decimals give back exactly uses them, any
    other its shortest exact text; -0.0 equals 0.0 and NaN equals NaN. Nested
    values are written out value by value, maps in the order of their entries.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        fixed = f"try_cast({c} AS DECIMAL(38,9))"
        return f"CASE WHEN CAST({fixed} AS {dtype.simpleString()}) = {c} THEN CAST({fixed} AS STRING) ELSE CAST({c} AS STRING) END"
    if isinstance(dtype, T.TimestampNTZType):
        return f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    if isinstance(dtype, T.TimestampType):
        return f"CAST(unix_micros({c}) AS STRING)"
    if isinstance(dtype, T.VariantType):
        return f"concat(schema_of_variant({c}), ':', to_json({c}))"
    if isinstance(dtype, T.BinaryType):
        return f"hex({c})"
    x = f"x{depth}"
    if isinstance(dtype, T.StructType):
        parts = [_escaped(_value_sql(f"{c}.{_q(f.name)}", f.dataType, depth)) for f in dtype.fields]
        return f"CASE WHEN {c} IS NOT NULL THEN concat('{{', concat_ws('|', {', '.join(parts) or repr('')}), '}}') END"
    if isinstance(dtype, T.ArrayType):
        each = _escaped(_value_sql(x, dtype.elementType, depth + 1))
        return f"concat('[', array_join(transform({c}, {x} -> {each}), '|'), ']')"
    if isinstance(dtype, T.MapType):
        each = f"concat({_escaped(_value_sql(x + '.key', dtype.keyType, depth + 1))}, '|', {_escaped(_value_sql(x + '.value', dtype.valueType, depth + 1))})"
        return f"concat('<', array_join(array_sort(transform(map_entries({c}), {x} -> {each})), '|'), '>')"
    return f"CAST({c} AS STRING)"


def canonical_sql(df: DataFrame, name: str) -> str:
    """Exact text of one value for fingerprints, as a SQL expression; unambiguous in the joined row text."""
    return _escaped(_value_sql(_q(name), df.schema[name].dataType))


def row_text_sql(df: DataFrame, cols: list[str] | None = None) -> str:
    """Canonical text of a whole row (columns in name order), as SQL."""
    cols = sorted(cols if cols is not None else df.columns)
    return "concat_ws('|', " + ", ".join(canonical_sql(df, c) for c in cols) + ")"


def canonical_text(df: DataFrame, name: str) -> Column:
    return F.expr(canonical_sql(df, name))


def row_text(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Canonical text of a whole row, columns in name order."""
    return F.expr(row_text_sql(df, cols))


# A 128-bit MD5 digest is read as four 32-bit lanes; each lane is summed as
# two 16-bit halves in bigint, which cannot overflow below 2^47 rows, and
# recombined at the end as an exact decimal.
_HALVES = [(1 + 4 * i) for i in range(8)]


def lane_sums(digest_col: str, prefix: str = "h") -> list[Column]:
    """Aggregates over a hex digest column: the eight 16-bit partial sums."""
    d = _q(digest_col)
    return [F.expr(f"sum(CAST(conv(substring({d}, {p}, 4), 16, 10) AS BIGINT)) AS {prefix}{i}")
            for i, p in enumerate(_HALVES)]


def lanes_text_sql(count_col: str, prefix: str = "h") -> str:
    """'count:l1:l2:l3:l4' from the partial sums (exact, decimal arithmetic)."""
    parts = [f"CAST({count_col} AS STRING)"]
    for j in range(4):
        hi, lo = f"{prefix}{2 * j}", f"{prefix}{2 * j + 1}"
        parts.append(f"CAST(CAST(coalesce(CAST({hi} AS DECIMAL(38,0)) * 65536 + CAST({lo} AS DECIMAL(38,0)), 0) "
                     f"AS DECIMAL(38,0)) AS STRING)")
    return "concat_ws(':', " + ", ".join(parts) + ")"


def lanes_text(count: str, prefix: str = "h") -> Column:
    return F.expr(lanes_text_sql(count, prefix))


def band(pct: Column) -> Column:
    """Quality band of a percentage (100 / >=75 / >=50 / else)."""
    from ..entities import BAND_EXCELLENT, BAND_FAIR, BAND_GOOD
    return (F.when(pct == BAND_EXCELLENT, "excellent")
             .when(pct >= BAND_GOOD, "good")
             .when(pct >= BAND_FAIR, "fair")
             .otherwise("poor"))


def message_id(seed: Column, length: int = 8, prefix: str = "MSG") -> Column:
    """Deterministic short id: prefix + upper-case hex of md5(seed)."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(seed.cast("string")), 1, length)))


def gender(sex_cd: Column) -> Column:
    """Lower-cased code, 'unknown' for null or empty."""
    return F.when(F.coalesce(F.length(sex_cd), F.lit(0)) > 0, F.lower(sex_cd)).otherwise("unknown")
