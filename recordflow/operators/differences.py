"""Where two tables differ: by column of a key, and by range of keys.

``column_diff`` works in two phases. Digests find the keys whose rows differ
(``reconcile.row_diff``); only these keys' rows are then read with their
columns, through a semi join, and compared value by value. Columns of matching
keys are never shuffled as long as Spark can broadcast the list of mismatching
keys behind its own size check; beyond it the semi join shuffles.

``digest_tree`` finds the differing ranges without naming keys first: both
tables are digested over a coarse grid of key positions, and only cells that
differ are read again, over a finer grid, down to the leaf width. A level costs
one small aggregate; its reading is limited to the differing cells by a range
predicate that reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import _q, _value_sql, lane_sums, row_text_sql
from ..session import run_dir
from .quality import sql_str
from .reconcile import STATUS_MISMATCH, row_diff

FANOUT = 64
INTERVALS = 64  # range predicates of one level, at most
LARGEST = (1 << 63) - 1


def _written(df: DataFrame, kind: str) -> DataFrame:
    path = run_dir(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------ column by column

def column_diff(source: DataFrame, target: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    """(key, column_name, source_text, target_text, source_rows, target_rows) of every column that differs under a key.

    Keys on both sides only; those on one side are ``row_diff``'s. Values are
    compared null-safe by their exact text, the rows of a repeated key as a
    multiset per column: ``source_rows`` counts the rows whose value the source
    has more often than the target, ``source_text`` is the smallest such value
    (the value itself where the key is unique), and null is a value like any
    other. Rows that differ only in how values combine differ in no column.
    """
    cols = [c for c in (cols or [c for c in source.columns if c in target.columns]) if c != key]
    if not cols:
        return row_diff(source, target, key).where("false").selectExpr(
            _q(key), "'' AS column_name", "'' AS source_text", "'' AS target_text", "0L AS source_rows", "0L AS target_rows")
    diff = row_diff(source, target, key, [key, *cols])
    keys = _written(diff.where(F.col("status") == STATUS_MISMATCH).select(F.col(key).alias("_key")), "mismatching")

    def values(df: DataFrame, sign: int) -> DataFrame:
        mine = df.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        each = ", ".join(f"named_struct('c', {sql_str(c)}, 'v', {_value_sql(_q(c), df.schema[c].dataType)})" for c in cols)
        return mine.selectExpr(f"{_q(key)} AS _key", f"inline(array({each}))").selectExpr("_key", "c", "v", f"{sign}L AS n")

    left = values(source, 1).unionByName(values(target, -1)).groupBy("_key", "c", "v").agg(F.sum("n").alias("n")).where("n <> 0")
    return left.groupBy("_key", "c").agg(
        F.min(F.when(F.col("n") > 0, F.col("v"))).alias("source_text"), F.min(F.when(F.col("n") < 0, F.col("v"))).alias("target_text"),
        F.sum(F.greatest(F.col("n"), F.lit(0))).alias("source_rows"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("target_rows")) \
        .select(F.col("_key").alias(key), F.col("c").alias("column_name"), "source_text", "target_text", "source_rows", "target_rows")


def column_diff_counts(diff: DataFrame) -> DataFrame:
    """Per column: the keys under which it differs, and how many of these lost or gained a value."""
    return diff.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("source_text").isNotNull() & F.col("target_text").isNull()).alias("to_null"),
        F.count_if(F.col("source_text").isNull() & F.col("target_text").isNotNull()).alias("from_null"))


# ------------------------------------------------------------- range by range

def _position(df: DataFrame, key: str) -> str:
    """SQL of a key's place as a bigint: its own order for numbers and times, that of a hash for other types."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType):
        return f"CAST({_q(key)} AS BIGINT)"
    if isinstance(kind, T.DateType):
        return f"CAST(unix_date({_q(key)}) AS BIGINT)"
    if isinstance(kind, T.TimestampType):
        return f"unix_micros({_q(key)})"
    if isinstance(kind, T.TimestampNTZType):
        return f"unix_micros(to_timestamp_ltz(CAST({_q(key)} AS STRING) || 'Z'))"
    return f"CASE WHEN {_q(key)} IS NOT NULL THEN shiftright(xxhash64({_value_sql(_q(key), kind)}), 1) END"


def _cells(source: DataFrame, target: DataFrame, at: str, cols: list[str], width: int, low: int, limits: str | None,
           parents: DataFrame | None, parent_width: int) -> DataFrame:
    """Cells of one level whose rows differ: (cell, source_rows, target_rows); cell null for null keys."""
    def side(df: DataFrame, no: int) -> DataFrame:
        rows = df.where(limits) if limits else df
        return rows.selectExpr(f"{no} AS _side", f"{at} AS _at", f"md5({row_text_sql(df, cols)}) AS _dg")

    rows = side(source, 0).unionByName(side(target, 1))
    if parents is not None:
        rows = rows.withColumn("_p", F.expr(f"(_at - ({low}L)) div {parent_width}L")).join(parents, "_p", "left_semi")
    grouped = rows.withColumn("cell", F.expr(f"(_at - ({low}L)) div {width}L")).groupBy("cell", "_side") \
        .agg(F.count(F.lit(1)).alias("_rows"), *lane_sums("_dg"))
    state = F.struct("_rows", *[f"h{i}" for i in range(8)])
    both = grouped.groupBy("cell").agg(F.max(F.when(F.col("_side") == 0, state)).alias("s"), F.max(F.when(F.col("_side") == 1, state)).alias("t"))
    zero = F.lit(0).cast("bigint")
    return both.where(~F.col("s").eqNullSafe(F.col("t"))).select(
        "cell", F.coalesce("s._rows", zero).alias("source_rows"), F.coalesce("t._rows", zero).alias("target_rows"))


def _limits(cells: DataFrame, at: str, width: int, low: int, low_cell: int, high_cell: int) -> str:
    """A range predicate that holds for all rows of the differing cells: at most ``INTERVALS`` ranges."""
    step = max(1, -(-(high_cell - low_cell + 1) // INTERVALS))
    ranges = cells.groupBy(F.expr(f"(cell - {low_cell}L) div {step}L").alias("i")).agg(F.min("cell").alias("a"), F.max("cell").alias("b")).collect()
    return " OR ".join(f"({at} >= {low + r['a'] * width}L AND {at} <= {min(low + (r['b'] + 1) * width - 1, LARGEST)}L)" for r in sorted(ranges, key=lambda r: r["a"]))


def digest_tree(source: DataFrame, target: DataFrame, key: str, leaf_width: int | None = None, cols: list[str] | None = None,
                fanout: int = FANOUT) -> DataFrame:
    """(range_lo, range_hi, source_rows, target_rows) of the leaf ranges of key positions whose rows differ.

    Numbers, dates (days) and times (microseconds) are their own positions;
    keys of other types are placed by a hash. Leaves are ``leaf_width``
    positions wide, counted from the smallest position of either side; by
    default wide enough for about a thousand rows. Rows with a null key are one
    more leaf, with null bounds. Cells are compared by row count and digest
    lanes, so repeated rows count.
    """
    spark = source.sparkSession
    cols = cols or [c for c in source.columns if c in target.columns]
    at = _position(source, key)
    ends = source.selectExpr(f"{at} AS p").unionByName(target.selectExpr(f"{at} AS p")).agg(
        F.min("p").alias("a"), F.max("p").alias("b"), F.count("p").alias("n")).first()
    if ends["a"] is None:  # no key at all: the null keys are all there is
        low, span = 0, 1
    else:
        low, span = ends["a"], ends["b"] - ends["a"] + 1
    if span > LARGEST:
        raise ValueError(f"{key} spans more than 63 bits")
    leaf = min(leaf_width or max(1, span * 1000 // max(1, ends["n"])), span)
    widths = [leaf]
    while widths[-1] < span and len(widths) < 64 and widths[-1] * fanout < 1 << 62:
        widths.append(widths[-1] * fanout)
    widths = widths[:-1] if len(widths) > 1 and widths[-1] >= span else widths  # one cell over everything tells nothing
    limits, parents, parent_width, nulls = None, None, 0, None
    for width in reversed(widths):
        cells = _written(_cells(source, target, at, cols, width, low, limits, parents, parent_width), "digests")
        if nulls is None:  # the first level reads everything, null keys as well
            nulls = cells.where("cell IS NULL")
        cells = cells.where("cell IS NOT NULL")
        if width == widths[0]:
            break
        seen = cells.agg(F.min("cell").alias("a"), F.max("cell").alias("b")).first()
        if seen["a"] is None:
            cells = spark.createDataFrame([], cells.schema)
            break
        limits = _limits(cells, at, width, low, seen["a"], seen["b"])
        parents, parent_width = cells.select(F.col("cell").alias("_p")), width
    lo = F.expr(f"CAST(cell AS DECIMAL(38,0)) * {leaf} + ({low})")
    return cells.unionByName(nulls).select(
        lo.cast("bigint").alias("range_lo"), F.when(lo.isNotNull(), F.least(lo + F.lit(leaf - 1), F.lit(LARGEST))).cast("bigint").alias("range_hi"),
        "source_rows", "target_rows")
