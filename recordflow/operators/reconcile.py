"""Source-to-target reconciliation.

Per side, two scans produce one row: (1) all columns -> row count, null
counts and the multiset fingerprint, a global aggregate with no shuffle;
(2) the key column only -> duplicate measures through a partially
aggregated ``groupBy``. The two one-row profiles of a pair are put side by
side with a union and an aggregate (no join). Row-level differences group
each side by key first (one row per key and side) so a repeated key never
multiplies in the join.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..entities import RECON_NULL_FIELDS, key_for
from ..functions.columns import _q, lane_sums, lanes_text, lanes_text_sql, row_text_sql
from .ordinals import with_ordinal
from .quality import _key_text, duplicate_profile, merge_one_row, sql_str


def _with_digest(df: DataFrame, cols: list[str] | None, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``_dg`` = md5 of the canonical row text, computed
    once per row before any aggregation or shuffle."""
    return df.selectExpr(*[_q(c) for c in keep], f"md5({row_text_sql(df, cols)}) AS _dg")


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order-insensitive multiset fingerprint 'rows:l1:l2:l3:l4' (one row).

    Sum (not xor) of the four 32-bit lanes of md5(row text): duplicates
    add up instead of cancelling, so a duplicated row changes the value.
    """
    d = _with_digest(df, cols, [])
    return d.agg(F.count(F.lit(1)).alias("_rows"), *lane_sums("_dg")) \
            .select(lanes_text("_rows").alias("fingerprint"))


def ordered_fingerprint(df: DataFrame, order_by: list[str], cols: list[str] | None = None) -> DataFrame:
    """Order-sensitive fingerprint: every row digest is salted with its
    1-based position in the order (ties broken by the digest), then summed
    in lanes. Positions come from the distributed ordinal operator."""
    d = _with_digest(df, cols, list(order_by))
    o = with_ordinal(d, [*order_by, "_dg"], name="_pos")
    salted = o.selectExpr("md5(concat(CAST(_pos AS STRING), ':', _dg)) AS _sd")
    return salted.agg(F.count(F.lit(1)).alias("_rows"), *lane_sums("_sd")) \
                 .select(lanes_text("_rows").alias("fingerprint"))


def ordered_fingerprints(frames: dict[str, DataFrame], order_by: list[str],
                         cols: list[str] | None = None) -> DataFrame:
    """Ordered fingerprints of several frames from one distributed sort.

    The frames' (order columns, digest) rows are unioned under a side label
    and numbered once with the side as leading sort key; a side's positions
    start after the rows of the sides before it, and those offsets come from
    a per-side aggregate (one row per side). Returns (side, fingerprint).
    """
    parts = [_with_digest(df, cols, list(order_by)).selectExpr(f"{sql_str(name)} AS _side", "*")
             for name, df in frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    o = with_ordinal(u, ["_side", *order_by, "_dg"], name="_g")
    first = o.groupBy("_side").agg(F.min("_g").alias("_first"))
    pos = o.join(F.broadcast(first), "_side").selectExpr(
        "_side", "md5(concat(CAST(_g - _first + 1 AS STRING), ':', _dg)) AS _sd")
    return pos.groupBy("_side").agg(F.count(F.lit(1)).alias("_rows"), *lane_sums("_sd")) \
              .select(F.col("_side").alias("side"), lanes_text("_rows").alias("fingerprint"))


def side_profile(df: DataFrame, key: str, null_fields: list[str],
                 cols: list[str] | None = None, ordered_by: list[str] | None = None) -> DataFrame:
    """One row: rows, null counts n0.., fingerprint, duplicate_keys."""
    present = [f for f in null_fields if f in df.columns]
    d = df.selectExpr(*[f"{_q(f)} IS NULL AS _z{i}" for i, f in enumerate(null_fields) if f in present],
                      f"md5({row_text_sql(df, cols)}) AS _dg")
    aggs = [F.expr("count(1) AS rows")]
    aggs += [F.expr(f"count_if(_z{i}) AS n{i}" if f in present else f"count(1) AS n{i}")
             for i, f in enumerate(null_fields)]
    full = d.agg(*aggs, *lane_sums("_dg")).selectExpr(
        "rows", *[f"n{i}" for i in range(len(null_fields))], f"{lanes_text_sql('rows')} AS fingerprint")
    g = df.groupBy(_key_text(df, key).alias("k")).agg(F.count(F.lit(1)).alias("v"))
    dups = g.agg(F.expr("CAST(count_if(v > 1) AS BIGINT) AS duplicate_keys"))
    parts = [full, dups]
    if ordered_by:
        parts.append(ordered_fingerprint(df, ordered_by, cols).withColumnRenamed("fingerprint", "ordered_fingerprint"))
    return merge_one_row(parts)


def land(source: DataFrame, path: str, null_fields: list[str] | None = None, convert=None) -> tuple[dict, DataFrame]:
    """Write ``source`` (through ``convert``, if the target stores it otherwise) to ``path``; its profile, and the table read back.

    Row count, null counts and fingerprint lanes of the source rows are carried
    by an ``Observation`` of the same write, so the source is read once.
    """
    spark = source.sparkSession
    fields = list(null_fields if null_fields is not None else RECON_NULL_FIELDS)
    seen = Observation(f"land_{uuid.uuid4().hex}")
    rows = F.count(F.lit(1))
    nulls = [(F.count_if(F.col(f).isNull()) if f in source.columns else rows).alias(f"n{i}") for i, f in enumerate(fields)]
    (source.withColumn("_dg", F.expr(f"md5({row_text_sql(source)})")).observe(seen, rows.alias("rows"), *nulls, *lane_sums("_dg"))
     .drop("_dg").transform(convert or (lambda df: df)).write.mode("overwrite").parquet(path))
    return seen.get, spark.read.parquet(path)


def reconcile_landing(name: str, source: DataFrame, path: str, key: str | None = None, null_fields: list[str] | None = None,
                      convert=None) -> Reconciliation:
    """``reconcile`` of a table that is landed here and now, with one scan of the source.

    Duplicate keys can't be observed. Where the fingerprints of both sides are
    equal, the rows are, and the target's duplicates are the source's; only a
    mismatch makes a second pass, over the source's key column alone.
    """
    fields = list(null_fields if null_fields is not None else RECON_NULL_FIELDS)
    k = key or key_for(name)
    seen, target = land(source, path, fields, convert)
    t = side_profile(target, k, fields).first()
    lanes = {f"h{i}": seen[f"h{i}"] or 0 for i in range(8)}
    fingerprint = ":".join([str(seen["rows"]), *(str(lanes[f"h{2 * j}"] * 65536 + lanes[f"h{2 * j + 1}"]) for j in range(4))])
    same = fingerprint == t["fingerprint"]
    duplicates = t["duplicate_keys"] if same else duplicate_profile(source, k).first()["duplicate_keys"]
    row = {"entity_name": name, "key_field": k, "s_rows": seen["rows"], "s_fingerprint": fingerprint, "s_duplicate_keys": duplicates,
           **{f"s_n{i}": seen[f"n{i}"] for i in range(len(fields))}, **{f"t_{c}": t[c] for c in t.asDict()}}
    types = ", ".join(f"{c} {'string' if isinstance(v, str) else 'bigint'}" for c, v in row.items())
    return _compared(source.sparkSession.createDataFrame([tuple(row.values())], types), fields, False)


class Reconciliation:
    """``report``: one row per pair; ``checks``: one row per check (built on first use)."""

    def __init__(self, wide: DataFrame, fields: list[str], ordered: bool, report: DataFrame):
        self._wide, self._fields, self._ordered = wide, fields, ordered
        self.report = report
        self._checks = None

    @property
    def checks(self) -> DataFrame:
        if self._checks is None:
            self._checks = _checks(self._wide, self._fields, self._ordered)
        return self._checks


    def identified(self, report_id: str | None = None, generated_at: _dt.datetime | None = None) -> DataFrame:
        """The report with its id and time (a new id and the present time unless given)."""
        return self.report.select(
            F.lit(report_id or uuid.uuid4().hex).alias("report_id"),
            F.lit(str(generated_at or _dt.datetime.now())).cast("timestamp_ntz").alias("generated_at"), "*")

    @property
    def null_counts(self) -> DataFrame:
        """The null-count checks alone, from the null columns alone: no digest, no key shuffle."""
        items = [F.struct(F.lit(f).alias("field_name"), F.col(f"s_n{i}").cast("bigint").alias("source_null_count"),
                          F.col(f"t_n{i}").cast("bigint").alias("target_null_count"),
                          (F.col(f"s_n{i}") == F.col(f"t_n{i}")).alias("match")) for i, f in enumerate(self._fields)]
        return self._wide.select("entity_name", F.inline(F.array(*items)))


def _checks(wide: DataFrame, fields: list[str], ordered: bool) -> DataFrame:
    def chk(name, field, sv, tv):
        return F.struct(F.lit(name).alias("check_name"), F.lit(field).cast("string").alias("field_name"),
                        sv.cast("string").alias("source_value"), tv.cast("string").alias("target_value"),
                        (sv == tv).alias("match"))

    items = [chk("row_count", None, F.col("s_rows"), F.col("t_rows")),
             chk("checksum", None, F.col("s_fingerprint"), F.col("t_fingerprint"))]
    if ordered:
        items.append(chk("ordered_checksum", None, F.col("s_ordered_fingerprint"),
                         F.col("t_ordered_fingerprint")))
    items += [chk("null_count", f, F.col(f"s_n{i}"), F.col(f"t_n{i}")) for i, f in enumerate(fields)]
    items.append(chk("duplicates", F.col("key_field"), F.col("s_duplicate_keys"), F.col("t_duplicate_keys")))
    return wide.select("entity_name", F.explode(F.array(*items)).alias("c")).select("entity_name", "c.*")


def reconcile(pairs: list[tuple[str, DataFrame, DataFrame]], key: str | None = None,
              null_fields: list[str] | None = None, key_rule: str = "explicit",
              cols: list[str] | None = None, ordered_by: list[str] | None = None) -> Reconciliation:
    """Compare each (entity_name, source, target) pair.

    Checks: row counts (difference = source - target), table fingerprint,
    null counts of ``null_fields`` (absent column counts all rows), and
    duplicate keys. ``overall_match`` needs every check to match;
    ``issues_found`` counts failed checks (at most 6).
    """
    fields = list(null_fields if null_fields is not None else RECON_NULL_FIELDS)
    wide = None
    for name, src, tgt in pairs:
        k = key or key_for(name, key_rule)
        s = side_profile(src, k, fields, cols, ordered_by)
        t = side_profile(tgt, k, fields, cols, ordered_by)
        s = s.select(F.lit(name).alias("entity_name"), F.lit(k).alias("key_field"),
                     *[F.col(c).alias(f"s_{c}") for c in s.columns])
        t = t.select(*[F.col(c).alias(f"t_{c}") for c in t.columns])
        # Two one-row profiles side by side: union + aggregate, no join.
        j = merge_one_row([s, t])
        wide = j if wide is None else wide.unionByName(j)
    return _compared(wide, fields, bool(ordered_by))


def _compared(wide: DataFrame, fields: list[str], ordered: bool) -> Reconciliation:
    """The report over one-row profiles of both sides (``s_`` and ``t_`` columns)."""
    null_ok = F.lit(True)
    for i in range(len(fields)):
        null_ok = null_ok & (F.col(f"s_n{i}") == F.col(f"t_n{i}"))
    flags = [F.col("s_rows") == F.col("t_rows"), F.col("s_fingerprint") == F.col("t_fingerprint")]
    if ordered:
        flags.append(F.col("s_ordered_fingerprint") == F.col("t_ordered_fingerprint"))
    flags += [F.col(f"s_n{i}") == F.col(f"t_n{i}") for i in range(len(fields))]
    flags.append(F.col("s_duplicate_keys") == F.col("t_duplicate_keys"))
    failed = sum((F.when(f, 0).otherwise(1) for f in flags), F.lit(0))
    report = wide.select(
        "entity_name",
        F.col("s_rows").cast("bigint").alias("source_count"),
        F.col("t_rows").cast("bigint").alias("target_count"),
        (F.col("s_rows") - F.col("t_rows")).cast("bigint").alias("difference"),
        (F.col("s_rows") == F.col("t_rows")).alias("row_count_match"),
        F.col("s_fingerprint").alias("source_checksum"),
        F.col("t_fingerprint").alias("target_checksum"),
        (F.col("s_fingerprint") == F.col("t_fingerprint")).alias("checksum_match"),
        null_ok.alias("null_checks_match"),
        F.col("key_field"),
        F.col("s_duplicate_keys").alias("source_duplicates"),
        F.col("t_duplicate_keys").alias("target_duplicates"),
        (F.col("s_duplicate_keys") == F.col("t_duplicate_keys")).alias("duplicates_match"),
        (failed == 0).alias("overall_match"),
        failed.cast("bigint").alias("issues_found"))
    return Reconciliation(wide, fields, ordered, report)


STATUS_MATCH, STATUS_MISMATCH = "match", "mismatch"
STATUS_SOURCE_MISSING, STATUS_TARGET_MISSING = "source_missing", "target_missing"


def row_diff(source: DataFrame, target: DataFrame, key: str,
             cols: list[str] | None = None) -> DataFrame:
    """Per-key status: match / mismatch / source_missing / target_missing.

    Each side is reduced to one row per key (row count + multiset digest of
    its rows), so repeated keys compare as multisets and the full outer
    join is 1:1 per key; the digest is computed before the shuffle.
    """
    cols = cols or [c for c in source.columns if c in target.columns]

    def per_key(df, p):
        d = _with_digest(df, cols, [key]).withColumnRenamed(key, "_key")
        return d.groupBy("_key").agg(F.count(F.lit(1)).alias(f"{p}rows"), *lane_sums("_dg", prefix=f"{p}h"))

    s, t = per_key(source, "s_"), per_key(target, "t_")
    j = s.join(t, s["_key"].eqNullSafe(t["_key"]), "full_outer")
    same = F.col("s_rows") == F.col("t_rows")
    for i in range(8):
        same = same & (F.col(f"s_h{i}") == F.col(f"t_h{i}"))
    status = (F.when(F.col("s_rows").isNull(), STATUS_SOURCE_MISSING)
               .when(F.col("t_rows").isNull(), STATUS_TARGET_MISSING)
               .when(same, STATUS_MATCH).otherwise(STATUS_MISMATCH))
    return j.select(F.coalesce(s["_key"], t["_key"]).alias(key), status.alias("status"),
                    F.coalesce(F.col("s_rows"), F.lit(0)).cast("bigint").alias("source_rows"),
                    F.coalesce(F.col("t_rows"), F.lit(0)).cast("bigint").alias("target_rows"))


def row_diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("keys"))
