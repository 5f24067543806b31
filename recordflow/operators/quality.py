"""Data-quality checks: required columns, nulls, duplicates, orphans, rules.

Each check returns issue rows with one schema (``ISSUE_COLS``) so checks
combine with ``unionByName``. A full validation is one scan and one
shuffle: the key ``groupBy`` carries row and null counts along, and its
partial aggregation runs map-side, so a hot key is reduced before the
shuffle. Schema checks read only metadata.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..entities import EDGES, VALIDATION_NULL_FIELDS, Edge, key_for, required_fields

ISSUE_COLS = ["entity_name", "level", "validation_type", "field_name", "message", "row_count"]

ERROR, WARNING, INFO = "error", "warning", "info"


def sql_str(text: str) -> str:
    """A Spark SQL string literal for ``text``."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Issues are built as SQL expression text: one expression per frame instead
# of one driver round trip per Column function (same plan either way).
def _issue(entity: str, level: str, vtype: str, field: str, message_sql: str, rows_sql: str) -> str:
    return (f"named_struct('entity_name', {sql_str(entity)}, 'level', '{level}', "
            f"'validation_type', '{vtype}', 'field_name', {sql_str(field)}, "
            f"'message', {message_sql}, 'row_count', CAST({rows_sql} AS BIGINT))")


def _issues_from(one_row: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
    """Issue rows from a one-row aggregate: (condition, issue struct) SQL pairs."""
    if not items:
        return one_row.sparkSession.createDataFrame([], _issue_schema())
    arr = ", ".join(f"CASE WHEN {cond} THEN {iss} END" for cond, iss in items)
    return one_row.selectExpr(f"explode(filter(array({arr}), x -> x IS NOT NULL)) AS i").select("i.*")


def _schema_issue(label: str, entity: str, f: str) -> tuple[str, str]:
    return ("rows > 0", _issue(label, ERROR, "schema", f,
                               sql_str(f"Required field '{f}' missing from {entity}"), "rows"))


def _null_issue(label: str, f: str, i: int) -> tuple[str, str]:
    msg = sql_str("%d null values found in '" + f + "'")
    return (f"n{i} > 0", _issue(label, WARNING, "null_check", f, f"format_string({msg}, n{i})", f"n{i}"))


def _dup_issue(label: str, key: str) -> tuple[str, str]:
    msg = sql_str("%d duplicate key values in '" + key + "'")
    return ("duplicate_keys > 0", _issue(label, WARNING, "duplicate", key,
                                         f"format_string({msg}, surplus_rows)", "surplus_rows"))


def _issue_schema():
    return ("entity_name string, level string, validation_type string, "
            "field_name string, message string, row_count bigint")


def _key_text(df: DataFrame, key: str) -> Column:
    """Grouping value of the key; an absent key is '' for all rows.

    Groups follow the key's text form. Within one typed column, distinct
    integer, decimal, string, date or time values have distinct texts, so the
    raw value groups identically and shuffles smaller (8-byte longs instead
    of strings). Floating point is grouped by text, because -0.0 and 0.0
    print differently but compare equal.
    """
    if key not in df.columns:
        return F.lit("")
    if isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType)):
        return F.col(key).cast("string")
    return F.col(key)


def profile(df: DataFrame, null_fields: list[str]) -> DataFrame:
    """One pass: row count and a null count per field (absent -> all rows)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(null_fields):
        c = F.count_if(F.col(f).isNull()) if f in df.columns else F.count(F.lit(1))
        aggs.append(c.alias(f"n{i}"))
    return df.agg(*aggs)


def duplicate_profile(df: DataFrame, key: str) -> DataFrame:
    """Surplus rows sum(v-1) and duplicate keys count(v>1) over key groups."""
    g = df.groupBy(_key_text(df, key).alias("k")).agg(F.count(F.lit(1)).alias("v"))
    return g.agg(
        F.coalesce(F.sum(F.when(F.col("v") > 1, F.col("v") - 1)), F.lit(0)).cast("bigint").alias("surplus_rows"),
        F.count_if(F.col("v") > 1).cast("bigint").alias("duplicate_keys"))


# --------------------------------------------------------------------------
# Individual checks
# --------------------------------------------------------------------------

def missing_required(df: DataFrame, entity: str) -> list[str]:
    """Required columns absent from the frame (schema metadata, no data read)."""
    return [f for f in required_fields(entity) if f not in df.columns]


def validate_schema(df: DataFrame, entity: str, label: str | None = None) -> DataFrame:
    """One ERROR per missing required column; row_count = all rows.

    An empty batch has no issues (nothing to check).
    """
    label = label or entity
    items = [_schema_issue(label, entity, f) for f in missing_required(df, entity)]
    return _issues_from(profile(df, []), items)


def validate_nulls(df: DataFrame, entity: str, null_fields: list[str] | None = None,
                   label: str | None = None) -> DataFrame:
    """One WARNING per field with nulls (absent column counts as all null)."""
    fields = list(null_fields if null_fields is not None else VALIDATION_NULL_FIELDS)
    label = label or entity
    items = [_null_issue(label, f, i) for i, f in enumerate(fields)]
    return _issues_from(profile(df, fields), items)


def validate_duplicates(df: DataFrame, entity: str, key: str | None = None,
                        label: str | None = None) -> DataFrame:
    """One WARNING when any key repeats; row_count = surplus rows."""
    key = key or key_for(entity)
    label = label or entity
    return _issues_from(duplicate_profile(df, key), [_dup_issue(label, key)])


def fused_profile(df: DataFrame, key: str, null_fields: list[str]) -> DataFrame:
    """Row count, null counts and duplicate measures in one scan and one shuffle.

    Only the key and the null-checked columns are read. The key groups carry
    their row and null counts, partially aggregated map-side, and a final
    global aggregate folds them into one row.
    """
    aggs = [F.count(F.lit(1)).alias("v")]
    for i, f in enumerate(null_fields):
        c = F.count_if(F.col(f).isNull()) if f in df.columns else F.count(F.lit(1))
        aggs.append(c.alias(f"n{i}"))
    g = df.groupBy(_key_text(df, key).alias("k")).agg(*aggs)
    zero = F.lit(0).cast("bigint")
    return g.agg(
        F.coalesce(F.sum("v"), zero).cast("bigint").alias("rows"),
        *[F.coalesce(F.sum(f"n{i}"), zero).cast("bigint").alias(f"n{i}") for i in range(len(null_fields))],
        F.coalesce(F.sum(F.when(F.col("v") > 1, F.col("v") - 1)), zero).cast("bigint").alias("surplus_rows"),
        F.count_if(F.col("v") > 1).cast("bigint").alias("duplicate_keys"))


class Validation:
    """``issues`` (one row per finding) and ``summary`` (one row), each
    built on first use from the same one-row profile."""

    def __init__(self, build_issues, build_summary):
        self._bi, self._bs = build_issues, build_summary
        self._issues = self._summary = None

    @property
    def issues(self) -> DataFrame:
        if self._issues is None:
            self._issues = self._bi()
        return self._issues

    @property
    def summary(self) -> DataFrame:
        if self._summary is None:
            self._summary = self._bs()
        return self._summary


def validate_all(df: DataFrame, entity: str, key: str | None = None,
                 null_fields: list[str] | None = None, label: str | None = None) -> Validation:
    """Schema + nulls + duplicates from one fused pass; passes only without issues.

    Warnings fail the batch too. ``issues_found`` counts issues, not rows.
    """
    key = key or key_for(entity)
    label = label or entity
    fields = list(null_fields if null_fields is not None else VALIDATION_NULL_FIELDS)
    missing = missing_required(df, entity)
    prof = fused_profile(df, key, fields)
    items = ([_schema_issue(label, entity, f) for f in missing]
             + [_null_issue(label, f, i) for i, f in enumerate(fields)]
             + [_dup_issue(label, key)])
    errors = f"(CASE WHEN rows > 0 THEN {len(missing)} ELSE 0 END)"
    warnings = " + ".join([f"(CASE WHEN n{i} > 0 THEN 1 ELSE 0 END)" for i in range(len(fields))]
                          + ["(CASE WHEN duplicate_keys > 0 THEN 1 ELSE 0 END)"])

    def summary():
        return prof.selectExpr(
            f"{sql_str(label)} AS entity_name",
            f"({errors} + {warnings}) = 0 AS passed",
            "rows AS rows_checked",
            f"CAST({errors} + {warnings} AS BIGINT) AS issues_found",
            f"CAST({errors} AS BIGINT) AS errors",
            f"CAST({warnings} AS BIGINT) AS warnings")

    return Validation(lambda: _issues_from(prof, items), summary)


def merge_one_row(frames: list[DataFrame]) -> DataFrame:
    """Combine one-row aggregates with disjoint columns into one row
    (union, then a global aggregate) instead of joining them."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def validate_referential(tables: dict[str, DataFrame], edges: list[Edge] | None = None) -> DataFrame:
    """Orphan check per foreign-key edge: child rows whose key has no parent.

    ``left_anti`` against the parent's key column only. Spark broadcasts the
    parent when its measured size is under the broadcast bound, else it
    shuffles both sides on the key. A null foreign key is not an orphan.
    """
    out = None
    for e in edges or EDGES:
        if e.child not in tables or e.parent not in tables:
            continue
        child = tables[e.child].select(F.col(e.fk).alias("_k"))
        # Distinct parent keys: a repeated parent key cannot skew the join, and
        # the aggregate's hash partitioning on the key feeds the join directly.
        parent = tables[e.parent].select(F.col(e.pk).alias("_k")).distinct()
        # One pass over the child: rows per key, then one aggregate over the keys.
        keys = child.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
        orphan = F.col("_k").isNotNull() & F.col("_p").isNull()
        counts = keys.join(parent.withColumn("_p", F.lit(True)), "_k", "left").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
            F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(orphan).alias("orphan_keys"))
        r = counts.select(
            F.lit(e.child).alias("entity_name"), F.lit(e.fk).alias("field_name"),
            F.lit(e.parent).alias("parent_entity"), F.lit(e.pk).alias("parent_key"),
            F.col("child_rows").cast("bigint").alias("child_rows"),
            F.col("orphan_rows").cast("bigint").alias("orphan_rows"),
            F.col("orphan_keys").cast("bigint").alias("orphan_keys"),
            F.when(F.col("orphan_rows") > 0, F.lit(ERROR)).otherwise(F.lit(INFO)).alias("level"),
            F.lit("referential").alias("validation_type"),
            (F.col("orphan_rows") == 0).alias("passed"))
        out = r if out is None else out.unionByName(r)
    return out


@dataclass(frozen=True)
class Rule:
    """A row predicate that marks a violating row (SQL boolean expression)."""
    name: str
    entity: str
    field: str
    violation: str
    level: str = WARNING


def validate_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Clinical/business rules: one aggregate pass per entity counts every
    rule's violations together (``count_if``), then one row per rule."""
    out = None
    by_entity: dict[str, list[Rule]] = {}
    for r in rules:
        by_entity.setdefault(r.entity, []).append(r)
    for ent, rs in by_entity.items():
        df = tables[ent]
        prof = df.agg(F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(F.coalesce(F.expr(r.violation), F.lit(False))).alias(f"v{i}")
                        for i, r in enumerate(rs)])
        rows = prof.select(F.explode(F.array(*[
            F.struct(F.lit(ent).alias("entity_name"), F.lit(r.name).alias("rule_name"),
                     F.lit(r.field).alias("field_name"), F.lit(r.level).alias("level"),
                     F.lit("clinical").alias("validation_type"),
                     F.col("rows").cast("bigint").alias("rows_checked"),
                     F.col(f"v{i}").cast("bigint").alias("violations"),
                     F.format_string(f"%d rows violate rule '{r.name}' on '{r.field}'",
                                     F.col(f"v{i}")).alias("message"),
                     (F.col(f"v{i}") == 0).alias("passed"))
            for i, r in enumerate(rs)])).alias("r")).select("r.*")
        out = rows if out is None else out.unionByName(rows)
    return out


_DIGITS = "(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?"
_PLAIN, _NUMBER = f"[+-]?{_DIGITS}", f"[+]?(-?{_DIGITS})"


def _bound(pattern: str) -> str:
    """The number a range text has at the pattern's group; null where the text has another form."""
    return f"TRY_CAST(regexp_extract(NORMAL_RANGE, '^ *[(]? *{pattern} *[)]? *$', 1) AS DOUBLE)"


# A range text is 'lo-hi', '<hi', '<=hi', '>lo' or '>=lo', perhaps in
# parentheses; numbers may have a sign, no digit before the point, or an exponent.
_LOW, _HIGH = _bound(f"{_NUMBER} *- *{_PLAIN}"), _bound(f"{_PLAIN} *- *{_NUMBER}")
_BOUNDS = {f"VALUE < {_LOW}": _LOW, f"VALUE > {_HIGH}": _HIGH,
           **{f"VALUE {out} {_bound(f'{sign} *{_NUMBER}')}": _bound(f"{sign} *{_NUMBER}")
              for sign, out in (("<", ">="), ("<=", ">"), (">", "<="), (">=", "<"))}}
_OUT_OF_RANGE = "(" + " OR ".join(f"coalesce({test}, false)" for test in _BOUNDS) + ")"
_PARSED = "(" + " OR ".join(f"{bound} IS NOT NULL" for bound in _BOUNDS.values()) + ")"

# The default rules on RESPIRATORY results (value outside the
# normal range text, or an abnormal flag that contradicts it).
RESPIRATORY_RULES = [
    Rule("value_out_of_range", "RESPIRATORY", "VALUE", _OUT_OF_RANGE),
    Rule("abnormal_flag_contradiction", "RESPIRATORY", "ABNORMAL_IND",
         f"VALUE IS NOT NULL AND {_PARSED} AND (ABNORMAL_IND = 'Y') <> {_OUT_OF_RANGE}"),
    Rule("missing_result_value", "RESPIRATORY", "VALUE", "VALUE IS NULL", ERROR),
]
# Range texts that can't be read break neither rule; this one counts them.
UNREADABLE_RANGE = Rule("unreadable_normal_range", "RESPIRATORY", "NORMAL_RANGE", f"NORMAL_RANGE IS NOT NULL AND NOT {_PARSED}")

CLEAN, QUARANTINED = "clean", "quarantined"


def row_outcomes(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every row with ``broken_rules``: the names of the rules it breaks, in the order of ``rules``; none for a clean row.

    One projection: no pass per rule, no shuffle. A rule that can't be decided
    on a row (null) isn't broken by it.
    """
    each = ", ".join(f"CASE WHEN coalesce({r.violation}, false) THEN {sql_str(r.name)} END" for r in rules)
    broken = f"filter(array({each}), x -> x IS NOT NULL)" if rules else "CAST(array() AS array<string>)"
    return df.withColumn("broken_rules", F.expr(broken))


@dataclass(frozen=True)
class Outcome:
    clean: DataFrame
    quarantined: DataFrame
    clean_rows: int
    quarantined_rows: int
    by_rule: dict


def split_by_rules(df: DataFrame, rules: list[Rule], path: str) -> Outcome:
    """Write clean and quarantined rows to two folders under ``path`` in a single pass, and read both back.

    The rows' rules are evaluated once; counts come from an ``Observation`` of
    the same write. Quarantined rows keep ``broken_rules``.
    """
    spark = df.sparkSession
    seen = Observation(f"outcomes_{uuid.uuid4().hex}")
    none = F.size("broken_rules") == 0
    counts = [F.count_if(F.array_contains("broken_rules", r.name)).alias(f"r{i}") for i, r in enumerate(rules)]
    (row_outcomes(df, rules).withColumn("outcome", F.when(none, CLEAN).otherwise(QUARANTINED))
     .observe(seen, F.count_if(none).alias("clean"), F.count_if(~none).alias("bad"), *counts)
     .write.mode("overwrite").partitionBy("outcome").parquet(path))
    schema = T.StructType([*row_outcomes(df, rules).schema.fields, T.StructField("outcome", T.StringType())])
    # The schema is given, so a side without rows (and folder) reads as empty.
    back = spark.read.schema(schema).parquet(path)
    n = seen.get
    return Outcome(back.where(F.col("outcome") == CLEAN).drop("outcome", "broken_rules"),
                   back.where(F.col("outcome") == QUARANTINED).drop("outcome"), int(n["clean"]), int(n["bad"]),
                   {r.name: int(n[f"r{i}"]) for i, r in enumerate(rules)})
