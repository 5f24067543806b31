"""Reconciliation fixtures: a source projection of ``orders`` and five targets.

Each target is the whole source with a defined perturbation (changed
values, nulls, lost rows, extra rows, duplicated rows), so every check of
the reconciliation has a case where it must fail. The key predicates below
pick which rows are perturbed; no rows are sampled away from the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .testdata import read_table

# Target names and perturbation moduli.
TARGETS = ["T_SAME", "T_CHANGED", "T_NULLED", "T_LOSSY", "T_DUPED"]
CHANGE_MOD, DROP_MOD, COPY_MOD, DUP_MOD, COPY_OFFSET = 101, 97, 500, 250, 1000000


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("ORDER_ID"), F.col("o_custkey").alias("PATIENT_ID"),
                    F.col("o_orderstatus").alias("ST"))


def _changed(src: DataFrame, key: str, col: str, value) -> DataFrame:
    return src.withColumn(col, F.when(F.col(key) % CHANGE_MOD == 0, F.lit(value)).otherwise(F.col(col)))


def perturb(src: DataFrame, name: str, key: str, change_col: str, change_value) -> DataFrame:
    """Apply one named perturbation to any frame with an integer key."""
    if name == "T_SAME":
        return src
    if name == "T_CHANGED":
        return _changed(src, key, change_col, change_value)
    if name == "T_NULLED":
        return src.withColumn("PATIENT_ID", F.when(F.col(key) % CHANGE_MOD == 0, F.lit(None))
                              .otherwise(F.col("PATIENT_ID")))
    if name == "T_LOSSY":
        ch = _changed(src, key, change_col, change_value)
        kept = ch.where(F.col(key) % DROP_MOD != 0)
        extra = ch.where(F.col(key) % COPY_MOD == 0).withColumn(key, F.col(key) + COPY_OFFSET)
        return kept.unionByName(extra)
    if name == "T_DUPED":
        return src.unionByName(src.where(F.col(key) % DUP_MOD == 0))
    raise ValueError(name)


def targets(src: DataFrame) -> dict[str, DataFrame]:
    return {n: perturb(src, n, "ORDER_ID", "ST", "X") for n in TARGETS}


# Oracle SQL of the same fixtures (DuckDB), as CTE bodies.
SRC_SQL = "SELECT o_orderkey AS ORDER_ID, o_custkey AS PATIENT_ID, o_orderstatus AS ST FROM orders"


def target_sql(name: str, src: str = "SRC", key: str = "ORDER_ID", cols=("ORDER_ID", "PATIENT_ID", "ST"),
               change_col: str = "ST", change_value: str = "'X'") -> str:
    def changed():
        sel = ", ".join(f"CASE WHEN {key} % {CHANGE_MOD} = 0 THEN {change_value} ELSE {c} END AS {c}"
                        if c == change_col else c for c in cols)
        return f"SELECT {sel} FROM {src}"
    if name == "T_SAME":
        return f"SELECT * FROM {src}"
    if name == "T_CHANGED":
        return changed()
    if name == "T_NULLED":
        sel = ", ".join(f"CASE WHEN {key} % {CHANGE_MOD} = 0 THEN NULL ELSE {c} END AS {c}"
                        if c == "PATIENT_ID" else c for c in cols)
        return f"SELECT {sel} FROM {src}"
    if name == "T_LOSSY":
        ch = changed()
        extra_sel = ", ".join(f"{c} + {COPY_OFFSET} AS {c}" if c == key else c for c in cols)
        return (f"SELECT * FROM ({ch}) WHERE {key} % {DROP_MOD} <> 0 UNION ALL "
                f"SELECT {extra_sel} FROM ({ch}) WHERE {key} % {COPY_MOD} = 0")
    if name == "T_DUPED":
        return f"SELECT * FROM {src} UNION ALL SELECT * FROM {src} WHERE {key} % {DUP_MOD} = 0"
    raise ValueError(name)
