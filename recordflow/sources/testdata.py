"""Adapters from the driver's test tables to the 15 entities.

Each adapter is a base table, an optional row predicate and a list of
``expression AS column`` items written in SQL that both Spark and DuckDB
accept. Spark applies them with ``where`` + ``selectExpr`` on the Parquet
scan (so pruning and pushdown still reach the file); the DuckDB oracle
uses the same text as CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Adapter definitions (entity -> base table, filter, columns).
ADAPTERS: dict[str, tuple[str, str | None, list[tuple[str, str]]]] = {
    "ORDER_PROC": ("orders", None, [
        ("o_orderkey", "ORDER_ID"),
        ("o_custkey", "PATIENT_ID"),
        ("o_orderpriority", "ORDER_TYPE_CD"),
        ("o_orderstatus", "ORDER_STATUS_CD"),
        ("o_custkey % 100", "ORDERING_PROVIDER_ID"),
        ("o_orderdate", "ORDER_START_DT_TM"),
        ("o_orderdate + INTERVAL '7' DAY", "ORDER_END_DT_TM"),
        ("o_orderstatus", "RESULT_STATUS_CD"),
        ("o_orderdate", "UPDATE_DT_TM"),
    ]),
    "SPECIMEN": ("lineitem", None, [
        ("l_orderkey * 10 + l_linenumber", "SPECIMEN_ID"),
        ("l_orderkey", "ORDER_ID"),
        ("l_returnflag", "SPECIMEN_TYPE_CD"),
        ("l_shipdate", "COLLECT_DT_TM"),
        ("l_shipdate + INTERVAL '1' DAY", "RECEIVE_DT_TM"),
    ]),
    "RESPIRATORY": ("events", None, [
        ("event_id", "RESULT_ID"),
        ("user_id", "PATIENT_ID"),
        ("CASE WHEN event_type = 'purchase' THEN event_id END", "ORDER_ID"),
        ("event_type", "RESULT_TYPE_CD"),
        ("ts", "RESULT_DT_TM"),
        ("value", "VALUE"),
        ("'L/min'", "UNITS"),
        ("'0-100'", "NORMAL_RANGE"),
        ("CASE WHEN value > 100 THEN 'Y' ELSE 'N' END", "ABNORMAL_IND"),
    ]),
    "CLARITY_SER": ("region", None, [
        ("r_regionkey", "SER_ID"),
        ("r_name", "SER_NAME"),
        ("'REGION'", "SER_TYPE_CD"),
    ]),
    # Region 4's nations, 'A' lines and events other than errors point at
    # parents that aren't there, so joins keep unmatched rows on both sides.
    "CLARITY_DEP": ("nation", None, [
        ("n_nationkey", "DEP_ID"),
        ("n_name", "DEP_NAME"),
        ("'NATION'", "DEP_TYPE_CD"),
        ("CASE WHEN n_regionkey = 4 THEN 99 ELSE n_regionkey END", "SER_ID"),
    ]),
    "CLARITY_EMP": ("supplier", None, [
        ("s_suppkey", "EMP_ID"),
        ("s_name", "EMP_NAME"),
        ("'SUPPLIER'", "EMP_TYPE_CD"),
        ("s_nationkey", "DEP_ID"),
    ]),
    "PATIENT_VISIT": ("orders", None, [
        ("o_orderkey", "VISIT_ID"),
        ("o_custkey", "PATIENT_ID"),
        ("o_orderdate", "ADMIT_DT_TM"),
        ("CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '3' DAY END", "DISCH_DT_TM"),
        ("o_orderpriority", "VISIT_TYPE_CD"),
        ("o_orderstatus", "ACCOMMODATION_CD"),
    ]),
    "ORDER_REC": ("lineitem", "l_returnflag = 'N'", [
        ("l_orderkey * 10 + l_linenumber", "ORDER_ID"),
        ("l_orderkey", "VISIT_ID"),
        ("l_linestatus", "ORDER_STATUS_CD"),
    ]),
    "ORDER_MISC": ("lineitem", "l_returnflag <> 'N'", [
        ("l_orderkey * 10 + l_linenumber", "ORDER_MISC_ID"),
        ("CASE WHEN l_returnflag = 'R' THEN l_orderkey ELSE -1 - l_orderkey END", "VISIT_ID"),
        ("l_linestatus", "MISC_TYPE_CD"),
    ]),
    "PATIENT": ("customer", None, [
        ("c_custkey", "PATIENT_ID"),
        ("substr(c_name, 1, 8)", "FIRST_NAME"),
        ("substr(c_name, 10)", "LAST_NAME"),
        ("CAST('1950-01-01' AS DATE) + CAST(c_custkey % 20000 AS INT)", "DOB"),
        ("CASE WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' END", "SEX_CD"),
        ("c_mktsegment", "MARITAL_STATUS_CD"),
        ("c_name", "ADDRESS_LINE_1"),
        ("n_name", "CITY"),
        ("r_name", "STATE_CD"),
        ("CAST(c_nationkey AS STRING)", "ZIP_CD"),
    ]),
    "PATIENT_ALLERGY": ("events", None, [
        ("event_id", "ALLERGY_ID"),
        ("CASE WHEN event_type = 'error' THEN user_id ELSE -1 - user_id END", "PATIENT_ID"),
        ("event_type", "ALLERGY_TYPE_CD"),
        ("props", "ALLERGY_CD"),
        ("CASE WHEN value > 100 THEN 'SEVERE' ELSE 'MILD' END", "SEVERITY_CD"),
    ]),
    "PATIENT_DIAGNOSIS": ("orders", None, [
        ("o_orderkey", "DIAGNOSIS_ID"),
        ("o_custkey", "PATIENT_ID"),
        ("o_orderpriority", "DIAGNOSIS_CD"),
        ("o_orderstatus", "DIAGNOSIS_TYPE_CD"),
        ("o_orderdate", "ONSET_DT_TM"),
    ]),
    "ACCOUNT": ("orders", None, [
        ("o_orderkey", "ACCOUNT_ID"),
        ("o_custkey", "PATIENT_ID"),
        ("o_orderpriority", "ACCOUNT_TYPE_CD"),
        ("o_orderstatus", "ACCOUNT_STATUS_CD"),
        ("CAST(o_totalprice AS DECIMAL(18,2))", "BALANCE_AMT"),
        ("o_orderdate", "CREATE_DT_TM"),
    ]),
    "PB_AR": ("lineitem", "l_linestatus = 'O'", [
        ("l_orderkey * 10 + l_linenumber", "AR_ID"),
        ("l_orderkey", "ACCOUNT_ID"),
        ("l_returnflag", "AR_TYPE_CD"),
        ("CAST(l_extendedprice AS DECIMAL(18,2))", "AMOUNT"),
    ]),
    "GB_PAYMENT": ("lineitem", "l_linestatus = 'F'", [
        ("l_orderkey * 10 + l_linenumber", "PAYMENT_ID"),
        ("l_orderkey", "ACCOUNT_ID"),
        ("l_shipdate", "PAYMENT_DT_TM"),
        ("CAST(l_extendedprice AS DECIMAL(18,2))", "PAYMENT_AMT"),
        ("l_returnflag", "PAYMENT_METHOD_CD"),
    ]),
}

# PATIENT reads customer joined to nation and region (small dimension sides).
_PATIENT_FROM_SQL = (
    "customer LEFT JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey"
)

# Change-time column per entity for incremental pulls on the test tables.
CHANGE_COLUMNS: dict[str, str] = {
    "ORDER_PROC": "UPDATE_DT_TM",
    "SPECIMEN": "COLLECT_DT_TM",
    "RESPIRATORY": "RESULT_DT_TM",
    "PATIENT_VISIT": "ADMIT_DT_TM",
    "PATIENT_DIAGNOSIS": "ONSET_DT_TM",
    "ACCOUNT": "CREATE_DT_TM",
    "GB_PAYMENT": "PAYMENT_DT_TM",
}


# Narrow parameters of each extract, beside the whole-table ones.
EXTRACT_WINDOWS: dict[str, dict] = {
    "extract_orders_psd": {"start_date": "1998-01-01", "end_date": "1999-01-01"},
    "extract_respiratory_results": {"start_date": "2024-01-08", "end_date": "2024-01-15"},
    "extract_organizational_hierarchy": {"start_ser_id": 1},
    "extract_visit_encounters": {"start_date": "1998-01-01", "end_date": "1999-01-01"},
    "extract_patient_demographics": {"start_patient_id": 100},
    "extract_billing_accounts": {"start_date": "1998-01-01", "end_date": "1999-01-01"},
}


# The driver's test tables are read-only, so each one is listed and its
# schema read once per session (the library's own scans never cache: real
# incremental sources grow between runs).
_TABLES: dict[tuple[int, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def entity(spark: SparkSession, sf_dir: str, name: str, _reads: dict | None = None) -> DataFrame:
    """One entity as a DataFrame over the test Parquet files.

    ``_reads`` shares base-table frames between entities built together, so
    each file is listed and its schema read once.
    """
    base, where, cols = ADAPTERS[name]
    reads = _reads if _reads is not None else {}

    def rd(t):
        if t not in reads:
            reads[t] = read_table(spark, sf_dir, t)
        return reads[t]

    if name == "PATIENT":
        c = rd("customer")
        n = rd("nation")
        r = rd("region")
        # nation/region are fixed-size dimensions (25 / 5 rows by definition
        # of the schema); Spark's size check broadcasts them.
        df = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
               .join(r, n.n_regionkey == r.r_regionkey, "left"))
    else:
        df = rd(base)
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{e} AS {a}" for e, a in cols])


def adapt(df: DataFrame, name: str) -> DataFrame:
    """Apply a single-table adapter to a frame of its base table (batch or stream)."""
    base, where, cols = ADAPTERS[name]
    if name == "PATIENT":
        raise ValueError("PATIENT reads three tables; use entity()")
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{e} AS {a}" for e, a in cols])


def entities(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    reads: dict[str, DataFrame] = {}
    return {n: entity(spark, sf_dir, n, reads) for n in (names or ADAPTERS)}


def adapter_sql(name: str) -> str:
    """The adapter as one SELECT (DuckDB / Spark SQL)."""
    base, where, cols = ADAPTERS[name]
    src = _PATIENT_FROM_SQL if name == "PATIENT" else base
    sel = ", ".join(f"{e} AS {a}" for e, a in cols)
    return f"SELECT {sel} FROM {src}" + (f" WHERE {where}" if where else "")


def with_entities(sql: str, names: list[str]) -> str:
    """Prefix ``sql`` with CTEs defining the named entities."""
    ctes = ",\n".join(f"{n} AS ({adapter_sql(n)})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
