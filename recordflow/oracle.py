"""DuckDB oracle SQL for every registered query that SQL can express.

Each text starts from the driver's base tables; the entity adapters are
prepended as CTEs (``testdata.with_entities``). Column names equal those
of the Spark results.
"""

from __future__ import annotations

from .entities import EDGES, KEYS, RECON_NULL_FIELDS, REQUIRED_FIELDS, VALIDATION_NULL_FIELDS
from .plans.catalog import EXTRACTS, extract_sql
from .sources import recon_fixtures as RFX
from .sources.testdata import ADAPTERS, CHANGE_COLUMNS, EXTRACT_WINDOWS, adapter_sql
from .sources.testdata import with_entities as W

TS_LO = "TIMESTAMP '1900-01-01 00:00:00'"
TS_HI = "TIMESTAMP '2100-01-01 00:00:00'"

ORACLE: dict[str, str] = {}

# Query key and extract name.
EXTRACT_KEYS = [("extract_orders", "extract_orders_psd"), ("extract_respiratory", "extract_respiratory_results"),
                ("extract_org", "extract_organizational_hierarchy"), ("extract_visits", "extract_visit_encounters"),
                ("extract_patients", "extract_patient_demographics"), ("extract_billing", "extract_billing_accounts")]


def _extract(name: str, values: dict) -> str:
    d = EXTRACTS[name]
    literal = {p: str(v) if isinstance(v, int) else f"TIMESTAMP '{v}'" for p, v in values.items()}
    return W(extract_sql(d, literal), list(d.entities))


for _key, _name in EXTRACT_KEYS:
    _whole = {"start_date": "1900-01-01 00:00:00", "end_date": "2100-01-01 00:00:00"}
    ORACLE[_key] = _extract(_name, {p: _whole.get(p, 0) for p in EXTRACTS[_name].params})
    ORACLE[f"{_key}_window"] = _extract(_name, EXTRACT_WINDOWS[_name])
ORACLE["extract_orders_sql"] = ORACLE["extract_orders"]
ORACLE["extract_patients_salted"] = ORACLE["extract_patients"]

ORACLE["billing_totals"] = W(f"""
SELECT a.ACCOUNT_ID, a.PATIENT_ID, a.BALANCE_AMT,
       CAST(coalesce(ar.t, 0) AS DECIMAL(38,2)) AS AR_TOTAL,
       CAST(coalesce(ar.n, 0) AS BIGINT) AS AR_ROWS,
       CAST(coalesce(py.t, 0) AS DECIMAL(38,2)) AS PAID_TOTAL,
       CAST(coalesce(py.n, 0) AS BIGINT) AS PAYMENT_ROWS
FROM ACCOUNT a
LEFT JOIN (SELECT ACCOUNT_ID, sum(AMOUNT) AS t, count(*) AS n FROM PB_AR GROUP BY ACCOUNT_ID) ar
       ON a.ACCOUNT_ID = ar.ACCOUNT_ID
LEFT JOIN (SELECT ACCOUNT_ID, sum(PAYMENT_AMT) AS t, count(*) AS n FROM GB_PAYMENT GROUP BY ACCOUNT_ID) py
       ON a.ACCOUNT_ID = py.ACCOUNT_ID
WHERE a.CREATE_DT_TM >= {TS_LO} AND a.CREATE_DT_TM < {TS_HI}
""", ["ACCOUNT", "PB_AR", "GB_PAYMENT"])

ORACLE["run_extracts"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS extract_name, '{EXTRACTS[n].schema}' AS schema_group, 'success' AS status, "
    f"(SELECT count(*) FROM ({ORACLE[k]})) AS row_count" for k, n in EXTRACT_KEYS)



def _order_sql(key: str, name: str) -> str:
    d = EXTRACTS[name]
    ids = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in d.sort if c.endswith("_ID"))
    sort = ", ".join(f"{c} NULLS LAST" for c in d.sort)
    return f"SELECT '{name}' AS extract_name, row_number() OVER (ORDER BY {sort}) AS position, {ids} AS ids FROM ({ORACLE[key]})"


ORACLE["extract_order"] = "\nUNION ALL\n".join(_order_sql(k, n) for k, n in EXTRACT_KEYS if k in ("extract_orders", "extract_org", "extract_patients"))

ORACLE["extract_resume"] = ORACLE["extract_orders"]
_TWO_OF_FOUR = "SELECT min(u) + (max(u) - min(u) + 1) * 2 // 4 FROM (SELECT epoch_us(o_orderdate) AS u FROM orders)"
ORACLE["extract_runs"] = f"""
SELECT 'extract_orders_psd' AS name, 'partial' AS status, count(*) AS rows, CAST(4 AS BIGINT) AS chunks, CAST(2 AS BIGINT) AS chunks_made,
       TRUE AS published, FALSE AS has_error, TRUE AS timed
FROM ({ORACLE["extract_orders"]}) WHERE epoch_us(ORDER_START_DT_TM) < ({_TWO_OF_FOUR})
UNION ALL SELECT 'extract_orders_psd', 'success', count(*), 4, 2, TRUE, FALSE, TRUE FROM ({ORACLE["extract_orders"]})
UNION ALL SELECT 'extract_respiratory_results', 'success', count(*), NULL, NULL, TRUE, FALSE, TRUE FROM ({ORACLE["extract_respiratory"]})
UNION ALL SELECT 'extract_respiratory_results', 'failed', 0, NULL, NULL, FALSE, TRUE, TRUE"""


# ------------------------------------------------------------------ quality

ALL = list(ADAPTERS)
# (label, entity contract, CTE name, columns)
_BATCHES = [(n, n, n, [a for _, a in ADAPTERS[n][2]]) for n in ALL] + [
    ("ORDER_PROC/ids_only", "ORDER_PROC", "ORDER_PROC_IDS", ["ORDER_ID", "PATIENT_ID"])]


def _q(sql: str) -> str:
    ctes = ",\n".join(f"{n} AS ({adapter_sql(n)})" for n in ALL)
    ctes += ",\nORDER_PROC_IDS AS (SELECT ORDER_ID, PATIENT_ID FROM ORDER_PROC)"
    return f"WITH {ctes}\n{sql}"


def _nullcnt(f: str, cols: list[str]) -> str:
    return f"count(*) FILTER (WHERE {f} IS NULL)" if f in cols else "count(*)"


def _missing(ent: str, cols: list[str]) -> list[str]:
    return [f for f in REQUIRED_FIELDS.get(ent, []) if f not in cols]


ORACLE["validate_schema"] = _q("\nUNION ALL\n".join(
    f"SELECT '{lab}' AS entity_name, (count(*) = 0 OR {str(not _missing(ent, cols)).upper()}) AS passed, "
    f"count(*) AS rows_checked, "
    f"CAST(CASE WHEN count(*) > 0 THEN {len(_missing(ent, cols))} ELSE 0 END AS BIGINT) AS issues_found, "
    f"'{','.join(_missing(ent, cols))}' AS missing_fields FROM {cte}"
    for lab, ent, cte, cols in _BATCHES))

ORACLE["validate_nulls"] = _q("\nUNION ALL\n".join(
    f"SELECT '{lab}' AS entity_name, 'warning' AS level, 'null_check' AS validation_type, "
    f"'{f}' AS field_name, printf('%d null values found in ''{f}''', n) AS message, "
    f"CAST(n AS BIGINT) AS row_count FROM (SELECT {_nullcnt(f, cols)} AS n FROM {cte}) WHERE n > 0"
    for lab, ent, cte, cols in _BATCHES for f in VALIDATION_NULL_FIELDS))


def _keytext(k: str, cols: list[str]) -> str:
    return f"CAST({k} AS VARCHAR)" if k in cols else "''"


ORACLE["validate_duplicates"] = _q("\nUNION ALL\n".join(
    f"SELECT '{n}' AS entity_name, '{KEYS[n]}' AS key_field, "
    f"CAST(coalesce(sum(v - 1) FILTER (WHERE v > 1), 0) AS BIGINT) AS surplus_rows, "
    f"CAST(count(*) FILTER (WHERE v > 1) AS BIGINT) AS duplicate_keys, "
    f"count(*) FILTER (WHERE v > 1) = 0 AS passed "
    f"FROM (SELECT {_keytext(KEYS[n], [a for _, a in ADAPTERS[n][2]])} AS k, count(*) AS v FROM {n} GROUP BY 1)"
    for n in ALL))


def _va_parts(lab, ent, cte, cols):
    k = KEYS[ent]
    miss = _missing(ent, cols)
    nulls = ", ".join(f"{_nullcnt(f, cols)} AS n{i}" for i, f in enumerate(VALIDATION_NULL_FIELDS))
    prof = (f"(SELECT count(*) AS rows, {nulls} FROM {cte}) p, "
            f"(SELECT count(*) FILTER (WHERE v > 1) AS dk, coalesce(sum(v - 1) FILTER (WHERE v > 1), 0) AS sr "
            f"FROM (SELECT {_keytext(k, cols)} AS kk, count(*) AS v FROM {cte} GROUP BY 1)) d")
    return k, miss, prof


def _va_summary(lab, ent, cte, cols):
    k, miss, prof = _va_parts(lab, ent, cte, cols)
    errs = f"(CASE WHEN rows > 0 THEN {len(miss)} ELSE 0 END)"
    warns = " + ".join([f"(CASE WHEN n{i} > 0 THEN 1 ELSE 0 END)" for i in range(len(VALIDATION_NULL_FIELDS))]
                       + ["(CASE WHEN dk > 0 THEN 1 ELSE 0 END)"])
    return (f"SELECT '{lab}' AS entity_name, ({errs} + {warns}) = 0 AS passed, CAST(rows AS BIGINT) AS rows_checked, "
            f"CAST({errs} + {warns} AS BIGINT) AS issues_found, CAST({errs} AS BIGINT) AS errors, "
            f"CAST({warns} AS BIGINT) AS warnings FROM {prof}")


def _va_issues(lab, ent, cte, cols):
    k, miss, prof = _va_parts(lab, ent, cte, cols)
    parts = [f"SELECT '{lab}' AS entity_name, 'error' AS level, 'schema' AS validation_type, '{f}' AS field_name, "
             f"'Required field ''{f}'' missing from {ent}' AS message, CAST(rows AS BIGINT) AS row_count "
             f"FROM {prof} WHERE rows > 0" for f in miss]
    parts += [f"SELECT '{lab}' AS entity_name, 'warning' AS level, 'null_check' AS validation_type, "
              f"'{f}' AS field_name, printf('%d null values found in ''{f}''', n{i}) AS message, "
              f"CAST(n{i} AS BIGINT) AS row_count FROM {prof} WHERE n{i} > 0"
              for i, f in enumerate(VALIDATION_NULL_FIELDS)]
    parts.append(f"SELECT '{lab}' AS entity_name, 'warning' AS level, 'duplicate' AS validation_type, "
                 f"'{k}' AS field_name, printf('%d duplicate key values in ''{k}''', sr) AS message, "
                 f"CAST(sr AS BIGINT) AS row_count FROM {prof} WHERE dk > 0")
    return "\nUNION ALL\n".join(parts)


ORACLE["validate_all"] = _q("\nUNION ALL\n".join(_va_summary(*b) for b in _BATCHES))
ORACLE["validate_all_issues"] = _q("\nUNION ALL\n".join(_va_issues(*b) for b in _BATCHES))

ORACLE["validate_referential"] = _q("\nUNION ALL\n".join(
    f"SELECT '{e.child}' AS entity_name, '{e.fk}' AS field_name, '{e.parent}' AS parent_entity, "
    f"'{e.pk}' AS parent_key, (SELECT count(*) FROM {e.child}) AS child_rows, "
    f"CAST(count(*) AS BIGINT) AS orphan_rows, CAST(count(DISTINCT c.{e.fk}) AS BIGINT) AS orphan_keys, "
    f"CASE WHEN count(*) > 0 THEN 'error' ELSE 'info' END AS level, 'referential' AS validation_type, "
    f"count(*) = 0 AS passed "
    f"FROM {e.child} c WHERE c.{e.fk} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {e.parent} p WHERE p.{e.pk} = c.{e.fk})"
    for e in EDGES))


def _rules_sql():
    from .operators.quality import RESPIRATORY_RULES
    return _q("\nUNION ALL\n".join(
        f"SELECT '{r.entity}' AS entity_name, '{r.name}' AS rule_name, '{r.field}' AS field_name, "
        f"'{r.level}' AS level, 'clinical' AS validation_type, count(*) AS rows_checked, "
        f"CAST(count(*) FILTER (WHERE coalesce({r.violation}, false)) AS BIGINT) AS violations, "
        f"printf('%d rows violate rule ''{r.name}'' on ''{r.field}''', "
        f"count(*) FILTER (WHERE coalesce({r.violation}, false))) AS message, "
        f"count(*) FILTER (WHERE coalesce({r.violation}, false)) = 0 AS passed FROM {r.entity}"
        for r in RESPIRATORY_RULES))


ORACLE["validate_rules"] = _rules_sql()


# What breaks the range of each form that the results are dealt, in the order of ``queries.RANGE_FORMS``; None: unreadable.
_BROKEN = ["VALUE < 0 OR VALUE > 100", "VALUE >= 50", "VALUE > 50", "VALUE <= 10", "VALUE < 10", "VALUE < -5 OR VALUE > 10",
           "VALUE < -5 OR VALUE > -1", "VALUE < 1.5 OR VALUE > 200", "VALUE < 0.5 OR VALUE > 1", "VALUE < 10 OR VALUE > 200",
           "VALUE < 1 OR VALUE > 150", "VALUE < 1 OR VALUE > 50", None, None, None, None]
_NO_TEXT = 13  # the form without a text


def _range_case(then) -> str:
    return f"CASE RESULT_ID % {len(_BROKEN)} " + " ".join(f"WHEN {i} THEN {then(i, b)}" for i, b in enumerate(_BROKEN)) + " END"


ORACLE["quarantine_rows"] = W(f"""
, R AS (SELECT RESULT_ID, ABNORMAL_IND, CASE WHEN RESULT_ID % 50 <> 0 THEN VALUE END AS VALUE FROM RESPIRATORY),
B AS (SELECT *, coalesce({_range_case(lambda i, b: f"({b})" if b else "FALSE")}, FALSE) AS out_of_range,
             {_range_case(lambda i, b: str(b is not None).upper())} AS readable,
             {_range_case(lambda i, b: str(b is None and i != _NO_TEXT).upper())} AS unreadable FROM R),
L AS (SELECT RESULT_ID, concat_ws(',', CASE WHEN out_of_range THEN 'value_out_of_range' END,
             CASE WHEN VALUE IS NOT NULL AND readable AND (ABNORMAL_IND = 'Y') <> out_of_range THEN 'abnormal_flag_contradiction' END,
             CASE WHEN VALUE IS NULL THEN 'missing_result_value' END, CASE WHEN unreadable THEN 'unreadable_normal_range' END) AS broken_rules FROM B)
SELECT RESULT_ID, CASE WHEN broken_rules = '' THEN 'clean' ELSE 'quarantined' END AS outcome, broken_rules FROM L
""", ["RESPIRATORY"]).replace("\n, R AS", ",\nR AS")


# ----------------------------------------------------------- reconciliation

_RECON_COLS = [("ORDER_ID", "int"), ("PATIENT_ID", "int"), ("ST", "str")]


def duck_text(c: str, kind: str) -> str:
    """DuckDB twin of ``functions.columns.canonical_text``."""
    if kind == "double":
        t = f"coalesce(CAST(TRY_CAST({c} AS DECIMAL(38,9)) AS VARCHAR), CAST({c} AS VARCHAR))"
    elif kind == "ts":
        t = f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
    else:
        t = f"CAST({c} AS VARCHAR)"
    return f"coalesce(replace(replace({t}, '\\', '\\\\'), '|', '\\|'), '\\N')"


def duck_row_text(cols) -> str:
    return "concat_ws('|', " + ", ".join(duck_text(c, k) for c, k in sorted(cols)) + ")"


def duck_lanes(digest: str) -> str:
    lanes = [f"CAST(coalesce(sum(CAST(('0x' || substr({digest}, {p}, 8)) AS BIGINT)), 0) AS VARCHAR)"
             for p in (1, 9, 17, 25)]
    return "CAST(count(*) AS VARCHAR) || ':' || " + " || ':' || ".join(lanes)


def _recon_ctes() -> str:
    ctes = [f"SRC AS ({RFX.SRC_SQL})"] + [f"{n} AS ({RFX.target_sql(n)})" for n in RFX.TARGETS]
    return "WITH " + ",\n".join(ctes) + "\n"


def _profile_sql(t: str) -> str:
    fields = RECON_NULL_FIELDS
    present = [c for c, _ in _RECON_COLS]
    nulls = ", ".join(f"{_nullcnt(f, present)} AS n{i}" for i, f in enumerate(fields))
    return (f"(SELECT count(*) AS rows, {nulls}, {duck_lanes('md5(' + duck_row_text(_RECON_COLS) + ')')} AS fp, "
            f"(SELECT count(*) FROM (SELECT CAST(ORDER_ID AS VARCHAR) FROM {t} GROUP BY 1 HAVING count(*) > 1)) AS dk "
            f"FROM {t})")


def _recon_wide(select: str) -> str:
    return _recon_ctes() + "\nUNION ALL\n".join(
        f"SELECT {select.format(name=n)} FROM {_profile_sql('SRC')} s, {_profile_sql(n)} t" for n in RFX.TARGETS)


_NULL_OK = " AND ".join(f"s.n{i} = t.n{i}" for i in range(len(RECON_NULL_FIELDS)))
_FAILED = " + ".join([
    "(CASE WHEN s.rows = t.rows THEN 0 ELSE 1 END)", "(CASE WHEN s.fp = t.fp THEN 0 ELSE 1 END)"]
    + [f"(CASE WHEN s.n{i} = t.n{i} THEN 0 ELSE 1 END)" for i in range(len(RECON_NULL_FIELDS))]
    + ["(CASE WHEN s.dk = t.dk THEN 0 ELSE 1 END)"])

ORACLE["recon_row_counts"] = _recon_wide(
    "'{name}' AS entity_name, s.rows AS source_count, t.rows AS target_count, "
    "s.rows - t.rows AS difference, s.rows = t.rows AS row_count_match")
ORACLE["recon_checksum"] = _recon_wide(
    "'{name}' AS entity_name, s.fp AS source_checksum, t.fp AS target_checksum, s.fp = t.fp AS checksum_match")
ORACLE["recon_duplicates"] = _recon_wide(
    "'{name}' AS entity_name, 'ORDER_ID' AS key_field, s.dk AS source_duplicates, "
    "t.dk AS target_duplicates, s.dk = t.dk AS duplicates_match")
ORACLE["recon_report"] = _recon_wide(
    "'{name}' AS entity_name, (" + _FAILED + ") = 0 AS overall_match, CAST(" + _FAILED + " AS BIGINT) AS issues_found, "
    "s.rows = t.rows AS row_count_match, s.fp = t.fp AS checksum_match, (" + _NULL_OK + ") AS null_checks_match, "
    "s.dk = t.dk AS duplicates_match")
ORACLE["recon_nulls"] = _recon_ctes() + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS entity_name, '{f}' AS field_name, s.n{i} AS source_null_count, "
    f"t.n{i} AS target_null_count, s.n{i} = t.n{i} AS match "
    f"FROM {_profile_sql('SRC')} s, {_profile_sql(n)} t"
    for n in RFX.TARGETS for i, f in enumerate(RECON_NULL_FIELDS))


def _ordered_fp(t: str) -> str:
    dg = "md5(" + duck_row_text(_RECON_COLS) + ")"
    return (f"(SELECT {duck_lanes('md5(CAST(pos AS VARCHAR) || \':\' || dg)')} AS fp FROM "
            f"(SELECT dg, row_number() OVER (ORDER BY ORDER_ID, dg) AS pos FROM "
            f"(SELECT ORDER_ID, {dg} AS dg FROM {t})))")


ORACLE["recon_checksum_ordered"] = _recon_ctes() + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS entity_name, s.fp AS source_checksum, t.fp AS target_checksum, "
    f"s.fp = t.fp AS checksum_match FROM {_ordered_fp('SRC')} s, {_ordered_fp(n)} t" for n in RFX.TARGETS)

_TS_COLS = {"ORDER_START_DT_TM", "ORDER_END_DT_TM", "UPDATE_DT_TM", "COLLECT_DT_TM", "RECEIVE_DT_TM",
            "RESULT_DT_TM", "ADMIT_DT_TM", "DISCH_DT_TM", "ONSET_DT_TM", "CREATE_DT_TM", "PAYMENT_DT_TM"}
_DOUBLE_COLS = {"VALUE"}


def _entity_cols(ent: str):
    return [(a, "ts" if a in _TS_COLS else "double" if a in _DOUBLE_COLS else "v") for _, a in ADAPTERS[ent][2]]


def _entity_recon(ent: str) -> str:
    cols = _entity_cols(ent)
    names = [c for c, _ in cols]
    k = KEYS[ent]
    fp = duck_lanes("md5(" + duck_row_text(cols) + ")")
    nulls_ok = " AND ".join("TRUE" for _ in RECON_NULL_FIELDS)
    return (f"SELECT '{ent}' AS entity_name, count(*) AS source_count, count(*) AS target_count, "
            f"{fp} AS source_checksum, {fp} AS target_checksum, "
            f"(SELECT count(*) FROM (SELECT {k} FROM {ent} GROUP BY {k} HAVING count(*) > 1)) AS source_duplicates, "
            f"{nulls_ok} AS overall_match, CAST(0 AS BIGINT) AS issues_found FROM {ent}")


ORACLE["recon_entities"] = _q("\nUNION ALL\n".join(_entity_recon(e) for e in ALL))


def _side_sql(table: str, cols) -> str:
    present = [c for c, _ in cols]
    nulls = ", ".join(f"{_nullcnt(f, present)} AS n{i}" for i, f in enumerate(RECON_NULL_FIELDS))
    return f"SELECT count(*) AS rows, {nulls}, {duck_lanes('md5(' + duck_row_text(cols) + ')')} AS fp FROM {table}"


# Landed tables: the entity with one column stored otherwise, rows lost, or rows repeated.
_LANDED = {"ORDER_PROC": "SELECT * FROM ORDER_PROC",
           "RESPIRATORY": "SELECT * REPLACE (CAST(floor(VALUE) AS DOUBLE) AS VALUE) FROM RESPIRATORY",
           "ACCOUNT": "SELECT * REPLACE (CAST(BALANCE_AMT AS DECIMAL(18,1)) AS BALANCE_AMT) FROM ACCOUNT",
           "SPECIMEN": "SELECT * FROM SPECIMEN WHERE SPECIMEN_ID % 97 <> 0",
           "GB_PAYMENT": "SELECT * FROM GB_PAYMENT UNION ALL SELECT * FROM GB_PAYMENT WHERE PAYMENT_ID % 50 = 0"}


def _landing_sql(ent: str) -> str:
    cols, k = _entity_cols(ent), KEYS[ent]
    def dups(t):
        return f"(SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)) AS dk"
    failed = _FAILED.replace("s.", "a.").replace("t.", "b.")
    return (f"SELECT '{ent}' AS entity_name, a.rows AS source_count, b.rows AS target_count, a.fp AS source_checksum, b.fp AS target_checksum, "
            f"a.dk AS source_duplicates, b.dk AS target_duplicates, ({failed}) = 0 AS overall_match, CAST({failed} AS BIGINT) AS issues_found "
            f"FROM (SELECT *, {dups(ent)} FROM ({_side_sql(ent, cols)})) a, (SELECT *, {dups('L_' + ent)} FROM ({_side_sql('L_' + ent, cols)})) b")


ORACLE["recon_landing"] = W("WITH " + ",\n".join(f"L_{e} AS ({sql})" for e, sql in _LANDED.items()) + "\n"
                            + "\nUNION ALL\n".join(_landing_sql(e) for e in _LANDED), list(_LANDED))


def _tree_sql(name: str) -> str:
    fp = duck_lanes("md5(" + duck_row_text(_RECON_COLS) + ")")
    base = f"(SELECT min(k) FROM (SELECT ORDER_ID AS k FROM SRC UNION ALL SELECT ORDER_ID FROM {name}))"
    def cells(t):
        return f"(SELECT (ORDER_ID - {base}) // 64 AS c, count(*) AS n, {fp} AS fp FROM {t} GROUP BY 1)"
    return (f"SELECT '{name}' AS entity_name, {base} + c * 64 AS range_lo, {base} + c * 64 + 63 AS range_hi, "
            f"coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows "
            f"FROM {cells('SRC')} s FULL OUTER JOIN {cells(name)} t USING (c) WHERE s.fp IS DISTINCT FROM t.fp")


ORACLE["recon_digest_tree"] = _recon_ctes() + "\nUNION ALL\n".join(_tree_sql(n) for n in RFX.TARGETS)

_OFF = "CASE WHEN VALUE > 1 AND VALUE < 50 THEN VALUE + CAST(1e-10 AS DOUBLE) ELSE VALUE END"
ORACLE["recon_precision"] = W("\nUNION ALL\n".join(
    f"SELECT '{n}' AS entity_name, count(*) AS source_count, count(*) AS target_count, "
    f"bool_and({v} IS NOT DISTINCT FROM VALUE) AS checksum_match, bool_and({v} IS NOT DISTINCT FROM VALUE) AS overall_match "
    f"FROM RESPIRATORY" for n, v in [("EQUAL", "VALUE"), ("OFF_BY_1E-10", _OFF)]), ["RESPIRATORY"])

_ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORACLE["recon_row_diff"] = (
    "WITH S AS (SELECT * FROM orders), T AS ("
    + RFX.target_sql("T_LOSSY", src="S", key="o_orderkey", cols=_ORD_COLS, change_col="o_orderstatus")
    + ")\nSELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, "
    "CASE WHEN s.o_orderkey IS NULL THEN 'source_missing' WHEN t.o_orderkey IS NULL THEN 'target_missing' "
    "WHEN " + " AND ".join(f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in _ORD_COLS[1:])
    + " THEN 'match' ELSE 'mismatch' END AS status, "
    "CAST(CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS source_rows, "
    "CAST(CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS target_rows "
    "FROM S s FULL OUTER JOIN T t ON s.o_orderkey = t.o_orderkey")

_DIFF_KINDS = {"o_totalprice": "double", "o_orderdate": "ts"}


def _plain_value(c: str) -> str:
    text = duck_text(c, _DIFF_KINDS.get(c, "v"))
    return text[len("coalesce(replace(replace("):text.index(", '\\', ")]  # without the escapes of the joined row text


_VALUES = "\nUNION ALL\n".join(f"SELECT o_orderkey, '{c}' AS column_name, {_plain_value(c)} AS v, {n} AS n FROM {t}"
                               for c in _ORD_COLS[1:] for t, n in (("S", 1), ("T", -1)))
ORACLE["recon_column_diff"] = (
    "WITH S AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 250 = 0), T0 AS ("
    + RFX.target_sql("T_LOSSY", src="orders", key="o_orderkey", cols=_ORD_COLS, change_col="o_orderstatus")
    + "), T1 AS (SELECT * REPLACE (CASE WHEN o_orderkey % 89 <> 0 THEN o_totalprice END AS o_totalprice) FROM T0), "
    "T AS (SELECT * FROM T1 UNION ALL SELECT * REPLACE (o_custkey + 1 AS o_custkey) FROM T1 WHERE o_orderkey % 303 = 0), "
    f"V AS (SELECT o_orderkey, column_name, v, sum(n) AS n FROM ({_VALUES}) "
    "WHERE o_orderkey IN (SELECT o_orderkey FROM S) AND o_orderkey IN (SELECT o_orderkey FROM T) GROUP BY ALL HAVING sum(n) <> 0)\n"
    "SELECT o_orderkey, column_name, min(v) FILTER (WHERE n > 0) AS source_text, min(v) FILTER (WHERE n < 0) AS target_text, "
    "CAST(sum(greatest(n, 0)) AS BIGINT) AS source_rows, CAST(sum(greatest(-n, 0)) AS BIGINT) AS target_rows FROM V GROUP BY ALL")
ORACLE["recon_column_counts"] = (
    "SELECT column_name, count(*) AS keys, count(*) FILTER (WHERE source_text IS NOT NULL AND target_text IS NULL) AS to_null, "
    "count(*) FILTER (WHERE source_text IS NULL AND target_text IS NOT NULL) AS from_null "
    f"FROM ({ORACLE['recon_column_diff']}) GROUP BY column_name")

_PCT = ("25.0 * ((CASE WHEN row_count_match THEN 1 ELSE 0 END) + (CASE WHEN checksum_match THEN 1 ELSE 0 END) "
        "+ (CASE WHEN null_checks_match THEN 1 ELSE 0 END) + (CASE WHEN duplicates_match THEN 1 ELSE 0 END))")


def _band(x: str) -> str:
    return (f"CASE WHEN {x} = 100 THEN 'excellent' WHEN {x} >= 75 THEN 'good' "
            f"WHEN {x} >= 50 THEN 'fair' ELSE 'poor' END")


_SCORES = ("SELECT entity_name, " + _band(_PCT) + " AS quality_score, row_count_match, checksum_match, "
           "null_checks_match AS null_check_pass, duplicates_match AS duplicate_check_pass, "
           "CAST(" + _PCT + " AS DOUBLE) AS overall_percentage FROM (" + ORACLE["recon_report"].replace(
               _recon_ctes(), "") + ")")
ORACLE["scorecard_entity"] = _recon_ctes() + _SCORES
ORACLE["scorecard_overall"] = (
    _recon_ctes() + "SELECT " + _band("p") + " AS overall_score, round(p, 6) AS overall_percentage, "
    "total_entities, entities_passing FROM (SELECT CAST(coalesce(avg(overall_percentage), 0) AS DOUBLE) AS p, "
    "count(*) AS total_entities, count(*) FILTER (WHERE quality_score IN ('excellent', 'good')) AS entities_passing "
    "FROM (" + _SCORES + "))")


# ------------------------------------------------------------------ exports
RUN_TS_SQL = "TIMESTAMP '2024-01-01 00:00:00'"
RUN_ID = "rf-run"


def duck_plain(c: str, kind: str) -> str:
    """Python ``str()`` text of a value (timestamps without zero fraction)."""
    if kind == "ts":
        return (f"CASE WHEN microsecond({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%d %H:%M:%S') "
                f"ELSE strftime({c}, '%Y-%m-%d %H:%M:%S.%f') END")
    return f"CAST({c} AS VARCHAR)"


def duck_iso(c: str) -> str:
    return (f"CASE WHEN microsecond({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END")


def duck_csv_field(c: str, kind: str) -> str:
    v = duck_plain(c, kind)
    return (f"CASE WHEN {c} IS NULL THEN '' "
            f"WHEN contains({v}, ',') OR contains({v}, '\"') OR contains({v}, chr(10)) OR contains({v}, chr(13)) "
            f"THEN '\"' || replace({v}, '\"', '\"\"') || '\"' ELSE {v} END")


def _kinds(ent: str) -> list[tuple[str, str]]:
    ts_cols = {"ORDER_START_DT_TM", "ORDER_END_DT_TM", "UPDATE_DT_TM", "COLLECT_DT_TM", "RECEIVE_DT_TM",
               "RESULT_DT_TM", "ADMIT_DT_TM", "DISCH_DT_TM", "ONSET_DT_TM", "CREATE_DT_TM", "PAYMENT_DT_TM"}
    return [(a, "ts" if a in ts_cols else "v") for _, a in ADAPTERS[ent][2]]


def _csv_sql(ent: str) -> str:
    line = " || ',' || ".join(duck_csv_field(c, k) for c, k in _kinds(ent))
    return W(f"SELECT {line} AS line FROM {ent}", [ent])


ORACLE["export_csv_lines"] = _csv_sql("PATIENT_ALLERGY")
ORACLE["export_csv_orders"] = _csv_sql("ORDER_PROC")

ORACLE["export_hl7"] = W(f"""
, J AS (SELECT o.ORDER_ID, o.ORDER_STATUS_CD, o.PATIENT_ID, p.LAST_NAME, p.FIRST_NAME, p.DOB, p.SEX_CD
        FROM ORDER_PROC o LEFT JOIN PATIENT p ON o.PATIENT_ID = p.PATIENT_ID),
N AS (SELECT *, row_number() OVER (ORDER BY ORDER_ID) AS ordinal FROM J)
SELECT ordinal,
  'MSH|^~\\&|EHR_SRC|SRC_FACILITY|RECV_SYS|DEST|' || strftime({RUN_TS_SQL}, '%Y%m%d%H%M') || '|MSG'
  || upper(md5('{RUN_ID}:' || CAST(ordinal AS VARCHAR))) || '|ORU|2.4' || chr(13)
  || 'PID|' || CAST(ordinal AS VARCHAR) || '|' || coalesce(CAST(PATIENT_ID AS VARCHAR), '') || '||'
  || coalesce(LAST_NAME, '') || '^' || coalesce(FIRST_NAME, '') || '||' || coalesce(CAST(DOB AS VARCHAR), '')
  || '|' || coalesce(SEX_CD, '') || chr(13)
  || 'ORC|' || coalesce(ORDER_STATUS_CD, '') || '|' || coalesce(CAST(ORDER_ID AS VARCHAR), '') || chr(13) AS message
FROM N
""", ["ORDER_PROC", "PATIENT"]).replace("\n\n, J AS", ",\nJ AS")

_GENDER = "CASE WHEN coalesce(length(SEX_CD), 0) > 0 THEN lower(SEX_CD) ELSE 'unknown' END"
_PATIENT_STRUCT = ("{'resourceType': 'Patient', 'id': coalesce(CAST(PATIENT_ID AS VARCHAR), ''), "
                   "'name': [{'family': LAST_NAME, 'given': [FIRST_NAME]}], 'birthDate': CAST(DOB AS VARCHAR), "
                   f"'gender': {_GENDER}, "
                   "'address': [{'line': [ADDRESS_LINE_1], 'city': CITY, 'state': STATE_CD, 'postalCode': ZIP_CD}]}")
ORACLE["fhir_patient"] = W(f"SELECT to_json({_PATIENT_STRUCT})::VARCHAR AS resource FROM PATIENT", ["PATIENT"])

ORACLE["fhir_encounter"] = W(
    "SELECT to_json({'resourceType': 'Encounter', 'id': coalesce(CAST(VISIT_ID AS VARCHAR), ''), "
    "'subject': {'reference': 'Patient/' || coalesce(CAST(PATIENT_ID AS VARCHAR), '')}, 'status': 'finished', "
    "'class': {'code': VISIT_TYPE_CD}, "
    f"'period': {{'start': {duck_iso('ADMIT_DT_TM')}, 'end': {duck_iso('DISCH_DT_TM')}}}}})::VARCHAR AS resource "
    "FROM PATIENT_VISIT", ["PATIENT_VISIT"])

ORACLE["fhir_observation"] = W(
    "SELECT to_json({'resourceType': 'Observation', 'id': coalesce(CAST(RESULT_ID AS VARCHAR), ''), "
    "'subject': {'reference': 'Patient/' || coalesce(CAST(PATIENT_ID AS VARCHAR), '')}, 'status': 'final', "
    "'code': {'coding': [{'code': RESULT_TYPE_CD}]}, 'valueQuantity': {'value': VALUE, 'unit': UNITS}, "
    f"'effectiveDateTime': {duck_iso('RESULT_DT_TM')}}})::VARCHAR AS resource FROM RESPIRATORY", ["RESPIRATORY"])

ORACLE["fhir_passthrough"] = W(
    "SELECT to_json({'ACCOUNT_ID': ACCOUNT_ID, 'PATIENT_ID': PATIENT_ID, 'ACCOUNT_TYPE_CD': ACCOUNT_TYPE_CD, "
    "'ACCOUNT_STATUS_CD': ACCOUNT_STATUS_CD, 'BALANCE_AMT': BALANCE_AMT, "
    f"'CREATE_DT_TM': {duck_iso('CREATE_DT_TM')}}})::VARCHAR AS resource FROM ACCOUNT", ["ACCOUNT"])

_BID = "md5('" + RUN_ID + ":' || CAST(bundle_no AS VARCHAR))"
ORACLE["export_fhir_bundle"] = W(f"""
, R AS (SELECT row_number() OVER (ORDER BY PATIENT_ID) AS ordinal, {_PATIENT_STRUCT} AS resource FROM PATIENT),
B AS (SELECT CAST((ordinal - 1) // 100 AS BIGINT) AS bundle_no, count(*) AS entries,
             list({{'resource': resource}} ORDER BY ordinal) AS entry FROM R GROUP BY 1)
SELECT bundle_no, entries,
  to_json({{'resourceType': 'Bundle',
            'id': substr({_BID}, 1, 8) || '-' || substr({_BID}, 9, 4) || '-' || substr({_BID}, 13, 4) || '-'
                  || substr({_BID}, 17, 4) || '-' || substr({_BID}, 21, 12),
            'type': 'collection', 'timestamp': {duck_iso(RUN_TS_SQL)}, 'entry': entry}})::VARCHAR AS bundle
FROM B
""", ["PATIENT"]).replace("\n\n, R AS", ",\nR AS")

ORACLE["export_csv_files"] = "\nUNION ALL\n".join(
    f"SELECT '{e}' AS entity_name, 'header' AS part, '{','.join(a for _, a in ADAPTERS[e][2])}' AS line\n"
    f"UNION ALL\nSELECT '{e}', 'data', line FROM ({_csv_sql(e)})" for e in ("RESPIRATORY", "ACCOUNT"))
ORACLE["export_hl7_files"] = (
    f"SELECT unnest(string_split(rtrim(message, chr(13)), chr(13))) AS segment FROM ({ORACLE['export_hl7']})")
ORACLE["export_fhir_files"] = f"SELECT bundle FROM ({ORACLE['export_fhir_bundle']})"

ORACLE["export_csv_single"] = (
    f"SELECT 'ACCOUNT' AS entity_name, CAST(1 AS BIGINT) AS line_no, '{','.join(a for _, a in ADAPTERS['ACCOUNT'][2])}' AS line\nUNION ALL\n"
    f"SELECT 'ACCOUNT', 1 + row_number() OVER (ORDER BY CAST(split_part(line, ',', 1) AS BIGINT)), line FROM ({_csv_sql('ACCOUNT')})")
_ZERO_ID = "md5('" + RUN_ID + ":0')"
ORACLE["export_fhir_single"] = W(f"""
, R AS (SELECT row_number() OVER (ORDER BY PATIENT_ID) AS n, count(*) OVER () AS total, to_json({{'resource': {_PATIENT_STRUCT}}})::VARCHAR AS entry FROM PATIENT)
SELECT CAST(1 AS BIGINT) AS line_no, '{{"resourceType":"Bundle","id":"' || substr({_ZERO_ID}, 1, 8) || '-' || substr({_ZERO_ID}, 9, 4) || '-'
  || substr({_ZERO_ID}, 13, 4) || '-' || substr({_ZERO_ID}, 17, 4) || '-' || substr({_ZERO_ID}, 21, 12) || '","type":"collection","timestamp":"'
  || {duck_iso(RUN_TS_SQL)} || '","entry":[' AS line
UNION ALL SELECT n + 1, entry || CASE WHEN n < total THEN ',' ELSE '' END FROM R
UNION ALL SELECT count(*) + 2, ']}}' FROM PATIENT
""", ["PATIENT"]).replace("\n, R AS", ",\nR AS")

_PCOLS = sorted(a for _, a in ADAPTERS["PATIENT"][2])
_ROW_JSON = "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in _PCOLS) + "}) AS VARCHAR)"
ORACLE["scalar_functions"] = W(f"""
SELECT PATIENT_ID, CAST(PATIENT_ID AS VARCHAR) AS id_text, {_GENDER} AS gender,
  coalesce(LAST_NAME, '') || '^' || coalesce(FIRST_NAME, '') AS name_hl7,
  'Patient/' || CAST(PATIENT_ID AS VARCHAR) AS subject_ref,
  strftime(CAST(DOB AS TIMESTAMP), '%Y%m%d%H%M') AS dob_hl7,
  {duck_iso('CAST(DOB AS TIMESTAMP)')} AS dob_iso,
  'MSG' || upper(substr(md5(CAST(PATIENT_ID AS VARCHAR)), 1, 8)) AS msg_id,
  {_ROW_JSON} AS row_json, md5({_ROW_JSON}) AS row_md5,
  CASE WHEN (PATIENT_ID % 5) * 25.0 = 100 THEN 'excellent' WHEN (PATIENT_ID % 5) * 25.0 >= 75 THEN 'good'
       WHEN (PATIENT_ID % 5) * 25.0 >= 50 THEN 'fair' ELSE 'poor' END AS band,
  printf('%d null values found in ''%s''', PATIENT_ID % 7, 'SEX_CD') AS message
FROM PATIENT
""", ["PATIENT"])


# -------------------------------------------------------------- incremental

ORACLE["incremental_extract"] = W(
    "SELECT * FROM ORDER_PROC WHERE UPDATE_DT_TM > TIMESTAMP '1900-01-01 00:00:00'", ["ORDER_PROC"])

ORACLE["incremental_extract_by_date"] = W(
    "SELECT *, CAST(date_trunc('month', UPDATE_DT_TM) AS DATE) AS change_date FROM ORDER_PROC "
    "WHERE UPDATE_DT_TM > TIMESTAMP '1900-01-01 00:00:00'", ["ORDER_PROC"])

ORACLE["incremental_from_position"] = W(
    "SELECT * FROM ORDER_PROC WHERE UPDATE_DT_TM > TIMESTAMP '2001-01-01 00:00:00'", ["ORDER_PROC"])

ORACLE["incremental_by_period"] = W("\nUNION ALL\n".join(
    f"SELECT '{g}' AS layout, *, CAST(date_trunc('{g}', UPDATE_DT_TM) AS DATE) AS change_date FROM ORDER_PROC "
    f"WHERE UPDATE_DT_TM > TIMESTAMP '2000-06-15 10:00:00'" for g in ("day", "month", "year")), ["ORDER_PROC"])

ORACLE["entity_scan"] = W("SELECT * FROM ORDER_PROC", ["ORDER_PROC"])

ORACLE["etl_overlap"] = W("""
SELECT CAST(2 AS BIGINT) AS run_no, * FROM (
  SELECT * REPLACE ('LATE' AS ORDER_STATUS_CD) FROM ORDER_PROC WHERE ORDER_ID % 20 = 0
  UNION ALL SELECT * REPLACE (NULL AS ORDER_ID) FROM ORDER_PROC WHERE ORDER_ID % 30 = 0
  UNION ALL SELECT * FROM ORDER_PROC WHERE ORDER_ID % 70 = 0)
""", ["ORDER_PROC"])

# Entity, format and change column of the recorded runs.
_RUNS = [("ORDER_PROC", "hl7", "UPDATE_DT_TM"), ("ACCOUNT", "csv", "CREATE_DT_TM"), ("PATIENT_VISIT", "fhir", "ADMIT_DT_TM")]
_RUN_BATCHES = {b[0]: b for b in _BATCHES}
ORACLE["run_history"] = _q("\nUNION ALL\n".join(
    f"SELECT v.entity_name, 'success' AS status, '{f}' AS export_format, v.rows_checked AS rows_extracted, "
    f"v.rows_checked AS rows_exported, v.passed AS validation_passed, v.issues_found, "
    f"TIMESTAMP '1900-01-01 00:00:00' AS position_before, (SELECT max({c}) FROM {e}) AS position_after, "
    f"TRUE AS published, TRUE AS timed FROM ({_va_summary(*_RUN_BATCHES[e])}) v" for e, f, c in _RUNS)
    + "\nUNION ALL\nSELECT 'SPECIMEN', 'failed', 'xml', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BOOLEAN), "
      "CAST(NULL AS BIGINT), TIMESTAMP '1900-01-01 00:00:00', TIMESTAMP '1900-01-01 00:00:00', FALSE, TRUE")
ORACLE["run_issues"] = _q("\nUNION ALL\n".join(_va_issues(*_RUN_BATCHES[e]) for e, _, _ in _RUNS))

ORACLE["watermark_ledger"] = W("\nUNION ALL\n".join(
    f"SELECT '{e}' AS entity_name, max({c}) AS last_extract_ts, CAST(0 AS BIGINT) AS last_rows, "
    f"count(*) AS total_rows, CAST(2 AS BIGINT) AS successful_runs, CAST(1 AS BIGINT) AS failed_runs, "
    f"'failed' AS last_status FROM {e}" for e, c in CHANGE_COLUMNS.items()), list(CHANGE_COLUMNS))

_VALID = ("(count(*) FILTER (WHERE PATIENT_ID IS NULL) = 0 AND count(*) FILTER (WHERE ORDER_ID IS NULL) = 0 "
          "AND count(DISTINCT ORDER_ID) = count(*))")
ORACLE["etl_job"] = W(f"""
SELECT CAST(1 AS BIGINT) AS run_no, 'ORDER_PROC' AS entity_name, 'success' AS status, 'csv' AS export_format,
       count(*) AS rows_extracted, count(*) AS rows_exported, {_VALID} AS validation_passed,
       CAST(CASE WHEN {_VALID} THEN 0 ELSE 1 END AS BIGINT) AS issues_found,
       TIMESTAMP '1900-01-01 00:00:00' AS position_before, max(UPDATE_DT_TM) AS position_after
FROM ORDER_PROC
UNION ALL
SELECT CAST(2 AS BIGINT), 'ORDER_PROC', 'success', 'hl7', CAST(0 AS BIGINT), CAST(0 AS BIGINT), TRUE,
       CAST(0 AS BIGINT), max(UPDATE_DT_TM), max(UPDATE_DT_TM)
FROM ORDER_PROC
""", ["ORDER_PROC"])

ORACLE["incremental_stream"] = W("SELECT * FROM ORDER_PROC", ["ORDER_PROC"])
