"""Catalog of the named extracts, and their SQL text.

An extract is declared, not coded: a driving entity with its columns, a lower
bound or half-open range on one driving column, left-joined entities, and the
sort. ``plans.extracts`` builds DataFrames from it, ``extract_sql`` the same
statement as text. A user's own extract is registered the same way, or as SQL
text with ``:name`` markers.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Joined:
    """A left-joined entity; its key column is one that the frame has so far."""
    entity: str
    key: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ExtractDef:
    name: str
    schema: str                        # source schema group label (metadata only)
    category: str
    entities: tuple[str, ...]
    params: tuple[str, ...]            # one: lower bound; two: half-open range
    description: str = ""
    bound: str = ""                    # driving column that the parameters limit
    columns: tuple[str, ...] = ()      # of the driving entity
    joined: tuple[Joined, ...] = ()
    sort: tuple[str, ...] = ()
    text: str | None = None            # a user's statement, in place of the declaration

    @property
    def output(self) -> list[str]:
        return [*self.columns, *(c for j in self.joined for c in j.columns)]


def _declare(name, schema, category, params, description, bound, driving, columns, joined, sort) -> ExtractDef:
    sides = tuple(Joined(entity, key, tuple(cols.split())) for entity, key, cols in joined)
    return ExtractDef(name, schema, category, (driving, *(j.entity for j in sides)), params, description,
                      bound, tuple(columns.split()), sides, tuple(sort.split()))


_RANGE = ("start_date", "end_date")

# Extract names, schema groups, categories, parameter names,
# entities, join keys, column lists and first sort columns. The sort goes on
# with the row keys of all joined entities, so the rows of one hot sort value
# spread over range partitions.
EXTRACTS: dict[str, ExtractDef] = {d.name: d for d in [
    _declare("extract_orders_psd", "PSD", "hl7", _RANGE, "each order with the specimens taken for it",
             "ORDER_START_DT_TM", "ORDER_PROC",
             "ORDER_ID PATIENT_ID ORDER_TYPE_CD ORDER_STATUS_CD ORDERING_PROVIDER_ID ORDER_START_DT_TM ORDER_END_DT_TM RESULT_STATUS_CD",
             [("SPECIMEN", "ORDER_ID", "SPECIMEN_ID SPECIMEN_TYPE_CD COLLECT_DT_TM RECEIVE_DT_TM")],
             "ORDER_START_DT_TM ORDER_ID SPECIMEN_ID"),
    _declare("extract_respiratory_results", "PSD", "hl7", _RANGE, "measured values in a range of result times",
             "RESULT_DT_TM", "RESPIRATORY",
             "RESULT_ID PATIENT_ID ORDER_ID RESULT_TYPE_CD RESULT_DT_TM VALUE UNITS NORMAL_RANGE ABNORMAL_IND",
             [], "RESULT_DT_TM RESULT_ID"),
    _declare("extract_organizational_hierarchy", "CDO", "cdo", ("start_ser_id",), "services down to departments and staff",
             "SER_ID", "CLARITY_SER",
             "SER_ID SER_NAME SER_TYPE_CD",
             [("CLARITY_DEP", "SER_ID", "DEP_ID DEP_NAME DEP_TYPE_CD"),
              ("CLARITY_EMP", "DEP_ID", "EMP_ID EMP_NAME EMP_TYPE_CD")],
             "SER_ID DEP_ID EMP_ID"),
    _declare("extract_visit_encounters", "HSD", "hl7", _RANGE, "each visit against both kinds of its orders",
             "ADMIT_DT_TM", "PATIENT_VISIT",
             "VISIT_ID PATIENT_ID ADMIT_DT_TM DISCH_DT_TM VISIT_TYPE_CD ACCOMMODATION_CD",
             [("ORDER_REC", "VISIT_ID", "ORDER_ID ORDER_STATUS_CD"),
              ("ORDER_MISC", "VISIT_ID", "ORDER_MISC_ID MISC_TYPE_CD")],
             "ADMIT_DT_TM VISIT_ID ORDER_ID ORDER_MISC_ID"),
    _declare("extract_patient_demographics", "ARK", "cdo", ("start_patient_id",), "each person against allergies and diagnoses",
             "PATIENT_ID", "PATIENT",
             "PATIENT_ID FIRST_NAME LAST_NAME DOB SEX_CD MARITAL_STATUS_CD ADDRESS_LINE_1 CITY STATE_CD ZIP_CD",
             [("PATIENT_ALLERGY", "PATIENT_ID", "ALLERGY_ID ALLERGY_TYPE_CD ALLERGY_CD SEVERITY_CD"),
              ("PATIENT_DIAGNOSIS", "PATIENT_ID", "DIAGNOSIS_ID DIAGNOSIS_CD DIAGNOSIS_TYPE_CD ONSET_DT_TM")],
             "PATIENT_ID ALLERGY_ID DIAGNOSIS_ID"),
    _declare("extract_billing_accounts", "FIN", "fin", _RANGE, "each account against receivables and payments",
             "CREATE_DT_TM", "ACCOUNT",
             "ACCOUNT_ID PATIENT_ID ACCOUNT_TYPE_CD ACCOUNT_STATUS_CD BALANCE_AMT CREATE_DT_TM",
             [("PB_AR", "ACCOUNT_ID", "AR_ID AR_TYPE_CD AMOUNT"),
              ("GB_PAYMENT", "ACCOUNT_ID", "PAYMENT_ID PAYMENT_DT_TM PAYMENT_AMT PAYMENT_METHOD_CD")],
             "CREATE_DT_TM ACCOUNT_ID AR_ID PAYMENT_ID"),
]}


def extract_sql(d: ExtractDef, values: dict[str, str] | None = None) -> str:
    """The declared extract as one statement; ``values`` are SQL literals put in
    place of the parameter markers."""
    if d.text is not None:
        return d.text
    value = {p: (values or {}).get(p, f":{p}") for p in d.params}
    holder = {c: "f0" for c in d.columns}  # which frame a column is first found in
    chosen, source = [f"f0.{c}" for c in d.columns], f"{d.entities[0]} f0"
    for i, j in enumerate(d.joined, 1):
        source += f"\nLEFT JOIN {j.entity} f{i} ON f{i}.{j.key} = {holder[j.key]}.{j.key}"
        chosen += [f"f{i}.{c}" for c in j.columns]
        holder = {**{c: f"f{i}" for c in j.columns}, **holder}
    limits = [f"f0.{d.bound} {op} {value[p]}" for op, p in zip((">=", "<"), d.params)]
    order = ", ".join(f"{holder[c]}.{c} NULLS LAST" for c in d.sort)
    return f"SELECT {', '.join(chosen)}\nFROM {source}\nWHERE {' AND '.join(limits)}\nORDER BY {order}"


def register_extract(d: ExtractDef) -> ExtractDef:
    """Add a user's extract to the catalog; a taken name is refused."""
    if d.name in EXTRACTS:
        raise ValueError(f"extract {d.name!r} exists already")
    if d.text is None and not (d.bound and d.columns and 1 <= len(d.params) <= 2):
        raise ValueError(f"{d.name}: needs SQL text, or a bound column, driving columns and one or two parameters")
    known = set(d.columns)
    for j in d.joined:
        if j.key not in known:
            raise ValueError(f"{d.name}: join key {j.key} of {j.entity} is in no earlier entity")
        known |= set(j.columns)
    EXTRACTS[d.name] = d
    return d


def unregister_extract(name: str) -> None:
    EXTRACTS.pop(name, None)


def extracts_by_category(category: str) -> list[ExtractDef]:
    return [d for d in EXTRACTS.values() if d.category == category]
