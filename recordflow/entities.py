"""Entity catalog: names, required columns, keys, change columns, join edges.

Everything here is metadata that the driver reads; no data passes through it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the behaviour being matched.
# ---------------------------------------------------------------------------

# Required columns per entity (schema contract of the validation step).
REQUIRED_FIELDS: dict[str, list[str]] = {
    "ORDER_PROC": ["ORDER_ID", "PATIENT_ID", "ORDER_START_DT_TM"],
    "SPECIMEN": ["SPECIMEN_ID", "ORDER_ID", "COLLECT_DT_TM"],
    "RESPIRATORY": ["RESULT_ID", "PATIENT_ID", "RESULT_DT_TM"],
    "CLARITY_SER": ["SER_ID", "SER_NAME"],
    "CLARITY_DEP": ["DEP_ID", "DEP_NAME"],
    "CLARITY_EMP": ["EMP_ID", "EMP_NAME"],
    "ORDER_REC": ["ORDER_ID", "VISIT_ID"],
    "ORDER_MISC": ["ORDER_MISC_ID", "VISIT_ID"],
    "PATIENT_VISIT": ["VISIT_ID", "PATIENT_ID", "ADMIT_DT_TM"],
    "PATIENT": ["PATIENT_ID", "LAST_NAME", "DOB"],
    "PATIENT_ALLERGY": ["ALLERGY_ID", "PATIENT_ID"],
    "PATIENT_DIAGNOSIS": ["DIAGNOSIS_ID", "PATIENT_ID"],
    "ACCOUNT": ["ACCOUNT_ID", "PATIENT_ID"],
    "PB_AR": ["AR_ID", "ACCOUNT_ID"],
    "GB_PAYMENT": ["PAYMENT_ID", "ACCOUNT_ID"],
}

# Columns null-checked by the validation step and by reconciliation.
VALIDATION_NULL_FIELDS = ["PATIENT_ID", "ORDER_ID"]
RECON_NULL_FIELDS = ["PATIENT_ID", "ORDER_ID", "VISIT_ID"]

# Position used when an entity has never been extracted.
FIRST_RUN_POSITION = _dt.datetime(1900, 1, 1)

# Quality bands: 100 -> excellent, >= 75 -> good, >= 50 -> fair, else poor.
BAND_EXCELLENT = 100.0
BAND_GOOD = 75.0
BAND_FAIR = 50.0
CHECKS_PER_ENTITY = 4

# Default change-time column for incremental pulls.
DEFAULT_CHANGE_COLUMN = "UPDATE_DT_TM"

# ---------------------------------------------------------------------------
# Explicit primary keys (replaces the name-derived key, see README).
# ---------------------------------------------------------------------------
KEYS: dict[str, str] = {
    "ORDER_PROC": "ORDER_ID",
    "SPECIMEN": "SPECIMEN_ID",
    "RESPIRATORY": "RESULT_ID",
    "CLARITY_SER": "SER_ID",
    "CLARITY_DEP": "DEP_ID",
    "CLARITY_EMP": "EMP_ID",
    "PATIENT_VISIT": "VISIT_ID",
    "ORDER_REC": "ORDER_ID",
    "ORDER_MISC": "ORDER_MISC_ID",
    "PATIENT": "PATIENT_ID",
    "PATIENT_ALLERGY": "ALLERGY_ID",
    "PATIENT_DIAGNOSIS": "DIAGNOSIS_ID",
    "ACCOUNT": "ACCOUNT_ID",
    "PB_AR": "AR_ID",
    "GB_PAYMENT": "PAYMENT_ID",
}

ENTITIES: list[str] = list(REQUIRED_FIELDS)


@dataclass(frozen=True)
class Edge:
    """A foreign-key edge implied by the extract joins."""
    child: str
    fk: str
    parent: str
    pk: str


# Join edges the extracts rely on, plus the patient links used by exports.
EDGES: list[Edge] = [
    Edge("SPECIMEN", "ORDER_ID", "ORDER_PROC", "ORDER_ID"),
    Edge("CLARITY_DEP", "SER_ID", "CLARITY_SER", "SER_ID"),
    Edge("CLARITY_EMP", "DEP_ID", "CLARITY_DEP", "DEP_ID"),
    Edge("ORDER_REC", "VISIT_ID", "PATIENT_VISIT", "VISIT_ID"),
    Edge("ORDER_MISC", "VISIT_ID", "PATIENT_VISIT", "VISIT_ID"),
    Edge("PATIENT_ALLERGY", "PATIENT_ID", "PATIENT", "PATIENT_ID"),
    Edge("PATIENT_DIAGNOSIS", "PATIENT_ID", "PATIENT", "PATIENT_ID"),
    Edge("PB_AR", "ACCOUNT_ID", "ACCOUNT", "ACCOUNT_ID"),
    Edge("GB_PAYMENT", "ACCOUNT_ID", "ACCOUNT", "ACCOUNT_ID"),
    Edge("ORDER_PROC", "PATIENT_ID", "PATIENT", "PATIENT_ID"),
    Edge("RESPIRATORY", "PATIENT_ID", "PATIENT", "PATIENT_ID"),
    Edge("PATIENT_VISIT", "PATIENT_ID", "PATIENT", "PATIENT_ID"),
    Edge("ACCOUNT", "PATIENT_ID", "PATIENT", "PATIENT_ID"),
]


def check_entity(name: str) -> str:
    """Entity names are looked up, never interpolated blindly into SQL."""
    if name not in REQUIRED_FIELDS:
        raise ValueError(f"unknown entity {name!r}; known: {', '.join(ENTITIES)}")
    return name


def required_fields(name: str) -> list[str]:
    return list(REQUIRED_FIELDS.get(name, []))


def key_for(name: str, rule: str = "explicit") -> str:
    """Key column of an entity.

    ``explicit`` uses the catalog. ``validation`` and ``reconciliation``
    reproduce the two name-derived rules (drop the last character always,
    or only a trailing ``S``, then append ``_ID``).
    """
    if rule == "explicit":
        return KEYS.get(name, f"{name}_ID")
    if rule == "validation":
        return f"{name[:-1]}_ID"
    if rule == "reconciliation":
        return f"{name[:-1]}_ID" if name.endswith("S") else f"{name}_ID"
    raise ValueError(f"unknown key rule {rule!r}")
