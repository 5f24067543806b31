"""FHIR R4 resources as nested struct Columns (serialise with ``to_json``).

Absent columns become ``""``; present nulls stay JSON ``null``. Times are
ISO-8601 text. Every field is a JVM-side expression, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import gender, iso_ts

JSON_OPTS = {"ignoreNullFields": "false"}


def _v(df: DataFrame, name: str) -> Column:
    """Value for a JSON field: absent -> '', times -> ISO text, dates -> text."""
    if name not in df.columns:
        return F.lit("")
    dt = df.schema[name].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return iso_ts(F.col(name))
    if isinstance(dt, T.DateType):
        return F.col(name).cast("string")
    return F.col(name)


def _s(df: DataFrame, name: str) -> Column:
    """Text form of an id (``str(value)``); '' when absent or null."""
    return F.coalesce(_v(df, name).cast("string"), F.lit(""))


def patient(df: DataFrame, gender_codes: dict[str, str] | None = None) -> Column:
    """Patient resource. ``gender`` is the lower-cased sex code ('unknown' when
    null or empty); ``gender_codes`` maps source codes to FHIR codes instead
    (codes it does not list become 'unknown')."""
    sex = F.col("SEX_CD") if "SEX_CD" in df.columns else F.lit(None).cast("string")
    if gender_codes:
        lookup = F.create_map(*[F.lit(x) for kv in gender_codes.items() for x in kv])
        g = F.coalesce(lookup[sex], F.lit("unknown"))
    else:
        g = gender(sex)
    return F.struct(
        F.lit("Patient").alias("resourceType"),
        _s(df, "PATIENT_ID").alias("id"),
        F.array(F.struct(_v(df, "LAST_NAME").alias("family"),
                         F.array(_v(df, "FIRST_NAME")).alias("given"))).alias("name"),
        _v(df, "DOB").alias("birthDate"),
        g.alias("gender"),
        F.array(F.struct(F.array(_v(df, "ADDRESS_LINE_1")).alias("line"),
                         _v(df, "CITY").alias("city"), _v(df, "STATE_CD").alias("state"),
                         _v(df, "ZIP_CD").alias("postalCode"))).alias("address"))


def encounter(df: DataFrame) -> Column:
    return F.struct(
        F.lit("Encounter").alias("resourceType"),
        _s(df, "VISIT_ID").alias("id"),
        F.struct(F.concat(F.lit("Patient/"), _s(df, "PATIENT_ID")).alias("reference")).alias("subject"),
        F.lit("finished").alias("status"),
        F.struct(_v(df, "VISIT_TYPE_CD").alias("code")).alias("class"),
        F.struct(_v(df, "ADMIT_DT_TM").alias("start"), _v(df, "DISCH_DT_TM").alias("end")).alias("period"))


def observation(df: DataFrame) -> Column:
    return F.struct(
        F.lit("Observation").alias("resourceType"),
        _s(df, "RESULT_ID").alias("id"),
        F.struct(F.concat(F.lit("Patient/"), _s(df, "PATIENT_ID")).alias("reference")).alias("subject"),
        F.lit("final").alias("status"),
        F.struct(F.array(F.struct(_v(df, "RESULT_TYPE_CD").alias("code"))).alias("coding")).alias("code"),
        F.struct(_v(df, "VALUE").alias("value"), _v(df, "UNITS").alias("unit")).alias("valueQuantity"),
        _v(df, "RESULT_DT_TM").alias("effectiveDateTime"))


def passthrough(df: DataFrame) -> Column:
    """Any other resource type: the row itself (times as ISO text)."""
    return F.struct(*[_v(df, c).alias(c) for c in df.columns])


BUILDERS = {"Patient": patient, "Encounter": encounter, "Observation": observation}


# An optional source-code -> FHIR administrative gender map (not applied by default).
FHIR_GENDER_CODES = {"M": "male", "F": "female", "O": "other", "U": "unknown"}


def resource(df: DataFrame, resource_type: str = "Patient", gender_codes: dict | None = None) -> Column:
    if resource_type == "Patient":
        return patient(df, gender_codes)
    return BUILDERS.get(resource_type, passthrough)(df)


def resource_json(df: DataFrame, resource_type: str = "Patient", gender_codes: dict | None = None) -> Column:
    return F.to_json(resource(df, resource_type, gender_codes), JSON_OPTS)
