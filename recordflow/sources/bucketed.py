"""Bucketed staging of entities, so repeated extracts join without shuffles.

Each entity is written once as a catalog table bucketed (and sorted) by
the key its extract joins on, with the same bucket count for every table.
Later extracts read the tables back: Spark sees matching hash
partitioning on both sides of each join and plans sort-merge joins with no
exchange, including the second join of a star (same key, same buckets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..entities import check_entity

# Join key each entity is bucketed on (the key of the extract join it is on).
JOIN_LAYOUT: dict[str, str] = {
    "ORDER_PROC": "ORDER_ID", "SPECIMEN": "ORDER_ID",
    "PATIENT_VISIT": "VISIT_ID", "ORDER_REC": "VISIT_ID", "ORDER_MISC": "VISIT_ID",
    "PATIENT": "PATIENT_ID", "PATIENT_ALLERGY": "PATIENT_ID", "PATIENT_DIAGNOSIS": "PATIENT_ID",
    "ACCOUNT": "ACCOUNT_ID", "PB_AR": "ACCOUNT_ID", "GB_PAYMENT": "ACCOUNT_ID",
}


def stage_bucketed(spark: SparkSession, tables: dict[str, DataFrame], database: str,
                   buckets: int, layout: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Write each entity as ``database.entity`` bucketed by its join key.

    Entities without a layout key (small dimension tables) are written
    unbucketed; Spark broadcasts them by size. Returns the staged tables.
    """
    layout = layout or JOIN_LAYOUT
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = {}
    for name, df in tables.items():
        check_entity(name)
        w = df.write.mode("overwrite").format("parquet")
        key = layout.get(name)
        if key:
            w = w.bucketBy(buckets, key).sortBy(key)
        w.saveAsTable(f"{database}.{name}")
        out[name] = spark.table(f"{database}.{name}")
    return out
