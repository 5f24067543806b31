"""Quality scores per entity and an overall scorecard, from reconciliation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..entities import CHECKS_PER_ENTITY
from ..functions.columns import band


def score_entities(report: DataFrame) -> DataFrame:
    """Four checks (rows, checksum, all nulls, all duplicates) x 25 %, banded.

    A missing row-count or checksum result fails its check; the null and
    duplicate checks pass when nothing was checked.
    """
    rc = F.coalesce(F.col("row_count_match"), F.lit(False))
    cs = F.coalesce(F.col("checksum_match"), F.lit(False))
    nl = F.coalesce(F.col("null_checks_match"), F.lit(True))
    dp = F.coalesce(F.col("duplicates_match"), F.lit(True))
    passing = sum((f.cast("int") for f in (rc, cs, nl, dp)), F.lit(0))
    pct = (passing.cast("double") / F.lit(float(CHECKS_PER_ENTITY)) * F.lit(100.0))
    return report.select(
        "entity_name",
        band(pct).alias("quality_score"),
        rc.alias("row_count_match"), cs.alias("checksum_match"),
        nl.alias("null_check_pass"), dp.alias("duplicate_check_pass"),
        pct.alias("overall_percentage"))


def scorecard(entity_scores: DataFrame) -> DataFrame:
    """Mean percentage, entity count, passing count (excellent or good).

    No entities -> mean 0 -> poor. One global aggregate.
    """
    agg = entity_scores.agg(
        F.coalesce(F.avg("overall_percentage"), F.lit(0.0)).alias("overall_percentage"),
        F.count(F.lit(1)).cast("bigint").alias("total_entities"),
        F.count_if(F.col("quality_score").isin("excellent", "good")).cast("bigint").alias("entities_passing"))
    return agg.select(band(F.col("overall_percentage")).alias("overall_score"),
                      F.round("overall_percentage", 6).alias("overall_percentage"),
                      "total_entities", "entities_passing")

