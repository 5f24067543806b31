"""Extracts written as SQL text with ``:name`` parameter markers.

Spark binds named parameters itself (``spark.sql(text, args=...)``), so an
extract kept as a SQL template runs as is: entity views are registered,
the text is parsed and optimised by Catalyst like any DataFrame plan, and
parameter values are bound as typed literals (never pasted into the text).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..entities import check_entity
from .catalog import EXTRACTS, extract_sql


def register_entities(tables: dict[str, DataFrame]) -> None:
    """Expose entity frames to SQL under their entity names."""
    for name, df in tables.items():
        check_entity(name)
        df.createOrReplaceTempView(name)


def _arg(v):
    # Times are bound as ISO text: compared with a timestamp_ntz column the
    # text is cast to that type, so no time zone enters and the predicate
    # still reaches the Parquet scan.
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """Parse and run one parameterised statement (a trailing ';' is allowed)."""
    body = text.strip()
    if body.endswith(";"):
        body = body[:-1]
    return spark.sql(body, args={k: _arg(v) for k, v in params.items()})


# The orders extract in the form extract texts take: banner comment, named
# markers, trailing semicolon.
ORDERS_WITH_SPECIMENS_SQL = f"/* generated from the catalog */\n{extract_sql(EXTRACTS['extract_orders_psd'])};\n"
