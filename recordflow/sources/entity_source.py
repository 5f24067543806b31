"""Named-entity scans over Parquet paths, catalog tables or JDBC sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..entities import check_entity


def read_entity(spark: SparkSession, name: str, *, path: str | None = None,
                fmt: str = "parquet", table: str | None = None,
                jdbc: dict | None = None, schema=None) -> DataFrame:
    """Scan one entity.

    * ``path``: files in ``fmt`` (Parquet by default; partition pruning and
      predicate pushdown apply). A known ``schema`` skips schema inference,
      which matters when a folder holds very many files.
    * ``table``: a catalog table / view name.
    * ``jdbc``: options for Spark's JDBC source. Pass ``partitionColumn``,
      ``lowerBound``, ``upperBound`` and ``numPartitions`` so the pull is
      split into parallel range reads instead of one connection.
    """
    check_entity(name)
    if path is not None:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    if jdbc is not None:
        opts = {"dbtable": name, **jdbc}
        return spark.read.format("jdbc").options(**opts).load()
    return spark.table(table or name)
