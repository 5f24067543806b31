"""The incremental job over append-only file sources, as Structured Streaming.

New files in the source folder are picked up by the file source; the
stream checkpoint (in the shared folder) replaces the position ledger, so
a restarted query continues after the last committed micro-batch. Each
micro-batch is validated and exported by ``foreachBatch``; outputs go to a
per-batch folder written in overwrite mode, so a retried batch replaces
its own output instead of duplicating it.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import validate_all
from ..sources import sinks


def run_incremental_stream(spark: SparkSession, source_dir: str, schema, entity: str, out_root: str,
                           checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                           path_glob: str | None = None, key: str | None = None,
                           export_format: str | None = None, max_files_per_trigger: int = 1000,
                           **export_opts) -> None:
    """Process everything available now, then stop (``availableNow``)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    stream = reader.parquet(source_dir)
    if transform is not None:
        stream = transform(stream)
    out_root = out_root.rstrip("/")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        data_path = f"{out_root}/data/batch={epoch_id}"
        batch.write.mode("overwrite").parquet(data_path)
        staged = batch.sparkSession.read.parquet(data_path)
        if export_format:
            sinks.export(staged, export_format, f"{out_root}/{export_format}/batch={epoch_id}", **export_opts)
        # Written last: a batch counts as finished once its metrics are there.
        (validate_all(staged, entity, key).summary.withColumn("batch_id", F.lit(epoch_id).cast("bigint"))
         .coalesce(1).write.mode("overwrite").parquet(f"{out_root}/metrics/batch={epoch_id}"))

    q = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_output(spark: SparkSession, out_root: str) -> DataFrame:
    """All exported rows of finished batches (the partition column ``batch`` dropped)."""
    done = stream_metrics(spark, out_root).select("batch").distinct()
    return spark.read.parquet(f"{out_root.rstrip('/')}/data").join(done, "batch", "left_semi").drop("batch")


def stream_metrics(spark: SparkSession, out_root: str) -> DataFrame:
    return spark.read.parquet(f"{out_root.rstrip('/')}/metrics")
