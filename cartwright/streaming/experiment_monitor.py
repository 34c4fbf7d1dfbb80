"""Incremental experiment read-out with Structured Streaming.

The batch statistics all start from ``variant_moments`` (counts, successes,
mean, variance per variant). The same aggregation runs unchanged on a
stream of experiment-fact rows (e.g. the fact's Parquet folder receiving
new daily files): Spark keeps the per-variant aggregation buffers in the
state store, checkpointed under the session's ``spark.checkpoint.dir``, and
each trigger folds only the new files in. The z-test, Welch test and
guardrail then read the latest moments row like any batch frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwright.operators.experiment import DEFAULT, ExperimentConfig, variant_moments
from cartwright.session import warehouse_path

FACT_SCHEMA = ("order_id bigint, user_id bigint, variant string, order_status string, "
               "order_created_at timestamp_ntz, order_value double, item_count bigint, "
               "is_completed int, is_returned int")


def moments_stream(spark: SparkSession, fact_dir: str, cfg: ExperimentConfig = DEFAULT,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the one-row moments over all fact files so far."""
    reader = spark.readStream.schema(FACT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return variant_moments(reader.parquet(fact_dir), cfg)


def start_monitor(spark: SparkSession, fact_dir: str, out_table: str,
                  cfg: ExperimentConfig = DEFAULT, checkpoint: str | None = None,
                  available_now: bool = True):
    """Keep ``out_table`` (in-memory table) equal to the moments of the fact so far.

    ``available_now`` processes what is there and stops (scheduled runs);
    otherwise the query keeps running with the default trigger.
    """
    ckpt = checkpoint or warehouse_path(spark, "streams", out_table)
    writer = (moments_stream(spark, fact_dir, cfg).writeStream
              .outputMode("complete").format("memory").queryName(out_table)
              .option("checkpointLocation", ckpt))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
