"""Live activity counts on a stream of canonical flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def activity_counts(flights: DataFrame, width: str = "1 day") -> DataFrame:
    """Flights and minutes per time window and region.

    `start_time_utc` must be a timestamp column here, as windows need one; under the
    session zone UTC it shows the same clock time.
    """
    return (
        flights.groupBy(F.window("start_time_utc", width), "region_code")
        .agg(
            F.count("*").alias("flights_count"),
            F.sum(F.col("duration_minutes").cast("decimal(18,2)")).alias("duration_sum_min"),
        )
        .select(F.col("window.start").alias("window_start"), "region_code", "flights_count", "duration_sum_min")
    )


def write_counts(flights: DataFrame, path: str, checkpoint: str, width: str = "1 day") -> StreamingQuery:
    """Write the counts of each batch of the stream as one partition.

    No state is kept between batches and no row is too late: a window gets another row
    per batch that brings flights for it, and a repeated batch overwrites its own.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = activity_counts(batch, width).withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return (
        flights.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def totals(counts: DataFrame) -> DataFrame:
    """All batches of each window and region together."""
    return counts.groupBy("window_start", "region_code").agg(
        F.sum("flights_count").alias("flights_count"), F.sum("duration_sum_min").alias("duration_sum_min")
    )
