"""Tumbling-window sales over an event stream.

The same functions run on a batch DataFrame, which gives the values that the stream must
arrive at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("county", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
    ]
)


def read_events(
    spark: SparkSession,
    fmt: str = "kafka",
    schema: T.StructType | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A streaming source: a message broker, or files as they arrive below ``path``."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def parse_events(stream: DataFrame, schema: T.StructType = EVENT_SCHEMA, payload: str = "value") -> DataFrame:
    """The fields of the JSON payload as columns; unreadable payloads give nulls."""
    return stream.select(F.from_json(F.col(payload).cast("string"), schema).alias("data")).select("data.*")


def windowed_sales(
    events: DataFrame,
    time: str = "timestamp",
    group: str = "county",
    amount: str = "amount",
    size: str = "5 minutes",
    watermark: str = "1 hour",
) -> DataFrame:
    """Event count and amount by tumbling window and group; events past the watermark are dropped."""
    return (
        events.withWatermark(time, watermark)
        .groupBy(F.window(time, size).alias("window"), group)
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum(amount).alias("total_sales"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            group,
            "transaction_count",
            "total_sales",
        )
    )


def write_late_events(
    events: DataFrame,
    path: str,
    checkpoint: str,
    time: str = "timestamp",
    size: str = "5 minutes",
    watermark: str = "1 hour",
    available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Keep the events that ``windowed_sales`` drops: those whose window the watermark of earlier batches closed.

    Each batch writes its late events to ``path/late/batch=N`` and the latest event time so far, one row, to
    ``path/latest/batch=N``; both are overwritten if the batch is run again. The two streams agree where they
    take the same batches, that is with the same source, trigger and files a batch. Events without a time
    are in no window and not late. Read the result with ``late_events``.
    """

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = batch.agg(F.max(time).alias("latest"))
        if number:
            before = spark.read.schema(latest.schema).parquet(f"{path}/latest/batch={number - 1}")
            mark = before.scalar()
            latest = latest.union(before).agg(F.max("latest").alias("latest"))
        else:
            mark = F.lit(None).cast("timestamp")
        closed = F.window(time, size)["end"] <= mark - F.expr(f"INTERVAL {watermark}")
        batch.filter(closed).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        latest.write.mode("overwrite").parquet(f"{path}/latest/batch={number}")

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return events.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def late_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """What ``write_late_events`` kept, with the number of its batch."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{path}/late")


def write_windows(
    windows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Append closed windows to files. ``available_now`` stops once all present input is done."""
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        windows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )
