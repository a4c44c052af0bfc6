"""Result tables: batch parquet by date and append streams with checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_results(df: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    df.withColumn("date", F.to_date(ts)).write.mode(mode).partitionBy("date").parquet(path)


def stream_results(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append to parquet; ``every`` is the trigger interval, None runs what is there and stops."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)
