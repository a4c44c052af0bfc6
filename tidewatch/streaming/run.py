"""Running a stream over what is there and reading its result table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ROCKSDB_PROVIDER, shared_dir
from tidewatch.sources.sinks import stream_results


def event_stream(spark: SparkSession, folder: str, name: str = "events.parquet", per_batch: int = 1) -> DataFrame:
    """A table of a folder as a stream, whether it is one file or a folder of part files.

    Timestamps get a zone, as watermarks need.
    """
    path = f"{folder}/{name}"
    table = spark.read.parquet(path)
    part = table.select(F.input_file_name().alias("f")).limit(1).collect()
    rows = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", per_batch)
    # a single file has the table's own name, and a stream reads folders
    single = bool(part) and part[0]["f"].rsplit("/", 1)[-1] == name
    rows = rows.option("pathGlobFilter", name).parquet(folder) if single else rows.parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def run_once(stream: DataFrame) -> DataFrame:
    """Process the available input and return the sink table."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    place = f"{shared_dir(spark)}/streams/{uuid.uuid4()}"
    running = stream_results(stream, f"{place}/out", f"{place}/checkpoint")
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{place}/out")
