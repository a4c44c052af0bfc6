"""Session settings the library relies on."""

from __future__ import annotations

import hashlib
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
DEFAULT_PARTITIONS = "200"
ARCHIVE = "tidewatch.zip"


def ship_package(spark: SparkSession) -> str:
    """Send this package to the executors' Python workers, for clusters where it is not installed.

    The archive lies in the shared folder, under a name made of its content, and
    stays there: executors fetch it when their first task starts, which can be
    long after this call. A session ships it once. Returns where it lies.
    """
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(root.rglob("*.py")):
            # a fixed date: the same sources make the same archive
            out.writestr(zipfile.ZipInfo(str(source.relative_to(root.parent))), source.read_bytes())
    content = packed.getvalue()
    context = spark.sparkContext
    for uri in context.listFiles:
        if uri.endswith(f"/{ARCHIVE}"):
            return uri
    folder = f"{shared_dir(spark)}/package-{hashlib.sha256(content).hexdigest()[:16]}"
    # written by Hadoop's file systems, as the shared folder need not be a local path
    path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{ARCHIVE}")
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(content)
    finally:
        stream.close()
    context.addPyFile(path.toString())
    return path.toString()


def get_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        ship_package(spark)
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the timezone and make sure a reliable checkpoint folder is known."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    context = spark.sparkContext
    if context.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == DEFAULT_PARTITIONS:
        # a cluster's default; one process has no use for more partitions than threads
        spark.conf.set("spark.sql.shuffle.partitions", str(context.defaultParallelism))
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names.

    A machine-local folder is taken only when Spark itself is local.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage as a reliable checkpoint does, so a lost executor costs one
    read. Unlike a checkpoint it is columnar and is planned by its true size;
    size estimates kept through repeated joins grow without bound.
    """
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
