"""Tables that cut lineage: written to the folder all executors share, so that losing one costs nothing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder. Only a local session may fall back on a folder of its own."""
    folder = spark.conf.get(SETTING, None) or _own.get(spark.sparkContext.applicationId)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{SETTING} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quarrylight-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        folder = _own[spark.sparkContext.applicationId] = f"file://{folder}"
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and returns it as read from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes what materialize() wrote; call it once the results that read it are written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
