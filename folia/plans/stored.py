"""Relations that a query reads several times, as Parquet in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def _shared(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in local sessions without one, a temporary folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='folia-')}"
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once and read back: later uses read only the columns that they take, and none is held in memory."""
    spark = df.sparkSession
    path = f"{_shared(spark)}/folia-{uuid.uuid4().hex}"
    schema = df.schema
    _written.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@atexit.register
def _remove_all() -> None:
    for spark, path in _written:
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may have ended already
            return
