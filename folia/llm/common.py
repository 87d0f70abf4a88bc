"""Shared plumbing: shared-folder tables, salted joins and gapless ranks."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Pieces into which a hot key is split by salted joins.
SALTS = 32

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent, as in local tests, a temporary folder of this
    process is set once and used from then on.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='folia-')}"
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`stored`."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder when the process ends."""
    _written.append((spark, path))


@atexit.register
def _remove_all() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # the session may have ended already
            return


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of queries whose DataFrames are gone.

    It does so only when the driver collects its garbage, which a loop of small
    queries on a large cluster may not bring about for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Stored:
    """A DataFrame written as Parquet in the shared folder; ``drop()`` ends it."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/folia-{uuid.uuid4().hex}"
        schema = df.schema
        df.write.parquet(self.path)
        _written.append((self.spark, self.path))
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)
        _written.remove((self.spark, self.path))


def stored(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a table in the shared folder."""
    return Stored(df).df


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join whose left side may hold one key in a large share of its rows.

    ``spread`` is a deterministic expression over the left side that varies
    inside a key.  ``right`` holds few rows a key and is repeated ``salts``
    times, so that no task gets more than a ``salts``-th of a hot key.
    """
    a = left.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    b = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [*keys, "__salt"], how).drop("__salt")


def gapless_rank(df: DataFrame, key: str, order: list[str], name: str, counts: dict) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... within each value of ``key``, without gaps.

    ``counts`` has the rows of every key; keys are few (shards, or lengths).  A
    key may hold any share of the rows: it is cut into buckets by a hash of
    ``order``, as many as its rows ask for, rows are numbered inside a bucket,
    and each bucket starts at the number of rows in the buckets before it.  A
    bucket holds about a 512th of all rows, but 64 at least and 65,536 at most,
    and a window over the buckets of a key has a row for each of them.  Rows
    that agree in all of ``order`` fall into one bucket.
    """
    total = sum(counts.values())
    each = min(65_536, max(64, total // 512))
    sizes = {k: -(-n // each) for k, n in counts.items()}
    buckets = F.lit(1)
    for n in sorted(set(sizes.values()) - {1}):
        buckets = F.when(F.col(key).isin([k for k, x in sizes.items() if x == n]), n).otherwise(buckets)
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), buckets).cast("long"))
    held = dealt.groupBy(key, "__bucket").count()
    before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select(F.col(key).alias("__k"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(key, "__bucket").orderBy(*order)
    ranked = dealt.withColumn("__rank", F.row_number().over(inside) - 1)
    joined = ranked.join(base, (F.col(key) == F.col("__k")) & (F.col("__bucket") == F.col("__b")))
    return joined.withColumn(name, (F.col("__base") + F.col("__rank")).cast("long")).drop("__k", "__b", "__base", "__bucket", "__rank")
