"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import checkpoint_root


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, which Spark reuses for
    many tasks. It only saves work: everything in it can be made again."""
    return sys.__dict__.setdefault("_vitrine_llm", {})


def give_back() -> None:
    """Memory that this process has freed goes back to the system, as a worker serves many stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def forget_caches() -> None:
    """What other operators left in this worker goes: an operator that needs memory and no cache begins."""
    cache = worker_cache()
    if cache:
        cache.clear()
        give_back()


@contextmanager
def batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Within it Spark hands at most ``rows`` rows at once to a task's Python (None: as the session says)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    # 0 or less: no limit
    least = rows if rows and (int(before) <= 0 or rows < int(before)) else before
    spark.conf.set(key, str(least))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs within it gives its shuffle files back at its end, not when the driver happens to collect its garbage.

    For steps that end in a written table. A frame that is handed out lazily is made outside of it,
    as its second run would have to make its shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/vitrine-llm/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the plan
    above starts from files that every executor can read again."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with batches_of(spark, batch_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through Spark's own file system layer."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


BIT_BUCKET = 1 << 15  # bits of one bitmap of Spark's bitmap functions
BITS_A_KEY, LEAST_BITS, MOST_BITS = 32, 1 << 15, 1 << 28


def may_be_among(rows: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false if ``key`` (64 bits) is surely not in ``keys``, a written table of one column.

    A bitmap of the hashed keys meets the rows, so wide rows need no shuffle to learn that they are not
    concerned. It has ``BITS_A_KEY`` bits a key, so about one in 32 other rows is flagged as well, and
    never more than ``MOST_BITS`` (32 MB): beyond that more rows are flagged, and none is missed.
    """
    count, bits = keys.count(), LEAST_BITS
    while bits < min(count * BITS_A_KEY, MOST_BITS):
        bits *= 2
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(bits))
    maps = keys.select(place(F.col(keys.columns[0])).alias("p")).select(
        F.floor(F.col("p") / BIT_BUCKET).alias("__bucket"), (F.col("p") % BIT_BUCKET).alias("p")).groupBy("__bucket").agg(
        F.bitmap_construct_agg("p").alias("__bits"))
    at = F.col("__at") % BIT_BUCKET
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    placed = rows.withColumn("__at", place(key)).withColumn("__bucket", F.floor(F.col("__at") / BIT_BUCKET))
    # at most 8192 rows of 4 KB
    return placed.join(F.broadcast(maps), "__bucket", "left").select(*rows.columns, hit.alias(flag))


def commit_file(store, part: str, target: str) -> None:
    """Give a complete file its name; a file that an earlier attempt left there is the same."""
    from pyarrow import fs

    if store.get_file_info(target).type != fs.FileType.NotFound:
        store.delete_file(target)
    store.move(part, target)
