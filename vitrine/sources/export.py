"""Single-file exports.

The frame is computed, encoded and compressed in parallel, into Parquet parts
next to the target. Only the final write runs in one task, as one file has one
writer: it reads the compressed parts, not shuffled rows, and writes into a
staging folder, whose one part file is then renamed through the Hadoop file
system of the target path (local disk, HDFS or an object store alike).
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame

# Fixed value: a spreadsheet's row limit, for use as an explicit ``max_rows``.
CSV_MAX_ROWS = 1_048_576


def _fs(df: DataFrame, path: str):
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def export_single_file(df: DataFrame, target: str, fmt: str, options: dict | None = None, max_rows: int | None = None) -> str:
    """Write ``df`` as exactly one ``fmt`` file at ``target``; returns ``target``.

    All rows by default, in no promised order. An explicit ``max_rows`` keeps the first rows in the
    frame's order and warns when it leaves any out.
    """
    spark = df.sparkSession
    if max_rows and df.limit(max_rows + 1).count() > max_rows:
        warnings.warn(f"{target} holds the first {max_rows} rows only", stacklevel=3)
    staging = f"{target}._staging-{uuid.uuid4().hex[:12]}"
    encoded = f"{staging}-parts"
    if max_rows:
        out = df.limit(max_rows).repartition(1)
    else:
        df.write.option("compression", "zstd").parquet(encoded)
        out = spark.read.schema(df.schema).parquet(encoded).coalesce(1)
    out.write.mode("overwrite").format(fmt).options(**(options or {})).save(staging)
    fs, target_path, jvm = _fs(df, target)
    staging_path = jvm.org.apache.hadoop.fs.Path(staging)
    parts = [s.getPath() for s in fs.listStatus(staging_path) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {staging}, found {len(parts)}")
    if fs.exists(target_path):
        fs.delete(target_path, True)
    if not fs.rename(parts[0], target_path):
        raise RuntimeError(f"could not move {parts[0]} to {target}")
    fs.delete(staging_path, True)
    fs.delete(jvm.org.apache.hadoop.fs.Path(encoded), True)
    return target


def export_csv(df: DataFrame, target: str, max_rows: int | None = None) -> str:
    """One CSV file with a header row and all rows."""
    return export_single_file(df, target, "csv", {"header": "true"}, max_rows)


def export_parquet(df: DataFrame, target: str, max_rows: int | None = None) -> str:
    """One Parquet file."""
    return export_single_file(df, target, "parquet", None, max_rows)
