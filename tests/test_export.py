"""Single-file exports (T20, T21): one file, header, row cap, no staging left."""

import glob
import os

from vitrine.session import local_path, scratch_location
from vitrine.sources import export as X


def test_csv_cap_header_single_file(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    folder = local_path(scratch_location(spark, "exp"))
    target = X.export_csv(df, f"{folder}/out.csv", max_rows=5)
    assert os.path.isfile(local_path(target))
    lines = open(local_path(target)).read().strip().split("\n")
    assert lines[0] == "id,twice" and len(lines) == 6
    assert glob.glob(f"{folder}/*_staging-*") == []
    again = X.export_csv(df, f"{folder}/out.csv", max_rows=7)  # overwrite in place
    assert len(open(local_path(again)).read().strip().split("\n")) == 8


def test_parquet_single_file_roundtrip(spark):
    df = spark.range(50).selectExpr("id", "cast(id AS string) AS s")
    folder = local_path(scratch_location(spark, "exp"))
    target = X.export_parquet(df, f"{folder}/out.parquet")
    assert os.path.isfile(local_path(target))
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(50))
    assert X.CSV_MAX_ROWS == 1_048_576


def test_one_task_reads_encoded_parts_of_all_rows(spark, monkeypatch):
    """The rows of a whole export aren't shuffled into the writing task; empty frames give a file as well."""
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F

    def shuffled(*args, **kwargs):
        raise AssertionError("all rows go to one task as shuffled rows")

    df = spark.range(5000, numPartitions=7).select("id", F.when(F.col("id") % 9 > 0, F.col("id").cast("string")).alias("s"))
    folder = local_path(scratch_location(spark, "exp"))
    monkeypatch.setattr(DataFrame, "repartition", shuffled)
    monkeypatch.setattr(type(df), "repartition", shuffled)
    for rows, n in ((df, 5000), (df.filter("id < 0"), 0)):
        target = X.export_parquet(rows, f"{folder}/whole{n}.parquet")
        assert os.path.isfile(target) and os.listdir(folder).count(f"whole{n}.parquet") == 1
        got = {(r.id, r.s) for r in spark.read.parquet(target).collect()}
        assert got == {(i, str(i) if i % 9 else None) for i in range(n)}
        target = X.export_csv(rows, f"{folder}/whole{n}.csv")
        assert len(open(target).read().split()) == n + 1 or n == 0
    assert glob.glob(f"{folder}/*_staging-*") == []
