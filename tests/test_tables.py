"""Table layer: overwrite, merge, drop, strict schema, load type (FIXTURES §2)."""

import uuid

import pytest
from pyspark.sql import functions as F

from vitrine.plans import silver
from vitrine.session import scratch_location
from vitrine.sources import tables as T


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    T.create_database(spark, name, scratch_location(spark, name))
    yield name
    T.drop_database(spark, name)


def rows(spark, data):
    return spark.createDataFrame(data, "id string, v int, dt_refe_crga string")


def test_rerun_and_overwrite_keep_other_partitions(spark, db):
    name = f"{db}.t"
    T.save_table(spark, rows(spark, [("a", 1, "d1"), ("b", 2, "d2")]), name, "dt_refe_crga", "append")
    new = rows(spark, [("c", 3, "d2")])
    T.save_table(spark, new, name, "dt_refe_crga", "overwrite")
    T.save_table(spark, new, name, "dt_refe_crga", "overwrite")
    assert sorted((r.id, r.dt_refe_crga) for r in spark.table(name).collect()) == [("a", "d1"), ("c", "d2")]


def test_by_name_and_new_column(spark, db):
    name = f"{db}.t"
    T.save_table(spark, rows(spark, [("a", 1, "d1")]), name, "dt_refe_crga", "append")
    more = spark.createDataFrame([("d2", 5, "b", "x")], "dt_refe_crga string, v int, id string, extra string")
    T.save_table(spark, more, name, "dt_refe_crga", "append", "merge")
    got = sorted(spark.table(name).select("id", "v", "extra").collect())
    assert [tuple(r) for r in got] == [("a", 1, None), ("b", 5, "x")]


def test_strict_schema_and_bad_mode(spark, db):
    name = f"{db}.t"
    T.save_table(spark, rows(spark, [("a", 1, "d1")]), name, "dt_refe_crga", "append")
    with pytest.raises(ValueError):
        T.save_table(spark, rows(spark, [("a", 1, "d1")]).withColumn("z", F.lit(1)), name, "dt_refe_crga",
                     "append", "none")
    with pytest.raises(ValueError):
        T.save_table(spark, rows(spark, [("a", 1, "d1")]), name, "dt_refe_crga", "upsert")


def test_drop_partition_and_unpartitioned_noop(spark, db):
    name = f"{db}.t"
    T.save_table(spark, rows(spark, [("a", 1, "d1"), ("b", 2, "d2")]), name, "dt_refe_crga", "append")
    assert T.drop_partition(spark, name, latest=True) == "d2"
    assert T.drop_partition(spark, name, value="d1", latest=True) == "d1"
    assert spark.table(name).count() == 0
    flat = f"{db}.flat"
    T.save_table(spark, rows(spark, [("a", 1, "d1")]), flat)
    assert T.drop_partition(spark, flat, latest=True) is None


def test_missing_table_and_load_type(spark, db):
    missing = T.read_table(spark, f"{db}.none", missing_ok=True, schema=silver.CATEGORIES_SCHEMA)
    assert missing.columns[0] == "ID_CATEGORY" and missing.isEmpty()
    assert silver.choose_load_type(missing, None) == "full"
    assert silver.choose_load_type(missing, "bogus") == "full"
    assert silver.choose_load_type(missing, "incremental") == "incremental"
    with pytest.raises(Exception):
        T.read_table(spark, f"{db}.none")


def test_changed_type_keeps_other_partitions(spark, db):
    name = f"{db}.t"
    T.save_table(spark, rows(spark, [("a", 1, "d1"), ("b", 2, "d2")]), name, "dt_refe_crga", "append")
    new = spark.createDataFrame([("c", "x", "d2"), ("d", "y", "d3")], "id string, v string, dt_refe_crga string")
    T.save_table(spark, new, name, "dt_refe_crga", "overwrite", "overwrite")
    got = spark.table(name)
    assert dict(got.dtypes)["v"] == "string"
    want = [("a", "1", "d1"), ("c", "x", "d2"), ("d", "y", "d3")]
    assert sorted(tuple(r) for r in got.select("id", "v", "dt_refe_crga").collect()) == want
    # what can't be cast raises, and the table stays as it is
    with pytest.raises(Exception):
        T.save_table(spark, rows(spark, [("e", 5, "d9")]), name, "dt_refe_crga", "overwrite", "overwrite")
    assert sorted(tuple(r) for r in spark.table(name).select("id", "v", "dt_refe_crga").collect()) == want
    assert T.list_tables(spark, db).count("t") == 1 and not [t for t in T.list_tables(spark, db) if t.startswith("t__")]
    # without partitions the frame is the new table
    flat = f"{db}.flat"
    T.save_table(spark, rows(spark, [("a", 1, "d1")]), flat)
    T.save_table(spark, new, flat, None, "overwrite", "overwrite")
    assert spark.table(flat).count() == 2 and dict(spark.table(flat).dtypes)["v"] == "string"


def test_newest_folder_without_reading_older_ones(spark, tmp_path):
    path = str(tmp_path / "lake")
    frame = rows(spark, [("a", 1, "2024-03-01"), ("b", 2, "2024-03-02"), ("c", 3, None)])
    frame.write.partitionBy("dt_refe_crga").parquet(path)
    (tmp_path / "lake" / "dt_refe_crga=2024-03-09").mkdir()  # a partition without files
    older = tmp_path / "lake" / "dt_refe_crga=2024-03-01"
    for f in older.glob("*.parquet"):
        f.write_bytes(b"not a parquet file")
    got = T.read_path(spark, path, latest_only=True)
    assert [tuple(r) for r in got.select("id", "v", "dt_refe_crga").collect()] == [("b", 2, "2024-03-02")]
    assert all("2024-03-02" in f for f in got.inputFiles())
    assert [v for v, _ in T.partition_folders(spark, path, "dt_refe_crga")] == ["2024-03-09", "2024-03-02", "2024-03-01"]


def test_overwrite_reading_own_table(spark, db):
    name = f"{db}.t"
    T.save_table(spark, rows(spark, [("a", 1, "d1"), ("b", 2, "d2")]), name, "dt_refe_crga", "append")
    again = T.read_table(spark, name, latest_only=True).withColumn("v", F.col("v") + 10)
    T.save_table(spark, again, name, "dt_refe_crga", "overwrite")
    assert sorted((r.id, r.v) for r in spark.table(name).collect()) == [("a", 1), ("b", 12)]
