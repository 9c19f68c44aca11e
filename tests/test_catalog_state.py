"""The catalog by increments against its rebuild from all loads."""

import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators.relational import CATALOG_STATE_COLUMNS
from vitrine.plans import silver
from vitrine.session import scratch_location
from vitrine.sources import tables as T

SCHEMA = ("id string, name string, seller string, url string, img string, category string, position int, "
          "price_in_cash double, dt_refe_crga string, dh_exec timestamp")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
RUN = "2024-05-09 06:00:00"


@pytest.fixture()
def db(spark):
    name = f"vitrine_state_{random.randrange(10**9)}"
    T.create_database(spark, name, scratch_location(spark, name))
    yield name
    T.drop_database(spark, name)


def load(spark, day, seed, n=200, stamp_day=None):
    """Rows of one load: ties in the stamp, nulls, repeated rows, a null URL."""
    import datetime as dt

    rng, rows = random.Random(seed), []
    for i in range(n):
        k = rng.randrange(60)
        stamp = dt.datetime(2024, 5, int((stamp_day or day)[-2:]), rng.randrange(3))
        rows.append((str(rng.randrange(1000)) if k % 9 else None, f"n{seed}-{i}", "Zoom", f"u{k}" if k else None, f"i{i}",
                     rng.choice(["a", "b", None]), rng.choice([1, 2, None]), 1.0, day, stamp if k % 7 else None))
    return spark.createDataFrame(rows + rows[:5], SCHEMA)


def key_rows(df):
    # rows that tie in the whole version order may stand for each other, so names and images are left out
    return sorted(map(repr, df.select("url", "id", "seller", "dh_exec", "position", "category").collect()))


def catalog_rows(df):
    return sorted(map(repr, df.select("DS_URL", "ID_ORIGIN", "ID_CATALOG", "dt_refe_crga", "dh_exec").collect()))


def rebuilt(spark, table):
    return silver.merge_catalog_state(None, T.read_table(spark, table))


def scanned(df):
    """Partition folders of b_products that a plan lists to read."""
    return {f.split("dt_refe_crga=")[1].split("/")[0] for f in df.inputFiles() if "b_products" in f}


def test_three_loads_equal_the_rebuild_and_scan_one_partition(spark, db, monkeypatch):
    table, state = f"{db}.b_products", f"{db}.s_state"
    seen = []
    merge = silver.merge_catalog_state
    monkeypatch.setattr(silver, "merge_catalog_state", lambda s, f: (seen.append(scanned(f)), merge(s, f))[1])
    for k, day in enumerate(["2024-05-01", "2024-05-02", "2024-05-03"]):
        T.save_table(spark, load(spark, day, k), table, "dt_refe_crga", "append")
        seen.clear()
        got = silver.update_catalog_state(spark, table, state)
        assert seen == [{day}]
        assert got.columns == [*CATALOG_STATE_COLUMNS, "dt_refe_crga"]
        assert key_rows(got) == key_rows(rebuilt(spark, table))


def test_rerun_of_a_load_replaces_what_it_gave(spark, db):
    table, state = f"{db}.b_products", f"{db}.s_state"
    for k, day in enumerate(["2024-05-01", "2024-05-02"]):
        T.save_table(spark, load(spark, day, k), table, "dt_refe_crga", "append")
        silver.update_catalog_state(spark, table, state)
    T.save_table(spark, load(spark, "2024-05-02", 9, n=20), table, "dt_refe_crga", "overwrite")
    got = silver.update_catalog_state(spark, table, state)
    assert key_rows(got) == key_rows(rebuilt(spark, table))


def test_older_load_rewritten_and_late_stamps(spark, db):
    table, state = f"{db}.b_products", f"{db}.s_state"
    days = ["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-04", "2024-05-05"]
    for k, day in enumerate(days):
        # stamps that don't follow the load dates
        T.save_table(spark, load(spark, day, k, stamp_day=days[-1 - k]), table, "dt_refe_crga", "append")
        silver.update_catalog_state(spark, table, state, keep=4)
    T.save_table(spark, load(spark, "2024-05-03", 77, n=10), table, "dt_refe_crga", "overwrite")
    got = silver.update_catalog_state(spark, table, state, changed_since="2024-05-03", keep=4)
    assert key_rows(got) == key_rows(rebuilt(spark, table))
    assert [r[0] for r in T.list_partitions(spark, state).collect()] == ["2024-05-05", "2024-05-02"]


def test_only_some_states_are_kept(spark, db):
    table, state = f"{db}.b_products", f"{db}.s_state"
    for k, day in enumerate(["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-04"]):
        T.save_table(spark, load(spark, day, k, n=10), table, "dt_refe_crga", "append")
        got = silver.update_catalog_state(spark, table, state, keep=2)
    assert [r[0] for r in T.list_partitions(spark, state).collect()] == ["2024-05-04", "2024-05-03"]
    # a rewrite before all kept states reads all loads
    again = silver.update_catalog_state(spark, table, state, changed_since="2024-05-01", keep=2)
    assert key_rows(again) == key_rows(got)


def test_loads_without_a_date(spark, db):
    table, state = f"{db}.b_products", f"{db}.s_state"
    T.save_table(spark, load(spark, None, 1, stamp_day="2024-05-08"), table, "dt_refe_crga", "append")
    assert key_rows(silver.update_catalog_state(spark, table, state)) == key_rows(rebuilt(spark, table))
    assert not spark.catalog.tableExists(state)
    for k, day in enumerate(["2024-05-01", "2024-05-02"]):
        T.save_table(spark, load(spark, day, k), table, "dt_refe_crga", "append")
        assert key_rows(silver.update_catalog_state(spark, table, state)) == key_rows(rebuilt(spark, table))


def test_empty_load(spark, db):
    table, state = f"{db}.b_products", f"{db}.s_state"
    T.save_table(spark, load(spark, "2024-05-01", 1).limit(0), table, "dt_refe_crga", "append")
    assert silver.update_catalog_state(spark, table, state).count() == 0


def test_run_in_both_modes_gives_the_same_tables(spark, db):
    dbs = {"BRONZE": db, "SILVER": db}
    for k, day in enumerate(["2024-05-01", "2024-05-02"]):
        rows = load(spark, day, k).withColumn("id", F.monotonically_increasing_id().cast("string"))
        for c in ("price_in_installments", "installment_value", "rating"):
            rows = rows.withColumn(c, F.lit(0.0))
        rows = rows.withColumns({"installments_num": F.lit(0), "rating_users": F.lit(0)})
        T.save_table(spark, rows, f"{db}.b_products", "dt_refe_crga", "append")
        done = silver.run_silver(spark, f"{day} 08:00:00", databases=dbs, catalog_mode="incremental")
        step = catalog_rows(T.read_table(spark, done["catalog"], latest_only=True))
        silver.run_silver(spark, f"{day} 08:00:00", databases=dbs)
        assert step == catalog_rows(T.read_table(spark, done["catalog"], latest_only=True))
    with pytest.raises(ValueError, match="catalog mode"):
        silver.run_silver(spark, RUN, databases=dbs, catalog_mode="none")
