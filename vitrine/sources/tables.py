"""Table layer over managed Parquet tables.

Every table is a managed Parquet table, hive-partitioned by the load date
string. Reads are lazy DataFrames; writes are single Spark jobs:

* append with schema merge  -> ``ALTER TABLE ADD COLUMNS`` + ``INSERT INTO BY NAME``
* partition overwrite       -> ``INSERT OVERWRITE BY NAME`` in dynamic mode
* whole-table overwrite     -> ``INSERT OVERWRITE BY NAME`` in static mode

so a rerun of the same load replaces its partition instead of duplicating it.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrine.session import LOAD_TS_COLUMN, PARTITION_COLUMN, checkpoint_root

SAVE_MODES = ("append", "overwrite")
SCHEMA_OPTIONS = ("merge", "overwrite", "none")


def _quote(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _temp_view(df: DataFrame):
    name = f"_vitrine_src_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


# --------------------------------------------------------------------------- reads


def empty_frame(spark: SparkSession, schema: StructType | None = None) -> DataFrame:
    """Typed empty frame (T3); an empty StructType when no schema is known."""
    return spark.createDataFrame([], schema or StructType([]))


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a registered table, in declared order (T5)."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def latest_partition(df: DataFrame, part: str = PARTITION_COLUMN) -> DataFrame:
    """Rows of the newest partition.

    The maximum is a scalar subquery, so a partitioned scan prunes to one
    partition in the same query; no value travels through the driver.
    """
    return df.filter(F.col(part) == df.select(F.max(part)).scalar())


def read_table(
    spark: SparkSession,
    name: str,
    latest_only: bool = False,
    missing_ok: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a registered table, whole or newest partition only.

    A missing table raises unless ``missing_ok``; then an empty frame with
    ``schema`` (or no columns) comes back, so callers can still project it.
    """
    if not spark.catalog.tableExists(name):
        if missing_ok:
            return empty_frame(spark, schema)
        raise AnalysisException(f"table {name} not found")
    df = spark.table(name)
    if latest_only:
        parts = partition_columns(spark, name)
        if parts:
            # newest value from the catalog's partition list: no file listing
            newest = list_partitions(spark, name).agg(F.max(parts[0])).scalar()
            df = df.filter(F.col(parts[0]) == newest)
    return df


def partition_folders(spark: SparkSession, path: str, partition_column: str) -> list[tuple[str, str]]:
    """``(value, folder)`` of the partitions of a folder, newest first, from a listing of the folder
    itself (one name a partition); the NULL partition is left out."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    prefix = f"{partition_column}="
    found = []
    for status in store.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix) and name != prefix + NULL_PARTITION:
            found.append((unquote(name[len(prefix):]), status.getPath().toString()))
    return sorted(found, reverse=True)


def read_path(
    spark: SparkSession,
    path: str,
    latest_only: bool = False,
    partition_column: str | None = PARTITION_COLUMN,
) -> DataFrame:
    """Read an unregistered hive-partitioned Parquet folder (T4).

    The partition column is a string, so that a date-like value is never inferred as DATE, whatever
    the session setting. With ``latest_only`` the newest partition is chosen from a listing of the folder's own
    entries; no file of an older partition is listed or read. Columns that only older partitions have are not
    returned then. A folder without such partitions is read whole.
    """
    if latest_only and partition_column:
        for value, folder in partition_folders(spark, path, partition_column):
            try:
                df = spark.read.parquet(folder)
            except AnalysisException as e:  # no file in this partition: the next older one is the newest
                if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                    continue
                raise
            return df.withColumn(partition_column, F.lit(value))
    df = spark.read.parquet(path)
    if partition_column and partition_column in df.columns:
        df = df.withColumn(partition_column, F.col(partition_column).cast("string"))
        if latest_only:
            df = latest_partition(df, partition_column)
    return df


# Fixed value: name of the partition that holds NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Partition values, newest first (T6), from the catalog only."""
    parts = partition_columns(spark, name)
    if not parts:
        raise ValueError(f"table {name} is not partitioned")
    p = parts[0]
    shown = spark.sql(f"SHOW PARTITIONS {name}")
    value = F.nullif(F.regexp_extract("partition", rf"(?:^|/){p}=([^/]*)", 1), F.lit(NULL_PARTITION))
    # special characters are listed as %XX; a plus sign stands for itself
    return (
        shown.select(F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(p))
        .distinct()
        .orderBy(F.col(p).desc())
    )


def list_loads(df: DataFrame, column: str = LOAD_TS_COLUMN) -> DataFrame:
    """Distinct load timestamps, newest first."""
    from vitrine.operators.relational import distinct_values

    return distinct_values(df, column).orderBy(F.col(column).desc())


def aim_partition_frame(
    df: DataFrame,
    run_date,
    part: str = PARTITION_COLUMN,
    ignore_delay: bool = False,
) -> DataFrame:
    """One-row frame with the input partition to process.

    By default a load runs one day behind: when the newest partition is the
    run date itself and an older one exists, the older one is chosen. With
    ``ignore_delay`` the newest partition is taken. A run date before the
    newest partition still gives the newest.
    """
    p = F.col(part)
    latest = F.max(p)
    if ignore_delay:
        aim = latest
    else:
        run = run_date if isinstance(run_date, Column) else F.lit(str(run_date))
        before = F.max(F.when(p < run, p))
        aim = F.when(latest == run, F.coalesce(before, latest)).otherwise(latest)
    return df.agg(aim.alias("aim_partition"))


def read_chosen_partition(
    df: DataFrame,
    run_date,
    part: str = PARTITION_COLUMN,
    ignore_delay: bool = False,
    partitions: DataFrame | None = None,
) -> DataFrame:
    """Rows of the partition chosen by :func:`aim_partition_frame` (T7 + C2).

    ``partitions`` (e.g. :func:`list_partitions` of the table) lets the choice
    come from the catalog instead of a scan of the partition column.
    """
    aim = aim_partition_frame(partitions if partitions is not None else df, run_date, part, ignore_delay).scalar()
    return df.filter(F.col(part) == aim)


# --------------------------------------------------------------------------- writes


def _field_sql(field) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"


def _schema_gap(table_schema: StructType, df_schema: StructType):
    known = {f.name.lower(): f for f in table_schema}
    new = [f for f in df_schema if f.name.lower() not in known]
    changed = [
        f.name
        for f in df_schema
        if f.name.lower() in known and known[f.name.lower()].dataType != f.dataType
    ]
    missing = [f.name for f in table_schema if f.name.lower() not in {x.name.lower() for x in df_schema}]
    return new, changed, missing


def _create(df: DataFrame, name: str, partition_column: str | None, mode: str) -> None:
    writer = df.write.format("parquet").mode(mode)
    if partition_column:
        writer = writer.partitionBy(partition_column)
    writer.saveAsTable(name)


def save_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    partition_column: str | None = None,
    mode: str = "append",
    schema_option: str = "merge",
) -> None:
    """Write ``df`` into table ``name``.

    mode ``append``: add the rows. mode ``overwrite`` with a partition
    column: replace exactly the partitions present in ``df`` (one dynamic
    ``INSERT OVERWRITE`` job). ``overwrite`` without one: replace the table.

    schema_option ``merge``: new columns are added to the table, columns the
    frame lacks are written as NULL. ``overwrite``: a differing schema makes
    the frame the new table; when partitions are overwritten, the table's other partitions stay, and where a
    column's type changes they are cast to it (a value that can't be cast raises, and nothing changes).
    ``none``: any difference raises.

    Columns are always matched by name, never by position. A missing table is
    created from the frame whatever the mode.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"save mode {mode!r} not supported; use one of {SAVE_MODES}")
    if schema_option not in SCHEMA_OPTIONS:
        raise ValueError(f"schema option {schema_option!r} not supported; use one of {SCHEMA_OPTIONS}")

    if not spark.catalog.tableExists(name):
        _create(df, name, partition_column, "append")
        return

    new, changed, missing = _schema_gap(spark.table(name).schema, df.schema)
    if schema_option == "none" and (new or changed or missing):
        raise ValueError(
            f"schema of {name} differs: new={[f.name for f in new]} changed={changed} missing={missing}"
        )
    if schema_option == "overwrite" and mode == "append" and (new or changed or missing):
        raise ValueError(f"appending to {name} can't replace its schema: use schema_option='merge' or mode='overwrite'")
    if schema_option == "overwrite" and mode == "overwrite" and partition_column:
        if changed:
            _rewrite_with_types(spark, df, name, partition_column)
            return
        schema_option = "merge"  # the other partitions stay
    if schema_option == "overwrite" and (new or changed or missing):
        # A new schema replaces the table, as a schema-overwriting write does.
        # The frame is checkpointed to the shared checkpoint folder first, as
        # it may read the very table being replaced.
        checkpoint_root(spark)
        _create(df.checkpoint(eager=True), name, partition_column, "overwrite")
        return
    if changed:
        raise ValueError(f"column types of {name} differ for {changed}; use schema_option='overwrite'")
    if new:
        cols = ", ".join(_field_sql(f) for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")

    with _temp_view(df) as view:
        if mode == "append":
            spark.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {view}")
        elif partition_column:
            with session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                spark.sql(f"INSERT OVERWRITE TABLE {name} BY NAME SELECT * FROM {view}")
        else:
            with session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
                spark.sql(f"INSERT OVERWRITE TABLE {name} BY NAME SELECT * FROM {view}")


def _rewrite_with_types(spark: SparkSession, df: DataFrame, name: str, partition_column: str) -> None:
    """Overwrite the partitions of ``df`` where its column types differ from the table's.

    Frame and other partitions, cast to the frame's types, are written beside the table, as ``<name>__staged_*``, and
    replace it from there: a failure before that leaves the table as it was, one in the
    middle of it leaves all rows in the staged table.
    """
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    old = spark.table(name)
    cast = old.select(*[F.col(c).cast(kinds[c.lower()]).alias(c) if c.lower() in kinds else F.col(c) for c in old.columns])
    own = df.select(F.col(partition_column).alias("__own")).distinct()
    others = cast.join(own, F.col(partition_column).eqNullSafe(F.col("__own")), "left_anti")
    staged = f"{name}__staged_{uuid.uuid4().hex[:8]}"
    try:
        _create(others.unionByName(df, allowMissingColumns=True), staged, partition_column, "errorifexists")
    except Exception:
        drop_table(spark, staged)
        raise
    _create(spark.table(staged), name, partition_column, "overwrite")
    drop_table(spark, staged)


def drop_partition(
    spark: SparkSession,
    name: str,
    value: str | None = None,
    latest: bool = False,
) -> str | None:
    """Drop one partition, given or newest (T14); returns the value dropped.

    An explicit value wins over ``latest``. A table without partitions is
    left alone and ``None`` comes back.
    """
    parts = partition_columns(spark, name)
    if not parts:
        return None
    p = parts[0]
    if value is None:
        if not latest:
            raise ValueError("give a partition value or latest=True")
        row = list_partitions(spark, name).agg(F.max(p)).first()  # from the catalog, no scan
        value = row[0] if row else None
        if value is None:
            return None
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({p} = {_quote(value)})")
    return str(value)


def truncate_table(spark: SparkSession, name: str) -> None:
    """Remove all rows, keep table and schema."""
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def register_table(spark: SparkSession, name: str, path: str, partition_column: str | None = PARTITION_COLUMN) -> DataFrame:
    """Register a Parquet folder as a table and load its partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING PARQUET LOCATION {_quote(path)}")
    if partition_columns(spark, name):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def create_database(
    spark: SparkSession, name: str, location: str | None = None, comment: str | None = None, properties: dict[str, str] | None = None
) -> bool:
    """Create a database unless it exists (T18); True when it was created."""
    if spark.catalog.databaseExists(name):
        return False
    more = f" COMMENT {_quote(comment)}" if comment else ""
    more += f" LOCATION {_quote(location)}" if location else ""
    if properties:
        more += " WITH DBPROPERTIES (" + ", ".join(f"{_quote(k)} = {_quote(v)}" for k, v in properties.items()) + ")"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{more}")
    return True


def describe_database(spark: SparkSession, name: str) -> DataFrame:
    """Database properties (T18): ``(info_name, info_value)``, among them name, comment, location, owner and properties."""
    return spark.sql(f"DESCRIBE DATABASE EXTENDED {name}")


def list_tables(spark: SparkSession, name: str) -> list[str]:
    """Table names of a database."""
    return sorted(t.name for t in spark.catalog.listTables(name) if not t.isTemporary)


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database with all its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


# --------------------------------------------------------------------------- stamps


def load_ts_column(run_ts) -> Column:
    """The load timestamp as a column: a Column, datetime or 'yyyy-MM-dd HH:mm:ss' text."""
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp")
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(str(run_ts)))


def with_load_stamp(df: DataFrame, run_ts, part: str = PARTITION_COLUMN, ts_col: str = LOAD_TS_COLUMN) -> DataFrame:
    """Add the load date partition and the load timestamp.

    Both come from one ``run_ts`` argument, in the session time zone, so a
    job rerun with the same argument writes the same partition.
    """
    ts = load_ts_column(run_ts)
    return df.withColumn(part, F.date_format(ts, "yyyy-MM-dd")).withColumn(ts_col, ts)
