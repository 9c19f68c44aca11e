"""Silver jobs (J3-J7, J9): product catalog, last version, category catalog.

Each ``build_*`` function is DataFrame -> DataFrame and takes ``run_ts``
explicitly; ``run_silver`` reads the bronze tables and writes the three
silver tables, one Spark job per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from vitrine.operators.latest import latest_per_key, product_version_order
from vitrine.operators.numbering import number_rows
from vitrine.operators.relational import (
    CATALOG_STATE_COLUMNS,
    CATEGORY_COLUMNS,
    LAST_VERSION_COLUMNS,
    attach_catalog_id,
    catalog_id,
    category_order,
    flatten_categories,
    merge_categories,
    project_catalog,
    project_last_version,
)
from vitrine.session import PARTITION_COLUMN, layer_table
from vitrine.sources import tables as T

LOAD_TYPES = ("full", "incremental")
CATALOG_MODES = ("full", "incremental")

CATEGORIES_SCHEMA = StructType(
    [
        StructField("ID_CATEGORY", IntegerType()),
        StructField("DS_CATEGORY", StringType()),
        StructField("NM_SELLER", StringType()),
        StructField("DS_URL", StringType()),
        StructField("DH_ORIGIN_EXEC", TimestampType()),
        StructField(PARTITION_COLUMN, StringType()),
        StructField("dh_exec", TimestampType()),
    ]
)
CATALOG_SCHEMA = StructType(
    [StructField(n, StringType()) for n in ("ID_ORIGIN", "NM_PRODUCT", "NM_SELLER", "DS_URL", "DS_IMG", "ID_CATALOG")]
    + [StructField(PARTITION_COLUMN, StringType()), StructField("dh_exec", TimestampType())]
)


def run_date_of(run_ts) -> Column:
    """Load date text of a run timestamp, in the session time zone."""
    return F.date_format(T.load_ts_column(run_ts), "yyyy-MM-dd")


def build_catalog(bronze_products: DataFrame, run_ts, id_mode: str = "stable") -> DataFrame:
    """Newest row per URL over all loads, 5 columns, catalog id, stamps."""
    return catalog_from_newest(latest_per_key(bronze_products, ["url"], product_version_order()), run_ts, id_mode)


def catalog_from_newest(newest: DataFrame, run_ts, id_mode: str = "stable") -> DataFrame:
    """Catalog rows of the newest product row per URL."""
    catalog = project_catalog(newest).withColumn(
        "ID_CATALOG", catalog_id(F.col("NM_SELLER"), F.col("DS_URL"), id_mode)
    )
    return T.with_load_stamp(catalog, run_ts)


def merge_catalog_state(state: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Newest row per URL of a stored state and further product rows.

    The state keeps the columns of the version order, so the merge is the maximum of two maxima: in whatever
    steps the loads are merged, the rows are those of a rebuild from all loads. Merging a row again changes nothing.
    """
    rows = fresh.select(*CATALOG_STATE_COLUMNS)
    if state is not None:
        rows = state.select(*CATALOG_STATE_COLUMNS).unionByName(rows)
    return latest_per_key(rows, ["url"], product_version_order())


def update_catalog_state(
    spark: SparkSession, products_name: str, state_name: str, changed_since: str | None = None, keep: int = 3
) -> DataFrame:
    """J3 by increments: the newest row per URL over all loads, from the last state and the loads after it.

    ``state_name`` holds one state a load date, complete up to that load. The run starts from the newest state
    before the newest load, so a rerun of a load replaces what it gave, and scans only the product partitions
    after that state (and the one without a load date, which has no place in the order of loads). Loads that were
    rewritten or added further back are named by ``changed_since``, the oldest such load date: states from there on
    are dropped and their loads merged again. Without a usable state all loads are read. The newest ``keep``
    states stay. Returns the state's rows; without a single dated load they are not stored.
    """
    products = T.read_table(spark, products_name)
    part = F.col(PARTITION_COLUMN)
    # partition values, from the catalog: one a load
    loads = [r[0] for r in T.list_partitions(spark, products_name).collect() if r[0] is not None]
    if not loads:
        return merge_catalog_state(None, products)
    newest = max(loads)
    start = min(newest, changed_since or newest)
    stored = spark.catalog.tableExists(state_name)
    states = [r[0] for r in T.list_partitions(spark, state_name).collect()] if stored else []
    for value in states:
        if value >= start and value != newest:  # the newest one is replaced by the write below
            T.drop_partition(spark, state_name, value)
    before = sorted((s for s in states if s < start), reverse=True)
    if before:
        state = T.read_table(spark, state_name).filter(part == before[0])
        fresh = products.filter((part > before[0]) | part.isNull())
    else:
        state, fresh = None, products
    merged = merge_catalog_state(state, fresh).withColumn(PARTITION_COLUMN, F.lit(newest))
    T.save_table(spark, merged, state_name, PARTITION_COLUMN, "overwrite")
    for value in before[max(keep - 1, 1):]:  # one earlier state must stay for a rerun
        T.drop_partition(spark, state_name, value)
    return T.read_table(spark, state_name).filter(part == newest)


def build_last_version(
    bronze_products: DataFrame,
    catalog: DataFrame | None,
    run_ts,
    ignore_delay: bool = False,
    partitions: DataFrame | None = None,
) -> DataFrame:
    """Newest row per URL within the chosen load, 13 columns + catalog id, stamps.

    The load filter comes before the window on purpose: it is a partition
    filter, not a window key, so the result is the newest row *of that load*.
    """
    chosen = T.read_chosen_partition(bronze_products, run_date_of(run_ts), PARTITION_COLUMN, ignore_delay, partitions)
    newest = latest_per_key(chosen, ["url"], product_version_order())
    version = attach_catalog_id(project_last_version(newest), catalog)
    version = version.select(*[dst for _, dst in LAST_VERSION_COLUMNS], "ID_CATALOG")
    return T.with_load_stamp(version, run_ts)


def _newest_seller_rows(sellers: DataFrame) -> DataFrame:
    # the content breaks ties, so every pass chooses the same row
    content = F.to_json(F.struct("name", "categories"))
    return latest_per_key(sellers, ["id"], [F.col("dh_exec").desc(), F.col(PARTITION_COLUMN).desc(), content.asc()])


def category_id_order() -> list[Column]:
    """Order of new category ids; the text key first, then tie-breakers."""
    return [category_order(), F.col("DS_URL"), F.col("DH_ORIGIN_EXEC")]


def build_categories_full(sellers: DataFrame, run_ts) -> DataFrame:
    """Newest row per seller over all loads, flattened, ids from 1."""
    flat = flatten_categories(_newest_seller_rows(sellers)).distinct()
    numbered = number_rows(flat, category_id_order(), 0, "ID_CATEGORY")
    out = numbered.select(F.col("ID_CATEGORY").cast("int").alias("ID_CATEGORY"), *CATEGORY_COLUMNS[1:])
    return T.with_load_stamp(out, run_ts)


def build_categories_incremental(
    sellers: DataFrame,
    existing: DataFrame,
    run_ts,
    ignore_delay: bool = False,
    dense: bool = False,
    partitions: DataFrame | None = None,
) -> DataFrame:
    """Newest row per seller in the chosen load, merged into the stored ids."""
    chosen = T.read_chosen_partition(sellers, run_date_of(run_ts), PARTITION_COLUMN, ignore_delay, partitions)
    fresh = flatten_categories(_newest_seller_rows(chosen)).distinct()
    merged = merge_categories(existing, fresh, dense=dense, order=category_id_order())
    return T.with_load_stamp(merged, run_ts)


def choose_load_type(existing: DataFrame, load_type: str | None) -> str:
    """The given type when valid, else full for an empty silver table, else incremental."""
    if load_type in LOAD_TYPES:
        return load_type
    return "full" if existing.isEmpty() else "incremental"


def run_silver(
    spark: SparkSession,
    run_ts,
    ignore_delay: bool = False,
    load_type: str | None = None,
    id_mode: str = "stable",
    dense: bool = False,
    databases: dict[str, str] | None = None,
    catalog_mode: str = "full",
    changed_since: str | None = None,
) -> dict[str, str]:
    """Catalog, then last version (needs the catalog ids), then categories.

    ``catalog_mode="incremental"`` merges only the loads after the stored state (:func:`update_catalog_state`).
    """
    if catalog_mode not in CATALOG_MODES:
        raise ValueError(f"catalog mode {catalog_mode!r} not supported; use one of {CATALOG_MODES}")
    products_name = layer_table("BRONZE", "products", databases)
    sellers_name = layer_table("BRONZE", "sellers", databases)
    catalog_name = layer_table("SILVER", "catalog", databases)
    version_name = layer_table("SILVER", "last_version", databases)
    categories_name = layer_table("SILVER", "categories", databases)
    T.create_database(spark, catalog_name.split(".")[0])
    done: dict[str, str] = {}

    products = T.read_table(spark, products_name, missing_ok=True)
    if products.columns and not products.isEmpty():
        if catalog_mode == "incremental":
            state_name = layer_table("SILVER", "catalog_state", databases)
            state = update_catalog_state(spark, products_name, state_name, changed_since)
            catalog = catalog_from_newest(state, run_ts, id_mode)
        else:
            catalog = build_catalog(products, run_ts, id_mode)
        T.save_table(spark, catalog, catalog_name, PARTITION_COLUMN, "overwrite")
        catalog = T.read_table(spark, catalog_name, latest_only=True, missing_ok=True, schema=CATALOG_SCHEMA)
        version = build_last_version(products, catalog, run_ts, ignore_delay, T.list_partitions(spark, products_name))
        T.save_table(spark, version, version_name, PARTITION_COLUMN, "overwrite")
        done["catalog"] = catalog_name
        done["last_version"] = version_name

    sellers = T.read_table(spark, sellers_name, missing_ok=True)
    if sellers.columns and not sellers.isEmpty():
        existing = T.read_table(spark, categories_name, latest_only=True, missing_ok=True, schema=CATEGORIES_SCHEMA)
        kind = choose_load_type(existing, load_type)
        if kind == "full":
            out = build_categories_full(sellers, run_ts)
        else:
            out = build_categories_incremental(
                sellers, existing, run_ts, ignore_delay, dense, T.list_partitions(spark, sellers_name)
            )
        T.save_table(spark, out, categories_name, PARTITION_COLUMN, "overwrite")
        done["categories"] = f"{categories_name} ({kind})"
    return done
