"""Projection, join, flatten and id steps of the silver jobs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrine.operators.numbering import number_rows
from vitrine.session import scratch_location

# Silver column names and the bronze columns they come from.
CATALOG_COLUMNS = [
    ("id", "ID_ORIGIN"),
    ("name", "NM_PRODUCT"),
    ("seller", "NM_SELLER"),
    ("url", "DS_URL"),
    ("img", "DS_IMG"),
]
LAST_VERSION_COLUMNS = [
    ("id", "ID_ORIGIN"),
    ("name", "NM_PRODUCT"),
    ("url", "DS_URL"),
    ("img", "DS_IMG"),
    ("category", "DS_CATEGORY"),
    ("price_in_cash", "VL_CASH"),
    ("price_in_installments", "VL_INSTALLMENTS"),
    ("installments_num", "NR_INSTALLMENTS"),
    ("installment_value", "VL_SINGLE_INSTALLMENT"),
    ("seller", "NM_SELLER"),
    ("rating", "VL_RATING"),
    ("rating_users", "QT_RATING_USERS"),
    ("position", "NR_POSITION"),
]
# Columns of the newest row per URL that later loads need: the catalog's own, then those of the tie order.
CATALOG_STATE_COLUMNS = [src for src, _ in CATALOG_COLUMNS] + ["dh_exec", "position", "category"]
CATEGORY_COLUMNS = ["ID_CATEGORY", "DS_CATEGORY", "NM_SELLER", "DS_URL", "DH_ORIGIN_EXEC"]


def rename_select(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Project and rename."""
    return df.select(*[F.col(src).alias(dst) for src, dst in pairs])


def project_catalog(df: DataFrame) -> DataFrame:
    """Bronze product row -> 5 catalog columns (C4)."""
    return rename_select(df, CATALOG_COLUMNS)


def project_last_version(df: DataFrame) -> DataFrame:
    """Bronze product row -> 13 last-version columns."""
    return rename_select(df, LAST_VERSION_COLUMNS)


def catalog_id(seller: Column, url: Column, mode: str = "stable") -> Column:
    """Seller-prefixed product id.

    ``stable``: first four letters of the seller + md5 of the URL, so a full
    reload gives every product the id it had. ``random``: a fresh ``uuid()``
    per load.
    """
    if mode == "stable":
        tail = F.md5(url)
    elif mode == "random":
        tail = F.expr("uuid()")
    else:
        raise ValueError(f"unknown id mode {mode!r}")
    return F.concat_ws("-", F.substring(seller, 1, 4), tail)


def one_id_per_url(catalog: DataFrame) -> DataFrame:
    """One catalog id per URL, so a later left join cannot fan out (Q11)."""
    return catalog.groupBy("DS_URL").agg(F.max("ID_CATALOG").alias("ID_CATALOG"))


def attach_catalog_id(df: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """Left join on DS_URL for ID_CATALOG (C7); a NULL string column without catalog."""
    if catalog is None:
        return df.withColumn("ID_CATALOG", F.lit(None).cast("string"))
    return df.join(one_id_per_url(catalog.select("DS_URL", "ID_CATALOG")), "DS_URL", "left")


def normalise_label(c: Column) -> Column:
    """Drop every '+' with the blanks after it, then trim."""
    return F.trim(F.regexp_replace(c, r"\+\s*", ""))


def flatten_categories(sellers: DataFrame) -> DataFrame:
    """Seller rows with ``categories array<map>`` -> one row per category.

    Sellers with a NULL or empty list produce no row (explode); an empty map
    produces no row either; a map with several pairs contributes its first.
    """
    exploded = sellers.select(
        F.col("name").alias("NM_SELLER"),
        F.col("dh_exec").alias("DH_ORIGIN_EXEC"),
        F.explode("categories").alias("__m"),
    )
    return (
        exploded.select(
            normalise_label(F.try_element_at(F.map_keys("__m"), F.lit(1))).alias("DS_CATEGORY"),
            "NM_SELLER",
            F.try_element_at(F.map_values("__m"), F.lit(1)).alias("DS_URL"),
            "DH_ORIGIN_EXEC",
        )
        .filter(F.col("DS_CATEGORY").isNotNull())
    )


def category_order() -> Column:
    """Order of category ids: ``category|seller`` text."""
    return F.concat_ws("|", F.col("DS_CATEGORY"), F.col("NM_SELLER"))


def max_or_default(df: DataFrame, column: str, default: int = 0) -> Column:
    """Scalar column: highest integer value of ``column``, ``default`` when none."""
    return df.agg(F.coalesce(F.max(F.expr(f"try_cast({column} AS BIGINT)")), F.lit(default))).scalar()


def merge_categories(
    old: DataFrame,
    new: DataFrame,
    dense: bool = False,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Full outer merge of stored and fresh categories.

    Keys (DS_CATEGORY, NM_SELLER); the fresh side wins per column; rows only
    in the stored side stay. A label with several URLs is paired one to one:
    first rows with the same URL, then what is left by the order of the URLs,
    so no row is doubled and every id stays unique; rows without a seller are paired likewise. A stored id is kept; a new row gets max + its
    rank. As coded the rank runs over all merged rows (unique, above the
    maximum, with gaps); ``dense=True`` ranks only the new rows.
    """
    order = list(order) if order is not None else [category_order()]
    start = max_or_default(old, "ID_CATEGORY")
    o = old.select("ID_CATEGORY", "DS_CATEGORY", "NM_SELLER", "DS_URL", "DH_ORIGIN_EXEC")
    n = new.select("DS_CATEGORY", "NM_SELLER", "DS_URL", "DH_ORIGIN_EXEC")
    # both sides as one tagged relation, dealt once by the key; both windows and the grouping reuse that
    tagged = o.withColumn("__new", F.lit(False)).unionByName(
        n.withColumn("__new", F.lit(True)).withColumn("ID_CATEGORY", F.lit(None).cast(o.schema["ID_CATEGORY"].dataType)))
    key = ["DS_CATEGORY", "NM_SELLER"]
    url = Window.partitionBy(*key, "DS_URL")
    alike = Window.partitionBy(*key, "__met", "__new").orderBy("DS_URL", "ID_CATEGORY", "DH_ORIGIN_EXEC")
    placed = (
        tagged.repartition(*key)
        .withColumn("__met", F.min("__new").over(url) != F.max("__new").over(url))
        .withColumn("__k", F.row_number().over(alike)))

    def side(column: str, new: bool) -> Column:  # at most one row of each side meets
        return F.max(F.when(F.col("__new") == new, F.col(column)))

    merged = placed.groupBy(*key, "__met", "__k").agg(
        side("ID_CATEGORY", False).cast("bigint").alias("__old_id"),
        F.coalesce(side("DS_URL", True), side("DS_URL", False)).alias("DS_URL"),
        F.coalesce(side("DH_ORIGIN_EXEC", True), side("DH_ORIGIN_EXEC", False)).alias("DH_ORIGIN_EXEC"),
    ).select("__old_id", *CATEGORY_COLUMNS[1:])
    if dense:
        kept = merged.filter(F.col("__old_id").isNotNull()).withColumn("ID_CATEGORY", F.col("__old_id"))
        fresh = number_rows(merged.filter(F.col("__old_id").isNull()), order, start, "ID_CATEGORY")
        out = kept.unionByName(fresh)
    else:
        ranked = number_rows(merged, order, start, "__rank")
        out = ranked.withColumn("ID_CATEGORY", F.coalesce(F.col("__old_id"), F.col("__rank")))
    return out.select(F.col("ID_CATEGORY").cast("int").alias("ID_CATEGORY"), *CATEGORY_COLUMNS[1:])


# Keys that are broadcast at most (16 bytes each).
BROADCAST_KEYS = 100_000


def repeated_places(rows: DataFrame, columns: list[str], place: str) -> DataFrame:
    """The rows of a written table that repeat an earlier one (C11): their other columns, ``place`` among them.

    Two phases: 128-bit keys of all rows find what can repeat at all; the wide columns are compared
    only for these. Of equal rows the one with the smallest ``place`` is not returned.
    """
    spark = rows.sparkSession
    keyed = rows.withColumns({"__k1": F.xxhash64(*columns), "__k2": F.xxhash64(F.lit(7), *columns)})
    again = keyed.groupBy("__k1", "__k2").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__k1", "__k2")
    path = scratch_location(spark, "repeated-keys")
    again.write.parquet(path)
    again = spark.read.schema("__k1 bigint, __k2 bigint").parquet(path)
    few = again.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    doubtful = keyed.join(F.broadcast(again) if few else again, ["__k1", "__k2"])
    first = doubtful.groupBy(*columns).agg(F.min(place).alias(place)).select(place)
    return doubtful.select(*[c for c in rows.columns if c not in columns]).join(first, place, "left_anti")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, lazily (C17)."""
    return df.select(column).distinct()


def top_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows in ``order`` (C19, C20): per-task top-n, then one merge."""
    return df.orderBy(*order).limit(n)


def sql_over_view(df: DataFrame, query: str) -> DataFrame:
    """Run SQL with ``{df}`` standing for the frame."""
    name = f"_vitrine_v_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    try:
        # the query is analysed here, with the view's plan inlined
        return df.sparkSession.sql(query.format(df=name))
    finally:
        df.sparkSession.catalog.dropTempView(name)


def frame_from_rows(spark: SparkSession, rows: Iterable[dict], schema: StructType) -> DataFrame:
    """A few local rows with a fixed nested schema (C25), e.g. a source list."""
    return spark.createDataFrame(list(rows), schema)
