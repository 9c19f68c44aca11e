"""Bronze-shaped inputs derived, with Spark, from the driver tables.

``events`` stands for product observations: ``user_id`` is the product
(URL), ``ts`` the load timestamp, its date the load partition,
``event_type`` the seller and the ``k`` of ``props`` the category. Every
column is a plain expression, so the frame is as large as ``events`` and
partitions like it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import LOAD_TS_COLUMN, PARTITION_COLUMN

# URL prefixes of the stand-in shop.
PRODUCT_URL_PREFIX = "https://loja.example/p/"
IMAGE_URL_PREFIX = "https://img.loja.example/"


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def products_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> rows with the b_products schema (partition + stamp included)."""
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("produto "), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit(PRODUCT_URL_PREFIX), F.col("user_id").cast("string")).alias("url"),
        F.concat(F.lit("cat-"), k).alias("category"),
        F.col("value").alias("price_in_cash"),
        F.lit(None).cast("double").alias("price_in_installments"),
        F.lit(0).alias("installments_num"),
        F.lit(-999.0).alias("installment_value"),
        F.concat(F.lit(IMAGE_URL_PREFIX), F.col("user_id").cast("string"), F.lit(".jpg")).alias("img"),
        F.col("event_type").alias("seller"),
        F.lit(-999.0).alias("rating"),
        F.lit(0).alias("rating_users"),
        (k.cast("int") + 1).alias("position"),
        F.date_format("ts", "yyyy-MM-dd").alias(PARTITION_COLUMN),
        F.col("ts").alias(LOAD_TS_COLUMN),
    )


def events_run_ts(events: DataFrame):
    """Scalar column: the run happens at the newest observation."""
    return events.agg(F.max("ts")).scalar()


def sources_from_suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """``supplier`` x ``nation`` -> source list rows (id, name, url, categories, active).

    url is ``array<array<string>>`` of [url, kind] (0 home, 1 categories,
    2 products); some suppliers have no kind-1 entry, some two.
    """
    s = supplier.join(nation.select("n_nationkey", "n_name"), supplier.s_nationkey == nation.n_nationkey)
    home = F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example/"), F.col("s_suppkey").cast("string"), F.lit("/"))
    entries = F.array(
        F.array(home, F.lit("0")),
        F.when(F.col("s_acctbal") > 3000, F.array(F.concat(home, F.lit("categorias")), F.lit("1"))),
        F.array(F.concat(home, F.lit("ofertas")), F.lit("2")),
        F.when(F.col("s_acctbal") > 6000, F.array(F.concat(home, F.lit("todas-categorias")), F.lit("1"))),
    )
    fixed = F.when(
        F.col("s_acctbal") > 8000, F.array(F.create_map(F.lit("Ofertas"), F.concat(home, F.lit("ofertas"))))
    ).otherwise(F.array().cast("array<map<string,string>>"))
    return s.select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.col("s_name").alias("name"),
        F.filter(entries, lambda x: x.isNotNull()).alias("url"),
        fixed.alias("categories"),
        (F.col("s_acctbal") >= 0).alias("active"),
    )


def seller_loads_from_pages(pages: DataFrame) -> DataFrame:
    """``pages`` -> b_sellers-shaped history: one seller row per page.

    The seller is the host; the page is one load of the seller's category
    page (``dh_exec`` = 2024-03-01 + page_id hours); its ``<nav>`` links are
    the categories found. Arrays are bounded by one page's links.
    """
    from vitrine.functions.html import text_of
    from vitrine.operators.pages import categories_as_maps, host_of
    from vitrine.sources.listing_html import nav_links_raw

    links = nav_links_raw(pages).select(
        "page_id",
        F.col("url").alias("page_url"),
        host_of("url").alias("host"),
        "pos",
        F.coalesce(text_of("label_html"), F.lit("")).alias("name"),
        F.concat(F.lit("https://"), host_of("url"), F.col("href")).alias("url"),
    )
    # one group per page (its page url rides along as a key): no join back
    found = categories_as_maps(links, ["page_id", "page_url", "host"])
    kind = F.when(F.col("page_url").contains("?"), "1").otherwise("0")
    ts = F.expr("timestampadd(HOUR, page_id, TIMESTAMP_NTZ '2024-03-01 00:00:00')")
    return found.select(
        F.substring(F.md5("host"), 1, 12).alias("id"),
        F.col("host").alias("name"),
        F.array(F.array(F.col("page_url"), kind)).alias("url"),
        F.col("found").alias("categories"),
        F.date_format(ts, "yyyy-MM-dd").alias(PARTITION_COLUMN),
        ts.alias(LOAD_TS_COLUMN),
    )


def sources_from_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pages`` -> (sources, links) for the seller load.

    A source per host: its category page is chosen among the host's pages
    (kind 1 = URL with a query string, else kind 0; the highest page id
    wins); active when one of its pages is served over https; hosts starting
    with ``www.`` carry one configured category. ``links`` are the ``<nav>``
    links of each chosen page.
    """
    from vitrine.functions.html import text_of
    from vitrine.operators.pages import host_of
    from vitrine.sources.listing_html import nav_links_raw

    kind = F.when(F.col("url").contains("?"), "1").otherwise("0")
    cand = pages.select(host_of("url").alias("host"), "url", "page_id", kind.alias("kind"))
    rank = F.struct((F.col("kind") == "1").alias("k1"), F.col("page_id"))
    per_host = cand.groupBy("host").agg(
        F.min("page_id").alias("id"),
        F.bool_or(F.col("url").startswith("https://")).alias("active"),
        F.max_by("url", rank).alias("category_url"),
        F.max_by("kind", rank).alias("category_kind"),
        F.max_by("page_id", rank).alias("category_page"),
    )
    fixed = F.when(
        F.col("host").startswith("www."),
        F.array(F.create_map(F.lit("Ofertas"), F.concat(F.lit("https://"), F.col("host"), F.lit("/ofertas")))),
    ).otherwise(F.array().cast("array<map<string,string>>"))
    sources = per_host.select(
        F.col("id").cast("int").alias("id"),
        F.col("host").alias("name"),
        F.array(F.array("category_url", "category_kind")).alias("url"),
        fixed.alias("categories"),
        "active",
        "category_page",
    )
    chosen = sources.select(F.col("category_page").alias("page_id"), F.col("name").alias("seller"))
    links = nav_links_raw(pages).join(chosen, "page_id").select(
        "seller",
        "pos",
        F.coalesce(text_of("label_html"), F.lit("")).alias("name"),
        F.concat(F.lit("https://"), F.col("seller"), F.col("href")).alias("url"),
    )
    return sources.drop("category_page"), links
