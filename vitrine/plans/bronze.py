"""Bronze jobs (J1, J2, J8): product observations and seller category lists.

Pages come in as a table; nothing is fetched or parsed on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from vitrine.operators import pages as P
from vitrine.operators.dialects import DIALECTS
from vitrine.operators.latest import latest_per_key
from vitrine.operators.relational import frame_from_rows, max_or_default, repeated_places
from vitrine.session import PARTITION_COLUMN, layer_table, scratch_location
from vitrine.sources import tables as T

# Bronze product schema (before the load stamps).
PRODUCTS_SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("name", StringType()),
        StructField("url", StringType()),
        StructField("category", StringType()),
        StructField("price_in_cash", DoubleType()),
        StructField("price_in_installments", DoubleType()),
        StructField("installments_num", IntegerType()),
        StructField("installment_value", DoubleType()),
        StructField("img", StringType()),
        StructField("seller", StringType()),
        StructField("rating", DoubleType()),
        StructField("rating_users", IntegerType()),
        StructField("position", IntegerType()),
    ]
)
# Bronze seller schema (before the load stamps).
SELLERS_SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("name", StringType()),
        StructField("url", ArrayType(ArrayType(StringType()))),
        StructField("categories", ArrayType(MapType(StringType(), StringType()))),
    ]
)


# The source list of the three shops (url kinds: 0 home,
# 1 categories page, 2 products page), as configured for the bronze run.
DEFAULT_SOURCES = [
    {
        "id": 1,
        "name": "Zoom",
        "url": [
            ["https://www.zoom.com.br/", "0"],
            ["https://www.zoom.com.br/todas-categorias", "1"],
            ["https://www.zoom.com.br/cata-pechincha", "2"],
        ],
        "categories": [{"Cata-Pechincha": "https://www.zoom.com.br/cata-pechincha"}],
        "active": True,
    },
    {
        "id": 2,
        "name": "Magalu",
        "url": [["https://www.magazineluiza.com.br/", "0"]],
        "categories": [],
        "active": True,
    },
    {
        "id": 3,
        "name": "MercadoLivre",
        "url": [
            ["https://www.magazineluiza.com.br/", "0"],
            ["https://www.mercadolivre.com.br/mais-vendidos", "1"],
        ],
        "categories": [],
        "active": True,
    },
]
SOURCES_SCHEMA = StructType(
    [
        StructField("id", IntegerType(), False),
        StructField("name", StringType()),
        StructField("url", ArrayType(ArrayType(StringType()))),
        StructField("categories", ArrayType(MapType(StringType(), StringType()))),
        StructField("active", BooleanType()),
    ]
)


def default_sources(spark: SparkSession) -> DataFrame:
    """The configured source list as a frame."""
    return frame_from_rows(spark, DEFAULT_SOURCES, SOURCES_SCHEMA)


def chosen_menu_pages(menu_pages: DataFrame, sources: DataFrame) -> DataFrame:
    """The one category page of each active source.

    The page whose URL is the source's category page; without such a page
    any menu page of the seller. Of several loads the highest ``page_id``
    counts. A partial limit per seller runs before the shuffle.
    """
    wanted = P.active_sources(sources).select(
        F.col("name").alias("seller"), P.category_page_url("url").alias("__wanted"))
    rows = menu_pages.join(wanted, "seller")
    best = latest_per_key(rows, ["seller"], [F.col("url").eqNullSafe(F.col("__wanted")).desc(), F.col("page_id").desc(), F.col("url").asc()])
    return best.select(*menu_pages.columns)


def links_from_menu_pages(menu_pages: DataFrame) -> DataFrame:
    """Category pages ``(page_id, url, html, seller)`` -> ``(seller, pos, name, url)``,
    each page parsed in its seller's dialect (X3-X6)."""
    parts = [
        P.category_links(menu_pages.filter(F.col("seller") == spec["seller"]), dialect).select("seller", "pos", "name", "url")
        for dialect, spec in DIALECTS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def no_links(spark: SparkSession) -> DataFrame:
    """The link table of a run on configured categories only."""
    return spark.createDataFrame([], "seller string, pos int, name string, url string")


def to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Project and cast to a fixed schema, by name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def extract_listing_products(
    pages: DataFrame, limit: int | None = None, missing: str = "reference", keep_failed: bool = False
) -> DataFrame:
    """Listing pages of all sellers -> product rows; the dialect follows the seller.

    The page table is read once, whatever shops it holds. ``page`` numbers the page rows.
    """
    return P.typed_fields(P.card_rows(pages, limit=limit), missing=missing, keep_failed=keep_failed)


def _known_seller() -> Column:
    return F.coalesce(F.col("seller").isin([spec["seller"] for spec in DIALECTS.values()]), F.lit(False))


def card_counts(pages: DataFrame) -> DataFrame:
    """``(seller, n_cards, n_failed, n_unknown)``: cards found and cards that lack a name, url or price.

    Pages of sellers without a dialect count as one row each in ``n_unknown``,
    so none vanishes without a trace. For pages that are not loaded; a run counts while it loads (``run_bronze``).
    """
    known = extract_listing_products(pages, keep_failed=True).select(
        "seller", F.lit(1).alias("card"), (F.size("parse_errors") > 0).cast("int").alias("failed"), F.lit(0).alias("unknown"))
    other = pages.filter(~_known_seller()).select("seller", F.lit(0).alias("card"), F.lit(0).alias("failed"), F.lit(1).alias("unknown"))
    return known.unionByName(other).groupBy("seller").agg(
        F.sum("card").alias("n_cards"), F.sum("failed").alias("n_failed"), F.sum("unknown").alias("n_unknown"))


class CountedCards:
    """Cards found and failed per seller, and pages without a dialect, counted by the load itself."""

    def __init__(self) -> None:
        self.cards, self.pages = Observation(), Observation()

    def watch_pages(self, pages: DataFrame) -> DataFrame:
        return pages.observe(self.pages, F.count_if(~_known_seller()).alias("unknown"))

    def watch_cards(self, cards: DataFrame) -> DataFrame:
        failed = F.size("parse_errors") > 0
        sums = []
        for letter, spec in DIALECTS.items():
            own = F.col("seller") == spec["seller"]
            sums += [F.count_if(own).alias(f"found_{letter}"), F.count_if(own & failed).alias(f"failed_{letter}")]
        return cards.observe(self.cards, *sums)

    def rows(self) -> list[dict]:
        """After the load: one row a shop, and one without a name for the pages of others."""
        seen = self.cards.get
        out = [
            {"seller": spec["seller"], "n_cards": seen[f"found_{k}"], "n_failed": seen[f"failed_{k}"], "n_unknown": 0}
            for k, spec in DIALECTS.items()]
        return [*out, {"seller": None, "n_cards": 0, "n_failed": 0, "n_unknown": self.pages.get["unknown"]}]


CARD_COUNTS_SCHEMA = StructType(
    [StructField("seller", StringType()), *[StructField(n, LongType(), False) for n in ("n_cards", "n_failed", "n_unknown")]])


def build_products(products: DataFrame, start_id, run_ts, dedup: bool = True) -> DataFrame:
    """Exact duplicates out, ids after ``start_id``, fixed schema, stamps.

    ``products`` (with ``page``) are parsed and written once; what follows reads that table. Ids count in the order of
    (seller, category, page url, page, position). The dedup runs before numbering (after it, as
    the unique ids make every row distinct, it could never remove a row).
    """
    columns = ["page_url", *[f.name for f in PRODUCTS_SCHEMA if f.name != "id"]]
    spark = products.sparkSession
    # rows of a page are written one after the other, so a card's place minus its page's first is its rank
    rows = products.select("page", *columns).withColumn("place", F.monotonically_increasing_id())
    path = scratch_location(spark, "parsed-products")
    rows.write.parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    gone = repeated_places(staged, columns, "place") if dedup else None
    return T.with_load_stamp(to_schema(P.assign_product_ids(staged, start_id, gone), PRODUCTS_SCHEMA), run_ts)


def build_sellers(sources: DataFrame, links: DataFrame, run_ts) -> DataFrame:
    """Active sources with configured + found categories, stamps.

    ``links`` is ``(seller, pos, name, url)``: the links found on each
    seller's category page. A seller without any category stays in the
    table with an empty list (its products are skipped).
    """
    found = P.categories_as_maps(links, ["seller"])
    active = P.active_sources(sources)
    joined = active.join(found, active["name"] == found["seller"], "left")
    empty = F.array().cast("array<map<string,string>>")
    out = joined.select(
        F.col("id").cast("string").alias("id"),
        F.col("name"),
        F.col("url"),
        P.append_categories("categories", F.coalesce(F.col("found"), empty)).alias("categories"),
    )
    return T.with_load_stamp(to_schema(out, SELLERS_SCHEMA), run_ts)


def visited_pages(listing_pages: DataFrame, sellers: DataFrame) -> DataFrame:
    """Listing pages of the active sources that have a category.

    ``sellers`` is the result of ``build_sellers``: active sources with all
    their categories. The semi-join drops the pages of the others before
    they are parsed.
    """
    sources = sellers.filter(F.size("categories") > 0).select(F.col("name").alias("seller")).distinct()
    return listing_pages.join(sources, "seller", "left_semi")


def run_bronze(
    spark: SparkSession,
    listing_pages: DataFrame,
    sources: DataFrame,
    links: DataFrame,
    run_ts,
    limit: int | None = None,
    databases: dict[str, str] | None = None,
    id_start: str = "table",
) -> dict:
    """Products appended (ids continue after the stored maximum),
    sellers' partition overwritten. Returns the table names and, as ``cards``, the
    cards found and failed per seller (rows of ``CARD_COUNTS_SCHEMA``), counted while the cards were written.

    ``id_start="table"`` takes the maximum id over the whole table (exact,
    reads the id column of every partition); ``"latest_partition"`` reads
    only the newest partition, which holds the maximum as long as loads are
    appended in date order.
    """
    if id_start not in ("table", "latest_partition"):
        raise ValueError(f"unknown id_start {id_start!r}")
    products_name = layer_table("BRONZE", "products", databases)
    sellers_name = layer_table("BRONZE", "sellers", databases)
    T.create_database(spark, products_name.split(".")[0])
    stored = T.read_table(
        spark, products_name, latest_only=id_start == "latest_partition", missing_ok=True, schema=PRODUCTS_SCHEMA
    )
    start = max_or_default(stored, "id")
    sellers = build_sellers(sources, links, run_ts)
    pages = visited_pages(listing_pages, sellers)
    counted = CountedCards()
    cards = counted.watch_cards(extract_listing_products(counted.watch_pages(pages), limit, keep_failed=True))
    products = build_products(cards.filter(F.size("parse_errors") == 0), start, run_ts)
    T.save_table(spark, products, products_name, PARTITION_COLUMN, "append")
    T.save_table(spark, sellers, sellers_name, PARTITION_COLUMN, "overwrite")
    return {"products": products_name, "sellers": sellers_name, "cards": counted.rows()}
