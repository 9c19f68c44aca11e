"""The spark-submit entry points, end to end on fixture pages written as Parquet."""

from pyspark.sql import functions as F

from vitrine import jobs
from vitrine.operators.dialects import DIALECTS
from vitrine.session import scratch_location
from vitrine.sources import listing_html as L
from vitrine.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_bronze_then_silver_jobs(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    letter = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("p_partkey") % 3 + 1).cast("int"))
    listing_path = scratch_location(spark, "listing")
    L.listing_pages(part, letter).write.parquet(listing_path)
    menus = None
    for i, (d, spec) in enumerate(DIALECTS.items()):
        one = L.menu_pages(pages.filter(F.col("page_id") % 3 == i), d).withColumn("seller", F.lit(spec["seller"]))
        menus = one if menus is None else menus.unionByName(one)
    menu_path = scratch_location(spark, "menus")
    menus.write.parquet(menu_path)
    try:
        done = jobs.main(["bronze", "--listing-pages", listing_path, "--menu-pages", menu_path,
                          "--run-ts", "2025-04-07 06:00:00"])
        assert set(done) == {"products", "sellers", "cards"}
        assert sum(r["n_cards"] for r in done["cards"]) == part.count()
        products = spark.table(done["products"])
        assert products.count() > 0 and products.select("seller").distinct().count() == 3
        assert products.select("id").distinct().count() == products.count()
        sellers = spark.table(done["sellers"]).collect()
        assert {r.name for r in sellers} == {"Zoom", "Magalu", "MercadoLivre"}
        zoom = [r for r in sellers if r.name == "Zoom"][0]
        assert zoom.categories[0] == {"Cata-Pechincha": "https://www.zoom.com.br/cata-pechincha"}

        out = jobs.main(["silver", "--run-ts", "2025-04-07 07:00:00"])
        assert set(out) == {"catalog", "last_version", "categories"} and "(full)" in out["categories"]
        cats = spark.table("s_prod_prices.s_categories_catalog")
        ids = [r.ID_CATEGORY for r in cats.collect()]
        assert sorted(ids) == list(range(1, len(ids) + 1))
        version = spark.table("s_prod_prices.s_last_ver_products")
        assert version.filter(F.col("ID_CATALOG").isNull()).count() == 0
        before = {}
        for r in cats.collect():
            before.setdefault((r.DS_CATEGORY, r.NM_SELLER), set()).add(r.ID_CATEGORY)
        again = jobs.main(["silver", "--run-ts", "2025-04-07 07:00:00"])
        assert "(incremental)" in again["categories"]
        after = {}
        for r in spark.table("s_prod_prices.s_categories_catalog").collect():
            after.setdefault((r.DS_CATEGORY, r.NM_SELLER), set()).add(r.ID_CATEGORY)
        # same keys, and each key keeps ids it had
        assert set(after) == set(before)
        assert all(after[k] <= before[k] for k in after)
    finally:
        T.drop_database(spark, "b_prod_prices")
        T.drop_database(spark, "s_prod_prices")


def test_pages_of_inactive_sources_and_of_sources_without_categories_are_left_out(spark):
    from vitrine.plans import bronze

    pages = spark.createDataFrame([("Zoom", "u1"), ("Magalu", "u2"), ("MercadoLivre", "u3")], "seller string, url string")
    rows = [{**s, "active": s["name"] != "Zoom"} for s in bronze.DEFAULT_SOURCES]
    sources = spark.createDataFrame(rows, bronze.SOURCES_SCHEMA)
    links = spark.createDataFrame([("Magalu", 1, "c", "x"), ("Zoom", 1, "c", "y")], "seller string, pos int, name string, url string")
    sellers = bronze.build_sellers(sources, links, "2024-04-01 06:00:00")
    assert [r["seller"] for r in bronze.visited_pages(pages, sellers).collect()] == ["Magalu"]


def test_one_menu_page_a_seller(spark):
    from vitrine.plans import bronze

    sources = spark.createDataFrame(
        [{**s, "active": s["name"] != "Magalu"} for s in bronze.DEFAULT_SOURCES], bronze.SOURCES_SCHEMA)
    wanted = "https://www.zoom.com.br/todas-categorias"
    rows = [(1, wanted, "a", "Zoom"), (2, wanted, "b", "Zoom"), (3, "https://www.zoom.com.br/", "c", "Zoom"),
            (4, "x", "d", "Magalu"), (5, "y", "e", "MercadoLivre"), (6, "z", "f", "MercadoLivre"), (7, "z", "g", "Other")]
    menus = spark.createDataFrame(rows, "page_id long, url string, html string, seller string")
    assert sorted(r["page_id"] for r in bronze.chosen_menu_pages(menus, sources).collect()) == [2, 6]


def test_escaped_partition_values(spark):
    db = "vitrine_escaped"
    T.create_database(spark, db, scratch_location(spark, db))
    try:
        values = ["2024-04-01 06:00", "a+b=c/d"]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, dt_refe_crga string")
        T.save_table(spark, df, f"{db}.t", "dt_refe_crga", "append")
        assert {r[0] for r in T.list_partitions(spark, f"{db}.t").collect()} == set(values)
        assert [r["id"] for r in T.read_table(spark, f"{db}.t", latest_only=True).collect()] == [1]
        assert T.drop_partition(spark, f"{db}.t", latest=True) == values[1]
    finally:
        T.drop_database(spark, db)
