"""Smaller paths: random catalog ids, read by path, NULL sentinels in B and C."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators.pages import card_fields
from vitrine.operators.relational import catalog_id
from vitrine.session import scratch_location
from vitrine.sources import tables as T


def test_catalog_id_modes(spark):
    df = spark.createDataFrame([("Magalu", "u1")], "s string, u string")
    stable = df.select(catalog_id(F.col("s"), F.col("u")).alias("x")).first().x
    random = df.select(catalog_id(F.col("s"), F.col("u"), "random").alias("x")).first().x
    assert stable.startswith("Maga-") and len(stable) == 5 + 32
    assert random.startswith("Maga-") and len(random) == 5 + 36
    with pytest.raises(ValueError):
        catalog_id(F.col("s"), F.col("u"), "other")


def test_read_path_newest_partition_as_string(spark):
    path = scratch_location(spark, "bypath")
    rows = [(1, "2025-04-06"), (2, "2025-04-07"), (3, "2025-04-07")]
    spark.createDataFrame(rows, "v int, dt_refe_crga string").write.partitionBy("dt_refe_crga").parquet(path)
    got = T.read_path(spark, path, latest_only=True)
    assert dict(got.dtypes)["dt_refe_crga"] == "string"
    assert sorted(r.v for r in got.collect()) == [2, 3]


def test_missing_null_mode_dialects_b_and_c(spark):
    b = ('<a data-testid="product-card-container" href="/p/1"><h2 data-testid="product-title">N</h2>'
         '<p data-testid="price-value">ou R$ 1,00</p></a>')
    c = ('<div class="andes-card"><a class="poly-component__title" href="https://x/p/1">N</a>'
         '<span class="andes-money-amount__fraction">1</span></div>')
    for dialect, card in (("B", b), ("C", c)):
        cards = spark.createDataFrame([(1, 1, card)], "page_id long, position int, card string")
        ref = card_fields(cards, dialect).first()
        nul = card_fields(cards, dialect, missing="null").first()
        assert ref.price_in_cash == 1.0 and ref.installments_num == 0 and ref.installment_value == -999.0
        assert ref.rating == (None if dialect == "B" else -999.0) and ref.rating_users == 0
        assert (nul.installments_num, nul.installment_value, nul.rating, nul.rating_users) == (None, None, None, None)
        assert ref.price_in_installments is None and nul.price_in_installments is None


def test_link_without_name_gets_empty_key(spark):
    from vitrine.operators.pages import categories_as_maps, category_links

    menu = ('<div data-testid="header::menu-region"><a class="MenuRegion_zmenu__link--more__x" href="/a">x</a>'
            '<a class="MenuRegion_zmenu__link--more__y" title="Casa" href="/b">y</a></div>')
    pages = spark.createDataFrame([(1, "u", menu, "Zoom")], "page_id long, url string, html string, seller string")
    links = category_links(pages, "A")
    assert [(r.pos, r.name) for r in links.collect()] == [(1, None), (2, "Casa")]
    found = categories_as_maps(links, ["seller"]).first().found
    assert found == [{"": "https://www.zoom.com.br/a"}, {"Casa": "https://www.zoom.com.br/b"}]
