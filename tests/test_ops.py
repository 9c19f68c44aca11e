"""Handmade cases of FIXTURES §2 for the relational steps and silver jobs."""

import datetime as dt

from pyspark.sql import functions as F

from vitrine.operators.latest import latest_per_key, product_version_order
from vitrine.operators.numbering import number_rows, plain_number_rows
from vitrine.operators.relational import attach_catalog_id, flatten_categories, merge_categories
from vitrine.operators import elements as E
from vitrine.operators.dialects import DIALECTS
from vitrine.operators.pages import category_page_url
from vitrine.plans import silver
from vitrine.sources import tables as T

D1, D2 = dt.datetime(2025, 4, 6, 10), dt.datetime(2025, 4, 7, 10)
PRODUCT_COLS = "id string, url string, category string, position int, dh_exec timestamp, price double"


def test_newest_row_wins(spark):
    df = spark.createDataFrame([("1", "u1", "A", 1, D1, 10.0), ("2", "u1", "A", 1, D2, 12.0)], PRODUCT_COLS)
    got = latest_per_key(df, ["url"], product_version_order()).collect()
    assert [(r.url, r.price) for r in got] == [("u1", 12.0)]


def test_tie_in_one_load_best_position(spark):
    df = spark.createDataFrame([("1", "u1", "A", 3, D1, 1.0), ("2", "u1", "B", 1, D1, 2.0)], PRODUCT_COLS)
    got = latest_per_key(df, ["url"], product_version_order()).first()
    assert got.category == "B"


def test_max_by_equals_window(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"), (F.col("id") * 7 % 11).alias("w"))
    a = latest_per_key(df, ["k"], [F.col("w").desc(), F.col("v").desc()])
    b = latest_per_key(df, ["k"], [], method="max_by", max_key=F.struct("w", "v"))
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_number_rows_equals_plain_window(spark):
    df = spark.range(30000).select((F.col("id") % 3).alias("hot"), (F.col("id") * 7919 % 30011).alias("v"))
    a = number_rows(df, ["hot", "v"], start=5).orderBy("row_id").collect()
    b = plain_number_rows(df, ["hot", "v"], start=5).orderBy("row_id").collect()
    assert a == b


def test_catalog_missing_empty_filled_no_fanout(spark):
    lv = spark.createDataFrame([("u1",), ("u2",)], "DS_URL string")
    assert {r.ID_CATALOG for r in attach_catalog_id(lv, None).collect()} == {None}
    empty = spark.createDataFrame([], "DS_URL string, ID_CATALOG string")
    assert {r.ID_CATALOG for r in attach_catalog_id(lv, empty).collect()} == {None}
    cat = spark.createDataFrame([("u1", "x-1"), ("u1", "x-2")], "DS_URL string, ID_CATALOG string")
    got = attach_catalog_id(lv, cat).collect()
    assert len(got) == 2 and {r.DS_URL: r.ID_CATALOG for r in got}["u1"] == "x-2"


def test_flatten_categories_edge_cases(spark):
    rows = [("s1", D1, []), ("s2", D1, None), ("s3", D1, [{}]), ("s4", D1, [{"+ Casa ": "x"}])]
    df = spark.createDataFrame(rows, "name string, dh_exec timestamp, categories array<map<string,string>>")
    got = flatten_categories(df).collect()
    assert [(r.NM_SELLER, r.DS_CATEGORY, r.DS_URL) for r in got] == [("s4", "Casa", "x")]


def _cats(spark, rows):
    return spark.createDataFrame(rows, "ID_CATEGORY int, DS_CATEGORY string, NM_SELLER string, DS_URL string, DH_ORIGIN_EXEC timestamp")


def test_merge_as_coded_and_dense(spark):
    old = _cats(spark, [(1, "A", "s", "a", D1), (2, "B", "s", "b", D1)])
    new = spark.createDataFrame([("B", "s", "b2", D2), ("0new", "s", "n", D2), ("C", "s", "c", D2)],
                                "DS_CATEGORY string, NM_SELLER string, DS_URL string, DH_ORIGIN_EXEC timestamp")
    coded = {r.DS_CATEGORY: (r.ID_CATEGORY, r.DS_URL) for r in merge_categories(old, new).collect()}
    assert coded == {"A": (1, "a"), "B": (2, "b2"), "0new": (3, "n"), "C": (6, "c")}
    dense = {r.DS_CATEGORY: r.ID_CATEGORY for r in merge_categories(old, new, dense=True).collect()}
    assert dense == {"A": 1, "B": 2, "0new": 3, "C": 4}
    empty = _cats(spark, [])
    assert sorted(r.ID_CATEGORY for r in merge_categories(empty, new).collect()) == [1, 2, 3]


def test_chosen_partition_rules(spark):
    two = spark.createDataFrame([("d1",), ("d2",)], "dt_refe_crga string")
    one = spark.createDataFrame([("d2",)], "dt_refe_crga string")

    def aim(df, run, ignore=False):
        return T.aim_partition_frame(df, run, ignore_delay=ignore).first()[0]

    assert aim(two, "d2") == "d1"
    assert aim(two, "d2", ignore=True) == "d2"
    assert aim(two, "d3") == "d2"
    assert aim(one, "d2") == "d2"


def test_category_page_kinds(spark):
    rows = [([["h", "0"]],), ([["h", "0"], ["c", "1"]],), ([["h", "0"], ["c1", "1"], ["c2", "1"]],), ([["p", "2"]],)]
    df = spark.createDataFrame(rows, "url array<array<string>>")
    assert [r[0] for r in df.select(category_page_url("url")).collect()] == ["h", "c", "c2", None]


def test_andes_cards_nested_and_region():
    html = ('<div class="andes-card x">out</div><section class="ui-best-seller-content-main-components">'
            '<div class="andes-card a"><div class="inner"><div class="andes-card b">n</div></div></div>'
            '<div class="other"></div></section>')
    index = E.ElementIndex(html, E.Decoder())
    got = [index.outer(i) for i in E.find_cards(index, DIALECTS["C"], None)]
    assert got == ['<div class="andes-card a"><div class="inner"><div class="andes-card b">n</div></div></div>',
                   '<div class="andes-card b">n</div>']
    assert [index.outer(i) for i in E.find_cards(index, DIALECTS["C"], 1)] == got[:1]


def test_element_index_ranges():
    page = ('<DIV class="a b"><span>1<SPAN data-x=\'q"q\'>2</SPAN></span><img src=i.png class=b><!-- <p>no</p> -->'
            '<p class="a">open <i>x</div><p>after</p><script>"<div class=a>"</script><br/><a title="unclosed>z</a>')
    ix = E.ElementIndex(page, E.Decoder())
    assert ix.tags == ["div", "span", "span", "img", "p", "i", "p", "br", "a"]
    assert ix.depth == [0, 1, 2, 1, 1, 2, 0, 0, 0]
    assert ix.last == [6, 3, 3, 4, 6, 6, 7, 8, 9]
    assert ix.text(0) == "12open x" and ix.text(1) == "12" and ix.text(4) == "open x" and ix.text(8) == "z"
    assert ix.attribute(2, "data-x") == 'q"q' and ix.attribute(3, "src") == "i.png" and ix.attribute(0, "none") is None
    assert ix.find(0, "p") == 4 and ix.find(4, "p") is None and ix.find(-1, "p", "class", "a") == 4
    assert ix.find(-1, "div", "class", "a b") == 0 and ix.find(-1, "div", "class", "c") is None
    assert ix.find_all(-1, "p") == [4, 6] and ix.find_all(0, "p", "class", "a", prefix=True) == [4]
    assert ix.outer(3) == "<img src=i.png class=b>" and ix.outer(1).endswith("</span>")


def test_element_index_of_long_and_deep_pages():
    deep = "<div class='x'>" * 20_000 + "t" + "</div>" * 20_000
    ix = E.ElementIndex(deep, E.Decoder())
    assert max(ix.depth) == 19_999 and ix.last[0] == 20_000 and ix.outer(0) == deep and ix.text(19_999) == "t"
    assert E.ElementIndex("<" * 50_000 + "a", E.Decoder()).tags == []


def test_references_are_decoded_once():
    decode = E.Decoder()
    text = "caf&eacute;&nbsp;&#x27;a&#34; &amp;lt; R&D &unknown; &#128512;&#0; &apos;&lt;b&gt; &eacute;"
    assert decode(text) == "café\u00a0'a\" &lt; R&D &unknown; \U0001f600\ufffd '<b> é"
    assert decode.known["&eacute;"] == "é" and len(decode.known) == 11


def test_catalog_ids_stable_across_loads(spark):
    df = spark.createDataFrame([("1", "u1", "A", 1, D1, 1.0)], PRODUCT_COLS).withColumn("name", F.lit("n")) \
        .withColumn("seller", F.lit("Zoom")).withColumn("img", F.lit(None).cast("string"))
    a = silver.build_catalog(df, D1).first().ID_CATALOG
    b = silver.build_catalog(df, D2).first().ID_CATALOG
    assert a == b and a.startswith("Zoom-")


def test_dialect_b_cards_only_inside_the_list(spark):
    from vitrine.operators.pages import split_cards

    card = '<a data-testid="product-card-container" href="/p/{k}"><div data-testid="review"></div>{k}</a>'
    html = ('<body><div data-testid="product-list"><div class="row">' + card.format(k=1) + '</div>'
            + card.format(k=2) + '</div><div class="reco">' + card.format(k=3) + '</div></body>')
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [(r.position, r.card.endswith("2</a>")) for r in split_cards(pages, "B").collect()]
    assert got == [(1, False), (2, True)]


def test_url_only_in_older_load_in_catalog_not_last_version(spark):
    from vitrine.plans import silver

    rows = [("1", "u1", "A", 1, D1, 1.0, "2025-04-06"), ("2", "u2", "A", 2, D1, 2.0, "2025-04-06"),
            ("3", "u1", "A", 1, D2, 3.0, "2025-04-07")]
    df = spark.createDataFrame(rows, PRODUCT_COLS + ", dt_refe_crga string").select(
        "*", F.lit("n").alias("name"), F.lit("Zoom").alias("seller"), F.lit(None).cast("string").alias("img"),
        F.col("price").alias("price_in_cash"), F.lit(None).cast("double").alias("price_in_installments"),
        F.lit(0).alias("installments_num"), F.lit(-999.0).alias("installment_value"),
        F.lit(-999.0).alias("rating"), F.lit(0).alias("rating_users"))
    run = dt.datetime(2025, 4, 8, 6)
    catalog = silver.build_catalog(df, run)
    assert sorted(r.DS_URL for r in catalog.collect()) == ["u1", "u2"]
    version = silver.build_last_version(df, catalog, run).collect()
    assert [(r.DS_URL, r.ID_ORIGIN, r.ID_CATALOG is not None) for r in version] == [("u1", "3", True)]


def test_inactive_source_dropped(spark):
    from vitrine.operators.pages import active_sources

    rows = [(1, "a", [["h", "0"]], [], True), (2, "b", [["h", "0"]], [], False)]
    df = spark.createDataFrame(rows, "id int, name string, url array<array<string>>, "
                                     "categories array<map<string,string>>, active boolean")
    got = [(r.name, r.n_urls, r.n_categories) for r in active_sources(df).collect()]
    assert got == [("a", 1, 0)]
