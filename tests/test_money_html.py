"""Price, installment and rating text cases (FIXTURES §3), plus HTML helpers."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrine.functions import html as H
from vitrine.functions import money as M
from vitrine.sources.listing_html import money_text

NBSP = " "


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr.alias("x")).first()[0]


def test_brl_texts(spark):
    assert one(spark, M.brl("t"), "R$ 1.234,56") == Decimal("1234.56")
    assert one(spark, M.brl("t"), f"ou R${NBSP}1.234,56") == Decimal("1234.56")
    assert one(spark, M.brl("t"), "R$ abc") is None
    assert one(spark, M.brl("t"), "R$ 1.234") == Decimal("1234.00")


def test_whole_plus_cents(spark):
    df = spark.createDataFrame([("1.234", "05"), ("1.234", None), ("--", "10")], "w string, c string")
    got = [r[0] for r in df.select(M.whole_plus_cents("w", "c")).collect()]
    assert got == [Decimal("1234.05"), Decimal("1234.00"), None]


def test_installments(spark):
    t = "10x de R$ 123,45"
    assert one(spark, M.installment_count("t"), t) == 10
    assert one(spark, M.value_after_currency("t"), t) == Decimal("123.45")
    total, count, value = M.total_count_value("t")
    row = spark.createDataFrame([(f"R${NBSP}1.234,50 em 10x de R${NBSP}123,45 sem juros",)], "t string").select(
        total, count, value).first()
    assert tuple(row) == (Decimal("1234.50"), 10, Decimal("123.45"))
    v = F.lit(Decimal("123.45")).cast("decimal(18,2)")
    assert spark.range(1).select(M.installment_total(v, F.lit(10))).first()[0] == Decimal("1234.50")
    assert spark.range(1).select(M.installment_total(F.lit(None).cast("decimal(18,2)"), F.lit(0))).first()[0] is None


def test_rating(spark):
    assert one(spark, M.rating_value("t"), "4.5 (123)") == 4.5
    assert one(spark, M.rating_users("t"), "4.5 (123)") == 123


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=0, max_value=10**12))
def test_brl_format_parse_identity(spark, cents):
    got = spark.range(1).select(M.brl(F.concat(F.lit("R$ "), money_text(F.lit(cents))))).first()[0]
    assert got == Decimal(cents) / 100


def test_html_helpers(spark):
    card = '<a href="/p/1" data-testid="c"><h2 data-testid="n">  Caf&eacute; &amp; <b>Cia</b> </h2><img src="x.jpg"></a>'
    df = spark.createDataFrame([(card,)], "card string")
    row = df.select(
        H.text_of(H.inner("card", "h2", "data-testid", "n")).alias("name"),
        H.attr(H.start_tag("card", "a"), "href").alias("href"),
        H.attr(H.start_tag("card", "img"), "src").alias("img"),
        H.inner("card", "p", "data-testid", "missing").alias("none"),
    ).first()
    assert row.name == "Café & Cia"
    assert row.href == "/p/1" and row.img == "x.jpg" and row.none is None


def test_nested_elements_and_references(spark):
    from vitrine.functions import html as H
    from vitrine.operators.elements import Decoder, ElementIndex

    long = "x" * 50_000
    pages = {
        '<p><span class="a b"><span>10x <span>de <i>12</i></span></span> fim</span> rest</p>': "10x de 12 fim",
        f'<span class="a">{long}<span>{long}</span></span><span class="a">no</span>': long + long,
        '<div><span class="a">open': "open", "": None,
    }
    for page, want in pages.items():
        index = ElementIndex(page, Decoder())
        assert index.text(index.find(-1, "span", "class", "a")) == want
    text = spark.createDataFrame(
        [("caf&eacute;&nbsp;&#x27;a&#34; &amp;lt; R&D &unknown; &#128512;&#0; &apos;&lt;b&gt;",)], "t string")
    assert text.select(H.unescape("t")).first()[0] == "café 'a\" &lt; R&D &unknown; \U0001f600� '<b>"
    more = spark.createDataFrame([("&amp;#38;lt; &#38;amp; &amp;&amp; x&lt;&lt;",)], "t string")
    assert more.select(H.unescape("t")).first()[0] == "&#38;lt; &amp; && x<<"


def test_category_ids_stay_unique_with_two_urls(spark):
    from vitrine.operators.relational import merge_categories

    ts = "2024-01-01 00:00:00"
    schema = "DS_CATEGORY string, NM_SELLER string, DS_URL string, DH_ORIGIN_EXEC string"
    new = spark.createDataFrame([("c", "s", "u1", ts), ("c", "s", "u2", ts), ("d", "s", None, ts)], schema)
    old = spark.createDataFrame([], "ID_CATEGORY int, " + schema)
    seen = None
    for _ in range(3):
        old = spark.createDataFrame(merge_categories(old, new, dense=True).collect(), "ID_CATEGORY int, " + schema)
        rows = sorted((r["DS_CATEGORY"], r["DS_URL"] or "", r["ID_CATEGORY"]) for r in old.collect())
        assert len(rows) == 3 and len({r[2] for r in rows}) == 3 and (seen is None or rows == seen)
        seen = rows
    other = spark.createDataFrame([("c", "s", "u2", ts), ("c", "s", "u9", ts)], schema)
    rows = {r["DS_URL"]: r["ID_CATEGORY"] for r in merge_categories(old, other, dense=True).collect()}
    kept = {r[1]: r[2] for r in seen}
    assert rows == {None: kept[""], "u2": kept["u2"], "u9": kept["u1"]}
