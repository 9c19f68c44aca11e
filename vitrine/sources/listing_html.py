"""Listing and menu pages in the three shop dialects, rendered by Spark from
the driver tables (the extraction jobs parse them back).

Cards come from ``part``: category = ``p_brand``, one page per brand and
block of 1,000 part keys (so a page never holds more than 1,000 cards),
cards in part-key order. Menus come from the ``<nav>`` links of ``pages``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.dialects import DIALECTS

NBSP = "\u00a0"
PAGE_BLOCK = 1000


def money_text(cents: Column) -> Column:
    """Integer cents -> '1.234,56'."""
    return F.translate(F.format_number((cents / 100).cast("decimal(18,2)"), 2), ",.", ".,")


def card_facts(part: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per part: the values a listing card shows (and the parser must recover)."""
    price_cents = ((F.col("p_retailprice") * F.col("p_size")).cast("decimal(18,2)") * 100).cast("bigint")
    n = (F.col("p_size") % 13).cast("int")
    inst_cents = F.when(n > 0, F.floor(price_cents / n).cast("bigint"))
    return part.select(
        F.col("p_partkey").alias("pk"),
        F.col("p_brand").alias("category"),
        F.floor(F.col("p_partkey") / PAGE_BLOCK).cast("bigint").alias("block"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("name"),
        price_cents.alias("price_cents"),
        (F.col("p_size") == 50).alias("broken"),
        n.alias("n"),
        inst_cents.alias("inst_cents"),
        (inst_cents * n).alias("total_cents"),
        (F.col("p_size") % 4 != 0).alias("rated"),
        F.format_string("%d.%d", F.floor((F.col("p_size") % 50) / 10).cast("int"), F.col("p_size") % 50 % 10).alias("rating"),
        (F.col("p_size") * 3 + 1).alias("users"),
        F.format_string("https://img.example.com/p/%d.jpg", F.col("p_partkey")).alias("img"),
        F.format_string("/produto/%d", F.col("p_partkey")).alias("href"),
        *keep,
    )


def _opt(cond: Column, text: Column) -> Column:
    return F.when(cond, text).otherwise(F.lit(""))


def shown_name(c) -> Column:
    """The name as a page writes it: some characters as references, blanks around it, a part in bold."""
    name = F.when(c("pk") % 5 == 0, F.replace(c("name"), F.lit("#"), F.lit("&#35;"))).when(
        c("pk") % 5 == 1, F.replace(c("name"), F.lit("#"), F.lit("&#x23;"))).when(
        c("pk") % 5 == 2, F.replace(c("name"), F.lit("#"), F.lit("<b>#</b>"))).otherwise(c("name"))
    return F.when(c("pk") % 2 == 0, F.concat(F.lit("&nbsp; "), name, F.lit("\n"))).otherwise(name)


def card_html(facts: DataFrame, dialect: str) -> Column:
    """The card as its shop writes it: nested amounts and reviews, references, further class tokens, both kinds of quotes."""
    c = F.col
    price = F.when(c("broken"), F.lit("--")).otherwise(money_text(c("price_cents")))
    has_inst = c("n") > 0
    if dialect == "A":
        href = F.when(c("pk") % 7 == 0, F.concat(F.lit(DIALECTS["A"]["site"]), c("href"))).otherwise(c("href"))
        return F.concat(
            F.lit('<a class="card" data-testid="product-card::card" href="'), href, F.lit('">'),
            F.lit('<img src="'), c("img"), F.lit('" alt="">'),
            F.lit('<!-- <h2 data-testid="product-card::name">old</h2> --><h2 data-testid="product-card::name"> '), shown_name(c), F.lit(" </h2>"),
            F.lit('<p data-testid="product-card::price"><span>R$&nbsp;</span><strong>'), price, F.lit("</strong></p>"),
            _opt(has_inst, F.concat(F.lit('<span data-testid="product-card::installment"><span>'), c("n").cast("string"),
                                    F.lit("x</span> de <span>R$ <span>"), money_text(c("inst_cents")), F.lit("</span></span></span>"))),
            _opt(c("rated"), F.concat(F.lit('<div data-testid="product-card::rating"><div><div>'), c("rating"), F.lit("</div> <div>("),
                                      c("users").cast("string"), F.lit(")</div></div></div>"))),
            F.lit("</a>"),
        )
    if dialect == "B":
        return F.concat(
            F.lit('<a data-testid="product-card-container" href="'), c("href"), F.lit('">'),
            F.lit('<img data-testid="image" src="'), c("img"), F.lit('">'),
            F.lit("<h2 class=title data-testid='product-title'>"), shown_name(c), F.lit("</h2>"),
            F.lit(f'<p data-testid="price-value">ou R${NBSP}'), price, F.lit("</p>"),
            _opt(has_inst, F.concat(F.lit(f'<p data-testid="installment">R${NBSP}'), money_text(c("total_cents")),
                                    F.lit(" em "), c("n").cast("string"), F.lit(f"x de R${NBSP}"),
                                    money_text(c("inst_cents")), F.lit(" sem juros</p>"))),
            _opt(c("rated"), F.concat(F.lit('<div data-testid="review"><div><div class="stars"></div></div><div><span format="score-count">'), c("rating"),
                                      F.lit(" <span>("), c("users").cast("string"), F.lit(")</span></span></div></div>"))),
            F.lit("</a>"),
        )
    if dialect == "C":
        whole = F.when(c("broken"), F.lit("--")).otherwise(
            F.translate(F.format_number(F.floor(c("price_cents") / 100), 0), ",", "."))
        cents = c("price_cents") % 100
        inst_whole = F.translate(F.format_number(F.floor(c("inst_cents") / 100), 0), ",", ".")
        inst_cents = c("inst_cents") % 100
        data_img = c("pk") % 3 == 0
        img = F.when(data_img, F.concat(F.lit('<img class="poly-component__picture" src="data:image/gif;base64,R0lGODlh" data-src="'),
                                        c("img"), F.lit('">'))).otherwise(
            F.concat(F.lit('<img class="poly-component__picture" src="'), c("img"), F.lit('">')))
        return F.concat(
            F.lit('<div class="andes-card poly-card poly-card--grid"><div class="poly-card__portada">'), img,
            F.lit('</div><div class="poly-card__content"><A HREF="'),
            F.lit(DIALECTS["C"]["site"]), c("href"), F.lit('" class="link poly-component__title x"><span><span>'), shown_name(c), F.lit("</span></span></A>"),
            F.lit('<div class="poly-price"><span class="andes-money-amount"><span>R$</span><span class="andes-money-amount__fraction large">'),
            whole, F.lit("</span>"),
            _opt(cents > 0, F.concat(F.lit('<span class="andes-money-amount__cents andes-money-amount__cents--superscript-24">'),
                                     F.lpad(cents.cast("string"), 2, "0"), F.lit("</span>"))),
            F.lit("</span></div>"),
            _opt(has_inst, F.concat(F.lit('<span class="green poly-price__installments"><span>'), c("n").cast("string"),
                                    F.lit('x</span> <span class="andes-money-amount"><span class="andes-money-amount__fraction">'), inst_whole, F.lit("</span>"),
                                    _opt(inst_cents > 0, F.concat(F.lit('<span class="andes-money-amount__cents">'),
                                                                  F.lpad(inst_cents.cast("string"), 2, "0"), F.lit("</span>"))),
                                    F.lit("</span></span>"))),
            _opt(c("rated"), F.concat(F.lit('<div class="poly-component__reviews"><div><span class="poly-reviews__rating">'),
                                      c("rating"), F.lit('</span></div><div><span class="poly-reviews__total">('),
                                      c("users").cast("string"), F.lit(")</span></div></div>"))),
            F.lit("</div></div>"),
        )
    raise ValueError(dialect)


_WRAP = {
    "A": ('<html><body><div data-testid="header::menu-region"></div><main>', "</main></body></html>"),
    # a list element with an inner div, and a strip of recommendations after it that doesn't count
    "B": ('<html><body><header>ofertas</header><div data-testid="product-list"><div>',
          '</div></div><div><a data-testid="product-card-container" href="/x"><h2 data-testid="product-title">x</h2></a></div></body></html>'),
    # scripts and cards outside of the section don't count
    "C": ('<html><body><script>"<div class=andes-card>"</script><div class="andes-card">x</div>'
          '<section class="main ui-best-seller-content-main-components">', "</section></body></html>"),
}


def listing_pages(part: DataFrame, dialect_of: Column | str) -> DataFrame:
    """Listing pages ``(page_id, url, html, seller, category)`` from ``part``.

    ``dialect_of`` is a dialect letter or a column of letters over ``part``.
    """
    dial = F.lit(dialect_of) if isinstance(dialect_of, str) else dialect_of
    facts = card_facts(part.withColumn("__dialect", dial), keep=("__dialect",))
    card = F.when(F.col("__dialect") == "A", card_html(facts, "A")).when(
        F.col("__dialect") == "B", card_html(facts, "B")).otherwise(card_html(facts, "C"))
    grouped = facts.groupBy("__dialect", "category", "block").agg(
        F.array_sort(F.collect_list(F.struct(F.col("pk"), card.alias("card")))).alias("cards")
    )
    body = F.array_join(F.transform("cards", lambda x: x["card"]), "")
    head = F.when(F.col("__dialect") == "A", F.lit(_WRAP["A"][0])).when(
        F.col("__dialect") == "B", F.lit(_WRAP["B"][0])).otherwise(F.lit(_WRAP["C"][0]))
    tail = F.when(F.col("__dialect") == "A", F.lit(_WRAP["A"][1])).when(
        F.col("__dialect") == "B", F.lit(_WRAP["B"][1])).otherwise(F.lit(_WRAP["C"][1]))
    site = F.when(F.col("__dialect") == "A", F.lit(DIALECTS["A"]["site"])).when(
        F.col("__dialect") == "B", F.lit(DIALECTS["B"]["site"])).otherwise(F.lit(DIALECTS["C"]["site"]))
    seller = F.when(F.col("__dialect") == "A", F.lit(DIALECTS["A"]["seller"])).when(
        F.col("__dialect") == "B", F.lit(DIALECTS["B"]["seller"])).otherwise(F.lit(DIALECTS["C"]["seller"]))
    brand_no = F.regexp_extract("category", r"([0-9]+)", 1).cast("bigint")
    return grouped.select(
        (brand_no * 100000 + F.col("block")).alias("page_id"),
        F.concat(site, F.lit("/categoria/"), F.lower(F.translate("category", "#", "-")),
                 F.lit("?bloco="), F.col("block").cast("string")).alias("url"),
        F.concat(head, body, tail).alias("html"),
        seller.alias("seller"),
        F.col("category"),
    )


NAV_LINK = r'<a href="([^"]*)">([^<]*)</a>'


def nav_links_raw(pages: DataFrame) -> DataFrame:
    """``<nav>`` anchors of generic pages: (page_id, url, pos, href, label_html)."""
    nav = F.regexp_extract("html", r"(?s)<nav>(.*?)</nav>", 1)
    pairs = F.arrays_zip(
        F.regexp_extract_all(nav, F.lit(NAV_LINK), 1).alias("href"),
        F.regexp_extract_all(nav, F.lit(NAV_LINK), 2).alias("label"),
    )
    return pages.select("page_id", "url", F.posexplode(pairs).alias("pos", "link")).select(
        "page_id", "url", (F.col("pos") + 1).alias("pos"), F.col("link.href").alias("href"),
        F.col("link.label").alias("label_html"))


def menu_pages(pages: DataFrame, dialect: str) -> DataFrame:
    """One category-menu page per page of ``pages``, holding its nav links in ``dialect``."""
    links = nav_links_raw(pages)
    c = F.col
    if dialect == "A":
        item = F.concat(F.lit('<a class="MenuRegion_zmenu__link--more__x1 link" title="'), c("label_html"),
                        F.lit('" href="'), c("href"), F.lit('">ver mais</a>'))
        head, tail = '<html><body><div data-testid="header::menu-region"><a class="MenuRegion_home" href="/">inicio</a>', "</div></body></html>"
    elif dialect == "B":
        # every third link is a non-category link, which the href filter drops
        href = F.when(c("pos") % 3 == 0, F.concat(F.lit("/institucional"), c("href"))).otherwise(
            F.concat(c("href"), F.lit("/l/"), c("pos").cast("string"), F.lit("/")))
        item = F.concat(F.lit('<a href="'), href, F.lit('">'), c("label_html"), F.lit("</a>"))
        head, tail = '<html><body><nav data-testid="links-menu">', "</nav></body></html>"
    elif dialect == "C":
        item = F.concat(
            F.lit('<div class="category-list-item"><div class="ui-item category-list-item__permalink-custom-fw-regular category-list-item__permalink-custom extra">'),
            c("label_html"), F.lit('</div><a class="ui-splinter-link--x" href="https://lista.example.com'), c("href"),
            F.lit('">ver</a></div>'))
        head, tail = '<html><body><div class="CategoryList">', "</div></body></html>"
    else:
        raise ValueError(dialect)
    grouped = links.groupBy("page_id", "url").agg(
        F.array_sort(F.collect_list(F.struct(c("pos"), item.alias("item")))).alias("items"))
    return grouped.select(
        "page_id", "url",
        F.concat(F.lit(head), F.array_join(F.transform("items", lambda x: x["item"]), ""), F.lit(tail)).alias("html"),
    )
