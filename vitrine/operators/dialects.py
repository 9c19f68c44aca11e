"""Per-shop page dialects (X3): where cards and category links sit in a page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Shop names, sites and the marker of each page dialect.
DIALECTS = {
    "A": {
        "seller": "Zoom",
        "site": "https://www.zoom.com.br",
        "card": ("a", "data-testid", "product-card::card"),
        "fields": {
            "name": ("h2", "data-testid", "product-card::name"),
            "price": ("p", "data-testid", "product-card::price"),
            "installment": ("span", "data-testid", "product-card::installment"),
            "image": ("img",),
            "rating": ("div", "data-testid", "product-card::rating"),
        },
        "menu_region": ("div", "data-testid", "header::menu-region"),
        "menu_link_class_prefix": "MenuRegion_zmenu__link--more__",
    },
    "B": {
        "seller": "Magalu",
        "site": "https://www.magazineluiza.com.br",
        "card": ("a", "data-testid", "product-card-container"),
        "card_region": ("div", "data-testid", "product-list"),
        "fields": {
            "name": ("h2", "data-testid", "product-title"),
            "price": ("p", "data-testid", "price-value"),
            "installment": ("p", "data-testid", "installment"),
            "image": ("img", "data-testid", "image"),
            "rating": ("div", "data-testid", "review"),
            "score": ("span", "format", "score-count"),
        },
        "menu_region": ("nav", "data-testid", "links-menu"),
        "menu_href": r"/.*/l/.*/",
        "category_query": "?page=1&sortOrientation=desc&sortType=soldQuantity",
    },
    "C": {
        "seller": "MercadoLivre",
        "site": "https://www.mercadolivre.com.br",
        "card_region": ("section", "class", "ui-best-seller-content-main-components"),
        "card_class_prefix": "andes-car",
        "fields": {
            "title": ("a", "class", "poly-component__title"),
            "price": ("span", "class", "andes-money-amount__fraction"),
            "cents": ("span", "class", "andes-money-amount__cents andes-money-amount__cents--superscript-24"),
            "installment": ("span", "class", "poly-price__installments"),
            "plan_cents": ("span", "class", "andes-money-amount__cents"),
            "image": ("img", "class", "poly-component__picture"),
            "rating": ("div", "class", "poly-component__reviews"),
            "score": ("span", "class", "poly-reviews__rating"),
            "users": ("span", "class", "poly-reviews__total"),
        },
        "menu_region": ("div", "class", "CategoryList"),
        "menu_name_class": "category-list-item__permalink-custom-fw-regular category-list-item__permalink-custom",
        "menu_link_class": "splinter-link",
    },
}

# Fixed value: cards per category page in the top-k report; elsewhere all cards count.
PRODUCTS_LIMIT = 25


def dialect_table(spark: SparkSession) -> DataFrame:
    """Three-row table seller -> dialect, for a join on seller (size fixed: broadcastable)."""
    from pyspark.sql.types import StringType, StructField, StructType

    from vitrine.operators.relational import frame_from_rows

    schema = StructType([StructField(n, StringType(), False) for n in ("dialect", "seller", "site")])
    rows = [{"dialect": k, "seller": v["seller"], "site": v["site"]} for k, v in DIALECTS.items()]
    return frame_from_rows(spark, rows, schema)
