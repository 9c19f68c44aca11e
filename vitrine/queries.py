"""Registered queries and their DuckDB oracles.

Each query takes ``(spark, sf_dir)``, reads whole driver tables and returns
a DataFrame; ``ORACLE[name]`` is the same result written in plain SQL over
the driver tables. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.latest import latest_per_key
from vitrine.operators.numbering import number_rows
from vitrine.operators.relational import max_or_default, normalise_label, top_rows
from vitrine.plans import silver
from vitrine.session import PARTITION_COLUMN, configure
from vitrine.sources import tables as T
from vitrine.sources.standins import events_run_ts, products_from_events, read_input

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


def _products(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, object]:
    configure(spark)
    events = read_input(spark, sf_dir, "events")
    return products_from_events(events), events_run_ts(events)


# --------------------------------------------------------------------------- SQL pieces

PRODUCTS_SQL = """
products AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         'produto ' || CAST(user_id AS VARCHAR) AS name,
         'https://loja.example/p/' || CAST(user_id AS VARCHAR) AS url,
         'cat-' || json_extract_string(props, '$.k') AS category,
         value AS price_in_cash,
         CAST(NULL AS DOUBLE) AS price_in_installments,
         0 AS installments_num,
         CAST(-999.0 AS DOUBLE) AS installment_value,
         'https://img.loja.example/' || CAST(user_id AS VARCHAR) || '.jpg' AS img,
         event_type AS seller,
         CAST(-999.0 AS DOUBLE) AS rating,
         0 AS rating_users,
         CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS position,
         strftime(ts, '%Y-%m-%d') AS dt_refe_crga,
         ts AS dh_exec
  FROM events
),
run AS (SELECT max(ts) AS run_ts, strftime(max(ts), '%Y-%m-%d') AS run_date FROM events)
"""

NEWEST_PER_URL = (
    "row_number() OVER (PARTITION BY url ORDER BY dh_exec DESC, position ASC NULLS LAST, "
    "TRY_CAST(id AS BIGINT) DESC, category ASC)"
)

CATALOG_SQL = f"""
catalog AS (
  SELECT id AS ID_ORIGIN, name AS NM_PRODUCT, seller AS NM_SELLER, url AS DS_URL, img AS DS_IMG,
         concat_ws('-', substring(seller, 1, 4), md5(url)) AS ID_CATALOG
  FROM (SELECT *, {NEWEST_PER_URL} AS rn FROM products) WHERE rn = 1
)
"""

AIM_SQL = """
aim AS (
  SELECT CASE WHEN max(dt_refe_crga) = (SELECT run_date FROM run)
              THEN coalesce(max(CASE WHEN dt_refe_crga < (SELECT run_date FROM run) THEN dt_refe_crga END),
                            max(dt_refe_crga))
              ELSE max(dt_refe_crga) END AS delayed,
         max(dt_refe_crga) AS latest
  FROM products
)
"""

LAST_VERSION_COLS = """
id AS ID_ORIGIN, name AS NM_PRODUCT, url AS DS_URL, img AS DS_IMG, category AS DS_CATEGORY,
price_in_cash AS VL_CASH, price_in_installments AS VL_INSTALLMENTS, installments_num AS NR_INSTALLMENTS,
installment_value AS VL_SINGLE_INSTALLMENT, seller AS NM_SELLER, rating AS VL_RATING,
rating_users AS QT_RATING_USERS, position AS NR_POSITION
"""

# --------------------------------------------------------------------------- silver products


@register(
    "catalog_products",
    f"""
WITH {PRODUCTS_SQL}, {CATALOG_SQL}
SELECT c.*, r.run_date AS dt_refe_crga, r.run_ts AS dh_exec FROM catalog c, run r
""",
)
def q_catalog_products(spark, sf_dir):
    """J3 + C1, C4, C6, T22, T23: product catalog with a stable id per URL (session configured first)."""
    products, run_ts = _products(spark, sf_dir)
    return silver.build_catalog(products, run_ts)


@register(
    "last_ver_left_join",
    f"""
WITH {PRODUCTS_SQL}, {CATALOG_SQL}, {AIM_SQL},
chosen AS (SELECT * FROM products WHERE dt_refe_crga = (SELECT delayed FROM aim)),
newest AS (SELECT {LAST_VERSION_COLS} FROM (SELECT *, {NEWEST_PER_URL} AS rn FROM chosen) WHERE rn = 1)
SELECT n.*, c.ID_CATALOG, r.run_date AS dt_refe_crga, r.run_ts AS dh_exec
FROM newest n LEFT JOIN catalog c ON n.DS_URL = c.DS_URL, run r
""",
)
def q_last_ver_left_join(spark, sf_dir):
    """J4 + T7 (one day behind), C2, C5, C7: newest row per URL of the chosen load, catalog id."""
    products, run_ts = _products(spark, sf_dir)
    catalog = silver.build_catalog(products, run_ts)
    return silver.build_last_version(products, catalog, run_ts, ignore_delay=False)


@register(
    "last_ver_no_catalog",
    f"""
WITH {PRODUCTS_SQL}, {AIM_SQL},
chosen AS (SELECT * FROM products WHERE dt_refe_crga = (SELECT latest FROM aim)),
newest AS (SELECT {LAST_VERSION_COLS} FROM (SELECT *, {NEWEST_PER_URL} AS rn FROM chosen) WHERE rn = 1)
SELECT n.*, CAST(NULL AS VARCHAR) AS ID_CATALOG, r.run_date AS dt_refe_crga, r.run_ts AS dh_exec
FROM newest n, run r
""",
)
def q_last_ver_no_catalog(spark, sf_dir):
    """J4 + C8, T7 with ignore_delay: no catalog yet, typed NULL id."""
    products, run_ts = _products(spark, sf_dir)
    return silver.build_last_version(products, None, run_ts, ignore_delay=True)


@register(
    "last_version_per_key",
    """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
""",
)
def q_last_version_per_key(spark, sf_dir):
    """Newest event per user, window form."""
    events = read_input(spark, sf_dir, "events")
    return latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


ORACLE_LAST_VERSION_MAXBY = ORACLE["last_version_per_key"]


@register("last_version_maxby", ORACLE_LAST_VERSION_MAXBY)
def q_last_version_maxby(spark, sf_dir):
    """C1, aggregate form: max_by over struct(ts, event_id), partial + final."""
    events = read_input(spark, sf_dir, "events")
    return latest_per_key(
        events, ["user_id"], [], method="max_by", max_key=F.struct(F.col("ts"), F.col("event_id"))
    )


@register(
    "last_partition",
    f"""
WITH {PRODUCTS_SQL}
SELECT * FROM products WHERE dt_refe_crga = (SELECT max(dt_refe_crga) FROM products)
""",
)
def q_last_partition(spark, sf_dir):
    """Rows of the newest load only (scalar subquery filter)."""
    products, _ = _products(spark, sf_dir)
    return T.latest_partition(products, PARTITION_COLUMN)


@register(
    "lagged_partition",
    f"""
WITH {PRODUCTS_SQL}, {AIM_SQL},
early AS (
  SELECT CASE WHEN max(dt_refe_crga) = (SELECT min(dt_refe_crga) FROM products)
              THEN coalesce(max(CASE WHEN dt_refe_crga < (SELECT min(dt_refe_crga) FROM products) THEN dt_refe_crga END),
                            max(dt_refe_crga))
              ELSE max(dt_refe_crga) END AS early_run
  FROM products
)
SELECT (SELECT run_date FROM run) AS run_date, latest AS latest_partition, delayed AS aim_delayed,
       latest AS aim_ignore_delay, (SELECT early_run FROM early) AS aim_early_run
FROM aim
""",
)
def q_lagged_partition(spark, sf_dir):
    """Chosen input partition for run date = newest load (one day behind), ignore_delay,
    and a run date before the newest load (gives the newest)."""
    products, run_ts = _products(spark, sf_dir)
    run_date = silver.run_date_of(run_ts)
    first = products.agg(F.min(PARTITION_COLUMN)).scalar()
    return products.sparkSession.range(1).select(
        run_date.alias("run_date"),
        products.agg(F.max(PARTITION_COLUMN)).scalar().alias("latest_partition"),
        T.aim_partition_frame(products, run_date).scalar().alias("aim_delayed"),
        T.aim_partition_frame(products, run_date, ignore_delay=True).scalar().alias("aim_ignore_delay"),
        T.aim_partition_frame(products, first).scalar().alias("aim_early_run"),
    )


@register(
    "partition_list_desc",
    f"""
WITH {PRODUCTS_SQL}
SELECT DISTINCT dt_refe_crga FROM products ORDER BY 1 DESC
""",
)
def q_partition_list_desc(spark, sf_dir):
    """Distinct load dates, newest first, as SQL over a temp view."""
    from vitrine.operators.relational import sql_over_view

    products, _ = _products(spark, sf_dir)
    return sql_over_view(products, f"SELECT DISTINCT {PARTITION_COLUMN} FROM {{df}} ORDER BY 1 DESC")


@register(
    "load_list_desc",
    f"""
WITH {PRODUCTS_SQL}
SELECT DISTINCT dh_exec FROM products ORDER BY 1 DESC
""",
)
def q_load_list_desc(spark, sf_dir):
    """Distinct load timestamps, newest first."""
    products, _ = _products(spark, sf_dir)
    return T.list_loads(products)


@register(
    "distinct_rows",
    f"""
WITH {PRODUCTS_SQL}
SELECT DISTINCT seller, category FROM products
""",
)
def q_distinct_rows(spark, sf_dir):
    """C11: row dedup (partial + final hash aggregate)."""
    products, _ = _products(spark, sf_dir)
    return products.select("seller", "category").distinct()


@register(
    "max_default",
    f"""
WITH {PRODUCTS_SQL}
SELECT coalesce(max(TRY_CAST(id AS BIGINT)), 0) AS max_id,
       (SELECT coalesce(max(TRY_CAST(id AS BIGINT)), 0) FROM products WHERE seller = 'no such seller') AS max_id_empty,
       max(TRY_CAST(id AS INTEGER)) AS max_id_int
FROM products
""",
)
def q_max_default(spark, sf_dir):
    """Highest id, 0 when there is none; text -> int cast."""
    products, _ = _products(spark, sf_dir)
    none = products.filter(F.col("seller") == "no such seller")
    return products.sparkSession.range(1).select(
        max_or_default(products, "id").alias("max_id"),
        max_or_default(none, "id").alias("max_id_empty"),
        products.agg(F.max(F.col("id").try_cast("int"))).scalar().alias("max_id_int"),
    )


@register(
    "limit_sorted",
    f"""
WITH {PRODUCTS_SQL}
SELECT id, url, price_in_cash, dt_refe_crga FROM products
ORDER BY price_in_cash DESC, TRY_CAST(id AS BIGINT) ASC LIMIT 20
""",
)
def q_limit_sorted(spark, sf_dir):
    """The 20 most expensive observations (a top-k report)."""
    products, _ = _products(spark, sf_dir)
    order = [F.col("price_in_cash").desc(), F.col("id").try_cast("bigint").asc()]
    return top_rows(products.select("id", "url", "price_in_cash", PARTITION_COLUMN), 20, order)


@register(
    "seq_ids_scaled",
    """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 1000 AS row_id FROM orders
""",
)
def q_seq_ids_scaled(spark, sf_dir):
    """C12 at scale: global numbering by range splitters, no one-partition window."""
    orders = read_input(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, ["o_orderdate", "o_orderkey"], start=1000)


@register(
    "seq_ids_hot_key",
    """
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                          l_quantity, l_extendedprice) AS row_id
FROM lineitem
""",
)
def q_seq_ids_hot_key(spark, sf_dir):
    """C12 where the leading key has three values: the ranges split inside each value."""
    cols = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    li = read_input(spark, sf_dir, "lineitem").select(*cols)
    return number_rows(li, cols, start=0)


@register(
    "normalise_label",
    """
SELECT p_partkey, trim(regexp_replace('+ ' || p_brand || ' +  ' || p_type || ' ', '\\+\\s*', '', 'g')) AS label FROM part
""",
)
def q_normalise_label(spark, sf_dir):
    """Remove '+' and the blanks after it, trim."""
    part = read_input(spark, sf_dir, "part")
    raw = F.concat(F.lit("+ "), F.col("p_brand"), F.lit(" +  "), F.col("p_type"), F.lit(" "))
    return part.select("p_partkey", normalise_label(raw).alias("label"))


# --------------------------------------------------------------------------- cards

from vitrine.operators import pages as P  # noqa: E402
from vitrine.operators.relational import frame_from_rows  # noqa: E402
from vitrine.operators.dialects import DIALECTS, PRODUCTS_LIMIT  # noqa: E402
from vitrine.sources import listing_html as L  # noqa: E402

CARD_OUTPUT = ["page_url"] + P.BRONZE_FIELDS

CARD_FACTS_SQL = """
facts AS (
  SELECT p_partkey AS pk, p_brand AS category, p_partkey // 1000 AS block,
         p_name || ' #' || CAST(p_partkey AS VARCHAR) AS name,
         CAST(CAST(p_retailprice * p_size AS DECIMAL(18,2)) * 100 AS BIGINT) AS price_cents,
         p_size = 50 AS broken,
         p_size % 13 AS n,
         p_size % 4 <> 0 AS rated,
         (p_size % 50) / 10.0 AS rating_num,
         p_size * 3 + 1 AS users,
         'https://img.example.com/p/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS img_url,
         CAST(row_number() OVER (PARTITION BY p_brand, p_partkey // 1000 ORDER BY p_partkey) AS INTEGER) AS position
  FROM part
),
cards AS (
  SELECT *, CASE WHEN n > 0 THEN price_cents // n END AS inst_cents FROM facts
  WHERE NOT broken
)
"""


def _card_oracle(dialect: str) -> str:
    spec = DIALECTS[dialect]
    site = spec["site"]
    rating_missing = "CAST(NULL AS DOUBLE)" if dialect == "B" else "-999.0"
    return f"""
WITH {CARD_FACTS_SQL}
SELECT '{site}/categoria/' || lower(replace(category, '#', '-')) || '?bloco=' || CAST(block AS VARCHAR) AS page_url,
       name,
       '{site}/produto/' || CAST(pk AS VARCHAR) AS url,
       category,
       price_cents / 100.0 AS price_in_cash,
       CASE WHEN n > 0 THEN (inst_cents * n) / 100.0 END AS price_in_installments,
       CASE WHEN n > 0 THEN n ELSE 0 END AS installments_num,
       CASE WHEN n > 0 THEN inst_cents / 100.0 ELSE -999.0 END AS installment_value,
       img_url AS img,
       '{spec["seller"]}' AS seller,
       CASE WHEN rated THEN rating_num ELSE {rating_missing} END AS rating,
       CASE WHEN rated THEN users ELSE 0 END AS rating_users,
       position
FROM cards
"""


def _cards_query(dialect: str):
    def run(spark, sf_dir):
        part = read_input(spark, sf_dir, "part")
        pages = L.listing_pages(part, dialect)
        return P.extract_products(pages, dialect).select(*CARD_OUTPUT)

    run.__doc__ = f"X8-X27, dialect {dialect}: listing pages rendered from part, cards parsed back."
    return run


for _d in ("A", "B", "C"):
    register(f"cards_dialect_{_d.lower()}", _card_oracle(_d))(_cards_query(_d))


@register(
    "topk_per_category",
    f"""
WITH {CARD_FACTS_SQL}
SELECT category, count(*) AS n_cards, max(position) AS last_position, min(position) AS first_position
FROM facts WHERE position <= 25 GROUP BY category, block
""",
)
def q_topk_per_category(spark, sf_dir):
    """First 25 cards per category page, positions count failed cards too."""
    part = read_input(spark, sf_dir, "part")
    cards = P.split_cards(L.listing_pages(part, "A"), "A", PRODUCTS_LIMIT)
    return cards.groupBy("category", "page_id").agg(
        F.count(F.lit(1)).alias("n_cards"),
        F.max("position").alias("last_position"),
        F.min("position").alias("first_position"),
    ).drop("page_id")


@register(
    "brl_round_trip",
    """
SELECT o_orderkey, CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS price,
       CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS price_nbsp,
       CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS price_plain_thousands
FROM orders
""",
)
def q_brl_round_trip(spark, sf_dir):
    """BRL text -> decimal; 'R$ 1.234,56', 'ou R$<nbsp>1.234,56 à vista', '1.234,56'."""
    from vitrine.functions import money as M

    orders = read_input(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    text = L.money_text(cents)
    return orders.select(
        "o_orderkey",
        M.brl(F.concat(F.lit("R$ "), text)).alias("price"),
        M.brl(F.concat(F.lit("ou R$ "), text, F.lit(" à vista"))).alias("price_nbsp"),
        M.brl(text).alias("price_plain_thousands"),
    )


@register(
    "installment_total",
    """
SELECT o_orderkey,
       CAST((o_orderkey % 12) + 1 AS INTEGER) AS installments_num,
       CAST((CAST(round(o_totalprice * 100) AS BIGINT) // ((o_orderkey % 12) + 1)) / 100 AS DECIMAL(18,2)) AS installment_value,
       CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) // ((o_orderkey % 12) + 1) AS DECIMAL(18,2)) / 100
            * ((o_orderkey % 12) + 1) AS DECIMAL(18,2)) AS price_in_installments
FROM orders
""",
)
def q_installment_total(spark, sf_dir):
    """X16, X17, X20: 'Nx de R$ V' -> count, value, exact total value x count."""
    from vitrine.functions import money as M

    orders = read_input(spark, sf_dir, "orders")
    n = (F.col("o_orderkey") % 12 + 1).cast("int")
    cents = F.floor(F.round(F.col("o_totalprice") * 100).cast("bigint") / n).cast("bigint")
    text = F.concat(n.cast("string"), F.lit("x de R$ "), L.money_text(cents), F.lit(" sem juros"))
    value = M.value_after_currency(text)
    count = M.installment_count(text)
    return orders.select(
        "o_orderkey",
        count.alias("installments_num"),
        value.alias("installment_value"),
        M.installment_total(value, count).alias("price_in_installments"),
    )


# --------------------------------------------------------------------------- category links

UNESCAPE_SQL = (
    "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
)
NAV_SQL = """
nav AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages
),
lists AS (
  SELECT page_id, url,
         regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
         regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 2) AS labels
  FROM nav
),
links AS (
  SELECT page_id, url, CAST(i AS INTEGER) AS pos, hrefs[i] AS href, labels[i] AS label_html
  FROM (SELECT *, unnest(generate_series(1, len(hrefs))) AS i FROM lists)
)
"""


@register("nav_links", f"WITH {NAV_SQL} SELECT page_id, url, pos, href, label_html FROM links")
def q_nav_links(spark, sf_dir):
    """X4 (generic menu region), X12: every <nav> link of every page with its position."""
    pages = read_input(spark, sf_dir, "pages")
    return L.nav_links_raw(pages)


def _trimmed(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')"


def _links_oracle(dialect: str) -> str:
    spec = DIALECTS[dialect]
    text = UNESCAPE_SQL.format(x="label_html")
    if dialect == "A":
        body = f"SELECT page_id, pos, {text} AS name, '{spec['site']}' || href AS url FROM links"
    elif dialect == "B":
        body = f"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS INTEGER) AS pos,
       {_trimmed(text)} AS name,
       '{spec['site']}' || href || '/l/' || CAST(pos AS VARCHAR) || '/' || '{spec['category_query']}' AS url
FROM links WHERE pos % 3 <> 0"""
    else:
        body = f"SELECT page_id, pos, {_trimmed(text)} AS name, 'https://lista.example.com' || href AS url FROM links"
    return f"WITH {NAV_SQL} {body}"


def _links_query(dialect: str):
    def run(spark, sf_dir):
        pages = read_input(spark, sf_dir, "pages")
        return P.category_links(L.menu_pages(pages, dialect), dialect)

    run.__doc__ = f"X{4 + 'ABC'.index(dialect)}: category links of dialect {dialect} menus built from the pages' nav links."
    return run


for _d in ("A", "B", "C"):
    register(f"category_links_{_d.lower()}", _links_oracle(_d))(_links_query(_d))


# --------------------------------------------------------------------------- sources and bronze

from vitrine.plans import bronze  # noqa: E402
from vitrine.sources import standins as S  # noqa: E402

HOST_SQL = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
SOURCES_SQL = """
src AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, s_acctbal,
         'https://' || lower(n_name) || '.example/' || CAST(s_suppkey AS VARCHAR) || '/' AS home
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)
"""


@register(
    "active_sources",
    f"""
WITH {SOURCES_SQL}
SELECT id, name,
       2 + (CASE WHEN s_acctbal > 3000 THEN 1 ELSE 0 END) + (CASE WHEN s_acctbal > 6000 THEN 1 ELSE 0 END) AS n_urls,
       CASE WHEN s_acctbal > 8000 THEN 1 ELSE 0 END AS n_categories
FROM src WHERE s_acctbal >= 0
""",
)
def q_active_sources(spark, sf_dir):
    """Keep active sources; url and category counts."""
    sources = S.sources_from_suppliers(read_input(spark, sf_dir, "supplier"), read_input(spark, sf_dir, "nation"))
    return P.active_sources(sources).select("id", "name", "n_urls", "n_categories")


@register(
    "category_page_choice",
    f"""
WITH {SOURCES_SQL}
SELECT id, name,
       CASE WHEN s_acctbal > 6000 THEN home || 'todas-categorias'
            WHEN s_acctbal > 3000 THEN home || 'categorias'
            ELSE home END AS category_url
FROM src
""",
)
def q_category_page_choice(spark, sf_dir):
    """Category page = last kind-1 url, else the kind-0 (home) url."""
    sources = S.sources_from_suppliers(read_input(spark, sf_dir, "supplier"), read_input(spark, sf_dir, "nation"))
    return sources.select("id", "name", P.category_page_url("url").alias("category_url"))


LABEL_SQL = "coalesce(nullif(" + _trimmed(UNESCAPE_SQL.format(x="label_html")) + ", ''), '')"

SELLERS_SRC_SQL = f"""
cand AS (
  SELECT {HOST_SQL} AS host, url, page_id, CASE WHEN contains(url, '?') THEN '1' ELSE '0' END AS kind FROM pages
),
hosts AS (
  SELECT host, min(page_id) AS id, bool_or(starts_with(url, 'https://')) AS active FROM cand GROUP BY host
),
chosen AS (
  SELECT host, url AS category_url, page_id FROM (
    SELECT *, row_number() OVER (PARTITION BY host ORDER BY (kind = '1') DESC, page_id DESC) AS rn FROM cand
  ) WHERE rn = 1
),
found AS (
  SELECT c.host, string_agg({LABEL_SQL} || '=' || 'https://' || c.host || l.href, ';' ORDER BY l.pos) AS txt,
         count(*) AS n
  FROM chosen c JOIN links l ON l.page_id = c.page_id GROUP BY c.host
)
"""


@register(
    "bronze_sellers",
    f"""
WITH {NAV_SQL}, {SELLERS_SRC_SQL}
SELECT CAST(h.id AS VARCHAR) AS id, h.host AS name, c.category_url,
       CAST(coalesce(f.n, 0) + (CASE WHEN starts_with(h.host, 'www.') THEN 1 ELSE 0 END) AS INTEGER) AS n_categories,
       concat_ws(';', CASE WHEN starts_with(h.host, 'www.') THEN 'Ofertas=https://' || h.host || '/ofertas' END, f.txt)
         AS categories_text,
       '2024-03-31' AS dt_refe_crga, TIMESTAMP '2024-03-31 06:00:00' AS dh_exec
FROM hosts h JOIN chosen c ON c.host = h.host LEFT JOIN found f ON f.host = h.host
WHERE h.active
""",
)
def q_bronze_sellers(spark, sf_dir):
    """J2 + X1, X2 (aggregate form), X7, X13: one row per active seller with
    configured + found categories, partition stamp of the run."""
    sources, links = S.sources_from_pages(read_input(spark, sf_dir, "pages"))
    sellers = bronze.build_sellers(sources, links, "2024-03-31 06:00:00")
    text = F.concat_ws(
        ";",
        F.transform("categories", lambda m: F.concat(F.map_keys(m)[0], F.lit("="), F.map_values(m)[0])),
    )
    return sellers.select(
        "id", "name", F.col("url")[0][0].alias("category_url"), F.size("categories").alias("n_categories"),
        text.alias("categories_text"), PARTITION_COLUMN, "dh_exec",
    )


def _mixed_listing(spark, sf_dir):
    part = read_input(spark, sf_dir, "part")
    letter = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")),
                          (F.regexp_extract("p_brand", r"([0-9]+)", 1).cast("int") % 3 + 1).cast("int"))
    return L.listing_pages(part, letter)


def _mixed_cards_oracle(start: str) -> str:
    cases = []
    for i, d in enumerate("ABC"):
        spec = DIALECTS[d]
        cases.append((i, spec))
    site = "CASE b % 3 " + " ".join(f"WHEN {i} THEN '{s['site']}'" for i, s in cases) + " END"
    seller = "CASE b % 3 " + " ".join(f"WHEN {i} THEN '{s['seller']}'" for i, s in cases) + " END"
    return f"""
WITH {CARD_FACTS_SQL},
mixed AS (
  SELECT *, CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) AS b FROM cards
),
rows AS (
  SELECT {site} || '/categoria/' || lower(replace(category, '#', '-')) || '?bloco=' || CAST(block AS VARCHAR) AS page_url,
         name, {site} || '/produto/' || CAST(pk AS VARCHAR) AS url, category,
         price_cents / 100.0 AS price_in_cash,
         CASE WHEN n > 0 THEN (inst_cents * n) / 100.0 END AS price_in_installments,
         CASE WHEN n > 0 THEN n ELSE 0 END AS installments_num,
         CASE WHEN n > 0 THEN inst_cents / 100.0 ELSE -999.0 END AS installment_value,
         img_url AS img, {seller} AS seller,
         CASE WHEN rated THEN rating_num WHEN b % 3 = 1 THEN CAST(NULL AS DOUBLE) ELSE -999.0 END AS rating,
         CASE WHEN rated THEN users ELSE 0 END AS rating_users,
         position
  FROM mixed
)
SELECT CAST({start} + row_number() OVER (ORDER BY seller, category, page_url, position) AS VARCHAR) AS id,
       name, url, category, price_in_cash, price_in_installments, installments_num, installment_value, img,
       seller, rating, rating_users, position,
       '2024-03-31' AS dt_refe_crga, TIMESTAMP '2024-03-31 06:00:00' AS dh_exec
FROM rows
"""


@register("bronze_products", _mixed_cards_oracle("0"))
def q_bronze_products(spark, sf_dir):
    """J1 + X3, X28: listing pages of three shops (dialect by seller), fixed
    schema, ids from 1 (no stored table), stamps."""
    pages = _mixed_listing(spark, sf_dir)
    return bronze.build_products(bronze.extract_listing_products(pages), 0, "2024-03-31 06:00:00")


# --------------------------------------------------------------------------- categories silver

CAT_LINKS_SQL = f"""
cl AS (
  SELECT page_id, {HOST_SQL} AS host, pos, {LABEL_SQL} AS name, 'https://' || {HOST_SQL} || href AS link_url,
         TIMESTAMP '2024-03-01 00:00:00' + page_id * INTERVAL 1 HOUR AS dh
  FROM links
),
loads AS (SELECT DISTINCT page_id, host, dh, strftime(dh, '%Y-%m-%d') AS dt FROM cl),
parts AS (SELECT DISTINCT dt FROM loads),
runinfo AS (
  SELECT max(dh) AS run_ts, strftime(max(dh), '%Y-%m-%d') AS run_date,
         (SELECT max(dt) FROM parts WHERE dt < (SELECT max(dt) FROM parts)) AS prev_dt
  FROM loads
)
"""


def _flat_sql(where: str) -> str:
    return f"""(
  SELECT DISTINCT trim(regexp_replace(cl.name, '\\+\\s*', '', 'g')) AS DS_CATEGORY, n.host AS NM_SELLER,
         cl.link_url AS DS_URL, n.dh AS DH_ORIGIN_EXEC
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY dh DESC, dt DESC) AS rn
                       FROM loads WHERE {where}) WHERE rn = 1) n
  JOIN cl ON cl.page_id = n.page_id
)"""


ID_ORDER_SQL = "concat_ws('|', DS_CATEGORY, NM_SELLER), DS_URL, DH_ORIGIN_EXEC"


def _stored_sellers(spark, sf_dir):
    """The seller history plays the stored bronze table: written once to the
    checkpoint folder, then read by every pass of the job."""
    from vitrine.session import checkpoint_root

    checkpoint_root(spark)
    return S.seller_loads_from_pages(read_input(spark, sf_dir, "pages")).checkpoint(eager=True)


@register(
    "categories_full",
    f"""
WITH {NAV_SQL}, {CAT_LINKS_SQL}, flat AS {_flat_sql('TRUE')}
SELECT CAST(row_number() OVER (ORDER BY {ID_ORDER_SQL}) AS INTEGER) AS ID_CATEGORY,
       DS_CATEGORY, NM_SELLER, DS_URL, DH_ORIGIN_EXEC,
       (SELECT run_date FROM runinfo) AS dt_refe_crga, (SELECT run_ts FROM runinfo) AS dh_exec
FROM flat
""",
)
def q_categories_full(spark, sf_dir):
    """J5 + C3, C9-C12: newest category list per seller over all loads, ids from 1."""
    sellers = _stored_sellers(spark, sf_dir)
    run_ts = sellers.agg(F.max("dh_exec")).scalar()
    return silver.build_categories_full(sellers, run_ts)


def _incremental_sql(dense: bool) -> str:
    new_id = (
        "CASE WHEN old_id IS NOT NULL THEN old_id ELSE "
        "(SELECT coalesce(max(ID_CATEGORY), 0) FROM old) + row_number() OVER (PARTITION BY old_id IS NULL ORDER BY "
        f"{ID_ORDER_SQL}) END"
        if dense
        else f"coalesce(old_id, (SELECT coalesce(max(ID_CATEGORY), 0) FROM old) + row_number() OVER (ORDER BY {ID_ORDER_SQL}))"
    )
    return f"""
WITH {NAV_SQL}, {CAT_LINKS_SQL},
oldflat AS {_flat_sql('dt < (SELECT prev_dt FROM runinfo)')},
old AS (SELECT row_number() OVER (ORDER BY {ID_ORDER_SQL}) AS ID_CATEGORY, * FROM oldflat),
fresh AS {_flat_sql('dt = (SELECT prev_dt FROM runinfo)')},
o AS (
  SELECT *, row_number() OVER (PARTITION BY DS_CATEGORY, NM_SELLER, met ORDER BY DS_URL, ID_CATEGORY) AS k
  FROM (SELECT *, EXISTS (SELECT 1 FROM fresh f WHERE f.DS_CATEGORY = old.DS_CATEGORY AND f.NM_SELLER = old.NM_SELLER
                          AND f.DS_URL IS NOT DISTINCT FROM old.DS_URL) AS met FROM old)
),
f AS (
  SELECT *, row_number() OVER (PARTITION BY DS_CATEGORY, NM_SELLER, met ORDER BY DS_URL, DH_ORIGIN_EXEC) AS k
  FROM (SELECT *, EXISTS (SELECT 1 FROM old o WHERE o.DS_CATEGORY = fresh.DS_CATEGORY AND o.NM_SELLER = fresh.NM_SELLER
                          AND o.DS_URL IS NOT DISTINCT FROM fresh.DS_URL) AS met FROM fresh)
),
merged AS (
  SELECT o.ID_CATEGORY AS old_id,
         coalesce(f.DS_CATEGORY, o.DS_CATEGORY) AS DS_CATEGORY, coalesce(f.NM_SELLER, o.NM_SELLER) AS NM_SELLER,
         coalesce(f.DS_URL, o.DS_URL) AS DS_URL, coalesce(f.DH_ORIGIN_EXEC, o.DH_ORIGIN_EXEC) AS DH_ORIGIN_EXEC
  FROM o FULL OUTER JOIN f ON o.DS_CATEGORY = f.DS_CATEGORY AND o.NM_SELLER = f.NM_SELLER AND o.met = f.met AND o.k = f.k
)
SELECT CAST({new_id} AS INTEGER) AS ID_CATEGORY, DS_CATEGORY, NM_SELLER, DS_URL, DH_ORIGIN_EXEC,
       (SELECT run_date FROM runinfo) AS dt_refe_crga, (SELECT run_ts FROM runinfo) AS dh_exec
FROM merged
"""


def _incremental_query(dense: bool):
    def run(spark, sf_dir):
        sellers = _stored_sellers(spark, sf_dir)
        run_ts = sellers.agg(F.max("dh_exec")).scalar()
        parts = sellers.select(PARTITION_COLUMN).distinct()
        latest = parts.agg(F.max(PARTITION_COLUMN)).scalar()
        prev = parts.filter(F.col(PARTITION_COLUMN) < latest).agg(F.max(PARTITION_COLUMN)).scalar()
        earlier = sellers.filter(F.col(PARTITION_COLUMN) < prev)
        # the earlier load plays the stored silver table: written once
        from vitrine.session import checkpoint_root

        checkpoint_root(spark)
        old = silver.build_categories_full(earlier, run_ts).checkpoint(eager=True)
        return silver.build_categories_incremental(sellers, old, run_ts, ignore_delay=False, dense=dense)

    run.__doc__ = ("J6 + C13-C15: merge the D-1 load into an earlier full load; "
                   + ("dense ids for new rows." if dense else "ids as coded (rank over all merged rows)."))
    return run


register("categories_incremental", _incremental_sql(False))(_incremental_query(False))
register("categories_incremental_dense", _incremental_sql(True))(_incremental_query(True))


# --------------------------------------------------------------------------- tables

from vitrine.session import scratch_location  # noqa: E402
from vitrine.sources import export as X  # noqa: E402


def _scratch_db(spark) -> str:
    import uuid as _uuid

    configure(spark)
    name = f"vitrine_q_{_uuid.uuid4().hex[:10]}"
    T.create_database(spark, name, scratch_location(spark, name))
    return name


SPLIT_DATE = "2024-01-16"


@register(
    "append_merge_schema",
    f"""
WITH {PRODUCTS_SQL}
SELECT * REPLACE (CAST(NULL AS INTEGER) AS rating_users) FROM products WHERE dt_refe_crga < '{SPLIT_DATE}'
UNION ALL
SELECT * FROM products WHERE dt_refe_crga >= '{SPLIT_DATE}'
""",
)
def q_append_merge_schema(spark, sf_dir):
    """First load creates the table (no rating_users column),
    second load appends with a new column: added by ALTER TABLE, old rows NULL."""
    products, _ = _products(spark, sf_dir)
    name = f"{_scratch_db(spark)}.b_products"
    first = products.filter(F.col(PARTITION_COLUMN) < SPLIT_DATE).drop("rating_users")
    T.save_table(spark, first, name, PARTITION_COLUMN, "append", "merge")
    second = products.filter(F.col(PARTITION_COLUMN) >= SPLIT_DATE)
    T.save_table(spark, second.select(*reversed(second.columns)), name, PARTITION_COLUMN, "append", "merge")
    return T.read_table(spark, name)


@register(
    "overwrite_partition",
    f"""
WITH {PRODUCTS_SQL}
SELECT * FROM products WHERE dt_refe_crga < (SELECT max(dt_refe_crga) FROM products)
UNION ALL
SELECT * REPLACE (price_in_cash * 2 AS price_in_cash) FROM products
WHERE dt_refe_crga = (SELECT max(dt_refe_crga) FROM products)
""",
)
def q_overwrite_partition(spark, sf_dir):
    """T9 (Q1, Q2): overwrite the newest partition twice with reordered
    columns; the others stay, the rerun does not duplicate."""
    products, _ = _products(spark, sf_dir)
    name = f"{_scratch_db(spark)}.b_products"
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    newest = T.latest_partition(products).withColumn("price_in_cash", F.col("price_in_cash") * 2)
    shuffled = newest.select(*sorted(newest.columns))
    T.save_table(spark, shuffled, name, PARTITION_COLUMN, "overwrite")
    T.save_table(spark, shuffled, name, PARTITION_COLUMN, "overwrite")
    return T.read_table(spark, name)


@register(
    "overwrite_table",
    f"""
WITH {PRODUCTS_SQL}
SELECT * FROM products WHERE dt_refe_crga = (SELECT min(dt_refe_crga) FROM products)
""",
)
def q_overwrite_table(spark, sf_dir):
    """Overwrite without partition column replaces the whole table."""
    products, _ = _products(spark, sf_dir)
    name = f"{_scratch_db(spark)}.b_products"
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    first = products.filter(F.col(PARTITION_COLUMN) == products.agg(F.min(PARTITION_COLUMN)).scalar())
    T.save_table(spark, first, name, None, "overwrite")
    return T.read_table(spark, name)


@register(
    "drop_partition",
    f"""
WITH {PRODUCTS_SQL}
SELECT * FROM products
WHERE dt_refe_crga NOT IN ((SELECT max(dt_refe_crga) FROM products), (SELECT min(dt_refe_crga) FROM products))
""",
)
def q_drop_partition(spark, sf_dir):
    """Drop the newest partition, then a given one (the oldest)."""
    products, _ = _products(spark, sf_dir)
    name = f"{_scratch_db(spark)}.b_products"
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    T.drop_partition(spark, name, latest=True)
    oldest = T.list_partitions(spark, name).agg(F.min(PARTITION_COLUMN)).first()[0]
    T.drop_partition(spark, name, value=oldest, latest=True)
    return T.read_table(spark, name)


@register(
    "truncate_table",
    f"""
WITH {PRODUCTS_SQL}
SELECT * FROM products WHERE dt_refe_crga = (SELECT max(dt_refe_crga) FROM products)
""",
)
def q_truncate_table(spark, sf_dir):
    """Truncate keeps the table and schema; the next load is alone in it."""
    products, _ = _products(spark, sf_dir)
    db = _scratch_db(spark)
    name = f"{db}.b_products"
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    T.truncate_table(spark, name)
    T.save_table(spark, T.latest_partition(products), name, PARTITION_COLUMN, "append")
    return T.read_table(spark, name)


@register(
    "register_path",
    f"""
WITH {PRODUCTS_SQL}
SELECT * FROM products WHERE dt_refe_crga = (SELECT max(dt_refe_crga) FROM products)
""",
)
def q_register_path(spark, sf_dir):
    """Files written by path, registered as a table,
    newest partition read from the table."""
    products, _ = _products(spark, sf_dir)
    db = _scratch_db(spark)
    path = scratch_location(spark, "files")
    products.write.partitionBy(PARTITION_COLUMN).parquet(path)
    T.register_table(spark, f"{db}.registered", path)
    return T.read_table(spark, f"{db}.registered", latest_only=True)


@register(
    "partitions_of_table",
    f"""
WITH {PRODUCTS_SQL}
SELECT DISTINCT dt_refe_crga FROM products
""",
)
def q_partitions_of_table(spark, sf_dir):
    """T6 from the catalog (SHOW PARTITIONS)."""
    products, _ = _products(spark, sf_dir)
    db = _scratch_db(spark)
    name = f"{db}.b_products"
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    return T.list_partitions(spark, name)


@register("read_missing", "SELECT * FROM (SELECT 'x' AS ID_ORIGIN) WHERE false")
def q_read_missing(spark, sf_dir):
    """A missing table reads as an empty frame with the expected schema."""
    from pyspark.sql.types import StringType, StructField, StructType

    configure(spark)
    schema = StructType([StructField("ID_ORIGIN", StringType())])
    missing = T.read_table(spark, f"{_scratch_db(spark)}.absent", missing_ok=True, schema=schema)
    events = read_input(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("ID_ORIGIN"))
    return missing.unionByName(events.join(missing, "ID_ORIGIN", "left_semi"))


NEWEST_SQL = f"""
WITH {PRODUCTS_SQL}
SELECT * FROM products WHERE dt_refe_crga = (SELECT max(dt_refe_crga) FROM products)
"""


@register("read_path_latest", NEWEST_SQL)
def q_read_path_latest(spark, sf_dir):
    """T4: the newest partition of a folder that no table names."""
    products, _ = _products(spark, sf_dir)
    path = scratch_location(spark, "files")
    products.write.partitionBy(PARTITION_COLUMN).parquet(path)
    return T.read_path(spark, path, latest_only=True).select(*products.columns)


@register("null_load_date", NEWEST_SQL)
def q_null_load_date(spark, sf_dir):
    """Rows without a load date (here: the oldest load's) are never the newest partition."""
    products, _ = _products(spark, sf_dir)
    name = f"{_scratch_db(spark)}.b_products"
    oldest = products.agg(F.min(PARTITION_COLUMN)).scalar()
    dates = F.when(F.col(PARTITION_COLUMN) != oldest, F.col(PARTITION_COLUMN))
    T.save_table(spark, products.withColumn(PARTITION_COLUMN, dates), name, PARTITION_COLUMN, "append")
    return T.read_table(spark, name, latest_only=True)


@register(
    "schema_policies",
    f"""
WITH {PRODUCTS_SQL}
SELECT * REPLACE (CASE WHEN dt_refe_crga = (SELECT max(dt_refe_crga) FROM products) THEN rating_users END AS rating_users)
FROM products
""",
)
def q_schema_policies(spark, sf_dir):
    """T11: "none" and append + "overwrite" refuse a new column; "overwrite" of a
    partition adds it and leaves the other partitions."""
    products, _ = _products(spark, sf_dir)
    name = f"{_scratch_db(spark)}.b_products"
    T.save_table(spark, products.drop("rating_users"), name, PARTITION_COLUMN, "append")
    newest = T.latest_partition(products)
    for mode, option in (("append", "none"), ("append", "overwrite")):
        try:
            T.save_table(spark, newest, name, PARTITION_COLUMN, mode, option)
        except ValueError:
            continue
        raise AssertionError(f"{mode} with schema option {option} took a new column")
    T.save_table(spark, newest, name, PARTITION_COLUMN, "overwrite", "overwrite")
    return T.read_table(spark, name)


@register(
    "changed_type",
    f"""
WITH {PRODUCTS_SQL}
SELECT * REPLACE (CAST(rating_users AS VARCHAR) || CASE WHEN dt_refe_crga = (SELECT max(dt_refe_crga) FROM products) THEN '+' ELSE '' END AS rating_users)
FROM products
""",
)
def q_changed_type(spark, sf_dir):
    """A partition overwritten with another type of a column; the other partitions stay and are cast."""
    products, _ = _products(spark, sf_dir)
    name = f"{_scratch_db(spark)}.b_products"
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    newest = T.latest_partition(products).withColumn("rating_users", F.concat(F.col("rating_users").cast("string"), F.lit("+")))
    T.save_table(spark, newest, name, PARTITION_COLUMN, "overwrite", "overwrite")
    return T.read_table(spark, name)


@register(
    "describe_databases",
    """
SELECT r_name, 'Suppliers of ' || r_name AS comment, CAST(count(DISTINCT n_nationkey) AS VARCHAR) AS nations, true AS at_location,
       1 AS n_tables, count(s_suppkey) AS n_rows
FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY r_name
""",
)
def q_describe_databases(spark, sf_dir):
    """A database a region with its suppliers as a table; name, comment, property and location as described."""
    region, nation = read_input(spark, sf_dir, "region"), read_input(spark, sf_dir, "nation")
    homes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    counts = {r["r_name"]: r["n"] for r in homes.groupBy("r_name").agg(F.countDistinct("n_nationkey").alias("n")).collect()}  # the regions
    supplier = read_input(spark, sf_dir, "supplier").join(homes, F.col("s_nationkey") == F.col("n_nationkey"))
    out = []
    for region_name, nations in sorted(counts.items()):
        db = f"{_scratch_db(spark)}_{region_name.lower().replace(' ', '_')}"
        place = scratch_location(spark, "database")
        T.create_database(spark, db, place, f"Suppliers of {region_name}", {"nations": str(nations)})
        T.save_table(spark, supplier.filter(F.col("r_name") == region_name), f"{db}.suppliers")
        info = T.describe_database(spark, db)
        value = {r["info_name"]: r["info_value"] for r in info.collect()}  # one row a property of the database
        assert value["Namespace Name"] == db
        out.append(info.filter("info_name = 'Comment'").select(
            F.lit(region_name).alias("r_name"), F.col("info_value").alias("comment"),
            F.lit(value["Properties"].strip("()").split(",")[1].strip(" )")).alias("nations"),
            F.lit(value["Location"].endswith(place.split(":")[-1])).alias("at_location"),
            F.lit(len(T.list_tables(spark, db))).alias("n_tables")).crossJoin(
                T.read_table(spark, f"{db}.suppliers").agg(F.count(F.lit(1)).alias("n_rows"))))
    return reduce(lambda a, b: a.unionByName(b), out)


@register(
    "table_lifecycle",
    """
SELECT 1 AS step, 'missing' AS state, 0 AS n_tables, 0 AS n_rows, true AS database_exists
UNION ALL SELECT 2, 'loaded', 1, (SELECT count(*) FROM events), true
UNION ALL SELECT 3, 'bad mode refused', 1, (SELECT count(*) FROM events), true
UNION ALL SELECT 4, 'truncated', 1, 0, true
UNION ALL SELECT 5, 'dropped', 0, 0, true
UNION ALL SELECT 6, 'loaded again', 1, (SELECT count(*) FROM events), true
UNION ALL SELECT 7, 'database dropped', 0, 0, false
""",
)
def q_table_lifecycle(spark, sf_dir):
    """What is there after each step of a table's life."""
    products, _ = _products(spark, sf_dir)
    db = _scratch_db(spark)
    name = f"{db}.b_products"
    seen = []

    def look(state):
        there = spark.catalog.databaseExists(db)
        rows = T.read_table(spark, name, missing_ok=True, schema=products.schema).count()
        seen.append((len(seen) + 1, state, len(T.list_tables(spark, db)) if there else 0, rows, there))

    look("missing")
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    look("loaded")
    try:
        T.save_table(spark, products, name, PARTITION_COLUMN, "upsert")
    except ValueError:
        look("bad mode refused")
    T.truncate_table(spark, name)
    look("truncated")
    T.drop_table(spark, name)
    look("dropped")
    T.save_table(spark, products, name, PARTITION_COLUMN, "append")
    look("loaded again")
    T.drop_database(spark, db)
    look("database dropped")
    return spark.createDataFrame(seen, "step int, state string, n_tables int, n_rows bigint, database_exists boolean")


@register(
    "load_date_zone",
    "SELECT strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS dt_refe_crga, count(*) AS n_rows FROM events GROUP BY 1",
)
def q_load_date_zone(spark, sf_dir):
    """Load dates of UTC stamps in the zone of the jobs."""
    from vitrine.session import TIME_ZONE

    configure(spark)
    stamps = read_input(spark, sf_dir, "events").select(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")).alias("stamp"))
    with T.session_setting(spark, "spark.sql.session.timeZone", TIME_ZONE):
        dated = T.with_load_stamp(stamps, F.to_timestamp("stamp"))
        return dated.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))


EXPORT_COLS = ["id", "url", "price_in_cash", "position", PARTITION_COLUMN]


@register(
    "export_csv_capped",
    f"WITH {PRODUCTS_SQL} SELECT id, url, price_in_cash, position, dt_refe_crga FROM products",
)
def q_export_csv_capped(spark, sf_dir):
    """One CSV file with header and all rows, read back."""
    products, _ = _products(spark, sf_dir)
    target = scratch_location(spark, "export") + "/products.csv"
    X.export_csv(products.select(*EXPORT_COLS), target)
    schema = "id string, url string, price_in_cash double, position int, dt_refe_crga string"
    return spark.read.schema(schema).option("header", "true").csv(target)


@register("export_parquet", f"WITH {PRODUCTS_SQL} SELECT * FROM products")
def q_export_parquet(spark, sf_dir):
    """One Parquet file, read back."""
    products, _ = _products(spark, sf_dir)
    target = scratch_location(spark, "export") + "/products.parquet"
    X.export_parquet(products, target)
    return spark.read.parquet(target)


# --------------------------------------------------------------------------- end to end

DAY1, DAY2 = "2024-04-01 06:00:00", "2024-04-02 06:00:00"


def _listing_links(listing: DataFrame) -> DataFrame:
    """The category links of the three shops: one per listing page."""
    return listing.select("seller", F.lit(1).alias("pos"), F.col("category").alias("name"), "url")


@register(
    "jobs_last_version",
    f"""
SELECT id AS ID_ORIGIN, name AS NM_PRODUCT, url AS DS_URL, img AS DS_IMG, category AS DS_CATEGORY,
       price_in_cash AS VL_CASH, price_in_installments AS VL_INSTALLMENTS, installments_num AS NR_INSTALLMENTS,
       installment_value AS VL_SINGLE_INSTALLMENT, seller AS NM_SELLER, rating AS VL_RATING,
       rating_users AS QT_RATING_USERS, position AS NR_POSITION,
       concat_ws('-', substring(seller, 1, 4), md5(url)) AS ID_CATALOG,
       '2024-04-02' AS dt_refe_crga, TIMESTAMP '{DAY2}' AS dh_exec
FROM ({_mixed_cards_oracle("0")}) base
""",
)
def q_jobs_last_version(spark, sf_dir):
    """J8 twice (ids of day 2 continue after day 1), then J9 on day 2 with J7
    (empty silver: full load); the last version comes from day 1 (one day
    behind), with catalog ids."""
    bronze_db, silver_db = _scratch_db(spark), _scratch_db(spark)
    dbs = {"BRONZE": bronze_db, "SILVER": silver_db}
    listing = _mixed_listing(spark, sf_dir)
    sources, links = bronze.default_sources(spark), _listing_links(listing)
    bronze.run_bronze(spark, listing, sources, links, DAY1, databases=dbs)
    bronze.run_bronze(spark, listing, sources, links, DAY2, databases=dbs)
    silver.run_silver(spark, DAY2, databases=dbs)
    return T.read_table(spark, f"{silver_db}.s_last_ver_products", latest_only=True)


@register(
    "jobs_product_ids",
    f"""
SELECT dt_refe_crga, count(*) AS n, min(CAST(id AS BIGINT)) AS first_id, max(CAST(id AS BIGINT)) AS last_id
FROM (
  SELECT '2024-04-01' AS dt_refe_crga, id FROM ({_mixed_cards_oracle("0")}) a
  UNION ALL
  SELECT '2024-04-02', CAST(CAST(id AS BIGINT) + (SELECT count(*) FROM ({_mixed_cards_oracle("0")}) c) AS VARCHAR)
  FROM ({_mixed_cards_oracle("0")}) b
) GROUP BY dt_refe_crga
""",
)
def q_jobs_product_ids(spark, sf_dir):
    """Product ids continue after the stored maximum across loads
    (second load: maximum read from the newest partition only)."""
    bronze_db = _scratch_db(spark)
    dbs = {"BRONZE": bronze_db}
    listing = _mixed_listing(spark, sf_dir)
    sources, links = bronze.default_sources(spark), _listing_links(listing)
    bronze.run_bronze(spark, listing, sources, links, DAY1, databases=dbs)
    bronze.run_bronze(spark, listing, sources, links, DAY2, databases=dbs, id_start="latest_partition")
    table = T.read_table(spark, f"{bronze_db}.b_products")
    return table.groupBy(PARTITION_COLUMN).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.col("id").cast("bigint")).alias("first_id"),
        F.max(F.col("id").cast("bigint")).alias("last_id"),
    )


@register(
    "dialect_dispatch",
    f"""
WITH {CARD_FACTS_SQL},
b AS (SELECT DISTINCT category, block, CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) % 3 AS d FROM facts)
SELECT CASE d WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS dialect,
       CASE d WHEN 0 THEN '{DIALECTS["A"]["seller"]}' WHEN 1 THEN '{DIALECTS["B"]["seller"]}'
              ELSE '{DIALECTS["C"]["seller"]}' END AS seller,
       CASE d WHEN 0 THEN '{DIALECTS["A"]["site"]}' WHEN 1 THEN '{DIALECTS["B"]["site"]}'
              ELSE '{DIALECTS["C"]["site"]}' END AS site,
       count(*) AS n_pages
FROM b GROUP BY 1, 2, 3
""",
)
def q_dialect_dispatch(spark, sf_dir):
    """Listing pages joined to the three-row dialect table (built
    from local rows with a fixed schema; broadcast, as its size is fixed)."""
    from vitrine.operators.dialects import dialect_table

    pages = _mixed_listing(spark, sf_dir).select("page_id", "seller")
    joined = pages.join(F.broadcast(dialect_table(spark)), "seller")
    return joined.groupBy("dialect", "seller", "site").agg(F.count(F.lit(1)).alias("n_pages"))


@register(
    "jobs_categories",
    f"""
WITH {NAV_SQL}, {SELLERS_SRC_SQL},
fixed AS (
  SELECT h.host, 0 AS pos, 'Ofertas' AS name, 'https://' || h.host || '/ofertas' AS link_url
  FROM hosts h WHERE h.active AND starts_with(h.host, 'www.')
),
found_links AS (
  SELECT c.host, l.pos, {LABEL_SQL} AS name, 'https://' || c.host || l.href AS link_url
  FROM chosen c JOIN hosts h ON h.host = c.host AND h.active JOIN links l ON l.page_id = c.page_id
),
flat AS (
  SELECT DISTINCT trim(regexp_replace(name, '\\+\\s*', '', 'g')) AS DS_CATEGORY, host AS NM_SELLER,
         link_url AS DS_URL, TIMESTAMP '{DAY1}' AS DH_ORIGIN_EXEC
  FROM (SELECT * FROM fixed UNION ALL SELECT * FROM found_links)
)
SELECT CAST(row_number() OVER (ORDER BY {ID_ORDER_SQL}) AS INTEGER) AS ID_CATEGORY,
       DS_CATEGORY, NM_SELLER, DS_URL, DH_ORIGIN_EXEC,
       '2024-04-01' AS dt_refe_crga, TIMESTAMP '{DAY1}' AS dh_exec
FROM flat
""",
)
def q_jobs_categories(spark, sf_dir):
    """J8 then J9 (J7: empty silver gives a full load, J5): the category catalog
    built from the stored b_sellers table (nested array<map>, T9 overwrite)."""
    bronze_db, silver_db = _scratch_db(spark), _scratch_db(spark)
    dbs = {"BRONZE": bronze_db, "SILVER": silver_db}
    listing = _mixed_listing(spark, sf_dir)
    sources, links = S.sources_from_pages(read_input(spark, sf_dir, "pages"))
    bronze.run_bronze(spark, listing, sources, links, DAY1, databases=dbs)
    silver.run_silver(spark, DAY1, databases=dbs)
    return T.read_table(spark, f"{silver_db}.s_categories_catalog", latest_only=True)


def _last_menu_sql(i: int, dialect: str) -> str:
    rows = f"SELECT * FROM ({_links_oracle(dialect)}) WHERE page_id % 3 = {i}"
    return f"""
SELECT '{DIALECTS[dialect]["seller"]}' AS seller, pos, name, url
FROM ({rows}) WHERE page_id = (SELECT max(page_id) FROM ({rows}))"""


@register("chosen_menu_links", " UNION ALL ".join(_last_menu_sql(i, d) for i, d in enumerate(DIALECTS)))
def q_chosen_menu_links(spark, sf_dir):
    """X1, X2, X4-X6 as in the run: of many loads of the shops' menu pages one page each counts."""
    pages = read_input(spark, sf_dir, "pages")
    menus = [
        L.menu_pages(pages.filter(F.col("page_id") % 3 == i), d).withColumn("seller", F.lit(spec["seller"]))
        for i, (d, spec) in enumerate(DIALECTS.items())
    ]
    every = menus[0].unionByName(menus[1]).unionByName(menus[2])
    return bronze.links_from_menu_pages(bronze.chosen_menu_pages(every, bronze.default_sources(spark)))


@register(
    "card_counts",
    f"""
WITH {CARD_FACTS_SQL}
SELECT CASE CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) % 3
         WHEN 0 THEN '{DIALECTS["A"]["seller"]}' WHEN 1 THEN '{DIALECTS["B"]["seller"]}' ELSE '{DIALECTS["C"]["seller"]}' END AS seller,
       count(*) AS n_cards, count(*) FILTER (broken) AS n_failed, 0 AS n_unknown
FROM facts GROUP BY 1
""",
)
def q_card_counts(spark, sf_dir):
    """Cards found and cards failed per seller."""
    return bronze.card_counts(_mixed_listing(spark, sf_dir))


@register(
    "jobs_card_counts",
    f"""
WITH {CARD_FACTS_SQL},
seen AS (SELECT CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) % 3 AS d, broken FROM facts)
SELECT seller, count(d) AS n_cards, count(*) FILTER (broken) AS n_failed, CAST(0 AS BIGINT) AS n_unknown
FROM (VALUES (0, '{DIALECTS["A"]["seller"]}'), (1, '{DIALECTS["B"]["seller"]}'), (2, '{DIALECTS["C"]["seller"]}')) s(k, seller)
LEFT JOIN seen ON d = k GROUP BY seller
UNION ALL SELECT NULL, 0, 0, (SELECT count(DISTINCT category || '|' || CAST(block AS VARCHAR)) FROM facts)
""",
)
def q_jobs_card_counts(spark, sf_dir):
    """Cards found and failed per seller as the load itself counts them (one parse);
    the pages come once more under an active source that has no dialect."""
    dbs = {"BRONZE": _scratch_db(spark)}
    listing = _mixed_listing(spark, sf_dir)
    other = listing.withColumn("seller", F.lit("Outra"))
    sources = bronze.default_sources(spark)
    more = sources.limit(1).withColumns({"id": F.lit(9), "name": F.lit("Outra")})
    every = listing.unionByName(other)
    done = bronze.run_bronze(spark, every, sources.unionByName(more), _listing_links(every), DAY1, databases=dbs)
    return frame_from_rows(spark, done["cards"], bronze.CARD_COUNTS_SCHEMA)


@register(
    "jobs_categories_incremental",
    f"""
WITH {NAV_SQL}, {SELLERS_SRC_SQL},
named AS (
  SELECT h.id, h.host, 'Ofertas' AS name, 'https://' || h.host || '/ofertas' AS link_url
  FROM hosts h WHERE h.active AND starts_with(h.host, 'www.')
  UNION ALL
  SELECT h.id, c.host, {LABEL_SQL}, 'https://' || c.host || l.href
  FROM chosen c JOIN hosts h ON h.host = c.host AND h.active JOIN links l ON l.page_id = c.page_id
),
flat AS (
  SELECT DISTINCT trim(regexp_replace(name, '\\+\\s*', '', 'g')) AS DS_CATEGORY, host AS NM_SELLER, link_url AS DS_URL, id FROM named
),
old AS (
  SELECT *, row_number() OVER (ORDER BY concat_ws('|', DS_CATEGORY, NM_SELLER), DS_URL) AS old_id FROM flat WHERE id % 2 = 0
),
ranked AS (SELECT *, row_number() OVER (ORDER BY concat_ws('|', DS_CATEGORY, NM_SELLER), DS_URL) AS place FROM flat)
SELECT CAST(coalesce(old_id, place + (SELECT coalesce(max(old_id), 0) FROM old)) AS INTEGER) AS ID_CATEGORY,
       r.DS_CATEGORY, r.NM_SELLER, r.DS_URL, TIMESTAMP '{DAY2}' AS DH_ORIGIN_EXEC,
       '2024-04-02' AS dt_refe_crga, TIMESTAMP '{DAY2}' AS dh_exec
FROM ranked r LEFT JOIN old o ON o.DS_CATEGORY = r.DS_CATEGORY AND o.NM_SELLER = r.NM_SELLER AND o.DS_URL = r.DS_URL
""",
)
def q_jobs_categories_incremental(spark, sf_dir):
    """J8 and J9 on two days; day 1 has half the sellers. On day 2 J7 finds stored
    categories and takes the incremental load (J6): stored ids stay."""
    bronze_db, silver_db = _scratch_db(spark), _scratch_db(spark)
    dbs = {"BRONZE": bronze_db, "SILVER": silver_db}
    listing = _mixed_listing(spark, sf_dir)
    sources, links = S.sources_from_pages(read_input(spark, sf_dir, "pages"))
    bronze.run_bronze(spark, listing, sources.filter(F.col("id") % 2 == 0), links, DAY1, databases=dbs)
    silver.run_silver(spark, DAY1, databases=dbs)
    bronze.run_bronze(spark, listing, sources, links, DAY2, databases=dbs)
    done = silver.run_silver(spark, DAY2, ignore_delay=True, databases=dbs)
    assert "(incremental)" in done["categories"]
    return T.read_table(spark, f"{silver_db}.s_categories_catalog", latest_only=True)


# --------------------------------------------------------------------------- catalog by increments


@register(
    "catalog_incremental",
    f"""
WITH {PRODUCTS_SQL}, {CATALOG_SQL}
SELECT c.*, r.run_date AS dt_refe_crga, r.run_ts AS dh_exec FROM catalog c, run r
""",
)
def q_catalog_incremental(spark, sf_dir):
    """J3, C1 by increments: the last three loads come one by one, each merged into the stored newest rows;
    the catalog equals a rebuild from all loads."""
    products, run_ts = _products(spark, sf_dir)
    db = _scratch_db(spark)
    bronze_name, state_name = f"{db}.b_products", f"{db}.s_catalog_state"
    days = [r[0] for r in products.select(PARTITION_COLUMN).distinct().orderBy(PARTITION_COLUMN).collect()]
    steps = [days[:-2], days[-2:-1], days[-1:]]
    for step in filter(None, steps):
        loaded = products.filter(F.col(PARTITION_COLUMN).isin(step))
        T.save_table(spark, loaded, bronze_name, PARTITION_COLUMN, "append")
        state = silver.update_catalog_state(spark, bronze_name, state_name)
    return silver.catalog_from_newest(state, run_ts)
