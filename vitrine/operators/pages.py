"""Page extraction as Spark jobs.

Input is a table of pages ``(page_id, url, html[, seller, category])``.
Nested markup is no regular language: ``mapInArrow`` reads each listing page once into an element index
(``elements.py``), whichever dialect its seller has, and takes the texts of all cards from it. Numbers, links and
sentinels are Catalyst expressions on these texts. Menus are flat: regular expressions in the JVM.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import html as H
from vitrine.functions import money as M
from vitrine.operators import elements as E
from vitrine.operators.dialects import DIALECTS
from vitrine.operators.numbering import running_offsets

CARD_BYTES = 8 << 20  # texts held before a batch of cards is handed on
ROW_BYTES = 512  # what a held card costs besides its texts
PAGE_BITS = 33  # a page's number holds its task above these bits
HOST = r"^https?://([^/?#]+)"


def host_of(url: Column | str) -> Column:
    return F.regexp_extract(F.col(url) if isinstance(url, str) else url, HOST, 1)


# --------------------------------------------------------------------------- sources


def active_sources(sources: DataFrame) -> DataFrame:
    """Active sources with their url and category counts."""
    return sources.filter(F.col("active")).select(
        "*", F.size("url").alias("n_urls"), F.size("categories").alias("n_categories")
    )


def category_page_url(urls: Column | str) -> Column:
    """Category page of a source url list ``array<array<string>>`` of [url, kind].

    The last kind-1 entry, else the last kind-0 entry, else NULL.
    """
    urls = F.col(urls) if isinstance(urls, str) else urls

    def last_of(kind: str) -> Column:
        hit = F.filter(urls, lambda x: x[1] == F.lit(kind))
        return F.try_element_at(hit, F.lit(-1))[0]

    return F.coalesce(last_of("1"), last_of("0"))


def append_categories(fixed: Column | str, found: Column | str) -> Column:
    """Configured categories followed by the ones found on the page."""
    fixed = F.col(fixed) if isinstance(fixed, str) else fixed
    found = F.col(found) if isinstance(found, str) else found
    return F.concat(F.coalesce(fixed, F.array().cast("array<map<string,string>>")), found)


def categories_as_maps(links: DataFrame, keys: list[str]) -> DataFrame:
    """Links ``(keys..., pos, name, url)`` -> one row per key with
    ``array<map<name,url>>`` in page order (X7, J2). One row per page link,
    so each group is bounded by one page when a key has one page, as
    ``bronze.chosen_menu_pages`` sees to it."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "name", "url")))
    return links.groupBy(*keys).agg(
        # a map key cannot be NULL: a link without a name gets ''
        F.transform(ordered, lambda x: F.create_map(F.coalesce(x["name"], F.lit("")), x["url"])).alias("found"),
        F.count(F.lit(1)).alias("n_found"),
    )


# --------------------------------------------------------------------------- category links


def category_links(pages: DataFrame, dialect: str) -> DataFrame:
    """Category links of menu pages in ``dialect``: (page_id, pos, name, url).

    A: anchors whose class starts with the menu prefix; name = title, url = site + href.
    B: anchors of the links menu whose href looks like ``/x/l/y/``; name = text,
       url = site + href + best-seller query.
    C: n-th name div paired with n-th link; the shorter list decides.
    """
    spec = DIALECTS[dialect]
    tag, attr_name, value = spec["menu_region"]
    area = H.region("html", tag, attr_name, value)
    extra = [c for c in pages.columns if c not in ("page_id", "html", "url")]
    if dialect == "A":
        anchors = F.regexp_extract_all(
            area, F.lit(f"({H.start_tag_pattern('a', 'class', re.escape(spec['menu_link_class_prefix']), 'prefix')})"), 1
        )
        rows = pages.select("page_id", *extra, F.posexplode(anchors).alias("pos0", "tag"))
        return rows.select(
            "page_id",
            *extra,
            (F.col("pos0") + 1).alias("pos"),
            H.attr("tag", "title").alias("name"),
            F.concat(F.lit(spec["site"]), H.attr("tag", "href")).alias("url"),
        )
    if dialect == "B":
        menu = F.regexp_extract(area, r"(?s)^(.*?)</nav>", 1)
        links = F.filter(
            F.regexp_extract_all(menu, F.lit(r"(?s)(<a\b[^>]*>.*?</a>)"), 1),
            lambda a: F.regexp_like(H.attr(H.start_tag(a, "a"), "href"), F.lit(spec["menu_href"])),
        )
        rows = pages.select("page_id", *extra, F.posexplode(links).alias("pos0", "a"))
        return rows.select(
            "page_id",
            *extra,
            (F.col("pos0") + 1).alias("pos"),
            F.coalesce(H.text_of("a"), F.lit("")).alias("name"),
            F.concat(F.lit(spec["site"]), H.attr(H.start_tag("a", "a"), "href"), F.lit(spec["category_query"])).alias("url"),
        )
    if dialect == "C":
        names = F.regexp_extract_all(area, F.lit(H.element_pattern("div", "class", re.escape(spec["menu_name_class"]), "within")), 1)
        hrefs = F.regexp_extract_all(
            area, F.lit(f"({H.start_tag_pattern('a', 'class', re.escape(spec['menu_link_class']), 'within')})"), 1
        )
        pairs = F.arrays_zip(names.alias("n"), hrefs.alias("h"))
        rows = pages.select("page_id", *extra, F.posexplode(pairs).alias("pos0", "p"))
        return rows.filter(F.col("p.n").isNotNull() & F.col("p.h").isNotNull()).select(
            "page_id",
            *extra,
            (F.col("pos0") + 1).alias("pos"),
            F.coalesce(H.text_of(F.col("p.n")), F.lit("")).alias("name"),
            H.attr(F.col("p.h"), "href").alias("url"),
        )
    raise ValueError(dialect)


# --------------------------------------------------------------------------- cards


def _card_batches(keep: list[str], limit: int | None, dialect: str | None, with_html: bool, whole_pages: bool = True):
    """Task function: pages (or, without ``whole_pages``, single cards) -> one row a card with its texts."""
    by_seller = {spec["seller"]: letter for letter, spec in DIALECTS.items()}

    def rows_of(page: str, letter: str, decode: E.Decoder) -> Iterator[tuple]:
        index, spec = E.ElementIndex(page, decode), DIALECTS[letter]
        cards = E.find_cards(index, spec, limit) if whole_pages else list(range(min(1, len(index.tags))))
        for position, card in enumerate(cards, start=1):
            texts = (index.outer(card),) if with_html else E.card_texts(index, card, spec)
            yield (letter, position, *texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dialect", "position", *(["card"] if with_html else E.FIELDS)]
        types = [pa.string(), pa.int32(), *[pa.string()] * (len(names) - 2)]
        if not whole_pages:
            names[1:2], types[1:2] = [], []
        page_no = TaskContext.get().partitionId() << PAGE_BITS
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            pages = columns["html" if whole_pages else "card"]
            letters = [dialect] * len(pages) if dialect else [by_seller.get(s) for s in columns["seller"].to_pylist()]
            # the page column itself is no column of a card: its html is never repeated
            own_columns = [columns[k] for k in keep]
            row_bytes = ROW_BYTES + sum(c.nbytes for c in own_columns) // max(1, len(pages))
            decode, first = E.Decoder(), 0
            take, found, held = [], [], 0

            def table() -> pa.RecordBatch:
                at = pa.array(take, pa.int64())
                own = [c.take(at) for c in own_columns]
                cells = zip(*found, strict=True)
                own += [pa.array(c, t) for c, t in zip(cells, types, strict=True)]
                if not whole_pages:
                    return pa.RecordBatch.from_arrays(own, names=[*keep, *names])
                number = pa.array([page_no + i for i in take], pa.int64())
                return pa.RecordBatch.from_arrays([*own, number], names=[*keep, *names, "page"])

            for row in range(len(pages)):
                page, letter = pages[row].as_py(), letters[row]
                if not letter or (whole_pages and not page):
                    continue
                for card in rows_of(page or "", letter, decode):
                    take.append(row)
                    found.append(card if whole_pages else (card[0], *card[2:]))
                    held += row_bytes + sum(len(x) for x in card[2:] if x)
                    if whole_pages and held > CARD_BYTES:  # a page of any length is handed on in parts
                        yield table()
                        take, found, held = [], [], 0
                if not whole_pages and len(take) == first:
                    take.append(row)  # a card without an element fails, but counts
                    found.append((letter, *[None] * (len(names) - 1)))
                first = len(take)
                if held > CARD_BYTES:
                    yield table()
                    take, found, held, first = [], [], 0, 0
            if found:
                yield table()
            page_no += batch.num_rows

    return run


def _shipped(run):
    """The task function and its modules travel by value: workers need not import vitrine."""
    from pyspark import cloudpickle

    for module in (sys.modules[__name__], E):
        cloudpickle.register_pickle_by_value(module)
    return run


def card_rows(pages: DataFrame, dialect: str | None = None, limit: int | None = None, with_html: bool = False) -> DataFrame:
    """Listing pages -> one row per card, in one pass over each page.

    The page columns (``url`` becomes ``page_url``, ``html`` goes), ``dialect``, ``position`` (1-based; counts every
    card, also those whose fields fail later), the texts ``elements.FIELDS`` (or the outer HTML as ``card``)
    and ``page``, a number of the page row. Without ``dialect`` the seller of each page decides; pages
    of other sellers have no cards. Only the first ``limit`` cards of a page are kept (falsy = all).
    """
    if dialect is not None and dialect not in DIALECTS:
        raise ValueError(dialect)
    pages = pages.withColumnRenamed("url", "page_url")
    keep = [c for c in pages.columns if c != "html"]
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = [f"`{k}` {kinds[k]}" for k in keep]
    schema += ["dialect string", "position int", *[f"{k} string" for k in (["card"] if with_html else E.FIELDS)], "page bigint"]
    return pages.mapInArrow(_shipped(_card_batches(keep, limit, dialect, with_html)), ", ".join(schema))


def split_cards(pages: DataFrame, dialect: str, limit: int | None = None) -> DataFrame:
    """Listing pages -> page columns, ``position`` and the outer HTML of each ``card``."""
    return card_rows(pages, dialect, limit, with_html=True).drop("dialect", "page")


# --------------------------------------------------------------------------- card fields

BRONZE_FIELDS = [
    "name", "url", "category", "price_in_cash", "price_in_installments", "installments_num",
    "installment_value", "img", "seller", "rating", "rating_users", "position",
]


def _dialect_values(dialect: str) -> dict[str, Column]:
    """Numbers and absolute links from the texts of a card, as its dialect writes them."""
    c, site = F.col, F.lit(DIALECTS[dialect]["site"])
    href, plan = c("t_href"), c("t_plan")
    if dialect == "C":
        value = M.whole_plus_cents(c("t_plan_price"), c("t_plan_cents"))
        count = F.coalesce(M.installment_count(plan), F.lit(0))
        return {"url": href, "cash": M.whole_plus_cents(c("t_price"), c("t_cents")), "value": value, "count": count,
                "total": M.installment_total(value, count), "no_rating": F.lit(M.MISSING_VALUE)}
    cash = M.brl(c("t_price"))
    if dialect == "B":
        total, count, value = M.total_count_value(plan)
        return {"url": F.concat(site, href), "cash": cash, "value": value, "count": count, "total": total,
                "no_rating": F.lit(None).cast("double")}
    value, count = M.value_after_currency(plan), M.installment_count(plan)
    return {"url": F.when(href.startswith("/"), F.concat(site, href)).otherwise(href), "cash": cash, "value": value, "count": count,
            "total": M.installment_total(value, count), "no_rating": F.lit(M.MISSING_VALUE)}


def typed_fields(cards: DataFrame, dialect: str | None = None, missing: str = "reference", keep_failed: bool = False) -> DataFrame:
    """Texts of cards (``card_rows``) -> the bronze product fields.

    ``missing="reference"`` keeps the per-dialect sentinels of the bronze
    table (installment value -999.0 and count 0 without installments;
    rating -999.0, or NULL for dialect B, and 0 raters without a rating);
    ``missing="null"`` makes every missing value NULL. Cards without name,
    url or cash price are dropped unless ``keep_failed``; ``parse_errors``
    names the failed fields.
    """
    letters = [dialect] if dialect else list(DIALECTS)
    each = {letter: _dialect_values(letter) for letter in letters}

    def pick(key: str) -> Column:
        out = each[letters[0]][key]
        if len(letters) > 1:
            out = F.when(F.col("dialect") == letters[0], out)
            for letter in letters[1:]:
                out = out.when(F.col("dialect") == letter, each[letter][key])
        return out

    null_mode = missing == "null"
    none = F.lit(None).cast("double")
    count_missing = F.lit(None).cast("int") if null_mode else F.lit(M.MISSING_COUNT)
    has_plan, rated, rating = F.col("t_plan").isNotNull(), F.col("t_rating").isNotNull(), F.col("t_rating")
    fields = {
        "name": F.col("t_name"),
        "url": pick("url"),
        "price_in_cash": M.as_double(pick("cash")),
        "price_in_installments": F.when(has_plan, M.as_double(pick("total"))),
        "installments_num": F.when(has_plan, pick("count")).otherwise(count_missing),
        "installment_value": F.when(has_plan, M.as_double(pick("value"))).otherwise(none if null_mode else F.lit(M.MISSING_VALUE)),
        "img": F.col("t_image"),
        "rating": F.when(rated, M.rating_value(rating)).otherwise(none if null_mode else pick("no_rating")),
        "rating_users": F.when(rated, M.rating_users(rating)).otherwise(count_missing),
    }
    keep = [k for k in cards.columns if k not in fields and k not in E.FIELDS and k != "dialect"]
    out = cards.select(*keep, *[v.alias(k) for k, v in fields.items()])
    errors = F.filter(
        F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in ("name", "url", "price_in_cash")]), lambda x: x.isNotNull())
    out = out.withColumn("parse_errors", errors)
    return out if keep_failed else out.filter(F.size("parse_errors") == 0)


def card_fields(cards: DataFrame, dialect: str, missing: str = "reference", keep_failed: bool = False) -> DataFrame:
    """Cards given as HTML (``card``) -> the bronze product fields."""
    keep = [c for c in cards.columns if c != "card"]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in cards.schema if f.name != "card"]
    schema += ["dialect string", *[f"{k} string" for k in E.FIELDS]]
    texts = cards.mapInArrow(_shipped(_card_batches(keep, None, dialect, False, whole_pages=False)), ", ".join(schema))
    return typed_fields(texts, dialect, missing, keep_failed)


def extract_products(pages: DataFrame, dialect: str | None = None, limit: int | None = None, missing: str = "reference") -> DataFrame:
    """Listing pages of one dialect, or of all sellers, -> product rows."""
    return typed_fields(card_rows(pages, dialect, limit), dialect, missing).drop("page")


def assign_product_ids(staged: DataFrame, start, gone: DataFrame | None = None) -> DataFrame:
    """ids continue after ``start`` (the stored maximum, 0 if none), in
    (seller, category, url of page, page, position) order (X28).

    Two levels: only the pages are ordered and summed up; a row's id is its page's offset plus its place in
    the page. ``staged`` is a written table whose rows have a running ``place``, the rows of a ``page`` one after
    the other; the rows of ``gone`` (page, place) are left out.
    """
    pages = staged.groupBy("page", "seller", "category", "page_url").agg(
        F.min("place").alias("__first"), F.count(F.lit(1)).alias("__n"))
    if gone is None:
        pages = pages.withColumn("__gone", F.array().cast("array<bigint>"))
    else:  # at most the cards of a page in each list
        left_out = gone.groupBy("page").agg(F.collect_list("place").alias("__gone"))
        pages = pages.join(left_out, "page", "left").withColumn("__gone", F.coalesce("__gone", F.array().cast("array<bigint>")))
    pages = pages.withColumn("__n", F.col("__n") - F.size("__gone"))
    offsets = running_offsets(pages, ["seller", "category", "page_url", "page"], "__n", "__before")
    rows = staged.join(offsets.select("page", "__first", "__before", "__gone"), "page")
    rows = rows.filter(~F.array_contains("__gone", F.col("place")))
    earlier = F.size(F.filter("__gone", lambda x: x < F.col("place")))
    value = (start if isinstance(start, Column) else F.lit(start)) + F.col("__before") + F.col("place") - F.col("__first") - earlier + 1
    return rows.withColumn("id", value.cast("bigint").cast("string")).drop("page", "place", "__first", "__before", "__gone")
