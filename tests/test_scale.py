"""Scale properties: a hot key does not land in one task."""

from pyspark.sql import functions as F

from vitrine.operators.latest import latest_per_key
from vitrine.operators.numbering import PLACE, RANGE_BITS, ranged_rows


def test_numbering_ranges_split_a_hot_leading_key(spark):
    # one leading value holds a third of all rows; ties broken by a unique id
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id"),
    )
    place = F.shiftrightunsigned(PLACE, RANGE_BITS)
    sizes = [r[1] for r in ranged_rows(df, ["k", "id"]).groupBy(place).count().collect()]
    assert len(sizes) == 8  # as many as there are shuffle partitions
    # no range holds more than a few times its fair share; the hot value alone is 20,000 rows
    assert max(sizes) < 2 * 60000 / len(sizes)


def test_numbering_ranges_split_copies_of_few_keys(spark):
    df = spark.range(60000).select((F.col("id") % 2).alias("k"), F.col("id"))
    sizes = [r[1] for r in ranged_rows(df, ["k"]).groupBy(F.shiftrightunsigned(PLACE, RANGE_BITS)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 60000 / len(sizes)


def test_newest_row_has_partial_limit_before_shuffle(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    out = latest_per_key(df, ["k"], [F.col("t").desc()])
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ids_need_no_sort_of_products(spark):
    """Only pages are range-partitioned; the page table is read once; repeated rows are left out before counting."""
    import contextlib
    import io

    from vitrine.plans import bronze

    card = '<a data-testid="product-card::card" href="/p/{k}"><h2 data-testid="product-card::name">N{k}</h2><p data-testid="product-card::price">R$ {v}</p></a>'
    page = "".join(card.format(k=k, v="--" if k == 3 else f"{k},00") for k in range(6))
    rows = [(i, f"u{i % 3}", page, ["Zoom", "Outra"][i == 4], "c") for i in range(7)]  # u0 and u1, u2 are loaded repeatedly
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, seller string, category string").repartition(3)
    parsed = bronze.extract_listing_products(pages)
    with contextlib.redirect_stdout(io.StringIO()) as text:
        parsed.explain("formatted")
    assert text.getvalue().count("MapInArrow [") + text.getvalue().count("MapInArrow (") <= 2  # node and its details
    built = bronze.build_products(parsed, 100, "2025-04-07 06:00:00")
    with contextlib.redirect_stdout(io.StringIO()) as text:
        built.explain("formatted")
    assert "rangepartitioning" not in text.getvalue()
    got = sorted((int(r["id"]), r["position"], r["name"]) for r in built.collect())
    assert [g[0] for g in got] == list(range(101, 116))  # five readable cards of three pages
    assert [g[1] for g in got] == [1, 2, 3, 5, 6] * 3
    every = bronze.build_products(parsed, 0, "2025-04-07 06:00:00", dedup=False)
    assert sorted(int(r["id"]) for r in every.collect()) == list(range(1, 31))


def _card_task(monkeypatch, page, keep):
    import pyarrow as pa

    from vitrine.operators import pages as P

    class OneTask:
        get = staticmethod(lambda: OneTask)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(P, "TaskContext", OneTask)
    names = ["page_id", "page_url", "html", "seller"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array(["u"]), pa.array([page]), pa.array(["Zoom"])], names=names)
    return P._card_batches(keep, None, None, False)(iter([batch]))


CARD = '<a data-testid="product-card::card" href="/p/{k}"><h2 data-testid="product-card::name">N{k}</h2></a>'


def test_cards_do_not_repeat_their_page(spark, monkeypatch):
    """Memory of a task follows the texts of its cards, not cards times the length of their page."""
    import pyarrow as pa

    page = "<!--" + "x" * (1 << 20) + "-->" + "".join(CARD.format(k=k) for k in range(1000))
    before = pa.default_memory_pool().max_memory()
    assert sum(b.num_rows for b in _card_task(monkeypatch, page, ["page_id", "page_url", "seller"])) == 1000
    assert pa.default_memory_pool().max_memory() - before < 100 << 20  # the page 1000 times is 1 GB


def test_cards_of_a_long_page_come_in_parts(spark, monkeypatch):
    from vitrine.operators import pages as P

    page = "".join(CARD.format(k=k) for k in range(100))
    whole = [r for b in _card_task(monkeypatch, page, ["page_id", "seller"]) for r in b.to_pylist()]
    monkeypatch.setattr(P, "CARD_BYTES", 10_000)
    parts = list(_card_task(monkeypatch, page, ["page_id", "seller"]))
    assert len(parts) > 3 and max(b.num_rows for b in parts) < 50
    assert [r for b in parts for r in b.to_pylist()] == whole
    assert [r["position"] for r in whole] == list(range(1, 101)) and {r["page"] for r in whole} == {0}
