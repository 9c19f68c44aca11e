"""Property and quirk-regression tests."""

import datetime as dt

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrine.operators.latest import latest_per_key
from vitrine.operators.numbering import number_rows, plain_number_rows
from vitrine.operators.pages import card_fields
from vitrine.operators.relational import merge_categories

D1 = dt.datetime(2025, 4, 6, 10)

keys = st.lists(st.tuples(st.sampled_from(["a", "b", None, "c"]), st.integers(-50, 50)), min_size=1, max_size=120)


@settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(keys, st.integers(0, 1000))
def test_number_rows_matches_plain_window(spark, rows, start):
    df = spark.createDataFrame(rows, "k string, v int").dropDuplicates()
    got = number_rows(df, ["k", "v"], start)
    want = plain_number_rows(df, ["k", "v"], start)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=80))
def test_one_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, id int")
    out = latest_per_key(df, ["k"], [F.col("t").desc(), F.col("id").desc()])
    got = {r.k: (r.t, r.id) for r in out.collect()}
    assert len(got) == out.count()
    for k in got:
        assert got[k] == max((t, i) for kk, t, i in rows if kk == k)


def test_incremental_merge_is_idempotent(spark):
    old = spark.createDataFrame(
        [(1, "A", "s", "a", D1), (2, "B", "s", "b", D1)],
        "ID_CATEGORY int, DS_CATEGORY string, NM_SELLER string, DS_URL string, DH_ORIGIN_EXEC timestamp")
    new = spark.createDataFrame([("B", "s", "b2", D1), ("C", "s", "c", D1)],
                                "DS_CATEGORY string, NM_SELLER string, DS_URL string, DH_ORIGIN_EXEC timestamp")
    for dense in (False, True):
        once = merge_categories(old, new, dense=dense)
        twice = merge_categories(once, new, dense=dense)
        assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


CARD = ('<a data-testid="product-card::card" href="/p/{k}"><h2 data-testid="product-card::name">N{k}</h2>'
        '<p data-testid="product-card::price">R$ {price}</p></a>')


def test_failed_field_is_null_and_named(spark):
    cards = spark.createDataFrame(
        [(1, 1, CARD.format(k=1, price="10,00")), (1, 2, CARD.format(k=2, price="--"))],
        "page_id long, position int, card string")
    kept = card_fields(cards, "A")
    assert [r.position for r in kept.collect()] == [1]
    both = {r.position: r for r in card_fields(cards, "A", keep_failed=True).collect()}
    assert both[2].price_in_cash is None and both[2].parse_errors == ["price_in_cash"]
    assert both[1].name == "N1" and both[1].price_in_cash == 10.0 and both[1].parse_errors == []
    # no installment and no rating: per-dialect sentinels, or NULL on request
    assert (both[1].installment_value, both[1].installments_num, both[1].price_in_installments) == (-999.0, 0, None)
    assert (both[1].rating, both[1].rating_users) == (-999.0, 0)
    nulls = card_fields(cards, "A", missing="null").first()
    assert (nulls.installment_value, nulls.installments_num, nulls.rating, nulls.rating_users) == (None, None, None, None)
