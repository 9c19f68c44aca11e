"""Newest row per key.

``row_number() over (partition by key order by ...) = 1`` is planned by
Catalyst with a partial WindowGroupLimit before the shuffle, so each map
task forwards at most one row per key: a key holding a third of all rows
costs no more in the shuffle than any other. ``method="max_by"`` is the
aggregate form of the same thing (partial + final hash aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def product_version_order() -> list[Column]:
    """Total order for product observations: newest load first.

    Within one load the same URL can sit in several categories; the best
    position wins, then the higher id, then the category name.
    """
    return [
        F.col("dh_exec").desc(),
        F.col("position").asc_nulls_last(),
        F.expr("try_cast(id AS BIGINT)").desc(),
        F.col("category").asc(),
    ]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    method: str = "window",
    max_key: Column | None = None,
) -> DataFrame:
    """Keep the first row of each key under ``order`` (ties must be broken by ``order``).

    ``method="window"`` uses ``row_number``; ``method="max_by"`` needs
    ``max_key``, a column whose maximum marks the same row (for example
    ``struct(ts, event_id)`` for ``ts desc, event_id desc``).
    """
    key_cols = _cols(keys)
    if method == "window":
        w = Window.partitionBy(*key_cols).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    if method == "max_by":
        if max_key is None:
            raise ValueError("method='max_by' needs max_key")
        names = df.columns
        picked = df.groupBy(*key_cols).agg(F.max_by(F.struct(*names), max_key).alias("__row"))
        return picked.select(*[F.col("__row")[n].alias(n) for n in names])
    raise ValueError(f"unknown method {method!r}")
