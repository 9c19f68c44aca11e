"""Dense sequence numbers in a global order without a one-partition window.

``number_rows(df, order, start)`` equals ``start + row_number() over (order
by order)``. The plain window moves every row into one task; here

1. the rows are range-partitioned by the order (as many ranges as
   ``spark.sql.shuffle.partitions`` says) and sorted within each range;
2. they are written once to the shared folder, each with the number of its
   range and its place in it, so a lost executor's rows are read again and no
   later pass can see another order;
3. rows per range (one row a range) -> running offsets, joined back.

Rows with equal order keys are told apart by a running row id, so copies of
a few keys spread over many ranges like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import scratch_location

PLACE = "__nr_place"
RANGE_BITS = 33  # a running row id holds the partition above this many bits


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def _start(start) -> Column:
    return start if isinstance(start, Column) else F.lit(start)


def plain_number_rows(df: DataFrame, order: Sequence[str | Column], start=0, name: str = "row_id") -> DataFrame:
    """The single-partition reference form; for tests and tiny frames only."""
    w = Window.orderBy(*_cols(order))
    return df.withColumn(name, (_start(start) + F.row_number().over(w)).cast("bigint"))


def ranged_rows(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The rows in ranges of ``order``, sorted, with ``PLACE`` (range and place within it)."""
    keys = [f"__nr_k{i}" for i in range(len(order))]
    keyed = df.withColumns({**dict(zip(keys, _cols(order), strict=True)), "__nr_tie": F.monotonically_increasing_id()})
    # a few columns that are not of the frame; the order may hold expressions
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(count, *keys, "__nr_tie").sortWithinPartitions(*keys, "__nr_tie")
    return ranged.drop(*keys, "__nr_tie").withColumn(PLACE, F.monotonically_increasing_id())


def number_rows(df: DataFrame, order: Sequence[str | Column], start=0, name: str = "row_id") -> DataFrame:
    """Append ``name`` = start + position of the row in ``order`` (ascending columns).

    ``start`` may be an int or a scalar Column (e.g. a stored maximum). The
    ordered rows are written to the shared folder when this is called.
    """
    spark = df.sparkSession
    ranged = ranged_rows(df, order)
    path = scratch_location(spark, "numbered")
    ranged.write.parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    number = F.shiftrightunsigned(PLACE, RANGE_BITS)
    sizes = stored.groupBy(number.alias("__nr_range")).agg(F.count(F.lit(1)).alias("__nr_size"))
    before = Window.orderBy("__nr_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__nr_range", F.coalesce(F.sum("__nr_size").over(before), F.lit(0)).alias("__nr_offset"))
    # one row a range: as many as there are shuffle partitions
    out = stored.withColumn("__nr_range", number).join(F.broadcast(offsets), "__nr_range")
    place = F.col(PLACE).bitwiseAND(F.lit((1 << RANGE_BITS) - 1)) + 1
    value = (_start(start) + F.col("__nr_offset") + place).cast("bigint")
    return out.withColumn(name, value).drop(PLACE, "__nr_range", "__nr_offset")


def running_offsets(df: DataFrame, order: Sequence[str | Column], weight: str, name: str) -> DataFrame:
    """Append ``name`` = sum of ``weight`` over all rows before this one in ``order``.

    Meant for the upper level of a two-level numbering: the groups (pages, say) are ordered and
    summed up here, their members keep their place and get the group's offset.
    The sums run within a range, and over one row a range.
    """
    spark = df.sparkSession
    ranged = ranged_rows(df, order)
    path = scratch_location(spark, "offsets")
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path).withColumn("__nr_range", F.shiftrightunsigned(PLACE, RANGE_BITS))
    sizes = rows.groupBy("__nr_range").agg(F.sum(weight).alias("__nr_size"))
    over = Window.orderBy("__nr_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__nr_range", F.coalesce(F.sum("__nr_size").over(over), F.lit(0)).alias("__nr_offset"))
    within = Window.partitionBy("__nr_range").orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    # one row a range: as many as there are shuffle partitions
    out = rows.withColumn(name, F.coalesce(F.sum(weight).over(within), F.lit(0))).join(F.broadcast(offsets), "__nr_range")
    return out.withColumn(name, F.col(name) + F.col("__nr_offset")).drop(PLACE, "__nr_range", "__nr_offset")


__all__ = ["number_rows", "plain_number_rows", "ranged_rows", "running_offsets"]
