"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import delete_path, scratch_dir


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges`` (u, v): the
    smallest node that links reach.

    A large star hangs all larger neighbours of a node on its smallest
    neighbour, a small star the smaller ones and the node itself; in turns
    they end in one star per component after few rounds. Minima are combined
    before the shuffle, so a node with very many links is no hot spot; each
    round is a written table that any executor can read again.
    """
    spark = edges.sparkSession
    folder = scratch_dir(spark, label)
    schema = "u bigint, v bigint"

    def keep(rows: DataFrame, number: int) -> tuple[DataFrame, tuple]:
        path = f"{folder}/{number}"
        rows.write.parquet(path)
        out = spark.read.schema(schema).parquet(path)
        mark = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
        return out, tuple(mark)

    current, mark = keep(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), 0)
    number = 0
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").filter("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        least = _smallest(large)
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, seen = keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), number + 1)
        delete_path(spark, f"{folder}/{number}")
        number, current = number + 1, after
        if seen == mark:
            break
        mark = seen
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
