"""Work on groups of rows as a stream of bounded blocks.

A group of any size is cut into blocks by a hash; every pair of blocks
becomes a small group of its own, so no task ever holds a whole group. The
small groups of a partition arrive sorted and are handed on one by one or,
where they are tiny, many together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, group: list[str], member: str, sizes: DataFrame, most: int) -> DataFrame:
    """``rows`` once for each pair of blocks of its group that it belongs to.

    ``sizes`` has a row (``group``, ``size``) per group. New columns: ``bi``
    <= ``bj`` (the pair) and ``side`` (-1: both blocks are the same; 0 or 1:
    the row is of block bi or bj).
    """
    joined = rows.join(sizes, group)
    blocks = F.ceil(F.col("size") / most).cast("int")
    own = F.pmod(F.xxhash64(F.lit(17), member), blocks).cast("int")
    placed = joined.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))}).drop("size")
    return placed.withColumns({
        "bi": F.least("own", "other"), "bj": F.greatest("own", "other"),
        "side": F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1),
    }).drop("own", "other")


def dealt_blocks(rows: DataFrame, group: list[str], member: str) -> DataFrame:
    """``rows`` of block pairs, dealt and sorted so that each pair is a run of rows."""
    keys = [*group, "bi", "bj"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, member)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches -> tables that end at the end of a group, with the start of each group."""
    left: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        n = table.num_rows
        new = np.zeros(n, dtype=bool)
        new[:1] = True
        for k in keys:
            values = np.asarray(table.column(k).combine_chunks())
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*left, batch])
        starts = cut(table)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last), starts[:-1]
        left = table.slice(last).to_batches()
    if left:
        table = pa.Table.from_batches(left)
        yield table, cut(table)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` items the smallest item that the links (a, b) reach."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        np.minimum.at(root, before[a], least)
        np.minimum.at(root, before[b], least)
        root = root[root]
        if np.array_equal(root, before):
            return root
