"""Merkle manifest of a dataset (operator 12): one tree a source, one tree over the sources.

Each row is a leaf: the hash of its cells. The leaves of a tree stand in
order and every ``FAN`` consecutive nodes become one node of the next level.
Leaves are placed by a range sort and running offsets, so a tree of any size
has the place of each leaf without one task seeing them all. ``FAN ** LEVELS``
consecutive nodes are a superblock:

1. up: each superblock is reduced on its own to one node; these nodes are the
   next round's leaves, until every tree has one node. The trees' roots are the
   leaves of the tree over the sources, which climbs in the same way;
2. down: the nodes of a superblock are cogrouped with what lies outside of it,
   one row with the siblings on the way from the superblock to the root.
   ``applyInPandas`` reduces the superblock again, joins the inner siblings with
   the outer ones and folds the proof.

So a proof needs the leaves of one superblock and one row, and no task holds
more than that.

Cases: a null cell is ``-``, an empty text ``0:``; null ids come first, null sources are
the first tree; rows with one id are ordered by their leaf, and repeated rows are
leaves of their own; an empty table gives an empty result; further columns
are not read; a text of any length is one hash in the JVM.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import stored
from vitrine.operators.numbering import PLACE, RANGE_BITS, ranged_rows

FAN = 3
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree string, pos bigint, node string, total bigint"
OUTER = "tree string, pos bigint, path array<string>, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(cells: Sequence[Column]) -> Column:
    """Hash of a row: each cell as its UTF-8 byte count, a colon and its value, or ``-`` if null."""
    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in cells]).cast("binary"), 256)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``pos``, the place in ``order`` within the tree, and ``total``, the size of the tree.

    Rows meet the offsets of their range and tree, so no join key holds more rows than a range."""
    placed = stored(ranged_rows(rows, ["tree", *order]), "merkle-order").withColumn("range", F.shiftrightunsigned(PLACE, RANGE_BITS))
    runs = placed.groupBy("range", "tree").agg(F.min(PLACE).alias("first"), F.count(F.lit(1)).alias("size"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "range", "tree", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(tree).alias("total"))
    return placed.join(offsets, ["range", "tree"]).withColumn("pos", F.col(PLACE) + F.col("shift")).drop(PLACE, "range", "shift")


def levels_of(nodes: list[str], total: int, levels: int) -> tuple[list[list[str]], str, int]:
    """The levels of a superblock below its top node, the top node, and the size of the tree's
    level there. A tree that has only one node left ends early."""
    out: list[list[str]] = []
    for _ in range(levels):
        if total == 1:
            break
        out.append(nodes)
        nodes = [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
        total = -(-total // FAN)
    return out, nodes[0], total


def siblings(levels: list[list[str]], i: int) -> Iterator[str]:
    """For each level the run of node ``i`` without it: ``<before>:<after>``."""
    for nodes in levels:
        first = i - i % FAN
        yield f"{''.join(nodes[first:i])}:{''.join(nodes[i + 1 : first + FAN])}"
        i //= FAN


def fold(node: str, path: list[str]) -> str:
    """The root that ``node`` and the siblings on its way lead to."""
    for step in path:
        before, _, after = step.partition(":")
        node = digest(before + node + after)
    return node


def climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` (tree, pos, node, total) and the nodes of each round of superblocks above, up to one a tree."""
    size = FAN**levels

    def reduce(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        _, top, total = levels_of(rows["node"].tolist(), int(rows["total"].iloc[0]), levels)
        return pd.DataFrame([(key[0], key[1], top, total)], columns=["tree", "pos", "node", "total"])

    out = [nodes]
    while True:
        block = F.expr(f"pos div {size}").alias("block")
        above = out[-1].select("tree", "pos", "node", "total").groupBy("tree", block).applyInPandas(reduce, NODES)
        out.append(stored(above, "merkle-nodes"))
        most = out[-1].agg(F.max("total")).first()[0]
        if most is None or most == 1:
            return out


def finish(nodes: DataFrame, outer: DataFrame, levels: int, columns: str, row_of) -> DataFrame:
    """``nodes`` cogrouped by superblock with the one ``OUTER`` row that leads on from it;
    ``row_of(row, path, outer)`` gives the values of ``columns`` for each node, its whole path and that row."""
    size = FAN**levels
    names = [c.split()[0] for c in columns.split(", ")]

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=names)
        left = left.sort_values("pos")
        beyond = next(right.itertuples(index=False))
        inner, _, _ = levels_of(left["node"].tolist(), int(left["total"].iloc[0]), levels)
        path = list(beyond.path)
        found = [row_of(row, [*siblings(inner, i), *path], beyond) for i, row in enumerate(left.itertuples(index=False))]
        return pd.DataFrame(found, columns=names)

    blocks = nodes.withColumn("block", F.expr(f"pos div {size}")).groupBy("tree", "block")
    return blocks.cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(join, columns)


def outer_rows(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """For each superblock of the lowest round its ``OUTER`` row: the siblings above it, and the roots.
    ``tops`` (tree, path, subroot, root) leads on from the root of each tree."""
    found = tops.select("tree", F.lit(0).cast("bigint").alias("pos"), "path", "subroot", "root")
    for nodes in reversed(rounds[1:-1]):
        found = stored(finish(nodes, found, levels, OUTER, lambda row, path, o: (row.tree, row.pos, path, o.subroot, o.root)), "merkle-paths")
    return found


def manifest(
    df: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "source",
    claimed: dict[str, Column] | None = None, levels: int = LEVELS,
) -> DataFrame:
    """Manifest of all rows of ``df`` and what their claimed contents prove.

    One row each: ``id_col``, ``leaf``, ``subroot`` (of its source), ``root``, ``proof`` (siblings from the
    leaf to the root, ``<before>:<after>`` a level), ``proof_sha256``, ``folded_root`` (from the
    leaf of the row with ``claimed`` cells, by default its own, and the proof) and ``verified``.
    """
    leaf = leaf_hash([F.col(c) for c in columns])
    # a null claim stands for the leaf itself
    claim = F.nullif(leaf_hash([claimed.get(c, F.col(c)) for c in columns]), leaf) if claimed else F.lit(None).cast("string")
    kind = df.schema[id_col].dataType.simpleString()
    # '' sorts before every '=...': null sources first, the others bytewise
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = stored(df.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf.alias("node"), claim.alias("claim")), "merkle-leaves")
    # ids travel as text: a frame in a task would turn integers with nulls into floats
    leaves = ranked(leaves, ["id", "node"]).withColumn("id", F.col("id").cast("string"))

    rounds = climb(leaves, levels)
    sources = ranked(rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("child"), "node"), ["child"])
    above = climb(sources, levels)
    root = above[-1].select("tree", F.array().cast("array<string>").alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    way = "tree string, path array<string>, subroot string, root string"
    tops = stored(finish(
        sources, outer_rows(above, root, levels), levels, way, lambda row, path, o: (row.child, path, row.node, o.root)), "merkle-tops")

    def proven(row, path: list[str], o) -> tuple:
        end = fold(row.claim or row.node, path)
        return row.id, row.node, o.subroot, o.root, path, digest("".join(path).replace(":", "")), end, end == o.root

    out = (
        "id string, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, "
        "folded_root string, verified boolean")
    rows = finish(leaves, outer_rows(rounds, tops, levels), levels, out, proven)
    return rows.select(F.col("id").cast(kind).alias(id_col), *[c.split()[0] for c in out.split(", ")[1:]])


def without_line_ends(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """The claim of the check: every second id (by the CRC-32 of its digits) has lost the line ends of its text."""
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return {text_col: F.when(hit, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))}


__all__ = ["manifest", "without_line_ends", "leaf_hash", "fold", "FAN", "LEVELS"]
