"""Embedding near-dedup by Euclidean p-stable hashing (operator 1).

Vectors are normalised; a table hashes a unit vector by ``K`` quantised
Gaussian projections floor((a.v + b) / WIDTH), and vectors that fall into the same
bucket of any table are compared by their exact cosine. ``K`` follows the
logarithm of the largest label, so that an unrelated pair seldom shares a bucket at
any size, and the number of tables follows from the chance that a pair at
the threshold shares one bucket: it is missed by all tables with a chance of at
most ``MISS``; closer pairs much less often.

Equal vectors are one class with a count, so copies are never compared. Buckets are cut
into blocks of at most ``BLOCK`` rows, and every pair of blocks is its own small
group. A pair counts in the first table where it meets, so links need no
second pass; tasks give back numbers of links and one root per vector,
never pairs.

Cases: vectors with null, zero, null or non-finite components, and null
labels, link with nothing and form components of their own; vectors of
different length are not compared; a repeated row counts as one more vector;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.blocks import block_pairs, dealt_blocks, local_roots, whole_groups
from vitrine.llm.common import stored
from vitrine.llm.components import connected_components

THRESHOLD = 0.93
WIDTH = 2.0
MISS = 0.002
BLOCK = 512
SEED = 20_240


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection is the same for two points at ``distance``."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def parameters(largest: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Projections a table and number of tables for ``largest`` comparable vectors."""
    far, near = collision(math.sqrt(2)), collision(math.sqrt(2 - 2 * threshold))
    k = max(4, math.ceil(math.log(max(2, largest)) / -math.log(far)) + 2)
    return k, math.ceil(math.log(MISS) / math.log1p(-(near**k)))


class Hasher:
    """Bucket keys of unit vectors; the projections depend on the seed and the dimension only."""

    def __init__(self, k: int, tables: int):
        self.k, self.tables, self.by_dim = k, tables, {}

    def keys(self, units: np.ndarray) -> np.ndarray:
        dim = units.shape[1]
        if dim not in self.by_dim:
            rng = np.random.default_rng([SEED, dim])
            shape = self.tables * self.k
            self.by_dim[dim] = (
                rng.standard_normal((dim, shape)), rng.uniform(0, WIDTH, shape),
                rng.integers(1, 1 << 62, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        directions, offsets, odd = self.by_dim[dim]
        out = np.empty((len(units), self.tables), dtype=np.uint64)
        for a in range(0, len(units), 4096):
            cells = np.floor((units[a : a + 4096] @ directions + offsets) / WIDTH).astype(np.int64).view(np.uint64)
            mixed = (cells + np.uint64(0x9E3779B9)) * odd
            mixed ^= mixed >> np.uint64(29)
            mixed = mixed.reshape(len(cells), self.tables, self.k)
            out[a : a + 4096] = mixed.sum(axis=2, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return out


def unit_vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)
    # by a power of two, which is exact: squares of very large or small components stay in range
    _, exponents = np.frexp(np.abs(values).max(axis=1, initial=0, keepdims=True))
    values = np.ldexp(values, -exponents)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def usable(vector: str, label: str):
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(label).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every row."""
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.col(label_col).alias("label"))
    rows = rows.withColumn("valid", F.coalesce(usable("vector", "label"), F.lit(False)))
    rows = rows.withColumns({
        "h1": F.when(F.col("valid"), F.xxhash64("label", "vector")).otherwise(F.xxhash64(F.lit(1), "id")),
        "h2": F.when(F.col("valid"), F.xxhash64(F.lit(3), "vector", "label")).otherwise(F.xxhash64(F.lit(2), "id")),
    })
    classes = stored(rows.filter("valid").groupBy("h1", "h2").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n"),
        F.any_value("vector").alias("vector"), F.any_value("label").alias("label")), "vectors")
    # vectors with a null id are compared, too, under an id of their own
    classes = classes.select(
        F.coalesce("id", F.col("h1")).alias("id"), "h1", "h2", "n", "vector",
        F.xxhash64("label", F.size("vector")).alias("space"))
    largest = classes.groupBy("space").count().agg(F.max("count")).first()[0] or 0
    k, tables = parameters(largest, threshold)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(k, tables)
        for batch in batches:
            ids, spaces = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
            lengths = np.asarray(pa.compute.list_value_length(batch.column(2)))
            for dim in np.unique(lengths):
                rows = np.flatnonzero(lengths == dim)
                keys = hasher.keys(unit_vectors(batch.column(2).take(pa.array(rows))))
                keys = keys + spaces[rows][:, None] * np.uint64(0x9E3779B97F4A7C15)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[rows]), pa.array(np.full(len(rows), t, np.int32)), pa.array(keys[:, t].view(np.int64))],
                        names=["id", "t", "key"])

    buckets = classes.select("id", "space", "vector").mapInArrow(hashed, "id bigint, t int, key bigint")
    sizes = buckets.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(k, tables)
        for table, starts in whole_groups(batches, ["t", "key", "bi", "bj"]):
            n = table.num_rows
            number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            lengths = np.asarray(pa.compute.list_value_length(table.column("vector")))
            ids, counts = np.asarray(table.column("id")), np.asarray(table.column("n"))
            t, side, space = (np.asarray(table.column(c)) for c in ("t", "side", "space"))
            dim = int(lengths.max())
            if lengths.min() != dim:  # vectors of several lengths: fill up with zeros, which no cosine sees
                flat = table.column("vector").to_pylist()
                units = np.array([v + [0.0] * (dim - len(v)) for v in flat])
                units /= np.linalg.norm(units, axis=1, keepdims=True)
            else:
                units = unit_vectors(table.column("vector"))
            found_a, found_b = [], []
            for d in range(1, int(np.bincount(number).max())):
                a = np.flatnonzero(number[d:] == number[:-d])
                b = a + d
                open_ = (space[a] == space[b]) & ((side[a] < 0) | (side[a] != side[b])) & (lengths[a] == lengths[b])
                a, b = a[open_], b[open_]
                near = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
                found_a.append(a[near])
                found_b.append(b[near])
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))
            if not len(a):
                continue
            # a pair counts in its first table only
            used = np.unique(np.concatenate([a, b]))
            keys = np.zeros((n, tables), dtype=np.uint64)
            for size in np.unique(lengths[used]):
                rows = used[lengths[used] == size]
                keys[rows] = hasher.keys(np.ascontiguousarray(units[rows][:, :size]))
            first = np.empty(len(a), dtype=bool)
            for i in range(0, len(a), 1 << 16):
                part = slice(i, i + (1 << 16))
                first[part] = np.argmax(keys[a[part]] == keys[b[part]], axis=1) == t[a[part]]
            a, b = a[first], b[first]
            if not len(a):
                continue
            members, where = np.unique(ids, return_inverse=True)
            pa_, pb = where[a], where[b]
            links = np.bincount(pa_, counts[b], len(members)) + np.bincount(pb, counts[a], len(members))
            roots = local_roots(len(members), pa_, pb)
            some = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(members[some]), pa.array(members[roots[some]]), pa.array(links[some].astype(np.int64))],
                names=["u", "v", "links"])

    # the vectors follow only the rows that meet another one
    paired = block_pairs(buckets, ["t", "key"], "id", sizes, BLOCK)
    ready = dealt_blocks(paired.join(classes.select("id", "space", "n", "vector"), "id"), ["t", "key"], "id")
    met = stored(ready.mapInArrow(compared, "u bigint, v bigint, links bigint"), "vector-links")
    links = met.groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    reached = connected_components(met.select("u", "v"))
    done = classes.select("id", "h1", "h2", "n").join(links, "id", "left").join(
        reached.withColumnRenamed("node", "id"), "id", "left").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    out = rows.select("id", "h1", "h2").join(done, ["h1", "h2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))
