"""N-gram Jaccard join with several global token orders (operator 9).

The tokens of a document are the hashes of its distinct word shingles. Two
documents link when their Jaccard similarity is at least ``PERCENT`` / 100.
For any order of all tokens, linked documents share tokens in the prefixes of
their sorted token lists, so a candidate must pass the filter of every order;
only what is left in the intersection is verified on whole sets.

1. Documents with equal token sets are one class; its smallest id stands for it.
2. Order 1 (a hash permutation): with n tokens, at least ceil(0.85 n) of them
   common and m = floor(n / 20) + 1, the first n - ceil(0.85 n) + m
   tokens of two linked documents have m or more in common. A document whose prefix holds
   fewer tokens that any other class has in its prefix links with nothing;
   this ends most documents after their prefixes were counted.
3. Order 2 (rarest first, counted over the rest): a linked pair shares one of the first
   n - ceil(0.85 n) + 1 tokens. Documents that share such a token are tied to the
   smallest one; what hangs together is a cluster of candidates.
4. Within a cluster, pairs meet in blocks of at most ``BLOCK`` documents. Orders
   3 and 4 (further permutations) filter by prefixes as in step 2; pairs that
   pass both, and the comparison of sizes, are verified exactly. Tasks give back
   one root per document, never pairs.
5. The roots' links give the components.

Cases: a null text or one without words has no tokens and links with nothing;
fewer than ``WIDTH`` words are one shingle; copies and repeated rows belong to one class;
documents without an id keep a null component; an empty table gives an empty result; only the
id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.blocks import block_pairs, dealt_blocks, local_roots, whole_groups
from vitrine.llm.bpe import slices
from vitrine.llm.common import forget_caches, may_be_among, shuffles_freed, stored
from vitrine.llm.components import connected_components

WIDTH, PERCENT = 4, 85
BLOCK = 512
BATCH_ROWS = 2000  # rows that a task's Python gets at once
ORDERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def token_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted token hashes of each text. Distinct words are hashed once per batch."""
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(low)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = word_hashes(words)[np.asarray(coded.indices)] if words else np.zeros(0, np.uint64)
    blank = word_hashes([""])[0]
    ends = np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))
    start = 0
    for end in ends.tolist():
        own = hashes[start:end]
        start = end
        own = own[own != blank]  # of a text that begins or ends with white space
        size = min(width, len(own))
        if not size:
            yield own
            continue
        count = len(own) - size + 1
        mixed = np.full(count, np.uint64(size))
        for k in range(size):
            mixed = (mixed ^ own[k : k + count]) * ORDERS[0]
            mixed ^= mixed >> np.uint64(32)
        yield np.unique(mixed)


def least_common(n, percent: int = PERCENT):
    """Least number of tokens that a set of ``n`` has in common with a linked one."""
    return -(-percent * n // 100)


def prefix(tokens: np.ndarray, order: np.uint64, length: int) -> np.ndarray:
    """The first ``length`` tokens in the order of a permutation."""
    if length >= len(tokens):
        return tokens
    return tokens[np.argpartition(tokens * order, length - 1)[:length]]


def signatures(df: DataFrame, id_col: str, text_col: str, width: int, percent: int, carried: Sequence[str] = ()) -> DataFrame:
    """``(id, n, d1, d2, prefix)``: number and digest of the tokens, prefix under order 1; and the ``carried`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                sizes, first, second, heads = [], [], [], []
                for tokens in token_sets(part.column(1), width):
                    n = len(tokens)
                    digest = xxhash.xxh3_128_digest(tokens.tobytes())
                    sizes.append(n)
                    first.append(int.from_bytes(digest[:8], "little", signed=True))
                    second.append(int.from_bytes(digest[8:], "little", signed=True))
                    heads.append(prefix(tokens, ORDERS[0], n - least_common(n, percent) + n // 20 + 1).tobytes() if n else b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                     pa.array(heads, pa.binary()), *part.columns[2:]], names=["id", "n", "d1", "d2", "prefix", *more])

    more = [f"c_{c}" for c in carried]
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"c_{c}") for c in carried])
    kinds = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in more)
    return rows.mapInArrow(run, f"id bigint, n bigint, d1 bigint, d2 bigint, prefix binary{kinds}")


def exploded(rows: DataFrame, blob: str) -> DataFrame:
    """``(id, token)`` for each token in the binary column ``blob``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for a, b in slices(batch.column(1), 4 << 20):
                blobs = batch.column(1).slice(a, b - a)
                counts = np.asarray(pc.binary_length(blobs), dtype=np.int64) // 8
                tokens = np.frombuffer(b"".join(blobs.to_pylist()), dtype="<i8")
                if len(tokens):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids[a:b], counts)), pa.array(tokens)], names=["id", "token"])

    return rows.select("id", blob).mapInArrow(run, "id bigint, token bigint")


def shared_tokens(postings: DataFrame) -> DataFrame:
    """Postings of the tokens that more than one document has, with their number ``df``."""
    many = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    return postings.join(many, "token")


def survivors(reps: DataFrame, percent: int) -> DataFrame:
    """Ids of the classes whose order-1 prefix shares enough tokens with other prefixes."""
    found = shared_tokens(exploded(reps, "prefix")).groupBy("id").agg(F.count(F.lit(1)).alias("met"))
    partner = F.ceil(F.col("n") * percent / 100)  # a linked set has so many tokens at least
    need = F.floor(partner / 20) + 1
    return reps.select("id", "n").join(found, "id").filter(F.col("met") >= need).select("id")


def whole_sets(df: DataFrame, ids: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``(id, n, d1, d2, tokens)`` of the rows with the given ids, and of a few others: a row more costs
    some work, but no link, and so no text is shuffled."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = may_be_among(rows, F.col("id"), ids, "among").filter("among").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        for batch in batches:
            for a, b in slices(batch.column(1), 4 << 20):
                part = batch.slice(a, b - a)
                sets = list(token_sets(part.column(1), width))
                digests = [xxhash.xxh3_128_digest(t.tobytes()) for t in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in sets], pa.int64()),
                     pa.array([int.from_bytes(x[:8], "little", signed=True) for x in digests], pa.int64()),
                     pa.array([int.from_bytes(x[8:], "little", signed=True) for x in digests], pa.int64()),
                     pa.array([t.tobytes() for t in sets], pa.binary())], names=["id", "n", "d1", "d2", "tokens"])

    return rows.mapInArrow(run, "id bigint, n bigint, d1 bigint, d2 bigint, tokens binary")


def candidate_clusters(sets: DataFrame, percent: int) -> DataFrame:
    """``(node, component)``: documents that share tokens of their rarest-first prefixes, directly or not."""
    shared = shared_tokens(exploded(sets, "tokens"))
    rarest = shared.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("common"))
    # tokens that no other document has come first in the order; one document's tokens bound the list
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("common"))
    heads = sets.select("id", "n").join(rarest, "id").filter(length > 0).select(
        "id", F.explode(F.slice("common", F.lit(1), length.cast("int"))).alias("t")).select("id", F.col("t.token").alias("token"))
    heads = stored(heads, "ngram-prefixes", BATCH_ROWS)
    leaders = heads.groupBy("token").agg(F.min("id").alias("v"), F.max("id").alias("w")).filter("v < w").select("token", "v")
    ties = heads.join(leaders, "token").filter("id <> v").select(F.col("id").alias("u"), "v").distinct()
    return connected_components(ties, "ngram-clusters")


def links_in_block(n: np.ndarray, side: np.ndarray, blobs: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of one small group: prefix filters of two orders, then whole sets."""
    sets = [np.frombuffer(b, dtype="<u8") for b in blobs]
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(n)
    mark = np.zeros(int(flat.max()) + 1, dtype=bool)
    heads, head_ends = [], []
    for order in ORDERS[1:]:
        parts = []
        for i, tokens in enumerate(sets):
            length = int(n[i] - least_common(n[i], percent) + 1)
            own = flat[ends[i] - n[i] : ends[i]]
            parts.append(own if length >= n[i] else own[np.argpartition(tokens * order, length - 1)[:length]])
        heads.append(np.concatenate(parts))
        head_ends.append(np.cumsum([len(p) for p in parts]))
    found_a, found_b = [], []
    for i in range(len(sets)):
        later = np.flatnonzero((n >= n[i]) & (percent * n <= 100 * n[i]) & ((side < 0) | (side != side[i])))
        later = later[(n[later] > n[i]) | (later > i)]
        for head, stops in zip(heads, head_ends, strict=True):
            if len(later):
                starts = np.concatenate([[0], stops[:-1]])
                mark[head[starts[i] : stops[i]]] = True
                hits = np.concatenate([[0], np.cumsum(mark[head])])
                later = later[hits[stops[later]] > hits[starts[later]]]
                mark[head[starts[i] : stops[i]]] = False
        if len(later):
            mark[flat[ends[i] - n[i] : ends[i]]] = True
            hits = np.concatenate([[0], np.cumsum(mark[flat])])
            common = hits[ends[later]] - hits[ends[later] - n[later]]
            mark[flat[ends[i] - n[i] : ends[i]]] = False
            later = later[100 * common >= percent * (n[i] + n[later] - common)]
            found_a.append(np.full(len(later), i))
            found_b.append(later)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def verified(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """``(u, v)``: each document with a linked partner, and a root that its links reach."""
    # sets outside of all clusters stay where they are
    some = may_be_among(sets.select("id", "n", "tokens"), F.col("id"), clusters.select("node"), "among").filter("among").drop("among")
    placed = some.join(clusters.withColumnRenamed("node", "id"), "id")
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    dealt = dealt_blocks(block_pairs(placed, ["component"], "id", sizes, BLOCK), ["component"], "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        for table, starts in whole_groups(batches, ["component", "bi", "bj"]):
            n, side, ids = (np.asarray(table.column(c)) for c in ("n", "side", "id"))
            blobs = table.column("tokens").to_pylist()
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
                if b - a < 2:
                    continue
                x, y = links_in_block(n[a:b], side[a:b], blobs[a:b], percent)
                if len(x):
                    roots = local_roots(b - a, x, y)
                    some = np.flatnonzero(roots != np.arange(b - a))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[a:b][some]), pa.array(ids[a:b][roots[some]])], names=["u", "v"])

    return dealt.mapInArrow(run, "u bigint, v bigint")


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
               percent: int = PERCENT, carried: Sequence[str] = ()) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of every row, and its ``carried`` columns."""
    # each step ends in a written table, so its shuffles need no disk beside those of the next
    with shuffles_freed(df.sparkSession):
        all_rows = stored(signatures(df, id_col, text_col, width, percent, carried), "ngram-signatures", BATCH_ROWS)
        classes = all_rows.filter("n > 0 and id is not null").groupBy("d1", "d2").agg(F.min("id").alias("rep"))
        classes = stored(classes, "ngram-classes")
        # one row a class: its smallest id, which repeated rows may have several times
        reps = all_rows.join(classes, [all_rows["id"] == classes["rep"], all_rows["d1"] == classes["d1"], all_rows["d2"] == classes["d2"]],
                             "left_semi").dropDuplicates(["id", "d1", "d2"])
        reached = _linked(df, classes, reps, id_col, text_col, width, percent)
    named = classes.join(reached.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    return all_rows.drop("prefix").join(named, ["d1", "d2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        *[F.col(f"c_{c}").alias(c) for c in carried])


def _linked(df: DataFrame, classes: DataFrame, reps: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """``(node, component)``: the classes that links reach."""
    left = stored(survivors(reps, percent), "ngram-survivors", BATCH_ROWS)
    sets = whole_sets(df, left, id_col, text_col, width)
    # an id may have several texts: only those that stand for a class
    sets = sets.join(classes, [sets["id"] == classes["rep"], sets["d1"] == classes["d1"], sets["d2"] == classes["d2"]],
                     "left_semi").dropDuplicates(["id", "d1", "d2"]).select("id", "n", "tokens")
    sets = stored(sets, "ngram-sets", BATCH_ROWS)
    clusters = candidate_clusters(sets, percent)
    links = stored(verified(sets, clusters, percent), "ngram-links", BATCH_ROWS)
    return connected_components(links, "ngram-components")
