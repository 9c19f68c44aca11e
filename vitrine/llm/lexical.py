"""Ranked lexical search with norm buckets (operator 11).

Each document is a vector of impacts over the terms of the items: the weight of
a term times its saturated frequency, in integers. The score of a document
for an item is the inner product with the item's term counts, and the search for the
largest products goes by length, as LEMP does:

1. tokens are counted once, in Arrow batches; the counts of the corpus (documents, terms,
   documents of each term) are sums over all of them;
2. every task orders its vectors by length and cuts them into buckets of
   similar lengths. By the inequality of Cauchy and Schwarz a bucket whose longest
   vector times the item's length stays below the item's threshold holds no result;
3. in the other buckets the item's ``FOCUS`` heaviest coordinates are summed up, and
   they, with the lengths of what is left of both vectors, bound each product;
4. what survives is scored over all terms in 64-bit integers, and the best
   ``k`` raise the threshold of the next buckets.

A first wave searches the longest vectors of the corpus, in all tasks; its k-th
best scores are the thresholds that the other vectors start with. Bounds only drop what
is surely below the k-th score; equal scores are kept, so the result is exact.

Items are worked off in blocks of ``ITEMS`` (each block is a pass over the texts), whose terms and
counts are broadcast.

Cases: null and empty texts, and texts without a term, count in no
statistic and are never found; an item without terms, or whose terms no
document holds, has no rows; null ids rank before others of their score;
repeated documents are ranked one by one, repeated items are items of
their own; empty tables give an empty result; further columns are not read; ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.bpe import slices
from vitrine.llm.common import stored
from vitrine.llm.terms import known_counts, list_array, term_lists

TOP = 20
ITEMS = 1024
SLICE = 4 << 20
BUCKET, SHORTEST = 512, 0.8  # rows a bucket at most, and its shortest length as a share of its longest
FOCUS = 8
FIRST_WAVE = 0.98  # vectors longer than this share of all go first
SLACK = 1 + 1e-9  # bounds are sums of doubles
B = 25  # fixed value: per cent of the length normalisation


def item_terms(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """``(q, item, terms, counts)``: the terms of each item, ``q`` counting the items from 0 in order of their id."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a stated query set: few rows
                words, codes, _ = term_lists(batch.column(1).slice(i, 1))
                used, counts = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([words.take(pa.array(used)).to_pylist()], pa.list_(pa.string())),
                     pa.array([counts.tolist()], pa.list_(pa.int64()))], names=["item", "terms", "counts"])

    from vitrine.operators.numbering import number_rows

    rows = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).mapInArrow(
        run, f"item {kind}, terms array<string>, counts array<bigint>")
    return number_rows(stored(rows, "search-items"), ["item"], start=-1, name="q")


def count_terms(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """``(id, n, terms, tfs)`` of every document with a term: all its terms, and the known ones with their counts."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                n, terms, tfs, sizes = known_counts(batch.column(1).slice(a, b - a), known)
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), list_array(terms, sizes, pa.int32()),
                     list_array(tfs, sizes, pa.int32())], names=["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, tfs array<int>")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and run lengths of a list column without nulls."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    return np.asarray(column.values)[offsets[0] : offsets[-1]].astype(np.int64), np.diff(offsets)


def corpus_counts(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms in all, and documents of each known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows, total = np.zeros(size + 1, dtype=np.int64), 0, 0
        for batch in batches:
            df += np.bincount(flat(batch.column(1))[0], minlength=size + 1)
            rows += batch.num_rows
            total += int(np.asarray(batch.column(0), dtype=np.int64).sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *some.tolist()], pa.int64()), pa.array([rows, total, *df[some].tolist()], pa.int64())], names=["term", "c"])

    # one row a term of the block of items, and two more
    found = {r["term"]: r["c"] for r in counted.select("n", "terms").mapInArrow(run, "term bigint, c bigint").groupBy("term").agg(
        F.sum("c").alias("c")).collect()}
    df = np.zeros(size, dtype=np.int64)
    for term, c in found.items():
        if term >= 0:
            df[term] = c
    return found.get(-2, 0), found.get(-1, 0), df


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def impacts(counted: DataFrame, n_docs: int, n_terms: int, weights: np.ndarray) -> DataFrame:
    """``(id, norm, terms, shares)``: the saturated frequencies and the length of the vector of
    impacts (weight x share); vectors of length 0 have no score and go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, sizes = flat(batch.column(2))
            tf, _ = flat(batch.column(3))
            # lengths times documents may leave 64 bits: whole numbers of any size
            n = batch.column(1).to_pylist()
            m = np.array([100 - B + (B * x * n_docs) // n_terms for x in n], dtype=np.int64)
            share = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes))
            squares = np.concatenate([[0.0], np.cumsum((weights[terms] * share).astype(np.float64) ** 2)])
            ends = np.cumsum(sizes)
            norm = np.array([math.sqrt(max(0.0, x)) for x in (squares[ends] - squares[ends - sizes]).tolist()])
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norm), batch.column(2), list_array(share, sizes, pa.int32())],
                names=["id", "norm", "terms", "shares"])
            yield out.filter(pa.array(norm > 0))

    return counted.mapInArrow(run, "id bigint, norm double, terms array<int>, shares array<int>")


class Best:
    """The best ``k`` of one item in one task; equal scores by ascending id."""

    def __init__(self, k: int, threshold: int):
        self.k, self.threshold = k, threshold
        self.scores, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort([ids, -scores])[: self.k]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.k:
            self.threshold = max(self.threshold, int(self.scores[-1]))


class Items:
    """The items of a block as vectors: terms by falling weight of their coordinate, and the length of what follows the focus."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], weights: np.ndarray):
        self.terms, self.counts = [], []
        for t, c in zip(terms, counts, strict=True):
            order = np.lexsort([t, -(c * weights[t])])
            self.terms.append(t[order])
            self.counts.append(c[order])
        self.norms = np.array([math.sqrt(float((c.astype(np.float64) ** 2).sum())) for c in self.counts])
        self.rests = np.array([math.sqrt(float((c[FOCUS:].astype(np.float64) ** 2).sum())) for c in self.counts])


def search_bucket(items: Items, best: list[Best], norms: np.ndarray, ids: np.ndarray, terms: np.ndarray, sizes: np.ndarray,
                  impact: np.ndarray, size: int) -> None:
    """Compare one bucket (norms falling) with every item that it can still serve."""
    reach = items.norms * norms[0] * SLACK
    wanted = [q for q in range(len(best)) if reach[q] > 0 and reach[q] >= best[q].threshold]
    if not wanted:
        return
    n = len(norms)
    order = np.argsort(terms, kind="stable")
    rows, value = np.repeat(np.arange(n), sizes)[order], impact[order]
    starts = np.searchsorted(terms[order], np.arange(size + 1))
    squares = value.astype(np.float64) ** 2
    for q in wanted:
        score, seen = np.zeros(n, dtype=np.int64), np.zeros(n)
        own, counts = items.terms[q], items.counts[q]
        for t, c in zip(own[:FOCUS].tolist(), counts[:FOCUS].tolist(), strict=True):
            a, b = starts[t], starts[t + 1]
            score[rows[a:b]] += c * value[a:b]  # a term stands once in a row
            seen[rows[a:b]] += squares[a:b]
        threshold = max(1, best[q].threshold)
        bound = (score + items.rests[q] * np.sqrt(np.maximum(norms**2 * SLACK - seen, 0))) * SLACK
        if not (bound >= threshold).any():
            continue
        for t, c in zip(own[FOCUS:].tolist(), counts[FOCUS:].tolist(), strict=True):
            a, b = starts[t], starts[t + 1]
            score[rows[a:b]] += c * value[a:b]
        hit = np.flatnonzero((bound >= threshold) & (score >= threshold))
        if len(hit):
            best[q].add(score[hit], ids[hit])


def search(vectors: DataFrame, shared, k: int) -> DataFrame:
    """``(q, id, score)``: the best ``k`` of each item in each task."""
    least = -(1 << 63)  # a null id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, terms, counts, thresholds = shared.value
        items = Items(terms, counts, weights)
        best = [Best(k, t) for t in thresholds]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.asarray(batch.column(0).fill_null(least), dtype=np.int64)
            norms = np.asarray(batch.column(1))
            words, sizes = flat(batch.column(2))
            impact = weights[words] * flat(batch.column(3))[0]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            a = 0
            while a < len(ids):
                b = min(a + BUCKET, len(ids), a + max(1, int(np.searchsorted(-norms[a:], -SHORTEST * norms[a], side="right"))))
                part = slice(ends[a], ends[b])
                search_bucket(items, best, norms[a:b], ids[a:b], words[part], sizes[a:b], impact[part], len(weights))
                a = b
        found = [(q, i, s) for q, x in enumerate(best) for i, s in zip(x.ids.tolist(), x.scores.tolist(), strict=True)]
        if found:
            q, i, s = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array([None if x == least else x for x in i], pa.int64()), pa.array(s, pa.int64())],
                names=["q", "id", "score"])

    return vectors.sortWithinPartitions(F.col("norm").desc()).mapInArrow(run, "q int, id bigint, score bigint")


def top(rows: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc())
    return rows.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def search_block(terms: list[list[str]], counts: list[list[int]], docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Results ``(q, rank, id, score)`` of one block of items over all documents."""
    spark = docs.sparkSession
    vocabulary = sorted({t for ts in terms for t in ts})
    number = {t: i for i, t in enumerate(vocabulary)}
    counted = stored(count_terms(docs, vocabulary, id_col, text_col), "search-counts")
    n_docs, n_terms, df = corpus_counts(counted, len(vocabulary))
    weights = term_weights(n_docs, df)
    vectors = stored(impacts(counted, n_docs, n_terms, weights), "search-vectors")
    numbers = [np.array([number[t] for t in ts], dtype=np.int64) for ts in terms]
    times = [np.array(c, dtype=np.int64) for c in counts]
    # the terms and thresholds of one block of items
    share = lambda thresholds: spark.sparkContext.broadcast((weights, numbers, times, thresholds))
    cut = vectors.agg(F.percentile_approx("norm", F.lit(FIRST_WAVE), F.lit(1000))).first()[0]
    first = stored(top(search(vectors.filter(F.col("norm") > F.lit(cut)), share([0] * len(terms)), k), k), "search-first")
    kth = {r["q"]: r["score"] for r in first.filter(F.col("rank") == k).collect()}  # one row an item of the block
    rest = search(vectors.filter(~(F.col("norm") > F.lit(cut))), share([kth.get(q, 0) for q in range(len(terms))]), k)
    return top(first.drop("rank").unionByName(rest), k)


def ranked_search(items: DataFrame, docs: DataFrame, k: int = TOP, item_id: str = "item_id", item_text: str = "text",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(item_id, rank, id_col, score)``: the ``k`` best documents of every item, with scores above 0."""
    spark = docs.sparkSession
    numbered = stored(item_terms(items, item_id, item_text), "search-queries")
    total = numbered.count()
    kind = items.schema[item_id].dataType.simpleString()
    blocks = []
    for a in range(0, total, ITEMS):
        rows = numbered.filter(F.col("q").between(a, a + ITEMS - 1)).orderBy("q").collect()  # one block of the query set
        found = search_block([r["terms"] for r in rows], [r["counts"] for r in rows], docs, k, id_col, text_col)
        blocks.append(found.withColumn("q", F.col("q") + F.lit(a).cast("bigint")))
    if not blocks:
        return spark.createDataFrame([], f"{item_id} {kind}, rank int, {id_col} bigint, score bigint")
    found = reduce(lambda x, y: x.unionByName(y), blocks)
    return found.join(numbered.select("q", "item"), "q").select(
        F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


__all__ = ["ranked_search"]
