"""Toxicity from the nearest labelled examples (operator 13).

The examples are a sample of labelled rows, about ``EXAMPLES`` of each class chosen by a hash
of their id (all of a smaller class). The terms of a text are its words, their stems (the first
``STEM`` characters) and the stems that occur more than once. Vectors are TF-IDF weights over the
``TERMS`` terms at most that tell the classes apart best (chi-square of at least ``CHI_SQUARE``
in the sample); the document frequencies are counted over all documents.

The inverted index of the examples has blocks of ``BLOCK`` examples: a posting run a
term and block, and the largest weight of each. For a text the block maxima give an upper bound
of every block's cosines; blocks are scored exactly by falling bound as
long as they can still hold one of the ``NEIGHBOURS`` nearest. So the neighbours are
exact (equal cosines by the order of the index).

A text's vote is the share of toxic neighbours, each weighted by a power of its
cosine and by how many labelled rows an example of its class stands for. Votes of the
examples on each other (an example never sees its own id) calibrate the score: monotone regression
of the labels on ``BINS`` bins of votes, and a share of its own for texts without neighbours. The
nearest examples are returned as evidence.

Cases: null and empty texts, and texts without a selected term, have no neighbours
and get that share; several labels of one id: toxic wins; labels other than 0 and 1
and null ids teach nothing; an id with several texts is one example; without
labels, or with one class only, each score is the share of toxic labels (0 without labels); empty tables
give an empty result; only id, text and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.bpe import slices, take_ranges
from vitrine.llm.common import stored
from vitrine.llm.lexical import flat
from vitrine.llm.terms import list_array, term_lists

EXAMPLES = 4000
TERMS, CHI_SQUARE, STEM = 2048, 25.0, 5
BLOCK, NEIGHBOURS, EVIDENCE = 64, 15, 5
POWER, BINS = 4, 64
SLICE = 4 << 20


def held_out(id_col: str = "doc_id") -> Column:
    """The rows whose labels are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(texts: pa.Array, vocabulary: pa.Array | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms (the ``vocabulary`` if there is one, of which no others count), and runs by text
    of the number of a term, its occurrences and the runs' lengths.

    A stem is written ``stem~``, a stem that occurs more than once also ``stem~2``."""
    words, codes, counts = term_lists(pc.utf8_lower(pc.fill_null(texts, "")))
    n = len(counts)
    rows = np.repeat(np.arange(n), counts)
    coded = pc.utf8_slice_codeunits(words, 0, STEM).dictionary_encode()
    stems = pc.binary_join_element_wise(coded.dictionary, pa.scalar("~", words.type), pa.scalar("", words.type))
    twice = pc.binary_join_element_wise(coded.dictionary, pa.scalar("~2", words.type), pa.scalar("", words.type))
    names = pa.concat_arrays([words, stems, twice])
    if vocabulary is None:
        place = np.arange(len(names))
    else:
        place = np.asarray(pc.fill_null(pc.index_in(names, value_set=vocabulary.cast(names.type)), -1), dtype=np.int64)
        names = vocabulary
    of_word, of_stem, of_twice = np.split(place, [len(words), len(words) + len(stems)])
    stem = np.asarray(coded.indices, dtype=np.int64)[codes] if len(codes) else codes
    long_ = np.asarray(pc.greater(pc.utf8_length(words), STEM))[codes] if len(codes) else np.zeros(0, dtype=bool)
    size = max(1, len(names))

    def counted(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = term >= 0
        return np.unique(row[known] * size + term[known], return_counts=True)

    parts = [counted(rows, of_word[codes]), counted(rows[long_], of_stem[stem[long_]])]
    wanted = of_twice[stem] >= 0
    keys, tf = counted(rows[wanted], of_twice[stem[wanted]])
    parts.append((keys[tf > 1], tf[tf > 1]))
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    row, term = np.divmod(keys[order], size)
    return names, term, np.concatenate([t for _, t in parts])[order], np.bincount(row, minlength=n).astype(np.int64)


@dataclass
class Index:
    vocabulary: list[str]
    idf: np.ndarray
    ids: np.ndarray  # of the examples, in index order
    toxic: np.ndarray
    counts_for: np.ndarray  # labelled rows that an example stands for
    examples: np.ndarray  # postings by term and example
    weights: np.ndarray
    runs: np.ndarray  # (term, block + 1): where the postings of a term and block start
    maxima: np.ndarray  # (term, block): largest weight
    prior: float
    alone: float = 0.0  # score of a text without neighbours
    edges: np.ndarray | None = None  # calibrated scores at the bins' middles

    def vector(self, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Weights of length 1."""
        w = (1 + np.log(tf)) * self.idf[terms]
        return w / np.sqrt((w * w).sum()) if len(w) else w

    def cosines(self, terms: np.ndarray, query: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Exact cosine with each example of ``blocks`` (0 elsewhere)."""
        starts = self.runs[terms[:, None], blocks].ravel()
        sizes = self.runs[terms[:, None], blocks + 1].ravel() - starts
        of = np.repeat(np.repeat(query, len(blocks)), sizes)
        return np.bincount(
            take_ranges(self.examples, starts, sizes), weights=of * take_ranges(self.weights, starts, sizes), minlength=len(self.ids))

    def nearest(self, terms: np.ndarray, tf: np.ndarray, without: int | None = None, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` nearest examples with a cosine above 0."""
        if not len(terms) or not len(self.ids):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        query = self.vector(terms, tf)
        bounds = query @ self.maxima[terms]
        order = np.argsort(-bounds, kind="stable")
        step = max(2, 2 * k // BLOCK)
        found = self.cosines(terms, query, order[:step])
        if without is not None:
            found[self.ids == without] = 0
        least = np.partition(found, -k)[-k] if len(found) >= k else 0.0
        more = order[step:]
        more = more[bounds[more] * (1 + 1e-9) >= max(least, 1e-12)]
        if len(more):
            rest = self.cosines(terms, query, more)
            if without is not None:
                rest[self.ids == without] = 0
            found = found + rest  # blocks are disjoint
        some = np.flatnonzero(found >= max(least, 1e-12))
        first = some[np.lexsort([some, -found[some]])][:k]
        return first, found[first]

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic neighbours; NaN without neighbours."""
        if not len(places):
            return float("nan")
        w = cosines**POWER * self.counts_for[places]
        return float((w * self.toxic[places]).sum() / w.sum())

    def scores(self, votes: np.ndarray) -> np.ndarray:
        middles = (np.arange(BINS) + 0.5) / BINS
        known = np.interp(np.nan_to_num(votes), middles, self.edges) if self.edges is not None else np.full(len(votes), self.prior)
        return np.where(np.isnan(votes), self.alone, known)


def build_index(vocabulary: list[str], idf: np.ndarray, ids: np.ndarray, toxic: np.ndarray, stands: np.ndarray,
                terms: list[np.ndarray], tfs: list[np.ndarray], prior: float) -> Index:
    """Index of the examples, ordered so that those of a block share their heaviest terms."""
    index = Index(vocabulary, idf, ids, toxic, stands, *[np.zeros(0)] * 4, prior)
    vectors = [index.vector(t, f) for t, f in zip(terms, tfs, strict=True)]
    heads = np.array([t[w.argmax()] if len(t) else -1 for t, w in zip(terms, vectors, strict=True)])
    order = np.lexsort([ids, heads])
    index.ids, index.toxic, index.counts_for = ids[order], toxic[order], stands[order]
    size, n_blocks = len(vocabulary), max(1, -(-len(ids) // BLOCK))
    sizes = np.array([len(terms[i]) for i in order], dtype=np.int64)
    term = np.concatenate([np.zeros(0, dtype=np.int64), *[terms[i] for i in order]])
    weight = np.concatenate([np.zeros(0), *[vectors[i] for i in order]])
    example = np.repeat(np.arange(len(ids)), sizes)
    by_term = np.lexsort([example, term])
    index.examples, index.weights = example[by_term], weight[by_term]
    cell = term[by_term] * n_blocks + index.examples // BLOCK
    index.runs = np.searchsorted(cell, np.arange(size)[:, None] * n_blocks + np.arange(n_blocks + 1))
    index.maxima = np.zeros(size * n_blocks)
    np.maximum.at(index.maxima, cell, index.weights)
    index.maxima = index.maxima.reshape(size, n_blocks)
    return index


def monotone(votes: np.ndarray, toxic: np.ndarray, rows: np.ndarray, prior: float) -> np.ndarray:
    """Least-squares rising score of each bin from its weighted sums; empty bins take what their neighbours have.
    Each bin with rows counts the prior as one more row."""
    some = np.flatnonzero(rows > 0)
    pools: list[list[float]] = []  # toxic, rows, bins
    for i in some:
        pools.append([toxic[i] + prior, rows[i] + 1.0, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            t, n, b = pools.pop()
            pools[-1] = [pools[-1][0] + t, pools[-1][1] + n, pools[-1][2] + b]
    level = np.repeat([p[0] / p[1] for p in pools], [p[2] for p in pools])
    return np.interp(np.arange(len(votes)), some, level)


def examples_of(docs: DataFrame, labels: DataFrame, learned: Column, id_col: str, text_col: str, label_col: str, most: int) -> tuple[DataFrame, dict]:
    """``(id, toxic, terms, tfs)`` of the sampled examples over all their terms, and the labelled rows of each class."""
    known = labels.filter(learned & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("bigint").alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows at most
    if not sizes:
        return None, sizes
    step = 1 << 20
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(max(1, round(step * min(1, most / n)))))])
    sample = known.filter(F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(step)) < share[F.col("toxic")])
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), "id")  # about ``most`` ids a class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                names, term, tf, sizes = features(batch.column(1).slice(a, b - a))
                terms = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), names.take(pa.array(term)).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), terms, list_array(tf, sizes, pa.int32())],
                    names=["id", "toxic", "terms", "tfs"])

    counted = rows.select("id", "text", "toxic").mapInArrow(run, "id bigint, toxic int, terms array<string>, tfs array<int>")
    one = counted.groupBy("id", "toxic").agg(F.min(F.struct(F.size("terms").alias("n"), "terms", "tfs")).alias("v"))
    return stored(one.select("id", "toxic", "v.terms", "v.tfs"), "toxic-examples"), sizes


def telling_terms(examples: DataFrame, most: int, least: float) -> list[str]:
    """The terms whose presence depends on the class most, by chi-square over the examples."""
    n = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}  # two rows at most
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    yes, no = F.lit(float(n.get(1, 0))), F.lit(float(n.get(0, 0)))
    chi = (yes + no) * F.pow(a * (no - b) - b * (yes - a), 2) / (yes * no * (a + b) * (yes + no - a - b))
    counts = examples.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    chosen = counts.filter((yes > 0) & (no > 0) & (a + b < yes + no)).select("term", chi.alias("chi")).filter(F.col("chi") >= least)
    return sorted(r["term"] for r in chosen.orderBy(F.col("chi").desc(), "term").limit(most).collect())


def document_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str) -> tuple[int, np.ndarray]:
    """All documents, and how many of them hold each term of the vocabulary."""
    size = len(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # TERMS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df, rows = pa.array(shared.value, pa.string()), np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for a, b in slices(batch.column(0), SLICE):
                df += np.bincount(features(batch.column(0).slice(a, b - a), known)[1], minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int64()), pa.array([rows, *df.tolist()], pa.int64())], names=["term", "c"])

    found = {r["term"]: r["c"] for r in docs.select(text_col).mapInArrow(run, "term bigint, c bigint").groupBy("term").agg(
        F.sum("c").alias("c")).collect()}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(size)], dtype=np.int64)


def learn(docs: DataFrame, labels: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", most: int = EXAMPLES) -> Index:
    """Calibrated index from the labels where ``learned`` holds."""
    spark = docs.sparkSession
    examples, sizes = examples_of(docs, labels, learned, id_col, text_col, label_col, most)
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    nothing = build_index([], *[np.zeros(0)] * 4, [], [], prior)
    nothing.alone = prior
    vocabulary = telling_terms(examples, TERMS, CHI_SQUARE) if examples is not None else []
    if not vocabulary:
        return nothing
    n, df = document_frequencies(docs, vocabulary, text_col)
    idf = np.log((1 + n) / (1 + df)) + 1
    # bounded: the examples over the chosen terms
    place = F.map_from_arrays(F.lit(vocabulary), F.lit(list(range(len(vocabulary)))))
    pairs = F.filter(F.arrays_zip("terms", "tfs"), lambda x: F.array_contains(F.lit(vocabulary), x["terms"]))
    known = examples.select("id", "toxic", F.transform(pairs, lambda x: F.struct(
        F.element_at(place, x["terms"]).alias("t"), x["tfs"].alias("f"))).alias("v")).select("id", "toxic", "v.t", "v.f")
    known = stored(known, "toxic-vectors")
    rows = known.orderBy("id").collect()
    toxic = np.array([r["toxic"] for r in rows], dtype=np.int64)
    had = np.bincount(toxic, minlength=2)
    stands = np.array([sizes.get(0, 0) / max(1, had[0]), sizes.get(1, 0) / max(1, had[1])])
    index = build_index(
        vocabulary, idf, np.array([r["id"] for r in rows], dtype=np.int64), toxic, stands[toxic],
        [np.array(r["t"], dtype=np.int64) for r in rows], [np.array(r["f"], dtype=np.int64) for r in rows], prior)
    shared = spark.sparkContext.broadcast(vars(index))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(**shared.value)
        for batch in batches:
            terms, sizes = flat(batch.column(2))
            tf, _ = flat(batch.column(3))
            ends = np.cumsum(sizes)
            out = [own.vote(*own.nearest(terms[b - s : b], tf[b - s : b], without=i))
                   for i, b, s in zip(batch.column(0).to_pylist(), ends.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.float64())], names=["toxic", "vote"])

    voted = known.select("id", "toxic", "t", "f").repartition(F.xxhash64("id")).mapInArrow(votes, "toxic int, vote double")
    bin_ = F.when(F.isnan("vote"), -1).otherwise(F.least(F.floor(F.col("vote") * BINS), F.lit(BINS - 1)))
    counts = {(r["bin"], r["toxic"]): r["count"] for r in voted.groupBy(bin_.cast("int").alias("bin"), "toxic").count().collect()}  # 2 x BINS rows
    bad = np.array([counts.get((i, 1), 0) * stands[1] for i in range(-1, BINS)])
    all_ = bad + np.array([counts.get((i, 0), 0) * stands[0] for i in range(-1, BINS)])
    index.alone = float((bad[0] + prior) / (all_[0] + 1))
    if all_[1:].sum() > 0:
        index.edges = monotone(np.arange(BINS), bad[1:], all_[1:], prior)
    return index


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score, predicted, vote, evidence)`` of every row, from its text alone."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vars(index))  # bounded by EXAMPLES and TERMS
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(**shared.value)
        vocabulary = pa.array(own.vocabulary, pa.string())
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                _, terms, tf, sizes = features(batch.column(1).slice(a, b - a), vocabulary)
                ends = np.cumsum(sizes)
                votes, shown = np.full(b - a, np.nan), []
                for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
                    places, cosines = own.nearest(terms[end - size : end], tf[end - size : end])
                    votes[i] = own.vote(places, cosines)
                    shown.append([(int(own.ids[p]), float(c), int(own.toxic[p])) for p, c in zip(places[:EVIDENCE], cosines, strict=False)])
                scores = own.scores(votes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                     pa.array(votes, mask=np.isnan(votes)),
                     pa.array([[dict(zip(("doc_id", "cosine", "toxic"), x, strict=True)) for x in xs] for xs in shown], evidence)],
                    names=["id", "score", "predicted", "vote", "evidence"])

    schema = f"id {kind}, score double, predicted int, vote double, evidence array<struct<doc_id:bigint,cosine:double,toxic:int>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
