"""Language identification by Kneser-Ney character models (operator 5).

A text becomes its words: runs of letters, in lower case. Each language has
an interpolated Kneser-Ney model of order ``ORDER`` over the characters of a word
between word marks. The models are learned from about ``SAMPLE_ROWS`` labelled rows a
language (their word counts are made by Spark); the grams of all languages
stand in one sorted array of hashes per order, next to one row of log
probabilities (one column a language). A gram that no language has seen
falls back to the next shorter one times the weight of its context.

A text's cross-entropy in a language is the negative log probability of its
words over their number of characters (each word's end counts as one). The
least one wins; ``score`` is the winner's share if the languages are weighted
by exp(-``SHARPNESS`` x cross-entropy), and ``rejected`` says that even the winner's
cross-entropy is above a limit. The limit is calibrated on all rows that may be learned from, each
scored twice: by all languages (``known``), and by all but its own, as if that one had never been learned
(``strange``). It stands in the middle between the known texts' ``TAIL`` quantile and the lowest
``LEFT_OUT`` quantile of a language's strange texts, and never below the first, so that rejection takes at
most about 1 - ``TAIL`` of the known texts even where languages are alike. A single language has no strange
texts; its limit is the known quantile plus ``MARGIN``.

Words are scored once per slice of a batch, however often they occur there.

Cases: a null text, or one without a letter, is ``und`` with score 0 and is
rejected; without any labelled row every text is ``und``; an empty table
gives an empty result; equal cross-entropies go to the first language by
name; only the id, text and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.bpe import slices
from vitrine.llm.common import forget_caches

ORDER = 4
SAMPLE_ROWS = 600
SHARPNESS = 6.0
BLOCK, SLICE = 20_000, 2 << 20  # words and bytes of text that a task scores at once
TAIL, LEFT_OUT, MARGIN, SHORT = 0.9999, 0.05, 1.2, 6.0
BIN, BINS = 0.001, 50_000  # nats a step of the calibration counts, and their number on either side of 0
START, END = "\x02", "\x03"
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word number of each occurrence, and the occurrences a text."""
    letters = pc.utf8_lower(pc.replace_substring_regex(pc.fill_null(texts, ""), r"[^\p{L}]+", " "))
    lists = pc.ascii_split_whitespace(letters)
    coded = lists.flatten().dictionary_encode()
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    codes = np.asarray(coded.indices, dtype=np.int64)
    empty = pc.index_in(pa.scalar(""), coded.dictionary).as_py()  # of a text that begins or ends with a blank
    if empty is not None:
        keep = codes != empty
        before = np.concatenate([[0], np.cumsum(keep)])
        ends = np.cumsum(counts)
        counts = before[ends] - before[ends - counts]
        codes = codes[keep]
    return coded.dictionary, codes, counts


def gram_hashes(chars: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` characters that end at each place of ``chars`` (uint64 code
    points); the first places wrap around and are not used by callers."""
    h = np.zeros(len(chars), dtype=np.uint64)
    for k in range(size):
        h = (h ^ np.roll(chars, size - 1 - k)) * MIX
        h ^= h >> np.uint64(31)
    return h


def room(sizes: np.ndarray) -> np.ndarray:
    """What a text of so many characters may lie above the limit."""
    return SHORT / np.sqrt(np.maximum(sizes, 1))


@dataclass
class Model:
    languages: list[str]
    hashes: list[np.ndarray]  # per order, sorted hashes of grams
    logs: list[np.ndarray]  # per order, log probabilities (gram x language)
    contexts: list[np.ndarray]  # per order, sorted hashes of the contexts of its grams
    weights: list[np.ndarray]  # per order, log weights of the next shorter order
    floor: float
    limit: float = float("inf")

    def word_logs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each word in each language, and its length with the end mark."""
        blocks = [self.block_logs(words[i : i + BLOCK]) for i in range(0, len(words), BLOCK)]
        return np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])

    def block_logs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``word_logs`` of a few words, as each of their characters takes a row of numbers."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        pad = START * (ORDER - 1)
        joined = pad + (END + pad).join(words) + END
        chars = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        ends = np.cumsum(lengths + ORDER - 1)
        own = np.ones(len(chars), dtype=bool)
        for k in range(ORDER - 1):
            own[ends - lengths - 1 - k] = False
        places = np.flatnonzero(own)
        out = np.zeros((len(places), len(self.languages)))
        open_ = np.arange(len(places))
        for order in range(ORDER, 0, -1):
            h = gram_hashes(chars, order)[places[open_]]
            at = np.searchsorted(self.hashes[order], h)
            at[at == len(self.hashes[order])] = 0
            hit = self.hashes[order][at] == h
            out[open_[hit]] += self.logs[order][at[hit]]
            open_ = open_[~hit]
            if order > 1 and len(open_):
                h = gram_hashes(chars, order - 1)[places[open_] - 1]
                at = np.searchsorted(self.contexts[order], h)
                at[at == len(self.contexts[order])] = 0
                hit = self.contexts[order][at] == h
                out[open_[hit]] += self.weights[order][at[hit]]
        out[open_] += self.floor + self.weights[1][0]  # a character that no language has seen
        return np.add.reduceat(out, np.cumsum(lengths) - lengths, axis=0), lengths

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text in each language (inf without a word) and its number of characters."""
        words, codes, counts = words_of(texts)
        total = np.full((len(counts), len(self.languages)), np.inf)
        sizes = np.zeros(len(counts), dtype=np.int64)
        some = np.flatnonzero(counts)
        if len(some):
            logs, lengths = self.word_logs(words.to_pylist())
            first = (np.cumsum(counts) - counts)[some]
            sizes[some] = np.add.reduceat(lengths[codes], first)
            sums = np.stack([np.add.reduceat(logs[codes, k], first) for k in range(len(self.languages))], axis=1)
            total[some] = -sums / sizes[some][:, None]
        return total, sizes

    def rejects(self, least: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Short texts scatter more: they get more room."""
        return ~(least - room(sizes) <= self.limit)


def kneser_ney(grams: pd.DataFrame, languages: list[str]) -> Model:
    """Model from ``(lang, gram, n)``: counts of grams of ``ORDER`` characters."""
    size = len(languages)
    alphabet = {c for g in grams["gram"] for c in g} | {END}
    floor = -np.log(len(alphabet) + 1)
    none = np.zeros(1, dtype=np.uint64)
    hashes, logs = [none] * (ORDER + 1), [np.zeros((1, size))] * (ORDER + 1)
    contexts, weights = [none] * (ORDER + 1), [np.zeros((1, size))] * (ORDER + 1)

    def hash_of(strings: pd.Index, length: int) -> np.ndarray:
        chars = np.frombuffer("".join(strings).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        return gram_hashes(chars, length)[length - 1 :: length]

    # counts by order: occurrences for the longest grams, distinct left neighbours below
    tables, current = {ORDER: grams}, grams
    for order in range(ORDER - 1, 0, -1):
        shorter = current.assign(gram=current["gram"].str[1:])
        current = shorter.groupby(["lang", "gram"], as_index=False).size().rename(columns={"size": "n"})
        tables[order] = current
    below: pd.DataFrame | None = None  # probabilities of the next shorter grams
    for order in range(1, ORDER + 1):
        wide = tables[order].pivot_table(index="gram", columns="lang", values="n", fill_value=0, aggfunc="sum")
        wide = wide.reindex(columns=languages, fill_value=0).astype(float)
        ones, twos = (wide == 1).sum(), (wide == 2).sum()
        discount = (ones / (ones + 2 * twos).clip(lower=1)).clip(0.1, 0.95)
        head = wide.index.str[:-1]
        totals = wide.groupby(head).sum()
        kinds = (wide > 0).groupby(head).sum()
        weight = (kinds * discount / totals.where(totals > 0)).fillna(1.0)
        spread = weight.reindex(head).to_numpy()
        share = ((wide - discount).clip(lower=0).to_numpy() / totals.where(totals > 0).reindex(head).to_numpy())
        if order == 1:
            lower = np.full((len(wide), size), np.exp(floor))
            weights[1] = np.log(weight.to_numpy())  # of the uniform share, after the one empty context
        else:
            lower = below.reindex(wide.index.str[1:]).to_numpy()
        below = pd.DataFrame(np.nan_to_num(share) + spread * lower, index=wide.index)
        h = hash_of(wide.index, order)
        rank = np.argsort(h)
        hashes[order], logs[order] = h[rank], np.log(below.to_numpy())[rank]
        if order > 1:
            h = hash_of(weight.index, order - 1)
            rank = np.argsort(h)
            contexts[order], weights[order] = h[rank], np.log(weight.to_numpy())[rank]
    return Model(languages, hashes, logs, contexts, weights, float(floor))


def learn(df: DataFrame, learned: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          rows_a_language: int = SAMPLE_ROWS) -> Model | None:
    """Model from a sample of the rows where ``learned`` holds: about ``rows_a_language``
    of each language, chosen by a hash of their id and text. None if there is no labelled row."""
    known = df.filter(learned & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return None
    step = 1 << 20
    shares = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(max(1, round(step * min(1, rows_a_language / n)))))])
    sample = known.filter(F.pmod(F.xxhash64(F.lit(11), "id", "text"), F.lit(step)) < shares[F.col("lang")])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        for batch in batches:
            langs = np.asarray(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                words, codes, _ = words_of(batch.column(0).take(pa.array(np.flatnonzero(langs == lang))))
                n = np.bincount(codes, minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words)), words.cast(pa.string()), pa.array(n, pa.int64())],
                    names=["lang", "word", "n"])

    words = sample.select("text", "lang").mapInArrow(counted, "lang string, word string, n bigint")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter("n > 0 and word <> ''")
    padded = F.concat(F.lit(START * (ORDER - 1)), "word", F.lit(END))
    grams = words.select("lang", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))).alias("gram"))
    table = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # bounded by the sample
    if table.empty:
        return None
    model = kneser_ney(table, sorted(table["lang"].unique()))
    model.limit = limit_of(calibration(known, model))
    return model


def calibration(known: DataFrame, model: Model) -> pd.DataFrame:
    """``(lang, strange, bin, n)`` over all rows of ``known`` (text, lang): how many texts of a language have their least
    cross-entropy, less their room, in a bin of ``BIN`` nats; ``strange``: without the columns of their own language.

    The counts are added up by Spark; at most 2 x 2 x ``BINS`` rows a language reach the driver, however many texts there are.
    """
    shared = known.sparkSession.sparkContext.broadcast(vars(model))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        model = Model(**shared.value)
        place = {lang: k for k, lang in enumerate(model.languages)}
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE):
                found, sizes = model.entropies(batch.column(0).slice(a, b - a))
                # a language of which no sampled row has a letter was not learned: its texts have no say
                own = np.array([place.get(x, -1) for x in batch.column(1).slice(a, b - a).to_pylist()], dtype=np.int64)
                some = np.flatnonzero((sizes > 0) & (own >= 0))
                found, own, extra = found[some], own[some], room(sizes[some])
                for strange in (False, True):
                    if strange:
                        found[np.arange(len(own)), own] = np.inf
                    least = found.min(axis=1) - extra
                    at = np.isfinite(least)
                    bins = np.clip(np.floor(least[at] / BIN), -BINS, BINS - 1).astype(np.int64)
                    pairs, n = np.unique(np.stack([own[at], bins]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(model.languages, dtype=object)[pairs[0]], pa.string()),
                         pa.array(np.full(len(n), strange)), pa.array(pairs[1]), pa.array(n.astype(np.int64))],
                        names=["lang", "strange", "bin", "n"])

    counts = known.select("text", "lang").mapInArrow(counted, "lang string, strange boolean, bin bigint, n bigint")
    return counts.groupBy("lang", "strange", "bin").agg(F.sum("n").alias("n")).toPandas()


def quantile(counts: pd.DataFrame, share: float) -> float:
    """Upper end of the bin that holds the ``share`` quantile."""
    bins = counts.groupby("bin")["n"].sum().sort_index()
    reached = np.searchsorted(bins.cumsum().to_numpy(), share * bins.sum())
    return (int(bins.index[min(reached, len(bins) - 1)]) + 1) * BIN


def limit_of(counts: pd.DataFrame) -> float:
    """The limit on cross-entropy from the counts of :func:`calibration`."""
    known, strange = counts[~counts["strange"].astype(bool)], counts[counts["strange"].astype(bool)]
    if known.empty:
        return float("inf")
    tail = quantile(known, TAIL)
    if strange.empty:
        return tail + MARGIN
    lowest = min(quantile(one, LEFT_OUT) for _, one in strange.groupby("lang"))
    return max(tail, (tail + lowest) / 2)


def identify(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``(id_col, lang_pred, score, cross_entropy, rejected)`` of every row, from its text alone; and its ``text_col`` with ``with_text``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model and vars(model))  # bounded by the sample it is learned from

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        model = Model(**shared.value) if shared.value else None
        names = np.array([*(model.languages if model else []), "und"], dtype=object)
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                part = batch.slice(a, b - a)
                n = len(part)
                best, score, least, rejected = np.full(n, -1), np.zeros(n), np.full(n, np.inf), np.ones(n, dtype=bool)
                if model:
                    found, sizes = model.entropies(part.column(1))
                    some = np.flatnonzero(sizes)
                    best[some] = found[some].argmin(axis=1)
                    least[some] = found[some].min(axis=1)
                    score[some] = 1 / np.exp(-SHARPNESS * (found[some] - least[some][:, None])).sum(axis=1)
                    rejected = model.rejects(least, sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names[best], pa.string()), pa.array(score),
                     pa.array(least, mask=~np.isfinite(least)), pa.array(rejected), *[part.column(1)] * with_text],
                    names=["id", "lang_pred", "score", "cross_entropy", "rejected", *["text"] * with_text])

    schema = f"id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean" + ", text string" * with_text
    out = rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return out.withColumnRenamed("text", text_col) if with_text else out


def held_out(id_col: str = "doc_id") -> Column:
    """The rows that are never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
