"""Order-preserving packing by dynamic programming (operator 2).

The documents, in order of their id, form one stream of tokens. Candidate
cuts are document ends, sentence ends and, inside sentences of more than
``LONG_SENTENCE`` tokens, a position every ``STRIDE`` tokens. A window between two
cuts becomes one sequence; its cost is its padding, a fee for the sequence
and a penalty for the kind of cut that ends it. With ``p`` the position of a
cut and ``f`` the least cost up to it,

    f(j) = penalty(j) + fee + min(window - (p_j - p_i) + f(i)),  p_j - p_i <= window

so a queue of the cuts in reach, kept in rising order of ``f(i) + p_i``,
gives each minimum in constant time. Windows whose length is a power of two
need no padding; those of ``POWERS`` are further transitions.

Each task takes a range of ids and works through it in segments of about
``SEGMENT`` tokens; the last window of a segment is carried into the next.
What is left at a range's end is cut into powers of two when that is cheaper
than padding.

Cases: the vocabulary's added tokens have their own ids where a text holds them; a null text is empty (its only token is the end id); an empty table
gives an empty result; rows with one id are packed one after the other in
an order of their own; null ids come first; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import bpe
from vitrine.llm.common import worker_cache

WINDOW = 2048
SEGMENT = 1 << 19
END_ID = 1
FEE, SENTENCE_CUT, INNER_CUT = 8, 4, 32
LONG_SENTENCE, STRIDE = 128, 64
POWERS = (256, 512, 1024)

PIECES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, sequence_length bigint, padded_length bigint"
)


def sentence_ends(path: str) -> np.ndarray:
    """For each id of the vocabulary: does the token end a sentence?"""
    cache = worker_cache()
    if ("sentence", path) not in cache:
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        last = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        flags = np.zeros(last + 1, dtype=bool)
        stop = re.compile(r"[^0-9a-z]*[.!?]+[\"')\]]*</w>")
        flags[[i for token, i in vocab.items() if stop.fullmatch(token)]] = True
        cache["sentence", path] = flags
    return cache["sentence", path]


def candidate_cuts(ids: np.ndarray, doc_ends: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, rising up to ``len(ids)``, and their penalties."""
    ends = flags[ids]
    ends[:-1] &= ~ends[1:]
    penalty = np.full(len(ids) + 1, -1, dtype=np.int64)
    penalty[np.flatnonzero(ends) + 1] = SENTENCE_CUT
    penalty[doc_ends] = 0
    penalty[len(ids)] = 0
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at, prepend=0)
    for k in np.flatnonzero(gaps > LONG_SENTENCE):
        penalty[at[k] - gaps[k] + STRIDE : at[k] : STRIDE] = INNER_CUT
    at = np.flatnonzero(penalty >= 0)
    at = at[at > 0]
    return at, penalty[at]


def best_cuts(cuts: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """Cuts of least total cost; the last of ``cuts`` is always chosen."""
    p = [0, *cuts.tolist()]
    fees = [0, *(penalties + FEE).tolist()]
    m = len(p)
    at = np.asarray(p)
    powers: dict[int, list[int]] = {}
    for size in POWERS:
        if size < window:
            i = np.searchsorted(at, at - size)
            for j in np.flatnonzero(at[i] == at - size).tolist():
                powers.setdefault(j, []).append(int(i[j]))
    cost, before = [0] * m, [0] * m
    queue, keys = deque([0]), [0] * m
    for j in range(1, m):
        here = p[j]
        while p[queue[0]] < here - window:
            queue.popleft()
        i = queue[0]
        least = keys[i] + window - here
        if j in powers:
            for k in powers[j]:
                if cost[k] < least:
                    least, i = cost[k], k
        cost[j], before[j] = least + fees[j], i
        key = keys[j] = cost[j] + here
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    chosen, j = [], m - 1
    while j:
        chosen.append(p[j])
        j = before[j]
    return chosen[::-1]


def tail_cuts(start: int, end: int, window: int = WINDOW) -> list[int]:
    """Cuts of a last window: powers of two if their cuts cost less than padding."""
    length = end - start
    bits = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    if (FEE + INNER_CUT) * (len(bits) - 1) >= window - length:
        return [end]
    return (start + np.cumsum(bits)).tolist()


class Packer:
    """The state of one task: documents that are not yet cut into windows."""

    def __init__(self, flags: np.ndarray, task: int, window: int, with_ids: bool):
        self.flags, self.window, self.with_ids = flags, window, with_ids
        self.next_id = task << 40
        self.ids = np.zeros(0, dtype="<u4")
        self.docs: list[tuple] = []  # (id, its tokens before the buffer, tokens in the buffer, tokens in all)

    def add(self, keys: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.extend((k, 0, n, n) for k, n in zip(keys, counts.tolist(), strict=True))
        self.ids = np.concatenate([self.ids, ids])

    def flush(self, last: bool) -> list[tuple]:
        if not len(self.ids):
            return []
        ends = np.cumsum([d[2] for d in self.docs])
        cuts = best_cuts(*candidate_cuts(self.ids, ends, self.flags), self.window)
        if last:
            cuts[-1:] = tail_cuts(cuts[-2] if len(cuts) > 1 else 0, cuts[-1], self.window)
        else:
            cuts.pop()
        rows, position, k, done = [], 0, 0, 0
        for cut in cuts:
            size, begin = cut - position, position
            padded = size if size & (size - 1) == 0 else self.window
            while position < cut:
                key, before, here, total = self.docs[k]
                length = min(here - done, cut - position)
                own = self.ids[position : position + length]
                row = (key, before + done, length, zlib.crc32(own), total, self.next_id, position - begin, size, padded)
                rows.append((*row, own.tolist()) if self.with_ids else row)
                position += length
                done += length
                if done == here:
                    k, done = k + 1, 0
            self.next_id += 1
        if k < len(self.docs):
            key, before, here, total = self.docs[k]
            self.docs = [(key, before + done, here - done, total), *self.docs[k + 1 :]]
        else:
            self.docs = []
        self.ids = self.ids[position:]
        return rows


def append_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(len(ids) + len(counts), end_id, dtype="<u4")
    keep = np.ones(len(out), dtype=bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out, counts + 1


def pack(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents in sequences of at most ``window`` tokens.

    One row per piece: ``id_col``, ``start`` (its document's tokens before
    it), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` in the sequence, ``sequence_length`` without and
    ``padded_length`` with padding, and ``ids`` if ``with_ids``.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, {PIECES}" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.WordEncoder(vocabulary, added=True)
        packer = Packer(sentence_ends(vocabulary), TaskContext.get().partitionId(), window, with_ids)
        names = [x.split()[0] for x in schema.split(", ")]

        def table(found: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * 8, *[pa.list_(pa.int32())] * with_ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for a, b in bpe.slices(batch.column(1)):
                part = batch.slice(a, b - a)
                packer.add(part.column(0).to_pylist(), *append_end(*encoder.encode(part.column(1)), end_id))
                if len(packer.ids) >= SEGMENT and (found := packer.flush(last=False)):
                    yield table(found, id_type)
        if found := packer.flush(last=True):
            yield table(found, id_type)

    # equal ids may fall into several ranges: no id can make a range of its own grow
    keys = ["id", "tie", "row"]
    ordered = (
        rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
    )
    return ordered.select("id", "text").mapInArrow(run, schema).withColumnRenamed("id", id_col)
