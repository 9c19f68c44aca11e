"""Byte-level BPE encoding and decoding (operator 10).

``encode`` runs the ``tokenizers`` library over Arrow batches: bytes go
through the byte-to-character table, each match of the split pattern is
encoded alone by the ranks, and every token knows the code points that it
covers. ``decode`` reverses the byte table; bytes of a character that is
split between tokens are joined before they are read as UTF-8.

Cases: a null text counts as empty (no ids); an empty table gives an empty
result; only the id and text columns are read, so further columns cannot
clash; repeated rows give repeated rows; a very long text is one row of its
own batch slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import bpe
from vitrine.llm.common import worker_cache

ENCODED = {
    "ids": "array<int>",
    "starts": "array<int>",
    "ends": "array<int>",
    "n_tokens": "bigint",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def char_spans(text: str, byte_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points [start, end) that the tokens of ``text`` touch, from their byte
    lengths. Tokens that share one split character all cover that character."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    char_of_byte = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(byte_lengths)
    return char_of_byte[ends - byte_lengths], char_of_byte[ends - 1] + 1


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def encode(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    outputs: tuple[str, ...] = ("ids", "starts", "ends"),
) -> DataFrame:
    """``id_col`` and the chosen ``outputs`` of each row.

    ``ids``; ``starts`` and ``ends`` (code points that each token touches);
    ``n_tokens``; ``ids_sha256`` (decimal ids joined by one space);
    ``decoded_sha256`` (bytes that the ids decode to).
    """
    ranks = bpe.load_ranks(ranks_path)
    spec, key = bpe.rank_spec(ranks), f"ranks:{ranks_path}"
    shared = df.sparkSession.sparkContext.broadcast((spec, token_bytes(ranks)))  # the vocabulary: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, table = shared.value
        encoder = bpe.ByteEncoder(spec, key, pattern)
        lengths = np.fromiter(map(len, table), dtype=np.int64, count=len(table))
        decimal = worker_cache().setdefault("decimal", [])
        decimal.extend(str(i).encode() for i in range(len(decimal), len(table)))
        for batch in batches:
            for a, b in bpe.slices(batch.column(1)):
                part = batch.slice(a, b - a)
                texts = part.column(1)
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                columns: dict[str, list | pa.Array] = {k: [] for k in outputs}
                if "ids" in columns:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
                if "n_tokens" in columns:
                    columns["n_tokens"] = pa.array(counts, pa.int64())
                if {"ids_sha256", "decoded_sha256"} & set(columns):
                    for lo, hi in zip(ends - counts, ends, strict=True):
                        own = ids[lo:hi].tolist()
                        if "ids_sha256" in columns:
                            columns["ids_sha256"].append(hashlib.sha256(b" ".join([decimal[i] for i in own])).hexdigest())
                        if "decoded_sha256" in columns:
                            columns["decoded_sha256"].append(hashlib.sha256(b"".join([table[i] for i in own])).hexdigest())
                if {"starts", "ends"} & set(columns):
                    for text, lo, hi in zip(pc.fill_null(texts, "").to_pylist(), ends - counts, ends, strict=True):
                        first, last = char_spans(text, lengths[ids[lo:hi]]) if hi > lo else ([], [])
                        for name, values in (("starts", first), ("ends", last)):
                            if name in columns:
                                columns[name].append(list(map(int, values)))
                types = {"ids": pa.list_(pa.int32()), "starts": pa.list_(pa.int32()), "ends": pa.list_(pa.int32())}
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, types.get(k, pa.string())) for k, c in columns.items()]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["id", *columns])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, ", ".join([f"id {kind}", *[f"{k} {ENCODED[k]}" for k in outputs]]))
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, text, pieces)`` from arrays of ids.

    ``pieces`` has one string per token: the characters that this token
    completes, so a token that ends inside a character gives its part to the
    next one. Bytes that are no UTF-8 read as U+FFFD; null ids give a null text.
    """
    shared = df.sparkSession.sparkContext.broadcast(token_bytes(bpe.load_ranks(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import codecs

        table = shared.value
        for batch in batches:
            texts, pieces = [], []
            for ids in batch.column(1).to_pylist():
                if ids is None:
                    texts.append(None)
                    pieces.append(None)
                    continue
                reader = codecs.getincrementaldecoder("utf-8")(errors="replace")
                own = [reader.decode(table[i], final=k == len(ids) - 1) for k, i in enumerate(ids)]
                texts.append("".join(own))
                pieces.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(pieces, pa.list_(pa.string()))],
                names=["id", "text", "pieces"])

    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string, pieces array<string>").withColumnRenamed("id", id_col)
