"""Terms of texts over Arrow batches, for the search and the toxicity operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# ASCII letters and digits and every byte of a longer character belong to a term; the rest parts terms.
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def plain_texts(texts: pa.Array) -> pa.Array:
    """The texts with A-Z in lower case and a blank in place of each separator; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    if not n:
        return texts
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = memoryview(data)[int(offsets[0]) : int(offsets[-1])].tobytes() if data is not None else b""
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(raw.translate(TABLE)))


def term_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms, the term number of each occurrence in order, and the occurrences a text."""
    lists = pc.ascii_split_whitespace(plain_texts(texts))
    coded = lists.flatten().dictionary_encode()
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    codes = np.asarray(coded.indices, dtype=np.int64)
    empty = pc.index_in(pa.scalar("", coded.dictionary.type), coded.dictionary).as_py()  # around outer blanks
    if empty is not None:
        keep = codes != empty
        before = np.concatenate([[0], np.cumsum(keep)])
        ends = np.cumsum(counts)
        counts = before[ends] - before[ends - counts]
        codes = codes[keep]
    return coded.dictionary, codes, counts


def known_counts(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of the ``vocabulary`` in each text: all terms a text (n), and as runs by text the
    number of each distinct known term, its occurrences, and the runs' lengths."""
    words, codes, counts = term_lists(texts)
    place = pc.fill_null(pc.index_in(words, value_set=vocabulary.cast(words.type)), -1)
    found = np.asarray(place, dtype=np.int64)[codes] if len(codes) else codes
    rows = np.repeat(np.arange(len(counts)), counts)
    known = found >= 0
    keys, tf = np.unique(rows[known] * max(1, len(vocabulary)) + found[known], return_counts=True)
    row, term = np.divmod(keys, max(1, len(vocabulary)))
    return counts, term, tf, np.bincount(row, minlength=len(counts)).astype(np.int64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Runs of ``values`` as a list column."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
