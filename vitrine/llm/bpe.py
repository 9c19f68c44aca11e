"""Byte-pair encoding with the ``tokenizers`` library over Arrow batches.

Both tokenizers of the operators work the same way: a text falls into pieces
that are encoded independently of each other, and most pieces repeat. A
batch is cut into chunks at places that no piece spans, the distinct chunks
are cut into pieces, and each distinct piece is encoded once; the ids of the
documents are then put together with array operations. A memo of encoded
pieces, bounded in entries and in the length of a piece, lives in the Python worker.

Bytes reach the model as one printable character each (the byte table of
byte-level vocabularies); decoding reverses the table.
"""

from __future__ import annotations

import base64
import codecs
import json
import os
import unicodedata
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vitrine.llm.common import give_back, worker_cache

MEMO_ENTRIES, MEMO_LENGTH = 400_000, 64
SLICE_BYTES = 4 << 20


def byte_table() -> list[str]:
    """Character of each byte: printable Latin-1 bytes stand for themselves,
    the others follow in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in chars:
            chars[b] = chr(0x100 + extra)
            extra += 1
    return [chars[b] for b in range(256)]


BYTE_TABLE = byte_table()
BYTE_CHARS = "".join(BYTE_TABLE)
TABLE_TO_BYTE = {c: b for b, c in enumerate(BYTE_TABLE)}


def to_byte_chars(text: str) -> str:
    return codecs.charmap_decode(text.encode(), "strict", BYTE_CHARS)[0]


def from_byte_chars(chars: str) -> bytes:
    return bytes(map(TABLE_TO_BYTE.__getitem__, chars))


def slices(texts: pa.Array, most: int = SLICE_BYTES):
    """Row ranges of about ``most`` bytes of text each (a longer text stands alone)."""
    n = len(texts)
    if n == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield start, stop
        start = stop
    give_back()


def take_ranges(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[s : s + n]`` over all (s, n)."""
    total = int(lengths.sum())
    if total == 0:
        return values[:0]
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(total)]


def remember(memo: dict[str, bytes], own: dict[str, bytes]) -> None:
    """Keep what a batch has used in the memo, but for long keys. A memo that would grow beyond its
    bound forgets the rest, and takes no more than the bound."""
    short = [(k, v) for k, v in own.items() if len(k) <= MEMO_LENGTH]
    if len(memo) + len(short) > MEMO_ENTRIES:
        memo.clear()
    memo.update(short[:MEMO_ENTRIES])


class PieceEncoder:
    """ids (as uint32 bytes) of chunks of text; a chunk is a run of pieces, and each piece is
    encoded alone by a ``tokenizers`` model. Both are remembered per worker."""

    def __init__(self, spec: str, key: str):
        cache = worker_cache()
        if ("model", key) not in cache:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            cache["model", key] = Tokenizer.from_str(spec)
            cache["ends", key] = word_ends(spec)
        self.model, self.ends = cache["model", key], cache["ends", key]
        self.pieces: dict[str, bytes] = cache.setdefault(("pieces", key), {})
        self.chunks: dict[str, bytes] = cache.setdefault(("chunks", key), {})

    def known(self, memo: dict[str, bytes], wanted: list[str], make) -> dict[str, bytes]:
        """Ids of the distinct ``wanted``: from the memo, or from ``make(fresh)``."""
        own = {x: memo[x] for x in wanted if x in memo}
        fresh = [x for x in wanted if x not in own]
        if fresh:
            new = dict(zip(fresh, make(fresh), strict=True))
            remember(memo, new)
            own.update(new)
        return own

    def piece_ids(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces."""
        def make(fresh: list[str]) -> list[bytes]:
            parts = [fresh[i : i + 10_000] for i in range(0, len(fresh), 10_000)]
            return list(chain.from_iterable(self.encode_pieces([to_byte_chars(p) for p in part]) for part in parts))

        return self.known(self.pieces, pieces, make)

    def encode(self, chunks: list[str], cut) -> list[bytes]:
        """ids of each of the distinct ``chunks``; ``cut`` gives the pieces of one."""
        def make(fresh: list[str]) -> list[bytes]:
            split = [cut(c) for c in fresh]
            own = self.piece_ids(list(dict.fromkeys(chain.from_iterable(split))))
            return [own[ps[0]] if len(ps) == 1 else b"".join([own[p] for p in ps]) for ps in split]

        own = self.known(self.chunks, chunks, make)
        return [own[c] for c in chunks]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """ids of pieces in byte characters. Where word ends are marked, many pieces
        go as one text with blanks between, and the marks part their ids again."""
        if self.ends is not None:
            found = self.model.encode_batch_fast(
                [" ".join(pieces[i : i + 1000]) for i in range(0, len(pieces), 1000)], add_special_tokens=False)
            ids = np.array(list(chain.from_iterable(e.ids for e in found)), dtype="<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) == len(pieces):
                raw = ids.tobytes()
                return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
        done = self.model.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in done]

    def run(self, pieces: list[str]) -> bytes:
        """ids of a run of pieces, each of which is a chunk of its own."""
        distinct = list(dict.fromkeys(pieces))
        own = dict(zip(distinct, self.encode(distinct, lambda p: [p]), strict=True))
        return b"".join([own[p] for p in pieces])


def word_ends(spec: str) -> np.ndarray | None:
    """For each id: does its token end a word? None if the vocabulary marks no word ends."""
    model = json.loads(spec)["model"]
    suffix = model["end_of_word_suffix"]
    if not suffix:
        return None
    flags = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
    flags[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
    return flags


def word_spec(path: str) -> str:
    """The vocabulary of words with word ends, as a model over byte characters between blanks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
    return json.dumps({**spec, **plain})


# The split pattern of the word vocabulary (white space parts pieces and is dropped), and white space.
SPACES = r"\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\x09-\x0D\x20" + SPACES + r"\p{L}\p{N}]+"


class WordEncoder:
    """Texts -> ids of the lower-casing word vocabulary.

    The tokenizer composes characters, lower-cases, drops white space and
    encodes each match of its pattern alone; no match spans white space, so
    the distinct white-space chunks of a batch are cut into pieces by Arrow, all at once.

    With ``added`` a text that holds one of the vocabulary's added tokens is encoded by the unmodified
    tokenizer, which gives such a token its own id; otherwise it is text like any other.
    """

    def __init__(self, path: str, added: bool = False):
        cache = worker_cache()
        if ("spec", path) not in cache:
            cache["spec", path] = word_spec(path)
            with open(path, encoding="utf-8") as f:
                cache["added", path] = [t["content"] for t in json.load(f)["added_tokens"]]
        self.path = path
        self.pieces = PieceEncoder(cache["spec", path], path)
        self.added = cache["added", path] if added else []

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all the distinct chunks, and the number of ids of each."""
        if not pc.all(pc.string_is_ascii(chunks), min_count=0).as_py():
            text = "\n".join(chunks.to_pylist())  # a chunk holds no line end
            if not unicodedata.is_normalized("NFC", text):
                chunks = pa.array(unicodedata.normalize("NFC", text).split("\n"), chunks.type)
            chunks = pc.replace_substring(chunks, "\u0130", "i\u0307")  # the one letter whose lower case is two
            chunks = pc.replace_substring_regex(chunks, f"[{SPACES}]+", " ")
        spaced = pc.replace_substring_regex(pc.utf8_lower(chunks), WORD_PATTERN, r"\0 ")
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(spaced))
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        own = self.pieces.piece_ids([p for p in pieces if p])
        own[""] = b""
        parts = [own[p] for p in pieces]
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), dtype="<u4")
        codes = np.asarray(coded.indices, dtype=np.int64)
        each = sizes[codes]
        ids = take_ranges(flat, (np.cumsum(sizes) - sizes)[codes], each)
        ends = np.concatenate([[0], np.cumsum(each)])
        last = np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))
        first = np.concatenate([[0], last[:-1]])
        return ids, ends[last] - ends[first]

    def whole(self) -> object:
        """The unmodified tokenizer."""
        cache = worker_cache()
        if ("whole", self.path) not in cache:
            from tokenizers import Tokenizer

            cache["whole", self.path] = Tokenizer.from_file(self.path)
        return cache["whole", self.path]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts (uint32) and the number of ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        odd = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            odd |= np.asarray(pc.match_substring(texts, token))
        rows = np.flatnonzero(odd)
        if not len(rows):
            return self.encode_plain(texts)
        ids, counts = self.encode_plain(pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts))
        own = [array("I", self.whole().encode(texts[int(i)].as_py(), add_special_tokens=False).ids) for i in rows]
        ends = np.cumsum(counts)
        parts, done = [], 0
        for i, found in zip(rows.tolist(), own, strict=True):
            parts += [ids[done : ends[i]], np.frombuffer(found, dtype="<u4")]
            counts[i], done = len(found), ends[i]
        return np.concatenate([*parts, ids[done:]]), counts

    def encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.ascii_split_whitespace(texts)
        counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = np.asarray(coded.indices, dtype=np.int64)
        flat, sizes = self.chunk_ids(coded.dictionary)
        each = sizes[codes]
        ids = take_ranges(flat, (np.cumsum(sizes) - sizes)[codes], each)
        ends = np.concatenate([[0], np.cumsum(each)])
        last = np.cumsum(counts)
        return ids, ends[last] - ends[last - counts]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_spec(ranks: dict[bytes, int]) -> str:
    """A ``tokenizers`` BPE model from a rank file.

    The pair that makes a token is found by merging its bytes with lower
    ranks only; a piece that is itself a token stays whole.
    """

    def parts_of(token: bytes, limit: int) -> list[bytes]:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], limit))
            if ranks.get(parts[best] + parts[best + 1], limit) >= limit:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    chars = {t: "".join(BYTE_TABLE[b] for b in t) for t in ranks}
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1:
            parts = parts_of(token, rank)
            if len(parts) == 2:
                merges.append([chars[parts[0]], chars[parts[1]]])
    model = {
        "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
        "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
        "vocab": {chars[t]: r for t, r in ranks.items()}, "merges": merges,
    }
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": None, "post_processor": None, "decoder": None, "model": model,
    })


class ByteEncoder:
    """Texts -> ids of a byte-level rank file, each match of ``pattern`` alone.

    A text is cut before every space. The cut is a piece boundary exactly
    when the space ends its run of white space, that is when the next chunk
    starts with a visible character; texts with other cuts go through the
    pattern as a whole.
    """

    def __init__(self, spec: str, key: str, pattern: str):
        import regex

        self.pieces = PieceEncoder(spec, key)
        self.find = regex.compile(pattern).findall

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts (uint32) and the number of ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = np.asarray(coded.indices, dtype=np.int64)
        last = np.cumsum(counts)
        first = last - counts
        chunks = coded.dictionary.to_pylist()
        bad = np.fromiter((not c or c[0].isspace() for c in chunks), dtype=bool, count=len(chunks))
        odd = bad[codes] if len(chunks) else np.zeros(0, bool)
        odd[first] = False
        slow = np.add.reduceat(odd, first) > 0 if len(first) else np.zeros(0, bool)
        # a chunk is cut once with and once without its space (the first of a text)
        keys = codes * 2 + 1
        keys[first] -= 1
        slow_rows = np.flatnonzero(slow)
        if len(slow_rows):
            keep = ~np.repeat(slow, counts)
            keys = keys[keep]
        used, keys = np.unique(keys, return_inverse=True)
        parts = self.pieces.encode([(" " if k & 1 else "") + chunks[k >> 1] for k in used.tolist()], self.find)
        for i in slow_rows:  # as a run of its white-space chunks and the pieces between
            parts.append(self.pieces.run(self.find(texts[int(i)].as_py())))
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), dtype="<u4")
        starts = np.cumsum(sizes) - sizes
        counts = np.where(slow, 1, counts)
        order = np.empty(int(counts.sum()), dtype=np.int64)
        last = np.cumsum(counts)
        mask = np.repeat(slow, counts)
        order[~mask] = keys
        order[mask] = len(used) + np.arange(len(slow_rows))
        each = sizes[order]
        ids = take_ranges(flat, starts[order], each)
        ends = np.concatenate([[0], np.cumsum(each)])
        return ids, ends[last] - ends[last - counts]
