"""WARC archives through a chunked record table (operator 3).

A payload is a run of rows ``(record, chunk_no, chunk, size, digest, last)``: at
most ``CHUNK`` bytes each, with the bytes and the SHA-1 (bare upper-case
base32) of the payload up to and with this chunk. Writing and reading both go through
this table:

1. the last rows of all payloads, without bytes, decide which records are responses and which revisits;
2. the chunk rows, each with the size and digest of its whole payload, are dealt by record together
   with one head row a record, and sorted by chunk number;
3. the writer takes the head, then chunk after chunk, and compresses them into the archive;
   the reader takes chunk after chunk out of it and carries the digest along.

So beyond the source cell no step holds a whole record: shuffle, sort and Python see rows of ``CHUNK`` bytes.

``write_archives`` writes one archive per task (a new one after ``ARCHIVE_BYTES``) into
a shared folder; an archive gets its name only when it is complete, and a
repeated task writes the same bytes again. Each record is a gzip member: a ``response`` with
an HTTP head and the payload, or a ``revisit`` with the head alone that
refers to the response with the same payload digest.

Cases: a null html is an empty payload; of records with equal payloads of at
least ``minimum`` bytes that with the largest id is the response (null ids
count as smallest; rows that repeat this id are all responses), smaller
payloads are all responses; an empty table gives no archive and no rows;
repeated rows are records of their own (those with one id and one payload go to one task, which
streams them); further columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import commit_file, scratch_dir, shuffle_partitions, stored

CHUNK = 1 << 16
ARCHIVE_BYTES = 1 << 28
LEVEL = 3
TASK_BYTES = 1 << 26  # payload bytes that a writing task takes on average, archive bytes that a reading task takes
ARCHIVES_A_TASK, MOST_TASKS = 4, 100_000
CHUNK_SCHEMA = "chunk_no bigint, chunk binary, size bigint, digest string, last boolean"


def base32(state) -> str:
    return base64.b32encode(state.digest()).decode()


def chunks_of(read, chunk: int = CHUNK) -> Iterator[tuple[int, bytes, int, str | None, bool]]:
    """Rows of one payload; ``read(n)`` gives its next at most ``n`` bytes. An empty payload has one
    empty chunk. The digest of a chunk that is not the last is that of the payload up to it."""
    state, size, number, piece = hashlib.sha1(), 0, 0, read(chunk)
    while True:
        state.update(piece)
        size += len(piece)
        after = read(chunk) if piece else b""
        yield number, piece, size, base32(state), not after
        if not after:
            return
        number, piece = number + 1, after


def reader_of(data) -> object:
    """``read(n)`` over a buffer, without copying more than the chunk."""
    view, at = memoryview(data), 0

    def read(n: int) -> bytes:
        nonlocal at
        piece = bytes(view[at : at + n])
        at += len(piece)
        return piece

    return read


def chunk_table(df: DataFrame, id_col: str = "page_id", payload_col: str = "html", with_chunks: bool = True,
                last_only: bool = False) -> DataFrame:
    """``(id_col, chunk_no, chunk, size, digest, last)``: the payloads as chunk rows;
    ``with_chunks=False`` leaves the bytes out, ``last_only`` keeps the last row of each payload."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [None, pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
        names = ["id", "chunk_no", "chunk", "size", "digest", "last"]

        def table(found: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            ids, payloads = batch.column(0).to_pylist(), batch.column(1)
            found: list[tuple] = []
            held = 0
            for i, key in enumerate(ids):
                for number, piece, size, digest, last in chunks_of(reader_of(payloads[i].as_buffer())):
                    if last or not last_only:
                        found.append((key, number, piece if with_chunks else None, size, digest, last))
                        held += len(piece) * with_chunks + 100
                    if held > 1 << 23:
                        yield table(found, id_type)
                        found, held = [], 0
            if found:
                yield table(found, id_type)

    return rows.mapInArrow(run, f"id {kind}, {CHUNK_SCHEMA}").withColumnRenamed("id", id_col)


def record_chunks(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """The chunk rows of all records for the writer: ``(id, total, payload, row, chunk_no, url, chunk)``.

    ``total`` and ``payload`` are the size and digest of the whole payload, ``row`` is the number of the source row; the url stands on the
    first chunk. The running digest of the last chunk must be the payload's."""
    rows = df.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["id", "total", "payload", "row", "chunk_no", "url", "chunk"]

        def table(found: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            ids, numbers, urls, payloads = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)
            found: list[tuple] = []
            held = 0
            for i, (key, row) in enumerate(zip(ids, numbers, strict=True)):
                cell = payloads[i].as_buffer()
                total, payload = cell.size, base32(hashlib.sha1(cell))
                for number, piece, _, digest, last in chunks_of(reader_of(cell)):
                    if last and digest != payload:
                        raise ValueError(f"the chunks of {key} are not its payload")
                    found.append((key, total, payload, row, number, urls[i].as_py() if number == 0 else None, piece))
                    held += len(piece) + 200
                    if held > 1 << 23:
                        yield table(found, id_type)
                        found, held = [], 0
            if found:
                yield table(found, id_type)

    return rows.mapInArrow(run, f"id {kind}, total bigint, payload string, row bigint, chunk_no bigint, url string, chunk binary")


def dealt_records(chunks: DataFrame, decisions: DataFrame, tasks: int) -> DataFrame:
    """Chunk rows and one head row a record key (``row`` and ``chunk_no`` -1), dealt by record and in order."""
    key = ["id", "total", "payload"]
    heads = decisions.select(
        *key, F.lit(-1).cast("bigint").alias("row"), F.lit(-1).cast("bigint").alias("chunk_no"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("chunk"), "record_type", "refers_to")
    every = chunks.unionByName(heads, allowMissingColumns=True)
    return every.repartition(tasks, *key).sortWithinPartitions(*key, "row", "chunk_no")


def decide(digests: DataFrame, id_col: str = "page_id", minimum: int = 0) -> DataFrame:
    """``(id_col, size, digest, record_type, refers_to)`` from the last chunk rows."""
    large = F.col("size") >= minimum
    latest = digests.filter(large).groupBy("digest", "size").agg(F.max(id_col).alias("latest"))
    joined = digests.join(latest, ["digest", "size"], "left")
    revisit = F.coalesce(large & ~F.col(id_col).eqNullSafe(F.col("latest")), F.lit(False))
    return joined.select(
        id_col, "size", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("latest")).alias("refers_to"))


def record_head(key, url: str | None, kind: str, size: int, digest: str, refers_to) -> bytes:
    """WARC head and HTTP head of one record; what follows is the payload of a response."""
    clean = (url or "").replace("\r", "").replace("\n", "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = len(http) + (size if kind == "response" else 0)
    name = lambda k: "null" if k is None else k
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name(key)}>", f"WARC-Target-URI: {clean}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {block}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{name(refers_to)}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``dealt_records`` as WARC records below ``folder``, chunk by chunk; the (lazy) rows name the
    archives: ``(archive, records, bytes)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, part, records, number, done = None, "", "", 0, 0, []
        member, kind, refers = None, "", None

        def end_record() -> None:
            nonlocal member
            if member is not None:
                out.write(member.compress(b"\r\n\r\n"))
                out.write(member.flush())
                member = None

        def close() -> None:
            nonlocal out
            end_record()
            if out is not None:
                size = out.tell()
                out.close()
                commit_file(store, part, f"{root}/{name}")
                done.append((name, records, size))
                out = None

        for batch in batches:
            keys, totals, payloads, _, places, urls, chunks, kinds, refers_to = (batch.column(i) for i in range(9))
            for i, place in enumerate(places.to_pylist()):
                if place < 0:
                    kind, refers = kinds[i].as_py(), refers_to[i].as_py()
                    continue
                if place == 0:
                    end_record()
                    if out is not None and out.tell() >= ARCHIVE_BYTES:
                        close()
                    if out is None:
                        name = f"part-{task.partitionId():06d}-{number:04d}.warc.gz"
                        part = f"{root}/.{name}.{task.taskAttemptId()}"
                        out, records, number = store.open_output_stream(part, compression=None), 0, number + 1
                    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # each record is a gzip member of its own
                    out.write(member.compress(record_head(
                        keys[i].as_py(), urls[i].as_py(), kind, totals[i].as_py(), payloads[i].as_py(), refers)))
                    records += 1
                if kind == "response":
                    out.write(member.compress(chunks[i].as_buffer()))
        close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["archive", "records", "bytes"])

    return rows.select("id", "total", "payload", "row", "chunk_no", "url", "chunk", "record_type", "refers_to").mapInArrow(
        run, "archive string, records bigint, bytes bigint")


def read_heads(stream) -> dict[str, str] | None:
    """Header lines up to the empty line; None at the end of the stream."""
    out: dict[str, str] = {}
    first = True
    while True:
        line = stream.readline()
        if not line:
            return None if first else out
        text = line.decode("utf-8").rstrip("\r\n")
        if not text:
            if first:
                continue  # the empty lines between records
            return out
        first = False
        key, _, value = text.partition(":")
        out[key.strip().lower()] = value.strip()


def read_archives(archives: DataFrame, folder: str, id_type: str = "bigint", with_chunks: bool = True,
                  last_only: bool = False) -> DataFrame:
    """Chunk rows of all records of ``archives`` (archive, bytes): ``record, url, record_type, refers_to,
    payload_bytes`` (of the HTTP head), ``header_digest`` and the chunk columns. A revisit has one
    row with a null chunk and the digest of its header."""
    names = ["record", "url", "record_type", "refers_to", "payload_bytes", "header_digest",
             "chunk_no", "chunk", "size", "digest", "last"]
    schema = f"record string, url string, record_type string, refers_to string, payload_bytes bigint, header_digest string, {CHUNK_SCHEMA}"
    types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        found: list[tuple] = []
        held = 0

        def table() -> pa.RecordBatch:
            nonlocal found, held
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)
            found, held = [], 0
            return out

        bare = lambda x: x.removeprefix("<urn:page:").removesuffix(">") if x else None
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{archive}", compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) as stream:
                    while (head := read_heads(stream)) is not None:
                        http = read_heads(stream)
                        size = int(http["content-length"])
                        kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
                        own = (bare(head["warc-record-id"]), head["warc-target-uri"], kind, bare(head.get("warc-refers-to")), size, digest)
                        if kind == "revisit":
                            found.append((*own, 0, None, size, digest, True))
                            held += 200
                        else:
                            left = size

                            def read(n: int) -> bytes:
                                nonlocal left
                                piece = stream.read(min(n, left))
                                left -= len(piece)
                                return piece

                            for number, piece, at, sofar, last in chunks_of(read):
                                if last and sofar != digest:
                                    raise ValueError(f"{archive}: payload of {own[0]} doesn't match its digest")
                                if last or not last_only:
                                    found.append((*own, number, piece if with_chunks else None, at, sofar, last))
                                    held += len(piece) * with_chunks + 200
                                if held > 1 << 23:
                                    yield table()
        if found:
            yield table()

    # names of a few bytes stand for megabytes: a number of tasks by what is listed, which the session doesn't fold together
    listed = archives.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = min(MOST_TASKS, max(1, -(-listed["n"] // ARCHIVES_A_TASK), -(-listed["bytes"] // TASK_BYTES)))
    out = archives.select("archive").repartition(tasks, "archive").mapInArrow(run, schema)
    for c in ("record", "refers_to"):
        out = out.withColumn(c, F.expr(f"try_cast({c} AS {id_type})"))
    return out


def archive_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                       minimum: int = 0) -> DataFrame:
    """Write all rows as WARC records, read the archives back and tell what they hold."""
    spark = df.sparkSession
    folder = scratch_dir(spark, "warc")
    digests = chunk_table(df, id_col, payload_col, with_chunks=False, last_only=True).select(id_col, "size", "digest")
    decisions = decide(digests, id_col, minimum).distinct()
    decisions = stored(decisions.withColumnsRenamed({id_col: "id", "size": "total", "digest": "payload"}), "warc-records")
    held = decisions.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    tasks = max(shuffle_partitions(spark), -(-held // TASK_BYTES))
    dealt = dealt_records(record_chunks(df, id_col, url_col, payload_col), decisions, tasks)
    written = write_archives(dealt, f"{folder}/archives")
    archives = stored(written, "warc-archives")
    kind = df.schema[id_col].dataType.simpleString()
    back = read_archives(archives, f"{folder}/archives", kind, with_chunks=False, last_only=True)
    return back.select(
        F.col("record").alias(id_col), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")

