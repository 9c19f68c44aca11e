"""Token counts of flat token files by a separator scan (operator 6).

A token file is nothing but little-endian unsigned 16-bit ids; an
end-of-document id follows each document. There is no index. The scan reads
blocks of a fixed number of ids, finds the separators of a block with one
vectorised comparison, and stitches the documents that cross block borders
with a prefix scan over the blocks: the first document of a block starts
after the last separator in any block before it. The scan has two levels
(blocks within a group of blocks, then groups), so that no file, however
large, puts all its blocks into one task.

Cases: a null text is an empty document (0 tokens); an empty file or table
gives no rows; a last document without separator is counted and flagged;
documents longer than a block just cross several borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm import bpe
from vitrine.llm.common import commit_file, scratch_dir

BLOCK_IDS = 1 << 22
GROUP_BLOCKS = 1024
BLOCKS_A_TASK, MOST_TASKS = 4, 100_000
SEPARATOR = 49407  # end-of-text id of the word vocabulary; ordinary text never gives it


def write_token_files(
    df: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    separator: int = SEPARATOR,
) -> DataFrame:
    """Write one token file per task into the shared ``folder``; the (lazy) rows
    say which document stands where: ``id_col``, ``file``, ``doc_no``.

    A file gets its name only when it is complete, and a repeated task
    writes the same bytes under the same name.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"tokens-{task.partitionId():06d}.u16"
        part = f"{root}/.{name}.{task.taskAttemptId()}"
        encoder, number = bpe.WordEncoder(vocabulary), 0
        with store.open_output_stream(part) as out:
            for batch in batches:
                for a, b in bpe.slices(batch.column(1)):
                    piece = batch.slice(a, b - a)
                    ids, counts = encoder.encode(piece.column(1))
                    flat = np.full(len(ids) + len(counts), separator, dtype="<u2")
                    keep = np.ones(len(flat), dtype=bool)
                    keep[np.cumsum(counts + 1) - 1] = False
                    flat[keep] = ids
                    out.write(flat.tobytes())
                    numbers = pa.array(np.arange(number, number + len(counts)), pa.int64())
                    number += len(counts)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0), pa.array([name] * len(counts), pa.string()), numbers],
                        names=["id", "file", "doc_no"])
        commit_file(store, part, f"{root}/{name}")

    return rows.mapInArrow(run, f"id {kind}, file string, doc_no bigint").withColumnRenamed("id", id_col)


def list_blocks(spark, folder: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``(file, block, total)``: a row per block of every token file; ``total`` is the file's ids."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(s.getPath().getName(), s.getLen() // 2) for s in store.listStatus(path)] if store.exists(path) else []
    files = spark.createDataFrame(
        [x for x in found if x[0].endswith(".u16") and x[1]], "file string, total bigint")
    last = F.floor((F.col("total") - 1) / block_ids)
    return files.select("file", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"), "total")


def scan_blocks(blocks: DataFrame, folder: str, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``(file, block, ends, total)``: positions of the separators in each block, in ids
    from the file's start. The last block also holds the end of a last document
    that has no separator."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, block, total in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first = block * block_ids
                size = min(block_ids, total - first)
                with store.open_input_file(f"{root}/{file}") as f:
                    ids = np.frombuffer(f.read_at(2 * size, 2 * first), dtype="<u2")
                ends = np.flatnonzero(ids == separator) + first
                if first + size == total and ids[-1] != separator:
                    ends = np.append(ends, total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64())),
                     pa.array([total], pa.int64())], names=["file", "block", "ends", "total"])

    # rows of a few bytes stand for megabytes: a number of tasks by the blocks listed, which the session doesn't fold together
    tasks = min(MOST_TASKS, max(1, -(-blocks.count() // BLOCKS_A_TASK)))
    dealt = blocks.select("file", "block", "total").repartition(tasks, "file", "block")
    return dealt.mapInArrow(run, "file string, block bigint, ends array<bigint>, total bigint")


def count_tokens(scanned: DataFrame) -> DataFrame:
    """``(file, doc_no, start, n_tokens, terminated)`` of every document of the scanned files."""
    rows = scanned.select(
        "*", F.floor(F.col("block") / GROUP_BLOCKS).alias("grp"), F.size("ends").cast("bigint").alias("n"),
        F.try_element_at("ends", F.lit(-1)).alias("last"))
    inner = Window.partitionBy("file", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy("file", "grp").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "file", "grp",
        F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max("last").over(outer), F.lit(-1)).alias("end_before"))
    stitched = rows.select(
        "file", "grp", "ends", "total",
        F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("docs_here"),
        F.max("last").over(inner).alias("end_here"),
    ).join(groups, ["file", "grp"])
    first = F.coalesce("end_here", "end_before")
    docs = stitched.select(
        "file", "total", "ends", first.alias("before"), (F.col("docs_before") + F.col("docs_here")).alias("number"),
        F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("before")).otherwise(F.try_element_at("ends", F.col("k"))) + 1
    return docs.select(
        "file", (F.col("number") + F.col("k")).alias("doc_no"), start.alias("start"),
        (F.col("end") - start).alias("n_tokens"), (F.col("end") < F.col("total")).alias("terminated"))


def document_tokens(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens)`` by way of token files in the shared folder and their scan."""
    spark = df.sparkSession
    folder = scratch_dir(spark, "tokens")
    places = f"{folder}/places"
    written = write_token_files(df, f"{folder}/files", vocabulary, id_col, text_col)
    written.write.parquet(places)
    counted = count_tokens(scan_blocks(list_blocks(spark, f"{folder}/files"), f"{folder}/files"))
    return spark.read.schema(written.schema).parquet(places).join(counted, ["file", "doc_no"]).select(id_col, "n_tokens")
