"""Homomorphic multiset fingerprints of documents (operator 7), DataFrame functions only.

Every paragraph (line) is hashed to a wide vector and the fingerprint of a
document is the sum of its paragraphs' vectors, lane by lane, modulo a power
of two. The order of the paragraphs does not matter, and a paragraph can be
added to or taken from a fingerprint without the rest of the text
(``combine``). The vector has three parts:

* one lane modulo 2^32 that counts the blocks (at most ``BLOCK_WORDS`` words
  of a paragraph in a row),
* ``EQUAL`` lanes modulo 2^32 of hashes of the whole paragraph, which tell
  different multisets of paragraphs apart,
* ``LANES`` lanes modulo 2^32 that count for each bit of a 128-bit block hash
  in how many blocks it is set. Twice such a lane less the block count is a sum of
  signs, so the cosine of two documents' lanes estimates the cosine of their
  multisets of blocks, with an error of about 1 / sqrt(LANES).

A fingerprint is the lanes in hexadecimal.

Cases: a null text counts as empty, and an empty text has one empty
paragraph; equal texts have equal fingerprints, also in repeated rows; rows
with one id follow each other in the order of their texts; a null id comes
first; an only document is its own next one; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import shuffle_partitions, text_or_empty

BLOCK_WORDS = 8
EQUAL, LANES = 8, 128
SPREAD = 0x0000000100000001  # one lane in each half of a long
WIDTHS = [8] * (1 + EQUAL + LANES)


def _lane_sums(paragraph: str, block: str, first: str) -> dict[str, Column]:
    """The sums over exploded blocks that hold all lanes of a fingerprint."""
    sums = {"n": F.count(F.lit(1))}
    for k in range(EQUAL // 2):
        h = F.when(F.col(first), F.xxhash64(F.lit(k), paragraph)).otherwise(F.lit(0).cast("bigint"))
        sums[f"e{2 * k}"] = F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))
        sums[f"e{2 * k + 1}"] = F.sum(F.shiftrightunsigned(h, 32))
    for k in range(LANES // 64):
        h = F.xxhash64(F.lit(1000 + k), block)
        for i in range(32):
            sums[f"s{32 * k + i}"] = F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(SPREAD)))
    return sums


def _lanes() -> Column:
    """Array of all lanes from the sums: count, equality lanes, then bit counts."""
    low, high = F.lit(0xFFFFFFFF), 1 << 32
    equal = [F.col(f"e{k}") % F.lit(high) for k in range(EQUAL)]
    bits = []
    for k in range(LANES // 64):
        bits += [F.col(f"s{32 * k + i}").bitwiseAND(low) for i in range(32)]
        bits += [F.shiftrightunsigned(F.col(f"s{32 * k + i}"), 32) for i in range(32)]
    return F.array(F.col("n") % F.lit(high), *equal, *bits)


def to_text(lanes: Column) -> Column:
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def to_lanes(text: Column) -> Column:
    """The lanes of a fingerprint text."""
    starts, at = [], 1
    for w in WIDTHS:
        starts.append((at, w))
        at += w
    return F.array(*[F.conv(F.substring(text, a, w), 16, 10).cast("bigint") for a, w in starts])


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint text of the multiset sum (``sign=1``) or difference (-1) of two fingerprints."""
    summed = F.zip_with(to_lanes(a), to_lanes(b), lambda x, y: x + sign * y)
    modulus = F.array(*[F.lit(1 << (4 * w)).cast("bigint") for w in WIDTHS])
    return to_text(F.zip_with(summed, modulus, F.pmod))


def signs(lanes: Column) -> Column:
    """Centred bit counts: in how many more blocks a bit is set than not, modulo 2^32 around 0
    (a text of less than 2 GB has fewer than 2^31 blocks, so none wraps)."""
    half = 1 << 31
    return F.transform(
        F.slice(lanes, 2 + EQUAL, LANES),
        lambda x: (F.pmod(2 * x - lanes[0] + F.lit(half), F.lit(2 * half)) - half).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of two documents' multisets of blocks, 0 to 1, from their ``signs``."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    size = F.sqrt(dot(a, a) * dot(b, b))
    found = F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), found))


def fingerprints(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and ``lanes`` of each group's text (one text a key): no shuffle if
    ``df`` is already partitioned by a part of ``keys``."""
    words = rf"(?:[^ ]+ *){{1,{BLOCK_WORDS}}}"
    paragraphs = df.select(*keys, F.explode(F.split(F.col(text_col), "\n", -1)).alias("_paragraph"))
    blocks = paragraphs.select(
        *keys, "_paragraph",
        F.posexplode_outer(F.regexp_extract_all("_paragraph", F.lit(words), 0)).alias("_at", "_block"))
    ready = blocks.select(
        *keys, "_paragraph", (F.coalesce("_at", F.lit(0)) == 0).alias("_first"),
        F.coalesce("_block", F.lit("")).alias("_block"))
    summed = ready.groupBy(*keys).agg(*[v.alias(k) for k, v in _lane_sums("_paragraph", "_block", "_first").items()])
    return summed.select(*keys, _lanes().alias("lanes"))


def with_next_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(range, rn, id, text, next_text)``: each text with that of the next row in the
    order of (id, text); after the last comes the first.

    The ids are cut into ranges by their quantiles; a range is one window partition,
    and only the first row of each range is looked up by the range before it.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    count = 4 * shuffle_partitions(spark)
    marks = rows.approxQuantile("id", [i / count for i in range(1, count)], 0.1 / count)
    marks = sorted({int(m) for m in marks})
    place = F.lit(0)
    if marks:  # number of marks below the id: null ids come first
        edges = F.lit(marks)
        place = F.coalesce(F.size(F.filter(edges, lambda m: m <= F.col("id"))), F.lit(0))
    ordered = Window.partitionBy("range").orderBy("id", "text")
    windowed = rows.withColumn("range", place).select(
        "range", "id", "text", F.row_number().over(ordered).alias("rn"), F.lead("text").over(ordered).alias("lead_text"))
    by_range = Window.orderBy("range")  # one row a range
    firsts = windowed.filter("rn = 1").select("range", "text")
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select(
        "range", F.coalesce(F.lead("text").over(by_range), F.first("text").over(whole)).alias("first_text"))
    return windowed.join(following, "range", "left").select(
        "range", "rn", "id", "text", F.coalesce("lead_text", "first_text").alias("next_text"))


def edited_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts (the last quarter of the code
    points replaced by as many from the start of the next document), and their likeness."""
    quarter = F.floor(F.length("text") / 4).cast("int")
    texts = with_next_text(df, id_col, text_col).withColumn(
        "edited",
        F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"),
                 F.substring(F.col("next_text"), F.lit(1), quarter)))
    both = texts.select(
        "range", "rn", "id", F.length("text").cast("bigint").alias("n_chars"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text").alias("own"), F.lit(None).cast("string").alias("sha")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("own"), F.sha2("edited", 256).alias("sha")),
        )).alias("v"),
    ).select("range", "rn", "id", "n_chars", "v.*")
    lanes = fingerprints(both, ["range", "rn", "id", "n_chars", "kind", "sha"], "own")
    joined = lanes.groupBy("range", "rn", "id", "n_chars").agg(
        F.max("sha").alias("edited_sha256"),
        F.max(F.when(F.col("kind") == 0, F.col("lanes"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("lanes"))).alias("other"))
    ordered = Window.partitionBy("range").orderBy("rn")
    led = joined.withColumn("lead_lanes", F.lead("own").over(ordered))
    by_range = Window.orderBy("range")
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = joined.filter("rn = 1").select(
        "range", F.coalesce(F.lead("own").over(by_range), F.first("own").over(whole)).alias("first_lanes"))
    ready = led.join(following, "range", "left").select(
        "id", "n_chars", "edited_sha256", to_text(F.col("own")).alias("fingerprint"),
        to_text(F.col("other")).alias("edited_fingerprint"),
        signs(F.col("own")).alias("a"), signs(F.col("other")).alias("b"),
        signs(F.coalesce("lead_lanes", "first_lanes")).alias("c"))
    return ready.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.when(F.col("fingerprint") == F.col("edited_fingerprint"), F.lit(1.0))
        .otherwise(likeness(F.col("a"), F.col("b"))).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"))
