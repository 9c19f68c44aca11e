"""The corpus pipeline: language identification, near-duplicates, secrets, packing.

Each stage reads all that its predecessor kept, as Parquet, and its decisions
take effect: texts that the language models reject go, one document of each
group of near-duplicates stays, secrets are masked in the texts, and the
last stage packs what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import language, secrets
from vitrine.llm.common import may_be_among, scratch_dir, shuffles_freed, stored, table
from vitrine.llm.ngram_join import ngram_join
from vitrine.llm.packing import pack

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SALTS = 64  # tasks that a large group's rows are dealt to
NEAR_WIDTH, NEAR_PERCENT = 5, 80  # near-duplicates: Jaccard of 0.8 or more on five-word shingles


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language model accepts, with the language it names.

    Texts without a letter, and texts that no learned language explains, go.
    """
    # a text goes to the workers once, not in the row as well
    rows = docs.select(F.struct("doc_id", "source", "n_chars").alias("row"), "text")
    model = language.learn(docs, ~language.held_out())
    found = language.identify(rows, model, id_col="row", with_text=True)
    return found.filter(~F.col("rejected")).select(
        "row.doc_id", "text", F.col("lang_pred").alias("lang"), "row.source", "row.n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (null ids last).

    Decisions go by row, that is by id and text, as an id may stand on several texts and may be null. Of rows
    with one id and one text that with the smallest other columns stays. Documents without words belong to no group and stay.
    """
    # two hashes of id and text name a row; the join's own key is the first
    row = [F.struct("doc_id", "text")]
    rows = docs.select(*COLUMNS).withColumns({"key": F.xxhash64(*row), "key2": F.xxhash64(F.lit(1), *row)})
    groups = ngram_join(rows, id_col="key", width=NEAR_WIDTH, percent=NEAR_PERCENT, carried=["key2", "doc_id"])
    groups = stored(groups.filter("n_shingles > 0").select("key", "key2", "doc_id", "component_id"), "pipeline-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "key2")
    # a row alone in its group stays; the rows of a large group meet its first one in several tasks
    first = groups.groupBy("component_id").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "component_id", "f", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    named = groups.groupBy("key", "key2", "component_id").agg(F.count(F.lit(1)).alias("times")).withColumn(
        "salt", F.pmod("key", F.lit(SALTS)).cast("int"))
    # the rows that stay by their key, and how often they are there; most are there once and not in this table
    gone = named.join(first, ["component_id", "salt"]).select(
        "key", "key2", "times", ((F.col("key") == F.col("f.key")) & (F.col("key2") == F.col("f.key2"))).alias("stays"))
    gone = stored(gone.filter(~F.col("stays") | (F.col("times") > 1)), "pipeline-gone")
    # most rows are surely not named there and stay as they are; the others meet the table
    flagged = may_be_among(rows, F.col("key"), gone.select("key"), "named")
    sure = flagged.filter(~F.col("named")).select(*COLUMNS)
    kept = flagged.filter("named").join(gone.filter(~F.col("stays")).select("key", "key2"), ["key", "key2"], "left_anti")
    repeated = gone.filter("stays").select("key", "key2")
    if repeated.isEmpty():
        return sure.unionByName(kept.select(*COLUMNS))
    least = kept.join(repeated, ["key", "key2"], "left_semi").groupBy("key", "key2").agg(
        F.min(F.struct(*COLUMNS)).alias("r"))
    return sure.unionByName(kept.join(repeated, ["key", "key2"], "left_anti").select(*COLUMNS)).unionByName(least.select("r.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret span replaced by a mask."""
    rows = docs.select(*COLUMNS).withColumn("digest", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn(
        "n_chars", F.col("n_chars").cast("bigint"))
    with shuffles_freed(spark):
        scanned = secrets.scan(docs).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "digest"])
        scanned = stored(scanned, "pipeline-secrets")
    # most texts hold no secret and stay as they are, without a shuffle; the others meet their spans
    flagged = may_be_among(rows, F.col("digest"), scanned.select("digest"), "named")
    clean = flagged.filter(~F.col("named")).select(*COLUMNS)
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.digest") == F.col("s.digest"))
    joined = flagged.filter("named").alias("d").join(scanned.alias("s"), same, "left")
    text = F.when(F.col("s.spans").isNull(), F.col("d.text")).otherwise(secrets.redact(F.col("d.text"), F.col("s.spans")))
    return clean.unionByName(joined.select(
        "d.doc_id", text.alias("text"), "d.lang", "d.source",
        F.when(F.col("s.spans").isNull(), F.col("d.n_chars")).otherwise(F.length(text)).cast("bigint").alias("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]
ORACLE_SQL = None  # the models and the tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
