"""The corpus pipeline: stages that each take and return the documents table.

1. quality: documents that the quality classifier rejects go.
2. near_duplicates: of each group of near-duplicate documents the first stays.
3. pii: personal data in the texts is replaced by its kind in brackets.
4. mixing: documents are repeated or left out so that sources reach their target weights.
5. packing: all documents' tokens in sequences of at most 4096.

Defined results: a stage that finds an empty table returns one. The mix tells repeats of a document
apart by nothing but their row, as they are the same document taken again. A document without text is
scored like any other and, if it stays, is packed as its end token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.llm import jaccard, mixing, packing, pii, quality_fm
from rxlake.llm.queries import QUALITY_CUT, tokenizer_path
from rxlake.sources.scratch import scratch_path, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
COPIES_AT_ONCE = 500


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least the cut, by a model of the labelled ones among them."""
    model = quality_fm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_fm.score(docs.select(*COLUMNS), model, out="_score")
    return scored.filter(F.col("_score") >= QUALITY_CUT).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group, of equal ids the one of the smallest text hash.

    A document is told by id and text, so others of its id are judged by their own texts. A NULL id
    comes last. Rows equal in id and text become one. Rows without words stand for themselves and
    stay, without an id also if they are equal.
    """
    docs = docs.select(*COLUMNS).withColumn("_hash", F.xxhash64("text"))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("_hash").alias("hash"))
    keyed = docs.select(F.when(F.col("_hash").isNotNull(), key).alias("doc_id"), "text")  # nullable, as the join has rows without a key
    groups = stored(jaccard.near_duplicates(keyed), "groups")
    first = F.col("component_id").eqNullSafe(F.col("doc_id"))

    def named(keys: DataFrame) -> DataFrame:
        return keys.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.hash").alias("_text"))

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text"))
    kept = docs.join(named(groups.filter(~first).select("doc_id").distinct()), same, "left_anti")
    repeated = groups.filter(first & (~F.col("doc_id.no_id") | (F.col("n_shingles") > 0)))
    repeated = stored(named(repeated.groupBy("doc_id").count().filter("count > 1")), "repeated")
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    again = kept.join(repeated, same, "left_semi").select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").select(*COLUMNS).unionByName(again)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced in their texts."""
    clean = pii.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    The mix sees sizes only. Rows are told by id and a hash of all columns; rows equal in these are the same
    document, so one of them stands for the copies of all. Texts are shuffled once, to meet their copies.
    """
    docs = docs.select(*COLUMNS).withColumn("_hash", F.xxhash64(*COLUMNS))
    taken = mixing.mix_sources(docs.select("doc_id", "text", "source", "_hash"), keep=["doc_id", "_hash"])
    taken = taken.groupBy(F.col("doc_id").alias("_id"), F.col("_hash").alias("_row"))
    taken = stored(taken.agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")), "copies")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_row"))

    def times(rows: DataFrame, many: Column) -> DataFrame:
        return rows.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), many)))

    once = taken.filter("_copies > 0 AND _rows = 1")
    out = times(docs.join(once.hint("shuffle_hash"), same), F.col("_copies")).select(*COLUMNS)
    several = taken.filter("_copies > 0 AND _rows > 1")
    if several.isEmpty():
        return out
    # Copies of a row that many equal ones stand behind are made by many tasks, some hundred each.
    first = docs.join(several, same).dropDuplicates(["_id", "_row"])
    parts = times(first, F.ceil(F.col("_copies") / COPIES_AT_ONCE)).repartition("_id", "_row", "_time")
    left = F.least(F.lit(COPIES_AT_ONCE), F.col("_copies") - (F.col("_time") - 1) * COPIES_AT_ONCE)
    return out.unionByName(times(parts, left.cast("long")).select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of training sequences."""
    return packing.pack(docs, tokenizer_path)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

# A fitted classifier, the landing of a sampling and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a folder, each one's rows stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
