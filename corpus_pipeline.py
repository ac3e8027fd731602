"""Documents from raw to token ids, stage by stage.

Each stage takes every document its predecessor kept, is written as Parquet, and is read again
as the next stage's input. All but the last return the columns of ``documents``.

1. ``quality``: documents that the weakly trained classifier takes for junk or insults go.
2. ``near_duplicates``: documents whose distinct five-word shingles have a Jaccard similarity of 0.8
   or more are linked, found by SimHash signatures and by MinHash bands and verified pair by pair; of every component one row stays, that of the
   smallest id, and one without an id only if none has an id. Rows of one id are kept apart as
   their texts are.
3. ``decontamination``: documents that hold a benchmark item go.
4. ``secrets``: secrets that are no widely copied examples are replaced in the text, whose
   length is counted anew. No document goes.
5. ``encoding``: every text becomes token ids, which decode to the text.

Empty tables pass through; null texts count as empty and are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bpe_trie, bytelevel, decontamination, quality, secrets, simhash
from orderloom.llm.common import table
from orderloom.session import materialize, scratch_path

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, _ = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.filter_rows(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Ids may be null or repeated: every row gets a key of its own, which is written so that it stays.
    key = "_key" + "_" * max(map(len, docs.columns))  # longer than any column's name
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed-documents")
    found = simhash.near_duplicates(keyed, key, wide=True).select(key, "component_id")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", key)
    first = keyed.select("doc_id", key).join(found, key).groupBy("component_id").agg(F.min(row).alias("first"))
    return keyed.join(first.select(f"first.{key}"), key, "left_semi").drop(key)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    changed = F.col("text").contains("[REDACTED]")
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The stages before leave the executors less memory than a job of its own would have.
    return bpe_trie.encode(docs, bytelevel.vocabulary_path(), memory_words=200_000)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
