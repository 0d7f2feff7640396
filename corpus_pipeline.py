"""The corpus pipeline: five stages over ``documents``, each by one of the llm operators.

Every stage works on all rows its predecessor kept; ``run`` writes each stage's
result as Parquet in the cluster's shared folder and reads it again for the next.

1. language_id: documents whose language cannot be told (no letter, or a score
   below ``LEAST_SCORE``) go.
2. quality_rules: documents that fail the base or the repetition rules go, by the
   limits below.
3. near_duplicates: of each component of linked documents the one with the
   smallest ``doc_id`` stays, one row of it; of a component without any
   ``doc_id`` one row stays. Blank texts are linked with nothing and stay.
4. mix_sources: a document appears as often as the mix takes it, 0 to 2 times:
   its words taken over its size, rounded half up.
5. bpe_round_trip: token counts and digests of every remaining document.

All but the last return the columns of ``documents``; further columns are
dropped. NULLs, empty texts and repeated rows are treated as the operators say;
an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapecraft.llm.bpe import round_trip
from tapecraft.llm.language_id import UNDETERMINED, identify_languages
from tapecraft.llm.mixing import mix_sources
from tapecraft.llm.ngram_join import class_names, near_duplicate_classes
from tapecraft.llm.queries import RANK_FILE
from tapecraft.llm.repetition import repetition_rules
from tapecraft.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.5
#: Shares of a text's word characters in later copies of windows of n words, and in lines equal to an earlier one.
MAX_NGRAM_SHARE = {5: 0.15, 7: 0.13, 10: 0.10}
MAX_LINE_SHARE = 0.20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify_languages(docs, keep=("text", "lang", "source", "n_chars"))
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = repetition_rules(docs, MAX_NGRAM_SHARE, MAX_LINE_SHARE, keep=("text", "lang", "source", "n_chars"))
    return judged.filter("kept").select(*COLUMNS)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    facts, classes = near_duplicate_classes(docs)
    apart = F.col("cls").isNull() & F.col("doc_id").isNotNull()
    first = (facts.join(classes, "cls", "left").filter(apart | (F.col("doc_id") == F.col("component_id")))
             .select("doc_id").distinct())
    kept = docs.select(*COLUMNS).join(first, "doc_id", "left_semi")
    # repeated rows of a doc_id are copies as well: one stays, the same in every run
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text", "lang", "source", "n_chars"))
    kept = kept.withColumn("_r", F.row_number().over(one)).filter("_r = 1").select(*COLUMNS)
    # rows without an id: those that a kept row stands for go, of every other component one stays
    unnamed = class_names(docs.select(*COLUMNS).filter("doc_id IS NULL")).join(classes, "cls", "left")
    others = COLUMNS[1:]
    single = (unnamed.filter("cls IS NOT NULL AND component_id IS NULL").groupBy("root")
              .agg(F.min(F.struct(F.xxhash64(*others).alias("_h"), *others)).alias("row"))
              .select(F.lit(None).cast("long").alias("doc_id"), *(f"row.{c}" for c in others)))
    blank = unnamed.filter("cls IS NULL").select(*COLUMNS)
    return kept.unionByName(single).unionByName(blank)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mix_sources(docs).filter("size > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
        F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("_times")).filter("_times > 0")
    joined = docs.select(*COLUMNS).join(
        taken, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs, RANK_FILE)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", duplicates),
    ("mix_sources", mix),
    ("bpe_round_trip", bpe_round_trip),
]

#: Fitting a classifier and merging byte pairs are no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
