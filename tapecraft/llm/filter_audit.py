"""What each of five filters removes in every order of application, per language.

``filter_masks`` judges each document by all filters at once: five failure bits.
What any order does to a document follows from its mask alone, so a mask has one
big integer (``packed_outcomes``) whose fields hold all 600 step outcomes, 120
orders times 5 steps, of every counter. Documents are counted by part, mask and
labels, partially aggregated, and the integers, times those counts, are summed
per part: at most 2^5 * 4 rows a part. A field has 64 bits and a count fewer, so
sums never reach the next field. ``unpack`` cuts the sums into rows.

A copy (filter E) has the text of a smaller ``doc_id`` anywhere in the table: the
smallest id of each text digest is found by a partially aggregated minimum and
joined back to narrow rows; no text is shuffled.

Cases with a defined result: a NULL or empty text has no words: it fails A, and E
if a smaller id has such a text; a NULL ``lang`` is the part of the empty string;
a NULL ``doc_id`` is smaller than none, larger than none, and has no labels;
repeated rows are counted row by row and are no copies of each other; of repeated
labels an id has those that any row gives it; an empty table has no rows; other
columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.session import scratch_path

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bits of a field; a count of rows is below 2^63.
FIELD = 64
SLOTS = len(ORDERS) * len(FILTERS)

LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3


# --- masks -----------------------------------------------------------------------------------------------------

def text_words(text: Column) -> Column:
    """Maximal runs of characters other than the six separators."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def filter_masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, mask`` of every row; bits 0 to 3 of the mask are the failures of A to D."""
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    counted = read.select(
        "doc_id", "part", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.transform(F.array(text_words(F.col("text"))),
                    lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0].alias("words"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("capitals"), F.char_length("text").alias("chars"),
        F.col("text").rlike("[#$%&*|]").alias("symbols"))
    n, distinct = F.col("words.n").cast("long"), F.col("words.d").cast("long")
    fails = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT_PERCENT * n,
             100 * F.col("capitals").cast("long") > MOST_CAPITALS_PERCENT * F.col("chars").cast("long"), F.col("symbols")]
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    return counted.select("doc_id", "part", "digest", mask.alias("mask"))


def with_copies(masks: DataFrame) -> DataFrame:
    """Sets bit 4 where a smaller ``doc_id`` has the same digest."""
    first = masks.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    copy = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False)).cast("int") * (1 << 4)
    return masks.join(first, "digest").withColumn("mask", F.col("mask") + copy).drop("_first", "digest")


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by mask and labels."""
    given = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return (masks.join(given, "doc_id", "left")
            .groupBy("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
            .agg(F.count("*").alias("n")))


# --- packed counters -------------------------------------------------------------------------------------------

def outcomes(mask: int, good: int, toxic: int) -> dict[str, list[int]]:
    """0 or 1 for each counter and slot (order by order, step by step) of a document."""
    found = {name: [0] * SLOTS for name in COUNTERS}
    failed = {f: bool(mask >> i & 1) for i, f in enumerate(FILTERS)}
    for number, order in enumerate(ORDERS):
        gone = False
        for step, name in enumerate(order):
            slot = number * len(FILTERS) + step
            here = failed[name] and not gone
            found["redundant"][slot] = int(failed[name] and gone)
            gone = gone or here
            found["kept"][slot] = int(not gone)
            found["removed"][slot] = int(here)
            found["unique_fails"][slot] = int(failed[name] and mask & (mask - 1) == 0)
            found["good_lost"][slot] = int(here and good)
            found["toxic_lost"][slot] = int(here and toxic)
    return found


def packed_outcomes(mask: int, good: int, toxic: int) -> int:
    """All outcomes in one integer, a field each."""
    bits = [x for name in COUNTERS for x in outcomes(mask, good, toxic)[name]]
    return int.from_bytes(b"".join(x.to_bytes(FIELD // 8, "little") for x in bits), "little")


def unpack(total: int) -> dict[str, list[int]]:
    """The fields of a sum of such integers."""
    data = total.to_bytes(len(COUNTERS) * SLOTS * FIELD // 8, "little")
    fields = [int.from_bytes(data[i:i + FIELD // 8], "little") for i in range(0, len(data), FIELD // 8)]
    return {name: fields[k * SLOTS:(k + 1) * SLOTS] for k, name in enumerate(COUNTERS)}


def _report(counts: pd.DataFrame) -> pd.DataFrame:
    """The rows of one part from its counts by mask and labels (at most 128)."""
    total = sum(int(n) * packed_outcomes(int(m), int(g), int(t))
                for m, g, t, n in zip(counts["mask"], counts["good"], counts["toxic"], counts["n"]))
    table = pd.DataFrame(unpack(total))
    table.insert(0, "part", counts["part"].iloc[0])
    table.insert(1, "filter_order", [order for order in ORDERS for _ in FILTERS])
    table.insert(2, "step", [step for _ in ORDERS for step in range(1, len(FILTERS) + 1)])
    name = [order[step] for order in ORDERS for step in range(len(FILTERS))]
    table["shapley"] = table.groupby(name)["removed"].transform("sum")
    return table


REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in (*COUNTERS, "shapley"))


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: ``REPORT``."""
    folder = scratch_path(spark, "filter-audit")
    filter_masks(docs).write.mode("overwrite").parquet(f"{folder}/masks")  # texts are read once
    masks = with_copies(spark.read.parquet(f"{folder}/masks"))
    return mask_counts(masks, labels).groupBy("part").applyInPandas(_report, REPORT)
