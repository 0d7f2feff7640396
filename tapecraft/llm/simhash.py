"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius.

``fingerprint`` is one expression on a text. Its terms are pairs of neighbouring
words (the last word alone), lower-cased, hashed to 64 bits; a pair weighs 2 if
its first word has ``LONG_WORD`` characters or more, else 1. Every hash votes on
each bit with its weight, for 1 or against; the majority sets it. Votes are
counted in packed fields: eight longs of eight bytes count the 64 bits of up to
``RUN`` hashes, before which no byte can pass 127, and the runs' counts are
summed. So a text is one fold, with nothing shuffled and no counter to overflow.

``near_fingerprints`` finds all pairs within ``RADIUS`` bits by permuted block
tables: 64 bits are cut into ``BLOCKS`` blocks, and for each choice of ``BLOCKS -
RADIUS`` of them a table is keyed by these blocks alone. Two fingerprints that
differ in at most ``RADIUS`` bits differ in at most as many blocks, so some table
has both under one key; an exact bit count follows, and the first such table
reports the pair. Equal fingerprints are one entry with a count.

``edited_fingerprints`` also fingerprints each text with its last third replaced
from the next document in descending ``doc_id``. Documents are dealt into cells
of that order (``order_cells``); the first rows of a cell are copied into the
cell before it, so a window over one cell sees every next document, and each text
is shuffled once.

Cases with a defined result: a NULL text is an empty one; a text without words has
no votes and the fingerprint of 64 zeros; a NULL ``doc_id`` comes before all
others; rows of one ``doc_id`` follow each other by a hash of their texts; a single
row is its own next document; texts are hashed whole; an empty table has no rows;
other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapecraft.llm.order_cells import order_cell, order_cuts, tie_hash
from tapecraft.session import scratch_path

BITS = 64
LONG_WORD = 7
#: Hashes that byte fields count before they are summed.
RUN = 127
RADIUS = 3
BLOCKS = 5

_LANES = 0x0101010101010101


# --- the fingerprint -------------------------------------------------------------------------------------------

def _let(value: Column, body) -> Column:
    """``body`` with the value computed once: in higher-order functions a repeated expression runs repeatedly."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Lower-cased maximal runs of characters other than the six separators."""
    one_space = F.translate(F.lower(text), "\t\n\v\f\r", "     ")
    return F.filter(F.split(one_space, " "), lambda w: w != "")


def term_hashes(words: Column) -> Column:
    """The hash of every pair of neighbouring words, as often as it weighs."""
    def weighed(hashes: Column) -> Column:
        heavy = F.filter(hashes, lambda h, i: F.char_length(F.get(words, i)) >= LONG_WORD)
        return F.concat(hashes, heavy)

    return _let(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1))), weighed)


def packed_votes(hashes: Column) -> Column:
    """Per run of hashes, eight longs: byte ``k`` of the ``j``-th counts the hashes that set bit ``8 k + j``."""
    def count(run: Column) -> Column:
        return F.aggregate(run, F.array(*[F.lit(0).cast("long")] * 8), lambda acc, h: F.array(
            *[F.get(acc, F.lit(j)) + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES)) for j in range(8)]))

    runs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / RUN).cast("int"))
    return F.when(F.size(hashes) > 0, F.transform(runs, lambda r: count(F.slice(hashes, r * RUN + 1, F.lit(RUN)))))


def majority(hashes: Column) -> Column:
    """The long whose bits most of the hashes set."""
    total = F.size(hashes)

    def bits(votes: Column) -> Column:
        def ones(p: Column) -> Column:
            lane, shift = F.pmod(p, F.lit(8)), F.shiftright(p, 3) * 8
            return F.aggregate(votes, F.lit(0).cast("long"), lambda s, run: s + F.call_function(
                "shiftrightunsigned", F.get(run, lane), shift).bitwiseAND(F.lit(255)))

        return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda f, p: f.bitwiseOR(
            F.when(2 * ones(p) > total, F.call_function("shiftleft", F.lit(1).cast("long"), p)).otherwise(F.lit(0).cast("long"))))

    return F.coalesce(_let(packed_votes(hashes), bits), F.lit(0).cast("long"))


def fingerprint(text: Column) -> Column:
    """The 64-bit fingerprint of a text that is not NULL (long)."""
    return _let(words_of(text), lambda words: _let(term_hashes(words), majority))


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


# --- permuted block tables -------------------------------------------------------------------------------------

def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """A mask (as a signed long) of the blocks that a table keeps, for every table."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("more blocks than the radius are needed")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(block[i] for i in kept) for kept in combinations(range(blocks), blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_fingerprints(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``query, found, distance, n`` for every pair of a query and an entry of the index within
    ``radius`` bits. Both tables have distinct fingerprints ``f``; the index counts them in ``n``."""
    masks = block_masks(blocks, radius)

    def keyed(df: DataFrame) -> DataFrame:
        tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("f").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])
        return df.withColumn("k", F.explode(tables)).select("*", "k.*").drop("k")

    q, x = keyed(queries.select("f")).withColumnRenamed("f", "query"), keyed(index).withColumnRenamed("f", "found")
    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)])
    return (q.join(x, ["t", "key"]).filter((F.bit_count(differ) <= radius) & (first == F.col("t")))
            .select("query", "found", F.bit_count(differ).alias("distance"), "n"))


# --- documents and their next ones -----------------------------------------------------------------------------

def with_next(docs: DataFrame, cells: int) -> DataFrame:
    """``doc_id, text, f, next_text, next_f`` of every row; the next document in descending ``doc_id``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.bitwise_not(F.col("doc_id").cast("long")).alias("_k"))
    cuts, hot = order_cuts(rows, "_k", cells)
    tie = tie_hash(F.col("text"))
    placed = rows.withColumn("_tie", tie).withColumn("_cell", order_cell(F.col("_k"), F.col("_tie"), cuts, hot))
    # a cell has one key, or its head is every row of its first key: both are found by minima
    heads = placed.groupBy("_cell").agg(F.min("_k").alias("_head"), F.min("_tie").alias("_least"), F.max("_k").alias("_last"))
    before, every = Window.orderBy("_cell"), Window.partitionBy()
    heads = heads.select("_cell", "_head", F.when(F.col("_head").eqNullSafe(F.col("_last")), F.col("_least")).alias("_least"),
                         F.coalesce(F.lag("_cell").over(before), F.max("_cell").over(every)).alias("_before"))
    # at most MOST_CELLS cells, and as many as a tie hash splits hot keys into
    joined = placed.join(F.broadcast(heads), "_cell").withColumn("f", fingerprint(F.col("text")))
    head = F.col("_k").eqNullSafe(F.col("_head")) & (F.col("_least").isNull() | (F.col("_tie") == F.col("_least")))
    places = F.array(F.struct(F.col("_cell").alias("at"), F.lit(False).alias("copy")),
                     F.when(head, F.struct(F.col("_before").alias("at"), F.lit(True).alias("copy"))))
    dealt = joined.select("doc_id", "text", "f", "_k", "_tie", F.explode(F.array_compact(places)).alias("_p"))
    dealt = dealt.select("doc_id", "text", "f", "_k", "_tie", F.col("_p.at").alias("_at"), F.col("_p.copy").alias("_copy"))
    order = Window.partitionBy("_at").orderBy("_copy", F.col("_k").asc_nulls_first(), "_tie")
    return (dealt.select("doc_id", "text", "f", "_copy", F.lead("text").over(order).alias("next_text"),
                         F.lead("f").over(order).alias("next_f"))
            .filter(~F.col("_copy")).drop("_copy"))


def edited_fingerprints(docs: DataFrame, cells: int) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, f, edited_f, next_f`` of every row."""
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    return (with_next(docs, cells).withColumn("edited", edited)
            .select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    "f", fingerprint(F.col("edited")).alias("edited_f"), "next_f"))


def fingerprint_report(spark: SparkSession, docs: DataFrame, is_query: Column) -> DataFrame:
    """Every row's fingerprints and likenesses; of the query rows also ``near_docs``, the rows of
    the whole table whose fingerprints lie within ``RADIUS`` bits of theirs, themselves included."""
    folder = scratch_path(spark, "simhash")
    cells = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edited_fingerprints(docs, cells).write.mode("overwrite").parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    index = rows.groupBy("f").agg(F.count("*").alias("n"))
    queries = rows.filter(is_query).select("f").distinct()
    near = near_fingerprints(queries, index).groupBy("query").agg(F.sum("n").alias("near_docs"))
    found = rows.join(near, rows["f"] == near["query"], "left")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("edited_f")).alias("edited_fingerprint"), likeness(F.col("f"), F.col("edited_f")).alias("near_edited"),
        likeness(F.col("f"), F.col("next_f")).alias("near_next"), F.when(is_query, F.col("near_docs")).alias("near_docs"))
