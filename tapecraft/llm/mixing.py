"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks.

Targets. Sources in code-point order (NULL last) weigh 5, 2, 1, 5, 2, 1, ...
and share ``BUDGET`` times all words. No source gives more than ``MAX_EPOCHS``
times its size; the excess is shared anew by weight until no target is above.

Blocks. A source's documents are put in a pseudo-random order by hash, once per
epoch, and their words form one stream, cut into blocks of ``block_words``
words; the last block of the target is cut at the target.

Schedule. Slot k's point, the golden-ratio sequence on a grid of 2^31, is mapped
through the cumulative block counts of the sources. Slots are ranked within
their source, and the slot of rank r takes block r. A source whose slots run out
before its blocks gets the rest as closing slots; slots beyond its blocks are
void. So every prefix of the schedule is close to the target weights, and each
source's words end at its target, rounded to a whole word.

How it runs. Ranks and stream offsets are prefix sums over hash cells (see
``running_start``): a window over a cell's rows plus one over the cells' sums,
so a source with a third of all documents is spread over many tasks. Slots meet
sources by a join on cells of the grid, blocks by (source, block number). No
text is shuffled: the plan carries ids, sizes and offsets. Sizes, targets, pieces
and dealt slots are written to the shared folder, each by a query of its own: in
one plan the driver would hold every step's plan again for each use of a table,
and describe it all anew at each adaptive step.

Cases with a defined result: a NULL or empty text has size 0 and takes 0 words;
NULL sources form one source; rows that share ``doc_id`` and source count as one
document whose size is the sum over the rows; an empty table or one without any
word gives targets of 0; very long texts are spread over many blocks; other
columns are not read. Everything is a function of the input rows, so reruns
agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapecraft.session import scratch_path

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
BLOCK_WORDS = 1024
#: The golden-ratio step on a grid of 2^31 points (odd, so that all points are visited).
GRID = 1 << 31
GOLDEN_STEP = 1327217885
#: Cells of the grid in which slots and sources meet.
CELLS = 1 << 12


def word_count(text: Column) -> Column:
    """Number of runs outside ``[\\x20\\x09-\\x0D]``; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_start(df: DataFrame, group: list[str], order: list[Column], cell: Column, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the group's earlier rows, in the order (cell, order).

    Rows of one cell are summed in one window and whole cells in another, so no
    window holds a whole group's rows.
    """
    df = df.withColumn("_cell", cell)
    keys = [*group, "_cell"]
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
             .withColumn("_before", F.coalesce(F.sum("_sum").over(outer), F.lit(0))).drop("_sum"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    within = df.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0)))
    joined = within.alias("a").join(cells.alias("b"), same)
    return joined.select("a.*", "b._before").withColumn(out, F.col(out) + F.col("_before")).drop("_before", "_cell")


def _cells_for(df: DataFrame, rows: int) -> int:
    """Cells over all groups: several a shuffle partition, so that tasks come out even."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(rows, 8 * parts))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, max_epochs=MAX_EPOCHS) -> DataFrame:
    """``source, documents, source_size, target`` from ``source, documents, size`` rows, one a source.

    Sharing: sort the sources by size over weight. The capped ones are a prefix
    of that order, and the water level follows from running sums, so the fixed
    point needs no iteration.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name)).withColumn("_w", weigh)
    everything = Window.partitionBy()
    level_order = Window.orderBy(F.col("_need"), F.col("_rank"))
    before = level_order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranked
              .withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
              .withColumn("_need", F.col("_cap") / F.col("_w"))
              .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(budget)))
              .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
              .withColumn("_weights", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
              .withColumn("_level", F.col("_left") / F.col("_weights"))
              .withColumn("_capped", F.col("_need") <= F.col("_level")))
    # the first uncapped source sets the level for all uncapped ones
    level = F.min(F.when(~F.col("_capped"), F.struct("_need", "_rank", "_level"))).over(everything)
    return (ranked.withColumn("_free", level)
            .withColumn("target", F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_w") * F.col("_free._level")))
            .select("source", "documents", "source_size", "target", "_rank"))


def _written(spark: SparkSession, df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def mixing_plan(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, max_epochs=MAX_EPOCHS,
                block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, targets, plan)`` of a mix.

    ``plan`` is the mix itself: one row per slot and document piece, with
    ``slot, source, doc_id, epoch, first_word, words``; sorted by slot it is the
    training order.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "mixing")
    own = _written(spark, docs.select("doc_id", "source", word_count(F.col("text")).alias("_n"))
                   .groupBy("doc_id", "source").agg(F.sum("_n").alias("size")), folder, "sizes")
    per_source = own.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    targets = _written(spark, source_targets(per_source, weights, budget, max_epochs), folder, "targets")
    totals = targets.agg(F.sum("documents").alias("d"),
                         F.sum(F.ceil(F.round("target") / block_words)).alias("k")).first()
    rows, slots_needed = int(totals["d"] or 0), int(totals["k"] or 0)
    targets_int = targets.withColumn("_words", F.round("target").cast("long")).withColumn(
        "_blocks", F.ceil(F.col("_words") / block_words).cast("long"))

    # 1. streams: each document's place in its source's words, once per epoch
    cells = _cells_for(docs, max(1, rows // 16))
    epochs = (own.filter(F.col("size") > 0).alias("d")
              .join(targets_int.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
              .select("d.doc_id", "d.source", "d.size", "t.documents", "t.source_size", "t._words")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
              .filter(F.col("epoch") * F.col("source_size") < F.col("_words"))
              .withColumn("_h", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                                  F.col("epoch").cast("string")).cast("binary"))))
    per_group = F.greatest(F.lit(1), F.ceil(F.col("documents") * F.lit(cells / max(rows, 1)))).cast("long")
    # cells are ranges of the hash, so the order over all cells is the hash order
    share = F.conv(F.substring("_h", 1, 7), 16, 10).cast("long")
    placed = running_start(epochs, ["source", "epoch"], [F.col("_h"), F.col("doc_id")],
                           F.floor(share * per_group / F.lit(1 << 28)), "size", "_start")
    first = F.col("epoch") * F.col("source_size") + F.col("_start")
    pieces = (placed.withColumn("_from", first)
              .withColumn("_to", F.least(first + F.col("size"), F.col("_words")))
              .filter(F.col("_to") > F.col("_from"))
              .withColumn("block", F.explode(F.sequence(
                  F.floor(F.col("_from") / block_words), F.floor((F.col("_to") - 1) / block_words))))
              .withColumn("_a", F.greatest("_from", F.col("block") * block_words))
              .withColumn("_b", F.least("_to", (F.col("block") + 1) * block_words))
              .select("source", "block", "doc_id", "epoch", (F.col("_a") - F.col("_from")).alias("first_word"),
                      (F.col("_b") - F.col("_a")).alias("words"), F.col("_from").alias("_order")))
    pieces = _written(spark, pieces, folder, "pieces")

    # 2. schedule: golden-ratio points through the cumulative block counts
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = (spark.range(0, slots_needed, 1, parts).withColumnRenamed("id", "slot")
             .withColumn("_u", (F.col("slot") % F.lit(GRID)) * F.lit(GOLDEN_STEP) % F.lit(GRID))
             .withColumn("_grid", F.floor(F.col("_u") / F.lit(GRID // CELLS))))
    upto = Window.orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    edge = F.floor(F.sum("_blocks").over(upto) * F.lit(float(GRID)) / F.lit(float(max(slots_needed, 1)))).cast("long")
    reach = (targets_int.filter("_blocks > 0").withColumn("_hi", edge)
             .withColumn("_lo", F.coalesce(F.lag("_hi").over(Window.orderBy("_rank")), F.lit(0)))
             .filter("_hi > _lo")
             .withColumn("_grid", F.explode(F.sequence(F.floor(F.col("_lo") / F.lit(GRID // CELLS)),
                                                       F.floor((F.col("_hi") - 1) / F.lit(GRID // CELLS)))))
             .select("source", "_lo", "_hi", "_grid", "_blocks"))
    mapped = (slots.join(reach, "_grid").filter("_u >= _lo AND _u < _hi")
              .select("slot", "source", "_blocks", F.lit(1).alias("_one")))
    width = max(1, slots_needed // _cells_for(docs, slots_needed))
    ranked = running_start(mapped, ["source"], [F.col("slot")], F.floor(F.col("slot") / width),
                           "_one", "block").filter(F.col("block") < F.col("_blocks"))
    ranked = _written(spark, ranked.select("slot", "source", "block"), folder, "slots")
    dealt = ranked.groupBy("source").agg(F.count("*").alias("_dealt"))
    closing = (targets_int.alias("t").join(dealt.alias("d"), F.col("t.source").eqNullSafe(F.col("d.source")), "left")
               .select("t.source", "t._rank", "t._blocks", F.coalesce("d._dealt", F.lit(0)).alias("_dealt"))
               .filter("_blocks > _dealt")
               .withColumn("block", F.explode(F.sequence(F.col("_dealt"), F.col("_blocks") - 1)))
               .select((F.lit(slots_needed) + F.col("block") * F.lit(1 << 20) + F.col("_rank")).alias("slot"),
                       "source", "block"))
    schedule = ranked.unionByName(closing)

    # 3. slots take blocks
    plan = (schedule.alias("s").join(pieces.alias("p"), [F.col("s.source").eqNullSafe(F.col("p.source")),
                                                        F.col("s.block") == F.col("p.block")])
            .select("s.slot", "s.source", "p.doc_id", "p.epoch", "p.first_word", "p.words", "p._order"))
    return own, targets, plan


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: what the mix takes of each document."""
    own, targets, plan = mixing_plan(docs, **options)
    taken = plan.groupBy("doc_id", "source").agg(F.sum("words").alias("_taken"))
    return (own.alias("d")
            .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
            .join(taken.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                  & F.col("d.source").eqNullSafe(F.col("k.source")), "left")
            .select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target",
                    F.coalesce("k._taken", F.lit(0)).cast("long").alias("taken")))
