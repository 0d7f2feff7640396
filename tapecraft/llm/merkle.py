"""Merkle manifest of a dataset: a hash tree per group, by pivoting children into fan-out columns.

``dataset_leaves`` hashes rows. ``with_places`` numbers the leaves of each group
in order, from counts of the order's cells, so no group is sorted in one task.
``manifest`` builds the trees. A tier is ``TIER`` levels in one shuffle: a
conditional aggregate spreads the ``fanout ** TIER`` nodes under one ancestor
into as many columns; concatenating neighbouring columns and hashing them gives
the levels between, and a node's siblings are the columns of its run without its
own slot. Only the last run of a level may be short, even of one node, which is
hashed alone; a group of one node passes its levels unhashed. The groups' roots
are the leaves of one more tree, in the order of the group keys.

``prove`` walks down the tiers: every node gets its steps, (left, right) siblings
a level, before those of its ancestor. ``fold`` hashes a leaf up its steps.

Each tier is written in the shared folder, so that a lost executor costs one tier
and nothing is computed twice. The driver learns the cuts of the order, the length
of the longest group and nothing else; rows of the top tree are one a group.

Cases with a defined result: a NULL field is ``-`` in its leaf, so NULL and empty
differ; a NULL ``lang`` is a group of its own, before all others; a NULL
``doc_id`` comes first in its group; rows of one ``doc_id`` are leaves of their
own in the order of a hash of their leaves, and rows that repeat a leaf are
interchangeable; texts are hashed whole; an empty table has no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapecraft.llm.order_cells import order_cell, order_cuts, tie_hash
from tapecraft.session import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Levels a shuffle; a tier's row has fanout ** TIER child columns.
TIER = 3

_STEP = "struct<l:string,r:string>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field_text(value: Column) -> Column:
    """``-`` if NULL, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return digest(F.concat(*[field_text(c) for c in fields.values()]))


def dataset_leaves(docs: DataFrame, tampered: Column | None = None, tamper: dict[str, Column] | None = None) -> DataFrame:
    """``g, doc_id, leaf, shown`` of every row: its group's key, its leaf, and the leaf
    that is shown to the proof (of the ``tamper`` columns where ``tampered``)."""
    fields = {name: F.col(name) for name in FIELDS}
    leaf = leaf_hash(fields)
    shown = leaf if tampered is None else F.when(tampered, leaf_hash({**fields, **tamper}))
    out = docs.select("doc_id", group_key(F.col("lang")).alias("g"), leaf.alias("leaf"), shown.alias("shown"))
    return out.withColumn("shown", F.coalesce("shown", "leaf"))


def group_key(group: Column) -> Column:
    """A key that is never NULL and sorts like the group, NULL first, bytewise."""
    return F.coalesce(F.concat(F.lit("="), group), F.lit(""))


def with_places(rows: DataFrame, cells: int) -> DataFrame:
    """Adds ``n`` (rows of the group) and ``idx`` (place in it, from 0), by ``doc_id`` and a hash of the leaf."""
    cuts, hot = order_cuts(rows, "doc_id", cells)
    rows = (rows.withColumn("_tie", tie_hash(F.col("leaf")))
            .withColumn("_cell", order_cell(F.col("doc_id"), F.col("_tie"), cuts, hot)))
    group = Window.partitionBy("g")
    before = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy("g", "_cell").agg(F.count("*").alias("_rows"))
              .select("g", "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                      F.sum("_rows").over(group).alias("n")))
    inside = Window.partitionBy("g", "_cell").orderBy(F.col("doc_id").asc_nulls_first(), "_tie", "leaf")
    return (rows.withColumn("_r", F.row_number().over(inside)).join(counts, ["g", "_cell"])
            .withColumn("idx", F.col("_before") + F.col("_r") - 1).drop("_tie", "_cell", "_r", "_before"))


# --- tiers -----------------------------------------------------------------------------------------------------

def _left(n: str, fanout: int, level: int) -> str:
    """SQL: nodes that are left of ``n`` after some levels."""
    span = fanout ** level
    return f"(({n} + {span - 1}) div {span})"


def _joined(columns: list[str]) -> str:
    return f"concat_ws('', {', '.join(columns)})" if columns else "''"


def pivot_tier(nodes: DataFrame, fanout: int, payload: list[str], height: int) -> DataFrame:
    """One row per ancestor, ``height`` levels above ``g, n, idx, h``: its children in slots
    ``c0, c1, ...`` (structs of ``h`` and the payload), the levels between as ``v<level>_<k>``,
    its own hash as ``top``."""
    width = fanout ** height
    child = f"struct({', '.join(['h', *payload])})"
    out = (nodes.groupBy("g", "n", F.expr(f"idx div {width}").alias("idx"))
           .agg(*[F.expr(f"max(CASE WHEN pmod(idx, {width}) = {s} THEN {child} END) AS c{s}") for s in range(width)]))
    out = out.selectExpr("*", *[f"c{s}.h AS v0_{s}" for s in range(width)])
    for level in range(1, height + 1):
        made = []
        for k in range(fanout ** (height - level)):
            run = [f"v{level - 1}_{k * fanout + j}" for j in range(fanout)]
            alone = f"WHEN {_left('n', fanout, level - 1)} = 1 THEN {run[0]} " if k == 0 else ""
            made.append(f"CASE {alone}WHEN {run[0]} IS NOT NULL THEN sha2(cast({_joined(run)} AS binary), 256) END AS v{level}_{k}")
        out = out.selectExpr("*", *made)
    return out.withColumnRenamed(f"v{height}_0", "top")


def _slot(slot: int, fanout: int, height: int) -> str:
    """SQL of a slot: its number, its child, and the child's siblings level by level as
    (those left of it, those right of it) in its run."""
    steps = []
    for level in range(height):
        at = slot // fanout ** level
        first = at - at % fanout
        left = _joined([f"v{level}_{k}" for k in range(first, at)])
        right = _joined([f"v{level}_{k}" for k in range(at + 1, first + fanout)])
        steps.append(f"CASE WHEN {_left('n', fanout, level)} > 1 THEN struct({left} AS l, {right} AS r) END")
    return f"struct({slot} AS s, c{slot} AS c, array_compact(array({', '.join(steps)})) AS steps)"


def build(spark: SparkSession, nodes: DataFrame, folder: str, fanout: int, payload: list[str], longest: int) -> list[DataFrame]:
    """The written tiers over ``g, n, idx, h`` and a payload of the lowest nodes, from the leaves up."""
    tiers, width = [], fanout ** TIER
    while True:
        path = f"{folder}/tier{len(tiers)}"
        pivot_tier(nodes, fanout, payload if not tiers else [], TIER).write.mode("overwrite").parquet(path)
        tiers.append(spark.read.parquet(path))
        longest = -(-longest // width)
        if longest <= 1:
            return tiers
        nodes = tiers[-1].select("g", F.expr(f"{_left('n', fanout, TIER)} AS n"), "idx", F.col("top").alias("h"))


def prove(tiers: list[DataFrame], above: DataFrame, fanout: int, payload: list[str]) -> DataFrame:
    """Down the tiers: ``g, idx, h``, the payload, the columns of ``above`` and ``steps``, of every leaf.

    ``above`` has a row a group: ``g``, ``steps`` above the group's root, further columns.
    """
    carried = [c for c in above.columns if c not in ("g", "steps")]
    upper = above.withColumn("idx", F.lit(0).cast("long")).withColumnRenamed("steps", "_upper")
    width = fanout ** TIER
    for number, tier in reversed(list(enumerate(tiers))):
        slots = ", ".join(_slot(s, fanout, TIER) for s in range(width))
        found = tier.join(upper, ["g", "idx"]).selectExpr(
            "g", "idx", "_upper", *carried, f"explode(filter(array({slots}), x -> x.c IS NOT NULL)) AS x")
        found = found.selectExpr("g", f"idx * {width} + x.s AS idx", "x.c.*", *carried, "concat(x.steps, _upper) AS steps")
        if number == 0:
            return found
        upper = found.drop("h").withColumnRenamed("steps", "_upper")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps hash to."""
    return F.aggregate(steps, leaf, lambda h, s: digest(F.concat(s["l"], h, s["r"])))


def manifest(spark: SparkSession, leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, leaf, shown, subroot, root, steps`` of rows as ``dataset_leaves`` makes them."""
    folder = scratch_path(spark, "merkle")
    cells = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaves.write.mode("overwrite").parquet(f"{folder}/rows")
    places = with_places(spark.read.parquet(f"{folder}/rows"), cells)
    places.write.mode("overwrite").parquet(f"{folder}/leaves")
    nodes = spark.read.parquet(f"{folder}/leaves").withColumnRenamed("leaf", "h")
    longest = nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    tiers = build(spark, nodes, f"{folder}/groups", fanout, ["doc_id", "shown"], longest)

    # the tree over the groups' roots: a row a group
    roots = tiers[-1].select("g", F.col("top").alias("h"))
    every = Window.partitionBy()
    top = roots.select(F.lit("").alias("g"), F.count("*").over(every).alias("n"),
                       (F.row_number().over(Window.orderBy("g")) - 1).cast("long").alias("idx"), "h", F.col("g").alias("own"))
    top_tiers = build(spark, top, f"{folder}/roots", fanout, ["own"], roots.count())
    start = top_tiers[-1].select("g", F.array().cast(f"array<{_STEP}>").alias("steps"), F.col("top").alias("root"))
    above = prove(top_tiers, start, fanout, ["own"]).select(F.col("own").alias("g"), "steps", F.col("h").alias("subroot"), "root")
    return prove(tiers, above, fanout, ["doc_id", "shown"]).select(
        "doc_id", F.col("h").alias("leaf"), "shown", "subroot", "root", "steps")


def verified_manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every row's leaf, proof and the root that its shown leaf folds to; rows whose
    ``doc_id`` (as decimal text) has a CRC-32 divisible by 7 are shown with ``n_chars`` one higher."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)")}
    proved = manifest(spark, dataset_leaves(docs, tampered, more))
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["l"], s["r"])), "")
    folded = proved.select("doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"),
                           fold(F.col("shown"), F.col("steps")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
