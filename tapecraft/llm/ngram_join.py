"""Near-duplicate documents by an exact Jaccard join on word 5-grams, with vertical partitioning.

The n-grams ("shingles") are 64-bit hashes. Their space is cut into fragments;
documents are cut along, and whatever concerns a shingle happens in its
fragment: counting the documents that have it, and counting the partial overlap
of a pair of documents. Partial results are summed per document or per pair.

1. Screen. Every text is hashed once. On a fixed 3/8 of the hash space, each
   fragment tells how many of a document's shingles no other document has. A
   partner shares at least 80 % of the set, so a document with more own shingles
   than 20 % of its set has none and leaves. What remains is a superset of all
   documents with partners; nothing depends on the sampled share but cost.
2. Classes. Documents with equal sets form a class; only one of them goes on, so
   copies are never paired with one another.
3. Order. Each fragment counts its shingles over the remaining classes; a class
   keeps the prefix of its shingles in the order (rarest first, hash) in which
   any partner must meet it.
4. Pairs. Classes that share a prefix shingle are compared with a pivot, the one
   of them with the fewest rarer shingles; linked classes become components.
   Then shingles whose classes are still in different components are joined for
   exactly those pairs, by bands of lengths that can satisfy the bounds. A group of near copies costs about one comparison a
   member, not a comparison a pair; length and position bounds, which never drop
   a link, keep unrelated classes apart.
5. Overlap. A pair's overlap is the sum of its fragments' overlaps; it is linked
   when ``100 * overlap >= percent * union``.

Nothing is collected to the driver but counts and flags; intermediate tables go
to the shared folder. Sets are compared by 64-bit hashes: two of a pair's
shingles agree by chance with probability about n^2 / 2^64. Classes are named by
126 bits of their fingerprint.

Cases with a defined result: a NULL, empty or blank text has an empty set and is
linked with nothing; a text of one to four words is one shingle; a NULL
``doc_id`` links like any other row but is never a component's name (it gets the
smallest ``doc_id`` that it reaches, or NULL if it reaches none); repeated rows
are copies, one result row each; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from tapecraft.llm.components import connected_components
from tapecraft.llm.memory import release_unused
from tapecraft.llm.words import block_words, shingle_set, text_blocks
from tapecraft.session import scratch_path

WORDS = 5
PERCENT = 80
#: Eighths of the hash space that the screen looks at.
SCREEN_EIGHTHS = 3
#: Length bands for each factor of e in the lengths, in the join of classes still apart.
BANDS = 20
#: Bytes of text a fragment of the screen stands for; its shingles take about 0.3 bytes for each.
SCREEN_BYTES = 256 << 20
#: Shingles a fragment holds, about, once the screen is over.
FRAGMENT_SHINGLES = 2_000_000
#: Documents up to which the remaining ones are told to every task (8 bytes each); more are joined by shuffle.
TOLD_DOCUMENTS = 2_000_000
NAME = np.dtype([("low", "<u8"), ("high", "<u8")])
FACT = np.dtype([("doc_id", "<i8"), ("present", "u1"), ("n", "<i8"), ("cls", NAME)])


def _fragment_of(keys: np.ndarray, fragments: int) -> np.ndarray:
    """Fragments are equal ranges of the hash space."""
    return (((keys >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)).astype(np.int64)


def _text_sets(ids: pa.Array, texts: pa.Array, words: int):
    for first, offsets, data in text_blocks(texts):
        hashes, _, _, bounds = block_words(offsets, data, lower=True)
        for i in range(len(offsets) - 1):
            yield first + i, shingle_set(hashes[bounds[i]:bounds[i + 1]], words)


def _fingerprint(keys: np.ndarray) -> tuple[int, int]:
    """The low 64 and the high 62 bits of a class's name."""
    low, high = np.frombuffer(hashlib.blake2b(keys.tobytes(), digest_size=16).digest(), "<u8").tolist()
    return low, high >> 2


def _names(fingerprints: np.ndarray) -> pa.Array:
    """Fingerprints (NAME) as decimals: a type of fixed size that Spark aggregates in place."""
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(fingerprints), [None, pa.py_buffer(fingerprints.tobytes())])


def class_names(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` with ``cls``, the class of their text (NULL for an empty set)."""
    def name(batches):
        for batch in batches:
            found = np.zeros(batch.num_rows, NAME)
            some = np.zeros(batch.num_rows, bool)
            for i, keys in _text_sets(None, batch.column("text"), words):
                if len(keys):
                    found[i], some[i] = _fingerprint(keys), True
            cls = pc.if_else(pa.array(some), _names(found), pa.scalar(None, pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, cls], names=[*batch.schema.names, "cls"])

    return docs.mapInArrow(name, StructType([*docs.schema.fields, StructField("cls", DecimalType(38, 0))]))


# --- 1. screen -------------------------------------------------------------------------------------------------

def _screen_rows(batches, words, fragments):
    """Per batch: one row of facts on its documents, and one per fragment with the shingles seen there."""
    release_unused()  # of the stages before, in a worker that serves many tasks
    task = TaskContext.get().partitionId()
    names = ["fragment", "batch", "facts", "counts", "once", "again"]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    for number, batch in enumerate(batches):
        facts = np.zeros(batch.num_rows, FACT)
        ids = batch.column(0).cast(pa.int64())
        facts["present"] = np.asarray(ids.is_valid())
        facts["doc_id"] = np.asarray(ids.fill_null(0)) if len(ids) else 0
        kept, owner = [], []
        for i, keys in _text_sets(ids, batch.column(1), words):
            if len(keys):
                facts["n"][i] = len(keys)
                facts["cls"][i] = _fingerprint(keys)
                keys = keys[(keys & np.uint64(7)) < SCREEN_EIGHTHS]
                kept.append(keys)
                owner.append(np.full(len(keys), i, np.int32))
        name = (task << 32) + number
        rows = [(name % fragments, name, facts.tobytes(), None, None, None)]
        if kept:
            keys, doc = np.concatenate(kept), np.concatenate(owner)
            order = np.argsort(keys, kind="stable")
            same = keys[order][1:] == keys[order][:-1]
            several = np.zeros(len(keys), bool)
            several[order[1:][same]] = True
            later = several.copy()
            several[order[:-1][same]] = True
            part = _fragment_of(keys, fragments)
            # shingles with one document in the batch keep it; the others are only known to occur
            single = np.flatnonzero(~several)
            single = single[np.argsort(part[single], kind="stable")]
            multi = np.flatnonzero(later)
            multi = multi[np.argsort(part[multi], kind="stable")]
            s_edge = np.searchsorted(part[single], np.arange(fragments + 1))
            m_edge = np.searchsorted(part[multi], np.arange(fragments + 1))
            for f in range(fragments):
                mine = single[s_edge[f]:s_edge[f + 1]]
                more = multi[m_edge[f]:m_edge[f + 1]]
                if len(mine) or len(more):
                    rows.append((f, name, None, _packed(doc[mine], batch.num_rows),
                                 _short(keys[mine]).tobytes(), _short(keys[more]).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _short(keys: np.ndarray) -> np.ndarray:
    """32 bits of a hash, enough inside a fragment: a chance match only makes the screen keep more."""
    return ((keys >> np.uint64(3)) & np.uint64(0xFFFFFFFF)).astype("<u4")


def _packed(doc: np.ndarray, rows: int) -> bytes:
    """How often each of a batch's documents is in an ascending list: all counts, or those that are not 0 if shorter."""
    where, times = np.unique(doc, return_counts=True)
    body = [where, times] if 2 * len(where) < rows else [np.bincount(doc, minlength=rows)]
    return np.concatenate([[rows, len(body)], *body]).astype("<u4").tobytes()


def _unpacked(raw: bytes) -> tuple[int, np.ndarray]:
    """Number of documents and the list of ``_packed``."""
    data = np.frombuffer(raw, "<u4")
    rows, form, body = int(data[0]), data[1], data[2:]
    where, times = (np.arange(rows), body) if form == 1 else (body[:len(body) // 2], body[len(body) // 2:])
    return rows, np.repeat(where, times)


def _own_counts(part: pd.DataFrame) -> pd.DataFrame:
    """Per batch: how many of each document's shingles in this fragment nothing else has. Facts pass through."""
    facts = part[part["facts"].notna()]
    rows = part[part["facts"].isna()]
    out = [(int(b), bytes(f), None) for b, f in zip(facts["batch"], facts["facts"])]
    if len(rows):
        once = [np.frombuffer(x, "<u4") for x in rows["once"]]
        again = [np.frombuffer(x, "<u4") for x in rows["again"]]
        every = np.concatenate([*once, *again, *again])  # what occurs again is never single
        every.sort()
        differs = np.concatenate([[True], every[1:] != every[:-1], [True]])
        single = every[differs[1:] & differs[:-1]]
        del every, differs
        for b, counts, keys in zip(rows["batch"], rows["counts"], once):
            size, doc = _unpacked(counts)
            at = np.searchsorted(single, keys)
            alone = np.zeros(len(keys), bool)
            alone[at < len(single)] = single[at[at < len(single)]] == keys[at < len(single)]
            out.append((int(b), None, _packed(doc[alone], size)))
    return pd.DataFrame(out, columns=["batch", "facts", "own"])


def _verdicts(part: pa.Table, percent: int) -> pa.Table:
    """Documents of one batch: doc_id, set size, class, and whether a partner is possible."""
    raw = next(x for x in part["facts"].to_pylist() if x is not None)
    facts = np.frombuffer(raw, FACT)
    own = np.zeros(len(facts), np.int64)
    for x in part["own"]:
        if x.is_valid:
            own += np.bincount(_unpacked(x.as_py())[1], minlength=len(facts))
    n = facts["n"]
    some = n > 0
    spare = n - (percent * n + 99) // 100  # shingles a partner may lack
    return pa.table({
        "doc_id": pa.array(facts["doc_id"], mask=facts["present"] == 0), "n": pa.array(n),
        "cls": pc.if_else(pa.array(some), _names(np.ascontiguousarray(facts["cls"])), pa.scalar(None, pa.decimal128(38, 0))),
        "open": pa.array(some & (own <= spare))})


def screen(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n, cls, open`` for every row: its class, and whether it may have a partner."""
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-volume // SCREEN_BYTES))
    rows = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _screen_rows(batches, words, fragments),
        "fragment int, batch long, facts binary, counts binary, once binary, again binary")
    own = rows.groupBy("fragment").applyInPandas(_own_counts, "batch long, facts binary, own binary")
    return own.groupBy("batch").applyInArrow(
        lambda part: _verdicts(part, percent), "doc_id long, n long, cls decimal(38,0), open boolean")


# --- 2.-3. classes, fragments, order ---------------------------------------------------------------------------

def _segment_rows(batches, words, fragments):
    """One row per class and fragment. Copies that a task meets again are left out, so a class has at most one row a task."""
    schema = pa.schema([("cls", pa.decimal128(38, 0)), ("n", pa.int64()), ("fragment", pa.int32()), ("keys", pa.list_(pa.int64()))])
    seen = set()
    for batch in batches:
        cls, n, part, keys_of = [], [], [], []
        for _, keys in _text_sets(batch.column(0), batch.column(1), words):
            name = _fingerprint(keys) if len(keys) else None
            if name is None or name in seen:
                continue
            seen.add(name)
            place = _fragment_of(keys, fragments)
            edges = np.flatnonzero(np.diff(place)) + 1
            for piece in np.split(np.arange(len(keys)), edges):
                cls.append(name)
                n.append(len(keys))
                part.append(int(place[piece[0]]))
                keys_of.append(keys[piece].view(np.int64))
        lengths = np.array([0, *map(len, keys_of)], np.int64).cumsum().astype(np.int32)
        flat = np.concatenate(keys_of) if keys_of else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [_names(np.array(cls, NAME)), pa.array(n, pa.int64()), pa.array(part, pa.int32()),
             pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))], schema=schema)


def _shared_shingles(part: pa.Table) -> pa.Table:
    """Per class of a fragment: shingles only it has, and the others with the number of classes that have them."""
    names = np.concatenate([np.frombuffer(c.buffers()[1], NAME)[c.offset:c.offset + len(c)] for c in part["cls"].chunks])
    if len(np.unique(names["low"])) < len(names):  # several tasks met a class
        part = part.take(pa.array(np.sort(np.unique(names, return_index=True)[1])))
    lists = pa.concat_arrays(part["keys"].chunks)
    every = lists.flatten().to_numpy()
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    _, back, times = np.unique(every, return_inverse=True, return_counts=True)
    times = times[back]
    many = times > 1
    kept = np.concatenate([[0], np.cumsum(many)])[edges]  # where each class's shared shingles begin
    offsets = pa.array(kept, pa.int32())
    return pa.table({
        "cls": part["cls"], "n": part["n"], "own": pa.array(np.diff(edges) - np.diff(kept), pa.int64()),
        "keys": pa.ListArray.from_arrays(offsets, pa.array(every[many], pa.int64())),
        "counts": pa.ListArray.from_arrays(offsets, pa.array(times[many], pa.int64()))})


def _need(n, percent):
    """Least overlap of a set of n shingles with any partner."""
    return F.floor((n * percent + 99) / 100)


def prefix_entries(segments: DataFrame, percent: int) -> DataFrame:
    """``key, cls, n, cap``: the prefix shingles that other classes have too.

    ``cap`` bounds the overlap of a pair whose first common shingle this is: the
    class's shingles from here on in the order.
    """
    shared = segments.select("fragment", "cls", "n", "keys").groupBy("fragment").applyInArrow(
        _shared_shingles, "cls decimal(38,0), n long, own long, keys array<long>, counts array<long>")
    each = shared.withColumn("pairs", F.arrays_zip("counts", "keys"))
    ordered = (each.groupBy("cls").agg(F.max("n").alias("n"), F.sum("own").alias("own"),
                                       F.flatten(F.collect_list("pairs")).alias("pairs"))
               .withColumn("take", (F.col("n") - _need(F.col("n"), percent) + 1 - F.col("own")).cast("int"))
               .filter("take > 0"))
    return (ordered.select("cls", "n", "own", F.posexplode(F.slice(F.sort_array("pairs"), F.lit(1), F.col("take"))))
            .select(F.col("col.keys").alias("key"), "cls", "n", (F.col("n") - F.col("own") - F.col("pos")).alias("cap")))


# --- 4.-5. pairs and overlaps ----------------------------------------------------------------------------------

def _possible(a: str, b: str, percent: int):
    """Length and position bounds for two entries of one shingle; both are implied by a link."""
    na, nb, ca, cb = (F.col(f"{x}.{c}") for c in ("n", "cap") for x in (a, b))
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & ((100 + percent) * F.least(ca, cb) >= percent * (na + nb)))


def _band(n):
    """Number of a length band; a band is about a twentieth wide."""
    return F.floor(F.log(n.cast("double")) * F.lit(BANDS))


def banded_sides(entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The entries as smaller and as larger member of a pair, with the bands in which they can meet.

    ``_possible`` holds for a pair if the larger length is within the smaller one's
    ``most`` and the smaller within the larger one's: ``most`` is the length up to
    which a partner may go by the entry's cap. Entries that no length band of their
    key can satisfy are in neither side.
    """
    most = F.floor((100 + percent) * F.col("cap") / percent) - F.col("n")
    up = F.least("most", F.floor(100 * F.col("n") / percent))
    down = F.least("most", "n")
    every = entries.withColumn("most", most)
    small = (every.filter(F.col("most") >= F.col("n")).withColumn("small", _band(F.col("n")))
             .withColumn("large", F.explode(F.sequence(F.col("small"), _band(up)))))
    large = (every.filter(100 * F.col("most") >= percent * F.col("n")).withColumn("large", _band(F.col("n")))
             .withColumn("small", F.explode(F.sequence(_band(F.ceil(percent * F.col("n") / 100)), _band(down)))))
    return small.drop("most"), large.drop("most")


def pivot_pairs(entries: DataFrame, percent: int) -> DataFrame:
    pivots = entries.groupBy("key").agg(
        F.max(F.struct((F.col("cap") / F.col("n")).alias("rate"), "cls", "n", "cap")).alias("p"), F.count("*").alias("m"))
    pivots = pivots.filter("m > 1").select("key", "p.cls", "p.n", "p.cap")
    return (entries.alias("b").join(pivots.alias("a"), "key")
            .filter((F.col("a.cls") != F.col("b.cls")) & _possible("a", "b", percent))
            .select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
            .distinct())


def remaining_pairs(entries: DataFrame, components: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Possible pairs in different components that were not compared yet, in shingles that several components have."""
    placed = (entries.join(components.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("root", F.coalesce("root", "cls")))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    open_ = placed.join(mixed, "key", "left_semi")
    small, large = banded_sides(open_, percent)
    # of equal lengths the smaller class is the smaller member; results name the smaller class first
    ahead = (F.col("s.n") < F.col("l.n")) | ((F.col("s.n") == F.col("l.n")) & (F.col("s.cls") < F.col("l.cls")))
    first = F.col("s.cls") < F.col("l.cls")
    pairs = (small.alias("s").join(large.alias("l"), ["key", "small", "large"])
             .filter(ahead & (F.col("s.root") != F.col("l.root")) & _possible("s", "l", percent))
             .select(F.least("s.cls", "l.cls").alias("a"), F.greatest("s.cls", "l.cls").alias("b"),
                     F.when(first, F.col("s.n")).otherwise(F.col("l.n")).alias("na"),
                     F.when(first, F.col("l.n")).otherwise(F.col("s.n")).alias("nb"))
             .distinct())
    either = done.select("a", "b").unionByName(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(either, ["a", "b"], "left_anti")


def linked_pairs(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """``a, b, overlap`` of the pairs that are links: overlaps counted by fragment and summed by pair."""
    parts = segments.select("cls", "fragment", "keys")
    left = parts.alias("s").join(pairs.alias("p"), F.col("s.cls") == F.col("p.b")).select("p.*", "s.fragment", "s.keys")
    pivots = parts.join(pairs.select(F.col("a").alias("cls")).distinct(), "cls", "left_semi")
    both = left.alias("l").join(pivots.alias("r"), (F.col("l.a") == F.col("r.cls")) & (F.col("l.fragment") == F.col("r.fragment")))
    partial = both.select("l.a", "l.b", "l.na", "l.nb", "l.fragment",
                          F.size(F.array_intersect("l.keys", "r.keys")).alias("shared"))
    # a fragment counts once a pair, even where a class was hashed from two equal rows
    per_fragment = partial.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("shared").alias("shared"))
    return (per_fragment.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("overlap"))
            .filter(100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap")))
            .select("a", "b", "overlap"))


def _written(spark: SparkSession, df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def near_duplicate_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, cls`` of every row, and ``cls, root, component_id`` of every class.

    ``root`` is a class that names the component even where no row of it has a ``doc_id``.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "ngram-join")
    facts = _written(spark, screen(docs, words, percent), folder, "facts")
    classes = (facts.filter("cls IS NOT NULL").groupBy("cls")
               .agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("open").alias("open")))
    classes = _written(spark, classes, folder, "classes")
    known = classes.agg(F.count(F.when(F.col("open"), 1)).alias("open"),
                        F.count(F.when(F.col("open") & F.col("doc_id").isNull(), 1)).alias("unnamed"),
                        F.sum(F.when(F.col("open"), F.col("n"))).alias("shingles")).first()

    roots = spark.createDataFrame([], "node decimal(38,0), root decimal(38,0)")
    if known["open"]:
        fragments = max(8, -(-known["shingles"] // FRAGMENT_SHINGLES))

        def segments_of(texts):
            return texts.select("doc_id", "text").mapInArrow(
                lambda batches: _segment_rows(batches, words, fragments),
                "cls decimal(38,0), n long, fragment int, keys array<long>")

        def told(some):
            return F.broadcast(some) if known["open"] <= TOLD_DOCUMENTS else some

        segments = segments_of(docs.select("doc_id", "text").join(
            told(classes.filter("open AND doc_id IS NOT NULL").select("doc_id")), "doc_id", "left_semi"))
        if known["unnamed"]:  # classes without an id are found by their texts
            unnamed = told(classes.filter("open AND doc_id IS NULL").select("cls"))
            segments = segments.unionByName(segments_of(docs.filter("doc_id IS NULL")).join(unnamed, "cls", "left_semi"))
        segments = _written(spark, segments, folder, "segments")
        entries = _written(spark, prefix_entries(segments, percent), folder, "entries")
        first = _written(spark, pivot_pairs(entries, percent), folder, "pairs-1")
        links = _written(spark, linked_pairs(first, segments, percent), folder, "links-1")
        roots = connected_components(links.select("a", "b"))
        second = _written(spark, remaining_pairs(entries, roots, first, percent), folder, "pairs-2")
        more = _written(spark, linked_pairs(second, segments, percent), folder, "links-2")
        if not more.isEmpty():
            roots = connected_components(links.select("a", "b").unionByName(more.select("a", "b")))

    named = (classes.select("cls", "doc_id").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("root", F.coalesce("root", "cls")))
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return facts.select("doc_id", "n", "cls"), named.join(names, "root").select("cls", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document."""
    facts, classes = near_duplicate_classes(docs, words, percent)
    return (facts.join(classes.select("cls", "component_id"), "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
