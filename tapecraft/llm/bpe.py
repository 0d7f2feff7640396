"""Byte-level BPE by ranks: encoding folds ranked merges in Spark higher-order functions.

``encode_word`` turns a word into ids. Its bytes become ids, and an ``aggregate``
merges the leftmost pair of lowest rank until no pair has one. The state is two
strings with one character an id: the ids, and the ranks of neighbours (a merged
pair's rank is its id), so a merge looks up only the two pairs that it changes,
and cutting and joining are string functions, which cost a fraction of those on
arrays. The rank map is a literal: two arrays, keys and ranks, with two places
for each pair of ids (cuckoo hashing), so a look-up is at most two array reads.

``encode_documents`` folds each distinct word of the corpus once, not each
occurrence. Tasks cut their texts into words (pre-tokens by the pattern) and list
the distinct ones by hash, Spark makes them distinct and folds them; the results,
as (hash, ids), are told to the tasks, which put the documents together in numpy.
Their number is checked first: beyond ``TOLD_WORDS`` only words of the most tasks
are told, and each block of documents folds its remaining words itself, by the
same expression. So any vocabulary works, nothing is dropped, and no text is
shuffled. Hashes have 64 bits; a chance match of two words would show in the
round trip.

``decode`` concatenates the byte pieces of ids, in Spark expressions. The
round trip checks every document: its decoded bytes must be its text.

Cases with a defined result: a NULL or empty text has no ids and decodes to no
bytes; a NULL ``doc_id`` stays NULL; repeated rows are encoded row by row; texts
are encoded whole, a long one is a block of its own; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import base64
import json
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import regex
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.llm.files import open_store
from tapecraft.llm.memory import release_unused
from tapecraft.llm.words import text_blocks, word_hashes
from tapecraft.session import scratch_path

#: Distinct words whose ids are told to every task, at most: about 20 bytes each.
TOLD_WORDS = 8_000_000
#: Text bytes of a block of documents, about; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19
#: Characters of a plan's description that Spark keeps of the fold: its literal has millions.
PLAN_TEXT = 1 << 16
#: Hashes of words that a listing task remembers.
WORDS_KEPT = 1_000_000
#: Characters of the state: an id is the character this far on; two beyond all ids stand for
#: no rank and for the ends of a word.
FIRST = 0x100
NO_RANK, END = chr(0xD7FF), chr(0xD7FE)
PLACES = 1 << 18
MIX = (1640531527, 1181783497)
SHIFT = (22, 24)


def read_ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


# --- the literal rank map --------------------------------------------------------------------------------------

def _places(key: int) -> tuple[int, int]:
    return ((key * MIX[0]) >> SHIFT[0]) % PLACES, ((key * MIX[1]) >> SHIFT[1]) % PLACES


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of ids whose bytes together are a piece, as ``left * 2^16 + right`` of their characters, to its id."""
    if max(ranks.values()) >= ord(END) - FIRST:
        raise ValueError("an id has no character")
    found = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                found[(left + FIRST) << 16 | (right + FIRST)] = rank
    return found


@lru_cache(maxsize=2)
def _rank_arrays(rank_file: str) -> tuple[str, str, str, str]:
    """The literal's arrays as JSON: keys and ranks by place, the ids of the 256 bytes, and every id's bytes in hex."""
    ranks = read_ranks(rank_file)
    keys, values = [-1] * PLACES, [NO_RANK] * PLACES
    for key, rank in pair_ranks(ranks).items():
        value, place = chr(rank + FIRST), _places(key)[0]
        for _ in range(500):
            key, keys[place] = keys[place], key
            value, values[place] = values[place], value
            if key < 0:
                break
            first, second = _places(key)
            place = second if place == first else first
        else:
            raise ValueError("the rank map does not fit its places")
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex().upper()
    letters = [chr(ranks[bytes([b])] + FIRST) for b in range(256)]
    made = tuple(json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in (keys, values, letters, pieces))
    del ranks, keys, values, pieces
    release_unused()  # the driver's memory is small beside the lists and maps that made these
    return made


def _let(value: Column, body) -> Column:
    """``body`` with the value computed once: in higher-order functions a repeated expression runs repeatedly."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- the fold --------------------------------------------------------------------------------------------------

def _pair_rank(table: dict[str, Column], left: Column, right: Column) -> Column:
    def find(key: Column) -> Column:
        at = [(F.shiftright(key * F.lit(MIX[k]), SHIFT[k]) % PLACES).cast("int") for k in range(2)]
        return (F.when(F.get(table["keys"], at[0]) == key, F.get(table["ranks"], at[0]))
                .when(F.get(table["keys"], at[1]) == key, F.get(table["ranks"], at[1])).otherwise(F.lit(NO_RANK)))

    return _let(F.ascii(left).cast("long") * 65536 + F.ascii(right), find)


def _merge(table: dict[str, Column], state: Column) -> Column:
    """Merge the leftmost pair of lowest rank; ``p`` are the ids between two ends, ``r`` the ranks of neighbours."""
    p, r, one, rest = state["p"], state["r"], F.lit(1), F.lit(1 << 30)

    def at_place(best: Column, at: Column) -> Column:
        left, right = F.substring(p, at - 1, one), F.substring(p, at + 2, one)
        return F.struct(
            F.concat(F.substring(p, one, at - 1), best, F.substring(p, at + 2, rest)).alias("p"),
            F.concat(F.substring(r, one, at - 2), _pair_rank(table, left, best), _pair_rank(table, best, right),
                     F.substring(r, at + 2, rest)).alias("r"))

    return _let(F.array_min(F.split(r, "")), lambda best: F.when(best == NO_RANK, state).otherwise(
        _let(F.instr(r, best), lambda at: at_place(best, at))))


def encode_word(table: dict[str, Column], word: Column) -> Column:
    """Ids of one word that is not empty (array<int>)."""
    letters = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")  # one character a byte

    def fold(ids: Column) -> Column:
        pairs = F.transform(F.slice(ids, F.lit(2), F.size(ids)), lambda x, i: _pair_rank(table, F.get(ids, i), x))
        p = F.concat(F.lit(END), F.array_join(ids, ""), F.lit(END))
        r = F.concat(F.lit(NO_RANK), F.array_join(pairs, ""), F.lit(NO_RANK))
        return F.aggregate(F.slice(ids, F.lit(2), F.size(ids)), F.struct(p.alias("p"), r.alias("r")),
                           lambda state, _: _merge(table, state),
                           lambda state: F.transform(F.split(F.substring(state["p"], F.lit(2), F.length(state["p"]) - 2), ""),
                                                     lambda c: F.ascii(c) - FIRST))

    return _let(F.transform(letters, lambda c: F.get(table["bytes"], F.ascii(c))), fold)


def encode_words(words: Column, rank_file: str) -> Column:
    """Ids of each word of an array column: array<array<int>>."""
    keys, values, letters, _ = _rank_arrays(rank_file)
    literal = F.struct(F.from_json(F.lit(keys), "array<bigint>").alias("keys"),
                       F.from_json(F.lit(values), "array<string>").alias("ranks"),
                       F.from_json(F.lit(letters), "array<string>").alias("bytes"))

    def with_arrays(t: Column) -> Column:
        return _let(t["keys"], lambda k: _let(t["ranks"], lambda r: _let(t["bytes"], lambda b: F.transform(
            words, lambda w: encode_word({"keys": k, "ranks": r, "bytes": b}, w)))))

    return _let(literal, with_arrays)


def decode(ids: Column, rank_file: str) -> Column:
    """The bytes of an array of ids: their pieces, one after the other (binary)."""
    pieces = F.from_json(F.lit(_rank_arrays(rank_file)[3]), "array<string>")
    return F.unhex(F.array_join(_let(pieces, lambda p: F.transform(ids, lambda i: F.get(p, i))), ""))


# --- words -----------------------------------------------------------------------------------------------------

_MATCHES = regex.compile(public_tokenizers.PATTERN).findall

# Byte classes of plain texts: space, newline, letter, digit, other; PATTERN only for the rest.
_SPACE, _NEWLINE, _LETTER, _DIGIT, _OTHER, _PATTERN = range(6)
_CLASS = np.full(256, _PATTERN, np.uint8)
_CLASS[0x21:0x7F] = _OTHER
_CLASS[[0x20, 0x0A, 0x27]] = _SPACE, _NEWLINE, _PATTERN
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, 0xC4, 0xC5, *range(0x80, 0xC0)]] = _LETTER


class Words:
    """The pattern's matches of a run of texts, as byte ranges and hashes of the texts' UTF-8.

    In a plain text -- ASCII and Latin letters up to U+017F, no apostrophe, white
    space only as single spaces and newlines -- a match starts at each space and
    newline, after a newline, and wherever letters, digits and other characters
    meet; numpy finds these places for all texts at once. Any other text is cut
    by the pattern itself.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        self.data = data
        kind = _CLASS[data]
        before = np.empty_like(kind)
        before[1:], before[:1] = kind[:-1], _PATTERN
        edge = offsets[:-1][np.diff(offsets) > 0]
        start = (kind <= _NEWLINE) | (before == _NEWLINE) | ((kind != before) & (before != _SPACE))
        start[edge] = True
        odd = kind == _PATTERN
        odd |= (kind <= _NEWLINE) & (before <= _NEWLINE)
        odd[edge] = kind[edge] == _PATTERN
        times = np.flatnonzero((data == 0x97) | (data == 0xB7))  # the signs among the letters of U+00C0 to U+00FF
        odd[times[data[times - 1] == 0xC3]] = True
        upto = np.concatenate([[0], np.cumsum(odd)])
        for i in np.flatnonzero(upto[offsets[1:]] > upto[offsets[:-1]]):
            a, b = int(offsets[i]), int(offsets[i + 1])
            sizes = [len(w.encode()) for w in _MATCHES(data[a:b].tobytes().decode())]
            start[a:b] = False
            start[a + np.cumsum([0, *sizes[:-1]])] = True
        self.begin = np.flatnonzero(start)
        self.end = np.concatenate([self.begin[1:], [len(data)]]) if len(self.begin) else self.begin
        self.bounds = np.searchsorted(self.begin, offsets)
        self.hashes = word_hashes(data, self.begin, self.end)

    def text(self, k: int) -> str:
        return self.data[self.begin[k]:self.end[k]].tobytes().decode()


def _signed(hashes: np.ndarray) -> np.ndarray:
    """As longs whose signed order is the unsigned order of the hashes."""
    return (hashes ^ np.uint64(1 << 63)).view(np.int64)


def _list_words(batches):
    """Distinct words of a task's texts and their hashes (again once the task has forgotten a word)."""
    release_unused()
    seen = np.zeros(0, np.uint64)
    for batch in batches:
        for _, offsets, data in text_blocks(batch.column(0), BLOCK_BYTES):
            words = Words(offsets, data)
            hashes, first = np.unique(words.hashes, return_index=True)
            fresh = ~np.isin(hashes, seen, assume_unique=True)
            hashes, first = hashes[fresh], first[fresh]
            seen = hashes if len(seen) > WORDS_KEPT else np.concatenate([seen, hashes])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(hashes)), pa.array([words.text(k) for k in first.tolist()], pa.string())],
                names=["hash", "word"])


class Vocabulary:
    """Ids of told words: their hashes in order, and the ids one after the other."""

    _held: dict[str, Vocabulary] = {}

    def __init__(self, folder: str):
        store, path = open_store(folder)
        names = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))
        words = sum(pq.read_metadata(store.open_input_file(name)).num_rows for name in names)
        self.hashes = np.empty(words, np.int64)
        self.ends = np.zeros(words + 1, np.uint32)  # no more than TOLD_WORDS words, so 32 bits hold their ids' places
        ids, at = [np.zeros(0, np.uint16)], 0
        for name in names:  # files and their rows are in the order of the hashes
            for batch in pq.ParquetFile(store.open_input_file(name)).iter_batches(1 << 15, columns=["hash", "ids"]):
                lists, n = batch.column(1), batch.num_rows
                self.hashes[at:at + n] = batch.column(0).to_numpy()
                self.ends[at + 1:at + n + 1] = np.cumsum(np.diff(lists.offsets.to_numpy())) + self.ends[at]
                ids.append(lists.flatten().to_numpy().astype(np.uint16))
                at += n
        self.ids = np.concatenate(ids)

    @classmethod
    def of(cls, folder: str) -> Vocabulary:
        """This worker's copy of a told vocabulary; only the latest one is held."""
        if folder not in cls._held:
            cls._held.clear()
            cls._held[folder] = cls(folder)
        return cls._held[folder]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where the word was not told."""
        asked = _signed(hashes)
        if not len(self.hashes):
            return np.full(len(asked), -1)
        at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        return np.where(self.hashes[at] == asked, at, -1)


def _spans(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions ``begin[i] .. begin[i] + sizes[i] - 1`` of all i, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begin - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Block:
    """A run of texts on the way to their ids."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, vocabulary: Vocabulary):
        self.words, self.vocabulary = Words(offsets, data), vocabulary
        self.hashes, self.first, self.back = np.unique(self.words.hashes, return_index=True, return_inverse=True)
        self.place = vocabulary.find(self.hashes)
        self.untold = np.flatnonzero(self.place < 0)

    def missing(self) -> list[str]:
        return [self.words.text(k) for k in self.first[self.untold].tolist()]

    def ids(self, folded: list[list[int]]) -> pa.ListArray:
        """Ids of each text; ``folded`` are those of the missing words, in their order."""
        ends = self.vocabulary.ends
        begin = ends[self.place].astype(np.int64)
        sizes = ends[self.place + 1].astype(np.int64) - begin
        own = [np.array(x, np.uint16) for x in folded]
        sizes[self.untold] = [len(x) for x in own]
        told = self.place >= 0
        pool = np.concatenate([self.vocabulary.ids[_spans(begin[told], sizes[told])], *own])
        place = np.empty(len(sizes), np.int64)  # where each distinct word's ids begin in the pool
        place[told] = np.cumsum(sizes[told]) - sizes[told]
        place[self.untold] = int(sizes[told].sum()) + np.cumsum(sizes[self.untold]) - sizes[self.untold]
        each = sizes[self.back]
        flat = pool[_spans(place[self.back], each)].astype(np.int32)
        bounds = np.concatenate([[0], np.cumsum(each)])[self.words.bounds]
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))


def _blocks(batches):
    """(doc_ids, texts, offsets, data) of runs of documents; a NULL text is an empty one."""
    for batch in batches:
        texts = batch.column(1)
        texts = texts.fill_null("") if texts.null_count else texts
        for first, offsets, data in text_blocks(texts, BLOCK_BYTES):
            rows = len(offsets) - 1
            yield batch.column(0).slice(first, rows), texts.slice(first, rows), offsets, data


@contextmanager
def _short_plan_texts(spark: SparkSession):
    """Bound the plan texts that the driver makes and keeps of the queries inside."""
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, str(PLAN_TEXT))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def told_vocabulary(spark: SparkSession, docs: DataFrame, rank_file: str, folder: str, most: int) -> tuple[str, bool]:
    """Fold the corpus's distinct words and write (hash, ids); returns the folder and whether it holds all words."""
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = docs.select("text").mapInArrow(_list_words, "hash long, word string")
    words = listed.repartition(parts, "word").groupBy("word", "hash").agg(F.count("*").alias("tasks"))
    # dealt anew here, for the fold takes longer than it reads; its own plan then has no shuffle, so that the
    # literal is planned and described once and not at every adaptive step
    words.repartition(parts).write.mode("overwrite").parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    total = words.count()
    if total > most:
        left, least = 0, None
        for row in words.groupBy("tasks").count().orderBy(F.col("tasks").desc()).collect():  # one row a number of tasks
            left += row["count"]
            if left > most:
                break
            least = row["tasks"]
        words = words.filter(F.col("tasks") >= least) if least else words.limit(0)
    folded = words.select(
        "hash", F.get(encode_words(F.array("word"), rank_file), F.lit(0)).alias("ids"))
    with _short_plan_texts(spark):
        folded.write.mode("overwrite").parquet(f"{folder}/folded")
    # sorted once here, so that no task has to sort or gather the whole
    (spark.read.parquet(f"{folder}/folded").repartitionByRange(parts, "hash").sortWithinPartitions("hash")
     .write.mode("overwrite").parquet(f"{folder}/vocabulary"))
    return f"{folder}/vocabulary", total <= most


def encode_documents(docs: DataFrame, rank_file: str, told_words: int = TOLD_WORDS) -> DataFrame:
    """``doc_id, text, ids`` of every document; a NULL text becomes an empty one."""
    spark = docs.sparkSession
    release_unused()
    folder = scratch_path(spark, "bpe")
    vocabulary, complete = told_vocabulary(spark, docs, rank_file, folder, told_words)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = "doc_id long, text string, ids array<int>"

    if complete:
        def encode(batches):
            release_unused()
            told = Vocabulary.of(vocabulary)
            for ids, texts, offsets, data in _blocks(batches):
                block = Block(offsets, data, told)
                if len(block.untold):
                    raise ValueError("a word of the corpus is not in its vocabulary")
                yield pa.RecordBatch.from_arrays([ids, texts, block.ids([])], names=["doc_id", "text", "ids"])

        return rows.mapInArrow(encode, out)

    def gather(batches):
        release_unused()
        told = Vocabulary.of(vocabulary)
        for ids, texts, offsets, data in _blocks(batches):
            columns = [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([texts.to_pylist()], pa.list_(pa.string())),
                       pa.array([Block(offsets, data, told).missing()], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "texts", "words"])

    def finish(batches):
        told = Vocabulary.of(vocabulary)
        for batch in batches:
            for ids, texts, folded in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                column = pa.array(texts, pa.string())
                ((_, offsets, data),) = text_blocks(column, 1 << 62)
                found = Block(offsets, data, told).ids(folded)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), column, found], names=["doc_id", "text", "ids"])

    blocks = rows.mapInArrow(gather, "ids array<long>, texts array<string>, words array<string>")
    return blocks.withColumn("folded", encode_words(F.col("words"), rank_file)).mapInArrow(finish, out)


def round_trip(docs: DataFrame, rank_file: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode every whole text, then decode its ids."""
    encoded = encode_documents(docs, rank_file)
    decoded = encoded.withColumn("bytes", decode(F.col("ids"), rank_file))
    exact = F.col("bytes") == F.encode("text", "UTF-8")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.when(exact, F.sha2("bytes", 256)).otherwise(
            F.raise_error(F.lit("decoded bytes differ from the text"))).alias("decoded_sha256"))
