"""Token ids in compressed binary shards: one zstandard frame a document, one shared dictionary.

``encode_to_files`` encodes every whole text, appends the end id and writes
shards in ascending ``doc_id`` order; ``read_token_files`` reads them back, and
``read_document`` fetches one short document with three range reads.

A shard file holds: the magic and a JSON header (id width in bytes, dictionary
hash, number of documents, number of ids), the frames, then the offset index
(doc_id, first id's position in the shard, frame offset; int64 each, and a
presence byte for a NULL doc_id) and an 8-byte index position. The dictionary is
a file of its own beside the shards, named by its SHA-256; a reader checks it.

How it runs: documents are range-partitioned by ``doc_id`` (the only shuffle of
texts), each task encodes, compresses and writes its range. Shards are in
order, so a document's ``start`` is its shard's first position, a running sum
over the shard list (one entry a partition), plus its position in the shard.
Distinct text pieces are encoded once per worker (see ``pieces``); that
dictionary is emptied when it reaches ``PIECES_KEPT`` entries.

Cases with a defined result: a NULL or empty text has the end id alone; a NULL
``doc_id`` sorts first; repeated rows are each a document, ordered by text hash;
an empty table writes no shard and reads back as no rows; very long texts are
one frame; other columns are not read. The dictionary is fitted on a bounded
sample (``DICTIONARY_SAMPLE`` documents chosen by hash, ``SAMPLE_IDS`` ids of each, in one task); below
``DICTIONARY_LEAST`` documents there is none and frames stand alone.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
import struct
import sys
import zlib
from array import array
from collections.abc import Iterable
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.llm.files import RangeReader, write_file
from tapecraft.llm.pieces import split_pieces

MAGIC = b"TKZS0001"
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
DICTIONARY_SAMPLE = 1000
#: Ids of a sampled document that the dictionary is fitted on, at most.
SAMPLE_IDS = 8192
DICTIONARY_LEAST = 16
PIECES_KEPT = 1_000_000
INDEX_ROW = np.dtype([("doc_id", "<i8"), ("present", "u1"), ("position", "<i8"), ("offset", "<i8")])


_ENCODERS: dict[str, PieceEncoder] = {}
_ID = attrgetter("id")


class _Filled(dict):
    """A dictionary that makes a missing key's value."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        found = self[key] = self.make(key)
        return found


class PieceEncoder:
    """Serialised ids of texts, from a bounded dictionary of pieces encoded by the tokenizers library.

    For byte-level BPE files that split by the usual pattern. A piece of Latin
    letters, or of matches of the pattern below U+0250, goes straight to the
    file's BPE model; any other piece, or one that holds a special token's
    string, goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        if self.tokenizer.normalizer is not None or "ByteLevel" not in str(self.tokenizer.pre_tokenizer):
            raise ValueError(f"{tokenizer_file} is not a plain byte-level BPE tokenizer")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(s.isalpha() or any(c in s for c in " \n.,") for s in self.special):
            raise ValueError(f"{tokenizer_file} has a special token of letters alone, or one that would be cut")
        self.matches = regex.compile(public_tokenizers.PATTERN).findall
        # the printable stand-ins of bytes: Latin-1 graphic characters for themselves, the others from U+0100 on
        graphic = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in graphic)}
        self.stand_in = "".join(others.get(b, chr(b)) for b in range(256))
        self.kept = _Filled(self._piece_ids)

    @classmethod
    def of(cls, tokenizer_file: str) -> PieceEncoder:
        """This worker process's encoder; its dictionary serves the worker's later tasks too."""
        if tokenizer_file not in _ENCODERS:
            _ENCODERS[tokenizer_file] = cls(tokenizer_file)
        return _ENCODERS[tokenizer_file]

    def serialise(self, ids: Iterable[int]) -> bytes:
        packed = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _model_ids(self, match: str) -> bytes:
        as_bytes = codecs.charmap_decode(match.encode(), "strict", self.stand_in)[0]
        return self.serialise(map(_ID, self.model.tokenize(as_bytes)))

    def _piece_ids(self, piece: str) -> bytes:
        if not piece:
            return b""
        latin = piece.isascii() or max(piece) < "\u0250"
        if latin and (piece[1:] if piece[0] == " " else piece).isalpha():
            return self._model_ids(piece)
        if not latin or any(s in piece for s in self.special):
            return self.serialise(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        matches = self.matches(piece)
        if len(matches) == 1:
            return self._model_ids(piece)
        return b"".join([self.kept[m] for m in matches])

    def encode(self, text: str) -> bytes:
        if len(self.kept) > PIECES_KEPT:
            self.kept.clear()
        return b"".join(map(self.kept.__getitem__, split_pieces(text)))


def _rows(batches):
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield doc_id, text or ""


def train_dictionary(docs: DataFrame, tokenizer_file: str, end_id: int) -> bytes:
    """A zstandard dictionary fitted on pieces of the serialised ids of a bounded sample of documents.

    Of a sampled document goes at most one piece of ``SAMPLE_IDS`` ids, from a place
    by hash; one task trains on at most ``2 * DICTIONARY_SAMPLE`` pieces, and the
    driver gets the dictionary alone.
    """
    rows = docs.count()
    every = max(1, rows // DICTIONARY_SAMPLE)

    def serialise(batches):
        encoder = PieceEncoder.of(tokenizer_file)
        end = encoder.serialise([end_id])
        most = SAMPLE_IDS * encoder.width
        for batch in batches:
            pieces = []
            for text in batch.column(1).to_pylist():
                ids = encoder.encode(text or "") + end
                places = max(len(ids) - most, 0) // encoder.width + 1
                begin = zlib.crc32(ids) % places * encoder.width
                pieces.append(ids[begin:begin + most])
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["ids"])

    def train(batches):
        samples = sorted(x for batch in batches for x in batch.column(0).to_pylist())
        if len(samples) < DICTIONARY_LEAST:
            return
        try:
            fitted = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little variety to fit one
            return
        yield pa.RecordBatch.from_arrays([pa.array([fitted], pa.binary())], names=["dictionary"])

    sample = (docs.filter(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(every)) == 0)
              .select("doc_id", "text").mapInArrow(serialise, "ids binary"))
    fitted = sample.limit(2 * DICTIONARY_SAMPLE).repartition(1).mapInArrow(train, "dictionary binary").collect()
    return bytes(fitted[0]["dictionary"]) if fitted else b""


def _write_shard(batches, folder, tokenizer_file, end_id, dictionary, dictionary_hash):
    encoder = PieceEncoder.of(tokenizer_file)
    end = encoder.serialise([end_id])
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if shared:
        shared.precompute_compress(LEVEL)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
    shard = TaskContext.get().partitionId()
    totals = {"documents": 0, "ids": 0}
    index = []

    def chunks():
        offset = 0
        for doc_id, text in _rows(batches):
            ids = encoder.encode(text) + end
            frame = compressor.compress(ids)
            index.append((doc_id or 0, doc_id is not None, totals["ids"], offset))
            totals["documents"] += 1
            totals["ids"] += len(ids) // encoder.width
            offset += len(frame)
            yield frame
        table = np.array(index, INDEX_ROW).tobytes()
        header = json.dumps({"width": encoder.width, "dictionary": dictionary_hash, **totals}).encode()
        yield table + header + struct.pack("<QQQ", offset, len(table), len(header)) + MAGIC

    first = next(batches, None)
    while first is not None and first.num_rows == 0:
        first = next(batches, None)
    if first is None:
        return
    batches = _chain(first, batches)
    uri = f"{folder}/shard-{shard:06d}.tkz"
    write_file(uri, chunks())
    yield pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([uri]), pa.array([totals["documents"]], pa.int64()),
         pa.array([totals["ids"]], pa.int64())], names=["shard", "uri", "documents", "ids"])


def _chain(first, rest):
    yield first
    yield from rest


def encode_to_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int) -> list[tuple[int, str, int, int]]:
    """Write all documents as shards; returns the shard list (shard, uri, documents, ids) in order."""
    dictionary = train_dictionary(docs, tokenizer_file, end_id)
    name = hashlib.sha256(dictionary).hexdigest()
    if dictionary:
        write_file(f"{folder}/{name}.dict", [dictionary])

    def write(batches):
        yield from _write_shard(iter(batches), folder, tokenizer_file, end_id, dictionary, name)

    # the text's hash is part of the key, so that rows of a repeated id are spread
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    shards = ordered.mapInArrow(write, "shard int, uri string, documents long, ids long").collect()
    return sorted(tuple(r) for r in shards)


class ShardReader:
    """Documents of one shard by range reads: footer, index, then single frames."""

    def __init__(self, uri: str, reader: RangeReader | None = None):
        self.uri, self.reader = uri, reader or RangeReader()
        tail = self.reader.size(uri) - 24 - len(MAGIC)
        foot = self.reader.read(uri, tail, 24 + len(MAGIC))
        if foot[24:] != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        self.frames_end, table, header = struct.unpack("<QQQ", foot[:24])
        rest = self.reader.read(uri, self.frames_end, table + header)
        self.index = np.frombuffer(rest[:table], INDEX_ROW)
        self.header = json.loads(rest[table:])
        self.kind = f"<u{self.header['width']}"
        shared = None
        if self.header["dictionary"] != hashlib.sha256(b"").hexdigest():
            place = f"{uri.rpartition('/')[0]}/{self.header['dictionary']}.dict"
            own = RangeReader()
            content = own.read(place, 0, own.size(place))
            own.close()
            if hashlib.sha256(content).hexdigest() != self.header["dictionary"]:
                raise ValueError(f"{place} does not have the hash in its name")
            shared = zstandard.ZstdCompressionDict(content)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=shared)

    def frame_end(self, k: int) -> int:
        return int(self.index["offset"][k + 1]) if k + 1 < len(self.index) else self.frames_end

    def ids(self, k: int) -> np.ndarray:
        begin = int(self.index["offset"][k])
        frame = self.reader.read(self.uri, begin, self.frame_end(k) - begin)
        return np.frombuffer(self.decompressor.decompress(frame), self.kind)

    def documents(self, block: int = 8 << 20):
        """(doc_id or None, position in the shard, ids) of every document, reading long ranges."""
        k, n = 0, len(self.index)
        while k < n:
            begin = int(self.index["offset"][k])
            last = max(int(np.searchsorted(self.index["offset"], begin + block)), k + 1)
            data = self.reader.read(self.uri, begin, self.frame_end(last - 1) - begin)
            for i in range(k, last):
                row = self.index[i]
                frame = data[int(row["offset"]) - begin:self.frame_end(i) - begin]
                yield (int(row["doc_id"]) if row["present"] else None, int(row["position"]),
                       np.frombuffer(self.decompressor.decompress(frame), self.kind))
            k = last


def read_document(uri: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document of a shard, without reading the other frames; None if it has none."""
    shard = ShardReader(uri)
    at = np.flatnonzero((shard.index["doc_id"] == doc_id) & (shard.index["present"] == 1))
    return shard.ids(int(at[0])) if len(at) else None


def read_token_files(spark: SparkSession, shards: list[tuple[int, str, int, int]]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files; one task a shard."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return spark.createDataFrame([], schema)
    starts = np.concatenate([[0], np.cumsum([s[3] for s in shards])]).tolist()
    uris = [s[1] for s in shards]

    def read(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                found = [(d, starts[k] + p, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                         for d, p, ids in ShardReader(uris[k]).documents()]
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(shards), 1, len(shards)).mapInArrow(read, schema)
