import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tapecraft.llm.bpe import Words, decode, encode_documents, encode_words, read_ranks, round_trip
from tapecraft.llm.words import text_blocks
from tests.llm.util import ODD_TEXTS, docs_table, prose

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(FILE), special_tokens={})


def rows_of():
    return list(enumerate(ODD_TEXTS)) + [(50 + i, prose(i, 80) + "." + prose(i + 7, 9)) for i in range(12)] + [(50, prose(0, 80))]


def test_round_trip_matches_the_library(spark):
    def sha(x):
        return hashlib.sha256(x).hexdigest()

    rows = rows_of()
    want = [(i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))
            for i, t in rows for ids in [ENCODING.encode_ordinary(t or "")]]
    assert sorted(map(tuple, round_trip(docs_table(spark, rows), FILE).collect())) == sorted(want)


@pytest.mark.parametrize("told", [0, 60])
def test_words_beyond_the_told_ones_are_folded_in_their_blocks(spark, told):
    got = encode_documents(docs_table(spark, rows_of()), FILE, told_words=told).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((i, ENCODING.encode_ordinary(t or "")) for i, t in rows_of())


def test_fold_and_decode_of_single_words(spark):
    words = ["a", " the", "ción", "你好", "\x00\x01", "aaaaaaaaaaaaaaaa", " tokenization", "🙂🙂", "x" * 500]
    row = spark.createDataFrame([(words,)], "w array<string>").select(encode_words(F.col("w"), FILE).alias("ids")).first()
    assert row.ids == [ENCODING.encode_ordinary(w) for w in words]
    ids = spark.createDataFrame([(sum(row.ids, []),), ([],)], "ids array<int>")
    assert [bytes(r[0]) for r in ids.select(decode(F.col("ids"), FILE)).collect()] == ["".join(words).encode(), b""]


def test_empty_table(spark):
    assert round_trip(docs_table(spark, []), FILE).collect() == []


def test_words_are_the_matches_of_the_pattern():
    rng = random.Random(4)
    letters = ["a", "Z", "é", "ß", "Œ", "ŉ", "ƀ", "×", "÷", "1", "٣", " ", " ", "\n", "\t", "\xa0", "\x1c", "'s", "'", ",", "—", "你", "🙂", "\x00"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [t or "" for t in ODD_TEXTS]
    texts += [prose(i, 30) + rng.choice([".", ",\n", " ", "\n\n", "!? "]) + prose(i + 1, 5) for i in range(50)]
    for _, offsets, data in text_blocks(pa.array(texts), 1 << 10):
        words = Words(offsets, data)
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            text = data[a:b].tobytes().decode()
            found = [words.text(k) for k in range(words.bounds[i], words.bounds[i + 1])]
            assert found == regex.findall(public_tokenizers.PATTERN, text), repr(text)
