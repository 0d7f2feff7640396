import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tapecraft.llm import token_files
from tapecraft.llm.pieces import split_pieces
from tapecraft.llm.token_files import PieceEncoder, encode_to_files, read_document, read_token_files
from tests.llm.util import ODD_TEXTS, docs_table, prose

FILE = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tokenizer = Tokenizer.from_file(FILE)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, tmp_path):
    rows = [(100 - i, t) for i, t in enumerate(ODD_TEXTS)] + [(200 + i, prose(i, 60)) for i in range(40)]
    rows += [(None, "no id"), (300, prose(1, 20_000))]
    shards = encode_to_files(docs_table(spark, rows), str(tmp_path), FILE, 2)
    got = sorted((tuple(r) for r in read_token_files(spark, shards).collect()), key=lambda r: r[1])
    assert got == expected(rows)
    assert sum(s[2] for s in shards) == len(rows)


def test_dictionary_learns_from_bounded_pieces(spark, tmp_path, monkeypatch):
    rows = [(i, prose(i, 900)) for i in range(40)] + [(1, prose(2, 30 + i)) for i in range(30)]
    monkeypatch.setattr(token_files, "SAMPLE_IDS", 100)
    assert 0 < len(token_files.train_dictionary(docs_table(spark, rows), FILE, 2)) <= token_files.DICTIONARY_BYTES
    assert token_files.train_dictionary(docs_table(spark, rows[:3]), FILE, 2) == b""
    shards = encode_to_files(docs_table(spark, rows), str(tmp_path), FILE, 2)
    got = [tuple(r) for r in read_token_files(spark, shards).collect()]
    want = {(d, n, c) for d, _, n, c in expected(rows)}
    assert {(d, n, c) for d, _, n, c in got} == want and len(got) == len(rows)
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == sorted(d for d, _ in rows)


def test_one_document_by_range_reads(spark, tmp_path):
    shards = encode_to_files(docs_table(spark, [(i, prose(i, 50)) for i in range(60)]), str(tmp_path), FILE, 2)
    found = [x for x in (read_document(s[1], 17) for s in shards) if x is not None]
    assert len(found) == 1
    assert found[0].tolist() == Tokenizer.from_file(FILE).encode(prose(17, 50), add_special_tokens=False).ids + [2]


def test_repeated_rows_and_empty_table(spark, tmp_path):
    rows = [(1, "same text")] * 3 + [(1, "other"), (2, "end")]
    got = read_token_files(spark, encode_to_files(docs_table(spark, rows), str(tmp_path / "a"), FILE, 2)).collect()
    assert len(got) == 5 and sorted(r.start for r in got)[0] == 0
    assert sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)
    assert read_token_files(spark, encode_to_files(docs_table(spark, []), str(tmp_path / "b"), FILE, 2)).collect() == []


def test_pieces_encode_like_whole_texts():
    encoder, tokenizer = PieceEncoder(FILE), Tokenizer.from_file(FILE)
    for text in [t or "" for t in ODD_TEXTS] + [prose(i, 200) + ",\n\t " + prose(i + 1, 5) + "." for i in range(30)]:
        assert "".join(split_pieces(text)) == text
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plain_texts_are_cut_into_words():
    assert split_pieces("The end.\nNext, été, 4.") == ["The", " end", ".", "\n", "Next", ",", " été", ",", " 4", "."]
    for text in ["a..b c", "a, .b c", "(a). b", ".a b", "a_. b", "a\u0345. b", "\u4f60. b"]:  # a stop after no letter: cut at spaces alone
        assert split_pieces(text) == [" " * (k > 0) + x for k, x in enumerate(text.split(" "))]
    encoder, tokenizer = PieceEncoder(FILE), Tokenizer.from_file(FILE)
    rng = random.Random(8)
    parts = ["a", "été", "7", ".", ",", "\n", " ", "'", "'s", "\t", ")", "\r", "\u0345", "ß", "你", "\0", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(6000)]
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert "".join(split_pieces(text)) == text
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == found.ids, repr(text)


def test_random_texts_encode_like_the_tokenizer():
    rng = random.Random(6)
    letters = ["a", "Z", "é", "ß", "Œ", "ƀ", "×", "1", " ", " ", " ", "\n", "\t", "\xa0", "\x1c", "'s", "'", ",", ".", "—", "你", "🙂",
               "\x00", "<|endoftext|>", "the", "\ue000"]
    encoder, tokenizer = PieceEncoder(FILE), Tokenizer.from_file(FILE)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == found.ids, repr(text)
