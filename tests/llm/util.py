"""Tables and brute-force helpers for the operator tests."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, n long, cls string, block int, score string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_table(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); the table has further columns with clashing names."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, "en", "s1")[:4] if len(row) < 3 else (*row, "s1")[:4]
        full.append((doc_id, text, lang, source, None, -1, -1, "x", 0, "y"))
    return spark.createDataFrame(full, DOCS).repartition(3) if full else spark.createDataFrame([], DOCS)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    parts = ["ba", "lo", "ner", "it", "sha", "eau", "und", "ción", "que", "thr"]
    known = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(vocabulary)]
    return " ".join(rng.choice(known) for _ in range(words))


def words_of(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


ODD_TEXTS = [None, "", " ", "\n\n", "a", "one two three four", "  a  b\n c \n\n d", "ñandú—x 你好 世界 z \x85 q\xa0 r 12ab",
             "x" * 3000, "#*$ %&| <>", "é" * 40 + " " + "é" * 40, "it's <|endoftext|> x<|endoftext|>y"]
