"""Fingerprints against votes counted bit by bit; block tables against all pairs."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tapecraft.llm import simhash
from tests.llm.util import ODD_TEXTS, docs_table, prose, words_of


def fingerprint(text):
    words = words_of(text.lower())
    votes = [0] * 64
    for i, word in enumerate(words):
        value = xxhash.xxh64_intdigest(word.encode(), 42)
        if i + 1 < len(words):
            value = xxhash.xxh64_intdigest(words[i + 1].encode(), value)
        for bit in range(64):
            votes[bit] += (2 if len(word) >= 7 else 1) * (1 if value >> bit & 1 else -1)
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


def distance(a, b):
    return bin(a ^ b).count("1")


def expected(rows, is_query):
    """rows: (doc_id, text) in the order of the chain."""
    prints = [fingerprint(text or "") for _, text in rows]
    found = []
    for i, (doc_id, text) in enumerate(rows):
        text, (_, following) = text or "", rows[(i + 1) % len(rows)]
        third = len(text) // 3
        edited = text[:len(text) - third] + (following or "")[:third]
        own, changed = prints[i], fingerprint(edited)
        near = sum(distance(own, p) <= simhash.RADIUS for p in prints) if doc_id is not None and is_query(doc_id) else None
        found.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{own:016x}", f"{changed:016x}",
                      1 - distance(own, changed) / 64, 1 - distance(own, prints[(i + 1) % len(rows)]) / 64, near))
    return sorted(found, key=repr)


def report(spark, rows, every=2):
    found = simhash.fingerprint_report(spark, docs_table(spark, rows), F.col("doc_id") % every == 0)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_fingerprints_of_whole_texts_and_their_edits(spark):
    base = prose(1, 300)
    texts = [*ODD_TEXTS, prose(2, 20_000), base, base, base.replace(" ", "  "), base + " tail", *[prose(k, 40) for k in range(3, 40)]]
    rows = [(7 * i - 30, text) for i, text in enumerate(texts)]
    assert report(spark, rows) == expected(rows[::-1], lambda d: d % 2 == 0)


def test_null_and_repeated_ids_follow_each_other(spark):
    def tie(text):
        return xxhash.xxh64_intdigest((text or "").encode(), 42) >> 1
    rows = [(None, prose(k, 30)) for k in range(40)] + [(5, prose(k, 30)) for k in range(100, 180)] + [(5, "same")] * 3
    rows += [(k, prose(k, 20)) for k in range(20, 30)] + [(1, None)]
    chain = sorted(rows, key=lambda r: (r[0] is not None, -(r[0] or 0), tie(r[1])))
    assert report(spark, rows) == expected(chain, lambda d: d % 2 == 0)


def test_one_row_and_no_row(spark):
    assert report(spark, [(3, "one two three")]) == expected([(3, "one two three")], lambda d: d % 2 == 0)
    assert report(spark, []) == []


@pytest.mark.parametrize("radius, blocks", [(3, 5), (2, 4), (0, 1)])
def test_block_tables_find_all_pairs_within_the_radius(spark, radius, blocks):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(6):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    table = spark.createDataFrame([(s, 1) for s in signed.values()], "f long, n long")
    found = simhash.near_fingerprints(table, table, radius, blocks).collect()
    want = {(signed[a], signed[b], distance(a, b)) for a in prints for b in prints if distance(a, b) <= radius}
    assert len(found) == len(want) and {(r["query"], r["found"], r["distance"]) for r in found} == want


def test_more_blocks_than_the_radius():
    with pytest.raises(ValueError):
        simhash.block_masks(3, 3)
