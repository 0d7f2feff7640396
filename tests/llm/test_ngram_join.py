import random

import pytest

from tapecraft.llm import ngram_join
from tapecraft.llm.components import connected_components
from tapecraft.llm.ngram_join import banded_sides, class_names, near_duplicate_classes, near_duplicates, remaining_pairs
from tests.llm.util import ODD_TEXTS, docs_table, lower_ascii, prose, words_of


def shingles(text):
    words = words_of(lower_ascii(text or ""))
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, set()).add(shingles(t))
    flat = [(i, s) for i in sets if i is not None for s in sets[i] if s]
    root = {i: i for i, _ in flat}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, s) in enumerate(flat):
        for b, t in flat[:k]:
            both = len(s & t)
            if 100 * both >= 80 * (len(s) + len(t) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(shingles(t)), find(i) if shingles(t) else i) for i, t in rows if i is not None)


def edited(text, seed, edits):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + rng.randint(0, 2)] = [f"new{rng.random():.6f}"] * rng.randint(0, 2)
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    rows = [(i, prose(100 + i, rng.randint(1, 120), 3000)) for i in range(150)]
    base, passage = prose(1, 160, 3000), prose(2, 70, 3000)
    # near copies about the threshold, so that links, chains and near misses all occur
    rows += [(1000 + i, edited(base, i, i % 7)) for i in range(120)]
    rows += [(2000 + i, prose(500 + i, 60, 3000) + " " + passage + " " + prose(700 + i, 50, 3000)) for i in range(60)]
    rows += [(3000 + i, base.upper()) for i in range(40)]                        # copies but for case
    rows += [(4000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(4100, "One two THREE four"), (4101, "one two three four\n")]
    rows += [(5000 + i, prose(3, 30 + i, 3000)) for i in range(25)]              # each a little longer than the one before
    return rows


@pytest.mark.parametrize("fragment_shingles", [2_000_000, 500])
def test_components_match_brute_force(spark, monkeypatch, fragment_shingles):
    monkeypatch.setattr(ngram_join, "FRAGMENT_SHINGLES", fragment_shingles)
    rows = corpus()
    got = sorted(tuple(r) for r in near_duplicates(docs_table(spark, rows)).collect())
    assert got == brute(rows)


def test_remaining_documents_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TOLD_DOCUMENTS", 0)
    rows = corpus()[140:280]
    assert sorted(tuple(r) for r in near_duplicates(docs_table(spark, rows)).collect()) == brute(rows)


def test_nulls_repeated_rows_and_empty_table(spark):
    text = prose(9, 40)
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "alone in the world here"), (3, None), (None, None)]
    got = sorted((tuple(r) for r in near_duplicates(docs_table(spark, rows)).collect()), key=str)
    n = len(shingles(text))
    assert got == sorted([(1, n, 1), (1, n, 1), (2, n, 1), (None, n, 1), (None, 1, None), (3, 0, 3), (None, 0, None)], key=str)
    assert near_duplicates(docs_table(spark, [])).collect() == []


def chain(seed):
    """Three texts: the first and last are linked only through the second."""
    words = prose(seed, 60, 3000).split(" ")
    texts = [" ".join(words[k:k + 50]) for k in (0, 4, 8)]
    near = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in zip(texts, texts[1:] + texts[:1])]
    assert near[0] >= 0.8 and near[1] >= 0.8 > near[2]
    return texts


def test_links_through_documents_without_an_id(spark):
    a, b, c = chain(31)
    d, e, f = chain(32)
    rows = [(1, a), (None, b), (2, c), (None, b), (None, d), (None, e), (None, e + " "), (None, f), (None, "")]
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(docs_table(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1)] + [(None, 1)] * 2 + [(None, None)] * 5, key=str)
    facts, classes = near_duplicate_classes(docs_table(spark, rows))
    assert sorted(r["count"] for r in classes.groupBy("root").count().collect()) == [3, 3]
    named = class_names(docs_table(spark, rows).select("doc_id", "text")).select("cls").collect()
    assert sorted(map(str, named)) == sorted(str(r) for r in facts.select("cls").collect())


def test_sets_that_share_64_bits_of_their_names():
    keys = [list(range(k, k + 10)) for k in (0, 1, 100)]
    parts = ngram_join.pa.table({
        "fragment": ngram_join.pa.array([0] * 4, ngram_join.pa.int32()),
        "cls": ngram_join._names(ngram_join.np.array([(7, 0), (7, 1), (7, 2), (7, 0)], ngram_join.NAME)),
        "n": [10] * 4, "keys": [*keys, keys[0]]})
    got = ngram_join._shared_shingles(parts).to_pylist()
    assert [int(r["cls"]) for r in got] == [7, (1 << 64) + 7, (2 << 64) + 7]
    assert [(r["own"], r["keys"], set(r["counts"])) for r in got] == [
        (1, list(range(1, 10)), {2}), (1, list(range(1, 10)), {2}), (10, [], set())]


def test_counts_of_a_batch_are_packed_either_way():
    np = ngram_join.np
    for rows, doc in [(100, [3, 3, 70]), (3, [0, 0, 1, 2]), (5, [])]:
        size, back = ngram_join._unpacked(ngram_join._packed(np.array(doc, np.int64), rows))
        assert (size, back.tolist()) == (rows, doc)


def test_components_of_long_paths(spark):
    rng = random.Random(2)
    nodes = list(range(300))
    rng.shuffle(nodes)
    edges = [(nodes[i], nodes[i + 1]) for i in range(299) if i % 100 != 99] + [(7, 7), (nodes[0], nodes[1])]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (nodes[:100], nodes[100:200], nodes[200:]):
        assert {got[n] for n in part} == {min(part)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


ENTRY = "key long, cls long, n long, cap long"


@pytest.mark.parametrize("percent", [70, 80, 90])
def test_banded_join_finds_every_possible_pair(spark, percent):
    rng = random.Random(percent)
    entries = [(rng.randrange(3), c, n, n - rng.randrange(n - (percent * n + 99) // 100 + 1))
               for c in range(150) for n in [rng.choice([rng.randint(1, 12), rng.randint(80, 130)])]]
    want = {(a[1], b[1], a[2], b[2]) for a in entries for b in entries
            if a[0] == b[0] and a[1] < b[1] and 100 * min(a[2], b[2]) >= percent * max(a[2], b[2])
            and (100 + percent) * min(a[3], b[3]) >= percent * (a[2] + b[2])}
    found = remaining_pairs(spark.createDataFrame(entries, ENTRY), spark.createDataFrame([], "node long, root long"),
                            spark.createDataFrame([], "a long, b long"), percent).collect()
    assert len(found) == len(want) > 100 and {tuple(r) for r in found} == want


def test_a_hot_shingle_of_classes_without_partners_forms_no_pairs(spark):
    rng = random.Random(1)
    weak = [(7, c, 100, rng.randint(81, 88)) for c in range(500)]
    strong = [(7, 500 + c, 100, 100) for c in range(3)] + [(7, 600 + c, 160, 160) for c in range(3)]
    small, large = banded_sides(spark.createDataFrame(weak, ENTRY), 80)
    assert small.isEmpty()
    small, large = banded_sides(spark.createDataFrame(weak + strong, ENTRY), 80)
    assert small.join(large, ["key", "small", "large"]).count() < 100
