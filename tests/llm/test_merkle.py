"""The manifest against trees built node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tapecraft.llm import merkle
from tests.llm.util import DOCS, ODD_TEXTS, docs_table, prose


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n = row
    return digest(*map(field, (doc_id, source, lang, n if n is None else n + more, text)))


def tree(nodes, fanout):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [digest(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        levels.append(nodes)
    return levels


def steps(levels, at, fanout):
    found = []
    for level in levels[:-1]:
        first = at - at % fanout
        run = level[first:first + fanout]
        found.append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
        at //= fanout
    return found


def brute(rows, fanout=2):
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    groups = [sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0)) for g in langs]
    trees = [tree([leaf(r) for r in group], fanout) for group in groups]
    top = tree([t[-1][0] for t in trees], fanout)
    found = []
    for k, group in enumerate(groups):
        for i, row in enumerate(group):
            path = steps(trees[k], i, fanout) + steps(top, k, fanout)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            h = leaf(row, int(tampered))
            for a, b in path:
                h = digest(a, h, b)
            found.append((row[0], leaf(row), trees[k][-1][0], top[-1][0], digest(*[a + b for a, b in path]), h, h == top[-1][0]))
    return sorted(found, key=repr)


def table(spark, rows):
    full = [(d, t, g, s, n, -1, -1, "x", 0, "y") for d, t, g, s, n in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def test_trees_of_several_heights_against_brute_force(spark):
    texts = [*ODD_TEXTS, prose(1, 20_000)]
    rows = [(i * 3 - 20, texts[i % len(texts)], lang, None if i % 5 == 0 else f"s{i % 3}", None if i % 4 == 0 else i)
            for lang, size in (("en", 70), (None, 9), ("de", 8), ("", 1), ("é", 2), ("zz", 17)) for i in range(size)]
    found = merkle.verified_manifest(spark, table(spark, rows))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)


def test_null_and_repeated_ids_and_no_rows(spark):
    same = (4, "a b", "en", "s", 3)
    rows = [(None, "x", "en", "s", 1), *[same] * 5, (9, None, "en", None, None), (2, "", "en", "", 2 ** 63 - 1)]
    found = sorted((tuple(r) for r in merkle.verified_manifest(spark, table(spark, rows)).collect()), key=repr)
    assert found == brute(rows)
    assert merkle.verified_manifest(spark, docs_table(spark, [])).collect() == []


@pytest.mark.parametrize("fanout", [3, 4])
def test_wider_runs(spark, monkeypatch, fanout):
    monkeypatch.setattr(merkle, "TIER", 2)
    rows = [(i, f"t{i}", "en" if i % 4 else "de", "s", i) for i in range(45)]
    found = merkle.manifest(spark, merkle.dataset_leaves(table(spark, rows)), fanout)
    folded = found.select("doc_id", "leaf", "subroot", "root", merkle.fold(F.col("leaf"), F.col("steps")).alias("folded")).collect()
    want = {r[0]: r[1:4] for r in brute(rows, fanout)}
    assert len(folded) == len(rows)
    assert all((r["leaf"], r["subroot"], r["root"]) == want[r["doc_id"]] and r["folded"] == r["root"] for r in folded)
