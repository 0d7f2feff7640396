import pytest

from tapecraft.llm.mixing import mix_sources, mixing_plan
from tests.llm.util import ODD_TEXTS, docs_table, prose, words_of


def brute_targets(sizes):
    """Water filling by iteration."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not full:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def rows_of(n=400):
    # one source holds a third of all rows; one is NULL, one is nearly empty
    rows = [(i, prose(i, 1 + i * 7 % 90), "en", "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(n)]
    rows += [(1000 + i, t, "en", None) for i, t in enumerate(ODD_TEXTS)]
    return rows + [(2000, "", "en", "void"), (2001, prose(1, 9000), "en", "long"), (2002, "tiny", "en", "tiny")]


@pytest.mark.parametrize("block_words", [64, 1024])
def test_targets_and_taken_words(spark, block_words):
    rows = rows_of()
    size = {i: len(words_of(t)) for i, t, _, _ in rows}
    source = {i: s for i, _, _, s in rows}
    sizes = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    expected = brute_targets(sizes)
    got = mix_sources(docs_table(spark, rows), block_words=block_words).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    taken = {}
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[r.source])
        assert r.target == pytest.approx(expected[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in expected.items():
        assert abs(taken[s] - t) <= 1, s


def test_schedule_stays_close_to_the_weights(spark):
    _, _, plan = mixing_plan(docs_table(spark, rows_of()), block_words=16)
    slots = sorted({(r.slot, r.source) for r in plan.select("slot", "source").distinct().collect()})
    share = sum(s == "hot" for _, s in slots) / len(slots)
    half = slots[:len(slots) // 2]
    assert abs(sum(s == "hot" for _, s in half) / len(half) - share) < 0.05


def test_reruns_agree_whatever_the_partitions(spark):
    table = docs_table(spark, rows_of(120))
    a = sorted(map(tuple, mix_sources(table).collect()), key=str)
    assert a == sorted(map(tuple, mix_sources(table.repartition(7)).collect()), key=str)


def test_empty_and_wordless_tables(spark):
    assert mix_sources(docs_table(spark, [])).collect() == []
    (row,) = mix_sources(docs_table(spark, [(1, None)])).collect()
    assert (row.size, row.target, row.taken) == (0, 0.0, 0)


def test_repeated_rows_are_one_document(spark):
    got = mix_sources(docs_table(spark, [(1, "a b c"), (1, "a b c"), (2, "d")])).collect()
    assert sorted((r.doc_id, r.size) for r in got) == [(1, 6), (2, 1)]


def test_plan_text_stays_short(spark):
    # the driver keeps it, and makes it anew at each adaptive step
    plan = mix_sources(docs_table(spark, rows_of(60)))._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 50_000
