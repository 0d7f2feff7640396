from collections import Counter

from tapecraft.llm.repetition import MAX_LINE_SHARE, MAX_NGRAM_SHARE, repetition_rules
from tests.llm.util import ODD_TEXTS, docs_table, prose, words_of


def brute(text):
    text = text or ""
    words = words_of(text)
    triples = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup_lines, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if words_of(line):
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(len, words_of(line)))
            seen.add(line)
    chars = sum(map(len, words))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    calm = dup_chars <= MAX_LINE_SHARE * chars
    for n, share in MAX_NGRAM_SHARE.items():
        earlier, covered = set(), set()
        for i in range(len(words) - n + 1):
            window = tuple(words[i:i + n])
            if window in earlier:
                covered.update(range(i, i + n))
            earlier.add(window)
        calm &= sum(len(words[i]) for i in covered) <= share * chars
    return (len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), dup_lines, len(repeated), failed, not failed and calm)


def test_rules_match_brute_force(spark):
    line = prose(1, 12)
    texts = ODD_TEXTS + [prose(2, 60), prose(3, 20_000), "\n".join([line] * 9), prose(4, 80) + "\n" + "\n".join([line] * 3),
                         "\n".join([prose(5, 30), prose(6, 30), prose(5, 30)]), prose(7, 49), prose(8, 50), prose(8, 50)]
    rows = list(enumerate(texts)) + [(None, prose(9, 70)), (3, "a b c")]
    got = [tuple(r) for r in repetition_rules(docs_table(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()]
    assert sorted(got, key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_repeats_are_rejected_and_clean_texts_kept(spark):
    passage = prose(10, 40)
    rows = [(1, prose(11, 300)), (2, " ".join([passage, prose(12, 60), passage]))]
    kept = {r.doc_id: r.kept for r in repetition_rules(docs_table(spark, rows)).collect()}
    assert kept[1] and not brute(rows[1][1])[-1] == kept[1] and kept[2] == brute(rows[1][1])[-1]


def test_a_passage_said_twice_passes_the_base_and_is_rejected(spark):
    passage = prose(13, 30, 4000)
    twice = " ".join([passage, prose(14, 80, 4000), passage])                        # 43 % of words repeat, 21 % are copies
    lines = "\n".join([prose(15, 25, 4000), *[prose(k, 20, 4000) for k in range(16, 19)], prose(15, 25, 4000)])
    once = " ".join([passage, prose(14, 80, 4000)])
    found = {r.doc_id: (r.base_failed, r.kept) for r in repetition_rules(docs_table(spark, [(1, twice), (2, lines), (3, once)])).collect()}
    assert found == {1: (False, False), 2: (False, False), 3: (False, True)}


def test_empty_table_and_carried_columns(spark):
    empty = repetition_rules(docs_table(spark, []), keep=("text", "n"))
    assert empty.collect() == [] and {"text", "n", "kept"} <= set(empty.columns)
    (row,) = repetition_rules(docs_table(spark, [(1, "a b")]), keep=("text", "n")).collect()
    assert (row.text, row.n) == ("a b", -1)
