"""The packed counters against orders applied one by one, row by row."""

from itertools import permutations

from tapecraft.llm import filter_audit as fa
from tests.llm.util import ODD_TEXTS, docs_table, prose, words_of


def fails(rows, doc_id, text):
    text = text or ""
    words = words_of(text)
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, *_ in rows)}


def brute(rows, labels):
    judged = [(lang or "", fails(rows, d, t), max((q for i, q, _ in labels if i == d and d is not None), default=0),
               max((x for i, _, x in labels if i == d and d is not None), default=0)) for d, t, lang, *_ in rows]
    found = []
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        at = {}
        for order in permutations("ABCDE"):
            left = list(own)
            for step, name in enumerate(order, 1):
                here = [j for j in left if j[1][name]]
                gone = [j for j in own if j not in left]
                left = [j for j in left if not j[1][name]]
                at["".join(order), step] = (len(left), len(here), sum(j[1][name] for j in own) - len(here),
                                            sum(j[1][name] and sum(j[1].values()) == 1 for j in own),
                                            sum(j[2] == 1 for j in here), sum(j[3] == 1 for j in here))
                del gone
        for (order, step), values in at.items():
            shapley = sum(v[1] for (o, s), v in at.items() if o[s - 1] == order[step - 1])
            found.append((part, order, step, *values, shapley))
    return sorted(found)


def test_all_orders_against_filters_applied_in_turn(spark):
    long = prose(1, 260, 2000)
    texts = [*ODD_TEXTS, long, long, long, long + " #", long.upper(), prose(2, 400, 20), prose(3, 300, 4000) + " A $",
             prose(4, 30) * 20, prose(5, 20_000, 30_000)]
    langs = ["en", "de", None, ""]
    rows = [(i if i % 9 else None, text, langs[i % 4], "s") for i, text in enumerate(texts * 2)]
    rows += [rows[13], rows[13]]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(4, 1, 0), (None, 1, 1), (6, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = fa.audit(spark, docs_table(spark, rows), table).collect()
    clean = [(d, q or 0, x or 0) for d, q, x in labels]
    assert sorted(tuple(r) for r in found) == brute(rows, clean)
    assert fa.audit(spark, docs_table(spark, []), table).count() == 0


def test_fields_never_reach_the_next():
    many = (1 << 63) - 1
    mask, good, toxic = 0b10110, 1, 0
    assert fa.unpack(many * fa.packed_outcomes(mask, good, toxic)) == {
        name: [many * x for x in values] for name, values in fa.outcomes(mask, good, toxic).items()}
