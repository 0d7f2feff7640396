import re
import textwrap

import pytest

from tapecraft.llm.license_scan import TEMPLATES, license_scan, signature, telling, template_bigrams
from tapecraft.llm.license_texts import PASSAGES
from tests.llm.util import ODD_TEXTS, docs_table, prose


def bigrams(text):
    words = [w for w in re.sub(r"[\W_]+", " ", text.lower()).split(" ") if w]
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def brute(doc_id, text):
    if text is None:
        return []
    lines = text.split("\n")
    out = []
    for line, unit in [(0, text if len(lines) > 1 else "")] + list(enumerate(lines, 1)):
        own = bigrams(unit)
        found = []
        for name, wording in TEMPLATES:
            other = bigrams(wording)
            dice = 2.0 * len(own & other) / (len(own) + len(other)) if own else 0
            if dice >= 0.8:
                found.append((-dice, name, len(own & other), dice))
        if found:
            _, name, shared, dice = min(found)
            out.append((doc_id, line, name, shared, dice))
    return out


def test_units_match_brute_force(spark):
    wordings = [w for _, w in TEMPLATES]
    texts = ODD_TEXTS + wordings + [w.upper().replace(" ", "  ") for w in wordings] + [
        "\n".join([prose(1, 30), wordings[0], prose(2, 20)]), wordings[-1] + "\n" + wordings[4],
        wordings[7] + " or later", wordings[7].replace("3", "4"), wordings[2] + "\nand more", prose(3, 9000) + "\n" + wordings[10],
        " ".join([wordings[4]] * 400), wordings[3].replace("Creative", "Created")]
    rows = list(enumerate(texts)) + [(None, wordings[0]), (1000, wordings[1]), (1000, wordings[1])]
    got = sorted((tuple(r) for r in license_scan(docs_table(spark, rows)).collect()), key=str)
    want = sorted((x for i, t in rows for x in brute(i, t)), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=1e-12)


def test_a_match_cannot_avoid_the_signature():
    for _, wording in TEMPLATES:
        own = template_bigrams(wording)
        rest = set(own) - set(signature(own, 0.8))
        assert 2 * len(rest) / (len(rest) + len(own)) < 0.8


def test_empty_table_and_plan(spark):
    assert license_scan(docs_table(spark, [])).collect() == []
    plan = license_scan(docs_table(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def wrapped(text, width, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_wrapped_embedded_and_full_texts(spark):
    body = {n: t for n, t in PASSAGES if n in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense")}
    header = {n: t for n, t in PASSAGES if "Foundation" in t}
    gpl3 = next(w for n, w in TEMPLATES if n == "GPL-3.0")
    bsd3 = body["BSD-3-Clause"].replace("COPYRIGHT HOLDERS", "REGENTS").replace("copyright holder", "University")
    cases = [(wrapped("The MIT License (MIT) Copyright (c) 2020 A. Name " + body["MIT"], 76), "MIT"),
             (wrapped("Copyright (c) 2011, X. All rights reserved. " + body["BSD-2-Clause"], 70), "BSD-2-Clause"),
             (wrapped("Copyright (c) 2011, X. All rights reserved. " + bsd3, 70), "BSD-3-Clause"),
             (wrapped(body["ISC"], 60, " * "), "ISC"), (wrapped(body["Unlicense"], 72), "Unlicense"),
             ("The code and data are released under the MIT License.", "MIT"),
             ("Unless noted otherwise: " + gpl3 + ", or any later version.", "GPL-3.0"),
             (prose(5, 400) + " " + gpl3 + " " + prose(6, 400), "GPL-3.0"),
             (prose(7, 3000) + "\n" + wrapped(body["MIT"], 40) + "\n" + prose(8, 3000), "MIT")]
    cases += [(prose(9, 40) + "\n" + wrapped(t, 68, "# ") + "\n" + prose(10, 900), n) for n, t in header.items()]
    cases += [(wrapped(t, 75), n) for n, t in TEMPLATES]
    rows = license_scan(docs_table(spark, [(i, t) for i, (t, _) in enumerate(cases)])).collect()
    got = {i: {r.license for r in rows if r.doc_id == i} for i in range(len(cases))}
    assert [got[i] for i in range(len(cases))] == [{n} for _, n in cases]


def test_each_passage_of_a_long_text_is_found_where_it_begins(spark):
    mit, isc = (next(t for n, t in PASSAGES if n == name) for name in ("MIT", "ISC"))
    text = "\n".join([prose(1, 30), wrapped(mit, 50), wrapped(isc, 50), prose(2, 30), wrapped(mit, 50)])
    starts = [i for i, line in enumerate(text.split("\n"), 1) if line.startswith("Permission")]
    got = sorted((r.line, r.license) for r in license_scan(docs_table(spark, [(1, text)])).collect())
    assert got == sorted(zip(starts, ["MIT", "ISC", "MIT"]))
    assert license_scan(docs_table(spark, [(1, "The software is provided with a copyright notice. " * 30)])).collect() == []


def test_a_match_cannot_avoid_the_telling_words():
    known = [template_bigrams(w) for _, w in TEMPLATES]
    marks = set(telling(known, 0.8))
    for own in known:
        rest = [b for b in own if b not in marks and not marks & set(b.split())]
        assert 2 * len(rest) / (len(rest) + len(own)) < 0.8
