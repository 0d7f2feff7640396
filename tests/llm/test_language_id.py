import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from tapecraft.llm import language_id
from tapecraft.llm.language_id import (ALPHA, BETA, CALIBRATION, EPOCHS, L1, L2, _fit, fit_temperature, identify_languages,
                                       text_counts)
from tests.llm.util import ODD_TEXTS, docs_table

SYLLABLES = {"aa": ["tha", "er", "ing", "ly", "wh"], "bb": ["eau", "oi", "que", "ment", "é"],
             "cc": ["sch", "ung", "ver", "keit", "ß"]}


def text_of(lang, seed, words=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


def rows_of(n=240):
    # one language holds half of all rows; some labels are missing
    langs = ["aa", "aa", "bb", "cc"]
    return [(i, text_of(langs[i % 4], i), None if i % 11 == 0 else langs[i % 4], "s") for i in range(n)]


def test_held_out_documents_are_recognised(spark):
    rows = rows_of() + [(1000 + i, t, "aa", "s") for i, t in enumerate(ODD_TEXTS)] + [(None, text_of("bb", 5), "bb", "s")] * 2
    got = identify_languages(docs_table(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, _, _ in rows_of():
        r = by_id[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.lang_pred == ["aa", "aa", "bb", "cc"][i % 4]
    for i, t in enumerate(ODD_TEXTS):
        letters = any(c.isalpha() for c in t or "")
        assert (by_id[1000 + i].lang_pred == "und") == (not letters)
    assert all(r.held_out and r.lang_pred == "bb" for r in got if r.doc_id is None)


def test_predictions_do_not_see_labels_sources_or_ids_of_held_out_rows(spark):
    rows = rows_of()
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows]
    wrong = [(i, t, "zz" if h else lang, "other" if h else s) for (i, t, lang, s), h in zip(rows, held)]
    a = sorted(map(tuple, identify_languages(docs_table(spark, rows)).collect()))
    assert a == sorted(map(tuple, identify_languages(docs_table(spark, wrong)).collect()))


def test_without_anything_to_learn(spark):
    assert identify_languages(docs_table(spark, [])).collect() == []
    (row,) = identify_languages(docs_table(spark, [(1, "some text", None, "s")])).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)


def test_carried_columns(spark):
    (row,) = identify_languages(docs_table(spark, [(1, "some text", "aa", "s")]), keep=("text", "score_of")[:1]).collect()
    assert row.text == "some text" and row.doc_id == 1


def test_temperature_minimises_the_loss():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(500, 3)) * 4
    p = np.exp(logits / 2.5)
    labels = np.array([rng.choice(3, p=row / row.sum()) for row in p])
    assert math.isclose(fit_temperature(logits, labels), 2.5, rel_tol=0.25)


def test_counts_are_those_of_character_n_grams():
    for text, plain in [("Ab  ab!", " ab ab "), ("x1Y", " x y "), ("É ß—é", " é ß é "), ("好好", " 好好 "), ("𝒳a", " 𝒳a ")]:
        grams = Counter(plain[k:k + n] for n in (1, 2, 3) for k in range(len(plain) - n + 1))
        _, counts = text_counts(text)
        assert sorted(counts.tolist()) == sorted(grams.values())  # no two of these share a bucket
    assert text_counts("12 !?") is None and text_counts(None) is None and text_counts("") is None
    assert text_counts("AB")[0].tolist() == text_counts("ab")[0].tolist()


def naive_fit(examples, classes):
    """FTRL by its formulas, number by number: examples are (place, {bucket: value}, label)."""
    z, n = {}, {}

    def weight(b, c):
        s = z.get((b, c), 0.0)
        if abs(s) <= L1:
            return 0.0
        return -(s - math.copysign(L1, s)) / ((BETA + math.sqrt(n.get((b, c), 0.0))) / ALPHA + L2)

    ordered = sorted(examples, key=lambda e: e[0])
    for _ in range(EPOCHS):
        for k, (_, values, label) in enumerate(ordered):
            if k % CALIBRATION == CALIBRATION - 1:
                continue
            w = {(b, c): weight(b, c) for b in values for c in range(classes)}
            e = [math.exp(sum(v * w[b, c] for b, v in values.items())) for c in range(classes)]
            for b, v in values.items():
                for c in range(classes):
                    g = v * (e[c] / sum(e) - (c == label))
                    before = n.get((b, c), 0.0)
                    z[b, c] = z.get((b, c), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / ALPHA * w[b, c]
                    n[b, c] = before + g * g
    return {(b, c): weight(b, c) for b, c in z}


def test_weights_are_those_of_a_naive_fit():
    rng = random.Random(3)
    examples = []
    for place in range(60):
        label = rng.randrange(3)
        values = {b: float(np.float32(rng.random())) for b in rng.sample(range(20 * label, 20 * label + 40), 6)}
        examples.append((place, values, label))
    frame = pd.DataFrame([("abc"[label], np.array(sorted(v), "<i4").tobytes(), np.array([v[b] for b in sorted(v)], "<f4").tobytes(), place)
                          for place, v, label in examples], columns=["lang", "found", "weight", "place"])
    fitted = _fit(frame.sample(frac=1, random_state=1))
    got = np.stack([np.frombuffer(w, "<f4") for w in fitted["weights"]], axis=1)
    want = np.zeros_like(got)
    for (b, c), w in naive_fit(examples, 3).items():
        want[b, c] = w
    assert np.abs(want).max() > 0.1 and np.allclose(got, want, atol=1e-5)


def test_repeated_rows_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE", 30)
    rows = [(i, text_of("aa", i), "aa") for i in range(40)] + [(7, "said again " * 500, "aa")] * 300 + [(50, "one b", "bb")] * 50
    got = [tuple(r) for r in language_id.learning_sample(docs_table(spark, rows)).select("doc_id", "text", "lang").collect()]
    assert len(got) == len(set(got)) and sum(r[2] == "bb" for r in got) == 1
    assert sum(r[2] == "aa" for r in got) == 30 and set(got) <= set(rows)
