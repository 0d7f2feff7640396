"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

Templates are usual notices, standard headers, whole bodies of the short licences
and opening passages of the long ones. Units are the lines of a text, the whole
text, and windows of words that heed no line breaks. A unit is lower-cased, runs
of other characters than letters and digits become one space, and its set of word
bigrams is compared with each template's: ``2 * shared / (own + template)``.

First a text must hold a telling word or bigram: a match holds so many of a
template's bigrams that it cannot miss all of a chosen few. Texts without any are
done; the others are compared with the templates whose telling bigrams they hold.

Size bounds: a coefficient of t needs set sizes within a factor of (2 - t) / t of
each other, so a unit only meets templates of a fitting size. Before its bigrams
are made, a unit already falls to the bounds by its word count (a lower one) and
its number of distinct words (an upper one).

Windows have a template's number of words and begin at its bigrams, one in each
eighth of a template, where enough of its bigrams follow. Of lines and windows
that overlap by more than half of the shorter, a window only counts if it shares
the most bigrams (ties: the line, the greater coefficient, the name, the earlier
one), and not if the whole text already names its licence. Lines and whole texts
always count. A window is named by the line of its first word, so a line may have
several rows.

DataFrame functions only, one narrow pass: no shuffle, no Python on the
executors. The templates are a fixed list, held as literals in the plan.

Cases with a defined result: a NULL, empty or one-word text has no unit; repeated
rows give repeated results; of several templates the best is named, ties by name;
a text of one line is one unit (its line) and its windows; very long lines and
texts are compared whole and by windows; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecraft.llm.license_texts import PASSAGES

LEAST_DICE = 0.8

# Licence names and the wording of their usual notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *PASSAGES,
]
#: Windows of a template begin this part of its words apart, about.
STEPS = 8
#: Letters of a word that may tell on its own.
TELLING_LETTERS = 7


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def signature(bigrams: list[str], least: float) -> list[str]:
    """Bigrams of which any unit that matches must hold one.

    A match holds at least ``least / (2 - least)`` of the template's bigrams, so
    it cannot avoid a larger part than the rest; the longest are the rarest.
    """
    held = math.ceil(len(bigrams) * least / (2 - least) - 1e-9)
    return sorted(bigrams, key=lambda b: (-len(b), b))[:len(bigrams) - held + 1]


def telling(templates: list[list[str]], least: float) -> list[str]:
    """Words and bigrams of which any unit that matches any of the templates must hold one."""
    need = [len(signature(t, least)) for t in templates]
    free = [set(t) for t in templates]
    holding: dict[str, dict[int, set[str]]] = {}
    for k, t in enumerate(templates):
        for b in t:
            for w in b.split():
                if len(w) >= TELLING_LETTERS:
                    holding.setdefault(w, {}).setdefault(k, set()).add(b)
    chosen = []

    def gain(word):
        return sum(min(need[k], len(held & free[k])) for k, held in holding[word].items())

    while holding:
        best = max(holding, key=lambda w: (gain(w), len(w), w))
        if gain(best) < 2:
            break
        chosen.append(best)
        for k, held in holding.pop(best).items():
            need[k] = max(need[k] - len(held & free[k]), 0)
            free[k] -= held
    for k in range(len(free)):
        mine = sorted(free[k], key=lambda b: (b not in chosen, -len(b), b))[:need[k]]
        chosen += [b for b in mine if b not in chosen]
    return chosen


def _let(value: Column, body) -> Column:
    """``body`` with the value computed once: in higher-order functions a repeated expression runs repeatedly."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _normal(unit: Column) -> Column:
    return F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " ")


def _words(unit: Column) -> Column:
    return F.filter(F.split(_normal(unit), " "), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.transform(F.slice(words, F.lit(2), F.size(words)), lambda w, i: F.concat(F.get(words, i), F.lit(" "), w))


def _bigrams(words: Column) -> Column:
    return F.array_distinct(_pairs(words))


def _strings(values: list[str]) -> Column:
    """A literal array, as one expression."""
    return F.split(F.lit("|".join(values)), r"\|")


def _table(templates: list[tuple[str, list[str], int]], least: float) -> Column:
    return F.array(*[F.struct(
        F.lit(name).alias("license"), F.lit(len(bigrams)).alias("n"), F.lit(width).alias("width"),
        F.lit(max(1, width // STEPS)).alias("step"), F.lit(math.ceil(len(bigrams) * least / (2 - least) - 1e-9)).alias("held"),
        _strings(signature(bigrams, least)).alias("marks"), _strings(bigrams).alias("bigrams"))
        for name, bigrams, width in templates])


def best_template(words: Column, table: Column, low: float, high: float, least: float) -> Column:
    """An array with the best matching template of a unit's words (``dice, license, shared``), or an empty one."""
    ratio = (2 - least) / least
    nothing = F.array().cast("array<struct<dice:double,license:string,shared:bigint>>")

    def compare(bigrams: Column) -> Column:
        own = F.size(bigrams)
        fitting = F.filter(table, lambda t: (own * F.lit(ratio) >= t["n"]) & (own <= t["n"] * F.lit(ratio)))
        scored = F.transform(fitting, lambda t: _let(
            F.size(F.array_intersect(bigrams, t["bigrams"])), lambda shared: F.struct(
                (2.0 * shared / (own + t["n"])).alias("dice"), t["license"].alias("license"),
                shared.cast("long").alias("shared"))))
        good = F.filter(scored, lambda m: m["dice"] >= F.lit(least))
        ranked = F.array_sort(good, lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1)
                              .when(x["license"] < y["license"], -1).when(x["license"] > y["license"], 1).otherwise(0))
        return F.slice(ranked, F.lit(1), F.lit(1))

    # n distinct bigrams lie between the distinct words less one and the words less one
    few = F.size(words) - 1 < F.lit(low)
    return F.when(few, nothing).when(F.size(F.array_distinct(words)) - 1 > F.lit(high), nothing).otherwise(
        _let(_bigrams(words), compare))


def _found(shared: Column, kind: int, dice: Column, license: Column, first: Column, last: Column, line: Column) -> Column:
    """A line (kind 0) or a window (1); in ascending order the one that counts comes first."""
    return F.struct((-shared).cast("long").alias("less"), F.lit(kind).alias("kind"), (-dice).alias("low"),
                    license.alias("license"), first.cast("int").alias("first"), last.cast("int").alias("last"),
                    line.cast("int").alias("line"))


def _windows(bigrams: Column, line_of: Column, table: Column, least: float) -> Column:
    """Windows of a text that match, ``bigrams`` being all of it in order, repeated ones too."""
    def of_template(t: Column) -> Column:
        hits = F.filter(F.transform(bigrams, lambda b, i: F.when(F.array_contains(t["bigrams"], b), i).otherwise(-1)),
                        lambda i: i >= 0)
        starts = _let(hits, lambda h: F.filter(h, lambda p, j: (
            (j == 0) | (F.floor(p / t["step"]) != F.floor(F.get(h, j - 1) / t["step"])))
            & F.coalesce(F.get(h, j + t["held"] - 1) <= p + t["width"] - 2, F.lit(False))))
        scored = F.transform(starts, lambda p: _let(
            F.array_distinct(F.slice(bigrams, p + 1, t["width"] - 1)), lambda own: _let(
                F.size(F.array_intersect(own, t["bigrams"])), lambda shared: _found(
                    shared, 1, 2.0 * shared / (F.size(own) + t["n"]), t["license"], p,
                    F.least(p + t["width"] - 1, F.size(bigrams)), F.get(line_of, p)))))
        return F.filter(scored, lambda m: -m["low"] >= F.lit(least))

    return F.flatten(F.transform(table, of_template))


def _overlap(x: Column, y: Column) -> Column:
    """Whether more than half of the shorter one's words are in both."""
    both = F.least(x["last"], y["last"]) - F.greatest(x["first"], y["first"]) + 1
    return 2 * both > F.least(x["last"] - x["first"], y["last"] - y["first"]) + 1


def _matches(text: Column, normal: Column, table: Column, sizes: list[int], least: float) -> Column:
    ratio = (2 - least) / least
    low, high = min(sizes) / ratio, max(sizes) * ratio
    row = "array<struct<line:bigint,license:string,shared:bigint,dice:double>>"

    def of_text(known: Column, lines: Column, words: Column, line_of: Column) -> Column:
        in_lines = F.flatten(F.transform(lines, lambda w, i: F.transform(
            best_template(w, known, low, high, least), lambda m: _let(F.array_position(line_of, i + 1) - 1, lambda at: _found(
                m["shared"], 0, m["dice"], m["license"], at, at + F.size(w) - 1, i + 1)))))
        everywhere = _let(_pairs(words), lambda b: _windows(b, line_of, known, least))
        ranked = F.array_sort(F.concat(in_lines, everywhere))
        chosen = F.aggregate(ranked, F.slice(ranked, F.lit(1), F.lit(0)), lambda acc, x: F.when(
            (x["kind"] == 1) & F.exists(acc, lambda y: _overlap(x, y)), acc).otherwise(F.concat(acc, F.array(x))))
        whole = F.when(F.size(lines) > 1, best_template(words, known, low, high, least)).otherwise(F.slice(
            best_template(words, known, low, high, least), F.lit(1), F.lit(0)))
        return _let(whole, lambda one: F.concat(
            F.transform(one, lambda m: F.struct(F.lit(0).cast("long").alias("line"), m["license"].alias("license"),
                                                m["shared"].alias("shared"), m["dice"].alias("dice"))).cast(row),
            F.transform(F.filter(chosen, lambda m: (m["kind"] == 0) | ~F.exists(one, lambda o: o["license"] == m["license"])),
                        lambda m: F.struct(m["line"].cast("long").alias("line"), m["license"].alias("license"),
                                           (-m["less"]).alias("shared"), (-m["low"]).alias("dice"))).cast(row)))

    fitting = F.filter(table, lambda t: F.exists(t["marks"], lambda b: F.contains(normal, b)))
    return _let(fitting, lambda known: _let(F.transform(F.split(text, "\n"), _words), lambda lines: _let(
        F.flatten(lines), lambda words: _let(
            F.flatten(F.transform(lines, lambda w, i: F.array_repeat(i + 1, F.size(w)))),
            lambda line_of: of_text(known, lines, words, line_of)))))


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST_DICE) -> DataFrame:
    """``doc_id, line, license, shared, dice``: units that match a template; line 0 is the whole text."""
    known = [(name, template_bigrams(text), len(re.sub(r"[\W_]+", " ", text).split())) for name, text in (templates or TEMPLATES)]
    marks = _strings(telling([bigrams for _, bigrams, _ in known], least))
    worth = _let(_normal(F.col("text")), lambda t: F.exists(marks, lambda b: F.contains(t, b)))
    found = _let(_normal(F.col("text")), lambda t: _matches(
        F.col("text"), t, _table(known, least), [len(b) for _, b, _ in known], least))
    return (docs.filter(worth).select("doc_id", F.explode(found).alias("m"))
            .select("doc_id", "m.line", "m.license", "m.shared", "m.dice"))
