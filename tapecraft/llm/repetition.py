"""Quality rules on repetition: characters inside duplicated word n-grams and lines.

``repetition_report(docs)`` adds, for each row of a table with ``doc_id`` and
``text``, the counts below; ``repetition_rules`` returns the rejected and kept
flags. One narrow pass: no shuffle, no state between rows, so neither a hot
source nor a group of copies concentrates work.

Words are runs outside ``[\\x20\\x09-\\x0D]``; a character is a code point.
Windows of n words are hashed by rolling 64-bit hashes in numpy, for all texts
of an Arrow batch at once. The 3-word base rule numbers the words of a text and
compares windows of numbers, so it is exact; the coverage lengths rely on 64-bit
hashes (about 1e-13 chance of a chance match in a text of 1,000 words).

Cases with a defined result: a NULL or blank text has zero counts and fails the
base rule (fewer than 50 words); a NULL ``doc_id`` stays NULL; repeated rows are
judged row by row; an empty table gives an empty result; other columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapecraft.llm.words import block_words, mix64, rolling, text_blocks

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

#: Share of a text's word characters that may lie in windows of n words seen
#: before in the text; longer repeats are rarer by chance, so they get less.
MAX_NGRAM_SHARE = {5: 0.15, 7: 0.13, 10: 0.10}
#: Share of a text's word characters that may lie in lines equal to an earlier line.
MAX_LINE_SHARE = 0.20

REPORT_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, dup_line_chars long, dup_ngram_chars array<long>"
)


def _repeated(keys: np.ndarray, first_too: bool) -> np.ndarray:
    """Flags the keys that occur elsewhere in the array too (or: earlier in it)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    flag = np.zeros(len(keys), dtype=bool)
    flag[order[1:][same]] = True
    if first_too:
        flag[order[:-1][same]] = True
    return flag


def _covered(flags: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside at least one flagged window of n words."""
    step = np.zeros(words + 1, dtype=np.int32)
    at = np.flatnonzero(flags)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def _owners(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of n words that stay inside one text: their first words and their texts."""
    counts = np.diff(bounds)
    doc = np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))
    ends = np.cumsum(np.maximum(counts - n + 1, 0))
    start = np.arange(len(doc)) - np.repeat(ends - np.maximum(counts - n + 1, 0), np.maximum(counts - n + 1, 0))
    return bounds[:-1][doc] + start, doc


def _window_cover(keys: np.ndarray, bounds: np.ndarray, n: int, first_too: bool) -> np.ndarray:
    """Words of each text inside windows that repeat within that text; keys: one per word position."""
    at, doc = _owners(bounds, n)
    covered = np.zeros(int(bounds[-1]) if len(bounds) else 0, dtype=bool)
    if not len(at):
        return covered
    flags = _repeated(mix64(keys[at] + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first_too)
    step = np.zeros(len(covered) + 1, dtype=np.int32)
    step[:-1] += np.bincount(at[flags], minlength=len(covered)).astype(np.int32)
    step -= np.bincount(at[flags] + n, minlength=len(covered) + 1).astype(np.int32)
    return np.cumsum(step[:-1]) > 0


def _exact_triples(data: bytes, begin: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words inside 3-word windows found twice or more in their text, first one included; exact."""
    total = len(begin)
    covered = np.zeros(total, dtype=bool)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a < 4:
            continue
        words = data[begin[a]:end[b - 1]].split()
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        pair = ids[:-1] * len(number) + ids[1:]
        if len(number) < 1 << 20:
            triple = pair[:-1] * len(number) + ids[2:]
        else:
            _, pair = np.unique(pair, return_inverse=True)
            triple = pair[:-1] * len(number) + ids[2:]
        covered[a:b] = _covered(_repeated(triple, True), 3, len(ids))
    return covered


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _duplicate_lines(raw: bytes, offsets: np.ndarray) -> tuple[list[int], list[int]]:
    """Per text: lines with a word that equal an earlier line, and the word characters in them."""
    counts, chars = [], []
    for a, b in zip(offsets[:-1], offsets[1:]):
        seen: set[bytes] = set()
        n = c = 0
        for line in raw[a:b].split(b"\n"):
            if line in seen:
                n += 1
                c += len(b"".join(line.split()).decode("utf-8", "replace"))
            elif line and not line.isspace():
                seen.add(line)
        counts.append(n)
        chars.append(c)
    return counts, chars


def _measure(batches, lengths, keep=()):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for first, offsets, data in text_blocks(texts):
            hashes, begin, end, bounds = block_words(offsets, data)
            raw = data.tobytes()
            # code points of each word: bytes that do not continue a character
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
            chars = points[end] - points[begin]
            dup_lines, dup_line_chars = _duplicate_lines(raw, offsets)
            cover = []
            for n in lengths:
                keys = np.zeros(len(hashes), dtype=np.uint64)
                rolled = rolling(hashes, n)
                keys[:len(rolled)] = rolled
                cover.append(_per_text(chars * _window_cover(keys, bounds, n, False), bounds))
            rows = len(offsets) - 1
            columns = [
                ids.slice(first, rows).cast(pa.int64()),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(_per_text(chars, bounds), pa.int64()),
                pa.array(_per_text(SYMBOLS[data], offsets), pa.int64()),
                pa.array(dup_lines, pa.int64()),
                pa.array(_per_text(_exact_triples(raw, begin, end, bounds), bounds), pa.int64()),
                pa.array(dup_line_chars, pa.int64()),
                pa.array(list(np.stack(cover, axis=1)) if rows else [], pa.list_(pa.int64())),
            ]
            columns += [batch.column(c).slice(first, rows) for c in keep]
            yield pa.RecordBatch.from_arrays(columns, names=[
                "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words", "dup_line_chars", "dup_ngram_chars", *keep])


def repetition_report(docs: DataFrame, lengths: tuple[int, ...] = tuple(MAX_NGRAM_SHARE),
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Word, symbol and repetition counts of every whole text; ``dup_ngram_chars`` follows ``lengths``.

    ``keep`` names columns of the input (other than ``doc_id``) to carry along,
    so that a filter needs no join back.
    """
    def measure(batches):
        yield from _measure(batches, lengths, keep)

    others = [c for c in keep if c != "text"]
    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select("doc_id", "text", *others).mapInArrow(measure, REPORT_SCHEMA + carried)


def repetition_rules(
    docs: DataFrame,
    max_ngram_share: dict[int, float] | None = None,
    max_line_share: float = MAX_LINE_SHARE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The report plus ``base_failed`` and ``kept``.

    Kept: the base rule holds, and neither the repeated lines nor the repeated
    windows of any length cover more than their share of the word characters.
    """
    shares = max_ngram_share or MAX_NGRAM_SHARE
    report = repetition_report(docs, tuple(shares), keep)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    calm = F.col("dup_line_chars") <= F.lit(max_line_share) * F.col("word_chars")
    for k, share in enumerate(shares.values()):
        calm &= F.get("dup_ngram_chars", F.lit(k)) <= F.lit(share) * F.col("word_chars")
    return report.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & calm)
