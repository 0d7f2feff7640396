"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: letters in lower case, everything else a space, runs of spaces one;
n-grams of 1 to 3 code points hashed into ``BUCKETS``; 1 + log(count), times the
inverse document frequency, scaled to length 1. Weights: follow the regularised
leader (FTRL-proximal) with L1 and L2 penalties, one example at a time; then one
temperature is fitted on examples that the weights did not see.

How it runs. Document frequencies come from all learning documents: tasks count
into one array each, which are summed by bucket. The weights are fitted on a
bounded sample, ``SAMPLE`` documents a language, the smallest by a hash of their
id; ids are chosen on narrow rows, so a language with a third of all documents
moves no texts. Fitting is one task over that bounded sample; the model
(``BUCKETS`` numbers a language) goes to every task and predicts all documents in
one narrow pass.

What is learned from: text and non-NULL lang of documents whose
``crc32(doc_id as text) mod 5`` is not 0. Predictions use the text alone.

Cases with a defined result: a NULL text or one without a letter is ``und`` with
score 0; a NULL ``doc_id`` is held out; repeated rows are judged alike, and the
weights learn from one of them; with no learning documents every text is ``und`` with score 0;
equal scores go to the smaller language name; very long texts are read whole;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 15
LENGTHS = (1, 2, 3)
#: Documents a language that the weights are fitted on, at most.
SAMPLE = 1200
#: One in so many of them is kept for the temperature.
CALIBRATION = 5
EPOCHS = 2
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-3, 1e-4
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point to lower-case code point of a letter, or to a space; for the first plane."""
    if not _LETTERS:
        table = np.full(1 << 16, 32, np.uint32)
        for c in map(chr, range(1 << 16)):
            if c.isalpha():
                lower = c.lower()
                table[ord(c)] = ord(lower) if len(lower) == 1 else ord(c)
        _LETTERS.append(table)
    return _LETTERS[0]


def text_codes(text: str) -> np.ndarray:
    """Code points of the letters, runs of anything else as one space, a space at both ends."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    table = _letters()
    high = raw >= len(table)
    codes = table[np.where(high, 32, raw)]
    if high.any():
        letters = np.array([chr(c).isalpha() for c in raw[high]])
        codes[high] = np.where(letters, raw[high], 32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    keep = codes != 32
    keep[1:] |= codes[:-1] != 32
    keep[0] = True
    return codes[keep]


def text_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets that occur and how often; None for a text without a letter."""
    if not text:
        return None
    codes = text_codes(text)
    if len(codes) < 2:
        return None
    parts, key = [], np.zeros(len(codes), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        if len(codes) < n:
            break
        key = (key[:len(codes) - n + 1] * np.uint32(0x01000193)) ^ (codes[n - 1:] * np.uint32(0x9E3779B1))
        if n in LENGTHS:
            mixed = key ^ (key >> np.uint32(15))
            parts.append((mixed * np.uint32(0x85EBCA6B) + np.uint32(n * 0x27D4EB2F)) >> np.uint32(32 - 15))
    counts = np.bincount(np.concatenate(parts), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def text_features(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    counted = text_counts(text)
    if counted is None:
        return None
    found, counts = counted
    values = (1 + np.log(counts)) * idf[found]
    length = np.sqrt((values ** 2).sum())
    return found, (values / length if length > 0 else values).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


# --- fitting ---------------------------------------------------------------------------------------------------

class Ftrl:
    """FTRL-proximal for a multinomial model; a row of weights per bucket, mostly zero."""

    def __init__(self, classes: int):
        self.z = np.zeros((BUCKETS, classes))
        self.n = np.zeros((BUCKETS, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        w[np.abs(z) <= L1] = 0
        return w

    def learn(self, found: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(found)
        error = _softmax(values @ w)
        error[label] -= 1
        gradient = values[:, None] * error[None, :]
        n = self.n[found]
        self.z[found] += gradient - (np.sqrt(n + gradient ** 2) - np.sqrt(n)) / ALPHA * w
        self.n[found] = n + gradient ** 2


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least negative log likelihood, by golden-section search on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _fit(sample: pd.DataFrame) -> pd.DataFrame:
    sample = sample.sort_values(["place", "lang", "found", "weight"], kind="stable")
    names = sorted(set(sample["lang"]))
    label = sample["lang"].map({x: k for k, x in enumerate(names)}).to_numpy()
    rows = [(np.frombuffer(f, "<i4"), np.frombuffer(v, "<f4")) for f, v in zip(sample["found"], sample["weight"])]
    spare = np.arange(len(rows)) % CALIBRATION == CALIBRATION - 1
    model = Ftrl(len(names))
    for _ in range(EPOCHS):
        for k in np.flatnonzero(~spare):
            model.learn(*rows[k], label[k])
    weights = model.weights()
    logits = np.array([rows[k][1] @ weights[rows[k][0]] for k in np.flatnonzero(spare)]).reshape(-1, len(names))
    temperature = fit_temperature(logits, label[spare])
    return pd.DataFrame({"lang": names, "weights": [weights[:, k].astype("<f4").tobytes() for k in range(len(names))],
                         "temperature": temperature})


def _count_documents(batches):
    """Documents in which each bucket occurs; bucket -1 counts the documents."""
    total = np.zeros(BUCKETS + 1, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counted = text_counts(text)
            if counted is not None:
                total[counted[0]] += 1
                total[-1] += 1
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(found == BUCKETS, -1, found), pa.int32()), pa.array(total[found])],
                                     names=["bucket", "documents"])


def learning_sample(learning: DataFrame) -> DataFrame:
    """``doc_id, lang, text``: at most ``SAMPLE`` distinct rows a language, those of the smallest hashes of their ids.

    A share of each language by hash holds its sample, but for bad luck; the exact
    bound is then on distinct (id, language, text hash), so repeated rows count once
    and are not moved.
    """
    place = F.xxhash64("doc_id")
    sizes = learning.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("_n"))  # one row a language
    grid = 1 << 20
    near = F.pmod(place, F.lit(grid)) * F.col("_n") < F.lit(2 * SAMPLE * grid)
    row = ["doc_id", "lang", "_text"]
    marked = learning.select("doc_id", "lang", "text", F.xxhash64("text").alias("_text"))
    chosen = (marked.select(*row, place.alias("_place")).join(F.broadcast(sizes), "lang").filter(near)
              .select(*row, "_place").distinct()
              .withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_place", "doc_id", "_text")))
              .filter(F.col("_r") <= SAMPLE).select(*row))
    return (marked.join(F.broadcast(chosen), row, "left_semi").groupBy(*row).agg(F.min("text").alias("text"))
            .select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"))


def fit_model(docs: DataFrame):
    """``(names, weights, temperature, idf)`` from the learning documents, or None without any."""
    learning = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequencies = (learning.select("text").mapInArrow(_count_documents, "bucket int, documents long")
                   .groupBy("bucket").agg(F.sum("documents").alias("documents")).collect())
    frequency = {r["bucket"]: r["documents"] for r in frequencies}
    if not frequency.get(-1):
        return None
    idf = np.full(BUCKETS, np.log(1.0 + frequency[-1]) + 1)
    for bucket, documents in frequency.items():
        if bucket >= 0:
            idf[bucket] = np.log((1.0 + frequency[-1]) / (1 + documents)) + 1
    idf = idf.astype(np.float32)

    def features(batches):
        for batch in batches:
            out = []
            for doc_id, lang, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                made = text_features(text, idf)
                if made is not None:
                    out.append((lang, doc_id, made[0].astype("<i4").tobytes(), made[1].astype("<f4").tobytes()))
            types = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["lang", "doc_id", "found", "weight"])

    examples = (learning_sample(learning).mapInArrow(features, "lang string, doc_id long, found binary, weight binary")
                .select("lang", "found", "weight", F.xxhash64("doc_id").alias("place")))
    fitted = (examples.groupBy(F.lit(0).alias("all"))
              .applyInPandas(_fit, "lang string, weights binary, temperature double").collect())
    if not fitted:
        return None
    fitted = sorted(fitted, key=lambda r: r["lang"])
    weights = np.stack([np.frombuffer(r["weights"], "<f4") for r in fitted], axis=1)
    return [r["lang"] for r in fitted], weights, fitted[0]["temperature"], idf


def predict(docs: DataFrame, model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document, from its text alone.

    ``keep`` names columns of the input (other than ``doc_id``) to carry along.
    """
    def judge(batches):
        for batch in batches:
            names, scores = [], []
            for text in batch.column(1).to_pylist():
                made = text_features(text, model[3]) if model else None
                if made is None:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                p = _softmax((made[1] @ model[1][made[0]]).astype(np.float64) / model[2])
                names.append(model[0][int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 *[batch.column(c) for c in keep]], names=["doc_id", "held_out", "lang_pred", "score", *keep])

    others = [c for c in keep if c != "text"]
    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("_held"), *others)
            .mapInArrow(judge, "doc_id long, held_out boolean, lang_pred string, score double" + carried))


def identify_languages(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return predict(docs, fit_model(docs), keep)
