"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1; for each bit a binary classifier (logistic
regression, trained here in numpy) on hashed character n-grams predicts that bit.  A text
gets the language whose codeword has the least sum of losses log(1 + exp(-bit * margin)),
so a sure bit weighs more than an unsure one.  ``score`` is the softmax of the negative
sums.  A text is flagged as ambiguous where the best codeword is less than ``ODDS`` times
as likely as the next one.

The classifiers are fitted on a bounded sample: at most ``sample`` rows per language and
``SAMPLE_ROWS`` in all, those with the smallest hash of their id.  Features are counted
over whole texts inside Spark tasks; the driver gets at most ``SAMPLE_ROWS`` vectors of at
most ``DIMENSIONS`` counts.  Prediction is a pass over all rows without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without a
labelled row every text is; with one language every other text is that one, score 1.
Rows with a null id are predicted, never learned from.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.llm.common import begin, least_hashed, pick, plain, position, text_slices, tidy, without
from tallyspan.session import store_and_reload

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 500
SAMPLE_ROWS = 20_000
MOST_LANGUAGES = 200  # learned; those with most ids
EXHAUSTIVE = 7  # languages up to which every split is a bit
RANDOM_BITS = 63
STEPS = 150
RATE = 0.5
DECAY = 1e-4
ODDS = 1.5
UNDETERMINED = "und"


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 per language.  Few languages: every split into two sides once.
    Many: of a fixed number of random codes, the one with the largest least distance."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= EXHAUSTIVE:
        tails = itertools.product((1, -1), repeat=languages - 1)
        return np.array([(1, *t) for t in tails][1:], np.int8).T
    rng, best, width = np.random.default_rng(7), None, -1
    for _ in range(100):
        code = rng.choice(np.array([1, -1], np.int8), (languages, RANDOM_BITS))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        apart = (code.shape[1] - code.astype(int) @ code.T) // 2 + np.eye(languages, dtype=int) * RANDOM_BITS
        if apart.min() > width:
            best, width = code, apart.min()
    return best


def counts(text: str) -> np.ndarray:
    """Hashed counts of the text's character n-grams; what is no letter counts as a blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (points - 97 < 26) | (points >= 0xC0) & (points != 0xD7) & (points != 0xF7)
    points = np.where(letter, points, 32).astype(np.uint32)
    again = np.zeros(len(points), bool)
    again[1:] = (points[1:] == 32) & (points[:-1] == 32)
    points = points[~again]
    found = np.zeros(DIMENSIONS, np.int64)
    code = np.zeros(len(points), np.uint32)
    for n in ORDERS:
        tail = points[n - 1 :]
        if not len(tail):
            break
        code = code[: len(tail)] * np.uint32(0x9E3779B1) + tail + np.uint32(n)
        mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        found += np.bincount(mixed >> np.uint32(20), minlength=DIMENSIONS)
    return found


def features(texts: list[str]) -> np.ndarray:
    """A row of unit length per text: the square roots of its counts."""
    rows = np.sqrt(np.stack([counts(t) for t in texts]).astype(np.float32))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.code, self.weights, self.bias = languages, code.astype(np.float32), weights, bias

    def losses(self, rows: np.ndarray) -> np.ndarray:
        margins = rows @ self.weights + self.bias
        return np.logaddexp(0, -margins[:, None, :] * self.code[None]).sum(axis=2)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names = [UNDETERMINED] * len(texts)
        score, ambiguous = np.zeros(len(texts)), np.zeros(len(texts), bool)
        known = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
        if not self.languages:
            return names, score, ambiguous
        for start in range(0, len(known), 512):
            part = known[start : start + 512]
            loss = self.losses(features([texts[i] for i in part]))
            best = loss.argmin(axis=1)
            share = np.exp(loss.min(axis=1, keepdims=True) - loss)
            score[part] = 1 / share.sum(axis=1)
            if len(self.languages) > 1:
                ambiguous[part] = np.sort(share, axis=1)[:, -2] * ODDS > 1
            for i, at in zip(part, best):
                names[i] = self.languages[at]
        return names, score, ambiguous


def fit(rows: np.ndarray, labels: list[str]) -> Model:
    """Classifiers of all bits at once, by gradient descent with momentum; every language
    weighs the same."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    at = np.array([languages.index(x) for x in labels], int)
    target = code[at].astype(np.float32)
    weight = (1 / np.bincount(at, minlength=len(languages)))[at][:, None].astype(np.float32)
    weight /= weight.sum() if len(at) else 1
    weights = np.zeros((DIMENSIONS, code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    speed, drift = np.zeros_like(weights), np.zeros_like(bias)
    scale = np.float32(20)  # texts have unit length, so that steps need to be long
    for _ in range(STEPS if code.shape[1] else 0):
        margin = rows @ weights + bias
        pull = weight * target / (1 + np.exp(target * margin))
        speed = 0.9 * speed + rows.T @ pull - DECAY * weights
        drift = 0.9 * drift + pull.sum(axis=0)
        weights += RATE * scale * speed
        bias += RATE * drift
    return Model(languages, code, weights, bias)


def training_rows(
    df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE_PER_LANGUAGE
) -> DataFrame:
    """(label, text) of the sample: ids with the smallest hashes of each of the languages with most ids, one text
    of each.  Ids are chosen without reading a text, then looked up."""
    rows = pick(df, key=key, text=text, label=label).where("key IS NOT NULL AND text IS NOT NULL AND label IS NOT NULL")
    ids = rows.select("label", "key").distinct().withColumn("hash", F.xxhash64("key"))
    ids = store_and_reload(ids, "ids")
    largest = ids.groupBy("label").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "label").limit(MOST_LANGUAGES)
    known = [r.label for r in largest.collect()]
    most = min(sample, SAMPLE_ROWS // max(1, len(known)))
    chosen = least_hashed(ids.where(F.col("label").isin(known)), "label", most).select("label", "key")
    found = rows.join(F.broadcast(chosen), ["label", "key"])
    # Of rows that repeat an id one counts.
    return found.groupBy("label", "key").agg(F.min("text").alias("text")).select("label", "text")


def train(df: DataFrame, **names) -> Model:
    """A model of the labelled rows of ``df``."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("langid")
        for batch in batches:
            tidy()
            found = [counts(t) for t in batch.column(1).to_pylist()]
            at = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.astype(np.int32).tobytes() for x in at], pa.binary()),
                    pa.array([c[x].astype(np.int32).tobytes() for c, x in zip(found, at)], pa.binary()),
                ],
                names=["label", "at", "n"],
            )

    sample = training_rows(df, **names).mapInArrow(vectors, "label string, at binary, n binary").collect()
    sample.sort(key=lambda r: (r.label, bytes(r.at), bytes(r.n)))
    rows = np.zeros((len(sample), DIMENSIONS), np.float32)
    for i, r in enumerate(sample):
        rows[i, np.frombuffer(r.at, np.int32)] = np.sqrt(np.frombuffer(r.n, np.int32))
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    return fit(rows, [r.label for r in sample])


PREDICTION = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ambiguous", T.BooleanType()),
]


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns (but those of these names) and lang_pred, score, ambiguous."""
    kept = without(df, [f.name for f in PREDICTION])
    at, names = position(kept, text), [*kept.columns, *[f.name for f in PREDICTION]]
    schema = T.StructType([*plain(kept).schema.fields, *PREDICTION])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("langid")
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(at)):
                part = batch.slice(start, length)
                found, score, ambiguous = model.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string()), pa.array(score), pa.array(ambiguous)],
                    names=schema.names,
                )

    return plain(kept).mapInArrow(run, schema).toDF(*names)


def held_out(key):
    """Rows that a model must not have learned from: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op3(documents: DataFrame) -> DataFrame:
    """The rows of the contract, and ``ambiguous``."""
    rows = pick(documents, doc_id="doc_id", text="text", lang="lang")
    model = train(rows.where(~held_out(F.col("doc_id"))))
    return predict(rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text")
