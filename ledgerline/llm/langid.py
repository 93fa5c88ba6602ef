"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every training document. The weights are fitted
on a bounded sample of labelled documents (``SAMPLE`` rows, chosen by a hash of the id)
in one task: follow-the-regularised-leader with elastic-net penalties, a few passes.
A part of the sample is kept out of the fit and sets the softmax temperature. The model
is a table of buckets times languages, a few hundred kB, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SAMPLE = 3000  # labelled rows the weights are fitted on
UNKNOWN = "und"
_PIECE = 1 << 20  # characters hashed at once
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    passes: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-4
    calibration: int = 5  # every so manieth sampled row sets the temperature


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket's character n-grams occur in the lower-cased text."""
    counts = np.zeros(BUCKETS)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    overlap = max(ORDERS) - 1
    for at in range(0, len(text), _PIECE):
        piece = text[at : at + _PIECE + overlap].lower()
        last = at + _PIECE + overlap >= len(text)
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        h = np.zeros(len(codes), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            h = (h[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(1)) * _MIX
            h ^= h >> np.uint64(29)
            if n in ORDERS:
                own = h if last else h[: _PIECE]
                counts += np.bincount(((own * _MIX) >> shift).astype(np.int64), minlength=BUCKETS)
        if last:
            break
    return counts


def _sparse(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text's TF-IDF vector of length 1."""
    counts = gram_counts(text)
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt(x @ x)
    return at.astype(np.int32), (x / norm if norm else x).astype(np.float32)


def idf_table(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency per bucket, over all rows of ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                seen += gram_counts(text.as_py() or "") > 0
                rows += 1
        buckets = np.append(np.arange(BUCKETS), -1)
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(np.append(seen, rows))], ["bucket", "n"])

    # BUCKETS + 1 rows, however many documents there are
    found = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(BUCKETS + 1)
    n[found["bucket"].to_numpy()] = found["n"].to_numpy()  # -1: the number of documents
    return np.log((1 + n[-1]) / (1 + n[:-1])) + 1


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, s: Settings) -> np.ndarray:
    """Weights (buckets + 1 for the bias, by classes) from rows of buckets, values and class."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at) -> np.ndarray:
        zz, shrunk = z[at], np.abs(z[at]) - s.l1
        return np.where(shrunk > 0, -np.sign(zz) * shrunk / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2), 0.0)

    for _ in range(s.passes):
        for at, x, label in rows:
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, of a fixed grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.25, 5.0, 60)
    loss = [-np.log(_softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        at, x = _sparse(text, self.idf)
        p = _softmax((x @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(np.argmax(p))  # ties: the first language in order
        return self.languages[best], float(p[best])


def fit(train: DataFrame, sample: int = SAMPLE, settings: Settings = Settings()) -> Model:
    """Fit on ``doc_id, text, lang`` (rows without text or lang take no part)."""
    train = train.where("text is not null and lang is not null")
    idf = idf_table(train)
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    ids = train.select("doc_id").orderBy(order, "doc_id").limit(sample).distinct()
    spark = train.sparkSession
    table = spark.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sparse(t.as_py(), table.value) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rank"), batch.column("lang"), pa.array([a for a, _ in found], pa.list_(pa.int32())),
                 pa.array([x for _, x in found], pa.list_(pa.float32()))],
                ["rank", "lang", "at", "x"],
            )

    schema = "rank long, lang string, at array<int>, x array<float>"
    # the sampled ids are known now, so only their texts are turned into vectors
    picked = train.join(F.broadcast(ids), "doc_id").select(order.alias("rank"), "text", "lang").mapInArrow(vectors, schema)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rank", "lang"], kind="stable").iloc[:sample]
        languages = sorted(set(pdf["lang"]))
        labels = pdf["lang"].map({c: i for i, c in enumerate(languages)}).to_numpy()
        data = [(np.asarray(a), np.asarray(x, np.float64), int(c)) for a, x, c in zip(pdf["at"], pdf["x"], labels)]
        kept = [r for i, r in enumerate(data) if i % settings.calibration]
        held = [r for i, r in enumerate(data) if not i % settings.calibration]
        w = ftrl(kept or held, len(languages), settings)
        scores = np.array([x @ w[a] + w[-1] for a, x, _ in held]).reshape(len(held), -1)
        t = temperature(scores, np.array([c for *_, c in held], np.int64))
        return pd.DataFrame({"languages": [languages], "weights": [w.astype(np.float32).tobytes()], "t": [t]})

    model = picked.groupBy().applyInPandas(learn, "languages array<string>, weights binary, t double").first()
    if model is None:
        return Model((), idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    w = np.frombuffer(model["weights"], np.float32).reshape(BUCKETS + 1, -1)
    return Model(tuple(model["languages"]), idf, w.astype(np.float64), model["t"])


def held_out(folds: int = 4, fold: int = 2, id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == fold, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (the calibrated probability) to every row.

    A null text, or one without a letter, is ``und`` with score 0; so is everything
    when no labelled row was there to learn from. Other columns stay as they are,
    but columns of these two names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    found = docs.withColumn("__found", predict(F.col("text")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], "__found.lang_pred", "__found.score")
