"""Quality classification with naive Bayes support vectors.

Indicators of n-grams (character n-grams, and n-grams of word shapes, where a word that
repeats its predecessor is one symbol) are scaled by the log ratio of the classes'
smoothed counts; a linear hinge-loss model is fitted on them by dual coordinate
descent. The fit uses a bounded sample of labelled rows (``SAMPLE``, chosen by a hash of
the id) in one task; a part of it is left out of the fit and turns margins into
probabilities. Every whole text is scored.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
SAMPLE = 4000  # labelled rows the model is fitted on
THRESHOLD = 0.3
_PIECE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHAPES = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "X"), (re.compile(r"[^\WA-ZÀ-ÖØ-Þ\d_]+"), "x"), (re.compile(r"\d+"), "9"))


@dataclass(frozen=True)
class Settings:
    smoothing: float = 1.0
    cost: float = 0.1
    passes: int = 12
    calibration: int = 4  # every so manieth sampled row turns margins into probabilities


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h * _MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


_shapes: dict[str, int] = {}  # of words seen before, in this process
_SHAPES_KEPT = 200_000
_AGAIN = 0x51ED270B


def _shape(word: str) -> int:
    """A number for the word's shape: runs of capitals, small letters and digits shortened."""
    shape = word[:64]
    for pattern, symbol in _SHAPES:
        shape = pattern.sub(symbol, shape)
    if len(_shapes) >= _SHAPES_KEPT:
        _shapes.clear()
    found = _shapes[word] = xxhash.xxh64_intdigest(shape[:24])
    return found


def _shape_grams(text: str) -> np.ndarray:
    """Hashes of one to three word shapes in a row, and of runs of one repeated word."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _shapes.get
    shapes = np.array([known(w) or _shape(w) for w in words], np.uint64)
    again = np.fromiter(map(operator.eq, words[1:], words), bool, len(words) - 1)
    shapes[1:][again] = _AGAIN
    breaks = np.flatnonzero(~np.concatenate(([False], again, [False])))
    longest = int(np.diff(breaks).max()) - 1  # repetitions in a row
    runs = np.array([_AGAIN + 1 + i for i in range(longest.bit_length())], np.uint64)
    two = (shapes[:-1] * _MIX) ^ shapes[1:]
    three = (two[:-1] * _MIX) ^ shapes[2:]
    return np.concatenate((shapes, two, three, runs))


def indicators(text: str | None) -> np.ndarray:
    """Sorted buckets of the text's n-grams; a null or empty text has none."""
    if not text:
        return np.zeros(0, np.int32)
    seen = np.zeros(BUCKETS, bool)
    overlap = max(ORDERS) - 1
    for at in range(0, len(text), _PIECE):
        codes = np.frombuffer(text[at : at + _PIECE + overlap].encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        h = np.zeros(len(codes), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            h = (h[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(1)) * _MIX
            h ^= h >> np.uint64(29)
            if n in ORDERS:
                seen[_bucket(h)] = True
    seen[_bucket(_shape_grams(text))] = True
    return np.flatnonzero(seen).astype(np.int32)


def count_ratios(rows: list[tuple[np.ndarray, int]], smoothing: float) -> np.ndarray:
    """Log ratio of each bucket's share in rows of label 1 to its share in those of label 0."""
    counts = np.full((2, BUCKETS), smoothing)
    for at, label in rows:
        counts[label, at] += 1
    shares = counts / counts.sum(1, keepdims=True)
    return np.log(shares[1] / shares[0])


def hinge(rows: list[tuple[np.ndarray, int]], scale: np.ndarray, s: Settings) -> np.ndarray:
    """Weights (the last is the bias) of the squared hinge loss, by dual coordinate descent."""
    w, alpha = np.zeros(BUCKETS + 1), np.zeros(len(rows))
    rng = np.random.default_rng(7)
    vectors = []
    for at, _ in rows:
        x = np.append(scale[at], 1.0)
        norm = np.sqrt(x @ x)
        vectors.append((np.append(at, BUCKETS), x / norm))
    slack = 0.5 / s.cost
    for _ in range(s.passes):
        for i in rng.permutation(len(rows)):
            at, x = vectors[i]
            y = 1.0 if rows[i][1] else -1.0
            step = max(alpha[i] - (y * (w[at] @ x) - 1 + slack * alpha[i]) / (1.0 + slack), 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w[at] += step * y * x
    return w


def margin(at: np.ndarray, weights: np.ndarray, scale: np.ndarray) -> float:
    x = scale[at]
    return float((x @ weights[at] + weights[-1]) / np.sqrt(x @ x + 1.0))


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins (Platt, smoothed targets)."""
    pos = labels.sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (len(labels) - pos + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * margins + b)))
        g, h = p - target, p * (1 - p) + 1e-9
        grad = np.array([(g * margins).sum() + 1e-3 * a, g.sum() + 1e-3 * b])
        hess = np.array([[(h * margins**2).sum(), (h * margins).sum()], [(h * margins).sum(), h.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    scale: np.ndarray
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        z = self.slope * margin(indicators(text), self.weights, self.scale) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _learn(pdf: pd.DataFrame, s: Settings) -> Model:
    rows = [(np.asarray(a), int(q)) for a, q in zip(pdf["at"], pdf["quality"])]
    part = [r for i, r in enumerate(rows) if i % s.calibration]
    rest = [r for i, r in enumerate(rows) if not i % s.calibration]
    scale = count_ratios(part, s.smoothing)
    w = hinge(part, scale, s)
    slope, offset = calibrate(
        np.array([margin(a, w, scale) for a, _ in rest]), np.array([q for _, q in rest])
    )
    return Model(w, scale, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, settings: Settings = Settings()) -> Model:
    """Fit on texts of ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, quality`` 0 or 1).

    Labels with a null id or another quality take no part. The sampled labels are at most
    ``sample`` rows, so they are broadcast to the scan of the texts.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    picked = known.orderBy(order, "doc_id", "quality").limit(sample).dropDuplicates(["doc_id"])
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumn("rank", order)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([indicators(t.as_py()) for t in batch.column("text")], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("quality"), found], ["rank", "quality", "at"])

    vectors = rows.select("rank", F.col("quality").cast("long"), "text").mapInArrow(featured, "rank long, quality long, at array<int>")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        m = _learn(pdf.sort_values("rank", kind="stable").iloc[:sample], settings)
        arrays = [m.weights.astype(np.float32).tobytes(), m.scale.astype(np.float32).tobytes()]
        return pd.DataFrame([[*arrays, m.slope, m.offset]], columns=["weights", "scale", "slope", "offset"])

    found = vectors.groupBy().applyInPandas(learn, "weights binary, scale binary, slope double, offset double").first()
    if found is None:
        return Model(np.zeros(BUCKETS + 1), np.zeros(BUCKETS), 1.0, 0.0)
    w, scale = (np.frombuffer(found[c], np.float32).astype(np.float64) for c in ("weights", "scale"))
    return Model(w, scale, found["slope"], found["offset"])


def held_out(folds: int = 5, fold: int = 0, id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == fold, F.lit(False))


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (probability of label 1) and ``predicted`` to every row.

    A null text is scored like an empty one. Without labels every score is 0.5. Other
    columns stay, but columns of these two names are replaced.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    scored = docs.withColumn("score", score(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
