"""Packing documents into sequences by vector best-fit.

Texts become token ids in the scan; only lengths and checksums of the pieces go on.
A piece is a vector of tokens, documents (1) and attention cost (the square of its
length, as attention stays within a document). A bin is a sequence with a capacity in
each. Pieces are placed in order of falling length, each into the open bin that fits in
every dimension and has the best score: the smallest weighted norm of what is left, or
the largest weighted dot product of the piece and what is left before.

Pieces are dealt at random into groups of about ``GROUP``, each packed in one task. A
group leaves at most about one sequence unfilled, a few hundredths of a percent.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lineage import cut

SEQUENCE = 2048
GROUP = 16_384
END_ID = 0  # closes every document
# Fixed value: how the byte-level vocabulary cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Capacity:
    """What a sequence may hold, and how much each part weighs in the score."""

    tokens: int = SEQUENCE
    documents: int = SEQUENCE
    attention: int = SEQUENCE * SEQUENCE
    weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4)
    score: str = "norm"  # or "dot"


def _byte_symbols() -> dict[str, int]:
    """The printable symbols that stand for bytes in a byte-level vocabulary file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


_encoders: dict[str, Callable[[str], list[int]]] = {}


def encoder(path: str) -> Callable[[str], list[int]]:
    """Token ids of a whole text under the byte-level vocabulary file at ``path``.

    The ids are those of the file's own library (a test compares them), from a faster
    encoder. Strings of special tokens in a text are ordinary text.
    """
    if path not in _encoders:
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        symbols = _byte_symbols()
        ranks = {bytes(symbols[c] for c in t): i for t, i in vocabulary.items() if all(c in symbols for c in t)}
        ranks = {t: i for t, i in ranks.items() if not (t.startswith(b"<|") and t.endswith(b"|>"))}
        made = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        _encoders[path] = made.encode_ordinary
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document; null text is empty.

    A document is its ids and ``END_ID``. One longer than ``size`` is cut into pieces of
    ``size``, the first of which takes what is over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for i, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), END_ID], "<u4")
                start, end = 0, len(ids) % size or min(size, len(ids))
                while start < len(ids):
                    rows.append((i, len(rows), start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start, end = end, end + size
            table = np.array(rows, np.int64).reshape(-1, 5)
            first = np.searchsorted(table[:, 0], table[:, 0])
            number = pa.array((np.arange(len(table)) - first).astype(np.int32))
            ids_of = batch.column("doc_id").take(pa.array(table[:, 0]))
            values = [ids_of, number, *[pa.array(table[:, k]) for k in (2, 3, 4)]]
            yield pa.RecordBatch.from_arrays(values, ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: Capacity = Capacity()) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece."""
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    weights = np.array(capacity.weights)[:, None]
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    left = np.zeros((3, 1024))  # of the open bins
    ids = np.zeros(1024, np.int64)
    count = made = 0
    smallest = lengths.min() if n else 0
    for i in order:
        size = float(lengths[i])
        item = np.array([size, 1.0, size * size])
        if (item > full).any():
            raise ValueError(f"a piece of {lengths[i]} tokens fits no sequence")
        best = -1
        if count:
            rest = left[:, :count] - item[:, None]
            fits = (rest >= 0).all(0)
            if fits.any():
                if capacity.score == "dot":
                    value = -(weights * (item / full)[:, None] * (left[:, :count] / full[:, None])).sum(0)
                else:
                    value = (weights * (rest / full[:, None]) ** 2).sum(0)
                best = int(np.argmin(np.where(fits, value, np.inf)))
        if best < 0:
            if count == left.shape[1]:
                left, ids = np.concatenate((left, np.zeros_like(left)), 1), np.concatenate((ids, np.zeros_like(ids)))
            best, count, made = count, count + 1, made + 1
            left[:, best], ids[best] = full, made - 1
        bins[i], offsets[i] = ids[best], capacity.tokens - left[0, best]
        left[:, best] -= item
        if left[0, best] < smallest or left[1, best] < 1:  # nothing fits any more
            count -= 1
            left[:, best], ids[best] = left[:, count], ids[count]
    return bins, offsets


def pack(found: DataFrame, capacity: Capacity = Capacity(), group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (any columns, one named ``length``).

    Groups are dealt by a row number over stored rows, so no id, length or repeated row
    can crowd one. An empty table gives an empty result; a piece without length fails.
    """
    found = cut(found.drop("sequence_id", "offset"))
    groups = max(math.ceil(found.count() / group), 1)
    dealt = found.withColumn("__group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    columns = found.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_fit(pdf["length"].to_numpy(np.int64), capacity)
        own = pdf["__group"].to_numpy(np.int64) << 32
        return pdf[columns].assign(sequence_id=own + bins, offset=offsets)

    fields = ", ".join(f"`{name}` {kind}" for name, kind in found.dtypes)
    return dealt.groupBy("__group").applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), group: int = GROUP) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity.tokens), capacity, group)
