"""Exact top-k inner products over a vector-approximation file.

Every component is kept twice: as a cell of a grid of equal steps per dimension, one
byte, and exactly. A query first scans the cells of a partition. A cell's range bounds
the component, so the cells bound the inner product from both sides. The exact vectors
are then read in order of falling upper bound (for a distance: rising lower bound), until
the kth exact score is above every bound left. The few rows each partition is sure of
are ranked together.

Queries go in blocks of about ``BLOCK`` rows, each small enough to broadcast (its bytes
are checked); a block scans the stored file once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lineage import stage

BITS = 6
BLOCK = 4096
BLOCK_BYTES = 64 * 1024 * 1024


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` per component; null for a vector that is null, or holds a
    null, infinite or undefined component."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def approximate(vectors: DataFrame, bits: int = BITS) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Store ``id, exact, cells`` and give each dimension's lowest value and step.

    ``vectors`` has ``id`` and ``exact`` (array<long>), all of one length.
    """
    lows = vectors.select(F.posexplode("exact").alias("d", "v")).groupBy("d").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    found = lows.orderBy("d").collect()  # one row per dimension
    low = np.array([r["low"] for r in found], np.float64)
    step = np.maximum(np.ceil((np.array([r["high"] for r in found]) - low + 1) / (1 << bits)), 1)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = _matrix(batch.column("exact"), len(low))
            cell = ((exact - low) // step).astype(np.uint8)
            raw = pa.array([row.tobytes() for row in cell], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("exact"), raw], ["id", "exact", "cells"])

    stored = stage(vectors.mapInArrow(cells, "id long, exact array<long>, cells binary"), "vector-file")
    return stored, low, step


def _matrix(arrays: pa.Array, width: int) -> np.ndarray:
    return arrays.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products (queries by rows)."""
    first = low + cells * step  # the cell's lowest value; its highest is step - 1 more
    half = (step - 1) / 2
    middle = queries @ (first + half).T
    reach = np.abs(queries) @ half
    return middle - reach[:, None], middle + reach[:, None]


def _search(query: np.ndarray, skip: int, ids: np.ndarray, exact: np.ndarray, low_b: np.ndarray, high_b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows by score, then id, among those not numbered ``skip``."""
    usable = np.flatnonzero(ids != skip)
    if len(usable) > k:
        sure = np.partition(low_b[usable], len(usable) - k)[len(usable) - k]  # k rows have at least this
        usable = usable[high_b[usable] >= sure]
    usable = usable[np.argsort(-high_b[usable], kind="stable")]
    best_s, best_i = np.zeros(0), np.zeros(0, np.int64)
    at, read = 0, max(4 * k, 32)
    while at < len(usable) and (len(best_s) < k or high_b[usable[at]] >= best_s[-1]):
        rows = usable[at : at + read]
        at, read = at + read, 2 * read
        s = np.concatenate((best_s, exact[rows] @ query))
        i = np.concatenate((best_i, ids[rows]))
        order = np.lexsort((i, -s))[:k]
        best_s, best_i = s[order], i[order]
    return best_s, best_i


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str, vector_col: str, scale: int = 256, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest scores, ties to smaller ids.

    ``is_query`` picks the queries among the rows; candidates are all rows but those with
    the query's own id. Rows that repeat an id and its vector are one row; rows of one id
    with different vectors are candidates each, and the id is queried once, with the first
    of its vectors. A null id, and a vector that is null or holds a null, infinite or
    undefined component, take no part; nor do vectors of another length than most have.
    """
    if not 1 <= bits <= 8:
        raise ValueError("a cell is one byte")
    own = vectors.select(F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector_col), scale).alias("exact"), is_query.alias("asked"))
    own = own.where("id is not null and exact is not null and size(exact) > 0").distinct()
    own = stage(own, "vectors")
    spark = own.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    sizes = own.groupBy(F.size("exact").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    own = own.where(F.size("exact") == sizes["n"])
    stored, low, step = approximate(own.select("id", "exact"), bits)
    asked = own.where("asked").groupBy("id").agg(F.min("exact").alias("exact"))
    blocks = max(math.ceil(asked.count() / block), 1)
    if block * sizes["n"] * 8 > BLOCK_BYTES:
        raise ValueError("use smaller blocks of queries for vectors of this length")
    width = len(low)

    parts = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toPandas()  # about `block` rows
        if not len(rows):
            continue
        shared = spark.sparkContext.broadcast((rows["id"].to_numpy(np.int64), np.array(rows["exact"].tolist(), np.float64)))
        parts.append(stored.mapInArrow(_scan(shared, low, step, width, k), "query_id long, vec_id long, score long"))
    found = parts[0] if parts else spark.createDataFrame([], "query_id long, vec_id long, score long")
    for part in parts[1:]:
        found = found.union(part)
    ranked = found.selectExpr("*", "row_number() over (partition by query_id order by score desc, vec_id) as rank")
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scan(shared, low: np.ndarray, step: np.ndarray, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_q, queries = shared.value
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids_q)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids = part.column("id").to_numpy()
                cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, width)
                exact = _matrix(part.column("exact"), width).astype(np.float64)
                for first in range(0, len(ids_q), 512):
                    low_b, high_b = bounds(queries[first : first + 512], cells, low, step)
                    for j in range(len(low_b)):
                        q = first + j
                        s, i = best[q]
                        if len(s) == k and high_b[j].max() < s[-1]:
                            continue
                        s2, i2 = _search(queries[q], ids_q[q], ids, exact, low_b[j], high_b[j], k)
                        s, i = np.concatenate((s, s2)), np.concatenate((i, i2))
                        order = np.lexsort((i, -s))[:k]
                        best[q] = s[order], i[order]
        counts = [len(s) for s, _ in best]
        if sum(counts):
            values = [np.repeat(ids_q, counts), np.concatenate([i for _, i in best]), np.concatenate([s for s, _ in best]).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["query_id", "vec_id", "score"])

    return run
