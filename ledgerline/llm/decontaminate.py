"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into overlapping passages of ``2 * STEP`` words. Passages are TF-IDF
vectors over the words of the benchmark (words in more than ``COMMON`` of the documents
count for nothing); document frequencies cover all documents. A distributed randomised
SVD finds the directions in which passages of documents and of the benchmark (weighted
alike) vary most: every task adds up its part of a sketch of the covariance, and only the
sum, words times directions, reaches the driver. A passage near a benchmark item in that
latent space (cosine) is a candidate. It is checked by the longest common subsequence of
words: enough of the item in the item's order within a stretch little longer than it, and,
where an item has an answer, the answer's words among them.

An item that many documents hold makes its own words common. Items that could be found by
words that count for nothing alone are also compared with every passage over the words
themselves, and there enough of their words count (:func:`weights`).

The benchmark is the stated query set. It is handled in blocks whose bytes are bounded and
broadcast; each block scans the documents.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 24  # words between passage starts; a passage has twice as many
RANK = 96
EXTRA = 32  # more directions in the sketch than are kept
COMMON = 0.05
COSINE = 0.5
OVERLAP = 0.6  # of the item's words, in order
STRETCH = 1.5  # the words looked at, as a multiple of the item's
SHORTEST = 5  # items of fewer words can not be told from chance and are left out
BLOCK_BYTES = 32 * 1024 * 1024
_SEED = 20
_CHECKERS = 1000  # items whose word tables are kept in a process
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and digits and of other characters beyond ASCII."""
    return text.lower().encode("utf-8", "replace").translate(_WORD_BYTES).split()


def _code(number: int) -> bytes:
    return number.to_bytes(4, "little")


@dataclass(frozen=True)
class Item:
    item_id: int
    words: tuple[int, ...]  # numbers in the vocabulary
    answer: frozenset[int]


@dataclass(frozen=True)
class Block:
    """Benchmark items and their words."""

    vocabulary: dict[bytes, int]
    items: list[Item]

    @cached_property
    def _codes(self) -> dict[bytes, bytes]:
        """The vocabulary with its numbers as four bytes: joined, they are an array."""
        return {w: _code(n) for w, n in self.vocabulary.items()}

    @cached_property
    def _known(self) -> frozenset[bytes]:
        return frozenset(self.vocabulary)

    def numbers(self, text: str) -> np.ndarray:
        """Number of each word; the vocabulary's size for a word outside the benchmark."""
        return self._numbers(words(text))

    def distinct(self, text: str) -> np.ndarray:
        """Like :meth:`numbers`, of the different benchmark words, in no order."""
        return self._numbers(self._known.intersection(words(text)))

    def _numbers(self, found: Collection[bytes]) -> np.ndarray:
        other = _code(len(self.vocabulary))
        return np.frombuffer(b"".join(map(self._codes.get, found, repeat(other))), "<i4").astype(np.int64)


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of at most ``limit`` bytes of text, read one at a time."""
    answered = "answer" in benchmark.columns
    rows = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("long"), "text", (F.col("answer") if answered else F.lit("")).alias("answer"))
    vocabulary: dict[bytes, int] = {}
    items: list[Item] = []
    used = 0
    for row in rows.dropDuplicates().toLocalIterator():
        found = words(row["text"])
        if len(found) < SHORTEST:
            continue
        numbers = tuple(vocabulary.setdefault(w, len(vocabulary)) for w in found)
        answer = frozenset(vocabulary.setdefault(w, len(vocabulary)) for w in words(row["answer"] or ""))
        items.append(Item(row["item_id"], numbers, answer))
        used += len(row["text"])
        if used >= limit:
            yield Block(vocabulary, items)
            vocabulary, items, used = {}, [], 0
    if items:
        yield Block(vocabulary, items)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    for i, text in enumerate(batch.column("text")):
        yield i, text.as_py() or ""


def frequencies(docs: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """In how many documents each benchmark word is, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    size = len(block.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            for _, text in _texts(batch):
                seen[shared.value.distinct(text)] += 1  # once a word: equal numbers do not add up
                rows += 1
        seen[size] = rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["word", "n"])

    found = docs.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(size + 1, np.int64)
    n[found["word"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return n[:-1], int(n[-1])


def idf(n: np.ndarray, rows: int, common: float = COMMON) -> np.ndarray:
    """Weight per word; the last is for all words outside the benchmark."""
    weight = np.log((1 + rows) / (1 + n)) + 1
    weight[n > np.maximum(common * rows, 2)] = 0
    return np.append(weight, 0.0)


def short_items(block: Block, weight: np.ndarray, overlap: float = OVERLAP) -> list[int]:
    """Which items' places without weight could make up ``overlap`` of them."""
    without = [np.count_nonzero(weight[list(item.words)] == 0) for item in block.items]
    return [i for i, item in enumerate(block.items) if without[i] and without[i] >= overlap * len(item.words) - 1e-9]


def weights(block: Block, n: np.ndarray, rows: int, common: float = COMMON, overlap: float = OVERLAP) -> np.ndarray:
    """:func:`idf`, but the rarest words of an item keep weight until no ``overlap`` of it is without:
    as much as a word has that is just not too common."""
    weight = idf(n, rows, common)
    least = np.log((1 + rows) / (1 + min(max(common * rows, 2.0), rows))) + 1
    for i in short_items(block, weight, overlap):
        places = np.array(block.items[i].words)
        without = places[weight[places] == 0]
        over = len(without) - math.ceil(overlap * len(places) - 1e-9) + 1
        if over > 0:
            weight[without[np.argsort(n[without], kind="stable")][:over]] = least
    return weight


def chunks(numbers: np.ndarray) -> np.ndarray:
    """Start of every ``STEP`` words."""
    return np.arange(0, len(numbers), STEP)


def item_rows(block: Block, weight: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of the items, of length 1."""
    rows = np.zeros((len(block.items), len(block.vocabulary)))
    for i, item in enumerate(block.items):
        np.add.at(rows[i], list(item.words), weight[list(item.words)])
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def _covariance_times(docs: DataFrame, block: Block, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``A' A right`` for the matrix of all chunks of the documents, scaled to length 1."""
    shared = docs.sparkSession.sparkContext.broadcast((block, weight, np.vstack((right, np.zeros(right.shape[1]))).astype(np.float32)))
    size, width = right.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w, r = shared.value
        total = np.zeros((size + 1, width))
        rows, at, n, chunk = [], [], 0, 0

        def add() -> None:
            flat, of = np.concatenate(rows), np.concatenate(at)
            x = w[flat]
            used = np.flatnonzero(x > 0)  # the others add nothing; most words are such
            if not len(used):
                return
            flat, of, x = flat[used], of[used], x[used]
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(flat))))
            x = (x / np.sqrt(np.add.reduceat(x * x, starts))[of])[:, None].astype(np.float32)
            y = np.add.reduceat(r[flat] * x, starts)
            order = np.argsort(flat, kind="stable")
            first = np.flatnonzero(np.diff(flat[order], prepend=-1))
            total[flat[order][first]] += np.add.reduceat(y[of[order]] * x[order], first)

        for batch in batches:
            for _, text in _texts(batch):
                numbers = own.numbers(text)
                if len(numbers):
                    rows.append(numbers)
                    at.append(chunk + np.arange(len(numbers)) // STEP)
                    n, chunk = n + len(numbers), int(at[-1][-1]) + 1
                if n > 20_000:
                    add()
                    rows, at, n, chunk = [], [], 0, 0
        if n:
            add()
        seen = np.flatnonzero(np.abs(total[:-1]).sum(1) > 0)
        values = pa.FixedSizeListArray.from_arrays(pa.array(total[seen].ravel()), width) if len(seen) else None
        if values is not None:
            yield pa.RecordBatch.from_arrays([pa.array(seen), values.cast(pa.list_(pa.float64()))], ["word", "v"])

    parts = docs.mapInArrow(run, "word long, v array<double>")
    sums = parts.groupBy("word").agg(*[F.sum(F.get("v", F.lit(k))).alias(f"v{k}") for k in range(width)]).toPandas()
    out = np.zeros((size, width))
    if len(sums):
        out[sums["word"].to_numpy(np.int64)] = sums[[f"v{k}" for k in range(width)]].to_numpy()
    return out


def latent(docs: DataFrame, block: Block, weight: np.ndarray, rank: int = RANK, extra: int = EXTRA) -> np.ndarray:
    """Words by directions: right singular vectors of the passages, by a randomised SVD."""
    items = item_rows(block, weight)
    width = min(rank + extra, len(block.vocabulary))
    start = np.random.default_rng(_SEED).standard_normal((len(block.vocabulary), width))
    sketch = _covariance_times(docs, block, weight, start)
    own = items.T @ (items @ start)
    scale = np.linalg.norm(own) / max(np.linalg.norm(sketch), 1e-30)
    basis, _ = np.linalg.qr(own + scale * sketch)
    # within the basis the covariance is small; items alone order its directions
    small = basis.T @ (items.T @ (items @ basis) + scale * sketch @ np.linalg.pinv(start.T @ start) @ (start.T @ basis))
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, np.argsort(-values)[:rank]]


def places(item: tuple[int, ...]) -> dict[int, int]:
    """For each word a bit vector of its places in the item."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def common_subsequence(masks: dict[int, int], size: int, passage: np.ndarray) -> int:
    """Length of the longest common subsequence of an item and a passage, by bit vectors."""
    full = row = (1 << size) - 1
    for m in map(masks.get, passage.tolist()):
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return size - row.bit_count()


class Checker:
    """Looks for one item in stretches of a text."""

    def __init__(self, item: Item, size: int) -> None:
        self.item = item
        distinct, counts = np.unique(item.words, return_counts=True)
        self.place = np.full(size + 1, len(distinct), np.int32)
        self.place[distinct] = np.arange(len(distinct))
        self.own = self.place < len(distinct)
        self.counts = counts
        self.masks = places(item.words)
        self.length = max(int(STRETCH * len(item.words)), len(item.words) + 3)

    def best(self, numbers: np.ndarray, near: int, overlap: float) -> float:
        """The largest share of the item found in order in a stretch about word ``near``;
        0 where the words there can not make up ``overlap`` of it."""
        size = len(self.item.words)
        first = max(near - self.length, 0)
        region = numbers[first : near + 2 * STEP + self.length]
        if np.count_nonzero(self.own[region]) < overlap * size:
            return 0.0  # the most there is to find; told without counts of each word
        have = np.bincount(self.place[region], minlength=len(self.counts) + 1)[:-1]
        if np.minimum(have, self.counts).sum() < overlap * size:
            return 0.0
        if common_subsequence(self.masks, size, region) < overlap * size:
            return 0.0  # a stretch has no longer one than the whole
        best = 0
        for s in range(0, max(len(region) - self.length, 0) + self.length // 8 + 1, max(self.length // 8, 1)):
            part = region[s : s + self.length]
            have = np.bincount(self.place[part], minlength=len(self.counts) + 1)[:-1]
            if np.minimum(have, self.counts).sum() <= max(best, overlap * size - 1):
                continue
            if not self.item.answer or self.item.answer <= set(part.tolist()):
                best = max(best, common_subsequence(self.masks, size, part))
        return best / size


def passages(numbers: np.ndarray, table: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Latent vectors of a text's passages; only words that are ``used`` have a row in ``table`` that is not zero."""
    z = np.zeros((len(chunks(numbers)), table.shape[1]), table.dtype)
    places = used[numbers].nonzero()[0]
    if len(places):
        chunk = places // STEP
        starts = np.ones(len(chunk), bool)
        np.not_equal(chunk[1:], chunk[:-1], out=starts[1:])
        first = starts.nonzero()[0]
        z[chunk[first]] = np.add.reduceat(table[numbers[places]], first)
    z[:-1] += z[1:].copy()  # a passage is a chunk and the next
    return z


@dataclass(frozen=True)
class Short:
    """Items compared with passages over the words themselves: a column each, and one for the length."""

    items: list[int]
    table: np.ndarray
    used: np.ndarray

    def near(self, numbers: np.ndarray) -> np.ndarray:
        """Cosine of every passage and item, or a little more where a passage repeats a word."""
        z = passages(numbers, self.table, self.used)
        return z[:, :-1] / np.sqrt(np.where(z[:, -1:] > 1e-9, z[:, -1:], 1))


def short(block: Block, weight: np.ndarray, items: list[int]) -> Short:
    """``weight`` is from :func:`weights`."""
    rows = item_rows(Block(block.vocabulary, [block.items[i] for i in items]), weight)
    table = np.vstack((rows * weight[:-1], weight[:-1] ** 2)).T
    table = np.vstack((table, np.zeros(table.shape[1]))).astype(np.float32, order="C")  # rows are gathered
    return Short(items, table, weight > 0)


def matches(numbers: np.ndarray, block: Block, checkers: dict[int, Checker], table: np.ndarray, used: np.ndarray, latent_items: np.ndarray, cosine: float, overlap: float, few: Short | None = None) -> list[tuple[int, int, float, float]]:
    """``item_id, first word of the passage, cosine, share`` of the items found in a text."""
    at = chunks(numbers)
    z = passages(numbers, table, used)
    norm = np.sqrt((z * z).sum(1))
    near = (z / np.where(norm > 1e-9, norm, 1)[:, None]) @ latent_items.T
    found = [(p, i, near[p, i]) for p, i in zip(*(x.tolist() for x in np.nonzero(near >= cosine)))]
    if few is not None:
        other = few.near(numbers)
        other[near[:, few.items] >= cosine] = 0  # they are there already
        found += [(p, few.items[k], other[p, k]) for p, k in zip(*(x.tolist() for x in np.nonzero(other >= cosine)))]
    best: dict[int, tuple[int, int, float, float]] = {}
    for p, i, c in found:
        item, known = block.items[i], best.get(i)
        if known and known[3] == 1.0:
            continue
        if i not in checkers:
            if len(checkers) >= _CHECKERS:
                checkers.clear()
            checkers[i] = Checker(item, len(block.vocabulary))
        share = checkers[i].best(numbers, int(at[p]), overlap)
        if share >= overlap and (known is None or share > known[3]):
            best[i] = (item.item_id, int(at[p]), min(float(c), 1.0), share)
    return list(best.values())


def find(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, overlap: float = OVERLAP, rank: int = RANK) -> DataFrame:
    """``doc_id, item_id, word, cosine, share``: one row per document row and item found in it.

    ``docs`` has ``doc_id, text``; ``benchmark`` has ``item_id, text`` and may have ``answer``.
    A null or empty text holds nothing; items without id or text, or of fewer than
    ``SHORTEST`` words, are not looked for. Equal document rows are found each. Items with
    equal texts are all reported.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, word long, cosine double, share double"
    parts = []
    for block in blocks(benchmark):
        n, total = frequencies(rows.select("text"), block)
        weight = idf(n, total)
        basis = latent(rows.select("text"), block, weight, rank)
        items = item_rows(block, weight) @ basis
        items /= np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-9)
        table = np.vstack((weight[:-1, None] * basis, np.zeros(basis.shape[1]))).astype(np.float32)
        at = short_items(block, weight, overlap)
        few = short(block, weights(block, n, total, overlap=overlap), at) if at else None
        shared = docs.sparkSession.sparkContext.broadcast((block, table, weight > 0, items.astype(np.float32), few))
        parts.append(rows.mapInArrow(_search(shared, cosine, overlap), schema))
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.union(part)
    return out


def _search(shared, cosine: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, table, used, items, few = shared.value
        checkers: dict[int, Checker] = {}
        for batch in batches:
            found = []
            for i, text in _texts(batch):
                numbers = block.numbers(text)
                if len(numbers):
                    found += [(i, *m) for m in matches(numbers, block, checkers, table, used, items, cosine, overlap, few)]
            of, item, word, near, share = zip(*found) if found else [()] * 5
            ids = batch.column("doc_id").take(pa.array(of, pa.int64()))
            values = [ids, pa.array(item, pa.int64()), pa.array(word, pa.int64()), pa.array(near, pa.float64()), pa.array(share, pa.float64())]
            yield pa.RecordBatch.from_arrays(values, ["doc_id", "item_id", "word", "cosine", "share"])

    return run
