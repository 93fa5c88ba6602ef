"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A fingerprint's 64 bits are split into six blocks. Two fingerprints that differ in
at most four bits leave at least two blocks alike, so all close pairs meet in one of
the fifteen tables keyed by two blocks (21 or 22 bits). Equal fingerprints are one
row from the start, so exact copies of any number cost nothing here.

A bucket of at most ``BUCKET`` fingerprints is joined with itself and each pair is
verified. A larger one is a crowd of near copies (or a crowded key); its members meet
at midpoints instead: two fingerprints differ in at most four bits just when some
value lies within two bits of both. Every fingerprint lists those values, and all
that list the same one link to the smallest of them. This finds the same components
with a number of rows in proportion to the members, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.textbytes import column
from ledgerline.operators.lineage import cut

WORDS = 4
BITS = 4
SEED = 42
BUCKET = 512
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))  # first bit, width
_CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of one text as an unsigned number; 0 for a text without words."""
    found = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[min(words, len(found)) - 1 :]
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(ends), _CHUNK):
        pairs = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist())
        h = np.array([digest(joined[s:e], SEED) for s, e in pairs], np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(ends), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, data = column(batch, "text")
            bounds = at.tolist()
            raw = data.tobytes() if len(data) < 1 << 26 else memoryview(data)
            found = [fingerprint(bytes(raw[s:e]), words) for s, e in zip(bounds, bounds[1:])]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def block_keys(fp: Column) -> Column:
    """One number per pair of blocks: which pair, and the blocks' bits."""
    def block(i: int) -> Column:
        first, width = BLOCKS[i]
        return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))

    pairs = list(combinations(range(len(BLOCKS)), 2))
    return F.array(*[F.lit(k << 22) + F.shiftleft(block(i), 11) + block(j) for k, (i, j) in enumerate(pairs)])


def _midpoints(fp: Column, radius: int) -> Column:
    """All values within ``radius`` (at most 2) bits of ``fp``."""
    if radius == 0:
        return F.array(fp)

    def bit(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), i)

    def masks(i: Column) -> Column:  # one bit where both are the same
        last = F.lit(63) if radius == 2 else i
        return F.transform(F.sequence(i, last), lambda j: bit(i).bitwiseOR(bit(j)))

    flips = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(63)), masks))
    return F.concat(F.array(fp), F.transform(flips, lambda m: fp.bitwiseXOR(m)))


def close_links(fps: DataFrame, bits: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` (values of ``rep``) whose components are those of all close pairs.

    ``fps`` has distinct ``fp`` with one ``rep`` each.
    """
    if bits not in (0, 2, 4):
        raise ValueError("bits must be 0, 2 or 4: at most four leave two blocks alike, and midpoints need an even number")
    keyed = fps.select("fp", "rep", F.explode(block_keys(F.col("fp"))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
    small = keyed.join(sizes.where(F.col("n").between(2, bucket)).select("key"), "key")
    other = small.select("key", F.col("fp").alias("fp2"), F.col("rep").alias("rep2"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= bits
    pairs = small.join(other, "key").where((F.col("fp") < F.col("fp2")) & close)
    links = pairs.select(F.col("rep").alias("a"), F.col("rep2").alias("b"))

    crowded = keyed.join(sizes.where(F.col("n") > bucket).select("key"), "key")
    crowded = cut(crowded.select("fp", "rep").distinct())
    if crowded.isEmpty():
        return links
    mid = crowded.select("rep", F.explode(_midpoints(F.col("fp"), bits // 2)).alias("mid"))
    least = mid.groupBy("mid").agg(F.min("rep").alias("a"))
    stars = mid.join(least, "mid").select("a", F.col("rep").alias("b")).where("a <> b")
    return links.union(stars.distinct())


def near_duplicates(
    docs: DataFrame, words: int = WORDS, bits: int = BITS, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex), ``component_id``, ``n_links``.

    ``component_id`` is the smallest id reachable over links of at most ``bits``
    differing bits; ``n_links`` counts the linked fingerprints of other texts found
    for the document's class. A null text is empty; an empty text has fingerprint 0
    and is linked like any other. Repeated rows stay repeated. Rows with a null id keep
    their fingerprint; their component is that of equal fingerprints, or null if no row
    with an id is reachable. Columns besides id and text are not read.
    """
    fps = cut(with_fingerprint(docs, words, id_col, text_col))
    classes = fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    # a document may stand twice with different texts: its classes are then one
    same = fps.join(classes, "fp").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    repeated = fps.groupBy("doc_id").agg(F.count_distinct("fp").alias("n")).where("n > 1").select(F.col("doc_id").alias("b"))
    found = cut(close_links(classes, bits, bucket).union(same.join(repeated, "b").select("a", "b")).distinct())
    n_links = found.select(F.col("a").alias("rep")).union(found.select("b")).groupBy("rep").agg(F.count("*").alias("n_links"))
    of = components(found, "a", "b").withColumnRenamed("node", "rep")
    classes = classes.join(of, "rep", "left").join(n_links, "rep", "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return fps.join(classes, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links"
    )
