"""Source divergence audit: how far each source's term profile lies from its language's and its siblings'.

Vocabularies: one CountVectorizer (minDF a count, vocabSize the largest integer) over terms
prefixed by their language, so each language keeps exactly its terms found in at least
``min_df`` of its own documents (a term of two languages is two entries). Its model gives
exact sparse count vectors. Texts are dealt by ranges of (lang, source, hash of the row) and cut into terms
in Arrow batches, as bytes. The estimator asks only whether ``min_df`` documents hold a term, so a task hands it
row k of the terms that k or more of its documents hold, for k up to ``min_df``. Counts add up, so a
task first counts the terms of each group's documents and hands the model one row per group and
binary digit of the counts, holding the terms with that digit set. Group sums, as a Summarizer would
take them but sparse: the (index, count) entries of every vector, times the row's digit, are summed per
(lang, source, index) inside each Arrow task (numpy) and again across tasks, so a hot source never meets one task with its documents, only with its terms.

With V kept terms of a language, N the sum of a group's counts over them and c a term's count,
p = 1 + floor(10^9 (c + 5) / (N + 5V)), exact (38-digit decimals, integer division). Part
``pair``: for each other source of the language, the sum over all V terms of |p - q|: the terms of a
language are dealt into blocks, each block a dense sources x terms matrix in one task (absent counts
take z, the value at count 0), summed over unordered pairs with numpy and then over blocks. Part
``term``: terms of the group with p above the language's p, the 50 largest differences.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.lineage import stage

# Fixed values of the audit's definition.
TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DF = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BLOCK_CELLS = 4_000_000  # sources x terms held by one task of the pair sums
PAIR_WORK = 200_000_000  # differences one such task takes at most
SEP = "\u0000"  # between language and term; terms never hold it
EXACT = "decimal(38,0)"
HELD = 100_000  # terms a task holds before it hands them on
SUMMED = 2_000_000  # summed counts a task holds before it hands them on
# What TERMS and the lower-casing say, byte by byte: all bytes it excludes are ASCII.
_TERM_BYTES = bytes(b | 32 if chr(b) in UPPER else b if chr(b) in LOWER or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z lower-cased (no other letter changes)."""
    return text.translate(_TERM_BYTES).split()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str, list[bytes]]]:
    for b in batches:
        langs, sources = (b.column(c).to_pylist() for c in ("__lang", "__source"))
        for lang, source, text in zip(langs, sources, b.column("__text").cast(pa.binary())):
            yield lang, source, terms(text.as_py())


def _prefixed(lang: str, found: Iterable[bytes]) -> list[bytes]:
    head = (lang + SEP).encode()
    return [head + w for w in found]


def _lists(flat: pa.Array, sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat)


def _frequent(batches: Iterable[pa.RecordBatch], min_df: int) -> Iterator[pa.RecordBatch]:
    """``__terms``: rows of different terms that say of each term whether ``min_df`` documents hold it.

    Of the documents a task counts together, row k holds the terms that k or more of them hold, k up to
    ``min_df``. So a term is in min(n, ``min_df``) rows for its n documents there, and in ``min_df`` rows
    or more of all exactly if it is in that many documents."""
    langs: dict[str, Counter] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counts in langs.items():
            count = np.fromiter(counts.values(), np.int64, len(counts))
            order = np.argsort(-count, kind="stable")
            flat = pa.array(_prefixed(lang, counts), pa.string()).take(pa.array(order))
            most = min(int(count.max(initial=0)), max(min_df, 1))
            sizes = np.searchsorted(-count[order], -np.arange(1, most + 1), "right")  # terms in k or more
            for n in sizes.tolist():
                yield pa.RecordBatch.from_arrays([_lists(flat.slice(0, n), [n])], ["__terms"])

    for lang, _, found in _rows(batches):
        counts = langs.setdefault(lang, Counter())
        held -= len(counts)
        counts.update(set(found))
        held += len(counts)
        if held + len(langs) >= HELD:
            yield from rows()
            langs, held = {}, 0
    yield from rows()


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``__lang, __source, __digit, __terms``: the terms whose count in a group's documents, as far as
    this task holds them, has the binary digit ``__digit`` (a power of two) set. Every group has a row."""
    groups: dict[tuple[str, str], Counter] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in groups.items():
            count = np.fromiter(counts.values(), np.int64, len(counts))
            flat = pa.array(_prefixed(lang, counts), pa.string())
            digits = [1 << k for k in range(max(int(count.max(initial=1)).bit_length(), 1))]
            at = [np.flatnonzero(count & d) for d in digits]
            values = [pa.array([lang] * len(at)), pa.array([source] * len(at)), pa.array(digits, pa.int64()), _lists(flat.take(pa.array(np.concatenate(at))), [len(a) for a in at])]
            yield pa.RecordBatch.from_arrays(values, ["__lang", "__source", "__digit", "__terms"])

    for lang, source, found in _rows(batches):
        counts = groups.setdefault((lang, source), Counter())
        held -= len(counts)
        counts.update(found)
        held += len(counts)
        if held + len(groups) >= HELD:
            yield from rows()
            groups, held = {}, 0
    yield from rows()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's counts summed per (lang, source, idx) before they leave it, as far as it holds them (``SUMMED``
    rows and what came since), plus one row (index -1, count 0) per group."""
    numbers: dict[tuple[str, str], int] = {}  # a group's place here, in the upper half of a key; the lower is 1 + idx
    keys, counts, size, least = [], [], 0, 0

    def rows(key: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array(v, pa.string()) for v in zip(*numbers))
        for k in range(0, len(key), HELD):
            of = pa.array(key[k : k + HELD] >> 32)
            idx = pa.array(((key[k : k + HELD] & 0xFFFFFFFF) - 1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([langs.take(of), sources.take(of), idx, pa.array(count[k : k + HELD])], ["lang", "source", "idx", "c"])

    for b in batches:
        vec = b.column("__vec")
        for k, lang, source, digit in zip(range(b.num_rows), *(b.column(c).to_pylist() for c in ("__lang", "__source", "__digit"))):
            # the model's vectors are sparse: struct of type, size, indices, values
            idx = vec.field("indices")[k].values.to_numpy()
            head = numbers.setdefault((lang, source), len(numbers)) << 32
            keys.append(np.concatenate(([head], head + 1 + idx.astype(np.int64))))
            counts.append(np.append(0, vec.field("values")[k].values.to_numpy().astype(np.int64) * digit))
            size += len(keys[-1])
            if size >= 2 * least + HELD:
                key, count = _summed(np.concatenate(keys), np.concatenate(counts))
                if len(key) >= SUMMED:
                    yield from rows(key, count)
                    numbers.clear()
                    keys, counts, size, least = [], [], 0, 0
                else:
                    keys, counts, size, least = [key], [count], len(key), len(key)
    if size:
        yield from rows(*_summed(np.concatenate(keys), np.concatenate(counts)))


def _block_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum of |p_a - p_b| over this block's terms for every pair a < b of the language's sources.

    Rows with idx -1 name every source and its value at count 0 (z); the others are the sparse entries.
    """
    heads = pdf[pdf["idx"] < 0].sort_values("source")
    sources = heads["source"].tolist()
    body = pdf[pdf["idx"] >= 0]
    terms, col = np.unique(body["idx"].to_numpy(), return_inverse=True)
    row = pd.Index(sources).get_indexer(body["source"])
    P = np.repeat(heads["p"].to_numpy(dtype=np.int64)[:, None], len(terms), axis=1)
    P[row, col] = body["p"].to_numpy(dtype=np.int64)
    lang = pdf["lang"].iloc[0]
    out = []
    for i in range(len(sources) - 1):
        diff = np.abs(P[i + 1:] - P[i]).sum(axis=1)
        out += [(lang, sources[i], sources[j], int(diff[j - i - 1])) for j in range(i + 1, len(sources))]
    return pd.DataFrame(out, columns=["lang", "a", "b", "near"])


def _fit(prefixed: DataFrame, min_df: int):
    """The CountVectorizer model, or None when no language keeps a term (the estimator refuses an empty vocabulary)."""
    try:
        return CountVectorizer(inputCol="__terms", outputCol="__vec", minDF=float(min_df), vocabSize=2**31 - 1).fit(prefixed)
    except Exception as e:  # noqa: BLE001 - only the empty vocabulary is expected here
        if "vocabulary size should be > 0" in str(e).lower() or "vocabulary size should be" in str(e):
            return None
        raise


def audit(documents: DataFrame, min_df: int = MIN_DF, top: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of parts ``pair`` and ``term``; see the module text.

    Defined cases: null text, lang or source read as ''; an empty table gives no rows; a group
    without kept terms still has pair rows (its p are those of count 0); a language with one
    source has no pair rows; V = 0 gives pair values 0 and no term rows. Repeated documents count
    as often as they occur. Ties rank by the item's UTF-8 bytes. Other input columns are not carried.
    """
    docs = documents.select(
        F.xxhash64(*[c for c in ("doc_id", "text") if c in documents.columns]).alias("__own"),
        F.coalesce(F.col("text"), F.lit("")).alias("__text"),
        F.coalesce(F.col("lang"), F.lit("")).alias("__lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("__source"))
    spark = documents.sparkSession
    # a group's documents in few tasks, by ranges that split a large one, stored once: each task holds few
    # groups' terms and counts most of their documents together
    docs = stage(docs.repartitionByRange("__lang", "__source", "__own").drop("__own"), "divergence-documents")
    # document frequencies need each document's distinct terms only, and matter up to min_df only
    model = _fit(docs.mapInArrow(lambda batches: _frequent(batches, min_df), "__terms array<string>"), min_df)
    vocabulary = model.vocabulary if model else []
    vocab = spark.createDataFrame([(i, *w.rsplit(SEP, 1)) for i, w in enumerate(vocabulary)], "idx int, lang string, term string")
    kept = vocab.groupBy("lang").agg(F.count(F.lit(1)).alias("nv"))
    if model:
        counted = docs.mapInArrow(_counted, "__lang string, __source string, __digit long, __terms array<string>")
        flat = model.transform(counted).select("__lang", "__source", "__digit", "__vec").mapInArrow(
            _entries, "lang string, source string, idx int, c long")
    else:
        flat = docs.select(F.col("__lang").alias("lang"), F.col("__source").alias("source"),
                               F.lit(-1).alias("idx"), F.lit(0).cast("long").alias("c"))
    # The one pass over the documents: (lang, source, term) counts, at most groups x kept terms rows, stored once.
    summed = stage(flat.groupBy("lang", "source", "idx").agg(F.sum("c").alias("c")), "divergence-counts")
    counts = summed.where(F.col("idx") >= 0)
    groups = (summed.groupBy("lang", "source").agg(F.sum("c").alias("total")).join(kept, "lang", "left")
              .select("lang", "source", "total", F.coalesce("nv", F.lit(0)).alias("nv")))
    groups = groups.withColumn("z", _exact_p("0", "total", "nv"))
    entries = stage(counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "idx", "c", _exact_p("c", "total", "nv").alias("p")), "divergence-entries")

    # unordered pairs (a < b); the value is symmetric and is given to both sides below
    pairs = groups.alias("a").join(groups.alias("b"), "lang").where(F.col("a.source") < F.col("b.source")).select(
        "lang", F.col("a.source").alias("a"), F.col("b.source").alias("b"), F.col("a.nv").alias("nv"))
    # Pair sums over terms in blocks: a task holds one block of a language's terms for all its sources,
    # at most BLOCK_CELLS values and PAIR_WORK differences; absent terms take the source's z.
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("nv").alias("nv"))
    blocks = sizes.select("lang", F.greatest(
        F.lit(1), F.ceil(F.col("nv") * F.col("s") / F.lit(BLOCK_CELLS)),
        F.ceil(F.col("nv") * F.col("s") * F.col("s") / F.lit(PAIR_WORK))).cast("int").alias("nb"))
    cells = entries.join(blocks, "lang").select("lang", F.pmod("idx", "nb").alias("block"), "source", "idx", "p")
    heads = groups.where(F.col("nv") > 0).join(blocks, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"), "source", F.lit(-1).alias("idx"), F.col("z").alias("p"))
    near = (cells.unionByName(heads).groupBy("lang", "block").applyInPandas(_block_pairs, "lang string, a string, b string, near long")
            .groupBy("lang", "a", "b").agg(F.sum("near").alias("near")))
    valued = pairs.join(near, ["lang", "a", "b"], "left").select(
        "lang", "a", "b", F.when(F.col("nv") == 0, F.lit(0)).otherwise(F.coalesce("near", F.lit(0))).cast("long").alias("value"))
    pair = valued.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value").unionByName(
        valued.select("lang", F.col("b").alias("source"), F.lit("pair").alias("part"), F.col("a").alias("item"), "value"))

    lang_counts = counts.groupBy("lang", "idx").agg(F.sum("c").alias("cl"))
    lang_totals = lang_counts.groupBy("lang").agg(F.sum("cl").alias("tl")).join(kept, "lang")
    lang_p = lang_counts.join(lang_totals, "lang").select("lang", "idx", _exact_p("cl", "tl", "nv").alias("q"))
    term = (entries.join(lang_p, ["lang", "idx"]).where(F.col("p") > F.col("q"))
            .join(vocab.select("idx", "term"), "idx")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).cast("long").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranked_terms = term.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top)
    ranked_pairs = pair.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked_pairs.unionByName(ranked_terms)


def _exact_p(count: str, total: str, nv: str) -> F.Column:
    """1 + floor(10^9 (count + 5) / (total + 5 nv)) as long, exact; null when total + 5 nv is 0. Arguments are SQL."""
    den = f"(cast({total} as {EXACT}) + {SMOOTH} * cast({nv} as {EXACT}))"
    num = f"(cast({SCALE} as {EXACT}) * (cast({count} as {EXACT}) + {SMOOTH}))"
    return F.expr(f"case when {den} > 0 then 1 + ({num} div {den}) end")
