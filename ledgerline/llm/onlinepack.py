"""Bounded-space online packing of documents into fixed-length sequences.

Each task reads its documents in order and keeps at most ``windows`` open sequences. A
piece goes into the open sequence whose gap is the smallest that still holds it (best fit);
when none holds it and fewer than ``windows`` are open, a new one opens; otherwise the fullest
open sequence is completed with a cut of the piece and emitted, and the rest is placed again.
A sequence that becomes full is emitted at once. Memory per task: the open sequences' ids
(``windows`` x ``length``) and the document being read.

What is left open at the end of a task, at most ``windows`` sequences, is merged in a tree:
the leftovers of ``FAN`` tasks meet in one group (carrying their ids, so cuts keep exact
checksums), are packed the same way, and leave at most ``windows`` sequences to the next level,
until one group remains, whose open sequences are emitted as they are (the only padding).
Stage outputs are written to the shared folder, so a lost executor repeats only its tasks.

A document's ids: those of the tokenizer file's own library (``tokenizers``), no special tokens
added, then ``END_ID``; computed by tiktoken over the same vocabulary where that gives the same ids
(see :class:`Encoder`). Null text counts as empty (one id).
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lineage import stage

LENGTH = 1024
WINDOWS = 8
FAN = 64
END_ID = 0
LEVEL_BITS, GROUP_BITS = 56, 32
SEGMENT = 1 << 20  # characters encoded at once: the library's encodings hold some 100 bytes a token

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "wkey long, pno int, ids array<int>, grp long")


def crc(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


class Packer:
    """The online packer of one task; ``out`` collects rows of emitted and, at ``close``, leftover pieces."""

    def __init__(self, length: int, windows: int, base: int):
        self.length, self.windows, self.base = length, windows, base
        self.open: list[dict] = []
        self.made = 0
        self.out: list[tuple] = []

    def _emit(self, w: dict, leftover: bool = False) -> None:
        key = self.base + self.made
        self.made += 1
        offset = 0
        for no, (doc_id, start, ids, doc_tokens) in enumerate(w["pieces"]):
            n = len(ids)
            self.out.append((doc_id, start, n, crc(ids), doc_tokens, None if leftover else key, None if leftover else offset,
                             key if leftover else None, no if leftover else None,
                             ids.astype(np.int32) if leftover else None))
            offset += n

    def add(self, doc_id, ids: np.ndarray, start: int, doc_tokens: int) -> None:
        s, rest = 0, len(ids)
        while rest > 0:
            best, gap = None, None
            for w in self.open:
                g = self.length - w["used"]
                if g >= rest and (gap is None or g < gap):
                    best, gap = w, g
            if best is not None:
                take = rest
            elif len(self.open) < self.windows:
                best = {"used": 0, "pieces": []}
                self.open.append(best)
                take = min(rest, self.length)
            else:
                best = max(self.open, key=lambda w: w["used"])  # the first of the fullest
                take = self.length - best["used"]
            best["pieces"].append((doc_id, start + s, ids[s:s + take], doc_tokens))
            best["used"] += take
            s, rest = s + take, rest - take
            if best["used"] == self.length:
                self.open.remove(best)
                self._emit(best)

    def close(self, final: bool) -> None:
        """Leftover sequences: emitted padded when ``final``, else passed on with their ids."""
        for w in sorted(self.open, key=lambda w: -w["used"]):
            self._emit(w, leftover=not final)
        self.open = []


def _frame(rows: list[tuple], group: int) -> pd.DataFrame:
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "wkey", "pno", "ids"]
    columns = list(zip(*rows)) if rows else [()] * len(cols)
    # Nullable integer arrays built from the Python ints: keys above 2^53 must not pass through float.
    pdf = pd.DataFrame({c: (list(v) if c == "ids" else pd.array(list(v), dtype="Int64")) for c, v in zip(cols, columns)})
    pdf["grp"] = group
    return pdf


_CUT = re.compile(r"(?<=\S) (?=\S)")  # a lone space between two other characters starts a new word


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """The text in pieces of about ``size`` characters, cut only before a lone space between two non-spaces.

    The byte-level vocabulary's words start at such a space, and merges never cross words, so the ids
    of the pieces are those of the whole text. A text without such a space stays whole.
    """
    out, start = [], 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size)
        if not found:
            break
        out.append(text[start:found.start()])
        start = found.start()
    out.append(text[start:])
    return out


_END = np.array([END_ID], dtype=np.uint32)
_LONG_RUN = re.compile(r"\S{10000}|\s{10000}")  # such runs go to the file's own library, which handles them


class Encoder:
    """The ids the tokenizer file's library gives (no special tokens added), mostly by a faster encoder.

    The file's added tokens are cut out first and take their own ids, as the library does; the text
    between them is encoded by tiktoken over the same vocabulary (its ``.tiktoken`` ranks and word
    pattern). A text holding a run of 10,000 blanks or non-blanks is encoded by the library itself,
    in segments. ``tests/llm`` compares both on whole tables and on odd texts.
    """

    def __init__(self, path: str):
        import base64
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = {t["content"]: t["id"] for t in json.load(open(path, encoding="utf-8")).get("added_tokens", [])}
        ranks_path = re.sub(r"\.json$", ".tiktoken", path)
        self.fast = None  # without the ranks beside the file, the library encodes everything
        if os.path.exists(ranks_path):
            import public_tokenizers

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = added
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None

    def _fast(self, text: str) -> list[int]:
        if self.split is None:
            return self.fast.encode_ordinary(text)
        out: list[int] = []
        for i, part in enumerate(self.split.split(text)):
            if i % 2:
                out.append(self.added[part])
            elif part:
                out += self.fast.encode_ordinary(part)
        return out

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            if self.fast is None or _LONG_RUN.search(text):
                parts = [np.asarray(self.library.encode(p, add_special_tokens=False).ids, dtype=np.uint32) for p in segments(text)]
            else:
                parts = [np.asarray(self._fast(text), dtype=np.uint32)]
            yield np.concatenate([*parts, _END])


def encoded(tok: Encoder, texts: list[str]) -> Iterator[np.ndarray]:
    """Ids of each text, then END_ID, in order."""
    return tok(texts)


def _first_level(path: str, length: int, windows: int, final: bool):
    def pack(batches):
        tok = Encoder(path)
        part = TaskContext.get().partitionId()
        packer = Packer(length, windows, part << GROUP_BITS)
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            for doc_id, ids in zip(pdf["doc_id"].tolist(), encoded(tok, texts)):
                packer.add(None if pd.isna(doc_id) else int(doc_id), ids, 0, len(ids))
            if packer.out:
                yield _frame(packer.out, part)
                packer.out = []
        packer.close(final)
        if packer.out:
            yield _frame(packer.out, part)

    return pack


def _merge_level(level: int, length: int, windows: int, final: bool):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["grp"].iloc[0])
        packer = Packer(length, windows, (level << LEVEL_BITS) | (group << GROUP_BITS))
        for r in pdf.sort_values(["wkey", "pno"]).itertuples(index=False):
            ids = np.asarray(r.ids, dtype=np.uint32)
            packer.add(None if pd.isna(r.doc_id) else int(r.doc_id), ids, int(r.start), int(r.doc_tokens))
        packer.close(final)
        return _frame(packer.out, group)

    return pack


def pack(documents: DataFrame, tokenizer_path: str, length: int = LENGTH, windows: int = WINDOWS, fan: int = FAN) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents.

    Defined cases: null or empty text is one piece of one id; a null doc_id stays null;
    repeated rows are packed as often as they occur; documents longer than ``length`` are cut;
    an empty table gives no rows. Only ``doc_id`` and ``text`` are read, whatever else the table holds.
    Every sequence holds at most ``length`` ids and offsets run gapless from 0; all sequences are
    full but the last level's at most ``windows`` leftovers.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(1, docs.rdd.getNumPartitions())
    levels = max(0, math.ceil(math.log(parts, fan))) if parts > 1 else 0
    first = stage(docs.mapInPandas(_first_level(tokenizer_path, length, windows, levels == 0), PIECES), "onlinepack-0")
    done = [first.where(F.col("sequence_id").isNotNull())]
    left = first.where(F.col("sequence_id").isNull())
    for level in range(1, levels + 1):
        grouped = left.withColumn("grp", F.col("grp") / F.lit(fan)).withColumn("grp", F.floor("grp"))
        merged = grouped.groupBy("grp").applyInPandas(_merge_level(level, length, windows, level == levels), PIECES)
        merged = stage(merged, f"onlinepack-{level}")
        done.append(merged.where(F.col("sequence_id").isNotNull()))
        left = merged.where(F.col("sequence_id").isNull())
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
