"""Whitening, divergence audit and online packing against brute force and round trips."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import divergence, onlinepack, queries, whitening

SF = "/root/testdata/sf0.001"


def _doc_rows():
    import pyarrow.parquet as pq

    return [type("R", (), {"text": t}) for t in pq.read_table(f"{SF}/documents.parquet", columns=["text"]).column("text").to_pylist()]


# ---- op11: whitening ---------------------------------------------------------------------------

def brute_whiten(rows, k=8):
    ids = [i for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    X = np.array([[float(c) for c in v] for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)])
    x = (np.floor(1024 * X) + 100000).astype(np.int64)
    n, S = len(x), x.sum(0)
    C = x - S / n
    V = C.T @ C / n
    e, vec = np.linalg.eigh(V)
    order = np.argsort(-e)
    e, vec = e[order][:k], vec[:, order][:, :k]
    dev = [sum(int(n * a - s) ** 2 for a, s in zip(row, S)) for row in x.tolist()]
    return ids, C @ vec / np.sqrt(e), e / np.trace(V), dev


@pytest.fixture(scope="module")
def embeddings(spark):
    base = queries.table(spark, SF, "embeddings").withColumn("component", F.lit(7)).withColumn("__x", F.lit("clash"))
    d = len(base.first().embedding)
    odd = [(None, [0.5] * d), (10**9, None), (10**9 + 1, [None] + [0.1] * (d - 1)), (10**9 + 2, [float("nan")] * d),
           (10**9 + 3, [float("inf")] + [0.0] * (d - 1)), (10**9 + 4, [0.25] * d), (10**9 + 4, [0.25] * d)]
    extra = spark.createDataFrame(odd, "vec_id long, embedding array<float>").withColumn("label", F.lit(0))
    return base.unionByName(extra.withColumn("component", F.lit(1)).withColumn("__x", F.lit("x")))


def test_whitening_matches_eigendecomposition(spark, embeddings):
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    ids, W, explained, dev = brute_whiten(rows)
    got = embeddings.transform(whitening.whiten).toPandas()
    assert set(got.columns) >= {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    assert len(got) == len(ids) * 8 and (got.n == len(ids)).all()
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] <= 1e-4
    for j in range(1, 9):
        part = got[got.component == j]
        mine = dict(zip(part.vec_id.astype(object).where(part.vec_id.notna(), None), part.whitened))
        ref = dict(zip(ids, W[:, j - 1]))  # rows with one id hold one vector here
        a, b = np.array([mine[i] for i in ref]), np.array(list(ref.values()))
        sign = 1.0 if np.dot(a, b) >= 0 else -1.0
        assert np.allclose(a, sign * b, atol=1e-8)
        assert abs(part.explained.iloc[0] - explained[j - 1]) <= 1e-4 * explained[j - 1]
    assert sorted(got[got.component == 1].deviation.tolist()) == sorted(dev)
    assert got.vec_id.isna().sum() == 8  # the null id keeps its rows


def test_whitening_edge_cases(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).count() == 0  # zero covariance
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], schema))
    rank1 = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 1.0]), (3, [1.0, 1.0, 1.0])], schema)).collect()
    assert {r.component for r in rank1} == {1} and len(rank1) == 3
    assert abs(sum(r.whitened ** 2 for r in rank1) / 3 - 1) < 1e-9


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(3)
    A = rng.standard_normal((30, 30))
    A = A + A.T
    B = rng.standard_normal((30, 4))
    x = whitening.minres(lambda V: A @ V, B, 200, 1e-14)
    assert np.allclose(A @ x, B, atol=1e-8)


def test_jacobi_davidson_finds_clustered_eigenvalues():
    rng = np.random.default_rng(5)
    Q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    values = np.concatenate([[10.0, 9.999, 9.998], np.linspace(5, 1, 37)])
    A = Q @ np.diag(values) @ Q.T
    e, v = whitening.leading(lambda U: A @ U, 40, 5)
    assert np.allclose(e, values[:5], rtol=1e-12)
    assert np.allclose(np.abs(v.T @ Q[:, :5]), np.eye(5), atol=1e-6)


# ---- op12: divergence audit --------------------------------------------------------------------

def brute_audit(rows, min_df, top=50):
    rx = re.compile(divergence.TERMS)
    low = str.maketrans(divergence.UPPER, divergence.LOWER)
    docs = [((t or "").translate(low), lang or "", s or "") for t, lang, s in rows]
    tokens = [rx.findall(t) for t, _, _ in docs]
    df = defaultdict(Counter)
    for (_, lang, _), tk in zip(docs, tokens):
        df[lang].update(set(tk))
    vocab = {lang: {w for w, c in cs.items() if c >= min_df} for lang, cs in df.items()}
    gc, groups = defaultdict(Counter), set()
    for (_, lang, s), tk in zip(docs, tokens):
        groups.add((lang, s))
        gc[(lang, s)].update(w for w in tk if w in vocab.get(lang, ()))

    def p(c, total, v):
        return 1 + (10**9 * (c + 5)) // (total + 5 * v)

    out, by_lang = [], defaultdict(list)
    for lang, s in groups:
        by_lang[lang].append(s)
    for lang, sources in by_lang.items():
        v = len(vocab.get(lang, ()))
        lc = Counter()
        for s in sources:
            lc.update(gc[(lang, s)])
        tl = sum(lc.values())
        for s in sources:
            total = sum(gc[(lang, s)].values())
            pairs = []
            for o in sources:
                if o != s:
                    t2 = sum(gc[(lang, o)].values())
                    pairs.append((o, sum(abs(p(gc[(lang, s)][w], total, v) - p(gc[(lang, o)][w], t2, v)) for w in vocab.get(lang, ()))))
            pairs.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, s, "pair", i, val, k + 1) for k, (i, val) in enumerate(pairs)]
            terms = [(w, p(c, total, v) - p(lc[w], tl, v)) for w, c in gc[(lang, s)].items() if p(c, total, v) > p(lc[w], tl, v)]
            terms.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, s, "term", i, val, k + 1) for k, (i, val) in enumerate(terms[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def audit_docs(spark):
    base = queries.table(spark, SF, "documents").select("text", "lang", "source", F.lit("x").alias("part"), F.lit(1).alias("rank"))
    odd = [(None, None, None), ("ÄBC Abc abc ÀBC", "en", None), ("", "en", "s"), ("Abc abc " * 5000, "en", "s"), ("same", "de", "s2"),
           ("same", "de", "s2")]
    return base.unionByName(spark.createDataFrame(odd, "text string, lang string, source string")
                            .withColumn("part", F.lit("y")).withColumn("rank", F.lit(2)))


@pytest.mark.parametrize("min_df", [1, 3, 30])
def test_audit_matches_brute_force(spark, audit_docs, min_df):
    rows = [(r.text, r.lang, r.source) for r in audit_docs.collect()]
    got = sorted(tuple(r) for r in divergence.audit(audit_docs, min_df=min_df).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == brute_audit(rows, min_df)


def test_terms_and_counts_by_digit():
    import pyarrow as pa

    odd = "".join(map(chr, range(0x180))) + "\u2028a\u00a0b\u0130\u0085c \U0001f600D"
    low = str.maketrans(divergence.UPPER, divergence.LOWER)
    assert [w.decode() for w in divergence.terms(odd.encode())] == re.findall(divergence.TERMS, odd.translate(low))
    rows = [("b a A a, c", "de", "s"), ("a" + " a" * 8, "de", "s"), ("a", "en", "s"), ("", "en", "t")]
    batches = [pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows[k : k + 2])], ["__text", "__lang", "__source"]) for k in (0, 2)]
    found, seen = Counter(), set()
    for b in divergence._counted(batches):
        for r in b.to_pylist():
            assert len(set(r["__terms"])) == len(r["__terms"])  # the vectors hold ones, however often a word occurs
            seen.add((r["__lang"], r["__source"]))
            found.update({(r["__lang"], r["__source"], w): r["__digit"] for w in r["__terms"]})
    assert found == {("de", "s", "de\0a"): 12, ("de", "s", "de\0b"): 1, ("de", "s", "de\0c"): 1, ("en", "s", "en\0a"): 1}
    assert seen == {("de", "s"), ("en", "s"), ("en", "t")}


def test_audit_hands_on_terms_up_to_min_df():
    """Terms of many documents go to the estimator ``min_df`` times at most, rarer ones once a document that holds them."""
    import pyarrow as pa

    rows = [("same b b" if k < 3 else "same", "de", "s") for k in range(50)] + [("same", "en", "t"), ("", "fr", "t")]
    batches = [pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows[k : k + 20])], ["__text", "__lang", "__source"]) for k in (0, 20, 40)]
    for min_df, want in ((1, {"de\0same": 1, "de\0b": 1, "en\0same": 1}), (5, {"de\0same": 5, "de\0b": 3, "en\0same": 1})):
        handed = [r["__terms"] for b in divergence._frequent(batches, min_df) for r in b.to_pylist()]
        assert all(len(set(r)) == len(r) for r in handed)
        assert Counter(w for r in handed for w in r) == want


def test_audit_edge_cases(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    no_terms = divergence.audit(spark.createDataFrame([("12 34", "en", "a"), (None, "en", "b")], schema)).collect()
    assert sorted((r.source, r.item, r.value) for r in no_terms) == [("a", "b", 0), ("b", "a", 0)]


# ---- op13: online packing ----------------------------------------------------------------------

def test_online_packing_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    spark.sparkContext.setCheckpointDir(str(tmp_path))
    path = queries.tokenizer_path()
    base = queries.table(spark, SF, "documents").select("doc_id", "text", F.lit(3).alias("offset"))
    odd = [(None, "null id"), (7_000_001, None), (7_000_002, ""), (7_000_003, " " * 50_000), (7_000_004, "a<|endoftext|>b"),
           (7_000_005, "twice"), (7_000_005, "twice")]
    docs = base.unionByName(spark.createDataFrame(odd, "doc_id long, text string").withColumn("offset", F.lit(4))).repartition(9)
    got = onlinepack.pack(docs, path, length=1024, windows=3, fan=2).toPandas()
    tok = Tokenizer.from_file(path)
    expected = Counter()
    for r in docs.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        expected[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    seen = Counter()
    for (doc_id, total), g in got.groupby([got.doc_id.fillna(-1), "doc_tokens"]):
        assert g.length.sum() % total == 0
    # every id lies in exactly one piece: rebuild each document's checksum from its pieces in order
    for r in docs.select("doc_id", "text").distinct().collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        mine = got[(got.doc_id == r.doc_id) if r.doc_id is not None else got.doc_id.isna()]
        for start, g in mine.groupby("start"):
            for crc in g.ids_crc32:
                assert crc == zlib.crc32(ids[start:start + int(g.length.iloc[0])].tobytes())
        seen[(r.doc_id, len(ids))] = int(mine.length.sum())
    for (doc_id, n, _), times in expected.items():
        assert seen[(doc_id, n)] == n * times
    assert got.loc[got.doc_id == 7_000_004, "doc_tokens"].iloc[0] == 4  # the special string is one id, then the end id
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.length.sum() <= 1024
        assert (g.offset.to_numpy() == np.concatenate([[0], np.cumsum(g.length.to_numpy())[:-1]])).all()
    full = got.groupby("sequence_id").length.sum()
    assert (full < 1024).sum() <= 3


def test_online_packing_empty(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert onlinepack.pack(spark.createDataFrame([], "doc_id long, text string"), queries.tokenizer_path()).count() == 0


def test_packer_best_fit_and_cut():
    p = onlinepack.Packer(10, 2, 0)
    for doc, n in [(1, 6), (2, 3), (3, 5), (4, 1), (5, 7)]:
        p.add(doc, np.arange(n, dtype=np.uint32), 0, n)
    # 6 and 3 share a window, 5 opens the second, 1 fills the first (best fit: gap 1) and it is emitted; 7 opens a new one
    assert [r[:4] + r[5:7] for r in p.out] == [(1, 0, 6, onlinepack.crc(np.arange(6)), 0, 0), (2, 0, 3, onlinepack.crc(np.arange(3)), 0, 6),
                                               (4, 0, 1, onlinepack.crc(np.arange(1)), 0, 9)]
    p.close(final=True)
    assert [(r[0], r[5], r[6]) for r in p.out[3:]] == [(5, 1, 0), (3, 2, 0)]  # fullest first
    q = onlinepack.Packer(10, 1, 0)
    for doc, n in [(1, 6), (2, 7)]:
        q.add(doc, np.arange(n, dtype=np.uint32), 0, n)
    q.close(final=False)
    # 7 fits nowhere and no window is free: the fullest takes a cut of 4 and goes; the rest is left over with its ids
    assert [(r[0], r[1], r[2], r[5], r[6]) for r in q.out] == [(1, 0, 6, 0, 0), (2, 0, 4, 0, 6), (2, 4, 3, None, None)]
    assert list(q.out[-1][9]) == [4, 5, 6]


def test_fast_and_segmented_encoding_equal_the_library(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    texts = ["", "word " * 500, "a  b\n\n c " * 100, "z" * 5000, "a<|endoftext|>b " * 40, "<|endoftext|>", "short",
             " " * 20_000, "\r\n\t é ü 中文 🙂 's 've'll", *[r.text or "" for r in _doc_rows()]]
    want = [np.array(library.encode(t, add_special_tokens=False).ids + [0], dtype=np.uint32) for t in texts]
    fast = onlinepack.Encoder(queries.tokenizer_path())
    assert all(np.array_equal(g, w) for g, w in zip(onlinepack.encoded(fast, texts), want))
    # the library's path, in small segments: every text with a run of 50 goes there
    monkeypatch.setattr(onlinepack, "SEGMENT", 64)
    monkeypatch.setattr(onlinepack, "_LONG_RUN", re.compile(r"\S{50}|\s{50}|word"))
    assert all(np.array_equal(g, w) for g, w in zip(onlinepack.encoded(fast, texts), want))
    assert len(onlinepack.segments("word " * 500, 64)) > 1 and onlinepack.segments("z" * 5000, 64) == ["z" * 5000]
