"""Operators for language model data against brute force, round trips and held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import (
    decontaminate, langid, linededup, packing, pii, quality, queries, simhash, suffixdedup, toolcalls, vectorfile,
)
from ledgerline.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = [
    (None, "x" * 120, "de", "s", 1, "a"), (900_001, None, None, None, None, "b"), (900_002, "", "en", "s", 0, "c"),
    (900_003, "aé " * 30_000, "en", "s", 3, "d"), (900_004, "same " * 30, "en", "s", 3, "e"), (900_005, "same " * 30, "en", "s", 3, "f"),
    (900_005, "same " * 30, "en", "s", 3, "f"), (900_006, "+1 (988) 555-2485 x@y.zz 1.2.3.4", "en", "s", 3, "g"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with odd rows and a column whose name operators use inside."""
    base = queries.table(spark, SF, "documents").withColumn("key", F.lit("k"))
    extra = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, key string")
    return base.unionByName(extra)


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(None, 3)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    real = [e for e in links if None not in e and e[0] != e[1]]
    assert got == brute_components({n for e in real for n in e}, real)


def test_decontamination(spark, docs):
    bench = queries.table(spark, SF, "benchmark")
    items = [r for r in bench.collect() if len(decontaminate.words(r.text)) >= decontaminate.SHORTEST]
    rng = random.Random(5)
    changed = []
    for k, r in enumerate(items[:20]):
        w = [x if rng.random() > 0.1 else "other" for x in r.text.split()]
        changed.append((950_000 + k, "before it " * 40 + " ".join(w) + " and after " * 40))
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(changed, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(rows, bench).collect()}
    exact = {(r.doc_id, i.item_id) for r in rows.collect() for i in items if i.text in (r.text or "")}
    assert exact <= got
    hit = sum((950_000 + k, r.item_id) in got for k, r in enumerate(items[:20]))
    assert hit >= 18 and len(got) <= len(exact) + 2 * len(items)
    assert decontaminate.find(rows.limit(0), bench).count() == 0 == decontaminate.find(rows, bench.limit(0)).count()


def test_answers_count(spark):
    text = "which of the many rivers here runs into the northern sea"
    bench = spark.createDataFrame([(1, text, "Elbe"), (2, text, None), (None, text, "")], "item_id long, text string, answer string")
    rows = spark.createDataFrame([(1, text + " the Elbe"), (2, text)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(rows, bench).collect()}
    assert got == {(1, 1), (1, 2), (2, 2)}


@pytest.mark.parametrize("holders", [20, 200])
def test_items_in_many_documents_are_found(spark, holders):
    """An item copied into a tenth or all of the documents makes its words common and is found nevertheless."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(900)]
    items = [" ".join(rng.sample(words[:60], 20))] + [" ".join(rng.sample(words[60:], 20)) for _ in range(30)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    prose = [" ".join(rng.choices(words[60:], k=60)) for _ in range(400)]
    rows = [(i, f"{prose[2 * i]} {items[0] if i < holders else ''} {prose[2 * i + 1]}") for i in range(200)]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in decontaminate.find(rows, bench).where("item_id = 0").collect()}
    assert got == set(range(holders))


def test_no_overlap_of_an_item_is_without_weight():
    items = [decontaminate.Item(1, (0, 1, 2, 3, 4), frozenset()), decontaminate.Item(2, (5, 6, 7, 8, 9), frozenset())]
    block = decontaminate.Block({b"%d" % k: k for k in range(10)}, items)
    n = np.array([90, 80, 70, 60, 50, 1, 2, 3, 90, 90])
    weight = decontaminate.weights(block, n, 100)
    assert (weight > 0).tolist() == [False, False, True, True, True, True, True, True, False, False, False]
    assert np.array_equal(weight[5:], decontaminate.idf(n, 100)[5:])


def test_passages_read_used_words_only():
    rng = np.random.default_rng(3)
    used = rng.random(41) < 0.2
    used[40] = False
    table = np.where(used[:, None], rng.integers(-9, 9, (41, 4)), 0).astype(np.float32)
    unread = np.where(used[:, None], table, np.nan).astype(np.float32)  # a gather of every word would bring these in
    for n in (1, decontaminate.STEP, decontaminate.STEP + 1, 500):
        numbers = rng.integers(0, 41, n)
        starts = range(0, n, decontaminate.STEP)
        want = [table[numbers[s : s + 2 * decontaminate.STEP]].sum(0) for s in starts]
        assert np.array_equal(decontaminate.passages(numbers, unread, used), np.array(want))
    assert not decontaminate.passages(np.full(60, 40), unread, used).any()


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(60):
        parts = [[rng.randint(1, rng.choice([2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0] for _ in range(rng.randint(1, 8))]
        ends = np.cumsum([len(p) for p in parts])
        got, at = suffixdedup.suffix_arrays(np.array(sum(parts, [])), ends), 0
        for p, e in zip(parts, ends):
            assert (got[at:e] - at).tolist() == sorted(range(len(p)), key=lambda i: p[i:])
            at = e


def brute_removed(texts):
    least, out = {}, []
    rows = [(i, t.encode()) for i, t in texts]
    for i, b in rows:
        if i is not None:
            for p in range(len(b) - 49):
                w = b[p : p + 50]
                if least.get(w, i + 1) > i:
                    least[w] = i
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - 49 if i is not None else 0):
            if least[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("crowd", [suffixdedup.CROWD, 1])
def test_suffix_dedup(docs, texts, monkeypatch, crowd):
    monkeypatch.setattr(suffixdedup, "CROWD", crowd)
    got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.remove_repeats(docs).drop("kept").collect()]
    assert sorted(got) == brute_removed(texts)


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def allowed(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_pii_base(spark, docs):
    more = ["a@b.c.d@x.y a@b@c.de .@x.y", "1.2.3.4.5.6.7.8 999.1.1.1 001.02.3.255", "4337 1665 9846 4399 4337166598464399-é", "+49 (0) 123456789012 +1"]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(more, 960_000)), "doc_id long, text string"))
    got = sorted(repr((r.doc_id, [tuple(s) for s in r.base])) for r in pii.find(rows).collect())
    want = []
    for r in rows.collect():
        spans = [(m.start(), k, m.end()) for k, kind in enumerate(RULES) for m in re.finditer(RULES[kind], r.text or "") if allowed(kind, m[0])]
        want.append(repr((r.doc_id, sorted(spans))))
    assert got == sorted(want)


def test_pii_query_counts(spark, tmp_path):
    rows = [(1, "a@b.cc d@e.ff g@h.ii"), (2, "4111 1111 1111 1111, +1 (988) 555-2485, +1 (988) 555-2486"), (3, "1.2.3.4 and 5.6.7.8"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op3_pii(spark, str(tmp_path)).select("doc_id", *[f"n_{k}" for k in pii.KINDS]).collect()
    assert sorted(map(tuple, found)) == [(1, 3, 0, 0, 0), (2, 0, 0, 1, 2), (3, 0, 2, 0, 0), (4, 0, 0, 0, 0)]


def test_pii_learns_contexts(spark):
    rows = [(i, f"word before telephone: +1 (988) 555-{2000 + i} thanks and more") for i in range(30)]
    rows += [(100, "please telephone: 988-555-7777 thanks"), (101, "the sum of 1234567 things")]
    found = {r.doc_id: [tuple(s) for s in r.added] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100] == [(18, 3, 30)] and not any(v for k, v in found.items() if k != 100)


SCHEMA = {"get": {"type": "object", "required": ["q"], "additionalProperties": False,
                  "properties": {"q": {"type": "string", "minLength": 1}, "n": {"type": "integer", "maximum": 5}}}}


@pytest.mark.parametrize("group", [10_000, 0])
def test_tool_calls(spark, group):
    calls = [(1, 0, "a", "get", '{"q":"x","n":3}'), (1, 0, "a", "get", '{"q":"x","n":3}'), (1, 2, "b", "get", '{"q":{"$ref":"a"}}'),
             (1, 2, "c", "get", '{"n":9}'), (1, 4, "d", "zip", '{"x":[{"$ref":"b"},{"$ref":"zz"}]}'), (2, 0, "p", "get", '{"q":{"$ref":"r"}}'),
             (2, 0, "r", "get", '{"q":{"$ref":"p"}}'), (None, 0, "p", "get", None)]
    results = [(1, 1, "a", "one"), (1, 3, "a", "two"), (1, 1, "b", "early"), (2, 9, "p", None), (5, 1, "x", "y")]
    out = toolcalls.link(spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string"),
                         spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"), SCHEMA, group)
    got = {(r.conv_id, r.call_id): (r.valid, r.level, r.position, r.status, r.result) for r in out.collect()}
    assert got == {
        (1, "a"): (True, 0, 0, "linked", "one"), (1, "c"): (False, 0, 1, "unanswered", None), (1, "b"): (True, 1, 2, "early", "early"),
        (1, "d"): (False, 2, 3, "unanswered", None), (2, "p"): (False, None, None, "linked", ""), (2, "r"): (False, None, None, "unanswered", None),
        (None, "p"): (False, 0, 0, "unnamed", None),
    }
    assert toolcalls.canonical({"b": 1.0, "a": ["é", None, True]}) == '{"a":["é",null,true],"b":1}'


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_path())
    own.encode_special_tokens = True
    want = []
    for i, t in texts:
        ids = np.array([*own.encode(t, add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [repr((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    rows = packing.pack_documents(docs, queries.tokenizer_path()).collect()
    assert sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= sum(r.length for r in rows) / 2048 * 1.05 + 2


def test_every_capacity_holds():
    lengths = np.random.default_rng(1).integers(1, 100, 400)
    for score in ("norm", "dot"):
        cap = packing.Capacity(tokens=128, documents=3, attention=9000, score=score)
        bins, offsets = packing.best_fit(np.minimum(lengths, 94), cap)
        for b in np.unique(bins):
            own = np.minimum(lengths, 94)[bins == b]
            assert own.sum() <= 128 and len(own) <= 3 and (own**2).sum() <= 9000
    with pytest.raises(ValueError):
        packing.best_fit(np.array([200]), cap)


def test_quality(spark):
    base, labels = queries.table(spark, "/root/testdata/sf0.01", "documents"), queries.table(spark, "/root/testdata/sf0.01", "labels")
    model = quality.fit(base, labels.where(~quality.held_out()))
    rows = quality.classify(base, model).where(quality.held_out()).join(labels, "doc_id").select("predicted", "quality").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert 0 <= model.score(None) <= 1
    assert quality.fit(base, labels.limit(0)).score("x") == 0.5


def test_line_dedup(docs):
    rows = [r for r in linededup.lines(docs).select("hash", "line").distinct().collect() if r.hash is not None]
    sets = [(r.hash, {r.line[i : i + 5] for i in range(len(r.line) - 4)} or {r.line}) for r in rows]
    want = {(min(a, b), max(a, b)) for k, (a, s) in enumerate(sets) for b, t in sets[:k] if len(s & t) >= 0.8 * len(s | t)}
    got = {(r.a, r.b) for r in linededup.similar_lines(docs).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)
    crowded = {(r.a, r.b) for r in linededup.similar_lines(docs, band=2).collect()}
    assert crowded <= want and len(crowded) >= 0.8 * len(want)
    decided = linededup.decide(docs).where("component is not null").collect()
    assert len({r.component for r in decided}) == sum(r.keep for r in decided)
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


@pytest.mark.parametrize("band", [linededup.BAND, 2])
def test_line_dedup_short_lines_and_few_words(spark, band):
    """Similar lines meet that are shorter than a long shingle, have no blank, or repeat themselves."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    own = ["abcdefghijklmn", "abcdefghijklmno", "=" * 9, "=" * 12, "=" * 50, "-+" * 30, "+-" * 30, "abcd", "abce"]
    for n in (9, 14, 18, 24, 31, 33, 45, 80, 120):
        for k in range(4):
            w = word(n)
            own += [w, word(1) + w[1:], w[:-1] + word(1), w + word(1), word(1) + w]
            w = " ".join(word(6) for _ in range(n // 7 + 1))
            own += [w, word(1) + w[1:], w[:-1] + word(1)]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(own)], "doc_id long, text string")
    rows = [(r.hash, r.line) for r in linededup.lines(docs).select("hash", "line").distinct().collect()]
    sets = [(h, {line[i : i + 5] for i in range(len(line) - 4)} or {line}) for h, line in rows]
    want = {(min(a, b), max(a, b)) for k, (a, s) in enumerate(sets) for b, t in sets[:k] if len(s & t) >= 0.8 * len(s | t)}
    assert {(r.a, r.b) for r in linededup.similar_lines(docs, band=band).collect()} == want


@pytest.mark.parametrize("tile", [linededup.TILE, 7])
def test_line_dedup_crowded_bands(spark, tile):
    """All pairs of a crowded band are compared: templates share bands, and only some of their lines are similar."""
    words = [f"{chr(97 + k % 26)}{k * 7919 % 1000:03d}" for k in range(400)]
    rows = []
    for i in range(90):  # one long common head; the tails fall into 30 groups of three that lie far apart in any order
        tail = [words[(i % 30 * 13 + k) % 400] for k in range(24)]
        tail[i // 30] = f"slot{i:03d}"
        rows.append((i, "the same opening words of every line here " + " ".join(tail)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = {r.hash: r.line for r in linededup.lines(docs).collect()}
    sets = [(h, {x[i : i + 5] for i in range(len(x) - 4)}) for h, x in lines.items()]
    share = {h: set(r) for h, r in linededup.lines(docs).select("hash", linededup.signature(F.col("line"))).collect()}
    want = {(min(a, b), max(a, b)) for k, (a, s) in enumerate(sets) for b, t in sets[:k]
            if share[a] & share[b] and len(s & t) >= 0.8 * len(s | t)}
    got = linededup.similar_lines(docs, band=2, tile=tile).collect()
    assert want and sorted(tuple(r) for r in got) == sorted(want)


def test_benchmark_word_numbers():
    """All words keep their place, others the vocabulary's size; the different ones are benchmark words alone."""
    block = decontaminate.Block({b"one": 0, "zwölf".encode(): 1, b"x": 2}, [])
    assert block.numbers("One two, ZWÖLF x x").tolist() == [0, 3, 1, 2, 2] and block.numbers("").tolist() == []
    assert sorted(block.distinct("x two X zwölf two").tolist()) == [1, 2] and block.distinct("two").tolist() == []
    used = np.array([True, False, True, False])
    table = np.array([[1.0], [0.0], [2.0], [0.0]], np.float32)
    numbers = np.array([0] * decontaminate.STEP + [3] * decontaminate.STEP + [1, 2, 0])
    step = decontaminate.STEP
    assert decontaminate.passages(numbers, table, used).ravel().tolist() == [step, 3, 3]
    assert decontaminate.passages(numbers[-3:-2], table, used).ravel().tolist() == [0]


def test_line_dedup_near_copies_have_an_edge_each(spark):
    """Near copies are all linked to each other, yet components see about one edge a line and each link is met once."""
    base = " ".join(f"word{k * 7919 % 1000:03d}" for k in range(60))
    docs = spark.createDataFrame([(i, f"{base} copy{i:03d}") for i in range(100)], "doc_id long, text string")
    links = linededup.linked(docs)
    pairs = [tuple(r) for r in links.select(F.explode("near").alias("a"), "b").collect()]
    assert len(pairs) == len(set(pairs)) == 100 * 99 // 2 and all(a < b for a, b in pairs)
    assert linededup.stars(links).count() == 99
    rows = linededup.decide(docs).collect()
    assert {r.component for r in rows} == {min(a for a, _ in pairs)} and {r.n_links for r in rows} == {99}
    assert [r.doc_id for r in rows if r.keep] == [0]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 1])
def test_simhash(docs, texts, bucket):
    rows = simhash.near_duplicates(docs, bucket=bucket).collect()
    prints = {i: simhash.fingerprint(t.encode()) for i, t in texts if i is not None}
    ids = list(prints)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = brute_components(ids, linked)
    assert len(rows) == len(texts)
    for r in rows:
        if r.doc_id is not None:
            assert (int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], want[r.doc_id])


def test_language_id(spark, docs):
    base = queries.table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.fit(base.where(~langid.held_out()))
    rows = langid.identify(base, model).where(langid.held_out()).collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97
    odd = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert odd[900_001].lang_pred == odd[900_002].lang_pred == "und" and odd[900_003].score <= 1
    none = langid.fit(base.limit(0))
    assert none.predict("some text") == ("und", 0.0)


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.1, 16).tolist()) for i in range(400)] + [(400, [0.1] * 16), (401, [0.1] * 16), (402, None), (450, [float("nan")] * 16), (350, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows if v and None not in v and not np.isnan(v).any()]
    want = set()
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-int(x @ v), i) for i, x in good if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    for bits, block in ((6, 4096), (2, 3)):
        got = vectorfile.top_k(df, F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding", bits=bits, block=block)
        assert {tuple(r) for r in got.collect()} == want
    assert vectorfile.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding").count() == 0


def test_empty_tables(docs):
    none = docs.limit(0)
    assert suffixdedup.remove_repeats(none).count() == pii.find(none).count() == simhash.near_duplicates(none).count() == 0
    assert linededup.dedup_lines(none).count() == packing.pack_documents(none, queries.tokenizer_path()).count() == 0


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())
    bench = [r.text for r in queries.table(spark, SF, "benchmark").collect() if len(decontaminate.words(r.text)) >= 5]
    kept = {r.doc_id for r in rows}
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    assert not [d for d in kept if any(b in texts[d] for b in bench)]
    assert len(kept) >= 0.7 * len(set(texts.values()))
