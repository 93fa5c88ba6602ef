import random

from pyspark.sql import functions as F

from ledgerline import layouts
from ledgerline.operators import hierarchy


def resolve(spark, edges, **kw):
    df = spark.createDataFrame(edges, "child string, parent string, descr string").distinct()
    return hierarchy.nearest_ancestor(df, **kw)


def climb_by_hand(edges, cap=15):
    """Brute force: every path, one step at a time, as a bag."""
    edges = sorted(set(edges))
    marked = lambda d: "BP -" in d or ("BP –" in d and "TBP" not in d)
    by_child, out = {}, {}
    for e in edges:
        by_child.setdefault(e[0], []).append(e)

    def add(child, line, label, n):
        if line != "FORABP" or child:
            out[child, line, label] = out.get((child, line, label), 0) + n

    for child, parent, descr in edges:
        if marked(descr):
            add(child, child, descr, 1)
            continue
        pending = {parent: 1}
        for _ in range(cap):
            after = {}
            for key, n in pending.items():
                if key not in by_child:
                    add(child, "FORABP", "FORABP", n)
                for c, p, d in by_child.get(key, []):
                    if marked(d):
                        add(child, c, d, n)
                    else:
                        after[p] = after.get(p, 0) + n
            pending = after
        for n in pending.values():
            add(child, "FORABP", "FORABP", n)
    return sorted((k + (n,) for k, n in out.items()), key=repr)


def test_marked_orphan_cycle_blank_and_two_parents(spark, rows):
    edges = [
        ("m", "r", "BP - line"), ("a", "m", "x"), ("b", "a", "x"), ("orphan", "gone", "x"),
        ("c1", "c2", "x"), ("c2", "c1", "x"), ("", "gone", "x"), ("t", "r", "TBP - t"), ("u", "t", "x"),
        ("d", "r", "BP – dash"), ("e", "d", "x"), ("f", "r", "TBP BP – no"), ("two", "m", "x"), ("two", "e", "x"),
        ("over", "two", "x"),
    ]
    assert rows(resolve(spark, edges)) == climb_by_hand(edges)


def test_depth_cap_15_and_16(spark, rows):
    edges = [("n0", "top", "BP - root")] + [(f"n{i}", f"n{i - 1}", "x") for i in range(1, 20)]
    got = {r[0]: r[1] for r in rows(resolve(spark, edges))}
    assert got["n15"] == "n0" and got["n16"] == "FORABP"
    assert rows(resolve(spark, edges)) == climb_by_hand(edges)


def test_other_caps(spark, rows):
    edges = [("n0", "top", "BP - root")] + [(f"n{i}", f"n{i - 1}", "x") for i in range(1, 9)]
    for cap in (1, 4, 6):
        assert rows(resolve(spark, edges, max_climb=cap)) == climb_by_hand(edges, cap)


def test_random_graphs_with_many_paths(spark, rows):
    rnd = random.Random(3)
    edges = []
    for i in range(120):
        for _ in range(rnd.choice([1, 1, 1, 2, 3])):
            descr = rnd.choice(["x"] * 6 + ["BP - l", "TBP", "BP – l"])
            edges.append((f"n{i}", f"n{rnd.randrange(150)}", descr))
    assert rows(resolve(spark, edges)) == climb_by_hand(edges)


def test_hot_parent(spark, rows):
    edges = [("hub", "r", "BP - hub")] + [(f"n{i}", "hub", "x") for i in range(3000)]
    got = rows(resolve(spark, edges))
    assert len(got) == 3001 and all(r[1] == "hub" for r in got)


def test_repeat(spark, rows):
    df = spark.createDataFrame([("a", 2), ("b", 1)], "k string, copies bigint")
    assert rows(hierarchy.repeat(df)) == [("a",), ("a",), ("b",)]


def labelled(spark, code, codes, descs):
    df = spark.createDataFrame([(code, codes, descs)], "c string, cs array<string>, ds array<string>")
    return df.select(hierarchy.first_label(F.col("c"), F.col("cs"), F.col("ds"))).first()[0]


def test_first_label(spark):
    codes = ["L0", "L1", "L2"]
    assert labelled(spark, "L1", codes, ["BP - deep", "none", "Z BP - top"]) == "BP - top"
    assert labelled(spark, "L0", codes, ["TBP - skip", "A BP – dash", "BP - top"]) == "BP – dash"
    assert labelled(spark, "L0", codes, ["BP – a BP - b", "", ""]) == "BP - b"
    assert labelled(spark, "no", codes, ["BP - x", "", ""]) == ""
    assert labelled(spark, "L2", codes, ["BP - x", "BP - y", "nothing"]) == ""


def test_code_before_keyword(spark):
    def before(descs):
        df = spark.createDataFrame([("own", ["c0", "c1", "c2"], descs)], "c string, cs array<string>, ds array<string>")
        return df.select(hierarchy.code_before_keyword(F.col("c"), F.col("cs"), F.col("ds"))).first()[0]

    assert before(["", "CARTEIRA", "CARTEIRA"]) == "c0"
    assert before(["", "", "A CARTEIRA B"]) == "c1"
    assert before(["CARTEIRA", "", ""]) == "own"


def test_parent_at_level(spark, rows):
    df = spark.createDataFrame(
        [("d", ["a", "b", "c", "d"]), ("b", ["a", "b", "c", "d"]), ("z", ["a", "b", "c", "d"])], "c string, cs array<string>"
    )
    got = rows(df.select("c", hierarchy.parent_at_level(F.col("c"), F.col("cs"))))
    assert got == [("b", "GER19999"), ("d", "c"), ("z", "")]


def test_edges_cut_descriptions(spark, rows):
    df = spark.createDataFrame([("a", "p", "xx BP - y"), ("b", "p", "x TBP BP"), ("c", "p", "none")], "c string, p string, d string")
    got = rows(df.select(*hierarchy.edges(F.col("c"), F.col("p"), F.col("d"))), "child", "descr")
    assert got == [("a", "BP - y"), ("b", "x TBP BP"), ("c", "none")]


def test_a_ladder_of_diamonds_has_many_paths(spark):
    """Twenty parents a step for fifteen steps: more paths than a bigint holds."""
    rows = [(f"n{i}_{k}", f"n{i + 1}_{m}", "x") for i in range(15) for k in range(20) for m in range(20)]
    rows += [(f"n15_{k}", None, layouts.LINE_MARKERS[0]) for k in range(20)]
    nodes = spark.createDataFrame(rows, "child string, parent string, descr string")
    got = hierarchy.nearest_ancestor(nodes).where("child = 'n0_0'").collect()
    assert len(got) == 20 and {int(r.copies) for r in got} == {20**14}
