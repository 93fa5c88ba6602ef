import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import measures, rollup
from ledgerline.operators.joins import lookup, measured_bytes
from ledgerline.operators.override import any_key_override, rule_hits
from ledgerline.operators.relabel import relabel
from ledgerline.operators.skew import hot_keys, salted_join, with_spread
from ledgerline.plans import tables


@pytest.fixture
def sides(spark):
    rnd = random.Random(1)
    # a third of the rows, and copies of one row, share one key; some keys are NULL
    left = [("hot", 0)] * 1000 + [(rnd.choice(["a", "b", "c", "miss", None]), i) for i in range(2000)]
    right = [("hot", "h1"), ("hot", "h2"), ("a", "x"), ("b", "y"), (None, "n")]
    return (
        spark.createDataFrame(left, "k string, v int"),
        spark.createDataFrame(right, "rk string, w string"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(sides, rows, how, null_safe):
    left, right = sides
    same = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    want = rows(left.join(right, same, how).drop("rk"))
    hot = hot_keys(left, {"k": ["k"]}, min_share=0.2)["k"]
    assert len(hot.hashes) >= 1 and hot.salts >= 2
    assert rows(salted_join(left, right, {"k": "rk"}, how, hot, null_safe)) == want
    got = salted_join(with_spread(left), right, {"k": "rk"}, how, hot, null_safe).drop("__spread")
    assert rows(got) == want


def test_hot_rows_spread_over_partitions(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = hot_keys(left, {"k": ["k"]}, min_share=0.2)["k"]
        joined = salted_join(with_spread(left), right, {"k": "rk"}, "inner", hot)
        parts = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
        assert parts > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_hot_keys_means_plain_join(spark):
    left = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert hot_keys(left, {"k": ["k"]})["k"].hashes == ()


def test_small_shares_are_split_among_many_partitions(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 2000 == 0, -1).when(F.col("id") % 100 == 1, -2).otherwise(F.col("id")).alias("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        hot = hot_keys(rows, {"k": ["k"]})["k"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    salts = {h: n for n, hashes in hot.levels for h in hashes}
    known = spark.createDataFrame([(-1,), (-2,)], "k long").select("k", F.xxhash64("k").alias("h")).collect()
    found = {r.k: salts[r.h] for r in known}
    assert found == {-1: 4, -2: 64} and len(salts) == 2


def test_key_types_must_agree(spark):
    with pytest.raises(TypeError):
        salted_join(spark.range(3), spark.createDataFrame([("1",)], "r string"), {"id": "r"})


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_lookup_both_strategies(sides, rows, limit):
    left, right = sides
    want = rows(left.join(right, F.col("k") == F.col("rk"), "left").drop("rk"))
    assert rows(lookup(left, right, {"k": "rk"}, limit=limit)) == want
    plan = lookup(left, right, {"k": "rk"}, limit=limit)._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit > 0)


def test_lookup_right_filter_keeps_unmatched(sides, rows):
    left, right = sides
    got = lookup(left, right, {"k": "rk"}, right_filter=F.col("w") == "h1")
    assert got.count() == left.count() and got.where("w is not null").count() == 1000


def test_lookup_unique(sides):
    left, right = sides
    with pytest.raises(ValueError, match="repeats"):
        lookup(left, right, {"k": "rk"}, unique=True)


def test_measured_bytes(spark):
    small = spark.createDataFrame([("abc",)], "a string")
    sizes = measured_bytes({"small": small, "none": small.where("false"), "two": small.union(small)})
    assert sizes["none"] == 0 and sizes["two"] == 2 * sizes["small"] > 0


def random_rules(spark, seed):
    rnd = random.Random(seed)
    pick = lambda p: rnd.choice([p + str(i) for i in range(6)] + ["", None])
    facts = [(i, pick("L"), pick("P"), pick("C")) for i in range(300)]
    rules = [(pick("L"), pick("P"), pick("C"), rnd.choice(["T1", "T2", None])) for _ in range(25)]
    rules += rules[:5]
    return (
        spark.createDataFrame(facts, "id int, l string, p string, c string"),
        spark.createDataFrame(rules, "rl string, rp string, rc string, target string"),
    )


@pytest.mark.parametrize("seed, limit", [(1, 1 << 20), (2, 1 << 20), (3, 0)])
def test_override_equals_or_join(spark, rows, seed, limit):
    facts, rules = random_rules(spark, seed)
    cond = F.col("l").isNotNull() & (
        (F.col("l") == F.col("rl")) | (F.col("p") == F.col("rp")) | (F.col("c") == F.col("rc"))
    )
    want = rows(facts.join(rules, cond, "left").drop("rl", "rp", "rc"))
    keys = {"l": "rl", "p": "rp", "c": "rc"}
    got = any_key_override(facts, rules, keys, ["target"], F.col("l").isNotNull(), limit=limit)
    assert rows(got) == want
    counted = any_key_override(facts, rules, keys, ["target"], F.col("l").isNotNull(), copies="n", limit=limit)
    assert counted.agg(F.sum("n")).first()[0] == len(want)
    assert "NestedLoop" not in counted._jdf.queryExecution().executedPlan().toString()


def test_relabel(spark, rows):
    lines = spark.createDataFrame([("p1", "L1", "one"), ("p2", "L1", "one"), ("p3", "L2", "two")], "p string, code string, label string")
    df = spark.createDataFrame([(1, "L1"), (2, "L9"), (3, None)], "id int, t string")
    fanned = relabel(df, lines, "t", "code", "label")
    assert rows(fanned, "id", "new_label") == sorted([(1, "one"), (1, "one"), (2, None), (3, None)], key=repr)
    assert rows(relabel(df, lines, "t", "code", "label", copies="n"), "id", "n") == [(1, 2), (2, 1), (3, 1)]
    assert rows(relabel(df, lines, "t", "code", "label", dedupe=True), "id") == [(1,), (2,), (3,)]


def test_signed_sum(spark, rows):
    df = spark.createDataFrame(
        [("a", "1.5", Decimal("2.25"), None), ("b", "1.5", Decimal("2.25"), "-1"), ("c", "n/a", Decimal("1"), "1"),
         ("d", "1", None, "1"), ("e", "1", Decimal("1"), ""), ("f", "2", Decimal("1"), "0.5")],
        "k string, x string, y decimal(10,2), s string",
    )
    got = dict(rows(measures.signed_sum(df, {"m": ["x", "y"]}, F.col("s")), "k", "m"))
    want = {"a": Decimal("3.75"), "b": Decimal("-3.75"), "c": None, "d": None, "e": None, "f": Decimal("1.5")}
    assert got == want


def test_signed_sum_is_exact(spark, rows):
    """Thirds, a factor of a million, nine decimals in text and a double column: nothing is cut or lost."""
    df = spark.createDataFrame(
        [("a", " 1.123456789", Decimal("2.25"), 0.1, "0.33333"), ("b", "2.000000001", Decimal("99999999.99"), 0.2, "1000000"),
         ("c", "3", Decimal("1"), 0.3, None), ("d", "4.5", Decimal("1"), 0.25, "-1")],
        "k string, x string, y decimal(10,2), z double, s string",
    )
    signs = df.select("s")
    sign_type = measures.exact_types(signs, ["s"])["s"]
    assert sign_type == "decimal(12,5)"
    out = measures.signed_sum(df, {"m": ["x", "y"], "w": ["y", "z"]}, F.col("s"), sign_type=sign_type)
    got = dict(rows(out, "k", "m"))
    assert got == {
        "a": (Decimal("1.123456789") + Decimal("2.25")) * Decimal("0.33333"),
        "b": (Decimal("2.000000001") + Decimal("99999999.99")) * 1_000_000,
        "c": Decimal("4"), "d": Decimal("-5.5"),
    }
    assert all(v is not None for v in got.values())
    assert out.schema["w"].dataType.simpleString() == "double"  # double input: the input's own arithmetic
    assert dict(rows(out, "k", "w"))["a"] == (2.25 + 0.1) * 0.33333
    derived = measures.signed_sum(df, {"m": ["x", "y"]}, F.col("s"))  # the factor's type found on the frame itself
    assert dict(rows(derived, "k", "m")) == got


def test_exact_types(spark):
    df = spark.createDataFrame([(" 007.50 ", 1, 2.0, Decimal("1.5"), "x")], "t string, i int, d double, m decimal(7,3), bad string")
    assert measures.exact_types(df, ["t", "i", "d", "m", "bad"]) == {
        "t": "decimal(2,1)", "i": "decimal(10,0)", "d": "double", "m": "decimal(7,3)", "bad": "decimal(1,0)"}


def test_group_sum_with_copies(spark, rows):
    df = spark.createDataFrame([("a", Decimal("1.50"), 3), ("a", None, 9), ("b", None, 2)], "k string, m decimal(10,2), n bigint")
    assert rows(rollup.group_sum(df, ["k"], ["m"], "n")) == [("a", Decimal("4.50")), ("b", None)]
    assert rows(rollup.group_sum(df, ["k"], ["m"])) == [("a", Decimal("1.50")), ("b", None)]


def test_spread_comes_from_file_positions(spark, tmp_path):
    """Salts are a hash of file and row index: the same on every evaluation; other frames are stored first."""
    path = str(tmp_path / "t")
    spark.range(1000).repartition(4).write.parquet(path)
    scan = spark.read.parquet(path)
    first = sorted(tuple(r) for r in with_spread(scan.where("id % 2 = 0")).collect())
    again = sorted(tuple(r) for r in with_spread(scan.where("id % 2 = 0")).collect())
    assert first == again and len({r[1] for r in first}) == len(first) == 500
    shuffled = with_spread(scan.repartition(7))  # a shuffle output has no file positions: it is stored and read back
    assert shuffled.count() == 1000 and shuffled.select("__spread").distinct().count() == 1000


def test_equal_sign_rules_are_counted(spark, rows):
    rules = [("A", "L", "-1")] * 3 + [("A", "L", "2"), ("A", "L", None), ("A", "L", None), (None, "L", "1")]
    found = tables.sign_factors(spark.createDataFrame(
        rules, "Conceito_Contabil string, Balanco_LDN_Nivel_3 string, Criterio_de_Sinais string"))
    want = [("A", "L", "-1", 3), ("A", "L", "2", 1), ("A", "L", None, 2), (None, "L", "1", 1)]
    assert rows(found) == sorted(want, key=repr)


@pytest.mark.parametrize("dtype", ["decimal(35,14)", "decimal(37,20)", "decimal(12,2)", "bigint"])
def test_exact_group_sum_equals_the_sum_of_repeated_rows(spark, dtype):
    rnd = random.Random(5)
    data = [(i % 3, str(rnd.randrange(-10**9, 10**9)) + ("" if dtype == "bigint" else ".12345678901234567"[:rnd.randrange(3, 17)]),
             rnd.randrange(1, 200)) for i in range(300)] + [(0, None, 7), (3, None, 2)]
    df = spark.createDataFrame(data, "k int, m string, n bigint").withColumn("m", F.expr(f"cast(m as {dtype})"))
    repeated = df.withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).groupBy("k").agg(F.sum("m").alias("m"))
    got = {r.k: r.m for r in rollup.exact_group_sum(df, ["k"], ["m"], "n").collect()}
    assert got == {r.k: r.m for r in repeated.collect()}


def test_rule_hits_take_repeated_combinations(spark, rows):
    rules = spark.createDataFrame([("a", None, 1), ("a", "x", 1), (None, "y", 2)], "rk string, rl string, v int")
    combos = spark.createDataFrame([("a", "x")] * 50 + [("b", "y")] * 3 + [("b", "z"), (None, None)], "k string, l string")
    found = rule_hits(combos, rules, {"k": "rk", "l": "rl"}, ["v"])
    assert rows(found.select("k", "l", "v", F.col("hits").cast("int"))) == [("a", "x", 1, 2), ("b", "y", 2, 1)]
