import glob
from decimal import Decimal

import pytest

from ledgerline.operators.lineage import cut, shared_dir, stage
from ledgerline.sinks.delimited import publish_table, write_delimited
from ledgerline.sources.files import read_rules


@pytest.fixture
def report(spark):
    data = [("a;b", 'say "x"', None, Decimal("0.0000000000")), (" lead", "", "z", Decimal("12.5000000000"))]
    return spark.createDataFrame(data, "A string, B string, C string, D decimal(28,10)").repartition(2)


def test_raw_text_one_header_per_file(report, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(report, path)
    write_delimited(report, path)  # a second run replaces the first
    lines = [line for f in glob.glob(path + "/part-*") for line in open(f).read().splitlines()]
    assert {line for line in lines if line != "A;B;C;D"} == {'a;b;say "x";;0.0000000000', " lead;;z;12.5000000000"}
    assert len(lines) - lines.count("A;B;C;D") == 2


def test_quoting_round_trip(spark, report, tmp_path):
    path = str(tmp_path / "out")
    broken = spark.createDataFrame([('two\nlines; "q"', "b", "c", Decimal(1))], report.schema)
    write_delimited(report.union(broken), path, quoting=True, files=1)
    (part,) = glob.glob(path + "/part-*")
    assert open(part).read().count("A;B;C;D") == 1
    back = spark.read.csv(path, sep=";", header=True, escape="\\", multiLine=True)
    assert {(r["A"], r["B"]) for r in back.collect()} == {("a;b", 'say "x"'), (" lead", None), ('two\nlines; "q"', "b")}


def test_round_trip_as_rules(spark, tmp_path, rows):
    df = spark.createDataFrame([("1", ""), ("2", "x")], "A string, B string")
    write_delimited(df, str(tmp_path / "out"), files=2)
    assert rows(read_rules(spark, str(tmp_path / "out"), ["A", "B"])) == [("1", ""), ("2", "x")]


def test_publish_table(spark, rows):
    df = spark.createDataFrame([("1",)], "A string")
    publish_table(df, "published_report")
    publish_table(df, "published_report")
    assert rows(spark.table("published_report")) == [("1",)]
    spark.sql("drop table published_report")


def test_cut_and_stage(spark, rows):
    df = spark.range(5).selectExpr("id % 2 as a", "id as b").groupBy("a").sum("b")
    assert rows(cut(df)) == rows(stage(df, "test")) == rows(df)
    assert shared_dir(spark)
