import gzip

import pytest

from ledgerline import layouts
from ledgerline.sources import fixedwidth
from pyspark.sql import functions as F

from ledgerline.sources.files import read_lines, read_rules, read_snapshot


def lines_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_latin1_lines_plain_and_gzip(spark, tmp_path, rows):
    text = "caf\xe9 1 \r\n\n  S\xe3o\n".encode("latin-1")
    (tmp_path / "plain.txt").write_bytes(text)
    with gzip.open(tmp_path / "packed.txt.gz", "wb") as f:
        f.write(text)
    want = sorted([("café 1 \r",), ("",), ("  São",)], key=repr)
    for name in ("plain.txt", "packed.txt.gz"):
        assert rows(read_lines(spark, str(tmp_path / name), "ISO-8859-1")) == want


def test_gzip_lines_spread_before_decoding(spark, tmp_path, rows):
    """A gzipped file of non-ASCII lines is one split; with min_partitions it feeds that many tasks, all lines kept."""
    import gzip

    want = [(f"ção {i} é",) for i in range(20_000)]
    with gzip.open(tmp_path / "big.txt.gz", "wb") as f:
        f.write("\n".join(v for (v,) in want).encode("latin-1"))
    plain = read_lines(spark, str(tmp_path / "big.txt.gz"), "ISO-8859-1")
    spread = read_lines(spark, str(tmp_path / "big.txt.gz"), "ISO-8859-1", min_partitions=8)
    assert plain.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() == 8
    counts = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) == 8 and max(r["count"] for r in counts) <= 2 * min(r["count"] for r in counts)
    assert rows(spread) == sorted(want, key=repr)


def test_utf8_lines(spark, tmp_path, rows):
    (tmp_path / "u.txt").write_text("BP – linha\n", encoding="utf-8")
    assert rows(read_lines(spark, str(tmp_path / "u.txt"))) == [("BP – linha",)]


def test_rules_header_repeated_and_blank_fields(spark, tmp_path, rows):
    (tmp_path / "r.txt").write_text("A;B;C\r\n1;;3\r\nA;B;C\n;\"q;z\n")
    rules = read_rules(spark, str(tmp_path / "r.txt"), ["A", "C"])
    assert rules.columns == ["A", "B", "C"]
    assert rows(rules) == sorted([("1", "", "3"), ("", '"q', "z")], key=repr)


def test_rules_missing_column(spark, tmp_path):
    (tmp_path / "r.txt").write_text("A;B\n1;2\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_rules(spark, str(tmp_path / "r.txt"), ["Z"])


def test_snapshot_reads_one_date(spark, tmp_path, rows):
    for date, n in (("20240131", 1), ("20240229", 2)):
        spark.range(n).write.parquet(str(tmp_path / "T" / date))
    assert rows(read_snapshot(spark, str(tmp_path), "T", "20240229")) == [(0,), (1,)]


def test_field_short_lines_and_blanks(spark, rows):
    df = lines_of(spark, "ab cd\t ", "a", "")
    assert rows(df.select(fixedwidth.field((3, 10)))) == sorted([("cd",), ("",), ("",)])


def test_levels_drop_the_separator_character(spark):
    line = " " * 33 + "".join(f"{'L' + str(i):<24}#" for i in range(14))
    got = lines_of(spark, line).select(fixedwidth.levels(layouts.PORTFOLIO_CODES)).first()[0]
    assert got == [f"L{i}" for i in range(14)]


def test_layout_positions():
    assert layouts.AREA_CODES[0] == (218, 232) and layouts.AREA_CODES[-1] == (23, 37)
    assert layouts.AREA_DESCS[0] == (1533, 1632) and layouts.AREA_DESCS[-1] == (233, 332)
    assert layouts.PORTFOLIO_CODES[-1] == (358, 382)
    assert layouts.PORTFOLIO_DESCS[-1] == (1683, 1782)
    assert sum(w for _, w in layouts.ORG_MONTHLY) == 211 and len(layouts.ORG_MONTHLY) == 30


def test_parse_prefix_and_trim(spark, rows):
    df = lines_of(spark, "1AB  C", "2AB  C", "")
    parsed = fixedwidth.parse(fixedwidth.where_prefix(df, "1"), [("t", 1), ("a", 4), ("c-d", 3)])
    assert parsed.columns == ["t", "a", "c-d"]
    assert rows(parsed) == [("1", "AB", "C")]
    raw = fixedwidth.parse(df, [("t", 1), ("a", 4)], trim=False)
    assert ("1", "AB  ") in rows(raw)


def test_where_tag(spark, rows):
    df = lines_of(spark, "xxJAN02 ", "xxJAN03", "xx")
    assert rows(fixedwidth.where_tag(df, layouts.AREA_TAG)) == [("xxJAN02 ",)]
