"""The jobs from files to files, their totals and their plans."""

import dataclasses
import glob

import pytest
from pyspark.sql import functions as F

from checks import inputs
from ledgerline import layouts
from ledgerline.functions import ladders
from ledgerline.plans import jobs, report
from ledgerline.sinks.delimited import write_delimited
from ledgerline.sources.files import read_rules

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    """The daily job's inputs as the files it reads."""
    root = tmp_path_factory.mktemp("inputs")
    for name in ("facts", "contracts", "clients"):
        df = inputs.frame(spark, SF_DIR, name)
        if name == "contracts":
            df = df.withColumn("fec_can_ant", F.lit(None).cast("string"))
        df.write.parquet(f"{root}/snap/{name}/{inputs.DATE}")
    for name in ("area_lines", "portfolio_lines", "product_tree_lines", "product_flat_lines", "org_daily_lines"):
        writer = inputs.frame(spark, SF_DIR, name).write
        writer.option("compression", "gzip").text(f"{root}/{name}_{inputs.DATE}")
    for name in ("sign_rules", "exception_rules"):
        write_delimited(inputs.frame(spark, SF_DIR, name), f"{root}/{name}")
    return jobs.Paths(
        snapshots=f"{root}/snap", facts="facts", contracts="contracts", clients="clients",
        areas=f"{root}/area_lines_{{date}}", portfolios=f"{root}/portfolio_lines_{{date}}",
        product_tree=f"{root}/product_tree_lines_{{date}}", product_flat=f"{root}/product_flat_lines_{{date}}",
        organisation=f"{root}/org_daily_lines_{{date}}",
        sign_rules=f"{root}/sign_rules", exception_rules=f"{root}/exception_rules",
    )


@pytest.fixture(scope="module")
def loaded(spark, paths):
    return jobs.load(spark, paths, inputs.DATE)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_daily_from_files_to_files(spark, loaded, tmp_path, rows):
    result = jobs.daily(loaded, inputs.DATE)
    assert result.detail.columns == list(jobs.DAILY.detail_columns) and len(result.detail.columns) == 64
    assert len(result.consolidated.columns) == 23
    for m in layouts.CONSOLIDATED_SUMS:
        assert total(result.detail, m) == total(result.consolidated, m) is not None

    direct = report.report_frame(inputs.report_inputs(spark, SF_DIR, "org_daily_lines"), inputs.DATE, jobs.DAILY)
    order = result.consolidated.columns
    assert rows(result.consolidated) == rows(report.consolidated(direct, jobs.DAILY).select(*order))

    jobs.write(result, str(tmp_path), "report", inputs.DATE, consolidated_files=1)
    (part,) = glob.glob(f"{tmp_path}/report_consolidado_{inputs.DATE}/part-*")
    text = open(part, encoding="utf-8").read().splitlines()
    assert text[0] == ";".join(order) and text.count(text[0]) == 1
    assert len(text) == result.consolidated.count() + 1
    back = read_rules(spark, f"{tmp_path}/report_{inputs.DATE}", list(result.detail.columns))
    assert back.count() == result.detail.count()


def test_monthly_columns(spark):
    frame = report.report_frame(inputs.report_inputs(spark, SF_DIR, "org_monthly_lines"), inputs.DATE, jobs.MONTHLY)
    assert frame.columns == [name for name, _ in layouts.REPORT_COLUMNS] + ["copies"]
    detail = report.detail(frame, jobs.MONTHLY)
    assert len(detail.columns) == 62 and len(jobs.MONTHLY.detail_keys) == 55
    assert len(report.consolidated(frame, jobs.MONTHLY).columns) == 22
    assert {c: frame.schema[c].dataType.scale for c in layouts.ROUNDING} == layouts.ROUNDING


def test_options(loaded):
    usual = report.report_frame(loaded, inputs.DATE, jobs.DAILY)
    options = report.Options(
        null_token="None", spread_steps=ladders.SPREAD_STEPS_GROUPED, dedupe_labels=True, broadcast_bytes=0
    )
    other = report.report_frame(loaded, inputs.DATE, jobs.DAILY, options)
    assert usual.where("Nome_Cliente = 'None'").isEmpty() and not other.where("Nome_Cliente = 'None'").isEmpty()
    assert total(other, "copies") <= total(usual, "copies")


def test_shuffled_lookups_give_the_same_report(loaded, rows):
    usual = report.consolidated(report.report_frame(loaded, inputs.DATE, jobs.DAILY), jobs.DAILY)
    options = report.Options(broadcast_bytes=0)
    shuffled = report.consolidated(report.report_frame(loaded, inputs.DATE, jobs.DAILY, options), jobs.DAILY)
    assert rows(shuffled) == rows(usual)


def test_hot_client_and_contract(spark, loaded, rows):
    """A third of the facts are copies of one row: same totals as adding it that often."""
    facts = loaded.facts.where("trim(cod_contenido) = 'CRE'")
    one = facts.orderBy("idf_cto_ods", "cod_producto_gest", "cod_cta_cont_gestion").limit(1)
    times = facts.count() // 2
    copies = one.crossJoin(spark.range(times)).drop("id")
    skewed = dataclasses.replace(loaded, facts=facts.unionByName(copies))
    hot = report.hot_keys(skewed.facts, {"c": layouts.JOIN_KEYS})["c"]
    assert hot.hashes and hot.salts > 1

    def volume(inputs_):
        frame = report.report_frame(inputs_, inputs.DATE, jobs.DAILY)
        return total(report.detail(frame, jobs.DAILY), "Saldo_ponta")

    single = volume(dataclasses.replace(loaded, facts=one))
    assert volume(skewed) == volume(dataclasses.replace(loaded, facts=facts)) + times * single


def test_plan_has_no_extra_shuffle(spark, loaded):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = report.report_frame(loaded, inputs.DATE, jobs.DAILY)
        plan = report.detail(frame, jobs.DAILY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    upper = plan[: plan.index("SortMergeJoin")]
    assert "Exchange hashpartitioning" not in upper  # group-by rides on the contract join
    for bad in ("NestedLoop", "CartesianProduct", "Python", "ArrowEval"):
        assert bad not in plan
