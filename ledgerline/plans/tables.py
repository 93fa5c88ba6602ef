"""Lookup tables of the report, built from hierarchy lines and rule files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import layouts
from ledgerline.functions.text import org_code
from ledgerline.operators import hierarchy
from ledgerline.operators.joins import BROADCAST_BYTES, lookup
from ledgerline.operators.override import rule_hits
from ledgerline.operators.relabel import relabel
from ledgerline.sources import fixedwidth


def business_areas(lines: DataFrame) -> DataFrame:
    """Area code and its reporting label."""
    lines = fixedwidth.where_tag(lines, layouts.AREA_TAG)
    records = lines.select(
        fixedwidth.field(layouts.AREA_CODE).alias("codigo"),
        fixedwidth.levels(layouts.AREA_CODES).alias("codes"),
        fixedwidth.levels(layouts.AREA_DESCS).alias("descs"),
    )
    label = hierarchy.first_label(F.col("codigo"), F.col("codes"), F.col("descs"))
    return records.select("codigo", label.alias("Area_de_Negocio_Reporting"))


def portfolios_pv(lines: DataFrame) -> DataFrame:
    """Portfolio code and its code in the PV view."""
    lines = fixedwidth.where_tag(lines, layouts.PORTFOLIO_PV_TAG)
    records = lines.select(
        fixedwidth.field(layouts.PORTFOLIO_CODE).alias("codigo_cart_pv"),
        fixedwidth.levels(layouts.PORTFOLIO_CODES).alias("codes"),
        fixedwidth.levels(layouts.PORTFOLIO_DESCS).alias("descs"),
    )
    above = hierarchy.code_before_keyword(F.col("codigo_cart_pv"), F.col("codes"), F.col("descs"))
    return records.select("codigo_cart_pv", above.alias("Cod_Carteira_PV"))


def portfolio_managers(lines: DataFrame) -> DataFrame:
    """Portfolio code and its manager."""
    lines = fixedwidth.where_tag(lines, layouts.PORTFOLIO_MANAGER_TAG)
    records = lines.select(
        fixedwidth.field(layouts.PORTFOLIO_CODE).alias("codigo_cart"),
        fixedwidth.levels(layouts.PORTFOLIO_CODES).alias("codes"),
    )
    manager = hierarchy.parent_at_level(F.col("codigo_cart"), F.col("codes"))
    return records.select("codigo_cart", manager.alias("Ger_Matr"))


def product_labels(lines: DataFrame) -> DataFrame:
    """Product code and its level-3 balance label."""
    return fixedwidth.select_fields(
        fixedwidth.where_tag(lines, layouts.PRODUCT_FLAT_TAG),
        {"cod_prod": layouts.PRODUCT_FLAT_CODE, "Balanco_LDN_Nivel_3": layouts.PRODUCT_FLAT_LABEL},
    )


def sign_factors(rules: DataFrame) -> DataFrame:
    """Distinct sign rules, with the number of equal ones in ``sign_copies``.

    A balance is repeated per matching rule; equal rules give equal rows, which the plans count.
    """
    columns = layouts.SIGN_RULES
    counted = rules.groupBy(*columns).agg(F.count(F.lit(1)).alias("sign_copies"))
    return counted.withColumnRenamed("Balanco_LDN_Nivel_3", "sign_label")


def product_edges(lines: DataFrame) -> DataFrame:
    """Distinct (child, parent, descr) rows of the product tree."""
    lines = fixedwidth.where_tag(lines, layouts.PRODUCT_TREE_TAG)
    columns = hierarchy.edges(
        fixedwidth.field(layouts.PRODUCT_CHILD),
        fixedwidth.field(layouts.PRODUCT_PARENT),
        fixedwidth.field(layouts.PRODUCT_DESC),
    )
    return lines.select(*columns).distinct()


def product_lines(lines: DataFrame) -> DataFrame:
    """Product code, its line, the line's label, and how often that result occurs."""
    resolved = hierarchy.nearest_ancestor(product_edges(lines))
    return resolved.select(
        F.col("child").alias("codigo_prod"),
        F.col("line").alias("Codigo_Linha_BP"),
        F.col("label").alias("Linha_BP"),
        "copies",
    )


def split_org_code(df: DataFrame, column: str = "Cod_Carteira_PV") -> DataFrame:
    """Add the unit type (two characters) and unit code found in a portfolio code."""
    code = org_code(F.col(column))
    return df.withColumns(
        {
            "unit_type": F.substring(code, 1, 2),
            "unit_code": F.substring(code, F.lit(3), F.length(code)),
        }
    )


def organisation(records: DataFrame, keys: tuple[str, str], superior: tuple[str, str], entity: str) -> DataFrame:
    """Unit type, unit code and superior unit of the reporting entity's records."""
    records = records.where(F.col(f"`{entity}`").isin(*layouts.ORG_ENTITIES))
    return records.select(
        F.col(f"`{keys[0]}`").alias("org_type"),
        F.col(f"`{keys[1]}`").alias("org_code"),
        F.concat(*[F.col(f"`{c}`") for c in superior]).alias("Superior_Carteira_Uniorg"),
    )


def portfolios(pv: DataFrame, managers: DataFrame, org: DataFrame) -> DataFrame:
    """All that a portfolio code looks up, in one table keyed ``portfolio``.

    Left joining this table gives the same rows as left joining the PV view,
    the managers and then the organisation one by one: a code in both views has
    every pair of its rows, a code in one view has that view's rows.
    """
    both = pv.join(managers, F.col("codigo_cart_pv") == F.col("codigo_cart"), "full")
    both = both.select(
        F.coalesce("codigo_cart_pv", "codigo_cart").alias("portfolio"), "Cod_Carteira_PV", "Ger_Matr"
    )
    placed = lookup(
        split_org_code(both), org, {"unit_type": "org_type", "unit_code": "org_code"}, size=None
    )
    return placed.drop("unit_type", "unit_code")


def line_overrides(
    pairs: DataFrame,
    lines: DataFrame,
    rules: DataFrame,
    dedupe: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """New line and label for each (line, product, account) that exception rules change.

    Whether a balance is changed depends on its product and account alone, so
    rules and relabelling run on distinct pairs, and pairs no rule matches leave
    at once. ``times`` is how many equal rows the row-by-row joins would give.
    Products without a line are never overridden, whatever else matches.
    """
    keys = {
        "Codigo_Linha_BP": "Linha_BP_ORIGEM",
        "cod_producto_gest": "Produto_Gestao_ORIGEM",
        "cod_cta_cont_gestion": "CONTA_DE_GESTAO",
    }
    named = lines.select("codigo_prod", "Codigo_Linha_BP").distinct()
    combos = lookup(pairs, named, {"cod_producto_gest": "codigo_prod"}, how="inner", size=None)
    hits = rule_hits(combos, rules, keys, ["Linha_BP_PARA"], limit)
    relabelled = relabel(
        hits.withColumnRenamed("hits", "times"),
        lines.withColumnRenamed("Codigo_Linha_BP", "target_line"),
        target="Linha_BP_PARA",
        code="target_line",
        label="Linha_BP",
        into="new_label",
        dedupe=dedupe,
        copies="times",
        line_copies="copies",
        size=None,
    )
    return relabelled.select(
        F.col("Codigo_Linha_BP").alias("old_line"),
        F.col("cod_producto_gest").alias("old_product"),
        F.col("cod_cta_cont_gestion").alias("old_account"),
        F.col("Linha_BP_PARA").alias("new_line"),
        "new_label",
        "times",
    )


OVERRIDE_KEYS = {
    "Codigo_Linha_BP": "old_line",
    "cod_producto_gest": "old_product",
    "cod_cta_cont_gestion": "old_account",
}


def with_new_lines(df: DataFrame) -> DataFrame:
    """Put new line and label in place where a rule names one; count the copies."""
    kept = F.col("new_line").isNull()
    return df.withColumns(
        {
            "Codigo_Linha_BP": F.when(kept, F.col("Codigo_Linha_BP")).otherwise(F.col("new_line")),
            "Linha_BP": F.when(kept, F.col("Linha_BP")).otherwise(F.col("new_label")),
            "copies": F.coalesce("copies", F.lit(1)) * F.coalesce("times", F.lit(1)),
        }
    ).drop("new_line", "new_label", "times")
