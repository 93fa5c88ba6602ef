"""One query per operator, each over the whole test tables, and the two jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs, oracles
from checks.oracles import out, source, trim, with_
from ledgerline import layouts
from ledgerline.functions import ladders
from ledgerline.functions.numbers import clean_round as rounded_columns
from ledgerline.functions.numbers import exact_types
from ledgerline.functions.text import strip_prefix
from ledgerline.operators import hierarchy, measures, rollup, shape
from ledgerline.operators.joins import BROADCAST_BYTES, lookup, measured_bytes
from ledgerline.operators.lineage import staging_path
from ledgerline.operators.override import any_key_override as override
from ledgerline.operators.relabel import relabel
from ledgerline.operators.skew import hot_keys, salted_join, with_spread
from ledgerline.plans import jobs, report, tables
from ledgerline.sinks.delimited import write_delimited
from ledgerline.sources import fixedwidth
from ledgerline.sources.files import read_lines, read_rules, read_snapshot

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def shown(c: Column | str, digits: int = 2) -> Column:
    """An amount as a double both engines print alike."""
    return F.round(c, digits).cast("double")


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = inputs.frame(spark, sf_dir, "facts")
    return shape.trim_all(facts, keep=layouts.AMOUNTS)


def _contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.trim_all(inputs.frame(spark, sf_dir, "contracts"))


def _clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.trim_all(shape.lower_names(inputs.frame(spark, sf_dir, "clients")))


# --- measures and rollups ---------------------------------------------------------

_MEASURED = with_(
    source("facts"), source("product_flat_lines"), source("sign_rules"),
    oracles.FACTS, oracles.PRODUCT_LABELS, oracles.SIGNED,
)
_ALL_MEASURES = list(layouts.MEASURES)
#: Measures of a double amount are doubles; they are shown through ten decimals, where both engines agree.
_DOUBLE_MEASURES = {m for m, cols in layouts.MEASURES.items() if set(cols) & inputs.DOUBLE_AMOUNTS}


def _steady(m: str, sql: str | None = None) -> str:
    expr = sql or m
    return f"cast({expr} as decimal(38,10))" if m in _DOUBLE_MEASURES else expr


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with their measures; ``sign_copies`` counts equal rows that equal sign rules give."""
    facts = _facts(spark, sf_dir)
    types = exact_types(facts, layouts.AMOUNTS)
    labels = tables.product_labels(inputs.frame(spark, sf_dir, "product_flat_lines"))
    facts = lookup(facts, labels, {"cod_producto_gest": "cod_prod"})
    signs = tables.sign_factors(inputs.frame(spark, sf_dir, "sign_rules"))
    facts = lookup(
        facts, signs, {"tip_concepto_ctb": "Conceito_Contabil", "Balanco_LDN_Nivel_3": "sign_label"}
    )
    sign_type = exact_types(signs, ["Criterio_de_Sinais"])["Criterio_de_Sinais"]
    measured = measures.signed_sum(facts, layouts.MEASURES, F.col("Criterio_de_Sinais"), sign_type=sign_type, types=types)
    return measured.withColumn("sign_copies", F.coalesce("sign_copies", F.lit(1)))


@query(
    f"{_MEASURED}\nselect cod_segmento_gest, cod_tip_ajuste, cod_contenido, "
    + ", ".join(f"{out(_steady(m, f'sum({m})'))} as {m}" for m in _ALL_MEASURES)
    + " from signed group by cod_segmento_gest, cod_tip_ajuste, cod_contenido"
)
def signed_rollup(spark, sf_dir):
    """Sign rules, measures and a group-by."""
    keys = ["cod_segmento_gest", "cod_tip_ajuste", "cod_contenido"]
    grouped = rollup.exact_group_sum(_measured(spark, sf_dir), keys, _ALL_MEASURES, "sign_copies")
    return grouped.select(*keys, *[shown(F.expr(_steady(m))).alias(m) for m in _ALL_MEASURES])


@query(
    f"{_MEASURED}\nselect idf_cto_ods, cod_contenido, cod_producto_gest, cod_cta_cont_gestion, "
    + ", ".join(f"{out(_steady(m), 4)} as {m}" for m in _ALL_MEASURES) + " from signed"
)
def measures_all(spark, sf_dir):
    """Eight measures per fact (M0-M8)."""
    shown_once = _measured(spark, sf_dir).select(
        "idf_cto_ods", "cod_contenido", "cod_producto_gest", "cod_cta_cont_gestion",
        *[shown(F.expr(_steady(m)), 4).alias(m) for m in _ALL_MEASURES], "sign_copies",
    )
    return hierarchy.repeat(shown_once, "sign_copies")


@query(
    f"""{_MEASURED}\nselect cod_centro_cont, count(*) as facts,
  {out('sum(Resultado_Total_ml - Receita - Custo)', 4)} as income_and_cost,
  {out('sum(Resultado_Total_ml - Resultado_Real - Res_ficticio)', 4)} as real_and_adjusted
from signed where Resultado_Total_ml is not null group by cod_centro_cont"""
)
def measure_identity(spark, sf_dir):
    """Total = income + cost = real + adjustments (M3-M7): both differences are 0."""
    c = F.col
    m = _measured(spark, sf_dir).where(c("Resultado_Total_ml").isNotNull())
    m = m.select(
        "cod_centro_cont", F.lit(1).alias("facts"), "sign_copies",
        (c("Resultado_Total_ml") - c("Receita") - c("Custo")).alias("income_and_cost"),
        (c("Resultado_Total_ml") - c("Resultado_Real") - c("Res_ficticio")).alias("real_and_adjusted"),
    )
    totals = rollup.exact_group_sum(m, ["cod_centro_cont"], ["facts", "income_and_cost", "real_and_adjusted"], "sign_copies")
    return totals.select(
        "cod_centro_cont", c("facts").cast("bigint").alias("facts"),
        *[shown(d, 4).alias(d) for d in ("income_and_cost", "real_and_adjusted")],
    )


# --- fixed-width records ----------------------------------------------------------


def _record_sql(lines: str, layout: list[tuple[str, int]]) -> str:
    columns, start = [], 0
    for name, width in layout:
        columns.append(f'{oracles.slice_((start, start + width))} as "{name}"')
        start += width
    return with_(source(lines)) + f"\nselect {', '.join(columns)} from in_{lines} where value like '1%'"


@query(_record_sql("org_monthly_lines", layouts.ORG_MONTHLY))
def fixed_width_org_monthly(spark, sf_dir):
    """Prefix filter and a 30-field record."""
    lines = inputs.frame(spark, sf_dir, "org_monthly_lines")
    return fixedwidth.parse(fixedwidth.where_prefix(lines, layouts.ORG_PREFIX), layouts.ORG_MONTHLY)


@query(_record_sql("org_daily_lines", layouts.ORG_DAILY))
def fixed_width_org_daily(spark, sf_dir):
    """Prefix filter and a 6-field record."""
    lines = inputs.frame(spark, sf_dir, "org_daily_lines")
    return fixedwidth.parse(fixedwidth.where_prefix(lines, layouts.ORG_PREFIX), layouts.ORG_DAILY)


@query(
    with_(source("portfolio_lines")) + f"""
select {oracles.slice_(layouts.PORTFOLIO_CODE)} as code,
  array_to_string({oracles.slices(layouts.PORTFOLIO_CODES)}, '|') as codes,
  array_to_string({oracles.slices(layouts.PORTFOLIO_DESCS)}, '|') as descs
from in_portfolio_lines where {oracles.slice_((2, 8))} = 'JCRPV'"""
)
def level_arrays(spark, sf_dir):
    """Tag filter and 14-level arrays."""
    lines = inputs.frame(spark, sf_dir, "portfolio_lines")
    return fixedwidth.where_tag(lines, layouts.PORTFOLIO_PV_TAG).select(
        fixedwidth.field(layouts.PORTFOLIO_CODE).alias("code"),
        F.array_join(fixedwidth.levels(layouts.PORTFOLIO_CODES), "|").alias("codes"),
        F.array_join(fixedwidth.levels(layouts.PORTFOLIO_DESCS), "|").alias("descs"),
    )


# --- hierarchies ------------------------------------------------------------------


@query(with_(source("area_lines"), oracles.AREAS) + "\nselect codigo, label as Area_de_Negocio_Reporting from areas")
def first_label(spark, sf_dir):
    """Nearest label at or above the own level (H1)."""
    return tables.business_areas(inputs.frame(spark, sf_dir, "area_lines"))


@query(
    with_(source("portfolio_lines"), oracles.PORTFOLIOS_PV)
    + "\nselect code as codigo_cart_pv, pv_code as Cod_Carteira_PV from pv"
)
def code_before_keyword(spark, sf_dir):
    """Code of the level above the first keyword (H2)."""
    return tables.portfolios_pv(inputs.frame(spark, sf_dir, "portfolio_lines"))


@query(
    with_(source("portfolio_lines"), oracles.MANAGERS)
    + "\nselect code as codigo_cart, manager as Ger_Matr from managers"
)
def parent_at_level(spark, sf_dir):
    """Parent by fixed level (H3)."""
    return tables.portfolio_managers(inputs.frame(spark, sf_dir, "portfolio_lines"))


@query(
    with_(source("facts"), source("product_flat_lines"), oracles.FACTS, oracles.PRODUCT_LABELS)
    + """\nselect cod_producto_gest, label as Balanco_LDN_Nivel_3, count(*) as facts
from facts left join product_labels on cod_producto_gest = code group by 1, 2"""
)
def flat_attribute(spark, sf_dir):
    """Product label read from lines and joined to facts."""
    labels = tables.product_labels(inputs.frame(spark, sf_dir, "product_flat_lines"))
    facts = lookup(_facts(spark, sf_dir), labels, {"cod_producto_gest": "cod_prod"})
    return facts.groupBy("cod_producto_gest", "Balanco_LDN_Nivel_3").agg(F.count(F.lit(1)).alias("facts"))


@query(with_(source("product_tree_lines"), oracles.EDGES) + "\nselect child, parent, descr from edges")
def edges_distinct(spark, sf_dir):
    """Distinct tree edges with cut descriptions (H5, A3)."""
    return tables.product_edges(inputs.frame(spark, sf_dir, "product_tree_lines"))


_LINES = (source("product_tree_lines"), oracles.EDGES, oracles.climb())


@query(
    with_(*_LINES)
    + "\nselect child as codigo_prod, line as Codigo_Linha_BP, label as Linha_BP from product_lines"
)
def nearest_ancestor(spark, sf_dir):
    """Nearest marked ancestor of every product, one row per path."""
    lines = tables.product_lines(inputs.frame(spark, sf_dir, "product_tree_lines"))
    return hierarchy.repeat(lines)


_CHAIN = """select cast(p_partkey as string) as child, cast(p_partkey - 1 as string) as parent,
  case when p_partkey % 40 = 1 then 'BP - ' || p_name else p_name end as descr from {part}"""


@query(
    with_(f"chain as ({inputs.duck(_CHAIN)})", oracles.climb("chain", "resolved"))
    + "\nselect child, line, label, count(*) as copies from resolved group by 1, 2, 3"
)
def ancestor_depth_cap(spark, sf_dir):
    """A chain longer than the climb limit (H6, H7)."""
    chain = spark.sql(_CHAIN, part=inputs.table(spark, sf_dir, "part"))
    return hierarchy.nearest_ancestor(chain).withColumn("copies", F.col("copies").cast("bigint"))


# --- joins ------------------------------------------------------------------------

_KEYS = ", ".join(layouts.JOIN_KEYS)
_JOINED = (
    source("facts"), source("contracts"), source("clients"), oracles.FACTS, oracles.CONTRACTS, oracles.CLIENTS,
)


@query(
    with_(*_JOINED)
    + f"""\nselect idf_cto_ods, fec_data, cod_contenido, idf_pers_ods, cod_producto_gest, cod_cta_cont_gestion,
  cod_producto, imp_ini_mo, cod_cartera_gestion, idf_cliente, nom_nombre, cod_tip_persona
from facts join contracts using ({_KEYS}) join clients using (idf_pers_ods)"""
)
def three_key_join(spark, sf_dir):
    """Facts with contracts and clients, hot keys salted."""
    facts = with_spread(_facts(spark, sf_dir).drop(*layouts.AMOUNTS))
    facts = salted_join(facts, _clients(spark, sf_dir), {"idf_pers_ods": "idf_pers_ods"})
    joined = salted_join(facts, _contracts(spark, sf_dir), {k: k for k in layouts.JOIN_KEYS})
    return joined.select(
        *layouts.JOIN_KEYS, "idf_pers_ods", "cod_producto_gest", "cod_cta_cont_gestion", "cod_producto",
        "imp_ini_mo", "cod_cartera_gestion", *layouts.CLIENT_ATTRIBUTES,
    )


@query(
    with_(
        source("facts"), source("contracts"), source("area_lines"), source("portfolio_lines"), *_LINES,
        oracles.FACTS, oracles.CONTRACTS, oracles.AREAS, oracles.PORTFOLIOS_PV, oracles.MANAGERS,
    )
    + f"""\nselect l.line as Codigo_Linha_BP, a.label as Area_de_Negocio_Reporting, pv_code as Cod_Carteira_PV,
  manager as Ger_Matr, count(*) as facts
from facts join contracts using ({_KEYS})
left join product_lines l on cod_producto_gest = l.child
left join areas a on cod_area_negocio = a.codigo
left join pv on cod_cartera_gestion = pv.code
left join managers m on cod_cartera_gestion = m.code
group by 1, 2, 3, 4"""
)
def lookup_left(spark, sf_dir):
    """Left lookups of line, area, PV portfolio and manager."""
    portfolio_lines = inputs.frame(spark, sf_dir, "portfolio_lines")
    lines = hierarchy.repeat(tables.product_lines(inputs.frame(spark, sf_dir, "product_tree_lines")))
    areas = tables.business_areas(inputs.frame(spark, sf_dir, "area_lines"))
    pv, managers = tables.portfolios_pv(portfolio_lines), tables.portfolio_managers(portfolio_lines)
    sizes = measured_bytes({"lines": lines, "areas": areas, "pv": pv, "managers": managers})
    # one sketch over the narrow facts; no lookup runs the joins before it once more
    facts = with_spread(_facts(spark, sf_dir).drop(*layouts.AMOUNTS))
    hot = hot_keys(facts, {"contract": layouts.JOIN_KEYS, "product": ["cod_producto_gest"]})

    def bounded(name: str) -> int | None:
        return sizes[name] if sizes[name] <= BROADCAST_BYTES else None

    contracts = _contracts(spark, sf_dir).select(*layouts.JOIN_KEYS, "cod_cartera_gestion")
    contracts = lookup(contracts, pv, {"cod_cartera_gestion": "codigo_cart_pv"}, size=bounded("pv"))
    contracts = lookup(contracts, managers, {"cod_cartera_gestion": "codigo_cart"}, size=bounded("managers"))
    joined = salted_join(facts, contracts, {k: k for k in layouts.JOIN_KEYS}, hot=hot["contract"])
    joined = lookup(joined, lines, {"cod_producto_gest": "codigo_prod"}, size=sizes["lines"], hot=hot["product"])
    joined = lookup(joined, areas, {"cod_area_negocio": "codigo"}, size=bounded("areas"))
    keys = ["Codigo_Linha_BP", "Area_de_Negocio_Reporting", "Cod_Carteira_PV", "Ger_Matr"]
    return joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("facts"))


def _org_sql(monthly: bool) -> str:
    lines, layout = ("org_monthly_lines", layouts.ORG_MONTHLY) if monthly else ("org_daily_lines", layouts.ORG_DAILY)
    p = jobs.MONTHLY if monthly else jobs.DAILY
    return with_(
        source("portfolio_lines"), source(lines), oracles.PORTFOLIOS_PV,
        oracles.org(layout, lines, p.org_keys, p.org_superior, p.org_entity),
    ) + f"""\nselect code as codigo_cart_pv, pv_code as Cod_Carteira_PV, substr({oracles.UNIT}, 1, 2) as unit_type,
  substr({oracles.UNIT}, 3) as unit_code, superior as Superior_Carteira_Uniorg
from pv left join org on substr({oracles.UNIT}, 1, 2) = org_type and substr({oracles.UNIT}, 3) = org_code"""


def _org_lookup(spark, sf_dir, lines: str, p: report.Profile) -> DataFrame:
    records = fixedwidth.where_prefix(inputs.frame(spark, sf_dir, lines), layouts.ORG_PREFIX)
    records = fixedwidth.parse(records, p.org_layout)
    pv = tables.split_org_code(tables.portfolios_pv(inputs.frame(spark, sf_dir, "portfolio_lines")))
    placed = lookup(
        pv.withColumns({"t": F.col("unit_type"), "c": F.col("unit_code")}),
        records.select(*[F.col(f"`{c}`") for c in (*p.org_keys, *p.org_superior, p.org_entity)]),
        dict(zip(("t", "c"), p.org_keys)),
        right_filter=F.col(f"`{p.org_entity}`").isin(*layouts.ORG_ENTITIES),
    )
    superior = F.concat(*[F.col(f"`{c}`") for c in p.org_superior])
    return placed.select(
        "codigo_cart_pv", "Cod_Carteira_PV", "unit_type", "unit_code", superior.alias("Superior_Carteira_Uniorg")
    )


@query(_org_sql(True))
def right_filtered_left(spark, sf_dir):
    """Left join with a condition on the right side only, monthly layout."""
    return _org_lookup(spark, sf_dir, "org_monthly_lines", jobs.MONTHLY)


@query(_org_sql(False))
def org_code_split(spark, sf_dir):
    """Unit type and code out of a portfolio code, superior unit, daily layout."""
    return _org_lookup(spark, sf_dir, "org_daily_lines", jobs.DAILY)


_OVERRIDE = with_(
    source("facts"), *_LINES, source("exception_rules"), oracles.FACTS,
    """lined as (select f.idf_cto_ods, f.cod_producto_gest, f.cod_cta_cont_gestion, l.line, l.label
  from facts f left join product_lines l on f.cod_producto_gest = l.child)""",
)
_RULE_KEYS = {
    "Codigo_Linha_BP": "Linha_BP_ORIGEM",
    "cod_producto_gest": "Produto_Gestao_ORIGEM",
    "cod_cta_cont_gestion": "CONTA_DE_GESTAO",
}


def _lined(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lines = tables.product_lines(inputs.frame(spark, sf_dir, "product_tree_lines"))
    facts = _facts(spark, sf_dir).select("idf_cto_ods", "cod_producto_gest", "cod_cta_cont_gestion")
    return lookup(facts, hierarchy.repeat(lines), {"cod_producto_gest": "codigo_prod"}), lines


@query(
    _OVERRIDE
    + """\nselect idf_cto_ods, cod_producto_gest, cod_cta_cont_gestion, line as Codigo_Linha_BP, Linha_BP_PARA
from lined left join in_exception_rules on line is not null and (line = Linha_BP_ORIGEM
  or cod_producto_gest = Produto_Gestao_ORIGEM or cod_cta_cont_gestion = CONTA_DE_GESTAO)"""
)
def any_key_override(spark, sf_dir):
    """Rules matching on any key, a row per matching rule."""
    lined, _ = _lined(spark, sf_dir)
    rules = inputs.frame(spark, sf_dir, "exception_rules")
    ruled = override(
        lined, rules, _RULE_KEYS, ["Linha_BP_PARA"], only_when=F.col("Codigo_Linha_BP").isNotNull()
    )
    return ruled.drop("Linha_BP")


def _relabelled_sql(labels: str) -> str:
    return _OVERRIDE + f"""\nselect o.cod_producto_gest, case when t.Linha_BP_PARA is null then o.line else t.Linha_BP_PARA end
    as Codigo_Linha_BP, case when t.Linha_BP_PARA is null then o.label else n.label end as Linha_BP,
  count(*) as facts
from lined o
left join in_exception_rules t on o.line is not null and (o.line = t.Linha_BP_ORIGEM
  or o.cod_producto_gest = t.Produto_Gestao_ORIGEM or o.cod_cta_cont_gestion = t.CONTA_DE_GESTAO)
left join {labels} n on t.Linha_BP_PARA = n.line
group by 1, 2, 3"""


def _relabelled(spark, sf_dir, dedupe: bool) -> DataFrame:
    lined, lines = _lined(spark, sf_dir)
    rules = inputs.frame(spark, sf_dir, "exception_rules")
    ruled = override(
        lined, rules, _RULE_KEYS, ["Linha_BP_PARA"],
        only_when=F.col("Codigo_Linha_BP").isNotNull(), copies="n",
    )
    named = relabel(
        ruled, lines, "Linha_BP_PARA", "Codigo_Linha_BP", "Linha_BP", "new_label", dedupe, "n", "copies"
    )
    kept = F.col("Linha_BP_PARA").isNull()
    return named.groupBy(
        "cod_producto_gest",
        F.when(kept, F.col("Codigo_Linha_BP")).otherwise(F.col("Linha_BP_PARA")).alias("Codigo_Linha_BP"),
        F.when(kept, F.col("Linha_BP")).otherwise(F.col("new_label")).alias("Linha_BP"),
    ).agg(F.sum("n").alias("facts"))


@query(_relabelled_sql("product_lines"))
def relabel_fanout(spark, sf_dir):
    """New line and label, counted once per product of the new line."""
    return _relabelled(spark, sf_dir, dedupe=False)


@query(_relabelled_sql("(select distinct line, label from product_lines)"))
def relabel_dedupe(spark, sf_dir):
    """New line and label, each label once."""
    return _relabelled(spark, sf_dir, dedupe=True)


# --- rules on columns ---------------------------------------------------------------

_RATED = with_(
    source("facts"), source("contracts"), oracles.FACTS, oracles.CONTRACTS,
    f"""rated as (select *, {oracles.CUPOM_TC} as Cupom_tc, {oracles.CUPOM_TTI} as Cupom_tti,
  {oracles.CD_SIST} as Cd_Sist from facts join contracts using ({_KEYS}))""",
)
_RATE_KEYS = ["idf_cto_ods", "cod_contenido", "cod_producto_gest", "cod_cta_cont_gestion"]


def _rated(spark, sf_dir, steps=ladders.SPREAD_STEPS) -> DataFrame:
    facts = with_spread(_facts(spark, sf_dir).drop(*layouts.AMOUNTS))
    joined = salted_join(facts, _contracts(spark, sf_dir), {k: k for k in layouts.JOIN_KEYS})
    return report.with_rates(joined, steps)


@query(f"{_RATED}\nselect {', '.join(_RATE_KEYS)}, tipo_tasa_adis, Cupom_tc, Cupom_tti from rated")
def rate_ladder(spark, sf_dir):
    """Coupons by rate type."""
    return _rated(spark, sf_dir).select(*_RATE_KEYS, "tipo_tasa_adis", "Cupom_tc", "Cupom_tti")


@query(
    with_(source("facts"), oracles.FACTS)
    + f"\nselect cod_segmento_gest, cod_contenido, {oracles.CD_SIST} as Cd_Sist, count(*) as facts from facts group by 1, 2, 3"
)
def system_code(spark, sf_dir):
    """System code with its fallbacks."""
    code = ladders.system_code(F.col("cod_sis_origen"), F.col("ind_conciliacion"), F.col("cod_contenido"))
    return (
        _facts(spark, sf_dir)
        .groupBy("cod_segmento_gest", "cod_contenido", code.alias("Cd_Sist"))
        .agg(F.count(F.lit(1)).alias("facts"))
    )


def _spread_sql(ladder: str) -> str:
    return (
        f"{_RATED}\nselect {', '.join(_RATE_KEYS)}, cod_tip_tas, {out('Spread', 6)} as Spread "
        f"from (select *, {ladder} as Spread from rated)"
    )


def _spread(spark, sf_dir, steps) -> DataFrame:
    return _rated(spark, sf_dir, steps).select(*_RATE_KEYS, "cod_tip_tas", shown("Spread", 6).alias("Spread"))


@query(_spread_sql(oracles.SPREAD))
def spread_as_written(spark, sf_dir):
    """Spread ladder, rate kind tested for the last code of each list (C4)."""
    return _spread(spark, sf_dir, ladders.SPREAD_STEPS)


@query(_spread_sql(oracles.SPREAD_GROUPED))
def spread_grouped(spark, sf_dir):
    """Spread ladder, rate kind tested for every code (C4)."""
    return _spread(spark, sf_dir, ladders.SPREAD_STEPS_GROUPED)


@query(
    with_(source("facts"), oracles.FACTS)
    + f"""\nselect {oracles.strip_prefix('idf_pers_ods', 5, 10033)} as Penumper,
  {oracles.strip_prefix('cod_ofi_comercial', 2, 1)} as Agencia, count(*) as facts from facts group by 1, 2"""
)
def prefix_strip(spark, sf_dir):
    """Numeric prefixes dropped from person and office codes."""
    person = strip_prefix(F.col("idf_pers_ods"), *layouts.PERSON_PREFIX)
    office = strip_prefix(F.col("cod_ofi_comercial"), *layouts.OFFICE_PREFIX)
    return (
        _facts(spark, sf_dir)
        .groupBy(person.alias("Penumper"), office.alias("Agencia"))
        .agg(F.count(F.lit(1)).alias("facts"))
    )


# --- cleaning, filtering, projecting ------------------------------------------------


@query(
    with_(source("clients"))
    + "\nselect " + ", ".join(
        f"coalesce({trim(f'cast({c} as varchar)')}, 'None') as {c}"
        for c in [layouts.PERSON_KEY, *layouts.CLIENT_ATTRIBUTES]
    ) + " from in_clients"
)
def clean_trim(spark, sf_dir):
    """All columns as trimmed text under lower-case names, NULL as a word."""
    return shape.trim_all(shape.lower_names(inputs.frame(spark, sf_dir, "clients")), null_token="None")


@query(
    with_(source("facts"), source("contracts"), oracles.FACTS, oracles.CONTRACTS)
    + f"""\nselect cod_contenido, count(*) as facts
from facts f join contracts g using ({_KEYS})
where f.cod_contenido in ('COM','PLZ','ARF','CCL','CCO','CRE','CTA','CTB','CTG','FON','PRE')
  and g.cod_contenido in ('ARF','CCO','COM','CRE','CTA','CTG','FON','PLZ','PRE') group by 1"""
)
def content_filter(spark, sf_dir):
    """Both content lists before the inner join (P5)."""
    facts = with_spread(shape.where_in(
        _facts(spark, sf_dir).select(*layouts.JOIN_KEYS), "cod_contenido", layouts.DAILY_FACT_CONTENTS
    ))
    contracts = shape.where_in(
        _contracts(spark, sf_dir).select(*layouts.JOIN_KEYS), "cod_contenido", layouts.DAILY_CONTRACT_CONTENTS
    )
    joined = salted_join(facts, contracts, {k: k for k in layouts.JOIN_KEYS})
    return joined.groupBy("cod_contenido").agg(F.count(F.lit(1)).alias("facts"))


_CLEANED = {"imp_ini_mo": 1, "tas_int": 5, "por_util_ind": 1}


@query(
    with_(source("contracts"), oracles.CONTRACTS)
    + "\nselect idf_cto_ods, cod_contenido, " + ", ".join(
        f"cast(round(try_cast(regexp_replace({c}, '[^-0-9.]', '', 'g') as decimal(28,10)), {n}) as double) as {c}"
        for c, n in _CLEANED.items()
    ) + " from contracts"
)
def clean_round_text(spark, sf_dir):
    """Numbers read out of text and rounded half up."""
    rounded = rounded_columns(_contracts(spark, sf_dir), _CLEANED)
    return rounded.select("idf_cto_ods", "cod_contenido", *[F.col(c).cast("double").alias(c) for c in _CLEANED])


_PRICE = "cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2))"


@query(
    f"""select l_orderkey, l_linenumber, cast(round({_PRICE}, 3) as double) as discount,
  cast(round(cast(l_tax as decimal(18,2)), 1) as double) as tax from lineitem"""
)
def clean_round(spark, sf_dir):
    """Numeric columns rounded half up, no text in between."""
    price = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)")
    rows = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", price.alias("discount"), F.col("l_tax").cast("decimal(18,2)").alias("tax")
    )
    rounded = rounded_columns(rows, {"discount": 3, "tax": 1})
    return rounded.withColumns({c: F.col(c).cast("double") for c in ("discount", "tax")})


_RENAMED = [(new, old) for new, old in layouts.REPORT_COLUMNS if old in layouts.CONTRACT_ATTRIBUTES + layouts.JOIN_KEYS]


@query(
    with_(source("contracts"), oracles.CONTRACTS)
    + f"\nselect '{inputs.DATE}' as Data_Extracao, " + ", ".join(f"{old} as {new}" for new, old in _RENAMED)
    + ", '' as Fonte from contracts"
)
def select_rename(spark, sf_dir):
    """Projection, renaming and constants in one select."""
    contracts = shape.constants(_contracts(spark, sf_dir), Data_Extracao=inputs.DATE)
    named = shape.select_map(contracts, [("Data_Extracao", "Data_Extracao"), *_RENAMED])
    return shape.constants(named, Fonte="")


# --- jobs -----------------------------------------------------------------------------


def _job_output(df: DataFrame) -> DataFrame:
    """Amounts as doubles: sums to two digits, numeric attributes to four."""
    columns = []
    for f in df.schema.fields:
        numeric = f.dataType.typeName() in ("decimal", "double")
        digits = 2 if f.name in layouts.DETAIL_SUMS else 4
        value = F.col(f.name).cast("decimal(38,10)") if f.dataType.typeName() == "double" else F.col(f.name)
        columns.append(shown(value, digits).alias(f.name) if numeric else F.col(f.name))
    return df.select(*columns)


def _frame(spark, sf_dir, profile: report.Profile, org: str) -> DataFrame:
    return report.report_frame(inputs.report_inputs(spark, sf_dir, org), inputs.DATE, profile)


@query(oracles.job(True, list(jobs.MONTHLY.detail_columns)))
def monthly_detail(spark, sf_dir):
    """Monthly job, detail report (B1, A1m)."""
    frame = _frame(spark, sf_dir, jobs.MONTHLY, "org_monthly_lines")
    return _job_output(report.detail(frame, jobs.MONTHLY))


@query(oracles.job(True, [*jobs.MONTHLY.consolidated_keys, *layouts.CONSOLIDATED_SUMS]))
def monthly_consolidated(spark, sf_dir):
    """Monthly job, consolidated report (B1, A2m)."""
    frame = _frame(spark, sf_dir, jobs.MONTHLY, "org_monthly_lines")
    return _job_output(report.consolidated(frame, jobs.MONTHLY))


@query(oracles.job(False, list(jobs.DAILY.detail_columns)))
def daily_detail(spark, sf_dir):
    """Daily job, detail report (B2, A1d)."""
    frame = _frame(spark, sf_dir, jobs.DAILY, "org_daily_lines")
    return _job_output(report.detail(frame, jobs.DAILY))


@query(oracles.job(False, [*jobs.DAILY.consolidated_keys, *layouts.CONSOLIDATED_SUMS]))
def daily_consolidated(spark, sf_dir):
    """Daily job run for both reports, consolidated from the stored detail (B2, A2d)."""
    return _job_output(jobs.daily(inputs.report_inputs(spark, sf_dir, "org_daily_lines"), inputs.DATE).consolidated)


# --- files -----------------------------------------------------------------------------

_CONTRACT_COLUMNS = [*layouts.JOIN_KEYS, *layouts.CONTRACT_ATTRIBUTES]


@query(
    with_(source("contracts"))
    + "\nselect " + ", ".join(f"cast({c} as varchar) as {c}" for c in _CONTRACT_COLUMNS) + " from in_contracts"
)
def snapshot_scan(spark, sf_dir):
    """A dated parquet snapshot written, then read by table and date."""
    root = staging_path(spark, "snapshots")
    contracts = inputs.frame(spark, sf_dir, "contracts").withColumn("fec_can_ant", F.lit(None).cast("string"))
    contracts.write.parquet(f"{root}/contracts/{inputs.DATE}")
    return read_snapshot(spark, root, "contracts", inputs.DATE)


@query(with_(source("portfolio_lines")) + "\nselect value from in_portfolio_lines")
def line_scan(spark, sf_dir):
    """Gzipped text lines read through a Latin-1 decoder."""
    path = staging_path(spark, "lines")
    inputs.frame(spark, sf_dir, "portfolio_lines").write.option("compression", "gzip").text(path)
    return read_lines(spark, path, "ISO-8859-1")


@query(
    with_(source("contracts"))
    + "\nselect " + ", ".join(f"coalesce(cast({c} as varchar), '') as {c}" for c in _CONTRACT_COLUMNS)
    + " from in_contracts"
)
def rules_file_roundtrip(spark, sf_dir):
    """A delimited report written, then read as a headed rule table."""
    path = staging_path(spark, "report")
    write_delimited(inputs.frame(spark, sf_dir, "contracts"), path)
    return read_rules(spark, path, _CONTRACT_COLUMNS)
