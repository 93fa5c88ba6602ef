"""Report inputs derived from the test tables.

Each input is one SQL text that Spark and DuckDB both run, with ``{table}``
standing for a test table. So both sides of a check start from the same rows,
and what is compared is the operators' work. Codes carry blanks, amounts carry
text, keys miss their partners and rule fields are empty, so that the operators
have something to do.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.report import Inputs

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

DATE = "20240131"


def line(*fields: tuple[int, str]) -> str:
    """SQL of a text line with each expression starting at its position."""
    text = "''"
    for start, expr in fields:
        text = f"rpad({text}, {start}, ' ') || ({expr})"
    return text


def _text(expr: str) -> str:
    return f"cast({expr} as string)"


def _code(prefix: str, key: str, width: int) -> str:
    return f"'{prefix}' || lpad({_text(key)}, {width}, '0')"


def _pick(key: str, *values: str) -> str:
    """CASE over the remainder of a key: one value per remainder."""
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case ({key}) % {len(values)} {whens} end"


_PRICE = "cast(l_extendedprice as decimal(18,2))"
_QTY = "cast(l_quantity as decimal(18,2))"
_DISC = "cast(l_discount as decimal(18,2))"
_TAX = "cast(l_tax as decimal(18,2))"

_CONTENT = _pick(
    "l_orderkey + l_linenumber",
    "'CRE'", "'PRE  '", "'CCO'", "' ARF'", "'CAP'", "'COM'", "'COM '", "'CTA'", "'PLZ'",
    "' PLZ '", "'CTG'", "'FON'", "'CCL'", "'ZZZ'",
)
_PERSON = "case when {k} % 3 = 0 then '10033' || cast({k} as string) else cast({k} as string) end"

#: Amounts stored as double: measures that hold them follow double arithmetic.
DOUBLE_AMOUNTS = {"imp_efec_enc_ml_acum"}

_AMOUNT_SQL = {
    "imp_sdo_cap_med_ml": _PRICE,
    "imp_sdo_med_int_ml": f"{_PRICE} * {_DISC}",
    "imp_sdo_med_insolv_ml": f"-({_PRICE} * {_TAX})",
    "imp_sdo_cap_ml": f"{_PRICE} + {_QTY}",
    "imp_sdo_int_ml": f"{_QTY} * {_DISC}",
    "imp_sdo_insolv_ml": f"-({_QTY} * {_TAX})",
    "imp_ing_per_ml": f"{_PRICE} * {_TAX}",
    # text, and now and then no number
    # text with nine decimals, and now and then no number
    "imp_ing_cap_ml": f"""case when l_linenumber = 7 and l_returnflag = 'A' then 'n/a' else ' ' || cast(cast(
        cast({_QTY} as decimal(20,9)) + cast(l_orderkey % 7 as decimal(20,9)) * cast(0.000000001 as decimal(20,9)) as decimal(20,9)) as string) end""",
    "imp_egr_per_ml": f"-({_PRICE} * {_DISC} * {_TAX})",
    "imp_egr_cap_ml": f"case when l_linenumber = 6 and l_returnflag = 'R' then null else -{_QTY} end",
    "imp_ajtti_egr_tb_cap_ml": f"{_DISC} * 3",
    "imp_ajtti_egr_sl_cap_ml": f"{_TAX} * 5",
    "imp_ajtti_egr_per_ml": f"-({_DISC} * {_QTY})",
    "imp_ajtti_ing_tb_cap_ml": f"{_DISC} * {_TAX}",
    "imp_ajtti_ing_sl_cap_ml": f"{_QTY} - 25",
    "imp_ajtti_ing_per_ml": f"{_TAX} * {_QTY}",
    "imp_efec_enc_ml": f"{_DISC} - {_TAX}",
}


def _facts() -> str:
    amounts = {}
    for name, expr in _AMOUNT_SQL.items():
        text = name == "imp_ing_cap_ml"
        amounts[name] = expr if text else f"cast({expr} as decimal(18,6))"
        if "ajtti" in name or "efec" in name:
            kind = "double" if name + "_acum" in DOUBLE_AMOUNTS else "decimal(18,6)"
            amounts[name + "_acum"] = f"cast(({expr}) * 2 as {kind})"
    attributes = {
        "idf_cto_ods": _code("K", "l_orderkey", 9),
        "fec_data": f"'{DATE} '",
        "cod_contenido": _CONTENT,
        "idf_pers_ods": _PERSON.format(k="o_custkey"),
        "cod_entidad_espana": "'0033'",
        "cod_producto_gest": "' ' || " + _text("l_partkey"),
        "cod_cta_cont_gestion": _code("C", "l_suppkey", 5),
        "cod_segmento_gest": "o_orderpriority",
        "cod_area_negocio": _code("AR", "l_suppkey", 6),
        "cod_tip_ajuste": "l_linestatus",
        "cod_centro_cont": _pick("l_suppkey", "'0001'", "'0002'", "'0003'"),
        "cod_ofi_comercial": _pick("l_suppkey", "'011234'", "'1'", "'xx12'", "'0212'"),
        "ind_conciliacion": _pick("l_linenumber", "'M'", "'N'", "null"),
        "cod_origen_inf": _pick("l_partkey", "'BAL'", "'AJU'"),
        "out_tti": _text(_DISC),
        "cod_est_sdo": "o_orderstatus",
        "tasa_base": _text(_TAX),
        "origen_tasa": _pick("l_orderkey", "'R'", "'S'"),
        "cod_sis_origen": _pick("l_orderkey + l_suppkey", "''", "'  '", "'GL'", "null"),
        "ind_pool": _pick("l_partkey", "'P'", "'Q'", "''"),
        "tipo_tasa_adis": _pick(
            "l_orderkey", "'6'", "'06'", "'7'", "'A'", "'B'", "'C'", "''", "null", "'6.0'", "' 7.00'", "'+6'"
        ),
        "spread_liq": f"cast({_TAX} + 1 as string)",
        "tip_concepto_ctb": "l_returnflag",
        **amounts,
    }
    columns = ",\n  ".join(f"{expr} as {name}" for name, expr in attributes.items())
    return f"select\n  {columns}\nfrom {{lineitem}} join {{orders}} on l_orderkey = o_orderkey"


_TOTAL = "cast(o_totalprice as decimal(18,2))"


def _contracts() -> str:
    attributes = {
        "idf_cto_ods": _code("K", "o_orderkey", 9),
        "fec_data": f"'{DATE}'",
        "cod_contenido": "content",
        "cod_producto": _pick("o_orderkey", "'P1'", "'P2'", "'P3'"),
        "tas_predef": _text("o_orderkey % 13"),
        "cod_subprodu": _pick("o_orderkey", "'S1'", "'S2'"),
        "fec_alta_cto": _text("cast(o_orderdate as date)"),
        "fec_ven": "'2030-12-31'",
        "fec_can_ant": "null",
        "imp_ini_mo": f"'R$ ' || {_text(_TOTAL)}",
        "tas_int": f"{_text('o_orderkey % 17')} || '.123456789'",
        "cod_complemento": "o_orderpriority",
        "imp_cuo_ini_mo": _text("o_orderkey % 100"),
        "imp_cuo_mo": _text("o_orderkey % 90"),
        "num_cuo_pac": _text("o_orderkey % 48"),
        "plz_contractual": _text("o_orderkey % 360"),
        "cod_cur_ref": "'CDI '",
        "cod_met_amrt": _pick("o_orderkey", "'SAC'", "'PRICE'"),
        "num_dia_demora": _text("o_orderkey % 30"),
        "plz_med_rec": _text("o_orderkey % 60"),
        "cod_bca_int": "'252'",
        "fec_prx_liq": "'2024-02-29'",
        "fec_ult_liq": "'2024-01-31'",
        "por_cupon": f"{_text('o_orderkey % 11')} || '.5'",
        "por_util_ind": f"{_text('o_orderkey % 19')} || '.25'",
        "cod_cartera_gestion": _code("PF", "o_custkey", 8),
        "cod_tip_tas": _pick("o_orderkey", "'V'", "'F'", "'V '", "null"),
    }
    columns = ",\n  ".join(f"{expr} as {name}" for name, expr in attributes.items())
    per_content = f"select distinct l_orderkey, {_CONTENT} as content from {{lineitem}}"
    return f"select\n  {columns}\nfrom {{orders}} join ({per_content}) c on o_orderkey = c.l_orderkey"


_PV_CODE = _pick(
    "c_custkey",
    _code("CPV", "c_custkey % 150", 6),
    _code("CP", "c_custkey % 150", 6),
    _code("", "c_custkey % 150", 5),
    _code("", "c_custkey % 150", 6),
)


def _portfolio(tag: str, level2: str, level3: str) -> str:
    fields = [
        (2, f"'{tag}'"),
        (8, _code("PF", "c_custkey", 8)),
        (33, "'R' || " + _text("n_regionkey")),
        (58, _pick("c_custkey", "'N' || " + _text("n_nationkey"), _code("PF", "c_custkey", 8), "'N'")),
        (83, level2),
        (108, level3),
        (383, _pick("c_custkey", "'TOPO'", "'CARTEIRA TOPO'")),
        (483, _pick("c_custkey", "n_name", "n_name", "n_name", "n_name", "'CARTEIRA ' || n_name")),
        (583, "c_mktsegment"),
        (683, _pick("c_custkey", "'CARTEIRA A'", "'MINHA CARTEIRA'", "'CARTEIRA'", "c_name", "c_name")),
    ]
    return f"select {line(*fields)} as value from {{customer}} join {{nation}} on c_nationkey = n_nationkey"


SQL: dict[str, str] = {
    "facts": _facts(),
    "contracts": _contracts(),
    "clients": f"""select {_PERSON.format(k='c_custkey')} as IDF_PERS_ODS,
  {_code('CPF', 'c_custkey', 8)} as idf_cliente,
  case when c_custkey % 17 = 0 then null else '  ' || c_name || ' ' end as nom_nombre,
  {_pick('c_nationkey', "'F'", "'J'")} as cod_tip_persona
from {{customer}}""",
    "area_lines": "select " + line(
        (2, _pick("s_suppkey", *["'JAN02'"] * 10, "'JAN01'")),
        (8, _code("AR", "s_suppkey", 6)),
        (188, "'R' || " + _text("r_regionkey")),
        (203, _pick("s_suppkey", "'N' || " + _text("n_nationkey"), _code("AR", "s_suppkey", 6))),
        (218, _pick("s_suppkey", *[_code("AR", "s_suppkey", 6)] * 4, "'NONE'")),
        (1333, _pick("r_regionkey", "'TBP - ' || r_name", "'REG BP - ' || r_name", "r_name")),
        (1433, _pick("n_nationkey", "'NAT BP – ' || n_name", "n_name")),
        (1533, _pick("s_suppkey", "'TBP - ' || s_name", "s_name", "'X BP - BP – ' || s_name", "s_name")),
    ) + " as value from {supplier} join {nation} on s_nationkey = n_nationkey"
        " join {region} on n_regionkey = r_regionkey",
    "portfolio_lines": _portfolio(
        "JCRPV", _PV_CODE, _code("PF", "c_custkey", 8)
    ) + "\nunion all\n" + _portfolio(
        "JCRGE", _code("GM", "c_custkey % 50", 4), _pick("c_custkey", _code("PF", "c_custkey", 8), "''", "'X'")
    ),
    "product_tree_lines": "select " + line(
        (3, "case when p_partkey = 0 then 'ROOT' else " + _text("cast(floor(p_partkey / 3) as bigint)") + " end"),
        (23, _text("p_partkey")),
        (43, _pick(
            "p_size", "'LIN BP - ' || p_brand || ' ' || " + _text("p_partkey"), "p_name", "p_name",
            "'TBP - ' || p_name", "p_name", "'BP – ' || p_name", *["p_name"] * 9,
        )),
        (143, _pick("p_partkey", *["'JPBMG'"] * 28, "'JPBXX'")),
    ) + " as value from {part}",
    "product_flat_lines": "select " + line(
        (2, "'JBLDN'"),
        (8, _text("p_partkey")),
        (419, _pick("p_partkey", "'NIVEL ' || p_brand", "'NIVEL ' || p_brand", "''", "'OUTRO'")),
    ) + " as value from {part}",
    "org_monthly_lines": "select " + line(
        (0, _pick("s_suppkey", *["'1'"] * 12, "'0'")),
        (2, _pick("s_suppkey", "'033'", "'0033'", "'0044'")),
        (10, f"substring({_code('', 's_suppkey', 6)}, 1, 2)"),
        (12, f"substring({_code('', 's_suppkey', 6)}, 3, 4)"),
        (16, "'CAR'"),
        (61, "'U' || " + _text("s_nationkey")),
        (65, _code("", "s_suppkey % 1000", 4)),
        (69, "'N'"),
    ) + " as value from {supplier}",
    "org_daily_lines": "select " + line(
        (0, _pick("s_suppkey", *["'1'"] * 12, "'0'")),
        (1, _code("", "s_suppkey % 1000", 4)),
        (5, f"substring({_code('', 's_suppkey', 6)}, 3, 4)"),
        (9, _pick("s_suppkey", "'033'", "'0033'", "'0044'")),
        (13, f"substring({_code('', 's_suppkey', 6)}, 1, 2)"),
        (16, "'U' || " + _text("s_nationkey % 10")),
    ) + " as value from {supplier}",
    "sign_rules": """select 'A' as Conceito_Contabil, 'NIVEL ' || p_brand as Balanco_LDN_Nivel_3,
  case when p_brand < 'Brand#2' then '-1' when p_brand < 'Brand#3' then '0.33333'
    when p_brand < 'Brand#4' then '1000000' else '1' end as Criterio_de_Sinais
from {part} group by p_brand
union all
select 'R', 'NIVEL ' || p_brand, case when p_brand < 'Brand#15' then '-1' else 'x' end
from {part} group by p_brand
union all
select 'N', 'OUTRO', '-1' from {part} group by p_type""",
    "exception_rules": f"""select
  {_pick('s_suppkey', "''", _text('s_suppkey * 3'), "''", "''", "''", _text('s_suppkey * 5'))} as Linha_BP_ORIGEM,
  {_pick('s_suppkey', "''", "''", _text('s_suppkey * 3'), "''", _text('s_suppkey * 2'), _text('s_suppkey'))} as Produto_Gestao_ORIGEM,
  {_pick('s_suppkey', "''", "''", "''", _code('C', 's_suppkey', 5), _code('C', 's_suppkey', 5), _code('C', 's_suppkey', 5))} as CONTA_DE_GESTAO,
  {_text('(s_suppkey % 10) * 5')} as Linha_BP_PARA
from {{supplier}}""",
}


def tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = SQL[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables_of(sql)})


def report_inputs(spark: SparkSession, sf_dir: str, org: str) -> Inputs:
    names = [n for n in Inputs.__dataclass_fields__ if n != "org_lines"]
    frames = {n: frame(spark, sf_dir, n) for n in names}
    return Inputs(**frames, org_lines=frame(spark, sf_dir, org))


def duck(sql: str) -> str:
    """The DuckDB text of an input: tables are views of their own names."""
    return sql.format(**{t: t for t in TABLES})
