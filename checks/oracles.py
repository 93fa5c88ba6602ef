"""DuckDB SQL for every query that SQL can express, written row by row.

These texts say what a result means in the plainest way: OR joins, real
repetition of rows, a recursive climb. They share only the input texts with the
Spark side.
"""

from __future__ import annotations

from checks import inputs
from ledgerline import layouts

_BLANKS = "' ' || chr(9) || chr(10) || chr(13)"


def trim(expr: str) -> str:
    return f"trim({expr}, {_BLANKS})"


def slice_(at: tuple[int, int], of: str = "value") -> str:
    return trim(f"substr({of}, {at[0] + 1}, {at[1] - at[0]})")


def slices(positions: list[tuple[int, int]]) -> str:
    return "[" + ", ".join(slice_(p) for p in positions) + "]"


def source(name: str) -> str:
    return f"in_{name} as (\n{inputs.duck(inputs.SQL[name])}\n)"


def with_(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes)


def out(expr: str, digits: int = 2) -> str:
    """An amount as a double both engines print alike."""
    return f"cast(round({expr}, {digits}) as double)"


# --- hierarchies ---------------------------------------------------------------

_TAGGED = "{0} as (select * from in_{1} where {2} = '{3}')"

AREAS = f"""areas as (
  select codigo, case when pos is null or label is null then ''
      when contains(label, 'BP -') then substr(label, instr(label, 'BP -'))
      else substr(label, instr(label, 'BP –')) end as label
  from (
    select codigo, pos, list_filter(list_slice(descs, coalesce(pos, 1), 14),
        lambda d: not contains(d, 'TBP') and (contains(d, 'BP -') or contains(d, 'BP –')))[1] as label
    from (
      select *, nullif(coalesce(list_position(codes, codigo), 0), 0) as pos
      from (
        select {slice_(layouts.AREA_CODE)} as codigo,
          {slices(layouts.AREA_CODES)} as codes,
          {slices(layouts.AREA_DESCS)} as descs
        from in_area_lines where {slice_((2, 7))} = 'JAN02'))))"""

_PV_CASES = "\n".join(
    f"      when contains(descs[{i + 1}], 'CARTEIRA') then codes[{i}]" for i in range(1, 14)
)
PORTFOLIOS_PV = f"""pv as (
  select code, case
{_PV_CASES}
      else code end as pv_code
  from (
    select {slice_(layouts.PORTFOLIO_CODE)} as code,
      {slices(layouts.PORTFOLIO_CODES)} as codes,
      {slices(layouts.PORTFOLIO_DESCS)} as descs
    from in_portfolio_lines where {slice_((2, 8))} = 'JCRPV'))"""

MANAGERS = f"""managers as (
  select code, case when code = codes[4] then codes[3]
      when code = codes[3] or code = codes[2] or code = codes[1] then 'GER19999'
      else '' end as manager
  from (
    select {slice_(layouts.PORTFOLIO_CODE)} as code, {slices(layouts.PORTFOLIO_CODES)} as codes
    from in_portfolio_lines where {slice_((2, 8))} = 'JCRGE'))"""

PRODUCT_LABELS = f"""product_labels as (
  select {slice_(layouts.PRODUCT_FLAT_CODE)} as code, {slice_(layouts.PRODUCT_FLAT_LABEL)} as label
  from in_product_flat_lines where {slice_((2, 7))} = 'JBLDN')"""

EDGES = f"""edges as (
  select distinct child, parent,
    case when contains(d, 'BP') and not contains(d, 'TBP') then substr(d, instr(d, 'BP')) else d end as descr
  from (
    select {slice_(layouts.PRODUCT_CHILD)} as child, {slice_(layouts.PRODUCT_PARENT)} as parent,
      {slice_(layouts.PRODUCT_DESC)} as d
    from in_product_tree_lines where {slice_((143, 162))} = 'JPBMG'))"""


def climb(edges: str = "edges", name: str = "product_lines") -> str:
    """Every path climbed step by step; (child, line, label) as a bag."""
    marked = "(contains({0}, 'BP -') or (contains({0}, 'BP –') and not contains({0}, 'TBP')))"
    return f"""climb as (
  select child, parent as look, 0 as steps, cast(null as varchar) as line, cast(null as varchar) as label
  from {edges} where not {marked.format('descr')}
  union all
  select c.child, n.parent, c.steps + 1,
    case when n.child is null then 'FORABP' when {marked.format('n.descr')} then n.child end,
    case when n.child is null then 'FORABP' when {marked.format('n.descr')} then n.descr end
  from climb c left join {edges} n on n.child = c.look
  where c.line is null and c.steps < 15
),
{name} as (
  select child, child as line, descr as label from {edges} where {marked.format('descr')}
  union all
  select child, coalesce(line, 'FORABP'), coalesce(label, 'FORABP') from climb
  where (line is not null or steps = 15) and (coalesce(line, 'FORABP') <> 'FORABP' or child <> '')
)"""


# --- measures ------------------------------------------------------------------

_RATE = "decimal(28,10)"


# Wide enough for every amount of the check inputs (at most nine decimals) and every factor (five).
_AMOUNT, _FACTOR = "decimal(30,9)", "decimal(18,5)"


def number(expr: str, kind: str = _AMOUNT) -> str:
    return f"try_cast(trim(cast({expr} as varchar)) as {kind})"


def measure(cols: list[str], sign: str = "sign") -> str:
    if any(c in inputs.DOUBLE_AMOUNTS for c in cols):
        total = " + ".join(number(c, "double") for c in cols)
        return f"(({total}) * cast({sign} as double))"
    total = " + ".join(number(c) for c in cols)
    return f"(({total}) * cast({sign} as {_FACTOR}))"


SIGN = f"case when r.Criterio_de_Sinais is null then 1 else try_cast(trim(r.Criterio_de_Sinais) as {_FACTOR}) end"


def _is(expr: str, n: int) -> str:
    return f"coalesce(try_cast({expr} as bigint) = {n}, false)"


CUPOM_TC = f"""case when {_is('tipo_tasa_adis', 6)} or tipo_tasa_adis = 'A' then por_cupon
    when {_is('tipo_tasa_adis', 7)} or tipo_tasa_adis = 'B' then por_util_ind else '' end"""
CUPOM_TTI = f"""case when {_is('tipo_tasa_adis', 6)} or {_is('tipo_tasa_adis', 7)} then spread_liq
    when tipo_tasa_adis = 'A' or tipo_tasa_adis = 'B' then tas_predef else '' end"""
CD_SIST = """case when cod_sis_origen <> '' then cod_sis_origen
    when ind_conciliacion = 'M' then 'MN' else cod_contenido end"""


def difference(a: str, b: str) -> str:
    return f"try_cast({a} as {_RATE}) - try_cast({b} as {_RATE})"


SPREAD = f"""case
    when cod_contenido = 'CRE' or cod_contenido = 'PRE' or cod_contenido = 'CCO' or cod_contenido = 'ARF'
      or cod_contenido = 'CAP' or cod_contenido = 'COM' and cod_tip_tas = 'V'
      then {difference('Cupom_tc', 'Cupom_tti')}
    when cod_contenido = 'CTA' or cod_contenido = 'PLZ' and cod_tip_tas = 'V'
      then {difference('Cupom_tc', 'Cupom_tti')}
    when cod_contenido = 'PLZ' and cod_tip_tas = 'F' then {difference('out_tti', 'tas_int')}
    when cod_contenido = 'COM' and cod_tip_tas = 'F' then {difference('tas_int', 'out_tti')}
    end"""
SPREAD_GROUPED = f"""case
    when cod_contenido in ('CRE', 'PRE', 'CCO', 'ARF', 'CAP', 'COM') and cod_tip_tas = 'V'
      then {difference('Cupom_tc', 'Cupom_tti')}
    when cod_contenido in ('CTA', 'PLZ') and cod_tip_tas = 'V' then {difference('Cupom_tc', 'Cupom_tti')}
    when cod_contenido in ('CTA', 'PLZ') and cod_tip_tas = 'F' then {difference('out_tti', 'tas_int')}
    when cod_contenido in ('CRE', 'PRE', 'CCO', 'ARF', 'CAP', 'COM') and cod_tip_tas = 'F'
      then {difference('tas_int', 'out_tti')}
    end"""


def strip_prefix(expr: str, width: int, value: int) -> str:
    return f"case when {_is(f'substr({expr}, 1, {width})', value)} then substr({expr}, {width + 1}) else {expr} end"


# --- the jobs ------------------------------------------------------------------


def _trimmed(name: str, columns: list[str], extra: str = "") -> str:
    cols = ", ".join(f"{trim(f'cast({c} as varchar)')} as {c}" for c in columns)
    return f"{name} as (select {cols}{extra} from in_{name})"


FACTS = _trimmed(
    "facts", [*layouts.FACT_ATTRIBUTES, layouts.FACT_CONCEPT],
    ", " + ", ".join(f"{trim(f'cast({c} as varchar)')} as {c}" for c in layouts.AMOUNTS),
)
CONTRACTS = _trimmed("contracts", [*layouts.JOIN_KEYS, *layouts.CONTRACT_ATTRIBUTES])
CLIENTS = _trimmed("clients", [layouts.PERSON_KEY, *layouts.CLIENT_ATTRIBUTES])

SIGNED = f"""signed as (
  select f.* exclude ({", ".join(layouts.AMOUNTS)}),
    {", ".join(f"{measure(cols, SIGN)} as {name}" for name, cols in layouts.MEASURES.items())}
  from facts f left join product_labels p on f.cod_producto_gest = p.code
  left join in_sign_rules r on f.tip_concepto_ctb = r.Conceito_Contabil and p.label = r.Balanco_LDN_Nivel_3)"""

UNIT = """case length(pv_code) when 9 then substr(pv_code, 4) when 8 then substr(pv_code, 3)
  when 5 then '0' || pv_code else pv_code end"""


def org(layout: list[tuple[str, int]], lines: str, keys, superior, entity: str) -> str:
    at = {}
    start = 0
    for name, width in layout:
        at[name] = slice_((start, start + width))
        start += width
    return f"""org as (
  select {at[keys[0]]} as org_type, {at[keys[1]]} as org_code, {at[superior[0]]} || {at[superior[1]]} as superior
  from in_{lines} where value like '1%' and {at[entity]} in ('033', '0033'))"""


OVERRIDDEN = """overridden as (
  select j.* exclude (line, label),
    case when t.Linha_BP_PARA is null then j.line else t.Linha_BP_PARA end as line,
    case when t.Linha_BP_PARA is null then j.label else n.label end as label
  from lined j
  left join in_exception_rules t on j.line is not null and (
    j.line = t.Linha_BP_ORIGEM or j.cod_producto_gest = t.Produto_Gestao_ORIGEM
    or j.cod_cta_cont_gestion = t.CONTA_DE_GESTAO)
  left join product_lines n on t.Linha_BP_PARA = n.line)"""


def job_ctes(monthly: bool) -> str:
    if monthly:
        org_cte = org(layouts.ORG_MONTHLY, "org_monthly_lines", ("TP_CRAL", "CD_CRAL"), ("TP_UOR", "CD_UOR"), "CD_ENTI")
        keep = contracts = "true"
    else:
        org_cte = org(layouts.ORG_DAILY, "org_daily_lines", ("TP-CRAL", "CTR-ALT"), ("TP-ORG", "COD-ORG"), "ENTIDAD")
        keep = "f.cod_contenido in ('COM','PLZ','ARF','CCL','CCO','CRE','CTA','CTB','CTG','FON','PRE')"
        contracts = "g.cod_contenido in ('ARF','CCO','COM','CRE','CTA','CTG','FON','PLZ','PRE')"
    names = dict((src, name) for name, src in layouts.REPORT_COLUMNS)
    special = {
        "Data_Extracao": f"'{inputs.DATE}'",
        "idf_pers_ods": strip_prefix("idf_pers_ods", 5, 10033),
        "cod_ofi_comercial": strip_prefix("cod_ofi_comercial", 2, 1),
        "Codigo_Linha_BP": "line",
        "Linha_BP": "label",
    }

    def column(src: str) -> str:
        name = names[src]
        expr = special.get(src, src)
        if monthly and name in layouts.ROUNDING:
            digits = layouts.ROUNDING[name]
            if name in ("Valor_do_Contrato", "Taxa_Contrato", "Taxa_Captacao"):
                expr = f"try_cast(regexp_replace({expr}, '[^-0-9.]', '', 'g') as {_RATE})"
            expr = f"round({expr}, {digits})"
        return f"{expr} as {name}"

    final = ",\n    ".join(column(src) for _, src in layouts.REPORT_COLUMNS)
    return with_(
        *[source(n) for n in ("facts", "contracts", "clients", "area_lines", "portfolio_lines",
                              "product_tree_lines", "product_flat_lines",
                              "org_monthly_lines" if monthly else "org_daily_lines",
                              "sign_rules", "exception_rules")],
        AREAS, PORTFOLIOS_PV, MANAGERS, PRODUCT_LABELS, EDGES, climb(), org_cte,
        FACTS, CONTRACTS, CLIENTS, SIGNED,
        f"""joined as (
  select f.*, g.* exclude ({", ".join(layouts.JOIN_KEYS)}), k.* exclude ({layouts.PERSON_KEY})
  from signed f join contracts g using ({", ".join(layouts.JOIN_KEYS)})
  join clients k using ({layouts.PERSON_KEY})
  where {keep} and {contracts})""",
        f"rated as (select *, {CUPOM_TC} as Cupom_tc, {CUPOM_TTI} as Cupom_tti, {CD_SIST} as Cd_Sist from joined)",
        f"spreaded as (select *, {SPREAD} as Spread from rated)",
        """lined as (select s.*, l.line, l.label from spreaded s
  left join product_lines l on s.cod_producto_gest = l.child)""",
        OVERRIDDEN,
        f"""placed as (
  select o.*, a.label as Area_de_Negocio_Reporting, pv_code as Cod_Carteira_PV, manager as Ger_Matr,
    superior as Superior_Carteira_Uniorg
  from overridden o
  left join areas a on o.cod_area_negocio = a.codigo
  left join pv on o.cod_cartera_gestion = pv.code
  left join managers m on o.cod_cartera_gestion = m.code
  left join org on substr({UNIT}, 1, 2) = org_type and substr({UNIT}, 3) = org_code)""",
        f"report as (select\n    {final}\n  from placed)",
    )


def _shown(columns: list[str], monthly: bool) -> str:
    shown = []
    for c in columns:
        numeric = {"Spread", "Resultado_Ficticio_Acum"}
        if monthly:
            numeric |= {"Valor_do_Contrato", "Taxa_Contrato", "Taxa_Captacao"}
        if c in layouts.DETAIL_SUMS:
            shown.append(f"{out(f'sum({c})')} as {c}")
        elif c in numeric:
            doubled = any(a in inputs.DOUBLE_AMOUNTS for a in layouts.MEASURES.get(c, []))
            shown.append(f"{out(f'cast({c} as decimal(38,10))' if doubled else c, 4)} as {c}")
        elif c == "Fonte":
            shown.append("'' as Fonte")
        else:
            shown.append(c)
    return ", ".join(shown)


def job(monthly: bool, columns: list[str]) -> str:
    keys = [c for c in columns if c not in layouts.DETAIL_SUMS and c != "Fonte"]
    return f"{job_ctes(monthly)}\nselect {_shown(columns, monthly)}\nfrom report group by {', '.join(keys)}"
