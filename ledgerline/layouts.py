"""Fixed values of the report: file layouts, word lists, column names and digits.

Everything here is data that has to be exactly this for results to be right.
Positions are 0-based, half-open ``(start, end)`` slices of a text line.
"""

from __future__ import annotations

# --- fixed values: hierarchy lines -------------------------------------------

LEVELS = 14


def level_slices(first: int, step: int, width: int) -> list[tuple[int, int]]:
    """Slices of the 14 levels: ``width`` characters every ``step`` characters."""
    return [(first + step * i, first + step * i + width) for i in range(LEVELS)]


# The last character of each level slot is a separator and is not read.
AREA_TAG = ((2, 7), "JAN02")
AREA_CODE = (8, 23)
AREA_CODES = level_slices(218, -15, 14)  # deepest level first
AREA_DESCS = level_slices(1533, -100, 99)  # deepest level first

PORTFOLIO_PV_TAG = ((2, 8), "JCRPV")
PORTFOLIO_MANAGER_TAG = ((2, 8), "JCRGE")
PORTFOLIO_CODE = (8, 33)
PORTFOLIO_CODES = level_slices(33, 25, 24)  # top level first
PORTFOLIO_DESCS = level_slices(383, 100, 99)  # top level first

PRODUCT_TREE_TAG = ((143, 162), "JPBMG")
PRODUCT_PARENT = (3, 22)
PRODUCT_CHILD = (23, 42)
PRODUCT_DESC = (43, 142)

PRODUCT_FLAT_TAG = ((2, 7), "JBLDN")
PRODUCT_FLAT_CODE = (8, 22)
PRODUCT_FLAT_LABEL = (419, 518)

LINE_MARKERS = ("BP -", "BP –")
LINE_SKIP = "TBP"
LINE_WORD = "BP"
PORTFOLIO_WORD = "CARTEIRA"
NO_MANAGER = "GER19999"
NO_LINE = "FORABP"
MAX_CLIMB = 15

# --- fixed values: organisation records --------------------------------------

ORG_PREFIX = "1"
ORG_ENTITIES = ("033", "0033")

ORG_MONTHLY = [
    ("TP_REGISTRO", 1), ("ID_ACAO", 1), ("CD_ENTI", 4), ("CD_CART", 4),
    ("TP_CRAL", 2), ("CD_CRAL", 4), ("TP_CART", 3), ("DH_INCL_REGT", 26),
    ("CD_USUA_GERE", 8), ("CD_PESS_GERE", 8), ("TP_UOR", 4), ("CD_UOR", 4),
    ("FLAG_INDIC_INCIDENTE", 1), ("CD_UNID_NEGO", 3), ("CD_CENT_CUST", 4),
    ("TP_SITU_CART", 1), ("DT_MUDA_SITU", 10), ("CD_SEGM_GERE", 3),
    ("CD_MATR_GERE", 8), ("IN_CART_GERE_GERL", 1), ("QT_ATIV_CRTT", 9),
    ("QT_NAO_ATIV_CRTT", 9), ("QT_NAO_CRTT", 9), ("CD_PORT_AGEN", 8),
    ("CD_USUA_INCL_REGT", 8), ("DTH_INCL_REGT", 26), ("CD_USUA_ULTI_ATLZ", 8),
    ("CD_TERN_ULTI_ATLZ", 4), ("CD_SUCR_ULTI_ATLZ", 4), ("DH_ULTI_ATLZ", 26),
]

ORG_DAILY = [
    ("TIP_REG", 1), ("COD-ORG", 4), ("CTR-ALT", 4), ("ENTIDAD", 4),
    ("TP-CRAL", 3), ("TP-ORG", 3),
]

# --- fixed values: rule files -------------------------------------------------

SIGN_RULES = ["Conceito_Contabil", "Balanco_LDN_Nivel_3", "Criterio_de_Sinais"]
EXCEPTION_RULES = [
    "Linha_BP_ORIGEM", "Produto_Gestao_ORIGEM", "CONTA_DE_GESTAO", "Linha_BP_PARA",
]

# --- fixed values: content codes ----------------------------------------------

DAILY_FACT_CONTENTS = [
    "COM", "PLZ", "ARF", "CCL", "CCO", "CRE", "CTA", "CTB", "CTG", "FON", "PRE",
]
DAILY_CONTRACT_CONTENTS = [
    "ARF", "CCO", "COM", "CRE", "CTA", "CTG", "FON", "PLZ", "PRE",
]

# --- fixed values: prefixes removed from codes --------------------------------

PERSON_PREFIX = (5, 10033)  # width, value compared as a number
OFFICE_PREFIX = (2, 1)

# --- fixed values: measures ---------------------------------------------------

_INCOME = ["imp_ing_per_ml", "imp_ing_cap_ml"]
_EXPENSE = ["imp_egr_per_ml", "imp_egr_cap_ml"]
_INCOME_ADJ = [
    "imp_ajtti_ing_tb_cap_ml", "imp_ajtti_ing_sl_cap_ml", "imp_ajtti_ing_per_ml",
]
_EXPENSE_ADJ = [
    "imp_ajtti_egr_tb_cap_ml", "imp_ajtti_egr_sl_cap_ml", "imp_ajtti_egr_per_ml",
]
_CHARGE = ["imp_efec_enc_ml"]

MEASURES = {
    "Volume": [
        "imp_sdo_cap_med_ml", "imp_sdo_med_int_ml", "imp_sdo_med_insolv_ml",
    ],
    "Saldo_ponta": ["imp_sdo_cap_ml", "imp_sdo_int_ml", "imp_sdo_insolv_ml"],
    "Resultado_Total_ml": _INCOME + _EXPENSE + _EXPENSE_ADJ + _INCOME_ADJ + _CHARGE,
    "Receita": _INCOME + _INCOME_ADJ + _CHARGE,
    "Custo": _EXPENSE + _EXPENSE_ADJ,
    "Resultado_Real": _INCOME + _EXPENSE,
    "Res_ficticio": _INCOME_ADJ + _EXPENSE_ADJ + _CHARGE,
    "Resultado_Ficticio_Acum": [
        c + "_acum" for c in _INCOME_ADJ + _CHARGE + _EXPENSE_ADJ
    ],
}
AMOUNTS = sorted({c for cols in MEASURES.values() for c in cols})

DETAIL_SUMS = [
    "Volume", "Saldo_ponta", "Resultado_Total_ml", "Receita", "Custo",
    "Resultado_Real", "Res_ficticio",
]
CONSOLIDATED_SUMS = DETAIL_SUMS[:5]

# --- fixed values: monthly rounding digits ------------------------------------

ROUNDING = {
    "Volume": 4, "Saldo_ponta": 4, "Valor_do_Contrato": 4, "Resultado_Total_ml": 4,
    "Receita": 5, "Custo": 4, "Taxa_Contrato": 5, "Taxa_Captacao": 5, "Spread": 5,
}

# --- fixed values: input columns ----------------------------------------------

JOIN_KEYS = ["idf_cto_ods", "fec_data", "cod_contenido"]
PERSON_KEY = "idf_pers_ods"

FACT_ATTRIBUTES = JOIN_KEYS + [
    PERSON_KEY, "cod_entidad_espana", "cod_producto_gest", "cod_cta_cont_gestion",
    "cod_segmento_gest", "cod_area_negocio", "cod_tip_ajuste", "cod_centro_cont",
    "cod_ofi_comercial", "ind_conciliacion", "cod_origen_inf", "out_tti",
    "cod_est_sdo", "tasa_base", "origen_tasa", "cod_sis_origen", "ind_pool",
    "tipo_tasa_adis", "spread_liq",
]
FACT_CONCEPT = "tip_concepto_ctb"

CONTRACT_ATTRIBUTES = [
    "cod_producto", "tas_predef", "cod_subprodu", "fec_alta_cto", "fec_ven",
    "fec_can_ant", "imp_ini_mo", "tas_int", "cod_complemento", "imp_cuo_ini_mo",
    "imp_cuo_mo", "num_cuo_pac", "plz_contractual", "cod_cur_ref", "cod_met_amrt",
    "num_dia_demora", "plz_med_rec", "cod_bca_int", "fec_prx_liq", "fec_ult_liq",
    "por_cupon", "por_util_ind", "cod_cartera_gestion", "cod_tip_tas",
]
CLIENT_ATTRIBUTES = ["idf_cliente", "nom_nombre", "cod_tip_persona"]

# --- fixed values: report columns as (report name, source column), in order ----

REPORT_COLUMNS = [
    ("Data_Extracao", "Data_Extracao"),
    ("Ref", "fec_data"),
    ("Banco", "cod_entidad_espana"),
    ("Contrato", "idf_cto_ods"),
    ("Cpf_cnpj", "idf_cliente"),
    ("Penumper", "idf_pers_ods"),
    ("Nome_Cliente", "nom_nombre"),
    ("Tp_Pessoa", "cod_tip_persona"),
    ("Produto", "cod_producto"),
    ("Subpro", "cod_subprodu"),
    ("Produto_Gestao", "cod_producto_gest"),
    ("Conta_Gestao", "cod_cta_cont_gestion"),
    ("Segto", "cod_segmento_gest"),
    ("Dimensao_AdN", "cod_area_negocio"),
    ("Area_de_Negocio_Reporting", "Area_de_Negocio_Reporting"),
    ("Codigo_Linha_BP", "Codigo_Linha_BP"),
    ("Linha_BP", "Linha_BP"),
    ("Criterio_de_Ajuste", "cod_tip_ajuste"),
    ("Centro_Contable", "cod_centro_cont"),
    ("Cli_Carte", "cod_cartera_gestion"),
    ("Ger_Matr", "Ger_Matr"),
    ("Agencia", "cod_ofi_comercial"),
    ("Cod_Carteira_PV", "Cod_Carteira_PV"),
    ("Indicador_Conciliacao", "ind_conciliacion"),
    ("Origem_Informacao", "cod_origen_inf"),
    ("Cd_Sist", "Cd_Sist"),
    ("Conteudo", "cod_contenido"),
    ("Data_Formalizacao", "fec_alta_cto"),
    ("Data_Vencimento", "fec_ven"),
    ("Data_Liq_Antecip", "fec_can_ant"),
    ("Valor_do_Contrato", "imp_ini_mo"),
    ("Volume", "Volume"),
    ("Saldo_ponta", "Saldo_ponta"),
    ("Resultado_Total_ml", "Resultado_Total_ml"),
    ("Receita", "Receita"),
    ("Custo", "Custo"),
    ("Taxa_Contrato", "tas_int"),
    ("Taxa_Captacao", "out_tti"),
    ("Spread", "Spread"),
    ("Resultado_Real", "Resultado_Real"),
    ("Res_ficticio", "Res_ficticio"),
    ("Cod_Complemento", "cod_complemento"),
    ("Cupom_tc", "Cupom_tc"),
    ("Cupom_tti", "Cupom_tti"),
    ("Ind_Remarcagem", "origen_tasa"),
    ("Valor_Parcela_Inicial", "imp_cuo_ini_mo"),
    ("Valor_Parcela", "imp_cuo_mo"),
    ("Qtde_Total_Parcelas", "num_cuo_pac"),
    ("Prazo_Contratual", "plz_contractual"),
    ("Curva_Referencia", "cod_cur_ref"),
    ("Metodo_Amortizacao", "cod_met_amrt"),
    ("Qtde_Dias_Atraso", "num_dia_demora"),
    ("Ind_Fixo_Variavel", "cod_tip_tas"),
    ("Tipo_Taxa_Adis", "tipo_tasa_adis"),
    ("Prazo_Medio_Receb", "plz_med_rec"),
    ("Base_Periodificacao_TC", "cod_bca_int"),
    ("Superior_Carteira_Uniorg", "Superior_Carteira_Uniorg"),
    ("Resultado_Ficticio_Acum", "Resultado_Ficticio_Acum"),
    ("Indicador_Pool", "ind_pool"),
    ("Estado_Saldo", "cod_est_sdo"),
    ("Taxa_Base", "tasa_base"),
    ("Data_Prx_Liq", "fec_prx_liq"),
    ("Data_Ult_Liq", "fec_ult_liq"),
]

CONSOLIDATED_KEYS = [
    "Data_Extracao", "Ref", "Tp_Pessoa", "Produto_Gestao", "Conta_Gestao", "Segto",
    "Dimensao_AdN", "Area_de_Negocio_Reporting", "Codigo_Linha_BP", "Linha_BP",
    "Criterio_de_Ajuste", "Centro_Contable", "Cli_Carte", "Cod_Carteira_PV",
    "Indicador_Conciliacao", "Origem_Informacao", "Indicador_Pool",
]
