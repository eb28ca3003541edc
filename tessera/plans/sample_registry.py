"""A registry in miniature, derived from the star-schema tables, so that every operator runs on real rows.

The expressions are written once, in the part of SQL that both engines share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.catalog import VERTICAL_CNAE, vertical_cnae
from ..sources.registry import ESTABELECIMENTOS
from ..tables import table
from .oracle import values

_K = "c_custkey"


def _pick(by: str, *options) -> str:
    cell = lambda o: "NULL" if o is None else "'" + o + "'"
    return f"CASE {by} " + " ".join(f"WHEN {i} THEN {cell(o)}" for i, o in enumerate(options)) + " END"


_EST = {c: "CAST(NULL AS STRING)" for c in ESTABELECIMENTOS} | {
    "cnpj_basico": f"lpad(CAST({_K} AS STRING), 8, '0')",
    "cnpj_ordem": "'0001'",
    "cnpj_dv": f"lpad(CAST({_K} % 97 AS STRING), 2, '0')",
    "identificador_matriz_filial": _pick(f"{_K} % 4", "2", "1", "1", "1"),
    "nome_fantasia": _pick(f"{_K} % 8", "", "CASA DO SOM", "CASA DO SON", "12345678901", "OFICINA DE VIOLA 00000000000", "ESTUDIO DA BARRA", "ESCOLA DE MUSICA", "12.345.678 LUTHERIA"),
    "situacao_cadastral": _pick(f"{_K} % 6", "08", "02", "02", "02", "02", "02"),
    "cnae_fiscal_principal": _pick(f"{_K} % 9", "9521500", "4756300", "3220500", "8592903", "5920100", "9001906", "4712100", "4712100", "4712100"),
    "cnae_fiscal_secundaria": _pick(f"{_K} % 5", "4756300,9521500", "", "5912002, 7739003", None, "4712100,4756300"),
    "tipo_logradouro": _pick(f"{_K} % 4", "RUA", "AVENIDA", "PRACA", ""),
    "logradouro": _pick(f"{_K} % 3", "RUA DAS FLORES", "DO COMERCIO", "PRACA DA SE"),
    "numero": f"CAST({_K} % 3 AS STRING)",
    "complemento": _pick(f"{_K} % 3", "", "SALA 2", "FUNDOS"),
    "bairro": _pick(f"{_K} % 4", "CENTRO", "JARDIM DA SERRA", "", "VILA DO RIO"),
    "cep": _pick(f"{_K} % 5", "01310100", "20040-020", "4001000", "70.040-010", "01310100"),
    "uf": _pick("c_nationkey % 6", "SP", "RJ", "BA", "DF", "EX", "SP"),
    "municipio": "lpad(CAST(c_nationkey AS STRING), 4, '0')",
    "ddd_1": f"lpad(CAST({_K} % 100 AS STRING), 2, '0')",
    "telefone_1": f"lpad(CAST(({_K} * 7919) % 100000000 AS STRING), 8, '0')",
    "ddd_2": _pick(f"{_K} % 3", "11", "71", "00"),
    "telefone_2": f"CAST(30000000 + {_K} % 400 AS STRING)",
    "correio_eletronico": _pick(f"{_K} % 4", "Casa@GMAIL.com", "contato@som-e-luz.com.br ", "sem arroba", "a@uol.com.br"),
    "data_inicio_atividade": _pick(f"{_K} % 4", "20150302", "20240231", "2015", "19991231"),
}
_CNAES = (
    ("9521500", "Reparação de equipamentos eletroeletrônicos"), ("3319800", "Manutenção de equipamentos"), ("4756300", "Comércio varejista de instrumentos musicais"),
    ("3220500", "Fabricação de instrumentos musicais"), ("8592903", "Ensino de música"), ("5920100", "Atividades de gravação de som"), ("5912002", "Mixagem sonora"),
    ("9001906", "Sonorização e iluminação"), ("7739003", "Aluguel de palcos"), ("4712100", "Minimercados"),
)
_RAZAO = _pick(f"{_K} % 3", "SOM E LUZ LTDA", "12.345.678 ANA DE TAL", "ANA DE TAL 00000000000")
_EMPRESAS = {"cnpj_basico": _EST["cnpj_basico"], "razao_social": _RAZAO, "porte": _pick(f"{_K} % 5", "00", "01", "03", "05", "99")}
_SIMPLES = {"cnpj_basico": _EST["cnpj_basico"], "opcao_mei": _pick(f"{_K} % 5", "S", "N", "", "N", "N")}


def _select(columns: dict, tail: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + " " + tail


CTE = ",\n".join(
    f"{name} AS ({sql})"
    for name, sql in {
        "estabelecimentos": _select(_EST, "FROM customer"),
        "empresas": _select(_EMPRESAS, f"FROM customer WHERE {_K} % 11 <> 0"),
        "simples": _select(_SIMPLES, f"FROM customer WHERE {_K} % 2 = 0"),
        "municipios_rfb": "SELECT lpad(CAST(n_nationkey AS STRING), 4, '0') AS codigo_rfb, n_name AS nome_rfb FROM nation",
        "ibge_municipios": "SELECT CAST(3500000 + n_nationkey AS STRING) AS codigo_ibge, lower(n_name) AS nome, CASE n_nationkey % 6 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'BA' WHEN 3 THEN 'DF' WHEN 4 THEN 'EX' ELSE 'SP' END AS uf FROM nation WHERE n_nationkey % 4 <> 3",
        "cnaes": "SELECT * FROM " + values(_CNAES, "codigo, descricao"),
        "vertical_cnae": "SELECT * FROM " + values(VERTICAL_CNAE, "vertical, rotulo, cnae"),
    }.items()
)


def relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    pick = lambda df, cols: df.selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])
    from ..functions.text import slug

    ibge = nation.where("n_nationkey % 4 <> 3").selectExpr(
        "CAST(3500000 + n_nationkey AS STRING) AS codigo_ibge", "lower(n_name) AS nome",
        "CASE n_nationkey % 6 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'BA' WHEN 3 THEN 'DF' WHEN 4 THEN 'EX' ELSE 'SP' END AS uf",
    )
    return {
        "estabelecimentos": pick(customer, _EST),
        "empresas": pick(customer.where(f"{_K} % 11 <> 0"), _EMPRESAS),
        "simples": pick(customer.where(f"{_K} % 2 = 0"), _SIMPLES),
        "municipios_rfb": nation.selectExpr("lpad(CAST(n_nationkey AS STRING), 4, '0') AS codigo_rfb", "n_name AS nome_rfb"),
        "ibge_municipios": ibge.withColumn("nome_slug", slug("nome")),
        "cnaes": spark.createDataFrame(list(_CNAES), "codigo string, descricao string"),
        "vertical_cnae": vertical_cnae(spark),
    }
