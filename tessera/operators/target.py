"""The wide, publishable row of each target establishment, and the canonical export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import phones as P
from ..functions import text as T
from ..staging import stage
from .classify import ID
from .resolve import flag, look_alike_keys, suspected_duplicates


def record_card(*parts):
    """Lines of a card; a part that is null leaves no line."""
    return F.concat_ws("\n", *parts)


def establishments(estabelecimentos: DataFrame, target: DataFrame, empresas: DataFrame, simples: DataFrame, municipios: DataFrame, cnaes: DataFrame, safra: str, flagged: bool = True) -> DataFrame:
    """One row per target id, everything normalised and formatted.  Bad data turn to null, never drop a row.

    With ``flagged`` the look-alike search runs and its flag is a column.  The search reads keys
    of its own (``look_alikes``), made from a staged narrow table and not from the wide rows.
    """
    keys = target.select(*ID).distinct()
    rows = (
        estabelecimentos.join(keys, ID, "left_semi")
        .join(empresas.select("cnpj_basico", "razao_social", F.col("porte").alias("porte_codigo")), "cnpj_basico", "left")
        .join(simples.select("cnpj_basico", "opcao_mei"), "cnpj_basico", "left")
        .join(municipios.select(F.col("codigo_rfb").alias("municipio"), F.col("municipio").alias("cidade"), "municipio_slug", "ibge"), "municipio", "left")
        .join(cnaes.select(F.col("codigo").alias("cnae_fiscal_principal"), F.col("descricao").alias("cnae_principal_desc")), "cnae_fiscal_principal", "left")
    )
    # in steps, so that every expression is over plain columns and none is repeated inside another
    made = rows.select(
        F.concat(*ID).alias("id"), T.nome_publicavel("nome_fantasia").alias("__fantasia"), F.trim("razao_social").alias("razao_social"), T.nome_publicavel("razao_social").alias("__razao"),
        A.logradouro_completo("tipo_logradouro", "logradouro").alias("__rua"), T.blank_to_null(F.upper(F.trim("numero"))).alias("numero"), T.titulo_caso("complemento").alias("complemento"), T.titulo_caso("bairro").alias("bairro"),
        T.so_digitos("cep").alias("__cep"), F.col("cidade").alias("municipio"), "municipio_slug", "ibge", "uf", F.concat("cidade", F.lit("-"), "uf").alias("cidade_uf"),
        *[T.so_digitos(c).alias(f"__{c}") for c in ("ddd_1", "telefone_1", "ddd_2", "telefone_2")],
        F.lower(T.blank_to_null(F.trim("correio_eletronico"))).alias("email"), A.dominio_email("correio_eletronico").alias("dominio_email"),
        F.col("cnae_fiscal_principal").alias("cnae_principal"), "cnae_principal_desc", T.blank_to_null(F.col("cnae_fiscal_secundaria")).alias("cnaes_secundarios"),
        F.to_date(F.try_to_timestamp("data_inicio_atividade", F.lit("yyyyMMdd"))).alias("data_abertura"),
        "porte_codigo", A.porte_nome(F.col("porte_codigo")).alias("porte"), F.coalesce(F.col("opcao_mei") == "S", F.lit(False)).alias("mei"),
        (F.col("identificador_matriz_filial") == "1").alias("matriz"), "situacao_cadastral", F.lit(safra).alias("safra"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"),
    )
    named = lambda c: F.when(~F.col(c).rlike(r"\A[0-9]+\z"), F.col(c))
    made = made.select(
        "*", T.cnpj_formatado(F.col("id")).alias("cnpj_formatado"), named("__fantasia").alias("nome_fantasia"), named("__razao").alias("razao_social_publicavel"), T.titulo_caso("__rua").alias("__titulo"),
        T.blank_to_null(F.col("__cep")).alias("cep"), F.when(F.length("__cep") == 8, F.concat(F.substring("__cep", 1, 5), F.lit("-"), F.substring("__cep", 6, 3))).alias("cep_formatado"),
        P.e164_of_digits(F.col("__ddd_1"), F.col("__telefone_1")).alias("telefone"), P.e164_of_digits(F.col("__ddd_2"), F.col("__telefone_2")).alias("telefone_2"),
        A.dominio_provedor("dominio_email").alias("dominio_provedor"), A.site_candidato(F.col("dominio_email")).alias("site_candidato"),
    )
    made = made.select("*", A.abreviar_logradouro("__titulo").alias("logradouro"), F.coalesce("nome_fantasia", "razao_social_publicavel", F.concat(F.lit("CNPJ "), "cnpj_formatado")).alias("nome"))
    made = P.with_phone_columns(made.drop(*[c for c in made.columns if c.startswith("__")]), "telefone", "telefone_2")
    made = made.select(
        "*", F.concat_ws(" - ", F.concat_ws(", ", "logradouro", "numero"), "bairro").alias("endereco"),
        F.concat_ws(" - ", F.concat_ws(", ", "logradouro", "numero", "complemento"), "bairro").alias("endereco_com_complemento"),
    )
    line = lambda n: P.line_of(F.col(f"{n}_tipo"), F.col(f"{n}_formatado"), F.col(f"{n}_9_formatado"))
    made = made.select("*", record_card("nome_fantasia", "razao_social_publicavel", "endereco", "cidade_uf", F.concat(F.lit("CEP: "), "cep_formatado"), line("telefone"), line("telefone_2"), "email").alias("ficha"))
    return flag(made, look_alikes(estabelecimentos, keys, empresas, municipios), "id", "suspeita_duplicata") if flagged else made


def look_alikes(estabelecimentos: DataFrame, keys: DataFrame, empresas: DataFrame, municipios: DataFrame) -> DataFrame:
    """Ids of target establishments at one exact address with a look-alike name.

    The raw columns that name and address come from are staged once; the case trees over them
    are then over plain columns, each made once, and the wide rows are not made a second time.
    """
    raw = (
        estabelecimentos.join(keys, ID, "left_semi")
        .join(empresas.select("cnpj_basico", "razao_social"), "cnpj_basico", "left")
        .join(municipios.select(F.col("codigo_rfb").alias("municipio"), "municipio_slug"), "municipio", "left")
        .select(F.concat(*ID).alias("id"), "uf", "municipio_slug", "cep", "tipo_logradouro", "logradouro", "numero", "nome_fantasia", "razao_social")
    )
    rows = stage(raw, "addresses").select(
        "id", "uf", "municipio_slug", T.so_digitos("cep").alias("cep"), A.logradouro_completo("tipo_logradouro", "logradouro").alias("rua"), F.upper(F.trim("numero")).alias("numero"),
        T.nome_publicavel("nome_fantasia").alias("fantasia"), T.nome_publicavel("razao_social").alias("razao"),
    )
    named = stage(rows, "names").where("cep <> '' and rua is not null")
    digits_only = lambda c: F.col(c).rlike(r"\A[0-9]+\z")
    name = F.coalesce(F.when(~digits_only("fantasia"), F.col("fantasia")), F.when(~digits_only("razao"), F.col("razao")), F.concat(F.lit("CNPJ "), T.cnpj_formatado(F.col("id"))))
    made = named.select("id", "uf", "municipio_slug", "cep", T.titulo_caso("rua").alias("titulo"), F.col("numero"), name.alias("nome"))
    made = made.select("id", "uf", "municipio_slug", "cep", A.abreviar_logradouro("titulo").alias("logradouro"), "numero", "nome")
    return suspected_duplicates(stage(look_alike_keys(made), "lookalikes"))


def phones(estabelecimentos: DataFrame, target: DataFrame) -> DataFrame:
    """id, telefone, telefone_2 of each target id, as ``establishments`` gives them, and nothing else."""
    digits = [T.so_digitos(c).alias(c) for c in ("ddd_1", "telefone_1", "ddd_2", "telefone_2")]
    rows = estabelecimentos.join(target.select(*ID).distinct(), ID, "left_semi").select(F.concat(*ID).alias("id"), *digits)
    return rows.select("id", P.e164_of_digits(F.col("ddd_1"), F.col("telefone_1")).alias("telefone"), P.e164_of_digits(F.col("ddd_2"), F.col("telefone_2")).alias("telefone_2"))


def export(target: DataFrame, verticals: DataFrame) -> DataFrame:
    """id x vertical, the canonical row of every report and file."""
    return target.join(verticals.select("id", "vertical", F.col("rotulo").alias("vertical_rotulo"), "origem_cnae"), "id")


def publication(exported: DataFrame) -> DataFrame:
    """Rows with a page: not abroad, with a city; only the cleaned company name."""
    return exported.where("uf <> 'EX' and municipio_slug is not null").drop("razao_social", "cep").withColumnsRenamed({"razao_social_publicavel": "razao_social", "cep_formatado": "cep"}).orderBy(
        "vertical", "uf", "municipio_slug", "origem_cnae", F.asc_nulls_last("nome_fantasia"), F.asc_nulls_last("razao_social"), "id"
    )
