"""Readers of the registry's delimited files, reference lists, brand files and raw bytes.

Every delimited file is read as text under a declared schema and fails on malformed rows;
leading zeros survive and nothing is inferred.  Raw files are read as bytes: lines are found
by byte ranges, stray control bytes go and the rest is decoded before anything is parsed, so
that one of them beside a quote or at a line end cannot change a record.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import stage

#: Column names in file order.
ESTABELECIMENTOS = (
    "cnpj_basico cnpj_ordem cnpj_dv identificador_matriz_filial nome_fantasia situacao_cadastral data_situacao_cadastral motivo_situacao_cadastral nome_cidade_exterior pais "
    "data_inicio_atividade cnae_fiscal_principal cnae_fiscal_secundaria tipo_logradouro logradouro numero complemento bairro cep uf municipio ddd_1 telefone_1 ddd_2 telefone_2 "
    "ddd_fax fax correio_eletronico situacao_especial data_situacao_especial"
).split()
EMPRESAS = "cnpj_basico razao_social natureza_juridica qualificacao_responsavel capital_social porte ente_federativo_responsavel".split()
SIMPLES = "cnpj_basico opcao_simples data_opcao_simples data_exclusao_simples opcao_mei data_opcao_mei data_exclusao_mei".split()
CODIGO = ["codigo", "descricao"]
MUNICIPIOS_RFB = ["codigo_rfb", "nome_rfb"]
POSTO = "fonte coletado_em posto_id nome uf_fonte cidade_fonte bairro endereco cep telefones email site contato horario segmento".split()

#: Relation -> (columns, file name pattern).  Files have no usual extension.
RELATIONS = {
    "estabelecimentos": (ESTABELECIMENTOS, "*.ESTABELE*"),
    "empresas": (EMPRESAS, "*.EMPRECSV*"),
    "simples": (SIMPLES, "*.SIMPLES.CSV.*"),
    "cnaes": (CODIGO, "*.CNAECSV*"),
    "municipios_rfb": (MUNICIPIOS_RFB, "*.MUNICCSV*"),
    "motivos": (CODIGO, "*.MOTICSV*"),
    "naturezas": (CODIGO, "*.NATJUCSV*"),
    "paises": (CODIGO, "*.PAISCSV*"),
    "qualificacoes": (CODIGO, "*.QUALSCSV*"),
}
#: Bytes that are dropped from text files before anything reads them.
DROPPED_BYTES = "\x00\x1a\x7f\x8f"


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


_CSV = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def read_delimited(spark: SparkSession, path: str, columns, pattern: str | None = None, encoding: str = "UTF-8", sep: str = ";", clean: bool = False) -> DataFrame:
    """A headerless file of quoted text columns; ``clean`` reads raw bytes (``read_raw``)."""
    if clean:
        return read_raw(spark, path, columns, pattern, encoding, sep)
    reader = spark.read.schema(text_schema(columns)).options(sep=sep, header=False, encoding=encoding, **_CSV)
    return _in_folder(reader, pattern).csv(path)


def _in_folder(reader, pattern: str | None):
    return reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True) if pattern else reader


def raw_lines(spark: SparkSession, path: str, pattern: str | None = None, encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines of raw files: path, line (bytes without the stray ones, decoded, without its carriage return).

    The text source hands on the bytes of a line as they are, from ranges of a file that begin
    and end anywhere; nothing has looked at them before the stray ones are gone.
    """
    rows = _in_folder(spark.read.option("lineSep", "\n"), pattern).text(path)
    kept = F.translate(F.decode(F.col("value").cast("binary"), encoding), DROPPED_BYTES, "")
    return rows.select(F.col("_metadata.file_path").alias("path"), F.rtrim(kept, F.lit("\r")).alias("line"))


def read_raw(spark: SparkSession, path: str, columns, pattern: str | None = None, encoding: str = "ISO-8859-1", sep: str = ";") -> DataFrame:
    """Raw files of quoted text columns, a record a line; a line that is no record of so many columns is an error."""
    lines = raw_lines(spark, path, pattern, encoding).where("trim(line) <> ''")
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv("line", schema, {"sep": sep, **_CSV}).alias("r")).select("r.*")


def read_relation(spark: SparkSession, root: str, name: str, raw: bool = False) -> DataFrame:
    """One relation of the registry under ``root``; ``raw`` files are Latin-1 with control bytes."""
    columns, pattern = RELATIONS[name]
    return read_delimited(spark, root, columns, pattern, "ISO-8859-1" if raw else "UTF-8", clean=raw)


def _plain(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).lower()


def find_columns(header: list[str], wanted: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """For each wanted name the first header that contains one of its keys; fails listing the header."""
    found = {}
    for name, keys in wanted.items():
        hit = next((h for k in keys for h in header if k in _plain(h)), None)
        if hit is None:
            raise ValueError(f"no column for {name} in {header}")
        found[name] = hit
    return found


#: Keys by which the columns of a list of municipalities are found.
IBGE_KEYS = {"codigo_ibge": ("codigo_ibge", "codigo", "id"), "nome": ("nome", "municipio"), "uf": ("uf", "sigla")}


#: Delimiters of lists with a header; of two that a header has as often the earlier is taken.
DELIMITERS = (";", ",", "\t", "|")


def dialects(lines: DataFrame, wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """How each file of ``lines(path, start, at, value)`` is written: path, its first line's at, sep, width, and the place of each wanted column.

    The first line is the header.  A wanted column is the first whose name holds the first of
    its keys that any name holds; its place is null if none does.
    """
    from ..functions.text import strip_accents

    head = lines.groupBy("path").agg(F.min_by(F.struct("at", "value"), F.struct("start", "at")).alias("h")).select("path", "h.at", F.regexp_replace("h.value", "\\A\ufeff", "").alias("value"))
    often = F.array(*[F.struct((F.length("value") - F.length(F.replace("value", F.lit(d)))).alias("n"), F.lit(-i).alias("first"), F.lit(d).alias("sep")) for i, d in enumerate(DELIMITERS)])
    head = head.withColumn("sep", F.array_max(often)["sep"])
    names = F.transform(F.split("value", F.concat(F.lit(r"\Q"), "sep", F.lit(r"\E"))), lambda x: F.lower(strip_accents(F.btrim(x, F.lit('" ')))))
    head = head.withColumn("names", names)
    place = lambda keys: F.coalesce(*[F.nullif(F.array_position(F.transform("names", lambda x: F.contains(x, F.lit(k))), True), F.lit(0)) for k in keys])
    return head.select("path", "at", "sep", F.size("names").alias("width"), F.array_join("names", ", ").alias("header"), *[(place(keys) - 1).cast("int").alias(f"at_{n}") for n, keys in wanted.items()])


def read_lists(spark: SparkSession, path: str, wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """The wanted columns, as text, of all files under ``path``, each read by its own delimiter and order of columns.

    The dialects are a table, one row a file, joined to the lines by their file.  A file that
    lacks a column is an error that lists its header; lines with fewer or more columns
    than the widest file are taken for what they have.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    known = stage(dialects(lines, wanted), "dialects")
    bad = known.where(" or ".join(f"at_{n} is null" for n in wanted)).limit(1).collect()
    if bad:
        lacks = [n for n in wanted if bad[0][f"at_{n}"] is None]
        raise ValueError(f"no column for {', '.join(lacks)} in {bad[0]['header']} of {bad[0]['path']}")
    width = known.agg(F.max("width")).first()[0] or 0
    schema = ", ".join(f"c{i} string" for i in range(width))
    rows = lines.join(known.withColumnRenamed("at", "head"), "path").where("at <> head and trim(value) <> ''")
    # a line is read by its file's delimiter; files are of few widths, those that are narrower leave columns empty
    made = F.coalesce(*[F.when(F.col("sep") == d, F.from_csv("value", schema, {"sep": d, **_CSV, "mode": "PERMISSIVE"})) for d in DELIMITERS])
    values = F.array(*[F.col("r")[f"c{i}"] for i in range(width)])
    return rows.withColumn("r", made).withColumn("v", values).select(*[F.get("v", F.col(f"at_{n}")).alias(n) for n in wanted])


def read_ibge(spark: SparkSession, path: str) -> DataFrame:
    """Lists of municipalities with a header, any of the usual delimiters and any order of columns: codigo_ibge, nome, uf, nome_slug."""
    from ..functions.text import slug

    return read_lists(spark, path, IBGE_KEYS).withColumn("nome_slug", slug("nome"))


def read_ibge_json(spark: SparkSession, path: str) -> DataFrame:
    """An array of flat objects with hyphenated keys, as the list of municipalities is published."""
    rows = spark.read.option("multiLine", True).schema("`municipio-id` long, `municipio-nome` string, `UF-sigla` string").json(path)
    return rows.select(F.col("`municipio-id`").cast("string").alias("codigo_ibge"), F.col("`municipio-nome`").alias("nome"), F.col("`UF-sigla`").alias("uf"))


def read_posts(spark: SparkSession, path: str, marca: DataFrame) -> DataFrame:
    """Shops of the collector's CSV whose source has a brand; the date is null where it is none."""
    rows = spark.read.schema(text_schema(POSTO)).options(header=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False).csv(path)
    return rows.join(marca.select("fonte").distinct(), "fonte", "left_semi").withColumn("coletado_em", F.try_to_date("coletado_em")).select(*POSTO)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole cached documents (HTML or JSON): path, text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def suspect_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Histogram of control bytes by file: path, byte (two hex digits), n.  Tab, line feed and return are none.

    The text source hands on the bytes of each line, and Latin-1 makes one character of each, so
    lines are enough and no file is held whole.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path", F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value"))
    found = lines.select(F.col("file_path").alias("path"), F.explode(control_characters(F.col("value"))).alias("c"))
    return found.groupBy("path", F.lower(F.lpad(F.hex(F.ascii("c")), 2, "0")).alias("byte")).agg(F.count(F.lit(1)).alias("n"))


def control_characters(text):
    """Control characters of a text as an array, repeats included."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"), F.lit(0))
