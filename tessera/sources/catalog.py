"""Inline relations: service verticals with their activity codes, and brand networks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Fixed values: (vertical, label, activity code).
VERTICAL_CNAE = (
    ("assistencia-tecnica", "Assistência técnica", "9521500"),
    ("assistencia-tecnica", "Assistência técnica", "3319800"),
    ("lojas-de-instrumentos-musicais", "Lojas de instrumentos musicais", "4756300"),
    ("luthier", "Luthiers", "3220500"),
    ("escolas-de-musica", "Escolas de música", "8592903"),
    ("estudios-de-gravacao", "Estúdios de gravação", "5920100"),
    ("estudios-de-gravacao", "Estúdios de gravação", "5912002"),
    ("locacao-som-palco", "Palcos, som e locação", "9001906"),
    ("locacao-som-palco", "Palcos, som e locação", "7739003"),
    ("locacao-som-palco", "Palcos, som e locação", "7729202"),
)


def vertical_cnae(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VERTICAL_CNAE), "vertical string, rotulo string, cnae string")


def networks(spark: SparkSession, sources: dict[str, dict]) -> DataFrame:
    """fonte, titular, pagina, termo, bloqueada of a catalogue {source: fields}."""
    rows = [(k, v.get("titular"), v.get("pagina"), v.get("termo"), v.get("bloqueada")) for k, v in sources.items()]
    return spark.createDataFrame(rows, "fonte string, titular string, pagina string, termo string, bloqueada string")


def brands(spark: SparkSession, catalogue: dict[str, dict], sources: dict[str, dict]) -> DataFrame:
    """marca, marca_nome, fonte of the brands whose source is not blocked; an unknown source is an error."""
    for slug, m in catalogue.items():
        if m["fonte"] not in sources:
            raise ValueError(f"{slug}: unknown source {m['fonte']}")
    rows = [(k, m["nome"], m["fonte"]) for k, m in catalogue.items() if not sources[m["fonte"]].get("bloqueada")]
    return spark.createDataFrame(rows, "marca string, marca_nome string, fonte string")
