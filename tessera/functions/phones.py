"""Brazilian phone numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import so_digitos

#: Area codes in use, by state.
DDD_BY_UF = {
    "SP": "11 12 13 14 15 16 17 18 19", "RJ": "21 22 24", "ES": "27 28", "MG": "31 32 33 34 35 37 38", "PR": "41 42 43 44 45 46", "SC": "47 48 49",
    "RS": "51 53 54 55", "DF": "61", "GO": "62 64", "TO": "63", "MT": "65 66", "MS": "67", "AC": "68", "RO": "69", "BA": "71 73 74 75 77", "SE": "79",
    "PE": "81 87", "AL": "82", "PB": "83", "RN": "84", "CE": "85 88", "PI": "86 89", "PA": "91 93 94", "AM": "92 97", "RR": "95", "AP": "96", "MA": "98 99",
}
UF_BY_DDD = {d: uf for uf, codes in DDD_BY_UF.items() for d in codes.split()}
DDDS = tuple(sorted(UF_BY_DDD))


def ddd_valido(d) -> Column:
    return (F.col(d) if isinstance(d, str) else d).isin(*DDDS)


def e164_of_digits(d: Column, n: Column) -> Column:
    alike = F.rtrim(n, F.substring(n, 1, 1)) == ""
    return F.when((F.length(d) == 2) & ddd_valido(d) & F.length(n).isin(8, 9) & ~alike, F.concat(F.lit("+55"), d, n))


def telefone_e164(ddd, numero) -> Column:
    """+55, area code and number; null unless the code is in use and 8 or 9 digits follow that are not all alike."""
    return e164_of_digits(so_digitos(ddd), so_digitos(numero))


# The functions of digits expect a plain column, so that nothing is computed twice however often they use it.


def type_of_digits(d: Column) -> Column:
    local = F.substring(d, 5, 1)
    return F.when(F.length(d) == 13, "movel").when(F.length(d) != 12, F.lit(None)).when(local.between("2", "5"), "fixo").when(local.between("6", "9"), "movel")


def ninth_of_digits(d: Column) -> Column:
    """Digits with the ninth one put in, null unless an 8-digit mobile."""
    return F.when((F.length(d) == 12) & F.substring(d, 5, 1).between("6", "9"), F.concat(F.substring(d, 1, 4), F.lit("9"), F.substring(d, 5, 8)))


def shown_digits(d: Column) -> Column:
    show = lambda k: F.concat(F.lit("("), F.substring(d, 3, 2), F.lit(") "), F.substring(d, 5, k), F.lit("-"), F.substring(d, 5 + k, 4))
    return F.when(F.length(d) == 13, show(5)).when(F.length(d) == 12, show(4))


def line_of(kind: Column, shown: Column, shown_ninth: Column) -> Column:
    both = F.concat(shown_ninth, F.lit(" ou "), shown)
    return F.when(kind == "fixo", F.concat(F.lit("Tel: "), shown)).when(kind == "movel", F.concat(F.lit("Cel: "), F.coalesce(both, shown)))


def tipo_telefone(e164) -> Column:
    """'fixo', 'movel' or null, by length and the first local digit."""
    return type_of_digits(so_digitos(e164))


def telefone_com_nono_digito(e164) -> Column:
    """An 8-digit mobile with the ninth digit in front; null for anything else."""
    d = so_digitos(e164)
    return F.when((F.length(d) == 12) & F.substring(d, 5, 1).between("6", "9"), F.concat(F.lit("+55"), F.substring(d, 3, 2), F.lit("9"), F.substring(d, 5, 8)))


def telefone_exibicao(e164) -> Column:
    """(DD) NNNN-NNNN or (DD) NNNNN-NNNN."""
    return shown_digits(so_digitos(e164))


def linha_telefone(e164) -> Column:
    """'Tel: ...' or 'Cel: new ou old'; null without a type."""
    d = so_digitos(e164)
    return line_of(type_of_digits(d), shown_digits(d), shown_digits(ninth_of_digits(d)))


def fone_chave(e164) -> Column:
    """Key under which old and new forms of a mobile meet."""
    c = F.col(e164) if isinstance(e164, str) else e164
    return F.coalesce(telefone_com_nono_digito(c), c)


def with_phone_columns(rows, *names: str):
    """``rows`` with type, display and ninth-digit forms of each E.164 column, in steps over plain columns."""
    rows = rows.select("*", *[F.substring(n, 2, 20).alias(f"__{n}") for n in names])  # E.164 without its plus sign
    rows = rows.select("*", *[ninth_of_digits(F.col(f"__{n}")).alias(f"__{n}_9") for n in names])
    made = []
    for n in names:
        d, nine = F.col(f"__{n}"), F.col(f"__{n}_9")
        made += [type_of_digits(d).alias(f"{n}_tipo"), shown_digits(d).alias(f"{n}_formatado"), F.concat(F.lit("+"), nine).alias(f"{n}_9"), shown_digits(nine).alias(f"{n}_9_formatado")]
    return rows.select("*", *made).drop(*[f"__{n}{x}" for n in names for x in ("", "_9")])
