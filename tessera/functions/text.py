"""Normalisation of names and free text as column expressions (no UDF)."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stay lower case in a title, even as its first word.
PARTICLES = ("de", "da", "do", "das", "dos", "e", "em", "no", "na", "nos", "nas", "a", "o", "com", "sob", "sobre", "para", "por")


def _bare(form: str, text: str) -> str:
    return "".join(c for c in unicodedata.normalize(form, text) if unicodedata.category(c)[0] != "M")


def _folding(form: str) -> tuple[str, str]:
    """(characters, what is left of each) of all of Unicode that the form takes to one other character, marks aside.

    Marks come last, without anything that is left of them, so that ``translate`` drops them.
    Hangul syllables fall apart into letters, none of which is a mark: they are left alone.
    """
    pairs, marks = [], []
    for i in (*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x30000), *range(0xE0000, 0xE1000)):
        base = _bare(form, chr(i))
        if not base:
            marks.append(chr(i))
        elif len(base) == 1 and base != chr(i):
            pairs.append((chr(i), base))
    return "".join([a for a, _ in pairs] + marks), "".join(b for _, b in pairs)


_NFD = _folding("NFD")


def _text(t) -> Column:
    c = F.col(t) if isinstance(t, str) else t
    return F.coalesce(c.cast("string"), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def constant_list(values) -> Column:
    """Texts as one array literal; a literal for each would cost the driver a call apiece."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def constant_map(table: dict) -> Column:
    """Texts by texts as one map literal."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def so_digitos(t) -> Column:
    """Digits only; null gives an empty text."""
    return F.regexp_replace(_text(t), "[^0-9]", "")


def strip_accents(t: Column) -> Column:
    """Characters of all of Unicode without their marks, and no loose combining marks; ligatures and Hangul syllables stay."""
    # as many bytes as characters: nothing but ASCII, as most texts are
    return let(t, lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(F.translate(x, *_NFD)))


#: Compatibility characters that comparison also folds, beyond single letters.
_WIDE = [(chr(i), "".join(c for c in unicodedata.normalize("NFKD", chr(i)) if not unicodedata.combining(c))) for i in (*range(0x80, 0x250), 0x2122, 0x2026, *range(0xFB00, 0xFB07))]


_SINGLE = [(a, b) for a, b in _WIDE if len(b) == 1 and a != b]
_MULTIPLE = [(a, b) for a, b in _WIDE if len(b) > 1]


def comparable(t) -> Column:
    """Lower case, no accents, compatibility forms resolved, white space collapsed: for comparison only."""

    def folded(x: Column) -> Column:
        for a, b in _MULTIPLE:
            x = F.replace(x, F.lit(a), F.lit(b))
        return F.regexp_replace(F.translate(x, "".join(a for a, _ in _SINGLE), "".join(b for _, b in _SINGLE)), r"\p{Mn}", "")

    c = let(_text(t), lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(folded(x)))
    return F.lower(F.trim(F.regexp_replace(c, r"[\s\u00a0]+", " ")))


def slug(t) -> Column:
    """ASCII, lower case, hyphenated; null when nothing is left."""
    s = F.regexp_replace(F.lower(strip_accents(_text(t))), "[^a-z0-9]+", "-")
    return blank_to_null(F.btrim(s, F.lit("-")))


def titulo_caso(t) -> Column:
    """Each word with a capital, particles excepted; runs of spaces are kept."""
    words = F.split(F.lower(F.trim(_text(t))), " ")
    one = lambda w: F.when((w == "") | w.isin(*PARTICLES), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1)))
    return blank_to_null(F.array_join(F.transform(words, one), " "))


def caso_natural(t) -> Column:
    """Trimmed as it is if it has a lower-case letter, else in title case; blank gives null."""
    c = F.col(t) if isinstance(t, str) else t
    return F.when(blank_to_null(F.trim(_text(c))).isNull(), F.lit(None).cast("string")).when(c.rlike("[a-zà-ÿ]"), F.trim(c)).otherwise(titulo_caso(c))


def nome_publicavel(t) -> Column:
    """A name without a leading registry root (dd.ddd.ddd) and a trailing 11-digit personal number."""
    s = F.regexp_replace(_text(t), r"\A[0-9]{2}\.[0-9]{3}\.[0-9]{3}[\t\n\f\r ]+", "")
    return blank_to_null(F.trim(F.regexp_replace(s, r"[\t\n\f\r ]*[0-9]{11}\z", "")))


def texto_nome(t) -> Column:
    """A publishable name that is not digits only."""
    n = nome_publicavel(t)
    return F.when(~n.rlike(r"\A[0-9]+\z"), n)


def cnpj_formatado(id14: Column) -> Column:
    """14 characters as dd.ddd.ddd/dddd-dd."""
    part = lambda a, n: F.substring(id14, a, n)
    return F.concat(part(1, 2), F.lit("."), part(3, 3), F.lit("."), part(6, 3), F.lit("/"), part(9, 4), F.lit("-"), part(13, 2))
