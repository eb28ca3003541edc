"""Expressions in ANSI-like SQL for an independent check of the column functions."""

from __future__ import annotations

# Fixed values, stated here a second time: a slip in the engine's own tables then shows as a difference.
DDD_OF_STATE = (
    "AC 68, AL 82, AM 92 97, AP 96, BA 71 73 74 75 77, CE 85 88, DF 61, ES 27 28, GO 62 64, MA 98 99, MG 31 32 33 34 35 37 38, MS 67, MT 65 66, PA 91 93 94, "
    "PB 83, PE 81 87, PI 86 89, PR 41 42 43 44 45 46, RJ 21 22 24, RN 84, RO 69, RR 95, RS 51 53 54 55, SC 47 48 49, SE 79, SP 11 12 13 14 15 16 17 18 19, TO 63"
)
UF_BY_DDD = {d: line.split()[0] for line in DDD_OF_STATE.split(", ") for d in line.split()[1:]}
STATES = (
    "Acre AC, Alagoas AL, Amapá AP, Amazonas AM, Bahia BA, Ceará CE, Distrito Federal DF, Espírito Santo ES, Goiás GO, Maranhão MA, Mato Grosso MT, Mato Grosso do Sul MS, "
    "Minas Gerais MG, Pará PA, Paraíba PB, Paraná PR, Pernambuco PE, Piauí PI, Rio de Janeiro RJ, Rio Grande do Norte RN, Rio Grande do Sul RS, Rondônia RO, Roraima RR, "
    "Santa Catarina SC, São Paulo SP, Sergipe SE, Tocantins TO"
)
UF_NOME = {x[-2:]: x[:-3] for x in STATES.split(", ")}
PARTICLES = "a com da das de do dos e em na nas no nos o para por sob sobre".split()
STREETS = [("Rua ", "R. "), ("Avenida ", "Av. "), ("Praca ", "Pç. "), ("Travessa ", "Tv. "), ("Alameda ", "Al. "), ("Estrada ", "Estr. "), ("Rodovia ", "Rod. "), ("Largo ", "Lgo. ")]
PORTE = {"00": "não informado", "01": "microempresa", "03": "empresa de pequeno porte", "05": "demais"}
PROVIDERS = (
    "126 163 abv aol bol brturbo click21 daum fastmail folha free globo globomail gmai gmail gmx googlemail hotmai hotmail hotmial hush ibest icloud ig inbox interia itelefonica "
    "laposte libero list live mac mail me msn mynet naver oi onda onet orange outlook pm pop proton protonmail qq r7 rocketmail seznam sfr superig t-online terra tutanota uol "
    "velox wanadoo web wp yahoo yandex ymail zipmail zipmail.com zoho"
).split()


def quote(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def values(rows, columns: str) -> str:
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else quote(v)
    return "(VALUES " + ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows) + f") AS t({columns})"


def digits(e: str) -> str:
    return f"regexp_replace(coalesce({e}, ''), '[^0-9]', '', 'g')"


def e164(d: str, n: str) -> str:
    d, n = digits(d), digits(n)
    known = ", ".join(quote(x) for x in sorted(UF_BY_DDD))
    return f"CASE WHEN length({d}) = 2 AND {d} IN ({known}) AND length({n}) IN (8, 9) AND rtrim({n}, substr({n}, 1, 1)) <> '' THEN '+55' || {d} || {n} END"


def phone_type(e: str) -> str:
    d = digits(e)
    return f"CASE WHEN length({d}) = 13 THEN 'movel' WHEN length({d}) <> 12 THEN NULL WHEN {d}[5:5] BETWEEN '2' AND '5' THEN 'fixo' WHEN {d}[5:5] BETWEEN '6' AND '9' THEN 'movel' END"


def ninth(e: str) -> str:
    d = digits(e)
    return f"CASE WHEN length({d}) = 12 AND {d}[5:5] BETWEEN '6' AND '9' THEN '+55' || {d}[3:4] || '9' || {d}[5:12] END"


def shown(e: str) -> str:
    d = digits(e)
    return f"CASE WHEN length({d}) = 13 THEN '(' || {d}[3:4] || ') ' || {d}[5:9] || '-' || {d}[10:13] WHEN length({d}) = 12 THEN '(' || {d}[3:4] || ') ' || {d}[5:8] || '-' || {d}[9:12] END"


def phone_line(e: str) -> str:
    both = f"coalesce({shown(ninth(e))} || ' ou ' || {shown(e)}, {shown(e)})"
    return f"CASE {phone_type(e)} WHEN 'fixo' THEN 'Tel: ' || {shown(e)} WHEN 'movel' THEN 'Cel: ' || {both} END"


def phone_key(e: str) -> str:
    return f"coalesce({ninth(e)}, {e})"


def slug(e: str) -> str:
    return f"nullif(trim(regexp_replace(lower(strip_accents(coalesce({e}, ''))), '[^a-z0-9]+', '-', 'g'), '-'), '')"


def plain(e: str) -> str:
    return f"lower(trim(regexp_replace(strip_accents(coalesce({e}, '')), '\\s+', ' ', 'g')))"


def title(e: str) -> str:
    keep = ", ".join(quote(w) for w in PARTICLES)
    return f"nullif(array_to_string(list_transform(str_split(lower(trim(coalesce({e}, ''))), ' '), lambda w: CASE WHEN w = '' OR w IN ({keep}) THEN w ELSE upper(w[1:1]) || w[2:] END), ' '), '')"


def natural(e: str) -> str:
    return f"CASE WHEN nullif(trim(coalesce({e}, '')), '') IS NULL THEN NULL WHEN regexp_matches({e}, '[a-zà-ÿ]') THEN trim({e}) ELSE {title(e)} END"


def clean_name(e: str) -> str:
    return f"nullif(trim(regexp_replace(regexp_replace(coalesce({e}, ''), '^[0-9]{{2}}\\.[0-9]{{3}}\\.[0-9]{{3}}\\s+', ''), '\\s*[0-9]{{11}}$', '')), '')"


def shown_name(e: str) -> str:
    n = clean_name(e)
    return f"CASE WHEN NOT regexp_matches({n}, '^[0-9]+$') THEN {n} END"


def short_street(e: str) -> str:
    cases = " ".join(f"WHEN starts_with({e}, {quote(a)}) THEN {quote(b)} || {e}[{len(a) + 1}:]" for a, b in STREETS)
    return f"CASE {cases} ELSE {e} END"


def street(t: str, n: str) -> str:
    t, n = f"trim(coalesce({t}, ''))", f"trim(coalesce({n}, ''))"
    return f"nullif(trim(CASE WHEN {n} = '' THEN {t} WHEN {t} = '' OR starts_with(upper({n}), upper({t}) || ' ') OR upper({n}) = upper({t}) THEN {n} ELSE {t} || ' ' || {n} END), '')"


def postal(e: str) -> str:
    d = digits(e)
    return f"CASE WHEN length({d}) = 8 THEN {d}[1:5] || '-' || {d}[6:8] END"


def mail_domain(e: str) -> str:
    return f"nullif(regexp_extract(lower(trim(coalesce({e}, ''))), '@([a-z0-9.-]+\\.[a-z]{{2,}})$', 1), '')"


def provider(e: str) -> str:
    names = "|".join(p.replace(".", "\\.") for p in PROVIDERS)
    return f"({e} IS NULL OR regexp_matches({e}, '^(www\\.)?({names})\\.[a-z.]+$'))"


def own_site(e: str) -> str:
    return f"CASE WHEN NOT {provider(e)} THEN 'https://' || {e} END"


def company_size(e: str) -> str:
    return f"CASE {e} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in PORTE.items()) + " END"


def cnpj(e: str) -> str:
    return f"{e}[1:2] || '.' || {e}[3:5] || '.' || {e}[6:8] || '/' || {e}[9:12] || '-' || {e}[13:14]"


def state(e: str) -> str:
    e = plain(e)
    names = " ".join(f"WHEN {e} IN ({quote(k.lower())}, lower(strip_accents({quote(v)}))) THEN {quote(k)}" for k, v in UF_NOME.items())
    return f"CASE {names} ELSE '' END"


def state_of_ddd(d: str) -> str:
    return f"CASE {d} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in UF_BY_DDD.items()) + " END"
