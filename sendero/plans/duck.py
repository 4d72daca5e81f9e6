"""The text functions again, as DuckDB expressions for the oracles. Ñ does not occur in oracle data."""

from __future__ import annotations

from functools import reduce

from sendero.functions import classify, geo, text
from sendero.plans.sender import SENDERS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def strip(x: str) -> str:
    return sub(f"coalesce({x}, '')", r"^\s+|\s+$")


def squeeze(x: str) -> str:
    return f"trim({sub(x, r'\s+', ' ')})"


def folded(x: str, table: tuple[str, str] = text.KEEP_ENIE) -> str:
    return f"translate({x}, {q(table[0])}, {q(table[1])})"


def clean_text(x: str) -> str:
    t = folded(f"upper({strip(x)})")
    t = f"""translate({t}, '་"“”''‘’', ' ')"""
    t = sub(sub(sub(t, "[–—]", "-"), r"\([^)]*\)"), r"\|")
    return f"trim({sub(sub(sub(t, r'\s+', ' '), r'^[.,;:\-\s]+'), r'[.,;:\-\s]+$')})"


def norm_keep(x: str) -> str:
    return squeeze(sub(folded(f"upper({strip(x)})"), r"[^A-Z0-9Ñ\s]", " "))


def norm_fold(x: str) -> str:
    return squeeze(sub(folded(f"upper({strip(x)})", text.FOLD_ALL), r"[.,;:\-/]+", " "))


def norm_registry(x: str) -> str:
    return squeeze(sub(folded(f"upper({strip(x)})", text.FOLD_COMPAT), r"[^A-Za-z0-9_\s]", " "))


def norm_city(x: str) -> str:
    return squeeze(folded(f"upper({strip(x)})", text.FOLD_ALL))


def norm_audit(x: str) -> str:
    return squeeze(sub(norm_city(x), "[^A-Z0-9ÑÁÉÍÓÚ ]", " "))


def replace_ordinals(x: str) -> str:
    return reduce(lambda t, r: sub(t, *r), text.ordinal_rules(), x)


def extract(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def entity_type(x: str) -> str:
    rules = " ".join(f"WHEN {matches(x, yes)}{f' AND NOT {matches(x, no)}' if no else ''} THEN '{name}'" for name, yes, no in classify.TYPES)
    return f"CASE {rules} ELSE '{classify.OTHER}' END"


def subtype(kind: str, x: str) -> str:
    rules = " ".join(f"WHEN {' AND '.join([f'{kind} = {q(of)}', *(matches(x, p) for p in patterns)])} THEN '{name}'" for of, some in classify.SUBTYPES.items() for name, patterns in some)
    return f"CASE {rules} WHEN {kind} = 'MINISTERIO' THEN substring(trim({extract(x, 'MINISTERIO(.*)$')}), 1, 25) ELSE '' END"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) = 0 AND length({b}) = 0 THEN 1.0::DOUBLE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0::DOUBLE WHEN abs(length({a}) - length({b}))::DOUBLE / greatest(length({a}), length({b})) > 0.4 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END"


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(q(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


#: c: distinct senders cleaned (clean), with type, subtype and number.
CLASSIFIED = f"""{SENDERS}, c0 AS (SELECT *, {clean_text("raw")} AS clean FROM u), c1 AS (SELECT *, {entity_type("clean")} AS tipo, {replace_ordinals("clean")} AS numbered FROM c0),
c AS (SELECT raw, n, seen, clean, numbered, tipo, {subtype("tipo", "clean")} AS subtipo, CASE WHEN tipo IN ('JUZGADO', 'FISCALIA') THEN {extract("numbered", r"\b(\d+)\b")} ELSE '' END AS numero FROM c1)"""
#: Name tables, hits of names in the cleaned senders, and the two-pass location as l(raw, municipio, departamento).
GEO = f"""gd(departamento, ord) AS (VALUES {values([(d, i) for i, d in enumerate(geo.DEPARTMENTS)])}),
gdn AS (SELECT {folded("upper(departamento)")} AS norm, departamento, ord FROM gd),
ga(norm, departamento, ord) AS (VALUES {values([(a, d, i) for i, (a, d) in enumerate(geo.DEPT_ALIASES)])}),
gm(municipio, departamento, ord) AS (VALUES {values([(m, d, i) for i, (m, d) in enumerate(geo.MUNICIPALITIES)])}),
gmn AS (SELECT {folded("upper(municipio)")} AS norm, municipio, departamento, ord FROM gm),
gp(norm, departamento) AS (VALUES {values(geo.PREFERRED)}),
gc(norm, municipio, departamento, ord) AS (VALUES {values([(a, m, d, 10_000 + i) for i, (a, m, d) in enumerate(geo.CITY_ALIASES)])}),
gall AS (SELECT norm, municipio, departamento, ord, CASE WHEN EXISTS (SELECT 1 FROM gp WHERE gp.norm = gmn.norm AND gp.departamento = gmn.departamento) THEN 1 ELSE 2 END AS rank, ord AS place FROM gmn UNION ALL SELECT norm, municipio, departamento, ord, 0, -ord FROM gc),
db AS (SELECT norm, municipio, departamento, first AS ord FROM (SELECT *, min(ord) OVER (PARTITION BY norm) AS first, row_number() OVER (PARTITION BY norm ORDER BY rank, place) AS rn FROM gall) WHERE rn = 1),
dh AS (SELECT raw, departamento, row_number() OVER (PARTITION BY raw ORDER BY rank, ord) AS rn FROM (SELECT raw, departamento, -length(norm) AS rank, ord FROM c JOIN gdn ON regexp_matches(clean, '\\b' || replace(norm, '.', '\\.') || '\\b') UNION ALL SELECT raw, departamento, 0, ord FROM c JOIN ga ON regexp_matches(clean, '\\b' || norm || '\\b'))),
dept AS (SELECT raw, departamento FROM dh WHERE rn = 1),
ch AS (SELECT raw, db.norm, municipio, departamento, -length(db.norm) AS l, db.ord, db.norm IN (SELECT norm FROM gdn UNION SELECT norm FROM ga) AS skip, (SELECT max(departamento) FROM gdn WHERE gdn.norm = db.norm) AS passed FROM c JOIN db ON length(db.norm) >= 3 AND regexp_matches(clean, '\\b' || replace(db.norm, '.', '\\.') || '\\b')),
re AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw ORDER BY l, ord) AS rn FROM ch WHERE NOT skip) WHERE rn = 1),
cx AS (SELECT raw, passed FROM (SELECT ch.raw, ch.passed, row_number() OVER (PARTITION BY ch.raw ORDER BY ch.l, ch.ord) AS rn FROM ch JOIN re ON ch.raw = re.raw WHERE ch.skip AND ch.passed IS NOT NULL AND (ch.l < re.l OR (ch.l = re.l AND ch.ord < re.ord))) WHERE rn = 1),
hit AS (SELECT re.raw, re.norm, re.municipio, re.departamento, coalesce(CASE WHEN c.tipo <> 'GOBERNACION' THEN dept.departamento END, cx.passed) AS wanted FROM re JOIN c ON c.raw = re.raw LEFT JOIN dept ON dept.raw = re.raw LEFT JOIN cx ON cx.raw = re.raw),
city AS (SELECT hit.raw, CASE WHEN hit.departamento <> wanted AND gmn.municipio IS NOT NULL THEN gmn.municipio ELSE hit.municipio END AS m, CASE WHEN hit.departamento <> wanted AND gmn.municipio IS NOT NULL THEN gmn.departamento ELSE hit.departamento END AS d FROM hit LEFT JOIN gmn ON gmn.norm = hit.norm AND gmn.departamento = wanted),
l AS (SELECT c.raw, CASE WHEN tipo <> 'GOBERNACION' THEN m END AS municipio, CASE WHEN tipo = 'GOBERNACION' THEN coalesce(dept.departamento, d) WHEN m IS NOT NULL THEN d ELSE dept.departamento END AS departamento FROM c LEFT JOIN dept ON dept.raw = c.raw LEFT JOIN city ON city.raw = c.raw)"""
