"""Text normalizers and scalar text functions as Column builders.

Seven normalizers look alike and are not interchangeable; each says what it keeps. A null counts as an empty text.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sendero.functions.numbers import COURT_PHRASES, COURT_WORDS, ORDINAL_PHRASES, ORDINAL_WORDS

#: Words without weight.
STOPWORDS = ["DE", "DEL", "LA", "LAS", "LOS", "EL", "EN", "Y", "A", "CON", "POR", "PARA", "D", "C", "E", "S", "P"]
KEY_STOPWORDS = ["DE", "DEL", "LA", "LAS", "LOS", "EL", "EN", "Y", "A"]
CITY_TAIL = r"\bDE\s+(?:BOGOTA|CALI|BARRANQUILLA|CARTAGENA|MEDELLIN|BUCARAMANGA|CUCUTA|IBAGUE|NEIVA|SANTA\s+MARTA|MONTERIA|VILLAVICENCIO|MANIZALES|PEREIRA|VALLEDUPAR|SOLEDAD|TURBACO|PALMIRA)\b.*"
PLACE_WORDS = r"\b(?:D\s*C|BOGOTA|CUNDINAMARCA|BOLIVAR|ATLANTICO|TOLIMA|SANTANDER|HUILA|META|VALLE)\b"
#: What stands for a missing mail, address or registry field.
NO_MAIL = ["noencontrada", "no encontrada", "no encontrado", ""]
NO_ADDRESS = ["no encontrada", "no encontrado", ""]
NO_FIELD = ["NULL", "NONE", "NAN"]


def accent_table(form: str = "NFD", keep: str = "ñÑ") -> tuple[str, str]:
    """Precomposed Latin letters and their base letters, but for those to keep."""
    pairs = []
    for c in map(chr, [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]):
        base = "".join(x for x in unicodedata.normalize(form, c) if unicodedata.category(x) != "Mn")
        if c not in keep and len(base) == 1 and base != c:
            pairs.append((c, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


KEEP_ENIE, FOLD_ALL, FOLD_COMPAT = accent_table(), accent_table(keep=""), accent_table("NFKD", "")


def _sub(col: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(col, pattern, to)


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return _sub(F.coalesce(col, F.lit("")), r"(?U)^\s+|\s+$")


def squeeze(col: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(_sub(col, r"(?U)\s+", " "))


def remove_accents(col: Column, table: tuple[str, str] = KEEP_ENIE) -> Column:
    """Letters without their marks; precomposed Ñ stays unless the table says otherwise."""
    return _sub(F.translate(col, *table), r"\p{Mn}")


def clean_text(col: Column) -> Column:
    """Upper case without accents (Ñ stays), quotes, parentheses, pipes and outer punctuation; long dashes as '-'."""
    t = remove_accents(F.upper(strip(col)))
    t = F.translate(t, "་\"“”'‘’", " ")
    t = _sub(_sub(_sub(t, "[–—]", "-"), r"\([^)]*\)"), r"\|")
    t = _sub(t, r"(?U)\s+", " ")
    return F.trim(_sub(_sub(t, r"^[.,;:\-\s]+"), r"[.,;:\-\s]+$"))


def norm_keep(col: Column) -> Column:
    """Upper case letters, digits and Ñ only, other characters as spaces."""
    return squeeze(_sub(remove_accents(F.upper(strip(col))), r"(?U)[^A-Z0-9Ñ\s]", " "))


def norm_fold(col: Column) -> Column:
    """Upper case, Ñ as N, the punctuation . , ; : - / as spaces."""
    return squeeze(_sub(remove_accents(F.upper(strip(col)), FOLD_ALL), r"[.,;:\-/]+", " "))


def norm_registry(col: Column) -> Column:
    """Upper case, compatibility forms and Ñ folded, all but word characters as spaces (underscores stay)."""
    return squeeze(_sub(remove_accents(F.upper(strip(col)), FOLD_COMPAT), r"(?U)[^\w\s]", " "))


def norm_suggest(col: Column) -> Column:
    """norm_keep with accented vowels allowed; none is left by then, so both agree."""
    return squeeze(_sub(remove_accents(F.upper(strip(col))), r"(?U)[^A-Z0-9ÑÁÉÍÓÚ\s]", " "))


def norm_city(col: Column) -> Column:
    """Upper case without any mark, spaces collapsed."""
    return squeeze(remove_accents(F.upper(strip(col)), FOLD_ALL))


def norm_audit(col: Column) -> Column:
    """norm_city, and other characters as spaces."""
    return squeeze(_sub(norm_city(col), "[^A-Z0-9ÑÁÉÍÓÚ ]", " "))


def ordinal_rules() -> list[tuple[str, str]]:
    """(pattern, number): phrases first, then single words, those of one number as one pattern."""
    rules = []
    for table in (ORDINAL_PHRASES, ORDINAL_WORDS):
        words: dict[int, list[str]] = {}
        for word, n in table.items():
            words.setdefault(n, []).append(word)
        rules += [(rf"\b(?:{'|'.join(some)})\b", str(n)) for n, some in words.items()]
    return rules


def replace_ordinals(col: Column) -> Column:
    """Spelled-out ordinals as digits. Every rule is tried in turn, but only on texts that hold some word of a rule."""
    singles = "|".join(ORDINAL_WORDS)
    tens = "|".join(dict.fromkeys(p.split(" ")[0] for p in ORDINAL_PHRASES))
    return F.when(col.rlike(rf"\b(?:{singles}|{tens})\b"), reduce(lambda t, rule: _sub(t, *rule), ordinal_rules(), col)).otherwise(col)


def extract_number(col: Column) -> Column:
    """The first whole number after ordinals became digits, or ''."""
    return F.regexp_extract(replace_ordinals(clean_text(col)), r"\b(\d+)\b", 1)


def court_phrases() -> list[tuple[str, int]]:
    """Phrases of two or three words and their numbers, longest first."""
    return sorted(COURT_PHRASES.items(), key=lambda x: -len(x[0]))


def court_ordinal(col: Column) -> Column:
    """A court's number: a phrase anywhere, else one of the first three words, else the first number of 1-3 digits."""
    t = _sub(norm_suggest(col), r"^JUZGADO\s+")
    phrase = F.coalesce(*[F.when(F.contains(t, F.lit(p)), F.lit(n)) for p, n in court_phrases()])
    table = F.create_map(*[F.lit(x) for w, n in COURT_WORDS.items() for x in (w, n)])
    word = F.filter(F.transform(F.slice(F.split(t, " "), 1, 3), lambda w: F.try_element_at(table, w)), lambda n: n.isNotNull())
    return F.coalesce(phrase, F.try_element_at(word, F.lit(1)), F.regexp_extract(t, r"\b(\d{1,3})\b", 1).try_cast("int"))


def office_number(col: Column) -> Column:
    """The first number of 1-3 digits, or ''."""
    return F.regexp_extract(F.coalesce(col, F.lit("")), r"\b(\d{1,3})\b", 1)


def _words_but(t: Column, stop: list[str]) -> Column:
    return F.filter(F.split(t, " "), lambda w: (F.length(w) > 1) & ~w.isin(*stop))


def key_words(col: Column) -> Column:
    """Words of two or more characters that are no stop words."""
    return _words_but(norm_suggest(col), STOPWORDS)


def court_subtype_key(col: Column) -> Column:
    """What remains of a court's name without number, place and stop words."""
    t = _sub(_sub(_sub(norm_suggest(col), r"^JUZGADO\s+"), CITY_TAIL), PLACE_WORDS)
    ordinal = sorted({w for p, _ in court_phrases() for w in p.split()} | set(COURT_WORDS))
    return F.array_join(_words_but(squeeze(t), [*ordinal, *KEY_STOPWORDS]), " ")


def tax_id(col: Column) -> Column:
    """The number after NIT, without dots and hyphens, or ''."""
    return F.translate(F.regexp_extract(F.coalesce(col, F.lit("")), r"(?i)NIT\s*[:\-]?\s*(\d[\d.\-]+)", 1), ".-", "")


def court_mail(code: Column, domain: str) -> Column:
    """lower(code)@domain, '' without a code."""
    return F.when(strip(code) != "", F.concat(F.lower(code), F.lit(f"@{domain}"))).otherwise("")


def address(raw: Column) -> Column:
    """Upper-case address of a text or a JSON object; an unreadable object is searched for its field."""
    t = strip(raw)
    found = strip(F.coalesce(F.get_json_object(t, "$.direccionGenerada"), F.get_json_object(t, "$.complemento")))
    searched = strip(F.regexp_extract(t, r'direccionGenerada[":\s]+([^"]+)', 1))
    readable = F.try_parse_json(t).isNotNull()
    obj = F.when(readable, F.when(F.upper(found) == "VACIA", "").otherwise(F.upper(found))).when(searched != "", F.upper(searched)).otherwise(F.upper(t))
    return F.when(t.startswith("{"), obj).otherwise(F.upper(t))


def numbers(col: Column) -> Column:
    """The distinct digit runs."""
    return F.array_distinct(F.regexp_extract_all(col, F.lit(r"(\d+)"), F.lit(1)))


def blank_if(col: Column, sentinels: list[str], fold=F.lower) -> Column:
    """'' where the stripped, folded text is a sentinel, else the stripped text."""
    t = strip(col)
    return F.when(fold(t).isin(*sentinels), "").otherwise(t)


def mixed_case(col: Column) -> Column:
    """Neither all upper nor all lower case; texts without any cased letter count as mixed."""
    return ((col != F.upper(col)) & (col != F.lower(col))) | (F.upper(col) == F.lower(col))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 0 if one is empty or lengths differ by more than 40 %."""
    la, lb = F.length(a), F.length(b)
    longer = F.greatest(la, lb)
    return F.when((la == 0) & (lb == 0), 1.0).when((la == 0) | (lb == 0), 0.0).when(F.abs(la - lb) / longer > 0.4, 0.0).otherwise(1.0 - F.levenshtein(a, b) / longer)


def contained(a: Column, b: Column) -> Column:
    """Either text holds the other."""
    return F.contains(a, b) | F.contains(b, a)


def whole_number(col: Column) -> Column:
    """The text of a whole number without leading zeros, '' for anything else."""
    return F.coalesce(strip(col).try_cast("bigint").cast("string"), F.lit(""))


def amount(col: Column) -> Column:
    """An exact amount of 18 digits before the point, null for blanks and what is no number."""
    return F.nullif(strip(col), F.lit("")).try_cast("decimal(20,2)")


def strip_commas(col: Column) -> Column:
    """Without the spaces at the ends, then the commas there, then the spaces."""
    return strip(F.trim(strip(col), F.lit(",")))
