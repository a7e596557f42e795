"""Entities, eras, transmission grades, personal data flags and small formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexquarry.functions.text import let

# The names that are tagged, in order of report.
KNOWN_NAMES = (
    "Abu Bakr", "Abu Bakr al-Siddiq", "Umar ibn al-Khattab", "Umar ibn Khattab", "Uthman ibn Affan", "Ali ibn Abi Talib",
    "Aisha", "Khadijah", "Khadija", "Fatimah", "Fatima", "Khalid ibn Walid", "Bilal ibn Rabah", "Bilal",
    "Salman al-Farisi", "Salman al-Farsi", "Abu Hurairah", "Ibn Abbas", "Ibn Umar", "Anas ibn Malik",
    "Abu Musa al-Ashari", "Muadh ibn Jabal", "Zayd ibn Thabit", "Nusayba", "Abu Dharr", "Amr ibn al-As",
    "Sad ibn Abi Waqqas", "Usamah ibn Zayd", "Hamza ibn Abd al-Muttalib", "Hamza", "Zubayr ibn al-Awwam", "Zubayr",
    "Talha ibn Ubaydullah", "Talha", "Abu Ubayda", "Abu Sufyan", "Abu Talib", "Zayd", "Usama", "Umar", "Uthman", "Ali",
    "Husayn", "Hassan", "Prophet", "Messenger of Allah", "Muawiyah", "Husayn ibn Ali", "Hassan ibn Ali", "Tariq ibn Ziyad",
    "Umar ibn Abd al-Aziz", "Umar II", "Al-Hajjaj", "Abd al-Rahman", "Harun al-Rashid", "Al-Ma'mun", "Saladin", "Baybars",
    "Nur al-Din", "Ibn Khaldun", "Ibn Battuta", "Ibn Sina", "Ibn Rushd", "Al-Ghazali", "Ibn Jubayr", "Nawawi", "Ibn Hazm",
    "Firdausi", "Nizami", "Timur", "Tamerlane", "Genghis Khan", "Hulagu", "Shah Ismail", "Shah Abbas", "Nader Shah",
    "Imam Shamil", "Kazi Mullah", "Ghazi Muhammad", "Rustam", "Sohrab", "Khosrow", "Mahmud of Ghazni", "Rumi", "Hafiz",
    "Saadi", "Muhammad al-Fatih", "Mehmed", "Mehmed II", "Constantine", "Constantinople", "Mansa Musa", "Tipu Sultan",
    "Omar al-Mukhtar", "Abd al-Qadir", "Abduh", "Afghani", "Iqbal",
)
# Eras with their keywords; the first era with a hit wins.
ERA_KEYWORDS = {
    "africa": ("mansa musa", "mali", "timbuktu", "songhai", "ghana empire", "sundiata", "askia"),
    "crusades": ("saladin", "crusade", "hattin", "jerusalem 1187", "richard", "baybars"),
    "mongol": ("mongol", "hulagu", "ain jalut", "genghis", "ilkhanate"),
    "ottoman": ("ottoman", "suleiman", "mehmed", "constantinople", "janissary"),
    "andalusia": ("andalusia", "cordoba", "granada", "ibn rushd", "averroes", "reconquista"),
    "abbasid": ("abbasid", "harun", "mamun", "house of wisdom", "baghdad caliphate"),
    "south_asia": ("mughal", "akbar", "babur", "delhi sultanate", "tipu sultan"),
    "southeast_asia": ("malacca", "java", "aceh", "malay", "indonesia"),
}
# Patterns of personal questions; the first four ignore case.
PERSONAL = (
    r"(?i)\bmy (grand)?(father|mother|uncle|aunt|family|ancestor|parent|sibling|brother|sister)s?\b",
    r"(?i)\bmy (village|hometown|tribe|lineage|nasab|clan)\b",
    r"(?i)\b(i am|i'm|im)\s+(a|an|from|the)\b",
    r"(?i)\b[A-Z][a-z]+\s+(ibn|bint|bin)\s+[A-Z][a-z]+\b.{0,60}\b(my|our|village|family|grandfather|ancestor)\b",
    r"\b\+?\d[\d\s\-]{8,}\d\b",
    r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b",
)
# Embedding models by language.
ENGLISH_MODEL, OTHER_MODEL = "voyage-2", "voyage-multilingual-2"


def extract_entities(text: Column, names: tuple[str, ...] | list[str] = KNOWN_NAMES, word_boundary: bool = False) -> Column:
    """The listed names that a text contains, whatever the case, in list order; null if none.

    Names are substrings, as given, unless ``word_boundary`` asks for whole words. One pass of
    built-in searches a row; the list is a constant of the plan.
    """
    distinct = list(dict.fromkeys(names))
    if word_boundary:
        hit = lambda low, n: low.rlike(r"(?<!\p{L})\Q" + n.lower() + r"\E(?!\p{L})")
    else:
        hit = lambda low, n: F.contains(low, F.lit(n.lower()))
    # the text is lower-cased once, bound by the outer lambda
    found = let(F.lower(text), lambda low: F.array_compact(F.array(*[F.when(hit(low, n), F.lit(n)) for n in distinct])))
    return let(found, lambda f: F.when(F.size(f) > 0, f))


def extract_entities_ext(text: Column, extra: list[str], names: tuple[str, ...] = KNOWN_NAMES) -> Column:
    """Names of both lists, sorted."""
    return F.array_sort(F.coalesce(extract_entities(text, [*names, *extra]), F.array().cast("array<string>")))


def detect_era(text: Column, keywords: dict[str, tuple[str, ...]] = ERA_KEYWORDS) -> Column:
    any_of = lambda low, ks: reduce(lambda a, b: a | b, [F.contains(low, F.lit(k)) for k in ks])
    return let(F.lower(text), lambda low: F.coalesce(*[F.when(any_of(low, ks), F.lit(era)) for era, ks in keywords.items()]))


def _grade(g: Column, weak: bool = False) -> Column:
    low = F.lower(g)
    daif = F.contains(low, F.lit("daif")) | F.contains(low, F.lit("da'if"))
    if weak:
        daif = daif | F.contains(low, F.lit("weak"))
    return F.when(F.contains(low, F.lit("sahih")), "sahih").when(F.contains(low, F.lit("hasan")), "hasan").when(daif, "daif")


def chain_strength_first(grades: Column) -> Column:
    """The class of the first grade in the list that has one."""
    return F.coalesce(F.get(F.filter(F.transform(grades, lambda g: _grade(g)), lambda g: g.isNotNull()), F.lit(0)), F.lit("unknown"))


def chain_strength_any(grades: Column) -> Column:
    """The best class that any grade of the list names."""
    return F.coalesce(_grade(F.array_join(grades, " "), weak=True), F.lit("unknown"))


def embedding_model(language: Column) -> Column:
    return F.when(language == "english", ENGLISH_MODEL).otherwise(OTHER_MODEL)


def pii_flag(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(text.rlike(p), F.lit(False)) for p in PERSONAL])


def query_hash(text: Column) -> Column:
    """SHA-256 (binary) of the lower-cased text, stripped, with runs of white space as one space."""
    norm = F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")
    return F.unhex(F.sha2(norm, 256))


def key_hash(key: Column) -> Column:
    return F.sha2(key, 256)


def valid_email(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[^@]+@[^@]+\.[^@]+$"), F.lit(False))


def date_ce_year(c: Column) -> Column:
    """The first run of three or four digits, as a number."""
    return F.nullif(F.regexp_extract(c, r"(\d{3,4})", 1), F.lit("")).try_cast("int")


def source_slug(name: Column, length: int = 40) -> Column:
    return F.regexp_replace(F.regexp_replace(F.substring(F.lower(name), 1, length), "[^a-z0-9_]", "_"), "^_+|_+$", "")


def citations_count(text: Column) -> Column:
    """Pairs of double asterisks."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit("**"), F.lit("")))) / 4).cast("long")


def format_passages(n: Column) -> Column:
    millions = F.regexp_replace(F.regexp_replace(F.format_string("%.1f", F.bround(n / 1e6, 1)), "0+$", ""), r"\.$", "")
    return F.when(n >= 1_000_000, F.concat(millions, F.lit("M+"))).when(n >= 1_000, F.concat(F.floor(n / 1000).cast("string"), F.lit("K+"))).otherwise(n.cast("string"))


def percent_used(used: Column, limit: Column) -> Column:
    """Null where the limit is 0."""
    return F.round(F.try_divide(used.cast("double"), limit.cast("double")) * 100, 1)


def inject_stats(html: Column, values: dict[str, Column]) -> Column:
    """Replaces the content of elements with data-stat="key" by the key's value."""
    out = html
    for key, value in values.items():
        out = F.regexp_replace(out, F.lit(rf'(<[^>]*data-stat="{key}"[^>]*>)[^<]*(</[^>]+>)'), F.concat(F.lit("$1"), F.regexp_replace(value.cast("string"), r"([$\\])", r"\\$1"), F.lit("$2")))
    return out


def clamp_n(n: int | None, default: int = 5, most: int = 20) -> int:
    """A requested number of results: missing or 0 is the default, then 1 to ``most``."""
    return min(max(n or default, 1), most)
