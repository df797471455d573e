"""Normalising text, names and domains, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, legal forms, stop words, units and modifiers that decide a key.
LATIN_LOOKALIKES = "abcehkmoptxy"
CYRILLIC_LOOKALIKES = "авсенкмортху"
LEGAL_FORMS = ("ооо", "ип", "ао", "зао", "оао", "пао", "нко", "анo", "ano")
NAME_STOP_WORDS = ("клиника", "центр", "медицинский", "медицинская", "медицинское", "мц", "«", "»")
UNITS = r"(?:см|мм|мл|ml|г|кв\.?\s*см)"
COUNTED = r"(?:эл(?:емент(?:ов|а)?)?|ед|шт|процедур[аы]?|зон[аы]?|этап(?:ная|а)?)"
NUMBER = r"\d+(?:[,.]\d+)?"
SIZES = (
    rf"(?:от\s+)?{NUMBER}\s*(?:-|–|до)\s*{NUMBER}\s*{UNITS}", rf"{NUMBER}\s*{UNITS}", rf"(?:от|до|св\.?|свыше)\s+{NUMBER}(?:\s*(?:см|мм|мл|ml))?", r"№\s*\d+(?:\s*-\s*\d+)?",
    rf"\d+\s*{COUNTED}\b\.?", r"\d+\s*кат\.?\s*сложности", r"за\s+1\s+ед\.?", r"\bмелких\b", r"\bкрупных\b",
)
MODIFIERS = (
    r"первичн\w+", r"повторн\w+", r"амбулаторн\w+", r"лечебно-диагностическ\w+", r"\d\s*(?:степени|категории)\s*сложности",
    r"высшей категории", r"\d\s*категории", r"с выдачей плана(?: лечения)?", r"с назначением лечения", r"кмн", r"дмн",
    r"кандидата медицинских наук", r"доктора медицинских наук", r"профессора?",
)
VISIT_WORDS = "прием|осмотр|консультация"
UI_TAILS = ("записаться", "позвонить", "подробнее", "заказать", "выбрать", "купить", "бонусов", "в корзину", "показать все", "читать далее", "узнать цену", "цена по запросу")
UI_HEADS = ("акция", "скидка", "хит", "new", "новинка", "записаться", "запись")
MASKED_NAME = "[ФИО]"

#: Java's regular expressions treat \b, \w and \s as ASCII and case as ASCII unless told otherwise.
U = "(?U)"
UI = "(?iU)"


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, U + r"\s+", " "))


def service_name(c: Column) -> Column:
    """The key under which spellings of one service meet: sizes, brackets, tails and modifiers go, kinds of visit are one.

    Modifiers must go before the kind of visit is looked for, as it may stand behind one.
    """
    edge = r"^[ \-–]+|[ \-–]+$"
    tidy = lambda x: F.regexp_replace(squeeze(x), edge, "")
    s = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("ё"), F.lit("е"))
    s = F.regexp_replace(s, r"\([^)]*\)", " ")
    s = F.substring_index(s, "/", 1)
    s = F.regexp_replace(s, UI + "(?:" + "|".join(SIZES) + ")", " ")
    s = tidy(F.regexp_replace(s, "[«»\"'.,;:№]", " "))
    s = tidy(F.regexp_replace(s, U + r"\b(?:" + "|".join(MODIFIERS) + r")\b", " "))
    return tidy(F.regexp_replace(s, U + rf"^(?:{VISIT_WORDS})(?:\s+(?:осмотр|консультация))*\s*(?:врача[-\s]*)?", "прием "))


def company_name(c: Column) -> Column:
    """Lower case, Latin look-alikes as Cyrillic, without legal forms, stop words and punctuation."""
    s = F.translate(F.lower(F.trim(F.coalesce(c, F.lit("")))), LATIN_LOOKALIKES, CYRILLIC_LOOKALIKES)
    for words in (LEGAL_FORMS, NAME_STOP_WORDS):
        s = F.regexp_replace(s, UI + r"\b(?:" + "|".join(words) + r")\b", " ")
    return squeeze(F.regexp_replace(s, r"[\"'«»„“”()\[\],.]", " "))


def rule_key(c: Column) -> Column:
    """What rules read: lower case, letters and digits only."""
    s = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("ё"), F.lit("е"))
    return squeeze(F.regexp_replace(F.regexp_replace(s, U + r"_x000d_|\s+", " "), "[^a-zа-я0-9 ]", " "))


def without_ui(c: Column) -> Column:
    """Cuts calls to action off both ends until none is left.

    Each pattern takes a whole run, and what one end loses can't bring out another at the other, but the whole text can
    go: so tails, heads and once more tails are the fixed point.
    """
    s = F.replace(F.coalesce(c, F.lit("")), F.lit(MASKED_NAME), F.lit(" "))
    s = F.regexp_replace(s, U + r"_x000D_|\s+", " ")
    tail = UI + r"(?:,?\s*(?:" + "|".join(UI_TAILS) + r"))+\s*$"
    head = UI + r"^\s*(?:(?:" + "|".join(UI_HEADS) + r")\b[^а-яa-z]*[:!.-]?\s*)+"
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, tail, ""), head, ""), tail, "")
    return F.regexp_replace(s, r"^[ ,;·\-–—]+|[ ,;·\-–—]+$", "")


def domain(c: Column) -> Column:
    """Host of a URL or bare domain: scheme, path, port and www. go, and other scripts become punycode, so that both
    spellings give one key. Empty is null; what has no punycode stays as it is.
    """
    s = F.regexp_replace(F.trim(F.lower(c)), r"^https?://", "")
    s = F.regexp_replace(F.substring_index(F.substring_index(s, "/", 1), ":", 1), r"^www\.", "")
    coded = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), s)
    return F.nullif(F.when(s.rlike(r"[^\x00-\x7f]"), F.coalesce(coded, s)).otherwise(s), F.lit(""))


def first_site(c: Column) -> Column:
    """The first of several sites in a cell; the port stays."""
    s = F.regexp_extract(F.trim(F.lower(c)), r"^[^,;\s]*", 0)
    s = F.substring_index(F.substring_index(F.regexp_replace(s, r"^https?://", ""), "/", 1), "?", 1)
    return F.nullif(F.regexp_replace(s, r"^www\.", ""), F.lit(""))


def all_sites(c: Column) -> Column:
    """All sites of a cell, each once, in order."""
    parts = F.split(F.coalesce(c, F.lit("")), r"[,;\s]+")
    return F.array_distinct(F.filter(F.transform(parts, first_site), lambda x: x.isNotNull()))


def has_digits(c: Column, lengths: tuple[int, ...]) -> Column:
    """Whether so many digits are left after dropping all else: 10 or 12 for a tax number, 13 or 15 for a register number."""
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")).isin(*lengths)


def tax_number(c: Column) -> Column:
    """10 or 12 digits; 9 get a leading zero; else null."""
    d = F.regexp_replace(c.cast("string"), r"\D", "")
    n = F.length(d)
    return F.when(n == 9, F.lpad(d, 10, "0")).when(n.isin(10, 12), d)


def shard_of(c: Column, shards: int) -> Column:
    """1 to shards, by CRC-32 of the bare domain: the same in every run and process."""
    key = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"^www\.", "")
    return (F.crc32(key.cast("binary")) % shards + 1).cast("int")


def head_and_tail(c: Column, head: int, tail: int) -> Column:
    """Long texts keep their start and their end."""
    return F.when(F.length(c) > head + tail, F.concat(F.substring(c, 1, head), F.lit("\n"), F.right(c, F.lit(tail)))).otherwise(c)


def cell(c: Column) -> Column:
    """Control characters that a sheet can't hold become a dot."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "·")


def suffix_match(d: Column, listed: tuple[str, ...]) -> Column:
    """Whether a domain is one of listed or below one."""
    hit = F.lit(False)
    for a in listed:
        hit = hit | (d == a) | d.endswith("." + a)
    return F.coalesce(hit, F.lit(False))


def is_fragment(c: Column) -> Column:
    """Nothing, or at most two words of at most three letters."""
    words = F.filter(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"), lambda w: w != "")
    return (F.size(words) == 0) | ((F.size(words) <= 2) & F.forall(words, lambda w: F.length(w) <= 3))


def family_key(c: Column) -> Column:
    """First four words of a service name without Latin words and digits."""
    words = F.filter(F.split(F.regexp_replace(service_name(c), "[A-Za-z0-9+]+", " "), " +"), lambda w: w != "")
    return F.array_join(F.slice(words, 1, 4), " ")
