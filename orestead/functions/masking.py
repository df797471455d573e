"""Personal names, addresses and fuzzy matching: what needs a match's own context, in pandas UDFs over Arrow."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What names and streets look like in Russian.
PATRONYMIC = r"[А-ЯЁ][а-яё]+(?:вич|вна|ична|оглы|кызы|ич\b)"
WORD = r"[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?"
CAPITALS = r"\b[А-ЯЁ]{2,}\s+[А-ЯЁ]{2,}\s+[А-ЯЁ]{2,}(?:ОВИЧ|ЕВИЧ|ЬЕВИЧ|ОВНА|ЕВНА|ЬЕВНА|ИЧНА|ИНИЧНА)\b"
NAME_PATTERNS = (rf"{WORD}\s+{WORD}\s+{PATRONYMIC}", rf"{WORD}\s+{PATRONYMIC}(?:\s+{WORD})?", CAPITALS, rf"{WORD}\s+[А-ЯЁ]\.\s?[А-ЯЁ]\.", rf"[А-ЯЁ]\.\s?[А-ЯЁ]\.\s?{WORD}")
ORGANISATION = r"клиник|центр|больниц|поликлиник|институт|ооо|улиц|проспект|имени"
MASK = "[ФИО]"
STREET = r"(?:ул(?:ица|\.)?|пр(?:оспект|-т|\.)?|пер(?:еулок|\.)?|ш(?:оссе|\.)?|б(?:ульвар|-р)|наб(?:ережная|\.)?|пл(?:ощадь|\.)?)"
HOUSE = r"(?:д(?:ом|\.)?\s*)?(\d+)\s*([а-яё]?)(?:[\s,/]*(?:к(?:орп(?:ус|\.)?|\.)?|стр(?:оение|\.)?|/)\s*(\d+[а-яё]?))?"
ANTONYMS = (("злокачествен", "доброкачествен"),)
CUTOFF = 0.92

_NAMES = [re.compile(p) for p in NAME_PATTERNS]
_ORG = re.compile(ORGANISATION, re.I)
_STREET = re.compile(rf"(?:^|[,\s]){STREET}\s*([А-ЯЁа-яё0-9 -]+?)(?=,|$|\s+д(?:ом|\.))", re.I)
_HOUSE = re.compile(rf"(?:^|[,\s]){HOUSE}(?=$|[,\s])", re.I)


def mask_names(text: str | None) -> str | None:
    """Personal names become a mask, unless the match holds an organisation's word; repeated masks are one, a lone one keeps the line break after it."""
    if text is None:
        return None
    for p in _NAMES:
        text = p.sub(lambda m: m[0] if _ORG.search(m[0]) else MASK, text)
    return re.sub(rf"(?:{re.escape(MASK)}\s*){{2,}}", lambda m: MASK + (" " if m[0][-1].isspace() else ""), text)


def street_and_house(address: str | None) -> tuple[str, str] | None:
    """The street's name and the house with letter and block, or None where either is missing."""
    found = _STREET.search(address or "")
    if not found:
        return None
    house = _HOUSE.search(address[found.end() :])
    if not house:
        return None
    number = house[1] + (house[2] or "").lower() + (f"к{house[3].lower()}" if house[3] else "")
    return found[1].strip().lower(), number


def best_match(name: str, listed: list[str], cutoff: float = CUTOFF) -> str | None:
    """The most similar of listed by matching blocks, at least cutoff; ties go to the larger string; texts of which one has a guarded stem and the other hasn't don't match.

    Strings so different in length that they can't reach the cutoff are passed over unseen.
    """
    least = cutoff / (2 - cutoff)
    near = [s for s in listed if min(len(s), len(name)) >= least * max(len(s), len(name))]
    best = max(((difflib.SequenceMatcher(None, s, name).ratio(), s) for s in near), default=(0.0, ""))
    if best[0] < cutoff:
        return None
    mine, other = name.lower(), best[1].lower()
    opposed = any((stem in mine) != (stem in other) for pair in ANTONYMS for stem in pair)
    return None if opposed else best[1]


def masked(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(mask_names, na_action="ignore")

    return run(c)


def fuzzy(c: Column, listed: list[str], cutoff: float = CUTOFF) -> Column:
    """best_match against a dictionary small enough to ship: filter out what matches exactly first."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        seen = {x: best_match(x, listed, cutoff) for x in s.dropna().unique()}
        return s.map(seen)

    return run(c)


def has_name(c: Column) -> Column:
    """Whether a personal name occurs that is no organisation's."""
    hits = F.flatten(F.array(*[F.regexp_extract_all(c, F.lit("(?U)" + p), 0) for p in NAME_PATTERNS]))
    return F.coalesce(F.exists(hits, lambda h: ~h.rlike("(?iU)" + ORGANISATION)), F.lit(False))
