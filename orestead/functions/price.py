"""Prices and links, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What prices, ranges and price links look like.
RANGE = r"(?iU)\bот\b|\bдо\b|[-–—]\s*\d"
NUMBER = r"\d{1,3}(?:[\s\x{a0}\x{202f}.,]\d{3})+(?:[.,]\d{1,2})?|\d+(?:[.,]\d{1,3})?"
CURRENCY = r"(?:руб|₽|р\.)"
PRICE = rf"(?iU)({NUMBER})\s*{CURRENCY}"
ONLY_PRICE = r"(?iU)^(?:от|до)?\s*[\d\s\x{a0}.,]*(?:у\.?\s?е\.?[\s/]*)?[\d\s\x{a0}.,]+\s*(?:руб\.?|₽|р\.)\s*$"
OPEN_RANGE = r"(?iU)\b(?:от|до)\s*$|\d[\d\s\x{a0}]*\s*[-–—]\s*$"
LEAST_CELL, MOST_CELL, LONGEST_CELL = 100, 5_000_000, 40
LABEL_HIGH = r"(?iU)прайс|price|цены|цена|стоимост|тариф|платн\w{0,3}\s+услуг"
LABEL_MID = r"(?iU)пациент|услуг|оплат|посетител|клиент"
URL_HIGH = r"(?i)/price|/ceny|/cens|/pra[ij]s|/tarif|/stoimost|/platn|/oplata|price-?list"
FILE = r"(?i)\.(pdf|xlsx?|docx?)([?#]|$)"
SKIPPED = r"(?i)\.(jpe?g|png|gif|svg|webp|css|js|ico|mp4|zip)([?#]|$)|^(mailto|tel|javascript):|#$"


def number(c: Column) -> Column:
    """A number as printed: three digits after the last point or comma are thousands, one or two are hundredths."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\x{a0}\x{202f}]", "")
    parts = F.split(s, "[.,]")
    last = F.element_at(parts, -1)
    whole = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), "")
    text = F.when(F.size(parts) == 1, s).when(F.length(last) == 3, F.array_join(parts, "")).otherwise(F.concat(whole, F.lit("."), last))
    return text.try_cast("double")


def line_value(c: Column) -> Column:
    """The one price of a line, or null for a range or none."""
    found = F.regexp_extract(c, PRICE, 1)
    return F.when(c.rlike(RANGE) | (found == ""), F.lit(None)).otherwise(number(found))


def split_inline(line: Column) -> tuple[Column, Column, Column]:
    """A line with a price as its text before, an open range in front of the price (`от`, `1 000 -`), and the rest from the price on."""
    before = F.regexp_extract(line, rf"(?iU)^(.*?)(?:{NUMBER})\s*{CURRENCY}", 1)
    opened = F.regexp_extract(before, OPEN_RANGE, 0)
    return F.left(before, F.length(before) - F.length(opened)), opened, F.substr(line, F.length(before) + 1)


def cell_value(c: Column) -> Column:
    """The price in a cell of its own: at most 40 characters, no share or number sign, one number of a likely size, and but for a currency nothing else."""
    text = F.trim(F.coalesce(c, F.lit("")))
    numbers = F.regexp_extract_all(text, F.lit(f"({NUMBER})"), 1)
    value = number(F.get(numbers, F.lit(0)))
    bare = F.regexp_replace(F.regexp_replace(text, rf"(?iU){NUMBER}", ""), r"(?iU)руб(?:лей|ля|ль|\.)?|₽|р\.|[\s\x{a0}.,]", "")
    fits = (F.length(text) <= LONGEST_CELL) & ~text.rlike("[%№]") & (F.size(numbers) == 1) & value.between(LEAST_CELL, MOST_CELL) & (text.rlike(f"(?iU){CURRENCY}") | (bare == ""))
    return F.when(fits, value)


def link_scent(label: Column, href: Column) -> Column:
    """0 to 100: how much a link smells of prices; 100 is a price document."""
    label, href = F.trim(F.coalesce(label, F.lit(""))), F.trim(F.coalesce(href, F.lit("")))
    document = href.rlike(FILE) & (label.rlike(LABEL_HIGH) | href.rlike(LABEL_HIGH) | href.rlike(URL_HIGH))
    by_label = F.when(label.rlike(LABEL_HIGH), 80).when(label.rlike(LABEL_MID), 30).otherwise(0)
    by_url = F.when(href.rlike(URL_HIGH), 70).otherwise(0)
    return F.when((href == "") | href.rlike(SKIPPED), 0).when(document, 100).otherwise(F.greatest(by_label, by_url))


def outlier(c: Column, low: float = 50, high: float = 1_000_000) -> Column:
    """Prices beyond belief; null is none."""
    return (c < low) | (c > high)
