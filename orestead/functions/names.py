"""What may be the name of a service or of a company, and what is made of it, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import UI, U, rule_key, squeeze

# Labels, headings, widgets and disclaimers that are no service, forms of ownership, letters and hints.
GENERIC_NAMES = (
    "консультация", "консультации", "диагностика", "приём", "прием", "приемы", "услуга", "услуги", "лечение", "обследование", "обследования",
    "процедура", "процедуры", "анализы", "анализ", "исследования", "стоимость", "цена", "цены", "прочее", "другое", "разное", "акции", "скидки",
    "программы", "комплексы", "манипуляции", "операции", "инъекции", "аппаратные",
)
PERSON = r"[А-ЯЁ][а-яё]+\s+[А-ЯЁ][а-яё]+\s+[А-ЯЁ][а-яё]*(?:вна|ична|инична|евич|ович|ич|оглы|кызы)\b"
NAME_REJECTS = (
    r"[●•]", r"\d{3,}\s*(?:₽|руб\.?|р\b)", r"\bруб\b|₽", PERSON, r"^\s*(?:на сайте|доступно|недоступно|опыт\b|стаж\b)",
    r"^\s*/|\bглавная\b.*/|/\s*$|^главная\b", r"^\s*(?:с\s+)?\d{1,2}\s+(?:январ|феврал|март|апрел|ма[яй]|июн|июл|август|сентябр|октябр|ноябр|декабр)",
    r"^\s*(?:по телефону|по запросу|уточняйте|звоните|сегодня|завтра|запись|ближайшая запись)\b",
)
UI_LABELS = (
    r"цена( от)?", r"от|до", r"\d[\d\s.,]*(руб|р|₽)?\.?", r"бесплатно", r"акция.*", r"скидк.*", r"\d+\s*%.*", r"курс(ом)?\s+\d+(-\d+)?\s+процедур.*", r"процедур[аы]?",
    r"после возврата налога", r"запись .*", r"соглас.* на обработку.*", r"(пн|вт|ср|чт|пт|сб|вс)[\s.,-].*\d{1,2}[:.]\d{2}.*", r"\+?[78][\s(-]?\d{3}.*\d{2}[\s-]?\d{2}",
    r"стоимость|прайс|услуг[аи]|наименование|название", r"записаться|позвонить|подробнее|заказать", r"выгодно|вместо|ежедневно|скоро|новинка", r"сумма депозита",
    r"срок выполнения", r"\d+ категория", r"(рекомендуемый )?курс( назначается врачом)?( по показаниям)?", r"рекомендуемый курс .*", r"курс \d.*процедур.*", r"оформите заявку.*",
    r"фильтр по параметрам.*", r"кровь с (гепарином|эдта)", r"сыв ка крови", r"(подарочный )?сертификат", r"минимальная (цена|стоимость).*", r"стоимость название услуги",
    r"стоимость препарата не включена", r"цены", r"для кого.*", r"более \d+ го элемента.*", r"как доп процедура.*", r"\d+ опред", r"повторн(ый|ая)", r"стоимость приема.*",
    r"пребывание пациента.*", r"стаж \d+.*", r"врач(и)?", r"взрослые", r"дет(и|ям)", r"жара( .*)?", r"топ прайс", r"читать полностью", r"(на первую процедуру|с \d+ й процедуры)",
    r"при (покупке абонемента|использовании).*", r"(стоимость|первичный|повторный) прием(а)?", r"первичная консультация", r"цена у экспертов.*", r".*записаться на прием",
    r"кровь|венозная кровь|кровь сыворотка|сыворотка крови|моча|кал|слюна|соскоб|биоматериал|количеств|качеств", r"экспресс",
)
FIRST_NAMES = (
    "ольга", "наталья", "мария", "анна", "елизавета", "нелли", "лилия", "ирина", "светлана", "екатерина", "татьяна", "юлия", "елена", "анастасия", "дарья", "ксения", "алина", "полина",
    "виктория", "вероника", "маргарита", "галина", "людмила", "надежда", "оксана", "яна", "инна", "алла", "валентина", "софья", "александр", "дмитрий", "сергей", "андрей", "алексей", "иван",
    "михаил", "владимир", "николай", "евгений", "максим", "денис", "павел", "антон", "руслан", "тимур", "олег", "игорь", "виталий", "константин", "роман", "артем", "никита",
)
LEFT_OF_HTML = r"(?iU)[<>]|class=|href=|style=|&#|\bspan\b|\bdiv\b"
HEADLINE = r"(?iU) в новосибирске| цены|цены,|цены:|фото до|запись на|стоимость|прайс|^лечение |^удаление |^консультация |^контурная |^лазерн|недорого|акци[яи]"
STATE_FORMS = r"(?U)\b(?:ФГБУ|ГБУЗ|ГАУЗ|МБУЗ|ГУЗ|КГБУЗ|ОГБУЗ|ФГАУ|ФКУЗ|МАУЗ|ГБУ)\b|министерств\w* здравоохранени|департамент\w* здравоохранени"
PRIVATE_FORMS = r"(?U)\b(?:ООО|АО|ЗАО|ПАО|ИП|АНО)\b"
SEGMENT_FORMS = r"(?U)\b(?:ООО|ОАО|ЗАО|ПАО|АО|ИП|АНО|ГБУЗ|ГАУЗ|МАУЗ|МУП|НУЗ|ЧУЗ|ФГБУ|ГУП)\b"
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s",
    "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}
OUTCOMES = (
    "прайс извлечён", "страница прайса найдена, цены не извлечены", "сайт недоступен на дату проверки", "прайс-файл не разобран на дату проверки", "прайс не найден на дату проверки",
)
DIGIT_SHARE, LEAST_LETTERS, LEAST_HEAD, LONGEST_TITLE, LEAST_DELAY, LEAST_TOKEN = 0.35, 5, 12, 60, 3.0, 4


def _without(c: Column, pattern: str) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def valid_name(c: Column) -> Column:
    """Whether a text can be a priced service's name: letters enough, few digits, none of the rejects, no heading, and its first two words not again behind."""
    low = F.lower(c)
    bare = F.regexp_replace(low, r"^[ .,;:–—-]+|[ .,;:–—-]+$", "")
    words = F.filter(F.split(low, r"(?U)\s+"), lambda w: w != "")
    head, rest = F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 3, F.greatest(F.size(words), F.lit(1))), " ")
    doubled = (F.size(words) >= 4) & (F.length(head) >= LEAST_HEAD) & F.contains(rest, head)
    rejected = c.rlike("(?iU)" + "|".join(f"(?:{p})" for p in NAME_REJECTS if p != PERSON)) | c.rlike("(?U)" + PERSON)
    enough = _without(low, "[а-яёa-z]") >= LEAST_LETTERS
    few_digits = _without(c, r"(?U)\d") <= DIGIT_SHARE * F.greatest(F.length(c), F.lit(1))
    return F.coalesce(enough & few_digits & ~rejected & ~bare.isin(*GENERIC_NAMES) & ~doubled, F.lit(False))


def ui_garbage(c: Column) -> Column:
    """Whether all of a text is a label, a price, a timetable or a list of people: nothing that a rule should read."""
    t = rule_key(c)
    people = "(?:" + "|".join(FIRST_NAMES) + ")"
    return (F.length(t) < 3) | t.rlike(f"{people} [а-я]+.*{people}") | t.rlike(UI + "^(?:" + "|".join(f"(?:{p})" for p in UI_LABELS) + ")$")


def clean_of_html(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).rlike(LEFT_OF_HTML)


def headline(c: Column) -> Column:
    """Whether a title is a page's headline and not an organisation's name."""
    return F.coalesce(c.rlike(HEADLINE) | (F.length(c) > LONGEST_TITLE), F.lit(False))


def ownership(legal_name: Column, text: Column) -> Column:
    """The form in the legal name decides; else what the text names, which is less sure for private ones."""
    by_name = F.when(legal_name.rlike(PRIVATE_FORMS), "частная").when(legal_name.rlike(STATE_FORMS), "государственная")
    by_text = F.when(text.rlike(STATE_FORMS), "государственная").when(text.rlike(PRIVATE_FORMS), "частная (по тексту сайта, Уточнить)")
    return F.coalesce(by_name, by_text, F.lit("Уточнить"))


def map_name(c: Column) -> Column:
    """A name for map searches: segments between commas that hold a legal form go, unless nothing else is left."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda p: F.trim(p)), lambda p: (p != "") & ~p.rlike(SEGMENT_FORMS))
    return F.when(F.size(parts) > 0, F.array_join(parts, " ")).otherwise(F.coalesce(c, F.lit("")))


def translit(c: Column) -> Column:
    """Latin letters for Cyrillic ones: single letters at once, the others one by one. Further letters of other scripts go."""
    s = F.lower(F.coalesce(c, F.lit("")))
    wide = {k: v for k, v in LATIN.items() if len(v) > 1}
    s = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), wide.items(), s)
    single = {k: v for k, v in LATIN.items() if len(v) == 1}
    silent = "".join(k for k, v in LATIN.items() if not v)
    return F.regexp_replace(F.translate(s, "".join(single) + silent, "".join(single.values())), r"[^\x00-\x7f]", "")


def name_tokens(c: Column, dropped: tuple[str, ...]) -> Column:
    """Words of four letters and more of a name, without legal forms and common words."""
    s = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("ё"), F.lit("е"))
    s = F.regexp_replace(s, U + r"\b(?:" + "|".join(dropped) + r")\b|[^\w\s]", " ")
    return F.filter(F.split(squeeze(s), " "), lambda w: F.length(w) >= LEAST_TOKEN)


def domain_candidates(tokens: Column) -> Column:
    """Up to six domains that a name may have: all words together, with hyphens, and the first."""
    latin = F.filter(F.transform(tokens, translit), lambda w: F.length(w) >= LEAST_TOKEN)
    joined = F.array_join(latin, "")
    bases = F.array(
        F.when(F.length(joined).between(LEAST_TOKEN, 24), joined), F.when(F.size(latin) > 1, F.substring(F.array_join(latin, "-"), 1, 28)), F.get(latin, F.lit(0)),
    )
    return F.array_distinct(F.flatten(F.transform(F.array_compact(bases), lambda b: F.array(F.concat(b, F.lit(".ru")), F.concat(b, F.lit(".com"))))))


def named_in(text: Column, tokens: Column) -> Column:
    """Whether a word of the name, or its Latin form of four letters and more, occurs in a text."""
    low = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ё"), F.lit("е"))
    return F.exists(tokens, lambda w: F.contains(low, w) | ((F.length(translit(w)) >= LEAST_TOKEN) & F.contains(low, translit(w))))


def city_code(c: Column) -> Column:
    code = F.regexp_replace(translit(F.trim(c)), "[^a-z0-9]+", "")
    return F.when(code == "", F.lit("x")).otherwise(code)


def parameter_hash(*parts: Column) -> Column:
    """Eight hexadecimal digits for parameters, whatever their case and white space."""
    return F.substring(F.sha1(F.concat_ws("|", *[squeeze(F.lower(p.cast("string"))) for p in parts])), 1, 8)


def crawl_delay(robots: Column, least: float = LEAST_DELAY) -> Column:
    """Seconds between requests: what robots.txt asks for, but never under least."""
    asked = F.regexp_extract(F.coalesce(robots, F.lit("")), r"(?i)crawl-delay:\s*(\d+)", 1).try_cast("double")
    return F.greatest(F.lit(least), F.coalesce(asked, F.lit(least)))


def judge_reply(c: Column, verdicts: tuple[str, ...], field: str = "verdict") -> Column:
    """A judge's answer from its first brace to its last one, as struct<verdict, profile, reason>; null if it is no JSON or its verdict isn't listed."""
    body = F.regexp_extract(F.coalesce(c, F.lit("")), r"(?s)\{.*\}", 0)
    j = F.from_json(body, f"`{field}` string, profile array<string>, reason string", {"mode": "PERMISSIVE"})
    answer = F.struct(j[field].alias("verdict"), F.coalesce(j["profile"], F.array().cast("array<string>")).alias("profile"), F.substring(F.coalesce(j["reason"], F.lit("")), 1, 300).alias("reason"))
    return F.when(j[field].isin(*verdicts), answer)


def price_outcome(items: Column, page_found: Column, reachable: Column, files: Column) -> Column:
    """Why a company has prices or none: the first of five outcomes that applies."""
    conditions = (items > 0, page_found, ~F.coalesce(reachable, F.lit(True)), files > 0)
    out = F.lit(OUTCOMES[-1])
    for condition, label in reversed(list(zip(conditions, OUTCOMES, strict=False))):
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def plain_line(c: Column) -> Column:
    """A line without link marks, emphasis and loose punctuation at its ends."""
    s = F.regexp_replace(c, r"\[([^\]]*)\]\([^)]*\)", "$1")
    return F.regexp_replace(squeeze(F.regexp_replace(s, "[#*_>`]+", " ")), r"^[ ·|;:.,–—-]+|[ ·|;:.,–—-]+$", "")


def link_priority(url: Column, label: Column, hints: tuple[tuple[str, ...], ...]) -> Column:
    """The place of the first group of hints of which one occurs in the url or label; null for none."""
    probe = F.lower(F.concat_ws(" ", url, label))
    out = F.lit(None).cast("int")
    for place, group in reversed(list(enumerate(hints))):
        hit = reduce(lambda a, b: a | b, [F.contains(probe, F.lit(h)) for h in group])
        out = F.when(hit, F.lit(place)).otherwise(out)
    return out
