"""Queries over names: samples of each kind are dealt to the rows of a table, and the SQL states what each must give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import windows
from .base import DIRECTED, ITEMS, Tables, query

DROPPED = (*text.LEGAL_FORMS, *text.NAME_STOP_WORDS[:6])


def _literal(v: object) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"{v}::DOUBLE" if isinstance(v, float) else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def _golden(name: str, samples: dict, apply, doc: str) -> None:
    """Registers a query that deals samples to the parts and applies a function; its SQL deals out the values that must come."""
    keys, values = list(samples), list(samples.values())
    listed = ", ".join(map(_literal, values))

    def run(t: Tables) -> DataFrame:
        kept = F.array(*[F.lit(k) for k in keys])
        sample = F.get(kept, (F.col("p_partkey") % len(keys)).cast("int"))
        return t.part.select("p_partkey", sample.alias("sample")).select("p_partkey", apply(F.col("sample")).alias("value"))

    run.__doc__ = doc
    query(name, f"SELECT p_partkey, ([{listed}])[p_partkey % {len(keys)} + 1] AS value FROM part")(run)


def _reply(c: Column) -> Column:
    reply = names.judge_reply(c, ("A1", "A2"))
    return F.when(reply.isNotNull(), F.concat(reply["verdict"], F.lit(":"), F.size(reply["profile"]).cast("string"), F.lit(":"), reply["reason"]))


_golden("fn_valid_name", {
    "Приём врача-дерматолога": True, "2000 2000": False, "УЗИ 12345678901": False, "Чистка ● Массаж лица": False, "Чистка лица 500 руб": False, "контракта руб. / штука": False, "Консультация": False,
    "консультации.": False, "Петрова Анна Сергеевна": False, "Приём ведёт Петрова Анна Сергеевна сегодня": False, "Доступно онлайн сегодня": False, "/ Главная / Цены": False, "с 24 сентября скидки": False,
    "по телефону клиники": False, "чистка лицевая и чистка лицевая глубокая": False, "Удаление папиллом": True, "Диспорт 300": True, "": False, "Массаж спины и массаж спины": False, "Массаж спины и шеи": True,
}, names.valid_name, "Whether a text can be a priced service's name.")
_golden("fn_ui_garbage", {
    "Записаться": True, "цена от": True, "1 500 руб.": True, "Акция месяца": True, "ПН-ПТ 9:00": False, "пн 9.00 до 18:00": False, "Врачи": True, "Ольга Петрова Ирина Сидорова": True, "Ольга Петрова": False,
    "да": True, "Чистка лица ультразвуковая": False, "первичная консультация": True, "Прием врача записаться на прием": True, "Стаж 12 лет": True, "Сертификат": True, "Удаление родинки": False, None: True,
}, names.ui_garbage, "Whether all of a text is an interface label or a list of people.")
_golden("fn_clean_of_html", {"Чистка лица": True, "<b>Чистка": False, "div class=x": False, "span": False, "Спанбонд &#160;": False, None: True, "spandex": True}, names.clean_of_html, "Names with left-overs of HTML go.")
_golden("fn_headline", {"Клиника Здоровье": False, "Лечение купероза на лице": True, "Цены на услуги": False, "Все цены клиники": True, "Прайс": True, None: False, "К" * 61: True, "К" * 60: False}, names.headline, "Headlines of pages that are no names.")
_golden("fn_ownership", {
    "ООО Ромашка|ГБУЗ рядом": "частная", "ГБУЗ Больница|ООО": "государственная", "Ромашка|лицензия министерства здравоохранения": "государственная", "Ромашка|ООО Ромашка": "частная (по тексту сайта, Уточнить)",
    "|": "Уточнить", "СООО|текст": "Уточнить",
}, lambda c: names.ownership(F.split_part(c, F.lit("|"), F.lit(1)), F.split_part(c, F.lit("|"), F.lit(2))), "A company's form of ownership: its legal name outranks the page.")
_golden("fn_map_name", {"НОВЫЕ МЕТОДЫ, ООО КДЛ": "НОВЫЕ МЕТОДЫ", "ООО КДЛ": "ООО КДЛ", "Ромашка, , Лютик": "Ромашка Лютик", "": "", "Астра, ИП": "Астра"}, names.map_name, "Segments with a legal form leave a name for maps.")
_golden("fn_translit", {"Щука": "schuka", "Объём юбки": "obem yubki", "Жизнь 24": "zhizn 24", "": "", "Ёлка": "elka", "Café": "caf"}, names.translit, "Latin letters for Cyrillic ones.")
_golden("fn_domain_candidates", {
    "ООО Здоровье Всем": "zdorove.ru", "Астра": "astra.ru astra.com", "ИП": "",
}, lambda c: F.when(c == "ООО Здоровье Всем", F.element_at(names.domain_candidates(names.name_tokens(c, DROPPED)), -2)).otherwise(F.array_join(names.domain_candidates(names.name_tokens(c, DROPPED)), " ")), "Domains that a name may have.")
_golden("fn_named_in", {"клиника Астра в городе": True, "visit ASTRA today": True, "Астория": False, "": False, "аст ра": False}, lambda c: names.named_in(c, names.name_tokens(F.lit("ООО Астра"), DROPPED)), "Whether a page names the company.")
_golden("fn_city_code", {"Нижний Новгород": "nizhniynovgorod", "Ростов-на-Дону": "rostovnadonu", "  Уфа ": "ufa", "北京": "x", "": "x"}, names.city_code, "Codes of cities.")
_golden("fn_crawl_delay", {"User-agent: *\nCrawl-delay: 10": 10.0, "crawl-delay:1": 3.0, "": 3.0, "Crawl-Delay:   7\nDisallow: /": 7.0, "Crawl-delay: x": 3.0, None: 3.0}, names.crawl_delay, "Seconds between requests to a host.")
_golden("fn_judge_reply", {
    'Ответ: {"verdict":"A1","profile":["x","y"],"reason":"r"} конец': "A1:2:r", '{"verdict":"Z9"}': None, "no json": None, '{"verdict":"A2"}': "A2:0:", '{"verdict":"A1"': None, "": None, None: None,
}, _reply, "A judge's answer against a closed list of verdicts.")
_golden("fn_plain_line", {"## **Чистка** [лица](http://x.ru) -": "Чистка лица", " - a_b; ": "a b", "`код`": "код", "": ""}, names.plain_line, "Lines without marks.")
_golden("fn_link_priority", {
    "https://a.ru/PRICE|": 0, "https://a.ru/x|Услуги": 0, "https://a.ru/doctors|Врачи": 1, "https://a.ru/about|": 2, "https://a.ru/news|Новости": None,
}, lambda c: names.link_priority(F.split_part(c, F.lit("|"), F.lit(1)), F.split_part(c, F.lit("|"), F.lit(2)), (("price", "услуг"), ("doctor", "врач"), ("about",))), "Which links a crawl follows first.")


@query("fn_parameter_hash", "SELECT c_custkey, left(sha1(lower(c_name) || '|' || c_nationkey || '|two words'), 8) AS hash FROM customer")
def parameter_hash(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", names.parameter_hash(F.concat(F.lit("  "), F.upper("c_name")), F.col("c_nationkey"), F.lit("Two \t WORDS ")).alias("hash"))


@query("cls_price_outcome", """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'прайс извлечён' WHEN s_suppkey % 3 = 0 THEN 'страница прайса найдена, цены не извлечены' WHEN s_suppkey % 5 = 0 THEN 'сайт недоступен на дату проверки'
 WHEN s_suppkey % 7 = 0 THEN 'прайс-файл не разобран на дату проверки' ELSE 'прайс не найден на дату проверки' END AS outcome FROM supplier""")
def price_outcome(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    reachable = F.when(k % 5 == 0, F.lit(False)).when(k % 4 == 1, F.lit(True))
    return t.supplier.select("s_suppkey", names.price_outcome((k % 2 == 0).cast("int"), k % 3 == 0, reachable, (k % 7 == 0).cast("int")).alias("outcome"))


@query("j_unjudged_provider", """SELECT c_custkey, p AS provider FROM customer, (VALUES ('1-URGENT'), ('2-HIGH')) v(p) WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = p)""")
def unjudged(t: Tables) -> DataFrame:
    """Rows that a provider hasn't judged: an anti-join on both keys; the providers are a short list in each row."""
    asked = t.customer.select("c_custkey", F.explode(F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))).alias("provider"))
    judged = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("provider"))
    return asked.join(judged, ["c_custkey", "provider"], "left_anti")


@query("j_rejected_edges", "SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE (o_custkey, l_suppkey) NOT IN (SELECT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')")
def rejected_edges(t: Tables) -> DataFrame:
    """Company and site pairs of which none was rejected: one aggregation in place of an anti-join."""
    edges = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return edges.groupBy("o_custkey", "l_suppkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("rejected")).where("not rejected").select("o_custkey", "l_suppkey")


@query("agg_broken_domains", f"WITH {ITEMS} SELECT domain, count(*) AS n, count(*) FILTER (WHERE price < 10000) AS broken FROM items GROUP BY domain HAVING count(*) FILTER (WHERE price < 10000) * 20 >= count(*)")
def broken_domains(t: Tables) -> DataFrame:
    """Domains of which a twentieth or more of the items are broken."""
    a = t.items.groupBy("domain").agg(F.count("*").alias("n"), F.count_if(F.col("price") < 10000).alias("broken"))
    return a.where(F.col("broken") * 20 >= F.col("n"))


@query("set_union_items", f"""WITH {ITEMS}, u AS (SELECT domain, name, floor(price / 5000) AS price_band, 1 AS rank, pos FROM items WHERE pos % 2 = 0 UNION ALL SELECT domain, name, floor(price / 5000), 2, pos FROM items WHERE pos % 2 = 1)
 SELECT domain, name, price_band, rank FROM u QUALIFY row_number() OVER (PARTITION BY domain, name, price_band ORDER BY rank, pos) = 1""")
def union_items(t: Tables) -> DataFrame:
    """Item lists of two ways of extraction as one: of equal items the first list's stays."""
    band = F.floor(F.col("price") / 5000).cast("double")
    part = lambda even, rank: t.items.where(F.col("pos") % 2 == even).select("domain", "name", band.alias("price_band"), F.lit(rank).alias("rank"), "pos")
    return windows.first_per(part(0, 1).unionByName(part(1, 2)), ["domain", "name", "price_band"], [F.col("rank"), F.col("pos")]).drop("pos")


@query("top_seeded_sample")
def seeded_sample(t: Tables) -> DataFrame:
    """Fifty rows in an order of a seeded hash: the same ones in every run. SQL hasn't that hash."""
    return t.customer.select("c_custkey", F.xxhash64(F.lit(42), "c_custkey").alias("h")).orderBy("h", "c_custkey").limit(50).select("c_custkey")


@query("cls_contextual_mapping", f"""WITH {DIRECTED}, v AS (SELECT DISTINCT domain, name, section, CASE WHEN regexp_matches(name, '^new') THEN 'new' END AS garbage,
 CASE section WHEN 'PROMO' THEN 'Promotion' WHEN 'SMALL' THEN 'Fitted' WHEN 'LARGE' THEN 'Heavy' END AS by_section, CASE WHEN direction <> 'Promotion' THEN direction END AS by_name FROM directed),
 m AS (SELECT *, CASE WHEN by_section IS NOT NULL AND garbage IS NULL THEN by_section WHEN by_name IS NOT NULL THEN by_name WHEN section = 'ECONOMY' THEN 'Laboratory' WHEN regexp_matches(name, 'blue') THEN 'Extra' END AS direction, by_section <> by_name AND garbage IS NULL AS conflict FROM v),
 c AS (SELECT domain, section, direction, count(*) AS n FROM m WHERE direction IS NOT NULL GROUP BY ALL), j AS (SELECT domain, section, direction AS major FROM (SELECT *, sum(n) OVER (PARTITION BY domain, section) AS total FROM c) WHERE n >= 5 AND n * 10 >= total * 6)
 SELECT domain, name, section, coalesce(direction, major) AS direction, coalesce(conflict, false) AS conflict, direction IS NULL AND major IS NOT NULL AS inherited FROM m LEFT JOIN j USING (domain, section)""")
def contextual_mapping(t: Tables) -> DataFrame:
    """A section's direction beats the name's, unless the name is a label; then fallback layers, then what most of the section has. Sections and names that disagree are marked."""
    by_section = F.when(F.col("section") == "PROMO", "Promotion").when(F.col("section") == "SMALL", "Fitted").when(F.col("section") == "LARGE", "Heavy")
    label = F.col("name").rlike("^new")
    rows = t.directed.select("domain", "name", "section", F.when(F.col("direction") != "Promotion", F.col("direction")).alias("by_name")).distinct().withColumn("by_section", by_section)
    fallback = F.when(F.col("section") == "ECONOMY", "Laboratory").when(F.col("name").rlike("blue"), "Extra")
    rows = rows.withColumn("direction", F.coalesce(F.when(~label, F.col("by_section")), F.col("by_name"), fallback))
    rows = rows.withColumn("conflict", F.coalesce((F.col("by_section") != F.col("by_name")) & ~label, F.lit(False)))
    major = windows.majority(rows, ["domain", "section"], "direction").select("domain", "section", "major")
    rows = rows.join(major, ["domain", "section"], "left")
    inherited = F.col("direction").isNull() & F.col("major").isNotNull()
    return rows.select("domain", "name", "section", F.coalesce("direction", "major").alias("direction"), "conflict", inherited.alias("inherited"))
