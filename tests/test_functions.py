"""Golden cases of functions and extraction."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from orestead.functions import masking, price, text, web
from orestead.operators import extraction, joins, state, stats, windows


def one(spark, c, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(c(F.col("v"))).collect()]


def test_prices(spark):
    cases = {"32040.00 ₽": 32040.0, "400,00 ₽": 400.0, "4 100.00 ₽": 4100.0, "2.500 ₽": 2500.0, "36.000₽": 36000.0, "1 500,50 ₽": 1500.5, "350 руб.": 350.0, "0 ₽": 0.0, "от 900 руб": None, "нет": None}
    assert one(spark, price.line_value, *cases) == list(cases.values())
    assert one(spark, price.number, "4 100,50", "368.200", "", "x") == [4100.5, 368200.0, None, None]


def test_link_scent(spark):
    rows = spark.createDataFrame([("Прайс", "/a.pdf"), ("Цены", "/x"), ("", "/price/"), ("Пациентам", "/p"), ("Цены", "/a.jpg"), ("", None), ("Новости", "/n")], "l string, h string")
    assert [r[0] for r in rows.select(price.link_scent(F.col("l"), F.col("h"))).collect()] == [100, 80, 70, 30, 0, 0, 0]


def test_service_names_meet(spark):
    a, b, c, d = one(spark, text.service_name, "Первичная консультация врача-дерматолога", "Приём дерматолога повторный", "Удаление папиллом (1 зона) до 5 мм / шея", None)
    assert a == b == "прием дерматолога"
    assert c.startswith("удаление папиллом") and "5" not in c and d == ""


def test_names_and_domains(spark):
    assert one(spark, text.company_name, 'ООО "Ромашка" клиника', None) == ["ромашка", ""]
    assert one(spark, text.domain, "https://www.Example.ru:80/a?b", "example.ru", "", None) == ["example.ru", "example.ru", None, None]
    assert one(spark, text.all_sites, "a.ru, www.b.ru; a.ru", None) == [["a.ru", "b.ru"], []]
    assert one(spark, text.without_ui, "Акция! Чистка лица, записаться подробнее", "[ФИО] приём") == ["Чистка лица", "приём"]
    assert one(spark, text.tax_number, "123456789", "12-34567890", "12", None) == ["0123456789", "1234567890", None, None]
    assert one(spark, lambda c: text.shard_of(c, 7), "www.Клиника.рф", "a.ru") == [zlib.crc32("клиника.рф".encode()) % 7 + 1, zlib.crc32(b"a.ru") % 7 + 1]


def test_masking(spark):
    assert masking.mask_names("Принимает Иванов Иван Иванович и Петрова А. Б.") == "Принимает [ФИО] и [ФИО]"
    assert masking.mask_names("имени Иванова") == "имени Иванова"
    assert masking.street_and_house("г. Самара, ул. Ленина, д. 12 к. 3") == ("ленина", "12к3")
    assert masking.street_and_house("Самара") is None
    assert masking.best_match("чистка лица ультразвуковая", ["чистка лица ультразвуковая.", "массаж"]) == "чистка лица ультразвуковая."
    assert masking.best_match("массаж", ["чистка"]) is None
    assert one(spark, masking.masked, "Иванов Иван Иванович", None) == ["[ФИО]", None]


def test_masking_of_capitals_and_short_patronymics(spark):
    cases = {
        "Врач ИВАНОВА МАРИЯ ПЕТРОВНА ведёт приём": "Врач [ФИО] ведёт приём", "ПЕТРОВ ПЁТР СЕРГЕЕВИЧ": "[ФИО]",
        "Принимает Иванов Пётр Ильич, терапевт": "Принимает [ФИО], терапевт", "Пётр Кузьмич Иванов": "[ФИО]", "Отзыв: Иван Лукич": "Отзыв: [ФИО]",
    }
    assert [masking.mask_names(x) for x in cases] == list(cases.values())
    assert one(spark, masking.has_name, *cases) == [True] * len(cases)
    others = ["ЦЕНТР ИМЕНИ ПЕТРОВНА", "НОВЫЕ ЦЕНЫ СЕГОДНЯ", "Красный Кирпичный завод", None]
    assert [masking.mask_names(x) for x in others] == others
    assert one(spark, masking.has_name, *others) == [False] * len(others)


def items_of(spark, body):
    rows = extraction.extract_items(spark.createDataFrame([(1, body)], "page long, body string"), "body", ["page"])
    return [r.asDict() for r in rows.orderBy("pos").collect()]


def test_price_text_triplets_pairs_and_branches(spark):
    items = items_of(spark, "АМБУЛАТОРНО > ДЕРМАТОЛОГИЯ\nDRMT7\nДерматоскопия кожи прибором\n124 у. е. / 12 437 руб.\nПриём врача первичный — 1 500 руб.\nУдаление от 900 руб.\nтекст без цены")
    assert [(i["code"], i["name"], i["price_value"]) for i in items] == [("DRMT7", "Дерматоскопия кожи прибором", 12437.0), ("", "Приём врача первичный", 1500.0), ("", "Удаление", None)]
    assert "ДЕРМАТОЛОГИЯ" in items[0]["section"] and "от 900" in items[2]["price_raw"]
    branches = items_of(spark, "Кошка rFel IgE анализ\n2 100.00 ₽\nЦены по филиалам\nКошка rFel IgE анализ\nг. Арзамас, пр. Ленина, д. 135\n2500 ₽")
    assert branches[1]["name"] == "Кошка rFel IgE анализ" and branches[1]["section"] == "филиал: г. Арзамас, пр. Ленина, д. 135"
    assert [b["price_value"] for b in branches] == [2100.0, 2500.0]


def test_price_text_entries(spark):
    items = items_of(spark, "  ОБЩИЕ УСЛУГИ \r\nПервая длинная строка названия\nхвост строки\n----\n300 ₽\n500 ₽\nОдна строка названия тут\nДругая длинная строка тут\n1 000 - 2 000 руб.\nКод\nAB12\nИмя услуги\nот 50 руб.\nЧистка 1 000 - 2 000 руб.\n" + "я" * 301 + "\n70 ₽")
    assert [(i["section"], i["code"], i["name"], i["price_raw"], i["price_value"], i["currency"]) for i in items] == [
        ("ОБЩИЕ УСЛУГИ", "", "Первая длинная строка названия, хвост строки", "300 ₽", 300.0, "RUB"),
        ("ОБЩИЕ УСЛУГИ", "AB12", "Имя услуги", "от 50 руб.", None, "RUB"),
        ("ОБЩИЕ УСЛУГИ", "", "Чистка", "1 000 - 2 000 руб.", None, "RUB"),
    ]


def test_tables_and_repeated_blocks(spark):
    html = "<table><tr><td>Консультации врачей</td></tr><tr><td>Приём дерматолога</td><td>1 500 ₽</td></tr><tr><td>Осмотр</td><td>900</td></tr><tr><td>123</td><td>77</td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, html)], "page long, body string")
    got = extraction.extract_items(pages, "body", ["page"], "html").orderBy("page", "pos").collect()
    assert [(r.page, r.section, r.name, r.price_value) for r in got] == [(k, "Консультации врачей", *x) for k in (1, 3) for x in (("Приём дерматолога", 1500.0), ("Осмотр", 900.0))]
    cards = "".join(f"<div class='card'><span>Процедура номер {i}</span><b>{i}00 ₽</b></div>" for i in range(1, 6))
    blocks = spark.createDataFrame([(1, f"<main>{cards}</main>"), (2, None), (3, cards.split("</div>")[0])], "page long, html string")
    assert sorted((r.page, r.price_value) for r in extraction.repeated_blocks(blocks, "page", "html").collect()) == [(1, v) for v in (100.0, 200.0, 300.0, 400.0, 500.0)]
    assert web.html_to_text("<p>a <b>b</b></p><script>x</script><tr><td>1</td><td>2</td></tr>") == "a b\n1 | 2"


def test_cell_values(spark):
    cases = {"1 500 ₽": 1500.0, "900": 900.0, "50 руб.": None, "15 %": None, "№ 300": None, "100 200 300 раз": None, "около 500": None, "от 700 руб": 700.0, "": None, "500 / 600 ₽": None, "9" * 41: None}
    assert one(spark, price.cell_value, *cases, None) == [*cases.values(), None]


def test_items_from_pages(spark):
    pages = spark.createDataFrame([(1, "Чистка лица 1 500 ₽"), (2, "Чистка лица 1 500 ₽"), (3, None)], "page long, body string")
    got = extraction.extract_items(pages, "body", ["page"]).collect()
    assert sorted((r.page, r.name, r.price_value) for r in got) == [(1, "Чистка лица", 1500.0), (2, "Чистка лица", 1500.0)]


def test_sanitising(spark):
    rows = spark.createDataFrame([("Введение S;16", "000 ₽; А11", 0.0), ("Осмотр ;", "900 ₽", 900.0)], "name string, price_raw string, price_value double")
    assert [tuple(r) for r in extraction.repair_thousands(rows).collect()] == [("Введение S", "16 000 ₽", 16000.0), ("Осмотр", "900 ₽", 900.0)]
    serial = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([10, 11, 12, 13, 14, 100, 7, 8, 300])], "d long, pos long, v double")
    assert [r.v for r in extraction.drop_serials(serial, ["d"], "pos", "v").orderBy("pos").collect()] == [100.0, 7.0, 8.0, 300.0]


def test_verification_ladder(spark):
    pages = ["ИНН 7701234567", "ИНН: 7709999999", "лицензия Л041 - 0116263", "ул. Ленина 5", "", None]
    df = spark.createDataFrame([(x,) for x in pages], "p string")
    v = extraction.verification(F.col("p"), F.lit("7701234567"), F.array(F.lit("Л041-0116263")), F.contains("p", F.lit("Ленина")), F.lit(1))
    assert [r[0].verdict for r in df.select(v).collect()] == ["tax number", None, "licence number", "licence address", None, None]


def test_fisher(spark):
    from math import comb

    a, b, c, d = 8, 2, 1, 5
    chance = lambda x: comb(a + b, x) * comb(c + d, a + c - x) / comb(a + b + c + d, a + c)
    want = sum(chance(x) for x in range(max(0, a + c - c - d), min(a + b, a + c) + 1) if chance(x) <= chance(a) + 1e-12)
    got = spark.range(1).select(stats.fisher(*[F.lit(x) for x in (a, b, c, d)])).first()[0]
    assert got == pytest.approx(want, abs=1e-9)


def test_saturation_equals_the_loop(spark):
    import random

    rng = random.Random(3)
    new = [int(rng.random() < 300 / (i + 300) ** 1.2) for i in range(2000)]
    size, want = 500, None
    for i in range(1, 2001):
        if i >= 1200 and sum(new[max(0, i - size) : i]) < 3:
            want = i
            break
    df = spark.createDataFrame(list(enumerate(new)), "seq long, new int")
    assert windows.saturation(df, "seq", "new", 2000).first()["at_query"] == want
    assert windows.saturation(df.limit(100), "seq", "new", 100).first()["at_query"] is None


def test_sections_cascade_and_merges(spark):
    items = spark.createDataFrame([("a", "n", None), ("a", "n", "s1")], "domain string, name string, section string")
    dirs = spark.createDataFrame([("a", "n", "s1", "D1"), ("a", "n", "s2", "D2")], "domain string, name string, section string, direction string")
    assert joins.join_with_section(items, dirs, ["domain", "name"], "section").count() == 3
    main = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    shard = spark.createDataFrame([(1, "new"), (2, None)], "k long, v string")
    once = state.merge_shard(main, shard, ["k"], F.col("k") <= 2, ["v"])
    twice = state.merge_shard(once, shard, ["k"], F.col("k") <= 2, ["v"])
    assert once.collect() == twice.collect() and {r.k: r.v for r in once.collect()} == {1: "new", 2: None}
    assert state.insert_if_absent(main, spark.createDataFrame([(2, "z"), (3, "w")], "k long, v string"), ["k"]).count() == 3


def test_robots(spark):
    rows = spark.createDataFrame([("/fr/", "/fr/x"), ("/*.html$", "/a.html"), ("/*.html$", "/a.html?x"), ("/a.b", "/aXb")], "p string, path string")
    assert [r[0] for r in rows.select(F.regexp("path", web.robots_regex(F.col("p")))).collect()] == [True, True, False, False]


def test_punycode_and_guards(spark):
    assert one(spark, text.domain, "https://Плазмасибирь.рф/x", "www.ПЛАЗМАСИБИРЬ.РФ:80", "a..рф") == ["плазмасибирь.рф".encode("idna").decode()] * 2 + ["a..рф"]
    pair = "доброкачественное новообразование кожи"
    assert masking.best_match("злокачественное новообразование кожи", [pair], 0.8) is None
    assert masking.best_match(pair + ".", [pair], 0.8) == pair


def test_numbering_by_ranges(spark):
    rows = spark.createDataFrame([(i * 7919 % 500 // 3, i) for i in range(500)], "a long, b long")
    got = windows.numbered(rows, [-F.col("a"), F.col("b")], "seq", 40).collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.seq)] == sorted(((r.a, r.b) for r in got), key=lambda x: (-x[0], x[1]))
    assert sorted(r.seq for r in got) == list(range(1, 501))
    assert windows.numbered(rows.limit(0), [F.col("a")], "seq").count() == 0


def test_last_of_repeated_imports(spark):
    held, new = spark.createDataFrame([(1, 5), (2, 6)], "k long, v long"), spark.createDataFrame([(2, 7), (2, 9), (3, 1)], "k long, v long")
    assert sorted(map(tuple, state.replace_on_key(held, new, ["k"], [F.col("v")]).collect())) == [(1, 5), (2, 9), (3, 1)]
