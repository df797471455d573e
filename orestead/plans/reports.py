"""Final reports, integrity checks, and the remaining text and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import masking, text
from ..operators import extraction, windows
from ..shipping import ship
from .base import DIRECTED, ITEMS, Tables, query
from .profile import SEGMENTS, composition, segments


@query("fn_norm_service", "SELECT p_partkey, p_name AS name FROM part")
def norm_service(t: Tables) -> DataFrame:
    """Brackets, tails and numbers around a name leave its key."""
    dressed = F.concat(F.upper("p_name"), F.lit(" (2 шт.) № "), F.col("p_size").cast("string"), F.lit(" / "), F.col("p_brand"))
    return t.part.select("p_partkey", text.service_name(dressed).alias("name"))


@query("fn_company_name", "SELECT s_suppkey, lower(translate(lower(s_name), 'abcehkmoptxy#', 'авсенкмортху#')) AS name FROM supplier")
def company_name(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", text.company_name(F.concat(F.lit("ООО «"), F.col("s_name"), F.lit("»"))).alias("name"))


@query("fn_split_sites", "SELECT s_suppkey, 's' || s_suppkey || '.ru s' || (s_suppkey % 7) || '.com' AS sites FROM supplier WHERE true")
def split_sites(t: Tables) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    cell = F.concat(F.lit("https://www.s"), k, F.lit(".ru/a, s"), (F.col("s_suppkey") % 7).cast("string"), F.lit(".com; S"), k, F.lit(".RU"))
    return t.supplier.select("s_suppkey", F.array_join(text.all_sites(cell), " ").alias("sites"))


@query("fn_first_site", "SELECT s_suppkey, 's' || s_suppkey || '.ru:80' AS site FROM supplier")
def first_site(t: Tables) -> DataFrame:
    cell = F.concat(F.lit("HTTP://www.S"), F.col("s_suppkey").cast("string"), F.lit(".ru:80/x?y, other.ru"))
    return t.supplier.select("s_suppkey", text.first_site(cell).alias("site"))


@query("fn_family_key", "SELECT DISTINCT p_name, 'пилинг лица' AS family FROM part")
def family_key(t: Tables) -> DataFrame:
    return t.part.select("p_name").distinct().withColumn("family", text.family_key(F.concat(F.lit("Пилинг лица "), F.col("p_name"), F.lit(" 5"))))


@query("fn_head_tail", "SELECT doc_id, CASE WHEN length(text) > 300 THEN left(text, 200) || chr(10) || right(text, 100) ELSE text END AS text FROM documents")
def head_tail(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.head_and_tail(F.col("text"), 200, 100).alias("text"))


@query("fn_cell", r"SELECT conv_id, turn, regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '·', 'g') AS text FROM conversations")
def cell(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.cell(F.col("text")).alias("text"))


@query("fn_masked_names")
def masked_names(t: Tables) -> DataFrame:
    """Names anywhere in documents; context decides, so it is a pandas UDF, tested on golden cases. `line` is the whole text, all its lines."""
    ship(t.spark)
    return t.documents.select("doc_id", masking.masked(F.concat(F.lit("Иванов Иван Иванович: "), F.col("text"))).alias("line"), masking.has_name(F.col("text")).alias("has_name"))


@query("j_fuzzy_match")
def fuzzy_match(t: Tables) -> DataFrame:
    """Exact matches go first; what is left is compared by matching blocks with a dictionary of a few names."""
    ship(t.spark)
    listed = sorted(f"{a} {b}" for a in ("red", "blue", "small") for b in ("ring", "widget", "plate"))
    names = t.part.select("p_name").distinct().withColumn("spelt", F.concat("p_name", F.lit(".")))
    exact = names.where(F.col("p_name").isin(listed)).select("spelt", F.col("p_name").alias("match"), F.lit("exact").alias("how"))
    rest = names.where(~F.col("p_name").isin(listed)).select("spelt", masking.fuzzy(F.col("spelt"), listed, 0.8).alias("match"), F.lit("fuzzy").alias("how"))
    return exact.unionByName(rest)


@query("j_token_overlap", """WITH s AS (SELECT DISTINCT p_name AS a, unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_partkey % 2 = 0), r AS (SELECT DISTINCT p_name AS b, unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_partkey % 2 = 1),
 x AS (SELECT a, s.w, b, (SELECT count(*) FROM r z WHERE z.w = s.w) AS holders FROM s JOIN r ON s.w = r.w WHERE length(s.w) >= 5)
 SELECT a, w AS word, b, shared FROM (SELECT *, (SELECT count(DISTINCT y.w) FROM x y WHERE y.a = x.a) AS shared FROM x) QUALIFY row_number() OVER (PARTITION BY a ORDER BY holders, w, b) = 1""")
def token_overlap(t: Tables) -> DataFrame:
    """The best partner of names that share words of five letters: by the rarest word, then the first name that has it.

    Each word is reduced to how many names hold it and the first of them before the join, so a frequent word makes a row
    per name and not a row per pair.
    """
    name = lambda k: t.part.where(F.col("p_partkey") % 2 == k).select("p_name").distinct()
    tokens = lambda df, c: df.select(F.col("p_name").alias(c), F.explode(F.array_distinct(F.split("p_name", " "))).alias("word")).where(F.length("word") >= 5)
    words = tokens(name(1), "b").groupBy("word").agg(F.count("*").alias("holders"), F.min("b").alias("b"))
    met = tokens(name(0), "a").join(words, "word").groupBy("a").agg(F.min(F.struct("holders", "word", "b")).alias("m"), F.count("*").alias("shared"))
    return met.select("a", "m.word", "m.b", "shared")


PRICE_LIST = ("ОБЩИЕ УСЛУГИ\nПриём врача {} — 1 {} руб.\nУдаление от 900 руб.\nМассаж спины общий\n2 000 ₽\nAB12\nАнализ крови клинический\nс забором\n4 {} руб.\n--\n500 ₽\n"
 "г. Самара, ул. Ленина, д. 5\n700 ₽\nУЗИ > СЕРДЦЕ\nВведение препарата;16\n000 ₽")  # fmt: skip


@query("ex_items_text", """WITH s AS (SELECT s_suppkey, 'врача ' || translate(s_name, '0123456789#', 'абвгдежзик') AS who, lpad((s_suppkey % 900 + 100)::VARCHAR, 3, '0') AS n FROM supplier), b AS (SELECT 'ОБЩИЕ УСЛУГИ' AS g)
 SELECT s_suppkey, section, code, name, price_raw, price_value, 'RUB' AS currency FROM (
 SELECT s_suppkey, g AS section, '' AS code, 'Приём ' || who AS name, '1 ' || n || ' руб.' AS price_raw, 1000.0 + n::DOUBLE AS price_value FROM s, b
 UNION ALL SELECT s_suppkey, g, '', 'Удаление', 'от 900 руб.', NULL FROM s, b
 UNION ALL SELECT s_suppkey, g, '', 'Массаж спины общий', '2 000 ₽', 2000 FROM s, b
 UNION ALL SELECT s_suppkey, g, 'AB12', 'Анализ крови клинический, с забором', '4 ' || n || ' руб.', 4000.0 + n::DOUBLE FROM s, b
 UNION ALL SELECT s_suppkey, g || ' · филиал: г. Самара, ул. Ленина, д. 5', '', 'Анализ крови клинический, с забором', '700 ₽', 700 FROM s, b
 UNION ALL SELECT s_suppkey, 'УЗИ > СЕРДЦЕ', '', 'Введение препарата', '16 000 ₽', 16000 FROM s)""")
def items_text(t: Tables) -> DataFrame:
    """Items of each supplier's price list, with the repair of split numbers and the check for serials behind it."""
    who = F.translate("s_name", "0123456789#", "абвгдежзик")
    n = F.lpad((F.col("s_suppkey") % 900 + 100).cast("string"), 3, "0")
    first, second, third, last = PRICE_LIST.split("{}")
    body = F.concat(F.lit(first), who, F.lit(second), n, F.lit(third), n, F.lit(last))
    items = extraction.extract_items(t.supplier.select("s_suppkey", body.alias("body")), "body", ["s_suppkey"])
    items = extraction.drop_serials(extraction.repair_thousands(items), ["s_suppkey"], "pos", "price_value")
    return items.select("s_suppkey", "section", "code", "name", "price_raw", "price_value", "currency")


@query("agg_org_gate", f"""WITH {ITEMS}, a AS (SELECT domain, count(DISTINCT name) AS total, count(DISTINCT CASE WHEN regexp_matches(name, 'ring|gear') THEN name END) AS hit, count(DISTINCT CASE WHEN regexp_matches(name, '^(hot|cold)') THEN name END) AS esthetic, bool_and(regexp_matches(name, 'rod')) AS lab FROM items GROUP BY domain)
 SELECT domain, CASE WHEN total = 0 THEN 'empty' WHEN lab THEN 'laboratory' WHEN hit * 100 >= total * 30 THEN 'profile' WHEN total >= 15 AND hit * 100 >= total * 15 THEN 'large profile' WHEN esthetic >= 2 THEN 'esthetic' ELSE 'out' END AS gate FROM a""")
def org_gate(t: Tables) -> DataFrame:
    named = lambda rx: F.countDistinct(F.when(F.col("name").rlike(rx), F.col("name")))
    a = t.items.groupBy("domain").agg(F.countDistinct("name").alias("total"), named("ring|gear").alias("hit"), named("^(hot|cold)").alias("esthetic"), F.bool_and(F.col("name").rlike("rod")).alias("lab"))
    gate = (
        F.when(F.col("total") == 0, "empty").when(F.col("lab"), "laboratory").when(F.col("hit") * 100 >= F.col("total") * 30, "profile")
        .when((F.col("total") >= 15) & (F.col("hit") * 100 >= F.col("total") * 15), "large profile").when(F.col("esthetic") >= 2, "esthetic").otherwise("out")
    )
    return a.select("domain", gate.alias("gate"))


@query("rep_segment_medians", SEGMENTS + ", n AS (SELECT inn, sum(n)::BIGINT AS positions FROM comp GROUP BY inn) SELECT segment, count(*) AS companies, median(positions) AS mid, max(positions) AS top FROM seg JOIN n USING (inn) GROUP BY segment")
def segment_medians(t: Tables) -> DataFrame:
    n = composition(t).groupBy("inn").agg(F.sum("n").alias("positions"))
    return segments(t).join(n, "inn").groupBy("segment").agg(F.count("*").alias("companies"), F.median("positions").alias("mid"), F.max("positions").alias("top"))


@query("rep_company_summary", """SELECT c_custkey, c_name, n_name, count(o_orderkey) AS licences, count(*) FILTER (WHERE o_orderstatus = 'F') AS active, min(o_orderdate) AS first, CASE WHEN count(o_orderkey) = 0 THEN 'нет' WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN 'да' ELSE 'истекла' END AS licensed
 FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def company_summary(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("licences"), F.count_if(F.col("o_orderstatus") == "F").alias("active"), F.min("o_orderdate").alias("first"))
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(per, F.col("o_custkey") == F.col("c_custkey"), "left").fillna(0, ["licences", "active"])
    return rows.select("c_custkey", "c_name", "n_name", "licences", "active", "first", F.when(F.col("licences") == 0, "нет").when(F.col("active") > 0, "да").otherwise("истекла").alias("licensed"))


@query("rep_quality_counters", f"WITH {DIRECTED} SELECT count(*) AS items, count(*) FILTER (WHERE direction IS NULL) AS untagged, count(*) FILTER (WHERE price < 1000) AS cheap, count(DISTINCT domain) AS domains, count(DISTINCT inn) AS companies FROM directed")
def quality_counters(t: Tables) -> DataFrame:
    return t.directed.agg(F.count("*").alias("items"), F.count_if(F.col("direction").isNull()).alias("untagged"), F.count_if(F.col("price") < 1000).alias("cheap"), F.countDistinct("domain").alias("domains"), F.countDistinct("inn").alias("companies"))


@query("rep_recipes", "SELECT s_suppkey, count(l_orderkey) AS items, max(l_extendedprice) AS top, CASE WHEN count(l_orderkey) = 0 THEN 'none' WHEN count(l_orderkey) < 50 THEN 'few' ELSE 'many' END AS outcome FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey")
def recipes(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("items"), F.max("l_extendedprice").alias("top"))
    rows = t.supplier.join(per, F.col("l_suppkey") == F.col("s_suppkey"), "left").fillna(0, ["items"])
    return rows.select("s_suppkey", "items", "top", F.when(F.col("items") == 0, "none").when(F.col("items") < 50, "few").otherwise("many").alias("outcome"))


@query("chk_one_tag_per_name", f"WITH {ITEMS} SELECT name, count(DISTINCT section) AS tags FROM items GROUP BY name HAVING count(DISTINCT section) > 1")
def one_tag(t: Tables) -> DataFrame:
    """Names under more than one tag: a clean dictionary gives none."""
    return t.items.groupBy("name").agg(F.countDistinct("section").alias("tags")).where("tags > 1")


@query("chk_range_inside", "SELECT a.n_nationkey AS inner_key, b.n_nationkey AS outer_key FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND b.n_nationkey <= a.n_nationkey AND a.n_nationkey + 5 <= b.n_nationkey + 15 AND a.n_nationkey <> b.n_nationkey")
def range_inside(t: Tables) -> DataFrame:
    """Ranges that fit inside another of the same block; blocks keep the interval join to an equi-join."""
    a, b = t.nation.select(F.col("n_nationkey").alias("inner_key"), "n_regionkey"), t.nation.select(F.col("n_nationkey").alias("outer_key"), "n_regionkey")
    return a.join(b, "n_regionkey").where("outer_key <= inner_key and inner_key + 5 <= outer_key + 15 and inner_key <> outer_key").select("inner_key", "outer_key")


@query("set_required_sections", f"WITH {ITEMS} SELECT domain, bool_or(section = 'PROMO') AND bool_or(section = 'LARGE') AND bool_or(section = 'SMALL') AS complete, count(DISTINCT section) AS have FROM items GROUP BY domain")
def required_sections(t: Tables) -> DataFrame:
    """Whether all required sections are there: nothing is left of them without those found."""
    need = F.array(*[F.lit(x) for x in ("PROMO", "LARGE", "SMALL")])
    g = t.items.groupBy("domain").agg(F.collect_set("section").alias("have"))
    return g.select("domain", (F.size(F.array_except(need, F.col("have"))) == 0).alias("complete"), F.size("have").cast("long").alias("have"))


@query("set_tag_intersection", f"WITH {ITEMS} SELECT domain, string_agg(DISTINCT section, '; ' ORDER BY section) AS shared FROM items WHERE section IN ('PROMO', 'ECONOMY') GROUP BY domain")
def tag_intersection(t: Tables) -> DataFrame:
    g = t.items.groupBy("domain").agg(F.sort_array(F.array_intersect(F.collect_set("section"), F.array(F.lit("PROMO"), F.lit("ECONOMY")))).alias("s"))
    return g.where(F.size("s") > 0).select("domain", F.array_join("s", "; ").alias("shared"))


@query("top_budget_queue", "SELECT p_partkey, kind, rn FROM (SELECT p_partkey, p_type = 'PROMO' AS kind, row_number() OVER (PARTITION BY p_type = 'PROMO' ORDER BY p_size DESC, p_partkey) AS rn FROM part) WHERE rn <= CASE WHEN kind THEN 40 ELSE 12 END")
def budget_queue(t: Tables) -> DataFrame:
    """Two budgets: branch pages and all others, each by score."""
    rows = t.part.select("p_partkey", (F.col("p_type") == "PROMO").alias("kind"), "p_size")
    ranked = windows.top_per(rows, ["kind"], [F.desc("p_size"), F.col("p_partkey")], 40)
    return ranked.where((F.col("kind")) | (F.col("rn") <= 12)).select("p_partkey", "kind", F.col("rn").cast("long").alias("rn"))


@query("st_migrate", "SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS acctbal FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 1")
def migrate(t: Tables) -> DataFrame:
    """An old table without a column joins a new one that has it."""
    old = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    new = t.customer.where("c_custkey % 2 = 1").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    return old.unionByName(new, allowMissingColumns=True)


@query("st_prefix_labels", "SELECT p_partkey, CASE WHEN starts_with(p_name, 'red') THEN 'warm' WHEN starts_with(p_name, 'cold') THEN 'cool' ELSE 'none' END AS label FROM part")
def prefix_labels(t: Tables) -> DataFrame:
    """Labels of truncated keys spread to every name that starts with one; the list is short, so it is a CASE."""
    label = F.when(F.startswith("p_name", F.lit("red")), "warm").when(F.startswith("p_name", F.lit("cold")), "cool").otherwise("none")
    return t.part.select("p_partkey", label.alias("label"))


@query("win_best_direction", f"""WITH {DIRECTED}, c AS (SELECT inn, direction, count(*) AS n, min(pos) AS f FROM directed WHERE direction IS NOT NULL GROUP BY ALL) SELECT inn, direction, n, (SELECT count(*) FROM c d WHERE d.inn = c.inn) AS of FROM c QUALIFY row_number() OVER (PARTITION BY inn ORDER BY n DESC, f) = 1""")
def best_direction(t: Tables) -> DataFrame:
    c = t.directed.where("direction is not null").groupBy("inn", "direction").agg(F.count("*").alias("n"), F.min("pos").alias("f"))
    c = c.withColumn("of", F.count("*").over(Window.partitionBy("inn")))
    return windows.first_per(c, ["inn"], [F.desc("n"), F.col("f")]).select("inn", "direction", "n", "of")
