"""Directions, composition, segments and the reports built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import joins, rules, stats, windows
from ..shipping import ship
from .base import DIRECTED, ITEMS, LICENCES, SITE_DIRS, Tables, query
from .rulesets import SERVICE


@query("cls_ordered_rules", f"WITH {DIRECTED} SELECT section, direction, count(*) AS n FROM directed GROUP BY ALL")
def ordered_rules(t: Tables) -> DataFrame:
    return t.directed.groupBy("section", "direction").agg(F.count("*").alias("n"))


@query("agg_direction_counts", f"WITH {DIRECTED} SELECT inn, direction, count(*) AS n FROM directed WHERE direction IS NOT NULL GROUP BY ALL")
def direction_counts(t: Tables) -> DataFrame:
    return t.directed.where("direction is not null").groupBy("inn", "direction").agg(F.count("*").alias("n"))


def composition(t: Tables) -> DataFrame:
    """Company x direction with positions, share of clinical positions, and whether the site claims it."""
    per = t.directed.where("direction is not null").groupBy("inn", "direction").agg(F.count("*").alias("n"))
    both = per.join(t.site_dirs.withColumn("on_site", F.lit(True)), ["inn", "direction"], "full")
    both = both.withColumn("n", F.coalesce("n", F.lit(0))).withColumn("on_site", F.coalesce("on_site", F.lit(False)))
    clinical = ~F.col("direction").isin(*SERVICE)
    total = F.sum(F.when(clinical, F.col("n")).otherwise(0)).over(Window.partitionBy("inn"))
    both = both.withColumn("clin_total", F.greatest(total, F.lit(1)))
    both = both.withColumn("share_bp", F.when(clinical, F.floor(F.col("n") * 10000 / F.col("clin_total"))))
    veto = (F.col("direction") == "Thermal") & (F.col("licence") == "FURNITURE")
    by_price = (F.col("n") >= 3) | ((F.col("n") >= 2) & (F.col("share_bp") >= 500))
    status = (
        F.when(F.coalesce(veto, F.lit(False)), "veto").when(F.col("on_site") & (F.col("n") > 0), "confirmed").when(F.coalesce(by_price, F.lit(False)), "by price")
        .when(F.col("on_site"), "site only").otherwise("trace")
    )
    return both.join(t.licences, "inn", "left").withColumn("status", status).drop("licence")


COMPOSITION = f"""WITH {DIRECTED}, {LICENCES}, {SITE_DIRS},
per AS (SELECT inn, direction, count(*) AS n FROM directed WHERE direction IS NOT NULL GROUP BY ALL),
bth AS (SELECT inn, direction, coalesce(n, 0) AS n, s.x IS NOT NULL AS on_site FROM per FULL JOIN (SELECT *, 1 AS x FROM site_dirs) s USING (inn, direction)),
tot AS (SELECT *, greatest(sum(CASE WHEN direction <> 'Service' THEN n ELSE 0 END) OVER (PARTITION BY inn), 1)::BIGINT AS clin_total FROM bth),
shr AS (SELECT *, CASE WHEN direction <> 'Service' THEN (n * 10000 // clin_total)::BIGINT END AS share_bp FROM tot),
comp AS (SELECT inn, direction, n, on_site, clin_total, share_bp, CASE WHEN direction = 'Thermal' AND licence = 'FURNITURE' THEN 'veto'
 WHEN on_site AND n > 0 THEN 'confirmed' WHEN n >= 3 OR (n >= 2 AND share_bp >= 500) THEN 'by price' WHEN on_site THEN 'site only' ELSE 'trace' END AS status
 FROM shr LEFT JOIN licences USING (inn))"""

query("cls_composition", COMPOSITION + " SELECT * FROM comp")(composition)


def segments(t: Tables) -> DataFrame:
    """Companies by the number of clinical directions in their composition: none, 1-2, 3-6, more."""
    inside = F.col("status").isin("confirmed", "by price") & ~F.col("direction").isin(*SERVICE)
    per = composition(t).groupBy("inn").agg(F.countDistinct(F.when(inside, F.col("direction"))).alias("k"))
    return per.withColumn("segment", F.when(F.col("k") == 0, "none").when(F.col("k") <= 2, "mono").when(F.col("k") <= 6, "oligo").otherwise("multi"))


SEGMENTS = COMPOSITION + """, seg AS (SELECT inn, k, CASE WHEN k = 0 THEN 'none' WHEN k <= 2 THEN 'mono' WHEN k <= 6 THEN 'oligo' ELSE 'multi' END AS segment FROM
 (SELECT inn, count(DISTINCT CASE WHEN status IN ('confirmed', 'by price') AND direction <> 'Service' THEN direction END) AS k FROM comp GROUP BY inn))"""


@query("agg_segments", SEGMENTS + " SELECT segment, count(*) AS n, sum(k)::BIGINT AS k FROM seg GROUP BY segment")
def segment_counts(t: Tables) -> DataFrame:
    return segments(t).groupBy("segment").agg(F.count("*").alias("n"), F.sum("k").alias("k"))


query("rep_segment_per_company", SEGMENTS + " SELECT * FROM seg")(segments)


@query(
    "agg_lift_fisher",
    SEGMENTS + """, cells AS (SELECT d.direction, count(*) FILTER (WHERE segment = 'multi' AND h) AS a, count(*) FILTER (WHERE segment = 'multi' AND NOT h) AS b,
 count(*) FILTER (WHERE segment <> 'multi' AND h) AS c, count(*) FILTER (WHERE segment <> 'multi' AND NOT h) AS d
 FROM (SELECT s.inn, s.segment, x.direction, EXISTS (SELECT 1 FROM comp WHERE comp.inn = s.inn AND comp.direction = x.direction AND status IN ('confirmed', 'by price')) AS h
 FROM seg s, (SELECT DISTINCT direction FROM comp) x) d GROUP BY 1)
 SELECT direction, a, b, c, d, floor(1000 * CASE WHEN a + b > 0 AND c + d > 0 AND c > 0 THEN (a / (a + b)) / (c / (c + d)) END + 1e-6)::BIGINT AS lift_milli FROM cells""",
)
def lift_fisher(t: Tables) -> DataFrame:
    """Tables of direction by segment. One pass: a company carries its directions, a null one among them counts the companies."""
    inside = F.col("status").isin("confirmed", "by price")
    clinical = F.countDistinct(F.when(inside & ~F.col("direction").isin(*SERVICE), F.col("direction")))
    per = composition(t).groupBy("inn").agg(clinical.alias("k"), F.collect_set(F.struct("direction", inside.alias("inside"))).alias("dirs"))
    none = F.struct(F.lit(None).cast("string").alias("direction"), F.lit(True).alias("inside"))
    rows = per.select((F.col("k") > 6).alias("multi"), F.explode(F.array_append("dirs", none)).alias("d"))
    cells = rows.groupBy("d.direction").agg(F.count_if(F.col("multi") & F.col("d.inside")).alias("a"), F.count_if(~F.col("multi") & F.col("d.inside")).alias("c"))
    all_of = lambda c: F.max(F.when(F.col("direction").isNull(), F.col(c))).over(Window.partitionBy())  # noqa: E731  one row per direction
    cells = cells.withColumn("m", all_of("a")).withColumn("o", all_of("c")).where("direction is not null")
    cells = cells.select("direction", "a", (F.col("m") - F.col("a")).alias("b"), "c", (F.col("o") - F.col("c")).alias("d"))
    return cells.withColumn("lift_milli", F.floor(1000 * stats.lift(*[F.col(x) for x in "abcd"]) + 1e-6))


@query("agg_fisher_p")
def fisher_p(t: Tables) -> DataFrame:
    """Fisher's p of each direction's table and what it says; SQL has no hypergeometric sum, so it is tested against a direct one."""
    ship(t.spark)
    cells = lift_fisher(t).withColumn("p", F.round(stats.fisher(*[F.col(x) for x in "abcd"]), 4))
    says = F.when(F.col("lift_milli").isNull() | (F.col("p") >= 0.05), "chance").when(F.col("lift_milli") > 1000, "more").otherwise("less")
    return cells.withColumn("verdict", says).drop("lift_milli")


@query("agg_quantiles_floor", f"""WITH {DIRECTED}, v AS (SELECT inn, direction, list_sort(list(price)) AS l FROM directed WHERE direction IS NOT NULL AND price <> 0 GROUP BY ALL)
 SELECT inn, direction, len(l)::BIGINT AS n, l[least(floor(len(l) * 0.25)::BIGINT, len(l) - 1) + 1] AS p25, l[least(floor(len(l) * 0.75)::BIGINT, len(l) - 1) + 1] AS p75, l[-1] AS top FROM v""")
def quantiles(t: Tables) -> DataFrame:
    rows = t.directed.where("direction is not null and price <> 0")
    return windows.floor_quantiles(rows, ["inn", "direction"], "price", {"p25": 0.25, "p75": 0.75})


@query("agg_combos", SEGMENTS + """, x AS (SELECT DISTINCT inn, direction FROM comp WHERE status IN ('confirmed', 'by price'))
 SELECT a.direction AS d1, b.direction AS d2, NULL::VARCHAR AS d3, count(*) AS n FROM x a JOIN x b ON a.inn = b.inn AND a.direction < b.direction GROUP BY ALL
 UNION ALL SELECT a.direction, b.direction, c.direction, count(*) FROM x a JOIN x b ON a.inn = b.inn AND a.direction < b.direction JOIN x c ON b.inn = c.inn AND b.direction < c.direction GROUP BY ALL""")
def combos(t: Tables) -> DataFrame:
    """Pairs and triples of directions: a company has a handful, so they come from its own sorted array, without a join."""
    x = composition(t).where(F.col("status").isin("confirmed", "by price")).groupBy("inn").agg(F.sort_array(F.collect_set("direction")).alias("l"))
    pair = x.select("l", F.posexplode("l").alias("i", "d1")).select("l", "d1", F.posexplode(F.expr("slice(l, i + 2, size(l))")).alias("j", "d2"), F.col("i"))
    triple = pair.select("d1", "d2", F.explode(F.expr("slice(l, i + j + 3, size(l))")).alias("d3"))
    return pair.groupBy("d1", "d2").agg(F.count("*").alias("n")).select("d1", "d2", F.lit(None).cast("string").alias("d3"), "n").union(triple.groupBy("d1", "d2", "d3").agg(F.count("*").alias("n")))


@query("rep_full_combination", SEGMENTS + """, f AS (SELECT inn, string_agg(direction, ' + ' ORDER BY direction) AS combo FROM (SELECT DISTINCT inn, direction FROM comp WHERE status IN ('confirmed', 'by price')) GROUP BY inn)
 SELECT combo, inn, count(*) OVER (PARTITION BY combo) AS companies FROM f""")
def full_combination(t: Tables) -> DataFrame:
    """Each company with its whole combination and how many have it: a row per member, as a list of members could hold most of the companies."""
    x = composition(t).where(F.col("status").isin("confirmed", "by price")).groupBy("inn").agg(F.array_join(F.sort_array(F.collect_set("direction")), " + ").alias("combo"))
    return x.join(x.groupBy("combo").agg(F.count("*").alias("companies")), "combo").select("combo", "inn", "companies")


@query("set_site_minus_price", COMPOSITION + """, a AS (SELECT inn, direction FROM site_dirs), b AS (SELECT DISTINCT inn, direction FROM directed WHERE direction IS NOT NULL)
 SELECT inn, direction, 'site' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT inn, direction, 'price' FROM (SELECT * FROM b WHERE inn IN (SELECT inn FROM a) EXCEPT SELECT * FROM a)""")
def site_minus_price(t: Tables) -> DataFrame:
    a = t.site_dirs
    b = t.directed.where("direction is not null").select("inn", "direction").distinct()
    return a.join(b, ["inn", "direction"], "left_anti").withColumn("only_in", F.lit("site")).union(
        b.join(a.select("inn").distinct(), "inn", "left_semi").join(a, ["inn", "direction"], "left_anti").withColumn("only_in", F.lit("price"))
    )


@query("set_union_dirs", COMPOSITION + " SELECT inn, count(*) AS n FROM (SELECT inn, direction FROM site_dirs UNION SELECT inn, direction FROM directed WHERE direction IS NOT NULL) GROUP BY inn")
def union_dirs(t: Tables) -> DataFrame:
    both = t.site_dirs.unionByName(t.directed.where("direction is not null").select("inn", "direction")).distinct()
    return both.groupBy("inn").agg(F.count("*").alias("n"))


@query("cls_typology", COMPOSITION + """, s AS (SELECT inn, sum(n) FILTER (WHERE direction = 'Round') AS r, sum(n) FILTER (WHERE direction IN ('Flat', 'Toothed')) AS w,
 sum(n) FILTER (WHERE direction <> 'Service') AS c, sum(n) AS t FROM comp GROUP BY inn)
 SELECT inn, CASE WHEN coalesce(c, 0) * 100 < t * 20 THEN 'service' WHEN coalesce(r, 0) * 100 >= c * 50 THEN 'core' WHEN coalesce(w, 0) * 100 >= c * 40 THEN 'mixed wide'
 WHEN coalesce(r, 0) * 100 >= c * 15 THEN 'balanced' ELSE 'other' END AS kind FROM s WHERE t > 0""")
def typology(t: Tables) -> DataFrame:
    of = lambda *ds: F.sum(F.when(F.col("direction").isin(*ds), F.col("n")).otherwise(0))
    s = composition(t).groupBy("inn").agg(of("Round").alias("r"), of("Flat", "Toothed").alias("w"), F.sum(F.when(~F.col("direction").isin(*SERVICE), F.col("n")).otherwise(0)).alias("c"), F.sum("n").alias("t")).where("t > 0")
    kind = (
        F.when(F.col("c") * 100 < F.col("t") * 20, "service").when(F.col("r") * 100 >= F.col("c") * 50, "core").when(F.col("w") * 100 >= F.col("c") * 40, "mixed wide")
        .when(F.col("r") * 100 >= F.col("c") * 15, "balanced").otherwise("other")
    )
    return s.select("inn", kind.alias("kind"))


#: Models: direction that a site may claim, and words of a specialist, a diagnosis and a treatment.
MODELS = [("M1", "Round", "ring|rod", "new", "large"), ("M2", "Flat", "plate", "old", "hot"), ("M3", "Toothed", "gear", "red", "blue")]


@query("cls_maturity", f"WITH {DIRECTED}, {SITE_DIRS}, m(model, ord, site, hit, diag, treat) AS (VALUES " + ", ".join(f"('{m}', {i}, '{s}', '{h}', '{d}', '{x}')" for i, (m, s, h, d, x) in enumerate(MODELS)) + """),
 f AS (SELECT inn, model, ord, site, count(*) FILTER (WHERE regexp_matches(name, hit)) AS hits, bool_or(regexp_matches(name, hit) AND regexp_matches(name, diag)) AS f_diag,
 bool_or(regexp_matches(name, hit) AND regexp_matches(name, treat)) AS f_treat, greatest(count(*) FILTER (WHERE direction <> 'Service'), 1) AS total FROM directed, m GROUP BY ALL),
 g AS (SELECT f.*, EXISTS (SELECT 1 FROM site_dirs s WHERE s.inn = f.inn AND s.direction = f.site) AS f_site FROM f),
 h AS (SELECT *, f_site::INT + f_diag::INT + f_treat::INT + (hits >= 5 AND f_diag AND f_treat)::INT + (hits * 100 >= total * 5 AND hits >= 3)::INT AS nf FROM g WHERE hits > 0 OR f_site),
 l AS (SELECT *, CASE WHEN nf >= 4 AND hits * 100 >= total * 20 AND hits >= 5 THEN 3 WHEN nf >= 3 AND hits >= 3 THEN 2 WHEN nf = 2 THEN 1 WHEN hits >= 1 THEN 0 END AS lvl FROM h)
 SELECT inn, model, hits, nf, lvl, row_number() OVER (PARTITION BY inn ORDER BY lvl DESC, hits / total DESC, ord) = 1 AS lead FROM l WHERE lvl IS NOT NULL""")
def maturity(t: Tables) -> DataFrame:
    """Levels of each model for each company, and which model leads. Models are a handful of columns, not a join."""
    name = F.col("name")
    rows = t.directed.withColumn("clinical", F.coalesce(~F.col("direction").isin(*SERVICE), F.lit(False)))
    aggs = [F.greatest(F.count_if("clinical"), F.lit(1)).alias("total")]
    for m, _, hit, diag, treat in MODELS:
        aggs.append(F.struct(F.count_if(name.rlike(hit)).alias("hits"), F.bool_or(name.rlike(hit) & name.rlike(diag)).alias("f_diag"), F.bool_or(name.rlike(hit) & name.rlike(treat)).alias("f_treat")).alias(m))
    per = rows.groupBy("inn").agg(*aggs)
    listed = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("ord"), F.lit(s).alias("direction"), F.col(f"{m}.hits"), F.col(f"{m}.f_diag"), F.col(f"{m}.f_treat")) for i, (m, s, *_) in enumerate(MODELS)])
    long = per.select("inn", "total", F.inline(listed)).join(t.site_dirs.withColumn("f_site", F.lit(True)), ["inn", "direction"], "left").fillna(False, ["f_site"])
    hits, total = F.col("hits"), F.col("total")
    features = [F.col("f_site"), F.col("f_diag"), F.col("f_treat"), (hits >= 5) & F.col("f_diag") & F.col("f_treat"), (hits * 100 >= total * 5) & (hits >= 3)]
    nf = sum((f.cast("int") for f in features), F.lit(0))
    long = long.where((hits > 0) | F.col("f_site")).withColumn("nf", nf)
    level = F.when((F.col("nf") >= 4) & (hits * 100 >= total * 20) & (hits >= 5), 3).when((F.col("nf") >= 3) & (hits >= 3), 2).when(F.col("nf") == 2, 1).when(hits >= 1, 0)
    long = long.withColumn("lvl", level).where("lvl is not null")
    best = Window.partitionBy("inn").orderBy(F.desc("lvl"), F.desc(hits / total), "ord")
    return long.select("inn", "model", "hits", "nf", "lvl", (F.row_number().over(best) == 1).alias("lead"))


@query("cls_dental_override", f"""WITH {DIRECTED}, {LICENCES}, p AS (SELECT inn, count(*) FILTER (WHERE direction = 'Toothed') AS k, count(*) AS total FROM directed WHERE direction IS NOT NULL GROUP BY inn),
 m AS (SELECT d.inn, direction, (k * 2 >= total OR coalesce(licence = 'MACHINERY', false)) AND direction IN ('Flat', 'Thermal', 'Heavy', 'Fitted') AS moved FROM directed d JOIN p USING (inn) LEFT JOIN licences USING (inn) WHERE direction IS NOT NULL)
 SELECT inn, CASE WHEN moved THEN 'Toothed' ELSE direction END AS direction, count(*) AS n, count(*) FILTER (WHERE moved) AS moved FROM m GROUP BY 1, 2""")
def dental_override(t: Tables) -> DataFrame:
    """Where one direction has half of a company's positions, or its licence is for that alone, four that look alike are rewritten to it."""
    rows = t.directed.where("direction is not null").groupBy("inn", "direction").agg(F.count("*").alias("n"))
    mine = Window.partitionBy("inn")
    share = F.sum(F.when(F.col("direction") == "Toothed", F.col("n")).otherwise(0)).over(mine) * 2 >= F.sum("n").over(mine)
    rows = rows.withColumn("dental", share).join(t.licences, "inn", "left")
    moved = (F.col("dental") | F.coalesce(F.col("licence") == "MACHINERY", F.lit(False))) & F.col("direction").isin("Flat", "Thermal", "Heavy", "Fitted")
    rows = rows.withColumn("moved", moved).withColumn("direction", F.when(moved, "Toothed").otherwise(F.col("direction")))
    return rows.groupBy("inn", "direction").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("moved"), F.col("n")).otherwise(0)).alias("moved"))


@query("win_profile_share", f"WITH {DIRECTED}, c AS (SELECT inn, direction, count(*) AS n FROM directed WHERE direction IS NOT NULL GROUP BY ALL) SELECT *, (n * 10000 // sum(n) OVER (PARTITION BY inn))::BIGINT AS share_bp FROM c")
def profile_share(t: Tables) -> DataFrame:
    c = t.directed.where("direction is not null").groupBy("inn", "direction").agg(F.count("*").alias("n"))
    return c.withColumn("share_bp", F.floor(F.col("n") * 10000 / F.sum("n").over(Window.partitionBy("inn"))))


@query("agg_majority_section", f"""WITH {DIRECTED}, c AS (SELECT domain, section, direction, count(*) AS n FROM directed WHERE direction IS NOT NULL GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY domain, section)::BIGINT AS total FROM c)
 SELECT domain, section, direction AS major, n, total FROM s WHERE n >= 5 AND n * 10 >= total * 4""")
def majority_section(t: Tables) -> DataFrame:
    return windows.majority(t.directed, ["domain", "section"], "direction", least=5, share=0.4).select("domain", "section", "major", "n", "total")


@query("agg_majority_inherit", f"""WITH {DIRECTED}, c AS (SELECT domain, section, direction, count(*) AS n FROM directed WHERE direction IS NOT NULL GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY domain, section) AS total FROM c),
 m AS (SELECT domain, section, direction AS major FROM s WHERE n >= 5 AND n * 10 >= total * 6) SELECT coalesce(direction, major) AS direction, direction IS NULL AND major IS NOT NULL AS inherited, count(*) AS n
 FROM directed LEFT JOIN m USING (domain, section) GROUP BY ALL""")
def majority_inherit(t: Tables) -> DataFrame:
    rows = t.directed
    major = windows.majority(rows, ["domain", "section"], "direction").select("domain", "section", "major")
    out = rows.join(major, ["domain", "section"], "left")
    inherited = F.col("direction").isNull() & F.col("major").isNotNull()
    return out.groupBy(F.coalesce("direction", "major").alias("direction"), inherited.alias("inherited")).agg(F.count("*").alias("n"))


@query("agg_mode_section", f"""WITH {ITEMS}, c AS (SELECT name, section, count(*) AS n, min(pos) AS first_pos FROM items GROUP BY ALL)
 SELECT name, section, n FROM c QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, first_pos, section) = 1""")
def mode_section(t: Tables) -> DataFrame:
    return windows.mode(t.items, ["name"], "section", "pos").select("name", "section", "n")


@query("agg_gold_eval", f"""WITH {DIRECTED}, g AS (SELECT name, section, max(direction) AS pred, CASE WHEN section = 'PROMO' THEN 'Promotion' WHEN regexp_matches(name, 'ring|rod') THEN 'Round' WHEN regexp_matches(name, 'gear') THEN 'Toothed' ELSE 'Flat' END AS truth FROM directed GROUP BY name, section)
 SELECT pred, truth, count(*) AS n, (pred = truth) IS TRUE AS correct FROM g GROUP BY ALL""")
def gold_eval(t: Tables) -> DataFrame:
    """Confusion of predicted and gold labels per distinct name."""
    name = F.col("name")
    truth = F.when(F.col("section") == "PROMO", "Promotion").when(name.rlike("ring|rod"), "Round").when(name.rlike("gear"), "Toothed").otherwise("Flat")
    g = t.directed.select("name", "section", "direction").distinct().select(F.col("direction").alias("pred"), truth.alias("truth"))
    return g.groupBy("pred", "truth").agg(F.count("*").alias("n")).withColumn("correct", F.coalesce(F.col("pred") == F.col("truth"), F.lit(False)))


@query("agg_coverage", f"WITH {DIRECTED} SELECT count(*) AS n, count(direction) AS mapped, count(*) FILTER (WHERE direction = 'Service') AS service, count(*) FILTER (WHERE direction IS NULL) AS unmapped, count(DISTINCT name) AS names FROM directed")
def coverage(t: Tables) -> DataFrame:
    d = F.col("direction")
    return t.directed.agg(F.count("*").alias("n"), F.count("direction").alias("mapped"), F.count_if(d == "Service").alias("service"), F.count_if(d.isNull()).alias("unmapped"), F.countDistinct("name").alias("names"))


@query("agg_retention", f"""WITH {ITEMS}, m AS (SELECT *, CASE WHEN regexp_matches(name, '^new') THEN 'yearly' WHEN regexp_matches(name, '^red') THEN 'subscription' WHEN regexp_matches(name, '^(hot|cold)') THEN 'course' WHEN regexp_matches(name, 'ring') THEN 'card' END AS mechanism FROM items)
 SELECT mechanism, count(DISTINCT inn) AS companies, count(*) AS positions, median(price) AS mid FROM m WHERE mechanism IS NOT NULL GROUP BY mechanism""")
def retention(t: Tables) -> DataFrame:
    listed = [rules.Rule("yearly", "^new"), rules.Rule("subscription", "^red"), rules.Rule("course", "^(hot|cold)"), rules.Rule("card", "ring")]
    m = t.items.withColumn("mechanism", rules.first_rule(F.col("name"), listed)).where("mechanism is not null")
    return m.groupBy("mechanism").agg(F.countDistinct("inn").alias("companies"), F.count("*").alias("positions"), F.median("price").alias("mid"))


@query("cls_earliest_match", f"""WITH {ITEMS}, n AS (SELECT DISTINCT name FROM items), h AS (SELECT name, label, ord, strpos(name, label) AS place FROM n, (VALUES ('ring', 0), ('old', 1), ('gear', 2), ('red', 3), ('plate', 4)) r(label, ord))
 SELECT name, (SELECT label FROM h WHERE h.name = n.name AND place > 0 ORDER BY place, ord LIMIT 1) AS label FROM n""")
def earliest_match(t: Tables) -> DataFrame:
    listed = [rules.Rule(x, x) for x in ("ring", "old", "gear", "red", "plate")]
    return t.part.select(F.col("p_name").alias("name")).join(t.items.select("name").distinct(), "name", "left_semi").distinct().withColumn("label", rules.earliest_rule(F.col("name"), listed))


@query("j_licence_cover", f"""WITH {DIRECTED}, {LICENCES} SELECT direction, covered, count(*) AS n FROM (SELECT direction, CASE WHEN licence IS NULL THEN NULL WHEN direction NOT IN ('Round', 'Flat') THEN true
 WHEN direction = 'Round' THEN contains(licence, 'MACH') OR contains(licence, 'AUTO') ELSE contains(licence, 'FURN') END AS covered FROM directed LEFT JOIN licences USING (inn) WHERE direction IS NOT NULL) GROUP BY ALL""")
def licence_cover(t: Tables) -> DataFrame:
    keys = F.when(F.col("direction") == "Round", F.array(F.lit("MACH"), F.lit("AUTO"))).when(F.col("direction") == "Flat", F.array(F.lit("FURN")))
    rows = t.directed.where("direction is not null").join(t.licences, "inn", "left")
    return rows.groupBy("direction", joins.covers(F.col("licence"), keys).alias("covered")).agg(F.count("*").alias("n"))


@query("j_nullsafe_section", f"""WITH {DIRECTED}, i AS (SELECT domain, name, CASE WHEN pos % 7 = 0 THEN NULL ELSE section END AS section FROM items), x AS (SELECT DISTINCT domain, name, section, direction FROM directed)
 SELECT i.domain, x.direction, count(*) AS n FROM i LEFT JOIN x ON x.domain = i.domain AND x.name = i.name AND x.section IS NOT DISTINCT FROM coalesce(i.section, x.section) GROUP BY ALL""")
def nullsafe_section(t: Tables) -> DataFrame:
    """Items without a section meet all sections of their domain and name: the fan-out is meant."""
    i = t.items.select("domain", "name", F.when(F.col("pos") % 7 != 0, F.col("section")).alias("section"))
    x = t.directed.select("domain", "name", "section", "direction").distinct()
    return joins.join_with_section(i, x, ["domain", "name"], "section").groupBy("domain", "direction").agg(F.count("*").alias("n"))
