"""Queries over priced positions, companies and orders: scans, joins, gates, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import price, text
from ..operators import joins, rules, state, windows
from .base import ITEMS, Tables, query


@query("src_scan_validate", r"""SELECT c_custkey AS inn, regexp_replace(c_name, '\D', '', 'g') AS digits, length(regexp_replace(c_name, '\D', '', 'g')) IN (9, 10, 12) AS valid FROM customer""")
def scan_validate(t: Tables) -> DataFrame:
    c = F.col("c_name")
    return t.customer.select(F.col("c_custkey").alias("inn"), F.regexp_replace(c, r"\D", "").alias("digits"), text.has_digits(c, (9, 10, 12)).alias("valid"))


@query("src_range_first", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 100 AND 900 ORDER BY o_orderkey LIMIT 250")
def range_first(t: Tables) -> DataFrame:
    """A shard's row range, then the first rows of it; the limit stays above the filter."""
    return t.orders.where(F.col("o_orderkey").between(100, 900)).orderBy("o_orderkey").limit(250).select("o_orderkey", "o_custkey")


@query("fn_shard_of")
def shard_of(t: Tables) -> DataFrame:
    """DuckDB has no CRC-32; tests compare with zlib."""
    return t.customer.select(F.col("c_custkey").alias("inn"), text.shard_of(F.concat(F.lit("www."), F.lower(F.replace("c_name", F.lit("#"), F.lit("."))))  , 7).alias("shard"))


@query("fn_tax_number", r"""SELECT c_custkey AS inn, CASE WHEN c_custkey % 4 = 3 THEN NULL WHEN length(d) = 9 THEN lpad(d, 10, '0') WHEN length(d) IN (10, 12) THEN d END AS tax
 FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN regexp_replace(c_name, '\D', '', 'g') WHEN 1 THEN '1' || regexp_replace(c_name, '\D', '', 'g') WHEN 2 THEN '123' || regexp_replace(c_name, '\D', '', 'g') END AS d FROM customer)""")
def tax_number(t: Tables) -> DataFrame:
    digits = F.regexp_replace("c_name", r"\D", "")
    k = F.col("c_custkey") % 4
    raw = F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("1"), digits)).when(k == 2, F.concat(F.lit("123"), digits)).otherwise(F.lit("12"))
    return t.customer.select(F.col("c_custkey").alias("inn"), text.tax_number(raw).alias("tax"))


@query("fn_price_number", r"""SELECT l_orderkey, l_linenumber, CASE WHEN len(p) = 1 THEN try_cast(s AS DOUBLE) WHEN length(p[-1]) = 3 THEN try_cast(array_to_string(p, '') AS DOUBLE) ELSE try_cast(array_to_string(p[:-2], '') || '.' || p[-1] AS DOUBLE) END AS value
 FROM (SELECT l_orderkey, l_linenumber, s, regexp_split_to_array(s, '[.,]') AS p FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN l_quantity::BIGINT || '.' || (100 + l_orderkey % 900) WHEN 1 THEN l_quantity::BIGINT || ',' || (10 + l_orderkey % 90)
 WHEN 2 THEN l_quantity::BIGINT || '.' || (100 + l_orderkey % 900) || ',50' ELSE l_quantity::BIGINT || ' 000' END AS raw, replace(CASE l_linenumber % 4 WHEN 0 THEN l_quantity::BIGINT || '.' || (100 + l_orderkey % 900) WHEN 1 THEN l_quantity::BIGINT || ',' || (10 + l_orderkey % 90)
 WHEN 2 THEN l_quantity::BIGINT || '.' || (100 + l_orderkey % 900) || ',50' ELSE l_quantity::BIGINT || ' 000' END, ' ', '') AS s FROM lineitem))""")
def price_number(t: Tables) -> DataFrame:
    k, q, m = F.col("l_linenumber") % 4, F.col("l_quantity").cast("long").cast("string"), F.col("l_orderkey")
    three, two = (m % 900 + 100).cast("string"), (m % 90 + 10).cast("string")
    raw = F.when(k == 0, F.concat(q, F.lit("."), three)).when(k == 1, F.concat(q, F.lit(","), two)).when(k == 2, F.concat(q, F.lit("."), three, F.lit(",50"))).otherwise(F.concat(q, F.lit(" 000")))
    return t.lineitem.select("l_orderkey", "l_linenumber", price.number(raw).alias("value"))


@query("fn_outliers", f"WITH {ITEMS} SELECT domain, count(*) AS n FROM items WHERE price < 1000 OR price > 90000 GROUP BY domain")
def outliers(t: Tables) -> DataFrame:
    return t.items.where(price.outlier(F.col("price"), 1000, 90000)).groupBy("domain").agg(F.count("*").alias("n"))


@query("fn_age_years", "SELECT o_orderkey, round((date_diff('day', o_orderdate::DATE, DATE '2005-01-01') / 365.25)::DECIMAL(18, 6), 1)::DOUBLE AS age FROM orders")
def age_years(t: Tables) -> DataFrame:
    days = F.datediff(F.lit("2005-01-01").cast("date"), F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", F.round((days / F.lit(365.25)).cast("decimal(18,6)"), 1).cast("double").alias("age"))


# --- joins --------------------------------------------------------------------------------


@query("j_semi_license", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'F' AND o_orderpriority LIKE '1-%')")
def semi_license(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderstatus = 'F' and o_orderpriority like '1-%'")
    return t.customer.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("j_anti_pending", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus NOT IN ('O', 'P'))")
def anti_pending(t: Tables) -> DataFrame:
    done = t.orders.where(~F.col("o_orderstatus").isin("O", "P"))
    return t.customer.join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j_orphans", "SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o JOIN supplier s ON s.s_nationkey = o.o_custkey % 25 WHERE o.o_orderkey = l.l_orderkey AND s.s_suppkey = l.l_suppkey) GROUP BY ALL")
def orphans(t: Tables) -> DataFrame:
    """Pairs that are no longer confirmed: an anti join on two keys after the confirming side is reduced to pairs that occur."""
    pairs = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("n"))
    nation = t.supplier.select("s_suppkey", "s_nationkey")
    kept = pairs.select("l_orderkey", "l_suppkey").join(nation, F.col("l_suppkey") == F.col("s_suppkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).where(F.col("s_nationkey") == F.col("o_custkey") % 25)
    return pairs.join(kept.select("l_orderkey", "l_suppkey"), ["l_orderkey", "l_suppkey"], "left_anti")


@query("j_unchecked", "SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE o_custkey IS NULL OR s = 'O'")
def unchecked(t: Tables) -> DataFrame:
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderstatus").alias("s"))
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").where("o_custkey is null or s = 'O'").select("c_custkey")


@query("j_summary_decorrelated", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) FROM orders WHERE o_custkey = c_custkey) AS statuses FROM customer")
def summary(t: Tables) -> DataFrame:
    """Two scalar subqueries of the summary as one aggregation and a join."""
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.array_join(F.sort_array(F.collect_set("o_orderstatus")), ", ").alias("statuses"))
    return t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), "statuses")


@query("j_shared_peers", "SELECT s_suppkey, s_nationkey AS shared, count(*) OVER (PARTITION BY s_nationkey) - 1 AS peers FROM supplier")
def shared_peers(t: Tables) -> DataFrame:
    """Peers of one key as membership: the key that is shared and how many others have it. Lists for every member would be quadratic."""
    sizes = t.supplier.groupBy("s_nationkey").agg((F.count("*") - 1).alias("peers"))
    return t.supplier.join(sizes, "s_nationkey").select("s_suppkey", F.col("s_nationkey").alias("shared"), "peers")


@query("j_recall_cascade", """WITH a AS (SELECT o_custkey AS key, min(o_orderpriority) AS value FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%' GROUP BY 1),
 b AS (SELECT o_custkey AS key, min(o_orderpriority) AS value FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority LIKE '2%' GROUP BY 1)
 SELECT c_custkey AS key, coalesce(a.value, b.value) AS value, CASE WHEN a.value IS NOT NULL THEN 'first' WHEN b.value IS NOT NULL THEN 'second' ELSE 'none' END AS step FROM customer LEFT JOIN a ON a.key = c_custkey LEFT JOIN b ON b.key = c_custkey""")
def recall_cascade(t: Tables) -> DataFrame:
    of = lambda s, p: t.orders.where((F.col("o_orderstatus") == s) & F.col("o_orderpriority").startswith(p)).select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("value"))
    return joins.cascade(t.customer.select(F.col("c_custkey").alias("key")), [("first", of("F", "1")), ("second", of("P", "2"))], "key")


@query("j_first_source_wins", "SELECT c_custkey, coalesce(a.v, b.v) AS v FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a ON a.o_custkey = c_custkey LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS v FROM orders GROUP BY 1) b ON b.o_custkey = c_custkey")
def first_source(t: Tables) -> DataFrame:
    """Both sources in one pass: the preferred value if there is one."""
    per = t.orders.groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("a"), F.max("o_orderkey").alias("b"))
    return t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("a", "b").alias("v"))


@query("j_domain_check", "SELECT e.page_id, e.root = s.root AS same_root FROM (SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS h, list_aggregate(string_split(split_part(split_part(url, '://', 2), '/', 1), '.')[-2:], 'string_agg', '.') AS root FROM pages) e, (SELECT 'example.com' AS root) s")
def domain_check(t: Tables) -> DataFrame:
    """Whether the last two labels of a host agree with a known one."""
    parts = F.split(F.split_part(F.split_part(F.col("url"), F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)), r"\.")
    root = F.when(F.size(parts) < 2, F.array_join(parts, ".")).otherwise(F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."))
    return t.pages.select("page_id", (root == "example.com").alias("same_root"))


# --- aggregates ---------------------------------------------------------------------------


@query("agg_quality_gate", f"""WITH {ITEMS}, a AS (SELECT domain, count(*) AS n, count(*) FILTER (WHERE price >= 1000) AS priced, count(*) FILTER (WHERE regexp_matches(name || ' ' || brand, '^new gizmo Brand#1')) AS ui,
 count(DISTINCT lower(name || ' ' || brand)) AS names, median(length(name || ' ' || brand)) AS mid_length, count(*) FILTER (WHERE regexp_matches(name, '(ring|rod|gear)$')) AS med FROM items GROUP BY domain)
 SELECT *, n >= 5 AND priced * 10 >= n * 7 AND ui * 100 <= n * 2 AND mid_length >= 15 AND (n - names) * 10 <= n * 6 AND med * 10 > n * 2 AS passed FROM a""")
def quality_gate(t: Tables) -> DataFrame:
    """Six tests of a domain's items: enough of them, priced, few interface labels, long names, few repeats, enough of the trade."""
    name = F.concat("name", F.lit(" "), "brand")
    a = t.items.select("domain", "price", name.alias("name"), F.col("name").rlike("(ring|rod|gear)$").alias("med")).groupBy("domain").agg(
        F.count("*").alias("n"), F.count_if(F.col("price") >= 1000).alias("priced"), F.count_if(F.col("name").rlike("^new gizmo Brand#1")).alias("ui"),
        F.countDistinct(F.lower("name")).alias("names"), F.median(F.length("name")).alias("mid_length"), F.count_if("med").alias("med"),
    )
    n = F.col("n")
    passed = (n >= 5) & (F.col("priced") * 10 >= n * 7) & (F.col("ui") * 100 <= n * 2) & (F.col("mid_length") >= 15) & ((n - F.col("names")) * 10 <= n * 6) & (F.col("med") * 10 > n * 2)
    return a.withColumn("passed", passed)


@query("agg_profile_judgment", f"""WITH {ITEMS}, u AS (SELECT inn, lower(name) AS name FROM items GROUP BY ALL), a AS (SELECT inn, count(*) AS total, count(*) FILTER (WHERE regexp_matches(name, 'ring|gear')) AS hit, bool_or(name = 'hot anvil') AS visit FROM u GROUP BY inn)
 SELECT inn, total, hit, CASE WHEN total = 0 THEN 'undefined' WHEN hit * 100 >= total * 30 OR (total >= 15 AND hit * 100 >= total * 15) OR visit THEN 'profile' ELSE 'other' END AS verdict FROM a""")
def profile_judgment(t: Tables) -> DataFrame:
    a = t.items.select("inn", F.lower("name").alias("name")).distinct().groupBy("inn").agg(F.count("*").alias("total"), F.count_if(F.col("name").rlike("ring|gear")).alias("hit"), F.bool_or(F.col("name") == "hot anvil").alias("visit"))
    yes = (F.col("hit") * 100 >= F.col("total") * 30) | ((F.col("total") >= 15) & (F.col("hit") * 100 >= F.col("total") * 15)) | F.col("visit")
    return a.select("inn", "total", "hit", F.when(F.col("total") == 0, "undefined").when(yes, "profile").otherwise("other").alias("verdict"))


@query("agg_collapse_family", f"""WITH {ITEMS}, f AS (SELECT domain, section, split_part(name, ' ', 2) AS family, count(*) AS n, min(price) AS lo, max(price) AS hi FROM items GROUP BY ALL)
 SELECT domain, section, CASE WHEN n >= 3 THEN family ELSE 'rest' END AS family, sum(n)::BIGINT AS n, 'от ' || floor(min(lo))::BIGINT || ' до ' || floor(max(hi))::BIGINT || ' ₽' AS span FROM f GROUP BY ALL""")
def collapse_family(t: Tables) -> DataFrame:
    """Families of three and more get an aggregate of their own, the rest are pooled."""
    f = t.items.groupBy("domain", "section", F.split_part(F.col("name"), F.lit(" "), F.lit(2)).alias("family")).agg(F.count("*").alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi"))
    f = f.withColumn("family", F.when(F.col("n") >= 3, F.col("family")).otherwise("rest"))
    span = F.concat(F.lit("от "), F.floor(F.min("lo")).cast("string"), F.lit(" до "), F.floor(F.max("hi")).cast("string"), F.lit(" ₽"))
    return f.groupBy("domain", "section", "family").agg(F.sum("n").alias("n"), span.alias("span"))


@query("agg_finance", """WITH o AS (SELECT o_custkey, year(o_orderdate) AS y, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders GROUP BY ALL), p AS (SELECT *, lag(cents) OVER (PARTITION BY o_custkey ORDER BY y) AS before FROM o)
 SELECT o_custkey, y, cents, before, CASE WHEN before IS NOT NULL AND before <> 0 THEN 'average' WHEN c_acctbal > 0 THEN 'end' ELSE 'none' END AS method,
 CASE WHEN before IS NOT NULL AND before <> 0 THEN floor(round(c_acctbal * 100)::BIGINT * 20000.0::DOUBLE / (cents + before))::BIGINT WHEN c_acctbal > 0 THEN floor(round(c_acctbal * 100)::BIGINT * 10000.0::DOUBLE / cents)::BIGINT END AS ratio_bp FROM p JOIN customer ON c_custkey = o_custkey""")
def finance(t: Tables) -> DataFrame:
    """A yearly ratio over average assets, with a fall-back where there is no year before; the method is named."""
    o = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("y")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    o = o.withColumn("before", F.lag("cents").over(Window.partitionBy("o_custkey").orderBy("y"))).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    usable, own = F.col("before").isNotNull() & (F.col("before") != 0), F.round(F.col("c_acctbal") * 100)
    method = F.when(usable, "average").when(F.col("c_acctbal") > 0, "end").otherwise("none")
    ratio = F.when(usable, F.floor(own * 20000 / (F.col("cents") + F.col("before")))).when(F.col("c_acctbal") > 0, F.floor(own * 10000 / F.col("cents")))
    return o.select("o_custkey", "y", "cents", "before", method.alias("method"), ratio.alias("ratio_bp"))


@query("agg_consensus", """WITH a AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS yes, count(*) FILTER (WHERE o_orderstatus = 'O') AS no FROM orders GROUP BY 1)
 SELECT c_custkey, coalesce(yes, 0) AS yes, coalesce(no, 0) AS no, CASE WHEN coalesce(yes, 0) + coalesce(no, 0) = 0 THEN CASE WHEN c_acctbal > 5000 THEN 'registry only' WHEN c_acctbal > 0 THEN 'weak' ELSE 'no data' END
 WHEN yes > 0 AND no = 0 THEN 'agreed yes' WHEN yes = 0 THEN 'agreed no' ELSE 'disputed' END AS consensus FROM customer LEFT JOIN a ON o_custkey = c_custkey""")
def consensus(t: Tables) -> DataFrame:
    a = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("yes"), F.count_if(F.col("o_orderstatus") == "O").alias("no"))
    rows = t.customer.join(a, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0, ["yes", "no"])
    alone = F.when(F.col("c_acctbal") > 5000, "registry only").when(F.col("c_acctbal") > 0, "weak").otherwise("no data")
    said = F.when(F.col("yes") + F.col("no") == 0, alone).when((F.col("yes") > 0) & (F.col("no") == 0), "agreed yes").when(F.col("yes") == 0, "agreed no").otherwise("disputed")
    return rows.select("c_custkey", "yes", "no", said.alias("consensus"))


@query("agg_progress", "SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus = 'P') AS waiting, count(DISTINCT o_custkey) AS companies, max(o_orderkey) AS last FROM orders")
def progress(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.orders.agg(F.count("*").alias("total"), F.count_if(s == "F").alias("done"), F.count_if(s == "P").alias("waiting"), F.countDistinct("o_custkey").alias("companies"), F.max("o_orderkey").alias("last"))


@query("agg_points", r"SELECT n_name, count(DISTINCT lower(regexp_replace(c_mktsegment || '  ' || (c_custkey % 7), '\s+', ' ', 'g'))) AS points FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0 GROUP BY n_name")
def points(t: Tables) -> DataFrame:
    address = F.lower(text.squeeze(F.concat("c_mktsegment", F.lit("  "), (F.col("c_custkey") % 7).cast("string"))))
    return t.customer.where("c_acctbal > 0").join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name").agg(F.countDistinct(address).alias("points"))


@query("agg_model_medians", "SELECT c_mktsegment, count(*) AS n, median(c_acctbal) AS mid, median(o.k) AS mid_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) o ON o_custkey = c_custkey GROUP BY 1")
def medians(t: Tables) -> DataFrame:
    o = t.orders.groupBy("o_custkey").agg(F.count("*").alias("k"))
    return t.customer.join(o, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.median("c_acctbal").alias("mid"), F.median("k").alias("mid_orders"))


# --- windows, top-k -----------------------------------------------------------------------


@query("win_topk_group", f"WITH {ITEMS} SELECT domain, name, price, rn FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY price DESC, pos) AS rn FROM items) WHERE rn <= 3")
def topk(t: Tables) -> DataFrame:
    return windows.top_per(t.items, ["domain"], [F.desc("price"), F.col("pos")], 3).select("domain", "name", "price", F.col("rn").cast("long").alias("rn"))


@query("top_expensive", f"WITH {ITEMS} SELECT pos, domain, name, price FROM items ORDER BY price DESC, pos LIMIT 600")
def expensive(t: Tables) -> DataFrame:
    return t.items.orderBy(F.desc("price"), "pos").limit(600).select("pos", "domain", "name", "price")


@query("top_diversified", f"""WITH {ITEMS}, k AS (SELECT domain, count(*) AS k FROM items GROUP BY 1), d AS (SELECT domain, section, count(*) AS n, min(pos) AS f FROM items GROUP BY ALL),
 m AS (SELECT domain, section FROM d QUALIFY row_number() OVER (PARTITION BY domain ORDER BY n DESC, f) = 1)
 SELECT domain, section, k FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY k DESC, domain) AS rn FROM k JOIN m USING (domain) WHERE k >= 100) WHERE rn <= 2 ORDER BY k DESC, domain LIMIT 10""")
def diversified(t: Tables) -> DataFrame:
    """At most two of a kind among the largest: as the order is global, ranks in each kind equal the greedy choice."""
    k = t.items.groupBy("domain").agg(F.count("*").alias("k")).where("k >= 100")
    kind = windows.mode(t.items, ["domain"], "section", "pos").select("domain", "section")
    return windows.top_per(k.join(kind, "domain"), ["section"], [F.desc("k"), F.col("domain")], 2).orderBy(F.desc("k"), "domain").limit(10).select("domain", "section", "k")


@query("batch_by_freq", f"WITH {ITEMS}, n AS (SELECT name || '/' || brand AS name, count(*) AS n FROM items GROUP BY 1) SELECT name, n, row_number() OVER (ORDER BY n DESC, name) AS pos, ((row_number() OVER (ORDER BY n DESC, name) - 1) // 40)::INT AS batch FROM n")
def batch_by_freq(t: Tables) -> DataFrame:
    n = t.items.groupBy(F.concat("name", F.lit("/"), "brand").alias("name")).agg(F.count("*").alias("n"))
    return windows.batches(n, [-F.col("n"), F.col("name")], 40)


@query("top_priority_null_last", "SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, v DESC NULLS LAST, c_name) AS pos FROM (SELECT *, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS v FROM customer) ")
def priority(t: Tables) -> DataFrame:
    v = F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal"))
    rows = t.customer.select("c_custkey", "c_mktsegment", F.coalesce(-v, F.lit(float("inf"))).alias("v"), "c_name")
    return windows.numbered(rows, [F.col("c_mktsegment"), F.col("v"), F.col("c_name")], "pos").select("c_custkey", "pos")


@query("dedup_prefer_section", f"""WITH {ITEMS}, x AS (SELECT domain, name, floor(price / 10000)::BIGINT AS p, pos, CASE WHEN pos % 3 <> 0 THEN section END AS section FROM items)
 SELECT domain, name, p, section, pos FROM x QUALIFY row_number() OVER (PARTITION BY domain, lower(name), p ORDER BY section IS NULL, pos) = 1""")
def dedup_prefer_section(t: Tables) -> DataFrame:
    x = t.items.select("domain", "name", F.floor(F.col("price") / 10000).alias("p"), "pos", F.when(F.col("pos") % 3 != 0, F.col("section")).alias("section"), F.lower("name").alias("_k"))
    return windows.first_per(x, ["domain", "_k", "p"], [F.col("section").isNull(), F.col("pos")]).select("domain", "name", "p", "section", "pos")


@query("win_serial_runs", f"""WITH {ITEMS}, x AS (SELECT domain, pos, floor(price / 1000)::BIGINT AS v, lag(floor(price / 1000)::BIGINT) OVER (PARTITION BY domain ORDER BY pos) AS b FROM items),
 i AS (SELECT *, sum(CASE WHEN v = b + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY domain ORDER BY pos) AS island FROM x) SELECT domain, count(*) AS runs, max(n)::BIGINT AS longest FROM (SELECT domain, island, count(*) AS n FROM i GROUP BY ALL) WHERE n >= 2 GROUP BY domain""")
def serial_runs(t: Tables) -> DataFrame:
    """Runs in which each value is one more than the last."""
    v = F.floor(F.col("price") / 1000)
    x = t.items.select("domain", "pos", v.alias("v")).withColumn("b", F.lag("v").over(Window.partitionBy("domain").orderBy("pos")))
    i = windows.islands(x, ["domain"], "pos", F.col("v") != F.col("b") + 1)
    return i.groupBy("domain", "island").agg(F.count("*").alias("n")).where("n >= 2").groupBy("domain").agg(F.count("*").alias("runs"), F.max("n").alias("longest"))


@query("win_ffill_section", f"""WITH {ITEMS}, x AS (SELECT domain, pos, CASE WHEN pos % 11 = 0 THEN section END AS header FROM items)
 SELECT domain, section, count(*) AS n FROM (SELECT domain, last_value(header IGNORE NULLS) OVER (PARTITION BY domain ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section FROM x) GROUP BY ALL""")
def ffill(t: Tables) -> DataFrame:
    x = t.items.select("domain", "pos", F.when(F.col("pos") % 11 == 0, F.col("section")).alias("header"))
    return windows.fill_forward(x, ["domain"], "pos", "header", "section").groupBy("domain", "section").agg(F.count("*").alias("n"))


@query("win_lead_share", f"WITH {ITEMS}, c AS (SELECT inn, section, count(*) AS n, min(pos) AS f FROM items GROUP BY ALL) SELECT inn, section, n FROM c QUALIFY row_number() OVER (PARTITION BY inn ORDER BY n DESC, f) = 1")
def lead_share(t: Tables) -> DataFrame:
    return windows.mode(t.items, ["inn"], "section", "pos").select("inn", "section", "n")


# --- state --------------------------------------------------------------------------------


@query("st_insert_if_absent", "SELECT o_orderkey, o_orderstatus, 'old' AS origin FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'new', 'incoming' FROM orders WHERE o_orderkey % 3 = 0")
def insert_if_absent(t: Tables) -> DataFrame:
    old = t.orders.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", F.lit("old").alias("origin"))
    incoming = t.orders.where("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").select("o_orderkey", F.lit("new").alias("o_orderstatus"), F.lit("incoming").alias("origin"))
    return state.insert_if_absent(old, incoming, ["o_orderkey"])


@query("st_replace_on_key", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def replace_on_key(t: Tables) -> DataFrame:
    old = t.orders.select("o_orderkey", "o_orderstatus")
    return state.replace_on_key(old, old.where("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_orderkey"])


@query("st_merge_range", "SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN 1000 AND 1999 THEN 'shard' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM orders")
def merge_range(t: Tables) -> DataFrame:
    main = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    shard = t.orders.select("o_orderkey", F.lit("shard").alias("o_orderstatus"))
    return state.merge_shard(main, shard, ["o_orderkey"], F.col("o_orderkey").between(1000, 1999), ["o_orderstatus", "missing"])


@query("st_sum_by_shard", "WITH l AS (SELECT event_type, user_id % 5 AS shard, value, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id % 5 ORDER BY event_id DESC) = 1) SELECT event_type, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM l GROUP BY 1")
def sum_by_shard(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", (F.col("user_id") % 5).alias("shard"), "event_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return state.sum_by_shard(rows, ["event_type"], "shard", "event_id", "cents")


@query("st_validated_merge", """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT o_totalprice > 50000 THEN 'price' END, CASE WHEN NOT o_orderstatus IN ('F', 'O') THEN 'status' END, CASE WHEN c.c_custkey IS NULL THEN 'company' END], lambda x: x IS NOT NULL), ',') AS problems
 FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON c_custkey = o_custkey""")
def validated(t: Tables) -> DataFrame:
    known = t.customer.where("c_acctbal > 0").select("c_custkey")
    rows = t.orders.join(known, F.col("c_custkey") == F.col("o_custkey"), "left")
    out = state.split_valid(rows, {"price": F.col("o_totalprice") > 50000, "status": F.col("o_orderstatus").isin("F", "O"), "company": F.col("c_custkey").isNotNull()})
    return out.select("o_orderkey", F.array_join("problems", ",").alias("problems"))


@query("st_finalise_groups", "SELECT DISTINCT o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = 'P')")
def finalise(t: Tables) -> DataFrame:
    """Only groups without anything pending: one aggregation instead of an anti join."""
    return t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "P").alias("p")).where("not p").select("o_custkey")


@query("st_rerun_guard", f"""WITH {ITEMS}, a AS (SELECT *, count(*) FILTER (WHERE pos % 2 = 0) OVER w AS old, count(*) FILTER (WHERE pos % 2 = 1) OVER w AS new FROM items WINDOW w AS (PARTITION BY domain))
 SELECT domain, pos, price FROM a WHERE (new < old) = (pos % 2 = 0)""")
def rerun_guard(t: Tables) -> DataFrame:
    """A domain's rows of the rerun, unless it found fewer than there were: then the old rows stay."""
    rows = t.items.select("domain", "pos", "price", (F.col("pos") % 2 == 1).alias("fresh"))
    per = rows.groupBy("domain").agg((F.count_if("fresh") >= F.count_if(~F.col("fresh"))).alias("take"))
    return rows.join(per, "domain").where("fresh = take").select("domain", "pos", "price")


@query("st_reparse", "SELECT l_orderkey, l_linenumber, coalesce(n, l_extendedprice) AS price, n IS NOT NULL AND n <> l_extendedprice AS changed FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN l_extendedprice ELSE l_quantity END AS n FROM lineitem)")
def reparse(t: Tables) -> DataFrame:
    k = F.col("l_linenumber") % 3
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.when(k == 1, F.col("l_extendedprice")).when(k == 2, F.col("l_quantity")).alias("n"))
    return state.only_refine(rows, "price", "n").select("l_orderkey", "l_linenumber", "price", "changed")


@query("cls_type123", """WITH o AS (SELECT o_custkey AS inn, bool_or(o_orderpriority LIKE '1%') AS derm, bool_or(o_orderpriority LIKE '2%') AS esth, bool_or(o_orderpriority LIKE '3%') AS cosm, count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority LIKE '4%') AS other FROM orders GROUP BY 1)
 SELECT inn, CASE WHEN other > 0 THEN 'R1' WHEN esth AND derm THEN 'R2' WHEN derm THEN 'R3' WHEN esth THEN 'R4' WHEN cosm THEN 'R4a' ELSE 'R5' END AS rule, other = 1 AS flag_single FROM o""")
def type123(t: Tables) -> DataFrame:
    has = lambda p: F.bool_or(F.col("o_orderpriority").startswith(p))
    o = t.orders.groupBy(F.col("o_custkey").alias("inn")).agg(has("1").alias("derm"), has("2").alias("esth"), has("3").alias("cosm"), F.count_if((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").startswith("4")).alias("other"))
    rule = F.when(F.col("other") > 0, "R1").when(F.col("esth") & F.col("derm"), "R2").when(F.col("derm"), "R3").when(F.col("esth"), "R4").when(F.col("cosm"), "R4a").otherwise("R5")
    return o.select("inn", rule.alias("rule"), (F.col("other") == 1).alias("flag_single"))


@query("cls_reaudit", "SELECT o_orderkey, CASE WHEN starts_with(o_orderpriority, '5') AND o_orderstatus = 'F' THEN 'U' ELSE o_orderstatus END AS status FROM orders")
def reaudit(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.when(F.col("o_orderpriority").startswith("5") & (F.col("o_orderstatus") == "F"), "U").otherwise(F.col("o_orderstatus")).alias("status"))


@query("src_seeds", f"WITH {ITEMS} SELECT domain, string_agg(DISTINCT u, ' ' ORDER BY u) AS urls FROM (SELECT domain, 'https://' || domain || '/' AS u FROM items UNION ALL SELECT domain, 'https://' || domain || '/' || lower(section) FROM items WHERE price > 50000) GROUP BY domain")
def seeds(t: Tables) -> DataFrame:
    home = F.concat(F.lit("https://"), F.col("domain").cast("string"), F.lit("/"))
    rows = t.items.select("domain", home.alias("u")).union(t.items.where("price > 50000").select("domain", F.concat(home, F.lower("section"))))
    return rows.groupBy("domain").agg(F.array_join(F.sort_array(F.collect_set("u")), " ").alias("urls"))


@query("gen_queries", """WITH p AS (SELECT DISTINCT p_type AS city FROM part), n AS (SELECT DISTINCT p_name AS phrase FROM part), q AS (SELECT lower(phrase || ' ' || city) AS text, CASE WHEN phrase LIKE 'new%' THEN 1 WHEN phrase LIKE 'old%' THEN 3 ELSE 2 END AS grp FROM p, n UNION ALL SELECT lower(split_part(phrase, ' ', 2) || ' ' || city), 4 FROM p, n)
 SELECT text, min(grp) AS grp FROM q GROUP BY text""")
def generate(t: Tables) -> DataFrame:
    """Phrases by city: both are short controlled lists, exploded from one array of cities; one text keeps its highest priority."""
    cities = t.part.agg(F.sort_array(F.collect_set("p_type")).alias("cities"))
    names = t.part.select(F.col("p_name").alias("phrase")).distinct().join(F.broadcast(cities), F.lit(True)).select("phrase", F.explode("cities").alias("city"))
    grp = F.when(F.col("phrase").startswith("new"), 1).when(F.col("phrase").startswith("old"), 3).otherwise(2)
    q = names.select(F.lower(F.concat("phrase", F.lit(" "), "city")).alias("text"), grp.alias("grp")).union(names.select(F.lower(F.concat(F.split_part(F.col("phrase"), F.lit(" "), F.lit(2)), F.lit(" "), "city")), F.lit(4)))
    return q.groupBy("text").agg(F.min("grp").alias("grp"))


@query("cls_mechanism_share", f"WITH {ITEMS} SELECT section, count(*) FILTER (WHERE regexp_matches(name, '^new')) AS yearly, count(*) AS n, max(CASE WHEN regexp_matches(name, '^new') THEN price END) AS top FROM items GROUP BY section")
def mechanism_share(t: Tables) -> DataFrame:
    hit = rules.Rule("yearly", "^new").hit(F.col("name"))
    return t.items.groupBy("section").agg(F.count_if(hit).alias("yearly"), F.count("*").alias("n"), F.max(F.when(hit, F.col("price"))).alias("top"))
