"""Queries over landed pages and texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import price, text, web
from ..operators import rules, windows
from ..shipping import ship
from .base import Tables, query

ROBOTS = [("disallow", "/fr/"), ("allow", "/fr/1"), ("disallow", "/*/2"), ("allow", "/en/"), ("disallow", "/*.html$")]


@query("robots_decision", r"""WITH p AS (SELECT page_id, regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) AS path FROM pages), r(allow, pattern, rx) AS (VALUES (false, '/fr/', '^/fr/'), (true, '/fr/1', '^/fr/1'), (false, '/*/2', '^/.*/2'), (true, '/en/', '^/en/'), (false, '/*.html$', '^/.*\.html$'))
 SELECT page_id, coalesce((SELECT allow FROM r WHERE regexp_matches(path, rx) ORDER BY length(pattern) DESC, allow DESC LIMIT 1), true) AS allowed FROM p""")
def robots(t: Tables) -> DataFrame:
    """Longest matching rule wins, a tie allows, nothing allows. The rules of a host are few: an array in each row, no join."""
    listed = F.array(*[F.struct(F.length(F.lit(p)).alias("n"), F.lit(a == "allow").alias("allow"), F.lit(p).alias("p")) for a, p in ROBOTS])
    path = F.regexp_extract("url", r"^[^:]+://[^/?#]*([^?#]*)", 1)
    hits = F.filter(listed, lambda r: F.regexp(path, web.robots_regex(r["p"])))
    return t.pages.select("page_id", F.coalesce(F.array_max(hits)["allow"], F.lit(True)).alias("allowed"))


@query("price_branch_links", r"SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, split_part(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/', 2) AS branch, regexp_matches(url, '(/fr/|ref=)') AS scented FROM pages")
def branch_links(t: Tables) -> DataFrame:
    path = F.regexp_extract("url", r"://[^/?#]*([^?#]*)", 1)
    return t.pages.select("page_id", F.regexp_extract("url", r"://([^/?#]*)", 1).alias("host"), F.split_part(path, F.lit("/"), F.lit(2)).alias("branch"), F.col("url").rlike("(/fr/|ref=)").alias("scented"))


@query("fn_norm_domain", r"SELECT page_id, regexp_replace(regexp_extract(lower(url), '^https?://([^/:]*)', 1), '^www\.', '') AS domain FROM pages")
def norm_domain(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.domain(F.col("url")).alias("domain"))


@query("fn_aggregator", r"SELECT page_id, regexp_matches(regexp_extract(url, '://([^/]*)', 1), '(^|\.)(example\.org|tionsh\.example\.net)$') AS aggregator FROM pages")
def aggregator(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.suffix_match(F.regexp_extract("url", r"://([^/]*)", 1), ("example.org", "tionsh.example.net")).alias("aggregator"))


@query("fn_dedup_key", r"""WITH p AS (SELECT page_id, url, regexp_replace(regexp_extract(lower(url), '^https?://([^/:]*)', 1), '^www\.', '') AS d FROM pages), k AS (SELECT page_id, CASE WHEN regexp_matches(d, '(^|\.)example\.org$') THEN 'agg:' || rtrim(split_part(url, '://', 2), '/') ELSE 'dom:' || d END AS key FROM p)
 SELECT key, min(page_id) AS page_id, count(*) AS n FROM k GROUP BY key""")
def dedup_key(t: Tables) -> DataFrame:
    """Aggregators are kept apart by path, sites by domain; the first page of a key stands for it."""
    d = text.domain(F.col("url"))
    path = F.regexp_replace(F.split_part(F.col("url"), F.lit("://"), F.lit(2)), "/+$", "")
    key = F.when(text.suffix_match(d, ("example.org",)), F.concat(F.lit("agg:"), path)).otherwise(F.concat(F.lit("dom:"), d))
    return t.pages.select("page_id", key.alias("key")).groupBy("key").agg(F.min("page_id").alias("page_id"), F.count("*").alias("n"))


@query("ex_title", "SELECT page_id, nullif(trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)), '') AS title FROM pages")
def page_title(t: Tables) -> DataFrame:
    return t.pages.select("page_id", web.title(F.col("html")).alias("title"))


@query("ex_nav_dirs", r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS label FROM pages), d AS (SELECT page_id, CASE WHEN contains(lower(label), 'th') THEN 'A' WHEN contains(lower(label), 'en') THEN 'B' WHEN contains(lower(label), 'la') THEN 'C' END AS direction FROM l)
 SELECT page_id, direction, count(*) AS n FROM d WHERE direction IS NOT NULL GROUP BY ALL""")
def nav_dirs(t: Tables) -> DataFrame:
    """Directions named in links: first substring wins."""
    label = F.lower("label")
    links = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), 1)).alias("label"))
    d = F.when(F.contains(label, F.lit("th")), "A").when(F.contains(label, F.lit("en")), "B").when(F.contains(label, F.lit("la")), "C")
    return links.select("page_id", d.alias("direction")).where("direction is not null").groupBy("page_id", "direction").agg(F.count("*").alias("n"))


@query("ex_html_text")
def html_text(t: Tables) -> DataFrame:
    """Visible text of each distinct page, and its links; equal pages are parsed once."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [web.html_to_text(h) for h in b["html"]]
            yield pd.DataFrame({"sha": b["sha"], "lines": [x.count("\n") + bool(x) for x in texts], "chars": [len(x) for x in texts], "links": [len(web.page_links(h)) for h in b["html"]]})

    ship(t.spark)
    pages = t.pages.select("page_id", "html", F.sha1("html").alias("sha"))
    once = pages.groupBy("sha").agg(F.min("html").alias("html"))
    parsed = once.mapInPandas(parse, "sha string, lines long, chars long, links long")
    return pages.select("page_id", "sha").join(parsed, "sha")


@query("fn_has_content", r"SELECT page_id, contains(html, '$') OR contains(html, '€') OR strlen(html) >= 3000 AS content FROM pages")
def has_content(t: Tables) -> DataFrame:
    return t.pages.select("page_id", (F.contains("html", F.lit("$")) | F.contains("html", F.lit("€")) | (F.octet_length("html") >= 3000)).alias("content"))


@query("fn_html_sniff", "SELECT page_id, regexp_matches(lower(substr(html, 1, 2000)), '<html|<!doctype|<body|<div') AS is_html FROM pages")
def html_sniff(t: Tables) -> DataFrame:
    return t.pages.select("page_id", web.looks_like_html(F.col("html")).alias("is_html"))


@query("fn_link_scent", r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM pages) SELECT page_id, href, CASE WHEN href = '' THEN 0 WHEN regexp_matches(lower(href), '/price|/ceny|/tarif|/platn|/oplata') THEN 70 ELSE 0 END AS scent, count(*) AS n FROM l GROUP BY ALL""")
def link_scent(t: Tables) -> DataFrame:
    links = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), 1)).alias("href"))
    return links.groupBy("page_id", "href", price.link_scent(F.lit(""), F.col("href")).cast("int").alias("scent")).agg(F.count("*").alias("n"))


@query("stoplist_type", r"""WITH m(kind, word) AS (VALUES ('a', 'tion'), ('a', 'heon'), ('a', 'erst'), ('b', 'pflicht'), ('b', 'keit'), ('b', 'ung'), ('c', 'eaux'), ('c', 'ment'), ('c', 'oiç')), h AS (SELECT doc_id, kind, count(*) AS n FROM documents, m WHERE contains(text, word) GROUP BY ALL HAVING count(*) >= 2)
 SELECT doc_id, kind, n FROM h QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, kind) = 1""")
def stoplist(t: Tables) -> DataFrame:
    """At least two distinct markers of a type; most hits win. Each text is read once against all markers, not joined to them."""
    markers = {"a": ("tion", "heon", "erst"), "b": ("pflicht", "keit", "ung"), "c": ("eaux", "ment", "oiç")}
    count = lambda ws: sum((F.contains("text", F.lit(w)).cast("int") for w in ws), F.lit(0))
    hits = F.array(*[F.struct((-count(ws)).alias("m"), F.lit(k).alias("kind")) for k, ws in markers.items()])
    best = t.documents.select("doc_id", F.array_min(F.filter(hits, lambda h: h["m"] <= -2)).alias("b")).where("b is not null")
    return best.select("doc_id", F.col("b.kind").alias("kind"), (-F.col("b.m")).cast("long").alias("n"))


@query("fn_fragment", r"SELECT conv_id, turn, length(trim(text)) = 0 OR (len(string_split_regex(trim(text), '\s+')) <= 2 AND len(list_filter(string_split_regex(trim(text), '\s+'), lambda x: length(x) > 3)) = 0) AS fragment FROM conversations")
def fragment(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.is_fragment(F.col("text")).alias("fragment"))


@query("win_previous_line", "SELECT conv_id, turn, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before, length(lag(text) OVER (PARTITION BY conv_id ORDER BY turn)) < 20 AS continues FROM conversations")
def previous_line(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return t.conversations.select("conv_id", "turn", F.lag("role").over(w).alias("before"), (F.length(F.lag("text").over(w)) < 20).alias("continues"))


@query("ex_price_lines", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE regexp_matches(line, '[0-9]')) AS digits, count(*) FILTER (WHERE upper(line) = line AND length(line) >= 8) AS headers FROM l WHERE trim(line) <> '' GROUP BY doc_id""")
def price_lines(t: Tables) -> DataFrame:
    l = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.trim("line") != "")  # noqa: E741
    return l.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(F.col("line").rlike("[0-9]")).alias("digits"), F.count_if((F.upper("line") == F.col("line")) & (F.length("line") >= 8)).alias("headers"))


@query("rep_markup_batches", "SELECT conv_id, string_agg(turn || ':' || role, ',' ORDER BY turn) AS turns, count(*) AS n FROM conversations GROUP BY conv_id")
def markup(t: Tables) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: F.concat(r["turn"].cast("string"), F.lit(":"), r["role"])), ",").alias("turns"), F.count("*").alias("n"))


@query("top_short_urls", "SELECT host, url FROM (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, url FROM pages) QUALIFY row_number() OVER (PARTITION BY host ORDER BY length(url), url) <= 5")
def short_urls(t: Tables) -> DataFrame:
    p = t.pages.select(F.regexp_extract("url", r"://([^/?#]*)", 1).alias("host"), "url")
    return windows.top_per(p, ["host"], [F.length("url"), F.col("url")], 5).select("host", "url")


@query("set_ordered_dedup", "SELECT host, string_agg(DISTINCT path, ' ' ORDER BY path) AS paths FROM (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, split_part(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/', 2) AS path FROM pages) GROUP BY host")
def ordered_dedup(t: Tables) -> DataFrame:
    p = t.pages.select(F.regexp_extract("url", r"://([^/?#]*)", 1).alias("host"), F.split_part(F.regexp_extract("url", r"://[^/?#]*([^?#]*)", 1), F.lit("/"), F.lit(2)).alias("path"))
    return p.groupBy("host").agg(F.array_join(F.sort_array(F.collect_set("path")), " ").alias("paths"))


@query("cls_row_type", r"SELECT doc_id, CASE WHEN regexp_matches(text, '[#$%&*]{2}') THEN 'junk' WHEN n_chars < 60 THEN 'auxiliary' WHEN lang = 'en' THEN 'service' ELSE 'other' END AS kind FROM documents")
def row_type(t: Tables) -> DataFrame:
    kind = rules.first_rule(F.col("text"), [rules.Rule("junk", "[#$%&*]{2}")], F.when(F.col("n_chars") < 60, F.lit("auxiliary")).when(F.col("lang") == "en", F.lit("service")).otherwise(F.lit("other")))
    return t.documents.select("doc_id", kind.alias("kind"))
