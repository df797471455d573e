"""Queries that SQL can't express, against direct computations."""

from __future__ import annotations

import zlib
from math import comb

from orestead import registry
from orestead.functions import masking, web

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return registry.queries()[name](spark, SF).collect()


def test_all_others_have_sql():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"agg_fisher_p", "ex_html_text", "fn_masked_names", "fn_shard_of", "j_fuzzy_match", "top_seeded_sample"}


def test_shard_of(spark):
    names = {r.c_custkey: r.c_name for r in spark.read.parquet(f"{SF}/customer.parquet").collect()}
    got = {r.inn: r.shard for r in run(spark, "fn_shard_of")}
    assert got == {k: zlib.crc32(n.lower().replace("#", ".").encode()) % 7 + 1 for k, n in names.items()}


def test_fisher(spark):
    rows = run(spark, "agg_fisher_p")
    assert rows
    for r in rows:
        a, b, c, d = r.a, r.b, r.c, r.d
        every = [comb(a + b, x) * comb(c + d, a + c - x) for x in range(max(0, a - d), min(a + b, a + c) + 1)]
        mine = comb(a + b, a) * comb(c + d, c)
        assert abs(r.p - min(1.0, sum(x for x in every if x <= mine * (1 + 1e-9)) / comb(a + b + c + d, a + c))) < 1e-3


def test_saturation(spark):
    rows = run(spark, "win_saturation")
    users = [r.user_id for r in sorted(spark.read.parquet(f"{SF}/events.parquet").collect(), key=lambda r: r.event_id)]
    seen, new = set(), []
    for u in users:
        new.append(int(u not in seen))
        seen.add(u)
    size = max(50, int(0.25 * len(new)))
    want = next((i for i in range(max(size, int(0.6 * len(new))), len(new) + 1) if sum(new[max(0, i - size) : i]) < 3), None)
    assert (rows[0]["at_query"], rows[0]["window"]) == (want, size)


def test_html_text(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: (r.chars, r.links) for r in run(spark, "ex_html_text")}
    assert got == {k: (len(web.html_to_text(h)), len(web.page_links(h))) for k, h in pages.items()}


def test_masked_and_fuzzy(spark):
    assert all(r.line.startswith(masking.MASK + ":") for r in run(spark, "fn_masked_names"))
    rows = run(spark, "j_fuzzy_match")
    listed = sorted(f"{a} {b}" for a in ("red", "blue", "small") for b in ("ring", "widget", "plate"))
    assert {r.how for r in rows} == {"exact", "fuzzy"}
    assert all(r.match == masking.best_match(r.spelt, listed, 0.8) for r in rows if r.how == "fuzzy")


def test_names_in_late_lines_are_masked(spark, tmp_path):
    filler = "".join(f"строка {i} без имён\n" for i in range(2000))
    rows = [(1, f"{filler}Принимает Петрова Анна Сергеевна\nконец"), (2, filler), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.line, r.has_name) for r in registry.queries()["fn_masked_names"](spark, str(tmp_path)).collect()}
    assert got[1] == (f"{masking.MASK}: {filler}Принимает {masking.MASK}\nконец", True)
    assert got[2] == (f"{masking.MASK}: {filler}", False) and got[3] == (None, False)

