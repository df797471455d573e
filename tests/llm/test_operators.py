"""Edge cases of every operator, and brute force on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orestead.llm import chat, fingerprint, hnsw, language, minhash, mixing, packing, shard, substring, urls
from orestead.llm.components import components
from orestead.llm.queries import URL_RULES, tokenizer_file

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept string, score string, h long"
PASSAGE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "fr", None), (4, "One", "en", "a"), (5, "One", "en", "a"), (5, "One", "en", "a"),
    (6, f"before {PASSAGE} after", "en", "b"), (7, f"other start {PASSAGE}", "de", "b"), (8, LONG, "en", "a"), (9, "one two three four five six seven eight nine ten eleven twelve", "en", "a"),
    (10, "One two three four five six seven eight nine ten eleven TWELVE", "es", "c"), (None, "no id here", "en", "c"), (11, "!!! ??? 123", None, "c"), (12, "naïve café façade ünder", "fr", "c"),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, lang, s, None, 7, 8, "x", "y", 9) for i, t, lang, s in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_shards(edge, none, docs):
    got = shard.kd_shards(edge, shards=3).toPandas()
    assert len(got) == len(ROWS)
    assert sorted(got["size"]) == sorted(len((t or "").encode()) + 16 for _, t, *_ in ROWS)
    assert all(zlib.crc32(t.encode()) in set(got["text_crc32"]) for _, t, *_ in ROWS if t)
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert shard.kd_shards(none, shards=3).count() == 0
    full = shard.kd_shards(docs, shards=8).toPandas()
    per = full.groupby("shard")["size"].sum()
    assert len(per) == 8 and per.max() - per.min() <= 2 * full["size"].max()


def test_packing(edge, none, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file())
    for table, rows in ((edge, ROWS), (docs, [(r.doc_id, r.text) for r in docs.collect()])):
        got = packing.pack_documents(table, tokenizer_file(), with_ids=True).toPandas()
        want = Counter((r[0], tuple(plain.encode(r[1] or "", add_special_tokens=False).ids) + (1,)) for r in rows)
        pieces = Counter()
        for r in got.itertuples():
            assert len(r.ids) == r.length <= 4096 and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
            pieces[None if r.doc_id != r.doc_id else int(r.doc_id)] += r.length
        assert pieces == Counter({k: sum(len(ids) * n for (i, ids), n in want.items() if i == k) for k in {i for i, _ in want}})
        for _, g in got.sort_values("offset").groupby("sequence_id"):
            assert list(g["offset"]) == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 4096
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 4096) + 2
    assert packing.pack_documents(none, tokenizer_file()).count() == 0


def test_plan_places_every_piece():
    rng = np.random.default_rng(3)
    histogram = dict(Counter(int(x) for x in np.minimum(rng.lognormal(5, 1.4, 4000) + 1, 4096)))
    ranges, sequences = packing.plan(histogram, 4096)
    room = Counter()
    ranks = {n: [] for n in histogram}
    for n, first, sequence, number, _ in ranges:
        ranks[n].append((first, number, sequence))
    for n, count in histogram.items():
        table = sorted(ranks[n])
        for rank in range(count):
            first, number, sequence = [x for x in table if x[0] <= rank][-1]
            room[sequence + (rank - first) % number] += n
    assert max(room.values()) <= 4096 and len(room) == sequences
    assert sequences <= -(-sum(k * v for k, v in histogram.items()) // 4096) + 2


def test_nearest(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(900, 16))
    v[100:140] = v[100]
    rows = [(i, [float(x) for x in v[i]]) for i in range(900)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("score", F.lit("clash"))
    got = hnsw.nearest(df, df.where("vec_id % 20 = 0"), k=20, shard_size=300).toPandas()
    hit = total = 0
    for q, g in got.groupby("query_id"):
        s = (v * v[q]).sum(1)
        s[q] = -np.inf
        order = np.lexsort((np.arange(900), -s))[:20]
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g["vec_id"])
        assert np.allclose(g["score"], s[g["vec_id"]], rtol=1e-12)
        hit, total = hit + len(set(order) & set(g["vec_id"])), total + 20
    assert set(got["query_id"]) == set(range(0, 900, 20)) and hit / total >= 0.9
    few = df.where("vec_id < 5")
    assert hnsw.nearest(few, few.where("vec_id = 0")).count() == 4
    assert hnsw.nearest(df.limit(0), df.limit(0)).count() == 0


def test_fingerprints(edge, none, docs):
    def check(table, rows):
        got = fingerprint.fingerprint_neighbours(table).toPandas()
        h = {r.doc_id if r.doc_id is not None else "none": {} for r in table.select("doc_id").distinct().collect()}
        for r in table.select("doc_id", "text", F.xxhash64("text").alias("h")).collect():
            h[r.doc_id if r.doc_id is not None else "none"][r.text] = r.h
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h[r[0] if r[0] is not None else "none"][r[1]]))
        want = Counter()
        for i, (_, text, *_) in enumerate(rows):
            a, b = text or "", rows[(i + 1) % len(rows)][1] or ""
            cut = len(a) // 4
            want[len(a), hashlib.sha256((a[: len(a) - cut] + b[:cut]).encode()).hexdigest(), fingerprint.fingerprint(a)] += 1
        assert Counter(zip(got["n_chars"], got["edited_sha256"], got["fingerprint"], strict=True)) == want
        assert ((got["near_edited"] >= 0) & (got["near_edited"] <= 1) & (got["near_next"] >= 0) & (got["near_next"] <= 1)).all()
        return got

    check(edge, [r[:2] for r in ROWS])
    got = check(docs, [(r.doc_id, r.text) for r in docs.collect()])
    assert got["near_edited"].mean() > 0.6 > 0.1 > got["near_next"].mean()
    assert fingerprint.fingerprint_neighbours(none).count() == 0


def test_fingerprints_of_long_texts_and_many_ranges(spark, monkeypatch):
    lines = [f"line {i} of text {i * i}" for i in range(400)]
    texts = ["\n".join(lines), "\n" * 50, "x y " * 300 + "\n" + "z", ""]
    whole = fingerprint.fingerprints([t.encode() for t in texts])
    monkeypatch.setattr(fingerprint, "BLOCK_BYTES", 256)
    assert (fingerprint.fingerprints([t.encode() for t in texts]) == whole).all()
    rows = [(None, f"null {i}") for i in range(30)] + [(7, f"seven {i % 9} words here") for i in range(30)] + [(i, f"{i} alone in here") for i in range(20, 60)]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, g int, own int")
    got = fingerprint.fingerprint_neighbours(table, group_bytes=40).toPandas()
    assert Counter(got["fingerprint"]) == Counter(fingerprint.fingerprint(t) for _, t in rows)
    of = {}
    for i, t in rows:
        of.setdefault(i, []).append(t)
    ids = sorted(of, key=lambda x: (x is not None, x or 0))
    for n, i in enumerate(ids[:-1]):  # each id's rows follow one another in some order, and its last goes on to the next id's first
        nexts = set(of[i]) | set(of[ids[n + 1]])
        mine = got[got["doc_id"].isna() if i is None else got["doc_id"] == i]
        for r in mine.itertuples():
            text = next(t for t in of[i] if fingerprint.fingerprint(t) == r.fingerprint)
            cut = len(text) // 4
            assert r.edited_sha256 in {hashlib.sha256((text[: len(text) - cut] + x[:cut]).encode()).hexdigest() for x in nexts}


def test_fingerprints_add_and_subtract():
    f = fingerprint.fingerprint
    assert f("a b\nc d\ne") == f("e\na b\nc d") != f("a b\nc d")
    assert fingerprint.insert(f("a b\nc d"), "e") == f("a b\nc d\ne")
    assert fingerprint.delete(f("a b\nc d\ne"), "c d") == f("a b\ne")


def test_fingerprints_of_one_word_repeated_often():
    text = b"word " * 65_540
    a, b = fingerprint.fingerprints([text, text[: len(text) * 3 // 4] + b"other words follow here"])
    assert fingerprint.likeness(a, b) > 0.9 and fingerprint.likeness(a, a) == 1
    assert (fingerprint.decode(fingerprint.encode(a)) == a).all()


def test_mixing(edge, none, docs):
    got = mixing.mix_sources(edge).toPandas()
    assert len(got) == len(ROWS) and (got["taken"] <= 2 * got["size"]).all()
    assert sorted(got["size"]) == sorted(len(words(t)) for _, t, *_ in ROWS)
    assert mixing.mix_sources(none).count() == 0
    out = mixing.mix_sources(docs.withColumn("source", F.when(F.col("source") != "src3", F.col("source")))).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    per = out.groupby(out["source"].where(out["source"] != "src3", None), dropna=False).agg(S=("size", "sum"), T=("target", "first"), K=("taken", "sum"), m=("size", "max"))
    assert abs(per["T"].sum() - 1.5 * per["S"].sum()) < 1 and (per["T"] <= 2 * per["S"] + 1e-6).all()
    assert ((per["K"] - per["T"]).abs() <= per["m"]).all()
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == mixing.mix_sources(docs).agg(F.sum("times")).first()[0]


def test_chat(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    model = chat.fit(chat.training_turns(turns))
    found = chat.recover_roles(turns, model).toPandas()
    got = found[found["part"] == 0].merge(turns.select("conv_id", "turn", F.col("role").alias("true")).toPandas(), on=["conv_id", "turn"])
    assert len(got) == turns.count() and (got["role"] == got["true"]).mean() > 0.9
    odd = spark.createDataFrame([(None, 0, "User: hi"), (None, 1, "Assistant: yes"), (5, None, None), (5, 3, ""), (5, 3, "")], "conv_id long, turn int, text string").withColumn("role", F.lit("clash"))
    found = chat.recover_roles(odd, model).toPandas()
    assert len(found) == 5 and list(found.loc[found["conv_id"].isna()].sort_values("turn")["role"]) == ["user", "assistant"]
    assert "User" not in "".join(found["rendered"])
    assert chat.recover_roles(odd.limit(0), model).count() == 0


def test_chat_transcript_in_one_text(spark):
    model = chat.fit(chat.training_turns(spark.read.parquet(f"{SF}/conversations.parquet")))
    text = "System: be kind\nUser: hello\nand more of it\n\nAssistant: hi\nwith a second line\nUser: bye"
    table = spark.createDataFrame([(1, 0, text), (1, 0, text), (2, 0, "### Assistant\nfirst\n**User**: second")], "conv_id long, turn int, text string")
    got = sorted((r.conv_id, r.part, r.role, r.rendered) for r in chat.recover_roles(table, model).collect())
    want = [(1, 0, "system", "<|system|>\nbe kind\n"), (1, 1, "user", "<|user|>\nhello\nand more of it\n"), (1, 2, "assistant", "<|assistant|>\nhi\nwith a second line\n"), (1, 3, "user", "<|user|>\nbye\n")]
    assert got == sorted(want * 2 + [(2, 0, "assistant", "<|assistant|>\nfirst\n"), (2, 1, "user", "<|user|>\nsecond\n")])


def test_chat_against_all_paths(spark, monkeypatch):
    """The likeliest of all sequences of roles, by trying each; and the same in blocks of two rows."""
    from itertools import product

    model = chat.fit(chat.training_turns(spark.read.parquet(f"{SF}/conversations.parquet")))
    rng = np.random.default_rng(5)
    pieces = ["x" * 3, "User: a b", "y " * 40, "Assistant: no", "z " * 200, "", "[system] be"]
    talks = [["\n".join(pieces[int(x)] for x in rng.integers(0, len(pieces), int(n))) for n in rng.integers(1, 3, 4)] for _ in range(12)]
    table = spark.createDataFrame([(c, t, text) for c, texts in enumerate(talks) for t, text in enumerate(texts)], "conv_id long, turn int, text string")
    kinds = {(r.conv_id, r.turn): r.o for r in table.select("conv_id", "turn", F.transform(chat._lines(F.col("text")), chat._observation).alias("o")).collect()}
    want = {}
    for c, texts in enumerate(talks):
        steps = [(t, "move" if i == 0 else "inside" if "|-|" in o else "marked", chat._emissions(model, o)) for t in range(len(texts)) for i, o in enumerate(kinds[c, t])]
        best, path = -np.inf, None
        for roles in product(range(3), repeat=len(steps)):
            total = model["start"][roles[0]] + steps[0][2][roles[0]]
            for (_, kind, e), a, b in zip(steps[1:], roles, roles[1:], strict=False):
                total += model[kind][a, b] + e[b]
            if total > best + 1e-12:
                best, path = total, roles
        for (t, _, _), r in zip(steps, path, strict=True):
            want.setdefault((c, t), []).append(chat.ROLES[r])
    runs = lambda roles: [r for i, r in enumerate(roles) if i == 0 or r != roles[i - 1]]

    def found():
        out = {}
        for r in sorted(chat.recover_roles(table, model).collect(), key=lambda r: r.part):
            out.setdefault((r.conv_id, r.turn), []).append(r.role)
        return out

    assert found() == {k: runs(v) for k, v in want.items()}
    monkeypatch.setattr(chat, "BLOCK", 2)
    assert found() == {k: runs(v) for k, v in want.items()}


def _brute_repeats(rows, window):
    texts = [words(t) for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = Counter()
    for (doc, *_), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def _digests(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_substring(spark, edge, none, docs):
    assert _digests(substring.remove_repeats_digest(edge)) == _brute_repeats(ROWS, 35)
    assert substring.remove_repeats_digest(none).count() == 0
    assert _digests(substring.remove_repeats_digest(docs)) == _brute_repeats([(r.doc_id, r.text) for r in docs.collect()], 35)
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("ab"[x] for x in rng.integers(0, 2, rng.integers(0, 60)))) for i in range(40)]
    rows += [(100, "a " * 80), (101, "a b " * 40), (102, rows[3][1]), (102, rows[3][1])]
    assert _digests(substring.remove_repeats_digest(spark.createDataFrame(rows, "doc_id long, text string"), window=12)) == _brute_repeats(rows, 12)
    cut = {r.doc_id: r.text for r in substring.remove_repeats(edge).collect()}
    assert cut[6] == "before after" and cut[7] == "other start " and cut[1] is None and cut[4] == "One"


def test_substring_keeps_each_text_of_a_shared_id(spark):
    copied = " ".join(f"copy{i}" for i in range(40))
    rows = [
        (None, f"a  {PASSAGE} tail", 1), (None, f"zz {PASSAGE}\nlast", 2), (None, "no  repeat here", 3), (None, None, 4), (None, "", 5), (None, copied, 6), (None, copied, 7),
        (1, f"first {PASSAGE}", 8), (1, "other text of the same id", 9), (1, f"third {PASSAGE} end", 10), (2, "untouched", 11), (2, copied, 12),
    ]
    got = {r.n: (r.doc_id, r.text) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect()}
    left = {1: "a  tail", 2: "zz last", 6: "", 7: "", 8: "first ", 10: "third end", 12: ""}
    assert got == {n: (i, left.get(n, t)) for i, t, n in rows}


def _rule(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(r), r, v) for v, r in URL_RULES if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def test_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", F.lit("clash").alias("host"))
    odd = ["", "no scheme", "http://", "http://EXAMPLE.org/es/1", "http://a.example.org?x", "http://xexample.org/es/", "http://b.com/fr/?q#f", "http://c.com/de/a", "http://d.example.org/en/19", "x" * 5000, None, None]
    both = pages.union(spark.createDataFrame([(1000 + i, u, "c") for i, u in enumerate(odd)], "page_id long, url string, host string"))
    got = {r.page_id: r for r in urls.judge(both, URL_RULES).collect()}
    assert len(got) == both.count()
    for r in both.collect():
        host, path, rule, verdict = _rule(r.url)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule) and g.verdict in ("allow", "block")
        assert verdict is None or g.verdict == verdict
    assert urls.judge(both.limit(0), URL_RULES).count() == 0


def test_url_model_tells_languages_of_urls_apart():
    good, bad = [f"http://news{i}.site/articles/{i}" for i in range(50)], [f"http://win-casino{i}.biz/bonus/{i}" for i in range(50)]
    ratio = urls.Ratio(good[:40], bad[:40])
    at = ratio.calibrate(good[40:], bad[40:])
    assert all(ratio.raw(u) > at for u in good) and all(ratio.raw(u) < at for u in bad)
    total = sum(ratio.accepted.chance("ttp:/", chr(c)) for c in range(128))
    assert abs(total - 1) < 1e-6


def test_language(edge, none, docs):
    profiles = language.learn(docs)
    got = language.identify(edge, profiles, carry=("doc_id", "text", "score")).toPandas()
    assert len(got) == len(ROWS)
    for r in got.itertuples():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert language.identify(none, profiles).count() == 0 and language.learn(none) == {}
    assert set(language.identify(edge, {}).toPandas()["lang_pred"]) == {"und"}
    held = language.identify(docs, profiles).join(docs, "doc_id").where(language.held_out(F.col("doc_id"))).toPandas()
    assert (held["lang_pred"] == held["lang"]).mean() >= 0.95


def _brute_components(rows, k, percent):
    sets = []
    for _, t, *_ in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r[0])
    return Counter((r[0], len(sets[i]), min(x for x in ids[find(i)] if x is not None) if any(x is not None for x in ids[find(i)]) else None) for i, r in enumerate(rows))


def test_near_duplicates(spark, edge, none, docs):
    seen = lambda df: Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())
    assert seen(minhash.near_duplicates(edge)) == _brute_components(ROWS, 5, 80)
    assert minhash.near_duplicates(none).count() == 0
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert seen(minhash.near_duplicates(docs, k=3, percent=85)) == _brute_components(rows, 3, 85)
    # A group of many near copies around one text, and many texts around one common passage.
    rng = np.random.default_rng(4)
    base = [f"t{x}" for x in rng.integers(0, 5000, 150)]
    rows = []
    for i in range(60):
        w = list(base)
        w[int(rng.integers(0, 150))] = f"n{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(base[:90] + [f"own{i}w{j}" for j in range(60)])) for i in range(60)]
    assert seen(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=3, percent=85)) == _brute_components(rows, 3, 85)


def test_near_duplicates_of_null_and_repeated_ids(spark):
    def text(seed, changed=()):
        return " ".join(f"c{seed}x{i}" if i in changed else f"s{seed}w{i}" for i in range(80))

    rows = [
        (5, text(1)), (5, text(2)), (6, text(2, [40])), (None, text(3)), (None, text(3, [5])), (None, text(4)), (None, text(4)), (7, text(4, [70])), (8, text(5)), (8, text(5)),
        (None, None), (None, ""), (9, None), (9, "one"), (10, "ONE"), (None, text(1, [1, 20, 40, 60])),
    ]
    table = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, node long, text_hash long, key long")
    got = minhash.near_duplicates(table)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == _brute_components(rows, 5, 80)
    groups = {}
    for r in got.where("group_node is not null").collect():
        groups.setdefault(r.group_node, []).append(r.doc_id)
    assert Counter(map(len, groups.values())) == Counter([1, 2, 2, 3, 2, 2, 1])


def test_near_duplicates_of_edited_copies(spark):
    """Copies of one text, edited so that many pairs lie just under the similarity, beside sets that only lose shingles."""
    rng = np.random.default_rng(9)
    base = [f"t{x}" for x in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.choice(120, int(rng.integers(0, 14)), replace=False):
            w[int(at)] = f"n{int(rng.integers(0, 60))}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(x for j, x in enumerate(base) if j not in set(rng.choice(120, i % 9, replace=False)))) for i in range(40)]
    for k, percent in ((3, 85), (5, 80)):
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=k, percent=percent).collect())
        assert got == _brute_components(rows, k, percent)


def test_prefix_pairs_name_only_bands_that_hold_something(spark, monkeypatch):
    """Sets of many sizes around common passages: rows written for the join follow the sets' first shingles, and no pair is lost."""
    rng = np.random.default_rng(3)
    base = [f"t{x}" for x in range(400)]
    rows = []
    for i in range(60):
        n = int(rng.integers(150, 400))
        w = base[:n]
        for at in rng.choice(n, int(rng.integers(0, 5)), replace=False):
            w[int(at)] = f"own{i}"
        rows.append((i, i // 2, 2, " ".join(w)))
    written, keep = {}, minhash.materialize

    def noted(df, name):
        out = keep(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(minhash, "materialize", noted)
    got = {(r.a, r.b) for r in minhash._prefix_pairs(spark.createDataFrame(rows, "node long, component long, members long, text string"), 5, 80).collect()}
    sets = [set(minhash.shingle_set(r[3], 5).tolist()) for r in rows]
    linked = {(a, b) for a in range(60) for b in range(a + 1, 60) if a // 2 != b // 2 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked and linked <= got
    assert 0 < written["mh-bands"] <= 4 * written["mh-prefix"], written


def test_shards_of_far_ids_and_plain_cuts(spark):
    ends = spark.createDataFrame([(-(2**63) + 1, "a"), (2**63 - 1, "bb"), (0, "c"), (None, "d")], "doc_id long, text string")
    assert sorted(shard.kd_shards(ends, shards=2).groupBy("shard").count().toPandas()["count"]) in ([1, 3], [2, 2])
    # Sizes are equal and ids are the widest dimension: cuts at plain medians of the ids, down the tree.
    rows = [(i * i, "same") for i in range(1, 401)]
    got = {r.doc_id: r.shard for r in shard.kd_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()}

    def cut(ids, leaves):
        if leaves == 1:
            return [set(ids)]
        at = len(ids) * (leaves // 2) // leaves
        return cut(ids[:at], leaves // 2) + cut(ids[at:], leaves - leaves // 2)

    want = cut(sorted(i for i, _ in rows), 4)
    assert [{d for d, x in got.items() if x == n} for n in range(4)] == want


def test_mixing_of_equal_rows(spark):
    rows = [(1, "one two three", "a")] * 100 + [(1000 + i, f"word number {i}", "b") for i in range(300)] + [(None, "x y", None)] * 40
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_h", F.lit(1))
    got = mixing.mix_sources(table).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 2 * got["size"]).all()
    per = got.groupby("source_size").agg(T=("target", "first"), K=("taken", "sum"), m=("size", "max"))
    assert ((per["K"] - per["T"]).abs() <= per["m"]).all()
    again = mixing.mix_sources(table).agg(F.sum("taken")).first()[0]
    out = mixing.mixed_documents(table)
    assert again == per["K"].sum() and out.columns == table.columns
    assert out.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == again


def test_nearest_of_ids_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [9.0, 0.0]), (2, [2.0, 1.0]), (3, [2.0, 5.0]), (3, [2.0, 5.0]), (20, [0.0, 1.0]), (20, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = hnsw.nearest(df, df.where("vec_id % 20 = 0"), k=3).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0] == [(1, 1, 9.0), (2, 2, 2.0), (3, 3, 2.0)]
    assert sorted(r.score for r in got if r.query_id == 20 and r.rank == 1) == [5.0, 9.0]


def test_nearest_meets_the_shards_of_its_middles(spark):
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(40, 24))
    group = np.where(rng.random(6000) < 0.3, 0, rng.integers(0, 40, 6000))
    v = (middle[group] + 0.2 * rng.normal(size=(6000, 24))) * rng.uniform(0.5, 1.5, (6000, 1))
    v[100:400] = v[100]
    v[400] *= 1e30
    schema = "vec_id long, vector array<double>"
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], schema)
    asked = df.where("vec_id % 20 = 0")
    route = hnsw.plan_route(df, asked, 20, shard_size=200)
    assert route.rows.sum() == 6000 and max(route.rows / route.shards) <= 300
    met = {r.vec_id: r.shards for r in hnsw.in_arrow(asked, route.meet, f"{schema}, shards array<int>").collect()}
    assert set(met) == set(range(0, 6000, 20)) and all(len(set(x)) == len(x) for x in met.values())
    dealt = {r.vec_id: r.shard for r in hnsw.in_arrow(df, route.deal, f"{schema}, shard int").collect()}
    assert sorted(dealt) == list(range(6000)) and set(dealt.values()) <= set(range(route.shards.sum()))
    assert np.mean([len(x) for x in met.values()]) < 0.5 * route.shards.sum()
    got = hnsw.nearest(df, asked, k=20, shard_size=200).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        s = (v * v[q]).sum(1)
        s[q] = -np.inf
        want = np.sort(s)[::-1][:20]
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 21)) and len(set(g["vec_id"])) == 20 and q not in set(g["vec_id"])
        assert np.allclose(g["score"], s[g["vec_id"]], rtol=1e-12)
        hit += (g["score"].to_numpy() >= want[-1] * (1 - 1e-12)).sum()
    assert hit / (300 * 20) >= 0.95
    # Without middles to gather round, all shards are met.
    loose = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(3000, 48)))], schema)
    assert hnsw.plan_route(loose, loose.where("vec_id % 20 = 0"), 20, shard_size=200) is None


def test_graph_of_huge_components():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(700, 12)) * np.exp(rng.normal(size=(700, 1)))
    want = np.argsort(-(v[:40] @ v.T), axis=1)[:, :10]
    for scale in (1.0, 1e25, 1e-30):
        found = hnsw.search(v * scale, hnsw.build(v * scale), v[:40] * scale, 64)[:, :10]
        assert np.mean([len(set(a) & set(b)) for a, b in zip(found, want, strict=True)]) >= 9.5


def test_language_against_plain_out_of_place(spark, docs):
    profiles = language.learn(docs)

    def plain(text):
        low = "".join(c.lower() if c.isalpha() else " " for c in text)
        low = " " + " ".join(low.split()) + " "
        return low

    counts = Counter()
    sample = "Der Hund und die Katze gehen über die Brücke, und der Hund bellt. Über allen Gipfeln!"
    low = plain(sample)
    for k in language.ORDERS:
        for i in range(len(low) - k + 1):
            gram = low[i : i + k]
            if gram.strip() and not (k == 3 and gram[1] == " "):
                counts[gram] += 1

    def code(gram):
        out = 0
        for c in gram:
            out = (out << 16) | (0 if c == " " else ord(c))
        return (len(gram) << 48) | out

    ranked = [g for g, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))][: language.RANKS]
    apart = {lang: sum(abs(p.index(g) - i) if g in p else language.RANKS for i, g in enumerate(ranked)) for lang, p in profiles.items()}
    best = min(apart.items(), key=lambda x: (x[1], x[0]))
    got = language.identify(spark.createDataFrame([(1, plain(sample)), (2, chr(0x30000)), (3, chr(0x1F600))], "doc_id long, text string"), profiles).toPandas().set_index("doc_id")
    assert got.loc[1, "lang_pred"] == best[0] and abs(got.loc[1, "score"] - (1 - best[1] / (len(ranked) * language.RANKS))) < 1e-9
    assert got.loc[2, "lang_pred"] != "und" and got.loc[3, "lang_pred"] == "und"
    rare = spark.createDataFrame([(i, f"common words here {i}", "xx") for i in range(300)] + [(1000, "seltene wörter", "yy")], "doc_id long, text string, lang string")
    assert set(language.fit_profiles(rare, max_fit=40)) == {"xx", "yy"}


def test_url_verdicts_against_plain_models(spark):
    accepted, rejected = [f"http://a{i}.org/list/{i}" for i in range(60)], [f"http://casino{i}.net/win/{i}" for i in range(40)]
    rows = accepted + accepted[:5] * 9 + rejected + ["http://a.unknown/list/1", "http://casino.unknown/win/9", "plain", None]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, [("allow", "org/")]).collect()}
    held = {r.url: r.held for r in pages.where("url is not null").select("url", (F.pmod(F.xxhash64(F.lit(7), "url"), F.lit(5)) == 0).alias("held")).collect()}

    def plain(train, url):
        """Witten-Bell by counting the contexts anew for each character."""
        texts = [urls._plain(t) for t in train]
        text, total = urls._plain(url), 0.0
        for i in range(1, len(text)):
            p = 1 / urls.ALPHABET
            for k in range(min(urls.ORDER, i) + 1):
                context = text[i - k : i]
                after = Counter(t[j] for t in texts for j in range(max(1, k), len(t)) if t[j - k : j] == context)
                n = sum(after.values())
                if not n:
                    break
                p = (after[text[i]] + len(after) * p) / (n + len(after))
            total += np.log(p)
        return total / (len(text) - 1)

    fit = lambda side: [u for u in side if not held[u]]
    rejected.append(rows[-3])  # its host has a seed word
    ratio = urls.Ratio(fit(accepted), fit(rejected))
    at = ratio.calibrate([u for u in accepted if held[u]], [u for u in rejected if held[u]])
    for i in range(len(rows) - 4, len(rows)):
        score = plain(fit(accepted), rows[i]) - plain(fit(rejected), rows[i]) - at
        assert abs(got[i].score - score) < 1e-9 and got[i].verdict == ("block" if score < 0 else "allow")
    assert got[0].score is None and got[0].verdict == "allow" and got[len(rows) - 3].verdict == "block"


def test_url_models_learn_from_every_labelled_url(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join("aeinorst"[x] for x in rng.integers(0, 8, 5))
    accepted, rejected = sorted({f"http://{word()}.org/" for _ in range(11_000)}), sorted({f"http://{word()}-casino.net" for _ in range(11_000)})
    assert min(len(accepted), len(rejected)) > 8_500
    other = [f"http://{word()}.{end}" for end in ("net", "org.net", "-poke.com") for _ in range(20)] + ["", "http://ÄÉ\U0001f600x" * 50]
    pages = spark.createDataFrame(list(enumerate([*accepted, *rejected, *other, *other[:3] * 4, None])), "page_id long, url string")
    held = {r.url for r in pages.where((F.pmod(F.xxhash64(F.lit(7), "url"), F.lit(5)) == 0) & F.col("url").isNotNull()).collect()}
    ratio = urls.Ratio([u for u in accepted if u not in held], [u for u in rejected if u not in held])
    at = ratio.calibrate([u for u in accepted if u in held], [u for u in rejected if u in held])
    runs = []
    for kept in ({}, {"in_memory": 50}):
        runs.append(urls.judge(pages, [("allow", "org/")], **kept).orderBy("page_id").collect())
        for r, url in zip(runs[-1][len(accepted) :], [*rejected, *other, *other[:3] * 4, None], strict=True):
            score = ratio.raw(url) - at
            assert abs(r.score - score) < 1e-9 and r.verdict == ("block" if score < 0 else "allow")
    assert runs[0] == runs[1]


def test_url_threshold_against_every_cut(spark):
    rng = np.random.default_rng(9)
    for n, spread in ((300, 40), (200, 5), (4, 3)):
        good, bad = (rng.integers(0, spread, n) + spread // 3) / 8, rng.integers(0, spread, n // 2) / 8
        scores = spark.createDataFrame([(float(x), True) for x in good] + [(float(x), False) for x in bad], "score double, accepted boolean")
        levels = np.unique(np.concatenate([good, bad]))
        cuts = [levels[0] - 1e-9, *(levels[1:] + levels[:-1]) / 2]
        best = max(cuts, key=lambda c: ((bad < c).sum() * len(good) - (good < c).sum() * len(bad), -c))
        want = min(best, np.sort(good)[int(urls.MOST_REJECTED * len(good))])
        ratio = urls.Ratio([], [])
        ratio.raw = lambda x: x
        assert urls.threshold(scores, rows_per_task=7) == urls.threshold(scores) == ratio.calibrate(list(good), list(bad)) == want
        assert urls.threshold(scores.where("accepted")) == urls.threshold(scores.limit(0)) == 0.0


def test_chat_of_null_and_named_null(spark):
    turns = spark.createDataFrame([(None, 0, "User: hi"), (None, 1, "Assistant: yes"), ("null", 0, "Assistant: yes"), ("null", 1, "User: hi")], "conv_id string, turn int, text string")
    model = chat.fit(chat.training_turns(spark.read.parquet(f"{SF}/conversations.parquet")))
    got = {(r.conv_id, r.turn): r.role for r in chat.recover_roles(turns, model).collect()}
    assert got == {(None, 0): "user", (None, 1): "assistant", ("null", 0): "assistant", ("null", 1): "user"}


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(50, 40), (41, 50), (60, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 40: 40, 41: 40, 50: 40}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
