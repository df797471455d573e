"""URL filters: rules by host and path, and a ratio of two character language models.

Both models are variable-order Markov models with Witten-Bell smoothing: the longest context seen so far counts, and its
escape mass goes to the next shorter one, down to equal chances for all characters. A URL's score is the difference
of its log-likelihoods under the models of accepted and of rejected URLs, divided by its length, less a threshold that
held-out labelled URLs calibrate.

Both the counts and the threshold come from every labelled URL. A gram is what ends at a place of a URL, with up to ORDER
characters before it; its log-ratio depends on the counts of its own endings. Grams are counted, smoothed and given their
log-ratios as tables. The most frequent ones are looked up in memory, any others by a join.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import windows
from .common import BROADCAST_ROWS, discard, in_arrow, materialize, ship

ORDER = 5
ALPHABET = 128
#: Log-ratios are whole multiples of 1 / UNIT, so that their sums don't depend on the order.
UNIT = 1 << 32
#: Grams that a task counts before it hands them on.
COUNT_GRAMS = 200_000
#: Different scores of held-out URLs that a task adds up.
ROWS_PER_TASK = 100_000
MOST_REJECTED = 0.02
#: Words in a host that make a URL a rejected example where no rule allows it.
SEED_WORDS = ("adult", "casino", "escort", "gambling", "poker", "porn", "spam", "torrent", "viagra", "warez", "xxx")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from there up to ?, # or the end. Else empty."""
    parts = r"://([^/?#]*)([^?#]*)"
    host, path = F.regexp_extract(url, parts, 1), F.regexp_extract(url, parts, 2)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of rules (verdict, host/path) that fits; a rule fits its host and all subdomains, by path prefix."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, p = rule.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _plain(url: str | None) -> str:
    """What the models read: lower case, digits alike, with marks for both ends."""
    return "^" + re.sub(r"\d", "0", (url or "").lower()) + "$"


class CharModel:
    """Counts of characters after contexts of 0 to order characters."""

    def __init__(self, urls: list[str], order: int = ORDER):
        self.order = order
        self.count: Counter[str] = Counter()
        for text in map(_plain, urls):
            for i in range(1, len(text)):
                for k in range(min(order, i) + 1):
                    self.count[text[i - k : i + 1]] += 1
        self.total: Counter[str] = Counter()
        self.kinds: Counter[str] = Counter()
        for gram, n in self.count.items():
            self.total[gram[:-1]] += n
            self.kinds[gram[:-1]] += 1

    def chance(self, context: str, char: str) -> float:
        p = 1 / ALPHABET
        for k in range(len(context) + 1):
            c = context[len(context) - k :]
            n = self.total.get(c)
            if n is None:
                break
            t = self.kinds[c]
            p = (self.count.get(c + char, 0) + t * p) / (n + t)
        return p


class Ratio:
    """The length-normalised difference of log-likelihoods; differences of seen places are kept."""

    def __init__(self, accepted: list[str], rejected: list[str], order: int = ORDER):
        self.accepted, self.rejected, self.order = CharModel(accepted, order), CharModel(rejected, order), order
        self.known: dict[str, float] = {}

    def raw(self, url: str | None) -> float:
        text, total = _plain(url), 0.0
        for i in range(1, len(text)):
            gram = text[max(0, i - self.order) : i + 1]
            d = self.known.get(gram)
            if d is None:
                d = math.log(self.accepted.chance(gram[:-1], gram[-1]) / self.rejected.chance(gram[:-1], gram[-1]))
                if len(self.known) < 500_000:
                    self.known[gram] = d
            total += d
        return total / (len(text) - 1)

    def calibrate(self, accepted: list[str], rejected: list[str]) -> float:
        """The threshold of best balanced accuracy, but no more than rejects MOST_REJECTED of the accepted; 0 without examples of both."""
        if not accepted or not rejected:
            return 0.0
        good, bad = Counter(map(self.raw, accepted)), Counter(map(self.raw, rejected))
        levels, under, best = sorted({*good, *bad}), 0, 0
        at = levels[0] - 1e-9
        for low, high in zip(levels, levels[1:]):
            under += bad[low] * len(accepted) - good[low] * len(rejected)
            if under > best:
                best, at = under, (low + high) / 2
        return min(at, sorted(good.elements())[int(MOST_REJECTED * len(accepted))])


def _places(text: str, order: int) -> list[str]:
    """The gram that ends at each place of text."""
    return [text[max(0, i - order) : i + 1] for i in range(1, len(text))]


def _counter(order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows of url and side (0 accepted, 1 rejected, 2 to be scored): how often grams and their endings occur on the sides.

    To be scored are only the grams themselves; their endings come with 0.
    """

    def handed_on(counts: list[Counter[str]]) -> pa.RecordBatch:
        out: dict[str, list[int]] = {}
        for side, grams in enumerate(counts):
            for gram, n in grams.items():
                for k in range(len(gram)):
                    out.setdefault(gram[k:], [0, 0, 0])[side] += n if side < 2 or k == 0 else 0
        columns = [pa.array(list(out), pa.string()), *(pa.array([n[side] for n in out.values()], pa.int64()) for side in range(3))]
        return pa.RecordBatch.from_arrays(columns, names=["gram", "accepted", "rejected", "wanted"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[Counter[str]] = [Counter(), Counter(), Counter()]
        for batch in batches:
            texts = Counter(zip(map(_plain, batch.column("url").to_pylist()), batch.column("side").to_pylist(), strict=True))
            for (text, side), n in texts.items():
                for gram in _places(text, order):
                    counts[side][gram] += n
                if sum(map(len, counts)) > COUNT_GRAMS:
                    yield handed_on(counts)
                    counts = [Counter(), Counter(), Counter()]
        yield handed_on(counts)

    return run


def log_ratios(examples: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, wanted and ratio (in 1 / UNIT) of every gram that is to be scored, from rows of url and side as _counter reads them.

    Windows see the characters after one context, joins those before one gram.
    """
    counts = in_arrow(examples.select("url", "side"), _counter(order), "gram string, accepted long, rejected long, wanted long").groupBy("gram")
    counts = counts.agg(*[F.sum(c).alias(c) for c in ("accepted", "rejected", "wanted")]).withColumn("size", F.char_length("gram"))
    after = Window.partitionBy(F.expr("substring(gram, 1, size - 1)"))
    seen = [c for side in ("accepted", "rejected") for c in (F.sum(side).over(after).alias(f"{side}_n"), F.sum((F.col(side) > 0).cast("long")).over(after).alias(f"{side}_kinds"))]
    counts = materialize(counts.select("*", *seen), "url-grams")
    small = counts.count() <= BROADCAST_ROWS

    def chance(side: str) -> Column:
        n, kinds, shorter = F.col(f"{side}_n"), F.col(f"{side}_kinds"), F.col(f"{side}_shorter")
        return F.when(n > 0, (F.col(side) + kinds * shorter) / (n + kinds)).otherwise(shorter).alias(f"{side}_p")

    levels = []
    for size in range(1, order + 2):
        rows = counts.where(F.col("size") == size)
        if levels:
            shorter = levels[-1].select(F.col("gram").alias("ending"), F.col("accepted_p").alias("accepted_shorter"), F.col("rejected_p").alias("rejected_shorter"))
            rows = rows.withColumn("ending", F.expr("substring(gram, 2)")).join(shorter.hint("broadcast" if small else "merge"), "ending")
        else:
            rows = rows.select("*", *[F.lit(1 / ALPHABET).alias(f"{side}_shorter") for side in ("accepted", "rejected")])
        rows = rows.select("gram", "wanted", chance("accepted"), chance("rejected"))
        # Neither what is tiny nor what is read once need be written.
        levels.append(materialize(rows, f"url-chances{size}") if 2 < size <= order else rows)
    ratio = F.round(F.log(F.col("accepted_p") / F.col("rejected_p")) * UNIT).cast("long").alias("ratio")
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    out = materialize(out.where("wanted > 0").select("gram", "wanted", ratio), "url-ratios")
    discard(counts, *levels)
    return out


class Scorer:
    """Log-ratios of grams: the in_memory most frequent ones as a broadcast dictionary, the others (None: there are none) as a table."""

    def __init__(self, ratios: DataFrame, order: int = ORDER, in_memory: int = BROADCAST_ROWS):
        self.order, self.rest = order, None
        many = ratios.count() > in_memory
        chosen = ratios.orderBy(F.desc("wanted"), "gram").limit(in_memory).collect() if many else ratios.collect()
        self.head = ratios.sparkSession.sparkContext.broadcast({r["gram"]: r["ratio"] for r in chosen})
        if many:
            wanted, gram = max(((-r["wanted"], r["gram"]) for r in chosen), default=(0, ""))
            after = (F.col("wanted") < -wanted) | ((F.col("wanted") == -wanted) & (F.col("gram") > gram))
            self.rest = ratios.where(after if chosen else F.lit(True)).select("gram", "ratio")
        else:
            discard(ratios)

    def add(self, rows: DataFrame, text: str, out: str) -> DataFrame:
        """rows with out, the mean log-ratio of the characters of text (null: null). Texts must be among those that ratios were made for."""
        rows = rows.withColumn("_of", _known(self.head, self.order)(F.col(text)))
        total = F.col("_of.total")
        if self.rest is not None:
            key = F.sha2(F.col(text), 256)
            found = in_arrow(rows.where(F.col("_of.unknown") > 0).select(key.alias("_text"), F.col(text).alias("url")).distinct(), _unknown(self.head, self.order), "_text string, gram string, n long")
            sums = found.join(self.rest.hint("merge"), "gram").groupBy("_text").agg(F.sum(F.col("n") * F.col("ratio")).alias("_more"))
            spread = F.concat(F.lit("-"), F.monotonically_increasing_id())
            rows = rows.withColumn("_text", F.when(F.col("_of.unknown") > 0, key).otherwise(spread)).join(sums.hint("merge"), "_text", "left")
            total = total + F.coalesce("_more", F.lit(0))
        return rows.withColumn(out, F.when(F.col(text).isNotNull(), total / F.lit(float(UNIT)) / F.col("_of.places"))).drop("_of", "_text", "_more")


def _known(head: Broadcast, order: int) -> Callable[[Column], Column]:
    @F.pandas_udf("total long, places long, unknown long")
    def run(urls: pd.Series) -> pd.DataFrame:
        ratio, found = head.value, {}
        for url in urls.dropna().unique():
            each = [ratio.get(gram) for gram in _places(_plain(url), order)]
            known = [x for x in each if x is not None]
            found[url] = (sum(known), len(each), len(each) - len(known))
        return pd.DataFrame([found.get(u, (0, 0, 0)) for u in urls], columns=["total", "places", "unknown"])

    return run


def _unknown(head: Broadcast, order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, url in zip(batch.column("_text").to_pylist(), batch.column("url").to_pylist(), strict=True):
                grams = Counter(g for g in _places(_plain(url), order) if g not in head.value)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(grams), pa.string()), pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["_text", "gram", "n"])

    return run


def threshold(scores: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> float:
    """What Ratio.calibrate gives, from score and accepted (boolean) of each held-out example, by running totals over ranges of scores."""
    side = lambda a: F.sum((F.col("accepted") == F.lit(a)).cast("long"))
    levels = materialize(scores.groupBy("score").agg(side(True).alias("good"), side(False).alias("bad")), "url-scores")
    n = levels.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("score").alias("least")).first()
    at = 0.0
    if n["good"] and n["bad"]:
        rows = windows.numbered(levels, [F.col("score")], "seq", rows_per_task).withColumn("part", F.floor((F.col("seq") - 1) / F.lit(rows_per_task)))
        for c in ("good", "bad"):
            rows = windows._offset(rows, "part", F.sum(c).over(Window.partitionBy("part").orderBy("seq")), F.sum(c), f"{c}_upto")
        rows = materialize(rows.select("seq", "score", "good_upto", "bad_upto"), "url-levels")
        whole = lambda c: F.col(c).cast("decimal(19,0)")
        value = whole("bad_upto") * F.lit(n["good"]).cast("decimal(18,0)") - whole("good_upto") * F.lit(n["bad"]).cast("decimal(18,0)")
        clean = F.min(F.when(F.col("good_upto") > int(MOST_REJECTED * n["good"]), F.col("score"))).alias("clean")
        best = rows.agg(F.max(F.struct(value.alias("value"), (-F.col("seq")).alias("seq"))).alias("best"), clean).first()
        at = n["least"] - 1e-9
        if best["best"]["value"] > 0:
            low, high = sorted(r["score"] for r in rows.where(F.col("seq").isin(-best["best"]["seq"], 1 - best["best"]["seq"])).collect())
            at = (low + high) / 2
        at = min(at, best["clean"])
        discard(rows)
    discard(levels)
    return at


def fit(labelled: DataFrame, others: DataFrame, in_memory: int = BROADCAST_ROWS) -> tuple[Scorer, float]:
    """Scorer and threshold from every different url of labelled, with accepted (boolean); others has the urls that are to be scored later.

    A fifth of the examples, by hash, calibrates the threshold, the models count the rest. A URL counts once however often it occurs.
    """
    held = F.pmod(F.xxhash64(F.lit(7), "url"), F.lit(5)) == 0
    labelled = materialize(labelled.select("url", "accepted").distinct().withColumn("held", held), "url-labelled")
    side = F.when(F.col("held"), 2).when(F.col("accepted"), 0).otherwise(1)
    scorer = Scorer(log_ratios(labelled.select("url", side.alias("side")).union(others.select("url", F.lit(2)))), in_memory=in_memory)
    at = threshold(scorer.add(labelled.where("held"), "url", "score").select("score", "accepted"))
    discard(labelled)
    return scorer, at


def judge(pages: DataFrame, rules: list[tuple[str, str]], seed_words: tuple[str, ...] = SEED_WORDS, in_memory: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, host, path, rule (null: none fits), verdict (allow or block) and score (null where a rule decides) of every row's url.

    The longest rule that fits decides, else the models: allow if the score isn't negative. They learn from the urls that
    rules decide and, as rejected, from those with one of seed_words in the host; allowed urls with such a word aren't
    examples. A null url, or one without ://, has empty host and path; the models judge it by its characters all the
    same (none: even odds). A URL of any length is read whole. With examples of one side only, the threshold is 0. Repeated
    rows get equal verdicts and are scored once a batch; an empty table gives no rows. in_memory is how many grams are looked
    up in memory; results don't depend on it.
    """
    ship(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    seeded = F.col("host").rlike("|".join(map(re.escape, seed_words))) if seed_words else F.lit(False)
    side = F.when(F.col("ruled") == "block", False).when(F.col("ruled") == "allow", F.when(~seeded, True)).when(seeded, False)
    rows = rows.withColumn("text", F.when(F.col("ruled").isNull(), F.coalesce("url", F.lit(""))))
    labelled = rows.where("url is not null").select("url", side.alias("accepted")).where("accepted is not null")
    scorer, at = fit(labelled, rows.where("text is not null").select(F.col("text").alias("url")), in_memory)
    scored = scorer.add(rows, "text", "raw").withColumn("score", F.col("raw") - F.lit(at))
    model_says = F.when(F.col("score") < 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", model_says).alias("verdict"), "score")
