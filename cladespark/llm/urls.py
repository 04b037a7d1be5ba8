"""URL filters: rules first, then naive Bayes over segmented host and path words.

Concatenated names are split into words by a unigram Viterbi search. The unigram
counts come from all page titles. The naive Bayes model is multinomial: its
labelled rows are all urls on which a rule decides, beside a short list of
labelled names; a class's prior is its share of these urls. Words that rules test themselves (of their hosts
and paths) are no features: they would only repeat the rules. Each class is smoothed in
proportion to its size, so a token that neither has is neutral.

All title words that occur twice and all training tokens count. Workers hold only the
frequent ones, those with ``WORD_SHARE`` of all title words or ``TOKEN_SHARE`` of all
training tokens, of which there are at most as many as the inverse of the share; all
others are joined to the names and rows that have them.

Defined results: a null url or one without ``://`` has empty host and path, no rule and
no tokens, and is allowed; repeated rows repeat; further columns are left out.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch, scratch

WORD_SHARE = 1e-5
TOKEN_SHARE = 1e-5
#: The share of a class's training tokens that each labelled name adds.
NAME_SHARE = 0.02
#: Names labelled by hand.
BLOCKED_NAMES = ["spam", "spam farm", "cheap pills", "casino", "free money", "adult cams", "betting", "payday loans", "malware", "click bait", "porn", "viagra"]
ALLOWED_NAMES = ["blog", "news", "library", "university", "school", "science", "museum", "docs", "wiki", "journal", "weather", "health"]
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONGEST_WORD = 24


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of urls; both empty where there is no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, *LOWER), path


def rule_of(rules: list[Rule], host: Column, path: Column, value: str) -> Column:
    """name or action of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


class Words(NamedTuple):
    """The share of each frequent word of all titles, the least share of any, and a table (word, share) of the others."""

    frequent: dict[str, float]
    least: float
    rare: DataFrame | None


def title_words(pages: DataFrame, tables: Scratch, html: str = "html") -> Words:
    title = F.lower(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), "(?is)<title>(.*?)</title>", 1))
    words = pages.select(F.explode(F.regexp_extract_all(title, F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    counts = tables.keep(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "title-words")
    total, least = counts.agg(F.sum("n"), F.min(F.when((F.col("n") >= 2) & (F.char_length("word") <= LONGEST_WORD), F.col("n")))).first()
    often = F.col("n") >= WORD_SHARE * (total or 0)
    rows = counts.filter((F.col("n") >= 2) & often).collect()  # 1 / WORD_SHARE rows at most
    rare = counts.filter((F.col("n") >= 2) & ~often & (F.char_length("word") <= LONGEST_WORD)).select("word", (F.col("n") / F.lit(total or 1)).alias("share"))
    return Words({r["word"]: r["n"] / total for r in rows}, (least or 1) / (total or 1), rare if rare.limit(1).count() else None)


def names_in(part: str) -> list[tuple[str, str]]:
    """(number, "") or ("", name) for each of a host or path."""
    return re.findall(r"(\d+)|([^\W\d_]+)", part)


def parts_of(name: str) -> set[str]:
    """What could be a word of a name."""
    return {name[i:j] for i in range(len(name)) for j in range(i + 1, min(len(name), i + LONGEST_WORD) + 1)}


def with_rare_words(urls: DataFrame, words: Words, tables: Scratch) -> DataFrame:
    """Adds rare, a map of the rare title words that are in the names of host and path."""
    kind = "map<string,double>"
    if words.rare is None:
        return urls.withColumn("rare", F.lit(None).cast(kind))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names = [], []
            for row, host, path in zip(*(c.to_pylist() for c in batch.columns)):
                own = {name for part in (host, path.lower()) for _, name in names_in(part) if name}
                rows += [row] * len(own)
                names += own
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(names, pa.string())], ["row", "name"])

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                own = list(parts_of(name))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(own), pa.string()), pa.array(own, pa.string())], ["name", "word"])

    names = tables.keep(urls.select("row", "host", "path").mapInArrow(named, "row long, name string"), "names")
    hits = names.select("name").distinct().mapInArrow(parted, "name string, word string").join(words.rare, "word")
    found = names.join(hits, "name").select("row", "word", "share").distinct()
    maps = found.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("word", "share"))).alias("rare"))
    return urls.join(maps, "row", "left")


class Segmenter:
    """The most likely split of a name into words; an unknown word costs more with each letter."""

    def __init__(self, shares: dict[str, float], least: float = 1.0, tested: frozenset[str] = frozenset()):
        self.tested = tested  # names that are no features
        self.cost = {w: -math.log(p) for w, p in shares.items() if len(w) <= LONGEST_WORD}
        self.unknown = max([*self.cost.values(), 10.0, -math.log(least)])
        self.rare: dict[str, float] = {}  # the costs of all words in the next names that aren't in cost
        self.split = functools.lru_cache(50_000)(self._split)

    def word_cost(self, word: str) -> float:
        return self.cost.get(word) or self.rare.get(word) or self.unknown + 3.0 * len(word)

    def know(self, rare: dict[str, float]) -> None:
        self.rare = {w: -math.log(p) for w, p in rare.items()}

    def _split(self, name: str) -> tuple[str, ...]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            cost, start = min((best[i] + self.word_cost(name[i:end]), i) for i in range(max(0, end - LONGEST_WORD), end))
            best.append(cost)
            back.append(start)
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return tuple(words[::-1])

    def tokens(self, host: str, path: str) -> list[str]:
        """h: and p: words of host and path but those that rules test; a number is one token of its own kind."""
        out = []
        for kind, part in (("h:", host), ("p:", path.lower())):
            for number, name in names_in(part):
                out += [kind + "0"] if number else [kind + w for w in self.split(name) if name not in self.tested]
        return out


def with_tokens(urls: DataFrame, words: Words, key: str, tested: frozenset[str]) -> DataFrame:
    """Adds tokens, the segmented words of host and path, to row, key, host, path, rule, action."""
    frequent, least = words.frequent, words.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(frequent, least, tested)
        for batch in batches:
            tokens = []
            for host, path, rare in zip(*(batch.column(i).to_pylist() for i in (2, 3, 6))):
                segmenter.know(dict(rare or {}))
                tokens.append(segmenter.tokens(host, path))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(tokens, pa.list_(pa.string()))], [*batch.schema.names[:6], "tokens"])

    kind = urls.schema[key].dataType.simpleString()
    return urls.select("row", key, "host", "path", "rule", "action", "rare").mapInArrow(run, f"row long, `{key}` {kind}, host string, path string, rule string, action string, tokens array<string>")


class Odds(NamedTuple):
    """The log odds of block before any token, for each frequent token and for one not seen, and a table (token, odds) of the others."""

    prior: float
    frequent: dict[str, float]
    unseen: float
    rare: DataFrame | None


def naive_bayes(tokens: DataFrame, words: Words, tables: Scratch) -> Odds:
    """Over all tokens of all rows that a rule decides, and the labelled names."""
    rows_of = {r["action"]: r["count"] for r in tokens.groupBy("action").count().collect()}
    prior = math.log((rows_of.get("block", 0) + 1) / (rows_of.get("allow", 0) + 1))
    counts = tokens.filter(F.col("action").isNotNull()).select("action", F.explode("tokens").alias("token")).groupBy("token").agg(*(F.count_if(F.col("action") == a).alias(a) for a in ("block", "allow")))
    counts = tables.keep(counts, "tokens")
    total = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count(F.lit(1)).alias("distinct")).first().asDict()
    total = {k: float(v or 0) for k, v in total.items()}
    segmenter = Segmenter(words.frequent, words.least)
    if words.rare is not None:
        parts = set().union(*(parts_of(x) for name in BLOCKED_NAMES + ALLOWED_NAMES for x in name.split()))
        segmenter.know({r["word"]: r["share"] for r in words.rare.filter(F.col("word").isin(*sorted(parts))).collect()})
    named = {"block": Counter(), "allow": Counter()}
    for a, names in (("block", BLOCKED_NAMES), ("allow", ALLOWED_NAMES)):
        weight = max(1.0, NAME_SHARE * total[a])
        for name in names:
            for kind in ("h:", "p:"):
                for word in {*name.split(), *(w for x in name.split() for w in segmenter.split(x))}:
                    named[a][kind + word] += weight
    labelled = sorted({*named["block"], *named["allow"]})
    often = (F.col("block") + F.col("allow") >= max(1.0, TOKEN_SHARE * (total["block"] + total["allow"]))) | F.col("token").isin(*labelled)
    rows = counts.filter(often).collect()  # 1 / TOKEN_SHARE rows at most, and those of the labelled names
    seen = {a: Counter(own) for a, own in named.items()}
    for row in rows:
        for a, own in seen.items():
            own[row["token"]] += row[a]
    distinct = total["distinct"] + len({*labelled}.difference(r["token"] for r in rows))
    sizes = {a: max(1.0, total[a] + sum(named[a].values())) for a in seen}
    added = {a: x / max(sizes.values()) for a, x in sizes.items()}
    sums = {a: sizes[a] + added[a] * distinct for a in seen}
    odds = {t: math.log((seen["block"][t] + added["block"]) / sums["block"]) - math.log((seen["allow"][t] + added["allow"]) / sums["allow"]) for t in {*seen["block"], *seen["allow"]}}
    unseen = math.log(added["block"] / sums["block"]) - math.log(added["allow"] / sums["allow"])  # 0 but for rounding
    rare = counts.filter(~often).select("token", (F.log((F.col("block") + added["block"]) / (F.col("allow") + added["allow"])) + F.lit(math.log(sums["allow"] / sums["block"]))).alias("odds"))
    return Odds(prior, odds, unseen, rare if rare.limit(1).count() else None)


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, host, path, rule (its name, or null), verdict, tokens, score (log odds of block)."""
    kind = pages.schema[key].dataType.simpleString()
    host, path = host_and_path(F.coalesce(F.col(url), F.lit("")))
    with scratch(pages.sparkSession) as tables:
        words = title_words(pages, tables, html)
        urls = tables.keep(pages.select(F.monotonically_increasing_id().alias("row"), key, host.alias("host"), path.alias("path")), "urls")
        urls = urls.withColumns({n: rule_of(rules, F.col("host"), F.col("path"), v) for n, v in (("rule", "name"), ("action", "action"))})
        tokens = tables.keep(with_tokens(with_rare_words(urls, words, tables), words, key, frozenset(x for rule in rules for part in (rule.host, rule.path.lower()) for _, x in names_in(part) if x)), "with-tokens")
        odds = naive_bayes(tokens, words, tables)
        frequent, unseen = odds.frequent, odds.unseen

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(6).to_pylist()
                scores = [sum(frequent.get(t, 0.0) for t in x) for x in lists]
                others = [[t for t in x if t not in frequent] for x in lists]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(others, pa.list_(pa.string()))], [*batch.schema.names, "known", "others"])

        scored = tokens.mapInArrow(run, f"row long, `{key}` {kind}, host string, path string, rule string, action string, tokens array<string>, known double, others array<string>")
        if odds.rare is None:
            scored = scored.withColumn("score", F.col("known") + unseen * F.size("others"))
        else:
            asked = scored.select("row", F.explode("others").alias("token")).join(odds.rare, "token", "left")
            sums = asked.groupBy("row").agg(F.sum(F.coalesce("odds", F.lit(unseen))).alias("more"))
            scored = scored.join(sums, "row", "left").withColumn("score", F.col("known") + F.coalesce("more", F.lit(0.0)))
        scored = scored.withColumn("score", F.col("score") + odds.prior)
        verdict = F.coalesce("action", F.when(F.col("score") > 0, "block").otherwise("allow"))
        return scored.select(key, "host", "path", "rule", verdict.alias("verdict"), "tokens", "score").checkpoint()
