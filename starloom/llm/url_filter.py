"""URL filters: a rule list first, association rules mined from labelled URLs for the rest.

The list: a rule is a host and a path; it fits that host and its subdomains if the url's path starts with the rule's. The longest rule that
fits wins (by host, then path; allow before block on a tie).

The method: a URL is a set of tokens (host labels and their parts, path segments, file extension, query keys and words of their values, each with its place). Spark's
FP-growth mines frequent combinations over labelled URLs, each basket holding its label as one more item. Rules tokens -> label need `min_confidence` and
`min_support`, and a rule is dropped if one of its subsets promises as much. They are matched by an inverted index: each token
lists the rules it occurs in, and a rule fires when all of its tokens were met. The most confident rule that fires decides (then more
support, then the rule's text); URLs that fire no rule get `default`.

Labels: any labelled URLs (url, verdict), all of them. The tables hold none (pages of unwanted hosts read like all others, and URLs that the list judges would
teach the list's own host and path), so without some, `example_urls` makes a set of example sites, in which most words stand in unwanted and in ordinary
names alike (a spam farm and a dairy farm, cheap pills and cheap flights), so that combinations decide, not words. Subdomains, domains, languages and numbers say nothing.
Frequent items number at most tokens a URL / support and itemsets have at most `max_items` tokens, so rules stay few; their number is
checked before they are broadcast, and beyond `MAX_RULES` mining fails with the remedy (a higher support).

A null url, or one without "://", has an empty host and path, no tokens, and the default verdict. Repeated URLs all get the same result. An empty table gives an empty one.
Other columns stay, whatever their names; only host, path, rule, verdict and mined are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, without

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict) of the production list.
LISTED = (("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW))
MAX_RULES = 20_000
OUT = ("host", "path", "rule", "verdict", "mined")
# Names of example sites, each two words; unwanted ones first. Most words also stand in names of the other kind.
UNWANTED = (
    "casino win,casino bonus,casino online,online poker,poker cash,free bets,best bets,sports bets,free slots,cheap pills,cheap meds,buy pills,buy meds,diet pills,ads track,ads server,ads click,"
    "click track,pixel track,spam farm,link farm,content farm,click farm,spam link,adult x,adult video,adult dating,hot dating,sex video,sex chat,free porn,porn video,payday loan,fast loan,"
    "cash loan,crack keygen,free crack,free keygen,replica watch,replica bags,lottery win,prize win,win cash,escort girls"
).split(",")
ORDINARY = (
    "casino history,online library,online news,poker rules,free library,free press,free software,best recipes,sports news,sports club,cheap flights,cheap hotels,buy local,diet advice,ads museum,"
    "race track,sound track,rail track,click beetle,pixel art,dairy farm,wind farm,organic farm,farm shop,content design,link editor,spam filter,adult education,adult learning,x rays,video art,"
    "hot springs,sex education,chat club,loan library,fast train,cash book,crack climbing,watch maker,old bags,lottery history,prize garden,win win,girls school,garden server,bonus track,school meds,slots design"
).split(",")


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query): host after the first :// up to / ? # or the end, A-Z lower-cased; path from there up to ? # or the end; query from ? up to #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path, query


def listed(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]), len(r[1]), r[2] == ALLOW, r[0], r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(host: str, path: str, query: str = "") -> list[str]:
    """Distinct tokens of a URL, each tagged by its place; numbers count by their length alone."""
    out = []
    labels = [x for x in host.split(":")[0].split(".") if x]
    for i, label in enumerate(reversed(labels)):
        out.append(f"{'tld' if i == 0 else 'host'}={label}")
        out += [f"word={w}" for w in re.split(r"[-_]", label) if i and w != label and w]
        out += [f"word={label}"] if i and not re.search(r"[-_]", label) else []
    parts = [x for x in path.split("/") if x]
    for i, part in enumerate(parts):
        stem, _, end = part.rpartition(".")
        stem, end = (stem, end) if stem and len(end) <= 5 else (part, "")
        out.append(f"path{min(i, 2)}=" + (f"#{len(stem)}" if stem.isdigit() else stem.lower()))
        out += [f"ext={end.lower()}"] if end else []
        out += [f"word={w}" for w in re.split(r"[^a-z]+", stem.lower()) if len(w) > 2]
    for part in query.split("&"):
        key, _, value = part.partition("=")
        out += [f"query={key.lower()}"] if key else []
        out += [f"word={w}" for w in re.split(r"[^a-z]+", value.lower()) if len(w) > 2]
    return sorted(set(out))


def _baskets(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for host, path, query in parts:
        yield pd.Series([tokens(h, p, q) for h, p, q in zip(host, path, query, strict=True)], dtype=object)


def basket(host: Column, path: Column, query: Column) -> Column:
    return F.pandas_udf(_baskets, "array<string>")(host, path, query)


@dataclass(frozen=True)
class MinedRule:
    tokens: frozenset[str]
    verdict: str
    confidence: float
    support: float

    @property
    def text(self) -> str:
        return " & ".join(sorted(self.tokens))


def mine(baskets: DataFrame, min_support: float = 0.005, min_confidence: float = 0.9, max_items: int = 3) -> list[MinedRule]:
    """Rules from (tokens, verdict) rows, pruned by support, confidence and subsets."""
    items = baskets.select(F.concat(F.col("tokens"), F.array(F.concat(F.lit("verdict="), F.col("verdict")))).alias("items")).persist()
    total = items.count()
    if not total:
        items.unpersist()
        return []
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    sets = model.freqItemsets.where(F.size("items") <= max_items + 1).limit(MAX_RULES * 8 + 1).collect()
    items.unpersist()
    if len(sets) > MAX_RULES * 8:
        raise ValueError("too many frequent combinations for a broadcast; raise min_support")
    count = {frozenset(r["items"]): r["freq"] for r in sets}
    found: dict[tuple[frozenset[str], str], float] = {}
    rules = []
    for items_, n in sorted(count.items(), key=lambda x: (len(x[0]), sorted(x[0]))):
        label = [i for i in items_ if i.startswith("verdict=")]
        left = items_ - set(label)
        if len(label) != 1 or not left or left not in count:
            continue
        confidence, verdict = n / count[left], label[0].removeprefix("verdict=")
        if confidence < min_confidence or any(found.get((left - {t}, verdict), 0) >= confidence for t in left):
            found[left, verdict] = max([found.get((left - {t}, verdict), 0.0) for t in left if len(left) > 1] or [0.0])
            continue
        found[left, verdict] = confidence
        rules.append(MinedRule(left, verdict, confidence, n / total))
    if len(rules) > MAX_RULES:
        raise ValueError("too many rules for a broadcast; raise min_support or min_confidence")
    return sorted(rules, key=lambda r: (-r.confidence, -r.support, r.text))


class RuleIndex:
    """Inverted index: token -> rules; a rule fires once all of its tokens were met."""

    def __init__(self, rules: list[MinedRule]) -> None:
        self.rules = rules
        self.sizes = [len(r.tokens) for r in rules]
        self.by_token: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            for t in r.tokens:
                self.by_token.setdefault(t, []).append(i)

    def first(self, found: list[str]) -> MinedRule | None:
        met: dict[int, int] = {}
        for t in found:
            for i in self.by_token.get(t, ()):
                met[i] = met.get(i, 0) + 1
        fired = [i for i, n in met.items() if n == self.sizes[i]]
        return self.rules[min(fired)] if fired else None


def example_urls(spark: SparkSession) -> DataFrame:
    """Labelled URLs (url, verdict): the example sites under changing subdomains, domains, languages and numbers; the two words in the host, or the second in the path."""
    rows = []
    for names, verdict in ((UNWANTED, BLOCK), (ORDINARY, ALLOW)):
        for i, name in enumerate(names):
            a, b = name.split()
            for j, host in enumerate((f"{a}-{b}", f"{b}-{a}", f"{a}-{b}-site", f"the-{a}", f"{a}-{b}")):
                under = ("", "www.", "m.", "blog.")[(i + j) % 4]
                end = ("", ".html", "/", "?page=2&ref=x", "?utm_source=feed", "#top")[(i + 2 * j) % 6]
                path = f"{('en', 'de', 'fr', 'es')[(i + j) % 4]}/{f'{b}/' if j == 3 else ''}{i * 7 + j}"
                rows.append((f"https://{under}{host}.example.{('com', 'net', 'org')[(i + j) % 3]}/{path}{end}", verdict))
    return spark.createDataFrame(rows, "url string, verdict string")


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=LISTED, default: str = ALLOW, min_support: float = 0.005, min_confidence: float = 0.9) -> DataFrame:
    """All rows and columns with host, path, rule, verdict, mined (the association rule that decided, if one did); such input columns are replaced."""
    spark = pages.sparkSession
    arrow_batches(spark, 5000)
    labelled = example_urls(spark) if labelled is None else labelled
    found = mine(labelled.select(basket(*split_url(F.col("url"))).alias("tokens"), "verdict"), min_support, min_confidence)
    sent = spark.sparkContext.broadcast(found)
    made: list[RuleIndex] = []

    def decide(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if not made:
            made.append(RuleIndex(sent.value))
        for parts in batches:
            hits = [made[0].first(tokens(h, p, q)) for h, p, q in zip(*parts, strict=True)]
            yield pd.DataFrame({"verdict": [r.verdict if r else default for r in hits], "mined": [r.text if r else None for r in hits]})

    host, path, query = split_url(F.col("row.url"))
    kept = without(pages, *OUT).select(F.struct("*").alias("row"))
    kept = kept.select("row", host.alias("host"), path.alias("path"), query.alias("query"))
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    out = kept.select("*", rule.alias("rule"), verdict.alias("listed"), F.pandas_udf(decide, "struct<verdict string, mined string>")("host", "path", "query").alias("by_rules"))
    mined = F.when(F.col("listed").isNull(), F.col("by_rules.mined"))
    return out.select("row.*", "host", "path", "rule", F.coalesce("listed", "by_rules.verdict").alias("verdict"), mined.alias("mined"))
