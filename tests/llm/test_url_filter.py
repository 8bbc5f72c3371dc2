from itertools import combinations
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from starloom.llm import url_filter

from .conftest import SF


def test_split_and_list(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in url_filter.judge(pages).collect():
        u = urlsplit(r["url"])
        assert (r["host"], r["path"]) == (u.netloc.lower(), u.path) and r["verdict"] in ("allow", "block")
        fits = [(h, p, v) for h, p, v in url_filter.LISTED if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        if fits:
            h, p, v = max(fits, key=lambda x: (len(x[0]), len(x[1])))
            assert (r["rule"], r["verdict"], r["mined"]) == (h + p, v, None)
        else:
            assert r["rule"] is None


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET?x=/en/", "x://net/", "http://notnet/", "http://www.example.net/en/1#a", "a://b://c/d", "http://x.ORG/fr/É?q", "http://example.net/en", "http://net"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("rule", F.lit("r")).withColumn("_m", F.lit(0))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.example.net", "", None, "allow") and got[5] == ("net", "/", "net/", "block") and got[6][2] is None
    assert got[7] == ("www.example.net", "/en/1", "example.net/en/", "allow") and got[8] == ("b:", "//c/d", None, "allow")
    assert got[9] == ("x.org", "/fr/É", "org/fr/", "allow") and got[10][2:] == ("net/", "block") and got[11][2] is None
    assert url_filter.judge(df.limit(0)).count() == 0


def test_combinations_decide(spark):
    """Words of unwanted sites in ordinary company stay; what decides are pairs."""
    urls = ["http://cheap-meds.example.org/es/1", "http://www.casino-win.example.com/en/2", "https://quietgarden.example.com/en/3", "http://dairy-farm.example.org/es/4", "http://www.the-ads.example.com/fr/track/7"]
    urls += ["http://our-farm.example.com/en/1", "http://m.spam-farm.example.com/en/1", "http://blog.tionsh.example.com/en/9", "http://cheap-flights.example.org/en/1", "http://casino-history.example.com/en/5"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = url_filter.judge(df).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block", "block", "allow", "allow", "block", "allow", "block", "allow", "allow", "allow"]
    assert all(" & " in r["mined"] or "-" in r["mined"] for r in got if r["verdict"] == "block")


def test_table_against_brute_force(spark):
    """Every URL that the list leaves open, by trying every mined rule on it."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    labelled = url_filter.example_urls(spark)
    rules = url_filter.mine(labelled.select(url_filter.basket(*url_filter.split_url(F.col("url"))).alias("tokens"), "verdict"), 0.005, 0.9)
    assert sum(len(r.tokens) > 1 for r in rules) > 20
    for r in url_filter.judge(pages, labelled).collect():
        if r["rule"] is None:
            u = urlsplit(r["url"])
            mine = set(url_filter.tokens(u.netloc.lower(), u.path, u.query))
            fired = sorted((x for x in rules if x.tokens <= mine), key=lambda x: (-x.confidence, -x.support, x.text))
            assert (r["verdict"], r["mined"]) == ((fired[0].verdict, fired[0].text) if fired else ("allow", None))


def test_query_words_count(spark):
    labelled = spark.createDataFrame([(f"http://s{i}.x.com/p?topic={'gore' if i % 2 else 'art'}&n={i}", "block" if i % 2 else "allow") for i in range(40)], "url string, verdict string")
    df = spark.createDataFrame([(1, "http://new.y.org/q?topic=gore"), (2, "http://new.y.org/q?topic=art"), (3, "http://new.y.org/q#topic=gore")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judge(df, labelled).orderBy("page_id").collect()] == ["block", "allow", "allow"]


def test_every_column_stays(spark):
    names = "row query listed by_rules _m tokens found".split()
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("*", *[F.lit(n).alias(n) for n in names])
    out = url_filter.judge(pages)
    assert out.columns == [*pages.columns, *url_filter.OUT] and all(r[n] == n for r in out.collect() for n in names)


def test_mined_rules_equal_brute_force(spark):
    rows = [(["a", "b"], "block")] * 6 + [(["a"], "allow")] * 5 + [(["b"], "allow")] * 4 + [(["c", "a"], "allow")] * 3 + [(["d"], "block")] * 2
    got = {(r.tokens, r.verdict): (r.confidence, r.support) for r in url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.1, 0.7, 3)}
    want, items = {}, sorted({t for ts, _ in rows for t in ts})
    confidence = lambda s, v: sum(s <= {*ts} and x == v for ts, x in rows) / max(1, sum(s <= {*ts} for ts, _ in rows))
    for n in (1, 2, 3):
        for s in map(frozenset, combinations(items, n)):
            for v in ("allow", "block"):
                support = sum(s <= {*ts} and x == v for ts, x in rows) / len(rows)
                if support >= 0.1 and confidence(s, v) >= 0.7 and not any(confidence(s - {t}, v) >= max(0.7, confidence(s, v)) for t in s if n > 1):
                    want[s, v] = (confidence(s, v), support)
    assert got == want and (frozenset("ab"), "block") in got


def test_index_fires_whole_combinations_only():
    rules = [url_filter.MinedRule(frozenset("ab"), "block", 0.9, 0.1), url_filter.MinedRule(frozenset("c"), "allow", 0.8, 0.2)]
    index = url_filter.RuleIndex(rules)
    assert index.first(["a"]) is None and index.first(["a", "b", "c"]) is rules[0] and index.first(["c"]) is rules[1]


def test_own_labels(spark):
    labelled = spark.createDataFrame([(f"http://s{i}.x.com/{'gore' if i % 2 else 'art'}/{i}", "block" if i % 2 else "allow") for i in range(40)], "url string, verdict string")
    df = spark.createDataFrame([(1, "http://new.y.org/gore/1"), (2, "http://new.y.org/art/1")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judge(df, labelled).orderBy("page_id").collect()] == ["block", "allow"]
