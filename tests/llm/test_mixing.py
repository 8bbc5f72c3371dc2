import functools
import heapq

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing

from .conftest import SF


def water(sizes, cap=3):
    """Targets by repeated sharing, as the definition says. sizes: by source in order."""
    weight = {s: i % 3 + 1 for i, s in enumerate(sizes)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(cap * sizes[s]) for s in over}


def check(got, tolerance):
    rows = [r.asDict() for r in got.collect()]
    sizes = {}
    for r in sorted(rows, key=lambda r: (r["source"] is None, (r["source"] or "").encode())):
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = water(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    for s in sizes:
        mine = [r for r in rows if r["source"] == s]
        assert all(abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) and r["source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= tolerance(want[s], len(mine))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    return rows


def test_targets_and_shares(docs):
    rows = check(mixing.mix(docs), lambda t, n: 0.01 * t + 10)
    assert len(rows) == docs.count()
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(docs, seed=12).collect()} != again


def test_against_sql(docs):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got)) == sorted(c.sql(mixing.SQL).fetchall())


def test_sizes(docs, texts):
    assert all(r["size"] == len(texts[r["doc_id"]].encode().split()) for r in mixing.mix(docs).collect())


def test_caps_reshare(spark):
    rows = [(i, "w " * n, s, 0) for i, (s, n) in enumerate([("a", 1000), ("b", 10), ("c", 10), ("d", 2000), (None, 5), ("B", 50)])]
    check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")), lambda t, n: 0.02 * t + 2)


def test_odd_rows(odd, none):
    rows = check(mixing.mix(odd.withColumn("taken", F.lit("x")).withColumn("_s", F.lit(0))), lambda t, n: 0.02 * t + 300)
    assert len(rows) == odd.count()
    assert mixing.mix(none).count() == 0
    assert all(r["taken"] == 0 for r in mixing.mix(odd.where("doc_id <= 3")).collect())


@pytest.mark.parametrize(("claims", "seats"), [([53, 24, 23], 7), ([1, 1, 1, 1], 2), ([100, 1, 1], 5), ([340, 300, 0, 60], 1000), ([5], 3), ([9, 9, 9, 2, 2, 2, 2], 11)])
def test_highest_quotients(spark, claims, seats):
    df = spark.createDataFrame([(0, i, c, seats) for i, c in enumerate(claims)], "g long, k long, c long, s long")
    got = [r["out"] for r in mixing.apportion(df, "c", "s", ["g"], ["k"], "out").orderBy("k").collect()]
    heap, want = [(-c, i, 0) for i, c in enumerate(claims) if c], [0] * len(claims)
    heapq.heapify(heap)
    for _ in range(seats):
        _, i, n = heapq.heappop(heap)
        want[i] += 1
        heapq.heappush(heap, (-claims[i] / (2 * n + 3), i, n + 1))
    assert got == want


def test_no_python_in_the_plan(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_small_sources_beside_a_huge_one(spark):
    """Sources of a few hundred or thousand short documents get their targets (three passes) beside one with many blocks and shards."""
    sizes = {"a": (10_000, 2000), "b": (1000, 100), "c": (200, 100), "d": (3, 40), "e": (2000, 100)}
    parts = [spark.range(n).select("id", F.expr(f"repeat('w ', {w})").alias("text"), F.lit(s).alias("source")) for s, (n, w) in sizes.items()]
    docs = functools.reduce(lambda x, y: x.unionByName(y), parts)
    docs = docs.select(F.concat("source", F.col("id").cast("string")).alias("doc_id"), "text", "source")
    got = {r["source"]: r for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()}
    for s, r in got.items():
        assert abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 1 and r["over"] <= 0, (s, r)


def test_every_column_stays(docs):
    names = "_k _h _s _n _q _u _end _c _w _low _high _open _won _shard_size _blocks _block _shards row order".split()
    more = docs.select("*", *[F.lit(n).alias(n) for n in names])
    out = mixing.mix(more)
    assert out.columns == [*more.columns, *mixing.OUT] and all(r[n] == n for r in out.collect() for n in names)


def test_rows_with_one_id(spark):
    """Rows with the same id and size but other texts: reruns agree, however the rows lie."""
    rows = [(1, f"{c} {c} {c}", "s") for c in "abcdefgh"] + [(2, "x " * 50, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [sorted(map(tuple, mixing.mix(df.repartition(n)).collect())) for n in (1, 5)]
    assert got[0] == got[1]
