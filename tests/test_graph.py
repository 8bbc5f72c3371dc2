import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.operators import graph

RAW = [(10, 20), (20, 10), (10, 20), (10, 30), (30, 10), (30, 30), (40, 10)]


@pytest.fixture(scope="module")
def index(spark):
    return graph.dense_index(spark.createDataFrame([(i,) for i in (30, 10, 50, 20, 40, 10)], "id long")).cache()


@pytest.fixture(scope="module")
def edges(spark, index):
    return graph.translate(spark.createDataFrame(RAW, "source long, target long"), index).cache()


def rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_ids(index):
    assert rows(index) == [(10, 0), (20, 1), (30, 2), (40, 3), (50, 4)]


def test_unknown_endpoint_raises(spark, index):
    with pytest.raises(KeyError):
        graph.translate(spark.createDataFrame([(40, 99)], "source long, target long"), index)


def test_degrees(edges, index):
    assert rows(graph.degrees(edges, index)) == [(0, 3, 3), (1, 1, 2), (2, 2, 2), (3, 1, 0), (4, 0, 0)]


def test_adjacency_and_offsets(edges, index):
    assert rows(graph.indptr(edges, index)) == [(0, 0, 3), (1, 3, 4), (2, 4, 6), (3, 6, 7), (4, 7, 7)]
    assert [r[1:] for r in rows(graph.indptr(edges, index, "target"))] == [(0, 3), (3, 5), (5, 7), (7, 7), (7, 7)]
    assert {r["node"]: r["neighbours"] for r in graph.adjacency(edges).collect()} == {0: [1, 1, 2], 1: [0], 2: [0, 2], 3: [0]}
    assert {r["node"]: r["neighbours"] for r in graph.adjacency(edges, "target").collect()} == {0: [1, 2, 3], 1: [0, 0], 2: [0, 2]}


def test_mutual(edges, index):
    m = graph.mutual_edges(edges)
    assert rows(m) == [(0, 1), (0, 2), (1, 0), (2, 0), (2, 2)]
    assert rows(graph.mutual_degrees(m)) == [(0, 2), (1, 1), (2, 2)]
    assert rows(graph.mutual_matrix(edges)) == [(0, 1, 1), (0, 2, 1), (1, 0, 1), (2, 0, 1), (2, 2, 1)]
    assert rows(graph.structural_degrees(m)) == [(0, 2), (1, 1), (2, 3)]
    assert rows(graph.low_mutual_nodes(index, m, 2)) == [(1, 1, 1), (3, 0, 2), (4, 0, 2)]


def test_weights(edges):
    assert rows(graph.weights(edges).distinct()) == [(0, 1, 20.410747), (0, 2, 20.410747), (1, 0, 15.388747), (2, 0, 20.410747), (2, 2, 29.127655), (3, 0, 15.388747)]


def test_probabilities(edges):
    deg = graph.degrees(edges)
    out = rows(graph.neighbour_probabilities(edges, deg).where("node = 2"))
    assert out == [(2, 0, 0, 0.442114), (2, 1, 2, 0.557886)]
    assert [r[2:] for r in rows(graph.neighbour_probabilities(edges, deg, "target").where("node = 0"))] == [(1, 0.380094), (2, 0.239812), (3, 0.380094)]


def test_alias_slots_induce_the_probabilities(edges):
    p = graph.neighbour_probabilities(edges, graph.degrees(edges))
    a = graph.alias_slots(p).toPandas()
    for node, g in a.groupby("node"):
        got = {}
        for r in g.itertuples():
            got[r.neighbour] = got.get(r.neighbour, 0) + r.prob / len(g)
            got[r.alias] = got.get(r.alias, 0) + (1 - r.prob) / len(g)
        want = {r["neighbour"]: r["s"] for r in p.where(F.col("node") == node).groupBy("neighbour").agg(F.sum("probability").alias("s")).collect()}
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert a.prob16.between(0, 65535).all()


def test_draws_follow_the_probabilities(spark, edges):
    a = graph.alias_slots(graph.neighbour_probabilities(edges, graph.degrees(edges)))
    draws = spark.range(4000).select(F.col("id").alias("draw"), F.when(F.col("id") % 2 == 0, 2).otherwise(4).cast("long").alias("node"))
    got = {r["neighbour"]: r["count"] for r in graph.draw_neighbours(draws, a).groupBy("neighbour").count().collect()}
    assert got[None] == 2000 and abs(got[2] / 2000 - 0.558) < 0.04


def test_two_hop(edges):
    assert rows(graph.two_hop(edges)) == [(0, 2, 1), (1, 2, 1), (1, 3, 1), (2, 3, 1)]


def test_order_of_the_fixture(edges, index):
    m = graph.mutual_edges(edges)
    assert [n for _, n in sorted((r["position"], r["node"]) for r in graph.reverse_cuthill_mckee(m, index).collect())] == [2, 0, 1, 4, 3]


def queue_order(links, n):
    near = {v: sorted({b for a, b in links if a == v}) for v in range(n)}
    deg = {v: len(near[v]) + (v in near[v]) for v in near}
    seen, out = set(), []
    for start in sorted(near, key=lambda v: (deg[v], v)):
        if start in seen:
            continue
        seen.add(start)
        line = [start]
        for v in line:
            new = sorted((u for u in near[v] if u not in seen), key=lambda u: (deg[u], u))
            seen.update(new)
            line += new
        out += line
    return out[::-1]


def test_order_against_a_queue(spark):
    rng = np.random.default_rng(3)
    pairs = {tuple(p) for p in rng.integers(0, 40, (45, 2)).tolist()}
    links = pairs | {(b, a) for a, b in pairs}
    edges = spark.createDataFrame(sorted(links), "source long, target long")
    nodes = spark.range(45).withColumnRenamed("id", "idx")
    got = [n for _, n in sorted((r["position"], r["node"]) for r in graph.reverse_cuthill_mckee(edges, nodes).collect())]
    assert got == queue_order(links, 45)


def test_numbered_with_ties_and_totals(spark):
    df = spark.createDataFrame([(i % 7, i, i % 3) for i in range(300)], "k long, id long, w long")
    got = sorted((r["k"], r["id"], r["at"]) for r in graph.numbered(df, ["k", "id"], "at").collect())
    assert [r[2] for r in got] == list(range(300))
    total = sorted((r["k"], r["id"], r["w"], r["s"]) for r in graph.numbered(df, ["k", "id"], "s", "w").collect())
    at = 0
    for *_, w, s in total:
        assert s == at
        at += w


def test_empty_graph(spark):
    e = spark.createDataFrame([], "source long, target long")
    assert graph.degrees(e).count() == graph.mutual_edges(e).count() == graph.weights(e).count() == graph.components(e).count() == 0


def test_scratch_tables_are_removed(spark):
    from pathlib import Path

    from starloom import scratch

    at = scratch.mark()
    a, b = (scratch.materialise(spark.range(3 + k), "removal") for k in range(2))
    paths = [Path(df.inputFiles()[0].removeprefix("file://")).parent for df in (a, b)]
    scratch.clear(spark, at, keep=(b,))
    assert not paths[0].exists() and paths[1].exists() and b.count() == 4 and scratch.mark() == at + 1
    scratch.discard(b)
    assert not paths[1].exists() and scratch.mark() == at


def test_pairs_that_are_no_two_hops(spark):
    """Pairs that meet elsewhere than said are two-hop pairs, others are not, however often they are drawn."""
    edges = spark.createDataFrame([(1, 10), (2, 10), (1, 11), (3, 11), (3, 12), (1, 10)], "source long, target long")
    drawn = spark.createDataFrame([(1, 10, 2), (1, 10, 3), (2, 10, 3), (2, 10, 3), (3, 11, 1)], "a long, via long, b long")
    assert sorted(map(tuple, graph.no_two_hops(drawn, edges).select("a", "b").collect())) == [(2, 3), (2, 3)]
    assert graph.no_two_hops(drawn.where("via = 10 AND b = 2"), edges).count() == 0


def test_alias_of_nodes_over_several_batches():
    """Nodes that are cut by batches, one of them over three, have the tables that they have in one piece."""
    sizes = [3, 25, 1, 7]
    rows = pd.DataFrame({"node": np.repeat(np.arange(4), sizes), "slot": np.concatenate([np.arange(n) for n in sizes]), "neighbour": np.arange(36), "probability": np.concatenate([np.arange(1, n + 1) * 2 / (n * (n + 1)) for n in sizes])})
    whole = pd.concat([graph._alias(rows[rows.node == k]) for k in range(4)]).reset_index(drop=True)
    cut = pd.concat(graph._alias_batches(iter([rows[i : i + 10] for i in range(0, 40, 10)]))).reset_index(drop=True)
    assert cut.equals(whole)
    chance = whole.prob.groupby(whole.neighbour).sum().add((1 - whole.prob).groupby(whole.alias).sum(), fill_value=0)
    assert np.allclose(chance.to_numpy(), rows.probability * np.repeat(sizes, sizes))
