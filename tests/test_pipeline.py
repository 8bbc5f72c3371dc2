import numpy as np
import pytest

from starloom.config import PipelineConfig
from starloom.operators import graph, spatial
from starloom.plans import pipeline


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 40, (160, 2))]
    ids = [(100 + 3 * i, f"did:{i}") for i in range(42)]  # two nodes have no edges
    nodes = spark.createDataFrame(ids, "id long, did string")
    edges = spark.createDataFrame([(100 + 3 * a, 100 + 3 * b) for a, b in pairs + [(b, a) for a, b in pairs[::2]]], "source long, target long")
    return nodes, edges


def test_ingest(tables):
    nodes, edges = tables
    t = pipeline.ingest(nodes, edges)
    assert t.index.count() == t.degrees.count() == 42 and t.edges.count() == t.weights.count() == edges.count()
    assert t.mutual.count() > 0 and t.out_slots.count() == t.in_slots.count() == edges.count()


def test_map(tables):
    out = pipeline.build_map(*tables, PipelineConfig(dim=8, n_neighbors=5, n_clusters=4, max_epoch=3, layout_epochs=4, capacity=10))
    nodes = out["nodes"].toPandas()
    assert sorted(nodes.id) == [100 + 3 * i for i in range(42)] and np.isfinite(nodes[["x", "y"]].to_numpy()).all() and (nodes.mass == 1).all()
    tiles = out["tiles"].toPandas()
    assert tiles[tiles.leaf].total.sum() == 42 and tiles["count"].max() <= 10
    packed = out["packed"].toPandas()
    assert len(packed) == len(tiles)
    in_leaves = sum(sum(n[0] == "leaf" for n in spatial.unpack(a)) for a in packed.atlas if a is not None)
    assert in_leaves == 42 and (packed.nodes.map(len) == 12 * tiles.set_index("path")["count"].reindex(packed.path).to_numpy()).all()


def test_uniform_draws(spark, tables):
    t = pipeline.ingest(*tables)
    draws = t.index.selectExpr("idx AS draw", "idx AS node")
    got = graph.draw_uniform(draws, t.out_slots, 1).toPandas()
    edges = set(map(tuple, t.edges.distinct().collect()))
    assert len(got) == 42 and all((r.node, int(r.neighbour)) in edges for r in got.itertuples() if r.neighbour == r.neighbour)
