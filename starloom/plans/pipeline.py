"""From a graph to a tiled map in one call: every stage a table in the shared folder, so that a lost executor costs one stage at most."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators import cluster, embed, graph, spatial
from ..scratch import materialise


@dataclass
class GraphTables:
    """What ingestion makes of nodes (id) and edges (source, target: ids)."""

    index: DataFrame  # id, idx
    edges: DataFrame  # source, target: positions
    degrees: DataFrame  # node, out_deg, in_deg
    weights: DataFrame  # source, target, weight, each parallel edge
    mutual: DataFrame  # source, target
    out_slots: DataFrame  # alias tables over followees and followers
    in_slots: DataFrame


def ingest(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> GraphTables:
    """Ids to positions (unknown endpoints raise), degrees, weights, mutual edges and alias tables."""
    index = materialise(graph.dense_index(nodes, id_col), "index")
    links = materialise(graph.translate(edges, index), "edges")
    deg = materialise(graph.degrees(links, index), "degrees")
    out_slots, in_slots = (materialise(graph.alias_slots(graph.neighbour_probabilities(links, deg, by).where("probability IS NOT NULL")), "slots") for by in ("source", "target"))
    return GraphTables(index, links, deg, materialise(graph.weights(links, deg), "weights"), materialise(graph.mutual_edges(links), "mutual"), out_slots, in_slots)


def vectors(tables: GraphTables, config: PipelineConfig = PipelineConfig(), wanted: int = 16) -> DataFrame:
    """(idx, embedding), trained on mutual edges and, for nodes with fewer than `wanted` of them, on followers of followees."""
    low = materialise(graph.low_mutual_nodes(tables.index, tables.mutual, wanted).select("node", "deficit"), "low")

    found, _ = embed.train(tables.mutual, tables.index.count(), config, embed.TwoHop(low, tables.out_slots, tables.in_slots))
    return materialise(found, "vectors")


def positions(points: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(idx, x, y) of (idx, embedding), positions 0 .. n - 1: neighbours (exact, unless the settings ask for approximate ones), fuzzy set, layout from the principal plane."""
    neighbours = embed.knn_approximate if config.approximate_neighbors else embed.knn_exact
    fuzzy = embed.fuzzy_union(embed.memberships(embed.as_arrays(neighbours(points, config.n_neighbors))))
    a, b = embed.curve(config.spread, config.min_dist)
    return materialise(embed.layout(fuzzy, embed.projected(points), a, b, config.layout_epochs, seed=config.seed), "positions")


def build_map(nodes: DataFrame, edges: DataFrame, config: PipelineConfig = PipelineConfig()) -> dict[str, DataFrame]:
    """nodes (id), edges (source, target) -> `nodes` (id, x, y, mass, color), `tiles`, and `packed` with each tile's bytes."""
    from ..sources.sinks import map_nodes

    tables = ingest(nodes, edges)
    points = vectors(tables, config)
    placed = positions(points, config)
    _, centers = cluster.kmeans(points, config.n_clusters, config.seed)
    degree = tables.degrees.select(F.col("node").alias("idx"), F.col("in_deg").alias("degree"))
    out = materialise(map_nodes(tables.index, placed, cluster.colours(points, degree, centers)), "map")
    area = spatial.area_of(out)
    tiles = materialise(spatial.tiles(out, config.capacity, area), "tiles")
    shown = spatial.tile_points(out, tiles, config.capacity, area)
    return {"nodes": out, "tiles": tiles, "packed": spatial.packed_tiles(shown, tiles, area)}
