"""Operators on a directed multigraph: edges are rows (source, target); parallel edges and self-loops count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import alias_weight, edge_weight, quantise16, uniform
from ..scratch import discard, materialise


# ---- ids


def numbered(df: DataFrame, by: list[str], out: str, total: str | None = None) -> DataFrame:
    """Rows in the order of `by`, numbered from 0 in column `out` - or, with `total`, with the sum of that column over all rows before.

    A range-partitioned sort, then one small row a partition for the offsets: no task holds all rows. The sorted table is written
    first, since partition bounds are sampled and must not change between the two passes.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(total) if total else F.lit(1)
    inside = Window.partitionBy("_p").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tagged = materialise(df.repartitionByRange(n, *by).withColumn("_p", F.spark_partition_id()), "sorted")
    sums = [r for r in tagged.groupBy("_p").agg(F.sum(value).alias("s")).collect()]
    offsets, at = [], 0
    for r in sorted(sums, key=lambda r: r["_p"]):
        offsets.append((r["_p"], at))
        at += r["s"] or 0
    first = df.sparkSession.createDataFrame(offsets, "_p int, _o long")
    placed = tagged.withColumn("_c", F.sum(value).over(inside) - value).join(F.broadcast(first), "_p")  # a row a partition
    return placed.withColumn(out, (F.col("_o") + F.col("_c")).cast("bigint")).drop("_p", "_o", "_c")


def dense_index(nodes: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, idx): the position of each distinct id in ascending order, from 0."""
    return numbered(nodes.select(F.col(id_col).alias("id")).where(F.col(id_col).isNotNull()).distinct(), ["id"], "idx")


def dangling(edges: DataFrame, nodes: DataFrame, id_col: str = "id") -> DataFrame:
    """Edges with an endpoint that is no node."""
    known = nodes.select(F.col(id_col).alias("_n")).distinct()
    bad = edges.join(known, edges["source"] == known["_n"], "left_anti").withColumn("missing", F.lit("source"))
    return bad.unionByName(edges.join(known, edges["target"] == known["_n"], "left_anti").withColumn("missing", F.lit("target")))


def translate(edges: DataFrame, index: DataFrame, check: bool = True) -> DataFrame:
    """Edges between ids as edges between positions; an unknown endpoint raises."""
    if check and (bad := dangling(edges, index).limit(3).collect()):
        raise KeyError(f"edges with an unknown endpoint, such as {[tuple(r) for r in bad]}")
    s, t = index.select(F.col("id").alias("source"), F.col("idx").alias("_s")), index.select(F.col("id").alias("target"), F.col("idx").alias("_t"))
    return edges.join(s, "source").join(t, "target").select(F.col("_s").alias("source"), F.col("_t").alias("target"))


# ---- degrees and weights


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, out_deg, in_deg), parallel edges and loops included; with `nodes` (idx), isolated ones have 0."""
    ends = F.explode(F.array(F.struct(F.col("source").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("target").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    found = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.o").alias("out_deg"), F.sum("e.i").alias("in_deg"))
    if nodes is None:
        return found
    return nodes.select(F.col("idx").alias("node")).join(found, "node", "left").na.fill(0, ["out_deg", "in_deg"])


def weights(edges: DataFrame, deg: DataFrame | None = None) -> DataFrame:
    """Edges with weight; the logarithms are taken once a node, before the joins."""
    deg = degrees(edges) if deg is None else deg
    out = deg.select(F.col("node").alias("source"), F.log1p("out_deg").alias("_a"))
    into = deg.select(F.col("node").alias("target"), F.log1p("in_deg").alias("_b"))
    return edges.join(out, "source").join(into, "target").select("source", "target", edge_weight(F.col("_a"), F.col("_b")).alias("weight"))


def structural_degrees(edges: DataFrame) -> DataFrame:
    """Entries of each row of a symmetric adjacency matrix, one more where the diagonal is set."""
    return edges.groupBy(F.col("source").alias("node")).agg((F.count(F.lit(1)) + F.max((F.col("source") == F.col("target")).cast("int"))).alias("degree"))


# ---- adjacency


def adjacency(edges: DataFrame, by: str = "source") -> DataFrame:
    """(node, neighbours: sorted array), duplicates kept; by="target" gives the mirrored form."""
    other = "target" if by == "source" else "source"
    return edges.groupBy(F.col(by).alias("node")).agg(F.sort_array(F.collect_list(other)).alias("neighbours"))


def slots(edges: DataFrame, by: str = "source") -> DataFrame:
    """(node, slot, neighbour): the long form of adjacency, slots from 0 in neighbour order.

    All edges are numbered in the order of (node, neighbour) and each node's first number taken off, so that a hub's edges may lie in many tasks.
    """
    other = "target" if by == "source" else "source"
    every = materialise(numbered(edges.select(F.col(by).alias("node"), F.col(other).alias("neighbour")), ["node", "neighbour"], "at"), "slots")
    first = every.groupBy("node").agg(F.min("at").alias("first"))
    return every.join(first, "node").select("node", (F.col("at") - F.col("first")).alias("slot"), "neighbour")


def indptr(edges: DataFrame, nodes: DataFrame, by: str = "source") -> DataFrame:
    """(node, start, stop): where each node's edges lie in the edge list sorted by node; nodes (idx) without any have start = stop."""
    count = edges.groupBy(F.col(by).alias("node")).agg(F.count(F.lit(1)).alias("n"))
    full = nodes.select(F.col("idx").alias("node")).join(count, "node", "left").na.fill(0, ["n"])
    return numbered(full, ["node"], "start", "n").select("node", "start", (F.col("start") + F.col("n")).alias("stop"))


def matrix(edges: DataFrame) -> DataFrame:
    """(source, target, value): parallel edges summed."""
    return edges.groupBy("source", "target").agg(F.count(F.lit(1)).alias("value"))


# ---- mutual edges


def mutual_edges(edges: DataFrame, distinct: bool = False) -> DataFrame:
    """Edges that also run the other way, as often as the rarer direction; both directions and loops are kept."""
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return edges.select("source", "target").intersect(back) if distinct else edges.select("source", "target").intersectAll(back)


def mutual_matrix(edges: DataFrame) -> DataFrame:
    """(source, target, value): the smaller multiplicity of both directions; one shuffle by unordered pair instead of a self-join."""
    low, high = F.least("source", "target"), F.greatest("source", "target")
    both = edges.groupBy(low.alias("a"), high.alias("b")).agg(F.sum((F.col("source") <= F.col("target")).cast("int")).alias("f"), F.sum((F.col("source") >= F.col("target")).cast("int")).alias("r"))
    value = F.least("f", "r").cast("bigint")
    pairs = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("target")))).otherwise(
        F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("target")), F.struct(F.col("b").alias("source"), F.col("a").alias("target")))
    )
    return both.where(value > 0).select(F.explode(pairs).alias("e"), value.alias("value")).select("e.source", "e.target", "value")


def mutual_degrees(mutual: DataFrame) -> DataFrame:
    return mutual.groupBy(F.col("source").alias("node")).agg(F.count(F.lit(1)).alias("mutual_deg"))


def low_mutual_nodes(nodes: DataFrame, mutual: DataFrame, wanted: int = 16) -> DataFrame:
    """(node, mutual_deg, deficit) of nodes (idx) with fewer than `wanted` mutual edges: so many pairs are drawn for them."""
    deg = nodes.select(F.col("idx").alias("node")).join(mutual_degrees(mutual), "node", "left").na.fill(0, ["mutual_deg"])
    return deg.where(F.col("mutual_deg") < wanted).withColumn("deficit", (F.lit(wanted) - F.col("mutual_deg")).cast("bigint"))


# ---- two hops


def two_hop(edges: DataFrame, via: str = "target") -> DataFrame:
    """(a, b, shared) for a < b: over how many nodes two others meet. Exact: its size is the sum of squared degrees, so for sparse graphs.

    Parallel edges count once. Nodes of the via side can be hubs: the join has an exchange above it, so adaptive execution can split them.
    """
    end = "source" if via == "target" else "target"
    one = edges.select("source", "target").distinct()
    x, y = one.select(F.col(via).alias("v"), F.col(end).alias("a")), one.select(F.col(via).alias("v"), F.col(end).alias("b"))
    return x.join(y, "v").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def neighbour_probabilities(edges: DataFrame, deg: DataFrame, by: str = "source") -> DataFrame:
    """(node, slot, neighbour, probability): the chance of each edge when a neighbour is drawn, falling with the neighbour's degree.

    Followees weigh by their incoming degree, followers (by="target") by their outgoing one.
    """
    known = deg.select(F.col("node").alias("neighbour"), alias_weight(F.col("in_deg" if by == "source" else "out_deg")).alias("w"))
    weighted = materialise(slots(edges, by).join(known, "neighbour"), "weighted")
    total = weighted.groupBy("node").agg(F.sum("w").alias("total"))  # added up before the shuffle, hubs included
    return weighted.join(total, "node").select("node", "slot", "neighbour", (F.col("w") / F.col("total")).alias("probability"))


def _alias(group: pd.DataFrame) -> pd.DataFrame:
    """Walker's alias method, by Vose, for rows of whole nodes in the order of node and slot: average slots at 1, let rich slots fill poor ones."""
    node = group["node"].to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    sizes = np.diff(np.append(starts, len(node)))
    p = (group["probability"].to_numpy() * np.repeat(sizes, sizes)).tolist()
    prob, alias = [1.0] * len(p), list(range(len(p)))
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        every = range(start, start + size)
        poor, rich = [i for i in every if p[i] < 1], [i for i in every if p[i] >= 1]
        while poor and rich:
            i, j = poor.pop(), rich[-1]
            prob[i], alias[i] = p[i], j
            p[j] -= 1 - p[i]
            if p[j] < 1:
                poor.append(rich.pop())
    near = group["neighbour"].to_numpy()
    return pd.DataFrame({"node": node, "slot": group["slot"].to_numpy(), "neighbour": near, "prob": prob, "alias": near[alias]})


def _alias_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches in the order of node and slot; the last node's rows wait for the rest of it."""
    held: list[pd.DataFrame] = []
    for x in batches:
        if not len(x):
            continue
        node = x["node"].to_numpy()
        if held and held[0]["node"].iloc[0] == node[-1]:
            held.append(x)
            continue
        cut = int(np.searchsorted(node, node[-1]))
        if held or cut:
            yield _alias(pd.concat([*held, x.iloc[:cut]]))
        held = [x.iloc[cut:]]
    if held:
        yield _alias(pd.concat(held))


def alias_slots(probabilities: DataFrame) -> DataFrame:
    """(node, slot, neighbour, prob, alias, prob16): draw a slot uniformly, keep its neighbour with `prob`, else take `alias`."""
    dealt = probabilities.select("node", "slot", "neighbour", "probability").repartition("node").sortWithinPartitions("node", "slot")
    out = dealt.mapInPandas(_alias_batches, "node long, slot long, neighbour long, prob double, alias long")
    return out.withColumn("prob16", quantise16(F.col("prob")))


def draw_neighbours(draws: DataFrame, table: DataFrame, seed: int = 0) -> DataFrame:
    """One neighbour for each row of `draws` (draw, node), by an equi-join on the drawn slot; null for a node without any."""
    size = table.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    spin = draws.join(size, "node", "left").withColumn("slot", F.floor(uniform(F.lit(seed), "draw", "node") * F.col("_n")))
    hit = spin.join(table.select("node", "slot", "neighbour", "prob", "alias"), ["node", "slot"], "left")
    keep = uniform(F.lit(seed + 1), "draw", "node") < F.col("prob")
    return hit.select(*draws.columns, F.when(keep, F.col("neighbour")).otherwise(F.col("alias")).alias("neighbour"))


def draw_uniform(draws: DataFrame, table: DataFrame, seed: int = 0) -> DataFrame:
    """As draw_neighbours, each edge of a node with the same chance; `table` needs node, slot, neighbour."""
    size = table.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    spin = draws.join(size, "node", "left").withColumn("slot", F.floor(uniform(F.lit(seed), "draw", "node") * F.col("_n")))
    return spin.join(table.select("node", "slot", "neighbour"), ["node", "slot"], "left").select(*draws.columns, "neighbour")


def sampled_two_hop(nodes: DataFrame, out_table: DataFrame, in_table: DataFrame, seed: int = 0, via: bool = False) -> DataFrame:
    """(a, b) pairs for nodes (node, deficit): so many draws of a followee, then of one of its followers; pairs with itself are dropped. With `via` also the followee."""
    draws = nodes.select(F.col("node").alias("a"), F.explode(F.sequence(F.lit(1), F.col("deficit"))).alias("k")).withColumn("draw", F.xxhash64("a", "k"))
    middle = draw_neighbours(draws.withColumnRenamed("a", "node"), out_table, seed).where("neighbour IS NOT NULL")
    back = draw_neighbours(middle.select(F.col("node").alias("a"), "draw", F.col("neighbour").alias("node")), in_table, seed + 2)
    found = back.where((F.col("neighbour").isNotNull()) & (F.col("neighbour") != F.col("a")))
    return found.select("a", *([F.col("node").alias("via")] if via else []), F.col("neighbour").alias("b"))


def no_two_hops(drawn: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (a, via, b) with no node over which a and b meet: those that meet over their own `via` are done, only the rest is held against all others."""
    one = edges.select(F.col("source").alias("a"), F.col("target").alias("via")).distinct().withColumn("hit", F.lit(1))
    met = drawn.join(one, ["a", "via"], "left").join(one.toDF("b", "via", "hit2"), ["b", "via"], "left")
    rest = materialise(met.where("hit IS NULL OR hit2 IS NULL").select("a", "via", "b"), "rest")
    if rest.isEmpty():
        return rest
    pairs = rest.select("a", "b").distinct().join(one.select("a", F.col("via").alias("m")), "a")
    good = pairs.join(one.select(F.col("a").alias("b"), F.col("via").alias("m")), ["b", "m"], "left_semi").select("a", "b").distinct()
    return rest.join(good, ["a", "b"], "left_anti")


# ---- order


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that undirected edges reach; min labels with pointer jumping, a written table a round."""
    both = edges.select("source", "target").union(edges.select("target", "source")).distinct().toDF("node", "to")
    both = materialise(both, "links")
    labels = materialise(both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        nxt = materialise(hooked.join(jump, "via").select("node", "old", F.least("via", "far").alias("label")), "labels")
        discard(labels)
        if not nxt.where("label < old").limit(1).count():
            discard(both)
            return nxt.select("node", F.col("label").alias("component"))
        labels = nxt.select("node", "label")


def reverse_cuthill_mckee(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, position) of nodes (idx) under a symmetric edge set: all components advance together, one breadth-first level a round.

    A component starts at its lowest degree (then index); a level is ordered by (position of the first parent, degree, index); components
    follow each other by their starts, isolated nodes among them; all of it is reversed in the end.
    """
    links = materialise(edges.select("source", "target").union(edges.select("target", "source")).distinct(), "links")
    every = nodes.select(F.col("idx").alias("node")).distinct()
    deg = every.join(structural_degrees(links), "node", "left").na.fill(0, ["degree"]).join(components(links), "node", "left")
    deg = materialise(deg.select("node", "degree", F.coalesce("component", "node").alias("component")), "deg")
    start = deg.groupBy("component").agg(F.min(F.struct("degree", "node")).alias("s"), F.count(F.lit(1)).alias("size"))
    frontier = materialise(start.select(F.col("s.node").alias("node"), "component", F.lit(0).cast("bigint").alias("place")), "level")
    levels, before = [frontier], frontier.limit(0)
    while True:
        # Edges run both ways, so what a level reaches lies in the level before, in itself or in the next: no other level is looked at again.
        reach = links.join(frontier, links["source"] == frontier["node"]).select(F.col("target").alias("node"), "place")
        known = before.select("node").unionByName(frontier.select("node"))
        reach = reach.join(known, "node", "left_anti").groupBy("node").agg(F.min("place").alias("parent")).join(deg, "node")
        placed = materialise(numbered(reach, ["component", "parent", "degree", "node"], "at"), "reach")
        base = frontier.groupBy("component").agg((F.max("place") + 1).alias("base"))
        first = placed.groupBy("component").agg(F.min("at").alias("first")).join(base, "component")
        nxt = materialise(placed.join(first, "component").select("node", "component", (F.col("base") + F.col("at") - F.col("first")).cast("bigint").alias("place")), "level")
        discard(placed)
        if nxt.isEmpty():
            break
        levels.append(nxt)
        before, frontier = frontier, nxt
    done = levels[0]
    for level in levels[1:]:
        done = done.unionByName(level)
    ranked = numbered(start.select("component", "size", F.col("s.degree").alias("d"), F.col("s.node").alias("n")), ["d", "n"], "before", "size")
    total = F.lit(deg.count())
    placed = done.join(ranked.select("component", "before"), "component")
    return placed.select("node", (total - 1 - F.col("before") - F.col("place")).cast("bigint").alias("position"))


def permute(edges: DataFrame, order: DataFrame) -> DataFrame:
    """Edges renumbered by (node, position)."""
    return translate(edges, order.select(F.col("node").alias("id"), F.col("position").alias("idx")), check=False)
