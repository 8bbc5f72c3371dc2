"""The registered queries of the graph, embedding and map operators, each with the same in DuckDB's SQL where SQL can say it.

Graphs come from the test tables: an edge leads from a line item's supplier (or part) to that of the order's next line, or from
an event's user to the next event's. Maps are the first two embedding components times 1000.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import scalars
from ..operators import cluster, embed, graph, spatial
from ..scratch import materialise, shared_dir
from ..sources import files, sinks
from ..streaming import degrees as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def succession(rows: DataFrame, key: str, group: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.select(F.col(key).cast("bigint").alias("source"), F.lead(key).over(w).cast("bigint").alias("target")).where("target IS NOT NULL")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return succession(table(spark, sf_dir, "lineitem"), "l_suppkey", ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return succession(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chain over all events: each day is a group, and a day's last event leads to the next day's first."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", "user_id").withColumn("day", F.to_date("ts"))
    inside = succession(events, "user_id", ["day"], ["ts", "event_id"])
    ends = events.groupBy("day").agg(F.max_by("user_id", F.struct("ts", "event_id")).alias("last"), F.min_by("user_id", F.struct("ts", "event_id")).alias("first"))
    days = Window.orderBy("day")  # a row a day
    across = ends.select(F.col("last").cast("bigint").alias("source"), F.lead("first").over(days).cast("bigint").alias("target")).where("target IS NOT NULL")
    return inside.unionByName(across)


def nodes_of(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.col(key).cast("bigint").alias("idx"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), "embedding", "label")


def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), *[(F.element_at("embedding", k).cast("double") * 1000).cast("float").alias(n) for k, n in ((1, "x"), (2, "y"))])


def _edges(key: str) -> str:
    return f"""e AS (SELECT s AS source, t AS target FROM (
  SELECT {key} AS s, lead({key}) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS t FROM lineitem) WHERE t IS NOT NULL)"""


SUPPLIERS, PARTS = _edges("l_suppkey"), _edges("l_partkey")
USERS = "e AS (SELECT s AS source, t AS target FROM (SELECT user_id AS s, lead(user_id) OVER (ORDER BY ts, event_id) AS t FROM events) WHERE t IS NOT NULL)"
DEGREES = """d AS (SELECT node, sum(o)::BIGINT AS out_deg, sum(i)::BIGINT AS in_deg FROM (
  SELECT source AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT target, 0, 1 FROM e) GROUP BY node)"""
MUTUAL = "m AS (SELECT source, target FROM e INTERSECT ALL SELECT target, source FROM e)"
MAP = "p AS (SELECT vec_id AS id, (embedding[1]::DOUBLE * 1000)::FLOAT AS x, (embedding[2]::DOUBLE * 1000)::FLOAT AS y FROM embeddings)"
AREA = """a AS (SELECT least(min(x), 0)::DOUBLE AS min_x, greatest(max(x), 0)::DOUBLE AS max_x, least(min(y), 0)::DOUBLE AS min_y, greatest(max(y), 0)::DOUBLE AS max_y FROM p),
s AS (SELECT *, pow(2, ceil(log2(2 * greatest(-min_x, max_x, -min_y, max_y)))) AS side FROM a)"""


# ---- ids and degrees


@query("SELECT DISTINCT s_suppkey AS id, (dense_rank() OVER (ORDER BY s_suppkey) - 1)::BIGINT AS idx FROM supplier")
def q_id_index(spark, sf_dir):
    return graph.dense_index(table(spark, sf_dir, "supplier"), "s_suppkey")


@query(f"WITH {SUPPLIERS}, n AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 3 <> 0) SELECT source, target, 'source' AS missing FROM e WHERE source NOT IN (SELECT id FROM n) UNION ALL SELECT source, target, 'target' FROM e WHERE target NOT IN (SELECT id FROM n)")
def q_dangling_edges(spark, sf_dir):
    return graph.dangling(suppliers(spark, sf_dir), table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("id")))


@query(f"WITH {SUPPLIERS}, n AS (SELECT s_suppkey AS id, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx FROM supplier) SELECT a.idx AS source, b.idx AS target, count(*) AS n FROM e JOIN n a ON e.source = a.id JOIN n b ON e.target = b.id GROUP BY ALL")
def q_translated_edges(spark, sf_dir):
    index = graph.dense_index(table(spark, sf_dir, "supplier"), "s_suppkey")
    return graph.translate(suppliers(spark, sf_dir), index).groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SUPPLIERS}, {DEGREES} SELECT s_suppkey AS node, coalesce(out_deg, 0) AS out_deg, coalesce(in_deg, 0) AS in_deg FROM supplier LEFT JOIN d ON s_suppkey = node")
def q_degrees(spark, sf_dir):
    return graph.degrees(suppliers(spark, sf_dir), nodes_of(spark, sf_dir, "supplier", "s_suppkey"))


@query(f"WITH {SUPPLIERS}, {DEGREES} SELECT node, (row_number() OVER (ORDER BY out_deg + in_deg, node) - 1)::BIGINT AS degree_rank FROM d")
def q_degree_rank(spark, sf_dir):
    d = graph.degrees(suppliers(spark, sf_dir)).withColumn("degree", F.col("out_deg") + F.col("in_deg"))
    return graph.numbered(d, ["degree", "node"], "degree_rank").select("node", "degree_rank")


WEIGHTS = """w AS (SELECT e.source, e.target, 64.0::DOUBLE * (least(ln(1 + a.out_deg), ln(1 + b.in_deg)) / greatest(ln(1 + a.out_deg), ln(1 + b.in_deg))) / (ln(1 + a.out_deg) + ln(1 + b.in_deg)) AS weight
FROM e JOIN d a ON e.source = a.node JOIN d b ON e.target = b.node)"""


@query(f"WITH {SUPPLIERS}, {DEGREES}, {WEIGHTS} SELECT source, target, round(weight, 6) AS weight FROM w")
def q_edge_weights(spark, sf_dir):
    return graph.weights(suppliers(spark, sf_dir)).select("source", "target", F.round("weight", 6).alias("weight"))


@query(f"WITH {USERS}, {DEGREES}, {WEIGHTS} SELECT source, target, round(weight, 6) AS weight FROM w")
def q_user_edge_weights(spark, sf_dir):
    return graph.weights(users(spark, sf_dir)).select("source", "target", F.round("weight", 6).alias("weight"))


@query(f"WITH {SUPPLIERS}, {DEGREES}, {WEIGHTS} SELECT source, target, weight FROM (SELECT DISTINCT source, target, round(weight, 6) AS weight FROM w) ORDER BY weight DESC, source, target LIMIT 100")
def q_edge_sort_topk(spark, sf_dir):
    w = graph.weights(suppliers(spark, sf_dir)).select("source", "target", F.round("weight", 6).alias("weight")).distinct()
    return w.orderBy(F.desc("weight"), "source", "target").limit(100)


# ---- adjacency


def _indptr(by: str) -> str:
    return f"""WITH {SUPPLIERS}, c AS (SELECT {by} AS node, count(*) AS n FROM e GROUP BY 1), f AS (SELECT s_suppkey AS node, coalesce(n, 0) AS n FROM supplier LEFT JOIN c ON s_suppkey = node)
SELECT node, (sum(n) OVER (ORDER BY node) - n)::BIGINT AS start, (sum(n) OVER (ORDER BY node))::BIGINT AS stop FROM f"""


@query(_indptr("source"))
def q_csr_indptr(spark, sf_dir):
    return graph.indptr(suppliers(spark, sf_dir), nodes_of(spark, sf_dir, "supplier", "s_suppkey"))


@query(_indptr("target"))
def q_csc_indptr(spark, sf_dir):
    return graph.indptr(suppliers(spark, sf_dir), nodes_of(spark, sf_dir, "supplier", "s_suppkey"), "target")


@query(f"WITH {PARTS} SELECT source AS node, count(*) AS n, string_agg(target::VARCHAR, ',' ORDER BY target) AS neighbours FROM e GROUP BY source")
def q_adjacency(spark, sf_dir):
    return graph.adjacency(parts(spark, sf_dir)).select("node", F.size("neighbours").cast("bigint").alias("n"), F.array_join(F.col("neighbours").cast("array<string>"), ",").alias("neighbours"))


@query(f"WITH {PARTS} SELECT target AS node, count(*) AS n, string_agg(source::VARCHAR, ',' ORDER BY source) AS neighbours FROM e GROUP BY target")
def q_adjacency_in(spark, sf_dir):
    return graph.adjacency(parts(spark, sf_dir), "target").select("node", F.size("neighbours").cast("bigint").alias("n"), F.array_join(F.col("neighbours").cast("array<string>"), ",").alias("neighbours"))


@query(f"WITH {SUPPLIERS} SELECT source, target, count(*) AS value FROM e GROUP BY source, target")
def q_matrix(spark, sf_dir):
    return graph.matrix(suppliers(spark, sf_dir))


# ---- mutual edges


@query(f"WITH {SUPPLIERS}, {MUTUAL} SELECT * FROM m")
def q_mutual_edges(spark, sf_dir):
    return graph.mutual_edges(suppliers(spark, sf_dir))


@query(f"WITH {SUPPLIERS}, {MUTUAL} SELECT source AS node, count(*) AS mutual_deg FROM m GROUP BY source")
def q_mutual_degrees(spark, sf_dir):
    return graph.mutual_degrees(graph.mutual_edges(suppliers(spark, sf_dir)))


@query(f"WITH {SUPPLIERS}, c AS (SELECT source, target, count(*) AS n FROM e GROUP BY ALL) SELECT a.source, a.target, least(a.n, b.n) AS value FROM c a JOIN c b ON a.source = b.target AND a.target = b.source")
def q_mutual_matrix(spark, sf_dir):
    return graph.mutual_matrix(suppliers(spark, sf_dir))


@query(f"WITH {PARTS}, m AS (SELECT source, target FROM e INTERSECT SELECT target, source FROM e) SELECT source AS node, count(*) + max((source = target)::INT) AS degree FROM m GROUP BY source")
def q_structural_degrees(spark, sf_dir):
    return graph.structural_degrees(graph.mutual_edges(parts(spark, sf_dir), distinct=True))


@query(f"WITH {PARTS}, {MUTUAL}, c AS (SELECT source AS node, count(*) AS n FROM m GROUP BY source) SELECT p_partkey AS node, coalesce(n, 0) AS mutual_deg, 16 - coalesce(n, 0) AS deficit FROM part LEFT JOIN c ON p_partkey = node WHERE coalesce(n, 0) < 16")
def q_low_mutual_nodes(spark, sf_dir):
    return graph.low_mutual_nodes(nodes_of(spark, sf_dir, "part", "p_partkey"), graph.mutual_edges(parts(spark, sf_dir)))


# ---- two hops and sampling


def _two_hop(via: str, end: str) -> str:
    return f"WITH {PARTS}, u AS (SELECT DISTINCT source, target FROM e) SELECT x.{end} AS a, y.{end} AS b, count(*) AS shared FROM u x JOIN u y ON x.{via} = y.{via} AND x.{end} < y.{end} GROUP BY ALL"


@query(_two_hop("target", "source"))
def q_cofollow(spark, sf_dir):
    return graph.two_hop(parts(spark, sf_dir), "target")


@query(_two_hop("source", "target"))
def q_cofollowed(spark, sf_dir):
    return graph.two_hop(parts(spark, sf_dir), "source")


def _probabilities(by: str, other: str, degree: str) -> str:
    return f"""WITH {SUPPLIERS}, {DEGREES}, w AS (SELECT {by} AS node, {other} AS neighbour, 1 / ln(1 + {degree}) AS w FROM e JOIN d ON d.node = {other})
SELECT node, (row_number() OVER (PARTITION BY node ORDER BY neighbour) - 1)::BIGINT AS slot, neighbour, round(w / sum(w) OVER (PARTITION BY node), 6) AS probability FROM w"""


@query(_probabilities("source", "target", "in_deg"))
def q_neighbor_probs_out(spark, sf_dir):
    e = suppliers(spark, sf_dir)
    return graph.neighbour_probabilities(e, graph.degrees(e)).withColumn("probability", F.round("probability", 6))


@query(_probabilities("target", "source", "out_deg"))
def q_neighbor_probs_in(spark, sf_dir):
    e = suppliers(spark, sf_dir)
    return graph.neighbour_probabilities(e, graph.degrees(e), "target").withColumn("probability", F.round("probability", 6))


def _induced(by: str, other: str, degree: str) -> str:
    return f"""WITH {SUPPLIERS}, {DEGREES}, w AS (SELECT {by} AS node, {other} AS neighbour, 1 / ln(1 + {degree}) AS w FROM e JOIN d ON d.node = {other}),
t AS (SELECT node, sum(w) AS total, count(*) AS slots FROM w GROUP BY node) SELECT node, neighbour, slots, round(sum(w / total), 6) AS probability FROM w JOIN t USING (node) GROUP BY ALL"""


def _chances(table: DataFrame) -> DataFrame:
    """How often alias tables draw each neighbour: its own slots' shares, and what other slots hand on."""
    size = table.groupBy("node").agg(F.count(F.lit(1)).alias("slots"))
    ways = F.array(F.struct(F.col("neighbour").alias("to"), F.col("prob").alias("p")), F.struct(F.col("alias").alias("to"), (1 - F.col("prob")).alias("p")))
    each = table.select("node", F.explode(ways).alias("w")).join(size, "node")
    return each.groupBy("node", F.col("w.to").alias("neighbour"), "slots").agg(F.round(F.sum(F.col("w.p") / F.col("slots")), 6).alias("probability"))


@query(_induced("source", "target", "in_deg"))
def q_alias_slots(spark, sf_dir):
    e = suppliers(spark, sf_dir)
    return _chances(graph.alias_slots(graph.neighbour_probabilities(e, graph.degrees(e)).where("probability IS NOT NULL")))


@query(_induced("target", "source", "out_deg"))
def q_alias_slots_in(spark, sf_dir):
    e = suppliers(spark, sf_dir)
    return _chances(graph.alias_slots(graph.neighbour_probabilities(e, graph.degrees(e), "target").where("probability IS NOT NULL")))


@query(f"""WITH {PARTS}, {MUTUAL}, c AS (SELECT source AS node, count(*) AS n FROM m GROUP BY source),
l AS (SELECT p_partkey AS a, 16 - coalesce(n, 0) AS deficit FROM part LEFT JOIN c ON p_partkey = node WHERE coalesce(n, 0) < 16)
SELECT count(*) AS nodes, sum(deficit)::BIGINT AS draws, 0::BIGINT AS too_many, 0::BIGINT AS no_two_hop FROM l WHERE a IN (SELECT source FROM e)""")
def q_sampled_two_hop(spark, sf_dir):
    """The pairs drawn, held against the edges: how many are no two-hop pairs, and how many nodes have more pairs than they lack."""
    e = materialise(parts(spark, sf_dir), "edges")
    deg = materialise(graph.degrees(e), "degrees")
    tables = [materialise(graph.alias_slots(graph.neighbour_probabilities(e, deg, by).where("probability IS NOT NULL")), "slots") for by in ("source", "target")]
    low = materialise(graph.low_mutual_nodes(nodes_of(spark, sf_dir, "part", "p_partkey"), graph.mutual_edges(e)), "low")
    drawn = materialise(graph.sampled_two_hop(low, *tables, via=True), "drawn")
    wrong = graph.no_two_hops(drawn, e).agg(F.count(F.lit(1)).alias("no_two_hop"))
    per = low.join(drawn.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n")), "node", "left")
    some = per.join(e.select(F.col("source").alias("node")).distinct(), "node", "left_semi")
    sums = some.agg(F.count(F.lit(1)).alias("nodes"), F.sum("deficit").alias("draws"), F.sum((F.coalesce("n", F.lit(0)) > F.col("deficit")).cast("bigint")).alias("too_many"))
    return sums.join(wrong, F.lit(True))  # one row each


@query(f"WITH {SUPPLIERS} SELECT source AS node, 100::BIGINT AS draws, 100::BIGINT AS along_edges FROM e GROUP BY source")
def q_uniform_draws(spark, sf_dir):
    """100 draws for each node that has edges: all of them go along edges."""
    e = suppliers(spark, sf_dir)
    draws = e.select(F.col("source").alias("node")).distinct().select("node", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(100).cast("bigint"))).alias("draw"))
    got = graph.draw_uniform(draws, graph.slots(e))
    known = e.select(F.col("source").alias("node"), F.col("target").alias("neighbour")).distinct().withColumn("hit", F.lit(1))
    return got.join(known, ["node", "neighbour"], "left").groupBy("node").agg(F.count(F.lit(1)).alias("draws"), F.count("hit").alias("along_edges"))


# ---- order


def _rcm(mutual: str) -> str:
    """A queue, one node a step: its new neighbours join by degree and number; an empty queue takes the open node of least degree."""
    return f"""WITH RECURSIVE {SUPPLIERS}, m AS ({mutual}), n AS (SELECT s_suppkey::BIGINT AS node FROM supplier),
c AS (SELECT source, count(*) + max((source = target)::INT) AS degree FROM m GROUP BY source), d AS (SELECT node, coalesce(degree, 0) AS degree FROM n LEFT JOIN c ON node = source),
j AS (SELECT d.node, coalesce(list(t.node ORDER BY t.degree, t.node) FILTER (t.node IS NOT NULL), []::BIGINT[]) AS near FROM d LEFT JOIN m ON m.source = d.node LEFT JOIN d t ON t.node = m.target GROUP BY d.node),
g AS (SELECT (SELECT map_from_entries(list((node, near))) FROM j) AS adj, (SELECT list(node ORDER BY degree, node) FROM d) AS starts, (SELECT count(*) FROM d) AS n),
r(pos, ord) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT CASE WHEN pos < len(ord) THEN pos + 1 ELSE pos END,
  CASE WHEN pos < len(ord) THEN list_concat(ord, list_filter(adj[ord[pos + 1]], lambda x: NOT list_contains(ord, x))) ELSE list_append(ord, list_filter(starts, lambda x: NOT list_contains(ord, x))[1]) END
  FROM r, g WHERE pos < n)
SELECT unnest(ord) AS node, (n - generate_subscripts(ord, 1))::BIGINT AS position FROM r, g WHERE pos = n"""


@query(_rcm("SELECT source, target FROM e INTERSECT SELECT target, source FROM e"))
def q_rcm_order(spark, sf_dir):
    return graph.reverse_cuthill_mckee(graph.mutual_edges(suppliers(spark, sf_dir), distinct=True), nodes_of(spark, sf_dir, "supplier", "s_suppkey"))


@query(_rcm("SELECT source, target FROM e WHERE (source + target) % 7 = 0 UNION SELECT target, source FROM e WHERE (source + target) % 7 = 0"))
def q_rcm_directed(spark, sf_dir):
    """Of directed edges, made symmetric; only those whose ends sum to a multiple of 7, so that there are several levels and components."""
    e = suppliers(spark, sf_dir).where("(source + target) % 7 = 0")
    return graph.reverse_cuthill_mckee(e, nodes_of(spark, sf_dir, "supplier", "s_suppkey"))


@query(f"""WITH {PARTS} SELECT count(*) AS n FROM (SELECT DISTINCT source, target FROM e)""")
def q_distinct_edges(spark, sf_dir):
    return parts(spark, sf_dir).distinct().agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE {PARTS}, m AS (SELECT source, target FROM e INTERSECT SELECT target, source FROM e), r(node, other) AS (
  SELECT source, source FROM m UNION SELECT r.node, m.target FROM r JOIN m ON r.other = m.source)
SELECT node, min(other) AS component FROM r GROUP BY node""")
def q_components(spark, sf_dir):
    return graph.components(graph.mutual_edges(parts(spark, sf_dir), distinct=True))


@query(f"WITH {SUPPLIERS}, n AS (SELECT s_suppkey AS id, (SELECT max(s_suppkey) FROM supplier) - s_suppkey AS idx FROM supplier) SELECT a.idx AS source, b.idx AS target FROM e JOIN n a ON e.source = a.id JOIN n b ON e.target = b.id")
def q_permuted_edges(spark, sf_dir):
    keys = table(spark, sf_dir, "supplier")
    top = keys.agg(F.max("s_suppkey")).first()[0]
    return graph.permute(suppliers(spark, sf_dir), keys.select(F.col("s_suppkey").alias("node"), (F.lit(top) - F.col("s_suppkey")).alias("position")))


# ---- neighbours, fuzzy sets, embeddings


KNN = """k AS MATERIALIZED (SELECT * FROM (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS rank FROM embeddings a, embeddings b) WHERE rank <= 10)"""


@query(f"WITH {KNN} SELECT i, rank, j, round(dist, 6) AS dist FROM k")
def q_knn_exact(spark, sf_dir):
    return embed.knn_exact(vectors(spark, sf_dir), 10).withColumn("dist", F.round("dist", 6))


@query(f"WITH {KNN} SELECT a.i, a.j FROM k a JOIN k b ON a.i = b.j AND a.j = b.i WHERE a.i < a.j")
def q_knn_mutual(spark, sf_dir):
    k = embed.knn_exact(vectors(spark, sf_dir), 10).select(F.col("i").alias("source"), F.col("j").alias("target"))
    return graph.mutual_edges(k).where("source < target").toDF("i", "j")


@query(f"WITH {KNN} SELECT x.label, count(*) AS n, sum((x.label = y.label)::INT)::BIGINT AS same FROM k JOIN embeddings x ON x.vec_id = i JOIN embeddings y ON y.vec_id = j WHERE i <> j GROUP BY x.label")
def q_knn_label_agreement(spark, sf_dir):
    v = vectors(spark, sf_dir)
    k = embed.knn_exact(v, 10).where("i <> j")
    x, y = v.select(F.col("idx").alias("i"), "label"), v.select(F.col("idx").alias("j"), F.col("label").alias("other"))
    return k.join(x, "i").join(y, "j").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == F.col("other")).cast("int")).alias("same"))


@query("SELECT count(*) AS queries, count(*) * 10 AS rows, TRUE AS recall_is_9_of_10 FROM embeddings")
def q_knn_approximate(spark, sf_dir):
    """All approximate neighbours, and their share of the exact ones."""
    v = vectors(spark, sf_dir).drop("label")
    got = materialise(embed.knn_approximate(v, 10), "knn")
    met = got.join(embed.knn_exact(v, 10).select("i", "j").withColumn("hit", F.lit(1)), ["i", "j"], "left")
    return met.agg(F.countDistinct("i").alias("queries"), F.count(F.lit(1)).alias("rows"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_is_9_of_10"))


FUZZY = f"""{KNN}, g AS (SELECT i, list(dist::FLOAT::DOUBLE ORDER BY rank) AS d, list(j ORDER BY rank) AS js FROM k GROUP BY i),
p AS (SELECT *, coalesce(list_min(list_filter(d, lambda x: x > 0)), 0) AS rho FROM g),
b(step, i, lo, hi, sigma, gap) AS (SELECT 0, i, 0::DOUBLE, 'infinity'::DOUBLE, 1::DOUBLE, list_transform(d[2:], lambda x: greatest(0::DOUBLE, x - rho)) FROM p UNION ALL
  SELECT step + 1, i, CASE WHEN over THEN lo ELSE sigma END, CASE WHEN over THEN sigma ELSE hi END,
    CASE WHEN over THEN (lo + sigma) / 2 WHEN isinf(hi) THEN sigma * 2 ELSE (sigma + hi) / 2 END, gap
  FROM (SELECT *, list_sum(list_transform(gap, lambda x: exp(-x / sigma))) > log2(10) AS over FROM b WHERE step < 64)),
f AS (SELECT p.i, unnest(js) AS j, unnest(list_transform(d, lambda x: exp(-greatest(0::DOUBLE, x - rho) / greatest(sigma, 1e-3 * list_avg(d))))) AS w FROM p JOIN b ON p.i = b.i AND step = 64),
w AS (SELECT i, j, w FROM f WHERE i <> j)"""


@query(f"WITH RECURSIVE {FUZZY} SELECT i AS source, j AS target, round(w, 5) AS weight FROM w")
def q_fuzzy_membership(spark, sf_dir):
    return embed.memberships(embed.as_arrays(embed.knn_exact(vectors(spark, sf_dir), 10))).withColumn("weight", F.round("weight", 5))


@query(f"""WITH RECURSIVE {FUZZY}, u AS (SELECT i, j, w, 0::DOUBLE AS v FROM w UNION ALL SELECT j, i, 0::DOUBLE, w FROM w)
SELECT i AS source, j AS target, round(sum(w) + sum(v) - sum(w) * sum(v), 5) AS weight FROM u GROUP BY i, j""")
def q_fuzzy_union(spark, sf_dir):
    return embed.fuzzy_union(embed.memberships(embed.as_arrays(embed.knn_exact(vectors(spark, sf_dir), 10)))).withColumn("weight", F.round("weight", 5))


@query("SELECT count(*) AS points, count(*) AS finite, TRUE AS neighbours_are_nearer FROM embeddings")
def q_layout(spark, sf_dir):
    """The whole layout, with the settings of the pipeline: all points have a place, and linked ones lie nearer to each other than others do."""
    config = PipelineConfig()
    v = vectors(spark, sf_dir).drop("label")
    index = materialise(graph.dense_index(v, "idx"), "index")
    at = materialise(v.join(index.select(F.col("id").alias("idx"), F.col("idx").alias("at")), "idx").select(F.col("at").alias("idx"), "embedding"), "points")
    fuzzy = materialise(embed.fuzzy_union(embed.memberships(embed.as_arrays(embed.knn_exact(at, config.n_neighbors)))), "fuzzy")
    placed = materialise(embed.layout(fuzzy, embed.projected(at), *embed.curve(config.spread, config.min_dist), config.layout_epochs, seed=config.seed), "placed")
    n = placed.count()
    ends = [placed.select(F.col("idx").alias(c), F.col("x").alias(f"{c}_x"), F.col("y").alias(f"{c}_y")) for c in ("source", "target")]
    apart = F.avg(F.hypot(F.col("source_x") - F.col("target_x"), F.col("source_y") - F.col("target_y")))
    near = fuzzy.join(ends[0], "source").join(ends[1], "target").agg(apart.alias("near"))
    far = embed.random_pairs(spark, 20 * n, n, 1).join(ends[0], "source").join(ends[1], "target").agg(apart.alias("far"))
    finite = F.sum((F.isnotnull("x") & ~F.isnan("x") & ~F.isnan("y") & (F.abs(F.col("x")) < 1e9)).cast("bigint"))
    one = placed.agg(F.count(F.lit(1)).alias("points"), finite.alias("finite"))
    return one.join(near, F.lit(True)).join(far, F.lit(True)).select("points", "finite", (F.col("near") < 0.8 * F.col("far")).alias("neighbours_are_nearer"))  # one row each


@query("SELECT count(*) AS nodes, 16 AS dim, TRUE AS inside_the_box, TRUE AS loss_fell FROM part")
def q_embed_train(spark, sf_dir):
    """Training with two-hop pulls and early stop, shorter than the pipeline's (16 dimensions and 30 epochs, of 64 and up to 500): the loss falls."""
    e, nodes = parts(spark, sf_dir), nodes_of(spark, sf_dir, "part", "p_partkey")
    index = materialise(graph.dense_index(nodes, "idx"), "index")
    e = materialise(graph.translate(e, index, check=False), "edges")
    deg = materialise(graph.degrees(e, index), "degrees")
    mutual = materialise(graph.mutual_matrix(e).select("source", "target", F.explode(F.sequence(F.lit(1).cast("bigint"), "value"))).select("source", "target"), "mutual")
    low = materialise(graph.low_mutual_nodes(index, mutual).select("node", "deficit"), "low")
    v, losses = embed.train(mutual, index.count(), PipelineConfig(dim=16, max_epoch=30), embed.EdgeTwoHop(low, e, deg))
    box = F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x)))) <= 1
    return v.agg(F.count(F.lit(1)).alias("nodes"), F.max(F.size("embedding")).alias("dim"), box.alias("inside_the_box"), F.lit(losses[-1] < losses[0]).alias("loss_fell"))


def _step(both: bool, target: float) -> str:
    back = "UNION ALL SELECT target, loss, a FROM l" if both else ""
    return f"""WITH n AS (SELECT count(*) AS n FROM embeddings), q AS (SELECT vec_id AS source, (vec_id * 7 + 3) % n AS target FROM embeddings, n),
l AS (SELECT source, target, x.embedding::DOUBLE[] AS a, y.embedding::DOUBLE[] AS b, greatest(least(list_dot_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) - {target}, 30), -30) AS loss
  FROM q JOIN embeddings x ON x.vec_id = source JOIN embeddings y ON y.vec_id = target WHERE source <> target),
g AS (SELECT source AS node, loss, b AS v FROM l {back}), c AS (SELECT node, loss, unnest(v) * loss AS x, generate_subscripts(v, 1) AS k FROM g),
m AS (SELECT node, k, avg(x) AS x FROM c GROUP BY node, k), b AS (SELECT node, avg(loss) AS gb, sum(abs(loss)) AS loss FROM g GROUP BY node),
w AS (SELECT vec_id AS idx, unnest(embedding) AS w, generate_subscripts(embedding, 1) AS k FROM embeddings),
r AS (SELECT idx, w.k, CASE WHEN x IS NULL THEN w ELSE greatest(least(w - 0.05 * x, 1), -1)::FLOAT END::DOUBLE AS w FROM w LEFT JOIN m ON node = idx AND m.k = w.k)
SELECT idx, round(max(w) FILTER (k = 1), 6) + 0.0::DOUBLE AS first, round(sum(w), 5) + 0.0::DOUBLE AS total, round(sum(w * w), 5) AS square, round(max(coalesce(-0.05 * gb, 0)), 5) + 0.0::DOUBLE AS bias, round(max(coalesce(loss, 0)), 5) AS loss
FROM r LEFT JOIN b ON node = idx GROUP BY idx"""


def _stepped(spark: SparkSession, sf_dir: str, both: bool, target: float) -> DataFrame:
    v = vectors(spark, sf_dir).select("idx", "embedding", F.lit(0.0).cast("float").alias("bias"))
    n = v.count()
    pairs = v.select(F.col("idx").alias("source"), ((F.col("idx") * 7 + 3) % n).alias("target")).where("source <> target")
    out = embed.moved(v, pairs, PipelineConfig(), target, both)
    w = F.transform("embedding", lambda x: x.cast("double"))
    rounded = lambda x, n=5: F.round(x, n) + 0.0  # no negative zero
    add = lambda f: rounded(F.aggregate(F.transform(w, f), F.lit(0.0), lambda s, x: s + x))
    return out.select("idx", rounded(F.element_at(w, 1), 6).alias("first"), add(lambda x: x).alias("total"), add(lambda x: x * x).alias("square"), rounded(F.col("bias").cast("double")).alias("bias"), F.round("loss", 5).alias("loss"))


@query(_step(True, 1.0))
def q_contraction_step(spark, sf_dir):
    return _stepped(spark, sf_dir, True, 1.0)


@query(_step(True, 0.0))
def q_relaxation_step(spark, sf_dir):
    return _stepped(spark, sf_dir, True, 0.0)


@query(_step(False, 1.0))
def q_two_hop_step(spark, sf_dir):
    return _stepped(spark, sf_dir, False, 1.0)


# ---- clusters and colours


@query("SELECT count(*) AS points, 10::BIGINT AS clusters, count(*) AS at_the_nearest_center FROM embeddings")
def q_kmeans(spark, sf_dir):
    """Every point has a label, and its label's center is the nearest one."""
    v = vectors(spark, sf_dir).drop("label")
    labels, centers = cluster.kmeans(v, 10)
    c = cluster.center_table(spark, centers).withColumnRenamed("label", "center_label")
    d = v.join(labels, "idx").join(F.broadcast(c), F.lit(True)).withColumn("d", scalars.distance(F.col("embedding"), F.col("center")))  # ten rows
    per = d.groupBy("idx", "label").agg(F.min("d").alias("least"), F.max(F.when(F.col("label") == F.col("center_label"), F.col("d"))).alias("own"))
    return per.agg(F.count(F.lit(1)).alias("points"), F.countDistinct("label").alias("clusters"), F.sum((F.col("own") <= F.col("least") + 1e-6).cast("bigint")).alias("at_the_nearest_center"))


def label_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors(spark, sf_dir)
    at = v.select("label", F.posexplode("embedding").alias("k", "x")).groupBy("label", "k").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return at.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("center"))


CENTERS = """c AS (SELECT label, list(x ORDER BY k) AS center FROM (
  SELECT label, k, avg(x::DOUBLE) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS k FROM embeddings) GROUP BY label, k) GROUP BY label)"""


@query(f"""WITH {CENTERS}, n AS (SELECT vec_id AS idx, c.label, list_distance(embedding::DOUBLE[], center) AS d, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_distance(embedding::DOUBLE[], center), 9), c.label) AS rank FROM embeddings, c)
SELECT idx, label, rank, round((1 / (d + 1e-8)) / sum(1 / (d + 1e-8)) OVER (PARTITION BY idx), 6) AS weight FROM n WHERE rank <= 3""")
def q_center_top3_weights(spark, sf_dir):
    """Three nearest centers of each point; the centers, one a label, are few and go out as a checked broadcast."""
    centers = label_centers(spark, sf_dir)
    if centers.count() > 10_000:
        raise ValueError("too many centers")
    d = vectors(spark, sf_dir).select("idx", "embedding").join(F.broadcast(centers), F.lit(True), "inner").select("idx", "label", scalars.distance(F.col("embedding"), F.col("center")).alias("d"))
    near = d.withColumn("rank", F.row_number().over(Window.partitionBy("idx").orderBy(F.round("d", 9), "label"))).where("rank <= 3")
    w = 1 / (F.col("d") + 1e-8)
    return near.select("idx", "label", F.col("rank").cast("bigint").alias("rank"), F.round(w / F.sum(w).over(Window.partitionBy("idx")), 6).alias("weight"))


@query(f"WITH {SUPPLIERS}, {DEGREES}, t AS (SELECT max(ln(1 + in_deg)) AS top FROM d) SELECT node, round(ln(1 + in_deg) / top, 6) AS lightness FROM d, t")
def q_point_lightness(spark, sf_dir):
    d = graph.degrees(suppliers(spark, sf_dir))
    top = d.agg(F.max(F.log1p("in_deg"))).first()[0]
    return d.select("node", F.round(F.log1p("in_deg") / F.lit(top), 6).alias("lightness"))


@query("SELECT vec_id AS idx, ((vec_id * 3 % 256) << 16) | ((vec_id * 7 % 256) << 8) | (vec_id % 256) AS color FROM embeddings")
def q_color_pack(spark, sf_dir):
    i = F.col("idx")
    return vectors(spark, sf_dir).select("idx", scalars.pack_colour(i % 256, i * 7 % 256, i * 3 % 256).cast("bigint").alias("color"))


@query("SELECT count(*) AS points, count(*) AS without_alpha, TRUE AS brighter_with_degree FROM embeddings")
def q_colors(spark, sf_dir):
    """The colour of every point; the mean of its channels rises with the degree."""
    v = vectors(spark, sf_dir)
    _, centers = cluster.kmeans(v, 10)
    degree = v.select("idx", (F.col("idx") % 97).alias("degree"))
    c = cluster.colours(v, degree, centers).join(degree, "idx")
    r, g, b = scalars.unpack_colour(F.col("color"))
    bright = F.corr((r + g + b).cast("double"), F.log1p("degree")) > 0.5
    return c.agg(F.count(F.lit(1)).alias("points"), F.sum(((F.col("color") >= 0) & (F.col("color") < 1 << 24)).cast("bigint")).alias("without_alpha"), bright.alias("brighter_with_degree"))


# ---- map


@query(f"WITH {MAP}, {AREA} SELECT min_x, max_x, min_y, max_y, side FROM s")
def q_bbox_area(spark, sf_dir):
    return spatial.bounds(map_points(spark, sf_dir))


CAPACITY = 50
PATHS = """g AS (SELECT p.id, p.x, p.y, l.level, least(greatest(floor((p.x::DOUBLE + side / 2) / (side / pow(2, l.level))), 0), pow(2, l.level) - 1)::BIGINT AS c,
  least(greatest(floor((p.y::DOUBLE + side / 2) / (side / pow(2, l.level))), 0), pow(2, l.level) - 1)::BIGINT AS r FROM p, s, range(0, 13) l(level)),
h AS (SELECT id, x, y, level, c, r, CASE WHEN level = 0 THEN '' ELSE array_to_string(list_transform(range(level - 1, -1, -1), lambda b:
  ['2', '3', '1', '0'][1 + ((c >> b) & 1) + 2 * ((r >> b) & 1)]), '') END AS path FROM g),
n AS (SELECT path, level, count(*) AS total, min(c) AS c, min(r) AS r FROM h GROUP BY path, level),
t AS (SELECT n.* FROM n LEFT JOIN n u ON n.level > 0 AND u.path = n.path[1:n.level - 1] AND u.level = n.level - 1 WHERE n.level = 0 OR u.total > 50)"""


@query(f"""WITH {MAP}, {AREA}, {PATHS} SELECT path, level, total, least(total, {CAPACITY}) AS count, total <= {CAPACITY} AS leaf,
trunc((c + 0.5) * (side / pow(2, level)) - side / 2)::BIGINT AS x, trunc((r + 0.5) * (side / pow(2, level)) - side / 2)::BIGINT AS y, trunc(side / pow(2, level))::BIGINT AS s FROM t, s""")
def q_tiles(spark, sf_dir):
    p = map_points(spark, sf_dir)
    return spatial.tiles(p, CAPACITY)


def _tiled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, spatial.Area]:
    p = map_points(spark, sf_dir)
    area = spatial.area_of(p)
    t = materialise(spatial.tiles(p, CAPACITY, area), "tiles")
    return spatial.tile_points(p, t, CAPACITY, area, F.md5(F.col("id").cast("string").cast("binary"))), t, area


@query(f"""WITH {MAP}, {AREA}, {PATHS}, f AS (SELECT h.path, h.id, row_number() OVER (PARTITION BY h.path ORDER BY md5(h.id::VARCHAR), h.id) AS k FROM h JOIN t ON h.path = t.path AND h.level = t.level)
SELECT path, id FROM f WHERE k <= {CAPACITY}""")
def q_tile_points(spark, sf_dir):
    return _tiled(spark, sf_dir)[0].select("path", "id")


TILE_POINTS = f"""{MAP}, {AREA}, {PATHS}, f AS (SELECT h.path, h.level, h.id, h.x, h.y, row_number() OVER (PARTITION BY h.path ORDER BY md5(h.id::VARCHAR), h.id) AS k, t.total FROM h JOIN t ON h.path = t.path AND h.level = t.level),
o AS (SELECT * FROM f WHERE k <= {CAPACITY})"""


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, spatial.Area]:
    points, t, area = _tiled(spark, sf_dir)
    return spatial.packed_tiles(points.withColumn("color", (F.col("id") % 1000).cast("int")), t, area), area


@query(f"WITH {TILE_POINTS} SELECT 'tile-' || level || '-' || CASE WHEN path = '' THEN 'root' ELSE path END || '-nodes' AS name, x::DOUBLE AS x, y::DOUBLE AS y, id % 1000 AS color FROM o")
def q_tile_bytes(spark, sf_dir):
    """Every tile's node bytes, decoded: little-endian floats and colour."""

    def decode(batches):
        for x in batches:
            for name, data in zip(x["name"], x["nodes"], strict=True):
                rec = np.frombuffer(data, np.dtype([("x", "<f4"), ("y", "<f4"), ("c", "<u4")]))
                yield pd.DataFrame({"name": name, "x": rec["x"].astype(float), "y": rec["y"].astype(float), "color": rec["c"].astype(np.int64)})

    return _packed(spark, sf_dir)[0].select(spatial.tile_name("nodes").alias("name"), "nodes").mapInPandas(decode, "name string, x double, y double, color long")


@query(f"WITH {TILE_POINTS} SELECT path, id, x::DOUBLE AS x, y::DOUBLE AS y FROM o WHERE total <= {CAPACITY}")
def q_tile_trees(spark, sf_dir):
    """The bodies in every leaf tile's packed tree, decoded."""

    def decode(batches):
        for x in batches:
            for path, data in zip(x["path"], x["atlas"], strict=True):
                found = [n[1:] for n in spatial.unpack(bytes(data)) if n[0] == "leaf"]
                yield pd.DataFrame([(path, *n) for n in found], columns=["path", "id", "x", "y"])

    return _packed(spark, sf_dir)[0].where("atlas IS NOT NULL").select("path", "atlas").mapInPandas(decode, "path string, id long, x double, y double")


@query(f"""WITH {TILE_POINTS}, q AS (SELECT path, id AS query, x::DOUBLE AS qx, y::DOUBLE AS qy FROM o WHERE total BETWEEN 2 AND {CAPACITY} AND id % 20 = 0),
z AS (SELECT query, q.path, o.id, x::DOUBLE AS x, y::DOUBLE AS y, sqrt((x::DOUBLE - qx) ** 2 + (y::DOUBLE - qy) ** 2) AS d FROM q JOIN o ON o.path = q.path WHERE NOT (x::DOUBLE = qx AND y::DOUBLE = qy))
SELECT query, path, id, round(x, 6) AS x, round(y, 6) AS y, round(d, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, id) AS k FROM z) WHERE k = 1""")
def q_tile_nearest(spark, sf_dir):
    """The nearest other body by search in the packed tree of a point's leaf tile, for every twentieth point."""
    packed, area = _packed(spark, sf_dir)
    packed = materialise(packed, "packed")
    points, t, _ = _tiled(spark, sf_dir)
    leaves = t.where("leaf AND total >= 2").select("path")
    asked = points.where("id % 20 = 0").join(leaves, "path").select(F.col("id").alias("query"), "path", "x", "y")
    return spatial.nearest_in_tiles(packed, area, asked, exclusive=True).select("query", "path", "id", *[F.round(c, 6).alias(c) for c in ("x", "y", "distance")])


@query("""SELECT * FROM (VALUES ('', '00002041' || '00002041' || '01000000' || '0000c842' || '0000c842' || '02000000' || '000048c2' || '000048c2' || '03000000',
  '000001000000000004000000' || '000003000000000002000000' || '800000014120000041200000' || '8000000242c8000042c80000' || '80000003c2480000c2480000')) f(path, nodes, atlas)""")
def q_packed_fixture(spark, sf_dir):
    """Three bodies in one tile, byte by byte (the nodes in the order of their positions here, since files hold a seeded order)."""
    three = spark.createDataFrame([(1, 10.0, 10.0, 1), (2, 100.0, 100.0, 2), (3, -50.0, -50.0, 3)], "id long, x double, y double, color int")
    area = spatial.area_of(three)

    def encode(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("id")
        rec = np.zeros(len(x), np.dtype([("x", "<f4"), ("y", "<f4"), ("c", "<u4")]))
        rec["x"], rec["y"], rec["c"] = x["x"], x["y"], x["color"]
        return pd.DataFrame({"path": [""], "nodes": [rec.tobytes().hex()], "atlas": [spatial.pack(x["id"].to_numpy(), x["x"].to_numpy(), x["y"].to_numpy(), area).hex()]})

    return three.groupBy(F.lit("").alias("k")).applyInPandas(lambda x: encode(x), "path string, nodes string, atlas string")


@query(f"""WITH {MAP}, {AREA}, {PATHS}, x AS (SELECT path, level, (c + 0.5) * (side / pow(2, level)) - side / 2 AS cx, (r + 0.5) * (side / pow(2, level)) - side / 2 AS cy, side / pow(2, level) AS w FROM t, s)
SELECT path, count(*) AS n, sum(id)::BIGINT AS ids FROM x JOIN p ON abs(p.x::DOUBLE - cx) <= w / 2 AND abs(p.y::DOUBLE - cy) <= w / 2 GROUP BY path""")
def q_closed_tile_points(spark, sf_dir):
    """All points of each tile, borders on all four sides included."""
    p = map_points(spark, sf_dir)
    area = spatial.area_of(p)
    t = materialise(spatial.tiles(p, CAPACITY, area), "tiles")
    return spatial.tile_points(p, t, 1 << 30, area, closed=True).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(f"WITH {MAP}, {AREA}, {PATHS} SELECT path, least(total, {CAPACITY}) AS n, least(total, {CAPACITY}) AS ids FROM t")
def q_seeded_tile_points(spark, sf_dir):
    """The default, seeded order: as many different points of each tile as it may show."""
    p = map_points(spark, sf_dir)
    area = spatial.area_of(p)
    t = materialise(spatial.tiles(p, CAPACITY, area), "tiles")
    return spatial.tile_points(p, t, CAPACITY, area).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


@query(f"""WITH {MAP}, {AREA}, {PATHS} SELECT CASE WHEN t.path = '' THEN 'root' ELSE t.path END AS id, t.level, t.total, max(k.path) FILTER (k.path[-1:] = '0') AS ne, max(k.path) FILTER (k.path[-1:] = '1') AS nw,
max(k.path) FILTER (k.path[-1:] = '2') AS sw, max(k.path) FILTER (k.path[-1:] = '3') AS se FROM t LEFT JOIN t k ON k.level = t.level + 1 AND k.path[1:t.level] = t.path GROUP BY ALL""")
def q_tile_list(spark, sf_dir):
    return sinks.tile_list(spatial.tiles(map_points(spark, sf_dir), CAPACITY)).select("id", "level", "total", "ne", "nw", "sw", "se")


SPOTS = [(15.0, 15.0), (-100.0, 40.0), (0.0, 0.0), (250.5, -31.25)]


def _nearest(where: str = "") -> str:
    spots = ", ".join(f"({k}, {x}::DOUBLE, {y}::DOUBLE)" for k, (x, y) in enumerate(SPOTS))
    return f"""WITH {MAP}, q(query, qx, qy) AS (VALUES {spots}), n AS (SELECT query, id, x::DOUBLE AS x, y::DOUBLE AS y, sqrt((x::DOUBLE - qx) ** 2 + (y::DOUBLE - qy) ** 2) AS d FROM p, q {where})
SELECT query::BIGINT AS query, id, round(x, 6) AS x, round(y, 6) AS y, round(d, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, id) AS k FROM n) WHERE k = 1"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("query", "id", *[F.round(c, 6).alias(c) for c in ("x", "y", "distance")])


@query(_nearest())
def q_nearest_inclusive(spark, sf_dir):
    return _rounded(spatial.nearest(map_points(spark, sf_dir), SPOTS))


@query("""WITH p AS (SELECT vec_id AS id, (embedding[1]::DOUBLE * 1000)::FLOAT AS x, (embedding[2]::DOUBLE * 1000)::FLOAT AS y FROM embeddings),
q AS (SELECT x::DOUBLE AS qx, y::DOUBLE AS qy FROM p WHERE id = 0), n AS (SELECT id, x::DOUBLE AS x, y::DOUBLE AS y, sqrt((x::DOUBLE - qx) ** 2 + (y::DOUBLE - qy) ** 2) AS d FROM p, q WHERE NOT (x::DOUBLE = qx AND y::DOUBLE = qy))
SELECT 0::BIGINT AS query, id, round(x, 6) AS x, round(y, 6) AS y, round(d, 6) AS distance FROM n ORDER BY d, id LIMIT 1""")
def q_nearest_exclusive(spark, sf_dir):
    p = map_points(spark, sf_dir)
    at = p.where("id = 0").first()
    return _rounded(spatial.nearest(p, [(at["x"], at["y"])], exclusive=True))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_points(spark, sf_dir).withColumn("mass", (F.col("id") % 10 + 1).cast("double"))


@query("SELECT sum(vec_id % 10 + 1)::DOUBLE AS mass FROM embeddings")
def q_total_mass(spark, sf_dir):
    return spatial.total_mass(bodies(spark, sf_dir))


@query(f"WITH {MAP}, {AREA}, {PATHS} SELECT path, count(*) AS total, sum(id % 10 + 1)::DOUBLE AS mass FROM h WHERE level = 4 GROUP BY path")
def q_mass_by_cell(spark, sf_dir):
    b = bodies(spark, sf_dir)
    return spatial.cells(b, spatial.area_of(b), 4)


@query("SELECT sum(vec_id % 10 + 1)::DOUBLE AS mass, count(*) AS n FROM embeddings WHERE vec_id % 5 <> 0")
def q_removed_bodies(spark, sf_dir):
    b = bodies(spark, sf_dir)
    return spatial.remove_bodies(b, b.where("id % 5 = 0")).agg(F.sum("mass").alias("mass"), F.count(F.lit(1)).alias("n"))


ALL_PAIRS = f"""{MAP}, o AS (SELECT id, x::DOUBLE AS x, y::DOUBLE AS y, (id % 10 + 1)::DOUBLE AS m FROM p),
z AS (SELECT a.id, sum(a.m * b.m / pow(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 3) * (a.x - b.x)) AS fx, sum(a.m * b.m / pow(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 3) * (a.y - b.y)) AS fy
  FROM o a JOIN o b ON a.x <> b.x OR a.y <> b.y GROUP BY a.id)"""


@query(f"WITH {ALL_PAIRS} SELECT id, round(fx, 5) AS fx, round(fy, 5) AS fy FROM z")
def q_forces_exact(spark, sf_dir):
    """Body by body: at level 1 every cell is next to every other."""
    b = bodies(spark, sf_dir)
    return spatial.forces(b, b, spatial.area_of(b), level=1).select("id", F.round("fx", 5).alias("fx"), F.round("fy", 5).alias("fy"))


@query("SELECT count(*) AS bodies, TRUE AS mean_error_below_5_percent FROM embeddings")
def q_forces(spark, sf_dir):
    """With far cells summed, held against the exact forces."""
    b = bodies(spark, sf_dir)
    area = spatial.area_of(b)
    near, exact = spatial.forces(b, b, area), spatial.forces(b, b, area, level=1).toDF("id", "ex", "ey")
    error = F.hypot(F.col("fx") - F.col("ex"), F.col("fy") - F.col("ey")) / F.hypot("ex", "ey")
    return near.join(exact, "id").agg(F.count(F.lit(1)).alias("bodies"), (F.avg(error) < 0.05).alias("mean_error_below_5_percent"))


@query("""WITH p AS (SELECT vec_id AS id, (embedding[1]::DOUBLE * 1000)::FLOAT::DOUBLE AS x, (embedding[2]::DOUBLE * 1000)::FLOAT::DOUBLE AS y FROM embeddings)
SELECT id, round(x, 6) AS x, round(y, 6) AS y, (id % 10 + 1)::DOUBLE AS mass, round(sqrt((x - 15) ** 2 + (y - 15) ** 2), 6) AS distance FROM p ORDER BY sqrt((x - 15) ** 2 + (y - 15) ** 2), id LIMIT 1""")
def q_nearest_body(spark, sf_dir):
    found = spatial.nearest_body(bodies(spark, sf_dir), 15.0, 15.0)
    return spark.createDataFrame([found], "id long, x double, y double, mass double, distance double").select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "mass", F.round("distance", 6).alias("distance"))


@query("""WITH b AS (SELECT min(embedding[1]::DOUBLE) AS lo, max(embedding[1]::DOUBLE) AS hi FROM embeddings)
SELECT least(floor((embedding[1]::DOUBLE - lo) / ((hi - lo) / 500)), 499)::BIGINT AS bin, count(*) AS n FROM embeddings, b GROUP BY 1""")
def q_histogram(spark, sf_dir):
    return spatial.histogram(table(spark, sf_dir, "embeddings").select(F.element_at("embedding", 1).cast("double").alias("v")), "v")


@query("SELECT count(*) - count(DISTINCT (x, y)) AS shared FROM (SELECT (embedding[1]::DOUBLE * 1000)::FLOAT AS x, (embedding[2]::DOUBLE * 1000)::FLOAT AS y FROM embeddings)")
def q_collisions(spark, sf_dir):
    return spatial.collisions(map_points(spark, sf_dir)).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("shared"))


# ---- files: written to the folder that all share, and read again by ranges


def _file(spark: SparkSession, name: str) -> str:
    files.register(spark)
    folder = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    return f"{folder}/{uuid.uuid4().hex}-{name}"


@query("SELECT s_suppkey AS id, s_name AS did FROM supplier")
def q_sqlite_nodes(spark, sf_dir):
    path = _file(spark, "directory.sqlite")
    sinks.write_sqlite_directory(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("did")), path)
    return spark.read.format("sqlite").options(path=path, table="users", page="64").load()


@query(f"WITH {MAP} SELECT id, round(x::DOUBLE, 6) AS x, round(y::DOUBLE, 6) AS y, 1::DOUBLE AS mass, id * 3 % 1000 AS color FROM p")
def q_sqlite_map(spark, sf_dir):
    p = map_points(spark, sf_dir)
    ids = p.select("id", F.col("id").alias("idx"))
    out = sinks.map_nodes(ids, p.select(F.col("id").alias("idx"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), p.select(F.col("id").alias("idx"), (F.col("id") * 3 % 1000).cast("int").alias("color")), scale=1.0)
    path = _file(spark, "map.sqlite")
    sinks.write_sqlite_nodes(out, path)
    return spark.read.format("sqlite").options(path=path, table="nodes", page="100").load().select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "mass", "color")


@query("SELECT row_number() OVER (ORDER BY vec_id) - 1 AS idx, len(embedding) AS dim, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings")
def q_npy_vectors(spark, sf_dir):
    path = _file(spark, "embeddings.npy")
    sinks.write_npy(vectors(spark, sf_dir), path, "embedding", dtype="<f4")
    x = spark.read.format("npy").options(path=path, page="100").load()
    total = F.aggregate(F.transform("value", lambda v: v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return x.select("idx", F.size("value").cast("bigint").alias("dim"), F.round(total, 5).alias("total"))


@query(f"WITH {SUPPLIERS}, {DEGREES}, {WEIGHTS} SELECT source, target, round(weight::FLOAT::DOUBLE, 4) AS weight FROM w")
def q_arrow_edges(spark, sf_dir):
    path = _file(spark, "edges.arrow")
    sinks.write_edges(graph.weights(suppliers(spark, sf_dir)), path)
    return spark.read.format("arrow_ipc").options(path=path, kind="edges").load().select("source", "target", F.round(F.col("weight").cast("double"), 4).alias("weight"))


@query(f"WITH {SUPPLIERS}, {DEGREES} SELECT s_suppkey AS id, coalesce(in_deg, 0) AS incoming_degree, coalesce(out_deg, 0) AS outgoing_degree FROM supplier LEFT JOIN d ON s_suppkey = node")
def q_arrow_nodes(spark, sf_dir):
    path = _file(spark, "nodes.arrow")
    sinks.write_nodes(graph.degrees(suppliers(spark, sf_dir), nodes_of(spark, sf_dir, "supplier", "s_suppkey")).withColumnRenamed("node", "id"), path)
    return spark.read.format("arrow_ipc").options(path=path, kind="nodes").load()


@query(f"WITH {KNN} SELECT (dense_rank() OVER (ORDER BY i) - 1) * 10 + rank - 1 AS at, j, round(dist::FLOAT::DOUBLE, 4) AS dist FROM k")
def q_arrow_knn(spark, sf_dir):
    path = _file(spark, "knn.arrow")
    sinks.write_knn(embed.as_arrays(embed.knn_exact(vectors(spark, sf_dir), 10)), path, 10)
    x = spark.read.format("arrow_ipc").options(path=path, kind="knn").load().coalesce(1)  # rows are nodes by position: numbered in the order of the file
    x = x.withColumn("row", F.monotonically_increasing_id()).select("row", F.posexplode(F.arrays_zip("index", "dist")).alias("k", "v"))
    return x.select((F.col("row") * 10 + F.col("k")).alias("at"), F.col("v.index").cast("bigint").alias("j"), F.round(F.col("v.dist").cast("double"), 4).alias("dist"))


@query("SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS idx, s_suppkey AS id FROM supplier")
def q_id_buffer(spark, sf_dir):
    """Ids as raw 32-bit numbers, read back as Spark's binary files."""
    path = _file(spark, "ids.buffer")
    sinks.write_id_buffer(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), path)

    def decode(batches):
        for x in batches:
            for data in x["content"]:
                ids = np.frombuffer(data, "<u4").astype(np.int64)
                yield pd.DataFrame({"idx": np.arange(len(ids)), "id": ids})

    return spark.read.format("binaryFile").load(f"file://{path}").select("content").mapInPandas(decode, "idx long, id long")


# ---- streams, here over the whole table as one batch


@query("SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS \"end\", event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def q_event_windows(spark, sf_dir):
    return streams.windowed_counts(table(spark, sf_dir, "events")).withColumn("value", F.round("value", 4))


@query(f"WITH {USERS}, {DEGREES} SELECT * FROM d")
def q_running_degrees(spark, sf_dir):
    return streams.running_degrees(users(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers with most mutual edges, their degrees and the mean weight of those edges."""
    e = suppliers(spark, sf_dir)
    mutual = graph.mutual_degrees(graph.mutual_edges(e))
    mean = graph.weights(e).groupBy(F.col("source").alias("node")).agg(F.round(F.avg("weight"), 6).alias("mean_weight"))
    return mutual.join(graph.degrees(e), "node").join(mean, "node").orderBy(F.desc("mutual_deg"), "node").limit(100)
