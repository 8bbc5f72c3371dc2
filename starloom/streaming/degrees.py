"""Running degrees and event counts over streams, as update-mode aggregations that Spark keeps in its state store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_degrees(edges: DataFrame) -> DataFrame:
    """(node, out_deg, in_deg) of an edge stream (source, target): state is one row a node."""
    ends = F.explode(F.array(F.struct(F.col("source").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("target").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    return edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.o").alias("out_deg"), F.sum("e.i").alias("in_deg"))


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events by type and window; what comes later than `late` is dropped and its state freed."""
    w = F.window("ts", length)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select("w.start", "w.end", "event_type", "n", "value")
