"""A map of points (id, x, y[, color, mass]) cut into level-of-detail quadtree tiles, packed trees, nearest points and forces.

Quadrants are numbered 0 north-east, 1 north-west, 2 south-west, 3 south-east; a point on a dividing line lies east or north of it. A tile's
path is the digits from the root. Coordinates are rounded to 32-bit floats first; centres are dyadic, so all cuts are exact.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise

#: Deepest level: two floats that differ part by then in any area worth mapping.
MAX_DEPTH = 26


@dataclass(frozen=True)
class Area:
    """A square by its side and centre."""

    side: float
    x: float = 0.0
    y: float = 0.0

    def child(self, digit: int) -> Area:
        q = self.side / 4
        return Area(self.side / 2, self.x + (q if digit in (0, 3) else -q), self.y + (q if digit in (0, 1) else -q))

    def locate(self, x: float, y: float) -> int:
        if y < self.y:
            return 2 if x < self.x else 3
        return 1 if x < self.x else 0

    def contains(self, x: float, y: float) -> bool:
        """Closed on all four sides."""
        return abs(x - self.x) <= self.side / 2 and abs(y - self.y) <= self.side / 2

    def distance(self, x: float, y: float) -> float:
        return float(np.hypot(max(abs(x - self.x) - self.side / 2, 0), max(abs(y - self.y) - self.side / 2, 0)))

    def at(self, path: str) -> Area:
        area = self
        for d in path:
            area = area.child(int(d))
        return area


def floats(points: DataFrame) -> DataFrame:
    return points.withColumn("x", F.col("x").cast("float")).withColumn("y", F.col("y").cast("float"))


def bounds(points: DataFrame) -> DataFrame:
    """One row min_x, max_x, min_y, max_y, side; the origin is always inside; side is the next power of two, 0 without points."""
    p = floats(points).select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    zero = F.lit(0.0)
    box = p.agg(*[F.coalesce(f(F.col(c)), zero).alias(n) for c, f, n in (("x", lambda c: F.least(F.min(c), zero), "min_x"), ("x", lambda c: F.greatest(F.max(c), zero), "max_x"), ("y", lambda c: F.least(F.min(c), zero), "min_y"), ("y", lambda c: F.greatest(F.max(c), zero), "max_y"))])
    reach = F.greatest(-F.col("min_x"), "max_x", -F.col("min_y"), "max_y") * 2
    return box.withColumn("side", F.when(reach > 0, F.pow(F.lit(2.0), F.ceil(F.log2(reach)))).otherwise(zero))


def area_of(points: DataFrame) -> Area:
    return Area(bounds(points).first()["side"])


def column_row(area: Area, level: int) -> tuple[Column, Column]:
    """Cell indices at a level; a point on the outer east or north border stays inside."""
    cells = 1 << level
    last = F.lit(cells - 1)

    def index(c: str, centre: float) -> Column:
        at = F.floor((F.col(c).cast("double") - centre + area.side / 2) / (area.side / cells)) if area.side else F.lit(0)
        return F.greatest(F.least(at, last), F.lit(0)).cast("bigint")

    return index("x", area.x), index("y", area.y)


def path(area: Area, depth: int) -> Column:
    """The digits of a point's cells down to `depth`, without a row a level: a base-4 number, then one translation of its digits.

    A digit is 2 * (odd row) + (odd column) first: 0 south-west, 1 south-east, 2 north-west, 3 north-east.
    """
    col, row = column_row(area, depth)

    def spread(v: Column) -> Column:
        return F.conv(F.bin(v), 4, 10).cast("decimal(38,0)")

    # bin() read in base 4 doubles the distance of the bits, so the two interleave by one addition.
    code = F.lpad(F.conv((spread(col) + spread(row) * 2).cast("string"), 10, 4), depth, "0") if depth else F.lit("")
    return F.translate(code, "0123", "2310")


def cells(points: DataFrame, area: Area, depth: int) -> DataFrame:
    """(path, total, mass) of the occupied cells at a level."""
    mass = F.sum("mass") if "mass" in points.columns else F.count(F.lit(1)).cast("double")
    return floats(points).groupBy(path(area, depth).alias("path")).agg(F.count(F.lit(1)).alias("total"), mass.alias("mass"))


def tiles(points: DataFrame, capacity: int, area: Area | None = None) -> DataFrame:
    """(path, level, total, count, leaf, x, y, s): the root, and the occupied children of every tile with more than `capacity` points.

    Points are counted once into the finest cells; levels are then sums of cells below crowded tiles. More than `capacity` equal points raise.
    """
    area = area or area_of(points)
    fine = materialise(cells(points, area, MAX_DEPTH).select("path", "total"), "cells")
    parts = [fine.agg(F.lit("").alias("path"), F.sum("total").alias("total")).where("total > 0")]
    crowded = materialise(parts[0].where(F.col("total") > capacity), "tiles")
    for level in range(1, MAX_DEPTH + 1):
        if not crowded.limit(1).count():
            break
        above = crowded.select(F.col("path").alias("_above"))
        inside = fine.join(above, F.substring("path", 1, level - 1) == F.col("_above"), "left_semi") if level > 1 else fine
        found = materialise(inside.groupBy(F.substring("path", 1, level).alias("path")).agg(F.sum("total").alias("total")), "tiles")
        parts.append(found)
        crowded = found.where(F.col("total") > capacity)
    if crowded.limit(1).count():
        raise ValueError("more points at one position than a tile may hold")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    side = F.lit(area.side) / F.pow(F.lit(2.0), F.length("path"))
    at = {0: (1, 1), 1: (-1, 1), 2: (-1, -1), 3: (1, -1)}

    def centre(axis: int, origin: float) -> Column:
        steps = F.transform(F.sequence(F.lit(1), F.length("path")), lambda i: F.substring(F.col("path"), i, F.lit(1)).cast("int"))
        sign = lambda d: F.when(d.isin([k for k, v in at.items() if v[axis] > 0]), 1.0).otherwise(-1.0)
        moved = F.aggregate(steps, F.struct(F.lit(origin).alias("c"), F.lit(area.side / 4).alias("q")), lambda s, d: F.struct((s["c"] + sign(d) * s["q"]).alias("c"), (s["q"] / 2).alias("q")))["c"]
        return F.when(F.length("path") > 0, moved).otherwise(F.lit(origin))

    return out.select(
        "path",
        F.length("path").cast("bigint").alias("level"),
        "total",
        F.least("total", F.lit(capacity)).cast("bigint").alias("count"),
        (F.col("total") <= capacity).alias("leaf"),
        centre(0, area.x).cast("bigint").alias("x"),
        centre(1, area.y).cast("bigint").alias("y"),
        side.cast("bigint").alias("s"),
    )


def tile_points(points: DataFrame, tile_table: DataFrame, capacity: int, area: Area, order: Column | None = None, closed: bool = False) -> DataFrame:
    """Points of each tile (path added), the first `capacity` in a seeded order (`order`, then id); each tile is an evenly drawn sample.

    A point meets the tiles on its own path by equi-joins on prefixes. With `closed`, points on a border also belong to the tiles beyond it. The default order is
    uniform, so of a tile with many points only those below a threshold are ranked, some standard deviations more than are wanted: no task sorts the whole map.
    """
    depth = tile_table.agg(F.max("level")).first()[0] or 0
    p = floats(points).withColumn("_order", order if order is not None else F.xxhash64(F.lit(1), "id"))
    if closed:
        step = area.side / (1 << depth)
        moves = [(0.0, 0.0)] + [(a * step / 2, b * step / 2) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]
        near = F.array(*[F.struct((F.col("x").cast("double") + a).alias("nx"), (F.col("y").cast("double") + b).alias("ny")) for a, b in moves])
        on_line = lambda c, o: F.pmod(F.col(c).cast("double") - o, F.lit(step)) == 0
        spread = p.withColumn("_n", F.explode(F.when(on_line("x", area.x) | on_line("y", area.y), near).otherwise(F.slice(near, 1, 1))))
        shifted = spread.withColumn("_x", F.col("x")).withColumn("_y", F.col("y")).withColumn("x", F.col("_n.nx")).withColumn("y", F.col("_n.ny")).withColumn("_path", path(area, depth))
        p = shifted.withColumn("x", F.col("_x")).withColumn("y", F.col("_y")).drop("_x", "_y", "_n")
    else:
        p = p.withColumn("_path", path(area, depth))
    on = p.withColumn("path", F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda n: F.substring("_path", F.lit(1), n)))).drop("_path")
    met = on.join(tile_table.select("path", F.col("x").alias("_cx"), F.col("y").alias("_cy"), F.col("s").alias("_cs"), F.col("total").alias("_total")), "path")
    if order is None:
        wanted = capacity + 12 * capacity**0.5 + 150
        met = met.where((F.col("_total") <= wanted) | (F.col("_order") < F.lit(-(2.0**63)) + 2.0**64 * wanted / F.col("_total")))
    if closed:
        half = F.col("_cs") / 2
        met = met.where((F.abs(F.col("x") - F.col("_cx")) <= half) & (F.abs(F.col("y") - F.col("_cy")) <= half)).dropDuplicates(["path", "id"])
    first = Window.partitionBy("path").orderBy("_order", "id")
    return met.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= capacity).drop("_order", "_r", "_cx", "_cy", "_cs", "_total")


# ---- packed trees


def pack(ids: np.ndarray, xs: np.ndarray, ys: np.ndarray, area: Area) -> bytes:
    """Bodies, inserted one after the other, as 12-byte nodes: leaves are big-endian id | 2^31, f32 x, f32 y; others four 24-bit links, 0 for none.

    A leaf that meets another body moves to a new node below itself. Bodies outside the area, or at one position, raise.
    """
    bodies: list[tuple[int, float, float] | None] = []
    links: list[list[int]] = []

    def new(body: tuple[int, float, float]) -> int:
        bodies.append(body)
        links.append([0, 0, 0, 0])
        if len(bodies) > 1 << 23:
            raise OverflowError("a packed tree has fewer than 2^23 nodes")
        return len(bodies) - 1

    for body in zip(ids.tolist(), xs.astype(np.float32).tolist(), ys.astype(np.float32).tolist(), strict=True):
        i, x, y = body
        if not 0 <= i < 1 << 31:
            raise ValueError(f"id {i} does not fit 31 bits")
        if not area.contains(x, y):
            raise ValueError(f"body {i} is outside of the area")
        at, here = 0, area
        while bodies:
            if (leaf := bodies[at]) is not None:
                if leaf[1:] == (x, y):
                    raise ValueError(f"bodies {leaf[0]} and {i} are at one position")
                bodies[at] = None
                links[at][here.locate(leaf[1], leaf[2])] = new(leaf)
            d = here.locate(x, y)
            if not links[at][d]:
                links[at][d] = new(body)
                break
            at, here = links[at][d], here.child(d)
        else:
            new(body)
    return b"".join(struct.pack(">Iff", b[0] | 1 << 31, b[1], b[2]) if b else b"".join(k.to_bytes(3) for k in n) for b, n in zip(bodies, links, strict=True))


def unpack(data: bytes) -> list[tuple]:
    """Nodes of a packed tree: ("leaf", id, x, y) or ("node", ne, nw, sw, se)."""
    out: list[tuple] = []
    for i in range(0, len(data), 12):
        n = data[i : i + 12]
        if n[0] & 0x80:
            k, x, y = struct.unpack(">Iff", n)
            out.append(("leaf", k & 0x7FFFFFFF, x, y))
        else:
            out.append(("node", *(int.from_bytes(n[j : j + 3]) for j in (0, 3, 6, 9))))
    return out


def nearest_packed(data: bytes, area: Area, x: float, y: float, exclusive: bool = False) -> tuple[int, float, float, float] | None:
    """(id, x, y, distance) of the nearest body by branch and bound; None if there is none (or only ones at the very position, with `exclusive`)."""
    nodes, best = unpack(data), None
    if not nodes:
        raise ValueError("the tree is empty")
    stack = [(0, area)]
    while stack:
        i, box = stack.pop()
        node = nodes[i]
        if node[0] == "leaf":
            if exclusive and node[2:] == (x, y):
                continue
            d = float(np.hypot(node[2] - x, node[3] - y))
            if best is None or (d, node[1]) < (best[3], best[0]):
                best = (*node[1:], d)
        elif best is None or box.distance(x, y) <= best[3]:
            inner = sorted(((box.child(d), k) for d, k in enumerate(node[1:]) if k), key=lambda c: -c[0].distance(x, y))
            stack += [(k, c) for c, k in inner]
    return best


def packed_tiles(points_of_tiles: DataFrame, tile_table: DataFrame, area: Area) -> DataFrame:
    """(path, level, nodes, atlas): per tile little-endian f32 x, f32 y, u32 color of its points, and for leaves the packed tree. A tile has at most capacity points."""
    box = (area.side, area.x, area.y)

    def encode(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["_k", "id"])
        rec = np.zeros(len(x), np.dtype([("x", "<f4"), ("y", "<f4"), ("c", "<u4")]))
        rec["x"], rec["y"], rec["c"] = x["x"], x["y"], x["color"]
        path = x["path"].iloc[0]
        tree = pack(x["id"].to_numpy(), x["x"].to_numpy(), x["y"].to_numpy(), Area(*box).at(path)) if x["leaf"].iloc[0] else None
        return pd.DataFrame({"path": [path], "level": [len(path)], "nodes": [rec.tobytes()], "atlas": [tree]})

    full = points_of_tiles if "color" in points_of_tiles.columns else points_of_tiles.withColumn("color", F.lit(0))
    joined = full.join(tile_table.select("path", "leaf"), "path").select("path", "leaf", "id", "x", "y", "color", F.xxhash64(F.lit(1), "id").alias("_k"))
    return joined.groupBy("path").applyInPandas(encode, "path string, level long, nodes binary, atlas binary")


def collisions(points: DataFrame) -> DataFrame:
    """Positions that several points share."""
    return floats(points).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).where("n > 1")


def tile_name(kind: str) -> Column:
    """tile-{level}-{root or path}-{kind}"""
    return F.concat_ws("-", F.lit("tile"), F.length("path").cast("string"), F.when(F.col("path") == "", "root").otherwise(F.col("path")), F.lit(kind))


def digest(packed: DataFrame) -> str:
    """One hash over all tile contents, in path order; the tiles' own hashes are what the driver sees."""
    import hashlib

    rows = packed.select("path", F.sha2(F.concat(F.col("nodes"), F.coalesce("atlas", F.lit(b""))), 256).alias("h")).orderBy("path").toLocalIterator()
    out = hashlib.sha256()
    for r in rows:
        out.update(f"{r['path']}:{r['h']}\n".encode())
    return out.hexdigest()


# ---- bodies with mass


def total_mass(points: DataFrame) -> DataFrame:
    return points.agg(F.coalesce(F.sum("mass"), F.lit(0.0)).alias("mass"))


def insert_bodies(points: DataFrame, more: DataFrame) -> DataFrame:
    return points.unionByName(more, allowMissingColumns=True)


def remove_bodies(points: DataFrame, gone: DataFrame) -> DataFrame:
    """Without the rows that equal one of `gone` in position and mass, as often as they are there."""
    return points.exceptAll(gone.select(*points.columns))


def nearest(points: DataFrame, queries: list[tuple[float, float]], exclusive: bool = False) -> DataFrame:
    """(query, id, x, y, distance): the nearest point to each of a stated, small list of positions; ties by id; null where none is left.

    One pass over the points, one partial minimum a query and task.
    """
    p = floats(points)
    aggs = []
    for k, (qx, qy) in enumerate(queries):
        qx, qy = float(np.float32(qx)), float(np.float32(qy))
        x, y = F.col("x").cast("double"), F.col("y").cast("double")
        d = F.hypot(x - qx, y - qy)
        best = F.struct(d.alias("distance"), F.col("id").cast("bigint").alias("id"), x.alias("x"), y.alias("y"))
        aggs.append(F.min(F.when(~((x == qx) & (y == qy)), best) if exclusive else best).alias(f"q{k}"))
    if not aggs:
        raise ValueError("no query position")
    rows = F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("query"), F.col(f"q{k}").alias("b")) for k in range(len(queries))]))
    return p.agg(*aggs).select(rows.alias("r")).select("r.query", "r.b.id", "r.b.x", "r.b.y", "r.b.distance")


def nearest_body(points: DataFrame, x: float, y: float, exclusive: bool = False) -> tuple[int, float, float, float, float]:
    """(id, x, y, mass, distance) of the nearest body to one position; raises if there is none."""
    p = floats(points) if "mass" in points.columns else floats(points).withColumn("mass", F.lit(1.0))
    qx, qy = float(np.float32(x)), float(np.float32(y))
    px, py = F.col("x").cast("double"), F.col("y").cast("double")
    best = F.struct(F.hypot(px - qx, py - qy).alias("distance"), F.col("id").cast("bigint").alias("id"), px.alias("x"), py.alias("y"), F.col("mass").cast("double").alias("mass"))
    found = p.agg(F.min(F.when(~((px == qx) & (py == qy)), best) if exclusive else best).alias("b")).first()["b"]
    if found is None:
        raise ValueError("there is no body")
    return found["id"], found["x"], found["y"], found["mass"], found["distance"]


def nearest_in_tiles(packed: DataFrame, area: Area, queries: DataFrame, exclusive: bool = False) -> DataFrame:
    """(query, path, id, x, y, distance) for queries (query, path, x, y): the nearest body in that tile's packed tree; no row where a tile has no tree or no body is left."""
    box = (area.side, area.x, area.y)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for q, path, qx, qy, atlas in zip(x["query"], x["path"], x["qx"], x["qy"], x["atlas"], strict=True):
                hit = nearest_packed(bytes(atlas), Area(*box).at(path), float(qx), float(qy), exclusive)
                if hit:
                    rows.append((q, path, *hit))
            yield pd.DataFrame(rows, columns=["query", "path", "id", "x", "y", "distance"])

    asked = queries.select("query", "path", F.col("x").cast("float").cast("double").alias("qx"), F.col("y").cast("float").cast("double").alias("qy"))
    joined = asked.join(packed.where("atlas IS NOT NULL AND length(atlas) > 0").select("path", "atlas"), "path")
    return joined.select("query", "path", "qx", "qy", "atlas").mapInPandas(find, "query long, path string, id long, x double, y double, distance double")


def forces(points: DataFrame, queries: DataFrame, area: Area, level: int | None = None, c: float = 1.0, r: float = 2.0) -> DataFrame:
    """(id, fx, fy) on each query body (id, x, y, mass): the repulsion c * m1 * m2 / d^r away from all bodies, cells summed to their centres of mass.

    Cells at `level` number at most 4^level, a stated bound, and travel to every task; the body's own cell and the 8 around it count
    body by body, through an equi-join on the cell. The default level grows with the bodies, up to 8, for about 16 in a cell; at level 1 or 0 all count body by body.
    """
    if level is None:
        level = int(np.clip(np.ceil(np.log2(max(points.count() / 16, 1)) / 2), 1, 8))
    p = floats(points)
    if "mass" not in p.columns:
        p = p.withColumn("mass", F.lit(1.0))
    col, row = column_row(area, level)
    p = p.withColumn("cx", col).withColumn("cy", row)
    whole = p.groupBy("cx", "cy").agg(F.sum("mass").alias("m"), (F.sum(F.col("x") * F.col("mass")) / F.sum("mass")).alias("gx"), (F.sum(F.col("y") * F.col("mass")) / F.sum("mass")).alias("gy")).toPandas()
    sent = points.sparkSession.sparkContext.broadcast(whole[["cx", "cy", "m", "gx", "gy"]].to_numpy(float))

    def far(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = sent.value
        for x in batches:
            fx, fy = np.zeros(len(x)), np.zeros(len(x))
            for at in range(0, len(x), 64):  # 64 bodies against all cells at once
                px, py, m, a, b = x[["x", "y", "mass", "cx", "cy"]].to_numpy(float)[at : at + 64].T[:, :, None]
                apart = (np.abs(w[:, 0] - a) > 1) | (np.abs(w[:, 1] - b) > 1)
                dx, dy = px - w[:, 3], py - w[:, 4]
                f = np.where(apart, c * m * w[:, 2] / np.where(apart, np.hypot(dx, dy), 1.0) ** (r + 1), 0.0)
                fx[at : at + 64], fy[at : at + 64] = (f * dx).sum(1), (f * dy).sum(1)
            yield pd.DataFrame({"id": x["id"], "fx": fx, "fy": fy})

    q = floats(queries).withColumn("cx", col).withColumn("cy", row)
    if "mass" not in q.columns:
        q = q.withColumn("mass", F.lit(1.0))
    away = q.select("id", "x", "y", "mass", "cx", "cy").mapInPandas(far, "id long, fx double, fy double")
    around = F.explode(F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    near = q.select("id", F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("mass").alias("qm"), around.alias("n")).select("id", "qx", "qy", "qm", "n.cx", "n.cy")
    met = near.join(p.select("cx", "cy", F.col("x").alias("bx"), F.col("y").alias("by"), F.col("mass").alias("bm")), ["cx", "cy"])
    dx, dy = F.col("qx").cast("double") - F.col("bx"), F.col("qy").cast("double") - F.col("by")
    d = F.hypot(dx, dy)
    f = F.when(d > 0, F.lit(c) * F.col("qm") * F.col("bm") / F.pow(d, F.lit(r + 1))).otherwise(0.0)
    close = met.groupBy("id").agg(F.sum(f * dx).alias("fx"), F.sum(f * dy).alias("fy"))
    return away.unionByName(close).groupBy("id").agg(F.sum("fx").alias("fx"), F.sum("fy").alias("fy"))


def histogram(df: DataFrame, column: str, bins: int = 500) -> DataFrame:
    """(bin, n): equal-width bins from the minimum to the maximum, the last one closed; empty bins are left out."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin long, n long")
    width = (float(hi) - float(lo)) / bins or 1.0
    at = F.least(F.floor((F.col(column).cast("double") - float(lo)) / width), F.lit(bins - 1)).cast("bigint")
    return df.where(F.col(column).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
