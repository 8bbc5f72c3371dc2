"""Files at the edge of the system. Parquet is the form between stages; these write what other programs read.

Single-file formats pass through the driver a batch at a time (toLocalIterator), never as a whole.
"""

from __future__ import annotations

import json
import sqlite3
from pathlib import Path

import numpy as np
import pyarrow as pa
from numpy.lib import format as npy
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .files import EDGES, NODES

BATCH = 50_000


def _batches(df: DataFrame):
    rows = []
    for r in df.toLocalIterator(prefetchPartitions=True):
        rows.append(tuple(r))
        if len(rows) == BATCH:
            yield rows
            rows = []
    if rows:
        yield rows


def write_npy(df: DataFrame, path: str, column: str, by: str = "idx", dtype: str | None = None) -> int:
    """A numeric or array column in the order of `by` as .npy; the row count is known first, so rows stream out. Returns it."""
    n = df.count()
    first = df.select(column).first()
    sample = np.asarray(first[0] if first else 0, dtype=dtype)
    kind = np.dtype(dtype) if dtype else sample.dtype
    with open(path, "wb") as f:
        npy.write_array_header_1_0(f, {"descr": npy.dtype_to_descr(kind), "fortran_order": False, "shape": (n, *sample.shape)})
        for rows in _batches(df.orderBy(by).select(column)):
            f.write(np.array([r[0] for r in rows], dtype=kind).tobytes())
    return n


def write_id_buffer(nodes: DataFrame, path: str, column: str = "id") -> None:
    """Ascending ids as raw little-endian u32."""
    with open(path, "wb") as f:
        for rows in _batches(nodes.select(column).orderBy(column)):
            f.write(np.array([r[0] for r in rows], dtype="<u4").tobytes())


def write_arrow(df: DataFrame, path: str, schema: pa.Schema | None = None) -> None:
    """An Arrow IPC file, a record batch per `BATCH` rows; `schema` may narrow types (u32, i32, f32)."""
    schema = schema or to_arrow_schema(df.schema)
    with pa.OSFile(path, "wb") as f, pa.ipc.new_file(f, schema) as out:
        for rows in _batches(df):
            out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema))


def write_nodes(nodes: DataFrame, path: str) -> None:
    """(id, in_deg, out_deg) in id order."""
    write_arrow(nodes.select("id", F.col("in_deg").alias("incoming_degree"), F.col("out_deg").alias("outgoing_degree")).orderBy("id"), path, NODES)


def write_edges(edges: DataFrame, path: str, by: tuple[str, str] = ("source", "target")) -> None:
    write_arrow(edges.select("weight", "source", "target").orderBy(*by), path, EDGES)


def write_knn(arrays: DataFrame, path: str, k: int) -> None:
    """(idx, index, dist) as fixed-size lists, in idx order."""
    schema = pa.schema([("index", pa.list_(pa.int32(), k)), ("dist", pa.list_(pa.float32(), k))])
    write_arrow(arrays.orderBy("idx").select("index", "dist"), path, schema)


def map_nodes(ids: DataFrame, positions: DataFrame, colors: DataFrame, scale: float = 1000.0) -> DataFrame:
    """(id, x, y, mass, color) of (id, idx), (idx, x, y) and (idx, color); all three must have the same nodes, or it raises."""
    out = ids.join(positions, "idx").join(colors, "idx")
    counts = [d.count() for d in (ids, positions, colors, out)]
    if len(set(counts)) != 1:
        raise ValueError(f"ids, positions, colours and their join have {counts} rows")
    return out.select("id", (F.col("x") * scale).alias("x"), (F.col("y") * scale).alias("y"), F.lit(1.0).alias("mass"), "color")


def write_sqlite_nodes(nodes: DataFrame, path: str) -> int:
    """Replace the table nodes(id, x, y, mass, color) in one transaction."""
    with sqlite3.connect(path) as db:
        db.execute("DROP TABLE IF EXISTS nodes")
        db.execute("CREATE TABLE nodes (id INTEGER PRIMARY KEY NOT NULL, x FLOAT NOT NULL, y FLOAT NOT NULL, mass FLOAT NOT NULL, color INTEGER NOT NULL)")
        for rows in _batches(nodes.select("id", "x", "y", "mass", "color")):
            db.executemany("INSERT INTO nodes VALUES (?, ?, ?, ?, ?)", rows)
        n = db.execute("SELECT count(*) FROM nodes").fetchone()[0]
    return n


def write_sqlite_directory(nodes: DataFrame, path: str) -> None:
    """Replace the table users(id, did) and its index."""
    with sqlite3.connect(path) as db:
        db.execute("DROP TABLE IF EXISTS users")
        db.execute("CREATE TABLE users (id INTEGER PRIMARY KEY NOT NULL, did TEXT)")
        for rows in _batches(nodes.select("id", "did")):
            db.executemany("INSERT INTO users VALUES (?, ?)", rows)
        db.execute("CREATE INDEX users_did ON users (did)")


def write_tiles(packed: DataFrame, tile_table: DataFrame, folder: str, dry_run: bool = False) -> dict:
    """The tile files and index.json: nested tiles, null for an empty quadrant. Tiles are few; their files pass one by one."""
    top = Path(folder)
    top.mkdir(parents=True, exist_ok=True)
    for old in top.glob("tile-*-*"):
        old.unlink()
    rows = {r["path"]: r for r in tile_table.toLocalIterator()}
    if not dry_run:
        for r in packed.toLocalIterator():
            for kind in ("nodes", "atlas"):
                if r[kind] is not None:
                    (top / f"tile-{len(r['path'])}-{r['path'] or 'root'}-{kind}").write_bytes(r[kind])

    def tile(path: str) -> dict | None:
        if path not in rows:
            return None
        r = rows[path]
        out = {"id": path or "root", "level": r["level"], "total": r["total"], "count": r["count"], "area": {"x": r["x"], "y": r["y"], "s": r["s"]}}
        if not dry_run:
            out["nodes"] = f"tile-{r['level']}-{path or 'root'}-nodes"
        if r["leaf"]:
            return out if dry_run else out | {"atlas": f"tile-{r['level']}-{path or 'root'}-atlas"}
        return out | {name: tile(path + digit) for digit, name in enumerate_digits()}

    index = tile("") or {}
    (top / "index.json").write_text(json.dumps(index, indent="\t"))
    return index


def enumerate_digits() -> list[tuple[str, str]]:
    return [("0", "ne"), ("1", "nw"), ("2", "sw"), ("3", "se")]


def tile_list(tile_table: DataFrame) -> DataFrame:
    """A flat table for JSON lines: each tile with the ids of its children."""
    kids = tile_table.where("level > 0").groupBy(F.expr("substring(path, 1, length(path) - 1)").alias("path")).agg(
        *[F.max(F.when(F.col("path").endswith(d), F.col("path"))).alias(n) for d, n in enumerate_digits()]
    )
    return tile_table.join(kids, "path", "left").withColumn("id", F.when(F.col("path") == "", "root").otherwise(F.col("path"))).drop("path")
