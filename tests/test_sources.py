import sqlite3

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.sources import files, sinks
from starloom.streaming import degrees as streams


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    files.register(spark)


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "graph.sqlite")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE edges (source INTEGER, target INTEGER)")
        db.execute("CREATE TABLE nodes (id INTEGER PRIMARY KEY, did TEXT)")
        db.executemany("INSERT INTO edges VALUES (?, ?)", [(i, i * 2) for i in range(250)])
        db.executemany("INSERT INTO nodes VALUES (?, ?)", [(i, None if i == 3 else f"d{i}") for i in range(10)])
    e = spark.read.format("sqlite").options(path=path, table="edges", page="100").load()
    assert e.rdd.getNumPartitions() == 3 and sorted(map(tuple, e.collect())) == [(i, i * 2) for i in range(250)]
    only = spark.read.format("sqlite").options(path=path, table="edges").schema("target long").load()
    assert only.agg(F.sum("target")).first()[0] == 250 * 249
    n = spark.read.format("sqlite").options(path=path, table="nodes").load()
    assert n.where("did IS NULL").count() == 1
    sinks.write_sqlite_directory(n, str(tmp_path / "directory.sqlite"))
    with sqlite3.connect(tmp_path / "directory.sqlite") as db:
        assert db.execute("SELECT id FROM users WHERE did = 'd7'").fetchall() == [(7,)]


def test_npy(spark, tmp_path):
    a, b = np.arange(1000, dtype=np.uint32) * 4_000_000, np.random.default_rng(0).random((300, 4)).astype(np.float32)
    np.save(tmp_path / "a.npy", a)
    np.save(tmp_path / "b.npy", b)
    x = spark.read.format("npy").options(path=str(tmp_path / "a.npy"), page="300").load()
    assert x.rdd.getNumPartitions() == 4 and [r["value"] for r in x.orderBy("idx").collect()] == a.tolist()
    y = spark.read.format("npy").options(path=str(tmp_path / "b.npy")).load()
    assert sinks.write_npy(y, str(tmp_path / "c.npy"), "value", dtype="<f4") == 300
    assert np.array_equal(np.load(tmp_path / "c.npy"), b)


def test_arrow(spark, tmp_path):
    path = str(tmp_path / "edges.arrow")
    e = spark.createDataFrame([(0.5, 2, 1), (0.25, 0, 3)], "weight double, source long, target long")
    sinks.write_edges(e, path)
    with pa.memory_map(path) as f:
        assert pa.ipc.open_file(f).schema == sinks.EDGES
    assert [tuple(r) for r in spark.read.format("arrow_ipc").options(path=path).load().collect()] == [(0.25, 0, 3), (0.5, 2, 1)]
    k = spark.createDataFrame([(0, [0, 1], [0.0, 0.5]), (1, [1, 0], [0.0, 0.5])], "idx long, index array<long>, dist array<double>")
    sinks.write_knn(k, path, 2)
    assert spark.read.format("arrow_ipc").options(path=path).load().count() == 2


def test_id_buffer(spark, tmp_path):
    sinks.write_id_buffer(spark.createDataFrame([(7,), (3,)], "id long"), str(tmp_path / "ids.buffer"))
    assert np.fromfile(tmp_path / "ids.buffer", "<u4").tolist() == [3, 7]


def test_map_nodes(spark, tmp_path):
    ids = spark.createDataFrame([(5, 0), (6, 1)], "id long, idx long")
    pos = spark.createDataFrame([(0, 0.5, 1.0), (1, 2.0, 3.0)], "idx long, x double, y double")
    col = spark.createDataFrame([(0, 9), (1, 8)], "idx long, color int")
    assert sinks.write_sqlite_nodes(sinks.map_nodes(ids, pos, col), str(tmp_path / "map.sqlite")) == 2
    with pytest.raises(ValueError):
        sinks.map_nodes(ids, pos.limit(1), col)


def test_stream(spark, tmp_path):
    folder = str(tmp_path / "edges")
    spark.createDataFrame([(0, 1), (1, 0), (0, 0)], "source long, target long").write.parquet(folder)
    stream = spark.readStream.schema("source long, target long").parquet(folder)
    q = streams.running_degrees(stream).writeStream.outputMode("complete").format("memory").queryName("deg").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("deg").collect())) == [(0, 2, 2), (1, 1, 1)]


def test_stated_kinds_are_checked(spark, tmp_path):
    path = str(tmp_path / "nodes.arrow")
    sinks.write_nodes(spark.createDataFrame([(1, 2, 3)], "id long, in_deg long, out_deg long"), path)
    load = lambda kind: spark.read.format("arrow_ipc").options(path=path, kind=kind).load()
    assert load("nodes").count() == 1
    for kind in ("edges", "knn"):
        with pytest.raises(Exception, match="wanted is"):
            load(kind).count()
