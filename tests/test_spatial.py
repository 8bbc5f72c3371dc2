import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import spatial
from starloom.sources import sinks


@pytest.fixture(scope="module")
def three(spark):
    return spark.createDataFrame([(1, 10.0, 10.0), (2, 100.0, 100.0), (3, -50.0, -50.0)], "id long, x double, y double").cache()


AREA = spatial.Area(256.0)


def test_area(spark, three):
    assert spatial.area_of(three) == AREA
    assert spatial.area_of(three.limit(0)).side == 0


def test_tiles_of_the_fixture(three):
    t = spatial.tiles(three, 1)
    assert {r["path"]: r["total"] for r in t.collect()} == {"": 3, "0": 2, "00": 1, "02": 1, "2": 1}
    assert spatial.tiles(three.limit(0), 1).count() == 0


def test_paths_equal_the_recursive_cuts(spark):
    rng = np.random.default_rng(1)
    pts = [(i, float(np.float32(x)), float(np.float32(y))) for i, (x, y) in enumerate(rng.uniform(-128, 128, (200, 2)))]
    pts += [(900, 0.0, 0.0), (901, 128.0, 128.0), (902, -128.0, -128.0), (903, 0.0, -64.0), (904, 128.0, -128.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {r["id"]: r["p"] for r in spatial.floats(df).select("id", spatial.path(AREA, 6).alias("p")).collect()}
    for i, x, y in pts:
        area, want = AREA, ""
        for _ in range(6):
            d = area.locate(x, y)
            want, area = want + str(d), area.child(d)
        assert got[i] == want, (i, x, y)


def test_packed_tree_of_the_fixture():
    data = spatial.pack(np.array([1, 2, 3]), np.array([10, 100, -50]), np.array([10, 100, -50]), AREA)
    assert data.hex(" ", 12).split() == ["000001000000000004000000", "000003000000000002000000", "800000014120000041200000", "8000000242c8000042c80000", "80000003c2480000c2480000"]
    near = lambda *a: spatial.nearest_packed(data, AREA, *a)
    assert near(15, 15)[0] == 1 and abs(near(15, 15)[3] - 7.071068) < 1e-6 and near(10, 10)[0] == 1
    assert near(10, 10, True)[0] == 3 and abs(near(10, 10, True)[3] - 84.852814) < 1e-6
    with pytest.raises(ValueError):
        spatial.nearest_packed(b"", AREA, 0, 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-127, 127), st.integers(-127, 127)), min_size=1, max_size=60, unique=True), st.integers(-127, 127), st.integers(-127, 127))
def test_packed_nearest_equals_brute_force(points, x, y):
    xy = np.array(points, float)
    data = spatial.pack(np.arange(len(xy)), xy[:, 0], xy[:, 1], AREA)
    assert sorted(n[1:] for n in spatial.unpack(data) if n[0] == "leaf") == sorted((i, float(a), float(b)) for i, (a, b) in enumerate(points))
    d = np.hypot(xy[:, 0] - x, xy[:, 1] - y)
    assert spatial.nearest_packed(data, AREA, x, y)[0] == int(np.lexsort((np.arange(len(d)), d))[0])


def test_pack_errors():
    with pytest.raises(ValueError, match="one position"):
        spatial.pack(np.array([1, 2]), np.array([3, 3]), np.array([4, 4]), AREA)
    with pytest.raises(ValueError, match="outside"):
        spatial.pack(np.array([1]), np.array([500]), np.array([0]), AREA)


def test_too_many_equal_points_raise(spark):
    with pytest.raises(ValueError):
        spatial.tiles(spark.createDataFrame([(i, 1.0, 1.0) for i in range(4)] + [(9, 2.0, 2.0)], "id long, x double, y double"), 3)


def test_nearest(three):
    got = spatial.nearest(three, [(15, 15), (10, 10)]).orderBy("query").collect()
    assert [r["id"] for r in got] == [1, 1]
    assert spatial.nearest(three, [(10, 10)], exclusive=True).first()["id"] == 3
    assert spatial.nearest(three.limit(0), [(0, 0)]).first()["id"] is None


def test_closed_tiles_share_border_points(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 50.0), (3, -50.0, 50.0), (4, -50.0, -50.0), (5, 50.0, -50.0), (6, 60.0, 60.0)], "id long, x double, y double")
    area = spatial.Area(128.0)
    t = spatial.tiles(df, 3, area)
    got = {(r["path"], r["id"]) for r in spatial.tile_points(df, t, 3, area, F.lit(0), closed=True).collect()}
    assert {("0", 1), ("1", 1), ("2", 1), ("3", 1)} <= got
    assert {p for p, i in ((r["path"], r["id"]) for r in spatial.tile_points(df, t, 3, area, F.lit(0)).collect()) if i == 1 and p} == {"0"}


def test_tile_files(spark, three, tmp_path):
    t = spatial.tiles(three, 1, AREA).cache()
    points = spatial.tile_points(three, t, 1, AREA).withColumn("color", F.lit(0x3264C8))
    packed = spatial.packed_tiles(points, t, AREA)
    index = sinks.write_tiles(packed, t, str(tmp_path))
    assert (tmp_path / "tile-2-02-nodes").read_bytes().hex() == "0000204100002041c8643200"
    assert (tmp_path / "tile-2-02-atlas").read_bytes().hex() == "800000014120000041200000" and not (tmp_path / "tile-0-root-atlas").exists()
    assert json.loads((tmp_path / "index.json").read_text()) == index and index["ne"]["ne"]["id"] == "00" and index["nw"] is None
    assert sinks.tile_list(t).where("id = '0'").first()["sw"] == "02"
    assert spatial.digest(packed) == spatial.digest(spatial.packed_tiles(points.repartition(5), t, AREA))


def test_forces_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    xy = rng.uniform(-60, 60, (80, 2))
    df = spark.createDataFrame([(i, float(x), float(y), float(1 + i % 3)) for i, (x, y) in enumerate(xy)], "id long, x double, y double, mass double")
    got = spatial.forces(df, df, spatial.Area(128.0), level=5).orderBy("id").toPandas()
    p, m = xy.astype(np.float32).astype(float), 1.0 + np.arange(80) % 3
    for i in range(80):
        k = np.arange(80) != i
        delta = p[i] - p[k]
        d = np.hypot(*delta.T)
        want = ((m[i] * m[k] / d**3)[:, None] * delta).sum(0)
        assert np.allclose(got.loc[i, ["fx", "fy"]].to_numpy(float), want, rtol=0.15, atol=0.02 * np.abs(want).max() + 1e-4)


def test_bodies(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 2.0), (2, 1.0, 2.0, 3.0)], "id long, x double, y double, mass double")
    more = spatial.insert_bodies(df, df.limit(1))
    assert spatial.total_mass(more).first()[0] in (7.0, 8.0) and spatial.remove_bodies(df, df.where("id = 1")).count() == 1
    assert spatial.total_mass(df.limit(0)).first()[0] == 0


def test_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "v double")
    got = spatial.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r["n"] for r in got] == [100] * 9 + [101]
    assert spatial.histogram(df.limit(0), "v").count() == 0 and spatial.histogram(df.limit(1), "v").first()["n"] == 1
