"""Tile covers and clipped parts against tests of every tile."""

import itertools
import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from millrace.operators import tiles
from millrace.plans import registry
from pyspark.sql import functions as F

RNG = np.random.default_rng(5)


def degrees(points, n):
    """Back from tile units at n tiles a side."""
    x, y = np.asarray(points, float).T / n
    return np.stack([x * 360 - 180, np.degrees(np.arctan(np.sinh(math.pi * (1 - 2 * y))))], axis=1)


def wkt(points, n=16, kind="LINESTRING"):
    text = ", ".join(f"{x!r} {y!r}" for x, y in degrees(points, n).tolist())
    return f"LINESTRING ({text})" if kind == "LINESTRING" else f"POLYGON (({text}))"


def cover(spark, texts, zoom=4):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, g string")
    out = {}
    for r in tiles.clip_tiles(df, "g", zoom, extent=1.0).collect():
        assert (r.tile_x, r.tile_y) not in out.setdefault(r.id, {})
        out[r.id][r.tile_x, r.tile_y] = r.part
    return out


def inside(points, ring):
    """Crossings of a ray with a ring."""
    x, y = points.T
    odd = np.zeros(len(points), bool)
    for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0)):
        if ay != by:
            odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return odd


def test_lines(spark):
    paths = [RNG.uniform(0, 16, (RNG.integers(2, 7), 2)) for _ in range(40)]
    got = cover(spark, [wkt(p) for p in paths])
    for i, path in enumerate(paths):
        expected = set()
        for a, b in zip(path, path[1:]):
            for x, y in itertools.product(range(16), range(16)):
                t = np.sort(np.stack([([x, y] - a) / (b - a), ([x + 1, y + 1] - a) / (b - a)]), axis=0)
                if min(1, *t[1]) - max(0, *t[0]) > 1e-9:
                    expected.add((x, y))
        assert set(got[i]) == expected
        total = sum(tiles.measures_wkt(p)[0] for p in got[i].values())
        assert math.isclose(total, np.hypot(*np.diff(path, axis=0).T).sum(), rel_tol=1e-9)


def test_polygons(spark):
    rings, holes = [], []
    for _ in range(12):
        turn, reach = np.sort(RNG.uniform(0, 2 * math.pi, 11)), RNG.uniform(2, 7, 11)
        rings.append(8 + np.stack([reach * np.cos(turn), reach * np.sin(turn)], axis=1))
        holes.append(8 + 0.3 * (rings[-1] - 8))
    close = lambda r: np.r_[r, r[:1]]
    texts = [f"{wkt(close(r), kind='POLYGON')[:-1]}, {wkt(close(h), kind='POLYGON')[len('POLYGON (') :]}" for r, h in zip(rings, holes)]
    got = cover(spark, texts)
    grid = (np.stack(np.meshgrid(np.arange(40), np.arange(40)), axis=-1).reshape(-1, 2) + 0.5) / 40
    for i, (ring, hole) in enumerate(zip(rings, holes)):
        for x, y in itertools.product(range(16), range(16)):
            share = (inside(grid + [x, y], ring) & ~inside(grid + [x, y], hole)).mean()
            area = tiles.measures_wkt(got[i].get((x, y)))[1] or 0.0
            assert abs(share - area) < 0.03
            assert area > 0 or (x, y) not in got[i]
        total = sum(tiles.measures_wkt(p)[1] for p in got[i].values())
        assert math.isclose(total, 0.91 * tiles._area(ring), rel_tol=1e-9)


def test_diagonal_crosses_few_tiles(spark):
    assert len(cover(spark, [wkt([[1.3, 2.1], [200.6, 221.9]], 256)], 8)[0]) == 199 + 219 + 1


def test_step_does_not_matter(spark, monkeypatch):
    texts = [wkt(RNG.uniform(0, 16, (5, 2))), wkt([[1, 1], [9.5, 1], [9.5, 7], [1, 7], [1, 1]], kind="POLYGON"), "POINT (10 20)"]
    by_four = cover(spark, texts, 7)
    monkeypatch.setattr(tiles, "STEP", 3)
    by_three = cover(spark, texts, 7)
    assert {i: set(v) for i, v in by_four.items()} == {i: set(v) for i, v in by_three.items()}
    assert len(by_four[1]) == 68 * 48 and len(by_four[2]) == 1


def test_borders_and_edges(spark):
    west = [f"LINESTRING ({x} 10, {x} 11)" for x in (0, 180, -180)]
    got = cover(spark, [*west, "POINT (180 -90)", "POINT (0 0)", "LINESTRING (-200 0.1, -170 0.1)", "POLYGON ((-180 -90, 180 -90, 180 90, -180 90, -180 -90))"], 2)
    assert [sorted({x for x, _ in got[i]}) for i in (0, 1, 2)] == [[2], [3], [0]]
    assert set(got[3]) == {(3, 3)} and set(got[4]) == {(2, 2)} and set(got[5]) == {(0, 1)}
    assert len(got[6]) == 16 and all(tiles.measures_wkt(p)[1] == 1.0 for p in got[6].values())
    assert math.isclose(tiles.measures_wkt(got[5][0, 1])[0], 10 / 90)


def test_hole_of_a_whole_tile_and_odd_shapes(spark):
    ring = lambda a, b: wkt([[a, a], [b, a], [b, b], [a, b], [a, a]], 4, "POLYGON")[len("POLYGON ") :]
    texts = [f"POLYGON {ring(0, 4)[:-1]}, {ring(1, 3)[1:]}", f"MULTIPOLYGON ({ring(0, 1)}, {ring(2, 3)})", "POLYGON ((1 1, 9 9, 1 1))", "LINESTRING (5 5, 5 5)", "MULTIPOINT ((1 1), (-100 1))", None, "POINT EMPTY", "geometrycollection (point (1 1), linestring (1 1, 2 2))"]
    got = cover(spark, texts, 2)
    assert len(got[0]) == 12 and set(got[1]) == {(0, 0), (2, 2)}
    assert got[2][2, 1].startswith("LINESTRING") and got[3][2, 1].startswith("POINT")
    assert len(got[4]) == 2 and 5 not in got and 6 not in got
    assert got[7][2, 1].startswith("GEOMETRYCOLLECTION (POINT (") and ", LINESTRING (" in got[7][2, 1]


def test_batches_are_cut_together(monkeypatch):
    """A thousand triangles take no more cuts than one, and each has what it has alone."""
    texts = [wkt(np.append(p := RNG.uniform(0, 16, 2) + RNG.normal(0, 1, (3, 2)), p[:1], axis=0), kind="POLYGON") for _ in range(1000)]
    cuts, side = [], tiles._side
    monkeypatch.setattr(tiles, "_side", lambda *a: cuts.append(1) or side(*a))
    together = tiles.cut_all(tiles.unpack_all(tiles._worlds(pa.array(texts))), 16)
    assert len(cuts) <= 16
    assert len(set(zip(together.row.tolist(), together.x.tolist(), together.y.tolist()))) == len(together.row) > 1000
    held = tiles.to_wkt(together, 1.0).to_pylist()
    for i in range(0, 1000, 50):
        alone = tiles.cut_all(tiles.unpack_all(tiles._worlds(pa.array(texts[i : i + 1]))), 16)
        mine = np.flatnonzero(together.row == i)
        assert list(zip(alone.x, alone.y, tiles.to_wkt(alone, 1.0).to_pylist())) == [(together.x[j], together.y[j], held[j]) for j in mine]


def test_measures_of_parts_with_and_without_their_texts(spark):
    hole = "POLYGON ((-50 -40, 60 -45, 50 70, -50 -40), (-10 -10, 20 -10, 10 20, -10 -10))"
    texts = [hole, "POLYGON ((-90 -60, 90 -60, 90 60, -90 60, -90 -60))", f"GEOMETRYCOLLECTION ({hole}, LINESTRING (-60 10, 80 20, 80 -70), POINT (3 4))", "MULTIPOLYGON (((0 0, 9 0, 9 9, 0 0)), ((1 1, 40 1, 40 40, 1 1)))", "POINT (1 1)", "LINESTRING (-200 3, 170 -4, 170 60)", "POLYGON ((1 1, 9 9, 1 1))", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, g string")
    place = lambda rows: {(r.id, r.tile_x, r.tile_y): (r.length, r.area) for r in rows}
    by_text = place(tiles.clip_tiles(df, "g", 6, 10.0).withColumn("m", tiles.measures(F.col("part"))).select("id", "tile_x", "tile_y", "m.*").collect())
    by_corners = place(tiles.measure_tiles(df, "g", 6, 10.0).collect())
    assert set(by_text) == set(by_corners) and len({i for i, _, _ in by_text}) == 7
    assert all(np.allclose(by_text[k], by_corners[k], rtol=1e-9, atol=1e-9) for k in by_text)
    one_by_one = [tiles.measures_wkt(t) for t in texts]
    assert [tuple(r.m) for r in df.select(tiles.measures(F.col("g")).alias("m")).collect()] == [(None, None) if m[0] is None else pytest.approx(m) for m in one_by_one]


def test_shapes_of_the_queries_have_all_digits(spark, tmp_path):
    """Customers whose shape's length or area lies at a rounding's edge."""
    keys = "(1024), (3148), (4390), (6333)"
    spark.sql(f"SELECT CAST(k AS BIGINT) AS c_custkey FROM VALUES {keys} t(k)").write.parquet(f"{tmp_path}/customer.parquet")
    got = registry.queries()["geo_08_tile_parts"](spark, str(tmp_path)).collect()
    sql = registry.oracle_sql()["geo_08_tile_parts"].replace("FROM customer", f"FROM (VALUES {keys}) t(c_custkey)")
    assert sorted(map(tuple, got)) == sorted(duckdb.sql(sql).fetchall())


def test_errors_empty_table_and_other_columns(spark):
    for bad in ("POINT (a b)", "hello", "POLYGON ((1 1, 2 2"):
        with pytest.raises(ValueError):
            tiles.parse_wkt(bad)
    df = spark.createDataFrame([(1, "POINT (0 0)")], "tile_x int, g string")
    assert tiles.cover_tiles(df, "g", 0).collect() == [(0, "POINT (0 0)", 0)]
    assert tiles.tile_features(df.filter(F.lit(False)), "g", 3).count() == 0
