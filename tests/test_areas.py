"""Areas as edges against brute force over all edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrasieve.operators import areas, matching, pages

EDGES = "code int, x1 double, y1 double, x2 double, y2 double"


def inside(x, y, edges):
    return sum((y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1) for x1, y1, x2, y2 in edges) % 2 == 1


def away(x, y, edges):
    best = math.inf
    for x1, y1, x2, y2 in edges:
        dx, dy = x2 - x1, y2 - y1
        t = max(0, min(1, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return best


def star(rng, cx, cy, r, n):
    at = [(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [(*a, *b) for a, b in zip(at, at[1:] + at[:1])]


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(4)
    return {1: star(rng, 0, 0, 10, 40), 2: star(rng, 3, 2, 8, 7) + star(rng, 3, 2, 2, 5), 3: star(rng, -40, 30, 0.2, 30), 4: [(-50, -50, 50, -50), (50, -50, 50, 50), (50, 50, -50, 50), (-50, 50, -50, -50)]}


@pytest.mark.parametrize("cell", [None, 0.37, 5.0, 400.0])
def test_containing(spark, shapes, cell):
    rng = random.Random(8)
    points = [(i, rng.uniform(-12, 12), rng.uniform(-12, 12)) for i in range(300)] + [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(300, 400)] + [(400, -40.01, 30.02)]
    edges = spark.createDataFrame([(c, *map(float, e)) for c, es in shapes.items() for e in es], EDGES)
    rows = spark.createDataFrame([*points, (900, None, 1.0), (901, float("nan"), 0.0), (902, float("inf"), 0.0)], "id int, x double, y double")
    got = {(r.id, r.code) for r in areas.containing(rows, edges, "id", cell).collect()}
    assert got == {(i, c) for i, x, y in points for c, es in shapes.items() if inside(x, y, es)}
    own = rows.withColumn("code", F.col("id") % 5)
    got = {r.id: (r.inside, r.distance_km) for r in areas.located(own.dropna(), edges, "id", cell=cell).collect()}
    for i, x, y in points:
        if i % 5 == 0:
            assert got[i] == (None, None)
        elif inside(x, y, shapes[i % 5]):
            assert got[i] == (True, 0.0)
        else:
            assert got[i][0] is False and got[i][1] == pytest.approx(111 * away(x, y, shapes[i % 5]), rel=1e-9)


def test_no_areas(spark):
    none = spark.createDataFrame([], EDGES)
    points = spark.createDataFrame([(1, 0.0, 0.0, 1)], "id int, x double, y double, code int")
    assert areas.containing(points.drop("code"), none, "id").count() == 0
    assert [tuple(r) for r in areas.located(points, none, "id").collect()] == [(1, None, None)]
    assert areas.dissolved(none).count() == 0 and areas.stitched(none).count() == 0


def squares(cells):
    return [(code, *e) for code, x, y in cells for e in ((x, y, x + 1, y), (x + 1, y, x + 1, y + 1), (x + 1, y + 1, x, y + 1), (x, y + 1, x, y))]


def test_dissolved_and_stitched(spark):
    ring = [(1, x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]  # a square with a hole
    touching = [(2, 10, 10), (2, 11, 11), (2, 11, 12)]  # two parts that meet at a corner
    long = [(3, x, 50) for x in range(200)]
    edges = areas.dissolved(spark.createDataFrame([(c, *map(float, e)) for c, *e in squares(ring + touching + long)], EDGES))
    rows = areas.stitched(edges).collect()
    rings = {}
    for r in rows:
        rings.setdefault((r.code, r.ring), {})[r.pos] = r
    shape = {}
    for (code, _), steps in rings.items():
        assert sorted(steps) == list(range(len(steps)))
        assert all((steps[i].x2, steps[i].y2) == (steps[(i + 1) % len(steps)].x1, steps[(i + 1) % len(steps)].y1) for i in steps)
        shape.setdefault(code, []).append((len(steps), sum(s.x1 * s.y2 - s.x2 * s.y1 for s in steps.values()) / 2))
    assert {c: sorted(v) for c, v in shape.items()} == {1: [(4, -1.0), (12, 9.0)], 2: [(4, 1.0), (6, 2.0)], 3: [(402, 200.0)]}
    for r in areas.inner_points(edges, ["code"]).collect():
        assert inside(r.x, r.y, [(e.x1, e.y1, e.x2, e.y2) for e in rows if e.code == r.code])
    sums = {r.code: (r.area, r.x, r.y) for r in areas.area_sums(edges, ["code"]).collect()}
    assert sums[1] == (8.0, 1.5, 1.5)


def test_ring_roles(spark):
    box = lambda ring, x, y, h: [(ring, i, float(x + a * h), float(y + b * h)) for i, (a, b) in enumerate([(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)])]
    nested = box(1, 0, 0, 10) + box(2, 0, 0, 8) + box(3, 0, 0, 6) + box(4, 3, 3, 1) + box(5, -3, -3, 1) + box(6, -3, -3, 0.5) + box(7, 40, 0, 2)
    vertices = spark.createDataFrame([(g, *v) for g in ("a", "b") for v in nested if g == "a" or v[0] != 1], "g string, ring int, pos int, x double, y double")
    got = {(r.g, r.ring): (r.depth, r.role, r.shell) for r in areas.ring_roles(areas.ring_edges(vertices, ["g", "ring"]), "g", "ring").collect()}
    a = {1: (0, "shell", 1), 2: (1, "hole", 1), 3: (2, "shell", 3), 4: (3, "hole", 3), 5: (3, "hole", 3), 6: (4, "shell", 6), 7: (0, "shell", 7)}
    b = {2: (0, "shell", 2), 3: (1, "hole", 2), 4: (2, "shell", 4), 5: (2, "shell", 5), 6: (3, "hole", 5), 7: (0, "shell", 7)}
    assert got == {**{("a", k): v for k, v in a.items()}, **{("b", k): v for k, v in b.items()}}


def test_nearest_with_a_far_crowd(spark):
    rng = random.Random(2)
    refs = [(i, 5000 + rng.random(), 5000 + rng.random()) for i in range(400)] + [(500, -3.0, 4.0), (501, -3.0, 4.0)]
    points = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(50)] + [(60, 4900.0, 5100.0), (61, 1e6, -1e6), (62, 5000.5, 5000.5), (63, None, 0.0)]
    got = {r.p: (r.ref, r.distance) for r in matching.nearest(spark.createDataFrame(points, "p int, x double, y double"), spark.createDataFrame(refs, "ref int, x double, y double"), 0.5, "p", "ref").collect()}
    for p, x, y in points:
        if x is None:
            assert p not in got
        else:
            want = min((math.hypot(x - a, y - b), r) for r, a, b in refs)
            assert got[p] == (want[1], pytest.approx(want[0]))


def test_legend_marker_by_lines(spark):
    rng = random.Random(3)
    texts = [(1, i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(80)]
    markers = [(1, f"c{i}", rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(60)]
    got = {r.t: (r.kind, r.left_by) for r in pages.legend_marker(spark.createDataFrame(texts, "page int, t int, x double, y double"), spark.createDataFrame(markers, "page int, kind string, mx double, my double"), "page", "t", "kind").collect()}
    want = {}
    for _, t, x, y in texts:
        near = [(x - mx, k) for _, k, mx, my in markers if mx < x and abs(my - y) < 6]
        if near:
            want[t] = min(near)[::-1]
    assert got == want


def test_band_nearest_by_buckets(spark):
    rng = random.Random(6)
    left = [(i, 1, rng.uniform(0, 50), rng.randrange(10)) for i in range(60)]
    right = [(i, 1, rng.uniform(0, 50), rng.randrange(10)) for i in range(80)]
    l, r = spark.createDataFrame(left, "a int, k int, u double, v int"), spark.createDataFrame(right, "b int, k int, s double, t int")
    got = {x.a: x.b for x in matching.band_nearest(l, r, ["k"], [(F.col("u"), F.col("s"), 6), (F.col("v"), F.col("t"), 3)], F.abs(F.col("u") - F.col("s")), "a", ["b"]).collect()}
    want = {a: min(near)[1] for a, _, u, v in left if (near := [(abs(u - s), b) for b, _, s, t in right if abs(u - s) <= 6 and abs(v - t) <= 3])}
    assert got == want


def test_many_long_edges_meet_few_points(spark):
    rng = random.Random(3)
    edges = spark.createDataFrame([(1, *[rng.uniform(0, 1) for _ in range(4)]) for _ in range(600)], EDGES)
    points = spark.createDataFrame([(i, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(20000)], "id int, x double, y double")
    cell = areas.cell_size(edges, points, [])
    at = points.select(F.floor(F.col("y") / cell).alias("row"), F.floor(F.col("x") / cell).alias("col"))
    met = at.join(areas.edge_cells(edges, cell), ["row", "col"]).count()
    assert met < 20000 * 600 / 20  # all pairs, as with cells of some edges' length
