import io
import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasieve.functions import geo
from terrasieve.operators import evaluate, fit, matching, profile, quality, resolve, views
from terrasieve.sources import readers, sinks
from terrasieve.streaming import incremental


def test_position_quality(spark):
    rows = [("a", "x"), ("b", "x"), ("b", "x"), ("c", "x"), ("c", "y"), ("d", ""), ("d", ""), ("e", "x"), ("e", ""), ("f", "")]
    got = quality.position_quality(spark.createDataFrame(rows, "p string, adr string"), ["p"], "adr").select("p", "POS_N", "POS_QUALITY").distinct().collect()
    assert {tuple(r) for r in got} == {("a", 1, "unique"), ("b", 2, "site"), ("c", 2, "fallback"), ("d", 2, "fallback"), ("e", 2, "fallback"), ("f", 1, "unique")}


def test_ranked_matching(spark):
    towns = [("M1", "中町"), ("M1", "上中町本"), ("M2", "中町"), ("M3", "厚田区聚富"), ("M3", "本町一丁目"), ("M3", "本町二丁目")]
    keys = spark.createDataFrame([("P", k, m, i) for i, (m, k) in enumerate(towns)], "scope string, key string, muni string, ord int")
    units = spark.createDataFrame([(1, "P", ["中町", "上中町本"]), (2, "P", ["中町"]), (3, "P", ["聚富"]), (4, "P", [])], "unit int, scope string, cands array<string>")
    got = {r.unit: r for r in matching.first_unique(units, keys, "unit", "scope", "muni", "ord").collect()}
    assert (got[1].status, got[1].match, got[1].used_cand) == ("unique", "M1", "上中町本")
    assert (got[2].status, got[2].n_groups, got[2].groups) == ("ambiguous", 2, "M1,M2")
    assert got[3].status == "unmatched" and got[4].status == "no_candidate"
    late = spark.createDataFrame([(3, "P", ["聚富"]), (5, "P", ["町本"]), (6, "P", ["中町本"])], "unit int, scope string, cands array<string>")
    names = spark.createDataFrame([("P", m, n) for m, n in towns], "scope string, muni string, name string")
    found = {r.unit: (r.match, r.level, r.n_entries) for r in matching.suffix_unique(late, names, "unit", "scope", "muni", "name").collect()}
    assert found == {3: ("M3", "town", 1), 5: ("M1", "town", 1)}
    twice = names.unionByName(names.filter("name = '厚田区聚富'"))  # two entries of one name
    assert {r.unit: (r.level, r.n_entries) for r in matching.suffix_unique(late, twice, "unit", "scope", "muni", "name").collect()}[3] == ("oaza", 2)


def test_exact_before_prefix(spark):
    towns = spark.createDataFrame([("M3", 1, "本町一丁目", "本町", 1.0, 1.0), ("M3", 2, "本町二丁目", "本町", 3.0, 1.0), ("M3", 3, "厚田区聚富", "厚田区聚富", 2.0, 2.0)], "muni string, town int, full string, short string, lon double, lat double")
    units = spark.createDataFrame([(1, "M3", ["本町"]), (2, "M3", ["厚田"]), (3, "M3", ["無"])], "unit int, muni string, cands array<string>")
    got = {r.unit: (r["mode"], r.n, r.lon, round(r.spread_km, 3)) for r in matching.exact_then_prefix(units, towns, "unit", "muni", geo.centroid_spread("lon", "lat")).collect()}
    assert got == {1: ("exact", 2, 2.0, round(111.32 * np.cos(np.radians(1.0)), 3)), 2: ("prefix", 1, 2.0, 0.0)}


def test_provenance_and_expand(spark):
    rows = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "")], "row_id int, key string")
    found = spark.createDataFrame([("k1", "A", "town", None, None, None, 35.5, 139.25, None), ("k2", "B", None, None, "no_adr", None, None, None, None)], "key string, track string, status_a string, refined string, status_b string, suffix_level string, lat double, lon double, spread_km double")
    got = {r.row_id: (r.level, r.method, r.confidence, r.GC_LAT) for r in resolve.expand(rows, resolve.provenance(found), "key").collect()}
    assert got == {1: ("town", "A_normalize", "high", "35.500000"), 2: ("none", "B_no_adr", "", ""), 3: ("none", "no_pref", "", "")}
    assert resolve.orphans(found, rows.filter("row_id = 1"), "key").count() == 1


def test_offsets_of_known_pairs(spark):
    df = spark.createDataFrame([(35.71434773944512, 139.96008245611378, 35.713181, 139.959076)], "lat double, lon double, tlat double, tlon double")
    n, e = geo.offsets(F.col("lat"), F.col("lon"), F.col("tlat"), F.col("tlon"))
    d = geo.haversine(F.col("lat"), F.col("lon"), F.col("tlat"), F.col("tlon"), 6371008.8)
    assert tuple(round(x) for x in df.select(n, e, d).first()) == (130, 91, 158)


def test_exact_percentiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=3000), "b": rng.integers(0, 4, 2500).astype(float), "c": np.array([3.0]), None: rng.exponential(size=40)}
    df = spark.createDataFrame([(g, float(v)) for g, values in groups.items() for v in values] + [("a", None)], "g string, v double")
    for close in (evaluate.CLOSE, 200):  # at 200 the groups are large enough to be ranked around the quantiles only
        monkeypatch.setattr(evaluate, "CLOSE", close)
        got = {r.g: (r.low, r.mid, r.high) for r in evaluate.exact_percentiles(df, "g", "v", {"low": 0.0, "mid": 0.5, "high": 0.93}).collect()}
        assert got.keys() == groups.keys()
        for g, values in groups.items():
            assert got[g] == pytest.approx(tuple(np.quantile(values, [0, 0.5, 0.93])))


def test_nearest_however_far(spark):
    rng = np.random.default_rng(6)
    refs, points = rng.normal(size=(200, 2)), np.vstack([rng.normal(size=(300, 2)), [[50.0, -80.0], [1000.0, 3.0]]])
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)] + [(999, None, 1.0), (998, float("nan"), 1.0)], "i int, x double, y double")
    r = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(refs)], "ref int, x double, y double")
    far = np.hypot(points[:, None, 0] - refs[None, :, 0], points[:, None, 1] - refs[None, :, 1])
    got = {x.i: (x.ref, x.distance) for x in matching.nearest(p, r, 0.1, "i", "ref").collect()}
    assert got == {i: (int(far[i].argmin()), pytest.approx(far[i].min())) for i in range(len(points))}
    assert matching.nearest(p, r.limit(0), 0.1, "i", "ref").count() == 0


def test_external_answers(spark):
    tries = spark.createDataFrame([(1, 0, 2, 1.0, 1.0), (1, 1, 3, 2.0, 2.0), (1, 2, 8, 9.0, 9.0), (2, 0, 2, 3.0, 3.0), (2, 1, 2, 4.0, 4.0)], "unit int, pos int, point_level int, lon double, lat double")
    assert {(r.unit, r.status, r.lon) for r in resolve.external_best(tries, "unit").collect()} == {(1, "town", 2.0), (2, "city", 3.0)}


def test_numeric_guard(spark):
    df = spark.createDataFrame([("1.5",), ("",)], "h string")
    assert [r.h for r in quality.numeric(df, ["h"]).collect()] == [1.5, None]
    worse = df.unionByName(spark.createDataFrame([("1d",)], "h string"))
    with pytest.raises(Exception, match="text that is no number"):
        quality.numeric(worse, ["h"]).collect()
    with pytest.raises(ValueError):
        quality.numeric(worse, ["h"], 0.2)
    assert [r.h for r in quality.numeric(worse, ["h"], 0.5).collect()] == [1.5, None, None]


def test_views_and_selected_total(spark):
    df = spark.createDataFrame([("unique", -1.0, 5.0, "a"), ("unique", 0.4, None, "b"), ("fallback", 2.0, 40.0, "c"), ("unique", None, 60.0, "a")], "POS_QUALITY string, ADR_DIST_KM_N double, DEP double, k string")
    steps = views.Steps("ADR_DIST_KM_N", 0, (0.5, 1, 2, 5))
    assert [r.b for r in df.select(steps.bin().alias("b")).collect()] == ["nodata", "0", "3", "nodata"]
    count = lambda **k: df.filter(views.FilterState(**k).predicate()).count()
    assert (count(), count(include_unknown=True), count(include_unknown=True, min_depth=5), count(classes=frozenset())) == (1, 3, 2, 0)
    assert df.filter(views.Categories("k", ("a",)).only("__other__")).count() == 2
    cube = spark.createDataFrame([("unique", 36415, 15452), ("site", 5351, 3241), ("fallback", 16081, 5662)], "cls string, n long, n_resolved long")
    assert tuple(views.selected_total(cube, views.FilterState()).first()) == (15452, True)
    assert tuple(views.selected_total(cube, views.FilterState(include_unknown=True, min_depth=1)).first()) == (36415, False)
    known = df.withColumns({"cls": F.lit("unique"), "use": F.col("k"), "year": F.when(F.col("k") == "a", 0).otherwise(1981)})
    stats = json.loads(sinks.stats_json(views.viewer_stats(known, "cls", "use", "ADR_DIST_KM_N", "year", range(4, 10))))
    assert stats["total"] == 4 and stats["posQuality"] == {"unique": 4} and sum(stats["use"].values()) == 4 and (stats["minzoom"], stats["maxzoom"]) == (4, 9)
    assert stats["nenRange"] == [1981, 1981] and stats["distResolved"] == stats["posQualityDistResolved"]["unique"]


def test_profile_and_placed_rows(spark):
    good = ["title\n緯　度,経度,井戸深度,所 在 地\n35.1,139.2,10,東町1-2\n", "name,location,住所\na,\"35.5,139.5\",西町1-1\n"]
    bad = "緯度,経度,深さ\n,,150\n44,150,3\n"
    raw = spark.createDataFrame([("a", good[0].encode("cp932")), ("b", good[1].encode("utf-8-sig")), ("c", bad.encode())], "path string, content binary")
    cells = readers.csv_cells(raw)
    got = {r.file: (r.has_place, r.has_depth, r.usable) for r in profile.usable(cells).collect()}
    assert got["a"] == (True, True, True) and got["b"] == (True, False, False) and got["c"] == (True, True, True)
    answers = spark.createDataFrame([("南町1", 36.0, 140.0)], "address string, g_lat double, g_lon double")
    more = spark.createDataFrame([("d", 0, ["住所", "x"]), ("d", 1, ["南町1", "y"]), ("d", 2, ["無", "y"])], "file string, row_no long, cells array<string>")
    placed = {(r.file, r.row_no): (r.lat, r.lon, r.source) for r in profile.placed_rows(cells.unionByName(more), answers).collect()}
    assert placed[("a", 2)] == (35.1, 139.2, "original") and placed[("b", 1)] == (35.5, 139.5, "original") and placed[("d", 1)] == (36.0, 140.0, "geocoded")
    assert ("d", 2) not in placed


def _zip(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def _dbf(fields, rows):
    size = 1 + sum(n for _, n in fields)
    head = struct.pack("<BBBBIHH20x", 3, 103, 1, 1, len(rows), 32 + 32 * len(fields) + 1, size)
    head += b"".join(struct.pack("<11sc4xBB14x", name.encode("cp932"), b"C", n, 0) for name, n in fields) + b"\r"
    return head + b"".join(b"*" + b"".join(v.encode("cp932").ljust(n) for v, (_, n) in zip(r, fields)) for r in rows)


def test_point_shapes_and_registry(spark, tmp_path):
    points = b"".join(struct.pack(">2i", i, 10) + struct.pack("<i2d", 1, x, y) for i, (x, y) in enumerate([(139.5, 35.5), (140.0, 36.0)]))
    head = struct.pack(">i20xi", 9994, 50 + len(points) // 2) + struct.pack("<2i8d", 1000, 1, *[0.0] * 8)
    shapes = _zip({"p.shp": head + points, "p.dbf": _dbf([("ADR", 10), ("DEP", 5)], [("東町", "10"), ("西町", "")])})
    got = readers.point_shapes(spark.createDataFrame([("p.zip", shapes)], "path string, content binary")).orderBy("row_no").collect()
    assert [(r.lon, r.lat, r.attributes) for r in got] == [(139.5, 35.5, {"ADR": "東町", "DEP": "10"}), (140.0, 36.0, {"ADR": "西町", "DEP": ""})]
    for k in (1, 2):
        header = "\t".join(f"C{i}" for i in range(47))
        line = "\t".join([str(k), "101", "町"] + ["x"] * (44 + k % 2))
        (tmp_path / f"{k}.zip").write_bytes(_zip({"a.dat": f"{header}\r\n{line}\r\n\r\n".encode("cp932")}))
    zips = readers.files(spark, f"{tmp_path}/*.zip", "504b")
    rows = readers.registry(zips).orderBy("file").collect()
    assert [(r.C0, r.C2, r.C32, len(r)) for r in rows] == [("1", "町", "xx", 49), ("2", "町", "x", 49)]


def test_polygons(spark):
    ring = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]
    body = struct.pack("<i4d3i", 5, 0, 0, 2, 2, 1, len(ring), 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    shp = bytes(100) + struct.pack(">2i", 1, len(body) // 2) + body
    raw = spark.createDataFrame([("n.zip", _zip({"n.shp": shp, "n.dbf": _dbf([("CODE", 5)], [("01101",)])}))], "path string, content binary")
    got = readers.polygon_vertices(raw, "CODE").orderBy("pos").collect()
    assert [(r.x, r.y) for r in got] == ring and got[0].code == "01101"
    inside = spark.range(1).select(geo.in_ring(F.lit(1.0), F.lit(1.0), ring[:-1]), geo.in_ring(F.lit(3.0), F.lit(1.0), ring[:-1])).first()
    assert tuple(inside) == (True, False)


def test_csv_json_and_geoparquet(spark, tmp_path):
    df = spark.createDataFrame([("a,b", ""), ('say "x"', "2")], "t string, n string")
    sinks.write_csv(df, f"{tmp_path}/csv")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "csv").glob("part-*"))
    assert b'"a,b",\r\n' in raw
    back = readers.text_csv(spark, f"{tmp_path}/csv", ["t", "n"])
    assert {tuple(r) for r in back.collect()} == {("a,b", ""), ('say "x"', "2")}
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{broken\n\n{"a": 2}\n')
    assert [r.a for r in readers.json_lines(spark, f"{tmp_path}/l.jsonl", "a int", tolerant=True).collect()] == [1, 2]
    (tmp_path / "api.json").write_text(json.dumps({"data": [{"pref": "北", "cities": [{"code": 11011, "city": "札", "point": [141.0, 43.0]}, {"code": 11029, "city": "小"}]}]}))
    assert {(r.MUNI_CD, r.county, r.lon) for r in readers.address_cities(spark, f"{tmp_path}/api.json").collect()} == {("01101", "", 141.0), ("01102", "", None)}
    places = spark.createDataFrame([(1, 139.5, 35.5), (2, None, 35.0)], "id int, lon double, lat double")
    sinks.write_geoparquet(places, "lon", "lat", f"{tmp_path}/geo")
    import pyarrow.parquet as pq

    file = next((tmp_path / "geo").glob("*.parquet"))
    assert json.loads(pq.read_schema(file).metadata[b"geo"])["primary_column"] == "geometry"
    row = spark.read.parquet(f"{tmp_path}/geo").first()
    assert struct.unpack("<BI2d", row.geometry) == (1, 1, 139.5, 35.5) and row.bbox.xmin == 139.5
    line = json.loads(sinks.features(places.filter("id = 1"), "lon", "lat", ["id"]).first().value)
    assert line["geometry"]["coordinates"] == [139.5, 35.5]


def test_resume_stream(spark, tmp_path):
    src, out, tried = tmp_path / "in", f"{tmp_path}/out", tmp_path / "tried"
    src.mkdir()
    tried.mkdir()

    def work(row):
        (tried / f"{row['k']}-{len(list(tried.glob(str(row['k']) + '-*')))}").touch()
        if row["k"] == 9:
            raise ValueError("a service is down")
        return None if row["k"] == 8 else {"done": row["k"] * 2}

    for n, keys in enumerate(([1, 2, 8, None], [2, 3, 9, 1], [9, 8])):
        (src / f"{n}.json").write_text("\n".join(json.dumps({"k": k}) for k in keys))
        incremental.run_available(spark, str(src), "k long", out, f"{tmp_path}/check", work, "done long", "k")
    assert sorted((r.key, r.done, r.tries, r.failed) for r in spark.read.parquet(out).collect()) == [("1", 2, 1, False), ("2", 4, 1, False), ("3", 6, 1, False), ("8", None, 3, True), ("9", None, 3, True)]
    assert len(list(tried.iterdir())) == 9  # three keys once, two thrice


def test_affine_by_sums(spark):
    rng = np.random.default_rng(0)
    places, m = rng.random((300, 2)) * [2, 1.5] + [139, 35], np.array([[1.01, 0.02], [-0.02, 0.99], [3.0, -2.0]])
    noisy = places @ m[:2] + m[2] + rng.normal(size=(300, 2)) * 0.01
    rows = [("g", *map(float, p), *map(float, q)) for p, q in zip(places, noisy)] + [("line", float(i), 2.0 * i, 1.0, 1.0) for i in range(9)] + [("few", 0.0, 0.0, 1.0, 1.0)]
    got = {r.sheet: r.coefficients for r in fit.affine_by_centroids(spark.createDataFrame(rows, "sheet string, x double, y double, u double, v double"), "sheet").collect()}
    want = np.linalg.lstsq(np.c_[places, np.ones(300)], noisy, rcond=None)[0]
    assert set(got) == {"g"} and np.allclose(np.array(got["g"]).reshape(3, 2), want, atol=1e-6)


def test_reports(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 9.0)], "lvl string, e double")
    got = {r.level: (r.n, r.median, r.p90, r.worst) for r in evaluate.error_stats(df, "lvl", "e").collect()}
    assert got == {"a": (3, 2.0, 3.6, 4.0), "b": (1, 9.0, 9.0, 9.0), "overall": (4, 3.0, 7.5, 9.0)}
    assert evaluate.spaced_sample(spark.range(1000), ["id"], 1000, 10).count() == 10


def test_page_elements(spark):
    spans = spark.createDataFrame([("f", " ● ", 0.0, 0.0, 2.0, 2.0, 1, 9.0), ("f", "x", 0.0, 0.0, 2.0, 2.0, 1, 9.0)], "font string, text string, x0 double, y0 double, x1 double, y1 double, color int, size double")
    assert [(r.x, r.y) for r in readers.page_markers(spans, "f", "●").collect()] == [(1 - 0.036, 1 - 0.609)]
    box = [(100.0, 100.0), (200.0, 100.0), (200.0, 200.0), (100.0, 200.0)]
    strokes = spark.createDataFrame([(1, box), (2, [(100.0, 100.0), (150.0, 180.0), (160.0, 170.0), (170.0, 120.0)]), (3, [(5.0, 100.0), (50.0, 80.0)])], "i int, p array<struct<x:double,y:double>>")
    assert {r.i: r.d for r in strokes.select("i", readers.is_decoration(F.col("p"), 600, 800).alias("d")).collect()} == {1: True, 2: False, 3: True}


def test_sheets(spark):
    from terrasieve.operators import pages

    spans = spark.createDataFrame([(1, "12", 0.0, 5.0, 10.0), (1, ",札", 5.5, 9.0, 10.2), (1, "x", 30.0, 33.0, 10.1), (1, "y", 0.0, 3.0, 20.0)], "page int, text string, x0 double, x1 double, y double")
    assert [r.text for r in pages.merged_spans(spans, "page").orderBy("y", "x").collect()][-1] == "y"
    rng = np.random.default_rng(4)
    rows = [(2, "12", 0.0, 5.0, 10.04), (2, ",A", 5.5, 9.0, 10.01), (2, ",3", 9.5, 12.0, 10.9), (2, ",4", 12.0, 15.0, 11.3)]  # the fourth is too far below the first
    rows += [(int(p), f"t{i}", float(x), float(x) + 5, float(y)) for i, (p, x, y) in enumerate(zip(rng.integers(3, 6, 300), rng.integers(0, 40, 300) * 2.6, rng.integers(0, 60, 300) * 0.37))]
    want = []
    for page in sorted({r[0] for r in rows}):
        run = None
        for _, text, x0, x1, y in sorted((r for r in rows if r[0] == page), key=lambda r: (round(r[4], 1), r[2], r[4], r[3], r[1])):
            if run and abs(y - run[3]) < 1 and -1 <= x0 - run[2] < 2:
                run[1], run[2] = run[1] + text, x1
            else:
                run = [page, text, x1, y]
                want.append(run)
    got = pages.merged_spans(spark.createDataFrame(rows, "page int, text string, x0 double, x1 double, y double"), "page").collect()
    assert sorted((r.page, r.text, r.x1, r.y) for r in got) == sorted(map(tuple, want)) and "12,A,3" in {r.text for r in got}
    far, near = [(100.0, 100.0), (500.0, 300.0), (520.0, 130.0), (90.0, 310.0)], [(100.0, 100.0), (110.0, 120.0)]
    strokes = spark.createDataFrame([(1, 0.5, far), (1, 0.2, near)], "page int, pen double, points array<struct<x:double,y:double>>")
    assert {r.pen for r in pages.boundary_cloud(strokes, "page", 600.0, 800.0).collect()} == {0.5}
    square = [("a", 1, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)])]
    got = pages.ring_centroids(spark.createDataFrame(square, "code string, ring int, pos int, x double, y double"), "code").first()
    assert (got.area, got.x, got.y) == (4.0, 1.0, 1.0)


def test_scales(spark):
    m = [1 / 2.0 / 111.320 / np.cos(np.radians(35.7)), 0.0, 0.0, -1 / 2.0 / 110.574, 139.0, 36.5]
    df = spark.createDataFrame([([float(x) for x in m],)], "c array<double>")
    assert df.select(fit.scale_plausible(F.col("c"), F.lit(2.0), F.lit(35.7))).first()[0] and not df.select(fit.scale_plausible(F.col("c"), F.lit(2.5), F.lit(35.7))).first()[0]
    boxes = spark.createDataFrame([(0.0, 0.0, 10.0, 20.0, 139.0, 35.0, 140.0, 36.0)], "x0 double, y0 double, x1 double, y1 double, u0 double, v0 double, u1 double, v1 double")
    assert np.allclose(fit.affine_by_boxes(boxes).first().coefficients, [0.1, 0, 0, -0.05, 139.0, 36.0])


def test_geoparquet_commits(spark, tmp_path):
    import pyarrow.parquet as pq

    rng, path = np.random.default_rng(3), f"{tmp_path}/geo"
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((50_000, 2)) * [4, 3] + [137, 34])]
    df = spark.createDataFrame(rows, "id int, lon double, lat double")
    sinks.write_geoparquet(df, "lon", "lat", path)
    box = (138.0, 35.0, 138.2, 35.1)
    got = sinks.read_geoparquet(spark, path, box)
    assert sorted(r.id for r in got.select("id").collect()) == [i for i, x, y in rows if box[0] <= x <= box[2] and box[1] <= y <= box[3]]
    groups = [pq.ParquetFile(f).metadata.row_group(g) for f in sorted((tmp_path / "geo").glob("part-*")) for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    spans = [{c.path_in_schema: (c.statistics.min, c.statistics.max) for c in (g.column(i) for i in range(g.num_columns)) if c.path_in_schema.startswith("bbox")} for g in groups]
    meets = sum(s["bbox.xmin"][0] <= box[2] and s["bbox.xmax"][1] >= box[0] and s["bbox.ymin"][0] <= box[3] and s["bbox.ymax"][1] >= box[1] for s in spans)
    assert 0 < meets < len(groups)  # the others are skipped by their statistics
    assert "bbox.xmin" in got._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    before = sorted(f.name for f in (tmp_path / "geo").iterdir())
    broken = df.withColumn("lat", F.when(F.col("id") == 49_999, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("lat")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_geoparquet(broken, "lon", "lat", path)
    assert sorted(f.name for f in (tmp_path / "geo").iterdir()) == before  # nothing is left of it, and nothing is gone
    sinks.write_geoparquet(df.limit(10), "lon", "lat", path, append=True)
    assert spark.read.parquet(path).count() == 50_010
    sinks.write_geoparquet(df.limit(5), "lon", "lat", path)
    assert spark.read.parquet(path).count() == 5 and not list((tmp_path / "geo").glob("_temporary"))


def test_feature_collection_is_one_document(spark, tmp_path):
    rows = [(i, i % 3, 139 + i / 100, 35.0) for i in range(40)] + [(99, 0, None, 35.0)]
    df = spark.createDataFrame(rows, "id int, source int, lon double, lat double")
    for some in (df, df.limit(0)):
        path = tmp_path / f"fc{some.count()}"
        sinks.write_feature_collection(some, "lon", "lat", ["id", "source"], ["source", "id"], str(path))
        parts = sorted(path.glob("part-*"))
        data = b"".join(p.read_bytes() for p in parts)
        manifest = json.loads(next(path.glob("_manifest*")).read_text())
        assert manifest["bytes"] == len(data) and [e["bytes"] for e in manifest["parts"]] == [p.stat().st_size for p in parts]
        ids = [int(f["properties"]["id"]) for f in json.loads(data)["features"]]
        assert ids == [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0])) if r[2] is not None and some is df]


def test_csv_records_over_block_ends(spark, tmp_path):
    from terrasieve.sources import blocks

    rng = np.random.default_rng(5)
    cells = ["", "a", 'say "x"', "two\nlines", "three\n\n\nlines", '"', "\r\n", ",", "日本\n,\"", " pad "]
    rows = [(i, cells[int(k)] * int(n), cells[int(m)]) for i, (k, n, m) in enumerate(zip(rng.integers(0, 10, 3000), rng.integers(0, 4, 3000), rng.integers(0, 10, 3000)))]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    sinks.write_csv(df.coalesce(1), f"{tmp_path}/csv")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997b")  # many blocks, which begin in the midst of cells
    try:
        lines = blocks.physical_lines(spark, f"{tmp_path}/csv")
        assert lines.select("block").distinct().count() > 30
        back = blocks.csv_by_blocks(spark, f"{tmp_path}/csv", "id int, a string, b string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted((r.id, r.a or "", r.b or "") for r in back) == rows
    assert [r.record for r in sorted(back, key=lambda r: r.id)] == list(range(1, 3001))


def test_tiles_keep_to_the_cap(spark):
    from terrasieve.operators import tiles

    crowd = [(i, 139.5, 35.5) for i in range(400)] + [(1000 + i, 139 + i / 50, 35 + i / 70) for i in range(100)] + [(2000, None, 35.0)]
    kept = tiles.pyramid(spark.createDataFrame(crowd, "id int, lon double, lat double"), "lon", "lat", range(4, 8), F.lit(10), F.col("id"), 1200).cache()
    weights = {tuple(r)[:3]: r.w for r in kept.groupBy("z", "tx", "ty").agg(F.sum("bytes").alias("w")).collect()}
    assert max(weights.values()) == 1200
    shown = {r.id for r in kept.filter("z = 4").collect()}
    assert set(range(1000, 1100)) <= shown and len(shown) == 120  # the crowd goes first
    assert {r.n for r in kept.filter("id = 399").groupBy("z").agg(F.count("*").alias("n")).collect()} == {1}


def test_entries_are_aggregated_once_a_key(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    counted = F.udf(count, "double")
    towns = spark.createDataFrame([("M", t, f"本町{t}", f"本町{t}", float(t)) for t in range(40)], "scope string, town int, full string, short string, lon double")
    units = spark.createDataFrame([(u, "M", ["本町"]) for u in range(50)], "unit int, scope string, cands array<string>")
    got = matching.exact_then_prefix(units, towns, "unit", "scope", [F.sum(counted("lon")).alias("lon")]).collect()
    assert sorted((r.unit, r["mode"], r.lon) for r in got) == [(u, "prefix", 780.0) for u in range(50)]
    assert seen.value < 50 * 40 / 4  # every unit with every town


def test_band_nearest_carries_what_is_kept(spark):
    left, right = spark.createDataFrame([(1, 1, 5.0)], "a int, k int, u double"), spark.createDataFrame([(7, 1, 6.0), (8, 1, 4.5)], "b int, k int, s double")
    got = matching.band_nearest(left, right, ["k"], [(F.col("u"), F.col("s"), 2)], F.abs(F.col("u") - F.col("s")), "a", ["b"], keep=[])
    assert got.columns == ["a", "distance", "b"] and [tuple(r) for r in got.collect()] == [(1, 0.5, 8)]
