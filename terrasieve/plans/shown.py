"""Queries on what is shown: themes, filters, counts, tiles, attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import numbers_in
from ..operators import tiles, views
from ..sources.sinks import compact_properties
from .places import QUALITY_SQL, parts_with_quality
from .registry import POINTS_SQL, points, query, table

SIZE = views.Steps("p_size", 2, (10, 20, 30, 40))
STATUS = views.Categories("o_orderstatus", ("F", "O"), name_other=True)
VIEW_SQL = f"SELECT *, CASE WHEN p_partkey % 4 = 0 THEN -1.0 ELSE (p_partkey % 100) / 10.0 END AS dist, p_size AS dep FROM ({QUALITY_SQL})"


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    dist = F.when(F.col("p_partkey") % 4 == 0, -1.0).otherwise((F.col("p_partkey") % 100) / 10.0)
    return parts_with_quality(spark, sf_dir).withColumns({"ADR_DIST_KM_N": dist, "DEP": F.col("p_size")})


@query("""
SELECT p_partkey, CASE WHEN p_size < 2 THEN 'nodata' WHEN p_size < 10 THEN '0' WHEN p_size < 20 THEN '1' WHEN p_size < 30 THEN '2' WHEN p_size < 40 THEN '3' ELSE '4' END AS bin FROM part
""")
def step_binning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-20."""
    return table(spark, sf_dir, "part").select("p_partkey", SIZE.bin().alias("bin"))


@query("SELECT CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE '__other__' END AS item, count(*) AS n FROM orders GROUP BY 1")
def category_binning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-19."""
    return table(spark, sf_dir, "orders").groupBy(STATUS.bin().alias("item")).agg(F.count("*").alias("n"))


@query("""
WITH i AS (SELECT unnest(range(6))::INT AS ord, unnest(['0', '1', '2', '3', '4', 'nodata']) AS item),
b AS (SELECT CASE WHEN p_size < 2 THEN 'nodata' WHEN p_size < 10 THEN '0' WHEN p_size < 20 THEN '1' WHEN p_size < 30 THEN '2' WHEN p_size < 40 THEN '3' ELSE '4' END AS item, count(*) AS n FROM part GROUP BY 1)
SELECT ord, item, coalesce(n, 0) AS n FROM i LEFT JOIN b USING (item)
""")
def legend_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-26."""
    return views.legend_counts(table(spark, sf_dir, "part"), SIZE)


@query(f"SELECT p_partkey FROM ({VIEW_SQL}) WHERE pos_quality IN ('unique', 'site') AND dist >= 0")
def filter_state_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-9."""
    state = views.FilterState(frozenset({"unique", "site"}))
    return _view(spark, sf_dir).filter(state.predicate()).select("p_partkey")


@query(f"SELECT p_partkey FROM ({VIEW_SQL}) WHERE pos_quality IN ('unique', 'site', 'fallback') AND (dist < 0 OR dist <= 1.25) AND dep >= 15")
def filter_state_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-9, PRJ-27."""
    state = views.FilterState(frozenset({"unique", "site", "fallback"}), max_distance=views.distance_at(6), include_unknown=True, min_depth=15)
    return _view(spark, sf_dir).filter(state.predicate()).select("p_partkey")


@query(f"SELECT p_partkey FROM ({VIEW_SQL}) WHERE pos_quality IN ('fallback', 'site') AND p_size >= 10 AND p_size < 20")
def filter_state_isolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-9, FLT-10, SET-3."""
    state = views.FilterState(frozenset({"fallback", "site"}), include_unknown=True, isolate="1", theme=SIZE)
    return _view(spark, sf_dir).filter(state.predicate()).select("p_partkey")


@query(f"SELECT pos_quality AS cls, count(*) AS n, count(*) FILTER (dist >= 0) AS n_resolved FROM ({VIEW_SQL}) GROUP BY 1")
def stats_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10, AGG-15, SNK-9."""
    return views.stats(_view(spark, sf_dir), "POS_QUALITY", "ADR_DIST_KM_N")


@query(f"SELECT count(*) FILTER (dist >= 0) AS n, true AS exact FROM ({VIEW_SQL}) WHERE pos_quality IN ('unique', 'fallback')")
def selected_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-16: from the counts of stats_crosstab alone."""
    cube = views.stats(_view(spark, sf_dir), "POS_QUALITY", "ADR_DIST_KM_N")
    return views.selected_total(cube, views.FilterState(frozenset({"unique", "fallback"})))


@query("""
WITH a AS (SELECT p_partkey, unnest([0, 1, 2, 3]) AS ord, unnest(['Name', 'Brand', 'Size', 'Left']) AS label,
  unnest([p_name, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END, p_size::VARCHAR, (p_partkey % 3)::VARCHAR || CASE WHEN p_partkey % 3 = 0 THEN ' *' ELSE '' END]) AS value FROM part)
SELECT p_partkey, ord, label, value FROM a WHERE value <> ''
""")
def unpivot_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-22."""
    p = table(spark, sf_dir, "part").withColumns({"p_brand": F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_brand")), "left": F.col("p_partkey") % 3})
    return views.attributes(p, "p_partkey", {"p_name": "Name", "p_brand": "Brand", "p_size": "Size", "left": "Left"}, ("left",))


@query("""
SELECT event_id, '{' || concat_ws(',', '"event_type":"' || event_type || '"', CASE WHEN user_id % 3 <> 0 THEN '"user":"' || user_id || '"' END, '"id":"' || event_id || '"') || '}' AS properties FROM events
""")
def compact_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6, JSN-1: empty values are left out."""
    e = table(spark, sf_dir, "events").withColumns({"user": F.when(F.col("user_id") % 3 != 0, F.col("user_id").cast("string")).otherwise(""), "id": F.col("event_id")})
    return e.select("event_id", compact_properties(["event_type", "user", "id"]).alias("properties"))


@query(f"SELECT vec_id, lon, lat FROM ({POINTS_SQL}) WHERE lon BETWEEN 138.7 AND 139.3 AND lat BETWEEN 35.7 AND 36.3 ORDER BY label DESC, vec_id LIMIT 1")
def bbox_hit_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-8, GEO-13, FLT-6: the one row that a click hits."""
    return views.hit(points(spark, sf_dir), F.col("lon"), F.col("lat"), (138.7, 35.7, 139.3, 36.3), [F.desc("label"), "vec_id"]).select("vec_id", "lon", "lat")


@query(f"""
SELECT vec_id, 9 AS z, floor((lon + 180) / 360 * 512)::INT AS tx, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 512)::INT AS ty FROM ({POINTS_SQL})
""")
def tile_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-12."""
    return views.tiles(points(spark, sf_dir), "lon", "lat", 9, ["vec_id"]).select("vec_id", "z", "tx", "ty")


@query(f"""
WITH t AS (SELECT vec_id, floor((lon + 180) / 360 * 128)::INT AS tx, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 128)::INT AS ty FROM ({POINTS_SQL})),
r AS (SELECT *, row_number() OVER (PARTITION BY tx, ty ORDER BY vec_id) AS nth FROM t)
SELECT tx, ty, count(*) FILTER (nth <= 40) AS n_kept, count(*) AS n FROM r GROUP BY 1, 2
""")
def tile_density_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8: below the complete zoom a tile keeps its first rows; the cap is the feature."""
    p = points(spark, sf_dir)
    kept = views.tiles(p, "lon", "lat", 7, ["vec_id"], 40).groupBy("tx", "ty").agg(F.count("*").alias("n_kept"))
    return kept.join(views.tiles(p, "lon", "lat", 7, []).groupBy("tx", "ty").agg(F.count("*").alias("n")), ["tx", "ty"])


def _curve(x: str, y: str, order: int = tiles.ORDER) -> str:
    """The place of a cell along the Hilbert curve, a subquery a bit; the innermost reads `t`."""
    full, sql = (1 << order) - 1, f"(SELECT *, {x} AS hx, {y} AS hy, 0::BIGINT AS place FROM t)"
    for bit in reversed(range(order)):
        rx, ry = f"((hx >> {bit}) & 1)", f"((hy >> {bit}) & 1)"
        ax, ay = (f"(CASE WHEN {rx} = 1 AND {ry} = 0 THEN {full} - {v} ELSE {v} END)" for v in ("hx", "hy"))
        sql = f"(SELECT * EXCLUDE (hx, hy, place), CASE WHEN {ry} = 0 THEN {ay} ELSE {ax} END AS hx, CASE WHEN {ry} = 0 THEN {ax} ELSE {ay} END AS hy, place + xor({rx} * 3, {ry})::BIGINT * {1 << 2 * bit} AS place FROM {sql})"
    return sql


CAP, ZOOMS = 6000, range(4, 10)


@query(f"""
WITH p AS (SELECT o_orderkey, 139 + (o_orderkey * 7919 % 10007) / 20000.0::DOUBLE * (o_custkey % 5) AS lon, 36 + (o_custkey * 104729 % 9973) / 20000.0::DOUBLE * (o_custkey % 3) AS lat, 40 + length(o_orderpriority) + o_orderkey % 7 AS bytes, (o_orderkey * 2654435761 % 16777216)::BIGINT AS tie FROM orders),
t AS (SELECT *, floor((lon + 180) / 360 * 65536)::BIGINT AS tx, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 65536)::BIGINT AS ty FROM p),
c AS (SELECT * FROM {_curve('tx', 'ty')}),
s AS (SELECT place, least(4294967295, coalesce(place - lag(place) OVER (ORDER BY place), 4294967295)) AS gap FROM (SELECT DISTINCT place FROM c)),
r AS (SELECT *, CASE WHEN tie = max(tie) OVER (PARTITION BY place) THEN gap ELSE 0 END * 16777216 + tie AS rank FROM c JOIN s USING (place)),
z AS (SELECT z, tx >> (16 - z) AS zx, ty >> (16 - z) AS zy, rank, bytes FROM r, (SELECT unnest([4, 5, 6, 7, 8, 9]) AS z)),
w AS (SELECT *, sum(bytes) OVER (PARTITION BY z, zx, zy ORDER BY rank DESC RANGE UNBOUNDED PRECEDING) AS total FROM z)
SELECT z::INT AS z, zx::INT AS tx, zy::INT AS ty, count(*) FILTER (total <= {CAP}) AS n_kept, coalesce(sum(bytes) FILTER (total <= {CAP}), 0)::BIGINT AS n_bytes FROM w GROUP BY 1, 2, 3 HAVING count(*) FILTER (total <= {CAP}) > 0
""")
def tile_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8, GEO-12: orders as places, a fifth of them at few longitudes; rows and bytes that each tile of each zoom keeps."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    lon = F.lit(139.0) + (k * 7919 % 10007) / F.lit(20000.0) * (c % 5)
    lat = F.lit(36.0) + (c * 104729 % 9973) / F.lit(20000.0) * (c % 3)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", lon.alias("lon"), lat.alias("lat"))
    size = F.lit(40) + F.length("o_orderpriority") + F.col("o_orderkey") % 7
    kept = tiles.pyramid(rows, "lon", "lat", ZOOMS, size, F.col("o_orderkey") * 2654435761 % 16777216, CAP)
    return kept.groupBy("z", "tx", "ty").agg(F.count("*").alias("n_kept"), F.sum("bytes").alias("n_bytes"))


@query("""
SELECT p_partkey, round(CASE WHEN z <= 4 THEN 1.6 WHEN z < 8 THEN 1.6 + (z - 4) * 1.4 / 4 WHEN z < 12 THEN 3 + (z - 8) * 2.5 / 4 WHEN z < 16 THEN 5.5 + (z - 12) * 3.5 / 4 ELSE 9 END, 6) AS radius
FROM (SELECT p_partkey, p_size / 3.0 AS z FROM part)
""")
def zoom_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-21."""
    radius = views.interpolate(F.col("p_size") / 3.0, ((4, 1.6), (8, 3), (12, 5.5), (16, 9)))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(radius, 6).alias("radius"))


@query(f"SELECT vec_id, 'map?zoom=15&lat=' || printf('%.6f', lat) || '&lon=' || printf('%.6f', lon) AS link FROM ({POINTS_SQL})")
def map_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10, PRJ-23."""
    return points(spark, sf_dir).select("vec_id", views.map_link(F.col("lon"), F.col("lat"), 15, "map").alias("link"))


@query(r"""
WITH p AS (SELECT event_id, list_filter(regexp_split_to_array(replace('x, ' || event_id || ',' || round(value, 2) || ' y', ',', ' '), ' +'), lambda s: regexp_full_match(s, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')) AS n FROM events)
SELECT event_id, len(n) AS n_numbers, n[1]::DOUBLE AS first_number, n[2]::DOUBLE AS second_number FROM p
""")
def numbers_among_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-16."""
    words = F.concat(F.lit("x, "), F.col("event_id").cast("string"), F.lit(","), F.round("value", 2).cast("string"), F.lit(" y"))
    n = table(spark, sf_dir, "events").select("event_id", numbers_in(words).alias("n"))
    return n.select("event_id", F.size("n").cast("long").alias("n_numbers"), F.get("n", F.lit(0)).alias("first_number"), F.get("n", F.lit(1)).alias("second_number"))


@query("""
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2
""")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed counts as the stream computes them (an extension)."""
    from ..streaming.incremental import windowed_counts

    w = windowed_counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type")
    return w.select("event_type", F.date_format("start", "yyyy-MM-dd").alias("day"), "n")
