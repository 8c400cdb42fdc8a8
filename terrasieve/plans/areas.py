"""Queries on areas: containment, distance, union, rings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import areas
from .registry import POINTS_SQL, points, query, table


def label_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as vertices: rings of the neighbours in vec_id that share a label, all rings of a label as one area."""
    v = points(spark, sf_dir).select(F.col("label").alias("code"), F.expr("vec_id div 60").alias("ring"), F.col("vec_id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    from pyspark.sql import Window

    v = v.withColumn("pos", F.row_number().over(Window.partitionBy("code", "ring").orderBy("vec_id")))  # sixty vectors at most
    return areas.ring_edges(v, ["code", "ring"])


AREA_EDGES_SQL = f"""
SELECT code, x1, y1, x2, y2 FROM (SELECT label AS code, lon AS x1, lat AS y1, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2
  FROM ({POINTS_SQL}) WINDOW w AS (PARTITION BY label, vec_id // 60 ORDER BY vec_id)) WHERE x1 <> x2 OR y1 <> y2
"""
PLACES_SQL = "SELECT o_orderkey, (o_orderkey % 11)::INT AS code, 138 + (o_orderkey * 7919 % 100003) / 50000.0::DOUBLE AS x, 35 + (o_custkey * 104729 % 99991) / 50000.0::DOUBLE AS y FROM orders"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    x = F.lit(138.0) + (F.col("o_orderkey") * 7919 % 100003) / F.lit(50000.0)
    y = F.lit(35.0) + (F.col("o_custkey") * 104729 % 99991) / F.lit(50000.0)
    return o.select("o_orderkey", (F.col("o_orderkey") % 11).cast("int").alias("code"), x.alias("x"), y.alias("y"))


@query(f"""
WITH e AS ({AREA_EDGES_SQL}), p AS ({PLACES_SQL})
SELECT o_orderkey, e.code AS area FROM p JOIN e ON (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1) GROUP BY 1, 2 HAVING count(*) % 2 = 1
""")
def areas_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-17: all areas of a polygon table that each place lies in."""
    edges = areas.settled(label_areas(spark, sf_dir))
    return areas.containing(places(spark, sf_dir), edges, "o_orderkey").select("o_orderkey", F.col("code").alias("area"))


@query(f"""
WITH e AS ({AREA_EDGES_SQL}), p AS ({PLACES_SQL}),
t AS (SELECT o_orderkey, p.code, e.code IS NOT NULL AS known, (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1) AS crossed, x, y, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy,
  greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t FROM p LEFT JOIN e USING (code)),
d AS (SELECT o_orderkey, bool_or(known) AS known, count(*) FILTER (crossed) % 2 = 1 AS odd, min(sqrt(pow(x - x1 - t * dx, 2) + pow(y - y1 - t * dy, 2))) AS d FROM t GROUP BY 1)
SELECT o_orderkey, CASE WHEN known THEN odd END AS inside, CASE WHEN known THEN round(CASE WHEN odd THEN 0 ELSE d * 111 END, 4) END AS distance_km FROM d
""")
def distance_to_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-17: each place against the area it is said to lie in, and how far outside it is; one code has no area."""
    found = areas.located(places(spark, sf_dir), label_areas(spark, sf_dir), "o_orderkey")
    return found.select("o_orderkey", "inside", F.round("distance_km", 4).alias("distance_km"))


def squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as unit squares, 64 in a row; a third of them, by nation, to a code."""
    c = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 3).cast("int").alias("code"), (F.col("c_custkey") % 64).cast("double").alias("x"), F.expr("c_custkey div 64").cast("double").alias("y"))
    corner = lambda i, j: (F.col("x") + i, F.col("y") + j)
    side = lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2"))
    sides = F.array(side(corner(0, 0), corner(1, 0)), side(corner(1, 0), corner(1, 1)), side(corner(1, 1), corner(0, 1)), side(corner(0, 1), corner(0, 0)))
    return c.select("code", F.explode(sides).alias("s")).select("code", "s.*")


@query("""
WITH c AS (SELECT c_nationkey % 3 AS code, c_custkey % 64 AS x, c_custkey // 64 AS y FROM customer),
n AS (SELECT code, x, y, unnest([(x - 1, y), (x + 1, y), (x, y - 1), (x, y + 1)]) AS o FROM c),
b AS (SELECT n.code, n.x, n.y, o[1] - n.x AS dx, o[2] - n.y AS dy FROM n LEFT JOIN c ON c.code = n.code AND c.x = o[1] AND c.y = o[2] WHERE c.code IS NULL),
k AS (SELECT code, x + i AS x, y + j AS y, sum(1) AS n, bool_or(i = 0 AND j = 0) AS nw, bool_or(i = 1 AND j = 1) AS se, bool_or(i = 1 AND j = 0) AS ne, bool_or(i = 0 AND j = 1) AS sw
  FROM c, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j) GROUP BY 1, 2, 3),
q AS (SELECT code, (count(*) FILTER (n = 1) - count(*) FILTER (n = 3) + 2 * count(*) FILTER (n = 2 AND ((nw AND se) OR (ne AND sw)))) // 4 AS shells_less_holes FROM k GROUP BY 1),
line AS (SELECT code, floor((min(y) + max(y) + 1) / 2.0) AS row FROM c GROUP BY 1),
r AS (SELECT c.code, x, x - row_number() OVER (PARTITION BY c.code ORDER BY x) AS run FROM c JOIN line ON c.code = line.code AND c.y = line.row),
w AS (SELECT code, run, min(x) AS a, max(x) + 1 AS b FROM r GROUP BY 1, 2),
i AS (SELECT code, arg_max((a + b) / 2.0, (b - a, -a)) AS x FROM w GROUP BY 1)
SELECT code::INT AS code, n_edges, area::DOUBLE AS area, shells_less_holes, x::DOUBLE AS x, (row + 0.5)::DOUBLE AS y FROM (SELECT code, count(*) AS n_edges FROM b GROUP BY 1) JOIN (SELECT code, count(*) AS area FROM c GROUP BY 1) USING (code) JOIN q USING (code) JOIN line USING (code) LEFT JOIN i USING (code)
""")
def dissolved_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13: the union of squares by code, its rings, and a point inside."""
    edges = areas.settled(areas.dissolved(squares(spark, sf_dir)))
    rings = areas.area_sums(areas.stitched(edges), ["code", "ring"])
    turns = rings.groupBy("code").agg((F.count_if(F.col("area") > 0) - F.count_if(F.col("area") < 0)).alias("shells_less_holes"))
    whole = areas.area_sums(edges, ["code"]).select("code", "n_edges", "area")
    return whole.join(turns, "code").join(areas.inner_points(edges, ["code"]), "code", "left")


RINGS_SQL = """
SELECT (c_nationkey % 2)::INT AS sheet, c_custkey AS ring, (c_custkey // 8 % 1000) * 12 AS cx, c_custkey // 8000 * 12 AS cy, 0.5 + 0.5 * (c_custkey % 8) AS half FROM customer
"""


@query(f"""
WITH r AS ({RINGS_SQL}),
a AS (SELECT p.sheet, p.ring, o.ring AS around, o.half FROM r p JOIN r o ON o.sheet = p.sheet AND o.ring <> p.ring AND abs(p.cx - p.half - o.cx) < o.half AND abs(p.cy - o.cy) < o.half),
d AS (SELECT r.sheet, r.ring, count(around) AS depth, arg_min(around, a.half) AS parent FROM r LEFT JOIN a USING (sheet, ring) GROUP BY 1, 2)
SELECT sheet, ring, depth, CASE WHEN depth % 2 = 0 THEN 'shell' ELSE 'hole' END AS role, CASE WHEN depth % 2 = 0 THEN ring ELSE parent END AS shell FROM d
""")
def shells_and_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, GEO-14: customers as nested squares, eight at most around a place; islands in lakes on islands."""
    c = table(spark, sf_dir, "customer")
    at = c.select((F.col("c_nationkey") % 2).cast("int").alias("sheet"), F.col("c_custkey").alias("ring"), F.expr("c_custkey div 8 % 1000 * 12").alias("cx"), F.expr("c_custkey div 8000 * 12").alias("cy"), (F.lit(0.5) + F.lit(0.5) * (F.col("c_custkey") % 8)).alias("half"))
    corner = lambda n, i, j: F.struct(F.lit(n).alias("pos"), (F.col("cx") + i * F.col("half")).alias("x"), (F.col("cy") + j * F.col("half")).alias("y"))
    corners = F.explode(F.array(corner(0, -1, -1), corner(1, 1, -1), corner(2, 1, 1), corner(3, -1, 1)))
    vertices = at.select("sheet", "ring", corners.alias("v")).select("sheet", "ring", "v.*")
    return areas.ring_roles(areas.ring_edges(vertices, ["sheet", "ring"]), "sheet", "ring")
