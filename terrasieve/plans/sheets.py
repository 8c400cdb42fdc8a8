"""Queries on page elements, samples, catalogues and files with places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import codes
from ..operators import evaluate, fit, pages, profile
from ..sources import readers
from .registry import POINTS_SQL, points, query, table


@query("""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row, count(*) OVER () AS n FROM orders),
s AS (SELECT o_orderkey, row, (n - 1) / 599.0::DOUBLE AS step FROM r)
SELECT o_orderkey FROM s WHERE floor(ceil(row / step) * step) = row AND ceil(row / step) < 600
""")
def spaced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-6: six hundred orders at even places of all in order; the number is the feature."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return evaluate.spaced_sample(o, ["o_orderdate", "o_orderkey"], o.count(), 600).select("o_orderkey")


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS x0, l_quantity + l_linenumber AS x1, l_discount * 100 AS y0, l_discount * 100 + 6 AS y1, l_suppkey % 4 AS color, l_quantity AS size FROM lineitem WHERE l_partkey % 3 = 0 AND l_suppkey % 5 <> 1)
SELECT round((x0 + x1) / 2 - 0.036, 6) AS x, round((y0 + y1) / 2 - 0.609, 6) AS y, color, size FROM s
""")
def marker_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-19: lines as text spans, some in the markers' font with the markers' sign."""
    l, q, d = table(spark, sf_dir, "lineitem"), F.col("l_quantity"), F.col("l_discount") * 100
    font = F.when(F.col("l_partkey") % 3 == 0, "Marks").otherwise("Text")
    spans = l.select(font.alias("font"), F.when(F.col("l_suppkey") % 5 == 1, "x").otherwise(" ● ").alias("text"), q.alias("x0"), (q + F.col("l_linenumber")).alias("x1"), d.alias("y0"), (d + 6).alias("y1"), (F.col("l_suppkey") % 4).alias("color"), q.alias("size"))
    found = readers.page_markers(spans, "Marks", "●")
    return found.select(F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "color", "size")


@query("""
WITH v AS (SELECT o_custkey AS page, o_orderkey % 3 AS pen, o_orderkey AS stroke, unnest([0, 1, 2]) AS i, 30 + o_orderkey * 37 % 500 AS x, 30 + o_orderkey * 53 % 700 AS y FROM orders),
p AS (SELECT page, pen, stroke, i, x + i * 7 AS x, y + i * i * 5 AS y FROM v),
s AS (SELECT page, pen, stroke FROM p GROUP BY 1, 2, 3 HAVING min(x) >= 20 AND min(y) >= 20 AND max(x) <= 580 AND max(y) <= 780),
k AS (SELECT p.* FROM p JOIN s USING (page, pen, stroke)),
b AS (SELECT page, pen, max(x) - min(x) AS w, max(y) - min(y) AS h FROM k GROUP BY 1, 2),
m AS (SELECT page, arg_max(pen, (w * h, pen)) AS best FROM b WHERE w >= 240 OR h >= 320 GROUP BY 1)
SELECT page, pen, count(*) AS n, sum(x)::DOUBLE AS x, sum(y)::DOUBLE AS y FROM k LEFT JOIN m USING (page) WHERE best IS NULL OR pen = best GROUP BY 1, 2
""")
def boundary_clouds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-20, AGG-19, FLT-13: of each page's strokes, without those at its margin, the pen that spreads widest."""
    k = F.col("o_orderkey")
    x, y = (30 + k * 37 % 500).cast("double"), (30 + k * 53 % 700).cast("double")
    line = F.array(*[F.struct((x + i * 7).alias("x"), (y + i * i * 5).alias("y")) for i in range(3)])
    strokes = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), (k % 3).alias("pen"), line.alias("points"))
    return pages.boundary_cloud(strokes, "page", 600.0, 800.0).groupBy("page", "pen").agg(F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"))


@query("""
SELECT 'file' || c_nationkey AS file, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_no, CASE WHEN c_custkey % 3 = 0 THEN 30 + c_custkey % 10 ELSE 30 + s_suppkey % 10 END::DOUBLE AS lat, CASE WHEN c_custkey % 3 = 0 THEN 130 + c_custkey % 11 ELSE 130 + s_suppkey % 11 END::DOUBLE AS lon,
  '東町' || c_custkey % 50 || '-' || c_custkey % 7 || '-1' AS address, CASE WHEN c_custkey % 3 = 0 THEN 'original' ELSE 'geocoded' END AS source
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey % 50 AND c_custkey % 3 <> 0 QUALIFY c_custkey % 3 = 0 OR s_suppkey IS NOT NULL
""")
def placed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-15: files of customers with latitude, longitude and address columns; where no place is written the address is looked up."""
    k = F.col("c_custkey")
    own = lambda base, m: F.when(k % 3 == 0, (k % m + base).cast("string")).otherwise("")
    lot = lambda n: F.concat(F.lit("東町"), (n % 50).cast("string"), F.lit("-"), (n % 7).cast("string"), F.lit("-1"))
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).cast("long")
    body = table(spark, sf_dir, "customer").select(F.concat(F.lit("file"), F.col("c_nationkey").cast("string")).alias("file"), nth.alias("row_no"), F.array(own(30, 10), own(130, 11), lot(k)).alias("cells"))
    heads = body.select("file").distinct().select("file", F.lit(0).cast("long").alias("row_no"), F.array(F.lit("緯 度"), F.lit("Lon"), F.lit("住所")).alias("cells"))
    s = F.col("s_suppkey")
    answers = table(spark, sf_dir, "supplier").filter("s_suppkey < 50").select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.concat(F.lit("東町"), s.cast("string"), F.lit("-"), i.cast("string"), F.lit("-1")))).alias("address"), (s % 10 + 30).cast("double").alias("g_lat"), (s % 11 + 130).cast("double").alias("g_lon"))
    return profile.placed_rows(heads.unionByName(body), answers)


@query("""
WITH e AS (SELECT doc_id, source AS catalogue, lang AS org, left(coalesce(text, ''), 12) AS title, coalesce(text, '') AS text, doc_id % 3 AS kind FROM documents),
h AS (SELECT *, unnest([1, 2, 3]) AS term, unnest(['the', 'de', 'und']) AS word FROM e),
r AS (SELECT * FROM h WHERE contains(text, word) AND (contains(title, 'e') OR contains(title, 'a')))
SELECT org, title, arg_max(CASE kind WHEN 0 THEN 'CSV/XLS' WHEN 1 THEN 'CSV' ELSE 'PDF/ZIP' END || ' (' || catalogue || ')', (term, catalogue, doc_id)) AS formats FROM r GROUP BY 1, 2
""")
def catalogue_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-16: three terms in every catalogue, one after the other; of a title found again the last find counts."""
    k = F.col("doc_id") % 3
    formats = F.when(k == 0, F.array(F.lit("XLS"), F.lit("CSV"), F.lit("CSV"))).when(k == 1, F.array(F.lit("CSV"))).otherwise(F.array(F.lit("ZIP"), F.lit("PDF")))
    text = F.coalesce("text", F.lit(""))
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("catalogue"), F.col("doc_id").alias("ord"), F.col("lang").alias("org"), F.substring(text, 1, 12).alias("title"), text.alias("text"), formats.alias("formats"))
    return readers.searched(d, ["the", "de", "und"], "text", "e|a")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 60 BETWEEN 1 AND 25 THEN (SELECT n_name FROM nation WHERE n_nationkey = s_suppkey % 60 - 1) ELSE '' END AS name, CASE WHEN s_suppkey % 4 = 0 THEN -1 ELSE s_acctbal END AS distance, CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE s_suppkey END AS year FROM supplier
""")
def indexed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6, PRJ-13: names by their place in a list, none outside of it; sentinels for what is missing."""
    names = [r.n_name for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]  # twenty-five
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 4 != 0, F.col("s_acctbal")).alias("distance"), F.when(k % 5 != 0, k).alias("year"))
    return codes.filled(rows, {"distance": -1, "year": 0}).select("s_suppkey", codes.name_at(k % 60, names).alias("name"), "distance", "year")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(1 + (l_partkey % 21 - 10) / 100.0 - 1) <= 0.0500001 AND abs(1 + (l_suppkey % 21 - 10) / 100.0 - 1) <= 0.0500001 AS plausible FROM lineitem
""")
def plausible_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUM-6: maps whose scale is off by up to a tenth in either direction."""
    import math

    east, north = 1 / (2.0 * 111.320 * math.cos(math.radians(35.7))), 1 / (2.0 * 110.574)
    off = lambda c: 1 + (F.col(c) % 21 - 10) / F.lit(100.0)
    zero = F.lit(0.0)
    m = F.array(off("l_partkey") * east, zero, zero, off("l_suppkey") * -north, F.lit(139.0), F.lit(36.5))
    l = table(spark, sf_dir, "lineitem")
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fit.scale_plausible(m, F.lit(2.0), F.lit(35.7), 0.0500001).alias("plausible"))


@query(f"SELECT vec_id, label, lon FROM ({POINTS_SQL}) ORDER BY label, vec_id")
def sorted_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1: all rows in the order of two columns, by one range shuffle."""
    return points(spark, sf_dir).select("vec_id", "label", "lon").orderBy("label", "vec_id")
