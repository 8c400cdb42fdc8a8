"""Queries on matching names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import matching
from .registry import query, table


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as units: the scope is the brand, candidates are the whole name and then its words, last first."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.col("p_brand").alias("scope"), F.array_distinct(F.concat(F.array("p_name"), F.reverse(F.split("p_name", " ")))).alias("cands"))


@query("""
WITH u AS (SELECT p_partkey, p_brand, unnest([p_name] || list_reverse(string_split(p_name, ' '))) AS key, unnest(range(len(string_split(p_name, ' ')) + 1)) AS pos FROM part),
k AS (SELECT DISTINCT p_brand, split_part(p_name, ' ', 2) AS key, p_size AS grp FROM part WHERE p_size <= 5),
h AS (SELECT p_partkey, key, min(pos) AS pos, count(DISTINCT grp) AS n, min(grp) AS g FROM u JOIN k USING (p_brand, key) GROUP BY 1, 2),
b AS (SELECT p_partkey, arg_min(key, (n > 1)::INT * 1000 + pos) AS used_cand, arg_min(n, (n > 1)::INT * 1000 + pos) AS n_groups, arg_min(g, (n > 1)::INT * 1000 + pos) AS g FROM h GROUP BY 1)
SELECT p_partkey, CASE WHEN n_groups IS NULL THEN 'unmatched' WHEN n_groups > 1 THEN 'ambiguous' ELSE 'unique' END AS status, used_cand, n_groups, CASE WHEN n_groups = 1 THEN g END AS match
FROM part LEFT JOIN b USING (p_partkey)
""")
def first_hit_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-5, WIN-7, AGG-4, AGG-11."""
    keys = table(spark, sf_dir, "part").filter("p_size <= 5").select(F.col("p_brand").alias("scope"), F.split("p_name", " ")[1].alias("key"), F.col("p_size").alias("grp"), F.col("p_size").alias("ord")).distinct()
    found = matching.first_unique(_words(spark, sf_dir), keys, "p_partkey", "scope", "grp", "ord")
    return found.select("p_partkey", "status", "used_cand", "n_groups", "match")


@query("""
WITH k AS (SELECT DISTINCT n_regionkey, split_part(p_name, ' ', 2) AS noun, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN part ON p_partkey % 100 = s_suppkey % 100),
g AS (SELECT n_regionkey, noun, count(DISTINCT n_name) AS n_groups, array_to_string(list_sort(list(DISTINCT n_name))[1:8], ',') AS groups FROM k GROUP BY 1, 2)
SELECT n_regionkey, noun, n_groups, CASE WHEN n_groups = 1 THEN 'unique' ELSE 'ambiguous' END AS status, CASE WHEN n_groups > 1 THEN groups END AS groups FROM g
""")
def unique_or_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-5, AGG-4, AGG-12."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 100).alias("k"), F.split("p_name", " ")[1].alias("key")).distinct()
    keys = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("n_regionkey", "n_name", (F.col("s_suppkey") % 100).alias("k")).join(p, "k")
    keys = keys.select("n_regionkey", "key", "n_name", F.col("n_name").alias("ord")).distinct()
    units = keys.select("n_regionkey", "key").distinct().select(F.concat_ws("|", "n_regionkey", "key").alias("unit"), "n_regionkey", F.array("key").alias("cands"), F.col("key").alias("noun"))
    found = matching.first_unique(units.drop("noun"), keys, "unit", "n_regionkey", "n_name", "ord")
    return units.join(found, "unit").select("n_regionkey", "noun", "n_groups", "status", "groups")


@query("""
WITH pts AS (SELECT vec_id, 139 + 5 * embedding[1]::DOUBLE AS lon, 36 + 5 * embedding[2]::DOUBLE AS lat FROM embeddings),
towns AS (SELECT p_partkey, p_brand, p_name AS full_name, split_part(p_name, ' ', 2) AS short_name, lon, lat FROM part JOIN pts ON p_partkey = vec_id),
units AS (SELECT DISTINCT p_brand, split_part(p_name, ' ', 2) AS noun, substr(split_part(p_name, ' ', 1), 1, 3) AS stem FROM part),
c AS (SELECT p_brand, noun, stem, noun AS key, 0 AS pos FROM units UNION ALL SELECT p_brand, noun, stem, stem, 1 FROM units),
h AS (SELECT c.p_brand, noun, stem, key, pos, lon, lat, CASE WHEN full_name = key OR short_name = key THEN 0 ELSE 1 END AS mode
  FROM c JOIN towns t ON c.p_brand = t.p_brand AND (starts_with(full_name, key) OR starts_with(short_name, key)) WHERE length(key) >= 2),
x AS (SELECT *, min(mode) OVER (PARTITION BY p_brand, noun, stem, pos) AS best, min(pos) OVER (PARTITION BY p_brand, noun, stem) AS first FROM h)
SELECT p_brand, noun, stem, pos, key, CASE WHEN best = 0 THEN 'exact' ELSE 'prefix' END AS mode, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat, count(*) AS n,
  round(CASE WHEN count(*) = 1 THEN 0 ELSE sqrt(var_pop(lon) * pow(111.320 * cos(radians(avg(lat))), 2) + var_pop(lat) * 110.574 * 110.574) END, 4) AS spread_km
FROM x WHERE pos = first AND mode = best GROUP BY p_brand, noun, stem, pos, key, best
""")
def exact_then_prefix_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-7, JN-8, AGG-5, FLT-7."""
    from ..functions.geo import centroid_spread
    from .registry import points

    p = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    at = points(spark, sf_dir).select(F.col("vec_id").alias("p_partkey"), "lon", "lat")
    towns = p.join(at, "p_partkey").select("p_brand", F.col("p_partkey").alias("town"), F.col("p_name").alias("full"), words[1].alias("short"), "lon", "lat")
    units = p.select("p_brand", words[1].alias("noun"), F.substring(words[0], 1, 3).alias("stem")).distinct()
    units = units.withColumns({"unit": F.struct("noun", "stem", F.col("p_brand").alias("b")), "cands": F.array("noun", "stem")})
    hits = matching.exact_then_prefix(units.select("unit", "p_brand", "cands"), towns, "unit", "p_brand", centroid_spread("lon", "lat"))
    return hits.select("unit.b", "unit.noun", "unit.stem", "pos", "key", "mode", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "n", F.round("spread_km", 4).alias("spread_km")).withColumnRenamed("b", "p_brand")


@query("""
WITH pts AS (SELECT vec_id, 139 + 5 * embedding[1]::DOUBLE AS lon, 36 + 5 * embedding[2]::DOUBLE AS lat FROM embeddings),
entries AS (SELECT p_brand || '/' || p_size AS scope, p_type AS grp, p_name, lon, lat FROM part JOIN pts ON vec_id = p_partkey % (SELECT count(*) FROM embeddings)),
units AS (SELECT DISTINCT p_brand || '/' || p_size AS scope, split_part(p_name, ' ', 2) AS noun FROM part),
h AS (SELECT u.scope, noun, grp, lon, lat FROM units u JOIN entries e ON u.scope = e.scope AND ends_with(p_name, noun) AND length(p_name) - length(noun) >= 2 AND length(noun) >= 2)
SELECT scope, noun, min(grp) AS match, count(*) AS n_entries, CASE WHEN count(*) = 1 THEN 'town' ELSE 'oaza' END AS level, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat,
  round(CASE WHEN count(*) = 1 THEN 0 ELSE sqrt(var_pop(lon) * pow(111.320 * cos(radians(avg(lat))), 2) + var_pop(lat) * 110.574 * 110.574) END, 4) AS spread_km
FROM h GROUP BY scope, noun HAVING count(DISTINCT grp) = 1
""")
def suffix_match_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-9, FLT-7, GEO-3: every part is an entry with the place of a vector, also where parts share a name."""
    from ..functions.geo import centroid_spread
    from .registry import points

    at = points(spark, sf_dir).select(F.col("vec_id").alias("at"), "lon", "lat")
    p = table(spark, sf_dir, "part").withColumns({"scope": F.concat_ws("/", "p_brand", "p_size"), "at": F.col("p_partkey") % F.lit(at.count())})
    names = p.join(at, "at").select("scope", F.col("p_type").alias("grp"), "p_name", "lon", "lat")
    units = p.select("scope", F.split("p_name", " ")[1].alias("noun")).distinct().withColumns({"unit": F.concat_ws("|", "scope", "noun"), "cands": F.array("noun")})
    found = matching.suffix_unique(units.select("unit", "scope", "cands"), names, "unit", "scope", "grp", "p_name", centroid_spread("lon", "lat"))
    return units.select("unit", "scope", "noun").join(found, "unit").select("scope", "noun", "match", "n_entries", "level", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.round("spread_km", 4).alias("spread_km"))


@query("""
WITH keys AS (
  SELECT p_brand, p_partkey, unnest(list_distinct([split_part(p_name, ' ', 2), split_part(p_name, ' ', 2) || p_size, split_part(p_name, ' ', 2) || split_part(p_name, ' ', 1)])) AS key FROM part WHERE p_size > 5)
SELECT p_brand, key, count(DISTINCT p_partkey) AS n FROM keys GROUP BY 1, 2
""")
def town_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-6."""
    w = F.split("p_name", " ")
    place = F.when(F.col("p_size") > 5, 1.0)
    towns = table(spark, sf_dir, "part").select("p_brand", "p_partkey", w[1].alias("oaza_cho"), F.col("p_size").cast("string").alias("chome"), w[0].alias("koaza"), place.alias("lon"), place.alias("lat"))
    return matching.town_keys(towns, lambda k: k, lambda c: c).groupBy("p_brand", "key").agg(F.count_distinct("p_partkey").alias("n"))


@query("""
WITH l AS (SELECT l_orderkey AS g, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS nth, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
o AS (SELECT o_custkey AS g, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT l.g, l.nth, o_orderkey, l_partkey FROM l JOIN o USING (g, nth, n)
""")
def positional_zip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-10, WIN-6: an order's lines with the orders of the customer of that number, where there are as many."""
    l = table(spark, sf_dir, "lineitem").withColumn("g", F.col("l_orderkey"))
    o = table(spark, sf_dir, "orders").withColumn("g", F.col("o_custkey"))
    pairs = matching.zip_by_position(l.select("g", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice"), o.select("g", "o_orderkey"), "g", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], ["o_orderkey"])
    return pairs.select("g", "nth", "o_orderkey", "l_partkey")


@query("""
WITH j AS (SELECT o_orderkey, l_partkey, l_suppkey, l_extendedprice, abs(date_diff('day', o_orderdate::DATE, l_shipdate::DATE)) AS days FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE abs(o_totalprice - l_extendedprice) <= 60000 AND abs(date_diff('day', o_orderdate::DATE, l_shipdate::DATE)) <= 400),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY days, l_partkey, l_suppkey, l_extendedprice) AS nth FROM j)
SELECT o_orderkey, l_partkey, l_suppkey, days FROM r WHERE nth = 1
""")
def band_join_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-11, SRT-3, FLT-11."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderkey", "o_totalprice", "o_orderdate")
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    days = F.abs(F.datediff("l_shipdate", "o_orderdate"))
    found = matching.band_nearest(o, l, ["k"], [(F.col("o_totalprice"), F.col("l_extendedprice"), 60000), (F.unix_date(F.to_date("o_orderdate")), F.unix_date(F.to_date("l_shipdate")), 400)], days, "o_orderkey", ["l_partkey", "l_suppkey", "l_extendedprice"], keep=[])
    return found.select("o_orderkey", "l_partkey", "l_suppkey", F.col("distance").cast("long").alias("days"))


@query("""
WITH p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS ref_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance FROM p a JOIN p b ON b.label = 0 AND a.label <> 0)
SELECT vec_id, arg_min(ref_id, (distance, ref_id)) AS ref_id, round(min(distance), 9) AS distance FROM d GROUP BY 1
""")
def nearest_reference_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-15: however far."""
    e = table(spark, sf_dir, "embeddings")
    p = e.select("vec_id", "label", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    refs = p.filter("label = 0").withColumnRenamed("vec_id", "ref_id")
    return matching.nearest(p.filter("label <> 0"), refs, 0.05, "vec_id", "ref_id").withColumn("distance", F.round("distance", 9))
