"""Round trips: given tables through a sink into the shared folder and back through a source."""

from __future__ import annotations

import io
import struct
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import views
from ..operators.pages import merged_spans as merge
from ..operators.rounds import shared_dir
from ..sources import blocks, readers, service, sinks, variants
from ..streaming import incremental
from .registry import POINTS_SQL, points, query, table
from .shown import VIEW_SQL, _view

BOX = (138.7, 35.8, 139.2, 36.4)


@query(f"SELECT vec_id, label, lon, lat FROM ({POINTS_SQL}) WHERE vec_id % 50 <> 0 AND lon BETWEEN {BOX[0]} AND {BOX[2]} AND lat BETWEEN {BOX[1]} AND {BOX[3]}")
def geoparquet_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4, SRC-11, FLT-2: places as GeoParquet, of which a box is read; some have no place and are left out."""
    path = shared_dir(spark)
    p = points(spark, sf_dir)
    sinks.write_geoparquet(p.withColumn("lon", F.when(F.col("vec_id") % 50 != 0, F.col("lon"))), "lon", "lat", path)
    return sinks.read_geoparquet(spark, path, BOX).select("vec_id", "label", "lon", "lat")


@query(f"SELECT label::VARCHAR AS label, count(*) AS n, round(sum(round(lon, 6)), 4) AS lon, round(sum(round(lat, 6)), 4) AS lat FROM ({POINTS_SQL}) GROUP BY 1")
def feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6, SNK-7, AGG-15: one FeatureCollection of all vectors in order, and its features by source."""
    path = shared_dir(spark)
    sinks.write_feature_collection(points(spark, sf_dir), "lon", "lat", ["vec_id", "label"], ["label", "vec_id"], path)
    back = sinks.read_feature_collection(spark, path, "vec_id string, label string")
    return back.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum("lon"), 4).alias("lon"), F.round(F.sum("lat"), 4).alias("lat"))


@query(f"""
WITH v AS (SELECT pos_quality AS cls, (p_partkey % 7)::VARCHAR AS use, dist, p_partkey % 60 + CASE WHEN p_partkey % 60 > 0 THEN 1940 ELSE 0 END AS year FROM ({VIEW_SQL}))
SELECT 'total' AS stat, NULL AS item, count(*) AS value FROM v UNION ALL SELECT 'distResolved', NULL, count(*) FILTER (dist >= 0) FROM v
UNION ALL SELECT 'posQuality', cls, count(*) FROM v GROUP BY cls UNION ALL SELECT 'posQualityDistResolved', cls, count(*) FILTER (dist >= 0) FROM v GROUP BY cls
UNION ALL SELECT 'use', use, count(*) FROM v GROUP BY use UNION ALL SELECT 'nenRange', 'min', min(nullif(year, 0)) FROM v UNION ALL SELECT 'nenRange', 'max', max(year) FROM v
UNION ALL SELECT 'minzoom', NULL, 4 UNION ALL SELECT 'maxzoom', NULL, 9 UNION ALL SELECT 'completeFromZoom', NULL, 9
""")
def viewer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-9, AGG-9, AGG-10: counts by class and use, the range of years that are known, zooms."""
    year = F.col("p_partkey") % 60 + F.when(F.col("p_partkey") % 60 > 0, 1940).otherwise(0)
    view = _view(spark, sf_dir).withColumns({"use": F.col("p_partkey") % 7, "year": year})
    return views.viewer_stats(view, "POS_QUALITY", "use", "ADR_DIST_KM_N", "year", range(4, 10))


@query("""
SELECT c_custkey, c_name || CASE c_custkey % 4 WHEN 0 THEN ', "the ' || c_custkey || '"' WHEN 1 THEN '' WHEN 2 THEN ' a,b' ELSE ' é 日' END AS name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance FROM customer
""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1, SRC-5, SRC-6: text with commas, quotes and nothing in it, and two typed columns."""
    path, k = shared_dir(spark), F.col("c_custkey")
    end = F.when(k % 4 == 0, F.concat(F.lit(', "the '), k.cast("string"), F.lit('"'))).when(k % 4 == 1, "").when(k % 4 == 2, " a,b").otherwise(" é 日")
    c = table(spark, sf_dir, "customer")
    sinks.write_csv(c.select("c_custkey", F.concat("c_name", end).alias("name"), F.when(k % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"), F.when(k % 3 != 0, F.col("c_acctbal")).alias("balance")), path)
    return readers.text_csv(spark, path, ["c_custkey", "name", "segment", "balance"], {"c_custkey": "bigint", "balance": "double"})


@query("SELECT event_id, event_type, props FROM events")
def json_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2, SNK-3, SRC-7: JSON lines written in two goes, the second appended; broken lines beside them are passed over."""
    path = shared_dir(spark)
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    sinks.write_json_lines(e.filter("event_id % 3 = 0"), path)
    sinks.write_json_lines(e.filter("event_id % 3 <> 0"), path, append=True)
    e.filter("event_id % 100 = 0").select(F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_type": "cut')).alias("value")).write.mode("append").text(path)
    return readers.json_lines(spark, path, "event_id bigint, event_type string, props string", tolerant=True)


@query("""
SELECT lpad(c_custkey::VARCHAR, 6, '0')[1:5] AS "MUNI_CD", n_name AS pref, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS county, c_name AS city, '' AS ward, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey::DOUBLE END AS lon, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN c_acctbal END AS lat
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def nested_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8, JSN-2: a nested file a nation, with cities whose point is missing or short."""
    path, k = shared_dir(spark), F.col("c_custkey")
    point = F.when(k % 7 != 0, F.when(k % 5 != 0, F.array(k.cast("double"), F.col("c_acctbal").cast("double"))).otherwise(F.array(k.cast("double"))))
    city = F.struct(k.alias("code"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("county"), F.col("c_name").alias("city"), point.alias("point"))
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    parts = c.groupBy("n_name", F.pmod("c_custkey", F.lit(16)).alias("part")).agg(F.collect_list(city).alias("cities"))  # files of bounded size: a sixteenth of a nation
    text = parts.select("n_name", "part", F.to_json(F.struct(F.array(F.struct(F.col("n_name").alias("pref"), "cities")).alias("data"))).alias("value"))
    text.write.partitionBy("n_name", "part").text(path)
    return readers.address_cities(spark, path).select("MUNI_CD", "pref", "county", "city", "ward", "lon", "lat")


def _zipped(name: str, data: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, data)
    return out.getvalue()


@query("""
SELECT n_name || '.zip' AS file, c_custkey::VARCHAR AS id, c_name AS name, '日本 ' || c_custkey % 9 AS place, c_mktsegment || CASE WHEN c_custkey % 6 = 0 THEN '終' ELSE '' END AS kind FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def zipped_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2, SRC-4, SET-1, PRJ-2: a zip file a nation and sixteenth, CP932 lines under one header; some rows have a field cut in two."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.when(k % 6 == 0, F.concat("c_mktsegment", F.lit("\t終"))).otherwise(F.col("c_mktsegment"))
    lines = c.select("n_name", F.pmod("c_custkey", F.lit(16)).alias("part"), F.concat_ws("\t", k.cast("string"), "c_name", F.concat(F.lit("日本 "), (k % 9).cast("string")), kind).alias("line"))

    def zipped(rows: pd.DataFrame) -> pd.DataFrame:
        data = "\r\n".join(["id\tname\tplace\tkind", *rows["line"], "", " "]).encode("cp932")
        return pd.DataFrame({"path": [f"{rows['n_name'].iloc[0]}.zip"], "content": [_zipped("a.DAT", data)]})

    zips = lines.groupBy("n_name", "part").applyInPandas(zipped, "path string, content binary")
    return readers.registry(zips.filter(F.hex(F.substring("content", 1, 2)) == "504B"), width=4, at=3).select("file", "id", "name", "place", "kind")


@query(f"SELECT label::VARCHAR AS label, vec_id::VARCHAR AS id, lon, lat FROM ({POINTS_SQL})")
def point_shapefiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9, PRJ-15: vectors as zipped point shapefiles, read back with their attributes."""

    def shaped(rows: pd.DataFrame) -> pd.DataFrame:
        n = len(rows)
        shapes = b"".join(struct.pack(">2i", i + 1, 10) + struct.pack("<i2d", 1, x, y) for i, (x, y) in enumerate(zip(rows["lon"], rows["lat"])))
        head = struct.pack(">i20xi", 9994, 50 + len(shapes) // 2) + struct.pack("<2i8d", 1000, 1, *[0.0] * 8)
        fields = b"".join(name.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([20, 0]) + b"\0" * 14 for name in (b"label", b"id"))
        records = b"".join(b" " + str(a).encode().ljust(20) + str(b).encode().ljust(20) for a, b in zip(rows["label"], rows["vec_id"]))
        dbf = struct.pack("<4BIHH20x", 3, 1, 1, 1, n, 32 + len(fields) + 1, 41) + fields + b"\r" + records
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("p.shp", head + shapes)
            z.writestr("p.dbf", dbf)
        return pd.DataFrame({"path": ["p.zip"], "content": [out.getvalue()]})

    zips = points(spark, sf_dir).groupBy("label", F.pmod("vec_id", F.lit(16))).applyInPandas(shaped, "path string, content binary")
    return readers.point_shapes(zips).select(F.col("attributes")["label"].alias("label"), F.col("attributes")["id"].alias("id"), "lon", "lat")


@query("""
WITH c AS (SELECT c_nationkey * 16 + c_custkey % 16 AS sheet, row_number() OVER (PARTITION BY c_nationkey, c_custkey % 16 ORDER BY c_custkey) AS nth, c_custkey::VARCHAR AS a, c_name || CASE WHEN c_custkey % 3 = 0 THEN E',\\n"線"' ELSE '' END AS b FROM customer)
SELECT sheet::VARCHAR AS sheet, nth, a, b FROM c
""")
def sniffed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12, SRC-21: CSV files in CP932 or UTF-8, by sheet, with commas, quotes and line ends inside cells."""
    k = F.col("c_custkey")
    b = F.concat("c_name", F.when(k % 3 == 0, ',\n"線"').otherwise(""))
    c = table(spark, sf_dir, "customer").select((F.col("c_nationkey") * 16 + k % 16).alias("sheet"), k, b.alias("b"))

    def written(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("c_custkey")
        text = "\r\n".join([f'{a},"{b.replace(chr(34), chr(34) * 2)}"' for a, b in zip(rows["c_custkey"], rows["b"])]) + "\r\n"
        sheet = int(rows["sheet"].iloc[0])
        return pd.DataFrame({"path": [str(sheet)], "content": [text.encode("cp932" if sheet % 2 else "utf-8-sig")]})

    cells = readers.csv_cells(c.groupBy("sheet").applyInPandas(written, "path string, content binary"))
    return cells.select(F.col("file").alias("sheet"), (F.col("row_no") + 1).alias("nth"), F.col("cells")[0].alias("a"), F.col("cells")[1].alias("b"))


@query("""
WITH s AS (SELECT l_orderkey AS page, l_linenumber % 2 * 10.0 AS y, l_linenumber * 10 + l_quantity % 4 - 2 AS x0, l_linenumber * 10 + 9.0 AS x1, l_returnflag AS text, l_partkey, l_suppkey FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_partkey, l_suppkey FROM lineitem)),
u AS (SELECT page, y, x0, min(x1) AS x1, min(text) AS text FROM s GROUP BY 1, 2, 3),
g AS (SELECT *, coalesce(x0 - lag(x1) OVER (PARTITION BY page, y ORDER BY x0), 99) AS gap FROM u),
r AS (SELECT *, sum(CASE WHEN gap >= -1 AND gap < 2 THEN 0 ELSE 1 END) OVER (PARTITION BY page, y ORDER BY x0) AS run FROM g)
SELECT page, y::DOUBLE AS y, min(x0)::DOUBLE AS x, max_by(x1, x0)::DOUBLE AS x1, string_agg(text, '' ORDER BY x0) AS text FROM r GROUP BY page, y, run
""")
def merged_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-8: an order's lines as text spans on two rows of a page; neighbours close enough become one."""
    n = F.col("l_linenumber")
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), (n % 2 * 10.0).cast("double").alias("y"), (n * 10 + F.col("l_quantity") % 4 - 2).cast("double").alias("x0"), (n * 10 + F.lit(9.0)).cast("double").alias("x1"), F.col("l_returnflag").alias("text"))
    spans = l.groupBy("page", "y", "x0").agg(F.min("x1").alias("x1"), F.min("text").alias("text"))
    return merge(spans, "page").select("page", "y", "x", "x1", "text")


@query("""
SELECT doc_id, md5(coalesce(text, '')) AS digest, length(coalesce(text, '')) AS n_chars, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang FROM documents
""")
def csv_by_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1, SRC-12, SRC-21: whole documents as CSV, quotes and line ends inside, read by blocks of the files."""
    path = shared_dir(spark)
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("lang"))
    sinks.write_csv(d, path)
    back = blocks.csv_by_blocks(spark, path, "doc_id long, text string, lang string")
    text = F.coalesce("text", F.lit(""))
    return back.select("doc_id", F.md5(text).alias("digest"), F.length(text).cast("long").alias("n_chars"), F.coalesce("lang", F.lit("")).alias("lang"))


@query("""
WITH j AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'no json' WHEN event_id % 4 = 0 THEN '{"k": "' || event_type || '", "at": {"user": ' || event_id % 50 || '}}' ELSE props END AS props FROM events)
SELECT event_id, CASE WHEN event_id % 9 <> 0 AND event_id % 4 <> 0 THEN (props->>'$.k')::BIGINT END AS k, CASE WHEN event_id % 9 <> 0 AND event_id % 4 = 0 THEN event_id % 50 END AS user FROM j
""")
def variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN-1: paths into JSON that some rows lack, hold as another type, or have no JSON for."""
    e = table(spark, sf_dir, "events")
    nested = F.concat(F.lit('{"k": "'), "event_type", F.lit('", "at": {"user": '), (F.col("event_id") % 50).cast("string"), F.lit("}}"))
    text = F.when(F.col("event_id") % 9 == 0, "no json").when(F.col("event_id") % 4 == 0, nested).otherwise(F.col("props"))
    found = variants.paths(e.select("event_id", text.alias("props")), "props", {"k": ("$.k", "bigint"), "user": ("$.at.user", "bigint")})
    return found.select("event_id", "k", "user")


@query("""
WITH j AS (SELECT CASE WHEN event_id % 4 = 0 THEN '{"k": "x", "at": {"user": 1}, "tags": []}' ELSE props END AS props FROM events),
u AS (SELECT props, unnest(json_keys(props)) AS key FROM j)
SELECT key, CASE json_type(props, '$.' || key) WHEN 'VARCHAR' THEN 'STRING' WHEN 'OBJECT' THEN 'OBJECT<user: BIGINT>' WHEN 'ARRAY' THEN 'ARRAY<VOID>' ELSE 'BIGINT' END AS type, count(*) AS n FROM u GROUP BY 1, 2
""")
def variant_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-24: keys of JSON and the types they are held as."""
    text = F.when(F.col("event_id") % 4 == 0, '{"k": "x", "at": {"user": 1}, "tags": []}').otherwise(F.col("props"))
    return variants.key_profile(table(spark, sf_dir, "events").select(text.alias("props")), "props")


@query(f"SELECT vec_id, round(lon, 6) AS lon, round(lat, 6) AS lat, label::VARCHAR AS label FROM ({POINTS_SQL})")
def variant_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN-1, SNK-6: GeoJSON features read without a schema."""
    lines = sinks.features(points(spark, sf_dir), "lon", "lat", ["vec_id", "label"])
    at = {"vec_id": ("$.properties.vec_id", "bigint"), "lon": ("$.geometry.coordinates[0]", "double"), "lat": ("$.geometry.coordinates[1]", "double"), "label": ("$.properties.label", "string")}
    return variants.paths(lines, "value", at).drop("value")


def _unsteady(path: str):
    """A service over files that answers a request only at its first, second or third try, by its number."""

    def start():
        fetch, seen = service.kept_in(path)(), {}

        def once(key: str) -> bytes | None:
            seen[key] = seen.get(key, 0) + 1
            return fetch(f"{key}.html") if seen[key] > int(key) % 3 else None

        return once

    return start


@query("""
SELECT page_id::VARCHAR AS key, CASE WHEN page_id % 11 <> 0 THEN md5(html) END AS digest, CASE WHEN page_id % 11 <> 0 THEN 1 + page_id % 3 ELSE 4 END::INT AS tries FROM pages WHERE page_id % 5 <> 0 OR page_id % 10 = 0
""")
def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, SRC-3, SRC-17: pages as files that a service gives out after some tries; some are missing, some fetched before,
    and of those before some had failed."""
    path, p = shared_dir(spark), table(spark, sf_dir, "pages")
    sinks.write_files(p.filter("page_id % 11 <> 0").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("name"), "html"), "name", "html", path).agg(F.sum("bytes")).collect()
    before = p.filter("page_id % 5 = 0").select(F.col("page_id").alias("key"), F.when(F.col("page_id") % 10 != 0, F.col("html")).cast("binary").alias("content"))
    found = service.fetched(p, "page_id", _unsteady(path), tries=4, wait=0.0, done=before)
    return found.select("key", F.md5("content").alias("digest"), "tries")


def _doubled(row: dict) -> dict | None:
    return None if row["user"] % 7 == 0 else {"twice": int(row["user"]) * 2}


@query("""
SELECT user::VARCHAR AS key, CASE WHEN user % 7 <> 0 THEN user * 2 END AS twice, CASE WHEN user % 7 = 0 THEN 3 ELSE 1 END::INT AS tries, user % 7 = 0 AS failed FROM (SELECT DISTINCT (event_id % 40)::BIGINT AS user FROM events)
""")
def resumed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3, JN-14: events as a stream of keys in two runs that overlap; each key is worked on once, failures three times."""
    source, out, state = shared_dir(spark), shared_dir(spark), shared_dir(spark)
    e = table(spark, sf_dir, "events").select(F.col("event_id"), (F.col("event_id") % 40).cast("long").alias("user"))
    for part in ("user < 25", "user > 10"):
        e.filter(part).write.mode("append").json(source)
        incremental.run_available(spark, source, "event_id long, user long", out, state, _doubled, "twice long", "user")
    return spark.read.schema("key string, twice long, tries int, failed boolean").parquet(out)
