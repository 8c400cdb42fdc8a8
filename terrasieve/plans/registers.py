"""Queries on codes, fields, units and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import codes, text
from ..operators import matching, quality, resolve
from ..sources import readers
from .registry import query, table


@query("""
SELECT o_orderstatus AS level, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 3) AS share
FROM orders GROUP BY o_orderstatus
""")
def level_share_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-1, AGG-2: records per level with their share of the total."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("level")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 3))


@query("SELECT c_custkey, printf('%02d', c_nationkey + 1) || printf('%03d', c_custkey % 1000) AS code FROM customer")
def code_synthesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4, PRJ-7."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", codes.code_from_numbers(F.col("c_nationkey") + 1, (F.col("c_custkey") % 1000).cast("int")).alias("code"))


@query("""
WITH raw AS (
  SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE (c_nationkey + 1)::VARCHAR END AS pref,
    CASE c_custkey % 5 WHEN 0 THEN (c_custkey % 1000)::VARCHAR WHEN 1 THEN lpad((c_nationkey + 1)::VARCHAR, 2, '0') || lpad((c_custkey % 1000)::VARCHAR, 3, '0')
      WHEN 2 THEN lpad((c_custkey % 10000)::VARCHAR, 4, '0') WHEN 3 THEN (c_custkey % 100)::VARCHAR || 'A' ELSE '' END AS city FROM customer),
p AS (SELECT *, CASE WHEN length(pref) < 2 THEN lpad(pref, 2, '0') ELSE pref END AS pp FROM raw),
s AS (SELECT *, CASE length(city) WHEN 5 THEN CASE WHEN substr(city, 1, 2) = pp THEN substr(city, 3) END WHEN 4 THEN substr(city, 1, 3) WHEN 3 THEN city END AS short FROM p)
SELECT c_custkey, pref, city, CASE WHEN pref <> '' AND regexp_full_match(city, '[0-9]+') AND short IS NOT NULL THEN pp || short ELSE '' END AS code FROM s
""")
def code_repair_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-3."""
    key = F.col("c_custkey")
    nation = (F.col("c_nationkey") + 1).cast("string")
    city = (
        F.when(key % 5 == 0, (key % 1000).cast("string")).when(key % 5 == 1, F.concat(F.lpad(nation, 2, "0"), F.lpad((key % 1000).cast("string"), 3, "0")))
        .when(key % 5 == 2, F.lpad((key % 10000).cast("string"), 4, "0")).when(key % 5 == 3, F.concat((key % 100).cast("string"), F.lit("A"))).otherwise("")
    )
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.when(key % 11 == 0, "").otherwise(nation).alias("pref"), city.alias("city"))
    return raw.withColumn("code", codes.municipality_code(F.col("pref"), F.col("city")))


@query(r"""
SELECT doc_id, regexp_replace(regexp_replace(chr(12288) || ' ' || text || chr(12288), '^[\s\x{3000}]+', ''), '[\s\x{3000}]+$', '') AS cleaned,
  lower(regexp_replace(text, '[\s\x{3000}]+', '', 'g')) AS header FROM documents
""")
def unicode_trim_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1, STR-14: white space of every width."""
    d = table(spark, sf_dir, "documents")
    wide = F.concat(F.lit("　 "), "text", F.lit("　"))
    return d.select("doc_id", text.clean(wide).alias("cleaned"), text.header_key(F.col("text")).alias("header"))


@query("""
WITH f AS (SELECT page_id, list_transform(range(47 + (page_id % 3 = 0)::INT), lambda i: (page_id * 31 + i)::VARCHAR) AS parts FROM pages)
SELECT page_id, len(parts) AS n_fields, array_to_string(CASE WHEN len(parts) = 48 THEN parts[1:32] || [parts[33] || parts[34]] || parts[35:48] ELSE parts END, '|') AS fields FROM f
""")
def field_split_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-2, SRC-4: lines of 47 fields, or 48 where one was cut."""
    p = table(spark, sf_dir, "pages")
    n = F.when(F.col("page_id") % 3 == 0, 48).otherwise(47)
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (F.col("page_id") * 31 + i).cast("string"))
    line = p.select("page_id", F.array_join(parts, "\t").alias("line"))
    return line.select("page_id", F.size(F.split("line", "\t")).cast("long").alias("n_fields"), F.array_join(text.repaired_fields(F.col("line")), "|").alias("fields"))


@query("""
SELECT substr(n_name, length(n_name), 1) AS prefix, arg_min(n_name, n_nationkey) AS first_name, arg_min(r_name, n_nationkey) AS region
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def prefix_code_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-2, AGG-11."""
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy(F.substring("n_name", -1, 1).alias("prefix")).agg(F.min_by("n_name", "n_nationkey").alias("first_name"), F.min_by("r_name", "n_nationkey").alias("region"))


@query("""
SELECT CASE WHEN n_nationkey IS NULL THEN 'B' ELSE 'A' END AS track, count(*) AS n, count(DISTINCT n_name) AS n_names, count(*) FILTER (c_acctbal < 0) AS n_negative
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 2000)) ON c_nationkey = n_nationkey GROUP BY 1
""")
def track_split_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1, PRJ-5, AGG-3."""
    poor = table(spark, sf_dir, "supplier").filter("s_acctbal < 2000").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    cities = table(spark, sf_dir, "nation").join(poor, "n_nationkey").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_nationkey").alias("ord"))
    rows = resolve.split_tracks(table(spark, sf_dir, "customer"), cities, "c_nationkey")
    return rows.groupBy("track").agg(F.count("*").alias("n"), F.count_distinct("city_row.n_name").alias("n_names"), F.count_if(F.col("c_acctbal") < 0).alias("n_negative"))


@query("""
WITH s AS (SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS head, regexp_replace(p_name, '(?:ring|ping|er)$', '') AS bare FROM part),
c AS (SELECT p_partkey, unnest([p_name, head, CASE WHEN trim(bare) = '' THEN p_name ELSE trim(bare) END]) AS cand, unnest([0, 1, 2]) AS pos FROM s)
SELECT p_partkey, cand, min(pos) AS pos FROM c WHERE cand <> '' GROUP BY 1, 2
""")
def candidate_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-2, STR-6, SET-2: candidates in stages, repeats left out; pos counts stages."""
    name = F.col("p_name")
    stages = F.array(name, F.split(name, " ", 2)[0], text.strip_repeat(name, "(?:ring|ping|er)$", 1))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(stages).alias("pos", "cand"))
    return rows.filter("cand <> ''").groupBy("p_partkey", "cand").agg(F.min("pos").alias("pos"))


@query("""
WITH k AS (SELECT l_orderkey * 10 + l_linenumber AS row_id, concat_ws('|', l_returnflag, l_linestatus, l_suppkey) AS unit_key, l_partkey FROM lineitem),
u AS (SELECT unit_key, count(*) AS n_rows, arg_min(l_partkey, row_id * 1000000 + l_partkey) AS part FROM k GROUP BY 1)
SELECT unit_key, n_rows, part FROM u
""")
def unit_dedup_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-14, PRJ-7, JN-4: one unit a key, the first row's part."""
    l = table(spark, sf_dir, "lineitem")
    order = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")
    rows = l.select(F.concat_ws("|", "l_returnflag", "l_linestatus", "l_suppkey").alias("unit_key"), order.alias("ord"), F.col("l_partkey").alias("part"))
    return resolve.units(rows, "unit_key", "ord").select("unit_key", "n_rows", "part")


@query("""
WITH f AS (SELECT o_orderkey, o_orderkey % 2 = 0 AS a, o_orderkey % 10 AS k FROM orders),
m AS (SELECT o_orderkey, CASE
  WHEN a AND k = 0 THEN 'A_normalize' WHEN a AND k = 2 THEN 'A_oaza_exact' WHEN a AND k = 4 THEN 'A_oaza_prefix' WHEN a AND k = 6 THEN 'A_city_fallback' WHEN a THEN 'A_failed'
  WHEN k = 1 THEN 'B_town_exact' WHEN k = 3 THEN 'B_town_suffix' WHEN k = 5 THEN 'B_town_ambiguous' WHEN k = 7 THEN 'B_unmatched' ELSE 'B_no_adr' END AS method FROM f)
SELECT method, CASE WHEN method IN ('A_normalize', 'B_town_exact') THEN 'town' WHEN method IN ('A_oaza_exact', 'A_oaza_prefix', 'B_town_suffix') THEN 'oaza' WHEN method = 'A_city_fallback' THEN 'city' ELSE 'none' END AS level,
  CASE WHEN method = 'A_normalize' THEN 'high' WHEN method IN ('A_oaza_exact', 'B_town_exact') THEN 'medium' WHEN method IN ('A_oaza_prefix', 'A_city_fallback', 'B_town_suffix') THEN 'low' ELSE '' END AS confidence, count(*) AS n
FROM m GROUP BY ALL
""")
def provenance_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-2, GEO-3, GEO-4, PRJ-9."""
    k = F.col("o_orderkey") % 10
    found = table(spark, sf_dir, "orders").select(
        F.when(k % 2 == 0, "A").otherwise("B").alias("track"), F.when(k == 0, "town").when(k.isin(2, 4, 6), "city").otherwise("failed").alias("status_a"),
        F.when(k == 2, "exact").when(k == 4, "prefix").alias("refined"), F.when(k == 1, "town_unique").when(k.isin(3, 7), "unmatched").when(k == 5, "town_ambiguous").otherwise("no_adr").alias("status_b"),
        F.when(k == 3, "oaza").alias("suffix_level"),
    )
    return resolve.provenance(found).groupBy("method", "level", "confidence").agg(F.count("*").alias("n"))


@query("""
SELECT coalesce(o_orderpriority, 'all') AS priority, coalesce(o_orderstatus, 'all') AS status, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 3) AS share
FROM orders GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), (o_orderpriority), ())
""")
def confidence_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2 with totals."""
    g = table(spark, sf_dir, "orders").rollup("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    total = F.max(F.when(F.col("gid") == 3, F.col("n"))).over(Window.partitionBy())
    return g.select(F.coalesce("o_orderpriority", F.lit("all")).alias("priority"), F.coalesce("o_orderstatus", F.lit("all")).alias("status"), "n", F.round(F.col("n") * 100.0 / total, 3).alias("share"))


@query(r"""
WITH raw AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN value::VARCHAR || 'd' WHEN 2 THEN ' ' || event_id || ' ' WHEN 3 THEN '-' || event_id || '.5' WHEN 4 THEN event_id || 'e1' WHEN 5 THEN '1_000' ELSE json_extract_string(props, '$.k') END AS t FROM events)
SELECT event_id, CASE WHEN regexp_full_match(t, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*') THEN CAST(trim(t) AS DOUBLE) END AS number FROM raw
""")
def numeric_safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-11, PRJ-12."""
    k, e = F.col("event_id") % 7, F.col("event_id").cast("string")
    t = (
        F.when(k == 0, "").when(k == 1, F.concat(F.col("value").cast("string"), F.lit("d"))).when(k == 2, F.concat(F.lit(" "), e, F.lit(" ")))
        .when(k == 3, F.concat(F.lit("-"), e, F.lit(".5"))).when(k == 4, F.concat(e, F.lit("e1"))).when(k == 5, "1_000").otherwise(F.get_json_object("props", "$.k"))
    )
    return table(spark, sf_dir, "events").select("event_id", text.number_of(t).alias("number"))


@query("""
WITH t AS (SELECT CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '#' || text ELSE '' END AS v FROM documents)
SELECT CASE WHEN v = '' THEN '' WHEN starts_with(v, '#') THEN 'overflow' WHEN contains(v, '|') THEN 'geology' ELSE 'temp' END AS kind, count(*) AS n FROM t GROUP BY 1
""")
def content_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-16."""
    k = F.col("doc_id") % 3
    v = F.when(k == 0, F.col("text")).when(k == 1, F.concat(F.lit("#"), F.col("text"))).otherwise("")
    return table(spark, sf_dir, "documents").groupBy(codes.content_kind(v).alias("kind")).agg(F.count("*").alias("n"))


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y%m%d') AS d, l_orderkey % 4 AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE k WHEN 0 THEN 'not measured' WHEN 1 THEN substr(d, 1, 4) WHEN 2 THEN substr(d, 1, 4) || '-' || substr(d, 5, 2) ELSE substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2) END AS shown FROM t
""")
def partial_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-1."""
    d, k = F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_orderkey") % 4
    raw = F.when(k == 0, "00000000").when(k == 1, F.concat(F.substring(d, 1, 4), F.lit("0000"))).when(k == 2, F.concat(F.substring(d, 1, 6), F.lit("00"))).otherwise(d)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", codes.partial_date(raw, "not measured").alias("shown"))


@query("SELECT o_orderkey, (CASE WHEN o_orderkey % 2 = 0 THEN 1925 + o_orderkey % 64 ELSE 1988 + o_orderkey % 31 END)::INT AS year FROM orders")
def era_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-17, PRJ-18."""
    k = F.col("o_orderkey")
    era = F.when(k % 2 == 0, F.concat(F.lit("昭"), (k % 64).cast("string"))).otherwise(F.concat(F.lit("平"), (k % 31).cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", codes.era_year(era).alias("year"))


@query("""
WITH p AS (SELECT p_partkey, unnest([p_size, p_size + 10.5]) AS top, unnest([p_size + 5, p_size + 20.25]) AS bottom FROM part)
SELECT p_partkey, top::DOUBLE AS top, bottom::DOUBLE AS bottom FROM p
""")
def multi_value_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-value fields of SURVEY section 1.3."""
    s = F.col("p_size")
    field = F.concat_ws("|", F.concat_ws("-", s, s + 5), F.concat_ws("-", s + 10.5, s + 20.25))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(codes.screens(field)).alias("s")).select("p_partkey", "s.top", "s.bottom")


@query("""
SELECT 'customer' AS region, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
""")
def union_with_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-1, PRJ-14, PRJ-15."""
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("region"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("region"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return c.unionByName(s)


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND user_id NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02')")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-14, SET-4: users already gone through on the first day are left out."""
    e = table(spark, sf_dir, "events")
    return matching.resume(e.filter("ts >= '2024-01-16'").select("event_id", "user_id"), e.filter("ts < '2024-01-02'"), "user_id")


@query("""
WITH h AS (SELECT page_id, list_sort(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS links FROM pages)
SELECT page_id, len(links) AS n_links, array_to_string(links, ' ') AS links FROM h
""")
def link_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15."""
    h = table(spark, sf_dir, "pages").select("page_id", readers.link_codes(F.col("html"), 'href="([^"]*)"').alias("links"))
    return h.select("page_id", F.size("links").cast("long").alias("n_links"), F.array_join("links", " ").alias("links"))


@query("""
WITH r AS (SELECT source AS org, lang AS title, doc_id % 3 AS kind, doc_id FROM documents WHERE regexp_matches(lang, 'en|de'))
SELECT org, title, CASE arg_max(kind, doc_id) WHEN 0 THEN 'CSV/XLS' WHEN 1 THEN 'CSV' ELSE 'PDF/ZIP' END AS formats FROM r GROUP BY 1, 2
""")
def catalogue_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-16."""
    k = F.col("doc_id") % 3
    formats = F.when(k == 0, F.array(F.lit("XLS"), F.lit("CSV"), F.lit("CSV"))).when(k == 1, F.array(F.lit("CSV"))).otherwise(F.array(F.lit("ZIP"), F.lit("PDF")))
    found = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("source").alias("org"), F.col("lang").alias("title"), formats.alias("formats"))
    return readers.catalogue(found, "en|de")


@query("""
WITH c AS (SELECT conv_id, turn, string_split(text, ',') AS cells FROM conversations),
x AS (SELECT conv_id, turn, unnest(cells) AS value, generate_subscripts(cells, 1) - 1 AS col FROM c)
SELECT conv_id, count(DISTINCT turn) AS n_rows, max(col) + 1 AS width, count(*) FILTER (regexp_matches(value, '[0-9]')) AS n_with_digits FROM x GROUP BY 1
""")
def csv_cell_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOF-1's long table of cells."""
    from ..operators.profile import long_cells

    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").alias("row_no"), F.split("text", ",").alias("cells"))
    return long_cells(c).groupBy(F.col("file").alias("conv_id")).agg(F.count_distinct("row_no").alias("n_rows"), (F.max("col_no") + 1).cast("long").alias("width"), F.count_if(F.col("value").rlike("[0-9]")).alias("n_with_digits"))


@query("""
SELECT 'f' || label AS file, count(*) AS n_rows, label % 3 <> 0 AS has_place, false AS has_lot, label % 4 <> 0 AS has_depth, label % 3 <> 0 AND label % 4 <> 0 AS usable
FROM embeddings GROUP BY label
""")
def csv_role_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOF-1, FLT-15: verdicts on files made of the vectors' places; every third without values, every fourth without depth."""
    from ..operators.profile import usable
    from .registry import points

    p = points(spark, sf_dir).withColumn("file", F.concat(F.lit("f"), F.col("label").cast("string")))
    value = lambda c: F.when(F.col("label") % 3 == 0, "").otherwise(F.col(c).cast("string"))
    rows = p.select("file", (F.col("vec_id") + 1).alias("row_no"), F.array(value("lat"), value("lon"), F.col("vec_id").cast("string")).alias("cells"))
    depth = F.when(F.col("label") % 4 == 0, "番号").otherwise("井戸 深度(m)")
    heads = p.select("file", F.lit(0).cast("long").alias("row_no"), F.array(F.lit("緯　度"), F.lit("Lon"), depth).alias("cells")).distinct()
    return usable(heads.unionByName(rows))


@query("""
SELECT o_orderkey, o_custkey, c_acctbal AS found FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
""")
def service_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3, SRC-17: answers of a service held as a table."""
    service = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("found"))
    return readers.looked_up(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), service, ["o_custkey"])


@query("""
WITH k AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders), s AS (SELECT * FROM k ORDER BY md5(o_custkey || '|' || o_orderpriority), o_custkey, o_orderpriority LIMIT 50)
SELECT o_custkey, o_orderpriority FROM s
""")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-5: the sampling operator itself."""
    return quality.sampled(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], 50)
