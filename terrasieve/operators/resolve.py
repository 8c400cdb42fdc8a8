"""Units to resolve, and where their places come from (AGG-14, JN-1 to JN-4, GEO-1 to GEO-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.codes import fixed_point, lookup

# How sure a method is.
CONFIDENCE = {
    "A_normalize": "high", "A_oaza_exact": "medium", "A_oaza_prefix": "low", "A_city_fallback": "low", "B_town_exact": "medium", "B_town_suffix": "low",
}


def split_tracks(rows: DataFrame, cities: DataFrame, code: str = "MUNI_CD") -> DataFrame:
    """JN-1, PRJ-5: rows with their city's columns and a track: A where the code is current, B where it is not.

    Of several rows of one code the last by `ord` counts.
    """
    last = cities.groupBy(code).agg(F.max_by(F.struct(*[c for c in cities.columns if c not in (code, "ord")]), "ord").alias("city_row"))
    return rows.join(last, code, "left").withColumn("track", F.when(F.col("city_row").isNull(), "B").otherwise("A"))


def unit_key(track: str, muni: str, full: str, cands: str):
    """PRJ-7."""
    return F.concat_ws("|", track, muni, full, F.array_join(cands, "/"))


def units(rows: DataFrame, key: str, order: str) -> DataFrame:
    """AGG-14: one row a key, the first by `order`; the key itself links rows to it."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in (key, order)]), order).alias("u"), F.count("*").alias("n_rows")).select(key, "u.*", "n_rows")


def external_best(tries: DataFrame, unit: str) -> DataFrame:
    """GEO-1: of a unit's answers (pos, point_level, lon, lat) the first of level 3 or more, else the best level's first."""
    order = F.struct((F.col("point_level") < 3).alias("coarse"), F.when(F.col("point_level") >= 3, F.col("pos")).alias("first"), (-F.col("point_level")).alias("level"), "pos")
    best = tries.groupBy(unit).agg(F.min_by(F.struct("pos", "point_level", "lon", "lat"), order).alias("b"))
    status = F.when(F.col("b.point_level") >= 3, "town").when(F.col("b.point_level") >= 2, "city").otherwise("failed")
    return best.select(unit, status.alias("status"), "b.*")


def provenance(found: DataFrame) -> DataFrame:
    """GEO-2, GEO-4, PRJ-9: level, method and confidence from a unit's track and what each step gave.

    Columns: track, status_a (town, city, failed), refined (exact, prefix), status_b (town_unique and others), and
    suffix_level (town, oaza); null where a step gave nothing. A row without a unit has track null.
    """
    a, b = F.col("track") == "A", F.col("track") == "B"
    method = (
        F.when(a & (F.col("status_a") == "town"), "A_normalize").when(a & (F.col("refined") == "exact"), "A_oaza_exact")
        .when(a & (F.col("refined") == "prefix"), "A_oaza_prefix").when(a & (F.col("status_a") == "city"), "A_city_fallback").when(a, "A_failed")
        .when(b & (F.col("status_b") == "town_unique"), "B_town_exact").when(b & F.col("suffix_level").isNotNull(), "B_town_suffix")
        .when(b, F.concat(F.lit("B_"), F.col("status_b"))).otherwise("no_pref")
    )
    level = (
        F.when(F.col("method").isin("A_normalize", "B_town_exact"), "town").when(F.col("method").isin("A_oaza_exact", "A_oaza_prefix"), "oaza")
        .when(F.col("method") == "A_city_fallback", "city").when(F.col("method") == "B_town_suffix", F.col("suffix_level")).otherwise("none")
    )
    done = found.withColumn("method", method).withColumn("level", level)
    return done.withColumn("confidence", lookup(F.col("method"), CONFIDENCE))


def expand(rows: DataFrame, resolved: DataFrame, key: str) -> DataFrame:
    """JN-4, PRJ-10: every row with its unit's result, numbers as fixed-point text."""
    joined = rows.join(resolved, key, "left")
    joined = joined.withColumns({"level": F.coalesce("level", F.lit("none")), "method": F.coalesce("method", F.lit("no_pref")), "confidence": F.coalesce("confidence", F.lit(""))})
    return joined.withColumns({"GC_LAT": fixed_point(F.col("lat"), 6), "GC_LON": fixed_point(F.col("lon"), 6), "GC_SPREAD_KM": fixed_point(F.col("spread_km"), 3)})


def orphans(results: DataFrame, all_units: DataFrame, key: str) -> DataFrame:
    """JN-3: results whose unit is unknown; none is expected."""
    return results.join(all_units.select(key), key, "left_anti")
