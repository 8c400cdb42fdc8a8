"""Quality of places (WIN-1 to WIN-5, GEO-5 to GEO-7, FLT-4, AGG-6, PRJ-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import haversine
from ..functions.text import number_of


def stack_count(df: DataFrame, place: list[str], out: str = "GC_STACK_N") -> DataFrame:
    """WIN-5: rows at the same place. Counted apart and joined, so that a place with very many rows is no one task's."""
    counts = df.groupBy(*place).agg(F.count("*").cast("int").alias(out))
    return df.join(counts, place)


def position_quality(df: DataFrame, place: list[str], address: str) -> DataFrame:
    """WIN-1 to WIN-4: POS_N and POS_QUALITY. One row at a place is unique; several with one address, never empty, are a
    site; all others are a fallback. Groups are aggregated before the join back, so a hot place stays cheap."""
    groups = df.groupBy(*place).agg(F.count("*").alias("POS_N"), F.count_distinct(address).alias("n_addresses"), F.bool_and(F.col(address) != "").alias("filled"))
    kind = F.when(F.col("POS_N") == 1, "unique").when((F.col("n_addresses") <= 1) & F.col("filled"), "site").otherwise("fallback")
    return df.join(groups.select(*place, "POS_N", kind.alias("POS_QUALITY")), place)


def dependable_places(refs: DataFrame, key: list[str], most_km: float = 2.0) -> DataFrame:
    """AGG-6: mean places of the keys whose rows lie close together."""
    g = refs.groupBy(*key).agg(F.avg("lon").alias("ref_lon"), F.avg("lat").alias("ref_lat"), F.coalesce(F.stddev_samp("lon"), F.lit(0.0)).alias("sx"), F.coalesce(F.stddev_samp("lat"), F.lit(0.0)).alias("sy"))
    return g.filter(F.hypot(F.col("sx") * 90.0, F.col("sy") * 111.1) <= most_km).drop("sx", "sy")


def address_distance(df: DataFrame, refs: DataFrame, key: list[str], out: str = "ADR_DIST_KM") -> DataFrame:
    """GEO-6, JN-13: km from a row's place to its name's dependable place; null where there is none."""
    joined = df.join(dependable_places(refs, key), key, "left")
    return joined.withColumn(out, F.round(haversine(F.col("lat"), F.col("lon"), F.col("ref_lat"), F.col("ref_lon")), 3)).drop("ref_lon", "ref_lat")


def elevation_difference(df: DataFrame, elevations: DataFrame, place: list[str], height: Column) -> DataFrame:
    """GEO-7, JN-12: |height - ground| from a table of looked-up places."""
    return df.join(elevations, place, "left").withColumn("DEM_DIFF", F.abs(height - F.col("elevation")))


def needs_check(dem: str = "DEM_DIFF", spread: str = "SPREAD_KM", confidence: str = "CONFIDENCE", level: str = "LEVEL") -> Column:
    """FLT-4: unknown values never raise a flag."""
    return F.coalesce(F.col(dem) > 50, F.lit(False)) | F.coalesce(F.col(spread) > 1, F.lit(False)) | F.coalesce((F.col(confidence) == "low") & (F.col(level) != "city"), F.lit(False))


def comparable(df: DataFrame, level: str | None = None, column: str = "LEVEL", height: str = "HEIGHT") -> DataFrame:
    """FLT-5: rows of one level, or of all, whose height is known."""
    known = df.filter(F.col(height).isNotNull())
    return known if level is None else known.filter(F.col(column) == level)


def numeric(df: DataFrame, columns: list[str], tolerated: float = 0.0) -> DataFrame:
    """PRJ-11: text columns as numbers; an error if more than the tolerated share of rows would lose a value.

    Where none may be lost the first such value raises as it is read, in the one scan there is. A share is counted before.
    """
    lost = {c: (F.col(c) != "") & number_of(F.col(c)).isNull() for c in columns}
    if not tolerated:
        error = lambda c: F.raise_error(F.concat(F.lit(f"column {c}: text that is no number: "), F.col(c))).cast("double")
        return df.withColumns({c: F.when(lost[c], error(c)).otherwise(number_of(F.col(c))) for c in columns})
    got = df.agg(F.count("*").alias("n"), *[F.count_if(x).alias(c) for c, x in lost.items()]).first()
    bad = {c: got[c] for c in columns if got[c] > tolerated * got["n"]}
    if bad:
        raise ValueError(f"columns with text that is no number: {bad}")
    return df.withColumns({c: number_of(F.col(c)) for c in columns})


def sampled(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """SRT-4, SRT-5: a reproducible sample of n distinct keys, by their hash."""
    return df.select(*key).distinct().orderBy(F.md5(F.concat_ws("|", *key)), *key).limit(n)


def first_of(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """SRT-4: one row a key, the first in order."""
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")
