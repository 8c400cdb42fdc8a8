"""What CSV files of any layout hold (HOF-1, FLT-15), and their rows as features (GEO-15). Cells stay distributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import header_key, looks_like_lot, numbers_in

# Names of columns.
DEPTH_HINTS = ("深度", "深さ", "さく井深", "井戸深", "掘削深")
ADDRESS_HINTS = ("住所", "所在地", "番地", "streetaddress")
HEADER_ROWS = 3  # titles and headers of two rows lie in them


def _any(c: Column, hints: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for hint in hints:
        out = out | c.contains(hint)
    return out


def long_cells(files: DataFrame) -> DataFrame:
    """(file, row_no, col_no, value) of (file, row_no, cells)."""
    return files.select("file", "row_no", F.posexplode("cells").alias("col_no", "value"))


def column_roles(cells: DataFrame) -> DataFrame:
    """HOF-1: (file, col_no, is_lat, is_lon, is_location, is_depth, is_address) from header cells, and from the cells' shape."""
    h = header_key(F.col("value"))
    head = F.col("row_no") < HEADER_ROWS
    role = lambda cond: F.bool_or(head & cond)
    lots = F.count_if((F.col("row_no") >= 1) & looks_like_lot(F.col("value")))
    return cells.groupBy("file", "col_no").agg(
        role(h.startswith("緯度") | (h == "lat") | h.startswith("latitude")).alias("is_lat"), role(h.startswith("経度") | (h == "lon") | h.startswith("longitude")).alias("is_lon"),
        role(h == "location").alias("is_location"), role(_any(h, DEPTH_HINTS)).alias("is_depth"), (role(_any(h, ADDRESS_HINTS)) | (lots >= 3)).alias("is_address"), lots.alias("n_lots"),
    )


def usable(files: DataFrame) -> DataFrame:
    """HOF-1, FLT-15: (file, n_rows, has_place, has_lot, has_depth, usable). Names alone do not count: some row must hold
    a latitude from 20 to 46 and a longitude from 122 to 154, or three rows a lot number."""
    cells = long_cells(files)
    roles = column_roles(cells)
    typed = cells.join(roles, ["file", "col_no"])
    inside = lambda low, high: F.exists(numbers_in(F.col("value")), lambda v: (v >= low) & (v <= high))
    lot = F.col("value").rlike("[0-9０-９]+\\s*[-－‐ー の丁目番地]+\\s*[0-9０-９]")
    rows = typed.filter("row_no >= 1").groupBy("file", "row_no").agg(
        F.bool_or((F.col("is_lat") | F.col("is_location")) & inside(20, 46)).alias("lat"), F.bool_or((F.col("is_lon") | F.col("is_location")) & inside(122, 154)).alias("lon"),
        F.count_if(F.col("is_address") & lot).alias("lots"),
    )
    places = rows.groupBy("file").agg(F.bool_or(F.col("lat") & F.col("lon")).alias("has_place"), (F.sum("lots") >= 3).alias("has_lot"))
    depth = roles.groupBy("file").agg(F.bool_or("is_depth").alias("has_depth"))
    n = files.groupBy("file").agg(F.greatest(F.count("*") - 1, F.lit(0)).alias("n_rows"))
    done = n.join(places, "file", "left").join(depth, "file", "left").fillna(False, ["has_place", "has_lot", "has_depth"])
    return done.withColumn("usable", F.col("has_depth") & (F.col("has_place") | F.col("has_lot")))


def placed_rows(files: DataFrame, geocoded: DataFrame) -> DataFrame:
    """GEO-15: (file, row_no, lat, lon, address, source): a location cell, else the latitude and longitude columns, else
    an answer (address, g_lat, g_lon) for the row's address; places outside 20 to 46 and 122 to 154 degrees go."""
    cells = long_cells(files)
    roles = column_roles(cells)
    best = F.row_number().over(Window.partitionBy("file").orderBy(F.desc("is_address"), F.desc("n_lots"), "col_no"))
    roles = roles.withColumn("is_address", F.col("is_address") & (best == 1))
    number = numbers_in(F.col("value"))
    pick = lambda role, v: F.min_by(F.when(F.col(role), v), F.when(F.col(role), F.col("col_no")))
    rows = cells.join(roles, ["file", "col_no"]).filter("row_no >= 1").groupBy("file", "row_no").agg(
        pick("is_location", number).alias("loc"), pick("is_lat", F.get(number, F.lit(0))).alias("lat"), pick("is_lon", F.get(number, F.lit(0))).alias("lon"), pick("is_address", F.trim("value")).alias("address"))
    both = F.when(F.size("loc") >= 2, F.struct(F.get("loc", F.lit(0)).alias("lat"), F.get("loc", F.lit(1)).alias("lon")))
    own = F.coalesce(both, F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon")))
    done = rows.withColumn("own", own).join(geocoded, "address", "left")
    done = done.withColumn("p", F.coalesce("own", F.when(F.col("g_lat").isNotNull(), F.struct(F.col("g_lat").alias("lat"), F.col("g_lon").alias("lon")))))
    done = done.filter(F.col("p.lat").between(20, 46) & F.col("p.lon").between(122, 154))
    return done.select("file", "row_no", "p.lat", "p.lon", "address", F.when(F.col("own").isNotNull(), "original").otherwise("geocoded").alias("source"))
