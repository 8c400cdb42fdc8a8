"""Maps from pages to the ground as columns and sums (GEO-11, GEO-16, JN-16, AGG-17, NUM-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pairing_cost(distance, outside_km, mismatch, outside: float = 1000.0, cap: float = 3.0, penalty: float = 1e6):
    """JN-16: pixels apart, kilometres outside the area up to a cap, and a penalty for another colour."""
    return distance + outside * F.least(outside_km, F.lit(cap)) + F.when(mismatch, penalty).otherwise(0.0)


def scale_bar(spans: DataFrame, page: str) -> DataFrame:
    """GEO-16: points a kilometre from the numbers (value, x, y) of a page's scale bar near its unit label: the baseline with
    three or more numbers, zero among them, and the slope of x over value."""
    lines = spans.filter(F.abs(F.col("y") - F.col("label_y")) <= 14).groupBy(page, "y").agg(
        F.count("*").alias("n"), F.min(F.abs(F.col("value"))).alias("low"), F.regr_slope("x", "value").alias("slope"), F.min(F.abs(F.col("y") - F.col("label_y"))).alias("apart"))
    good = lines.filter("n >= 3 AND low = 0 AND slope > 0")
    return good.groupBy(page).agg(F.min_by("slope", F.struct("apart", "y")).alias("points_per_km"))


def affine_by_centroids(pairs: DataFrame, group: str, least: int = 3) -> DataFrame:
    """GEO-11, AGG-17: the affine map of each group by least squares on pairs (x, y) -> (u, v): Cramer's rule on covariances,
    which Spark combines. Groups with too few distinct places, or with all of them on a line, have none.
    """
    moments = {"xx": F.var_pop("x"), "yy": F.var_pop("y"), "xy": F.covar_pop("x", "y"), "mx": F.avg("x"), "my": F.avg("y")}
    for to in ("u", "v"):
        moments |= {f"x{to}": F.covar_pop("x", to), f"y{to}": F.covar_pop("y", to), f"m{to}": F.avg(to)}
    sums = pairs.groupBy(group).agg(F.count_distinct("x", "y").alias("places"), *[c.alias(k) for k, c in moments.items()])
    sums = sums.withColumn("det", F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")).filter((F.col("places") >= least) & (F.col("det") > 1e-12 * F.col("xx") * F.col("yy")))
    for to in ("u", "v"):
        sums = sums.withColumns({f"a{to}": (F.col(f"x{to}") * F.col("yy") - F.col(f"y{to}") * F.col("xy")) / F.col("det"), f"b{to}": (F.col(f"y{to}") * F.col("xx") - F.col(f"x{to}") * F.col("xy")) / F.col("det")})
    ends = [F.col(f"m{to}") - F.col(f"a{to}") * F.col("mx") - F.col(f"b{to}") * F.col("my") for to in ("u", "v")]
    return sums.select(group, F.array("au", "av", "bu", "bv", *ends).alias("coefficients"))


def affine_by_boxes(boxes: DataFrame) -> DataFrame:
    """GEO-11: maps the box (x0, y0, x1, y1) onto (u0, v0, u1, v1), y turned over, as pages count downwards."""
    sx, sy = (F.col("u1") - F.col("u0")) / (F.col("x1") - F.col("x0")), (F.col("v0") - F.col("v1")) / (F.col("y1") - F.col("y0"))
    zero = F.lit(0.0)
    return boxes.withColumn("coefficients", F.array(sx, zero, zero, sy, F.col("u0") - F.col("x0") * sx, F.col("v1") - F.col("y0") * sy))


def scale_plausible(coefficients, points_per_km, lat0, tolerance: float = 0.05):
    """NUM-6: whether an affine map to degrees keeps the page's scale, to the tolerance, in both directions."""
    km = lambda i, j: F.hypot(coefficients[i] * 111.320 * F.cos(F.radians(lat0)), coefficients[j] * 110.574)
    near = lambda x: F.abs(x * points_per_km - 1) <= tolerance
    return near(km(0, 1)) & near(km(2, 3))
