"""Error reports (AGG-7, AGG-8, AGG-17, AGG-18, AGG-20, AGG-21, SRT-2, FLT-8, WIN-8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .rounds import settled

CLOSE = 10_000  # 1 / the share of a group's values that the approximate quantiles may be off by


def exact_percentiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """(group, one column a share): exact quantiles of each group, interpolated between neighbours; nulls do not count.

    No task gathers the values of a group. Mergeable approximate quantiles give an interval of values around each rank,
    whose error they bound; rows below it are counted, and only what lies inside it, some ten-thousandths of the group,
    with equal values counted as one, is ranked. Groups of fewer than 10,000 values are ranked whole.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    names, slack = list(shares), 2 / CLOSE
    ends = [min(max(q + side * slack, 0.0), 1.0) for q in shares.values() for side in (-1, 1)]
    near = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.percentile_approx("v", ends, CLOSE).alias("ends"))
    small = F.col("n") < CLOSE
    bounds = [F.struct(F.lit(i).alias("i"), F.when(small, F.col("low")).otherwise(F.col("ends")[2 * i]).alias("a"), F.when(small, F.col("high")).otherwise(F.col("ends")[2 * i + 1]).alias("b")) for i in range(len(names))]
    near = near.select(F.col("g").alias("of"), "n", F.array(*bounds).alias("bounds"))
    joined = rows.join(near, F.col("g").eqNullSafe(F.col("of"))).select("g", "n", "v", "bounds")
    below = F.transform("bounds", lambda b: F.struct(b["i"].alias("i"), F.when(F.col("v") < b["a"], -1).when(F.col("v") <= b["b"], 0).otherwise(1).alias("side")))
    sides = joined.select("g", "n", "v", F.explode(below).alias("s")).filter("s.side <= 0")
    counted = sides.groupBy("g", "n", "s.i", F.when(F.col("s.side") == 0, F.col("v")).alias("v")).agg(F.count("*").alias("k"))
    upto = F.sum("k").over(Window.partitionBy("g", "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("upto", upto).filter("v IS NOT NULL")
    q = F.get(F.array(*[F.lit(float(x)) for x in shares.values()]), F.col("i"))
    place = ranked.withColumn("at", (F.col("n") - 1) * q)
    has = lambda k: (F.col("upto") > k) & (F.col("upto") - F.col("k") <= k)
    ends = place.groupBy("g", "i").agg(F.max("at").alias("at"), F.max(F.when(has(F.floor("at")), F.col("v"))).alias("x"), F.max(F.when(has(F.ceil("at")), F.col("v"))).alias("y"))
    share = F.col("at") - F.floor("at")
    exact = ends.withColumn("z", F.when(F.col("x") == F.col("y"), F.col("x")).otherwise(F.col("x") * (1 - share) + F.col("y") * share))
    return exact.groupBy("g").agg(*[F.max(F.when(F.col("i") == i, F.col("z"))).alias(name) for i, name in enumerate(names)]).withColumnRenamed("g", group)


def error_stats(df: DataFrame, level: str, error: str) -> DataFrame:
    """AGG-7, AGG-9: n, median, mean, 90th percentile and maximum of each level, and of all as `overall`."""
    both = df.select(F.explode(F.array(F.col(level), F.lit("overall"))).alias("level"), F.col(error).alias("__error"))
    plain = both.groupBy("level").agg(F.count("*").alias("n"), F.round(F.avg("__error"), 3).alias("mean"), F.max("__error").alias("worst"))
    exact = exact_percentiles(both, "level", "__error", {"median": 0.5, "p90": 0.9}).withColumnRenamed("level", "__level")
    joined = plain.join(exact, F.col("level").eqNullSafe(F.col("__level")), "left")
    return joined.select("level", "n", F.round("median", 3).alias("median"), "mean", F.round("p90", 3).alias("p90"), "worst")


def threshold_shares(df: DataFrame, error: str, limits: tuple[float, ...] = (0.2, 0.5, 1.0, 2.0, 5.0)) -> DataFrame:
    """AGG-8: the share of rows within each limit."""
    wide = df.agg(*[F.round(F.avg((F.col(error) <= x).cast("double")), 6).alias(str(i)) for i, x in enumerate(limits)])
    pairs = F.array(*[F.struct(F.lit(float(x)).alias("within"), F.col(str(i)).alias("share")) for i, x in enumerate(limits)])
    return wide.select(F.explode(pairs).alias("p")).select("p.*")


def worst(df: DataFrame, error: str, tie: str, n: int = 10) -> DataFrame:
    """SRT-2."""
    return df.orderBy(F.desc(error), tie).limit(n)


def trimmed_mean(df: DataFrame, group: str, value: str, keep: float = 0.9) -> DataFrame:
    """AGG-18: the mean of the values below each group's quantile."""
    edge = exact_percentiles(df, group, value, {"edge": keep})
    kept = df.join(edge, group).filter(F.col(value) < F.col("edge"))
    return kept.groupBy(group).agg(F.count("*").alias("n"), F.round(F.avg(value), 6).alias("trimmed_mean"))


def occupied_cells(df: DataFrame, x: Column, y: Column, cell: float) -> DataFrame:
    """AGG-20: the cells of a grid that hold a point."""
    return df.select(F.floor(x / cell).alias("cell_x"), F.floor(y / cell).alias("cell_y")).distinct()


def widest_class(df: DataFrame, cls: str, x: str, y: str, least: float, page: float) -> DataFrame:
    """AGG-19: the class whose points spread widest, if to a share of the page; its bounding box."""
    box = df.groupBy(cls).agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    area = box.withColumn("area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    wide = area.filter(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) >= least * page)
    return wide.orderBy(F.desc("area"), cls).limit(1)


def accepted_groups(df: DataFrame, group: str, distance: str, near: float = 1.0, share: float = 0.9) -> DataFrame:
    """FLT-8, AGG-21: groups of which enough rows are near."""
    g = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col(distance) <= near).alias("n_near"), F.max(distance).alias("farthest"))
    return g.withColumn("share", F.round(F.col("n_near") / F.col("n"), 6)).filter(F.col("n_near") >= share * F.col("n"))


def by_frequency(df: DataFrame, column: str) -> DataFrame:
    """SRT-7: values and how many rows have them, most frequent first, equals by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def islands(df: DataFrame, group: str, order: list, gap: Column) -> DataFrame:
    """WIN-8: numbers the runs of a group in order; `gap` tells where a row begins a new one."""
    by = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__new", F.coalesce(gap.cast("int"), F.lit(1))).withColumn("island", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def spaced_sample(df: DataFrame, order: list, n: int, most: int) -> DataFrame:
    """SRT-6: at most `most` rows, evenly over n rows in order; rows are numbered by counts a partition, not in one task."""
    if n <= most:
        return df
    part, pos = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": part, "__pos": pos})
    placed = settled(placed)
    counts, at, starts = dict(placed.groupBy("__part").count().collect()), 0, {}
    for p in sorted(counts):
        starts[p], at = at, at + counts[p]
    first = F.try_element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("__part"))
    row = first + F.col("__pos")
    step = (n - 1) / (most - 1) if most > 1 else n
    nth = F.ceil(row / step)
    return placed.filter(F.floor(nth * step) == row).filter(nth < most).drop("__part", "__pos")
