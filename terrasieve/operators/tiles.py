"""A pyramid of map tiles under a cap of bytes (SNK-8, GEO-12): where a tile is too heavy, its densest points go first."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import hilbert, tile
from .rounds import settled

ORDER = 16  # bits of each coordinate along the curve: cells of the 16th zoom
TIE = 24  # low bits of a rank, which tell points of one cell apart
BITS = 2 * ORDER + TIE  # of a rank
ROUND = 14  # bits of the rank that a round settles: a window sees so many sums of a tile, never its points


def gaps(df: DataFrame, place: str, out: str) -> DataFrame:
    """`df` with how far behind the one before it each row lies along `place`; 2 ** (2 * ORDER) - 1 for the first.

    Rows at one place are counted first, so a crowd is one row; the rest is one range shuffle, a window in each of its
    parts, and a row a part for what lies before it. Rows that share a place have no gap but for the one of smallest rank.
    """
    spots = df.select(place).distinct().repartitionByRange(place).sortWithinPartitions(place)
    spots = settled(spots.withColumn("__part", F.spark_partition_id()))
    ends = spots.groupBy("__part").agg(F.max(place).alias("__end"))
    before = ends.withColumn("__before", F.lag("__end").over(Window.orderBy("__part"))).select("__part", "__before")  # a row a part
    by = Window.partitionBy("__part").orderBy(place)
    behind = spots.withColumn("__last", F.lag(place).over(by)).join(F.broadcast(before), "__part")
    gap = F.least(F.col(place) - F.coalesce("__last", "__before"), F.lit((1 << 2 * ORDER) - 1))
    return df.join(behind.select(place, F.coalesce(gap, F.lit((1 << 2 * ORDER) - 1)).alias(out)), place)


def thresholds(rows: DataFrame, keys: list[str], rank: str, size: str, cap: int) -> DataFrame:
    """(keys, least): the smallest rank from which on the sizes of a group stay within the cap; groups that fit have 0.

    A search by digits: each round sums sizes by the next ROUND bits of the rank and goes on in the one stretch that the cap
    cuts. Sums are combined before the shuffle, and a window runs over the sums of one stretch, so a group may hold a third
    of all rows.
    """
    shown = rows.select(*keys, F.col(rank).alias("__rank"), F.col(size).alias("__size"))
    low = shown.groupBy(*keys).agg(F.sum("__size").alias("__all")).filter(F.col("__all") > cap).select(*keys, F.lit(0).cast("long").alias("__prefix"), F.lit(0).cast("long").alias("__above"))
    fits = shown.groupBy(*keys).agg(F.sum("__size").alias("__all")).filter(F.col("__all") <= cap).select(*keys, F.lit(0).cast("long").alias("least"))
    low = settled(low)
    for done in range(0, ROUND * ceil(BITS / ROUND), ROUND):
        rest = ROUND * ceil(BITS / ROUND) - done  # bits that are open
        inside = shown.join(low, keys).filter(F.shiftright("__rank", rest) == F.col("__prefix"))
        digit = F.shiftright("__rank", rest - ROUND)
        sums = inside.groupBy(*keys, digit.alias("__digit"), "__above").agg(F.sum("__size").alias("__sum"))
        by = Window.partitionBy(*keys).orderBy(F.desc("__digit"))
        cut = sums.withColumn("__total", F.col("__above") + F.sum("__sum").over(by)).filter(F.col("__total") > cap)
        low = settled(cut.groupBy(*keys).agg(F.max(F.struct("__digit", (F.col("__total") - F.col("__sum")).alias("above"))).alias("__c")).select(*keys, F.col("__c.__digit").alias("__prefix"), F.col("__c.above").alias("__above")))
    return fits.unionByName(low.select(*keys, (F.col("__prefix") + 1).alias("least")))  # the stretch that is one rank breaks the cap


def pyramid(df: DataFrame, lon: str, lat: str, zooms: range, size: Column, tie: Column, cap: int) -> DataFrame:
    """`df` once for each zoom where it is shown, with z, tx, ty and bytes: no tile is heavier than the cap.

    `size` is what a row takes in a tile, encoded. Rows are ranked by the gap to the row before them along a Hilbert
    curve, so where points crowd they go first, and by `tie` (0 to 2**24 - 1) at one place. The gap is one number for all
    zooms, as a tile is a stretch of the curve. Rows without a place are left out.
    """
    placed = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    x, y = tile(F.col(lon), F.col(lat), ORDER)
    placed = placed.withColumns({"__tx": x, "__ty": y, "__tie": tie.cast("long"), "bytes": size.cast("long")})
    placed = settled(placed.withColumn("__place", hilbert(F.col("__tx"), F.col("__ty"), ORDER)))
    first = placed.groupBy("__place").agg(F.max("__tie").alias("__first"))
    ranked = gaps(placed.join(first, "__place"), "__place", "__gap")
    rank = F.when(F.col("__tie") == F.col("__first"), F.col("__gap")).otherwise(0) * (1 << TIE) + F.col("__tie")
    levels = F.explode(F.array(*[F.lit(z) for z in zooms]))
    spread = ranked.withColumn("__rank", rank).withColumn("z", levels)
    at = lambda c: F.expr(f"cast(shiftright({c}, {ORDER} - z) as int)")
    spread = settled(spread.withColumns({"tx": at("__tx"), "ty": at("__ty")}))
    least = thresholds(spread, ["z", "tx", "ty"], "__rank", "bytes", cap)
    kept = spread.join(least, ["z", "tx", "ty"]).filter(F.col("__rank") >= F.col("least"))
    return kept.drop("least", "__rank", "__gap", "__tie", "__first", "__place", "__tx", "__ty")
