"""What a map front end asks for: themes, filters, counts, tiles, attributes (PRJ-19 to PRJ-27, FLT-9, FLT-10, AGG-10, AGG-16, SRT-8, GEO-12)."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import tile

MISSING = -1e9  # stands for a missing value in steps and depths; distances use -1
# Where the distance slider stops, in km.
DISTANCE_STOPS = (0.1, 0.2, 0.3, 0.5, 0.75, 1, 1.25, 1.5, 2, 2.5, 3, 4, 5, 6, 8, 10, 12, 15, 20, 30, 50)


def distance_at(stop: int) -> float | None:
    """PRJ-27: the limit at a place of the slider; past the last stop there is none."""
    return DISTANCE_STOPS[stop] if stop < len(DISTANCE_STOPS) else None


@dataclass(frozen=True)
class Categories:
    """A theme of listed values."""

    prop: str
    values: tuple[str, ...]
    other: str = "__other__"
    name_other: bool = False

    def bin(self) -> Column:
        """PRJ-19."""
        v = F.coalesce(F.col(self.prop).cast("string"), F.lit(""))
        return F.when(v.isin(*self.values), v).otherwise(self.other)

    def only(self, item: str) -> Column:
        """FLT-10."""
        v = F.coalesce(F.col(self.prop).cast("string"), F.lit(""))
        return ~v.isin(*self.values) if item == self.other else v == item

    def legend(self) -> list[str]:
        return [*self.values, *([self.other] if self.name_other else [])]


@dataclass(frozen=True)
class Steps:
    """A theme of number ranges, closed to the left; below `least` there are no data."""

    prop: str
    least: float
    steps: tuple[float, ...]

    def _value(self) -> Column:
        return F.coalesce(F.col(self.prop).cast("double"), F.lit(MISSING))

    def bin(self) -> Column:
        """PRJ-20."""
        v, out = self._value(), F.lit("0")
        for i, edge in enumerate(self.steps, 1):
            out = F.when(v >= edge, str(i)).otherwise(out)
        return F.when(v < self.least, "nodata").otherwise(out)

    def only(self, item: str) -> Column:
        """FLT-10."""
        v = self._value()
        if item == "nodata":
            return v < self.least
        i = int(item)
        above = v >= (self.least if i == 0 else self.steps[i - 1])
        return above & (v < self.steps[i]) if i < len(self.steps) else above

    def legend(self) -> list[str]:
        return [*map(str, range(len(self.steps) + 1)), "nodata"]


@dataclass(frozen=True)
class FilterState:
    """FLT-9, PRJ-27: what is shown."""

    classes: frozenset[str] = frozenset({"unique"})
    max_distance: float | None = None
    include_unknown: bool = False
    min_depth: float = 0
    isolate: str | None = None
    theme: Categories | Steps | None = None
    columns: dict[str, str] = field(default_factory=lambda: {"class": "POS_QUALITY", "distance": "ADR_DIST_KM_N", "depth": "DEP"})

    def predicate(self) -> Column:
        d = F.coalesce(F.col(self.columns["distance"]), F.lit(-1.0))
        parts = [F.col(self.columns["class"]).isin(*sorted(self.classes)) if self.classes else F.lit(False)]
        if self.max_distance is not None:
            within = (d >= 0) & (d <= self.max_distance)
            parts.append(within | (d < 0) if self.include_unknown else within)
        elif not self.include_unknown:
            parts.append(d >= 0)
        if self.min_depth > 0:
            parts.append(F.coalesce(F.col(self.columns["depth"]), F.lit(MISSING)) >= self.min_depth)
        if self.isolate and self.theme:
            parts.append(self.theme.only(self.isolate))
        return reduce(lambda a, b: a & b, parts)


def stats(df: DataFrame, cls: str, distance: str) -> DataFrame:
    """AGG-10, SNK-9: rows of each class, and how many have a known distance."""
    return df.groupBy(F.col(cls).alias("cls")).agg(F.count("*").alias("n"), F.count_if(F.col(distance) >= 0).alias("n_resolved"))


def viewer_stats(df: DataFrame, cls: str, use: str, distance: str, year: str, zooms: range) -> DataFrame:
    """SNK-9: (stat, item, value): all counts a viewer needs, from one aggregate by class and use; year 0 is unknown.

    The total and the range of years and zooms have no item or min and max.
    """
    cube = df.groupBy(F.col(cls).cast("string").alias("cls"), F.col(use).cast("string").alias("use")).agg(
        F.count("*").alias("n"), F.count_if(F.col(distance) >= 0).alias("known"), F.min(F.nullif(F.col(year), F.lit(0))).alias("first"), F.max(year).alias("last"))
    row = lambda stat, item, value: F.struct(F.lit(stat).alias("stat"), item.cast("string").alias("item"), value.cast("long").alias("value"))
    none = F.lit(None)
    sums = cube.groupingSets([[], ["cls"], ["use"]], "cls", "use").agg(F.grouping_id().alias("of"), F.sum("n").alias("n"), F.sum("known").alias("known"), F.min("first").alias("first"), F.max("last").alias("last"))
    whole = F.array(row("total", none, F.col("n")), row("distResolved", none, F.col("known")), row("nenRange", F.lit("min"), F.col("first")), row("nenRange", F.lit("max"), F.col("last")),
                    row("minzoom", none, F.lit(zooms[0])), row("maxzoom", none, F.lit(zooms[-1])), row("completeFromZoom", none, F.lit(zooms[-1])))
    of_class = F.array(row("posQuality", F.col("cls"), F.col("n")), row("posQualityDistResolved", F.col("cls"), F.col("known")))
    shown = F.when(F.col("of") == 3, whole).when(F.col("of") == 1, of_class).otherwise(F.array(row("use", F.col("use"), F.col("n"))))
    return sums.select(F.explode(shown).alias("s")).select("s.*")


def selected_total(cube: DataFrame, state: FilterState) -> DataFrame:
    """AGG-16: rows shown, from the counts alone, and whether that is exact."""
    counted = F.col("n") if state.include_unknown else F.col("n_resolved")
    exact = state.max_distance is None and state.min_depth == 0 and not state.isolate
    return cube.filter(F.col("cls").isin(*sorted(state.classes))).agg(F.coalesce(F.sum(counted), F.lit(0)).cast("long").alias("n"), F.lit(exact).alias("exact"))


def legend_counts(df: DataFrame, theme: Categories | Steps) -> DataFrame:
    """PRJ-26: legend items in order, with the rows of each."""
    items = df.sparkSession.createDataFrame(list(enumerate(theme.legend())), "ord int, item string")
    counts = df.groupBy(theme.bin().alias("item")).agg(F.count("*").alias("n"))
    return F.broadcast(items).join(counts, "item", "left").select("ord", "item", F.coalesce("n", F.lit(0)).alias("n"))


def interpolate(zoom: Column, stops: tuple[tuple[float, float], ...]) -> Column:
    """PRJ-21: linear between stops, flat beyond them."""
    out = F.lit(float(stops[-1][1]))
    for (z0, v0), (z1, v1) in reversed(list(zip(stops, stops[1:]))):
        out = F.when(zoom < z1, F.lit(float(v0)) + (zoom - z0) * (v1 - v0) / (z1 - z0)).otherwise(out)
    return F.when(zoom <= stops[0][0], float(stops[0][1])).otherwise(out)


def attributes(df: DataFrame, key: str, labels: dict[str, str], zero_missing: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-22: a row for each attribute of a row that has a value, in the dictionary's order, zeros marked where they mean missing."""
    entry = lambda i, c: F.struct(F.lit(i).alias("ord"), F.lit(labels[c]).alias("label"), F.when(F.lit(c in zero_missing) & (F.col(c).cast("double") == 0), F.concat(F.col(c).cast("string"), F.lit(" *"))).otherwise(F.col(c).cast("string")).alias("value"))
    rows = df.select(key, F.explode(F.array(*[entry(i, c) for i, c in enumerate(labels)])).alias("a")).select(key, "a.*")
    return rows.filter("value IS NOT NULL AND value <> ''")


def map_link(lon: Column, lat: Column, zoom: int, base: str) -> Column:
    """PRJ-23."""
    return F.concat(F.lit(f"{base}?zoom={zoom}&lat="), F.format_string("%.6f", lat), F.lit("&lon="), F.format_string("%.6f", lon))


def hit(df: DataFrame, x: Column, y: Column, box: tuple[float, float, float, float], order: list) -> DataFrame:
    """SRT-8, GEO-13: the first row in order within a box."""
    x0, y0, x1, y1 = box
    return df.filter(x.between(x0, x1) & y.between(y0, y1)).orderBy(*order).limit(1)


def tiles(df: DataFrame, lon: str, lat: str, zoom: int, order: list, most: int | None = None) -> DataFrame:
    """GEO-12, SNK-8: rows with their tile; below the complete zoom at most so many a tile, the first in order."""
    tx, ty = tile(F.col(lon), F.col(lat), zoom)
    placed = df.withColumns({"z": F.lit(zoom), "tx": tx, "ty": ty})
    if most is None:
        return placed
    nth = F.row_number().over(Window.partitionBy("z", "tx", "ty").orderBy(*order))
    return placed.withColumn("__nth", nth).filter(F.col("__nth") <= most).drop("__nth")
