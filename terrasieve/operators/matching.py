"""Matching names in order of candidates (JN-5 to JN-11, JN-15, AGG-11, AGG-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .areas import nearest_cells
from .rounds import settled


def town_keys(towns: DataFrame, key, arabic) -> DataFrame:
    """JN-6: a row for each distinct key of a town with a place: its name, with its block (as written and in digits), with its small area."""
    name, block, area = F.col("oaza_cho"), F.coalesce("chome", F.lit("")), F.coalesce("koaza", F.lit(""))
    options = F.array(
        name, F.when(block != "", F.concat(name, block)).otherwise(""), F.when(block != "", F.concat(name, arabic(block))).otherwise(""),
        F.when(area != "", F.concat(name, area)).otherwise(""),
    )
    placed = towns.filter("lon IS NOT NULL AND lat IS NOT NULL").withColumn("key", F.explode(F.array_distinct(options)))
    return placed.withColumn("key", key(F.col("key"))).filter("key <> ''").distinct()


def first_unique(units: DataFrame, keys: DataFrame, unit: str, scope: str, group: str, order: str, most: int = 8) -> DataFrame:
    """JN-5, WIN-7: the first candidate that names one `group` within the scope; else the first that names several.

    `units` has `unit`, `scope` and `cands`; `keys` has `scope`, `key`, `group` and `order`, by which entries rank. Gives
    (unit, status, used_cand, match, n_groups, groups): status unique, ambiguous, unmatched or no_candidate. One
    equi-join on (scope, key) and one aggregate a key, however many units try it.
    """
    tried = units.select(unit, scope, F.posexplode("cands").alias("pos", "key"))
    entries = keys.join(tried.select(scope, "key"), [scope, "key"], "left_semi").groupBy(scope, "key").agg(
        F.count_distinct(group).alias("n_groups"), F.min(F.struct(order, group)).alias("match"),
        F.array_join(F.slice(F.array_sort(F.collect_set(group)), 1, most), ",").alias("groups"),
    )
    hits = tried.join(entries, [scope, "key"])
    best = hits.groupBy(unit).agg(F.min(F.struct((F.col("n_groups") > 1).alias("several"), "pos", F.col("key").alias("used_cand"), "n_groups", "match", "groups")).alias("b"))
    out = units.select(unit, F.size("cands").alias("n")).join(best, unit, "left")
    status = F.when(F.col("n") == 0, "no_candidate").when(F.col("b").isNull(), "unmatched").when(F.col("b.several"), "ambiguous").otherwise("unique")
    return out.select(unit, status.alias("status"), "b.used_cand", F.when(status == "unique", F.col(f"b.match.{group}")).alias("match"), "b.n_groups", F.when(status == "ambiguous", F.col("b.groups")).alias("groups"))


def exact_then_prefix(units: DataFrame, towns: DataFrame, unit: str, scope: str, aggregates: list[Column], least: int = 2) -> DataFrame:
    """JN-7, JN-8: by candidate, towns whose full or short name equals it, else starts with it, within the scope.

    `towns` has `scope`, `town` (its id), `full` and `short`. Names' prefixes become keys, so that both are one equi-join
    and no unit is compared with all towns of its scope; towns are aggregated once a key, not once a unit. Gives the first
    success of a unit: pos, mode, key, and the aggregates over all its towns.
    """
    prefixes = F.transform(F.sequence(F.lit(least), F.greatest(F.length("name"), F.lit(least))), lambda i: F.substring(F.col("name"), 1, i))
    names = towns.withColumn("name", F.explode(F.array_distinct(F.array("full", "short")))).filter(F.length("name") >= least)
    keyed = names.withColumn("key", F.explode(prefixes)).withColumn("mode", F.when(F.col("key") == F.col("name"), 0).otherwise(1))
    tried = units.select(unit, scope, F.posexplode("cands").alias("pos", "key")).filter(F.length("key") >= least)
    asked = keyed.drop("name").join(tried.select(scope, "key"), [scope, "key"], "left_semi")
    one = asked.groupBy(scope, "key", "town").agg(F.min("mode").alias("mode"), *[F.first(c).alias(c) for c in towns.columns if c not in (scope, "town", "full", "short")])
    exact = F.min("mode").over(Window.partitionBy(scope, "key"))
    hits = one.withColumn("exact", exact).filter((F.col("mode") == 0) | (F.col("exact") == 1))
    entries = hits.groupBy(scope, "key", F.when(F.col("exact") == 0, "exact").otherwise("prefix").alias("mode")).agg(*aggregates)
    rest = [c for c in entries.columns if c not in (scope, "key")]
    best = tried.join(entries, [scope, "key"]).groupBy(unit).agg(F.min_by(F.struct("pos", "key", *rest), "pos").alias("b"))
    return best.select(unit, "b.*")


def suffix_keys(names: DataFrame, name: str, least_key: int = 2, least_before: int = 2) -> DataFrame:
    """JN-9's build side: every ending of a name that leaves enough before it, as a key for an equi-join."""
    longest = F.length(name) - least_before
    ends = F.when(longest >= least_key, F.transform(F.sequence(F.lit(least_key), longest), lambda i: F.substring(F.col(name), F.length(name) - i + 1, i)))
    return names.withColumn("key", F.explode(ends))


def suffix_unique(units: DataFrame, names: DataFrame, unit: str, scope: str, group: str, name: str, aggregates: list[Column] | None = None, least: int = 2) -> DataFrame:
    """JN-9, GEO-3: the first candidate that ends names of one group only; candidates that end several groups' are passed over.

    Every row of `names` is an entry, also where entries share a name: one entry makes the level town, several make it
    oaza. `aggregates` run over the entries hit (a mean place, its spread), once a key and not once a unit.
    """
    tried = units.select(unit, scope, F.posexplode("cands").alias("pos", "key"))
    asked = suffix_keys(names, name, least, 2).join(tried.select(scope, "key"), [scope, "key"], "left_semi")
    entries = asked.groupBy(scope, "key").agg(
        F.min(group).alias("match"), F.max(group).alias("__other"), F.count("*").alias("n_entries"), *(aggregates or []))
    one = tried.join(entries.filter(F.col("match") == F.col("__other")).drop("__other"), [scope, "key"]).drop(scope)
    best = one.groupBy(unit).agg(F.min_by(F.struct(*[c for c in one.columns if c != unit]), "pos").alias("b"))
    return best.select(unit, "b.*", F.when(F.col("b.n_entries") == 1, "town").otherwise("oaza").alias("level"))


def zip_by_position(left: DataFrame, right: DataFrame, group: str, left_order: list, right_order: list) -> DataFrame:
    """JN-10, WIN-6: pairs the nth rows of a group on both sides, where both have as many."""

    def placed(df: DataFrame, order: list) -> DataFrame:
        by = Window.partitionBy(group)
        return df.withColumn("n", F.count("*").over(by)).withColumn("nth", F.row_number().over(by.orderBy(*order)))

    return placed(left, left_order).join(placed(right, right_order), [group, "n", "nth"])


def band_nearest(left: DataFrame, right: DataFrame, equal: list[str], bands: list[tuple[Column, Column, float]], distance: Column, left_id: str, tie: list[str], keep: list[str] | None = None) -> DataFrame:
    """JN-11, SRT-3: rows of equal key within all bands; of each left row the nearest, first by `tie`.

    A band is a column of the left side, one of the right side, and how far apart they may be. The first band's buckets are
    part of the join key (left rows, of which each gives one row at most, go to three), so rows of a hot key meet those near
    them only. `keep` are columns to give beside the distance and `tie`; without it, all are carried along.
    """
    of_left, of_right, most = bands[0]
    spread = left.withColumn("__bucket", F.explode(F.array(*[F.floor(of_left / most) + i for i in (-1, 0, 1)])))
    near = right.withColumn("__bucket", F.floor(of_right / most)).join(spread, [*equal, "__bucket"]).drop("__bucket")
    for a, b, most in bands:
        near = near.filter(F.abs(a - b) <= most)
    near = near.withColumn("distance", distance)
    rest = [c for c in (near.columns if keep is None else keep) if c not in ("distance", left_id, *tie)]
    return near.groupBy(left_id).agg(F.min(F.struct("distance", *tie, *rest)).alias("m")).select(left_id, "m.*")


def nearest_in_grid(points: DataFrame, refs: DataFrame, cell: float, point_id: str, ref_id: str) -> DataFrame:
    """Of each point the nearest reference within `cell` on the plane (x, y); `nearest` looks farther.

    References are sent to the nine cells around them, so that one equi-join on the cell finds all within reach.
    """
    at = lambda c: F.floor(F.col(c) / cell)
    around = F.explode(F.array(*[F.struct((at("rx") + i).alias("cx"), (at("ry") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    spread = refs.select(F.col(ref_id), F.col("x").alias("rx"), F.col("y").alias("ry")).withColumn("c", around).select(ref_id, "rx", "ry", "c.cx", "c.cy")
    pairs = points.withColumns({"cx": at("x"), "cy": at("y")}).join(spread, ["cx", "cy"])
    pairs = pairs.withColumn("distance", F.hypot(F.col("x") - F.col("rx"), F.col("y") - F.col("ry"))).filter(F.col("distance") <= cell)
    return pairs.groupBy(point_id).agg(F.min(F.struct("distance", ref_id)).alias("m")).select(point_id, f"m.{ref_id}", "m.distance")


CROWD = 8  # references in a cell that are compared without finer cells


def nearest(points: DataFrame, refs: DataFrame, cell: float, point_id: str, ref_id: str) -> DataFrame:
    """JN-15: of each point the nearest reference, however far, ties to the smaller id.

    `cell` is where the search begins. Points without a reference that near go down a pyramid of occupied cells, whose
    lowest level is as fine as the fullest cell asks for, so a far crowd of references is never one key. Points and
    references with null or non-finite coordinates take no part; references at one place are one, with the smallest id.
    """
    finite = lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c)
    left = points.filter(finite(F.col("x")) & finite(F.col("y"))).select(point_id, "x", "y")
    refs = settled(refs.filter(finite(F.col("x")) & finite(F.col("y"))).groupBy("x", "y").agg(F.min(ref_id).alias(ref_id)))
    found = settled(nearest_in_grid(left, refs, cell, point_id, ref_id))
    left = settled(left.join(found.select(point_id), point_id, "left_anti"))
    if left.isEmpty():
        return found
    at = lambda c, side: F.floor(F.col(c) / side)
    fullest = refs.groupBy(at("x", cell), at("y", cell)).count().agg(F.max("count")).first()[0] or 1
    fine = cell / (1 << max(0, (fullest // CROWD).bit_length() + 1) // 2)
    placed = refs.withColumns({"row": at("y", fine), "col": at("x", fine)})
    near = nearest_cells(left, placed, fine, point_id, [])
    pairs = left.join(near, point_id).join(placed.select("row", "col", F.col("x").alias("rx"), F.col("y").alias("ry"), ref_id), ["row", "col"])
    pairs = pairs.withColumn("distance", F.hypot(F.col("x") - F.col("rx"), F.col("y") - F.col("ry")))
    far = pairs.groupBy(point_id).agg(F.min(F.struct("distance", ref_id)).alias("m")).select(point_id, f"m.{ref_id}", "m.distance")
    return found.unionByName(far)


def resume(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """JN-14, SET-4: what has not been gone through; failures count as gone through."""
    return todo.join(done.select(key).distinct(), key, "left_anti")
