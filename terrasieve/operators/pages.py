"""Elements of map sheets, held as tables of spans, markers and strokes (FLT-12, FLT-13, WIN-8, JN-18, SRC-20, AGG-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.readers import is_decoration
from .evaluate import islands


def outside_legend(spans: DataFrame, legend: DataFrame, page: str, reach: float) -> DataFrame:
    """FLT-12: spans (x, y) that no legend text (lx, ly) of their page has within reach in both directions."""
    at = lambda c: F.floor(F.col(c) / reach)
    around = F.explode(F.array(*[F.struct((at("lx") + i).alias("cx"), (at("ly") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    boxes = legend.select(F.col(page).alias("__page"), "lx", "ly", around.alias("__cell"))  # a span meets only the legend of its own cells
    near = (F.abs(F.col("x") - F.col("lx")) <= reach) & (F.abs(F.col("y") - F.col("ly")) <= reach)
    same = (F.col(page) == F.col("__page")) & (at("x") == F.col("__cell.cx")) & (at("y") == F.col("__cell.cy"))
    return spans.join(boxes, same & near, "left_anti")


def merged_spans(spans: DataFrame, page: str) -> DataFrame:
    """WIN-8: text of neighbouring spans (text, x0, x1, y) on one line as one: (page, chain, run, x, x1, y, text).

    Spans go by (y to one digit, x0). A span joins the run before it if its y is less than 1 from that of the run's first
    span and it begins from -1 up to 2 after the last one's end. Windows cut a page into chains that cannot reach across;
    the few spans of a chain are then gone through in order.
    """
    line = F.round("y", 1)
    by = Window.partitionBy(page).orderBy(line, "x0", "y", "x1", "text")
    gap = F.col("x0") - F.lag("x1").over(by)
    fresh = (F.abs(F.col("y") - F.lag("y").over(by)) >= 1.2) | (gap < -1) | (gap >= 2)  # 1.2: y to one digit may hide some
    rows = islands(spans.withColumns({"__fresh": fresh, "__line": line}), page, ["__line", "x0", "y", "x1", "text"], F.col("__fresh"))
    parts = F.array_sort(F.collect_list(F.struct("__line", "x0", "y", "x1", "text")))
    item = lambda x, x1, y, text: F.struct(x.alias("x"), x1.alias("x1"), y.alias("y"), text.alias("text"))

    def joined(runs: Column, s: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        apart = s["x0"] - last["x1"]
        meets = F.coalesce((F.abs(s["y"] - last["y"]) < 1) & (apart >= -1) & (apart < 2), F.lit(False))
        return F.when(meets, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(item(last["x"], s["x1"], last["y"], F.concat(last["text"], s["text"]))))).otherwise(F.concat(runs, F.array(item(s["x0"], s["x1"], s["y"], s["text"]))))

    none = F.array().cast("array<struct<x:double,x1:double,y:double,text:string>>")
    runs = rows.groupBy(page, F.col("island").alias("chain")).agg(F.aggregate(parts, none, joined).alias("runs"))
    return runs.select(page, "chain", F.posexplode("runs").alias("run", "r")).select(page, "chain", "run", "r.*")


def legend_marker(texts: DataFrame, markers: DataFrame, page: str, text_id: str, kind: str, apart: float = 6.0) -> DataFrame:
    """JN-18: of each legend text (x, y) the nearest marker (mx, my) to its left on about its line; they meet by page and line."""
    lines = markers.withColumn("__line", F.explode(F.array(*[F.floor(F.col("my") / apart) + i for i in (-1, 0, 1)])))
    pairs = texts.withColumn("__line", F.floor(F.col("y") / apart)).join(lines, [page, "__line"]).filter((F.col("mx") < F.col("x")) & (F.abs(F.col("my") - F.col("y")) < apart))
    return pairs.groupBy(text_id).agg(F.min(F.struct((F.col("x") - F.col("mx")).alias("left_by"), kind)).alias("m")).select(text_id, f"m.{kind}", "m.left_by")


def boundary_cloud(strokes: DataFrame, page: str, width: float, height: float, least: float = 0.4) -> DataFrame:
    """SRC-20, AGG-19: (page, pen, x, y) of the strokes of the pen that spreads widest over its page, without decoration.

    A page on which no pen spreads over the least share keeps all its pens.
    """
    points = strokes.filter(~is_decoration(F.col("points"), width, height)).select(page, "pen", F.explode("points").alias("p")).select(page, "pen", "p.x", "p.y")
    box = points.groupBy(page, "pen").agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"))
    wide = box.filter((F.col("w") >= least * width) | (F.col("h") >= least * height))
    best = wide.groupBy(page).agg(F.max_by("pen", F.struct(F.col("w") * F.col("h"), "pen")).alias("best"))
    return points.join(best, page, "left").filter("best IS NULL OR pen = best").drop("best")


def ring_centroids(vertices: DataFrame, group: str) -> DataFrame:
    """AGG-13: (group, area, x, y) of polygons' vertices (ring, pos, x, y): rings of a group taken together, holes against outer rings by their direction."""
    by = Window.partitionBy(group, "ring").orderBy("pos")
    step = vertices.withColumns({"x2": F.lead("x").over(by), "y2": F.lead("y").over(by)}).filter("x2 IS NOT NULL")
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    sums = step.groupBy(group).agg(F.sum(cross).alias("a2"), F.sum((F.col("x") + F.col("x2")) * cross).alias("sx"), F.sum((F.col("y") + F.col("y2")) * cross).alias("sy"))
    return sums.filter("a2 <> 0").select(group, (F.abs("a2") / 2).alias("area"), (F.col("sx") / (3 * F.col("a2"))).alias("x"), (F.col("sy") / (3 * F.col("a2"))).alias("y"))
