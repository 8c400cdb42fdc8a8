"""Hard negatives by a vertical scan (BOND): columnar dimensions are read in each anchor's descending-magnitude order.

Every vector lies in one shard, a dimension a column there. After some dimensions each row still in the bitmap has a partial
score and, from the column's least and largest values, the least and the largest that the rest may add. Rows that no window
can want any more leave the bitmap; what is left at the end has exact scores.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

SHARD, LEAST_SHARD, ANCHOR_BLOCK = 65_536, 2048, 4096  # vectors of a shard at most, and of one worth a task; anchors of a block
STEP = 4  # dimensions read between two looks at the bitmap
LABELS = 10


class Columns:
    """The vectors of a shard, a row a dimension, with the least and the largest value of each."""

    def __init__(self, vectors: np.ndarray):
        self.values = np.ascontiguousarray(vectors.T)
        self.low, self.high = self.values.min(axis=1), self.values.max(axis=1)

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, want) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of those left at the end; `want` says which to keep from the scores' lower and upper bounds."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.sort(np.stack([anchor * self.low, anchor * self.high]), axis=0)[:, order]
        rest = np.concatenate([np.cumsum(ends[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1), ends.dtype)], axis=1)
        rows = np.flatnonzero(bitmap)
        scores = np.zeros(len(rows), anchor.dtype)
        for at in range(0, len(order), STEP):
            read = order[at : at + STEP]
            for d in read:
                scores += anchor[d] * self.values[d, rows]
            left = rest[:, min(at + STEP, len(order))]
            keep = want(scores + left[0], scores + left[1])
            if not keep.all():
                rows, scores = rows[keep], scores[keep]
            if not len(rows):
                break
        return rows, scores


def fifth(values: np.ndarray, k: int):
    """The k-th largest, or none."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids[rows], -scores))[:k]
    return ids[rows[order]], scores[order].astype(np.int64)


def positives(columns: Columns, anchor: np.ndarray, bitmap: np.ndarray, ids: np.ndarray, k: int):
    """(ids, scores): the k best rows of the bitmap."""

    def want(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        floor = fifth(low, k)
        return np.ones(len(low), bool) if floor is None else high >= floor

    return best(*columns.scan(anchor, bitmap, want), ids, k)


def windowed(columns: Columns, anchor: np.ndarray, bitmap: np.ndarray, ids: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window of scores, both ends included, its k best rows of the bitmap."""

    def want(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for least, most in windows:
            floor = fifth(low[(low >= least) & (high <= most)], k)  # so many are in for certain
            keep |= (low <= most) & (high >= (least if floor is None else floor))
        return keep

    rows, scores = columns.scan(anchor, bitmap, want)
    for least, most in windows:
        inside = (scores >= least) & (scores <= most)
        yield best(rows[inside], scores[inside], ids, k)


def _stack(vectors: pd.Series, dims: int) -> np.ndarray:
    return np.stack(vectors.to_list()).reshape(len(vectors), dims) if len(vectors) else np.zeros((0, dims), np.int64)


def _shard(index: pd.DataFrame, anchors: pd.DataFrame, dims: int):
    v, a = _stack(index["vec"], dims), _stack(anchors["vec"], dims)
    if dims * max(1, int(np.abs(v).max(initial=0))) * max(1, int(np.abs(a).max(initial=0))) < 1 << 52:
        v, a = v.astype(np.float64), a.astype(np.float64)  # whole numbers, exact, and faster
    return Columns(v), a, index["id"].to_numpy(), index["label"].to_numpy()


def _positives(dims: int, k: int):
    def run(index: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(anchors):
            columns, vectors, ids, labels = _shard(index, anchors, dims)
            for key, own, label, anchor in zip(anchors["key"], anchors["id"], anchors["label"], vectors):
                found, scores = positives(columns, anchor, (labels == label) & (ids != own), ids, k)
                if len(found):
                    out.append((key, found, scores))
        return pd.DataFrame(out, columns=["key", "ids", "scores"])

    return run


def _negatives(dims: int, k: int, share: int):
    def run(index: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(anchors):
            columns, vectors, ids, labels = _shard(index, anchors, dims)
            for key, label, anchor, scores in zip(anchors["key"], anchors["label"], vectors, anchors["scores"]):
                windows = [(-(-share * int(p) // 100), int(p)) for p in scores]
                for at, (found, got) in enumerate(windowed(columns, anchor, labels != label, ids, windows, k)):
                    if len(found):
                        out.append((key, at, found, got))
        return pd.DataFrame(out, columns=["key", "at", "ids", "scores"])

    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec): rows with everything there and finite, components as whole numbers, once each."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & good)
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    small = rows.filter(F.forall("vec", lambda x: F.abs(x) < float(1 << 40)))  # else not even one component fits
    return small.select("id", label.alias("label"), F.transform("vec", lambda x: F.floor(x * 256)).alias("vec")).distinct()


def mine(vectors: DataFrame, is_anchor: Column, n_positive: int = 5, n_negative: int = 5, share: int = 80, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ranks from 1 in each anchor and positive.

    `is_anchor` is a column over `id`. An anchor's positives are the best other rows of its label, negatives the best rows
    of other labels with share * positive <= 100 * negative <= 100 * positive; the score is the inner product of
    floor(256 * x), ties go to the smaller id. Rows with a null id or label, a null vector or a null or non-finite component
    take no part, nor do vectors of another length than most or so long that a score could pass 64 bits. Rows that repeat
    id, label and vector count once; a row that has the anchor's id is no partner of it. Other columns are not read; an
    empty table gives an empty result.
    """
    rows = stored(usable(vectors, id_col, vec_col, label_col).withColumn("key", F.monotonically_increasing_id()), "negatives-rows")
    common = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    spark, schema = vectors.sparkSession, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if common is None or common.dims == 0:
        return spark.createDataFrame([], schema)
    dims = common.dims
    most = isqrt((1 << 62) // dims)
    rows = rows.filter((F.size("vec") == dims) & F.forall("vec", lambda x: F.abs(x) <= most))
    anchors = rows.filter(is_anchor)
    n, n_anchors, tasks = rows.count(), anchors.count(), spark.sparkContext.defaultParallelism
    shards, blocks = max(-(-n // SHARD), min(2 * tasks, -(-n // LEAST_SHARD)), 1), max(-(-n_anchors // ANCHOR_BLOCK), 1)
    all_of = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    own = lambda m: F.pmod(F.xxhash64("key"), F.lit(m)).cast("int")
    index = rows.select("id", "label", "vec", own(shards).alias("shard"), all_of(blocks).alias("block")).groupBy("shard", "block")
    first = lambda k: F.slice(F.array_sort(F.flatten(F.collect_list(F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("minus"), x["ids"].alias("id")))))), 1, k)  # noqa: E731  k of each shard

    asked = anchors.select("key", "id", "label", "vec", own(blocks).alias("block"), all_of(shards).alias("shard"))
    near = index.cogroup(asked.groupBy("shard", "block")).applyInPandas(_positives(dims, n_positive), "key long, ids array<long>, scores array<long>")
    chosen = stored(near.groupBy("key").agg(first(n_positive).alias("p")).select("key", F.col("p.id").alias("positives"), F.transform("p.minus", lambda x: -x).alias("scores")), "negatives-positives")
    again = stored(anchors.select("key", "label", "vec").join(chosen.select("key", "scores"), "key"), "negatives-again")
    again = again.select("key", "label", "vec", "scores", own(blocks).alias("block"), all_of(shards).alias("shard"))
    far = index.cogroup(again.groupBy("shard", "block")).applyInPandas(_negatives(dims, n_negative, share), "key long, at int, ids array<long>, scores array<long>")
    found = far.groupBy("key", "at").agg(first(n_negative).alias("found")).join(chosen, "key").join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
    flat = found.select("anchor_id", F.col("positives")[F.col("at")].alias("positive_id"), F.col("scores")[F.col("at")].alias("positive_score"), F.posexplode("found").alias("pos", "x"))
    return flat.select("anchor_id", "positive_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias("negative_id"), "positive_score", (-F.col("x.minus")).alias("negative_score"))
