"""Nearest neighbours by multi-index hashing of learned, rotated binary codes.

The index is dealt to shards once, a vector to one shard. A shard indexes its codes by every substring, and each query is
sent to every shard: there pigeonhole probing finds all codes within the radius, and their floats are compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from .common import stored

SAMPLE = 4000  # vectors that rotations and radius are learnt from, at most
TURNS, TURN_BITS = 4, 64  # rotations, and the bits that each gives
BITS, PARTS = TURNS * TURN_BITS, 16  # of a code, and the substrings of sixteen bits that are indexed
SURE = 0.96  # share of the sample's true neighbours that the radius must reach; a whole table's are nearer
SHARD, LEAST_SHARD, QUERY_BLOCK = 131_072, 2048, 65_536  # vectors of a shard at most, and of one worth a task; queries of a block


@dataclass(frozen=True)
class Coder:
    centre: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """BITS / 8 bytes of each of these unit vectors."""
        return np.packbits((vectors - self.centre) @ self.rotation > 0, axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Of unit vectors; row by row, so that equal vectors score alike wherever they stand."""
    return (vectors * query).sum(axis=1)


def learn(sample: np.ndarray, k: int) -> Coder:
    """Iterative quantisation: principal axes, then rotations that lose least in rounding to signs; then the radius."""
    x = unit(sample)
    centre = x.mean(axis=0)
    off, dim = x - centre, x.shape[1]
    axes = np.linalg.eigh(off.T @ off)[1][:, ::-1]
    turns = []
    for i in range(TURNS):
        rng = np.random.default_rng(i)
        own = axes[:, :TURN_BITS] if dim >= TURN_BITS else rng.normal(size=(dim, TURN_BITS))  # few dimensions: random directions
        p = off @ own
        turn = np.linalg.qr(rng.normal(size=(TURN_BITS, TURN_BITS)))[0]
        for _ in range(30):
            u, _, w = np.linalg.svd(np.where(p @ turn > 0, 1.0, -1.0).T @ p)
            turn = (u @ w).T
        turns.append(own @ turn)
    rotation = np.hstack(turns)
    codes, far = Coder(centre, rotation, BITS).codes(x).view(np.uint64), []
    for i in range(0, min(len(x), 800)):
        near = x @ x[i]
        near[i] = -np.inf
        best = np.argsort(-near)[: min(k, len(x) - 1)]
        far += np.bitwise_count(codes[best] ^ codes[i]).sum(axis=1).tolist()
    return Coder(centre, rotation, int(np.quantile(far, SURE)) if far else BITS)


def reaches(radius: int) -> list[int]:
    """Bits that each substring may differ in: codes within the radius agree to that in one of them at least."""
    each, over = divmod(radius, PARTS)
    return [each if part <= over else each - 1 for part in range(PARTS)]


class Shard:
    """Codes of a shard, indexed by the values of every substring."""

    def __init__(self, codes: np.ndarray):
        self.words, parts = codes.view(np.uint64), codes.view(np.uint16)
        self.tables = []
        for part in range(PARTS):
            order = np.argsort(parts[:, part], kind="stable")
            values, counts = np.unique(parts[:, part], return_counts=True)
            self.tables.append((order, values, counts))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The places of all codes within the radius of this one."""
        met = np.zeros(len(self.words), bool)
        for (order, values, counts), own, reach in zip(self.tables, code.view(np.uint16), reaches(radius)):
            met[order[np.repeat(np.bitwise_count(values ^ own) <= reach, counts)]] = True
        found = np.flatnonzero(met)
        return found[np.bitwise_count(self.words[found] ^ code.view(np.uint64)).sum(axis=1) <= radius]


def _probe(radius: int, k: int):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(queries):
            of = lambda f: np.frombuffer(b"".join(f["code"]), np.uint8).reshape(len(f), BITS // 8)
            shard, ids, x = Shard(of(index)), index["id"].to_numpy(), unit(np.stack(index["vec"]))
            for query, code, vec in zip(queries["id"], of(queries), queries["vec"]):
                found = shard.within(code, radius)
                found = found[ids[found] != query]
                if len(found):
                    scores = cosines(x[found], unit(vec[None, :])[0])
                    best = np.lexsort((ids[found], -scores))[:k]
                    out.append((query, ids[found[best]], scores[best], len(found)))
        return pd.DataFrame(out, columns=["id", "ids", "scores", "n_seen"])

    return search


def classes(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """(vec, id, ids): distinct usable vectors with their smallest id and their k + 1 smallest ids.

    A vector that a third of all rows share is one row here; a ranking's limit is applied before the shuffle.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("row"), F.col(vec_col).cast("array<double>").alias("vec")).filter("row IS NOT NULL")
    good = F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.filter(good).distinct()  # a row that is repeated a million times is one from here on
    rank = F.dense_rank().over(Window.partitionBy("vec").orderBy("row"))
    low = rows.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    return low.groupBy("vec").agg(F.array_sort(F.collect_set("row")).alias("ids")).select("vec", F.col("ids")[0].alias("id"), "ids")


def search(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, n_candidates): the k nearest found of each query by cosine, ties to the smaller vec_id.

    `is_query` is a column over `row`, the id. All other rows are candidates; n_candidates counts the distinct vectors
    whose floats the query was compared with. Rows with a null id or an unusable vector (null, zero, with a null or
    non-finite part, or of another length than most) take no part; rows that repeat an id and a vector count once. Equal
    vectors are searched once for all their rows. A query for which fewer than k (or all others) were found is searched
    again with the largest radius, which reaches every row. Other columns are not read; an empty table gives an empty
    result.
    """
    every = stored(classes(vectors, id_col, vec_col, k), "ann-classes")
    length = every.groupBy(F.size("vec").alias("n")).agg(F.sum(F.size("ids")).alias("rows")).orderBy(F.desc("rows"), "n").first()
    spark = vectors.sparkSession
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, n_candidates long")
    every = every.filter(F.size("vec") == length.n)
    sample = [r.vec for r in every.orderBy(F.xxhash64("id")).limit(SAMPLE).select("vec").collect()]
    coder = learn(np.array(sample), k)

    @F.pandas_udf("code binary, own double")
    def code(vec: pd.Series) -> pd.DataFrame:
        x = unit(np.stack(vec)) if len(vec) else np.zeros((0, length.n))
        return pd.DataFrame({"code": pd.Series([c.tobytes() for c in coder.codes(x)], dtype=object), "own": (x * x).sum(axis=1)})

    coded = stored(every.select("id", "vec", "ids", code("vec").alias("c")).select("id", "vec", "ids", "c.*"), "ann-codes")
    asked_rows = vectors.select(F.col(id_col).cast("long").alias("row"), F.col(vec_col).cast("array<double>").alias("vec")).filter(is_query & F.col("row").isNotNull()).distinct()
    asked = stored(asked_rows.join(coded.select("vec", "id", "ids", "own"), "vec").select("row", "id", "ids", "own"), "ann-queries")
    queries = stored(coded.join(asked.select("id").distinct(), "id").select("id", "vec", "code"), "ann-query-codes")
    n, n_queries = coded.count(), queries.count()
    found = stored(_search_shards(coded, queries, coder.radius, k, n, n_queries), "ann-found")
    short = queries.join(found.filter(F.size("ids") >= min(k, n - 1)).select("id"), "id", "left_anti")
    if n > 1 and coder.radius < BITS and not short.isEmpty():
        again = stored(_search_shards(coded, stored(short, "ann-short"), BITS, k, n, n_queries), "ann-again")
        found = found.join(again.select("id"), "id", "left_anti").unionByName(again)
    return _expand(asked, found, coded, k)


def _search_shards(coded: DataFrame, queries: DataFrame, radius: int, k: int, n: int, n_queries: int) -> DataFrame:
    """(id, ids, scores, n_seen): of each query vector the k nearest other vectors within the radius.

    Index and queries meet by shard; only above QUERY_BLOCK queries is a shard sent to several blocks of them. A shard's
    result is k ids a query, so no pair leaves its task.
    """
    tasks = coded.sparkSession.sparkContext.defaultParallelism
    shards = max(-(-n // SHARD), min(2 * tasks, -(-n // LEAST_SHARD)), 1)
    blocks = max(-(-n_queries // QUERY_BLOCK), 1)
    all_of = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    own = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    index = coded.select("id", "vec", "code", own(shards).alias("shard"), all_of(blocks).alias("block"))
    asking = queries.select("id", "vec", "code", own(blocks).alias("block"), all_of(shards).alias("shard"))
    near = index.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInPandas(_probe(radius, k), "id long, ids array<long>, scores array<double>, n_seen long")
    pairs = F.flatten(F.collect_list(F.arrays_zip("scores", "ids")))  # k of each shard
    order = lambda a, b: F.when(a["scores"] > b["scores"], -1).when(a["scores"] < b["scores"], 1).when(a["ids"] < b["ids"], -1).otherwise(1)
    top = near.groupBy("id").agg(F.slice(F.array_sort(pairs, order), 1, k).alias("top"), F.sum("n_seen").alias("n_seen"))
    return top.select("id", F.col("top.ids").alias("ids"), F.col("top.scores").alias("scores"), "n_seen")


def _expand(asked: DataFrame, found: DataFrame, coded: DataFrame, k: int) -> DataFrame:
    """From vectors back to rows: a query's nearest are rows with its own vector, then those of the vectors found."""
    own = asked.select("row", "id", F.explode("ids").alias("vec_id"), F.col("own").alias("score"), F.lit(0).cast("long").alias("n_seen"))
    near = asked.select("row", "id").join(found, "id").select("row", "n_seen", F.explode(F.arrays_zip(F.col("ids").alias("near"), F.col("scores").alias("score"))).alias("z"))
    near = near.select("row", "n_seen", F.col("z.near").alias("id"), F.col("z.score").alias("score"))
    near = near.join(coded.select("id", "ids"), "id").select("row", F.explode("ids").alias("vec_id"), "score", "n_seen")
    rows = own.select("row", "vec_id", "score", "n_seen").unionByName(near).filter("row <> vec_id")
    by = Window.partitionBy("row")  # some (k + 1) squared rows at most
    best = rows.withColumns({"rank": F.row_number().over(by.orderBy(F.desc("score"), "vec_id")), "n_candidates": F.max("n_seen").over(by)}).filter(F.col("rank") <= k)
    return best.select(F.col("row").alias("query_id"), "rank", "vec_id", "score", "n_candidates")
