"""Helpers that the corpus operators share: shared storage, row numbers, components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (`spark.checkpoint.dir`).

    Only a local session may go without the setting; it then gets a folder of its own, on the one machine it runs on, and
    the session's setting names it from then on. All operators that store anything come here.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", where)
    return where


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:  # at exit the session may be gone already
        delete_path(spark, path)
    except Exception:  # noqa: BLE001
        pass


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get, by bytes: long texts else make batches of many megabytes, which a
    worker holds several times. A session that has a lower bound keeps it; the setting stays, as plans read it when they run.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if now is None or not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


class Stored:
    """A DataFrame written to the shared folder: lineage ends here, so a lost executor costs a reread only."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        atexit.register(_delete_quietly, self.spark, self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df`, written to the shared folder and read again; kept until the driver ends, as results may be read late."""
    return Stored(df, name).df


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(name: str, df: DataFrame) -> str:
    """`name`, with underscores after it until no column of `df` is called so, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


PACK_BYTES = 2 << 20


def pack_rows(df: DataFrame) -> DataFrame:
    """(tag, pack): the rows of `df`, all columns, in compressed blocks of about PACK_BYTES, stored.

    Shuffles of packs carry little, and answers go to a pack and not to each of its rows. A tag is random; storing the
    packs fixes it.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                n = max(1, batch.num_rows * PACK_BYTES // max(batch.nbytes, 1))
                while n > 1 and batch.slice(at, n).nbytes > 2 * PACK_BYTES:
                    n //= 2
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(at, n))
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["tag", "pack"])
                at += n

    small_batches(df.sparkSession)
    return stored(df.mapInArrow(pack, "tag long, pack binary"), "packs")


def unpack_rows(pack: bytes) -> pa.Table:
    return pa.ipc.open_stream(pack).read_all()


def numbered(df: DataFrame, order: list, out: str = "row_no") -> tuple[DataFrame, int]:
    """Adds a gapless global row number from 0 in the given order, and returns the row count too.

    One range shuffle of `df` (callers pass narrow rows); each partition's rows are numbered in place and a table
    with one count per partition gives the offsets, so no task sees all rows. Rows equal in every order column are
    interchangeable; the input position splits them so that one repeated row cannot fill a partition.
    """
    tie = "__tie"
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, F.col(tie))
    placed = ranged.sortWithinPartitions(*order, F.col(tie)).drop(tie)
    at = F.monotonically_increasing_id()
    kept = stored(placed.withColumn("__part", F.shiftright(at, 33)).withColumn("__pos", at.bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    offsets, total = {}, 0
    for part, n in sorted(tuple(r) for r in kept.groupBy("__part").count().collect()):  # a row a partition
        offsets[part] = total
        total += n
    if not offsets:
        return kept.withColumn(out, F.col("__pos")).drop("__part", "__pos"), 0
    spark = df.sparkSession
    starts = spark.createDataFrame(sorted(offsets.items()), "__part long, __start long")
    return kept.join(F.broadcast(starts), "__part").withColumn(out, F.col("__start") + F.col("__pos")).drop("__part", "__pos", "__start"), total


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b): root is the smallest node reachable.

    Contraction: each node takes the smallest neighbour's parent, links are relabelled and deduplicated, and rounds
    go on until no link is left; a round at least halves the nodes of a component that is not done. Every round is
    written to the shared folder. Only the number of links reaches the driver.
    """
    links = Stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots = None
    while not links.df.isEmpty():
        both = links.df.unionByName(links.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up"))
        parent = Stored(parent, "parent")
        upper = parent.df.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = Stored(parent.df.join(upper, "up").select("node", F.col("top").alias("up")), "jumped")
        one = links.df.join(jumped.df.withColumnsRenamed({"node": "a", "up": "a2"}), "a").select("a2", "b")
        two = one.join(jumped.df.withColumnsRenamed({"node": "b", "up": "b2"}), "b")
        fresh = Stored(two.filter("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "links")
        if roots is None:
            merged = Stored(jumped.df.withColumnRenamed("up", "root"), "roots")
        else:
            moved = roots.df.join(jumped.df.withColumnsRenamed({"node": "root", "up": "root2"}), "root", "left")
            merged = Stored(moved.select("node", F.coalesce("root2", "root").alias("root")), "roots")
            roots.drop()
        for old in (links, parent, jumped):
            old.drop()
        links, roots = fresh, merged
    links.drop()
    if roots is None:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    return roots.df
