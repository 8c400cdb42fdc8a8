"""Incremental runs (SNK-3, JN-14): new files are gone through once, and what is done stays done, as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

Work = Callable[[dict], dict | None]
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Attempts(StatefulProcessor):
    """One result a key: its first row is worked on, some times over if that fails; then the key is done, for as long as
    its state is kept. State is one short row a key, so a batch costs what its own rows cost.
    """

    def __init__(self, work: Work, columns: list[str], tries: int, keep_ms: int | None):
        self.work, self.columns, self.tries, self.keep_ms = work, columns, tries, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", T.StructType([T.StructField("tries", T.IntegerType())]), self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:  # all are read, one is kept
            if first is None and len(batch):
                first = batch.iloc[0].to_dict()
        if first is None or self.done.exists():
            return
        found, n = None, 0
        while found is None and n < self.tries:
            n += 1
            try:
                found = self.work(first)
            except Exception:  # noqa: BLE001  a failed try
                found = None
        self.done.update((n,))
        yield pd.DataFrame([{**{c: None for c in self.columns}, **(found or {}), "key": str(key[0]), "tries": n, "failed": found is None}])[["key", *self.columns, "tries", "failed"]]

    def close(self) -> None:
        pass


def worked(stream: DataFrame, key: str, work: Work, schema: str, tries: int = 3, keep: int | None = None) -> DataFrame:
    """(key, columns of `schema`, tries, failed): a stream's keys, each worked on once; `work` takes a row and gives the
    columns or None. A key that fails `tries` times gives a row of nulls with `failed`. With `keep` (milliseconds) a key may
    come again after that. The session needs the RocksDB state store.
    """
    columns = T.StructType.fromDDL(schema)
    out = T.StructType([T.StructField("key", T.StringType()), *columns.fields, T.StructField("tries", T.IntegerType()), T.StructField("failed", T.BooleanType())])
    processor = Attempts(work, columns.names, tries, keep)
    mode = "ProcessingTime" if keep else "None"
    return stream.filter(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode=mode)


def run_available(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, work: Work, made: str, key: str, tries: int = 3) -> None:
    """Goes through the files of `source` that have come since the last run, and appends results of new keys to `out`.

    The checkpoint holds which files and keys are done; `out` is never read, and a batch that is run again writes the same.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    stream = spark.readStream.schema(schema).json(source)
    results = worked(stream, key, work, made, tries)
    results.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, ts: str, key: str, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Counts a window and key of a stream, or of a table, with a watermark for late rows."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
