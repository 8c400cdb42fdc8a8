"""Requests to a service with the contract of the fetchers (SRC-1, SRC-3, SRC-17): some tries, waits that grow, null after
the last, and nothing for what a manifest holds already.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.matching import resume

Fetch = Callable[[str], bytes | None]


def fetched(requests: DataFrame, key: str, service: Callable[[], Fetch], tries: int = 4, wait: float = 1.5, done: DataFrame | None = None) -> DataFrame:
    """(key, content, tries): what the service answers to each distinct request that `done` (key, content) does not hold.

    `service` is called once a task and gives the function that fetches one; an answer that is empty, or an error, counts as
    a failure and is tried again after `wait` times the number of failures. After the last try content is null: failures are
    rows to be counted, never errors. `done` counts only where its content is not empty, so a failure is fetched anew in the
    next run. Requests that are null are left out; a task holds one batch of answers.
    """
    todo = requests.select(F.col(key).cast("string").alias("key")).filter("key IS NOT NULL").distinct()
    if done is not None:
        todo = resume(todo, done.filter("content IS NOT NULL AND octet_length(content) > 0").select(F.col("key").cast("string").alias("key")), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = service()
        for batch in batches:
            keys, contents, taken = batch.column(0).to_pylist(), [], []
            for k in keys:
                content = None
                for n in range(1, tries + 1):
                    try:
                        content = fetch(k) or None
                    except Exception:  # noqa: BLE001  whatever a service throws is a failed try
                        content = None
                    if content is not None or n == tries:
                        break
                    time.sleep(wait * n)
                contents.append(content)
                taken.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(contents, pa.binary()), pa.array(taken, pa.int32())], ["key", "content", "tries"])

    return todo.mapInArrow(run, "key string, content binary, tries int")


def kept_in(path: str) -> Callable[[], Fetch]:
    """A service over files below a path, by pyarrow: local, HDFS or object stores."""

    def service() -> Fetch:
        from .writers import opened

        store, root = opened(path)

        def fetch(key: str) -> bytes | None:
            with store.open_input_stream(f"{root.rstrip('/')}/{key}") as data:
                return data.read()

        return fetch

    return service
