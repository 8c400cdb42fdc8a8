"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import numbered

#: Multipliers and increments of the four rounds; below 2**31, so that products of half words stay in a signed long.
ROUNDS = ((1103515245, 12345), (1664525, 1013904223), (22695477, 826366247), (214013, 2531011))


def half_bits(n: int) -> int:
    """Bits of a half word, so that two of them hold n numbers; at most 31."""
    bits = 1
    while 1 << 2 * bits < n:
        bits += 1
    if bits > 31:
        raise ValueError("more than 2**62 rows")
    return bits


def permute(rows: np.ndarray, n: int, rounds=ROUNDS) -> np.ndarray:
    """Where each row number below n goes: numbers that leave the range walk on along their cycle until they are back in it."""
    half = half_bits(n)
    mask = (1 << half) - 1
    out = np.asarray(rows, np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for mul, add in rounds:
            mixed = right * mul + add
            left, right = right, left ^ ((mixed ^ (mixed >> half)) >> 3 & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= n]
    return out


def assign(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, row_no, law, shard, slot, grown_shard) for every row; law `rows`: shard counts at most one apart.

    Row numbers follow doc_id (nulls first), then size and checksum, so the order does not depend on partitions; rows
    equal in all three are interchangeable. The permuted number p gives shard p mod `shards` and slot p div `shards`,
    which any reader can compute. Null texts have size 8 and checksum 0; an empty table gives an empty result; other
    columns are not read. Texts are only measured where they are read: the shuffle carries three numbers a row.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    narrow = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(data) + F.lit(8)).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    rows, n = numbered(narrow, ["doc_id", "size", "text_crc32"])

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permute(batch.to_numpy(), n))

    spot = rows.withColumn("__at", place("row_no"))
    return spot.select(
        "doc_id", "size", "text_crc32", "row_no", F.lit("rows").alias("law"), (F.col("__at") % shards).cast("int").alias("shard"),
        F.expr(f"__at div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
