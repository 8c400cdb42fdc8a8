"""CSV with line ends inside quotes, read by blocks of a file (SRC-12, SRC-21), so that one huge file is many tasks.

A physical line turns the quotes over as often as it holds a quote. Whether it begins a record is the parity of all quotes
before it in the file: sums of a block are combined by prefix, blocks are known by where they begin, and only a row a block
is ever in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.rounds import settled


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, pos, line): lines as they stand, in the order of (file, block, pos); Spark splits files as it likes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))


def records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(file, record, text): physical lines (file, block, pos, line) put together where a quote is open at a line's end.

    Records are numbered from 0 in each file. A window runs over the lines of one block; an unclosed quote takes the rest of
    its file, as it does for any reader.
    """
    turns = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    lines = settled(lines.withColumn("turns", turns % 2))
    block = Window.partitionBy("file", "block").orderBy("pos")
    before = F.coalesce(F.sum("turns").over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    placed = lines.withColumn("odd", before)  # of the quotes before a line in its block
    # a block has as many lines at even as at odd parity either way; which of them begin a record the blocks before decide
    sums = placed.groupBy("file", "block").agg(F.sum("turns").alias("turns"), F.count_if(F.col("odd") == 0).alias("even"), F.count_if(F.col("odd") == 1).alias("odd"))
    chain = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    sums = sums.withColumn("open", F.coalesce(F.sum("turns").over(chain), F.lit(0)) % 2)
    sums = sums.withColumn("begun", F.coalesce(F.sum(F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("odd"))).over(chain), F.lit(0))).select("file", "block", "open", "begun")
    whole = placed.join(sums, ["file", "block"])
    starts = (F.col("odd") == F.col("open")).cast("long")
    numbered = whole.withColumn("record", F.col("begun") + F.sum(starts).over(block) - 1)
    parts = F.array_sort(F.collect_list(F.struct("block", "pos", "line")))
    return numbered.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("text"))


def csv_by_blocks(spark: SparkSession, path: str, schema: str, header: bool = True, quote: str = '"') -> DataFrame:
    """(file, record, columns of `schema`) of CSV files of any size; empty lines between records are left out."""
    rows = records(physical_lines(spark, path), quote).withColumn("text", F.regexp_replace("text", "\r$", ""))
    rows = rows.filter("text <> ''" + (" AND record > 0" if header else ""))
    fields = F.from_csv("text", schema, {"quote": quote, "escape": quote, "mode": "FAILFAST"}).alias("r")
    return rows.select("file", "record", fields).select("file", "record", "r.*")
