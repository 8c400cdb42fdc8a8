"""All registered queries of the library's operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as places: longitude 139 + 5 e0, latitude 36 + 5 e1."""
    e = table(spark, sf_dir, "embeddings")
    at = lambda i, base: (F.lit(float(base)) + 5 * F.get("embedding", F.lit(i)).cast("double"))
    return e.select("vec_id", "label", at(0, 139).alias("lon"), at(1, 36).alias("lat"))


POINTS_SQL = "SELECT vec_id, label, 139 + 5 * embedding[1]::DOUBLE AS lon, 36 + 5 * embedding[2]::DOUBLE AS lat FROM embeddings"
HAVERSINE_SQL = "2 * 6371.0088 * asin(sqrt(least(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2), 1.0)))"

from . import addresses, areas, files, names, places, registers, sheets, shown  # noqa: E402, F401  they register their queries
