"""JSON without a fixed schema (JSN-1, PRJ-24): VARIANT columns, paths that may be missing, and profiles of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def paths(df: DataFrame, json: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """`df` with a column for each path (name: (path, type)) into its JSON text, parsed once; null where the text is no JSON,
    the path is missing, or the value is of another type.
    """
    parsed = df.withColumn("__v", F.try_parse_json(json))
    return parsed.withColumns({name: F.try_variant_get("__v", path, kind) for name, (path, kind) in fields.items()}).drop("__v")


def merged_schema(df: DataFrame, json: str) -> DataFrame:
    """(schema): one type that all values fit, as Spark writes it; an aggregate, combined before the shuffle."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(json)).alias("schema"))


def key_profile(df: DataFrame, json: str) -> DataFrame:
    """(key, type, n): the top-level keys of JSON objects with the types of their values."""
    parsed = df.select(F.try_parse_json(json).alias("__v")).filter(F.schema_of_variant("__v").startswith("OBJECT"))
    keys = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__v").outer()))
    return keys.groupBy("key", F.schema_of_variant("value").alias("type")).agg(F.count("*").alias("n"))


def items(array: Column, schema: str) -> Column:
    """A VARIANT array as an array of `schema`, null where it is none."""
    return F.try_variant_get(array, "$", f"array<{schema}>")
