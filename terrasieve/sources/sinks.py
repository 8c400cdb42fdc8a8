"""Sinks (SNK-1 to SNK-9): all rows are written by tasks; the driver only writes what is a few rows."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.geo import bbox, hilbert, point_wkb, tile
from .writers import FeatureCollection, GeoParquet, Lines, opened

ORDER = 16  # bits of each coordinate of the curve that GeoParquet rows follow


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-1: CSV with a header in each file, CRLF, quotes where a cell needs them, and nothing for empty text and null.

    Records are put together as text, as Spark's own CSV writer makes CRLF of line ends inside cells.
    """
    df.sparkSession.dataSource.register(Lines)
    alone = len(df.columns) == 1

    def cell(c: Column) -> Column:
        text = F.coalesce(c.cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.rlike('[",\\r\\n]') | F.lit(alone) & (text == ""), quoted).otherwise(text)

    quote = lambda name: '"' + name.replace('"', '""') + '"' if any(x in name for x in '",\r\n') else name
    record = F.concat_ws(",", *[cell(F.col(f"`{c}`")) for c in df.columns])
    df.select(record.alias("value")).write.format("lines").mode("overwrite").option("head", ",".join(map(quote, df.columns))).option("end", "\r\n").save(path)


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """SNK-2, SNK-3."""
    df.write.mode("append" if append else "overwrite").json(path)


def write_files(df: DataFrame, name: str, content: str, path: str) -> DataFrame:
    """A file a row, below `path`, each by the task that has the row; gives (name, bytes) when it is run."""

    def write(batches):
        store, root = opened(path)
        store.create_dir(root, recursive=True)
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for file, data in zip(names, batch.column(1).to_pylist()):
                with store.open_output_stream(f"{root.rstrip('/')}/{file}") as out:
                    out.write(data or b"")
                sizes.append(len(data or b""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["name", "bytes"])

    return df.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("content")).mapInArrow(write, "name string, bytes long")


def geometry_columns(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """SNK-4: `df` with WKB points and their covering boxes; rows without a place are left out (FLT-2)."""
    placed = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    return placed.withColumns({"geometry": point_wkb(F.col(lon), F.col(lat)), "bbox": bbox(F.col(lon), F.col(lat))})


def write_geoparquet(df: DataFrame, lon: str, lat: str, path: str, append: bool = False) -> None:
    """SNK-4: zstd Parquet with the `geo` footer, committed as a whole; rows lie along a Hilbert curve, so the boxes of row
    groups are small and a search by box reads few of them.
    """
    spark = df.sparkSession
    spark.dataSource.register(GeoParquet)
    x, y = tile(F.col(lon), F.col(lat), ORDER)
    placed = geometry_columns(df, lon, lat).withColumn("__place", hilbert(x, y))
    placed.repartitionByRange("__place").sortWithinPartitions("__place").drop("__place").write.format("geoparquet").mode("append" if append else "overwrite").save(path)


def read_geoparquet(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Rows of a GeoParquet data set; with a box (xmin, ymin, xmax, ymax) those whose own box meets it, which Parquet filters."""
    df = spark.read.parquet(path)
    if box is None:
        return df
    return df.filter((F.col("bbox.xmin") <= box[2]) & (F.col("bbox.xmax") >= box[0]) & (F.col("bbox.ymin") <= box[3]) & (F.col("bbox.ymax") >= box[1]))


def compact_properties(columns: list[str]) -> Column:
    """SNK-6: JSON of the columns that hold something."""
    return F.to_json(F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]))


def features(df: DataFrame, lon: str, lat: str, columns: list[str]) -> DataFrame:
    """SNK-6: one GeoJSON feature a row, coordinates with six digits."""
    point = F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, 6), F.round(lat, 6)).alias("coordinates"))
    properties = F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), properties.alias("properties"))).alias("value"))


def write_features(df: DataFrame, lon: str, lat: str, columns: list[str], path: str) -> None:
    features(df, lon, lat, columns).write.mode("overwrite").text(path)


def write_feature_collection(df: DataFrame, lon: str, lat: str, columns: list[str], order: list[str], path: str) -> None:
    """SNK-7: one FeatureCollection in the given order, from as many tasks as there are ranges of it; the driver sees a name
    and a size a fragment. The fragments in the order of their names are the document.
    """
    df.sparkSession.dataSource.register(FeatureCollection)
    placed = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    features(placed, lon, lat, columns).write.format("featurecollection").mode("overwrite").save(path)


def read_feature_collection(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """(lon, lat, properties) of the features of such a document, a line each."""
    schema = f"geometry struct<coordinates:array<double>>, properties struct<{properties}>"
    lines = spark.read.text(path).filter(F.col("value").startswith('{"type":"Feature",'))
    f = lines.select(F.from_json(F.regexp_replace("value", ",$", ""), schema).alias("f"))
    return f.select(F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat"), "f.properties.*")


def write_layers(layers: dict[str, DataFrame], path: str) -> None:
    """SNK-5: each layer as a data set of its own."""
    for name, df in layers.items():
        df.write.mode("overwrite").parquet(f"{path}/layer={name}")


def stats_json(stats: DataFrame) -> str:
    """SNK-9: the rows of `views.viewer_stats` (stat, item, value) as one JSON object; a few dozen, whatever the input."""
    out: dict = {}
    for r in stats.collect():
        if r["item"] is None:
            out[r["stat"]] = r["value"]
        else:
            out.setdefault(r["stat"], {})[r["item"]] = r["value"]
    if isinstance(out.get("nenRange"), dict):
        out["nenRange"] = [out["nenRange"].get("min"), out["nenRange"].get("max")]
    return json.dumps(out, ensure_ascii=False, sort_keys=True)
