"""Sources (SRC-1 to SRC-21): files that Spark reads whole, decoded and split in tasks; lookups as tables."""

from __future__ import annotations

import csv
import io
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import repaired_fields


def files(spark: SparkSession, path: str, magic: str | None = None) -> DataFrame:
    """SRC-1, SRC-2: (path, content) of files; with `magic` (hex of the first bytes) only those that begin so."""
    df = spark.read.format("binaryFile").load(path).select("path", "content")
    return df if magic is None else df.filter(F.hex(F.substring("content", 1, len(magic) // 2)) == magic.upper())


def member_lines(zips: DataFrame, suffix: str = ".dat", encoding: str = "cp932") -> DataFrame:
    """SRC-4: (file, line_no, line) of a text member of each zip file, blank lines left out; line 0 is the header."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    name = next(n for n in z.namelist() if n.lower().endswith(suffix))
                    text = z.read(name).decode(encoding)
                kept = [x for x in text.splitlines() if x.strip()]
                yield pd.DataFrame({"file": path, "line_no": range(len(kept)), "line": kept})

    return zips.mapInPandas(lines, "file string, line_no long, line string")


def registry(zips: DataFrame, width: int = 47, at: int = 32) -> DataFrame:
    """SRC-4, SET-1: the rows of all files under one header, which must be the same in all; (file, line_no) is their order."""
    lines = member_lines(zips).withColumn("fields", repaired_fields(F.col("line"), width, at))
    heads = [r.line for r in lines.filter("line_no = 0").select("line").distinct().limit(2).collect()]
    if len(heads) != 1:
        raise ValueError("files differ in their headers")
    names = heads[0].split("\t")
    return lines.filter("line_no > 0").select("file", "line_no", *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(names)])


def text_csv(spark: SparkSession, path: str, columns: list[str], typed: dict[str, str] | None = None) -> DataFrame:
    """SRC-5, SRC-6: a CSV file with a header; columns are text and empty text is never null, but for those typed otherwise."""
    typed = typed or {}
    schema = ", ".join(f"`{c}` {typed.get(c, 'string')}" for c in columns)
    df = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) if c not in typed else F.col(c) for c in columns])


def json_lines(spark: SparkSession, path: str, schema: str, tolerant: bool = False) -> DataFrame:
    """SRC-7: JSON lines; with `tolerant` broken lines are left out, else they are an error."""
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, _broken string").option("columnNameOfCorruptRecord", "_broken").json(path).filter("_broken IS NULL").drop("_broken")


CITY_API = "data array<struct<pref:string,cities:array<struct<code:long,county:string,city:string,ward:string,point:array<double>>>>>"


def address_cities(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8, JSN-2: the cities of a nested address file, with five-digit codes."""
    nested = spark.read.schema(CITY_API).option("multiLine", True).json(path).select(F.explode("data").alias("d")).select("d.pref", F.explode("d.cities").alias("c"))
    text = lambda c: F.coalesce(F.col(f"c.{c}"), F.lit("")).alias(c)
    point = lambda i: F.try_element_at("c.point", F.lit(i))
    return nested.select(F.substring(F.lpad(F.col("c.code").cast("string"), 6, "0"), 1, 5).alias("MUNI_CD"), "pref", text("county"), text("city"), text("ward"), point(1).alias("lon"), point(2).alias("lat"))


def _members(content: bytes) -> dict[str, bytes]:
    """A zip file's members by suffix; names written in CP932 are told from CP437."""
    out = {}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for info in z.infolist():
            name = info.filename
            try:
                name = name.encode("cp437").decode("cp932")
            except UnicodeError:
                pass
            if "." in name and "subprefecture" not in name:
                out.setdefault(name.rsplit(".", 1)[1].lower(), z.read(info))
    return out


def dbf_rows(data: bytes, encoding: str = "cp932") -> Iterator[dict[str, str]]:
    """Rows of a dBase table as stripped text; rows marked deleted are kept."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at, offset = [], 32, 1
    while data[at] != 0x0D:
        name, length = data[at : at + 11].split(b"\0")[0].decode(encoding), data[at + 16]
        fields.append((name, offset, length))
        offset, at = offset + length, at + 32
    for i in range(n):
        row = data[head + i * size : head + (i + 1) * size]
        yield {name: row[o : o + k].decode(encoding, "replace").strip() for name, o, k in fields}


def point_shapes(zips: DataFrame, encoding: str = "cp932") -> DataFrame:
    """SRC-9, PRJ-15: (file, row_no, lon, lat, attributes) of point shapefiles; other shapes or unequal counts are errors."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                parts = _members(content)
                shp, table = parts["shp"], list(dbf_rows(parts["dbf"], encoding))
                kind, n = struct.unpack_from("<i", shp, 32)[0], (len(shp) - 100) // 28
                if kind != 1 or n != len(table):
                    raise ValueError(f"{path}: shape type {kind}, {n} shapes, {len(table)} rows")
                xy = [struct.unpack_from("<2d", shp, 112 + 28 * i) for i in range(n)]
                yield pd.DataFrame({"file": path, "row_no": range(n), "lon": [x for x, _ in xy], "lat": [y for _, y in xy], "attributes": table})

    return zips.mapInPandas(rows, "file string, row_no long, lon double, lat double, attributes map<string,string>")


def polygon_vertices(zips: DataFrame, code: str, encoding: str = "cp932") -> DataFrame:
    """SRC-10, GEO-14: (code, shape_no, ring_no, pos, x, y) of polygon shapefiles; shapes without geometry are left out."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                parts = _members(content)
                shp, at, out = parts["shp"], 100, []
                for no, attributes in enumerate(dbf_rows(parts["dbf"], encoding)):
                    words = struct.unpack_from(">2i", shp, at)[1]
                    if struct.unpack_from("<i", shp, at + 8)[0] == 5:
                        n_rings, n = struct.unpack_from("<2i", shp, at + 44)
                        starts = [*struct.unpack_from(f"<{n_rings}i", shp, at + 52), n]
                        for ring, (a, b) in enumerate(zip(starts, starts[1:])):
                            for k in range(a, b):
                                x, y = struct.unpack_from("<2d", shp, at + 52 + 4 * n_rings + 16 * k)
                                out.append((attributes[code], no, ring, k - a, x, y))
                    at += 8 + 2 * words
                yield pd.DataFrame(out, columns=["code", "shape_no", "ring_no", "pos", "x", "y"])

    return zips.mapInPandas(rows, "code string, shape_no int, ring_no int, pos int, x double, y double")


def sniffed(data: bytes) -> str:
    """SRC-12: text of bytes in the first encoding that fits."""
    for encoding in ("utf-8-sig", "cp932"):
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            pass
    return data.decode("utf-8", "replace")


def csv_cells(raw: DataFrame) -> DataFrame:
    """SRC-12, SRC-21: (file, row_no, cells) of CSV files of any layout and encoding."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                cells = list(csv.reader(io.StringIO(sniffed(content))))
                yield pd.DataFrame({"file": path, "row_no": range(len(cells)), "cells": cells})

    return raw.mapInPandas(rows, "file string, row_no long, cells array<string>")


def judged_files(files: DataFrame, path: str = "path") -> DataFrame:
    """FLT-14: files with what becomes of them: absent (no size), skipped (archives hold another population), or read."""
    kind = F.when(F.col("size").isNull(), "absent").when(F.lower(path).endswith(".zip"), "skipped").otherwise("read")
    return files.withColumn("verdict", kind)


def link_codes(html: Column, pattern: str) -> Column:
    """SRC-15: the distinct codes in a page's links, in order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))))


def catalogue(results: DataFrame, keywords: str) -> DataFrame:
    """SRC-16: search results (ord, org, title, formats) whose title has a keyword; the last of an (org, title) counts."""
    found = results.filter(F.col("title").rlike(keywords)).groupBy("org", "title").agg(F.max_by("formats", "ord").alias("formats"))
    return found.withColumn("formats", F.array_join(F.array_sort(F.array_distinct("formats")), "/"))


def searched(entries: DataFrame, terms: list[str], text: str, keywords: str) -> DataFrame:
    """SRC-16: what a search for each term in each catalogue comes to: (org, title, formats).

    Entries are (catalogue, ord, org, title, formats, text). Terms go first to last, and in each the catalogues and their
    entries in order; an (org, title) that is found again is overwritten. So the last term that an entry holds decides its
    place, which is a column: terms and catalogues are never multiplied.
    """
    hit = F.array_max(F.array(*[F.when(F.contains(F.col(text), F.lit(term)), F.lit(i)) for i, term in enumerate(terms)]))
    found = entries.withColumn("__term", hit).filter(F.col("__term").isNotNull() & F.col("title").rlike(keywords))
    shown = F.concat(F.array_join(F.array_sort(F.array_distinct(F.filter("formats", lambda f: f != ""))), "/"), F.lit(" ("), "catalogue", F.lit(")"))
    return found.groupBy("org", "title").agg(F.max_by(shown, F.struct("__term", "catalogue", "ord")).alias("formats"))


def looked_up(df: DataFrame, service: DataFrame, key: list[str]) -> DataFrame:
    """SRC-3, SRC-17: answers of a service, held as a table; rows without an answer keep nulls."""
    return df.join(service, key, "left")


def page_markers(spans: DataFrame, font: str, glyph: str, dx: float = -0.036, dy: float = -0.609) -> DataFrame:
    """SRC-19: marker centres among text spans (font, text, x0, y0, x1, y1, color, size)."""
    mid = lambda a, b, d: (F.col(a) + F.col(b)) / 2 + d
    return spans.filter((F.col("font") == font) & (F.trim("text") == glyph)).select(mid("x0", "x1", dx).alias("x"), mid("y0", "y1", dy).alias("y"), "color", "size")


def is_decoration(points: Column, width: float, height: float, margin: float = 20.0) -> Column:
    """FLT-13, WIN-9: strokes that touch the margin, or run along the axes only; points are structs (x, y)."""
    edge = F.exists(points, lambda p: (p["x"] < margin) | (p["y"] < margin) | (p["x"] > width - margin) | (p["y"] > height - margin))
    pairs = F.arrays_zip(F.slice(points, 1, F.size(points) - 1).alias("a"), F.slice(points, 2, F.size(points)).alias("b"))
    straight = F.forall(pairs, lambda s: (F.abs(s["a"]["x"] - s["b"]["x"]) < 0.05) | (F.abs(s["a"]["y"] - s["b"]["y"]) < 0.05))
    return edge | ((F.size(points) >= 4) & straight)


