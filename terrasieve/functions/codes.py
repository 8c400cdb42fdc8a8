"""Codes, dates and classes as columns (PRJ-3 to PRJ-18, DAT-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import zero_fill

ERAS = {"昭": 1925, "平": 1988}  # fixed values: the year before an era's first


def municipality_code(pref: Column, city: Column) -> Column:
    """PRJ-3: five digits from a prefecture and a city number that may repeat the prefecture or carry a check digit.

    A city number of one or two digits says nothing certain and gives no code, as does any other length.
    """
    p, c = zero_fill(F.trim(F.coalesce(pref, F.lit(""))), 2), F.trim(F.coalesce(city, F.lit("")))
    short = F.when((F.length(c) == 5) & c.startswith(p), F.substring(c, 3, 3)).when(F.length(c) == 4, F.substring(c, 1, 3)).otherwise(c)
    usable = (F.trim(F.coalesce(pref, F.lit(""))) != "") & c.rlike("^[0-9]+$") & (F.length(short) == 3)
    return F.when(usable, F.concat(p, short)).otherwise("")


def code_from_numbers(pref: Column, city: Column) -> Column:
    """PRJ-4."""
    return F.concat(F.format_string("%02d", pref), F.format_string("%03d", city))


def prefecture_of(code: Column, fallback: Column) -> Column:
    """PRJ-5."""
    return F.when(code != "", F.substring(code, 1, 2)).otherwise(zero_fill(fallback, 2))


def lookup(c: Column, values: dict[str, str], default: str = "") -> Column:
    """PRJ-9, MAP-1: a constant map with a default."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(default))


def name_at(index: Column, names: list[str], default: str = "") -> Column:
    """PRJ-6: the name at a place of a list, counted from 1; the default outside of it."""
    return F.coalesce(F.when(index > 0, F.try_element_at(F.array(*map(F.lit, names)), index.cast("int"))), F.lit(default))


def filled(df: DataFrame, sentinels: dict[str, float]) -> DataFrame:
    """PRJ-13: columns with a sentinel where they are null, as filters of a map cannot ask for nulls."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in sentinels.items()})


def fixed_point(c: Column, digits: int) -> Column:
    """PRJ-10: a number with so many digits; nothing for null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c)).otherwise("")


def content_kind(c: Column) -> Column:
    """PRJ-16."""
    return F.when(c == "", "").when(c.startswith("#"), "overflow").when(c.contains("|"), "geology").otherwise("temp")


def start_year(c: Column) -> Column:
    """PRJ-17."""
    return F.substring(c, 1, 4).try_cast("int")


def era_year(c: Column, eras: dict[str, int] = ERAS) -> Column:
    """PRJ-18: the year of an era letter and number; an unknown era is an error."""
    year = F.raise_error(F.concat(F.lit("unknown era: "), c)).cast("int")
    for letter, before in eras.items():
        year = F.when(F.substring(c, 1, 1) == letter, F.substring(c, 2, 9).cast("int") + before).otherwise(year)
    return year


def partial_date(c: Column, unknown: str) -> Column:
    """DAT-1: YYYYMMDD where month and day may be 00; other text stays."""
    y, m, d = (F.regexp_extract(c, r"^(\d{4})(\d{2})(\d{2})$", i) for i in (1, 2, 3))
    return (
        F.when(c.rlike("^0+$"), unknown).when(y == "", c).when(m == "00", y).when(d == "00", F.concat_ws("-", y, m)).otherwise(F.concat_ws("-", y, m, d))
    )


def screens(c: Column) -> Column:
    """A multi-value field 18-29|34.5-45.5 as an array of (top, bottom)."""
    ends = lambda x: F.split(x, "-")
    return F.transform(F.filter(F.split(c, r"\|"), lambda x: x != ""), lambda x: F.struct(F.get(ends(x), F.lit(0)).try_cast("double").alias("top"), F.get(ends(x), F.lit(1)).try_cast("double").alias("bottom")))


def strata(c: Column) -> Column:
    """A field of repeating depth|fossil|name triples as an array of structs."""
    parts = F.split(c, r"\|")
    at = lambda i, k: F.coalesce(F.get(parts, i + k), F.lit(""))
    starts = F.sequence(F.lit(0), F.size(parts) - 1, F.lit(3))
    return F.when(c == "", F.array().cast("array<struct<depth:string,fossil:string,name:string>>")).otherwise(
        F.transform(starts, lambda i: F.struct(at(i, 0).alias("depth"), at(i, 1).alias("fossil"), at(i, 2).alias("name"))))
