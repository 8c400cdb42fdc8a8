"""Text of addresses and names as columns (STR-*, PRJ-1, PRJ-2). Only NFKC needs Python, batch by batch."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Word lists that results depend on.
LOCATION_SUFFIXES = ("敷地内", "団地内", "工業団地内", "構内", "地内", "地先", "付近", "近傍", "隣接地", "の[東西南北](?:側|方)?", "[東西南北]側", "地区内")
FACILITY_SUFFIXES = (
    "小学校", "中学校", "高等学校", "高校", "学校", "幼稚園", "保育園", "大学", "工場", "製作所", "事業所", "営業所", "発電所",
    "浄水場", "下水処理場", "清掃工場", "処理場", "団地", "工業団地", "公園", "動物園", "球場", "競技場", "役場", "役所", "支所",
    "出張所", "公民館", "病院", "医院", "センター", "会館", "駅", "操車場", "車庫", "寮", "荘", "邸", "神社", "寺", "城跡",
)
LOT_NUMBER = "[0-9]+(?:-[0-9]+)*(?:番地|番|号)?$"
KANJI_DIGITS = "〇一二三四五六七八九"


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def clean(c: Column) -> Column:
    """PRJ-1: without white space of any width at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def zero_fill(c: Column, width: int) -> Column:
    """Leading zeros up to a width; longer text stays whole, which lpad would cut."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def repaired_fields(line: Column, width: int = 47, at: int = 32) -> Column:
    """PRJ-2, SRC-4: fields of a tab-separated line; one field too many means that field `at` was cut in two."""
    parts = F.split(line, "\t")
    joined = F.concat(F.slice(parts, 1, at), F.array(F.concat(F.get(parts, F.lit(at)), F.get(parts, F.lit(at + 1)))), F.slice(parts, at + 3, width))
    bad = F.raise_error(F.concat(F.lit("fields in a row: "), F.size(parts).cast("string"))).cast("array<string>")
    return F.when(F.size(parts) == width, parts).when(F.size(parts) == width + 1, joined).otherwise(bad)


def without_notes(s: Column) -> Column:
    """STR-1 on text that is in NFKC: no notes in brackets, no strays, one space between parts."""
    opened = F.length(s) - F.length(F.replace(s, F.lit("("), F.lit("")))
    rounds = F.sequence(F.lit(1), F.greatest(opened, F.lit(1)))  # each round takes the innermost pairs
    s = F.aggregate(rounds, s, lambda acc, _: F.regexp_replace(acc, r"\([^()]*\)", ""))
    s = F.regexp_replace(F.regexp_replace(s, r"\(.*$", ""), r"\)", "")
    s = F.regexp_replace(F.translate(s, "、〜", " -"), "・", "")
    return clean(F.regexp_replace(s, r"(?U)\s+", " "))


def base_normalize(c: Column) -> Column:
    """STR-1."""
    return without_notes(nfkc(F.coalesce(c, F.lit(""))))


def strip_repeat(c: Column, pattern: str, limit: int = 3) -> Column:
    """STR-2: cuts an end pattern up to `limit` times, but never leaves nothing."""

    def cut(s: Column, _: Column) -> Column:
        less = clean(F.regexp_replace(s, pattern, ""))
        return F.when(less == "", s).otherwise(less)

    return F.aggregate(F.sequence(F.lit(1), F.lit(limit)), c, cut)


def _ends(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")$"


def trim_candidates(parts: Column) -> Column:
    """Candidates without spaces and hyphens at the ends, empty ones and repeats; the first of equals stays."""
    tidy = F.transform(parts, lambda v: F.regexp_replace(v, "^[ 　-]+|[ 　-]+$", ""))
    return F.array_distinct(F.filter(tidy, lambda v: v != ""))


def _variants(v: Column) -> Column:
    block = F.regexp_extract(v, "^(.*?[0-9]+)丁目", 0)
    plain = F.regexp_replace(v, "(?<!大)字", "")
    return F.array(
        F.when(v.contains("大字"), F.replace(v, F.lit("大字"), F.lit(""))).otherwise(""), F.when(plain != v, plain).otherwise(""),
        block, F.when(block != "", F.regexp_replace(v, "[0-9]+丁目.*$", "")).otherwise(""),
    )


def with_candidates(df: DataFrame, adr: str, out: str = "cands", location: str = _ends(LOCATION_SUFFIXES), facility: str = _ends(FACILITY_SUFFIXES)) -> DataFrame:
    """STR-6: `df` with the names to try for an address, careful ones first: whole, first word, without location, lot number
    and facility, and of each the variants that drop 大字, 字 and what follows 丁目.

    Every stage is a column of its own that later ones read, so that Spark computes it once; Python is called once a row.
    """
    head = lambda c: F.split(c, " ", 2)[0]
    stages = {
        "__nfkc": nfkc(F.coalesce(adr, F.lit(""))), "__whole": without_notes(F.col("__nfkc")), "__placed": strip_repeat(F.col("__whole"), location),
        "__unlotted": clean(F.regexp_replace("__placed", LOT_NUMBER, "")), "__bare": strip_repeat(F.col("__unlotted"), facility), "__last": clean(F.regexp_replace("__bare", LOT_NUMBER, "")),
        "__first": trim_candidates(F.array("__whole", head("__whole"), "__placed", "__unlotted", head("__unlotted"), "__bare", "__last")),
        "__wide": F.concat("__first", F.flatten(F.transform("__first", _variants))),
    }
    for name, stage in stages.items():
        df = df.withColumn(name, stage)
    return df.withColumn(out, trim_candidates(F.col("__wide"))).drop(*stages)


def without_prefix(cands: Column, prefix: Column) -> Column:
    """PRJ-8: candidates without a leading ward name."""
    cut = F.transform(cands, lambda v: F.when((prefix != "") & v.startswith(prefix), F.btrim(F.substring(v, F.length(prefix) + 1, F.length(v)))).otherwise(v))
    return F.array_distinct(F.filter(cut, lambda v: v != ""))


def name_key(c: Column) -> Column:
    """STR-7: the key under which names of towns match."""
    return folded(nfkc(F.coalesce(c, F.lit(""))))


def folded(c: Column) -> Column:
    """STR-7 on text that is in NFKC already, as candidates are: without Python, so inside arrays too."""
    s = F.regexp_replace(c, r"(?U)\s+", "")
    return F.translate(F.regexp_replace(F.replace(s, F.lit("大字"), F.lit("")), "字", ""), "ケガ之ノ", "ヶヶのの")


def street_key(c: Column) -> Column:
    """STR-8: as STR-7, with 通り as 通; the two keys are kept apart."""
    s = F.regexp_replace(nfkc(F.coalesce(c, F.lit(""))), r"(?U)\s+", "")
    s = F.replace(F.regexp_replace(F.replace(s, F.lit("大字"), F.lit("")), "字", ""), F.lit("通り"), F.lit("通"))
    return F.translate(s, "ケガ之ノ", "ヶヶのの")


def arabic_block(c: Column) -> Column:
    """STR-9: a numbered block 十二丁目 as 12丁目; without 十 the digits are summed, other text stays."""
    number = F.regexp_extract(c, "^([〇一二三四五六七八九十]+)丁目$", 1)
    digit = lambda x: F.locate(x, F.lit(KANJI_DIGITS)) - 1 if isinstance(x, str) else F.instr(F.lit(KANJI_DIGITS), x) - 1
    tens, units = F.regexp_extract(number, "^([^十]*)十", 1), F.regexp_extract(number, "十(.*)$", 1)
    known = lambda x, other: F.when(x == "", other).when(F.length(x) == 1, F.when(digit(x) >= 0, digit(x)).otherwise(other))
    by_ten = F.coalesce(known(tens, F.lit(1)), F.lit(1)) * 10 + F.coalesce(known(units, F.lit(0)), F.lit(0))
    summed = F.aggregate(F.split(number, ""), F.lit(0), lambda acc, d: acc + F.when(d == "", 0).otherwise(digit(d)))
    value = F.when(number.contains("十"), by_ten).otherwise(summed)
    return F.when(number == "", c).otherwise(F.concat(value.cast("string"), F.lit("丁目")))


def town_name(c: Column) -> Column:
    """STR-10."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[ヶケが]", "ケ"), "^大字|^字", ""), "(町|村)$", "")


def town_of(c: Column) -> Column:
    """STR-11: the town of an address; a cut at 字 comes first, so 大字X gives 大."""
    return town_name(F.regexp_replace(F.regexp_replace(c, "[0-9０-９一二三四五六七八九十]+丁目.*$", ""), "字.*$", ""))


def loose_town(c: Column) -> Column:
    """STR-12."""
    return F.replace(F.regexp_replace(F.regexp_replace(c, "[ヶケが]", "ケ"), "町", ""), F.lit("丁目"), F.lit(""))


def without_house_number(c: Column) -> Column:
    """STR-13."""
    return F.regexp_replace(nfkc(c), r"[0-9\-]+$", "")


def header_key(c: Column) -> Column:
    """STR-14: a column name without white space, in lower case."""
    return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))


def looks_like_lot(c: Column) -> Column:
    """STR-15: a cell that holds a lot number and a character of addresses."""
    return c.rlike("[0-9０-９]+\\s*[-－‐ー の丁目番地]+\\s*[0-9０-９]") & c.rlike("[市区町村丁目番地]")


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_of(c: Column) -> Column:
    """PRJ-12: the number a text holds, else null; suffixes that Java alone takes do not count."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def numbers_in(c: Column) -> Column:
    """STR-16: the numbers among parts between commas and spaces."""
    return F.filter(F.transform(F.split(F.translate(c, ",", " "), " +"), number_of), lambda x: x.isNotNull())


def label_parts(c: Column) -> Column:
    """STR-17: (seq, city, use) of a label of three numbers, else null."""
    parts = F.split(c, ",")
    good = (F.size(parts) == 3) & F.forall(parts, lambda p: p.rlike("^[0-9]+$"))
    return F.when(good, F.struct(F.get(parts, F.lit(0)).cast("int").alias("seq"), F.get(parts, F.lit(1)).alias("city"), F.get(parts, F.lit(2)).cast("int").alias("use")))


def html_escape(c: Column) -> Column:
    """STR-18."""
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c
