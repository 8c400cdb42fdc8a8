import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terrasieve.functions import codes, text

CASES = {
    "円山動物園敷地内": "円山動物園敷地内 円山動物園 円山", "茨戸町茨戸公園団地内": "茨戸町茨戸公園団地内 茨戸町茨戸公園 茨戸町茨戸",
    "中央区南５条東２丁目": "中央区南5条東2丁目 中央区南5条東", "北12条東8丁目(北光小学校)": "北12条東8丁目 北12条東", "吹張町（": "吹張町", "宝生地先": "宝生地先 宝生",
    "真駒内": "真駒内", "水門町６－２７の北側隣接地": "水門町6-27の北側隣接地 水門町6-27 水門町", "桟橋通り4-10-1": "桟橋通り4-10-1 桟橋通り",
    "厚別町下野幌3-17番地(第2清掃工場)": "厚別町下野幌3-17番地 厚別町下野幌", "大戸町大字小谷字戸倉": "大戸町大字小谷字戸倉 大戸町小谷字戸倉 大戸町大字小谷戸倉",
    "立神津小学校の西）": "立神津小学校の西 立神津小学校 立神津", "": "",
}


def one(spark, rows, make):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r.out for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def names_to_try(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r.cands for r in text.with_candidates(df, "v").orderBy("i").collect()]


def test_candidates(spark):
    assert names_to_try(spark, CASES) == [v.split() for v in CASES.values()]
    assert names_to_try(spark, ["宮前町 国鉄旭川工場内"]) == [["宮前町 国鉄旭川工場内", "宮前町"]]
    assert names_to_try(spark, ["字福永　　（道北食肉施設№", None]) == [["字福永", "福永"], []]


@pytest.mark.parametrize("make, cases", [
    (text.arabic_block, {"十二丁目": "12丁目", "二十丁目": "20丁目", "十丁目": "10丁目", "三丁目": "3丁目", "二三丁目": "5丁目", "本町": "本町"}),
    (text.town_of, {"松が丘3丁目": "松ケ丘", "印内町": "印内", "大字小谷字戸倉": "大"}),
    (text.name_key, {"大字 小谷字戸倉": "小谷戸倉", "松ケ丘": "松ヶ丘", "井ノ頭通り": "井の頭通り", None: ""}),
    (text.street_key, {"井ノ頭通り": "井の頭通"}), (text.loose_town, {"松が丘3丁目": "松ケ丘3", "印内町": "印内"}),
    (text.without_house_number, {"印内１－２－１": "印内"}), (text.html_escape, {'<a&"b">': "&lt;a&amp;&quot;b&quot;&gt;"}),
    (text.header_key, {"住　　　所": "住所", "Lat": "lat"}), (codes.content_kind, {"": "", "###": "overflow", "0-5||砂": "geology", "15.2": "temp"}),
    (lambda c: codes.partial_date(c, "-"), {"19810220": "1981-02-20", "19810200": "1981-02", "19810000": "1981", "00000000": "-", "12": "12"}),
    (codes.era_year, {"昭55": 1980, "平10": 1998}), (text.number_of, {"1d": None, " 2.5 ": 2.5, "1_000": None, "-.5e1": -5.0, "": None}),
    (text.looks_like_lot, {"東町1-2-1": True, "2024-2-28": False}), (codes.start_year, {"19810220": 1981, "x": None}),
])
def test_scalars(spark, make, cases):
    assert one(spark, list(cases), make) == list(cases.values())


def test_codes(spark):
    cases = {("1", "101"): "01101", ("39", "39201"): "39201", ("38", "2015"): "38201", ("22", "13"): "", ("", "101"): "", ("1", "1A1"): "", ("2", "7"): "", ("13", "113"): "13113"}
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, p string, c string")
    assert [r.out for r in df.select("i", codes.municipality_code(F.col("p"), F.col("c")).alias("out")).orderBy("i").collect()] == list(cases.values())


def test_parts(spark):
    assert one(spark, ["1,札幌,3", "1,2", "4,01101,2"], text.label_parts) == [None, None, (4, "01101", 2)]
    assert one(spark, ["35.1, 139.2 x"], text.numbers_in) == [[35.1, 139.2]]
    assert one(spark, ["18-29|34.5-45.5"], codes.screens) == [[(18.0, 29.0), (34.5, 45.5)]]
    assert one(spark, ["5||砂|9|貝|泥", ""], codes.strata) == [[("5", "", "砂"), ("9", "貝", "泥")], []]
    line = lambda n: "\t".join(map(str, range(n)))
    got = one(spark, [line(47), line(48)], text.repaired_fields)
    assert got[0] == [str(i) for i in range(47)] and len(got[1]) == 47 and got[1][32] == "3233" and got[1][33] == "34"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="大字町村ケガの12-（）() 内地先", max_size=14), min_size=20, max_size=30))
def test_properties(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    key = text.name_key(F.col("v"))
    rows = text.with_candidates(df, "v", "c").select("c", key.alias("k"), text.name_key(key).alias("kk"), text.strip_repeat(F.col("v"), "(?:内|地先)$").alias("s"), "v").collect()
    for r in rows:
        assert len(set(r.c)) == len(r.c) and all(r.c)
        assert r.s or not r.v.strip(" 　")
        assert r.kk == r.k or "大" in r.k
