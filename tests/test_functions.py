"""Column helpers under ANSI mode: malformed input yields NULL instead of failing."""

import datetime as dt

from pyspark.sql import functions as F

from corvid.functions import nested, parse, text
from corvid.sources.files import from_local


def test_parse_pair_and_ids(spark):
    df = from_local(spark, [("a,1.5", "17593.0"), ("b,x", "C536379"), ("c", None)], "line string, id string")
    rows = df.select(parse.parse_pair("line").alias("p"), parse.to_int_id("id").alias("i")).collect()
    assert [(r.p.key, r.p.value, r.i) for r in rows] == [("a", 1.5, 17593), ("b", None, None), ("c", None, None)]


def test_timestamps_with_patterns(spark):
    df = from_local(spark, [("4/7/2019 9:05", "04/19/95 08:46"), ("bad", "12/31/49 23:59")], "a string, b string")
    rows = df.select(parse.to_ts("a", "M/d/yyyy H:mm").alias("a"),
                     parse.to_ts_two_digit_year("b", "MM/dd/yy HH:mm").alias("b")).collect()
    assert rows[0].a == dt.datetime(2019, 4, 7, 9, 5) and rows[1].a is None
    assert rows[0].b == dt.datetime(1995, 4, 19, 8, 46) and rows[1].b == dt.datetime(2049, 12, 31, 23, 59)


def test_text_helpers_keep_unicode_letters(spark):
    df = from_local(spark, [("  Élan, vital!  ça\tva 42_x ",)], "t string")
    r = df.select(text.tokens("t").alias("raw"), text.clean_tokens("t").alias("clean"),
                  text.characters(F.lit("abc")).alias("chars")).first()
    assert r.raw == ["Élan,", "vital!", "ça", "va", "42_x"]
    assert r.clean == ["élan", "vital", "ça", "va", "42_x"]
    assert r.chars == ["a", "b", "c"]


def test_nested_json_round_trip_and_explode_outer(spark):
    df = from_local(spark, [(1, '{"k": 5}', [1, 2]), (2, "not json", [])], "id int, js string, xs array<int>")
    parsed = nested.parse_json(df, "js", "k INT").select("id", "data.k").collect()
    assert [(r.id, r.k) for r in parsed] == [(1, 5), (2, None)]
    items = df.select("id", F.transform("xs", lambda x: F.struct(x.alias("x"))).alias("items"))
    assert nested.explode_items(items, "items", ["id"]).count() == 2
    assert nested.explode_items(items, "items", ["id"], outer=True).count() == 3
    assert df.select(nested.json_of("id").alias("j")).first().j == '{"id":1}'
