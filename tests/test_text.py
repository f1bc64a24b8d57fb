import pytest
from pyspark.sql import functions as F

from ratingstream.functions.text import decode_int_key, drop_last_field, encode_int_key, split_fields
from ratingstream.operators.parse import accepted, parse_rating, quarantined, reject_bad_lines


def _lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")


def test_split_fields_follows_java_split(spark):
    cases = {"1,2,3": 3, "1,2,3,": 3, "1,2,": 2, "1,,3": 3, ",a": 2, "": 1, "abc": 1, "1,2,3,,,": 3}
    df = _lines(spark, list(cases)).select("value", F.size(split_fields("value")).alias("n"))
    got = {r["value"]: r["n"] for r in df.collect()}
    assert got == cases


def test_parse_rating_rejects_and_accepts(spark):
    bad = ["x,2,3", "1,2", "1,2,", "1,2,3,4", " 1,2,3", "1,2,abc", "1,2.5,3", "99999999999,1,1"]
    good = ["1,2,3,", "1,2,3", "-4,+5, 2.5 ", "7,8,4.0f", "7,8,NaN", "7,8,1e2"]
    parsed = parse_rating(_lines(spark, bad + good), keep=["id", "value"])
    rejected = {r["value"]: r["reject_reason"] for r in quarantined(parsed).collect()}
    assert set(rejected) == set(bad)
    assert rejected["1,2"] == "field_count" and rejected["1,2,3,4"] == "field_count"
    assert rejected["x,2,3"] == "user_id" and rejected[" 1,2,3"] == "user_id"
    assert rejected["1,2.5,3"] == "movie_id" and rejected["1,2,abc"] == "rating"
    ok = {r["value"]: (r["user_id"], r["movie_id"], r["rating"]) for r in accepted(parsed).collect()}
    assert ok["1,2,3,"] == (1, 2, 3.0)
    assert ok["-4,+5, 2.5 "] == (-4, 5, 2.5)
    assert ok["7,8,4.0f"] == (7, 8, 4.0)
    assert ok["7,8,1e2"] == (7, 8, 100.0)
    assert ok["7,8,NaN"][2] != ok["7,8,NaN"][2]


def test_parse_rating_fail_mode_raises(spark):
    with pytest.raises(Exception, match="bad rating line"):
        parse_rating(_lines(spark, ["1,2,3", "oops"]), on_error="fail").collect()


def test_drop_last_field(spark):
    cases = {"1,2,3,4": "1,2,3", "1,2,3,": "1,2", "1": "", ",,,": "", "2200,3527,4.0,1422126710": "2200,3527,4.0"}
    df = _lines(spark, list(cases)).select("value", drop_last_field("value").alias("out"))
    assert {r["value"]: r["out"] for r in df.collect()} == cases


def test_encode_key_is_4_byte_big_endian(spark):
    df = spark.createDataFrame([(1,), (-1,), (0,), (2**31 - 1,), (-(2**31),), (258,)], "k int")
    out = df.select("k", F.hex(encode_int_key("k")).alias("h"), decode_int_key(encode_int_key("k")).alias("back"))
    got = {r["k"]: (r["h"], r["back"]) for r in out.collect()}
    assert got[1] == ("00000001", 1)
    assert got[-1] == ("FFFFFFFF", -1)
    assert got[258] == ("00000102", 258)
    assert got[2**31 - 1] == ("7FFFFFFF", 2**31 - 1)
    assert got[-(2**31)] == ("80000000", -(2**31))


def test_reject_bad_lines_checks_first_field_only(spark):
    df = reject_bad_lines(_lines(spark, ["1,x,y,z", "a,1,2,3", ",,,", "", "5"]))
    got = {r["value"]: r["rejected"] for r in df.collect()}
    assert got == {"1,x,y,z": False, "a,1,2,3": True, ",,,": True, "": True, "5": False}


def test_parse_plan_has_no_python(spark):
    parsed = parse_rating(_lines(spark, ["1,2,3"]))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
