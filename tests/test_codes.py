import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxlake.functions.codes import normalize_code, readable_code, register_sql_function

VECTORS = [
    ("0002-1433-01", "00002143301"),
    ("55513-101-01", "55513010101"),
    ("60429-1127-1", "60429112701"),
    ("12345-6789-01", "12345678901"),
    ("00002143301", "00002143301"),
    ("0002143301", "00021433001"),
    (None, None),
    ("", None),
    ("  0002-1433-01  ", "00002143301"),
    ("1-2", None),
    ("1-2-3", "00001000203"),
    ("123456-1-1", "123456000101"),
    ("ABCD-12-1", "0ABCD001201"),
    ("123", "00000000123"),
    ("12345678901x", None),
    ("123456789012", None),
    ("\t0002-1433-01\n", "00002143301"),
    ("00 02-1433-01", "00002143301"),
    ("--", "00000000000"),
    ("   ", None),
    ("1-2-3-4", None),
    ("000000001", "00000000001"),
    ("00001-00012-011", "00001000120" + "11"),
    ("-1-", "00000000100"),
    ("UNK7", None),
]


def expected(raw):
    """The rules, one character class at a time."""
    if raw is None:
        return None
    text = raw.strip(" \t\n\r\f\v").replace(" ", "")
    text = text.strip("\t\n\r\f\v")
    parts = text.split("-")
    if len(parts) == 3:
        return "".join(p.rjust(w, "0") for p, w in zip(parts, (5, 4, 2)))
    if not re.fullmatch("[0-9]{1,11}", text):
        return None
    return text[:9] + "0" + text[9] if len(text) == 10 else text.rjust(11, "0")


def normalized(spark, codes):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, raw string")
    out = df.select("i", normalize_code(F.col("raw")).alias("x"), "raw")
    readable = df.select("i", readable_code(F.col("raw")).alias("ok")).collect()
    rows = {r["i"]: r["x"] for r in out.collect()}
    for r in readable:
        assert bool(r["ok"]) == (rows[r["i"]] is not None)
    return [rows[i] for i in range(len(codes))]


def test_vectors(spark):
    assert normalized(spark, [v for v, _ in VECTORS]) == [e for _, e in VECTORS]


def test_sql_function(spark):
    register_sql_function(spark)
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(VECTORS)], "i int, raw string")
    df.createOrReplaceTempView("codes")
    rows = spark.sql("SELECT i, normalize_ndc(raw) AS x FROM codes").collect()
    assert {r["i"]: r["x"] for r in rows} == {i: e for i, (_, e) in enumerate(VECTORS)}


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("0123456789- \tAx", max_size=14), min_size=50, max_size=120))
def test_against_rules(spark, codes):
    got = normalized(spark, codes)
    assert got == [expected(c) for c in codes]
    assert all(len(c) >= 11 for c in got if c is not None)


@pytest.mark.parametrize("code", ["00002143301", "99999999999"])
def test_idempotent(spark, code):
    assert normalized(spark, [code]) == [code]
