import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewflow.functions.labels import label_name, percent_text, polarity
from reviewflow.functions.phone import phone_ok
from reviewflow.functions.text import full_text, nonblank, utrim
from reviewflow.operators import model as mdl
from reviewflow.operators import prepare as prep


def test_polarity_truncates_and_keeps_missing(spark):
    df = spark.createDataFrame([(3.0,), (3.9,), (4.0,), (1.0,), (5.0,), (None,), (math.nan,)], "r double")
    got = [r[0] for r in df.select(polarity("r")).collect()]
    assert got == [0, 0, 1, 0, 1, None, None]


def test_polarity_fail_on_missing(spark):
    df = spark.createDataFrame([(None,)], "r double")
    with pytest.raises(Exception):
        df.select(polarity("r", on_missing="fail")).collect()


def test_full_text_null_rules(spark):
    rows = [("a", "b"), (None, "b"), ("a", None), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "title string, text string")
    plain = [r[0] for r in df.select(full_text("title", "text")).collect()]
    filled = [r[0] for r in df.select(full_text("title", "text", fill=True)).collect()]
    assert plain == ["a. b", None, None, None, ". "]
    assert filled == ["a. b", ". b", "a. ", ". ", ". "]


def test_prepare_restores_missing_fields(spark):
    df = spark.createDataFrame([(4.0,)], "rating double")
    out = prep.prepare(df)
    assert {"title", "text", "sentiment", "review_full_text"} <= set(out.columns)
    assert out.first()["review_full_text"] is None


def test_phone_cases(spark):
    cases = {"855-555-1212": True, "195-555-1212": False, "295-555-1212": False,
             "855-555-1212\n": True, " 855-555-1212 ": True, "٨٥٥-555-1212": False,
             "8555551212": False, None: False}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = dict(df.select("p", phone_ok("p").alias("ok")).collect())
    assert got == cases


def test_nonblank(spark):
    df = spark.createDataFrame([("x",), ("  ",), (" \t",), (None,), (" y ",)], "t string")
    assert [r[0] for r in df.select(nonblank("t")).collect()] == [True, False, False, False, True]


def test_label_display(spark):
    df = spark.createDataFrame([("LABEL_1", 0.88125), ("LABEL_0", 0.5), ("OTHER", 0.7), (None, 0.9)],
                               "code string, score double")
    rows = df.select(label_name("code"), percent_text("score")).collect()
    assert [r[0] for r in rows] == ["POSITIVE", "NEGATIVE", "NEGATIVE", "NEGATIVE"]
    assert rows[0][1] == "88.13%" and rows[1][1] == "50.00%"


def test_display_of_empty_answer(spark):
    df = spark.createDataFrame([([],)], "a array<struct<label:string,score:double>>")
    code, name, conf = mdl.display(F.col("a"))
    r = df.select(code, name, conf).first()
    assert tuple(r) == (None, "NEGATIVE", None)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x3100), max_size=12), min_size=1, max_size=20))
def test_utrim_equals_str_strip(spark, values):
    pads = [" \t", "\x1c　", " \x85", "﻿", "​", ""]
    vals = [pads[i % len(pads)] + v + pads[(i * 5) % len(pads)] for i, v in enumerate(values)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", utrim("s").alias("t")).collect()}
    assert got == {i: v.strip() for i, v in enumerate(vals)}
