import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lienspark.functions import (
    cost_category,
    debt_to_income,
    loan_to_value,
    risk_segment,
    share,
    text_to_double,
    text_to_integer,
)
from lienspark.settings import session_conf

TEXTS = [
    "63.5", "99999", "99999999999", "NA", "Exempt", "", None, "  7 ", "+5", "-5.9", ".5", "5.",
    ".", "-", "-.", "+.5", "1e3", "1d", "0x10", "32768", "-32769.1", "1.2.3", "1.a", "5 . 5",
    "5. 5", "5\t", "32767.9", "2147483647.9", "2147483648.0", "-2147483648",
]


def both_ways(spark, texts, kind):
    """What our cast gives under ANSI, and what a plain cast gives without it."""
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    with session_conf(spark, {"spark.sql.ansi.enabled": "true"}):
        ours = [
            r[0]
            for r in frame.orderBy("i").select(text_to_integer("v", kind)).collect()
        ]
    with session_conf(spark, {"spark.sql.ansi.enabled": "false"}):
        plain = [r[0] for r in frame.orderBy("i").select(F.col("v").cast(kind)).collect()]
    return ours, plain


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_integer_cast_is_the_cast_without_ansi(spark, kind):
    ours, plain = both_ways(spark, TEXTS, kind)
    assert dict(zip(TEXTS, ours)) == dict(zip(TEXTS, plain))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    texts=st.lists(
        st.text(alphabet="0123456789.+- aeNA", max_size=12), min_size=200, max_size=400
    )
)
def test_integer_cast_on_any_text(spark, texts):
    ours, plain = both_ways(spark, texts, "int")
    assert ours == plain


def test_known_integer_casts(spark):
    ours, _ = both_ways(spark, ["63.5", "99999", "NA", "Exempt", "", None], "smallint")
    assert ours == [63, None, None, None, None, None]


def test_double_cast(spark):
    frame = spark.createDataFrame([("5.25",), ("NA",), ("Exempt",), ("",), (None,)], "v string")
    values = [r[0] for r in frame.select(text_to_double("v")).collect()]
    assert values == [5.25, None, None, None, None]


def test_loan_to_value_of_nothing_is_null(spark):
    frame = spark.createDataFrame(
        [(80.0, 100.0), (80.0, 0.0), (80.0, None), (None, 100.0)], "a double, v double"
    )
    values = [r[0] for r in frame.select(loan_to_value(F.col("a"), F.col("v"))).collect()]
    assert values == [0.8, None, None, None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("<20%", 0.20),
        ("20%-<30%", 0.20),
        ("30%-<36%", 0.30),
        ("36", 0.36),
        ("49", 0.49),
        ("50%-60%", 0.50),
        (">60%", 0.60),
        ("NA", None),
        ("Exempt", None),
        ("", None),
        (None, None),
    ],
)
def test_debt_to_income(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "v string")
    (value,) = frame.select(debt_to_income(F.col("v"))).first()
    assert value is None if expected is None else math.isclose(value, expected)


SEGMENTS = [
    (0.9, None, "High"),
    (0.8, 0.36, "Medium"),
    (0.8, None, "Low"),
    (0.6, 0.36, "Medium"),
    (0.59, 0.5, "Low"),
    (None, None, "Low"),
    (None, 0.5, "Low"),
    (0.7, 44.0, "High"),
    (None, 44.0, "High"),
]


def test_segments_as_written(spark):
    frame = spark.createDataFrame(SEGMENTS, "ltv double, dti double, expected string")
    found = frame.select(risk_segment(F.col("ltv"), F.col("dti")).alias("s"), "expected")
    assert found.where("s != expected").isEmpty()


def test_segments_in_percent(spark):
    rows = [(0.7, 0.44, "High"), (0.7, 0.43, "Medium"), (None, 0.5, "High"), (0.5, 0.43, "Low")]
    frame = spark.createDataFrame(rows, "ltv double, dti double, expected string")
    found = frame.select(risk_segment(F.col("ltv"), F.col("dti"), 100).alias("s"), "expected")
    assert found.where("s != expected").isEmpty()


def test_cost_category(spark):
    frame = spark.createDataFrame([(0.1,), (0.0,), (-1.0,), (None,)], "s double")
    values = [r[0] for r in frame.select(cost_category(F.col("s"))).collect()]
    assert values == ["High Cost"] + ["Market/Subsidized"] * 3


def test_share_of_nothing(spark):
    frame = spark.createDataFrame([(1, 4), (1, 0)], "a bigint, b bigint")
    result = frame.select(share(F.col("a"), F.col("b")).alias("s"))
    assert [r.s for r in result.collect()] == [0.25, None]
    assert result.dtypes == [("s", "double")]
