import base64
from datetime import datetime, timezone
from decimal import Decimal, getcontext

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import date_key, day_of_week, decimal_from_base64, iso_timestamp, micro_timestamp
from workloads.logs import decimal_to_base64

getcontext().prec = 60
# Every example is a Spark job over many values, so few examples and no shrinking.
BULK = settings(
    max_examples=3,
    deadline=None,
    phases=[Phase.explicit, Phase.generate],
    suppress_health_check=list(HealthCheck),
)


def wire(unscaled: int) -> str:
    size = ((unscaled if unscaled >= 0 else ~unscaled).bit_length() + 8) // 8
    return base64.b64encode(unscaled.to_bytes(size, "big", signed=True)).decode()


def decode(spark, texts, precision=12, scale=2):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, x string")
    out = rows.select("n", decimal_from_base64(F.col("x"), precision, scale).alias("v")).collect()
    return [r["v"] for r in sorted(out, key=lambda r: r["n"])]


def test_decimal_edges(spark):
    values = [0, 1, -1, 127, 128, -128, -129, 255, 256, -32768, 663464724, 2**39, -(2**39)]
    assert decode(spark, [wire(v) for v in values]) == [Decimal(v).scaleb(-2) for v in values]
    assert decode(spark, ["J4urFA=="]) == [Decimal("6634647.24")]


def test_decimal_wide(spark):
    values = [2**63 - 1, -(2**63), 2**63, -(2**63) - 1, 10**27, -(10**27), 12 * 10**21, 2**64, -(2**64)]
    assert decode(spark, [wire(v) for v in values], 38, 2) == [Decimal(v).scaleb(-2) for v in values]
    # An unshortened encoding has the same value.
    long_form = base64.b64encode((-5).to_bytes(12, "big", signed=True)).decode()
    assert decode(spark, [long_form]) == [Decimal("-0.05")]


def test_decimal_bad_input(spark):
    too_long = base64.b64encode(b"\x01" * 17).decode()
    bad = [None, "####", "AQ", "AQI", "A", "=", "AQ==AQ==", "not base64!", too_long, wire(10**12)]
    assert decode(spark, bad) == [None] * len(bad)
    assert decode(spark, [""]) == [Decimal("0.00")]
    assert decode(spark, [wire(10**12)], 14) == [Decimal("10000000000.00")]


@BULK
@given(st.lists(st.integers(-(2**100), 2**100), min_size=50, max_size=200), st.integers(0, 6))
def test_decimal_any_width(spark, values, scale):
    assert decode(spark, [wire(v) for v in values], 38, scale) == [Decimal(v).scaleb(-scale) for v in values]


@BULK
@given(st.lists(st.integers(-(10**14) + 1, 10**14 - 1), min_size=50, max_size=200))
def test_decimal_round_trip(spark, values):
    rows = spark.createDataFrame([(n, Decimal(v).scaleb(-2)) for n, v in enumerate(values)], "n int, v decimal(14,2)")
    coded = rows.select("n", "v", decimal_to_base64(F.col("v")).alias("x"))
    back = coded.select("n", "v", "x", decimal_from_base64(F.col("x"), 14, 2).alias("w")).collect()
    for row in back:
        assert row["w"] == row["v"]
        assert row["x"] == wire(values[row["n"]])


def test_micro_timestamp(spark):
    texts = ["1773794542598663", "0", "-1", None, "soon", ""]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, x string")
    got = {r["n"]: r["v"] for r in rows.select("n", F.unix_micros(micro_timestamp(F.col("x"))).alias("v")).collect()}
    assert got == {0: 1773794542598663, 1: 0, 2: -1, 3: None, 4: None, 5: None}


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-03-17T22:50:00.123456+00:00", datetime(2026, 3, 17, 22, 50, 0, 123456, timezone.utc)),
        ("2026-03-17T22:50:00Z", datetime(2026, 3, 17, 22, 50, tzinfo=timezone.utc)),
        ("2026-03-18T05:50:00+07:00", datetime(2026, 3, 17, 22, 50, tzinfo=timezone.utc)),
        ("not a time", None),
        (None, None),
    ],
)
def test_iso_timestamp(spark, text, expected):
    rows = spark.createDataFrame([(text,)], "x string")
    got = rows.select(F.unix_micros(iso_timestamp(F.col("x"))).alias("v")).first()["v"]
    assert got == (None if expected is None else int(expected.timestamp() * 1_000_000))


def test_calendar(spark):
    rows = spark.createDataFrame([("2024-02-29 23:59:59",), ("2024-03-03 00:00:00",)], "x string")
    got = rows.select(
        date_key(F.col("x").cast("timestamp")).alias("k"), day_of_week(F.col("x").cast("date")).alias("w")
    ).collect()
    assert [tuple(r) for r in got] == [(20240229, 4), (20240303, 0)]
