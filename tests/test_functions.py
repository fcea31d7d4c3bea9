from __future__ import annotations

import hashlib
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martworks import functions as fn


def value(spark, column, **inputs):
    cells = [F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in inputs.items()]
    return spark.range(1).select(*cells, "id").select(column.alias("x")).first()["x"]


def test_surrogate_key_keeps_the_place_of_nulls(spark):
    def key(a, b, **options):
        return value(spark, fn.surrogate_key(["a", "b"], **options), a=a, b=b)

    assert key("SUP-001", "JAF-001") == "0c1009250b32f19a8c96b44ba55d3cb3"
    assert key(None, "x") == "3b4eefe862272d14394cff0e43854ab0"
    assert key(None, "x") != key("x", None)
    assert key(None, "x", nulls_as_empty=True) == hashlib.md5(b"-x").hexdigest()


def test_cents_to_dollars(spark):
    assert value(spark, fn.cents_to_dollars("c"), c=1105) == Decimal("11.05")
    assert value(spark, fn.cents_to_dollars("c"), c=100.5) == Decimal("1.01")
    assert value(spark, fn.cents_to_dollars("c"), c=-9_999_999_999_999_999) == Decimal("-99999999999999.99")


def test_booleans(spark):
    assert value(spark, fn.to_bool(F.col("t") == "x"), t=None) is False
    assert value(spark, fn.to_bool(F.col("t") == "x"), t="x") is True
    assert value(spark, F.when(fn.is_true(F.col("t") == "x"), 1).otherwise(0), t=None) == 0
    assert value(spark, fn.customer_type(F.lit(None).cast("boolean"))) == "new"


def test_null_safe_math(spark):
    assert value(spark, fn.safe_add(["a", "b", "c"]), a=1, b=2, c=3) == 6
    nothing = F.lit(None).cast("int")
    assert value(spark, fn.safe_add([F.lit(4), nothing])) == 4
    assert value(spark, fn.safe_subtract([nothing, F.lit(4), F.lit(1)])) == -5
    assert value(spark, fn.safe_divide("a", "b"), a=1, b=0) is None
    assert value(spark, fn.safe_divide("a", "b"), a=3, b=2) == 1.5
    with pytest.raises(TypeError):
        fn.safe_add("a")
    with pytest.raises(TypeError):
        fn.safe_subtract("a")


def test_haversine(spark):
    miles = value(spark, fn.haversine(F.lit(40.7), F.lit(-74.0), F.lit(51.5), F.lit(-0.1)))
    assert 3450 < miles < 3470
    kilometres = value(spark, fn.haversine(F.lit(40.7), F.lit(-74.0), F.lit(51.5), F.lit(-0.1), "km"))
    assert kilometres == pytest.approx(miles * 1.60934)
    with pytest.raises(ValueError):
        fn.haversine("a", "b", "c", "d", "yards")


@pytest.mark.parametrize("e, parity, standard", [(3, 1, 2), (11, 5, 6), (-7, -4, 0), (20, 7, 6)])
def test_both_bucket_forms(spark, e, parity, standard):
    assert value(spark, fn.width_bucket_macro("e", 1, 11, 5), e=e) == parity
    assert value(spark, fn.width_bucket(F.lit(float(e)), 1.0, 11.0, 5)) == standard


@pytest.mark.parametrize(
    "url, host, path, parameter",
    [
        ("https://a.b/x/y?p=1&q=2", "a.b", "x/y", "1"),
        ("http://a.b?p=1", "a.b", "", "1"),
        ("a.b", "a.b", "a.b", None),
        ("a.b?u=/z", "a.b", "z", None),
        ("android-app://c.d/e?xp=7#f", "c.d", "/c.d/e", "7#f"),
        ("https://a.b/?p=&q=1", "a.b", "", None),
    ],
)
def test_url_parts(spark, url, host, path, parameter):
    assert value(spark, fn.url_host("u"), u=url) == host
    assert value(spark, fn.url_path("u"), u=url) == path
    assert value(spark, fn.url_parameter("u", "p"), u=url) == parameter


@pytest.mark.parametrize(
    "text, slug", [("Hello  World-x!", "hello_world_x"), ("3 jars", "_3_jars"), ("", ""), ("a--b", "a_b"), ("!1", "_1")]
)
def test_slugify(spark, text, slug):
    assert value(spark, fn.slugify("t"), t=text) == slug
    assert fn.scalar.slug_name(text) == slug
    assert value(spark, fn.slugify("t"), t=None) == ""


def test_single_value(spark):
    rows = spark.createDataFrame([(None, 1)], "a int, b int")
    assert spark.range(1).select(fn.single_value(rows, 5).alias("x")).first()["x"] is None
    assert spark.range(1).select(fn.single_value(rows.filter("b > 1"), 5).alias("x")).first()["x"] == 5
    assert spark.range(1).select(fn.single_value(rows.select("b")).alias("x")).first()["x"] == 1


@pytest.mark.parametrize(
    "part, start, end, count",
    [
        ("day", "2024-02-28", "2024-03-01", 2),
        ("week", "2024-01-06", "2024-01-07", 1),  # Saturday to Sunday
        ("week", "2024-01-07", "2024-01-13", 0),
        ("month", "2024-01-31", "2024-02-01", 1),
        ("quarter", "2024-01-01", "2024-03-31", 0),
        ("year", "2023-12-31", "2024-01-01", 1),
        ("day", "2024-03-01", "2024-02-28", -2),
        ("hour", "2024-01-01 00:59:00", "2024-01-01 02:00:00", 2),
    ],
)
def test_boundaries_between(spark, part, start, end, count):
    moments = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    assert value(spark, fn.boundaries_between(part, *moments)) == count


def test_truncation_never_rounds_up(spark):
    moment = F.lit("2079-10-27 23:59:59.9999").cast("timestamp_ntz")
    assert str(value(spark, fn.truncated(moment))) == "2079-10-27"
    assert str(value(spark, fn.truncated(moment, "hour"))) == "2079-10-27 23:00:00"
    with pytest.raises(ValueError):
        fn.truncated(moment, "century")


def brute_host(url):
    for piece in ("android-app://", "http://", "https://"):
        url = url.replace(piece, "")
    return url.split("/")[0].split("?")[0]


def brute_path(url):
    rest = url.replace("http://", "").replace("https://", "")
    start = rest.find("/") + 1 or rest.find("?")
    # `right` with a length beyond the text gives the whole text.
    return (rest[start:] if start >= 0 else rest).split("?")[0]


def brute_parameter(url, name):
    parts = url.split(f"{name}=")
    return (parts[1].split("&")[0] if len(parts) > 1 else "") or None


def test_text_functions_against_brute_force(spark):
    rnd = random.Random(4)
    pieces = ["http://", "https://", "android-app://", "/", "?", "&", "p=", "=", "a", "b.c", "#", " ", "-", "7", "É", "_"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 9))) for _ in range(3000)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", fn.url_host("t").alias("h"), fn.url_path("t").alias("p"), fn.url_parameter("t", "p").alias("q"),
        fn.slugify("t").alias("s"),
    )
    for row in found.collect():
        text = row["t"]
        assert tuple(row)[1:] == (
            brute_host(text), brute_path(text), brute_parameter(text, "p"), fn.scalar.slug_name(text)
        ), text


def test_parity_bucket_against_brute_force(spark):
    low, high, buckets = -3, 12, 6
    width = Decimal(high - low) / buckets
    values = [Decimal(n) / 4 for n in range(-40, 80)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = df.select("v", fn.width_bucket_macro("v", low, high, buckets).alias("b")).collect()
    for row in found:
        v = Decimal(row["v"])
        assert row["b"] == min(math.ceil((v - low) / width), buckets + 1) + (1 if v % width == 0 else 0), v
