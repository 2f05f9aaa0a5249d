"""Validity rules and column functions on hand-made edge rows."""

import datetime as dt
from decimal import Decimal

import pytest
from compare import rows
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark import functions as X
from tidemark.operators import apply_rules, reject_breakdown, route
from tidemark.operators.rules import domain_rules

D = dt.date


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_product_rules_report_the_first_failure(spark):
    data = [
        (1, "a", 1.0, None), (None, None, -1.0, None), (2, None, -1.0, None), (3, "a", None, None),
        (4, "a", -0.5, None), (5, "a", 0.0, None), (6, "a", 1.0, "{broken"),
    ]
    df = apply_rules(
        spark.createDataFrame(data, "id long, title string, price double, _corrupt_record string"),
        domain_rules("products"),
    )
    assert [r["_reject_reason"] for r in df.collect()] == [
        None, K.REASON_NO_ID, K.REASON_NO_TITLE, K.REASON_NO_PRICE, K.REASON_NEGATIVE_PRICE, None,
        K.REASON_UNREADABLE,
    ]
    assert [r["_is_valid"] for r in df.collect()] == [True, False, False, False, False, True, False]
    assert len(rows(reject_breakdown(df))) == 5


def test_user_rules(spark):
    data = [(1, "a@b"), (2, None), (3, "nobody"), (None, "a@b")]
    df = spark.createDataFrame(data, "id long, email string").withColumn(
        "_corrupt_record", F.lit(None).cast("string")
    )
    found = [r["_reject_reason"] for r in apply_rules(df, domain_rules("users")).collect()]
    assert found == [None, K.REASON_NO_EMAIL, K.REASON_BAD_EMAIL, K.REASON_NO_ID]


def test_cart_rules_treat_null_and_empty_alike(spark):
    schema = ("id long, userId long, products array<struct<productId: bigint, quantity: int>>, "
              "_corrupt_record string")
    data = [(1, 1, [(1, 2)], None), (2, 1, [], None), (3, 1, None, None), (4, None, [(1, 1)], None)]
    found = apply_rules(spark.createDataFrame(data, schema), domain_rules("carts")).collect()
    assert [r["_reject_reason"] for r in found] == [
        None, K.REASON_EMPTY_CART, K.REASON_EMPTY_CART, K.REASON_NO_USER,
    ]


def test_route_is_complementary_for_unknown_predicates(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    ok, refused = route(df, F.col("x") > 2)
    assert (ok.count(), refused.count()) == (1, 2)


@pytest.mark.parametrize("email, masked, domain", [
    ("john@x.org", "j***@x.org", "x.org"), ("nobody", None, None), (None, None, None),
])
def test_email(spark, email, masked, domain):
    c = F.col("e")
    assert values(spark, [(email,)], "e string", X.mask_email(c), X.email_domain(c)) == [(masked, domain)]


def test_text(spark):
    c = F.col("t")
    found = values(spark, [("  Men's CLOTHING ",), (None,)], "t string",
                   X.slug(c), X.title_label(c), X.digits(c))
    assert found == [("men's clothing", "Men S Clothing", ""), (None, None, "")]


def test_valid_range(spark):
    data = [("45.5",), ("91",), ("abc",), (None,), ("-90",)]
    assert values(spark, data, "v string", X.valid_range(F.col("v"), -90, 90)) == [
        (45.5,), (None,), (None,), (None,), (-90.0,)
    ]


def test_bands(spark):
    data = [(0.0,), (24.99,), (25.0,), (99.99,), (100.0,), (500.0,), (None,)]
    found = values(spark, data, "p double", X.bucketize(F.col("p"), K.PRICE_BAND_BOUNDS, K.PRICE_BAND_LABELS))
    a, b, c, d = K.PRICE_BAND_LABELS
    assert [r[0] for r in found] == [a, a, b, b, c, d, d]


def test_complete_counts_unknown_as_incomplete(spark):
    data = [("a long description",), (None,), ("x",)]
    found = values(spark, data, "d string", X.complete(F.length("d") > 5))
    assert found == [(True,), (False,), (False,)]


def test_ratio_rounds_half_up_and_survives_zero_and_overflow(spark):
    data = [(Decimal("10.05"), 2), (Decimal("1.00"), 0), (Decimal("9999999999.00"), 1), (Decimal("-10.05"), 2)]
    found = values(spark, data, "a decimal(12,2), b long", X.ratio(F.col("a"), F.col("b"), 6, 2))
    assert found == [(Decimal("5.03"),), (None,), (None,), (Decimal("-5.03"),)]


def test_business_key_never_truncates(spark):
    day = F.col("d")
    found = values(spark, [(D(2024, 3, 1), 7), (D(2024, 3, 1), 12345)], "d date, c long",
                   X.business_key("ORD", day, (F.col("c"), 3), F.lit(0)))
    assert found == [("ORD-20240301-007-0",), ("ORD-20240301-12345-0",)]


def test_murmur_uniform_has_the_published_steps(spark):
    df = spark.range(2000).select(X.hash_uniform(F.col("id"), F.lit("2024-01-01"), "occur").alias("u"))
    low, high = df.agg(F.min("u"), F.max("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1
    assert df.where(F.abs(F.col("u") * 100000 - F.round(F.col("u") * 100000)) > 1e-6).count() == 0
    text = "1|2024-01-01|occur|20260909"
    expected = spark.sql(f"SELECT pmod(hash('{text}'), 100000) / 100000.0").first()[0]
    got = df.collect()[1]["u"]
    assert got == pytest.approx(float(expected))


def test_picks_reach_beyond_the_published_steps(spark):
    key, day = F.col("id"), F.lit("2024-01-01")
    for method in ("murmur3", "md5"):
        found = spark.range(400_000).select(X.hash_pick(key, day, "cust", 1_000_000, method=method).alias("b"))
        low, high, distinct = found.agg(F.min("b"), F.max("b"), F.count_distinct("b")).first()
        assert 1 <= low and high <= 1_000_000
        assert abs(distinct / (1_000_000 * (1 - 2.718281828 ** -0.4)) - 1) < 0.01
    # Among ten the choices are the published ones.
    published = X.hash_bucket(X.hash_uniform(key, day, "cust"), 10)
    assert spark.range(5000).where(X.hash_pick(key, day, "cust", 10) != published).count() == 0


def test_hash_bucket_reaches_every_bucket(spark):
    u = X.hash_uniform(F.col("id"), F.lit("2024-01-01"), "cust")
    found = spark.range(5000).select(X.hash_bucket(u, 10).alias("b")).groupBy("b").count().collect()
    assert {r["b"] for r in found} == set(range(1, 11))
    assert min(r["count"] for r in found) > 400


def test_history_is_exact_on_the_anchor_and_bounded_before(spark):
    anchor = F.lit("2024-06-30").cast("date")
    data = [(1, D(2024, 6, 30)), (1, D(2024, 1, 2)), (1, D(2020, 1, 1)), (1, D(2024, 7, 9))]
    found = values(spark, data, "k long, d date",
                   X.back_projection(F.col("k"), F.col("d"), anchor), X.growth(F.col("d"), anchor))
    assert found[0] == (1.0, 1.0) and found[3][0] == 1.0
    assert all(K.FACTOR_FLOOR <= f <= K.FACTOR_CEILING for f, _ in found)
    assert found[1][1] == pytest.approx(K.GROWTH_START)
    assert found[2][1] == pytest.approx(K.GROWTH_START)


def test_weekday_rate_and_order_time(spark):
    data = [(D(2024, 6, 30),), (D(2024, 7, 1),), (D(2024, 7, 6),)]
    rates = values(spark, data, "d date", X.weekday_rate(F.col("d")))
    assert [r[0] for r in rates] == [0.80, 0.45, 0.85]
    times = values(spark, data[:1], "d date", X.order_time(F.col("d"), F.lit(0.999), F.lit(0.5)))
    assert times == [(dt.datetime(2024, 6, 30, 20, 30),)]


def test_record_hash_leaves_secrets_out(spark):
    df = spark.createDataFrame([(1, "a", "p1"), (1, "a", "p2")], "id long, name string, password string")
    hashes = {r[0] for r in df.select(X.record_hash(df, exclude=["password"])).collect()}
    assert len(hashes) == 1
