from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from conftest import at, rows
from pyspark.sql import functions as F

from wagerlens.functions.measures import average, money_percent, percent, risk_class, safe_ratio
from wagerlens.functions.text import (
    NULL_KEY_PART,
    lower_trimmed,
    money_text,
    surrogate_key,
    trimmed,
    upper_trimmed,
)
from wagerlens.functions.times import moment_of, stamp

D = Decimal


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_trim_removes_every_kind_of_white_space(spark):
    text = F.lit("\t\n\xa0  Ana Maria　\r\n ")
    assert one(spark, trimmed(text)) == "Ana Maria"
    assert one(spark, lower_trimmed(text)) == "ana maria"
    assert one(spark, upper_trimmed(text)) == "ANA MARIA"
    assert one(spark, trimmed(F.lit(None).cast("string"))) is None


def test_percent_edges(spark):
    data = [(5, 0), (3, 2), (5, None), (None, 5), (1, 3), (1, 800), (-1, 800), (0, 7)]
    df = spark.createDataFrame(data, "n long, d long")
    got = [r[0] for r in df.select(percent("n", "d")).collect()]
    # 1/800 = 0.125 %, which rounds away from zero.
    assert got == [0.0, 150.0, 0.0, None, 33.33, 0.13, -0.13, 0.0]


def test_percent_and_average_equal_exact_arithmetic(spark):
    rnd = random.Random(7)
    data = [(rnd.randrange(0, 10**rnd.randrange(1, 12)), rnd.randrange(1, 10**rnd.randrange(1, 10)))
            for _ in range(500)]
    df = spark.createDataFrame(data, "n long, d long").withColumn(
        "m", (F.col("n") / 100).cast("decimal(18,2)")
    )
    exact = lambda x, digits: x.quantize(D(1).scaleb(-digits), ROUND_HALF_UP)
    for n, d, p, a in df.select("n", "d", percent("n", "d"), average("m", "d")).collect():
        with localcontext(prec=60):
            assert p == float(exact(D(n) * 100 / D(d), 2))
            assert a == exact(D(n) / 100 / D(d), 6)


def test_money_percent_is_zero_without_cost(spark):
    df = spark.createDataFrame(
        [(Decimal("50.00"), Decimal("0.00")), (Decimal("-25.50"), Decimal("100.00"))],
        "n decimal(18,2), d decimal(18,2)",
    )
    assert [r[0] for r in df.select(money_percent("n", "d")).collect()] == [0.0, -25.5]


def test_safe_ratio(spark):
    assert one(spark, safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, safe_ratio(F.lit(1), F.lit(4))) == 0.25


def test_money_text_drops_trailing_zeros(spark):
    for value, text in (("100.00", "100"), ("100.50", "100.5"), ("0.00", "0"), ("12.34", "12.34")):
        assert one(spark, money_text(F.lit(Decimal(value)).cast("decimal(18,2)"))) == text


def test_surrogate_key_distinguishes_null_from_empty(spark):
    none, empty = F.lit(None).cast("string"), F.lit("")
    keys = {one(spark, surrogate_key([F.lit("a"), c])) for c in (none, empty, F.lit("b"))}
    assert len(keys) == 3
    expected = one(spark, F.md5(F.lit(f"a-{NULL_KEY_PART}")))
    assert one(spark, surrogate_key([F.lit("a"), none])) == expected


def test_risk_ladder(spark):
    data = [
        ("both", "10", "20", "0", 1),  # rules 1 and 2: the first wins
        ("over", "10", "20", "5", 9),
        ("new", "1000.01", "0", "5", 2),
        ("exact", "1000.00", "0", "5", 2),
        ("old", "2000", "0", "5", 3),
        ("idle", "0", "0", "0", 1),
    ]
    df = spark.createDataFrame(
        [(n, Decimal(d), Decimal(w), Decimal(b), a) for n, d, w, b, a in data],
        "name string, total_deposits decimal(18,2), total_withdrawals decimal(18,2),"
        " total_bets decimal(18,2), active_days long",
    )
    assert dict(rows(df.select("name", risk_class()))) == {
        "both": "HIGH_RISK_NO_BETS",
        "over": "HIGH_RISK_OVER_WITHDRAWAL",
        "new": "MEDIUM_RISK_NEW_HIGH_VALUE",
        "exact": "NORMAL",
        "old": "NORMAL",
        "idle": "NORMAL",
    }


def test_moments_survive_the_trip(spark):
    moment = at("2024-01-07 23:59:59.000123")
    assert moment_of(spark.range(1), F.max(stamp(moment))) == moment
    assert moment_of(spark.range(0), F.max(stamp(moment))) is None
