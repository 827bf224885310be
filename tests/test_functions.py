import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates, money, nulls, text


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_conditions_with_missing_values(spark):
    missing = F.lit(None).cast("boolean")
    r = one(
        spark,
        a=nulls.if_else(missing, "x", "y"),
        b=nulls.case_when([(missing, "x")], "y"),
        c=nulls.is_in(F.lit(None).cast("string"), ["x"]),
        d=~nulls.is_in(F.lit(None).cast("string"), ["x"]),
        e=nulls.is_in(F.lit(None).cast("string"), ["x", None]),
        f=nulls.ratio(F.lit(1.0), F.lit(0.0)),
        g=nulls.half_even(F.lit(2.5)),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == (None, "y", False, True, True, None, 2.0)


def test_strict_aggregate(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    got = {r.k: r.s for r in df.groupBy("k").agg(nulls.strict(F.sum("v"), F.col("v")).alias("s")).collect()}
    assert got == {"a": None, "b": 2}


def test_text(spark):
    r = one(
        spark,
        a=text.replace_first(F.lit("Label'"), "'", ""),
        b=text.replace_first(F.lit("a'b'c"), "'", "-"),
        c=text.replace_first(F.lit("none"), "'", ""),
        d=text.piece(F.lit("1 'Low'"), " '", 0),
        e=text.piece(F.lit("alone"), " '", 1),
        f=text.piece(F.lit("a/b/model_7"), "/", -1),
        g=text.first_match(F.lit("GBM_1_AutoML"), "[^_]+"),
        h=text.first_match(F.lit("___"), "[^_]+"),
        i=text.join_text(F.lit("a"), F.lit(None).cast("string"), sep=": "),
        j=text.join_text(F.lit("a"), F.lit("b"), sep=": "),
        k=text.template("Customer: {who}!", who=F.lit("x")),
        l=text.matches(F.lit("Shimano Deore XT rear"), "shimano deore(?! xt)"),
        m=text.matches(F.lit("Shimano Deore M6000"), "shimano deore(?! xt)"),
        n=text.matches(F.lit(None).cast("string"), "x"),
        o=text.replace_first(F.lit(None).cast("string"), "'", ""),
    )
    assert tuple(r) == (
        "Label", "a-b'c", "none", "1", None, "model_7", "GBM", None, None, "a: b", "Customer: x!", 0.0, 1.0, 0.0, None
    )


def test_turnover_cost(spark):
    r = one(spark, a=money.turnover_cost(), b=money.turnover_cost(200), c=money.turnover_cost(1, salary=0))
    assert r.a == pytest.approx(78483.33, abs=0.005)
    assert r.b == pytest.approx(15696666.67, abs=0.005)
    assert r.c == pytest.approx(91816.67, abs=0.005)
    with pytest.raises(TypeError):
        money.turnover_cost(1, wage=3)


def test_money(spark):
    r = one(
        spark, a=money.money(F.lit(1234.5)), b=money.money(F.lit(-2500000), 1, "M"), c=money.money(F.lit(999.994), 2),
        d=money.money(F.lit(None).cast("double")), e=money.money(F.lit(12.0), prefix="", suffix=" €"),
    )
    assert tuple(r) == ("$1,234", "-$2.5M", "$999.99", None, "12 €")


def test_holidays(spark):
    wanted = {
        "2024-01-01": {"NewYearsDay"},
        "2024-01-15": {"MLKingsBirthday"},
        "2021-01-20": {"InaugurationDay"},
        "2024-03-29": {"GoodFriday"},
        "2025-04-18": {"GoodFriday"},
        "2038-04-23": {"GoodFriday"},
        "2024-05-27": {"MemorialDay"},
        "2024-11-05": {"ElectionDay"},
        "2022-11-08": {"ElectionDay"},
        "2022-11-01": set(),
        "2024-11-28": {"ThanksgivingDay"},
        "2024-07-05": set(),
    }
    df = spark.createDataFrame([(d,) for d in wanted], "d string").withColumn("day", F.col("d").cast("date"))
    flags = dates.holiday_flags(F.col("day"))
    for r in df.select("d", *[c.alias(n) for n, c in flags.items()]).collect():
        assert {n for n in flags if r[n]} == wanted[r["d"]], r["d"]
    assert one(spark, w=dates.weekday_label(F.lit("2024-02-29").cast("date")), m=dates.month_label(F.lit("2024-02-29").cast("date"))) == ("Thu", "Feb")
