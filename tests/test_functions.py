from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfscan.functions import dates, numbers, text, variant

# category name and family, as labelled in a sample of real sales and by the rules' traps
FAMILIES = [
    ("IMPORTED SCHNAPPS", "SCHNAPPS"), ("STRAIGHT RYE WHISKIES", "WHISKIES"),
    ("AMERICAN FLAVORED VODKA", "VODKAS"), ("100% AGAVE TEQUILA", "TEQUILAS"),
    ("AMERICAN SCHNAPPS", "SCHNAPPS"), ("GOLD RUM", "RUMS"), ("WHISKEY LIQUEUR", "WHISKIES"),
    ("AMERICAN BRANDIES", "BRANDIES"), ("IMPORTED BRANDY", "OTHER"), ("GINGER BEER", "GINS"),
    ("SPARKLING WINE", "WINES"), ("SPARKLING ROSE", "CHAMPAGNE & SPARKLING"),
    ("TEMPORARY & SPECIALTY PACKAGES", "SPECIALTY SPIRITS"), ("IRISH WHISKIES", "WHISKIES"),
    ("AMERICAN CORDIALS & LIQUEURS", "LIQUEURS"), ("COCKTAILS/RTD", "COCKTAIL MIXERS"),
    ("NEUTRAL GRAIN SPIRITS FLAVORED", "NEUTRAL SPIRITS"), ("DELISTED ITEMS", "OTHER"),
    (None, "OTHER"), ("", "OTHER"),
]


def test_product_family(spark):
    rows = spark.createDataFrame(FAMILIES, "name string, family string")
    wrong = rows.where(text.product_family(F.col("name")) != F.col("family"))
    assert wrong.count() == 0


@pytest.mark.parametrize("given, expected", [
    ("JACK DANIELS", "Jack Daniels"), ("gallo-winery", "Gallo-Winery"),
    ("HY-VEE #2 / coralville", "Hy-Vee #2 / Coralville"), ("o'brien", "O'brien"),
    ("CHAMPAGNE & SPARKLING", "Champagne & Sparkling"), ("a\tb", "A\tB"), ("", ""), (None, None),
    ("x[y]z\\w^v", "X[Y]Z\\W^V"),
])
def test_title_case(spark, given, expected):
    row = spark.createDataFrame([(given,)], "v string").select(text.title_case(F.col("v"))).first()
    assert row[0] == expected


def test_title_case_with_other_breaks(spark):
    frame = spark.createDataFrame([("gallo-winery x.y",)], "v string")
    assert frame.select(text.title_case(F.col("v"), breaks="")).first()[0] == "Gallo-winery X.y"
    assert frame.select(text.title_case(F.col("v"), breaks=".")).first()[0] == "Gallo-winery X.Y"


@pytest.mark.parametrize("amount, expected", [
    (1234567.5, "$1,234,568"), (0.0, "$0"), (-1234.4, "-$1,234"), (999.5, "$1,000"),
    (-0.2, "$0"), (None, None), (123456789012.0, "$123,456,789,012"),
])
def test_dollars(spark, amount, expected):
    row = spark.createDataFrame([(amount,)], "v double").select(text.dollars(F.col("v"))).first()
    assert row[0] == expected


def test_whole_number(spark):
    texts = [("12",), ("12.0",), ("12.5",), ("-2.5",), ("0.4999999",), (None,)]
    frame = spark.createDataFrame(texts, "v string")
    assert [row[0] for row in frame.select(numbers.whole_number(F.col("v"))).collect()] == [
        12, 12, 13, -3, 0, None]


@pytest.mark.parametrize("bad", ["abc", "", "99999999999"])
def test_whole_number_that_does_not_fit(spark, bad):
    frame = spark.createDataFrame([(bad,)], "v string")
    assert frame.select(numbers.whole_number(F.col("v"), strict=False)).first()[0] is None
    with pytest.raises(PySparkException):
        frame.select(numbers.whole_number(F.col("v"))).collect()


def test_totals_do_not_depend_on_order(spark):
    amounts = [(0.1,), (0.2,), (0.3,), (1e12,), (-1e12,)]
    for listed in (amounts, amounts[::-1]):
        frame = spark.createDataFrame(listed, "v double").coalesce(1)
        assert frame.agg(numbers.total(F.col("v"))).first()[0] == 0.6


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(numbers.ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_json_or_scalar(spark):
    texts = ['{"a": 1}', "plain text", "null", " null ", None, "12", '"quoted"']
    frame = spark.createDataFrame([(t,) for t in texts], "v string")
    value = variant.json_or_scalar(F.col("v"))
    assert [row[0] for row in frame.select(F.to_json(value)).collect()] == [
        '{"a":1}', '"plain text"', None, None, None, "12", '"quoted"']


def test_point(spark):
    frame = spark.createDataFrame([(-91.5, 42.25), (None, 1.0)], "x double, y double")
    made = frame.select(variant.point(F.col("x"), F.col("y")).alias("p"))
    rows = made.select(
        F.to_json("p"), variant.longitude_of(F.col("p")), variant.latitude_of(F.col("p"))).collect()
    assert rows[0][0] == '{"coordinates":[-91.5,42.25],"type":"Point"}'
    assert tuple(rows[0])[1:] == (-91.5, 42.25)
    assert tuple(rows[1]) == (None, None, None)


def test_dates():
    assert dates.last_full_month(date(2024, 3, 31)) == (date(2024, 2, 1), date(2024, 2, 29))
    assert dates.last_full_month(date(2024, 1, 1)) == (date(2023, 12, 1), date(2023, 12, 31))
    assert dates.shift_months(date(2024, 1, 31), -1) == date(2023, 12, 1)
    assert dates.shift_months(date(2023, 12, 5), 1) == date(2024, 1, 1)


def test_sums_in_integers_equal_sums_of_decimals(spark):
    """Up to ten decimals, small and large amounts, missing ones, and in any order."""
    import random
    from decimal import Decimal
    from shelfscan.functions.numbers import exact_sum
    rng = random.Random(2)
    texts = [[f"{rng.choice('-+')}{rng.randrange(10 ** rng.choice((1, 3, 5, 6, 9)))}"
              f".{rng.randrange(10 ** d):0{d}}" for d in rng.choices((1, 2, 4, 7), k=50)] + [None]
             for _ in range(20)] + [[None, None]]
    rows = [(n, None if t is None else float(t)) for n, group in enumerate(texts) for t in group]
    frame = spark.createDataFrame(rows, "n int, v double")
    for order in (F.col("v"), F.col("v").desc()):
        found = frame.orderBy(order).groupBy("n").agg(exact_sum(F.col("v")).alias("s"))
        for row in found.collect():
            known = [Decimal(repr(float(t))) for t in texts[row.n] if t is not None]
            assert row.s == (sum(known) if known else None)
    some = frame.agg(exact_sum(F.col("v"), F.col("n") == 3).alias("s")).first().s
    assert some == sum(Decimal(repr(float(t))) for t in texts[3] if t is not None)
