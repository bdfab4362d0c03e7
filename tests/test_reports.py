from datetime import date

from pyspark.sql import functions as F
import pytest

from shelfscan.functions.numbers import total
from shelfscan.operators import filters, joins, rolling
from shelfscan.functions.numbers import total
from shelfscan.plans import calendar, reports, stores
from shelfscan.schemas import CALENDAR
from shelfscan.sources.testdata import CORRECTIONS, sales


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return sales(spark, sf_dir, "sale_date", "sale_dollars", "liquor_category", "item_description").persist()


def daily(spark, *rows):
    return spark.createDataFrame(list(rows), "sale_date date, sale_dollars double")


def test_trailing_year_is_twelve_months(lines):
    kept = filters.trailing_year(lines)
    months = kept.select(F.trunc("sale_date", "MM")).distinct().count()
    assert months == 12
    by_month = kept.groupBy(F.trunc("sale_date", "MM")).agg(total(F.col("sale_dollars")).alias("t"))
    assert by_month.agg(total(F.col("t"))).first() == kept.agg(total(F.col("sale_dollars"))).first()
    late = filters.trailing_year_late(lines)
    assert kept.exceptAll(late).count() == 0 and late.exceptAll(kept).count() == 0


def test_families_add_up_to_the_total(lines):
    everything = filters.trailing_year(lines).agg(total(F.col("sale_dollars"))).first()[0]
    text = reports.ttm_sales(lines).first().ttm_sales
    assert text == f"${round(everything):,}"
    families = reports.ttm_sales_by_category(lines).agg(F.sum("ttm_sales")).first()[0]
    assert abs(families - everything) <= 0.5 * 20


def test_title_case_merges_item_groups(lines):
    items = reports.ttm_top_items(lines)
    raw = filters.trailing_year(lines).select("item_description").distinct().count()
    assert items.count() < raw
    assert reports.ttm_top_items(lines, n=3).count() == 3


def test_literal_bounds_reach_the_scan(lines, spark, sf_dir, plan):
    text = plan(reports.ttm_sales_by_category(
        sales(spark, sf_dir, "sale_date", "sale_dollars", "liquor_category")))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "NestedLoop" not in text
    read = [line for line in text.split("\n") if "ReadSchema" in line]
    assert any("l_extendedprice" in line and "l_quantity" not in line for line in read)


def test_empty_sales(spark):
    empty = daily(spark).withColumn("liquor_category", F.lit("x"))
    assert reports.ttm_sales(empty).collect() == [(None,)]
    assert reports.ttm_sales_by_category(empty).count() == 0
    assert reports.daily_trend(empty).count() == 0
    assert reports.monthly_sales(empty, as_of=date(2024, 1, 1)).count() == 0


def test_moving_average_forms_agree(lines):
    totals = reports.daily_totals(lines)
    frame = rolling.rolling_mean_days(totals, "sale_dollars", "sale_date", 28, "mean")
    joined = rolling.rolling_mean_days_joined(totals, "sale_dollars", "sale_date", 28, "mean")
    assert frame.count() == joined.count()
    assert frame.select("sale_date", "mean").exceptAll(joined.select("sale_date", "mean")).count() == 0


def test_moving_average_divides_by_days_present(spark):
    rows = daily(spark, (date(2024, 1, 1), 10.0), (date(2024, 1, 3), 20.0), (date(2024, 1, 10), 6.0))
    means = rolling.rolling_mean_days(rows, "sale_dollars", "sale_date", 3, "mean")
    assert [row.mean for row in means.orderBy("sale_date").collect()] == [10.0, 15.0, 6.0]


def test_daily_trend_scans_before_the_visible_range(spark):
    rows = daily(spark, *[(date(2024, 1, day), float(day)) for day in range(1, 31)])
    trend = reports.daily_trend(rows, visible_start=date(2024, 1, 11), window_days=5).collect()
    assert len(trend) == 20 and trend[0].moving_avg == 9.0
    assert trend[0].trend_line == 9.0 and trend[-1].trend_line == 28.0


def test_monthly_sales_window(spark):
    rows = daily(spark, *[(date(2020 + m // 12, m % 12 + 1, 15), 100.0 + m) for m in range(48)])
    report = reports.monthly_sales(rows, as_of=date(2023, 12, 31)).collect()
    assert len(report) == 37 and report[0].sale_date == date(2020, 12, 1)
    assert report[0].ttm_avg_sales == 106.0  # 105.5, the mean of 100 to 111, rounded up
    labelled = reports.with_labels(reports.monthly_sales(rows, as_of=date(2023, 12, 31)))
    assert labelled.columns == ["Sale Month", "Monthly Sales", "TTM Avg Sales"]


def test_averages_over_months_and_days_without_sales(spark):
    from shelfscan.operators import rolling
    rows = spark.createDataFrame(
        [(date(2023, 1, 5), 120.0), (date(2023, 4, 7), 60.0), (date(2023, 4, 9), 30.0)],
        "sale_date date, sale_dollars double")
    sparse, filled = ([(r.sale_date.month, r.monthly_sales, r.ttm_avg_sales) for r in reports.monthly_sales(
        rows, as_of=date(2023, 5, 1), fill=fill).collect()] for fill in (False, True))
    assert sparse == [(1, 120, 120), (4, 90, 105)]
    assert filled == [(1, 120, 120), (2, 0, 60), (3, 0, 40), (4, 90, 53)]
    days = reports.daily_trend(rows, visible_start=date(2023, 4, 1), window_days=3, fill=True).collect()
    assert [(r.sale_date.day, r.moving_avg) for r in days] == [(7, 60), (8, 30), (9, 30)]
    empty = rows.limit(0).withColumnRenamed("sale_dollars", "v")
    assert rolling.dense(empty, "sale_date", "DAY", "v").count() == 0


def test_joins_of_any_size_agree(spark):
    # one store holds a third of the lines; a store is missing from the dimension
    fact = spark.range(0, 6000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("store"))
    dimension = spark.range(40).select(F.col("id").cast("int").alias("number"), F.lit("city").alias("city"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    for how in ("inner", "left"):
        found = {}
        for size in (before, "-1"):  # broadcast, then shuffled
            spark.conf.set(threshold, size)
            joined = joins.join_dimension(fact, dimension, "store", "number", how)
            assert joined.columns == ["id", "store", "city"]
            found[size] = sorted(map(tuple, joined.collect()))
        spark.conf.set(threshold, before)
        assert found[before] == found["-1"]
    assert joins.join_dimension(fact, dimension, "store", "number", "left").count() == 6000


def store_lines(spark, *rows):
    frame = spark.createDataFrame(
        list(rows), "store_number int, store_name string, sale_date date, location string, key string")
    nothing = {name: F.lit(None).cast("string").alias(name)
               for name in ("address", "city", "zip_code", "county")}
    return frame.select(
        "store_number", "store_name", "sale_date", F.col("key").alias("invoice_and_item_number"),
        F.lit(None).cast("int").alias("county_number"),
        F.try_parse_json("location").alias("store_location"), *nothing.values())


POINT = '{"type": "Point", "coordinates": [-91.0, 42.0]}'


def test_store_dimension(spark):
    rows = store_lines(
        spark,
        (1, "old", date(2024, 1, 1), POINT, "a"), (1, "new", date(2024, 2, 1), POINT, "b"),
        (2, "located", date(2024, 1, 1), POINT, "c"), (2, "newer", date(2024, 3, 1), None, "d"),
        (3, "nowhere", date(2024, 1, 1), None, "e"),
        (10505, "moved", date(2024, 1, 1), POINT, "f"), (10129, "fixed", date(2024, 1, 1), None, "g"),
        (4, "undated", None, POINT, "h"), (4, "dated", date(2024, 1, 1), POINT, "i"),
        (5, "tie b", date(2024, 1, 1), POINT, "k"), (5, "tie a", date(2024, 1, 1), POINT, "j"))
    found = {row.store_number: row for row in stores.store_locations(rows).collect()}
    assert {n: found[n].store_name for n in (1, 2, 4, 5)} == {
        1: "new", 2: "located", 4: "undated", 5: "tie a"}
    assert 3 not in found and 10129 not in found
    assert found[10505].corrected_tf and (found[10505].longitude, found[10505].latitude) == (-95.14875, 43.18232)
    assert not found[1].corrected_tf and found[1].longitude == -91.0
    everyone = {row.store_number: row for row in stores.store_locations(rows, keep_unlocated=True).collect()}
    assert everyone[3].longitude is None and everyone[10129].latitude == 42.2899905


def test_hot_store_is_cut_before_the_shuffle(spark, sf_dir, plan):
    latest = stores.latest_per_store(sales(spark, sf_dir, *stores.SOURCE_COLUMNS))
    text = plan(latest, "simple")
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


@pytest.mark.parametrize("day, name", [
    (date(2012, 1, 1), "New Year's Day"), (date(2012, 1, 2), "New Year's Day (observed)"),
    (date(2021, 12, 31), "New Year's Day (observed)"), (date(2024, 1, 15), "Martin Luther King Jr. Day"),
    (date(2024, 2, 19), "Washington's Birthday"), (date(2024, 5, 27), "Memorial Day"),
    (date(2024, 6, 19), "Juneteenth National Independence Day"), (date(2019, 6, 19), None),
    (date(2020, 7, 3), "Independence Day (observed)"), (date(2024, 9, 2), "Labor Day"),
    (date(2024, 10, 14), "Columbus Day"), (date(2023, 11, 10), "Veterans Day (observed)"),
    (date(2024, 11, 28), "Thanksgiving Day"), (date(2024, 12, 25), "Christmas Day"),
    (date(2024, 12, 24), None),
])
def test_holidays(spark, day, name):
    row = calendar.build_calendar(spark, day, day).first()
    assert row.holiday_name_us == name and row.is_holiday == row.is_holiday_us == (name is not None)


def test_calendar_columns(spark):
    built = calendar.build_calendar(spark, date(2011, 12, 31), date(2012, 3, 1))
    assert built.schema.fieldNames() == CALENDAR.fieldNames()
    assert [f.dataType for f in built.schema.fields] == [f.dataType for f in CALENDAR.fields]
    assert built.count() == 62
    row = built.where("date = DATE'2012-01-01'").first()
    assert (row.datekey, row.dayofweek, row.dayofweek_short, row.month, row.monthyear) == (
        20120101, "Sunday", "Sun", "January", "Jan2012")
    assert (row.iso_year, row.iso_weeknuminyear, row.daynuminweek, row.is_weekday) == (2011, 52, 1, False)
    leap = built.where("date = DATE'2012-02-29'").first()
    assert leap.is_last_day_in_month and leap.daynuminyear == 60
    assert built.where("is_last_day_in_week").select(F.min("dayofweek"), F.max("dayofweek")).first() == (
        "Saturday", "Saturday")


def test_store_corrections_may_be_a_relation(spark):
    schema = "store int, longitude double, latitude double"
    listed = stores.corrections_frame(spark, CORRECTIONS * 4000)
    assert listed.count() == len(CORRECTIONS) * 4000
    given = stores.corrections_frame(spark, spark.createDataFrame(CORRECTIONS, schema))
    assert given.columns == listed.columns and given.count() == len(CORRECTIONS)


def test_sums_keep_small_amounts_and_show_nan(spark):
    small = spark.range(100_000).select(F.lit(0.00004).alias("x"))
    assert small.agg(total(F.col("x"))).first()[0] == 4.0
    bad = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    with pytest.raises(Exception, match="NaN"):
        bad.agg(total(F.col("x"))).collect()
