from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfscan.operators import keyed
from shelfscan.plans import questions
from shelfscan.plans.loads import Store
from shelfscan.plans.mart import Mart
from shelfscan.sources.testdata import sales


@pytest.fixture(scope="module")
def mart(spark, sf_dir, tmp_path_factory):
    store = Store(str(tmp_path_factory.mktemp("mart")))
    store.sales(spark).upsert(keyed.dedup_by_key(sales(spark, sf_dir)))
    return Mart(spark, store)


def folders_read(plan_text):
    return [line for line in plan_text.split("\n") if "PartitionFilters" in line]


def test_reports_prune_months(mart, plan):
    for report in (
        mart.ttm_sales_by_category(), mart.ttm_top_items(5), mart.ttm_sales(),
        mart.monthly_sales(as_of=date(2001, 8, 15)), mart.daily_trend(visible_start=date(2001, 1, 1)),
        questions.month_yoy(mart.sales(), anchor=mart.newest_date()),
        questions.quarter_margin(mart.sales(), anchor=mart.newest_date()),
    ):
        filters = folders_read(plan(report))
        assert filters and all("sale_year" in line and "sale_month" in line for line in filters)
        assert report.count() > 0


def test_saved_dimensions_are_used(mart, plan):
    built = mart.stores().drop("store_location").collect()
    mart.save_dimensions()
    assert sorted(mart.stores().drop("store_location").collect()) == sorted(built)
    assert "WindowGroupLimit" not in plan(mart.stores())
    totals = mart.model().query(metrics=["Revenue"], dimensions=["YEAR"], order_by=["YEAR"]).collect()
    assert [row.year for row in totals] == sorted(row.year for row in totals)
    mart.model().validate()


def test_views_for_sql(spark, mart):
    mart.create_views()
    text = """SELECT d.year, count(*) AS rows FROM sales s JOIN date_dim d ON s.sale_date = d.date
              JOIN dim_store_location_v v USING (store_number) GROUP BY 1"""
    located = mart.sales().where(F.col("store_location").isNotNull()).count()
    assert spark.sql(text).agg(F.sum("rows")).first()[0] == located


@pytest.mark.parametrize("where, kept", [
    ([("YEAR", "=", 2000)], "sale_year = 2000"),
    ([("MONTHYEAR", "in", ["Feb1998", "Mar2001"])],
     "date_format(sale_date, 'MMMyyyy') IN ('Feb1998', 'Mar2001')"),
    ([("Sales.SALE_DATE", "between", (date(1999, 5, 20), date(1999, 7, 2)))],
     "sale_date BETWEEN '1999-05-20' AND '1999-07-02'"),
    ([("Sales.SALE_DATE", ">=", "2001-06-15"), ("DAYOFWEEK", "=", "Monday")],
     "sale_date >= '2001-06-15' AND dayofweek(sale_date) = 2"),
    ([("YEAR", "=", 1066)], "false"),
    ([("YEAR", "is null", True)], "sale_date IS NULL"),
])
def test_questions_with_dates_prune_months(mart, plan, where, kept):
    """Filters on the calendar and on the day reach the month folders, in totals and in lines."""
    expected = mart.sales().where(kept)
    model = mart.model()
    totals = model.query(metrics=["TOTAL_BOTTLES_SOLD"], where=where)
    lines = model.query(dimensions=["INVOICE_AND_ITEM_NUMBER", "BOTTLES_SOLD"], where=where)
    assert totals.first()[0] == expected.agg(F.sum("bottles_sold")).first()[0]
    assert sorted(map(tuple, lines.collect())) == sorted(
        map(tuple, expected.select("invoice_and_item_number", "bottles_sold").collect()))
    for query in (totals, lines):
        filters = [line for line in folders_read(plan(query)) if "/data/v=" in line or "sale_" in line]
        if where[0][2] not in (1066, True):
            assert any("sale_year" in line and "sale_month" in line for line in filters)


def test_questions_on_the_stored_table(mart, plan):
    for name, question in questions.QUESTIONS.items():
        found = mart.question(name)
        assert "sale_year" in plan(found).split("PartitionFilters")[1][:200]
        assert sorted(map(str, found.collect())) == sorted(map(str, question(mart.sales()).collect()))
    with pytest.raises(ValueError, match="month_yoy"):
        mart.question("no such")
