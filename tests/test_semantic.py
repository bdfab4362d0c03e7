from datetime import date

from pyspark.sql import functions as F
import pytest

from shelfscan.plans import calendar, stores
from shelfscan.plans.semantic import AmbiguousName, SalesModel, UnknownName
from shelfscan.plans.verified import VERIFIED, ask
from shelfscan.sources.testdata import CORRECTIONS, sales


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return sales(spark, sf_dir).persist()


@pytest.fixture(scope="module")
def model(lines):
    return SalesModel(
        fact=lines, calendar=calendar.calendar_of(lines),
        stores=stores.store_locations(lines, CORRECTIONS), state_name="Utah")


@pytest.mark.parametrize("name, meant", [
    ("Revenue", "TOTAL_SALES"), ("total sales", "TOTAL_SALES"), ("item", "ITEM"),
    ("Product Name", "ITEM"), ("liquor_family", "LIQUOR_FAMILY"),
    ("Liquor Category", "LIQUOR_FAMILY"), ("utah category", "CATEGORY_NAME"),
    ("SALE_DATE", "SALE_DATE"), ("bottles_sold", "BOTTLES_SOLD"),
    ("Sales.STORE_NUMBER", "STORE_NUMBER"), ("lat", "LATITUDE"), ("Total Quantity", "TOTAL_BOTTLES_SOLD"),
])
def test_names_resolve(model, name, meant):
    assert model.resolve(name).name == meant


@pytest.mark.parametrize("name", [
    "Bottles Sold", "Sale Date", "STORE_NUMBER", "store number", "Volume Sold Liters"])
def test_ambiguous_names_are_errors(model, name):
    with pytest.raises(AmbiguousName, match="may mean"):
        model.resolve(name)


def test_unknown_names_are_errors(model):
    with pytest.raises(UnknownName):
        model.resolve("profit")
    with pytest.raises(UnknownName):
        model.query(metrics=["ITEM"])
    with pytest.raises(UnknownName):
        model.query(dimensions=["Revenue"])


def test_columns_behind_names(spark, model, lines):
    assert model.resolve("ITEM").source == "item_description"
    assert lines.select(model.column("LIQUOR_FAMILY")).columns == ["liquor_category"]


def test_only_needed_dimensions_are_joined(model, lines, plan):
    text = plan(model.query(metrics=["Revenue"], dimensions=["LIQUOR_FAMILY"]), "simple")
    # no more joins than the lines themselves were made with
    assert text.count("Join") == plan(lines, "simple").count("Join")


def test_facts_are_summed_before_the_join(model, plan):
    text = plan(model.query(metrics=["Revenue"], dimensions=["STORE_CITY", "YEAR"]), "simple")
    assert text.index("Join") < text.rindex("partial_sum")
    assert "BroadcastNestedLoop" not in text and "Cartesian" not in text


def test_store_join_drops_unlocated_stores(model, lines):
    whole = model.query(metrics=["TOTAL_BOTTLES_SOLD"]).first()[0]
    by_store = model.query(metrics=["TOTAL_BOTTLES_SOLD"], dimensions=["STORE_STATE"]).collect()
    located = lines.where("store_location IS NOT NULL").agg(F.sum("bottles_sold")).first()[0]
    assert [tuple(row) for row in by_store] == [("IA", located)]
    assert located < whole


def test_lines_and_totals_agree(model):
    listed = model.query(dimensions=["STORE_CITY", "SALE_DOLLARS"], rounded=False)
    summed = {row.store_city: row[1] for row in listed.groupBy("store_city").agg(
        F.sum(F.col("sale_dollars").cast("decimal(18,4)")).cast("double")).collect()}
    totals = model.query(metrics=["TOTAL_SALES"], dimensions=["STORE_CITY"], rounded=False)
    assert {row.store_city: row.total_sales for row in totals.collect()} == summed


def test_filters_order_and_limit(model):
    result = model.query(
        metrics=["Revenue", "AVG_PRICE_PER_BOTTLE"], dimensions=["ITEM"],
        where=[("YEAR", "=", 2000), ("Revenue", ">", 0), ("DAYOFWEEK", "in", ["Monday", "Friday"])],
        order_by=["-Revenue", "ITEM"], limit=5).collect()
    assert len(result) == 5
    values = [row.total_sales for row in result]
    assert values == sorted(values, reverse=True) and all(v == round(v) for v in values)


def test_grouping_by_a_location(model):
    rows = model.query(metrics=["Revenue"], dimensions=["STORE_LOCATION"]).collect()
    assert rows and all(row.store_location.startswith("{") for row in rows)


def test_validation(spark, model, lines):
    model.validate()
    twice = SalesModel(lines, model.calendar, model.stores.unionByName(model.stores))
    with pytest.raises(ValueError, match="repeated keys"):
        twice.validate()
    short = SalesModel(lines.drop("pack"), model.calendar, model.stores)
    assert short.problems() == ["SALES has no column pack"]
    with pytest.raises(ValueError, match="no column pack"):
        short.validate()


def test_description(model):
    listed = model.describe()
    assert {"table": "SALES", "name": "ITEM", "kind": "dimension", "source": "item_description",
            "synonyms": "Item Description, Product, Product Name"} in listed
    assert sum(entry["kind"] == "metric" for entry in listed) == 8
    assert len(listed) == 8 + 20 + 11 + 20


def test_verified_questions(lines):
    for query in VERIFIED:
        options = {"as_of": date(2001, 8, 15)} if "MONTHLY" in query.name else {}
        assert ask(lines, query.question.lower(), **options).count() > 0
    with pytest.raises(ValueError):
        ask(lines, "What is love?")


def test_null_cost_leaves_margin_but_not_sales(spark):
    from shelfscan.operators.metrics import measure
    rows = spark.createDataFrame(
        [("x", 10.0, 2.0, 2), ("x", 5.0, None, 1), ("y", 1.0, 1.0, 0)],
        "k string, sale_dollars double, state_bottle_cost double, bottles_sold int")
    found = {row.k: row for row in measure(
        rows, ["TOTAL_SALES", "GROSS_MARGIN_DOLLARS", "GROSS_MARGIN_RATE", "AVG_PRICE_PER_BOTTLE"],
        "k").collect()}
    assert found["x"].total_sales == 15.0 and found["x"].gross_margin_dollars == 6.0
    assert found["x"].gross_margin_rate == 6.0 / 15.0
    assert found["y"].avg_price_per_bottle is None
