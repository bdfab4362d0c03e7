"""Semantic model: metrics by dimensions over the fact, the calendar and the stores.

A query names metrics, dimensions and filters by their logical names or synonyms and gets a
DataFrame. For totals, the sales lines are summed by the fact-side columns and join keys first
and only the sums are joined with the dimensions, so that a hot store or date is one row by then;
queries for plain lines join the lines themselves. Filters on the calendar and on the sale date
are carried over to the months and days of the fact, so that month folders are pruned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date
import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscan.operators.joins import join_dimension, join_totals
from shelfscan.operators.metrics import METRICS, Metric, add_parts, parts_of, sum_parts
from shelfscan.operators.months import month_predicate
from shelfscan.schemas import KEY

FACT, CALENDAR, STORES = "SALES", "DATE_DIM", "DIM_STORE_LOCATION"


class UnknownName(ValueError):
    pass


class AmbiguousName(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    """A column of the model under its logical name."""

    table: str
    name: str
    kind: str = "dimension"
    column: str = ""
    synonyms: tuple[str, ...] = ()
    currency: bool = False

    @property
    def source(self) -> str:
        return self.column or self.name.lower()

    @property
    def output(self) -> str:
        return self.name.lower()

    @property
    def qualified(self) -> str:
        return f"{self.table}.{self.name}"


@dataclass(frozen=True)
class Relationship:
    table: str
    fact_key: str
    key: str
    how: str


# Logical names of the model's columns, with their synonyms.
FIELDS = [
    *[Field(CALENDAR, name) for name in (
        "DATEKEY", "DAYNUMINMONTH", "DAYNUMINWEEK", "DAYNUMINYEAR", "DAYOFWEEK",
        "DAYOFWEEK_SHORT", "HOLIDAY_NAME_US", "IS_HOLIDAY", "IS_HOLIDAY_US",
        "IS_LAST_DAY_IN_MONTH", "IS_LAST_DAY_IN_WEEK", "IS_WEEKDAY", "ISO_WEEKNUMINYEAR",
        "ISO_YEAR", "MONTH", "MONTHNUMINYEAR", "MONTHYEAR", "YEAR", "YEARMONTHNUM")],
    Field(CALENDAR, "DATE", "time", synonyms=("Sale Date",)),
    Field(STORES, "LATITUDE", synonyms=("Lat",)),
    Field(STORES, "LONGITUDE", synonyms=("Lon", "Long")),
    *[Field(STORES, name) for name in (
        "STORE_CITY", "STORE_COUNTY", "STORE_COUNTY_NUMBER", "STORE_LOCATION", "STORE_NAME",
        "STORE_NUMBER", "STORE_STATE", "STORE_STREET_ADDRESS", "STORE_ZIP")],
    Field(FACT, "BOTTLE_VOLUME_ML"),
    Field(FACT, "CATEGORY"),
    Field(FACT, "CATEGORY_NAME", synonyms=("Category Name", "State Category")),
    Field(FACT, "INVOICE_AND_ITEM_NUMBER"),
    Field(FACT, "ITEM", column="item_description",
          synonyms=("Item Description", "Product", "Product Name")),
    Field(FACT, "ITEM_NUMBER"),
    Field(FACT, "LIQUOR_FAMILY", column="liquor_category",
          synonyms=("Liquor Family", "Liquor Category", "Normalized Category")),
    Field(FACT, "PACK"),
    Field(FACT, "STORE_NUMBER"),
    Field(FACT, "VENDOR_NAME"),
    Field(FACT, "VENDOR_NUMBER"),
    Field(FACT, "SALE_DATE", "time"),
    Field(FACT, "SALE_MONTH", "time", synonyms=("Sale Month",)),
    Field(FACT, "SALE_YEAR", "time", synonyms=("Sale Year",)),
    Field(FACT, "BOTTLES_SOLD", "fact"),
    Field(FACT, "SALE_DOLLARS", "fact", currency=True),
    Field(FACT, "STATE_BOTTLE_COST", "fact", currency=True),
    Field(FACT, "STATE_BOTTLE_RETAIL", "fact", currency=True),
    Field(FACT, "VOLUME_SOLD_GALLONS", "fact"),
    Field(FACT, "VOLUME_SOLD_LITERS", "fact"),
]

# Synonyms of the metrics.
METRIC_SYNONYMS = {
    "TOTAL_SALES": ("Total Sales", "Sales", "Revenue"),
    "TOTAL_BOTTLES_SOLD": ("Total Bottles Sold", "Bottles Sold", "Total Quantity"),
    "TOTAL_VOLUME_LITERS": ("Total Volume Liters", "Volume Sold Liters"),
    "TOTAL_VOLUME_GALLONS": ("Total Volume Gallons", "Volume Sold Gallons"),
}

PRIMARY_KEYS = {CALENDAR: "date", STORES: "store_number", FACT: KEY}

# Sales of a day outside the calendar stay; sales of a store outside the store dimension go.
RELATIONSHIPS = {
    CALENDAR: Relationship(CALENDAR, "sale_date", "date", "left"),
    STORES: Relationship(STORES, "store_number", "store_number", "inner"),
}

COMPARISONS: dict[str, Callable[[Column, Any], Column]] = {
    "=": lambda left, right: left == F.lit(right),
    "!=": lambda left, right: left != F.lit(right),
    "<": lambda left, right: left < F.lit(right),
    "<=": lambda left, right: left <= F.lit(right),
    ">": lambda left, right: left > F.lit(right),
    ">=": lambda left, right: left >= F.lit(right),
    "in": lambda left, right: left.isin(list(right)),
    "between": lambda left, right: left.between(F.lit(right[0]), F.lit(right[1])),
    "like": lambda left, right: left.like(right),
    "is null": lambda left, right: left.isNull() if right else left.isNotNull(),
}

Filter = tuple[str, str, Any]

DAY, MONTHS = "sale_date", ("sale_year", "sale_month")

#: The first and last day that a comparison of the sale date lets pass, None where it is open.
DAY_BOUNDS: dict[str, Callable[[Any], tuple[Any, Any]]] = {
    "=": lambda value: (value, value),
    "<": lambda value: (None, value),
    "<=": lambda value: (None, value),
    ">": lambda value: (value, None),
    ">=": lambda value: (value, None),
    "in": lambda values: (min(values), max(values)),
    "between": lambda pair: (pair[0], pair[1]),
}


@dataclass(frozen=True)
class Test:
    """A comparison of a field or metric with a value."""

    entry: Any
    op: str
    value: Any

    def __post_init__(self):
        if self.op not in COMPARISONS:
            raise ValueError(f"unknown comparison {self.op!r}")

    def on(self, column: Column) -> Column:
        return COMPARISONS[self.op](column, self.value)


def _as_date(value: Any) -> date | None:
    if value is None or isinstance(value, date):
        return value
    return date.fromisoformat(str(value)[:10])


def _month_range(low: date | None, high: date | None) -> Column:
    """Predicate on the partition columns for the months from low to high."""
    number = F.col("sale_year") * 100 + F.col("sale_month")
    test = F.lit(True)
    if low is not None:
        test = test & (number >= low.year * 100 + low.month)
    if high is not None:
        test = test & (number <= high.year * 100 + high.month)
    return test


def _plain(name: str) -> str:
    return re.sub(r"[\s_]+", " ", name).strip().lower()


@dataclass
class SalesModel:
    """The model over concrete relations.

    ``fact`` is a DataFrame, or a function from column names to a DataFrame with at least
    those columns. The dimensions are DataFrames, or functions that make them when a query needs
    them. ``state_name`` adds the synonym "<state> Category" of CATEGORY_NAME.
    """

    fact: DataFrame | Callable[..., DataFrame]
    calendar: DataFrame | Callable[[], DataFrame]
    stores: DataFrame | Callable[[], DataFrame]
    state_name: str | None = None
    fields: list[Field] = field(default_factory=lambda: list(FIELDS))

    # ------------------------------------------------------------ names

    def _synonyms(self, entry: Field | Metric) -> tuple[str, ...]:
        if isinstance(entry, Metric):
            return METRIC_SYNONYMS.get(entry.name, ())
        if self.state_name and entry.name == "CATEGORY_NAME":
            return (*entry.synonyms, f"{self.state_name} Category")
        return entry.synonyms

    def resolve(self, name: str) -> Field | Metric:
        """The field or metric a logical name or synonym stands for, whatever its case.

        A name spelled exactly like a logical name means that one. ``TABLE.NAME`` picks a
        table. Otherwise names and synonyms are compared without regard to underscores,
        and more than one match is an error.
        """
        entries: list[Field | Metric] = [*self.fields, *METRICS.values()]
        if "." in name:
            table, name = name.split(".", 1)
            entries = [entry for entry in self.fields if entry.table == table.strip().upper()]
            if table.strip().upper() == FACT:
                entries += METRICS.values()
        exact = [entry for entry in entries if entry.name == name.strip().upper()]
        if len(exact) == 1:
            return exact[0]
        wanted = _plain(name)
        found = exact or [
            entry for entry in entries
            if wanted in {_plain(entry.name), *map(_plain, self._synonyms(entry))}
        ]
        if not found:
            raise UnknownName(f"no field or metric is called {name!r}")
        if len(found) > 1:
            listed = ", ".join(sorted(
                entry.qualified if isinstance(entry, Field) else f"{FACT}.{entry.name}"
                for entry in found))
            raise AmbiguousName(f"{name!r} may mean any of: {listed}")
        return found[0]

    def column(self, name: str) -> Column:
        """Column of a field, by its physical name."""
        entry = self.resolve(name)
        if isinstance(entry, Metric):
            raise UnknownName(f"{name!r} is a metric, not a column")
        return F.col(entry.source)

    def describe(self) -> list[dict[str, str]]:
        """All fields and metrics with table, kind, source and synonyms."""
        listed = [
            {"table": f.table, "name": f.name, "kind": f.kind, "source": f.source,
             "synonyms": ", ".join(self._synonyms(f))} for f in self.fields]
        listed += [
            {"table": FACT, "name": m.name, "kind": "metric", "source": m.description,
             "synonyms": ", ".join(self._synonyms(m))} for m in METRICS.values()]
        return listed

    # ------------------------------------------------------------ relations

    def _fact(self, columns: Sequence[str]) -> DataFrame:
        wanted = sorted(set(columns))
        rows = self.fact(*wanted) if callable(self.fact) else self.fact
        return rows.select(*wanted)

    def _relation(self, table: str) -> DataFrame:
        rows = self.calendar if table == CALENDAR else self.stores
        return rows() if callable(rows) else rows

    def _dimension(self, table: str, fields: Sequence[Field]) -> DataFrame:
        """The key and the needed fields of a dimension, under unambiguous names."""
        rows = self._relation(table)
        return rows.select(
            F.col(RELATIONSHIPS[table].key).alias("_dim_key"),
            *[_groupable(rows, f.source).alias(_alias(f)) for f in fields])

    # ------------------------------------------------------------ queries

    def query(
        self,
        metrics: Sequence[str] = (),
        dimensions: Sequence[str] = (),
        where: Sequence[Filter] = (),
        order_by: Sequence[str] = (),
        limit: int | None = None,
        rounded: bool = True,
    ) -> DataFrame:
        """Metrics by dimensions, or plain lines when no metric is asked for.

        ``where`` holds (name, comparison, value) triples; one on a metric applies to the
        groups. ``order_by`` takes names, with a leading ``-`` for descending. With
        ``rounded``, currency has no decimals in totals and two in lines.
        """
        measures = [self._metric(name) for name in metrics]
        groups = [self._field(name) for name in dimensions]
        tests = [Test(self.resolve(name), op.lower(), value) for name, op, value in where]
        line_tests = [test for test in tests if isinstance(test.entry, Field)]
        group_tests = [test for test in tests if isinstance(test.entry, Metric)]
        if group_tests and not measures:
            raise ValueError("a filter on a metric needs a query with metrics")
        used = list(dict.fromkeys([*groups, *[test.entry for test in line_tests]]))
        if measures:
            result = self._totals(measures, groups, used, line_tests, group_tests, rounded)
        else:
            result = self._lines(groups, used, line_tests, rounded)
        if order_by:
            result = result.orderBy(*[self._order(name, result.columns) for name in order_by])
        return result if limit is None else result.limit(limit)

    def _metric(self, name: str) -> Metric:
        entry = self.resolve(name)
        if not isinstance(entry, Metric):
            raise UnknownName(f"{name!r} is a field, not a metric")
        return entry

    def _field(self, name: str) -> Field:
        entry = self.resolve(name)
        if not isinstance(entry, Field):
            raise UnknownName(f"{name!r} is a metric, not a dimension")
        return entry

    def _order(self, name: str, columns: Sequence[str]) -> Column:
        entry = self.resolve(name.lstrip("-"))
        output = entry.name.lower()
        if output not in columns:
            raise UnknownName(f"{name!r} is not in the result")
        column = F.col(output)
        # the warehouse puts unknown values first when descending, last when ascending
        return column.desc_nulls_first() if name.startswith("-") else column.asc_nulls_last()

    def _lines_of(self, columns: Sequence[str], tests: Sequence[Test]) -> DataFrame:
        """Fact lines with the given columns that pass the tests on the fact.

        Tests on the calendar or the sale date also bound the days and months that are read.
        """
        own = [test for test in tests if test.entry.table == FACT]
        days = [test for test in own if test.entry.source == DAY and test.op in DAY_BOUNDS]
        # a line without a day in the calendar only passes a test for NULL
        dated = [test for test in tests if test.entry.table == CALENDAR]
        if any(test.op == "is null" and test.value for test in dated):
            dated = []
        known = set(MONTHS) if callable(self.fact) else set(MONTHS) & set(self.fact.columns)
        rows = self._fact([*columns, *([DAY, *known] if days or dated else [])])
        for test in own:
            rows = rows.where(test.on(F.col(test.entry.source)))
        for test in days:
            low, high = DAY_BOUNDS[test.op](test.value)
            if len(known) == len(MONTHS):
                rows = rows.where(_month_range(_as_date(low), _as_date(high)))
        if dated:
            rows = self._in_calendar(rows, dated, len(known) == len(MONTHS))
        return rows.select(*dict.fromkeys(columns))

    def _in_calendar(self, rows: DataFrame, tests: Sequence[Test], by_month: bool) -> DataFrame:
        """Lines of the months in which some day passes the tests on the calendar.

        One job on the calendar brings at most its months to the driver, as literals.
        """
        days = self._relation(CALENDAR)
        for test in tests:
            days = days.where(test.on(F.col(test.entry.source)))
        key = F.col(RELATIONSHIPS[CALENDAR].key)
        months = days.groupBy(F.year(key).alias("y"), F.month(key).alias("m")).agg(
            F.min(key).alias("low"), F.max(key).alias("high")).collect()
        if not months:
            return rows.where(F.lit(False))
        rows = rows.where(F.col(DAY).between(
            F.lit(min(row.low for row in months)), F.lit(max(row.high for row in months))))
        return rows.where(month_predicate([(row.y, row.m) for row in months])) if by_month else rows

    def _totals(self, measures, groups, used, line_tests, group_tests, rounded) -> DataFrame:
        measured = [*measures, *[test.entry for test in group_tests]]
        parts = parts_of(measured)
        tables = [table for table in RELATIONSHIPS if any(f.table == table for f in used)]
        fact_groups = [f.source for f in groups if f.table == FACT]
        keys = [RELATIONSHIPS[table].fact_key for table in tables]
        rows = self._lines_of([
            *[f.source for f in used if f.table == FACT], *keys,
            *[column for metric in measured for column in metric.columns()]], line_tests)
        totals = sum_parts(rows, parts, *dict.fromkeys([*fact_groups, *keys]))
        for table in tables:
            relation = RELATIONSHIPS[table]
            dimension = self._dimension(table, [f for f in used if f.table == table])
            totals = join_totals(totals, dimension, relation.fact_key, "_dim_key", relation.how)
        for test in line_tests:
            if test.entry.table != FACT:
                totals = totals.where(test.on(F.col(_alias(test.entry))))
        names = [(f.source if f.table == FACT else _alias(f), f.output) for f in groups]
        if tables:
            totals = add_parts(totals, parts, *[name for name, _ in names])
        for test in group_tests:
            totals = totals.where(test.on(test.entry.value()))
        return totals.select(
            *[F.col(name).alias(output) for name, output in names],
            *[_shown(m.value(), m.currency and rounded, 0).alias(m.name.lower()) for m in measures])

    def _lines(self, groups, used, line_tests, rounded) -> DataFrame:
        tables = [table for table in RELATIONSHIPS if any(f.table == table for f in used)]
        keys = [RELATIONSHIPS[table].fact_key for table in tables]
        rows = self._lines_of(
            [*[f.source for f in used if f.table == FACT], *keys], line_tests)
        for table in tables:
            relation = RELATIONSHIPS[table]
            dimension = self._dimension(table, [f for f in used if f.table == table])
            rows = join_dimension(rows, dimension, relation.fact_key, "_dim_key", relation.how)
        for test in line_tests:
            if test.entry.table != FACT:
                rows = rows.where(test.on(F.col(_alias(test.entry))))
        return rows.select(*[
            _shown(F.col(f.source if f.table == FACT else _alias(f)), f.currency and rounded, 2)
            .alias(f.output) for f in groups])

    # ------------------------------------------------------------ checks

    def problems(self) -> list[str]:
        """What is wrong with the model's names and columns; needs no job."""
        found = []
        relations = {table: self._relation(table) for table in (CALENDAR, STORES)}
        if not callable(self.fact):
            relations[FACT] = self.fact
        for table, rows in relations.items():
            missing = {f.source for f in self.fields if f.table == table} - set(rows.columns)
            found += [f"{table} has no column {name}" for name in sorted(missing)]
            if PRIMARY_KEYS[table] not in rows.columns:
                found.append(f"{table} has no key column {PRIMARY_KEYS[table]}")
        names = [f.qualified for f in self.fields] + [f"{FACT}.{name}" for name in METRICS]
        found += [f"{name} is defined twice" for name in sorted({n for n in names if names.count(n) > 1})]
        return found

    def key_report(self) -> DataFrame:
        """Per table: rows, rows without a key, and keys that occur more than once.

        A repeated key in a dimension would multiply sales in its join.
        """
        reports = [
            key_counts(rows, PRIMARY_KEYS[table], table) for table, rows in (
                (CALENDAR, self._relation(CALENDAR)), (STORES, self._relation(STORES)),
                (FACT, self._fact([PRIMARY_KEYS[FACT]])))
        ]
        return reports[0].unionByName(reports[1]).unionByName(reports[2])

    def validate(self) -> None:
        """Raise when columns are missing or a dimension's key is not unique."""
        found = self.problems()
        if not found:
            for row in self.key_report().collect():
                if row["table"] != FACT and row.duplicate_keys:
                    found.append(f"{row.table} has {row.duplicate_keys} repeated keys")
        if found:
            raise ValueError("; ".join(found))


def key_counts(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Rows, missing keys and repeated keys of one relation."""
    counted = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.agg(
        F.lit(label).alias("table"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1)).alias("duplicate_keys"))


def _alias(entry: Field) -> str:
    return f"_{entry.table}_{entry.name}".lower()


def _groupable(rows: DataFrame, name: str) -> Column:
    """A variant column cannot be grouped; its JSON text can."""
    kind = rows.schema[name].dataType
    return F.to_json(F.col(name)) if isinstance(kind, T.VariantType) else F.col(name)


def _shown(value: Column, rounding: bool, decimals: int) -> Column:
    return F.round(value, decimals) if rounding else value
