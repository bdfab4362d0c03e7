"""The loaded layers of one dataset as relations, reports and a semantic model.

What a report needs to know beforehand (newest date, span of the calendar) comes from the
snapshot list and the newest month instead of a scan of all sales.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shelfscan.plans import reports
from shelfscan.plans.calendar import build_calendar
from shelfscan.plans.loads import Store
from shelfscan.plans.questions import QUESTIONS
from shelfscan.plans.semantic import SalesModel
from shelfscan.plans.stores import store_locations
from shelfscan.plans.verified import ask, takes_anchor
from shelfscan.schemas import CALENDAR, STORES
from shelfscan.session import empty_frame, path_exists


class Mart:
    def __init__(self, spark: SparkSession, store: Store):
        self.spark = spark
        self.store = store
        self.table = store.sales(spark)

    def sales(self) -> DataFrame:
        return self.table.read()

    def newest_date(self) -> date | None:
        return self.table.last_date()

    # ------------------------------------------------------------ dimensions

    def _saved(self, name: str) -> str:
        return f"{self.store.root}/{name}-v{self.table.version()}"

    def save_dimensions(self) -> None:
        """Write both dimensions for the current snapshot, so that queries need not build them."""
        self._build_calendar().coalesce(1).write.mode("overwrite").parquet(self._saved("calendar"))
        self._build_stores().write.mode("overwrite").parquet(self._saved("stores"))

    def _build_calendar(self) -> DataFrame:
        span = self.table.span()
        if span is None:
            return empty_frame(self.spark, CALENDAR)
        return build_calendar(self.spark, date(span[0].year, 1, 1), date(span[1].year, 12, 31))

    def _build_stores(self) -> DataFrame:
        return store_locations(self.sales())

    def calendar(self) -> DataFrame:
        saved = self._saved("calendar")
        if path_exists(self.spark, saved):
            return self.spark.read.schema(CALENDAR).parquet(saved)
        return self._build_calendar()

    def stores(self) -> DataFrame:
        saved = self._saved("stores")
        if path_exists(self.spark, saved):
            return self.spark.read.schema(STORES).parquet(saved)
        return self._build_stores()

    # ------------------------------------------------------------ questions

    def model(self, **options) -> SalesModel:
        return SalesModel(self.sales(), self.calendar, self.stores, **options)

    def ttm_sales(self) -> DataFrame:
        return reports.ttm_sales(self.sales(), anchor=self.newest_date())

    def ttm_sales_by_category(self) -> DataFrame:
        return reports.ttm_sales_by_category(self.sales(), anchor=self.newest_date())

    def ttm_top_items(self, n: int | None = None) -> DataFrame:
        return reports.ttm_top_items(self.sales(), n=n, anchor=self.newest_date())

    def monthly_sales(self, **options) -> DataFrame:
        return reports.monthly_sales(self.sales(), **options)

    def daily_trend(self, **options) -> DataFrame:
        return reports.daily_trend(self.sales(), **options)

    def ask(self, question: str, **options) -> DataFrame:
        """A verified question; trailing reports end with the newest date of the snapshot."""
        if takes_anchor(question):
            options.setdefault("anchor", self.newest_date())
        return ask(self.sales(), question, **options)

    def question(self, name: str, **options) -> DataFrame:
        """One of the business questions (see ``QUESTIONS``), up to the newest date of the snapshot."""
        if name not in QUESTIONS:
            raise ValueError(f"no question {name!r}; there are {', '.join(QUESTIONS)}")
        options.setdefault("anchor", self.newest_date())
        return QUESTIONS[name](self.sales(), **options)

    def create_views(self, sales: str = "sales", calendar: str = "date_dim",
                     stores: str = "dim_store_location_v") -> None:
        """Register the current snapshot for SQL."""
        self.sales().createOrReplaceTempView(sales)
        self.calendar().createOrReplaceTempView(calendar)
        self.stores().createOrReplaceTempView(stores)
