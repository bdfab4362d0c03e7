"""Landing files and loaded stores made once per session from the order tables.

The folders are below the shared folder of the session, so every executor can reach them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.plans.loads import LoadReport, Store, load_from_landing, load_latest
from shelfscan.session import fresh_folder
from shelfscan.sources import landing, testdata

FIRST_YEAR = 1995
HOLD_BACK = date(2001, 6, 1)
AS_OF = testdata.AS_OF

_made: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, make):
    place = (spark.sparkContext.applicationId, sf_dir, label)
    if place not in _made:
        _made[place] = make()
    return _made[place]


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """All documents as paged landing files."""
    def make() -> str:
        folder = fresh_folder(spark, "landing")
        landing.land(testdata.documents(spark, sf_dir), "invoice_line_no", folder)
        return folder
    return _once(spark, sf_dir, "landing", make)


def loaded_store(spark: SparkSession, sf_dir: str) -> tuple[Store, LoadReport]:
    """A store backfilled up to a date and then brought up to date by ``load_latest``."""
    def make() -> tuple[Store, LoadReport]:
        store = Store(fresh_folder(spark, "store"))
        documents = testdata.documents(spark, sf_dir)
        older = documents.where(F.substring("date", 1, 10) < F.lit(str(HOLD_BACK)))
        landing.land(older, "invoice_line_no", store.landing)
        load_from_landing(spark, store)
        report = load_latest(
            spark, store, feed=lambda labels: documents, as_of=AS_OF, first_year=FIRST_YEAR)
        return store, report
    return _once(spark, sf_dir, "store", make)


def own_store(spark: SparkSession, sf_dir: str) -> Store:
    """A store of all landing files that no other query sees or changes."""
    store = Store(fresh_folder(spark, "store"), pages=landing_folder(spark, sf_dir))
    load_from_landing(spark, store)
    return store


def whole_store(spark: SparkSession, sf_dir: str) -> Store:
    """A store of all landing files that queries only read."""
    return _once(spark, sf_dir, "whole", lambda: own_store(spark, sf_dir))
