"""Questions with an agreed answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from inspect import signature

from pyspark.sql import DataFrame

from shelfscan.plans import reports


@dataclass(frozen=True)
class VerifiedQuery:
    name: str
    question: str
    answer: Callable[..., DataFrame]


# Names and questions.
VERIFIED = [
    VerifiedQuery(
        "TTM_SALES", "What is our trailing twelve month (TTM) sales?", reports.ttm_sales),
    VerifiedQuery(
        "TOP_TTM_ITEMS", "What are the top N best selling items for the past TTM?",
        reports.ttm_top_items),
    VerifiedQuery(
        "MONTHLY_SALES_WITH_TTM_AVG",
        "Show monthly sales with a trailing 12-month average for the last 36 months.",
        reports.monthly_sales),
]


def find(question: str) -> VerifiedQuery:
    """The verified query with this name or text."""
    wanted = question.strip().rstrip("?.").lower()
    for query in VERIFIED:
        if wanted in (query.name.lower(), query.question.rstrip("?.").lower()):
            return query
    raise ValueError(f"no verified query for {question!r}")


def takes_anchor(question: str) -> bool:
    """Whether the answer depends on the newest date of all sales."""
    return "anchor" in signature(find(question).answer).parameters


def ask(sales: DataFrame, question: str, **options) -> DataFrame:
    """Answer a verified question, given by its name or text."""
    return find(question).answer(sales, **options)
