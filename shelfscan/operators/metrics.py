"""The eight sales metrics, as ratios and sums of six additive parts.

Parts add up over any grouping, so a query can sum them before a join and again after it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.numbers import exact_sum, ratio


def _margin() -> Column:
    # a line without a cost has no margin, although its sales still count as sales
    return F.col("sale_dollars") - F.col("state_bottle_cost") * F.col("bottles_sold")


# part name -> value of one sales line, and whether it is a whole number
PARTS: dict[str, tuple[Callable[[], Column], bool]] = {
    "sales": (lambda: F.col("sale_dollars"), False),
    "bottles": (lambda: F.col("bottles_sold").cast("bigint"), True),
    "liters": (lambda: F.col("volume_sold_liters"), False),
    "gallons": (lambda: F.col("volume_sold_gallons"), False),
    "cost": (lambda: F.col("state_bottle_cost") * F.col("bottles_sold"), False),
    "margin": (_margin, False),
}


def sum_part(part: str, when: Column | None = None) -> Column:
    """Exact sum of a part over sales lines, or over those of them that meet a condition."""
    value, whole = PARTS[part]
    if whole:
        return F.sum(value() if when is None else F.when(when, value()))
    return exact_sum(value(), when)


PART_COLUMNS: dict[str, set[str]] = {
    "sales": {"sale_dollars"},
    "bottles": {"bottles_sold"},
    "liters": {"volume_sold_liters"},
    "gallons": {"volume_sold_gallons"},
    "cost": {"state_bottle_cost", "bottles_sold"},
    "margin": {"sale_dollars", "state_bottle_cost", "bottles_sold"},
}


@dataclass(frozen=True)
class Metric:
    """A measure over summed parts. ``currency`` metrics are rounded in reports."""

    name: str
    parts: tuple[str, ...]
    finish: Callable[..., Column]
    currency: bool = False
    description: str = ""

    def value(self) -> Column:
        return self.finish(*[F.col(f"_{part}") for part in self.parts])

    def columns(self) -> set[str]:
        return set().union(*[PART_COLUMNS[part] for part in self.parts])


def _as_double(part: Column) -> Column:
    return part.cast("double")


METRICS: dict[str, Metric] = {metric.name: metric for metric in [
    Metric("TOTAL_SALES", ("sales",), _as_double, True, "Sales dollars."),
    Metric("TOTAL_BOTTLES_SOLD", ("bottles",), lambda part: part, False, "Bottles sold."),
    Metric("TOTAL_VOLUME_LITERS", ("liters",), _as_double, False, "Liters sold."),
    Metric("TOTAL_VOLUME_GALLONS", ("gallons",), _as_double, False, "Gallons sold."),
    Metric("AVG_PRICE_PER_BOTTLE", ("sales", "bottles"), ratio, True,
           "Sales dollars per bottle."),
    Metric("AVG_UNIT_COST", ("cost", "bottles"), ratio, True, "Bottle cost per bottle sold."),
    Metric("GROSS_MARGIN_DOLLARS", ("margin",), _as_double, True,
           "Sales dollars less the cost of the bottles."),
    Metric("GROSS_MARGIN_RATE", ("margin", "sales"), ratio, False,
           "Gross margin per sales dollar."),
]}


def parts_of(metrics: Sequence[Metric]) -> list[str]:
    """The parts the metrics need, each once, in a fixed order."""
    wanted = {part for metric in metrics for part in metric.parts}
    return [part for part in PARTS if part in wanted]


def sum_parts(rows: DataFrame, parts: Sequence[str], *by: Column | str) -> DataFrame:
    """Sum the parts of sales lines; part columns are named ``_part``."""
    return rows.groupBy(*by).agg(*[sum_part(part).alias(f"_{part}") for part in parts])


def add_parts(totals: DataFrame, parts: Sequence[str], *by: Column | str) -> DataFrame:
    """Sum parts that were summed before."""
    return totals.groupBy(*by).agg(*[F.sum(f"_{part}").alias(f"_{part}") for part in parts])


def measure(rows: DataFrame, names: Sequence[str], *by: str) -> DataFrame:
    """Metrics of sales lines grouped by columns; output columns in lower case."""
    metrics = [METRICS[name.upper()] for name in names]
    totals = sum_parts(rows, parts_of(metrics), *by)
    return totals.select(*by, *[metric.value().alias(metric.name.lower()) for metric in metrics])
