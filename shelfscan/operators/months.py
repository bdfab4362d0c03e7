"""Month-partitioned Parquet table with snapshots.

Plain Parquet has no MERGE or DELETE. A change here writes only the touched months to a new
folder, then a summary of their keys, and last a small list of the folders that make up the new
snapshot, in a folder of its own that is named by its number and tag. Readers see the last
complete list, a failed job leaves the previous one, and a plan never overwrites files it reads.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscan.functions.dates import shift_months
from shelfscan.operators.filters import on_dates
from shelfscan.operators.keysummary import block_count, may_hold, summarise
from shelfscan.operators.upsert import delete_range, merge_upsert
from shelfscan.schemas import KEY, SALES
from shelfscan.session import (
    TABLE_CODEC, child_names, empty_frame, even_groups, fresh_folder, path_exists, removed,
    shuffles_released, written_in_slices,
)

Month = tuple[int | None, int | None]

SNAPSHOTS = T.StructType([
    T.StructField("version", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("sale_year", T.IntegerType()),
    T.StructField("sale_month", T.IntegerType()),
    T.StructField("rows", T.LongType()),
    T.StructField("folder", T.StringType()),
])


UNKNOWN = "__HIVE_DEFAULT_PARTITION__"


def _folder_name(month: Month) -> str:
    year, number = (UNKNOWN if part is None else part for part in month)
    return f"sale_year={year}/sale_month={number}"


def _folder_of(version: int) -> Column:
    """The folder of a row that this version writes."""
    year, number = (F.coalesce(F.col(name).cast("string"), F.lit(UNKNOWN))
                    for name in ("sale_year", "sale_month"))
    return F.concat(F.lit(f"data/v={version}/sale_year="), year, F.lit("/sale_month="), number)


def _tag_mark(tag: str) -> str:
    return hashlib.sha256(tag.encode()).hexdigest()[:24]


def month_predicate(months: Sequence[Month]) -> Column:
    """Predicate on the partition columns alone, so that it prunes folders."""
    known = sorted(y * 100 + m for y, m in months if y is not None and m is not None)
    number = F.col("sale_year") * 100 + F.col("sale_month")
    picked = number.isin(known) if known else F.lit(False)
    if len(known) < len(months):
        picked = picked | number.isNull()
    return F.coalesce(picked, F.lit(False))


class MonthTable:
    def __init__(self, spark: SparkSession, root: str, key: str = KEY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key

    # ------------------------------------------------------------ snapshots

    def snapshots(self) -> DataFrame:
        """All snapshot lists: one row per version and month, plus one row per version."""
        path = f"{self.root}/snapshots"
        if not path_exists(self.spark, path):
            return empty_frame(self.spark, SNAPSHOTS)
        return self.spark.read.schema(SNAPSHOTS).option("recursiveFileLookup", True).json(path)

    def _lists(self) -> list[str]:
        """Folder names of the snapshot lists, newest first. Nothing is read but the names."""
        return sorted(child_names(self.spark, f"{self.root}/snapshots"), reverse=True)

    def _complete(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.root}/snapshots/{name}/_SUCCESS")

    def _current(self) -> tuple[int, list]:
        """Number and months of the current snapshot; the months are bounded by the calendar.

        Only the newest complete list is read, however many there are.
        """
        newest = next((name for name in self._lists() if self._complete(name)), None)
        if newest is None:
            return 0, []
        rows = self.spark.read.schema(SNAPSHOTS).json(f"{self.root}/snapshots/{newest}").collect()
        return rows[0].version, [row for row in rows if row.folder is not None]

    def version(self) -> int:
        """Number of the current snapshot, 0 before the first write."""
        return self._current()[0]

    def month_list(self) -> list:
        """Months of the current snapshot with their row counts and folders."""
        return self._current()[1]

    def has_tag(self, tag: str) -> bool:
        mark = _tag_mark(tag)
        return any(name.endswith(mark) and self._complete(name) for name in self._lists())

    # ------------------------------------------------------------ reading

    def _read(self, months: Sequence) -> DataFrame:
        if not months:
            return empty_frame(self.spark, SALES)
        paths = [f"{self.root}/{row.folder}" for row in months]
        return (
            self.spark.read.schema(SALES).option("basePath", f"{self.root}/data")
            .parquet(*paths).select(*SALES.fieldNames())
        )

    def read(self) -> DataFrame:
        return self._read(self.month_list())

    def read_between(self, low: date, high: date) -> DataFrame:
        """Rows of a date range with the partition predicate next to the date bounds."""
        return on_dates(self.read(), low, high)

    def last_date(self) -> date | None:
        """MAX(sale_date), read from the newest month only."""
        dated = [row for row in self.month_list() if row.sale_year is not None and row.rows]
        if not dated:
            return None
        newest = max(dated, key=lambda row: (row.sale_year, row.sale_month))
        return self._read([newest]).agg(F.max("sale_date")).first()[0]

    def span(self) -> tuple[date, date] | None:
        """First and last day of the stored months, from the snapshot list alone."""
        stored = sorted(
            (row.sale_year, row.sale_month) for row in self.month_list()
            if row.sale_year is not None and row.rows)
        if not stored:
            return None
        (first_year, first_month), (last_year, last_month) = stored[0], stored[-1]
        after = shift_months(date(last_year, last_month, 1), 1)
        return date(first_year, first_month, 1), after - timedelta(days=1)

    # ------------------------------------------------------------ writing

    def replace_months(
        self, rows: DataFrame, months: Sequence[Month], tag: str | None = None,
        expected: dict[Month, int] | None = None,
    ) -> int:
        """Make ``rows`` the whole content of ``months``; other months are kept by reference.

        Returns the number of rows written. ``expected`` may bound the rows of each month, which
        spares counting them ahead of their key summary.
        """
        return self._replaced([rows], months, tag, expected)

    def _replaced(
        self, parts: Sequence[DataFrame], months: Sequence[Month], tag: str | None,
        expected: dict[Month, int] | None,
    ) -> int:
        """:func:`replace_months` with the rows in parts, which are written one after another."""
        version, before = self._current()
        version += 1
        data = f"{self.root}/data/v={version}"
        for number, rows in enumerate(parts):
            with shuffles_released(rows.sparkSession):
                (
                    # even file sizes: large months are split, small ones share a task
                    rows.select(*SALES.fieldNames()).hint("rebalance", "sale_year", "sale_month")
                    .write.mode("append" if number else "overwrite")
                    .option("compression", TABLE_CODEC)
                    .partitionBy("sale_year", "sale_month").parquet(data)
                )
        written = self._summarised(version, data, expected)
        gone = set(months)
        listed = [(version, tag, None, None, None, None)]
        listed += [
            (version, tag, row.sale_year, row.sale_month, row.rows, row.folder)
            for row in before if (row.sale_year, row.sale_month) not in gone
        ]
        listed += [
            (version, tag, *month, count, f"data/v={version}/{_folder_name(month)}")
            for month, count in written.items()
        ]
        name = f"{version:010d}" if tag is None else f"{version:010d}-{_tag_mark(tag)}"
        (
            self.spark.createDataFrame(listed, SNAPSHOTS).coalesce(1)
            .write.mode("overwrite").json(f"{self.root}/snapshots/{name}")
        )
        return sum(written.values())

    def _summarised(
        self, version: int, data: str, expected: dict[Month, int] | None,
    ) -> dict[Month, int]:
        """Write the key summaries of the months a version has written; their row counts."""
        rows = self.spark.read.schema(SALES).parquet(data)
        if expected is None:
            expected = {
                (row.sale_year, row.sale_month): row["count"]
                for row in rows.groupBy("sale_year", "sale_month").count().collect()}
        folder = _folder_of(version)
        folders = {f"data/v={version}/{_folder_name(month)}": month for month in expected}
        counts = [F.lit(x) for name, month in folders.items()
                  for x in (name, block_count(expected[month]))]
        blocks = F.create_map(*counts)[folder] if counts else F.lit(1)
        path = f"{self.root}/keys/v={version}"
        with shuffles_released(self.spark):
            summarise(rows, self.key, folder, blocks).write.mode("overwrite").parquet(path)
        found = self.spark.read.parquet(path).groupBy("folder").agg(F.sum("rows").alias("n"))
        return {folders[row.folder]: row.n for row in found.collect()}

    def _holding(self, keys: DataFrame, months: Sequence) -> list:
        """Those of the months that hold one of the keys.

        The key summaries name candidates, and only the key column of these is read.
        """
        if not months:
            return []
        versions = sorted({row.folder.split("/")[1] for row in months})
        summary = self.spark.read.parquet(*[f"{self.root}/keys/{v}" for v in versions]).where(
            F.col("folder").isin([row.folder for row in months]))
        blocks = sorted({block_count(row.rows) for row in months} | {
            row.blocks for row in summary.select("blocks").distinct().collect()})
        named = {row.folder for row in may_hold(summary, keys, self.key, blocks).collect()}
        candidates = [row for row in months if row.folder in named]
        if not candidates:
            return []
        held = (
            self._read(candidates).where(F.col(self.key).isNotNull())
            .select(self.key, "sale_year", "sale_month").join(keys, self.key, "left_semi")
            .select("sale_year", "sale_month").distinct()
        )
        found = {(row.sale_year, row.sale_month) for row in held.collect()}
        return [row for row in candidates if (row.sale_year, row.sale_month) in found]

    def upsert(
        self, source: DataFrame | Sequence[DataFrame], tag: str | None = None, may_move: bool = True,
    ) -> int:
        """Merge a source with unique keys, whole or in slices; returns its row count.

        Touched months are those of the source rows and those that hold an old row of a
        source key, because a corrected date moves a row to another month. Old rows are searched
        for in the key summaries of the months, and then in the months these name;
        ``may_move=False`` leaves that out where a key never changes its month. ``tag`` names the
        change; a change whose tag is already there is not applied again.
        """
        slices = [source] if isinstance(source, DataFrame) else list(source)
        return self._merged(slices, None, tag, may_move)

    def replace_between(self, low: date, high: date, source: DataFrame, tag: str | None = None) -> int:
        """Delete a date range and merge a source, as one snapshot; returns the source's row count.

        A source that fails leaves the table as it was.
        """
        return self._merged([source], (low, high), tag, True)

    def _merged(self, slices: Sequence[DataFrame], span, tag, may_move) -> int:
        if tag is not None and self.has_tag(tag):
            return 0
        months = self.month_list()
        scratch = fresh_folder(self.spark, "source")
        try:
            source = written_in_slices(slices, scratch)
            with shuffles_released(self.spark, source.sparkSession):
                return self._merged_written(source, months, span, tag, may_move)
        finally:
            removed(self.spark, scratch)

    def _merged_written(self, source, months, span, tag, may_move) -> int:
        own = {
            (row.sale_year, row.sale_month): row["count"]
            for row in source.groupBy("sale_year", "sale_month").count().collect()}
        if not months:
            return self._replaced(
                [source.where(part) for part in self._parts(own)], [], tag, own)
        touched = set(own)
        if span is not None:
            touched |= {(row.sale_year, row.sale_month) for row in self._covered(months, *span)}
        if not touched:
            return 0
        if may_move and own:
            keys = source.select(self.key).where(F.col(self.key).isNotNull())
            rest = [row for row in months if (row.sale_year, row.sale_month) not in touched]
            touched |= {
                (row.sale_year, row.sale_month) for row in self._holding(keys, rest)}
        read = [row for row in months if (row.sale_year, row.sale_month) in touched]
        target = self._read(read)
        if span is not None:
            target = delete_range(target, *span)
        expected = dict(own)
        for row in read:
            month = (row.sale_year, row.sale_month)
            expected[month] = expected.get(month, 0) + row.rows
        # the old rows of a part's months look among the keys of the whole source
        parts = [
            merge_upsert(target.where(part), source, self.key).where(part)
            for part in self._parts(expected)]
        self._replaced(parts, list(touched), tag, expected)
        return sum(own.values())

    @staticmethod
    def _parts(expected: dict[Month, int]) -> list[Column]:
        """Conditions that deal months with so many rows to parts of a write."""
        known = sorted((month, rows) for month, rows in expected.items() if None not in month)
        unknown = [month for month in expected if None in month]
        groups = even_groups(known)
        if len(groups) < 2:
            return [F.lit(True)]
        return [month_predicate(group + unknown * (group is groups[-1])) for group in groups]

    @staticmethod
    def _covered(months: Sequence, low: date, high: date) -> list:
        """Stored months that a date range covers or cuts."""
        return [
            row for row in months if row.sale_year is not None
            and (low.year, low.month) <= (row.sale_year, row.sale_month) <= (high.year, high.month)
        ]

    def delete_between(self, low: date, high: date) -> int:
        """Delete a date range, rewriting only the stored months it covers; returns the rows kept."""
        stored = self._covered(self.month_list(), low, high)
        if not stored:
            return 0
        kept = delete_range(self._read(stored), low, high)
        return self.replace_months(kept, [(row.sale_year, row.sale_month) for row in stored])
