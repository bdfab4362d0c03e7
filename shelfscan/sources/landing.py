"""Landing files: paged JSON documents in ``year=YYYY/month=MM`` folders.

Everything here is a file source, a projection or a keyed aggregate; no step needs a
whole month, a whole file list or a hot group in one task or on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscan.functions.variant import text_at
from shelfscan.schemas import FILE_LEDGER, RAW
from shelfscan.session import (
    TABLE_CODEC, TEXT_CODEC, empty_frame, even_groups, fresh_folder, path_exists, removed,
    shuffles_released, written_in_slices,
)

PAGE_SIZE = 50_000
DOCUMENT_FILES = "*.json*"
#: Column of the scan for lines that are no documents. Next to a document column the scan takes it
#: by Spark's own name only.
BAD_LINE = "_corrupt_record"
PARSED = T.StructType([
    T.StructField("raw", T.VariantType()), T.StructField(BAD_LINE, T.StringType())])

Month = tuple[int, int]


# ---------------------------------------------------------------- paging and writing

def day_of(stamp: Column) -> Column:
    """The date of a document's timestamp text; NULL for text that is no date."""
    return stamp.cast("string").try_cast("date")


def undated(rows: DataFrame, day: str = "date") -> DataFrame:
    """Rows without a readable date. They belong to no month, so no page holds them."""
    return rows.where(day_of(F.col(day)).isNull())


def page_assign(
    rows: DataFrame,
    key: str,
    day: str = "date",
    page_size: int = PAGE_SIZE,
    scratch: str | None = None,
) -> DataFrame:
    """Number the rows of each month by date and cut them into pages.

    Adds ``year``, ``month``, ``row_in_month`` and ``page`` (both from 1). Rows of one date are
    ordered by the MD5 of their key, then by the hash of the whole row, then by all columns, which
    makes the numbering total and repeatable. Rows without a date are left to :func:`undated`.

    The rows are written as they come, which ends the shuffles of the joins they come from. They cross
    the network once, to range partitions in that order, and are written there with their places, in
    the folder ``scratch``; many rows are taken in slices of neighbouring days. A row's number is its place in its partition plus the rows of its month in
    earlier partitions; these are one small count per month and partition. Copies of a row are
    many values of the range key, since it ends with the task a row comes from.
    """
    spark, columns, month = rows.sparkSession, rows.columns, ["year", "month"]
    sale_day = day_of(F.col(day))
    order = [sale_day, F.md5(F.coalesce(F.col(key), F.lit(""))), F.xxhash64(*columns)]
    names = ["_day", "_hash", "_row"]

    def in_order(part: DataFrame, number: int) -> DataFrame:
        # the order's values are made again behind the exchange: hashes hardly compress
        ranged = part.withColumn("_task", F.spark_partition_id()).repartitionByRange(*order, "_task")
        place = F.lit(number << 20) + F.spark_partition_id()
        return (
            ranged.select(*columns, *[made.alias(name) for made, name in zip(order, names)])
            .sortWithinPartitions(*names, *columns)
            .select(*columns, F.year("_day").alias("year"), F.month("_day").alias("month"),
                    place.alias("_part"), F.monotonically_increasing_id().alias("_place")))

    source, pages = fresh_folder(spark, "unpaged"), scratch or fresh_folder(spark, "pages")
    try:
        dated = written_in_slices([rows.where(sale_day.isNotNull())], source)
        days = dated.groupBy(sale_day.alias("day")).count().orderBy("day").collect()
        spans = even_groups((row.day, row["count"]) for row in days)
        slices = [dated] if len(spans) < 2 else [
            dated.where(sale_day.between(F.lit(span[0]), F.lit(span[-1]))) for span in spans]
        ordered = written_in_slices([in_order(*x) for x in zip(slices, range(len(slices)))], pages)
    finally:
        removed(spark, source)

    counted = ordered.groupBy(*month, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*month).orderBy("_part")
    starts = counted.select(
        *month, "_part", "_first", (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"))
    return (
        # a partition holds neighbouring days: no more starts than partitions and months
        ordered.join(F.broadcast(starts), [*month, "_part"])
        .withColumn("row_in_month", F.col("_before") + F.col("_place") - F.col("_first") + 1)
        .select(*columns, *month, "row_in_month",
                (F.floor((F.col("row_in_month") - 1) / page_size) + 1).cast("int").alias("page"))
    )


def write_pages(
    paged: DataFrame, path: str, page_size: int = PAGE_SIZE, codec: str = "none",
) -> None:
    """Write paged documents as JSON lines, one file per page, replacing whole months.

    The rows of a page are brought together; the sort puts the full pages of a month before its
    last one, so files break exactly at page ends. Many rows are written in groups of months: a job
    that fails leaves the months of later groups as they were.
    """
    months = paged.groupBy("year", "month").count().orderBy("year", "month").collect()
    groups = even_groups(((row.year, row.month), row["count"]) for row in months)
    # zero-padded folder names; ``month=01`` is read back as the number 1
    folders = paged.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    for group in groups if len(groups) > 1 else [None]:
        part = folders if group is None else folders.where(in_months(group))
        with shuffles_released(paged.sparkSession):
            (
                part.repartition("year", "month", "page")
                .sortWithinPartitions("year", "month", "page", "row_in_month")
                .drop("page", "row_in_month")
                .write.mode("overwrite").partitionBy("year", "month")
                .option("partitionOverwriteMode", "dynamic")
                .option("maxRecordsPerFile", page_size)
                .option("compression", codec)
                .json(path)
            )


def land(
    rows: DataFrame, key: str, path: str, day: str = "date", page_size: int = PAGE_SIZE,
) -> None:
    """Page the rows and write compressed pages; the numbered copy of the rows is deleted afterwards.

    A compressed file is read by one task, which a page is small enough for.
    """
    spark = rows.sparkSession
    scratch = fresh_folder(spark, "pages")
    try:
        write_pages(page_assign(rows, key, day, page_size, scratch), path, page_size, TEXT_CODEC)
    finally:
        removed(spark, scratch)


# ---------------------------------------------------------------- reading

def in_months(months: Sequence[Month] | None = None, years: Sequence[int] | None = None) -> Column:
    """Predicate on the partition columns; months take precedence over years."""
    if months is not None:
        if not months:
            raise ValueError("no valid month was asked for")
        by_year: dict[int, list[int]] = {}
        for year, month in months:
            by_year.setdefault(year, []).append(month)
        return reduce(or_, [
            (F.col("year") == year) & F.col("month").isin(sorted(set(picked)))
            for year, picked in sorted(by_year.items())
        ])
    if years is not None:
        if not years:
            raise ValueError("no valid year was asked for")
        return F.col("year").isin(sorted(set(years)))
    return F.lit(True)


def scan_lines(
    spark: SparkSession,
    path: str,
    months: Sequence[Month] | None = None,
    years: Sequence[int] | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """The text lines of the chosen landing files with path and partition columns."""
    reader = spark.read.option("pathGlobFilter", DOCUMENT_FILES).option("basePath", path)
    lines = reader.text(list(files) if files is not None else path)
    if months is not None or years is not None:
        lines = lines.where(in_months(months, years))
    return lines


def parsed_once(reader):
    """A batch or stream reader of JSON lines as ``raw`` and ``BAD_LINE``.

    Each line is parsed once, by the scan: ``raw`` is the document, or NULL for a line that is none,
    which is then in the other column. Blank lines are skipped. Duplicate keys are refused, as the landing
    format demands, and a byte order mark is ignored.
    """
    return (reader.schema(PARSED).option("pathGlobFilter", DOCUMENT_FILES)
            .option("singleVariantColumn", "raw").option("columnNameOfCorruptRecord", BAD_LINE)
            .option("mode", "PERMISSIVE").format("json"))


def as_raw(parsed: DataFrame) -> DataFrame:
    """Parsed lines with their file and load time; ``line`` stays, so that bad lines can be seen."""
    return parsed.select("raw", F.col("_metadata.file_path").alias("file_name"),
                         F.localtimestamp().alias("load_ts"), F.col(BAD_LINE).alias("line"))


def scan_raw(
    spark: SparkSession,
    path: str,
    months: Sequence[Month] | None = None,
    years: Sequence[int] | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """``raw, file_name, load_ts, line`` of the chosen landing files, good and bad."""
    reader = parsed_once(spark.read).option("basePath", path)
    parsed = reader.load(list(files) if files is not None else path)
    if months is not None or years is not None:
        parsed = parsed.where(in_months(months, years))
    return as_raw(parsed)


def good_documents(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("raw").isNotNull()).select(*RAW.fieldNames())


def bad_documents(raw: DataFrame) -> DataFrame:
    """Lines that were skipped: kept for inspection instead of failing the load."""
    return raw.where(F.col("raw").isNull()).select("file_name", "load_ts", "line")


def scan_documents(spark: SparkSession, path: str, **choice) -> DataFrame:
    """Every readable landing document as one variant row."""
    return good_documents(scan_raw(spark, path, **choice))


# ---------------------------------------------------------------- load-once ledger

def list_files(spark: SparkSession, path: str, pattern: str = DOCUMENT_FILES) -> DataFrame:
    """Path, size, time and partition of the files below a folder; no content is read."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "false").load(path)
    )
    parts = [name for name in ("year", "month") if name in found.columns]
    return found.select(
        "path", "length", F.col("modificationTime").alias("modification_time"),
        F.col("_metadata.file_path").alias("file_name"), *parts)


def not_loaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose path, size and time are not in the ledger yet."""
    keys = FILE_LEDGER.fieldNames()
    return files.join(ledger.select(*keys), keys, "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; empty before the first load."""
    if not path_exists(spark, path):
        return empty_frame(spark, FILE_LEDGER)
    return spark.read.schema(FILE_LEDGER).parquet(path)


@dataclass(frozen=True)
class FilesLoaded:
    """New files, their lines that are no documents, and their documents without a date."""

    files: int = 0
    rejected: int = 0
    undated: int = 0


def load_files(
    spark: SparkSession,
    path: str,
    raw_path: str,
    ledger_path: str,
    months: Sequence[Month] | None = None,
    years: Sequence[int] | None = None,
    force: bool = False,
    rejects: str | None = None,
) -> FilesLoaded:
    """Append the documents of files that were not loaded before to the raw table.

    Lines that are no documents and documents without a date are counted while the documents are
    written. With ``rejects``, the lines are also written there, in a second reading that only
    takes place when there are some. The new files are opened by name; their names take the driver
    no more than Spark's own list of the files of a scan.
    """
    files = list_files(spark, path).where(in_months(months, years))
    fresh = files if force else not_loaded(files, read_ledger(spark, ledger_path))
    fresh = fresh.select(*FILE_LEDGER.fieldNames()).persist()
    try:
        names = [row.path for row in fresh.select("path").collect()]
        if not names:
            return FilesLoaded()
        raw = scan_raw(spark, path, files=names)
        seen = Observation()
        no_day = day_of(text_at(F.col("raw"), "date")).isNull()
        counted = raw.observe(
            seen, F.count_if(F.col("raw").isNull()).alias("rejected"),
            F.count_if(F.col("raw").isNotNull() & no_day).alias("undated"))
        good_documents(counted).write.mode("append").option(
            "compression", TABLE_CODEC).parquet(raw_path)
        found = FilesLoaded(len(names), seen.get["rejected"], seen.get["undated"])
        if rejects is not None and found.rejected:
            bad_documents(raw).write.mode("append").parquet(rejects)
        fresh.write.mode("append").parquet(ledger_path)
        return found
    finally:
        fresh.unpersist()


def load_new_files(*places, **options) -> int:
    """The file count of :func:`load_files`."""
    return load_files(*places, **options).files
