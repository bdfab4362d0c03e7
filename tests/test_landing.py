import gzip
import json
from pathlib import Path
import time

from pyspark.sql import functions as F
import pytest

from shelfscan.operators import transform
from shelfscan.schemas import LANDING_KEYS
from shelfscan.session import shared_folder
from shelfscan.sources import landing


def document(number, day="2024-01-05", **fields):
    made = {"invoice_line_no": f"INV-{number}", "date": f"{day}T00:00:00.000", "store": "12",
            "pack": "6", "sale_bottles": "2", "sale_dollars": "10.50", "category_name": "GOLD RUM"}
    return {**made, **fields}


def put(folder: Path, name: str, lines, year=2024, month=1):
    place = folder / f"year={year}" / f"month={month:02d}"
    place.mkdir(parents=True, exist_ok=True)
    body = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n"
    if name.endswith(".gz"):
        with gzip.open(place / name, "wt") as out:
            out.write(body)
    else:
        (place / name).write_text(body, encoding="utf-8")


def test_bad_records_are_set_aside(spark, tmp_path):
    put(tmp_path, "page_1.jsonl", [
        "﻿" + json.dumps(document(1)), '{"invoice_line_no": "INV-2"', '{"a": 1, "a": 2}', "",
        document(3)])
    put(tmp_path, "page_2.jsonl.gz", [document(4)], month=2)
    put(tmp_path, "notes.txt", ["not a landing file"])
    raw = landing.scan_raw(spark, str(tmp_path))
    good = transform.extract_fields(landing.good_documents(raw), "file_name", "load_ts").collect()
    assert sorted(row.invoice_line_no for row in good) == ["INV-1", "INV-3", "INV-4"]
    assert all(row.load_ts is not None and "page_" in row.file_name for row in good)
    assert {row.line for row in landing.bad_documents(raw).collect()} == {
        '{"invoice_line_no": "INV-2"', '{"a": 1, "a": 2}'}


def test_location_forms(spark, tmp_path):
    point = {"type": "Point", "coordinates": [-91.5, 42.0]}
    put(tmp_path, "page_1.jsonl", [
        document(1, store_location=point), document(2, store_location=json.dumps(point)),
        document(3, store_location="corner of Main"), document(4, store_location=None),
        document(5)])
    raw = landing.scan_documents(spark, str(tmp_path))
    typed = transform.to_sales(raw).orderBy("invoice_and_item_number")
    rows = typed.select(
        F.to_json("store_location").alias("location"),
        F.try_variant_get("store_location", "$.coordinates[0]", "double").alias("x")).collect()
    assert [row.x for row in rows] == [-91.5, -91.5, None, None, None]
    assert rows[2].location == '"corner of Main"'
    assert rows[3].location is None and rows[4].location is None


def test_numbers_that_do_not_fit(spark, tmp_path):
    put(tmp_path, "page_1.jsonl", [
        document(1, pack="12.0", sale_bottles=3), document(2, pack="abc"), document(3, pack="")])
    raw = landing.scan_documents(spark, str(tmp_path))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        transform.to_sales(raw).collect()
    rows = transform.to_sales(raw, strict=False).orderBy("invoice_and_item_number").collect()
    assert [(row.pack, row.bottles_sold) for row in rows] == [(12, 3), (None, 2), (None, 2)]
    bad = transform.extract_fields(transform.misfits(raw)).collect()
    assert sorted(row.invoice_line_no for row in bad) == ["INV-2", "INV-3"]


def test_partition_filter_prunes_folders(spark, plan, tmp_path):
    for month in (1, 2, 12):
        put(tmp_path, "page_1.jsonl", [document(month)], month=month)
    lines = landing.scan_lines(spark, str(tmp_path), months=[(2024, 2), (2024, 12)])
    filters = plan(lines).split("PartitionFilters:")[1].split("\n")[0]
    assert "month" in filters and "year" in filters
    assert lines.count() == 2
    assert landing.scan_lines(spark, str(tmp_path), years=[2023]).count() == 0
    with pytest.raises(ValueError):
        landing.scan_lines(spark, str(tmp_path), months=[])


def test_files_are_loaded_once(spark, tmp_path):
    base = tmp_path / "landing"
    put(base, "page_1.jsonl", [document(1), document(2)])
    places = (str(base), str(tmp_path / "raw"), str(tmp_path / "ledger"))
    assert landing.load_new_files(spark, *places) == 1
    assert landing.load_new_files(spark, *places) == 0
    put(base, "page_2.jsonl", [document(3)])
    assert landing.load_new_files(spark, *places) == 1
    assert spark.read.parquet(places[1]).count() == 3
    assert landing.load_new_files(spark, *places, force=True) == 2
    # a page written again under the same path is a new file
    put(base, "page_2.jsonl", [document(3), document(4)])
    assert landing.load_new_files(spark, *places) == 1


def test_documents_are_parsed_once(spark, tmp_path, plan):
    put(tmp_path, "page_1.jsonl", [document(1), "{broken"])
    text = plan(transform.to_sales(landing.scan_documents(spark, str(tmp_path))), "simple")
    assert "parseJson" not in text.split("store_location")[0] and "FileScan json" in text


def test_loads_count_what_they_leave_out(spark, tmp_path):
    base = tmp_path / "landing"
    put(base, "page_1.jsonl", [document(1), "{broken", document(2, date=None), "", '{"a": 1, "a": 2}'])
    put(base, "page_2.jsonl", [document(3), document(4, day="soon")])
    places = (str(base), str(tmp_path / "raw"), str(tmp_path / "ledger"))
    found = landing.load_files(spark, *places, rejects=str(tmp_path / "rejects"))
    assert found == landing.FilesLoaded(files=2, rejected=2, undated=2)
    assert spark.read.parquet(places[1]).count() == 4
    rejects = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert sorted(row.line for row in rejects) == ["{broken", '{"a": 1, "a": 2}'][::-1] or len(rejects) == 2
    assert landing.load_files(spark, *places) == landing.FilesLoaded()


def test_several_new_files_at_once(spark, tmp_path):
    base = tmp_path / "landing"
    for number in range(3):
        put(base, f"page_{number}.jsonl", [document(number)])
    places = (str(base), str(tmp_path / "raw"), str(tmp_path / "ledger"))
    assert landing.load_new_files(spark, *places) == 3
    put(base, "page_8.jsonl", [document(8)])
    put(base, "page_9.jsonl", [document(9)])
    assert landing.load_new_files(spark, *places) == 2
    assert spark.read.parquet(places[1]).count() == 5


def wide(frame):
    given = frame.columns
    return frame.select(*[
        F.col(key) if key in given else F.lit(None).cast("string").alias(key)
        for key in LANDING_KEYS])


def test_pages_with_a_hot_row(spark, tmp_path):
    # one document makes up a third of all rows, all of them on one day
    copies = spark.range(2000).select(
        F.lit("INV-HOT").alias("invoice_line_no"), F.lit("2024-02-03T00:00:00.000").alias("date"))
    others = spark.range(4000).select(
        F.concat(F.lit("INV-"), F.col("id").cast("string")).alias("invoice_line_no"),
        F.concat(F.lit("2024-02-0"), (F.col("id") % 5 + 1).cast("string"),
                 F.lit("T00:00:00.000")).alias("date"))
    rows = wide(copies.unionByName(others))
    paged = landing.page_assign(rows, "invoice_line_no", page_size=700)
    expected = rows.selectExpr(
        "*", "row_number() OVER (ORDER BY to_date(substr(date, 1, 10)), md5(invoice_line_no)) AS n")
    found = paged.select("invoice_line_no", F.col("row_in_month").cast("int").alias("n"))
    assert found.exceptAll(expected.select("invoice_line_no", "n")).count() == 0
    assert paged.count() == 6000
    sizes = {row.page: row["count"] for row in paged.groupBy("page").count().collect()}
    assert sizes == {**{page: 700 for page in range(1, 9)}, 9: 400}

    folder = str(tmp_path / "landing")
    landing.write_pages(paged, folder, page_size=700)
    lines = landing.scan_lines(spark, folder).groupBy(F.col("_metadata.file_path")).count()
    assert sorted(row["count"] for row in lines.collect()) == [400] + [700] * 8
    # written again, the month is replaced
    landing.write_pages(paged.where("page <= 2"), folder, page_size=700)
    assert landing.scan_lines(spark, folder).count() == 1400
    assert list((tmp_path / "landing").glob("year=2024/month=02/*.json"))


def test_pages_of_rows_without_key_or_date(spark):
    # half of the rows have no key; some have no date, or text that is none
    rows = wide(spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("INV-"), "id")).alias("invoice_line_no"),
        F.when(F.col("id") % 100 == 0, F.lit(None)).when(F.col("id") % 100 == 1, F.lit("soon"))
        .when(F.col("id") % 3 == 0, F.lit("2024-02-29")).otherwise(F.lit("2024-03-01T08:15:00"))
        .alias("date"), F.col("id").cast("string").alias("store")))
    assert landing.undated(rows).count() == 60
    paged = landing.page_assign(rows, "invoice_line_no", page_size=100).collect()
    dated = rows.where("date LIKE '2024%'").count()
    assert len({row.store for row in paged}) == len(paged) == dated == 2940
    for month in (2, 3):
        mine = sorted((row.row_in_month, row.page) for row in paged if row.month == month)
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1))
        assert all(page == (n - 1) // 100 + 1 for n, page in mine)
    assert landing.page_assign(rows.limit(0), "invoice_line_no").count() == 0


def test_pages_cross_the_network_once(spark, sf_dir, plan):
    rows = wide(spark.range(100).select(
        F.col("id").cast("string").alias("invoice_line_no"), F.lit("2024-02-03").alias("date")))
    text = plan(landing.page_assign(rows, "invoice_line_no"), "simple")
    # what is left after the written rows only moves the counts
    assert "rangepartitioning" not in text and "SortMergeJoin" not in text


def test_csv_skips_bad_records(spark, tmp_path):
    from shelfscan.plans.calendar import build_calendar
    from shelfscan.sources.csvfiles import read_calendar_csv
    from datetime import date
    built = build_calendar(spark, date(2012, 1, 1), date(2012, 1, 3))
    header = ",".join(built.columns)
    good = [",".join(f'"{value}"' if isinstance(value, str) else "" if value is None else str(value)
                     for value in row) for row in built.collect()]
    path = tmp_path / "dates.csv"
    path.write_text("\n".join([header, *good, "x,not a date," + "," * 17]) + "\n")
    read = read_calendar_csv(spark, str(path))
    assert read.count() == 3 and read.select("dayofweek").count() == 3
    assert read.exceptAll(built).count() == 0


def many_documents(spark, rows=3000):
    return wide(spark.range(rows).select(
        F.concat(F.lit("INV-"), F.col("id").cast("string")).alias("invoice_line_no"),
        F.concat(F.lit("2024-0"), (F.col("id") % 4 + 1).cast("string"), F.lit("-0"),
                 (F.col("id") % 9 + 1).cast("string")).alias("date"),
        F.col("id").cast("string").alias("store")))


def test_pages_in_slices_are_the_same(spark, tmp_path, monkeypatch):
    rows = many_documents(spark)
    whole = landing.page_assign(rows, "invoice_line_no", page_size=70).collect()
    monkeypatch.setattr("shelfscan.session.SLICE_ROWS", 400)
    scratch = str(tmp_path / "ordered")
    paged = landing.page_assign(rows, "invoice_line_no", page_size=70, scratch=scratch)
    assert spark.read.parquet(scratch).selectExpr("_part div (1 << 20)").distinct().count() == 7
    assert sorted(map(str, paged.collect())) == sorted(map(str, whole))
    landing.write_pages(paged, str(tmp_path / "pages"), page_size=70)
    sizes = landing.scan_lines(spark, str(tmp_path / "pages")).groupBy(
        "month", F.col("_metadata.file_path")).count().collect()
    assert sorted(row["count"] for row in sizes) == [50] * 4 + [70] * 40


def test_landing_leaves_compressed_pages_only(spark, tmp_path, monkeypatch):
    # the rows' own copies and shuffle files are gone when the pages are there
    monkeypatch.setattr("shelfscan.session.SLICE_ROWS", 400)
    scratch = set(Path(shared_folder(spark).removeprefix("file:")).iterdir())
    rows = many_documents(spark)
    landing.land(rows, "invoice_line_no", str(tmp_path / "pages"), page_size=100)
    files = [file.name for file in (tmp_path / "pages").rglob("part-*")]
    assert len(files) == 32 and all(name.endswith(".json.gz") for name in files)
    assert set(Path(shared_folder(spark).removeprefix("file:")).iterdir()) == scratch
    documents = landing.scan_documents(spark, str(tmp_path / "pages"))
    assert documents.select(F.variant_get("raw", "$.store", "string")).distinct().count() == 3000


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    from shelfscan.session import written_in_slices
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    def shuffles():
        found = kept.diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())
                if found.apply(i).getName().startswith("shuffle_")}
    before = shuffles()
    rows = spark.range(1000).repartition(3, "id")
    written_in_slices([rows, rows], str(tmp_path / "out"))
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2000
