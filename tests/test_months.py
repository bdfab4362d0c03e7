from datetime import date
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T
import pytest

from shelfscan.operators import keyed, upsert
from shelfscan.operators.months import MonthTable, month_predicate
from shelfscan.schemas import KEY, SALES
from shelfscan.session import shared_folder


def lines(spark, *rows):
    """Sales lines from (key, date, dollars)."""
    frame = spark.createDataFrame(list(rows), f"{KEY} string, sale_date date, sale_dollars double")
    built = {"sale_year": F.year("sale_date"), "sale_month": F.month("sale_date")}
    return frame.select(*[
        (F.col(f.name) if f.name in frame.columns
         else built.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name))
        for f in SALES.fields])


def content(table):
    return sorted((row[KEY] or "", row.sale_date, row.sale_dollars) for row in table.read().collect())


JAN, FEB, MAR = date(2024, 1, 10), date(2024, 2, 10), date(2024, 3, 10)


@pytest.fixture
def table(spark, tmp_path):
    made = MonthTable(spark, str(tmp_path / "sales"))
    assert made.upsert(lines(spark, ("a", JAN, 1.0), ("b", FEB, 2.0), ("c", MAR, 3.0))) == 3
    return made


def test_empty_table(spark, tmp_path):
    empty = MonthTable(spark, str(tmp_path / "none"))
    assert empty.read().count() == 0 and empty.last_date() is None and empty.version() == 0
    assert empty.read().schema.fieldNames() == SALES.fieldNames()


def test_update_insert_and_move(spark, table):
    changed = table.upsert(lines(spark, ("b", MAR, 20.0), ("d", JAN, 4.0)))
    assert changed == 2
    # b moved from February to March, so February has to be rewritten as well
    assert content(table) == [("a", JAN, 1.0), ("b", MAR, 20.0), ("c", MAR, 3.0), ("d", JAN, 4.0)]
    assert table.last_date() == MAR
    assert table.span() == (date(2024, 1, 1), date(2024, 3, 31))


def test_upsert_twice_changes_nothing(spark, table):
    source = lines(spark, ("b", FEB, 5.0), ("e", MAR, 6.0))
    table.upsert(source)
    once = content(table)
    table.upsert(source)
    assert content(table) == once


def test_upsert_of_nothing_writes_nothing(spark, table):
    before = table.version()
    assert table.upsert(lines(spark, ("a", JAN, 1.0)).limit(0)) == 0
    assert table.version() == before


def test_tagged_change_is_applied_once(spark, table):
    source = lines(spark, (None, JAN, 9.0))
    assert table.upsert(source, tag="feed:1") == 1
    assert table.upsert(source, tag="feed:1") == 0
    assert len(content(table)) == 4


def test_rows_without_a_key_are_added(spark, table):
    for expected in (4, 5):
        table.upsert(lines(spark, (None, JAN, 9.0)))
        assert table.read().count() == expected


def test_rows_without_a_date(spark, table):
    table.upsert(lines(spark, ("x", None, 7.0)))
    assert table.read().where("sale_date IS NULL").count() == 1
    table.upsert(lines(spark, ("x", JAN, 8.0)))
    assert table.read().where(f"{KEY} = 'x'").select("sale_date", "sale_dollars").collect() == [(JAN, 8.0)]


def test_only_touched_months_are_written(spark, table):
    folders = {(row.sale_year, row.sale_month): row.folder for row in table.month_list()}
    table.upsert(lines(spark, ("b", FEB, 5.0)))
    after = {(row.sale_year, row.sale_month): row.folder for row in table.month_list()}
    assert {m for m in folders if folders[m] != after[m]} == {(2024, 2)}


def test_delete_range(spark, table):
    table.upsert(lines(spark, ("b2", date(2024, 2, 20), 1.0)))
    table.delete_between(date(2024, 2, 1), date(2024, 2, 15))
    assert [row[0] for row in content(table)] == ["a", "b2", "c"]
    table.delete_between(date(2024, 1, 1), date(2024, 12, 31))
    assert content(table) == []


def test_delete_keeps_unknown_dates(spark):
    rows = lines(spark, ("a", JAN, 1.0), ("x", None, 2.0))
    assert [r[0] for r in upsert.delete_range(rows, JAN, JAN).select(KEY).collect()] == ["x"]


def test_readers_keep_their_snapshot(spark, table):
    old = table.read()
    table.upsert(lines(spark, ("a", JAN, 100.0)))
    assert old.where(f"{KEY} = 'a'").first().sale_dollars == 1.0
    assert table.read().where(f"{KEY} = 'a'").first().sale_dollars == 100.0


def test_month_predicate_prunes(spark, table, plan):
    text = plan(table.read().where(month_predicate([(2024, 2)])))
    assert "sale_year" in text.split("PartitionFilters:")[1].split("\n")[0]
    assert len(table.read_between(JAN, JAN).inputFiles()) >= 1
    assert "sale_month" in plan(table.read_between(JAN, JAN)).split("PartitionFilters:")[1].split("\n")[0]


def test_dedup_is_total_and_skew_safe(spark, plan):
    # one key holds a third of the rows, and no key at all another third
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise(F.col("id").cast("string")).alias(KEY),
        (F.col("id") * 7919 % 9000).alias("v"))
    kept = keyed.dedup_by_key(rows, prefer=[F.col("v").desc()])
    text = plan(kept)
    # the limit per key is applied before the shuffle
    assert text.count("WindowGroupLimit") >= 2
    assert kept.count() == 3002
    best = {row[KEY]: row.v for row in kept.where(f"{KEY} = 'hot' OR {KEY} IS NULL").collect()}
    expected = {row[KEY]: row.v for row in rows.groupBy(KEY).agg(F.max("v").alias("v"))
                .where(f"{KEY} = 'hot' OR {KEY} IS NULL").collect()}
    assert best == expected
    again = keyed.dedup_by_key(rows.repartition(13), prefer=[F.col("v").desc()])
    assert kept.exceptAll(again).count() == 0


def test_missing_keys_spread_in_the_anti_join(spark):
    target = spark.range(0, 8000, 1, 8).select(F.lit(None).cast("string").alias(KEY), "id")
    source = spark.createDataFrame([("a", 1), (None, 2)], f"{KEY} string, id bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = upsert.not_in(target, source)
        sizes = kept.groupBy(F.spark_partition_id()).count().collect()
        assert sum(row["count"] for row in sizes) == 8000
        assert len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_variant_column_survives(spark, table):
    row = lines(spark, ("v", JAN, 1.0)).withColumn("store_location", F.parse_json(F.lit('{"a": [1]}')))
    table.upsert(row)
    found = table.read().where(f"{KEY} = 'v'").select(F.to_json("store_location")).first()
    assert found[0] == '{"a":[1]}' and isinstance(table.read().schema["store_location"].dataType, T.VariantType)


def test_upsert_in_slices_and_parts(spark, tmp_path, monkeypatch):
    days = [date(2024, month, 3) for month in (1, 2, 3, 4)]
    old = lines(spark, *[(f"k{i}", days[i % 4], 1.0) for i in range(40)], ("x", None, 7.0))
    new = lines(spark, *[(f"k{i}", days[(i + 1) % 4], 2.0) for i in range(20, 60)], (None, None, 5.0))
    held = MonthTable(spark, str(tmp_path / "held"))
    monkeypatch.setattr("shelfscan.session.SLICE_ROWS", 8)
    monkeypatch.setattr("shelfscan.session.MOST_SLICES", 3)
    assert held.upsert([old.where(f"{KEY} < 'k3'"), old.where(f"{KEY} >= 'k3'")]) == 41
    assert held.upsert(new) == 41
    found = held.read().select(KEY, "sale_date", "sale_dollars").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(f"k{i}", days[i % 4], 1.0) for i in range(20)]
        + [(f"k{i}", days[(i + 1) % 4], 2.0) for i in range(20, 60)]
        + [("x", None, 7.0), (None, None, 5.0)], key=str)
    assert {row.rows for row in held.month_list() if row.sale_year is None} == {2}


def test_unique_rows_in_slices(spark, monkeypatch):
    monkeypatch.setattr("shelfscan.session.SLICE_ROWS", 20)
    rows = lines(spark, *[(f"k{i % 30}", JAN, float(i)) for i in range(90)],
                 *[(None, JAN, float(i)) for i in range(5)])
    scratch = Path(shared_folder(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    unique = keyed.unique_by_key(rows)
    assert unique.select(KEY, "sale_dollars").exceptAll(
        keyed.dedup_by_key(rows).select(KEY, "sale_dollars")).count() == 0
    assert unique.count() == 31
    # what it was made from is gone
    assert [place.name[:6] for place in set(scratch.iterdir()) - before] == ["unique"]


def test_csv_sample_is_compressed(spark, sf_dir):
    from shelfscan.catalog.queries import QUERIES
    scratch = Path(shared_folder(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    assert QUERIES["scan_csv_multiline"](spark, sf_dir).count() > 0
    made = set(scratch.iterdir()) - before
    files = [file.name for place in made for file in place.glob("part-*")]
    assert files and all(name.endswith(".csv.gz") for name in files)
