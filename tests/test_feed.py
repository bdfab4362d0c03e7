from datetime import date
import json

from pyspark.sql import functions as F
import pytest

from shelfscan.operators.months import MonthTable
from shelfscan.plans.loads import (
    Store, fetch_to_landing, load_from_landing, load_latest, replay_month,
)
from shelfscan.plans.schedule import month_gap, plan_months
from shelfscan.schemas import KEY, LANDING_KEYS
from shelfscan.streaming import feed

from tests.test_landing import document, put

AS_OF = date(2024, 4, 20)


def documents(spark, *docs):
    rows = [tuple(doc.get(key) for key in LANDING_KEYS) for doc in docs]
    return spark.createDataFrame(rows, ", ".join(f"{key} string" for key in LANDING_KEYS))


def raw_rows(spark, *docs, stamp="2024-05-01 00:00:00", file="page_1"):
    frame = spark.createDataFrame([(json.dumps(doc),) for doc in docs], "text string")
    return frame.select(
        F.parse_json("text").alias("raw"), F.lit(file).alias("file_name"),
        F.lit(stamp).cast("timestamp_ntz").alias("load_ts"))


def keys(table):
    return sorted(row[KEY] or "" for row in table.read().select(KEY).collect())


def test_last_loaded_wins(spark):
    early = raw_rows(spark, document(1, sale_dollars="99"), document(2, sale_dollars="1"))
    late = raw_rows(spark, document(1, sale_dollars="5"), stamp="2024-05-02 00:00:00")
    other_file = raw_rows(spark, document(2, sale_dollars="0.5"), file="page_2")
    rows = feed.newest_per_key(early.unionByName(late).unionByName(other_file)).collect()
    assert {row[KEY]: row.sale_dollars for row in rows} == {"INV-1": 5.0, "INV-2": 0.5}


def test_stream_reads_only_added_rows(spark, tmp_path):
    raw, table = str(tmp_path / "raw"), MonthTable(spark, str(tmp_path / "sales"))
    options = dict(checkpoint=str(tmp_path / "check"), quarantine=str(tmp_path / "aside"))
    raw_rows(spark, document(1), document(2)).write.mode("append").parquet(raw)
    assert feed.stream_upsert(spark, raw, table, **options) == 2
    version = table.version()
    assert feed.stream_upsert(spark, raw, table, **options) == 0
    assert table.version() == version
    raw_rows(spark, document(2, sale_dollars="7"), document(3)).write.mode("append").parquet(raw)
    assert feed.stream_upsert(spark, raw, table, **options) == 2
    assert keys(table) == ["INV-1", "INV-2", "INV-3"]
    assert table.read().where(f"{KEY} = 'INV-2'").first().sale_dollars == 7.0


def test_backlog_in_several_batches(spark, tmp_path):
    raw, table = str(tmp_path / "raw"), MonthTable(spark, str(tmp_path / "sales"))
    for number in range(4):
        raw_rows(spark, document(number % 3, sale_dollars=str(number)),
                 stamp=f"2024-05-0{number + 1} 00:00:00").coalesce(1).write.mode("append").parquet(raw)
    merged = feed.stream_upsert(
        spark, raw, table, str(tmp_path / "check"), max_files=1, quarantine=str(tmp_path / "aside"))
    assert merged == 4 and keys(table) == ["INV-0", "INV-1", "INV-2"]
    assert table.version() == 4


def test_streams_with_checkpoints_of_their_own_share_a_table(spark, tmp_path):
    table, aside = MonthTable(spark, str(tmp_path / "sales")), str(tmp_path / "aside")
    for number, name in enumerate(("a", "b")):
        raw_rows(spark, document(number)).write.parquet(str(tmp_path / name))
        assert feed.stream_upsert(
            spark, str(tmp_path / name), table, str(tmp_path / f"check-{name}"), quarantine=aside) == 1
    # a lost checkpoint: everything is read again, new rows come with it
    raw_rows(spark, document(7)).write.mode("append").parquet(str(tmp_path / "a"))
    assert feed.stream_upsert(
        spark, str(tmp_path / "a"), table, str(tmp_path / "check-new"), quarantine=aside) == 2
    assert keys(table) == ["INV-0", "INV-1", "INV-7"]


def test_all_batches_are_counted(spark, tmp_path):
    for number in range(4):
        folder = tmp_path / "in" / "year=2024" / f"month=0{number + 1}"
        folder.mkdir(parents=True)
        (folder / "page.jsonl").write_text(json.dumps(document(number)) + "\n{broken\n\n")
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    try:
        n = feed.stream_landing(spark, str(tmp_path / "in"), str(tmp_path / "raw"),
                                str(tmp_path / "check"), max_files=1)
        assert spark.conf.get(kept) == "2"
    finally:
        spark.conf.set(kept, before)
    assert n == 4 == spark.read.parquet(str(tmp_path / "raw")).count()


def test_failed_batch_is_read_again(spark, tmp_path, monkeypatch):
    raw, table = str(tmp_path / "raw"), MonthTable(spark, str(tmp_path / "sales"))
    options = dict(checkpoint=str(tmp_path / "check"), quarantine=str(tmp_path / "aside"))
    raw_rows(spark, document(1)).write.parquet(raw)
    with monkeypatch.context() as patch:
        patch.setattr(MonthTable, "upsert", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception):
            feed.stream_upsert(spark, raw, table, **options)
    assert feed.stream_upsert(spark, raw, table, **options) == 1
    assert keys(table) == ["INV-1"]


def test_repeated_batch_quarantines_its_rows_once(spark, tmp_path, monkeypatch):
    """The batch fails after its quarantine was written, and is run again."""
    raw, table = str(tmp_path / "raw"), MonthTable(spark, str(tmp_path / "sales"))
    aside = str(tmp_path / "aside")
    options = dict(checkpoint=str(tmp_path / "check"), quarantine=aside)
    raw_rows(spark, document(1), {"store": "1"}, {"store": "1"}).write.parquet(raw)
    with monkeypatch.context() as patch:
        patch.setattr(MonthTable, "upsert", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception):
            feed.stream_upsert(spark, raw, table, **options)
    assert spark.read.parquet(aside).count() == 2
    assert feed.stream_upsert(spark, raw, table, **options) == 1
    assert spark.read.parquet(aside).count() == 2
    raw_rows(spark, {"store": "2"}).write.mode("append").parquet(raw)
    assert feed.stream_upsert(spark, raw, table, **options) == 0
    assert spark.read.parquet(aside).count() == 3


def test_rows_without_a_key(spark, tmp_path):
    raw = raw_rows(spark, document(1), {"date": "2024-01-05T00:00:00.000", "store": "1"})
    aside = str(tmp_path / "aside")
    quarantined = MonthTable(spark, str(tmp_path / "one"))
    feed.apply_batch(raw, quarantined, quarantine=aside)
    assert keys(quarantined) == ["INV-1"]
    assert spark.read.parquet(aside).count() == 1
    inserted = MonthTable(spark, str(tmp_path / "two"))
    feed.apply_batch(raw, inserted, null_keys="insert")
    assert keys(inserted) == ["", "INV-1"]
    with pytest.raises(ValueError):
        feed.apply_batch(raw, MonthTable(spark, str(tmp_path / "three")))


def test_lenient_load_keeps_misfits_visible(spark, tmp_path):
    raw = raw_rows(spark, document(1, pack="x"), document(2))
    table = MonthTable(spark, str(tmp_path / "sales"))
    feed.apply_batch(raw, table, quarantine=str(tmp_path / "aside"), strict=False)
    assert keys(table) == ["INV-1", "INV-2"]
    assert spark.read.parquet(str(tmp_path / "aside")).count() == 1


def test_load_by_month(spark, tmp_path):
    store = Store(str(tmp_path))
    for month in (1, 2, 3):
        put(tmp_path / "landing", "page_1.jsonl", [document(month, day=f"2024-0{month}-05")], month=month)
    report = load_from_landing(spark, store, months=["2024-02", "bad"], as_of=AS_OF)
    assert report.months == [(2024, 2)] and report.files == 1
    assert keys(store.sales(spark)) == ["INV-2"]
    assert load_from_landing(spark, store, years=[2024], as_of=AS_OF).files == 2
    assert keys(store.sales(spark)) == ["INV-1", "INV-2", "INV-3"]
    assert load_from_landing(spark, store).message == "no new rows"


def test_load_latest_and_replay(spark, tmp_path):
    store = Store(str(tmp_path))
    source = documents(spark, *[
        document(f"{month}-{n}", day=f"2024-{month:02d}-{n + 1:02d}") for month in range(1, 5) for n in range(3)])
    assert fetch_to_landing(spark, source, store, months=["2024-01"], as_of=AS_OF) == [(2024, 1)]
    load_from_landing(spark, store)
    asked = []

    def api(labels):
        asked.extend(labels)
        return source

    report = load_latest(spark, store, feed=api, as_of=AS_OF)
    # April is not over on the day of the load
    assert asked == ["2024-02", "2024-03"] and report.rows == 6
    assert store.sales(spark).read().count() == 9
    again = load_latest(spark, store, feed=api, as_of=AS_OF)
    assert again.rows == 0 and "up to date" in again.message
    counts = [tuple(row) for row in replay_month(spark, store, (2024, 2)).collect()]
    assert counts == [("before", 3), ("after_delete", 0), ("after_reload", 3)]
    assert store.sales(spark).read().count() == 9


def test_replay_that_fails_changes_nothing(spark, tmp_path):
    store = Store(str(tmp_path))
    put(tmp_path / "landing", "page_1.jsonl", [document(1), document(2), {"date": "2024-01-06", "store": "1"}])
    load_from_landing(spark, store)
    table, aside = store.sales(spark), spark.read.parquet(store.quarantine).count()
    before, version = keys(table), table.version()
    counts = [row.rows for row in replay_month(spark, store, (2024, 1)).collect()]
    assert counts == [2, 0, 2] and keys(table) == before and table.version() == version + 1
    # a page that does not fit comes in: the reload fails before anything is written
    put(tmp_path / "landing", "page_2.jsonl", [document(3, pack="x")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        replay_month(spark, store, (2024, 1))
    assert keys(table) == before and table.version() == version + 1
    assert [row.rows for row in replay_month(spark, store, (2024, 1), strict=False).collect()] == [2, 0, 3]
    assert spark.read.parquet(store.quarantine).count() == aside == 1


def test_loads_report_and_force(spark, tmp_path):
    store = Store(str(tmp_path))
    put(tmp_path / "landing", "page_1.jsonl", [document(1), "{broken", document(2, date=None)])
    report = load_from_landing(spark, store)
    assert (report.files, report.rows, report.rejected, report.undated) == (1, 2, 1, 1)
    assert spark.read.parquet(store.rejects).first().line == "{broken"
    assert load_from_landing(spark, store).files == 0
    again = load_from_landing(spark, store, force=True)
    assert (again.files, again.rows, again.rejected) == (1, 2, 1)
    source = documents(spark, document(5, day="2024-03-01"), document(6, day="whenever"))
    fetch_to_landing(spark, source, store, months=["2024-03"], as_of=AS_OF)
    assert spark.read.parquet(store.undated).first().invoice_line_no == "INV-6"


def test_plan_months(spark):
    def plan(**request):
        return plan_months(spark, as_of=AS_OF, **request)

    labels = ["2024-03", "2024-01", "2024-01", "2024", "2024-13", "2024-00", "2011-12", "x-y",
              "2024-01-01", "2024-04", "2030-01", "2023-5"]
    assert plan(months=labels) == [(2023, 5), (2024, 1), (2024, 3)]
    assert plan(months=["2024-02"], years=[2023]) == [(2024, 2)]
    assert plan() == [(2024, 1), (2024, 2), (2024, 3)]
    assert plan(years=[2023, 2023, 2011]) == [(2023, month) for month in range(1, 13)]
    for request in ({"months": ["2030-01"]}, {"years": [1999]}):
        with pytest.raises(ValueError):
            plan(**request)


def test_month_gap(spark):
    def gap(days, **options):
        rows = spark.createDataFrame([(day,) for day in days], "sale_date date")
        return [row.label for row in month_gap(rows, date(2024, 3, 1), first_year=2023, **options).collect()]

    assert gap([date(2023, 12, 31)]) == ["2024-01", "2024-02", "2024-03"]
    assert gap([date(2024, 3, 2)]) == []
    assert gap([date(2024, 5, 2)]) == []
    assert len(gap([])) == 15 and gap([])[0] == "2023-01"
    assert gap([date(2023, 1, 5), date(2024, 2, 1)], fill_holes=True) == [
        *[f"2023-{month:02d}" for month in range(2, 13)], "2024-01", "2024-03"]


def test_batch_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shelfscan.session.SLICE_ROWS", 10)
    docs = [document(i % 25, day=f"2024-0{i % 3 + 1}-05", sale_dollars=str(i)) for i in range(75)]
    first = raw_rows(spark, *docs)
    assert len(feed.newest_in_slices(first, 75)) == 7
    table = MonthTable(spark, str(tmp_path / "sales"))
    assert feed.apply_batch(first, table) == 25
    whole = feed.newest_per_key(first).select(KEY, "sale_date", "sale_dollars")
    found = table.read().select(KEY, "sale_date", "sale_dollars")
    assert found.count() == 25 and found.exceptAll(whole).count() == 0
