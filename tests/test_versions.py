"""Versioned tables, commits, and what a run reads and rewrites."""

from __future__ import annotations

import multiprocessing.dummy
from dataclasses import replace
from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import NOW, day, seed_accounts, seed_transactions, write_csv
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_pipeline import TABLES, same

from tallystone.plans import pipeline
from tallystone.plans.pipeline import days_that_may_hold, run_next, run_range
from tallystone.schemas import ACCOUNT_COLUMNS, TRANSACTION_COLUMNS
from tallystone.sources import daily_csv, files, versions
from tallystone.sources.lake import ConcurrentRun, Lake
from tallystone.sources.versions import KEPT, VersionedTable


def table_of(spark, tmp_path, name="t"):
    return VersionedTable(spark, str(tmp_path / name))


def days_frame(spark, *pairs):
    return spark.createDataFrame([(day(d), x) for d, x in pairs], "date date, x long")


def content(frame):
    return sorted((r["date"].day, r["x"]) for r in frame.collect())


def test_a_reader_sees_old_or_new(spark, tmp_path):
    table = table_of(spark, tmp_path)
    assert table.replace_days(days_frame(spark, (1, 1), (2, 2), (2, 3)), [day(1), day(2), day(3)], "a") == {day(1): 1, day(2): 2, day(3): 0}
    before = table.frame()
    table.replace_days(days_frame(spark, (2, 9), (4, 4)), [day(1), day(2), day(4)], "b")
    # The reader that resolved the table before still has its state, whole.
    assert content(before) == [(1, 1), (2, 2), (2, 3)]
    assert content(table.frame()) == [(2, 9), (4, 4)]
    assert content(table.frame([day(4)])) == [(4, 4)] and content(table.frame([day(3)])) == []
    assert table.frame().columns == ["date", "x"]


def test_a_writer_killed_before_the_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.replace(spark.range(3), "a")
    with monkeypatch.context() as m:
        m.setattr(files, "publish_once", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.replace(spark.range(5), "b")
    assert table.frame().count() == 3
    orphans = table.vacuum(older_than_seconds=0)
    assert len(orphans) == 1 and table.frame().count() == 3 and table.vacuum(0) == []


def test_old_folders_go_with_their_manifests(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for i in range(KEPT + 3):
        table.replace_days(days_frame(spark, (1, i)), [day(1)], "a")
        if i == 0:
            table.replace_days(days_frame(spark, (2, 7)), [day(2)], "a")
    assert table.manifests.numbers() == list(range(5, KEPT + 5))
    held = [p for p in (tmp_path / "t").glob("_write=*/date=*")]
    assert len(held) == KEPT + 1 and content(table.frame()) == [(1, KEPT + 2), (2, 7)]


def test_writers_at_once_keep_each_others_days(spark, tmp_path):
    table = table_of(spark, tmp_path)
    with multiprocessing.dummy.Pool(4) as pool:
        pool.map(lambda d: table_of(spark, tmp_path).replace_days(days_frame(spark, (d, d)), [day(d)], "a"), range(1, 5))
    assert content(table.frame()) == [(d, d) for d in range(1, 5)]


def test_a_file_is_published_once(spark, tmp_path):
    path = str(tmp_path / "n" / "1.json")
    with multiprocessing.dummy.Pool(8) as pool:
        won = pool.map(lambda i: files.publish_once(spark, path, f"from {i} é"), range(8))
    assert won.count(True) == 1 and files.read_text(spark, path) == f"from {won.index(True)} é"
    assert [p.name for p in (tmp_path / "n").iterdir()] == ["1.json"]


def test_many_days_are_counted_too(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    monkeypatch.setattr("tallystone.sources.versions.OBSERVED_DAYS", 1)
    rows = days_frame(spark, (1, 1), (2, 2), (2, 3), (4, 4))
    assert table.replace_days(rows, [day(1), day(2), day(3)], "a") == {day(1): 1, day(2): 2, day(3): 0}
    assert content(table.frame()) == [(1, 1), (2, 2), (2, 3)]


def test_of_two_runs_at_once_one_loses(spark, loaded, monkeypatch):
    for i in (7, 8):
        write_csv(Path(loaded.source_dir) / f"transactions_2024-01-{i:02d}.csv", TRANSACTION_COLUMNS, [(f"T{i}-{r[0]}", *r[1:]) for r in seed_transactions(1)])
    real, inner = pipeline._silver_and_gold, []

    def with_another_run(run, *args):
        real(run, *args)
        if not inner:  # while this run is at work, another one does the same day and ends first
            inner.append(None)
            inner[0] = run_next(spark, loaded, run_id="other")

    monkeypatch.setattr(pipeline, "_silver_and_gold", with_another_run)
    lost = run_next(spark, loaded, run_id="first")
    assert inner[0].advanced and inner[0].watermark == day(7)
    assert not lost.advanced and lost.reasons == ["run other has moved the watermark meanwhile"]
    lake = Lake(spark, loaded)
    assert lake.get_watermark() == day(7) and lake.control().first()["updated_by_run_id"] == "other"
    log = lake.run_log().where("run_id = 'first' and status = 'FAILED'").collect()
    assert [r["model_name"] for r in log] == ["watermark"]
    with pytest.raises(ConcurrentRun):
        lake.set_watermark(day(9), "late", NOW, after=1)


def test_a_day_without_repeated_ids_opens_no_other_day(spark, loaded, monkeypatch):
    write_csv(Path(loaded.source_dir) / "transactions_2024-01-07.csv", TRANSACTION_COLUMNS, [(f"N{i}", "ACC-001", "2024-01-07", "5.00", "PURCH01", None, "ONLINE") for i in range(4)])
    opened, real = [], Lake.bronze
    monkeypatch.setattr(Lake, "bronze", lambda self, entity, days=None: (opened.append((entity, days and sorted(days))), real(self, entity, days))[1])
    frames, flags = [], pipeline.classify_transactions
    monkeypatch.setattr(pipeline, "classify_transactions", lambda rows, *a: (frames.append(rows), flags(rows, *a))[1])
    assert run_next(spark, loaded).rewritten == [day(7)]
    assert {tuple(d) for e, d in opened if e == "transactions"} == {(day(7),)}
    (bronze,) = frames
    assert {p.split("date=")[1][:10] for p in bronze.inputFiles()} == {"2024-01-07"}


def test_the_index_names_the_days_that_hold_an_id(spark, loaded):
    lake = Lake(spark, loaded)
    ids = spark.createDataFrame([("T2-1",), ("T5-3",), ("none",), (None,), ("",)], "transaction_id string")
    every = lake.days("bronze/transactions")
    assert days_that_may_hold(lake, ids, every) == [day(2), day(5)]
    assert days_that_may_hold(lake, ids, [day(1), day(5)]) == [day(5)]
    # A day that is loaded anew is indexed anew.
    write_csv(Path(loaded.source_dir) / "transactions_2024-01-02.csv", TRANSACTION_COLUMNS, seed_transactions(2)[1:])
    assert run_range(spark, day(2), day(2), loaded).advanced
    assert days_that_may_hold(lake, ids, every) == [day(5)]


def weeks_written(lake):
    rows = lake.read("gold/weekly_account_summary").groupBy("week_start_date", "_written_run_id").count().collect()
    return {(r["week_start_date"].day, r["_written_run_id"]) for r in rows}


@pytest.mark.parametrize("balance", ["latest", "as_of"])
def test_a_daily_run_rewrites_only_touched_weeks(spark, seeded, tmp_path, balance):
    cfg, source = replace(seeded, balance=balance), Path(seeded.source_dir)

    def deliver(d, rows, accounts):
        write_csv(source / f"transactions_2024-01-{d:02d}.csv", TRANSACTION_COLUMNS, [(f"T{d}-{i}", a, f"2024-01-{t:02d}", "5.00", "PURCH01", None, "ONLINE") for i, (a, t) in enumerate(rows)])
        if accounts:
            write_csv(source / f"accounts_2024-01-{d:02d}.csv", ACCOUNT_COLUMNS, [(a, *seed_accounts(6)[0][1:4], "77.00", *seed_accounts(6)[0][5:]) for a in accounts])

    deliver(7, [("ACC-001", 7)], [])
    deliver(8, [("ACC-002", 8)], ["ACC-002"])
    deliver(9, [("ACC-001", 9), ("ACC-003", 15)], [])
    deliver(10, [("ACC-003", 10)], ["ACC-ORPHAN"])
    lake = Lake(spark, cfg)
    assert run_range(spark, day(1), day(7), cfg, run_id="a").advanced
    assert weeks_written(lake) == {(1, "a")}
    assert run_next(spark, cfg, run_id="b").advanced  # a new week; the balance of ACC-002 on the 8th
    assert weeks_written(lake) == {(1, "b" if balance == "latest" else "a"), (8, "b")}
    assert run_next(spark, cfg, run_id="c").advanced  # no balance came
    assert weeks_written(lake) == {(1, "b" if balance == "latest" else "a"), (8, "c"), (15, "c")}
    # An account that is first seen now: no week of it is there yet, its rows are not resolvable.
    assert run_next(spark, cfg, run_id="d").advanced
    assert weeks_written(lake) == {(1, "b" if balance == "latest" else "a"), (8, "d"), (15, "c")}
    # A day of the first week again: that week only.
    deliver(3, [("ACC-001", 3)], [])
    assert run_range(spark, day(3), day(3), cfg, run_id="e").advanced
    assert weeks_written(lake) == {(1, "e"), (8, "d"), (15, "c")}
    pipeline.run_backfill(spark, cfg, run_id="f")
    fresh = replace(cfg, lake_dir=str(tmp_path / "fresh"))
    assert run_range(spark, day(1), day(10), fresh).advanced
    pipeline.run_backfill(spark, fresh)
    for t in TABLES:
        assert same(lake.read(t), Lake(spark, fresh).read(t)), t


def test_the_source_is_parsed_once(spark, seeded, monkeypatch):
    """A first load has one job that reads CSV rows: the one that writes them."""
    from tallystone.sources import daily_csv
    from tallystone.sources.lake import load_days

    parses, real = [], daily_csv._parsed
    monkeypatch.setattr(daily_csv, "_parsed", lambda *a: (parses.append(a[2]), real(*a))[1])
    counts, read = [], daily_csv.count_rows
    monkeypatch.setattr(daily_csv, "count_rows", lambda *a: (counts.append(a[2]), read(*a))[1])
    done = load_days(spark, "transactions", day(1), day(6), seeded, "r", NOW)
    assert len(parses) == 1 and counts == [[]] and [r[2] for r in sorted(done)] == [5] * 6
    # Nothing is left to see of the audit.
    assert Lake(spark, seeded).read("bronze/transactions").where(F.col("date") == day(1)).columns[-2:] == ["date", "_written_run_id"]


@pytest.mark.parametrize("accounts_on", [(1, 2, 3), (1,)])
def test_a_stream_passes_a_day_with_a_header_only(spark, seeded, tmp_path, accounts_on):
    from tallystone.streaming.drops import stream_next

    source = Path(seeded.source_dir)
    for i in range(1, 7):
        if i > 3:
            (source / f"transactions_2024-01-{i:02d}.csv").unlink()
        if i not in accounts_on:
            (source / f"accounts_2024-01-{i:02d}.csv").unlink()
    write_csv(source / "transactions_2024-01-02.csv", TRANSACTION_COLUMNS, [])
    assert all(r.advanced for r in stream_next(spark, seeded, str(tmp_path / "cp"), files_per_batch=1))
    ranged = replace(seeded, lake_dir=str(tmp_path / "ranged"))
    assert run_range(spark, day(1), day(3), ranged).advanced
    assert Lake(spark, seeded).get_watermark() == Lake(spark, ranged).get_watermark() == day(3)
    assert stream_next(spark, seeded, str(tmp_path / "cp")) == []
    for t in TABLES:
        assert same(Lake(spark, seeded).read(t), Lake(spark, ranged).read(t)), t


def test_source_findings(spark, tmp_path):
    from tallystone.settings import Settings
    from tallystone.sources.audit import changed_sources, source_digests
    from tallystone.sources.files import stage

    cfg, source = Settings(source_dir=str(tmp_path / "source")), tmp_path / "source"
    names = ["same.csv", "edited.csv", "gone.csv", "empty.csv", "odd %2B+ name.csv"]
    for n in names:
        write_csv(source / n, ["a", "b"], [("1", "2\r\n3"), ("x", None)])
    (source / "empty.csv").write_text("")
    before = stage(source_digests(spark, cfg), "before")
    assert {r["finding"] for r in changed_sources(before, source_digests(spark, cfg)).collect()} == {"UNCHANGED"}
    (source / "gone.csv").unlink()
    (source / "empty.csv").write_text("\n")
    (source / "edited.csv").write_text((source / "edited.csv").read_text().replace("x", "y"))
    write_csv(source / "new.csv", ["a"], [])
    found = {r["file"].rsplit("/", 1)[1]: r["finding"] for r in changed_sources(before, source_digests(spark, cfg)).collect()}
    assert found == {"same.csv": "UNCHANGED", "edited.csv": "CHANGED", "gone.csv": "MISSING", "empty.csv": "CHANGED", "odd %2B+ name.csv": "UNCHANGED", "new.csv": "NEW"}


def test_a_backfill_opens_only_days_that_wait(spark, seeded, monkeypatch):
    source = Path(seeded.source_dir)
    for i in (1, 2, 4, 6):  # the account without a delivery is used on the 3rd and 5th only
        write_csv(source / f"transactions_2024-01-{i:02d}.csv", TRANSACTION_COLUMNS, [r for r in seed_transactions(i) if r[1] != "ACC-ORPHAN"])
    write_csv(source / "accounts_2024-01-06.csv", ACCOUNT_COLUMNS, [*seed_accounts(6), ("ACC-ORPHAN", *seed_accounts(6)[0][1:])])
    assert run_range(spark, day(1), day(6), seeded).advanced
    opened, real = [], Lake.read
    monkeypatch.setattr(Lake, "read", lambda self, table, schema=None, days=None: (opened.append((table, days and sorted(days))), real(self, table, schema, days))[1])
    assert pipeline.run_backfill(spark, seeded).rewritten == [day(3), day(5)]
    assert {tuple(d) if d else None for t, d in opened if t == "silver/transactions"} == {(day(3), day(5))}
    assert pipeline.run_backfill(spark, seeded).rewritten == []


def test_equal_tables_compare_digests_only(spark):
    from tallystone.operators.reconcile import equivalence, equivalence_by_digest

    rows = [(day(1 + i % 5), i, None if i % 7 == 0 else f"v{i % 3}") for i in range(200)] + [(None, 1, "x")] * 3
    a = spark.createDataFrame(rows, "date date, x long, y string")
    differing, found = equivalence_by_digest(a, a.orderBy("x"))
    assert differing.isEmpty() and found.isEmpty()
    b = spark.createDataFrame([*rows[1:150], *rows[151:], rows[5], (day(9), 7, ""), (None, 1, "x")], "date date, x long, y string")
    differing, found = equivalence_by_digest(a, b, buckets=16)
    bag = lambda f: sorted(map(repr, f.collect()))
    assert bag(found) == bag(equivalence(a, b)) and len(bag(found)) == 5
    assert 0 < differing.count() <= 5
    # Null and empty are different values, whatever else a row holds.
    one, two = (spark.createDataFrame([(day(1), 1, v)], "date date, x long, y string") for v in (None, ""))
    assert equivalence_by_digest(one, two)[1].count() == 2


def test_days_are_written_at_once_without_a_sort(spark, tmp_path, monkeypatch):
    name, seen, real = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(spark.conf.get(name)), real(self, path))[1])
    before = spark.conf.get(name)
    rows = spark.range(0, 3000, 1, 2).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("date"))
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(30)]
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.replace_days(rows, days, "r") == dict.fromkeys(days, 100)
    assert seen == [str(versions.OPEN_DAYS)] and int(seen[0]) > int(before) and spark.conf.get(name) == before
    assert sorted(map(tuple, table.frame().collect())) == sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize(("path", "name"), [
    ("file:///s/transactions_2024-01-02.csv", "transactions_2024-01-02.csv"),
    ("file:///s/transactions_2024-01-02.csv/part-0.csv", "transactions_2024-01-02.csv"),
    ("file:///s/transactions_2024-01-02.csv/transactions_2024-01-09.csv", "transactions_2024-01-02.csv"),
    ("file:///s/transactions_2024-01-02.csv/a=1/part-0.csv", "transactions_2024-01-02.csv"),
    ("file:///transactions_deliveries.csv/transactions_2024-01-02.csv", "transactions_2024-01-02.csv"),
])
def test_the_delivery_of_a_file(spark, path, name):
    got = spark.range(1).select(*daily_csv._name_and_day(F.lit(path), "transactions")).first()
    assert tuple(got) == (name, date(2024, 1, 2))
