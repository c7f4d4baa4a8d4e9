"""CSV deliveries and the lake's small tables."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from conftest import NOW, day, seed_transactions, write_csv
from pyspark.sql import functions as F

from tallystone.schemas import TRANSACTION_COLUMNS
from tallystone.settings import Settings
from tallystone.sources import daily_csv, files
from tallystone.sources.daily_csv import find_deliveries, header_error, ingest_daily_csv
from tallystone.sources.lake import Lake, date_spine, load_idempotent


def put(folder: Path, name: str, text: str) -> None:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


HEADER = ",".join(TRANSACTION_COLUMNS) + "\n"


@pytest.fixture
def cfg(tmp_path):
    (tmp_path / "source").mkdir()
    return Settings(source_dir=str(tmp_path / "source"), lake_dir=str(tmp_path / "lake"))


def ingest(spark, cfg, first=1, last=6):
    return ingest_daily_csv(spark, "transactions", day(first), day(last), cfg, "run", NOW)


def test_values_stay_as_received(spark, cfg, tmp_path):
    put(tmp_path / "source", "transactions_2024-01-01.csv", HEADER + (
        't1,a,2024-01-01,1.50,P,"Joe ""Big"", Ltd",ONLINE\n'
        "t2,a,2024-01-01,1e3,P,C:\\dir\\,ONLINE\n"
        "t3,a,2024-01-01, 5 ,P,,ONLINE\n"
        't4,a,2024-01-01,"",P,N/A,ONLINE\n'
        "\n"
        "t5,a,2024-01-01,007,P,Zoë,ONLINE\n"
    ))
    rows = {r["transaction_id"]: r for r in ingest(spark, cfg).collect()}
    assert {k: (r["amount"], r["merchant_name"]) for k, r in rows.items()} == {
        "t1": ("1.50", 'Joe "Big", Ltd'), "t2": ("1e3", "C:\\dir\\"), "t3": (" 5 ", None),
        "t4": (None, "N/A"), "t5": ("007", "Zoë"),
    }
    one = rows["t1"]
    assert (one["_source_file"], one["date"], one["_pipeline_run_id"]) == ("transactions_2024-01-01.csv", day(1), "run")


def test_line_breaks_inside_values(spark, cfg, tmp_path):
    put(tmp_path / "source", "transactions_2024-01-01.csv", HEADER + 't1,a,2024-01-01,1,P,"two\nlines",ONLINE\n')
    rows = ingest(spark, replace(cfg, multiline_csv=True)).collect()
    assert [r["merchant_name"] for r in rows] == ["two\nlines"]


def test_folder_of_part_files_is_one_delivery(spark, cfg, tmp_path):
    drop = tmp_path / "source" / "transactions_2024-01-02.csv"
    write_csv(drop / "part-0.csv", TRANSACTION_COLUMNS, seed_transactions(2)[:2])
    write_csv(drop / "part-1.csv", TRANSACTION_COLUMNS, seed_transactions(2)[2:])
    rows = ingest(spark, cfg).collect()
    assert len(rows) == 5 and {r["_source_file"] for r in rows} == {"transactions_2024-01-02.csv"}
    turned = list(reversed(TRANSACTION_COLUMNS))
    write_csv(drop / "part-2.csv", turned, [tuple(reversed(r)) for r in seed_transactions(2)])
    with pytest.raises(Exception):
        ingest(spark, cfg).collect()


def test_only_well_named_files_in_range_are_found(spark, cfg, tmp_path):
    for name in ("transactions_2024-01-02.csv", "transactions_2024-01-09.csv", "transactions_2024-13-01.csv",
                 "transactions_latest.csv", "old_transactions_2024-01-03.csv"):
        put(tmp_path / "source", name, HEADER)
    found = find_deliveries(spark, "transactions", day(1), day(6), cfg)
    assert [d.day for d in found] == [day(2)]


def test_header_must_hold_exactly_the_expected_names():
    names = tuple(TRANSACTION_COLUMNS)
    assert header_error("transactions", names) is None
    assert header_error("transactions", tuple(reversed(names))) is None
    assert "no column channel" in header_error("transactions", names[:-1])
    assert "unknown column more" in header_error("transactions", (*names, "more"))
    assert "channel is there 2 times" in header_error("transactions", (*names, "channel"))
    assert header_error("transactions", ()) is not None


def test_a_row_with_too_many_fields_fails_its_day(spark, cfg, tmp_path):
    rows = [f"T{i},A,2024-01-01,5.00,PURCH01,Shop,ONLINE" for i in range(3)]
    quoted = 'T9,A,2024-01-01,5.00,PURCH01,"Shop, ""the"" Inc",ONLINE'
    short = "T8,A,2024-01-01,5.00"
    put(tmp_path / "source", "transactions_2024-01-01.csv", HEADER + "\n".join([*rows, quoted, short]) + "\n")
    for n, where in ((2, 0), (3, 1), (4, 3)):
        bad = [*rows]
        bad.insert(where, "T7,A,2024-01-01,5.00,PURCH01,Shop, Inc,ONLINE")
        put(tmp_path / "source", f"transactions_2024-01-{n:02d}.csv", HEADER + "\n".join(bad) + "\n")
    put(tmp_path / "source", "transactions_2024-01-05.csv", HEADER + rows[0] + ",\n")
    done = {r["date"]: r for r in load_idempotent(spark, "transactions", day(1), day(5), cfg, "r", NOW).collect()}
    assert [done[day(n)]["status"] for n in range(1, 6)] == ["SUCCESS", "FAILED", "FAILED", "FAILED", "FAILED"]
    assert "more fields" in done[day(2)]["error_message"]
    held = Lake(spark, cfg).bronze("transactions").collect()
    assert len(held) == 5 and {r["date"] for r in held} == {day(1)}
    assert next(r for r in held if r["transaction_id"] == "T9")["merchant_name"] == 'Shop, "the" Inc'
    assert next(r for r in held if r["transaction_id"] == "T8")["channel"] is None


def test_empty_and_header_only_files(spark, cfg, tmp_path):
    put(tmp_path / "source", "transactions_2024-01-01.csv", HEADER)
    put(tmp_path / "source", "transactions_2024-01-02.csv", "")
    rows = load_idempotent(spark, "transactions", day(1), day(3), cfg, "r", NOW).orderBy("date").collect()
    assert [(r["status"], r["records_written"]) for r in rows] == [("SUCCESS", 0), ("FAILED", None), ("SKIPPED", None)]


def test_source_is_never_written(spark, loaded):
    before = {p: p.stat().st_mtime_ns for p in Path(loaded.source_dir).rglob("*")}
    load_idempotent(spark, "transactions", day(1), day(6), loaded, "r", NOW).collect()
    assert before == {p: p.stat().st_mtime_ns for p in Path(loaded.source_dir).rglob("*")}


def test_date_spine_is_ascending_and_inclusive(spark):
    days = [r["date"] for r in date_spine(spark, day(28), day(31)).collect()]
    assert days == [day(d) for d in (28, 29, 30, 31)]


def test_run_log_only_grows(spark, cfg):
    lake = Lake(spark, cfg)
    assert lake.run_log().count() == 0 and lake.get_watermark() is None and lake.get_next_date() is None
    entry = {"run_id": "a", "layer": "GOLD", "status": "FAILED", "records_rejected": 4, "error_message": "/app\\x" + "y" * 600}
    lake.append_run_log([entry])
    lake.append_run_log([{**entry, "run_id": "b", "status": "SUCCESS", "layer": "SILVER"}])
    rows = {r["run_id"]: r for r in lake.run_log().collect()}
    assert rows["a"]["records_rejected"] is None and rows["a"]["error_message"] == "appx" + "y" * 600
    assert rows["b"]["records_rejected"] == 4 and rows["b"]["error_message"] is None


def test_staged_frames_are_removed_after_the_block(spark):
    with files.staged_for_now(spark):
        df = files.stage(spark.range(3).withColumn("x", F.lit("a")), "t")
        folder = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 3 and files.exists(spark, folder)
    assert not files.exists(spark, folder)


def test_watermark_keeps_the_newest_row(spark, cfg):
    lake = Lake(spark, cfg)
    lake.set_watermark(day(3), "a", NOW)
    lake.set_watermark(day(5), "b", NOW.replace(year=2025))
    assert lake.control().count() == 1
    row = lake.control().first()
    assert (row["last_processed_date"], row["updated_by_run_id"]) == (day(5), "b")
    assert lake.get_next_date() == day(6)


@pytest.fixture
def tiny_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "200")
    spark.conf.set(names[1], "0")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_values_with_line_breaks_are_split_between_records(spark, cfg, tmp_path, tiny_blocks):
    import csv
    import io
    import random

    rng, columns = random.Random(4), HEADER.strip().split(",")
    multi = replace(cfg, multiline_csv=True)
    for n, ending in ((1, "\n"), (2, "\r\n"), (3, "\n")):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=ending)
        writer.writerow(columns)
        for i in range(40):
            shop = "".join(rng.choices(["x", '"', "\n", ",", "\r\n", "é", " ", "l" * 90 + "\n"], k=rng.randint(0, 8)))
            writer.writerow([f"T{n}-{i}", "A", f"2024-01-{n:02d}", "5.00", "PURCH01", shop, rng.choice(["ONLINE", ""])])
        put(tmp_path / "source", f"transactions_2024-01-{n:02d}.csv", out.getvalue())
    # Quotes inside an unquoted value: parity would mislead.
    put(tmp_path / "source", "transactions_2024-01-04.csv", HEADER + 'T4,A,2024-01-04,5.00,PURCH01,5" pipe,ONLINE\n' * 3)
    put(tmp_path / "source", "transactions_2024-01-05.csv", HEADER + 'T5,A,2024-01-05,5.00,PURCH01,"a\nb", and more,ONLINE\n')
    found = daily_csv.check_headers(spark, "transactions", daily_csv.find_deliveries(spark, "transactions", day(1), day(5), multi), multi)
    whole = daily_csv.read_audited(spark, "transactions", found, multi, whole=True)
    split = daily_csv.read_audited(spark, "transactions", found, multi)
    plain = lambda rows: sorted(repr([r[c] for c in columns]) for r in rows.where("date <= '2024-01-03'").collect())
    assert plain(split) == plain(whole) and len(plain(split)) == 120
    assert {r["date"] for r in split.where("_loose_quotes").collect()} >= {day(4)}
    done = {r["date"]: (r["status"], r["records_written"]) for r in load_idempotent(spark, "transactions", day(1), day(5), multi, "r", NOW).collect()}
    assert done == {day(1): ("SUCCESS", 40), day(2): ("SUCCESS", 40), day(3): ("SUCCESS", 40), day(4): ("SUCCESS", 3), day(5): ("FAILED", None)}
    assert {r["merchant_name"] for r in Lake(spark, cfg).bronze("transactions", [day(4)]).collect()} == {'5" pipe'}
    again = load_idempotent(spark, "transactions", day(1), day(5), replace(multi, verify="checksum"), "r2", NOW).collect()
    assert {r["status"] for r in again if r["date"] != day(5)} == {"SUCCESS"}
    assert {r["_pipeline_run_id"] for r in Lake(spark, cfg).bronze("transactions").collect()} == {"r"}


def test_a_part_with_another_header_fails_when_split(spark, cfg, tmp_path):
    folder = tmp_path / "source" / "transactions_2024-01-01.csv"
    folder.mkdir(parents=True)
    row = 'T1,A,2024-01-01,5.00,PURCH01,"a\nb",ONLINE\n'
    (folder / "part-0.csv").write_text(HEADER + row)
    (folder / "part-1.csv").write_text(HEADER.replace("account_id,transaction_date", "transaction_date,account_id") + row)
    with pytest.raises(Exception, match="another header"):
        load_idempotent(spark, "transactions", day(1), day(1), replace(cfg, multiline_csv=True), "r", NOW).collect()
