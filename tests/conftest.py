from __future__ import annotations

import csv
import shutil
import sys
from datetime import date, datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallystone.schemas import ACCOUNT_COLUMNS, CODE_COLUMNS, TRANSACTION_COLUMNS
from tallystone.session import build_session
from tallystone.settings import Settings

NOW = datetime(2024, 2, 1, 6, 0, tzinfo=timezone.utc)

CODES = [
    ("PURCH01", "Purchase", "DR", "PURCHASE", "true"),
    ("PAY01", "Payment", "CR", "PAYMENT", "true"),
    ("FEE01", "Annual Fee", "DR", "FEE", "true"),
    ("INT01", "Interest Charge", "DR", "INTEREST", "true"),
]

# Six days: three good rows each as (account, code, amount, channel).
GOOD = {
    1: [("1", "PURCH01", "50.00", "ONLINE"), ("2", "PURCH01", "120.00", "IN_STORE"), ("1", "PAY01", "200.00", "ONLINE")],
    2: [("1", "PURCH01", "85.00", "ONLINE"), ("3", "PAY01", "300.00", "ONLINE"), ("2", "PURCH01", "45.00", "IN_STORE")],
    3: [("2", "PAY01", "500.00", "ONLINE"), ("3", "PURCH01", "95.00", "IN_STORE"), ("1", "INT01", "30.00", "ONLINE")],
    4: [("1", "PURCH01", "175.00", "ONLINE"), ("2", "PURCH01", "65.00", "IN_STORE"), ("3", "PAY01", "400.00", "ONLINE")],
    5: [("3", "PURCH01", "55.00", "ONLINE"), ("1", "PAY01", "800.00", "ONLINE"), ("2", "PURCH01", "35.00", "IN_STORE")],
    6: [("1", "PURCH01", "220.00", "ONLINE"), ("3", "PURCH01", "150.00", "IN_STORE"), ("2", "PAY01", "600.00", "ONLINE")],
}
BALANCES = {
    "1": ["1200.00", "1150.00", "1300.00", "1250.00", "1200.00", "1350.00"],
    "2": ["850.00", "730.00", "630.00", "580.00", "530.00", "480.00"],
    "3": [None, "2000.00", "1950.00", "1900.00", "1850.00", "1800.00"],
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_csv(path: Path, header: list[str], rows) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows([["" if v is None else v for v in r] for r in rows])


def seed_transactions(day: int) -> list[tuple]:
    text = f"2024-01-{day:02d}"
    rows = [
        (f"T{day}-{i}", f"ACC-00{a}", text, amount, code, None if code == "PAY01" else "Shop", channel)
        for i, (a, code, amount, channel) in enumerate(GOOD[day], 1)
    ]
    rows.append((f"T{day}-4", "ACC-ORPHAN", text, "70.00", "PURCH01", "Shop", "IN_STORE"))
    rows.append((f"T{day}-5", "ACC-001", text, "15.00", "PURCH01", "Shop", "DRIVE_THRU"))
    return rows


def seed_accounts(day: int) -> list[tuple]:
    return [
        (f"ACC-00{a}", f"Holder {a}", "ACTIVE", "5000.00", b[day - 1], "2020-01-15", "2024-01-01", "2024-01-31")
        for a, b in BALANCES.items()
        if b[day - 1]
    ]


def write_seed(folder: Path, days=range(1, 7)) -> None:
    write_csv(folder / "transaction_codes.csv", CODE_COLUMNS, CODES)
    for day in days:
        write_csv(folder / f"transactions_2024-01-{day:02d}.csv", TRANSACTION_COLUMNS, seed_transactions(day))
        write_csv(folder / f"accounts_2024-01-{day:02d}.csv", ACCOUNT_COLUMNS, seed_accounts(day))


@pytest.fixture
def seeded(tmp_path) -> Settings:
    write_seed(tmp_path / "source")
    return Settings(source_dir=str(tmp_path / "source"), lake_dir=str(tmp_path / "lake"))


def day(number: int) -> date:
    return date(2024, 1, number)


@pytest.fixture(scope="session")
def base_lake(spark, tmp_path_factory) -> Path:
    """Source files and a lake with all six days loaded."""
    from tallystone.plans.pipeline import run_range

    root = tmp_path_factory.mktemp("base")
    write_seed(root / "source")
    cfg = Settings(source_dir=str(root / "source"), lake_dir=str(root / "lake"))
    assert run_range(spark, day(1), day(6), cfg).advanced
    return root


@pytest.fixture
def loaded(base_lake, tmp_path) -> Settings:
    """A private copy of the loaded lake."""
    shutil.copytree(base_lake, tmp_path / "copy")
    return Settings(source_dir=str(tmp_path / "copy/source"), lake_dir=str(tmp_path / "copy/lake"))
