"""The weekly account summary as a maintained view: a run rewrites only the weeks it touches.

The view remembers what it was made of: the write of each day's cube with the weeks in it, the writes of
the account deliveries, and the codes. From what is different now follow the weeks that may be
different: those of cubes that came, changed or went, and those in which an account has rows whose
balance came since. A balance as of the week's end changes the weeks that end on or after the day of
its delivery, and those before the account was first seen, which show its newest balance; the latest
balance changes all weeks of its account. Changed codes or account days that were delivered anew
make the view from scratch. A refresh that is cut off is simply repeated: what the view was made of is
written after it.
"""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions import week_end
from tallystone.operators.gold import weekly_from_cube
from tallystone.settings import Settings
from tallystone.sources.lake import WRITER, Lake

VIEW, CUBE, SOURCES = "gold/weekly_account_summary", "gold/weekly_cube", "pipeline/weekly_sources"
SOURCES_SCHEMA = "source string, date date, made_of string, weeks array<date>"
KNOWN = "pipeline/known_accounts"


def _codes_digest(codes: DataFrame, cfg: Settings) -> str:
    """One text for the codes and how balances are taken; there is a row per code."""
    rows = codes.select("transaction_code", "transaction_type").collect()
    return hashlib.sha256(repr([cfg.balance, sorted((str(a), str(b)) for a, b in rows)]).encode()).hexdigest()


def weeks_of_balances(cube: DataFrame, delta: DataFrame, known: DataFrame, cfg: Settings) -> DataFrame:
    """The weeks of the cube that new balances change: delta has account_id and the day's date."""
    came = delta.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(F.min("date").alias("_came"))
    held = cube.select("account_id", "week_start_date").distinct().join(came, "account_id")
    if cfg.balance == "as_of":
        held = held.join(known.select("account_id", "_first_seen"), "account_id")
        ends = week_end(F.col("week_start_date"))
        held = held.where((ends >= F.col("_came")) | (ends < F.col("_first_seen")))
    return held.select("week_start_date").distinct()


def touched_weeks(lake: Lake, codes: DataFrame, cfg: Settings) -> tuple[set[date] | None, list[tuple]]:
    """The weeks to rewrite (None: all), and what the view will have been made of then."""
    held = {(r["source"], r["date"]): r for r in lake.read(SOURCES, SOURCES_SCHEMA).collect()}
    cubes, accounts = lake.day_writes(CUBE), {d: w for d, w in lake.day_writes("bronze/accounts").items() if w}
    before = {s: {d: r["made_of"] for (source, d), r in held.items() if source == s} for s in ("cube", "accounts", "codes")}
    changed = sorted(d for d, w in cubes.items() if before["cube"].get(d) != w)
    weeks: dict[date, list[date]] = {d: held["cube", d]["weeks"] for d in cubes if d not in changed}
    weeks |= {d: [] for d in changed}
    if any(cubes[d] for d in changed):  # a row per day and week
        for r in lake.read(CUBE, days=changed).select("date", "week_start_date").distinct().collect():
            weeks[r["date"]].append(r["week_start_date"])
    digest = _codes_digest(codes, cfg)
    made_of = [("codes", None, digest, None)]
    made_of += [("accounts", d, w, None) for d, w in accounts.items()]
    made_of += [("cube", d, w, weeks[d]) for d, w in cubes.items()]
    rebuilt = not held or not lake.has(VIEW) or before["codes"] != {None: digest}
    if rebuilt or any(accounts.get(d) != w for d, w in before["accounts"].items()):
        return None, made_of
    gone = [d for d in before["cube"] if cubes.get(d) != before["cube"][d]]
    touched = {w for d in gone for w in held["cube", d]["weeks"]} | {w for d in changed for w in weeks[d]}
    new = sorted(set(accounts) - set(before["accounts"]))
    if new:
        delta = lake.bronze("accounts", new).select("account_id", "date")
        late = weeks_of_balances(lake.read(CUBE), delta, lake.read(KNOWN), cfg)
        touched |= {r["week_start_date"] for r in late.collect()}
    return touched, made_of


def refresh_weekly(lake: Lake, codes: DataFrame, run_id: str, now: datetime, cfg: Settings) -> int:
    """Rewrite the weeks that changed; returns the rows of the whole view."""
    touched, made_of = touched_weeks(lake, codes, cfg)
    cube = lake.read(CUBE)
    everything = sorted({w for source, _, _, weeks in made_of if source == "cube" for w in weeks} | set(lake.known_days(VIEW)))
    weeks = everything if touched is None else sorted(touched)
    if weeks:
        if touched is not None:
            cube = cube.where(F.col("week_start_date").isin(weeks))
        rows = weekly_from_cube(cube, codes, lake.read("silver/accounts"), now, cfg, bronze_accounts=lake.bronze("accounts"))
        rows = rows.withColumn("date", F.col("week_start_date")).hint("rebalance", "date")
        lake.replace_days(rows, VIEW, weeks, run_id, shown=False)
    sources = lake.spark.createDataFrame(made_of, SOURCES_SCHEMA)
    lake.replace_table(sources.coalesce(1), SOURCES, run_id)
    return sum(x["rows"] for x in lake.table(VIEW).parts().values())
