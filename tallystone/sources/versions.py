"""Tables that change in one step: data first, unseen, then a numbered file that points to it.

A table's data lies in folders that are written once and never changed. What the table holds is told
by a manifest, a small numbered file: for each part (a day, or the whole table) the folder that has it,
its rows, and what it was made of. A change writes new folders, then creates the manifest with the
next number; a name can be created only once, so that of two writers one has to look again and repeat
its change on what the other one made. A reader resolves the newest manifest once and sees that state
and no other, also while the next one is written. A writer that dies leaves the table as it was; what
it wrote is removed by `vacuum`.

The last KEPT manifests stay, with their folders, for readers that began before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.session import unsorted_writes
from tallystone.sources import files

KEPT = 3
WRITE = "_write"
WHOLE = ""
#: Rows are counted by the write itself for up to so many days, by the files' footers beyond.
OBSERVED_DAYS = 4
#: Days a task writes at once without sorting its rows by day.
OPEN_DAYS = 8


class NumberedFiles:
    """Files 1, 2, 3 ... of a folder, each created once, by whoever comes first."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def numbers(self) -> list[int]:
        return [int(name.rsplit("/", 1)[1][:12]) for name in files.matching(self.spark, f"{self.folder}/{'[0-9]' * 12}.json")]

    def read(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, self._path(number)))

    def newest(self) -> tuple[int, dict]:
        """(0, {}) when there is none."""
        while True:
            found = self.numbers()
            if not found:
                return 0, {}
            try:
                return found[-1], self.read(found[-1])
            except Exception:
                if found[-1] == (self.numbers() or [0])[-1]:
                    raise  # not merely removed meanwhile, as one of the oldest

    def publish(self, number: int, content: dict) -> bool:
        return files.publish_once(self.spark, self._path(number), json.dumps(content, sort_keys=True))

    def remove(self, number: int) -> None:
        files.remove_folder(self.spark, self._path(number))


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.manifests = NumberedFiles(spark, f"{path}/_versions")

    def parts(self) -> dict[str, dict]:
        """What the table holds now: by day in ISO form (or WHOLE), the folder, rows and origin."""
        return self.manifests.newest()[1].get("parts", {})

    def exists(self) -> bool:
        return bool(self.manifests.numbers())

    def _folder(self, part: str, write: str) -> str:
        return f"{self.path}/{WRITE}={write}" + (f"/date={part}" if part else "")

    def frame(self, days: Iterable[date] | None = None, schema: T.StructType | None = None, state: dict | None = None) -> DataFrame:
        """The newest state (or a given one), of all days or some; only their folders are listed."""
        held = state if state is not None else self.manifests.newest()[1]
        if not held and schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        schema = schema or T.StructType.fromJson(held["schema"])
        parts = held.get("parts", {})
        wanted = None if days is None else {d.isoformat() for d in days}
        paths = [self._folder(p, x["write"]) for p, x in sorted(parts.items()) if x["write"] and (wanted is None or p in wanted)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*schema.fieldNames())

    def write(self, df: DataFrame, by_day: bool) -> str:
        """Write data that nobody sees yet; returns the name of the write."""
        write = uuid.uuid4().hex
        writer = df.write.mode("errorifexists")
        with unsorted_writes(self.spark, OPEN_DAYS):
            (writer.partitionBy("date") if by_day else writer).parquet(f"{self.path}/{WRITE}={write}")
        return write

    def discard(self, write: str, parts: Iterable[str]) -> None:
        for part in parts:
            files.remove_folder(self.spark, self._folder(part, write))

    def publish(self, changes: Mapping[str, dict], schema: T.StructType, run_id: str, whole: bool = False) -> int:
        """Point the given parts to their new folders; returns the manifest's number.

        Another writer's parts that were published meanwhile are kept: the change is repeated on
        the newest state until its number is free.
        """
        while True:
            number, held = self.manifests.newest()
            parts = dict(changes) if whole else {**held.get("parts", {}), **changes}
            content = {"run": run_id, "schema": schema.jsonValue(), "parts": parts}
            if self.manifests.publish(number + 1, content):
                self._forget(number + 1)
                return number + 1

    def _forget(self, newest: int) -> None:
        """Remove what only manifests before the kept ones point to."""
        kept, old = [], []
        for n in self.manifests.numbers():
            (kept if n > newest - KEPT else old).append(n)
        if not old:
            return
        used = {(p, x["write"]) for n in kept for p, x in self.manifests.read(n)["parts"].items()}
        for n in old:
            for p, x in self.manifests.read(n)["parts"].items():
                if x["write"] and (p, x["write"]) not in used:
                    files.remove_folder(self.spark, self._folder(p, x["write"]))
            self.manifests.remove(n)

    def vacuum(self, older_than_seconds: float = 24 * 3600) -> list[str]:
        """Remove folders of writes that no manifest points to, if they are that old: writers that
        died. Younger ones may still be written."""
        used = {x["write"] for n in self.manifests.numbers() for x in self.manifests.read(n)["parts"].values()}
        removed = []
        for folder in files.matching(self.spark, f"{self.path}/{WRITE}=*"):
            write = folder.rsplit(f"{WRITE}=", 1)[1]
            if write not in used and files.age_of(self.spark, folder) >= older_than_seconds:
                files.remove_folder(self.spark, folder)
                removed.append(write)
        return removed

    # Whole changes

    def replace(self, df: DataFrame, run_id: str) -> int:
        """Replace the whole table; returns its rows, counted by the write."""
        seen = Observation()
        write = self.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), by_day=False)
        rows = seen.get.get("rows", 0)
        self.publish({WHOLE: {"write": write, "rows": rows, "of": None}}, df.schema, run_id, whole=True)
        return rows

    def stage_days(self, df: DataFrame, days: list[date]) -> tuple[str, dict[date, int]]:
        """Write the rows of the given days, unseen yet; returns the name of the write and the rows
        of each day."""
        df = df.where(F.col("date").isin(days))
        if len(days) <= OBSERVED_DAYS:
            seen = Observation()
            counts = [F.count_if(F.col("date") == F.lit(d)).alias(d.isoformat()) for d in days]
            write = self.write(df.observe(seen, *counts), by_day=True)
            return write, {d: seen.get.get(d.isoformat(), 0) for d in days}
        write = self.write(df, by_day=True)
        held = self.staged(write, df.schema).groupBy("date").count().collect()
        return write, dict.fromkeys(days, 0) | {r["date"]: r["count"] for r in held}

    def staged(self, write: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{WRITE}={write}")

    def replace_days(self, df: DataFrame, days: list[date], run_id: str, of: Mapping[date, str] | None = None, shown: bool = True) -> dict[date, int]:
        """Replace the given days of the table; returns the rows of each. A day without rows stays
        known, with no folder. `of` tells what each day was made of; the day itself is a column
        that readers see, or not."""
        write, counts = self.stage_days(df, days)
        schema = T.StructType([f for f in df.schema if shown or f.name != "date"])
        self.publish(day_parts(write, counts, of), schema, run_id)
        return counts


def day_parts(write: str, counts: Mapping[date, int], of: Mapping[date, str] | None = None) -> dict[str, dict]:
    return {d.isoformat(): {"write": write if n else None, "rows": n, "of": (of or {}).get(d)} for d, n in counts.items()}
