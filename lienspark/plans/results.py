"""Answers kept for a while, as long as what they were made of stays the same."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.plans.dashboard import dashboard_rows, filter_choices, frames_from, selected
from lienspark.sinks import generations
from lienspark.sinks.folders import create_file, delete_folder, folders_like
from lienspark.sinks.tables import place_of_table

# Seconds that answers of the dashboard hold.
DATA_SECONDS, CHOICES_SECONDS = 600, 86_400


def version(spark: SparkSession, table: str) -> str:
    """A text that changes with every load of the table, for a table of either kind."""
    if spark.catalog.tableExists(generations.rows_table(table)):
        place = generations.place_of(spark, table)
        return ",".join(generations.in_force(generations.committed(spark, place)))
    return place_of_table(spark, table)


class Results:
    """Answers below a folder of the shared storage, so they outlive their executors.

    An answer is found by its question, the question's arguments and the versions of
    the tables it reads. Loading a table gives it a new version, so no answer made
    of the old rows is found again. An answer is complete when its mark is there;
    answers past their time are deleted when the next one is stored.
    """

    def __init__(self, spark: SparkSession, folder: str, clock: Callable[[], float] = time.time):
        self.spark, self.folder, self.clock = spark, folder.rstrip("/"), clock

    def answer(
        self,
        question: str,
        arguments: Mapping[str, object],
        tables: Sequence[str],
        seconds: float,
        ask: Callable[[], DataFrame],
    ) -> DataFrame:
        """The stored answer if it is young enough, else that of ``ask``, stored."""
        versions = {table: version(self.spark, table) for table in tables}
        asked = json.dumps([question, dict(arguments), versions], sort_keys=True)
        key = hashlib.sha256(asked.encode()).hexdigest()
        now = self.clock()
        for mark in sorted(folders_like(self.spark, f"{self.folder}/marks/{key}-*"), reverse=True):
            name = mark.rsplit("/", 1)[1]
            if now < self._ends(name):
                return self._read(name)
        self._delete_old(now)
        name = f"{key}-{int((now + seconds) * 1000):015d}-{uuid.uuid4().hex}"
        ask().write.parquet(f"{self.folder}/{name}")
        create_file(self.spark, f"{self.folder}/marks/{name}")
        return self._read(name)

    @staticmethod
    def _ends(name: str) -> float:
        return int(name.split("-")[1]) / 1000

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def _delete_old(self, now: float) -> None:
        """Answers that ended a while ago; who found one before it ended may still read it."""
        for mark in folders_like(self.spark, f"{self.folder}/marks/*"):
            name = mark.rsplit("/", 1)[1]
            if self._ends(name) + DATA_SECONDS < now:
                delete_folder(self.spark, mark)
                delete_folder(self.spark, f"{self.folder}/{name}")


def kept_choices(results: Results, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """The filters' choices over built marts, kept for a day."""
    summary = names["prd_risk_summary"]

    def ask(choice: str) -> Callable[[], DataFrame]:
        return lambda: filter_choices(results.spark.table(summary))[choice]

    order = {"years": F.desc("data_year"), "state_names": F.asc("state_name")}
    return {
        choice: results.answer(choice, {}, [summary], CHOICES_SECONDS, ask(choice)).orderBy(by)
        for choice, by in order.items()
    }


def kept_dashboard(
    results: Results, names: Mapping[str, str], year: int, states: Sequence[str]
) -> dict[str, DataFrame]:
    """Every frame of a selection over built marts, kept for ten minutes.

    The summary is read once for all of its frames.
    """
    spark = results.spark
    summary, sample = names["prd_risk_summary"], names["prd_loan_sample"]
    chosen = {"year": year, "states": sorted(set(states))}

    def rows() -> DataFrame:
        return dashboard_rows(spark.table(summary), year, states)

    def points() -> DataFrame:
        return selected(spark.table(sample), year, states)

    frames = frames_from(results.answer("dashboard", chosen, [summary], DATA_SECONDS, rows))
    frames["income_vs_spread"] = results.answer("sample", chosen, [sample], DATA_SECONDS, points)
    return frames
