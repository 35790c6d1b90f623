"""Runs of the incremental pipeline: sessions, steps on the units that are due, errors kept apart, reports.

A project is a folder of append-only tables: flags (unit, step, session, at), errors (session, unit, step, message, at) and
sessions (session, status, units, steps, at; the latest row of a session counts). A step is a function of (spark, unit); a
unit whose step fails waits for the next session, the others go on.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.operators import runtime

SCHEMAS = {
    "flags": "unit string, step string, session long, at timestamp",
    "errors": "session long, unit string, step string, message string, at timestamp",
    "sessions": "session long, status string, units long, steps string, at timestamp",
}


def group_steps(steps: Sequence[str], groups: dict[str, Sequence[str]]) -> dict[str, list[str]]:
    """Steps by the group that names them, in the order of the steps; a step without a group is its own. Two groups for a step are an error."""
    of: dict[str, str] = {}
    for name, members in groups.items():
        for s in members:
            if s not in steps or s in of:
                raise ValueError(f"step {s} of group {name} is unknown or has a group already")
            of[s] = name
    out: dict[str, list[str]] = {}
    for s in steps:
        out.setdefault(of.get(s, s), []).append(s)
    return out


@dataclass
class Project:
    """The tables of a project in a shared folder."""

    spark: SparkSession
    path: str

    def add(self, table: str, rows: Sequence[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(list(rows), SCHEMAS[table]).coalesce(1).write.mode("append").parquet(f"{self.path}/{table}")

    def read(self, table: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.path}/{table}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], SCHEMAS[table])

    def sessions(self) -> DataFrame:
        """The latest row of each session, newest first as ``back`` from 1."""
        rows = self.read("sessions").groupBy("session").agg(F.max_by(F.struct("status", "units", "steps", "at"), "at").alias("s"), F.min("at").alias("started"))
        back = F.row_number().over(W.orderBy(F.desc("session")))  # one row a session
        return rows.select("session", "started", F.col("s.at").alias("ended"), "s.status", "s.units", "s.steps", back.alias("back"))

    def session_errors(self, back: int = 1, pattern: str | None = None) -> DataFrame:
        """Errors of the session that many sessions back (1: the last); pattern: those whose message matches."""
        found = self.read("errors").join(F.broadcast(self.sessions().where(F.col("back") == back).select("session")), "session")
        return found if pattern is None else found.where(F.col("message").rlike(pattern))

    def error_counts(self) -> DataFrame:
        """Errors of each session, newest first."""
        n = self.read("errors").groupBy("session").agg(F.count("*").alias("errors"))
        return self.sessions().select("session", "back").join(n, "session", "left").fillna(0, ["errors"]).orderBy("back")


def run(project: Project, units: Sequence[str], steps: dict[str, Callable[[SparkSession, str], None]], workers: int = 4, together: int = 32) -> int:
    """One session: each unit's next open step runs until nothing is due; the session's number.

    Units run side by side, a unit's steps one after another; what is done already is left alone. The flags of ``together``
    units are written at a time, so after a crash of the driver their steps run again. The session ends as Completed, or as
    Failed where a step failed.
    """
    spark, names = project.spark, list(steps)
    last = project.read("sessions").agg(F.max("session")).first()[0] or 0
    session = last + 1
    now = datetime.datetime.now
    project.add("sessions", [(session, "Running", len(units), ",".join(names), now())])
    every = spark.createDataFrame([(u,) for u in units], "unit string")
    table = runtime.status(every, runtime.step_table(spark, names), project.read("flags"))
    open_ = {r["unit"]: r["step_idx"] for r in runtime.eligible(table).collect()}  # one row a unit

    def go(unit: str) -> tuple[list[tuple], list[tuple]]:
        done: list[tuple] = []
        for name in names[open_[unit] - 1 :]:
            try:
                steps[name](spark, unit)
            except Exception as e:
                return done, [(session, unit, name, f"{type(e).__name__}: {e}"[:2000], now())]
            done.append((unit, name, session, now()))
        return done, []

    failed, due = 0, sorted(open_)
    with ThreadPoolExecutor(workers) as pool:
        for at in range(0, len(due), together):
            found = list(pool.map(go, due[at : at + together]))
            project.add("flags", [x for done, _ in found for x in done])
            project.add("errors", [x for _, errors in found for x in errors])
            failed += sum(len(errors) for _, errors in found)
    project.add("sessions", [(session, "Failed" if failed else "Completed", len(units), ",".join(names), now())])
    return session


def report(project: Project, units: DataFrame, steps: Sequence[str]) -> DataFrame:
    """unit, progress_index, finished, and the step and message of its last error (null: none since)."""
    table = runtime.status(units, runtime.step_table(project.spark, steps), project.read("flags"))
    errors = project.read("errors").groupBy("unit").agg(F.max_by(F.struct("step", "message"), "session").alias("e"))
    out = runtime.progress(table).join(errors, "unit", "left")
    return out.select("unit", "progress_index", "finished", F.when(~F.col("finished"), F.col("e.step")).alias("failed_step"), F.when(~F.col("finished"), F.col("e.message")).alias("message"))
