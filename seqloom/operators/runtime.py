"""The incremental pipeline: ordered steps, done flags, progress, eligibility, sessions and a registry of steps.

A unit is (accession, organism) or any key; flags are rows (unit, step). Nothing loops over units on the driver.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Steps of each preset, in order; fixed names.
STEPS = {
    "Ribo-seq": ("start", "fetch", "trim", "collapsed", "aligned", "cleanbam", "exp", "ofst", "pshifted", "valid_pshift", "merged_lib", "covrle", "bigwig", "pcounts"),
    "RNA-seq": ("start", "fetch", "aligned", "cleanbam", "exp", "ofst", "cigar_collapse", "merged_lib", "covrle", "bigwig", "pcounts"),
    "SSU": ("start", "fetch", "trim", "collapsed", "aligned", "cleanbam", "exp", "ofst", "merged_lib", "covrle", "bigwig", "pcounts"),
}


def steps_for(preset: str, contaminants: bool = False, local: bool = False) -> list[str]:
    """Step names of a preset; contaminants adds their removal before the alignment, local drops start and fetch."""
    steps = list(STEPS[preset])
    if contaminants:
        steps.insert(steps.index("aligned"), "contam")
    return [s for s in steps if not (local and s in ("start", "fetch"))]


def step_table(spark: SparkSession, steps: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i, s) for i, s in enumerate(steps, 1)], "step_idx int, step string")


def status(units: DataFrame, steps: DataFrame, flags: DataFrame) -> DataFrame:
    """(unit, step_idx, step, done) of every unit and step. steps is a handful of rows."""
    done = flags.select("unit", "step").distinct().withColumn("done", F.lit(True))
    every = units.select("unit").distinct().crossJoin(F.broadcast(steps))
    return every.join(done, ["unit", "step"], "left").select("unit", "step_idx", "step", F.coalesce("done", F.lit(False)).alias("done"))


def progress(table: DataFrame) -> DataFrame:
    """progress_index: number of leading done steps; finished: all are."""
    n = F.count("*")
    first_open = F.min(F.when(~F.col("done"), F.col("step_idx")))
    return table.groupBy("unit").agg((F.coalesce(first_open - 1, n)).cast("long").alias("progress_index"), F.bool_and("done").alias("finished"))


def eligible(table: DataFrame) -> DataFrame:
    """Steps that are open while all earlier ones are done: one a unit at most."""
    before = W.partitionBy("unit").orderBy("step_idx").rowsBetween(W.unboundedPreceding, -1)
    ready = F.coalesce(F.bool_and("done").over(before), F.lit(True))
    return table.withColumn("_ready", ready).where("_ready and not done").select("unit", "step_idx", "step")


def current_steps(table: DataFrame) -> DataFrame:
    """Units by the step they wait for; finished ones are at ``done``."""
    at = table.groupBy("unit").agg(F.min_by("step", F.when(~F.col("done"), F.col("step_idx"))).alias("step"))
    return at.groupBy(F.coalesce("step", F.lit("done")).alias("step")).agg(F.count("*").alias("units"))


def reset_from(flags: DataFrame, steps: DataFrame, step: str, units: DataFrame | None = None) -> DataFrame:
    """flags without this step and the later ones, for the given units or for all."""
    gone = steps.where(F.col("step_idx") >= steps.where(F.col("step") == step).select("step_idx").scalar()).select("step")
    if units is None:
        return flags.join(F.broadcast(gone), "step", "left_anti")
    return flags.join(units.select("unit").crossJoin(F.broadcast(gone)), ["unit", "step"], "left_anti")


def status_matrix(table: DataFrame, steps: Sequence[str]) -> DataFrame:
    """One row a unit, a boolean column for each step."""
    return table.groupBy("unit").agg(*(F.bool_or(F.when(F.col("step") == s, F.col("done"))).alias(s) for s in steps))


def stale(results: DataFrame, inputs: DataFrame, key: str, made: str, changed: str) -> DataFrame:
    """Keys whose result is missing or older than its newest input."""
    newest = inputs.groupBy(key).agg(F.max(changed).alias("_changed"))
    old = results.groupBy(key).agg(F.max(made).alias("_made"))
    return newest.join(old, key, "left").where(F.col("_made").isNull() | (F.col("_made") < F.col("_changed"))).select(key)


@dataclass
class StepRegistry:
    """Named DataFrame -> DataFrame functions, run in order on the units that are due."""

    steps: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def register(self, name: str) -> Callable:
        def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
            if name in self.steps:
                raise ValueError(f"step {name} is there already")
            self.steps[name] = f
            return f

        return add

    def run(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        for name in names or self.steps:
            df = df.transform(self.steps[name])
        return df


def retry(action: Callable, times: int = 3, wait: float = 0.5, spread: float = 0.0):
    """The action's result; after a failure it is tried again, with growing pauses, longer by a random share up to ``spread``."""
    for k in range(times):
        try:
            return action()
        except Exception:
            if k == times - 1:
                raise
            time.sleep(wait * 2**k * (1 + random.uniform(0, spread)))


def first_success(*actions: Callable):
    """(number from 1, result) of the first action that succeeds; the last one's error if none does."""
    for k, action in enumerate(actions, 1):
        try:
            return k, action()
        except Exception:
            if k == len(actions):
                raise
    raise ValueError("no actions")


def split_valid(df: DataFrame, checks: dict[str, object]) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters): a row that fails checks (name -> condition, null fails) goes with their names."""
    failed = F.filter(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items())), lambda x: x.isNotNull())
    marked = df.withColumn("errors", failed)
    return marked.where(F.size("errors") == 0).drop("errors"), marked.where(F.size("errors") > 0)


def set_flags(flags: DataFrame, units: DataFrame, steps: Sequence[str], known: Sequence[str]) -> DataFrame:
    """flags with these steps of these units set; unknown steps are an error."""
    if missing := set(steps) - set(known):
        raise ValueError(f"no such steps: {sorted(missing)}")
    new = units.select("unit").distinct().withColumn("step", F.explode(F.array(*map(F.lit, steps))))
    return flags.select("unit", "step").unionByName(new).distinct()


def remove_flags(flags: DataFrame, units: DataFrame, steps: Sequence[str], known: Sequence[str]) -> DataFrame:
    """flags without these steps of these units; unknown steps are an error, ``["all"]`` is every step."""
    steps = known if list(steps) == ["all"] else steps
    if missing := set(steps) - set(known):
        raise ValueError(f"no such steps: {sorted(missing)}")
    gone = units.select("unit").distinct().withColumn("step", F.explode(F.array(*map(F.lit, steps))))
    return flags.join(gone, ["unit", "step"], "left_anti").select("unit", "step")


def still_progressing(updates: DataFrame, unit: str, ts: str, now, hours: float) -> DataFrame:
    """Units with hours since their last update and whether that is below the limit. now: a timestamp column or literal."""
    last = updates.groupBy(unit).agg(F.max(ts).alias("last_update"))
    idle = F.timestamp_diff("SECOND", F.col("last_update"), now) / 3600
    return last.select(unit, F.round(idle, 4).alias("hours"), (idle < hours).alias("progressing"))


def sessions_active(sessions: DataFrame, running: DataFrame) -> DataFrame:
    """sessions (pgid) with whether a running process group has that id."""
    return sessions.join(running.select("pgid", F.lit(True).alias("active")).distinct(), "pgid", "left").withColumn("active", F.coalesce("active", F.lit(False)))


def add_step(steps: Sequence[str], name: str, at: str = "tail") -> list[str]:
    """Step names with a user's step at the head or the tail; one that is there already is an error."""
    if name in steps:
        raise ValueError(f"step {name} is there already")
    return [name, *steps] if at == "head" else [*steps, name]
