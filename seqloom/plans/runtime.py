"""Queries of the pipeline runtime, JSON and streaming: users of events are units, event types are steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom import streaming
from seqloom.operators import runner, runtime
from seqloom.operators.common import shared_dir
from seqloom.plans.common import Registry, Tables

registry = Registry()
STEPS = ["signup", "view", "click", "purchase", "error"]
EVENT_STEPS = "(SELECT unnest(range(1, 6)) AS step_idx, unnest(['signup', 'view', 'click', 'purchase', 'error']) AS step)"
FLAGS = f"""
WITH fl AS (SELECT DISTINCT user_id AS unit, event_type AS step FROM events WHERE user_id % 4 <> 0 OR event_type <> 'view'),
u AS (SELECT DISTINCT user_id AS unit FROM events),
s AS (SELECT unit, step_idx::INT AS step_idx, step, fl.step IS NOT NULL AS done FROM u CROSS JOIN {EVENT_STEPS} st LEFT JOIN fl USING (unit, step))
""".replace("fl.step IS NOT NULL AS done FROM u CROSS JOIN", "done IS NOT NULL AS done FROM u CROSS JOIN").replace("LEFT JOIN fl USING", "LEFT JOIN (SELECT *, true AS done FROM fl) USING")


def _flags(t: Tables) -> DataFrame:
    return t.events.where("user_id % 4 <> 0 or event_type <> 'view'").select(F.col("user_id").alias("unit"), F.col("event_type").alias("step")).distinct()


def _status(t: Tables) -> DataFrame:
    return runtime.status(t.events.select(F.col("user_id").alias("unit")), runtime.step_table(t.spark, STEPS), _flags(t))


def folder(t: Tables, name: str) -> str:
    """A new folder below the session's shared one."""
    return shared_dir(t.spark, f"stream-{name}")


FILES = 4


def _event_files(t: Tables) -> str:
    """The events as a folder of ``FILES`` files, landed one after another in the order of time, for streams of several batches."""
    path = folder(t, "events")
    bounds = t.events.agg(F.percentile_approx("ts", [k / FILES for k in range(1, FILES)], 1000)).first()[0]
    part = sum(((F.col("ts") > F.lit(b)).cast("int") for b in bounds), F.lit(0))
    for k in range(FILES):
        t.events.where(part == k).coalesce(1).write.mode("append").parquet(path)
    return path


@registry.query(FLAGS + "SELECT unit, coalesce(min(step_idx) FILTER (WHERE NOT done) - 1, count(*))::BIGINT AS progress_index, bool_and(done) AS finished FROM s GROUP BY 1")
def progress_index(t: Tables) -> DataFrame:
    return runtime.progress(_status(t))


@registry.query(FLAGS + """, e AS (SELECT *, coalesce(bool_and(done) OVER (PARTITION BY unit ORDER BY step_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS ready FROM s)
SELECT unit, step_idx, step FROM e WHERE ready AND NOT done""")
def next_step_eligible(t: Tables) -> DataFrame:
    return runtime.eligible(_status(t))


@registry.query(FLAGS + ", c AS (SELECT unit, arg_min(step, step_idx) FILTER (WHERE NOT done) AS step FROM s GROUP BY 1) SELECT coalesce(step, 'done') AS step, count(*) AS units FROM c GROUP BY 1")
def current_step_table(t: Tables) -> DataFrame:
    return runtime.current_steps(_status(t))


@registry.query(FLAGS + """, p AS (SELECT unit, bool_and(done) AS finished FROM s GROUP BY 1)
SELECT c_mktsegment AS organism, count(*) AS units, count(*) FILTER (WHERE finished) AS done, round(100.0 * count(*) FILTER (WHERE finished) / count(*), 2) AS percent
FROM p JOIN customer ON unit = c_custkey GROUP BY 1""")
def organism_progress(t: Tables) -> DataFrame:
    p = runtime.progress(_status(t)).join(t.customer, F.col("unit") == F.col("c_custkey"))
    done = F.count_if("finished")
    return p.groupBy(F.col("c_mktsegment").alias("organism")).agg(F.count("*").alias("units"), done.alias("done"), F.round(100.0 * done / F.count("*"), 2).alias("percent"))


@registry.query(FLAGS + "SELECT unit, step FROM fl WHERE step NOT IN ('click', 'purchase', 'error') OR unit % 2 <> 0")
def flags_reset_from(t: Tables) -> DataFrame:
    even = t.events.where("user_id % 2 = 0").select(F.col("user_id").alias("unit")).distinct()
    return runtime.reset_from(_flags(t), runtime.step_table(t.spark, STEPS), "click", even).select("unit", "step")


@registry.query(FLAGS + "SELECT unit, " + ", ".join(f"bool_or(done) FILTER (WHERE step = '{s}') AS {s}" for s in STEPS) + " FROM s GROUP BY 1")
def status_matrix(t: Tables) -> DataFrame:
    return runtime.status_matrix(_status(t), STEPS)


@registry.query("""
WITH m AS (SELECT max(ts) AS newest FROM events)
SELECT user_id AS unit, max(ts) AS last_update, date_diff('second', max(ts), any_value(newest)) // 3600 AS hours_ago FROM events, m GROUP BY 1""")
def last_update_by_unit(t: Tables) -> DataFrame:
    newest = t.events.agg(F.max("ts").alias("newest"))
    x = t.events.groupBy(F.col("user_id").alias("unit")).agg(F.max("ts").alias("last_update")).crossJoin(F.broadcast(newest))  # newest: one row
    # Whole seconds of the two clocks, as date_diff counts: the elapsed time has one less where the fraction is larger before.
    second = lambda c: f"cast(cast({c} - timestamp_ntz'0001-01-01 00:00:00' as interval second) as bigint)"
    return x.select("unit", "last_update", F.expr(f"({second('newest')} - {second('last_update')}) div 3600").alias("hours_ago"))


@registry.query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_barcode_counts(t: Tables) -> DataFrame:
    stream = streaming.source(t.spark, _event_files(t), t.events.schema)
    return streaming.running_counts(stream, ["event_type"], folder(t, "counts"), folder(t, "counts-state"))


@registry.query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_append_recollapse(t: Tables) -> DataFrame:
    stream = streaming.source(t.spark, _event_files(t), t.events.schema)
    return streaming.append_then_compact(stream, ["user_id", "event_type"], folder(t, "parts"), folder(t, "parts-state"))


@registry.query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing.path'), 'none') AS absent FROM events""")
def json_report_fields(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.coalesce(F.get_json_object("props", "$.missing.path"), F.lit("none")).alias("absent"))


@registry.query("""
SELECT user_id, ord AS pos, value FROM (SELECT user_id, unnest(v) AS value, unnest(range(1, len(v) + 1)) AS ord FROM (SELECT user_id, list(round(value, 3) ORDER BY event_id) AS v FROM events GROUP BY 1))""")
def json_curves(t: Tables) -> DataFrame:
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.round("value", 3).alias("v")))), lambda x: x["v"])
    doc = t.events.groupBy("user_id").agg(F.to_json(F.struct(ordered.alias("curve"))).alias("doc"))
    back = doc.select("user_id", F.from_json("doc", "curve array<double>").alias("d"))
    return back.select("user_id", F.posexplode("d.curve").alias("p", "value")).select("user_id", (F.col("p") + 1).cast("long").alias("pos"), "value")


@registry.query("""
SELECT regexp_extract(url, '^[a-z]+', 0) AS scheme, count(*) AS files, sum(length(html))::BIGINT AS chars, round(sum(length(html)) / 1e6, 4) AS megabytes FROM pages GROUP BY 1""")
def file_statistics(t: Tables) -> DataFrame:
    n = F.sum(F.length("html"))
    return t.pages.groupBy(F.regexp_extract("url", "^[a-z]+", 0).alias("scheme")).agg(F.count("*").alias("files"), n.alias("chars"), F.round(n / 1e6, 4).alias("megabytes"))


@registry.query("""
WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 1 DAY THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, event_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g),
t AS (SELECT user_id, k::BIGINT AS session, min(ts) AS init_time, max(ts) AS end_time, count(*) AS n FROM s GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY init_time DESC) AS newest FROM t QUALIFY newest <= 2""")
def session_table(t: Tables) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    new = F.when(F.timestamp_diff("MICROSECOND", F.lag("ts").over(w), F.col("ts")) <= 86_400_000_000, 0).otherwise(1)
    k = t.events.withColumn("new", new).withColumn("session", F.sum("new").over(w))
    s = k.groupBy("user_id", "session").agg(F.min("ts").alias("init_time"), F.max("ts").alias("end_time"), F.count("*").alias("n"))
    return s.withColumn("newest", F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("init_time"))).cast("long")).where("newest <= 2")


@registry.query("""
WITH r AS (SELECT user_id, max(ts) AS made FROM events WHERE event_type = 'view' GROUP BY 1), i AS (SELECT user_id, max(ts) AS changed FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT user_id FROM i LEFT JOIN r USING (user_id) WHERE made IS NULL OR made < changed""")
def freshness_recompute(t: Tables) -> DataFrame:
    return runtime.stale(t.events.where("event_type = 'view'"), t.events.where("event_type <> 'view'"), "user_id", "ts", "ts")


@registry.query(FLAGS + ", p AS (SELECT unit, bool_and(done) AS finished FROM s GROUP BY 1) SELECT count(*) FILTER (WHERE NOT finished) AS waiting, count(*) FILTER (WHERE NOT finished) > 30 AS pause FROM p")
def admission_control(t: Tables) -> DataFrame:
    waiting = F.count_if(~F.col("finished"))
    return runtime.progress(_status(t)).agg(waiting.alias("waiting"), (waiting > 30).alias("pause"))


@registry.query("SELECT l_orderkey, sum(l_quantity * 2)::BIGINT AS doubled FROM lineitem WHERE l_quantity > 10 GROUP BY 1")
def user_step_registry(t: Tables) -> DataFrame:
    steps = runtime.StepRegistry()
    steps.register("filter")(lambda df: df.where("l_quantity > 10"))
    steps.register("double")(lambda df: df.withColumn("q", F.col("l_quantity") * 2))
    steps.register("sum")(lambda df: df.groupBy("l_orderkey").agg(F.sum("q").cast("long").alias("doubled")))
    return steps.run(t.lineitem)


@registry.query("""
SELECT event_id, concat_ws('+', CASE WHEN value > 50 THEN NULL ELSE 'low' END, CASE WHEN event_type <> 'view' THEN NULL ELSE 'view' END) AS errors FROM events WHERE NOT (value > 50 AND event_type <> 'view')""")
def dead_letter_split(t: Tables) -> DataFrame:
    _, dead = runtime.split_valid(t.events, {"low": F.col("value") > 50, "view": F.col("event_type") != "view"})
    return dead.select("event_id", F.array_join("errors", "+").alias("errors"))


@registry.query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_event_counts(t: Tables) -> DataFrame:
    stream = streaming.source(t.spark, _event_files(t), t.events.schema).withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need it
    counts = streaming.windowed_counts(stream, "ts", "1 hour", "10 minutes", ["event_type"])
    found = streaming.landed(counts, ["window", "event_type"], folder(t, "windows"), folder(t, "windows-state"))
    return found.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@registry.query("""
SELECT CAST(n_nationkey AS VARCHAR) AS unit, CASE WHEN n_nationkey % 7 = 0 THEN 1 ELSE 3 END::BIGINT AS progress_index, n_nationkey % 7 <> 0 AS finished, CASE WHEN n_nationkey % 7 = 0 THEN 'count' END AS failed_step FROM nation""")
def pipeline_session(t: Tables) -> DataFrame:
    project = runner.Project(t.spark, folder(t, "project"))
    units = t.nation.select(F.col("n_nationkey").cast("string").alias("unit"))

    def count(spark, unit: str) -> None:
        if int(unit) % 7 == 0:
            raise ValueError(f"nothing to count in {unit}")

    steps = {"start": lambda spark, unit: None, "count": count, "report": lambda spark, unit: None}
    runner.run(project, [r["unit"] for r in units.collect()], steps)  # the units of a session: a short list by nature
    return runner.report(project, units, list(steps)).drop("message")
