"""Queries of file checks, local studies, collections of all samples and reports: orders are runs, their lines are files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import files, runtime
from seqloom.plans.common import Registry, Tables

registry = Registry()
#: File names of an order's lines.
NAMES = "CASE l_linenumber WHEN 1 THEN '.fastq.gz' WHEN 2 THEN '_1.fastq.gz' WHEN 3 THEN '_2.fastq.gz' WHEN 4 THEN '.fastq' ELSE '.fastq.md5' END"


def _files(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("run"), F.concat(F.col("l_orderkey").cast("string"), F.expr(NAMES)).alias("name"), "l_returnflag")


@registry.query(f"""
WITH f AS (SELECT DISTINCT l_orderkey AS run, {NAMES} AS e FROM lineitem WHERE l_returnflag <> 'R'),
g AS (SELECT o_orderkey AS run, o_orderstatus = 'F' AS paired, coalesce(bool_or(e = '.fastq.gz'), false) AS s, coalesce(bool_or(e = '_1.fastq.gz'), false) AS m1, coalesce(bool_or(e = '_2.fastq.gz'), false) AS m2,
  coalesce(bool_or(e = '.fastq'), false) AS o FROM orders LEFT JOIN f ON o_orderkey = run GROUP BY 1, 2),
v AS (SELECT *, (CASE WHEN NOT s AND NOT m1 AND NOT m2 THEN 'missing' WHEN s AND NOT m2 THEN CASE WHEN paired THEN 'layout' ELSE 'ok' END
  WHEN m1 AND m2 AND NOT s THEN CASE WHEN paired THEN 'ok' ELSE 'layout' END ELSE 'invalid' END) AS verdict FROM g)
SELECT run, verdict,
  CASE WHEN verdict IN ('missing', 'invalid') THEN '' WHEN s THEN run || '.fastq.gz' ELSE run || '_1.fastq.gz,' || run || '_2.fastq.gz' END AS keep,
  concat_ws(',', CASE WHEN o THEN run || '.fastq' END, CASE WHEN verdict = 'invalid' AND s THEN run || '.fastq.gz' END,
    CASE WHEN m1 AND (verdict = 'invalid' OR (s AND NOT m2)) THEN run || '_1.fastq.gz' END, CASE WHEN m2 AND verdict = 'invalid' THEN run || '_2.fastq.gz' END) AS remove FROM v""")
def fastq_download_check(t: Tables) -> DataFrame:
    runs = t.orders.select(F.col("o_orderkey").alias("run"), (F.col("o_orderstatus") == "F").alias("paired"))
    found = files.fastq_verdicts(runs, _files(t).where("l_returnflag <> 'R'").select("run", "name"))
    return found.select("run", "verdict", F.array_join("keep", ",").alias("keep"), F.array_join("remove", ",").alias("remove"))


@registry.query("""
SELECT o_orderkey, round(gb, 6) AS gb, CASE WHEN gb <= free THEN 'scratch' ELSE 'out' END AS folder FROM (
  SELECT o_orderkey, CASE WHEN o_custkey % 40 = 0 THEN NULL ELSE 900 END AS free,
    coalesce(CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 1000 END, coalesce(5 * CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 1e6 END / 1073741824, 5) * CASE WHEN o_custkey % 2 = 0 THEN 2 ELSE 1 END) AS gb FROM orders)""")
def scratch_choice(t: Tables) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    gb = files.extracted_gb(F.when(status == "P", price / 1000), F.when(status == "O", price * 1e6), F.col("o_custkey") % 2 == 0)
    free = F.when(F.col("o_custkey") % 40 != 0, F.lit(900))
    return t.orders.select("o_orderkey", F.round(gb, 6).alias("gb"), files.scratch_folder(gb, free, "scratch", "out").alias("folder"))


@registry.query("""
WITH b AS (SELECT l_orderkey AS run, count(*) AS n, count(*) FILTER (WHERE l_discount = 0 AND l_tax = 0) AS e FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
SELECT o_custkey AS study, count(*) AS n_runs, coalesce(sum(n), 0)::BIGINT AS n_files, coalesce(sum(e), 0)::BIGINT AS n_empty,
  coalesce(sum(n), 0) >= count(*) AND coalesce(sum(e), 0) = 0 AS ok FROM orders LEFT JOIN b ON o_orderkey = run GROUP BY 1""")
def alignment_files_check(t: Tables) -> DataFrame:
    name = F.concat(F.col("l_orderkey").cast("string"), F.when(F.col("l_returnflag") == "N", ".bam").otherwise(".log"))
    length = F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), 0).otherwise(1)
    found = t.lineitem.select(F.col("l_orderkey").alias("run"), name.alias("name"), length.alias("length"))
    return files.alignment_problems(t.orders.select(F.col("o_custkey").alias("study"), F.col("o_orderkey").alias("run")), found)


@registry.query("""
SELECT 'repeated sample' AS problem WHERE (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY p_name)) > 1
UNION ALL SELECT 'barcode lengths differ' WHERE (SELECT count(DISTINCT length(p_type)) FROM part) <> 1
UNION ALL SELECT 'as many files as samples' WHERE (SELECT count(*) FROM part) = 2""")
def control_sheet_problems(t: Tables) -> DataFrame:
    sheet = t.part.select(F.col("p_size").alias("LANE"), F.col("p_type").alias("BARCODE"), F.col("p_name").alias("sample"))
    return files.control_problems(sheet, 2)


@registry.query("""
WITH f AS (SELECT doc_id, coalesce(lang, '') AS sub, doc_id // 2 AS stem, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END AS mate, n_chars * 1000 AS len, n_chars AS mean FROM documents),
p AS (SELECT sub, dense_rank() OVER (ORDER BY sub) + 7 AS project FROM (SELECT DISTINCT sub FROM f))
SELECT 's' || stem AS run, sum(len // 1048576)::BIGINT AS "size_MB", min_by(mean, mate) AS avg_length, 'PAIRED' AS layout, sub AS submission, max(project) AS project, count(*) = 2 AS ok
FROM f JOIN p USING (sub) GROUP BY stem, sub""")
def local_study_runs(t: Tables) -> DataFrame:
    d = t.documents
    path = F.concat(F.lit("/data/s"), F.floor(d.doc_id / 2).cast("string"), F.lit("_"), F.when(d.doc_id % 2 == 0, "1").otherwise("2"), F.lit(".fastq.gz"))
    found = d.select(path.alias("path"), (d.n_chars * 1000).alias("length"), d.n_chars.alias("mean_length"), F.coalesce("lang", F.lit("")).alias("lang"))
    return files.local_study(found, F.col("lang"), 7, F.lit("PAIRED"))


@registry.query("""
WITH s AS (SELECT c_custkey AS run, c_nationkey || '-x' AS study, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE c_mktsegment END AS fraction, row_number() OVER (ORDER BY c_nationkey, c_custkey) AS number FROM customer WHERE c_acctbal > 0)
SELECT run, number, CASE WHEN fraction IS NULL OR fraction = '' THEN '' ELSE fraction || '_' END || split_part(study, '-', 1) || '_' || number AS fraction, run % 2 = 0 AS is_pshifted FROM s""")
def master_collection(t: Tables) -> DataFrame:
    c = t.customer.where("c_acctbal > 0")
    fraction = F.when(F.col("c_custkey") % 3 == 1, "").when(F.col("c_custkey") % 3 == 2, F.col("c_mktsegment"))
    path = F.when(F.col("c_custkey") % 2 == 0, "a_pshifted.ofst").otherwise("a.ofst")
    samples = c.select(F.col("c_custkey").alias("run"), F.concat(F.col("c_nationkey").cast("string"), F.lit("-x")).alias("study"), fraction.alias("fraction"), path.alias("path"), "c_nationkey")
    rows, meta = files.master_collection(samples, t.customer.select(F.col("c_custkey").alias("run")), [F.col("c_nationkey"), F.col("run")])
    return meta.join(rows.select("run", "fraction"), "run").select("run", "number", "fraction", "is_pshifted")


RUNS = """WITH v AS (SELECT DISTINCT o_orderkey AS run FROM orders WHERE o_orderstatus = 'F')
"""


def _report(t: Tables) -> tuple[DataFrame, DataFrame]:
    aligned = t.orders.select(F.concat(F.lit("trimmed_"), F.col("o_orderkey").cast("string")).alias("sample"), (F.col("o_custkey") * 100000).alias("mapped"))
    trims = t.lineitem.select(F.col("l_orderkey").cast("string").alias("raw_library"), (F.col("l_partkey") * 1000).alias("raw_reads"), (F.col("l_suppkey") * 1000).alias("trim_reads"), F.col("l_linenumber").alias("trim_mean_length"))
    return files.run_report(aligned, trims, t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("run")))


@registry.query(RUNS + """, a AS (SELECT count(*) AS samples, sum(o_custkey * 100000) AS m FROM orders WHERE o_orderkey IN (SELECT run FROM v)),
l AS (SELECT sum(l_partkey * 1000) AS r, sum(l_suppkey * 1000) AS t FROM lineitem WHERE l_orderkey IN (SELECT run FROM v))
SELECT samples, round(m / 1e9, 2) AS mapped, round(r / 1e9, 2) AS raw, round(t / 1e9, 2) AS trimmed FROM a, l""")
def run_report_totals(t: Tables) -> DataFrame:
    return _report(t)[0]


@registry.query(RUNS + """, l AS (SELECT l_linenumber AS trim_mean_length, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT run FROM v) GROUP BY 1)
SELECT trim_mean_length, n, round(100 * n / sum(n) OVER (), 1) AS percent FROM l""")
def run_report_lengths(t: Tables) -> DataFrame:
    return _report(t)[1]


@registry.query("""
SELECT 'lang' AS "column", coalesce(lang, '') AS value, count(*) AS n FROM documents GROUP BY 2
UNION ALL SELECT 'source', coalesce(source, ''), count(*) FROM documents GROUP BY 2""")
def metadata_fill_statistics(t: Tables) -> DataFrame:
    return files.fill_statistics(t.documents, ["lang", "source"])


@registry.query("""
SELECT DISTINCT user_id AS unit, event_type AS step FROM events WHERE NOT (event_type IN ('view', 'click') AND user_id IN (SELECT user_id FROM events WHERE event_type = 'error'))""")
def flags_removed(t: Tables) -> DataFrame:
    flags = t.events.select(F.col("user_id").alias("unit"), F.col("event_type").alias("step")).distinct()
    return runtime.remove_flags(flags, flags.where("step = 'error'").select("unit"), ["view", "click"], ["signup", "view", "click", "purchase", "error"])


@registry.query("""
WITH b AS (SELECT unnest(['A', 'C', 'G', 'T']) AS x) SELECT p.x || q.x || r.x AS word FROM b p, b q, b r""")
def all_codons(t: Tables) -> DataFrame:
    return files.words(t.spark, "ACGT", 3)


@registry.query("""
SELECT n_nationkey, 'https://example.org/s/' || n_nationkey || '?sheet=' || replace(n_name, ' ', '+') AS url FROM nation""")
def sheet_links(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", files.link("https://example.org/s/%s?sheet=%s", F.col("n_nationkey"), F.col("n_name")).alias("url"))


@registry.query("""
SELECT o_orderkey, p || '/fastq/' || o AS fastq, p || '/references/' || r AS ref, p || '/processed/' || o AS bam, p || '/processed/' || o || '/trim' AS trim, p || '/processed/' || o || '/aligned' AS aligned,
  p || '/processed/' || o || '/aligned/ofst' AS ofst, p || '/processed/' || o || '/aligned/pshifted' AS pshifted, p || '/processed/' || o || '/aligned/cov_RLE' AS cov, p || '/processed/' || o || '/aligned/bigwig' AS bigwig
FROM (SELECT o_orderkey, '/data' AS p, lower(replace(trim(o_orderpriority), ' ', '_')) AS r, o_custkey || '-' || lower(replace(trim(o_orderpriority), ' ', '_')) AS o FROM orders)""")
def unit_folders(t: Tables) -> DataFrame:
    units = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("accession"), F.col("o_orderpriority").alias("organism"))
    return files.unit_paths(units, "/data/").drop("accession", "organism")
