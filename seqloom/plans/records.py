"""Queries of the record, interval and signal operators: lineitem holds alignments and intervals, part the features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.functions import finite
from seqloom.operators import analysis, intervals, records
from seqloom.operators.common import argmax, numbered, running_total
from seqloom.plans.common import Registry, Tables

registry = Registry()
METRICS = """
sum(w)::BIGINT AS reads, count(*) AS sequences, coalesce(sum(w) FILTER (WHERE n > 0), 0)::BIGINT AS aligned, count(*) FILTER (WHERE n > 0) AS aligned_sequences,
  sum(w * n)::BIGINT AS alignments, sum(n)::BIGINT AS alignment_rows, coalesce(sum(w) FILTER (WHERE n = 1), 0)::BIGINT AS unique, count(*) FILTER (WHERE n = 1) AS unique_sequences,
  coalesce(sum(w) FILTER (WHERE n > 1), 0)::BIGINT AS multi, count(*) FILTER (WHERE n > 1) AS multi_sequences,
  round(100.0 * coalesce(sum(w) FILTER (WHERE n > 0), 0) / sum(w), 2) AS percent_aligned"""
READS = "WITH x AS (SELECT o_orderkey, o_orderstatus, o_orderkey % 5 + 1 AS w, coalesce(n, 0) AS n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"


def _reads(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 5 + 1).alias("weight"))


def _alignments(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))


def _intervals(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("long")
    return t.lineitem.select(F.col("l_returnflag").alias("chr"), F.col("l_linestatus").alias("strand"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + q - 1).alias("end"), q.alias("width"), F.col("l_orderkey"), "l_suppkey")


INTERVALS = "SELECT l_returnflag AS chr, l_linestatus AS strand, l_partkey AS start, l_partkey + l_quantity::BIGINT - 1 AS \"end\", l_quantity::BIGINT AS width, l_orderkey, l_suppkey FROM lineitem"


@registry.query(READS + " SELECT" + METRICS + " FROM x")
def alignment_metrics(t: Tables) -> DataFrame:
    return records.alignment_metrics(_reads(t), _alignments(t), "o_orderkey", "weight")


@registry.query(READS + " SELECT o_orderstatus," + METRICS + " FROM x GROUP BY 1")
def alignment_metrics_by_sample(t: Tables) -> DataFrame:
    return records.alignment_metrics(_reads(t), _alignments(t), "o_orderkey", "weight", ["o_orderstatus"])


@registry.query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (CASE WHEN l_linenumber % 2 = 0 THEN 4 ELSE 0 END) | (CASE WHEN l_returnflag = 'R' THEN 256 ELSE 0 END) | (CASE WHEN l_partkey % 7 = 0 THEN 2048 ELSE 0 END) AS flag FROM lineitem)
SELECT *, flag & 4 <> 0 AS is_unmapped, flag & 256 <> 0 AS is_secondary, flag & 2048 <> 0 AS is_supplementary, flag & 2308 = 0 AS is_primary FROM x""".replace("flag & 4 <> 0", "(flag & 4) <> 0").replace("flag & 256 <> 0", "(flag & 256) <> 0").replace("flag & 2048 <> 0", "(flag & 2048) <> 0").replace("flag & 2308 = 0", "(flag & 2308) = 0"))
def bam_flag_decode(t: Tables) -> DataFrame:
    flag = F.when(F.col("l_linenumber") % 2 == 0, 4).otherwise(0).bitwiseOR(F.when(F.col("l_returnflag") == "R", 256).otherwise(0)).bitwiseOR(F.when(F.col("l_partkey") % 7 == 0, 2048).otherwise(0))
    return records.decode_flags(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", flag.alias("flag")))


JUNCTIONS = """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 3 AS strand, l_partkey % 7 AS motif FROM lineitem),
d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE strand WHEN 1 THEN '+' WHEN 2 THEN '-' ELSE '*' END AS strand,
  ['non-canonical', 'GT/AG', 'CT/AC', 'GC/AG', 'CT/GC', 'AT/AC', 'GT/AT'][CASE WHEN strand = 2 AND motif IN (2, 4, 6) THEN motif - 1 ELSE motif END + 1] AS motif FROM x)
"""


def _junctions(t: Tables) -> DataFrame:
    return records.decode_junctions(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_linenumber") % 3).alias("strand"), (F.col("l_partkey") % 7).alias("motif")))


@registry.query(JUNCTIONS + "SELECT * FROM d")
def junction_decode(t: Tables) -> DataFrame:
    return _junctions(t)


@registry.query(JUNCTIONS + "SELECT strand, motif, count(*) AS n FROM d GROUP BY 1, 2")
def junction_motif_table(t: Tables) -> DataFrame:
    return _junctions(t).groupBy("strand", "motif").agg(F.count("*").alias("n"))


def _features(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey"), F.col("p_partkey").alias("b_start"), (F.col("p_partkey") + F.col("p_size") - 1).alias("b_end"))


OVERLAPS = f"WITH i AS ({INTERVALS}), h AS (SELECT i.*, p_partkey FROM i JOIN part ON start <= p_partkey + p_size - 1 AND p_partkey <= \"end\")"


def _overlaps(t: Tables) -> DataFrame:
    return intervals.overlap_join(_intervals(t), _features(t), [], 32)


@registry.query(OVERLAPS + """, n AS (SELECT strand, count(*) AS n_overlaps FROM h GROUP BY 1)
SELECT strand, n_overlaps FROM n ORDER BY n_overlaps DESC, strand LIMIT 1""")
def strand_mode_overlap(t: Tables) -> DataFrame:
    n = _overlaps(t).groupBy("strand").agg(F.count("*").alias("n_overlaps")).withColumn("g", F.lit(1))
    return argmax(n, ["g"], "n_overlaps", "strand").drop("g")


@registry.query(OVERLAPS + """
SELECT p_partkey, count(*) FILTER (WHERE chr = 'A') AS "A", count(*) FILTER (WHERE chr = 'N') AS "N", count(*) FILTER (WHERE chr = 'R') AS "R" FROM h GROUP BY 1""")
def region_count_table(t: Tables) -> DataFrame:
    return _overlaps(t).groupBy("p_partkey").pivot("chr", ["A", "N", "R"]).agg(F.count(F.lit(1))).fillna(0)


POSITIONS = f"WITH i AS ({INTERVALS}), p AS (SELECT chr, strand, unnest(range(start, \"end\" + 1)) AS pos FROM i), c AS (SELECT chr, strand, pos, count(*) AS score FROM p GROUP BY 1, 2, 3)"
STRANDED = ["chr", "strand"]


def _runs(t: Tables) -> DataFrame:
    return intervals.coverage(_intervals(t), STRANDED)


@registry.query(POSITIONS + " SELECT * FROM c")
def coverage_per_position(t: Tables) -> DataFrame:
    return intervals.positions(_runs(t), STRANDED)


@registry.query(POSITIONS + """, g AS (SELECT *, pos - row_number() OVER (PARTITION BY chr, strand, score ORDER BY pos) AS island FROM c)
SELECT chr, strand, min(pos) AS start, max(pos) AS "end", score FROM g GROUP BY chr, strand, score, island""")
def coverage_rle(t: Tables) -> DataFrame:
    return _runs(t)


@registry.query(POSITIONS + """, l AS (SELECT chr, max(pos) AS n FROM c GROUP BY 1),
t AS (SELECT chr, n, unnest(range(1, CAST(ceil(n / 500) AS BIGINT) + 1)) AS part FROM l)
SELECT t.chr, part, (part - 1) * 500 + 1 AS start, least(part * 500, n) AS "end", coalesce(sum(score), 0)::BIGINT AS score
FROM t LEFT JOIN c ON c.chr = t.chr AND CAST(ceil(c.pos / 500) AS BIGINT) = part GROUP BY 1, 2, 3, 4""")
def coverage_tiles(t: Tables) -> DataFrame:
    pos = intervals.positions(_runs(t), STRANDED)
    tiles = intervals.tiles(pos.groupBy("chr").agg(F.max("pos").alias("n")), "chr", "n", 500)
    scores = pos.groupBy("chr", F.ceil(F.col("pos") / 500).alias("part")).agg(F.sum("score").alias("score"))
    return tiles.join(scores, ["chr", "part"], "left").fillna(0, ["score"])


@registry.query(POSITIONS + """, w AS (SELECT 'A' AS chr, unnest(range(1, 101)) AS pos)
SELECT w.chr, w.pos, coalesce(sum(score), 0)::BIGINT AS score FROM w LEFT JOIN c ON c.chr = w.chr AND c.pos = w.pos AND strand = 'F' GROUP BY 1, 2""")
def coverage_dense_page(t: Tables) -> DataFrame:
    cover = intervals.positions(_runs(t).where("strand = 'F'"), ["chr"])
    tile = t.spark.range(1).select(F.lit("A").alias("chr"), F.lit(1).cast("long").alias("start"), F.lit(100).cast("long").alias("end"))
    return intervals.dense_page(cover, tile, ["chr"])


@registry.query(POSITIONS + """
SELECT pos - p_partkey AS distance, sum(score)::BIGINT AS score FROM c JOIN part ON abs(pos - p_partkey) <= 15 WHERE p_partkey - 15 >= 1 AND p_size = 10 GROUP BY 1""")
def anchor_window_meta(t: Tables) -> DataFrame:
    anchors = t.part.where("p_size = 10").select(F.col("p_partkey").alias("anchor"))
    return intervals.window_profile(intervals.positions(_runs(t), STRANDED), anchors, [], 15, 32)


@registry.query("""
SELECT l_orderkey, l_linenumber, l_partkey - (CASE WHEN l_quantity >= 28 THEN -12 ELSE -11 END) AS start, l_suppkey FROM lineitem WHERE l_quantity BETWEEN 26 AND 30""")
def psite_shift(t: Tables) -> DataFrame:
    r = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.lit("a").alias("lib"), F.col("l_quantity").cast("int").alias("length"), F.col("l_partkey").alias("start"))
    shifts = t.spark.range(26, 31).select(F.lit("a").alias("lib"), F.col("id").cast("int").alias("fraction"), F.when(F.col("id") >= 28, -12).otherwise(-11).alias("offsets_start"))
    return records.psite_shift(r, shifts, "lib", "length", "start").select("l_orderkey", "l_linenumber", "start", "l_suppkey")


@registry.query("""
WITH a AS (SELECT l_returnflag || l_linestatus AS lib, l_linenumber AS fraction, -12 AS offsets_start, 1 AS level FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
b AS (SELECT l_returnflag || l_linestatus AS lib, l_linenumber AS fraction, -11 AS offsets_start, 2 AS level FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2),
c AS (SELECT l_returnflag || l_linestatus AS lib, 28 AS fraction, -12 AS offsets_start, 3 AS level FROM lineitem GROUP BY 1),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT lib, fraction, offsets_start, level FROM u QUALIFY level = min(level) OVER (PARTITION BY lib)""")
def shift_fallback(t: Tables) -> DataFrame:
    li = t.lineitem.withColumn("lib", F.concat("l_returnflag", "l_linestatus"))
    level = lambda where, off: li.where(where).select("lib", F.col("l_linenumber").alias("fraction")).distinct().withColumn("offsets_start", F.lit(off))
    fixed = li.select("lib").distinct().withColumn("fraction", F.lit(28)).withColumn("offsets_start", F.lit(-12))
    return records.shift_fallback(level("l_returnflag = 'A'", -12), level("l_returnflag <> 'N'", -11), fixed)


FRAMES = """
WITH g AS (SELECT l_returnflag AS lib, l_quantity::INT AS length, (l_partkey % 3)::INT AS frame, sum(l_quantity) AS score FROM lineitem GROUP BY 1, 2, 3),
f AS (SELECT *, round(100.0 * score / sum(score) OVER (PARTITION BY lib), 6) AS percent, round(100.0 * (score / sum(score) OVER b), 6) AS percent_length, score = max(score) OVER b AS best_frame FROM g WINDOW b AS (PARTITION BY lib, length))
"""


def _frames(t: Tables) -> DataFrame:
    li = t.lineitem.withColumnRenamed("l_returnflag", "lib")
    return records.frame_table(li, "lib", F.col("l_quantity").cast("int"), F.pmod("l_partkey", F.lit(3)).cast("int"), F.col("l_quantity"))


@registry.query(FRAMES + "SELECT * FROM f")
def frame_distribution(t: Tables) -> DataFrame:
    return _frames(t)


@registry.query(FRAMES + """
SELECT lib, CASE WHEN bool_or(frame = 0 AND NOT best_frame AND percent_length < 33) OR count(*) FILTER (WHERE frame = 0 AND NOT best_frame) = 0 THEN 'warning' ELSE 'good' END AS verdict,
  count(*) FILTER (WHERE frame = 0 AND NOT best_frame) AS bad_lengths FROM f GROUP BY 1""")
def periodicity_verdict(t: Tables) -> DataFrame:
    return records.periodicity_verdict(_frames(t), "lib", 33.0)


@registry.query("SELECT l_partkey, l_quantity, l_linestatus, count(*) AS score FROM lineitem GROUP BY 1, 2, 3")
def cigar_collapse(t: Tables) -> DataFrame:
    return records.merge_records(t.lineitem, ["l_partkey", "l_quantity", "l_linestatus"], F.lit(1))


@registry.query("SELECT o_custkey AS study, l_partkey AS pos, sum(l_quantity)::BIGINT AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def merge_libs_per_study(t: Tables) -> DataFrame:
    x = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("study"), F.col("l_partkey").alias("pos"), "l_quantity")
    return records.merge_records(x, ["study", "pos"], F.col("l_quantity"))


@registry.query("""
SELECT n_name AS organism, l_returnflag AS library, sum(l_quantity)::BIGINT AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def merge_per_organism(t: Tables) -> DataFrame:
    # scores are summed by order before the joins, so the large table shuffles once, already reduced
    part = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("library")).agg(F.sum("l_quantity").alias("q"))
    x = part.join(t.orders, "o_orderkey").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return records.merge_records(x.withColumnRenamed("n_name", "organism"), ["organism", "library"], F.col("q"))


@registry.query("""
WITH f AS (SELECT l_suppkey AS feature, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS a, sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS n, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT CAST(feature AS VARCHAR) AS feature, coalesce(a, 0)::BIGINT AS "A", coalesce(n, 0)::BIGINT AS "N", coalesce(r, 0)::BIGINT AS "R" FROM f
UNION ALL SELECT 'total', sum(a)::BIGINT, sum(n)::BIGINT, sum(r)::BIGINT FROM f""")
def count_matrix_cbind(t: Tables) -> DataFrame:
    wide = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("feature")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity").cast("long")).fillna(0)
    total = wide.agg(*(F.sum(c).alias(c) for c in "ANR")).select(F.lit("total").alias("feature"), *"ANR")
    return wide.unionByName(total)


@registry.query("""
WITH n AS (SELECT l_suppkey, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1), m AS (SELECT n, count(*) AS k FROM n GROUP BY 1 ORDER BY k DESC, n LIMIT 1)
SELECT l_suppkey, n.n, m.n AS modal FROM n, m WHERE n.n <> m.n""")
def matrix_shape_check(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_linenumber").alias("n"))
    modal = argmax(n.groupBy("n").agg(F.count("*").alias("k")).withColumn("g", F.lit(1)), ["g"], "k", "n").select(F.col("n").alias("modal"))
    return n.crossJoin(F.broadcast(modal)).where("n <> modal")  # modal: one row


@registry.query("""
SELECT o_orderpriority AS contrast, o_orderstatus AS regulation, count(*) AS n FROM orders GROUP BY 1, 2""")
def contrast_summary(t: Tables) -> DataFrame:
    return analysis.contrast_summary(t.orders.select(F.col("o_orderpriority").alias("contrast"), F.col("o_orderstatus").alias("regulation")), "contrast", "regulation")


@registry.query("SELECT o_orderkey, o_custkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderstatus) > 5")
def groups_above(t: Tables) -> DataFrame:
    return analysis.groups_above(t.orders, ["o_custkey", "o_orderstatus"], 5).select("o_orderkey", "o_custkey")


@registry.query("""
SELECT l_suppkey AS gene, arg_max(l_partkey, struct_pack(q := l_extendedprice, p := -l_partkey)) AS peak, max(l_extendedprice) AS score FROM lineitem GROUP BY 1""")
def max_peak_per_gene(t: Tables) -> DataFrame:
    x = t.lineitem.select(F.col("l_suppkey").alias("gene"), F.col("l_partkey").alias("peak"), F.col("l_extendedprice").alias("score"))
    return argmax(x, ["gene"], "score", "peak")


@registry.query("""
SELECT regexp_replace(l_shipdate::VARCHAR[1:7], '-', '_') AS sample, l_partkey % 50 AS feature, sum(l_quantity)::BIGINT AS score FROM lineitem GROUP BY 1, 2""".replace("l_shipdate::VARCHAR[1:7]", "strftime(l_shipdate, '%Y-%m')"))
def replicate_merge(t: Tables) -> DataFrame:
    x = t.lineitem.select(F.regexp_replace(F.date_format("l_shipdate", "yyyy-MM"), "-", "_").alias("sample"), (F.col("l_partkey") % 50).alias("feature"), "l_quantity")
    return records.merge_records(x, ["sample", "feature"], F.col("l_quantity"))


@registry.query()
def region_ids(t: Tables) -> DataFrame:
    """Rows only: SQL has no SHA-512; the unit tests pin values."""
    blocks = F.collect_list(F.struct(F.col("start"), F.col("end")))
    x = _intervals(t).groupBy("l_orderkey", "chr", "strand").agg(blocks.alias("blocks"))
    return x.select("l_orderkey", "chr", "strand", analysis.region_id(F.col("blocks"), "A38", F.col("chr"), F.col("strand")).alias("id"))


@registry.query("SELECT doc_id, 'L' || CAST(round_even(log10(n_chars), 0) AS INT) AS bucket FROM documents")
def length_bucket(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", analysis.length_bucket(F.col("n_chars")).alias("bucket"))


@registry.query("""
WITH o AS (SELECT o_orderkey, o_totalprice, sum(o_totalprice) OVER (ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING) AS used FROM orders)
SELECT o_orderkey, round(used, 2) AS used FROM o WHERE used <= 1000000""")
def cumulative_budget(t: Tables) -> DataFrame:
    o = running_total(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice"), F.col("o_orderkey")], "o_totalprice", "used")
    return o.where("used <= 1000000").select("o_orderkey", F.round("used", 2).alias("used"))


@registry.query("""
WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_partkey) - 1 AS k FROM part)
SELECT p_partkey, k % 8 AS worker, row_number() OVER (PARTITION BY k % 8 ORDER BY k) AS turn FROM r""")
def interleave_order(t: Tables) -> DataFrame:
    r = numbered(t.part.select("p_partkey", "p_size"), [F.desc("p_size"), F.col("p_partkey")], "n").withColumn("k", F.col("n") - 1)
    return r.select("p_partkey", (F.col("k") % 8).alias("worker"), (F.floor(F.col("k") / 8) + 1).alias("turn"))


@registry.query("""
SELECT l_orderkey, l_linenumber, greatest(l_discount, l_tax) AS most, least(greatest(l_quantity, 10), 40) AS clamped, ceil(l_extendedprice / 1000)::BIGINT AS thousands FROM lineitem""")
def row_max_and_clamp(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.greatest("l_discount", "l_tax").alias("most"), F.least(F.greatest("l_quantity", F.lit(10.0)), F.lit(40.0)).alias("clamped"), F.ceil(F.col("l_extendedprice") / 1000).alias("thousands"))


@registry.query("""
SELECT p_partkey, kind, p_partkey AS start, p_partkey + p_size - 1 AS "end" FROM part, (SELECT unnest(['gene', 'transcript', 'exon', 'CDS']) AS kind)""")
def gtf_four_rows(t: Tables) -> DataFrame:
    kinds = F.explode(F.array(*map(F.lit, ("gene", "transcript", "exon", "CDS"))))
    return t.part.select("p_partkey", kinds.alias("kind"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size") - 1).alias("end"))


@registry.query("""
SELECT l_orderkey, l_linenumber, (l_partkey - l_suppkey) % 3 + CASE WHEN (l_partkey - l_suppkey) % 3 < 0 THEN 3 ELSE 0 END AS frame, isfinite(l_extendedprice / nullif(l_linenumber - 1, 0)) IS TRUE AS ok FROM lineitem""")
def finite_and_frame(t: Tables) -> DataFrame:
    ratio = F.try_divide(F.col("l_extendedprice"), F.col("l_linenumber") - 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.pmod(F.col("l_partkey") - F.col("l_suppkey"), F.lit(3)).alias("frame"), finite(ratio).alias("ok"))
