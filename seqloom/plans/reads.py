"""Queries of the reads operators, over the documents and conversations tables as reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.functions import approximate_positions, codons, digit_total, percent, strip_ends, subseq_safe
from seqloom.operators import demultiplexing, reads
from seqloom.operators.common import numbered
from seqloom.plans.common import Registry, Tables

registry = Registry()
SQUEEZE = "trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g'))"
#: A pattern for the reads of text tables, and candidates in place of sequencing adapters.
PATTERN = "thention and"
CANDIDATES = {"c1": "tion", "c2": "ement", "c3": "schich", "c4": "License"}


def squeezed(df: DataFrame) -> DataFrame:
    return df.withColumn("seq", F.trim(F.regexp_replace("text", "[ \\t\\n\\r]+", " ")))


@registry.query(f"""
WITH c AS (SELECT {SQUEEZE} AS seq, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT seq, n, row_number() OVER (ORDER BY n DESC, seq) AS number FROM c)
SELECT seq, n, number, 'seq' || number || '_x' || n AS header FROM r WHERE length(seq) >= 20""")
def read_collapse(t: Tables) -> DataFrame:
    return reads.recollapse(reads.collapse(squeezed(t.documents)))


@registry.query(f"""
WITH p AS (SELECT source, {SQUEEZE} AS seq, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT seq, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_parts FROM p GROUP BY 1""")
def two_level_collapse(t: Tables) -> DataFrame:
    parts = reads.collapse(squeezed(t.documents), keys=("source",))
    return parts.groupBy("seq").agg(F.sum("n").cast("long").alias("n"), F.count("*").alias("n_parts"))


@registry.query("""
WITH c AS (SELECT unnest([{'a': 'c1', 'p': 'tion'}, {'a': 'c2', 'p': 'ement'}, {'a': 'c3', 'p': 'schich'}, {'a': 'c4', 'p': 'License'}]) AS c),
n AS (SELECT c.a AS adapter, count(*) FILTER (WHERE contains(text, c.p)) AS n_reads FROM documents, c GROUP BY 1)
SELECT CASE WHEN n_reads > 0 THEN adapter ELSE 'disable' END AS adapter, n_reads FROM n ORDER BY n_reads DESC, adapter LIMIT 1""")
def adapter_detect(t: Tables) -> DataFrame:
    return reads.detect_adapter(t.documents, CANDIDATES, "text")


@registry.query("""
WITH h AS (SELECT CAST(ceil(instr(text, 'tion') / 50) AS BIGINT) AS bin, count(*) AS n FROM documents WHERE instr(text, 'tion') > 0 GROUP BY 1)
SELECT bin, n, round(100.0 * sum(n) OVER (ORDER BY bin) / (SELECT count(*) FROM documents), 6) AS cumulative_percent FROM h""")
def adapter_content_by_position(t: Tables) -> DataFrame:
    return reads.adapter_content(t.documents, "tion", 50, "text")


_BAD = " + ".join(f"(lead(ch, {i}) OVER w <> '{c}')::INT" for i, c in enumerate(PATTERN))
_APPROX = f"""
WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?s).')) AS ch, unnest(range(1, length(text) + 1)) AS p FROM documents),
m AS (SELECT doc_id, p, {_BAD} AS bad FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
h AS (SELECT documents.doc_id, count(p) AS n_hits, min(p) AS first_hit FROM documents LEFT JOIN (SELECT * FROM m WHERE bad <= 2) AS m USING (doc_id) GROUP BY 1)
"""


@registry.query(_APPROX + "SELECT doc_id, n_hits, first_hit FROM h")
def adapter_positions_approx(t: Tables) -> DataFrame:
    hits = t.documents.select("doc_id", approximate_positions("text", PATTERN, 2).alias("hits"))
    return hits.select("doc_id", F.size("hits").cast("long").alias("n_hits"), F.get("hits", F.lit(0)).cast("long").alias("first_hit"))


@registry.query(_APPROX + "SELECT doc_id, coalesce(first_hit, 0) AS first_hit FROM h")
def matcher_pandas_udf(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", reads.approximate_first_udf(PATTERN, 2)("text").cast("long").alias("first_hit"))


@registry.query("""
WITH r AS (SELECT text AS o, CASE WHEN instr(text, 'tion') = 0 THEN text ELSE substr(text, 1, instr(text, 'tion') - 1) END AS t FROM documents)
SELECT count(*) AS reads, count(*) FILTER (WHERE length(o) <> length(t)) AS trimmed,
  round(100.0 * count(*) FILTER (WHERE length(o) = length(t)) / count(*), 1) AS percent_untouched,
  count(*) FILTER (WHERE length(t) < 20) AS below_20, count(*) FILTER (WHERE length(t) = 0) AS empty,
  max(length(t)) AS max_length, round(avg(length(t)), 6) AS mean_length, median(length(t)) AS median_length FROM r""")
def adapter_trim_stats(t: Tables) -> DataFrame:
    return reads.trim_statistics(t.documents.withColumn("t", reads.trim_at(F.col("text"), F.instr("text", "tion"))), "text", "t")


@registry.query("""
SELECT len(regexp_extract_all(text, 'tion')) AS hits, count(*) AS n_reads FROM documents GROUP BY 1""")
def hits_per_read_histogram(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.regexp_count("text", F.lit("tion")).cast("long").alias("hits")).agg(F.count("*").alias("n_reads"))


@registry.query("""
WITH r AS (SELECT doc_id, regexp_replace(text, '[.]+$', '') AS seq FROM documents)
SELECT doc_id, length(seq) AS n, right(seq, 12) AS tail FROM r WHERE length(seq) >= 20""")
def polyn_trim(t: Tables) -> DataFrame:
    r = t.documents.select("doc_id", reads.polyn_trim(F.col("text"), "[.]", 1).alias("seq")).where(F.length("seq") >= 20)
    return r.select("doc_id", F.length("seq").cast("long").alias("n"), F.right("seq", F.lit(12)).alias("tail"))


@registry.query("""
SELECT conv_id, turn, CASE WHEN length(text) > 7 THEN substr(text, 4, length(text) - 7) ELSE '' END AS seq FROM conversations""")
def trim_flanks(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", strip_ends("text", 3, 4).alias("seq"))


@registry.query("""
SELECT conv_id, turn, substr(text, 1, 4) AS umi_5, CASE WHEN length(text) > 9 THEN substr(text, 5, length(text) - 9) ELSE '' END AS seq,
  CASE WHEN length(text) >= 5 THEN right(text, 5) ELSE text END AS umi_3 FROM conversations""")
def umi_strip(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.substring("text", 1, 4).alias("umi_5"), reads.strip_umi(F.col("text"), 4, 5).alias("seq"), F.right("text", F.lit(5)).alias("umi_3"))


@registry.query("""
WITH p AS (SELECT unnest(range(1, 9)) AS pos),
b AS (SELECT pos, lower(substr(text, pos, 1)) AS base, count(*) AS n FROM documents, p WHERE length(text) >= pos GROUP BY 1, 2),
s AS (SELECT pos, base, n / sum(n) OVER (PARTITION BY pos) AS share FROM b)
SELECT pos, string_agg(base, '' ORDER BY base) AS letters FROM s WHERE share >= 0.10 GROUP BY 1""")
def consensus_flank(t: Tables) -> DataFrame:
    return reads.consensus(t.documents.select(F.lower("text").alias("seq")), 8, 0.10)


@registry.query("""
SELECT doc_id, CASE WHEN least(length(text), n_chars - 10) >= greatest(1, doc_id % 30 - 5)
  THEN substr(text, greatest(1, doc_id % 30 - 5), least(length(text), n_chars - 10) - greatest(1, doc_id % 30 - 5) + 1) ELSE '' END AS seq FROM documents""")
def subseq_safe_ends(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", subseq_safe("text", F.col("doc_id") % 30 - 5, F.col("n_chars") - 10).alias("seq"))


@registry.query("""
SELECT substr(text, 1, 3) AS barcode, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, barcode LIMIT 10""")
def barcode_top10(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.substring("text", 1, 3).alias("barcode")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "barcode").limit(10)


_SHEET = """
WITH sheet AS (SELECT DISTINCT source AS lane, substr(lang, 1, 2) AS barcode, source || '-' || lang AS sample FROM documents WHERE lang IN ('en', 'fr')),
r AS (SELECT doc_id, source AS lane, substr(lang, 1, 2) AS barcode FROM documents),
m AS (SELECT doc_id, lane, barcode, coalesce(sample, 'unmatched') AS sample FROM r LEFT JOIN sheet USING (lane, barcode))
"""


def _sheet(t: Tables) -> tuple[DataFrame, DataFrame]:
    sheet = t.documents.where(F.col("lang").isin("en", "fr")).select(F.col("source").alias("lane"), F.substring("lang", 1, 2).alias("barcode"), F.concat_ws("-", "source", "lang").alias("sample")).distinct()
    return t.documents.select("doc_id", F.col("source").alias("lane"), F.substring("lang", 1, 2).alias("barcode")), sheet


@registry.query(_SHEET + "SELECT doc_id, lane, barcode, sample FROM m")
def demultiplex_assign(t: Tables) -> DataFrame:
    r, sheet = _sheet(t)
    return reads.demultiplex(r, sheet, "lane", "barcode").select("doc_id", "lane", "barcode", "sample")


@registry.query(_SHEET + "SELECT sample, count(*) AS reads FROM m GROUP BY 1")
def demultiplex_stats(t: Tables) -> DataFrame:
    return reads.demultiplex_table(*_sheet(t), "lane", "barcode")


@registry.query("""
WITH c AS (SELECT source, length(text) // 500 AS pos, sum(length(text)) AS value FROM documents GROUP BY 1, 2),
r AS (SELECT *, sum(value) OVER a AS s1, count(*) OVER a AS n1, sum(value) OVER b AS s, count(*) OVER b AS n FROM c
  WINDOW a AS (PARTITION BY source ORDER BY pos ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY source)),
g AS (SELECT source, pos, round(s1::DOUBLE * s1 / n1 + (s - s1)::DOUBLE * (s - s1) / (n - n1), 9) AS gain FROM r WHERE n > n1)
SELECT source, arg_max(pos, struct_pack(g := gain, p := -pos)) AS change_at FROM g GROUP BY 1""")
def barcode_changepoint(t: Tables) -> DataFrame:
    curves = t.documents.groupBy("source", F.expr("length(text) div 500").alias("pos")).agg(F.sum(F.length("text")).cast("double").alias("value"))
    return reads.change_point(curves, "source")


@registry.query("""
SELECT count(*) AS n, min(length(text)) AS q0, quantile_cont(length(text), 0.25) AS q25, median(length(text)) AS q50,
  round(avg(length(text)), 6) AS mean, quantile_cont(length(text), 0.75) AS q75, max(length(text)) AS q100 FROM documents""")
def read_length_summary(t: Tables) -> DataFrame:
    n = F.length("text")
    q = F.percentile(n, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = t.documents.agg(F.count("*").alias("n"), F.min(n).cast("long").alias("q0"), q.alias("q"), F.round(F.avg(n), 6).alias("mean"), F.max(n).cast("long").alias("q100"))
    return out.select("n", "q0", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), "mean", F.col("q")[2].alias("q75"), "q100")


@registry.query("""
WITH b AS (SELECT min(length(text)) AS a, max(length(text)) AS z FROM documents),
h AS (SELECT least(20, CAST(floor((length(text) - a) * 20.0 / (z - a)) AS BIGINT) + 1) AS bin, count(*) AS n FROM documents, b GROUP BY 1)
SELECT bin, n, round(n / sum(n) OVER (), 9) AS share FROM h""")
def read_length_histogram(t: Tables) -> DataFrame:
    n = F.length("text")
    bounds = t.documents.agg(F.min(n).alias("a"), F.max(n).alias("z"))
    bin_ = F.least(F.lit(20), F.floor((n - F.col("a")) * 20.0 / (F.col("z") - F.col("a"))) + 1).cast("long")
    h = t.documents.crossJoin(F.broadcast(bounds)).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))  # bounds: one row
    return h.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 9))


@registry.query("SELECT doc_id, md5(text) AS h FROM documents ORDER BY h, doc_id LIMIT 100")
def deterministic_sample(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5("text").alias("h")).orderBy("h", "doc_id").limit(100)


@registry.query("""
WITH p AS (SELECT * FROM documents ORDER BY doc_id LIMIT 200)
SELECT source, count(*) AS n_reads, CAST(sum(length(text)) AS BIGINT) AS bases FROM p GROUP BY 1""")
def prefix_limit_sample(t: Tables) -> DataFrame:
    first = t.documents.orderBy("doc_id").limit(200)
    return first.groupBy("source").agg(F.count("*").alias("n_reads"), F.sum(F.length("text")).cast("long").alias("bases"))


@registry.query("""
WITH c AS (SELECT unnest(list_transform(range(0, CAST(floor(length(text) / 3) AS BIGINT)), lambda i: substr(text, i * 3 + 1, 3))) AS codon FROM documents),
n AS (SELECT codon, count(*) AS n FROM c GROUP BY 1)
SELECT codon, n, round(100.0 * n / sum(n) OVER (), 9) AS percent FROM n""")
def codon_usage(t: Tables) -> DataFrame:
    n = t.documents.select(F.explode(codons("text")).alias("codon")).groupBy("codon").agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 9))


@registry.query("""
WITH c AS (SELECT doc_id, regexp_extract_all(text, '(?s)...') AS codons FROM documents)
SELECT doc_id, array_to_string(list_transform(codons, lambda c: CASE WHEN c LIKE 'The%' THEN 'T' WHEN c LIKE '% %' THEN '*' WHEN lower(c) LIKE 'th%' THEN 'h' ELSE 'X' END), '') AS protein FROM c""")
def codon_translate(t: Tables) -> DataFrame:
    def letter(c):
        return F.when(c.startswith("The"), "T").when(F.contains(c, F.lit(" ")), "*").when(F.lower(c).startswith("th"), "h").otherwise("X")

    return t.documents.select("doc_id", F.array_join(F.transform(codons("text"), letter), "").alias("protein"))


@registry.query("""
WITH c AS (SELECT doc_id, list_transform(range(0, CAST(floor(length(text) / 3) AS BIGINT)), lambda i: lower(substr(text, i * 3 + 1, 3))) AS c FROM documents),
p AS (SELECT doc_id, unnest(list_filter(range(1, len(c)), lambda i: c[i] = 'the' AND c[i + 1][1] = ' ')) AS i FROM c)
SELECT doc_id, i AS codon, i * 3 - 2 AS start_pos, i * 3 + 3 AS end_pos FROM p""")
def motif_pair_search(t: Tables) -> DataFrame:
    c = t.documents.select("doc_id", codons(F.lower("text")).alias("c"))
    pairs = c.select("doc_id", F.posexplode(F.arrays_zip(F.col("c").alias("a"), F.slice("c", F.lit(2), F.size("c")).alias("b"))).alias("i", "p"))
    hits = pairs.where("p.a = 'the' and substring(p.b, 1, 1) = ' '")
    i = (F.col("i") + 1).cast("long")
    return hits.select("doc_id", i.alias("codon"), (i * 3 - 2).alias("start_pos"), (i * 3 + 3).alias("end_pos"))


@registry.query("""
WITH h AS (SELECT doc_id, list_filter(range(1, length(text) - 2), lambda p: substr(text, p, 4) = 'tion' AND p >= 20) AS hits FROM documents)
SELECT doc_id, len(hits) AS n_hits, hits[1] AS first_hit FROM h""")
def list_filter_min_position(t: Tables) -> DataFrame:
    hits = F.filter(approximate_positions("text", "tion", 0), lambda p: p >= 20)
    return t.documents.select("doc_id", F.size(hits).cast("long").alias("n_hits"), F.get(hits, F.lit(0)).cast("long").alias("first_hit"))


@registry.query("""
SELECT source, lang, count(*) AS n, round(stddev_samp(n_chars), 6) AS sd, round((max(n_chars) - avg(n_chars)) / stddev_samp(n_chars), 6) AS top_z
FROM documents GROUP BY 1, 2 HAVING count(*) > 1 AND stddev_samp(n_chars) > 0""")
def grouped_apply_stats(t: Tables) -> DataFrame:
    n = F.col("n_chars")
    g = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"), F.round(F.stddev_samp(n), 6).alias("sd"), F.round((F.max(n) - F.avg(n)) / F.stddev_samp(n), 6).alias("top_z"))
    return g.where("n > 1 and sd > 0")


@registry.query("""
SELECT o_orderkey, spots, avg_len, header, header + 2 * (avg_len + 1) + header AS bytes_per_read,
  (header + 2 * (avg_len + 1) + header) * spots * 2 AS total FROM (
  SELECT o_orderkey, o_custkey AS spots, CAST(round_even(o_totalprice / 1000, 0) AS BIGINT) AS avg_len, length('@SRR') + length(CAST(o_orderkey AS VARCHAR)) + 2 AS header FROM orders)""")
def fastq_size_estimate(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("spots"), F.bround(F.col("o_totalprice") / 1000, 0).cast("long").alias("avg_len"), (F.lit(6) + F.length(F.col("o_orderkey").cast("string"))).cast("long").alias("header"))
    size = F.col("header") + 2 * (F.col("avg_len") + 1) + F.col("header")
    return o.withColumn("bytes_per_read", size).withColumn("total", size * F.col("spots") * 2)


@registry.query("""
SELECT doc_id, CAST(list_sum(list_transform(range(0, 18), lambda k: greatest(0, doc_id - CAST(pow(10, k) AS BIGINT) + 1))) AS BIGINT) AS digits FROM documents""")
def read_number_digits(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", digit_total(F.col("doc_id")).alias("digits"))


@registry.query("""
SELECT row_number() OVER (ORDER BY n_chars DESC, doc_id) AS number, doc_id, n_chars FROM documents""")
def global_numbering(t: Tables) -> DataFrame:
    return numbered(t.documents.select("doc_id", "n_chars"), [F.desc("n_chars"), F.col("doc_id")])


@registry.query("""
SELECT source, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 2) AS percent FROM documents GROUP BY 1""")
def reads_per_source(t: Tables) -> DataFrame:
    n = t.documents.groupBy("source").agg(F.count("*").alias("n"))
    return n.withColumn("percent", percent(F.col("n"), F.sum("n").over(W.partitionBy())))


@registry.query("""
WITH c AS (SELECT unnest(['th', 'an', 'er', 'on']) AS barcode, unnest([1, 2, 1, 2]) AS pool),
k AS (SELECT lang AS lane, barcode, pool FROM (SELECT DISTINCT lang FROM documents), c),
h AS (SELECT lang AS lane, text, instr(substr(text, 13), 'tion') AS p FROM documents),
b AS (SELECT lane, substr(text, 1, p + 11) AS x FROM h WHERE p > 0),
r AS (SELECT lane, right(x, 2) AS barcode, CASE WHEN length(x) - 2 > 5 THEN substr(x, 3, length(x) - 7) ELSE '' END AS seq FROM b)
SELECT 'pool' || pool AS sample, seq, count(*) AS n FROM r JOIN k USING (lane, barcode) GROUP BY 1, 2""")
def demultiplex_pools(t: Tables) -> DataFrame:
    barcodes = t.spark.createDataFrame([("th", 1), ("an", 2), ("er", 1), ("on", 2)], "barcode string, pool int")
    lanes = t.documents.select(F.col("lang").alias("lane")).distinct().crossJoin(F.broadcast(barcodes))
    control = lanes.select("lane", "barcode", F.concat_ws("-", "lane", "barcode").alias("sample"), F.concat(F.lit("pool"), F.col("pool").cast("string")).alias("final_sample"))
    reads_ = t.documents.select(F.col("lang").alias("lane"), F.col("text").alias("seq"))
    found = demultiplexing.assign(reads_, control, "tion", five=2, three=3, least=6, mismatches=0)
    return demultiplexing.collapsed(found, control)
