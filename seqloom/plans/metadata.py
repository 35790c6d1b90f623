"""Queries of the metadata operators: orders are runs, customers studies, nations organisms, parts titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.functions import basename, dirname, extension, half_even, paste, sentence_case, sub_first
from seqloom.operators import metadata as m
from seqloom.operators.common import add_if_absent, contains_join, drop_constant_columns, drop_null_columns, first_per_key, new_by_keys, numbered, ordered_lookup, same_set, union_fill
from seqloom.plans.common import Registry, Tables

registry = Registry()
RULES = [m.Rule("(?i)steel", "metal"), m.Rule("(?i)copper|brass|nickel", "alloy"), m.Rule("(?i)tin$", "tin"), m.Rule("(?i)^small", "small")]
NAME = ["o_orderstatus", "absent_column", "o_orderpriority", "clerk"]
SPECIES = {"FRANCE": "French", "GERMANY": "German", "CHINA": "Chinese"}


def runs(t: Tables) -> DataFrame:
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("organism"))
    customer = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


@registry.query("""
SELECT o_orderkey, n_name AS organism, o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN ('FRANCE', 'CHINA', 'BRAZIL', 'NATION_1', 'NATION_2') AND o_orderstatus IN ('O', 'F') AND c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AND NOT contains(o_orderpriority, 'LOW')""")
def metadata_filter(t: Tables) -> DataFrame:
    kept = m.filter_runs(runs(t), ["FRANCE", "CHINA", "BRAZIL", "NATION_1", "NATION_2"], ["O", "F"], ["BUILDING", "AUTOMOBILE"], layout="o_orderstatus", platform="c_mktsegment", excluded=("o_orderpriority", "LOW"))
    return kept.select("o_orderkey", "organism", "o_orderstatus", "c_mktsegment")


@registry.query("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS forced FROM customer")
def metadata_drop_null_columns(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_name", F.lit(None).cast("string").alias("empty"), F.lit(None).cast("string").alias("forced"))
    return drop_null_columns(df, ["forced"])


@registry.query("""
SELECT p_partkey, coalesce(
  CASE WHEN regexp_matches(p_name, '(?i)steel') THEN 'metal' END, CASE WHEN regexp_matches(p_name, '(?i)copper|brass|nickel') THEN 'alloy' END,
  CASE WHEN regexp_matches(p_name, '(?i)tin$') THEN 'tin' END, CASE WHEN regexp_matches(p_name, '(?i)^small') THEN 'small' END,
  CASE WHEN regexp_matches(p_type, '(?i)steel') THEN 'metal' END, CASE WHEN regexp_matches(p_type, '(?i)copper|brass|nickel') THEN 'alloy' END,
  CASE WHEN regexp_matches(p_type, '(?i)tin$') THEN 'tin' END, CASE WHEN regexp_matches(p_type, '(?i)^small') THEN 'small' END, '') AS kind FROM part""")
def metadata_annotate_rules(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", m.by_rules(RULES, "p_name", "p_type").alias("kind"))


ANNOTATIONS = [
    m.Annotation("TISSUE", [m.Rule("(?i)^cold", "liver"), m.Rule("(?i)^small", "brain")], ["p_name", "p_type"]),
    m.Annotation("INHIBITOR", [m.Rule("(?i)bolt", "chx")], ["p_name"]),
    m.Annotation("LIBRARYTYPE", [m.Rule("(?i)widget", "RNA"), m.Rule("(?i)promo", "SSU")], ["p_name", "absent", "p_type"], ("p_type", ["PROMO"])),
    m.Annotation("CONDITION", [m.Rule("(?i)large", "WT")], ["p_name"]),
    m.Annotation("REPLICATE", [m.Rule("(?i)gear", "1")], ["p_name"]),
]


@registry.query("""
WITH x AS (SELECT *, CASE WHEN regexp_matches(p_name, '(?i)^cold') THEN 'liver' WHEN regexp_matches(p_name, '(?i)^small') THEN 'brain' WHEN regexp_matches(p_type, '(?i)^cold') THEN 'liver' WHEN regexp_matches(p_type, '(?i)^small') THEN 'brain' ELSE '' END AS tissue,
  CASE WHEN regexp_matches(p_name, '(?i)bolt') THEN 'chx' ELSE '' END AS inhibitor,
  CASE WHEN regexp_matches(p_name, '(?i)widget') THEN 'RNA' WHEN regexp_matches(p_name, '(?i)promo') THEN 'SSU'
    WHEN p_type <> 'PROMO' AND regexp_matches(p_type, '(?i)widget') THEN 'RNA' WHEN p_type <> 'PROMO' AND regexp_matches(p_type, '(?i)promo') THEN 'SSU' ELSE '' END AS lib,
  regexp_matches(p_name, ' g.*') AS ko, CASE WHEN regexp_matches(p_name, '(?i)gear') THEN '1' ELSE '' END AS rep, count(*) OVER (PARTITION BY p_brand, p_name) > 1 AS dup FROM part),
n AS (SELECT *, bool_or(dup) OVER s OR bool_and(rep = '') OVER s AS needs FROM x WINDOW s AS (PARTITION BY p_brand))
SELECT p_partkey, tissue, inhibitor, CASE WHEN lib = '' AND inhibitor <> '' THEN 'RFP' ELSE lib END AS library_type, CASE WHEN ko THEN 'KO' WHEN regexp_matches(p_name, '(?i)large') THEN 'WT' ELSE '' END AS condition,
  CASE WHEN ko THEN regexp_replace(p_name, ' g.*', '') ELSE '' END AS gene,
  CASE WHEN needs AND (SELECT count(*) > count(DISTINCT p_name) FROM part) THEN CAST(row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS VARCHAR) ELSE rep END AS replicate FROM n""")
def annotate_runs(t: Tables) -> DataFrame:
    out = m.annotate(t.part, ANNOTATIONS, "p_name", " g.*", "p_brand", [F.col("p_partkey")])
    names = {"TISSUE": "tissue", "INHIBITOR": "inhibitor", "LIBRARYTYPE": "library_type", "CONDITION": "condition", "GENE": "gene", "REPLICATE": "replicate"}
    return out.select("p_partkey", *(F.col(k).alias(v) for k, v in names.items()))


@registry.query("""
WITH c AS (SELECT p_partkey, p_name, CASE WHEN p_size % 2 = 0 THEN 'RFP' ELSE 'SSU' END AS lib, p_brand || '_' || p_name AS name FROM part WHERE p_partkey % 3 <> 0),
f AS (SELECT *, row_number() OVER (PARTITION BY p_name, name ORDER BY p_partkey) > 1 AS again FROM c)
SELECT p_partkey, concat_ws('+', CASE WHEN lib <> 'RFP' THEN 'library type' END, CASE WHEN again THEN 'name' END) AS reasons FROM f WHERE lib <> 'RFP' OR again""")
def invalid_runs(t: Tables) -> DataFrame:
    df = t.part.withColumns({"KEEP": F.col("p_partkey") % 3 != 0, "LIBRARYTYPE": F.when(F.col("p_size") % 2 == 0, "RFP").otherwise("SSU")})
    bad = m.invalid_rows(df, ["p_name"], ["p_brand", "p_name"], [F.col("p_partkey")], ["RFP", "RNA"])
    return bad.select("p_partkey", F.array_join("reasons", "+").alias("reasons"))


@registry.query("""
SELECT p_partkey, CASE WHEN regexp_matches(p_name, '[_ #]?1[0-9]*$') THEN 'KO' ELSE '' END AS condition,
  CASE WHEN regexp_matches(p_name, '[_ #]?1[0-9]*$') THEN trim(regexp_replace(p_name, '[_ #]?1[0-9]*$', '')) ELSE '' END AS gene FROM part""")
def ko_extract(t: Tables) -> DataFrame:
    return m.knock_out(t.part, "p_name", "[_ #]?1[0-9]*$").select("p_partkey", "condition", "gene")


@registry.query("""
SELECT o_orderkey, o_orderstatus || '_' || o_orderpriority || '_NA' AS name,
  row_number() OVER (PARTITION BY o_custkey, o_orderstatus || '_' || o_orderpriority || '_NA' ORDER BY o_orderkey) > 1 AS not_unique FROM orders""")
def metadata_unique_flag(t: Tables) -> DataFrame:
    df = t.orders.withColumn("clerk", F.lit(None).cast("string"))
    df = df.withColumn("name", m.sample_name(df, NAME))
    return m.flag_repeats(df, ["o_custkey"], "name", [F.col("o_orderkey")]).select("o_orderkey", "name", "not_unique")


@registry.query("""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END AS rep, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) > 1 AS dup FROM orders),
b AS (SELECT *, bool_or(dup) OVER s OR bool_and(rep = '') OVER s AS needs FROM a WINDOW s AS (PARTITION BY o_custkey))
SELECT o_orderkey, CASE WHEN needs THEN CAST(row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS VARCHAR) ELSE rep END AS rep FROM b""")
def replicate_renumber(t: Tables) -> DataFrame:
    df = t.orders.withColumn("rep", F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")))
    return m.renumber_replicates(df, "o_custkey", "o_orderpriority", "rep", [F.col("o_orderkey")]).select("o_orderkey", "rep")


@registry.query("""
SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS n_distinct, count(*) - count(DISTINCT l_linenumber) AS n_duplicates FROM lineitem GROUP BY 1""")
def duplicate_run_stats(t: Tables) -> DataFrame:
    return m.duplicate_statistics(t.lineitem, ["l_orderkey"], "l_linenumber")


@registry.query("""
WITH e AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0), b AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0)
SELECT o_orderkey, 'new' AS part FROM b WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.o_custkey = b.o_custkey AND e.o_orderstatus = b.o_orderstatus)
  AND NOT EXISTS (SELECT 1 FROM e WHERE e.o_custkey = b.o_custkey AND e.o_orderpriority = b.o_orderpriority)
UNION ALL SELECT o_orderkey, NULL FROM e""")
def new_study_anti_join(t: Tables) -> DataFrame:
    existing, batch = t.orders.where("o_orderkey % 3 = 0"), t.orders.where("o_orderkey % 3 <> 0")
    new = new_by_keys(batch, existing, ["o_custkey", "o_orderstatus"], ["o_custkey", "o_orderpriority"]).withColumn("part", F.lit("new"))
    return union_fill(new.select("o_orderkey", "part"), existing.select("o_orderkey"))


@registry.query("""
SELECT o_orderkey, 'backup' AS origin FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'appended' FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 2 <> 0""")
def backup_append(t: Tables) -> DataFrame:
    backup = t.orders.where("o_orderkey % 2 = 0").select("o_orderkey")
    new = t.orders.where("o_orderkey % 5 = 0").select("o_orderkey").join(backup, "o_orderkey", "left_anti")
    return backup.withColumn("origin", F.lit("backup")).unionByName(new.withColumn("origin", F.lit("appended")))


@registry.query("""
WITH x AS (SELECT page_id, 'Genus species' || CASE page_id % 5 WHEN 0 THEN ' substr. K12 x' WHEN 1 THEN ' k-12 by4741' WHEN 2 THEN ' str. 7' WHEN 3 THEN ' subsp. a' ELSE ' Coronavirus 2' END AS name FROM pages)
SELECT page_id, CASE WHEN regexp_matches(name, '(?i)coronavirus 2|sars cov 2') THEN 'Sars cov2'
  ELSE regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, ' substr\\..*', ''), ' (K.12|BY4741|H37Rv|PAO1|Go1)', '', 'i'), ' str\\..*', ''), ' subsp\\..*', '') END AS organism FROM x""")
def organism_name_cleanup(t: Tables) -> DataFrame:
    k = F.col("page_id") % 5
    suffix = F.when(k == 0, " substr. K12 x").when(k == 1, " k-12 by4741").when(k == 2, " str. 7").when(k == 3, " subsp. a").otherwise(" Coronavirus 2")
    return t.pages.select("page_id", m.organism_cleanup(F.concat(F.lit("Genus species"), suffix)).alias("organism"))


_GAP = "'^_|_$|^NA_|_NA$|^NA$|^_$|^__$|^___$'"


@registry.query(f"""
WITH x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS condition, split_part(o_orderpriority, '-', 2) AS fraction FROM orders),
u AS (SELECT *, bool_and(coalesce(condition, '') IN ('chx', 'CHX')) OVER (PARTITION BY o_custkey) AS usual FROM x),
y AS (SELECT o_orderkey, coalesce(condition, 'NA') || '_NA' AS c, regexp_replace('NA_' || fraction || '_NA', {_GAP}, '', 'g') || CASE WHEN usual THEN '' ELSE '_' || coalesce(condition, '') END AS f FROM u)
SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(c, {_GAP}, '', 'g'), {_GAP}, '', 'g'), {_GAP}, '', 'g'), {_GAP}, '', 'g') AS condition,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(f, {_GAP}, '', 'g'), {_GAP}, '', 'g'), {_GAP}, '', 'g'), {_GAP}, '', 'g') AS fraction, 'liver' AS stage FROM y""")
def experiment_condition_fraction(t: Tables) -> DataFrame:
    c = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    na = F.lit(None).cast("string")
    df = t.orders.select("o_orderkey", F.col("o_custkey").alias("study_accession"), c.alias("CONDITION"), na.alias("GENE"), na.alias("FRACTION"), F.split("o_orderpriority", "-")[1].alias("TIMEPOINT"), na.alias("BATCH"), c.alias("INHIBITOR"), F.lit("NONE").alias("CELL_LINE"), F.lit("liver").alias("TISSUE"))
    return m.experiment_fields(df).select("o_orderkey", F.col("condition"), "fraction", "stage")


@registry.query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'done' ELSE o_orderstatus END AS status FROM orders")
def recode_values(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", m.recode("o_orderstatus", {"O": "open", "F": "done"}).alias("status"))


@registry.query("SELECT n_name, 'all_merged-' || replace(n_name, ' ', '_') AS merged, 'all_merged-' || replace(n_name, ' ', '_') || '_modalities' AS modalities, 'all_samples-' || replace(n_name, ' ', '_') AS collection FROM nation")
def collection_names(t: Tables) -> DataFrame:
    return t.nation.select("n_name", *(m.collection_name(F.col("n_name"), k).alias(k) for k in ("merged", "modalities", "collection")))


@registry.query("""
WITH k AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS kingdom FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT c_custkey AS species, coalesce(kingdom, 'unknown') AS kingdom FROM customer LEFT JOIN k ON o_custkey = c_custkey""")
def kingdom_lookup(t: Tables) -> DataFrame:
    table = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("species"), F.col("o_orderpriority").alias("kingdom"), F.col("o_orderkey").alias("position"))
    return m.kingdoms(t.customer.select(F.col("c_custkey").alias("species")), table)


@registry.query("""
SELECT o_custkey, bool_or(o_orderstatus = 'P') AS has_open, string_agg(DISTINCT o_orderstatus, '-' ORDER BY o_orderstatus) AS conditions,
  regexp_replace(min(o_orderpriority), '^[0-9]-', '') AS stage FROM orders GROUP BY 1""")
def experiment_fields(t: Tables) -> DataFrame:
    conditions = F.array_join(F.array_sort(F.collect_set("o_orderstatus")), "-")
    return t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "P").alias("has_open"), conditions.alias("conditions"), F.regexp_replace(F.min("o_orderpriority"), "^[0-9]-", "").alias("stage"))


@registry.query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE 'sample_' || o_orderkey END AS name FROM orders),
l AS (SELECT max(CAST(substr(name, 8) AS BIGINT)) AS k FROM o WHERE name <> '')
SELECT o_orderkey, name FROM o WHERE name <> '' UNION ALL
SELECT o_orderkey, 'sample_' || (k + row_number() OVER (ORDER BY o_orderkey)) FROM o, l WHERE name = ''""")
def auto_fill_names(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, "").otherwise(F.concat(F.lit("sample_"), F.col("o_orderkey").cast("string"))).alias("name"))
    return m.auto_names(o, "name", [F.col("o_orderkey")])


@registry.query("""
SELECT n_name AS study, string_agg(CAST(page_id AS VARCHAR), ',' ORDER BY page_id) AS files FROM nation JOIN pages ON page_id % 25 = n_nationkey AND contains(url, 'example') GROUP BY 1""")
def study_file_match(t: Tables) -> DataFrame:
    pages = t.pages.where(F.contains("url", F.lit("example"))).withColumn("k", (F.col("page_id") % 25).cast("int"))
    return pages.join(t.nation, F.col("k") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("study")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("page_id")), lambda x: x.cast("string")), ",").alias("files"))


@registry.query("SELECT p_partkey, r_name FROM part JOIN region ON contains(upper(p_name), substr(r_name, 2, 1))")
def substring_join(t: Tables) -> DataFrame:
    short = t.region.select("r_name", F.substring("r_name", 2, 1).alias("piece"))
    return contains_join(t.part, F.upper("p_name"), short, "piece").select("p_partkey", "r_name")


@registry.query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def files_missing(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey").join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@registry.query("""
SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS number,
  regexp_replace(regexp_replace('_NA_' || o_orderstatus || '_' || split_part(o_orderpriority, '-', 1), '^_', ''), '^NA_', '') AS fraction FROM orders""")
def collection_union_fraction(t: Tables) -> DataFrame:
    half = [t.orders.where(f"o_orderkey % 2 = {k}") for k in (0, 1)]
    rows = half[0].unionByName(half[1])
    fraction = paste("_", F.lit(""), F.lit(None).cast("string"), "o_orderstatus", F.split("o_orderpriority", "-")[0])
    rows = rows.select("o_custkey", "o_orderkey", F.regexp_replace(F.regexp_replace(fraction, "^_", ""), "^NA_", "").alias("fraction"))
    return numbered(rows, [F.col("o_custkey"), F.col("o_orderkey")])


@registry.query("""
SELECT o_orderstatus AS organism, count(*) AS n, count(DISTINCT o_orderpriority) AS n_types FROM orders GROUP BY 1 HAVING count(*) > 1""")
def modalities(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderstatus").alias("organism")).agg(F.count("*").alias("n"), F.count_distinct("o_orderpriority").alias("n_types")).where("n > 1")


@registry.query("""
WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, count(*) AS n_repeated FROM c WHERE n > 1 GROUP BY 1""")
def exp_modality_crosstab(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey", "o_orderstatus").count().where("count > 1").groupBy("o_custkey").agg(F.count("*").alias("n_repeated"))


@registry.query("""
WITH p AS (SELECT DISTINCT a.c_mktsegment AS x, b.c_mktsegment AS y FROM customer a JOIN customer b ON a.c_mktsegment < b.c_mktsegment)
SELECT CASE WHEN x IN ('AUTOMOBILE', 'BUILDING') THEN y ELSE x END AS a, CASE WHEN x IN ('AUTOMOBILE', 'BUILDING') THEN x ELSE y END AS b FROM p""")
def condition_pairs(t: Tables) -> DataFrame:
    from seqloom.operators.analysis import contrast_pairs

    return contrast_pairs(t.customer.select(F.col("c_mktsegment").alias("condition")), "condition", ["AUTOMOBILE", "BUILDING"])


@registry.query("""
WITH f AS (SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS first_order FROM orders GROUP BY 1)
SELECT c_custkey, first_order FROM customer LEFT JOIN f ON c_custkey = o_custkey""")
def ordered_lookup_first(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("first_order"))
    return ordered_lookup(t.customer.select("c_custkey"), orders, "c_custkey", [F.col("first_order")])


@registry.query("""
SELECT DISTINCT k FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 0 UNION SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
WHERE k IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') AND k NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def accessions_union(t: Tables) -> DataFrame:
    k = lambda df, c: df.select(F.col(c).alias("k"))
    both = k(t.orders.where("o_orderkey % 3 = 0"), "o_orderkey").union(k(t.lineitem.where("l_quantity > 45"), "l_orderkey")).distinct()
    return both.intersect(k(t.orders.where("o_orderstatus = 'O'"), "o_orderkey")).subtract(k(t.lineitem.where("l_returnflag = 'R'"), "l_orderkey"))


@registry.query("""
WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT only_a, only_b, only_a = 0 AND only_b = 0 AS equal FROM (SELECT count(*) AS only_a FROM a WHERE k NOT IN (SELECT k FROM b)), (SELECT count(*) AS only_b FROM b WHERE k NOT IN (SELECT k FROM a))""")
def set_equality_check(t: Tables) -> DataFrame:
    return same_set(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k")), "k")


@registry.query("SELECT DISTINCT p_partkey, p_brand FROM part WHERE p_size > 25 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 30)")
def canonical_semi_join(t: Tables) -> DataFrame:
    used = t.lineitem.where("l_quantity > 30").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.withColumn("keep", F.when(F.col("p_size") > 25, True)).where("keep").join(used, "p_partkey", "left_semi").select("p_partkey", "p_brand")


@registry.query("SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) + 100 AS code FROM customer")
def factor_code_offset(t: Tables) -> DataFrame:
    # codes are given to the distinct values, few, and joined back
    codes = t.customer.select("c_mktsegment").distinct().withColumn("code", (F.dense_rank().over(W.orderBy("c_mktsegment")) + 100).cast("long"))
    return t.customer.join(codes, "c_mktsegment").select("c_custkey", "code")


@registry.query("SELECT part, k FROM (SELECT 'distinct' AS part, p_brand AS k FROM (SELECT DISTINCT p_brand FROM part) UNION ALL SELECT 'head', CAST(o_orderkey AS VARCHAR) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5) UNION ALL SELECT 'tail', CAST(o_orderkey AS VARCHAR) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 5))")
def sorted_distinct_head_tail(t: Tables) -> DataFrame:
    part = lambda name, df: df.select(F.lit(name).alias("part"), df[df.columns[0]].cast("string").alias("k"))
    keys = t.orders.select("o_orderkey")
    return part("distinct", t.part.select("p_brand").distinct()).unionAll(part("head", keys.orderBy("o_orderkey").limit(5))).unionAll(part("tail", keys.orderBy(F.desc("o_orderkey")).limit(5)))


@registry.query("SELECT p_partkey, length(p_name) * 1000 - p_size AS rank_key FROM part ORDER BY rank_key DESC, p_partkey LIMIT 200")
def order_by_derived_key(t: Tables) -> DataFrame:
    key = (F.length("p_name") * 1000 - F.col("p_size")).cast("long")
    return t.part.select("p_partkey", key.alias("rank_key")).orderBy(F.desc("rank_key"), "p_partkey").limit(200)


@registry.query("""
SELECT o_orderstatus, count(*) AS n_orders, CAST(coalesce(sum(k), 0) AS BIGINT) AS n_items, round(coalesce(sum(k), 0) / count(*), 2) AS ratio
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS k FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""")
def ratio_report(t: Tables) -> DataFrame:
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("k"))
    joined = t.orders.join(items, "o_orderkey", "left")
    total = F.coalesce(F.sum("k"), F.lit(0))
    return joined.groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"), total.alias("n_items"), F.round(total / F.count("*"), 2).alias("ratio"))


@registry.query("""
SELECT n_name, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS sentence, lower(replace(trim(n_name), ' ', '_')) AS folder,
  CASE n_name WHEN 'FRANCE' THEN 'French' WHEN 'GERMANY' THEN 'German' WHEN 'CHINA' THEN 'Chinese' ELSE substr(n_name, 1, 1) || '.' || regexp_replace(n_name, '^.* ', '') END AS common FROM nation""")
def reference_folder_names(t: Tables) -> DataFrame:
    n = F.col("n_name")
    return t.nation.select("n_name", sentence_case("n_name").alias("sentence"), F.lower(F.replace(F.trim(n), F.lit(" "), F.lit("_"))).alias("folder"), m.common_species_name(n, SPECIES).alias("common"))


@registry.query("""
SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_extract(url, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(url, '\\.([A-Za-z0-9]+)$', 1) AS ext,
  len(regexp_extract_all(url, '/')) AS n_slashes, translate(url, ':/', '|_') AS flat, printf('page %05d', page_id) AS label, split_part(url, '/', 3) AS host,
  regexp_replace(url, 'e', 'E') AS first_e FROM pages""")
def string_template(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", basename("url").alias("base"), dirname("url").alias("dir"), extension("url").alias("ext"), F.regexp_count("url", F.lit("/")).cast("long").alias("n_slashes"),
        F.translate("url", ":/", "|_").alias("flat"), F.format_string("page %05d", "page_id").alias("label"), F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), sub_first("url", "e", "E").alias("first_e"),
    )


@registry.query("SELECT o_orderkey, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y%m%d-%H%M%S') AS stamp FROM orders")
def month_year_and_stamp(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "MM").alias("month"), F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "yyyyMMdd-HHmmss").alias("stamp"))


@registry.query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_linenumber = 1")
def drop_constants(t: Tables) -> DataFrame:
    return drop_constant_columns(t.lineitem.where("l_linenumber = 1").select("l_orderkey", "l_linenumber", "l_quantity"))


@registry.query("SELECT c_custkey AS id, upper(c_name) AS c_name, upper(c_mktsegment) AS c_mktsegment, 'x' AS extra, round_even(c_acctbal, 0) AS balance FROM customer")
def add_columns_if_absent(t: Tables) -> DataFrame:
    df = t.customer.withColumns({c: F.upper(c) for c in ("c_name", "c_mktsegment")}).withColumnRenamed("c_custkey", "id")
    df = add_if_absent(df, {"c_name": F.lit("lost"), "extra": F.lit("x")}).withColumn("balance", half_even("c_acctbal"))
    return df.select("id", "c_name", "c_mktsegment", "extra", "balance")


@registry.query("""
SELECT o_custkey AS accession, o_orderstatus AS organism, min(o_orderkey) AS first_order, count(*) AS n FROM orders GROUP BY 1, 2""")
def nested_unit_record(t: Tables) -> DataFrame:
    one = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.struct(F.min("o_orderkey").alias("first_order"), F.count("*").alias("n")).alias("u"))
    nested = one.groupBy(F.col("o_custkey").alias("accession")).agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "u"))).alias("organisms"))
    flat = nested.select("accession", F.explode("organisms").alias("organism", "u"))
    return flat.select("accession", "organism", "u.first_order", "u.n")


@registry.query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""")
def canonical_first_isoform(t: Tables) -> DataFrame:
    rows = first_per_key(t.lineitem, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")
