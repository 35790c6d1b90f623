"""Readers and writers of sequence, alignment, annotation and report files. All of them read through Spark's own sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

JUNCTIONS = "chromosome string, intron_start int, intron_end int, strand int, motif int, annotated int, unique_reads int, multi_reads int, max_overhang int"
GTF = "chromosome string, source string, type string, start int, end int, score string, strand string, frame string, attributes string"
TRIM_REPORT = (
    "adapter_cutting struct<read1_adapter_sequence: string, adapter_trimmed_reads: bigint>, "
    "summary struct<before_filtering: struct<total_reads: bigint, read1_mean_length: double>, after_filtering: struct<read1_mean_length: double>>, "
    "read1_before_filtering struct<total_cycles: int>, "
    "read1_after_filtering struct<quality_curves: struct<mean: array<double>>, content_curves: struct<A: array<double>, C: array<double>, G: array<double>, T: array<double>>>"
)


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, seq) of each record. The separator is the begin of a record, so large files split."""
    records = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("value")).where(F.length(F.trim("value")) > 0)
    head = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.regexp_replace("value", "^[^\n]*", ""), "\\s+", "")
    return records.select(F.trim(head).alias("read_id"), body.alias("seq"))


def fastq_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, seq) of four-line records with a bare + line: split at that line, no shuffle, no qualities."""
    parts = spark.read.text(path, lineSep="\n+\n")
    found = parts.select(F.regexp_extract("value", r"(?:^|\n)@([^\n]*)\n([^\n]+)$", 1).alias("read_id"), F.regexp_extract("value", r"(?:^|\n)@([^\n]*)\n([^\n]+)$", 2).alias("seq"))
    return found.where("seq <> ''")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): lines with their number in the file, from 1. Blocks are counted first, one row each."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"))
    blocks = text.groupBy("file", "block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return text.join(blocks, ["file", "block"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"), "value")


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, read_id, seq, qual) of four-line records."""
    x = lines(spark, path).withColumn("record", F.expr("(line - 1) div 4 + 1"))
    part = lambda k: F.max(F.when((F.col("line") - 1) % 4 == k, F.col("value")))
    return x.groupBy("file", "record").agg(F.regexp_replace(part(0), "^@", "").alias("read_id"), part(1).alias("seq"), part(3).alias("qual")).where("seq is not null")


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment records of SAM text: the mandatory columns that analyses use, and the tags NH, HI, NM and AS."""
    f = F.split("value", "\t")
    tag = lambda name: F.nullif(F.regexp_extract("value", f"\t{name}:i:(-?[0-9]+)", 1), F.lit("")).cast("int")
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(f) >= 11))
    return rows.select(
        f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("rname"), f[3].cast("int").alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[9].alias("seq"),
        tag("NH").alias("NH"), tag("HI").alias("HI"), tag("NM").alias("NM"), tag("AS").alias("Alignment_score"),
    )


def junctions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=JUNCTIONS)


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Annotation rows with their attributes as a map (the first value of a repeated name)."""
    raw = spark.read.csv(path, sep="\t", schema=GTF, comment="#", quote="")
    pairs = F.regexp_extract_all("attributes", F.lit('([A-Za-z_]+) "([^"]*)"'), F.lit(0))
    names = F.transform(pairs, lambda p: F.substring_index(p, " ", 1))
    values = F.transform(pairs, lambda p: F.regexp_extract(p, '"([^"]*)"', 1))
    first = F.filter(F.arrays_zip(names.alias("key"), values.alias("value"), F.sequence(F.lit(1), F.greatest(F.size(pairs), F.lit(1))).alias("i")), lambda x: x["key"].isNotNull() & (F.array_position(names, x["key"]) == x["i"]))
    return raw.withColumn("attributes", F.map_from_entries(F.transform(first, lambda x: F.struct(x["key"], x["value"]))))


def gene_symbols(annotation: DataFrame) -> DataFrame:
    """One row a transcript of ``gtf``: its gene and names. Rows of a transcript agree, so any of them serves."""
    a = lambda k: F.element_at("attributes", k)
    rows = annotation.where("type <> 'gene'").select(a("gene_id").alias("ensembl_gene_id"), a("gene_name").alias("external_gene_name"), a("transcript_id").alias("ensembl_tx_name"))
    return rows.where("ensembl_tx_name is not null").dropDuplicates(["ensembl_tx_name"])


def report_section(spark: SparkSession, path: str, section: str) -> DataFrame:
    """(file, status, position, column, value) of a section ``>>name<TAB>status`` of text reports, header line first."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    body = F.regexp_extract("value", f"(?s)>>{section}\t([^\n]*)\n(.*?)\n>>END_MODULE", 2)
    x = whole.select("file", F.regexp_extract("value", f">>{section}\t([^\n]*)", 1).alias("status"), F.split(body, "\n").alias("lines"))
    x = x.withColumn("names", F.split(F.regexp_replace(F.get("lines", F.lit(0)), "^#", ""), "\t"))
    rows = x.select("file", "status", "names", F.explode(F.slice("lines", F.lit(2), F.greatest(F.lit(0), F.size("lines") - 1))).alias("row")).withColumn("cells", F.split("row", "\t"))
    cells = rows.select("file", "status", F.get("cells", F.lit(0)).alias("position"), F.explode(F.arrays_zip(F.col("names").alias("column"), F.col("cells").alias("value"))).alias("c"))
    return cells.select("file", "status", "position", "c.column", F.expr("try_cast(c.value as double)").alias("value")).where("column <> 'Position'")


def trim_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, schema=TRIM_REPORT, multiLine=True)


def table(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",") -> DataFrame:
    """A delimited table with a header; types are inferred where no schema is given."""
    reader = spark.read.option("header", True).option("sep", sep)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of the files below a folder; contents aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def write_fasta(df: DataFrame, path: str, header: str = "header", seq: str = "seq", mode: str = "errorifexists") -> None:
    df.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), F.col(seq)).alias("value")).write.mode(mode).text(path)


def write_fastq(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_bedgraph(runs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Coverage runs (chr, start, end, score), from 1 with ends included, as bedGraph lines (from 0, ends excluded)."""
    line = F.concat_ws("\t", "chr", (F.col("start") - 1).cast("string"), F.col("end").cast("string"), F.col("score").cast("string"))
    runs.select(line.alias("value")).write.mode(mode).text(path)


def write_gtf(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows of ``gtf``'s columns, attributes as a map."""
    attributes = F.array_join(F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('";'))), " ")
    columns = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("chromosome", "source", "type", "start", "end", "score", "strand", "frame")]
    rows.select(F.concat_ws("\t", *columns, attributes).alias("value")).write.mode(mode).text(path)


def bind_files(runs: DataFrame, files: DataFrame, run: str = "run", layout: str = "layout") -> DataFrame:
    """runs with their files: one for SINGLE, two for PAIRED (…_1 and …_2, or …_R1_001 and …_R2_001), matched by the name's
    begin up to the mate's suffix, an equi-join. ok is false where the number is wrong."""
    name = F.regexp_extract("path", "([^/]*)$", 1)
    stem = F.regexp_replace(name, r"(?:_R?[12](?:_001)?)?\.(?:fastq|fq|fasta|fa)(?:\.gz)?$", "")
    found = files.select(stem.alias(run), "path").groupBy(run).agg(F.array_sort(F.collect_list("path")).alias("files"))
    out = runs.join(found, run, "left").withColumn("files", F.coalesce("files", F.array().cast("array<string>")))
    return out.withColumn("ok", F.size("files") == F.when(F.col(layout) == "PAIRED", 2).otherwise(1))
