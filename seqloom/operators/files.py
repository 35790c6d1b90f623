"""Checks of the files that steps leave behind, local studies from listings, paths of units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.operators.common import numbered

#: Library strategies that studies may have; fixed values.
STRATEGIES = ("RNA-Seq", "Ribo-seq", "ssRNA-seq", "ncRNA-Seq", "miRNA-Seq", "OTHER")
GB = 1024**3
MB = 1024**2


def fastq_verdicts(runs: DataFrame, files: DataFrame, compressed: bool = True, suffix: str = ".fastq", packed: str = ".gz") -> DataFrame:
    """runs (run, paired) with verdict, ``keep`` and ``remove`` (sorted file names) from files (run, name).

    A run has one file, or two with mates; the layout must agree. A second file beside an unmarked one is a short version and
    goes, as does the unmarked file in the other packing. Verdicts: ok, layout (the number fits the other layout), missing
    (no file of the packing), invalid (anything else; all files of the packing go).
    """
    end, other = (suffix + packed, suffix) if compressed else (suffix, suffix + packed)
    names = files.groupBy("run").agg(F.array_sort(F.collect_set("name")).alias("_names"))
    df = runs.join(names, "run", "left").withColumn("_names", F.coalesce("_names", F.array().cast("array<string>")))
    name = lambda mate="": F.concat(F.col("run").cast("string"), F.lit(mate + end))
    df = df.withColumn("_mine", F.filter("_names", lambda x: F.endswith(x, F.lit(end))))
    short = F.col("_mine") == F.array_sort(F.array(name(), name("_1")))
    df = df.withColumn("_kept", F.when(short, F.array(name())).otherwise(F.col("_mine")))
    single, pair = F.col("_kept") == F.array(name()), F.col("_kept") == F.array(name("_1"), name("_2"))
    fits = F.when(F.col("paired"), pair).otherwise(single)
    verdict = F.when(F.size("_mine") == 0, "missing").when(fits, "ok").when(single | pair, "layout").otherwise("invalid")
    stray = F.filter("_names", lambda x: x == F.concat(F.col("run").cast("string"), F.lit(other)))
    df = df.withColumns({"verdict": verdict, "_stray": stray})
    none = F.array().cast("array<string>")
    bad = F.col("verdict") == "invalid"
    gone = F.when(bad, F.col("_mine")).otherwise(F.array_except("_mine", "_kept"))
    return df.select(*runs.columns, "verdict", F.when(bad, none).otherwise(F.col("_kept")).alias("keep"), F.array_sort(F.concat("_stray", gone)).alias("remove"))


def extracted_gb(estimate: Column, packed_bytes: Column, paired: Column, guess: float = 5.0, grows: float = 5.0) -> Column:
    """Gigabytes a run takes unpacked: its estimate, else a multiple of its packed size or a guess, twice that for mates."""
    rough = F.coalesce(grows * packed_bytes / GB, F.lit(guess))
    return F.coalesce(estimate, rough * F.when(paired, 2).otherwise(1))


def scratch_folder(needed_gb: Column, free_gb: Column, scratch: str, out: str) -> Column:
    """The scratch folder where what is needed fits in; the other where it doesn't or the free space isn't known."""
    return F.when(needed_gb <= free_gb, scratch).otherwise(out)


def alignment_problems(runs: DataFrame, files: DataFrame, suffix: str = ".bam") -> DataFrame:
    """Studies with n_runs, n_files, n_empty and ok, from runs (study, run) and files (run, name, length)."""
    bams = files.where(F.endswith("name", F.lit(suffix))).groupBy("run").agg(F.count("*").alias("_n"), F.count_if(F.col("length") == 0).alias("_empty"))
    found = runs.join(bams, "run", "left").groupBy("study")
    out = found.agg(F.count("*").alias("n_runs"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_files"), F.coalesce(F.sum("_empty"), F.lit(0)).alias("n_empty"))
    return out.withColumn("ok", (F.col("n_files") >= F.col("n_runs")) & (F.col("n_empty") == 0))


def control_problems(control: DataFrame, n_files: int) -> DataFrame:
    """(problem) of a sheet of pools (LANE, BARCODE, sample); no rows where it can be used. Missing columns are an error."""
    if missing := {"LANE", "BARCODE", "sample"} - set(control.columns):
        raise ValueError(f"the sheet lacks {sorted(missing)}")
    n = F.count("*")
    repeats = control.groupBy("sample").agg(n.alias("_n")).agg(F.max("_n").alias("_most"))
    sheet = control.agg(n.alias("_rows"), F.count_distinct(F.length("BARCODE")).alias("_lengths")).crossJoin(repeats)  # one row each
    checks = {"repeated sample": F.col("_most") > 1, "barcode lengths differ": F.col("_lengths") != 1, "as many files as samples": F.col("_rows") == n_files, "no files": F.lit(n_files < 1)}
    return sheet.select(F.explode(F.array_compact(F.array(*(F.when(c, k) for k, c in checks.items())))).alias("problem"))


def first_data_line(lines: DataFrame, comment: str = "#") -> DataFrame:
    """(file, line): the first line of each file of ``sources.lines`` that is no comment; a file without one is an error."""
    first = lines.groupBy("file").agg(F.min(F.when(~F.col("value").startswith(comment), F.col("line"))).alias("line"))
    none = F.raise_error(F.concat(F.lit("only comments in "), F.col("file"))).cast("long")
    return first.withColumn("line", F.coalesce("line", none))


def local_study(files: DataFrame, submission: Column, first_project: int = 0, layout: Column | None = None) -> DataFrame:
    """Runs of local files (path, length, mean_length): run, size_MB, avg_length, layout, submission, project.

    Files of one stem that end in 1 and 2 are mates and one run; sizes are whole MB of each file, added, and the length is
    that of the first mate. project goes on after first_project in the order of submissions. ok is false where the number of
    files isn't that of the layout (``layout``: what the caller says, SINGLE by default).
    """
    name = F.regexp_replace(F.regexp_extract("path", "([^/]*)$", 1), r"\.(?:fast[aq]|f[aq])(?:\.gz)?$", "")
    said = layout if layout is not None else F.lit("SINGLE")
    x = files.withColumns({"_name": name, "layout": said, "submission": submission})
    x = x.withColumn("run", F.when(F.col("layout") == "PAIRED", F.regexp_replace("_name", "_R?[0-9]+$", "")).otherwise(F.col("_name")))
    runs = x.groupBy("submission", "run", "layout").agg(
        F.sum(F.floor(F.col("length") / MB)).alias("size_MB"), F.min_by("mean_length", "_name").alias("avg_length"), F.count("*").alias("_n")
    )
    projects = numbered(runs.select("submission").distinct(), [F.col("submission")], "project").withColumn("project", F.col("project") + first_project)
    ok = F.col("_n") == F.when(F.col("layout") == "PAIRED", 2).otherwise(1)
    return runs.join(projects, "submission").select("run", "size_MB", "avg_length", "layout", "submission", "project", ok.alias("ok"))


def unit_paths(units: DataFrame, top: str, accession: str = "accession", organism: str = "organism", kind: str = "") -> DataFrame:
    """units with the folders of their raw files, references and results, and those below the last."""
    name = F.regexp_replace(F.concat_ws("-", F.col(accession), F.lower(F.regexp_replace(F.trim(organism), " ", "_"))), "_$", "")
    at = lambda *parts: F.regexp_replace(F.concat_ws("/", F.lit(top), *parts), "/+", "/")
    leaf = [name, *([F.lit(kind)] if kind else [])]
    df = units.withColumns({"fastq": at(F.lit("fastq"), *leaf), "ref": at(F.lit("references"), F.lower(F.regexp_replace(F.trim(organism), " ", "_"))), "bam": at(F.lit("processed"), *leaf)})
    below = lambda c, sub: F.concat(F.col(c), F.lit(f"/{sub}"))
    df = df.withColumns({"trim": below("bam", "trim"), "aligned": below("bam", "aligned")})
    return df.withColumns({c: below("aligned", sub) for c, sub in (("ofst", "ofst"), ("pshifted", "pshifted"), ("cov", "cov_RLE"), ("bigwig", "bigwig"))})


def track_paths(samples: DataFrame, library_types: Sequence[str], folder: str, order: Sequence[Column], files: DataFrame | None = None, below: str = "pshifted_merged", ext: str = ".ofst") -> DataFrame:
    """samples with the path of their merged track and rep, their number in the order. files (path): a track that isn't there is an error."""
    if len(library_types) != 1 or not library_types[0]:
        raise ValueError("samples of one library type are needed")
    path = F.concat_ws("/", F.col(folder), F.lit(below), F.lit(library_types[0] + ext))
    out = numbered(samples.withColumn("path", path), order, "rep")
    if files is None:
        return out
    there = out.join(files.select("path", F.lit(True).alias("_there")).distinct(), "path", "left")
    lost = F.raise_error(F.concat(F.lit("no track "), F.col("path"))).cast("string")
    return there.withColumn("path", F.when(F.col("_there"), F.col("path")).otherwise(lost)).drop("_there")


def master_collection(samples: DataFrame, metadata: DataFrame, order: Sequence[Column], key: str = "run") -> tuple[DataFrame, DataFrame]:
    """(all samples with unique fractions, their metadata in the same order with is_pshifted).

    samples: run, study (accession-organism), fraction, path. A fraction becomes fraction_study_number, without empty and NA
    begins; metadata of runs outside the samples goes.
    """
    rows = numbered(samples, order, "number")
    study = F.substring_index("study", "-", 1)
    joined = F.concat(F.coalesce("fraction", F.lit("NA")), F.lit("_"), study)
    named = F.regexp_replace(F.regexp_replace(joined, "^_", ""), "^NA_", "")
    rows = rows.withColumn("fraction", F.concat(named, F.lit("_"), F.col("number").cast("string")))
    shifted = rows.select(key, "number", F.endswith("path", F.lit("_pshifted.ofst")).alias("is_pshifted"))
    return rows, metadata.join(shifted, key)


def run_report(alignments: DataFrame, trims: DataFrame, valid: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row of totals in billions, percent of libraries by mean length) from alignments (sample, mapped) and trims
    (raw_library, raw_reads, trim_reads, trim_mean_length). valid (run): only its runs, unless none of a table is there."""
    if valid is not None:
        ids = valid.select("run").distinct()

        def among(df: DataFrame, run: Column) -> DataFrame:
            marked = df.withColumn("run", run).join(ids.withColumn("_valid", F.lit(True)), "run", "left").drop("run")
            any_ = marked.agg(F.count("_valid").alias("_any"))  # one row
            return marked.crossJoin(F.broadcast(any_)).where("_valid or _any = 0").drop("_valid", "_any")

        alignments = among(alignments, F.regexp_replace("sample", "collapsed_trimmed_|trimmed_|trimmed2_", ""))
        trims = among(trims, F.col("raw_library"))
    billions = lambda c: F.round(F.coalesce(F.sum(c), F.lit(0)) / 1e9, 2)
    totals = alignments.agg(F.count("*").alias("samples"), billions("mapped").alias("mapped")).crossJoin(trims.agg(billions("raw_reads").alias("raw"), billions("trim_reads").alias("trimmed")))
    n = trims.where("trim_mean_length is not null").groupBy("trim_mean_length").agg(F.count("*").alias("n"))
    return totals, n.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy()), 1))  # one row a length


def fill_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): rows by each value of each column; null and empty values are one, the empty text."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("x")).groupBy("x.column", "x.value").agg(F.count("*").alias("n"))


def words(spark, alphabet: Sequence[str], length: int) -> DataFrame:
    """(word): all words of a length over an alphabet, by the digits of their numbers; no product of tables."""
    base, letters = len(alphabet), F.array(*map(F.lit, alphabet))
    digit = lambda k: F.get(letters, ((F.floor(F.col("id") / base**k)) % base).cast("int"))
    return spark.range(base**length).select(F.concat(*(digit(k) for k in reversed(range(length)))).alias("word"))


def link(template: str, *parts: Column) -> Column:
    """An address by a template with %s for each part; parts are URL-encoded."""
    return F.format_string(template, *(F.url_encode(p.cast("string")) for p in parts))
