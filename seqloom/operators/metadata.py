"""Curation of sample metadata: filters, rule dictionaries, normalisation, uniqueness, merging into a master table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.functions import paste, sub_first
from seqloom.operators.common import numbered


@dataclass(frozen=True)
class Rule:
    """A value that a pattern stands for; earlier rules win."""

    pattern: str
    value: str


def filter_runs(df: DataFrame, organisms: Sequence[str] | None, layouts: Sequence[str], platforms: Sequence[str], organism: str = "organism", layout: str = "layout", platform: str = "platform", excluded: tuple[str, str] | None = None) -> DataFrame:
    """Rows of the wanted organisms (None: all), layouts and platforms; excluded: (column, text) that drops a row."""
    keep = F.col(layout).isin(*layouts) & F.col(platform).isin(*platforms)
    if organisms is not None:
        keep &= F.col(organism).isin(*organisms)
    if excluded:
        keep &= ~F.coalesce(F.contains(F.col(excluded[0]), F.lit(excluded[1])), F.lit(False))
    return df.where(keep)


def by_rules(rules: Sequence[Rule], *sources: str) -> Column:
    """The value of the first rule that matches, looked for in the sources in turn; empty where none does."""
    found = [F.coalesce(*(F.when(F.col(s).rlike(r.pattern), r.value) for r in rules)) for s in sources]
    return F.coalesce(*found, F.lit(""))


@dataclass(frozen=True)
class Annotation:
    """A column found by rules in source columns, one after another; ``unless``: a source and values that bar it as one."""

    column: str
    rules: Sequence[Rule]
    sources: Sequence[str]
    unless: tuple[str, Sequence[str]] | None = None


#: Columns that a curator fills later, empty at first; fixed names.
TO_FILL = ("KEEP", "UNIQUE", "CHECKED", "name", "not_unique")


def annotate(df: DataFrame, annotations: Sequence[Annotation], title: str, knock_out_pattern: str, study: str, order: Sequence[Column]) -> DataFrame:
    """df with the annotation columns, CONDITION and GENE of knock-outs, replicates numbered, and empty columns to fill.

    Later annotations may look into the columns of earlier ones. A knock-out's CONDITION is KO whatever the rules find; a
    library without type that names an inhibitor is a footprint library. Replicates are numbered anew in the studies that
    need it, if any title repeats at all. Sources that df lacks are left out.
    """
    for a in annotations:
        found = []
        for s in (c for c in a.sources if c in df.columns):
            value = F.coalesce(*(F.when(F.col(s).rlike(r.pattern), r.value) for r in a.rules))
            barred = F.col(s).isin(*a.unless[1]) if a.unless and a.unless[0] == s else F.lit(False)
            found.append(F.when(~barred, value))
        df = df.withColumn(a.column, F.coalesce(*found, F.lit("")))
    hit = F.coalesce(F.col(title).rlike(knock_out_pattern), F.lit(False))
    gene = F.when(hit, F.regexp_replace(F.col(title), knock_out_pattern, "")).otherwise("")
    condition = F.when(hit, "KO").otherwise(F.col("CONDITION") if "CONDITION" in df.columns else F.lit(""))
    df = df.withColumns({"GENE": gene, "CONDITION": condition})
    if {"LIBRARYTYPE", "INHIBITOR"} <= set(df.columns):
        df = df.withColumn("LIBRARYTYPE", F.when((F.col("LIBRARYTYPE") == "") & (F.col("INHIBITOR") != ""), "RFP").otherwise(F.col("LIBRARYTYPE")))
    if "REPLICATE" in df.columns:
        repeats = df.where(F.col(title).isNotNull()).groupBy(title).count().where("count > 1")
        df = df if repeats.isEmpty() else renumber_replicates(df, study, title, "REPLICATE", order)
    return df.withColumns({c: F.lit("") for c in TO_FILL})


def merged_curation(curated: DataFrame, table: DataFrame, key: str = "Run") -> DataFrame:
    """The table of all runs with a curator's rows in place of its own; new ones are added, columns that a side lacks are null."""
    kept = table.join(curated.select(key).distinct(), key, "left_anti")
    return curated.unionByName(kept, allowMissingColumns=True)


def invalid_rows(df: DataFrame, keys: Sequence[str], parts: Sequence[str], order: Sequence[Column], library_types: Sequence[str]) -> DataFrame:
    """Rows to keep that can't run, with their reasons: an unknown library type, or a name that an earlier row of the keys has."""
    kept = df.where(F.coalesce(F.col("KEEP").cast("boolean"), F.lit(False))).withColumn("name", sample_name(df, parts))
    kept = flag_repeats(kept, keys, "name", order)
    unknown = ~F.coalesce(F.col("LIBRARYTYPE").isin(*library_types), F.lit(False))
    reasons = F.array_compact(F.array(F.when(unknown, "library type"), F.when(F.col("not_unique"), "name")))
    return kept.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def curation_loop(load, validate, rounds: int = 10):
    """(valid, last invalid rows): a curator's table is loaded and validated again until it has no invalid rows."""
    bad = None
    for _ in range(rounds):
        bad = validate(load())
        if bad.isEmpty():
            return True, bad
    return False, bad


def knock_out(df: DataFrame, title: str, pattern: str) -> DataFrame:
    """condition KO, and the gene that the title names beside the pattern, where the title has it."""
    hit = F.col(title).rlike(pattern)
    gene = F.trim(F.regexp_replace(F.col(title), pattern, ""))
    return df.withColumn("condition", F.when(hit, "KO").otherwise("")).withColumn("gene", F.when(hit, gene).otherwise(""))


def sample_name(df: DataFrame, parts: Sequence[str]) -> Column:
    """Columns joined by _; a null reads NA, missing columns are left out."""
    return paste("_", *(c for c in parts if c in df.columns))


def flag_repeats(df: DataFrame, keys: Sequence[str], name: str, order: Sequence[Column]) -> DataFrame:
    """not_unique: an earlier row of the partition has the same name."""
    w = W.partitionBy(*keys, name).orderBy(*order)
    return df.withColumn("not_unique", F.row_number().over(w) > 1)


def renumber_replicates(df: DataFrame, study: str, title: str, replicate: str, order: Sequence[Column]) -> DataFrame:
    """Numbers within (study, title) in the studies that repeat a title or have no replicates at all."""
    per_title = F.count("*").over(W.partitionBy(study, title))
    rows = df.withColumn("_dup", per_title > 1)
    study_w = W.partitionBy(study)
    needs = F.bool_or(F.col("_dup")).over(study_w) | F.bool_and(F.coalesce(F.col(replicate), F.lit("")) == "").over(study_w)
    number = F.row_number().over(W.partitionBy(study, title).orderBy(*order)).cast("string")
    return rows.withColumn("_needs", needs).withColumn(replicate, F.when(F.col("_needs"), number).otherwise(F.col(replicate))).drop("_dup", "_needs")


#: Strains whose names are dropped; fixed values.
STRAINS = ("K.12", "BY4741", "H37Rv", "PAO1", "Go1")


#: Suffixes of names that are dropped, and the spellings of one virus; fixed values, so that names are the same.
SUBSTRAIN, STRAIN, SUBSPECIES, SARS2 = " substr\\..*", " str\\..*", " subsp\\..*", "(?i)coronavirus 2|sars cov 2"
#: What is left of empty and NA fields after joining; a fixed value, for the same reason.
GAPS = "^_|_$|^NA_|_NA$|^NA$|^_$|^__$|^___$"


def organism_cleanup(name: Column) -> Column:
    """Without substrain, known strain, strain and subspecies suffixes, in that order; the second SARS virus has one name."""
    virus = name.rlike(SARS2)
    strain = sub_first(F.regexp_replace(name, SUBSTRAIN, ""), f"(?i: ({'|'.join(STRAINS)}))")
    return F.when(virus, "Sars cov2").otherwise(F.regexp_replace(F.regexp_replace(strain, STRAIN, ""), SUBSPECIES, ""))


#: Spellings of inhibitors; fixed values.
INHIBITORS = {"CHX": "chx", "LTM": "ltm", "Harringtonine": "harr"}
#: Library types by long name; fixed values.
LIBRARY_TYPES = {"Ribo-seq": "RFP", "RNA-seq": "RNA"}


def recode(col: str, values: dict[str, str]) -> Column:
    """A column with some values replaced; the others stay."""
    table = F.create_map(*(F.lit(x) for kv in values.items() for x in kv))
    return F.coalesce(table[F.col(col)], F.col(col))


def without_gaps(text: Column, times: int, none: bool = False) -> Column:
    """Joined fields without empty and NA parts at either end; each pass takes what the one before laid bare."""
    gap = GAPS + ("|NONE_|_NONE" if none else "")
    return reduce(lambda c, _: F.regexp_replace(c, gap, ""), range(times), text)


def experiment_fields(df: DataFrame) -> DataFrame:
    """df with stage, condition and fraction from its annotation columns. The inhibitor joins the fraction where a study
    (study_accession) has another one than cycloheximide."""
    stage = without_gaps(paste("_", "CELL_LINE", "TISSUE"), 2, none=True)
    condition = without_gaps(paste("_", *(c for c in ("CONDITION", "GENE") if c in df.columns)), 4)
    plain = without_gaps(paste("_", "FRACTION", "TIMEPOINT", "BATCH"), 1)
    inhibitor = F.coalesce("INHIBITOR", F.lit(""))
    usual = F.bool_and(inhibitor.isin("chx", "CHX")).over(W.partitionBy("study_accession"))
    fraction = without_gaps(F.when(usual, plain).otherwise(F.concat(plain, F.lit("_"), inhibitor)), 4)
    return df.withColumns({"stage": stage, "condition": condition, "fraction": fraction})


def keep_split(df: DataFrame, library_types: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, kept rows of other library types, which are left out)."""
    kept = df.where(F.coalesce("KEEP", F.lit(False)))
    return kept.where(F.col("LIBRARYTYPE").isin(*library_types)), kept.where(~F.coalesce(F.col("LIBRARYTYPE").isin(*library_types), F.lit(False)))


def check_blacklist(ids: DataFrame, blacklist: DataFrame, id_col: str = "id") -> DataFrame:
    """ids as they are; the query fails where one of them is on the list."""
    bad = blacklist.select(F.col("id").alias(id_col), F.lit(True).alias("_bad")).distinct()
    joined = ids.join(bad, id_col, "left")
    return joined.where(F.when(F.col("_bad"), F.raise_error(F.concat(F.lit("on the blacklist: "), F.col(id_col)))).otherwise(F.lit(True))).drop("_bad")


def collection_name(organism: Column, kind: str) -> Column:
    """Name of an organism's merged track, collection or modalities."""
    name = F.regexp_replace(organism, " ", "_")
    return {"merged": F.concat(F.lit("all_merged-"), name), "modalities": F.concat(F.lit("all_merged-"), name, F.lit("_modalities")), "collection": F.concat(F.lit("all_samples-"), name)}[kind]


def kingdoms(species: DataFrame, table: DataFrame, key: str = "species") -> DataFrame:
    """species with the kingdom of its first entry in the table (species, kingdom, position); unknown where it has none."""
    first = table.groupBy(key).agg(F.min_by("kingdom", "position").alias("kingdom"))
    return species.join(first, key, "left").withColumn("kingdom", F.coalesce("kingdom", F.lit("unknown")))


def common_species_name(name: Column, known: dict[str, str]) -> Column:
    """A known common name, else the initial and the species."""
    pairs = F.create_map(*(F.lit(x) for kv in known.items() for x in kv))
    return F.coalesce(pairs[name], F.concat(F.substring(name, 1, 1), F.lit("."), F.regexp_replace(name, "^.* ", "")))


def auto_names(df: DataFrame, name: str, order: Sequence[Column], prefix: str = "sample_") -> DataFrame:
    """Empty names become prefix and a number that goes on after the largest such number in use."""
    used = F.regexp_extract(F.col(name), f"^{prefix}([0-9]+)$", 1)
    largest = df.agg(F.coalesce(F.max(F.when(used != "", used.cast("long"))), F.lit(0)).alias("_largest"))
    empty = F.coalesce(F.col(name), F.lit("")) == ""
    missing = numbered(df.where(empty), order, "_n").crossJoin(F.broadcast(largest))  # largest: one row
    filled = missing.withColumn(name, F.concat(F.lit(prefix), (F.col("_largest") + F.col("_n")).cast("string"))).drop("_n", "_largest")
    return df.where(~empty).unionByName(filled)


def duplicate_statistics(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Rows, distinct items (a null counts as one) and repeats of each key."""
    distinct = F.count_distinct(F.col(item)) + F.max(F.col(item).isNull().cast("int"))
    return df.groupBy(*keys).agg(F.count("*").alias("n"), distinct.cast("long").alias("n_distinct")).withColumn("n_duplicates", F.col("n") - F.col("n_distinct"))
