"""Readers and writers of the flat files around sequence analyses, as DataFrames.

Text formats are read by Spark's own text and CSV sources, so files are split and compressed files (gz, bz2 by their
ending) are decoded in tasks. Nothing here reads a file in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.functions import seq as S

BLAST6 = "qseqid string, sseqid string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double"
#: Least read lengths: a FASTQ length counts its newline, so 49 letters pass where FASTA needs 50.
LEAST_FASTA, LEAST_FASTQ = 50, 49


def fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """def, seq. Records may span lines; headers may hold >, as only one at a line's start begins a record."""
    rows = spark.read.option("lineSep", "\n>").text(path)
    text = F.regexp_replace("value", r"^>", "")
    head = F.regexp_extract(text, r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace(text, r"^[^\n]*", ""), r"[\r\n]", "")
    return rows.where("value <> ''").select(head.alias("def"), body.alias("seq"))


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """name, seq, qual. Quality lines may begin with any mark, so records are told by line numbers: lines are numbered
    within their split, and splits of a file by what came before them."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    number = F.col("at") - F.col("first") + F.col("skip")
    placed = lines.join(offsets, ["file", "block"]).select("file", F.floor(number / 4).alias("record"), (number % 4).alias("line"), "value")
    part = lambda k: F.max(F.when(F.col("line") == k, F.col("value")))
    rows = placed.groupBy("file", "record").agg(part(0).alias("head"), part(1).alias("seq"), part(3).alias("qual"))
    return rows.where(F.col("head").startswith("@")).select(F.expr("substring(head, 2)").alias("name"), "seq", "qual")


def renamed_reads(reads: DataFrame, name: str, prefix: str, least: int) -> DataFrame:
    """name, seq: prefix.name with white space as dots, without reads that are too short."""
    return reads.where(F.length("seq") >= least).select(F.concat(F.lit(f"{prefix}."), F.regexp_replace(name, r"\s", ".")).alias("name"), "seq")


def inputs(spark: SparkSession, fasta_paths: list[str] = (), fastq_paths: list[str] = ()) -> DataFrame:
    """Reads of all files, each file once, numbered from 1 in the order given."""
    parts = [(p, fastq, "name", LEAST_FASTQ) for p in dict.fromkeys(fastq_paths)] + [(p, fasta, "def", LEAST_FASTA) for p in dict.fromkeys(fasta_paths)]
    out = None
    for k, (p, read, name, least) in enumerate(parts, 1):
        rows = renamed_reads(read(spark, p), name, str(k), least)
        out = rows if out is None else out.unionByName(rows)
    return out


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual and the tags: nm (NM), zr, zi, zf, zs."""
    f = F.split("value", "\t")
    tag = lambda name, kind: F.regexp_extract("value", rf"\t{name}:[if]:(-?[\d.]+)", 1).try_cast(kind)
    names = {"qname": "string", "flag": "int", "rname": "string", "pos": "long", "mapq": "int", "cigar": "string", "rnext": "string", "pnext": "long", "tlen": "long", "seq": "string", "qual": "string"}
    rows = spark.read.text(path).where(~F.col("value").startswith("@"))
    cols = [F.get(f, F.lit(k)).try_cast(kind).alias(name) for k, (name, kind) in enumerate(names.items())]
    return rows.select(*cols, tag("NM", "int").alias("nm"), tag("ZR", "int").alias("zr"), tag("ZI", "double").alias("zi"), tag("ZF", "int").alias("zf"), tag("ZS", "int").alias("zs"))


def blast6(spark: SparkSession, path: str | list[str], gaps: bool = False) -> DataFrame:
    """The twelve standard columns, the taxon and accession of the subject, the base header and offset of the query."""
    rows = spark.read.schema(BLAST6 + (", gaps long" if gaps else "")).option("sep", "\t").option("quote", "").csv(path)
    return rows.withColumns({"taxon": S.attribute("sseqid", "taxId").try_cast("long"), "base": F.regexp_replace("qseqid", r";coords=\d+", ""), "coords": F.coalesce(S.attribute("qseqid", "coords").try_cast("long"), F.lit(0))})


def kraken(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema("contig string, taxid long").option("sep", "\t").csv(path)


def taxdump(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """nodes (taxid, parent, rank), names (taxid, name; scientific names), merged (old, new) and delnodes (taxid)."""
    def read(name):
        return spark.read.text(f"{folder}/{name}.dmp").select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))

    col = lambda k: F.get("f", F.lit(k))
    return {
        "nodes": read("nodes").select(col(0).cast("long").alias("taxid"), col(1).cast("long").alias("parent"), col(2).alias("rank")),
        "names": read("names").where(col(3) == "scientific name").select(col(0).cast("long").alias("taxid"), col(1).alias("name")),
        "merged": read("merged").select(col(0).cast("long").alias("old"), col(1).cast("long").alias("new")),
        "delnodes": read("delnodes").select(col(0).cast("long").alias("taxid")),
    }


def ids(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct taxids of a list, without 0 and blanks."""
    return spark.read.text(path).select(F.trim("value").try_cast("long").alias("taxid")).where("taxid <> 0").distinct()


def genbank_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row a flat-file record: text, accession, definition, year, taxid."""
    rows = spark.read.option("lineSep", "\n//\n").text(path).select(F.concat(F.lit("\n"), F.col("value"), F.lit("\n")).alias("text"))
    flat = lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))
    return rows.where(F.col("text").contains("\nLOCUS ")).select(
        "text", F.regexp_extract("text", r"\nACCESSION\s+(\S+)", 1).alias("accession"),
        flat(F.regexp_extract("text", r"\nDEFINITION\s+((?:.*)(?:\n\s{2,}.*)*)", 1)).alias("definition"),
        S.safe_year(F.regexp_extract("text", r"\n(LOCUS.*)", 1)).alias("year"), F.regexp_extract("text", r'/db_xref="taxon:(\d+)"', 1).try_cast("long").alias("taxid"),
    )


def genbank_nucleotides(spark: SparkSession, path: str | list[str], year: int | None = None, least: int = 80) -> DataFrame:
    """def, checksum, seq of records with a taxon that are long enough and not younger than ``year``."""
    r = genbank_records(spark, path).where("taxid IS NOT NULL")
    if year is not None:
        r = r.where(F.col("year") <= year)
    seq = S.clean_bases(F.regexp_extract("text", r"(?s)\nORIGIN[^\n]*\n(.*)$", 1))
    name = F.concat(F.lit("gi|NEWDB|gb|"), "accession", F.lit("|"), S.sanitised("definition"), F.lit(";taxId="), F.col("taxid").cast("string"))
    rows = r.select(name.alias("def"), seq.alias("seq")).where(F.length("seq") >= least)
    return rows.select("def", S.checksum("seq").alias("checksum"), "seq")


def genbank_proteins(spark: SparkSession, path: str | list[str], year: int | None = None, least: int = 30) -> DataFrame:
    """def, checksum, seq of each coding feature with a translation; a feature's qualifiers are its own alone."""
    r = genbank_records(spark, path).where("taxid IS NOT NULL")
    if year is not None:
        r = r.where(F.col("year") <= year)
    feature = F.regexp_extract_all("text", F.lit(r"\n {5}CDS +([^\n]*(?:\n {6,}[^\n]*)*)"), F.lit(1))
    cds = r.select("accession", "definition", "taxid", F.explode(feature).alias("cds"))
    value = lambda key: F.regexp_replace(F.regexp_extract("cds", rf'/{key}="?([^"/]*)', 1), r"\s*\n\s+", "")
    location = F.regexp_replace(F.regexp_extract("cds", r"^([^/]*)", 1), r"\s", "")
    start = F.coalesce(F.regexp_extract("cds", r"/codon_start=(\d)", 1).try_cast("int"), F.lit(1)).cast("string")
    rows = cds.select("*", F.regexp_replace(value("translation"), r"\s", "").alias("seq")).where(F.length("seq") >= least)
    product = S.sanitised(F.regexp_replace(F.regexp_extract("cds", r'/product="([^"]*)"', 1), r"\s+", " "))
    name = F.concat(F.lit("GI|NEWPROTDB|"), "accession", F.lit("|"), F.regexp_replace(value("protein_id"), r"\s", ""), F.lit("|"), product, F.lit("|"), S.sanitised("definition"),
                    F.lit(";pos="), location, F.lit(";codonStart="), start, F.lit(";taxId="), F.col("taxid").cast("string"))
    return rows.select(name.alias("def"), S.checksum("seq").alias("checksum"), "seq")


def write_fasta(seqs: DataFrame, path: str, compression: str = "none") -> None:
    """Records sorted by header over all part files, which are in order."""
    seqs.orderBy("def").select(F.concat(F.lit(">"), F.col("def").cast("string"), F.lit("\n"), "seq")).write.option("compression", compression).text(path)


def kraken_fasta(dump: DataFrame) -> DataFrame:
    """def, seq with headers that name the accession and taxon (accession, taxid, seq)."""
    return dump.select(F.concat("accession", F.lit("|kraken:taxid|"), F.col("taxid").cast("string")).alias("def"), "seq")


def interleaved(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Forward and reverse halves of reads numbered from 0 (n)."""
    return reads.where("n % 2 = 0"), reads.where("n % 2 = 1")


def centroids(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Of a centroid list: parents (accession, name: lines Parent:, the fourth field is the accession) and children
    (accession, name: lines Child:, the third)."""
    lines = spark.read.text(path)
    field = lambda k: F.get(F.split("name", r"\|"), F.lit(k))
    kind = lambda mark, k: lines.where(F.col("value").startswith(mark)).select(F.expr(f"substring(value, {len(mark) + 1})").alias("name")).select(field(k).alias("accession"), "name")
    return kind("Parent:", 3), kind("Child:", 2)


def write_centroids(parents: DataFrame, children: DataFrame, path: str) -> None:
    """The same list: each parent (accession, name) before its children, in order of accessions."""
    rows = parents.select("accession", F.lit(0).alias("k"), F.concat(F.lit("Parent:"), "name").alias("value")).union(children.select("accession", F.lit(1), F.concat(F.lit("Child:"), "name")))
    rows.orderBy("accession", "k", "value").select("value").write.text(path)


def listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """name: the distinct lines of a list, such as what is to be skipped, without white space around them and empty ones."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''").distinct()


def listed_taxa(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """taxid: the distinct numbers of a list, such as a white list; the first field counts, lines without a number are left out."""
    return spark.read.text(path).select(F.regexp_extract("value", r"^\s*(\d+)\b", 1).alias("n")).where("n <> ''").select(F.col("n").cast("long").alias("taxid")).distinct()


def divisions(spark: SparkSession, path: str | list[str], known: list[str]) -> DataFrame:
    """name: the wanted divisions, each once and in lower case. One that is not known is an error when it is read."""
    rows = listed(spark, path).select(F.lower("name").alias("name")).distinct()
    wrong = F.raise_error(F.concat(F.lit("no such division: "), "name")).cast("string")
    return rows.select(F.when(F.col("name").isin(*known), F.col("name")).otherwise(wrong).alias("name"))


def without(rows: DataFrame, name: str, skipped: DataFrame) -> DataFrame:
    """Rows whose ``name`` is not on the list (name)."""
    return rows.join(skipped.select(F.col("name").alias(name)).distinct(), name, "left_anti").select(*rows.columns)


def to_all(rows: DataFrame, paths: list[str]) -> None:
    """Write the same rows to several places. They are computed once: the other places are filled from the first."""
    rows.write.parquet(paths[0])
    for p in paths[1:]:
        rows.sparkSession.read.parquet(paths[0]).write.parquet(p)


def shuffled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in an order by chance that a rerun with the same seed repeats."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)


def sam_slim(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """qname, rname, pos, cigar, seq of alignments alone: the CSV source parses no other field of a line, nor its tags."""
    fields = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string"
    rows = spark.read.schema(fields).option("sep", "\t").option("quote", "").option("comment", "@").option("mode", "PERMISSIVE").csv(path)
    return rows.select("qname", "rname", "pos", "cigar", "seq")
