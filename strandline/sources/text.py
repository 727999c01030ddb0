"""Readers and writers of the text formats around the pipeline. All read and write in parallel; a record is never cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##FILTER=<ID=LowQual,Description="Low quality">',
    '##INFO=<ID=PROB,Number=1,Type=Float,Description="Probability of the called bases">',
    '##INFO=<ID=DELTA,Number=1,Type=Float,Description="Probability gained over the reference">',
    '##INFO=<ID=PHET,Number=1,Type=Float,Description="Probability of a heterozygous site">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSAMPLE",
]


def write_fasta(df: DataFrame, path: str, contig: str = "contig", seq: str = "seq", mode: str = "errorifexists") -> None:
    """Upper-case sequences, a line each; null sequences have no record."""
    rows = df.filter(F.col(seq).isNotNull()).select(F.concat(F.lit(">"), F.col(contig), F.lit("\n"), F.upper(seq)).alias("value"))
    rows.write.mode(mode).text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(contig, seq): records are parted at a line that begins with >, names cut at white space, lines joined."""
    r = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^>", "").alias("r")).filter("trim(r) <> ''")
    name = F.regexp_extract("r", r"^(\S*)", 1)
    body = F.regexp_replace(F.regexp_replace("r", r"^[^\n]*\n?", ""), r"\s+", "")
    return r.select(name.alias("contig"), body.alias("seq"))


def write_gfa(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows = df.filter("seq is not null").select(F.concat_ws("\t", F.lit("S"), "contig", "seq", F.concat(F.lit("LN:i:"), F.length("seq").cast("string"))).alias("value"))
    rows.write.mode(mode).text(path)


def read_gfa(spark: SparkSession, path: str) -> DataFrame:
    """(contig, seq) of the segment lines, those that begin with S."""
    f = F.split("value", "\t")
    return spark.read.text(path).filter(F.col("value").startswith("S")).select(f[1].alias("contig"), f[2].alias("seq"))


def write_bed(df: DataFrame, path: str, cols: list[str], mode: str = "errorifexists") -> None:
    df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in cols]).alias("value")).write.mode(mode).text(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """(contig, win_s, win_e, core_s, core_e, n): comments, blank lines and lines of fewer than five fields are skipped; a missing file is empty."""
    schema = "contig string, win_s bigint, win_e bigint, core_s bigint, core_e bigint, n int"
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    f = F.split("value", "\t")
    num = lambda i: F.try_element_at(f, F.lit(i)).try_cast("bigint")
    lines = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "") & (F.size(f) >= 5))
    return lines.select(f[0].alias("contig"), num(2).alias("win_s"), num(3).alias("win_e"), num(4).alias("core_s"), num(5).alias("core_e"), num(6).cast("int").alias("n"))


def haplotype_cluster(fields: Column) -> Column:
    return F.when(F.size(fields) >= 3, F.concat_ws("_", fields[1], fields[2])).otherwise(fields[1])


def read_haplotypes(spark: SparkSession, path: str) -> DataFrame:
    """(read, cluster) of lines with a read, a haplotype and perhaps a phase block; shorter lines are skipped."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.size(f) >= 2).select(f[0].alias("read"), haplotype_cluster(f).alias("cluster")).distinct()


def write_vcf(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rows: ordered text rows. The header goes into the first part by its place in the sort."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(0, i, x) for i, x in enumerate(VCF_HEADER)], "part int, i bigint, value string")
    body = rows.select(F.lit(1).alias("part"), F.monotonically_increasing_id().alias("i"), "value")
    head.unionByName(body).orderBy("part", "i").select("value").write.mode(mode).text(path)


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t")
    return spark.read.text(path).filter(~F.col("value").startswith("#")).select(f[0].alias("chrom"), f[1].cast("bigint").alias("pos"), f[3].alias("ref"), f[4].alias("alt"), f[5].cast("int").alias("qual"), f[9].alias("gt"))
