"""Padded shards of encoded windows, and the manifest that lists them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline import codes

SHARD_ROWS = 2000


def pad_shards(df: DataFrame, ident: str = "batch_id", seq: str = "ref_seq", rows: int = SHARD_ROWS) -> DataFrame:
    """Rows of a shard, of at most ``rows`` neighbouring idents, filled up with 7 to the shard's widest; null sequences are all padding."""
    s = df.withColumn("shard_id", F.floor(F.col(ident) / rows)).withColumn("width", F.coalesce(F.size(F.coalesce(seq, F.array().cast(df.schema[seq].dataType))), F.lit(0)))
    wide = s.groupBy("shard_id").agg(F.max("width").alias("max_w"))
    fill = F.array_repeat(F.lit(codes.BATCH_PAD).cast("tinyint"), F.col("max_w") - F.col("width"))
    return s.join(wide, "shard_id").withColumn(seq, F.concat(F.coalesce(seq, F.array().cast(df.schema[seq].dataType)), fill)).drop("width")


def write_shards(df: DataFrame, path: str, rows: int = SHARD_ROWS, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, max_w) of a folder of shards."""
    return spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.max(F.size("ref_seq")).alias("max_w"))


def write_manifest(m: DataFrame, path: str, mode: str = "errorifexists") -> None:
    m.write.mode(mode).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, n bigint, max_w int").json(path)
