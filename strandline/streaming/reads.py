"""The stateless read filter over a stream of delivered files. An extension: the batch pipeline has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.runtime import scratch_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stream over the files of a table, which may be one file or a folder of them."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()
    reader = spark.readStream.schema(schema)
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def run_to_end(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over all that is there, exactly once into files of the shared scratch folder, and give those as a table."""
    import uuid

    spark = stream.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(path)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def primary_reads(stream: DataFrame) -> DataFrame:
    return stream.filter(F.col("flag").bitwiseAND(0x904) == 0)
