"""The queries of the core and their SQL for the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.key_quantiles import hot_keys, key_quantiles
from strandline.plans import alignment_queries, depth_queries, function_queries, fusion_queries, io_queries
from strandline.runtime import table

#: A key with at least this part of all rows is reported as hot.
HOT_SHARE = 0.05


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return hot_keys(table(spark, d, "depth_norm"), "contig", HOT_SHARE, "depth_norm").unionByName(hot_keys(table(spark, d, "encoded_batches"), "chrom", HOT_SHARE, "encoded_batches"))


def p2_depth_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Rows, values and quartiles of every contig's depths, whatever part of all rows it holds."""
    q = key_quantiles(table(spark, d, "depth_norm"), "contig", "raw_depth", [0.25, 0.5, 0.75])
    return q.select("contig", "n_rows", "n_values", "prob", F.col("quantile").alias("raw_depth"))


def p2_norm_quantiles(spark: SparkSession, d: str) -> DataFrame:
    q = key_quantiles(table(spark, d, "depth_norm"), "contig", "norm", [0.25, 0.5, 0.75])
    return q.select("contig", "n_rows", "n_values", "prob", F.col("quantile").alias("norm"))


QUERIES = {f.__name__: f for f in (p2_found, p2_depth_quantiles, p2_norm_quantiles)}


def _quartiles(value: str) -> str:
    return f"""select contig, count(*) as n_rows, count({value}) as n_values, unnest([0.25, 0.5, 0.75])::double as prob,
        unnest(quantile_disc({value}, [0.25, 0.5, 0.75])) as {value} from depth_norm group by contig"""


ORACLE = {
    "p2_found": """select 'depth_norm' as tbl, contig from depth_norm where contig is not null group by contig having count(*) >= 0.05 * (select count(*) from depth_norm)
        union all select 'encoded_batches', chrom from encoded_batches where chrom is not null group by chrom having count(*) >= 0.05 * (select count(*) from encoded_batches)""",
    "p2_depth_quantiles": _quartiles("raw_depth"),
    "p2_norm_quantiles": _quartiles("norm"),
}

for _part in (function_queries, alignment_queries, depth_queries, fusion_queries, io_queries):
    QUERIES |= _part.QUERIES
    ORACLE |= _part.ORACLE
