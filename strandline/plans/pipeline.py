"""The stages from alignments to windows and from windows to corrected sequences, with resume."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import fusion, pileup
from strandline.operators.clusters import cluster_windows


class Stages:
    """Runs named stages into a folder, and reads a stage that is complete there for the same settings instead of running it again."""

    def __init__(self, spark: SparkSession, folder: str, settings: dict, force: bool = False) -> None:
        self.spark, self.folder, self.force, self.ran = spark, folder.rstrip("/"), force, []
        self.mark = hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]

    def __call__(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/{self.mark}/{name}"
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if self.force or not done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done):
            make().write.mode("overwrite").option("compression", "zstd").parquet(path)
            self.ran.append(name)
        return self.spark.read.parquet(path)


def default_scorer(alt: Column, depth: Column, bias: Column) -> Column:
    """Stands in for a trained model, which isn't part of the engine: a logistic curve over alternative share, depth and strand bias. A model may be a pandas UDF of the same three columns."""
    return 1 / (1 + F.exp(-(6.0 * alt + 0.05 * F.least(depth, F.lit(40.0)) + 2.0 * bias - 2.5)))


def scored(features: DataFrame, scorer=None) -> DataFrame:  # noqa: ANN001
    alt = F.greatest("snp_vaf_i", "ind_vaf_i", "snp_vaf_o", "ind_vaf_o")
    depth = F.col("depth_i") + F.col("depth_o")
    bias = F.greatest("snp_sb_i", "ind_sb_i", "snp_sb_o", "ind_sb_o")
    return features.withColumn("prob", (scorer or default_scorer)(alt, depth, bias))


def candidate_windows(aln: DataFrame, contigs: DataFrame, threshold: float = 0.5, scorer=None) -> DataFrame:  # noqa: ANN001
    """Pileup, features, scores, threshold and clustering: (contig, win_s, win_e, core_s, core_e, n)."""
    f = scored(pileup.features(pileup.pileup(aln, contigs), contigs), scorer).filter(F.col("prob") >= threshold)
    return cluster_windows(f, "contig", "pos")


def correct(windows: DataFrame, contigs: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Variants and the sequences they are written into, as resumable stages."""
    v = stages("variants", lambda: fusion.variants(windows))
    return v, stages("sequences", lambda: fusion.apply_variants(v, contigs))
