"""Column functions over class probabilities and scores; arrays are indexed by base code from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(x: Column) -> Column:
    """Shifted by the maximum, so that large scores don't overflow."""
    e = F.transform(x, lambda v: F.exp(v.cast("double") - F.array_max(x).cast("double")))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def sigmoid(x: Column) -> Column:
    return F.when(x >= 0, 1 / (1 + F.exp(-x))).otherwise(F.exp(x) / (1 + F.exp(x)))


def argmax(p: Column) -> Column:
    """Index of the largest value, the first among equals."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def top2(p: Column) -> Column:
    """Indexes of the two largest values; among equals the larger index first."""
    ranked = F.reverse(F.array_sort(F.transform(p, lambda v, i: F.struct(v.alias("v"), i.alias("i")))))
    return F.transform(F.slice(ranked, 1, 2), lambda s: s["i"])


def margin(p: Column) -> Column:
    s = F.sort_array(F.transform(p, lambda v: v.cast("double")), asc=False)
    return s[0] - s[1]


def vote_weight(score: Column, coverage: Column, alpha: float = 3.0) -> Column:
    """exp(alpha * score), the exponent within 20, times ln(1 + coverage); 0.1 for a read without a score."""
    w = F.exp(F.greatest(F.lit(-20.0), F.least(F.lit(20.0), score * alpha))) * F.log1p(coverage)
    return F.when(score.isNull(), F.lit(0.1)).otherwise(w)


def fuse(p: Column, prior: Column) -> Column:
    product = F.zip_with(p, prior, lambda a, b: a.cast("double") * b)
    total = F.aggregate(product, F.lit(0.0), lambda a, b: a + b) + 1e-9
    return F.transform(product, lambda v: v / total)


def phred(p: Column) -> Column:
    """-10 log10 of the error, cut to an integer, at most 99; a FLOAT p is widened as it stands."""
    return F.least(F.lit(99), (-10 * F.log10(F.greatest(1 - p.cast("double"), F.lit(1e-10)))).cast("int"))


def genotype(p_het: Column) -> Column:
    return F.when(p_het >= 0.5, "0/1").otherwise("1/1")


def common_suffix(a: Column, b: Column) -> Column:
    """Length of the common end, leaving at least one letter of either."""
    most = F.least(F.length(a), F.length(b)) - 1
    return F.array_max(F.filter(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), lambda k: F.right(a, k) == F.right(b, k)))


def common_prefix(a: Column, b: Column) -> Column:
    most = F.least(F.length(a), F.length(b)) - 1
    return F.array_max(F.filter(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), lambda k: F.left(a, k) == F.left(b, k)))


def trim_alleles(ref: Column, alt: Column, pos: Column) -> Column:
    """struct<ref, alt, pos> without the common end, then without the common start, which moves pos."""
    cut = common_suffix(ref, alt)
    r, a = F.left(ref, F.length(ref) - cut), F.left(alt, F.length(alt) - cut)
    skip = common_prefix(r, a)
    return F.struct(F.substring(r, skip + 1, F.length(r)).alias("ref"), F.substring(a, skip + 1, F.length(a)).alias("alt"), (pos + skip).alias("pos"))
