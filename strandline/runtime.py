"""Session helpers shared by the operators: scratch tables, lineage cuts and skew-aware joins."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from decimal import Decimal
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A join side of at most this many narrow rows may be broadcast; the count is always checked first.
BROADCAST_ROWS = 200_000
#: A key with more rows than a task should take is hot. Of very many rows a key must hold one in HOT_PART, so that at most HOT_PART keys are hot.
ROWS_A_TASK, HOT_PART = 1_000_000, 200_000

_own_scratch: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where that is unset a temporary one on a local master, which goes when Python ends, and an error on any other."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _own_scratch[app], ignore_errors=True)
    return _own_scratch[app]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, as the driver's import path isn't theirs."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = re.sub(r"^file:/+", "/", scratch_dir(spark))
    # Spark serves the archive to its executors itself, so the driver's own folder will do where the scratch folder has no path
    folder = root if root.startswith("/") else tempfile.mkdtemp(prefix="spark-")
    os.makedirs(folder, exist_ok=True)
    home = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(f"{folder}/package-{uuid.uuid4().hex}", "zip", os.path.dirname(home), os.path.basename(home))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df to the shared scratch folder and read it back: the plan is cut, and the files outlive executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def release(*tables: DataFrame) -> None:
    """Remove the files of materialized tables that no later step reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def join_state(rows: DataFrame, state: DataFrame, keys: list[str], how: str, weight: str, total: int, limit: int = BROADCAST_ROWS, size: int | None = None) -> DataFrame:
    """Join many rows, perhaps skewed on keys, to a materialized state with few rows a key (null keys match).

    state carries in ``weight`` how many rows each key has of the ``total``; size is its own number of rows, if known. Within ``limit`` rows the state is
    broadcast. Beyond it only the hot keys are, of which there are at most HOT_PART; the others, none with more rows than a task
    should take, are joined by a shuffle. how is "inner" or "left".
    """
    bound = max(ROWS_A_TASK, total // HOT_PART)
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    right = state.withColumnsRenamed(names)

    def joined(part: DataFrame, side: DataFrame, kind: str) -> DataFrame:
        cond = reduce(lambda a, b: a & b, (part[k].eqNullSafe(side[n]) for k, n in names.items()))
        return part.join(side, cond, kind).drop(*names.values())

    if (state.count() if size is None else size) <= limit:
        return joined(rows, F.broadcast(right), how)
    hot = right.filter(F.col(weight) > bound)
    hot_keys = F.broadcast(hot.select(*names.values()).distinct())
    cond = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(hot_keys[n]) for k, n in names.items()))
    cold = rows.join(hot_keys, cond, "left_anti")
    return joined(rows, F.broadcast(hot), "inner").unionByName(joined(cold, right.filter(F.col(weight) <= bound), how))


@F.pandas_udf(T.LongType())
def _double_code(x: pd.Series) -> pd.Series:
    bits = (x.to_numpy(dtype="float64", na_value=np.nan) + 0.0).view("int64")
    code = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
    return pd.Series(code).astype("Int64").where(x.notna().to_numpy(), pd.NA)


@F.pandas_udf(T.DoubleType())
def _code_double(c: pd.Series) -> pd.Series:
    code = c.fillna(0).to_numpy(dtype="int64")
    bits = np.where(code < 0, code ^ np.int64(0x7FFFFFFFFFFFFFFF), code)
    return pd.Series(bits.view("float64")).where(c.notna().to_numpy(), None)


def order_code(df: DataFrame, column: str) -> Column:
    """A BIGINT that orders as the numeric column does; null and NaN give null. -0.0 counts as 0.0."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double_code(F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double")))
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{column} must be an integer or floating column, not {kind.simpleString()}")
    return F.col(column).cast("bigint")


def from_code(code: Column, kind: T.DataType) -> Column:
    return _code_double(code).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else code.cast(kind)


def exact_part(n: Column, prob: float) -> Column:
    """prob * n without rounding: prob as it is written, to 17 decimals, so that 0.07 of 100 is 7."""
    return n.cast("decimal(20,0)") * F.lit(Decimal(repr(float(prob))).quantize(Decimal(10) ** -17)).cast("decimal(18,17)")


def sum_before(df: DataFrame, keys: list[str], order: str, value: str, out: str, chunk: int = 4096) -> DataFrame:
    """df with the sum of value over the rows of the same keys before this one; (keys, order) must be unique, order a BIGINT >= 0.

    Two levels: sums of chunks of the order first, then within a chunk, so that no task sorts more than a chunk of rows or
    one row for each chunk.
    """
    a = df.withColumn("__chunk", F.floor(F.col(order) / chunk))
    sums = a.groupBy(*keys, "__chunk").agg(F.sum(value).alias("__sum"))
    past = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)]).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__past", F.coalesce(F.sum("__sum").over(past), F.lit(0))).drop("__sum")
    same = sums.withColumnsRenamed({k: f"__r_{k}" for k in keys} | {"__chunk": "__r_chunk"})
    cond = a["__chunk"] == same["__r_chunk"]
    for k in keys:
        cond &= a[k].eqNullSafe(same[f"__r_{k}"])
    inner = Window.partitionBy(*keys, "__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    b = a.join(same, cond).withColumn(out, F.col("__past") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return b.select(*df.columns, out)


def lookup(df: DataFrame, column: str, table_: DataFrame, key: str, limit: int = BROADCAST_ROWS, salts: int = 32) -> DataFrame:
    """Left join to a materialized table with unique keys: broadcast within the row limit.

    Beyond it the join shuffles, and df's rows of a key are spread over ``salts`` copies of its row in the table, so that a key
    with a third of all rows isn't worked by one task. Null keys match nothing and are spread as well. Where a row goes depends on its
    values alone (maps aside), so that a task which is run again sends it to the same place; rows equal in all columns go together.
    """
    if table_.count() <= limit:
        return df.join(F.broadcast(table_), df[column] == table_[key], "left")
    by = F.xxhash64(*(F.col(f.name) for f in df.schema if not re.search(r"\b(map|variant)\b", f.dataType.simpleString())), F.lit(17))
    spread = df.withColumn("__by", by).withColumn("__salt", F.pmod("__by", F.lit(salts)).cast("int"))
    copies = table_.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    nulls = spread.withColumn("__key", F.coalesce(F.col(column), F.concat(F.lit("\0"), F.pmod("__by", F.lit(1 << 20)).cast("string"))))
    return nulls.join(copies, (F.col("__key") == copies[key]) & (F.col("__salt") == F.col("__copy")), "left").drop("__by", "__key", "__salt", "__copy")
