import os
import random
import shutil
import subprocess
import sys
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strandline import runtime
from strandline.operators.key_quantiles import hot_keys, key_quantiles

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_ranks_are_exact(spark):
    df = spark.range(1, 101).select(F.lit("k").alias("k"), F.col("id").cast("int").alias("v"))
    probs = [0.07, 0.14, 0.28, 0.55, 0.56, 0.57, 0.58, 1e-9, 1.0]
    got = {r["prob"]: r["quantile"] for r in key_quantiles(df, "k", "v", probs).collect()}
    assert got == {0.07: 7, 0.14: 14, 0.28: 28, 0.55: 55, 0.56: 56, 0.57: 57, 0.58: 58, 1e-9: 1, 1.0: 100}


def test_hot_keys_against_counts(spark):
    rng = random.Random(3)
    for share in (0.05, 0.3):
        rows = [(rng.choice(["a"] * 30 + ["b"] * 6 + ["c", "d", "e", None, "f" + str(rng.randint(0, 50))]),) for _ in range(500)] + [("z",)] * 27
        n = Counter(k for k, in rows)
        df = spark.createDataFrame(rows, "k string").withColumn("n_rows", F.lit(1)).withColumn("code", F.lit(1)).withColumn("c", F.lit(1))
        # a hash of two bits makes every key share its place with others
        for bits in (2, 24):
            assert {r["contig"] for r in hot_keys(df, "k", share, "t", bits).collect()} == {k for k, c in n.items() if k is not None and c >= share * len(rows)}
    assert hot_keys(df.limit(0), "k", 0.05, "t").count() == 0
    assert hot_keys(df.withColumn("k", F.lit(None).cast("string")), "k", 0.05, "t").count() == 0


def test_joins_beyond_the_broadcast_limit(spark, monkeypatch):
    rows = spark.createDataFrame([("hot", i) for i in range(300)] + [("a", 1), ("b", 2), (None, 3)], "k string, i int")
    side = runtime.materialize(spark.createDataFrame([("hot", 300, "x"), ("a", 1, "y"), ("c", 5, "z"), (None, 1, "n")], "k string, w bigint, v string"))
    for hot_from in (1, 1_000_000):
        monkeypatch.setattr(runtime, "ROWS_A_TASK", hot_from)
        got = Counter((r["k"], r["v"]) for r in runtime.join_state(rows, side, ["k"], "left", "w", 303, limit=0).collect())
        assert got == {("hot", "x"): 300, ("a", "y"): 1, ("b", None): 1, (None, "n"): 1}
    keyed = side.filter("k is not null").withColumnRenamed("k", "key")
    for limit in (0, 10):
        got = Counter((r["k"], r["v"]) for r in runtime.lookup(rows, "k", keyed, "key", limit=limit).collect())
        assert got == {("hot", "x"): 300, ("a", "y"): 1, ("b", None): 1, (None, None): 1}


def test_lookup_places_rows_by_value(spark):
    """Beyond the limit no row goes by chance, so that a task run again sends it where it went; maps are no hindrance."""
    rows = spark.range(400).selectExpr("id", "if(id % 4 = 0, null, if(id % 4 = 1, 'b', 'hot')) as k", "array(id) as a", "map('x', id) as m")
    keyed = runtime.materialize(spark.createDataFrame([("hot", "x")], "key string, v string"))
    found = runtime.lookup(rows, "k", keyed, "key", limit=0)
    assert found.columns == ["id", "k", "a", "m", "key", "v"]
    assert "rand(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r["id"]: r["v"] for r in found.collect()} == {i: "x" if i % 4 > 1 else None for i in range(400)}
    assert found.count() == 400


def test_scratch(spark):
    t = runtime.materialize(spark.range(3))
    assert os.path.isdir(t.scratch_path) and t.count() == 3
    runtime.release(t)
    assert not os.path.isdir(t.scratch_path)
    none = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=none, sparkContext=SimpleNamespace(getConf=lambda: none, master="spark://host:7077", applicationId="x"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        runtime.scratch_dir(cluster)


def test_a_scratch_folder_with_one_slash_is_a_path(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    sent = []
    there = SimpleNamespace(get=lambda *_: f"file:{tmp_path}/shared")
    fake = SimpleNamespace(conf=there, sparkContext=SimpleNamespace(getConf=lambda: there, applicationId="y", addPyFile=sent.append))
    runtime.ship_package(fake)
    assert sent[0].startswith(f"{tmp_path}/shared/package-") and os.listdir(tmp_path) == ["shared"]


def test_entry_shows_errors_of_the_subpackage(tmp_path):
    shutil.copytree(f"{HOME}/strandline", f"{tmp_path}/strandline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{HOME}/__spark_entry__.py", tmp_path)
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    out = run()
    assert out.returncode == 0 and int(out.stdout) > 100, out.stderr
    os.makedirs(f"{tmp_path}/strandline/llm")
    (tmp_path / "strandline/llm/__init__.py").write_text("")
    (tmp_path / "strandline/llm/queries.py").write_text("import a_missing_module\n")
    out = run()
    assert out.returncode and "a_missing_module" in out.stderr
