"""Every operator on empty tables, nulls in any column, repeated rows, very long values and other columns with the names it uses itself."""

from pyspark.sql import functions as F

from strandline.llm.bpe import count_tokens, encode_corpus, token_bytes
from strandline.llm.mixing import mix_report, mix_sources
from strandline.llm.multi_select import group_percentiles, merge_digests, regroup, value_digest
from strandline.llm.packing import pack_items
from strandline.llm.runs import collapse_runs
from strandline.llm.top_n import top_n_per_group
from strandline.llm.truncation import detect_truncation, length_spikes, truncation_report
from strandline.operators.key_quantiles import hot_keys, key_quantiles

#: Names of columns that operators make for themselves.
OWN = ["id", "s", "g", "j", "k", "n", "code", "weight", "size", "lo", "hi", "word", "item", "length", "block", "container", "offset", "piece", "share", "src", "ident", "text_hash", "bucket", "h", "u", "uid", "body", "line", "form", "key", "target", "rank"]


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in OWN if c not in df.columns])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_runs(spark):
    df = spark.createDataFrame([(1, [0, 0, 6, 0]), (1, [0, 0, 6, 0]), (None, [1, 1]), (2, None), (3, []), (4, [None, 2, None])], "ref bigint, seq array<tinyint>")
    want = [(1, 0, 3, 0, 3, 4), (4, 1, 1, 2, 1, 1), (None, 0, 1, 1, 2, 2)]
    assert rows(collapse_runs(clashing(df), "ref", "seq")) == want
    long_ = spark.createDataFrame([(5, [3] * 200_000)], "ref bigint, seq array<tinyint>")
    assert rows(collapse_runs(long_, "ref", "seq")) == [(5, 0, 199_999, 3, 200_000, 200_000)]
    assert collapse_runs(df.limit(0), "ref", "seq").count() == 0


def test_top_n(spark):
    data = [("a", 5, 1), ("a", 5, 1), ("a", 5, 2), ("a", None, 3), ("a", 7, None), (None, 9, 4), ("b", None, 5)]
    df = spark.createDataFrame(data, "name string, score bigint, row bigint")
    assert rows(top_n_per_group(clashing(df), "name", "score", "row", 2).select("name", "row")) == [("a", 1), ("a", 2), ("b", 5)]
    assert top_n_per_group(df.limit(0), "name", "score", "row", 2).count() == 0


def test_top_n_reads_fewer_rows_each_round(spark):
    df = spark.range(30_000).select(F.pmod("id", F.lit(7)).alias("grp"), (F.pmod(F.xxhash64("id"), F.lit(50))).alias("score"), "id")
    got = rows(top_n_per_group(df, "grp", "score", "id", 25, bits=2).select("grp", "id"))
    x = df.toPandas().sort_values(["grp", "score", "id"], ascending=[True, False, True])
    assert got == sorted(x.groupby("grp").head(25)[["grp", "id"]].itertuples(index=False, name=None), key=repr)


def test_percentiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 9), ("a", None), (None, 4), ("b", None)], "name string, value int")
    assert rows(group_percentiles(clashing(df), ["name"], "value", [0.5])) == [("a", 3, 0.5, 1), (None, 1, 0.5, 4)]
    assert group_percentiles(df.limit(0), ["name"], "value", [0.5]).count() == 0
    none = value_digest(df.limit(0), ["name"], "value")
    some = value_digest(df, ["name"], "value")
    assert rows(merge_digests(none, some)) == rows(some)
    assert rows(regroup(some, [])) == [(1, 2), (4, 1), (9, 1)]


def test_key_quantiles(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", float("nan")), ("a", None), (None, 2.0), ("b", None)], "name string, value double")
    got = rows(key_quantiles(clashing(df), "name", "value", [0.5]).select("name", "n_rows", "n_values", "quantile"))
    assert got == [("a", 3, 1, 1.5), ("b", 1, 0, None), (None, 1, 1, 2.0)]
    assert rows(hot_keys(clashing(df), "name", 0.3, "t")) == [("t", "a")]
    assert hot_keys(df.limit(0), "name", 0.3, "t").count() == 0


def test_packing(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, None, 25), (3, "b", None), (4, "b", -1), (None, "a", 3), (5, "a", 0)], "ref bigint, origin string, width int")
    got = rows(pack_items(clashing(df), "ref", "origin", "width", 10).select("ref", "piece", "n_pieces", "length", F.col("container").isNull()))
    assert got == [(1, 0, 1, 5, False), (2, 0, 3, 10, False), (2, 1, 3, 10, False), (2, 2, 3, 5, False), (3, 0, 0, 0, True), (4, 0, 0, 0, True), (5, 0, 0, 0, True)]
    assert pack_items(df.limit(0), "ref", "origin", "width", 10).count() == 0
    assert pack_items(df.filter("width is null"), "ref", "origin", "width", 10).count() == 1


TEXTS = [(1, "a", "One text."), (2, "a", "One text."), (3, None, "No source here."), (4, "a", None), (5, "a", ""), (6, "a", " \n\t "), (None, "b", "The second source."), (7, "b", "word " * 40_000)]


def _docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, source string, text string")


def test_tokens(spark):
    got = dict(rows(encode_corpus(clashing(_docs(spark)), "doc_id", "text").select("doc_id", F.size("ids"))))
    assert got[4] == got[5] == 0 and got[1] == got[2] > 0 and got[7] > 40_000 and len(got) == len(TEXTS)
    size = dict(rows(token_bytes(spark)))
    ids = {r.doc_id: r.ids for r in encode_corpus(_docs(spark), "doc_id", "text").collect()}
    assert all(sum(size[i] for i in ids[d]) == len((t or "").encode()) for d, _, t in TEXTS)
    assert encode_corpus(_docs(spark).limit(0), "doc_id", "text").count() == 0
    assert rows(count_tokens(_docs(spark).limit(0), ["doc_id"], "text")) == []


def test_mixing(spark):
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1), ("b", 0.5, 1), (None, 0.1, 1), ("c", None, 1), ("d", 0.2, None)], "source string, target_share double, max_repeats int")
    got = mix_sources(clashing(_docs(spark)), clashing(targets), total_tokens=10)
    # a copy counts as its first, a blank text has tokens, and null idents stay
    assert {(r.source, r.doc_id) for r in got.collect()} <= {("a", 1), ("a", 6), ("b", None), ("b", 7)}
    assert {r.source for r in mix_report(got, targets).collect()} == {"a", "b"}
    assert mix_sources(_docs(spark).limit(0), targets).count() == 0
    assert mix_sources(_docs(spark), targets.limit(0)).count() == 0


def test_truncation(spark):
    docs = clashing(_docs(spark))
    found = detect_truncation(docs)
    assert {r.doc_id for r in found.collect()} <= {7}
    report = {r.source: (r.texts, r.truncated) for r in truncation_report(docs, found).collect()}
    assert report[None] == (1, 0) and report["a"] == (4, 0)
    assert length_spikes(docs, "source", "text").count() == 0
    empty = _docs(spark).limit(0)
    assert detect_truncation(empty).count() == 0 and truncation_report(empty, detect_truncation(empty)).count() == 0
    nulls = _docs(spark).select("doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("text"))
    assert detect_truncation(nulls).count() == 0
