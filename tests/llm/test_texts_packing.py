import random

import pytest
from pyspark.sql import functions as F

from strandline.llm.bpe import Bpe, default_vocab, encode_corpus
from strandline.llm.mixing import mix_report, mix_sources, ramped, segments
from strandline.llm.packing import pack_items
from strandline.llm.truncation import detect_truncation, length_spikes, truncation_report


def test_packing(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["big", "big", "big", "a", None, ""]), rng.choice([None, 0, 1, 1024, 1025, 5000, rng.randint(1, 400)])) for i in range(800)]
    df = spark.createDataFrame([*rows, *rows[:50], (None, "a", 5)], "item bigint, block string, length int").withColumn("n_pieces", F.lit(3))
    got = pack_items(df, "item", "block", "length", 1024, block_items=200).collect()
    want = {i: n or 0 for i, _, n in rows}
    assert {r["item"] for r in got} == set(want)
    for i, n in want.items():
        mine = sorted((r["piece"], r["start"], r["length"]) for r in got if r["item"] == i)
        assert sum(x[2] for x in mine) == n and len(mine) == max(1, -(-n // 1024))
        assert [x[1] for x in mine] == [k * 1024 for k in range(len(mine))]
    bins = {}
    for r in got:
        if r["container"] is not None:
            bins.setdefault((r["block"], r["container"]), []).append((r["offset"], r["length"]))
    for spans in bins.values():
        spans.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[-1][0] + spans[-1][1] <= 1024
    assert sum(want.values()) / (1024 * len(bins)) > 0.97
    assert pack_items(df.limit(0), "item", "block", "length").count() == 0


def test_packing_keeps_shares(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b", 50) for i in range(4000)], "id bigint, src string, n int")
    p = pack_items(df, "id", "src", "n", 1000, block_items=1000).join(df, "id")
    shares = p.groupBy("block", "container").agg(F.sum("length").alias("all"), F.sum(F.when(F.col("src") == "b", F.col("n"))).alias("b"))
    # what a block has too little or too much of shows in its last containers only
    mid = [r["b"] for r in shares.filter("all = 1000").orderBy("block", "container").collect()]
    assert sum(200 <= (x or 0) <= 300 for x in mid) >= 0.9 * len(mid)


def test_sources_without_a_claim_only_fill(spark):
    rng = random.Random(12)
    rows = [(i, f"s{i % 50}", rng.randint(20, 700)) for i in range(3000)]
    rows += [(5000 + i, "none", rng.randint(1, 700)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, src string, n int")
    p = pack_items(df, "id", "src", "n", 1024, {f"s{k}": 0.02 for k in range(50)}, block_items=3000).join(df.withColumnRenamed("id", "i"), F.col("id") == F.col("i"))
    c = p.groupBy("block", "container").agg(F.sum("length").alias("used"), F.sum(F.when(F.col("src") == "none", F.col("length")).otherwise(0)).alias("free"))
    named = c.filter("free < used")
    total, free = named.agg(F.sum("used"), F.sum("free")).first()
    # beside fifty sources that are owed the one without a claim fills what none of their items fits
    assert free < 0.03 * total
    assert c.agg(F.sum("used") / (F.count("*") * 1024)).first()[0] > 0.97


def test_many_sources_keep_their_shares(spark):
    rng = random.Random(13)
    share = {f"s{k}": (k + 1) / 5050 for k in range(100)}
    rows = [(i, rng.choice(list(share)), rng.randint(5, 60)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, src string, n int")
    p = pack_items(df, "id", "src", "n", 1024, share, block_items=6000).join(df.withColumnRenamed("id", "i"), F.col("id") == F.col("i"))
    # the largest source of 200 or so containers' worth is used up first; before that each has its share to two items
    end = p.groupBy("src").agg(F.max("container").alias("last")).agg(F.min("last")).first()[0]
    got = {r["src"]: r["n"] for r in p.filter(F.col("container") < end).groupBy("src").agg(F.sum("length").alias("n")).collect()}
    total = sum(got.values())
    assert end > 20 and all(abs(got.get(s, 0) - w * total) <= 130 for s, w in share.items())


def test_tokens_match_the_public_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(default_vocab())
    t.encode_special_tokens = True
    texts = [None, "", " ", "a", "Hello, world's  end\n\n ", "<|endoftext|> x", "-" * 3000, "ab" * 700 + "a", "日本語のテキスト" * 90, "é" * 300, "x" * 100_000, "😀🙂" * 50, "\r\n\t 1234567"]
    df = spark.createDataFrame([*enumerate(texts), (None, "null id"), (3, "again")], "doc_id bigint, text string").withColumn("ids", F.lit(1)).withColumn("id", F.lit(2))
    got = encode_corpus(df, "doc_id", "text").collect()
    by = {r["doc_id"]: r["ids"] for r in encode_corpus(df.limit(len(texts)), "doc_id", "text").collect()}
    for i, x in enumerate(texts):
        assert by[i] == t.encode(x or "", add_special_tokens=False).ids
    assert len(got) == len(texts) + 2
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0


def test_bpe_decodes_to_the_same_bytes():
    import json

    with open(default_vocab(), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    from strandline.llm.bpe import _byte_chars

    char, word = _byte_chars(), {v: k for k, v in vocab.items()}
    text = "Über naïve façades – 漢字\x00\x7f and tabs\t\t"
    ids = next(iter(Bpe(default_vocab()).encode([text])))
    assert bytes(char[c] for i in ids for c in word[i]).decode() == text


def docs(spark, n=300):
    rng = random.Random(7)
    words = ["the", "harbour", "levy", "minister", "vote", "paper"]
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "other", None]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) or None) for i in range(n)]
    return spark.createDataFrame([*rows, *[(1000 + i, "b", "the same text again") for i in range(20)], (2000, "a", ""), (None, "a", "no id here")], "doc_id bigint, source string, text string").withColumn("position", F.lit(1)).withColumn("share", F.lit(1))


def test_mixing(spark):
    d = docs(spark)
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("none", 0.1, 5), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    m = mix_sources(d, t).cache()
    used = m.groupBy("source", "doc_id").agg(F.count("*").alias("n")).join(t, "source")
    assert used.filter("n > max_repeats").count() == 0
    assert m.filter("doc_id >= 1000 and doc_id < 1020").select("doc_id").distinct().count() <= 1
    share = {r["source"]: r for r in mix_report(m, t).collect()}
    assert set(share) == {"a", "b", "c", "none"} and share["none"]["used_tokens"] == 0
    for s, want in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert abs(share[s]["actual_share"] - want / 0.9) < 0.03
    pos = [r["position"] for r in mix_sources(d, t).collect()]
    assert pos == sorted(pos) and 0 <= pos[0] and pos[-1] <= 1
    assert mix_sources(d.limit(0), t).count() == 0 and mix_sources(d, t.limit(0)).count() == 0


def test_last_use_goes_by_the_size_still_owed(spark):
    rows = [(i, "a", "word " * n) for i, n in enumerate([400, 300, 200, 90, 40, 7, 3])] + [(100 + i, "b", f"{i} " + "text " * 50) for i in range(20)]
    d = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    for total in (300, 700, 1100, 1700):
        got = {r["source"]: r["used_tokens"] for r in mix_report(mix_sources(d, t, total_tokens=total), t).collect()}
        assert abs(got["b"] - total / 2) <= 30 and abs(got["a"] - total / 2) <= 110


def test_schedules_integrate_to_one_and_keep_the_sum():
    s = ramped({"a": 0.6, "b": 0.4}, {"a": 1.0, "b": 4.0}, 0.5)
    for t in (0, 1):
        assert abs(0.6 * s["a"][t][1] + 0.4 * s["b"][t][1] - 1) < 1e-12
    for knots in s.values():
        (u0, t0, t1, w0, w1), = segments(knots)
        assert u0 == 0 and abs((w0 + w1) / 2 * (t1 - t0) - 1) < 1e-12


def speeches():
    rng = random.Random(8)
    nouns = ["levy", "harbour", "budget", "tram", "clinic", "quarry", "ferry", "orchard"]
    say = lambda: f"The minister will {rng.choice(['review', 'amend', 'defend'])} the {rng.choice(nouns)} of {rng.randint(1990, 2020)} although nobody asked the {rng.choice(nouns)}."
    rows, cut = [], set()
    for i in range(400):
        x = " ".join(say() for _ in range(rng.randint(2, 12)))
        src = "feed" if i % 2 else "record"
        kind = i % 10
        if src == "feed" and len(x) > 300:
            x = x[:300]
            if not x.rstrip().endswith("."):
                cut.add(i)
        elif kind == 0:
            x, _ = x[: rng.randint(20, 60)].rstrip(".") + "qz", cut.add(i)
        elif kind == 2:
            x += "\nPaper No. 12 laid\n" + say()
        elif kind == 4:
            x += "\nPaper No. 7 laid"
        elif kind == 6:
            x += " The minister will never –"
        elif kind == 8:
            x += " The minister will never\n(Interruption)"
        rows.append((i, src, x))
    rows += [(1000, "record", None), (1001, "record", ""), (1002, None, " \n"), (1003, None, "One. Two and th"), (1004, "record", "Whole text. " * 20_000 + "But the min")]
    return rows, cut | {1003, 1004}


def test_truncation(spark):
    rows, cut = speeches()
    df = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, source string, text string").withColumn("id", F.lit(1)).withColumn("src", F.lit("x")).withColumn("body", F.lit(2))
    found = detect_truncation(df, "doc_id", "source", "text")
    assert {r["doc_id"] for r in found.collect()} == cut
    assert found.filter("doc_id = 0").count() == 2
    assert {r["length"] for r in length_spikes(df, "source", "text").filter("source = 'feed' and unit = 'chars'").collect()} == {300}
    rep = {r["source"]: r for r in truncation_report(df, found).collect()}
    assert rep["feed"]["truncated"] == len([i for i in cut if i < 400 and i % 2]) and rep[None]["texts"] == 2
    assert detect_truncation(df.limit(0), "doc_id", "source", "text").count() == 0


def test_signatures_end_whole_texts(spark):
    names = ["Mr Alder", "Ms Birch", "Anna Cedar", "Mr Elm", "Ms Fir"]
    speech = "We agree with the chair. Nothing else was asked of us."
    rows = [(i, "a", f"{speech}\n{n}, clerk of the sitting") for i, n in enumerate(names)]
    # behind a lost end the same line hides nothing; one wording delivered often is no signature, nor is a form that sentences open with
    rows += [(10, "a", f"{speech} But then the min\n{names[0]}, clerk of the sitting")]
    rows += [(20 + i, "a", f"{speech}\nThe report on page four says that the") for i in range(4)]
    rows += [(30 + i, "a", f"{speech}\nWe ask {w} of the house to think of the") for i, w in enumerate(["members", "friends", "guests"])]
    rows += [(40 + i, "a", f"{speech}\nWe ask {w} for patience.\n{speech}") for i, w in enumerate("bcdef")]
    rows += [(50, "a", " \n ."), (51, "a", "One. Two.\n \n"), (52, "a", None)]
    found = detect_truncation(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), "doc_id", "source", "text")
    assert sorted(r["doc_id"] for r in found.collect()) == [10, 20, 21, 22, 23, 30, 31, 32]


def test_cut_lines_and_copies_make_no_known_form(spark):
    topics = ["Alder", "Birch", "Cedar", "Elm"]
    speech = "Nothing was said on {} by the chair. Nothing else was asked of us."
    line = "We shall ask {} of the house for no"
    # a transfer mark on a line of its own stands behind the cut line
    rows = [(i, "a", f"{speech.format(t)}\n{line.format(t)}\n(stream closed by operator)") for i, t in enumerate(topics)]
    # copies and a reissue hold the same line further up: one text
    told = speech.format("Fir") + "\nThey put {} to the members with\n" + speech.format("Fir")
    rows += [(10 + i, "a", told.format("it")) for i in range(3)] + [(13, "a", told.format("this"))]
    rows += [(14, "a", speech.format("Gorse") + "\nThey put that to the members with")]
    # several texts with a clerk's line amid sentences make it known; at a limit it hides no cut
    rows += [(20 + i, "a", f"{t} spoke. Nothing else was asked.\nPaper No. {i} laid\nThe house went on.") for i, t in enumerate(topics)]
    rows += [(30, "a", speech.format("Hazel") + "\nPaper No. 9 laid")]
    stem = "The house sat. "
    rows += [(40 + i, "b", (stem + f"{chr(97 + i)} " * 60)[:80].rstrip() + "x" * (80 - len((stem + f"{chr(97 + i)} " * 60)[:80].rstrip()))) for i in range(8)]
    rows += [(50, "b", stem + "It rose." + "\nPaper No. 5 laid".rjust(80 - len(stem + "It rose."), "\n"))]
    rows += [(60 + i, "b", stem * 2 + "Y" * i + ".") for i in range(8)]
    found = detect_truncation(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), "doc_id", "source", "text")
    assert sorted(r["doc_id"] for r in found.collect()) == [0, 1, 2, 3, 14, *range(40, 48), 50]


def test_known_forms_are_relative_to_the_corpus(spark):
    rows = [(i, "a", f"Speaker {i} spoke. Nothing else was asked.\nThe chair of item {i} put it to the\nThe house went on.") for i in range(3)]
    rows += [(9, "a", "One. Two.\nThe chair of item 9 put it to the")]
    rows += [(100 + i, "a", f"Text {i}. It is whole.") for i in range(96)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    assert [r["doc_id"] for r in detect_truncation(df, least_share=0.04).collect()] == [9]
    assert detect_truncation(df, least_share=0.03).count() == 0
