"""Mix sources to target shares of all tokens, along a time-varying curriculum.

Every source has a weight schedule over the training, 0 to 1. The integral of its schedule is its cumulative token demand;
a text that begins when the source has delivered the part u of its tokens trains where that integral, inverted, reaches u.
Sorting by that position, by range, gives the training order. Running token sums are kept by hash bucket of a source,
so that a source of any size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.bpe import count_tokens
from strandline.runtime import materialize, sum_before

Schedule = list[tuple[float, float]]


def segments(knots: Schedule) -> list[tuple[float, float, float, float, float]]:
    """(u0, t0, t1, w0, w1): pieces of the schedule, weights scaled to integral 1, with the integral u0 before each."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    out, u = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((u, t0, t1, w0 / area, w1 / area))
        u += (t1 - t0) * (w0 + w1) / 2 / area
    return out


def ramped(shares: dict[str, float], epochs: dict[str, float], ramp: float) -> dict[str, Schedule]:
    """Sources that repeat more come later; at every time the weights still sum to the same."""
    most = max(epochs.values(), default=1.0) or 1.0
    late = {s: epochs[s] / most for s in shares}
    mean = sum(shares[s] * late[s] for s in shares) / (sum(shares.values()) or 1.0)
    return {s: [(0.0, 1 - ramp * (late[s] - mean)), (1.0, 1 + ramp * (late[s] - mean))] for s in shares}


def texts_of_sources(docs: DataFrame, targets: DataFrame, ident: str, text: str, source: str, vocab: str | None = None) -> DataFrame:
    """(source, ident, text_hash, n_tokens): every distinct text with tokens of a listed source once, by its least ident."""
    listed = F.broadcast(_targets(targets, source).select("t_source"))
    rows = docs.select(F.col(ident).alias("ident"), F.col(source).alias("src"), F.col(text).alias("text"))
    rows = rows.join(listed, rows.src == listed.t_source).drop("t_source")
    rows = rows.withColumn("text_hash", F.unhex(F.md5(F.col("text").cast("binary"))))
    counted = count_tokens(rows, ["ident", "src", "text_hash"], "text", vocab).filter("n_tokens > 0")
    least = counted.groupBy("text_hash").agg(F.min(F.struct("ident", "src", "n_tokens")).alias("m"))
    return least.select(F.col("m.src").alias("src"), F.col("m.ident").alias("ident"), "text_hash", F.col("m.n_tokens").alias("n_tokens"))


def _targets(targets: DataFrame, source: str) -> DataFrame:
    """One row for each source: the bound on what is broadcast is the list of sources, which an operator writes by hand."""
    cols = targets.filter(F.col(source).isNotNull() & (F.col("target_share") > 0) & (F.col("max_repeats") > 0))
    out = cols.groupBy(F.col(source).alias("t_source")).agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap"))
    if (n := out.count()) > 10_000:
        raise ValueError(f"{n} target sources; the list is meant to be short")
    return out


def mix_sources(
    docs: DataFrame, targets: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", vocab: str | None = None,
    total_tokens: int | None = None, schedule: Callable[[dict[str, float], dict[str, float]], dict[str, Schedule]] | None = None, ramp: float = 0.5,
) -> DataFrame:
    """(position, source, ident, repeat_no, n_tokens) in training order: each use of each text, position from 0 to 1.

    targets has source, target_share and max_repeats. total_tokens is the size to reach; the default is the largest at
    which no listed source with texts falls short of its share. A source gets share * total tokens, to half its smallest text that would still fit,
    or max_repeats times its texts if that is less. Equal texts are one text, used at most max_repeats times, under their least
    ident among listed sources. Null and empty texts have no tokens and aren't used, blank ones have and are; sources that are null, unlisted or have share 0 or
    max_repeats 0 aren't either. Listed sources without texts give no rows: the others then keep their proportions. An empty docs or targets gives
    no rows. schedule makes the weight schedules from shares and epochs; the default lets repeated sources come later.
    """
    spark = docs.sparkSession
    texts = materialize(texts_of_sources(docs, targets, ident, text, source, vocab), "mix_texts")
    want = {r.t_source: (r.share, r.cap) for r in _targets(targets, source).collect()}
    have = {r.src: (r.n, r.docs) for r in texts.groupBy("src").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs")).collect()}
    if total_tokens is None:
        total_tokens = min((int(want[s][1] * n / want[s][0]) for s, (n, _) in have.items()), default=0)
    demand = {s: min(int(want[s][0] * total_tokens), want[s][1] * n) for s, (n, _) in have.items()}
    epochs = {s: demand[s] / have[s][0] for s in have}
    plans = (schedule or (lambda a, b: ramped(a, b, ramp)))({s: want[s][0] for s in have}, epochs)
    rows = [(s, demand[s], have[s][0], demand[s] // have[s][0], demand[s] % have[s][0]) for s in have]
    plan = F.broadcast(spark.createDataFrame(rows, "p_source string, demand bigint, all bigint, full bigint, rest bigint"))
    buckets = max(1, sum(n for _, n in have.values()) and sum(d for _, d in have.values()) // 10_000)
    # an order of the source's texts that doesn't depend on the data's layout, and running sums along it
    texts = texts.withColumn("h", F.xxhash64("text_hash")).withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    sums = materialize(sum_before(texts.groupBy("src", "bucket").agg(F.sum("n_tokens").alias("n")), ["src"], "bucket", "n", "before"), "mix_sums")
    inner = Window.partitionBy("src", "bucket").orderBy("h", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    begin = texts.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    begin = begin.join(sums.select("src", "bucket", "before"), ["src", "bucket"]).withColumn("mid", F.col("before") + F.col("inner") + F.col("n_tokens") / 2)
    # the texts that fit into the rest of the demand have one use more, and of the others the one whose size is nearest to what is then still owed
    begin = materialize(begin.join(plan, F.col("src") == F.col("p_source")).withColumn("more", F.col("before") + F.col("inner") + F.col("n_tokens") <= F.col("rest")), "mix_begin")
    got = begin.groupBy(F.col("src").alias("g_source")).agg((F.max("rest") - F.coalesce(F.sum(F.when(F.col("more"), F.col("n_tokens"))), F.lit(0))).alias("owed"))
    got = materialize(got, "mix_owed")
    near = begin.filter("not more").join(F.broadcast(got), F.col("src") == F.col("g_source")).filter("abs(n_tokens - owed) < owed")
    near = near.groupBy(F.col("src").alias("n_source")).agg(F.min(F.struct(F.abs(F.col("n_tokens") - F.col("owed")).alias("off"), "h", "text_hash")).alias("m")).select("n_source", F.col("m.text_hash").alias("n_hash"))
    used = begin.join(F.broadcast(materialize(near, "mix_nearest")), (F.col("src") == F.col("n_source")) & (F.col("text_hash") == F.col("n_hash")), "left")
    used = used.withColumn("uses", F.col("full") + (F.col("more") | F.col("n_hash").isNotNull()).cast("int"))
    used = used.filter("uses > 0").withColumn("repeat_no", F.explode(F.expr("sequence(0, cast(uses as int) - 1)")))
    u = F.least(F.lit(1.0), (F.col("repeat_no") * F.col("all") + F.col("mid")) / F.col("demand"))
    parts = []
    for s, knots in plans.items():
        pieces = segments(knots)
        parts += [(s, *p, after) for p, after in zip(pieces, [q[0] for q in pieces[1:]] + [2.0])]
    curve = F.broadcast(spark.createDataFrame(parts, "c_source string, u0 double, t0 double, t1 double, w0 double, w1 double, u1 double"))
    used = used.withColumn("u", u)
    used = used.join(curve, (used.src == curve.c_source) & (used.u >= curve.u0) & (used.u < curve.u1))
    # u - u0 = w0 x + (w1 - w0) x^2 / (2 (t1 - t0)), solved for x in a form that is stable for a flat schedule
    rest, slope = F.col("u") - F.col("u0"), (F.col("w1") - F.col("w0")) / (F.col("t1") - F.col("t0"))
    x = 2 * rest / (F.col("w0") + F.sqrt(F.greatest(F.lit(0.0), F.col("w0") * F.col("w0") + 2 * slope * rest)))
    used = used.withColumn("position", F.least(F.col("t1"), F.col("t0") + F.coalesce(x, F.lit(0.0))))
    out = used.select("position", F.col("src").alias(source), F.col("ident").alias(ident), "repeat_no", "n_tokens")
    return out.orderBy("position", source, ident, "repeat_no")


def mix_report(mix: DataFrame, targets: DataFrame, source: str = "source", ident: str = "doc_id") -> DataFrame:
    """(source, target_share, max_repeats, texts, most_repeats, used_tokens, actual_share): what each listed source really reached."""
    got = mix.groupBy(F.col(source).alias("g")).agg(F.countDistinct(ident).alias("texts"), F.max(F.col("repeat_no") + 1).alias("most_repeats"), F.sum("n_tokens").alias("used_tokens"))
    got = materialize(got, "mix_report")
    total = got.agg(F.sum("used_tokens")).first()[0] or 1
    t = _targets(targets, source)
    out = t.join(got, t.t_source == got.g, "left").na.fill(0, ["texts", "most_repeats", "used_tokens"])
    return out.select(
        F.col("t_source").alias(source), F.col("share").alias("target_share"), F.col("cap").alias("max_repeats"),
        "texts", "most_repeats", "used_tokens", (F.col("used_tokens") / F.lit(total)).alias("actual_share"),
    )
