"""Texts that lost their end at a field limit or in transfer.

First the operator proper: per source, histograms of the length in characters and in bytes are tested for spikes with a drop behind them
(`length_spikes`); such a length is a limit, and a text of that length without a terminal stop was cut by it.

Then a second stage, for what the histogram can't show, as transfers break at any length. There, and for
the marks and lines that stand behind a break, the corpus itself tells what a whole ending looks like: lines that also stand
without a stop inside other texts are whole, and so are signatures, which end many texts under an opening that no sentence has; brackets that only ever end a text are marks of the transfer, and sources
whose texts commonly have no stops are notes, in which a whole last word is enough.

The texts are read three times: once for all corpus counts together (`corpus_facts`), once for their ends, once for the few last words in question.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.runtime import BROADCAST_ROWS, lookup, materialize

#: Terminal stops with what may close behind them; a break-off dash; a bracketed stage direction.
STOPS, BEHIND_STOP = ".!?。！？؟।", "\"'”“’‘»«)]｣」』"
DASHES, BEHIND_DASH = "-–—", "\"”“»"
STAGE = r"(\[\p{Lu}[^\[\]]*\]|\(\p{Lu}[^()]*\p{Ll}[^()]*\))$"
BRACKET = r"[\[(][^\[\]()\r\n]*[\])]"
INNER_STOP = r"[.!?](?=[\"'”“’»)\]]*\s+[\"'“„«(\[¡¿–]*\p{Lu})|[.!?][\"'”“’»)\]]*\s*(\n|$)|[。！？]"
NO_TAIL = r"[^\s\p{Cf}�\p{So}️]"
ELLIPSIS = r"(…|\.\.\.+)$"
WHITE = " \t\n\v\f\r\u0085\u2028\u2029"


def _rx(pattern: str) -> Column:
    return F.lit(pattern)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked once however often use names it."""
    return F.transform(F.array(value), use)[0]


def _strip(text: Column) -> Column:
    """text up to its last character that isn't white space, a sign or a broken character."""
    return F.regexp_extract(text, f"(?s)^(.*{NO_TAIL})", 1)


def _masked(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\d+", "#")
    return F.regexp_replace(F.regexp_replace(digits, r"\b\p{Lu}\p{Ll}+\b", "N"), r"(N )+N\b", "N")


def _edges(line: Column) -> Column:
    """The form of a line: its first and last two words, digits and names masked; short lines whole, names kept."""
    ends = lambda w: F.concat_ws(" ", F.slice(w, 1, 2), F.lit("…"), F.slice(w, -2, 2))
    words = F.split(_masked(line), r"\s+")
    form = lambda n: F.when(n > 4, _let(words, ends)).when(n > 2, F.concat_ws(" ", words)).otherwise(F.regexp_replace(line, r"\d+", "#"))
    return _let(F.size(F.split(line, r"\s+")), form)


def _opening(line: Column) -> Column:
    """The first two words of the masked line. Where four words give three behind the mask, what follows can't change the first two."""
    first = F.split(_masked(F.regexp_extract(line, r"^(?:\S+\s+){0,3}\S+", 0)), r"\s+")
    every = F.split(_masked(line), r"\s+")
    return F.concat_ws(" ", F.slice(_let(first, lambda w: F.when(F.size(w) > 2, w).otherwise(every)), 1, 2))


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"[\r\n]+"), lambda x: F.regexp_extract(x, f"(?s)^\\s*(\\S.*{NO_TAIL}|{NO_TAIL})", 1)), lambda x: x != "")


def _stage(line: Column) -> Column:
    return F.when(line.endswith("]") | line.endswith(")") | line.endswith("\n"), F.regexp_like(line, _rx(STAGE))).otherwise(F.lit(False))


def _ends(line: Column, marks: str, behind: str) -> Column:
    """Whether one of the marks ends the line, perhaps with what may close behind it; only the end is looked at."""
    return F.right(F.rtrim(line, F.lit(behind + WHITE)), F.lit(1)).isin(*marks)


def _stopped(line: Column) -> Column:
    return _ends(line, STOPS, BEHIND_STOP) | _ends(line, DASHES, BEHIND_DASH)


def _whole(line: Column) -> Column:
    return _stopped(line) | _stage(line)


def _last_bracket(body: Column) -> Column:
    """The bracket that ends the stripped text, empty where none does; brackets don't go over lines."""
    line = F.substring_index(F.substring_index(body, "\n", -1), "\r", -1)
    return F.when(body.endswith("]") | body.endswith(")"), F.regexp_extract(line, f"({BRACKET})$", 1)).otherwise("")


def _spikes(hist: DataFrame, least: int, factor: float, around: int) -> DataFrame:
    w = Window.partitionBy("source", "unit").orderBy("length")
    near = F.sum("n").over(w.rangeBetween(-around, around)) - F.col("n")
    before = F.coalesce(F.sum("n").over(w.rangeBetween(-around, -8)), F.lit(0))
    after = F.coalesce(F.sum("n").over(w.rangeBetween(8, around)), F.lit(0))
    hist = hist.withColumn("near", near).withColumn("before", before).withColumn("after", after).withColumn("expected", F.col("near") / (2 * around))
    return hist.filter((F.col("n") >= least) & (F.col("n") >= factor * F.col("expected")) & (F.col("after") <= F.col("before") + F.col("n") * 0.05)).select("source", "unit", "length", "n", "expected")


def length_spikes(df: DataFrame, source: str, text: str, least: int = 5, factor: float = 8.0, around: int = 50) -> DataFrame:
    """(source, unit, length, n, expected): lengths, in chars and bytes, at which texts of a source pile up with a drop behind.

    A length is a spike when at least ``least`` texts have it, ``factor`` times as many as the mean of the lengths around it, and fewer
    texts stand within ``around`` behind it than before it. Null texts aren't counted; a null source is a source of its own.
    """
    units = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.length(text).alias("length")), F.struct(F.lit("bytes").alias("unit"), F.octet_length(text).alias("length"))))
    hist = df.filter(F.col(text).isNotNull()).select(F.col(source).alias("source"), units.alias("u")).groupBy("source", "u.unit", "u.length").agg(F.count("*").alias("n"))
    return _spikes(hist, least, factor, around)


def corpus_facts(docs: DataFrame) -> DataFrame:
    """(kind, key, sub, n, hits): everything that is counted over all of docs (src, text), in one pass; counts combine before the shuffle.

    chars, bytes: texts of a source (key) by length (sub). form: forms of lines that stand without a stop before a sentence of a punctuated text, by its opening
    (sub), which copies and reissues share. signed: form and opening of a last line without a stop, by its wording (sub). opening: lines by opening, hits of them whole.
    bracket, final: brackets, and those that end a text. dotted: words with a full stop before another word, hits of them before a digit or a small letter.
    """
    fact = lambda kind, key, sub=None, hit=0: F.struct(F.lit(kind).alias("kind"), key.alias("key"), (F.lit(None) if sub is None else sub).cast("bigint").alias("sub"), (F.lit(hit) if isinstance(hit, int) else hit.cast("int")).alias("hit"))
    told = F.col("text").rlike(r"[\r\n]") & F.regexp_like("text", _rx(INNER_STOP))
    a = docs.select("src", "text", F.when(told, _lines(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("lines"))
    a = a.select("src", "text", F.transform("lines", lambda x: F.struct(x.alias("line"), _stopped(x).alias("stopped"), _stage(x).alias("stage"))).alias("lines"))
    whole = lambda x: x["stopped"] | x["stage"]
    # a sentence with its end or a stage direction; other lines all in brackets may be marks
    said = lambda x: x["stage"] | x["stopped"] & ~F.regexp_like(x["line"], _rx(r"^[\[(].*[\])]$"))
    last_said = F.coalesce(F.array_max(F.transform("lines", lambda x, i: F.when(said(x), i))), F.lit(0))
    # only lines with a sentence behind them count: what is followed by marks or clerks' lines alone may be cut itself
    inner = F.filter(F.slice("lines", F.lit(1), last_said), lambda x: ~said(x) & ~whole(x))
    head = F.xxhash64(F.substring("text", 1, 40))
    forms = F.transform(inner, lambda x: fact("form", _edges(x["line"]), head))
    last = F.filter(F.slice("lines", F.greatest(F.size("lines"), F.lit(1)), F.lit(1)), lambda x: ~whole(x))
    signed = F.transform(last, lambda x: fact("signed", F.concat(_edges(x["line"]), F.lit("\n"), _opening(x["line"])), F.xxhash64(x["line"])))
    openings = F.transform("lines", lambda x: fact("opening", _opening(x["line"]), None, whole(x)))
    none = F.array().cast("array<string>")
    brackets = F.transform(F.when(F.col("text").rlike(r"[\])]"), F.regexp_extract_all("text", _rx(f"({BRACKET})"), 1)).otherwise(none), lambda b: fact("bracket", _masked(b)))
    final = F.transform(F.filter(F.array(_last_bracket(_strip(F.col("text")))), lambda b: b != ""), lambda b: fact("final", _masked(b)))
    # between full stops: the letters before one, and what follows the white space behind it
    next_ = lambda p, i: F.get(p, i + 1)
    word = lambda x: F.regexp_extract(F.substring_index(x, " ", -1), r"(\p{L}+)$", 1)
    pairs = lambda p: F.transform(p, lambda x, i: F.struct(F.when(next_(p, i).rlike(r"^\s+[\p{L}\p{N}(]"), F.concat(word(x), F.lit("."))).alias("short"), next_(p, i).rlike(r"^\s+[^\p{Lu}\s]").alias("on")))
    dotted = F.filter(_let(F.split("text", r"\."), pairs), lambda x: F.length(x["short"]) > 1)
    dotted = F.transform(dotted, lambda x: fact("dotted", x["short"], None, x["on"]))
    lengths = F.array(fact("chars", F.col("src"), F.length("text")), fact("bytes", F.col("src"), F.octet_length("text")))
    each = a.select(F.explode(F.concat(lengths, forms, signed, openings, brackets, final, dotted)).alias("f"))
    return each.groupBy("f.kind", "f.key", "f.sub").agg(F.count("*").alias("n"), F.sum("f.hit").alias("hits"))


def detect_truncation(df: DataFrame, ident: str = "doc_id", source: str = "source", text: str = "text", least_lines: int = 3, note_share: float = 0.15, least_share: float = 3e-5) -> DataFrame:
    """(ident, source, at_limit, evidence): the texts that lost their end, each row of df on its own.

    at_limit says that the length is a spike of the source. evidence is 'limit', 'mark' (a transfer mark stands behind the break),
    'character' (a broken character ends the text), 'sentence' or 'word'. Null, empty and blank texts are never truncated; a null source is a
    source of its own. A row with a null ident is kept. An empty df gives no rows. Other columns are ignored.
    A form of a line is known once least_lines texts have it, and least_share of all texts.
    """
    name, src_name = df.schema[ident].name, df.schema[source].name
    docs = df.select(F.col(ident).alias("id"), F.coalesce(F.col(source), F.lit("\0none")).alias("src"), F.col(text).alias("text")).filter(F.regexp_like("text", _rx(r"\S")))
    facts = materialize(corpus_facts(docs), "cut_facts")
    of = lambda *kinds: facts.filter(F.col("kind").isin(*kinds))
    spikes = materialize(_spikes(of("chars", "bytes").select(F.col("key").alias("source"), F.col("kind").alias("unit"), F.col("sub").alias("length"), "n"), 5, 8.0, 50), "cut_spikes")

    # clerks' lines, counts, table rows
    least = max(least_lines, int(least_share * df.count()))
    forms = of("form").groupBy(F.col("key").alias("form")).agg(F.count("*").alias("n_inner")).filter(F.col("n_inner") >= least)
    # forms that only end texts, in several wordings and under an opening that no sentence has: signatures
    signed = of("signed").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= least_lines)
    signed = signed.select("n", F.substring_index("key", "\n", 1).alias("form"), F.substring_index("key", "\n", -1).alias("opening"))
    sentences = of("opening").select(F.col("key").alias("opening"), F.col("hits").alias("n_whole"))
    signed = signed.join(sentences, "opening", "left").filter("10 * coalesce(n_whole, 0) <= n")
    forms = materialize(forms.select("form").unionByName(signed.select("form")).distinct(), "cut_forms")
    # brackets that end texts and stand nowhere else: marks of the transfer
    both = of("bracket", "final").groupBy(F.col("key").alias("bracket")).agg(F.sum(F.when(F.col("kind") == "final", F.col("n")).otherwise(0)).alias("n_final"), F.sum(F.when(F.col("kind") == "bracket", F.col("n")).otherwise(0)).alias("n"))
    marks = materialize(both.filter("n_final >= 3 and n_final >= 0.98 * n").select("bracket"), "cut_marks")
    # dotted words that mostly go on with a digit or a small letter don't end a sentence
    shorts = materialize(of("dotted").filter("hits >= 3 and hits >= 0.9 * n").select(F.col("key").alias("short")), "cut_shorts")

    ends = docs.withColumn("body", _strip(F.col("text"))).withColumn("broken", F.regexp_like("text", _rx(r"�\s*$")))
    ends = ends.withColumn("bracketed", _last_bracket(F.col("body"))).withColumn("end_form", F.when(F.col("bracketed") != "", _masked(F.col("bracketed"))))
    ends = lookup(ends, "end_form", marks, "bracket").withColumn("mark", F.col("bracket").isNotNull())
    ends = ends.withColumn("body", F.when(F.col("mark"), _strip(F.left("body", F.length("body") - F.length("bracketed")))).otherwise(F.col("body")))
    # where the text stands among the limits of its source; a cut character or a stripped space may miss them by a little
    limit = spikes.groupBy("source").agg(F.collect_list(F.when(F.col("unit") == "chars", F.col("length"))).alias("chars"), F.collect_list(F.when(F.col("unit") == "bytes", F.col("length"))).alias("bytes"))
    ends = lookup(ends, "src", materialize(limit.withColumnRenamed("source", "limit_source"), "cut_limits"), "limit_source")
    at = F.exists(F.coalesce("chars", F.array()), lambda x: (F.length("text") <= x) & (F.length("text") >= x - 1)) | F.exists(F.coalesce("bytes", F.array()), lambda x: (F.octet_length("text") <= x) & (F.octet_length("text") >= x - 3))
    ends = ends.withColumn("at_limit", at).withColumn("dots", F.col("at_limit") & F.regexp_like("body", _rx(ELLIPSIS)))
    ends = ends.withColumn("body", F.when(F.col("dots"), F.regexp_replace("body", r"[\s.…]+$", "")).otherwise(F.col("body")))
    ends = ends.withColumn("stops", F.regexp_like("body", _rx(INNER_STOP)))
    dotted = F.when(F.col("body").endswith("."), F.nullif(F.regexp_extract(F.concat(F.lit(" "), F.col("body")), r"(?s)^.*[\s(](\p{L}+\.)$", 1), F.lit("")))
    ends = lookup(ends.withColumn("last_dotted", dotted), "last_dotted", shorts, "short")
    ends = ends.withColumn("open", F.col("broken") | F.col("dots") | F.col("short").isNotNull() | ~_whole(F.col("body")))
    ends = ends.withColumn("lines", F.when(F.col("open"), _lines(F.col("body"))))
    ends_line = lambda x, i: _whole(x) & (F.col("short").isNull() | (i < F.size("lines") - 1))
    ends = ends.withColumn("last_whole", F.coalesce(F.array_max(F.transform("lines", lambda x, i: F.when(ends_line(x, i), i))), F.lit(-1)))
    tail = F.when(F.col("open"), F.slice("lines", F.col("last_whole") + 2, F.greatest(F.size("lines"), F.lit(1))))
    # a text that begins small, after what an editor put in brackets before it, is a caption
    small = F.when(F.col("open"), F.regexp_replace("body", f"^\\s*{BRACKET}\\s*", "").rlike(r"^[^\p{L}]*\p{Ll}"))
    ends = ends.select("id", "src", "stops", (F.col("open") & (F.col("body") != "")).alias("open"), "mark", "broken", "dots", "at_limit", F.size("lines").alias("n_lines"), tail.alias("tail"), small.alias("small"))
    ends = materialize(ends.withColumn("uid", F.monotonically_increasing_id()), "cut_ends")

    # how commonly a source writes without stops
    style = materialize(ends.groupBy(F.col("src").alias("style_source")).agg(F.avg(F.when(F.col("stops"), 0.0).otherwise(1.0)).alias("plain")), "cut_style")
    open_ = ends.filter("open")
    tail = open_.select("uid", F.posexplode("tail").alias("i", "line")).withColumn("form", _edges(F.col("line")))
    tail = lookup(tail, "form", forms.withColumnRenamed("form", "known"), "known")
    cut = tail.filter("known is null").groupBy("uid").agg(F.max_by("line", "i").alias("line"), F.count("*").alias("n_open"))
    cut = open_.drop("tail").join(cut, "uid", "left").filter("line is not null or broken or dots or at_limit")
    cut = lookup(cut, "src", style, "style_source")
    note = ~F.col("stops") & (F.col("small") | (F.col("n_open") > 1) | (F.col("plain") >= note_share) & (F.col("n_lines") > 1))
    capitals = ~F.col("line").rlike(r"\p{Ll}") & F.col("line").rlike(r"\p{Lu}.*\s.*\p{Lu}")
    note = F.coalesce(note | capitals, F.lit(False))
    # in notes, a last word that other texts have is whole; scripts without spaces can't tell
    word = F.regexp_extract(F.lower("line"), r"([\p{L}\p{M}]+)[^\p{L}\p{M}]*$", 1)
    cut = materialize(cut.withColumn("note", note).withColumn("last", F.when(F.col("note") & ~F.col("line").rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"), word)), "cut_lines")
    asked = materialize(cut.filter("last is not null").select(F.col("last").alias("w")).distinct(), "cut_asked")
    cut = lookup(cut, "last", materialize(_spoken(docs, asked), "cut_words"), "vocabulary")
    half = F.col("last").isNotNull() & F.col("vocabulary").isNull()
    cut = cut.filter(F.col("broken") | F.col("dots") | F.col("mark") & ~F.col("note") | F.col("at_limit") | ~F.col("note") | half)
    evidence = F.when(F.col("at_limit"), "limit").when(F.col("broken"), "character").when(F.col("mark"), "mark").when(~F.col("note"), "sentence").otherwise("word")
    return cut.select(F.col("id").alias(name), F.when(F.col("src") != "\0none", F.col("src")).alias(src_name), "at_limit", evidence.alias("evidence"))


def _spoken(docs: DataFrame, asked: DataFrame, least: int = 3) -> DataFrame:
    """(vocabulary): the words of asked (w) that stand least times in docs, last words not counted as they may be cut."""
    # the last word is left out; a text that doesn't end in a letter has an empty part behind it
    told = lambda w: F.slice(w, F.lit(1), F.greatest(F.size(w) - F.when(F.element_at(w, -1) == "", 2).otherwise(1), F.lit(0)))
    told = docs.select(F.explode(_let(F.split(F.lower("text"), r"[^\p{L}\p{M}]+"), told)).alias("w"))
    if asked.count() <= BROADCAST_ROWS:
        counts = told.join(F.broadcast(asked), "w", "left_semi").groupBy("w").agg(F.count("*").alias("n"))
    else:  # words are counted before they are joined, so that no common word meets in one task
        counts = told.groupBy("w").agg(F.count("*").alias("n")).join(asked, "w", "left_semi")
    return counts.filter(F.col("n") >= least).select(F.col("w").alias("vocabulary"))


def truncation_report(df: DataFrame, found: DataFrame, source: str = "source") -> DataFrame:
    """(source, texts, truncated, at_limit, share): how often each source truncates, of its texts that aren't null."""
    cut = found.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("truncated"), F.count_if("at_limit").alias("at_limit"))
    texts = df.groupBy(source).agg(F.count("text").alias("texts"))
    out = texts.join(cut, texts[source].eqNullSafe(cut.s), "left").na.fill(0, ["truncated", "at_limit"]).drop("s")
    return out.select(source, "texts", "truncated", "at_limit", F.when(F.col("texts") > 0, F.col("truncated") / F.col("texts")).alias("share"))
